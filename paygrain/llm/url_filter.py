"""URL filter lists: a trie over reversed host labels and path segments, longest match wins."""

from __future__ import annotations

import re
from bisect import insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

#: A list beyond this many entries is refused: the trie goes to every executor.
MAX_RULES = 1_000_000

_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_END, _PATH_END = re.compile("[/?#]"), re.compile("[?#]")


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed values of the query's contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (ASCII letters lower-cased, port and user kept) and path; both empty without ``://``."""
    start = -1 if url is None else url.find("://")
    if start < 0:
        return "", ""
    rest = url[start + 3 :]
    host_end = _HOST_END.search(rest)
    if host_end is None:
        return rest.translate(_ASCII_LOWER), ""
    path = rest[host_end.start() :]
    path_end = _PATH_END.search(path)
    return rest[: host_end.start()].translate(_ASCII_LOWER), path[: path_end.start()] if path_end else path


class HostNode:
    """One host label. ``paths`` holds the path trie of the entries that end here."""

    __slots__ = ("labels", "paths")

    def __init__(self) -> None:
        self.labels: dict[str, HostNode] = {}
        self.paths: PathNode | None = None


class PathNode:
    """One whole path segment. ``tails`` are entries that end inside the next segment, ``sizes`` their lengths, falling."""

    __slots__ = ("segments", "sizes", "tails")

    def __init__(self) -> None:
        self.segments: dict[str, PathNode] = {}
        self.tails: dict[str, Rule] = {}
        self.sizes: list[int] = []


def build_trie(rules: Iterable[Rule]) -> HostNode:
    """Put the entries into one trie. Of two entries for the same host and path, block stays."""
    root = HostNode()
    for n, rule in enumerate(rules):
        if n >= MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} entries: the trie would be too large to send to every executor")
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.labels.setdefault(label, HostNode())
        node.paths = spot = node.paths or PathNode()
        *whole, tail = rule.path.split("/")
        for segment in whole:
            spot = spot.segments.setdefault(segment, PathNode())
        if len(tail) not in spot.sizes:
            insort(spot.sizes, len(tail), key=lambda n: -n)
        if tail not in spot.tails or rule.verdict == "block":
            spot.tails[tail] = rule
    return root


def _longest_path(node: PathNode, segments: list[str]) -> Rule | None:
    best = None
    for depth, segment in enumerate(segments):
        # One look-up for each length that occurs, however many entries there are.
        for size in node.sizes:
            rule = node.tails.get(segment[:size]) if size <= len(segment) else None
            if rule is not None:
                best = rule  # longer than what a shorter path has found
                break
        node = node.segments.get(segment) if depth + 1 < len(segments) else None
        if node is None:
            break
    return best


def match(trie: HostNode, host: str, path: str) -> Rule | None:
    """The longest entry that fits; of equally long ones the one with the longer host."""
    best, node, segments = None, trie, None
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        if node.paths is not None:
            segments = path.split("/") if segments is None else segments
            found = _longest_path(node.paths, segments)
            if found is not None and (best is None or len(found.text) >= len(best.text)):
                best = found
    return best


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], *, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """Host, path, deciding entry and verdict of every URL, one row per input row.

    No shuffle: the trie (at most ``MAX_RULES`` entries) is broadcast and each URL walks it once.
    A URL that is null or has no ``://`` has an empty host and path, meets no entry and gets
    ``default``; so does one outside all entries. Repeated rows and null keys are kept as they
    are; only ``key`` and ``url`` are read, so other columns cannot clash.
    """
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [match(root, host, path) for host, path in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p[0] for p in parts], pa.string()),
                    pa.array([p[1] for p in parts], pa.string()),
                    pa.array([r and r.text for r in found], pa.string()),
                    pa.array([r.verdict if r else default for r in found], pa.string()),
                ],
                ["key", "host", "path", "rule", "verdict"],
            )

    kind = pages.schema[key].dataType.simpleString()
    judged = pages.select(key, url).mapInArrow(
        work, f"key {kind}, host string, path string, rule string, verdict string"
    )
    return judged.withColumnRenamed("key", key)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL of ``pages`` against the five entries of the contract."""
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


SQL = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), rest AS (
  SELECT page_id, url,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), fits AS (
  SELECT p.*, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""
