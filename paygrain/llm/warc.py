"""WARC archives of captured pages, and a globally ordered index of them.

Writing: captures with equal payloads become one response and revisits of it. Archives are plain ``.warc``
record sequences in gzip, written by Spark's text sink (its committer deals with lost tasks), one per task
and at most ``records_per_file`` records each.

Reading: each archive is parsed by content lengths; payload digests are checked. Its index entries, sorted by
URL key and time, are one run. The runs are cut at common boundaries (range partitions of the whole key, so a
URL with very many captures is cut as well), and each range merges its pieces of all runs with a loser tree.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.session import scratch_path

from .common import table, written
from .url_filter import split_url

#: Payloads below this size are always stored (fixed value of the contract).
MIN_REVISIT = 100
RECORDS_PER_FILE = 20_000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "url_key string, captured timestamp, page_id bigint, record_type string, payload_bytes bigint, payload_digest string,"
    " refers_to bigint, url string, archive string, offset bigint, length bigint"
)


# --- writing ----------------------------------------------------------------------------------


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))


def captures(pages: DataFrame, captured: Column, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id``, url, payload, digest, size, time and ``refers_to`` (null for responses) of every page.

    The smallest page_id of each digest is found by partial minima, so a payload that a third of all pages
    share costs one row per task; only digests that occur twice are joined back. Rows that repeat the smallest
    page_id are responses too; a row without page_id refers to the response if its payload has one.
    """
    body = pages.select("page_id", "url", captured.alias("captured"), F.coalesce("html", F.lit("")).alias("payload"))
    body = body.withColumns(
        {"size": F.octet_length("payload").cast("long"), "digest": F.sha2(F.col("payload").cast("binary"), 256)}
    )
    first = body.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    both = body.join(first.where("n > 1").select("digest", "first"), "digest", "left")
    return both.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def record(named: DataFrame) -> DataFrame:
    """One column: the WARC record of each capture, without the two line ends behind it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), _line("Content-Type", "text/html; charset=utf-8"),
        _line("Content-Length", F.col("size").cast("string")), F.lit("\r\n"),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        _line("WARC-Date", F.date_format(F.col("captured"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(_line("WARC-Target-URI", target), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Profile", _PROFILE),
                _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
            ),
        ).otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"),
    )
    return named.select(F.concat(head, _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block).alias("value"))


def write_archives(
    pages: DataFrame, path: str, captured: Column, *, min_revisit: int = MIN_REVISIT, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``, which executors must share.

    A null html is an empty payload, a null url leaves out the target, a null time counts as the epoch. Other
    columns are not read. An empty table gives archives without records.
    """
    moment = F.coalesce(captured, F.timestamp_seconds(F.lit(0)))
    lines = record(captures(pages, moment, min_revisit))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


# --- reading ----------------------------------------------------------------------------------


def url_key(url: str | None) -> str:
    """Sort key that keeps a host's pages together: host labels from the right, then the rest of the URL."""
    host, path = split_url(url)
    if not host:
        return "" if url is None else url
    rest = url[url.find("://") + 3 + len(host) :]
    return ",".join(reversed(host.split("."))) + ")" + (rest if path else "/" + rest)


def parse(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Header fields, block, offset and length of each record of an uncompressed archive."""
    offset = 0
    while first := stream.readline():
        if first != b"WARC/1.1\r\n":
            raise ValueError(f"no record starts at byte {offset}")
        start, offset = offset, offset + len(first)
        fields: dict[str, str] = {}
        while (line := stream.readline()) != b"\r\n":
            if not line.endswith(b"\r\n"):
                raise ValueError(f"the record at byte {start} breaks off")
            offset += len(line)
            name, _, value = line.decode().partition(": ")
            fields[name] = value[:-2]
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} breaks off")
        offset += 2 + size + 4
        yield fields, block, start, offset - start


def _page(urn: str | None) -> int | None:
    name = "" if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name not in ("", "none") else None


def entries(content: bytes, archive: str) -> list[tuple]:
    """The index entries of one archive (gzip), sorted: one run."""
    out = []
    for fields, block, offset, length in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = next(int(x.split(b": ")[1]) for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} in {archive} does not match its digest")
        url = fields.get("WARC-Target-URI")
        captured = datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC)
        out.append(
            (url_key(url), captured, _page(fields["WARC-Record-ID"]), fields["WARC-Type"], size, digest,
             _page(fields.get("WARC-Refers-To")), url, archive, offset, length)
        )
    out.sort(key=_order)
    return out


def _order(x: Sequence) -> tuple:
    return x[0], x[1], x[2] is None, x[2] or 0, x[8], x[9]


_FIELDS = pa.schema(
    [
        ("url_key", pa.string()), ("captured", pa.timestamp("us", "UTC")), ("page_id", pa.int64()), ("record_type", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
        ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ]
)


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives below ``path``, each archive's in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                yield _batch(entries(content.as_py(), name.as_py().rpartition("/")[2]))

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return archives.select("path", "content").mapInArrow(work, INDEX)


class LoserTree:
    """Merges sorted sequences: each inner node holds the run that lost there, the root the run that won.

    Taking the next item replays only the path from its run's leaf, one comparison a level.
    """

    def __init__(self, sources: Iterable[Iterator]) -> None:
        self.sources = list(sources)
        k = self.k = max(1, len(self.sources))
        self.heads = [next(s, None) for s in self.sources] or [None]
        self.tree = [-1] * k
        for leaf in range(k):
            self._replay(leaf)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None if x is None or y is None and x is None else y is None or (x, a) < (y, b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # while the tree is filled: wait here for the neighbour
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.tree[0]]) is not None:
            winner = self.tree[0]
            yield head
            self.heads[winner] = next(self.sources[winner], None)
            self._replay(winner)


def merge_runs(index: DataFrame) -> DataFrame:
    """All entries ordered by URL key, time, page_id and place: partitions in order, rows in order within them.

    A partition's pieces of runs are the stretches that arrive in order, so the result does not depend on the
    order in which the shuffle delivers them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches), schema=None) if (batches := list(batches)) else None
        if held is None:
            return
        part = [held.column(n).to_pylist() for n in ("url_key", "captured", "page_id", "archive", "offset")]
        keys = [(u, t, p is None, p or 0, a, o, i) for i, (u, t, p, a, o) in enumerate(zip(*part, strict=True))]
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] < keys[i - 1]), len(keys)]
        tree = LoserTree(iter(keys[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
        yield from held.take(pa.array([x[-1] for x in tree], pa.int64())).to_batches()

    return index.repartitionByRange("url_key", "captured", "page_id", "archive", "offset").mapInArrow(work, INDEX)


def capture_histories(spark: SparkSession, path: str) -> DataFrame:
    """The merged index of all archives below ``path``."""
    sorted_runs, _ = written(runs(spark, path), "warc-runs")
    return merge_runs(sorted_runs)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back through the merged index.

    The table has no capture time; pages count as captured a second apart, in the order of their ids.
    """
    path = scratch_path(spark, "llm-warc")
    pages = table(spark, sf_dir, "pages")
    write_archives(pages, path, F.timestamp_seconds(F.col("page_id") + 1_577_836_800))
    return capture_histories(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH body AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
  SELECT digest, min(page_id) AS first FROM body WHERE strlen(html) >= 100 GROUP BY digest
)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM body LEFT JOIN firsts USING (digest)
"""
