"""SimHash near-duplicates: byte-position inverted index with count filtering, then components.

Two 64-bit fingerprints that differ in at most three bits differ in at most three of their eight
bytes, so at least five bytes agree, position by position. Five agreeing positions put at least three
into the same half of the fingerprint. The index therefore has one posting for every half and every
three of its four positions (eight postings per fingerprint, 24 bits each), and no linked pair escapes
it. Inside a posting the agreeing bytes of each pair are tallied, pairs below five are dropped, and
the rest are verified by their bit distance.

A posting that many fingerprints share (near copies of one text) is split again by two further
agreeing positions. What is left of such a part has 24 free bits, hence at most 2**24 members, and is
searched by neighbour lookup once that is cheaper than comparing its members. A posting yields a
spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary, drop_written, row_hash, sliced, table, written

#: The contract: three words to a shingle, links at three or fewer differing bits, seed of the hash.
SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: A posting with more members than this is split by two further byte positions.
LARGE_POSTING = 4096
#: Rows of a fingerprint that has more than one in so many are labelled where they lie.
HOT_SHARE = 1000
BYTES = 8
MIN_SHARED = BYTES - MAX_BITS
_BLOCK = 1 << 16  # shingles whose bits are counted at once


# --- fingerprints -----------------------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text: bytes.lower and bytes.split know ASCII only, as the contract does."""
    words = text.lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return digest(join(words), SEED)
    total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, _BLOCK):
        part = words[start : start + _BLOCK + shingle - 1]
        n = len(part) - shingle + 1
        windows = zip(*(part[i : i + n] for i in range(shingle)), strict=True)
        hashes = np.fromiter((digest(join(w), SEED) for w in windows), "<u8", n)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, keys: Sequence[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keys`` of every row and the fingerprint of its whole text, as a signed long ``fp``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(keys)):
            prints = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in binary(batch.column(len(keys)))), np.uint64, batch.num_rows
            )
            columns = [*batch.columns[: len(keys)], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "fp"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, text).mapInArrow(work, f"{kinds}, fp bigint")


# --- links ------------------------------------------------------------------------------------


def _byte(position: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))


def _packed(tag: int | Column, positions: Sequence[int]) -> Column:
    key = F.lit(tag).cast("long") if isinstance(tag, int) else tag
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(p))
    return key


#: Positions of each posting: three of either half.
POSTINGS = [p for half in (range(4), range(4, 8)) for p in combinations(half, 3)]


def postings(prints: DataFrame) -> DataFrame:
    """The inverted index: eight rows (key, fp) per fingerprint; the key holds the posting's number and its bytes."""
    keys = F.array(*[_packed(n, p) for n, p in enumerate(POSTINGS)])
    return prints.select(F.explode(keys).alias("key"), "fp")


def split_postings(large: DataFrame) -> DataFrame:
    """Rows of large postings under ten finer keys each, for every two of the five other positions.

    The finer key keeps posting and bytes (27 bits) and adds the pair of positions and their two bytes.
    """
    options = None
    for n, taken in enumerate(POSTINGS):
        others = [p for p in range(BYTES) if p not in taken]
        finer = F.array(*[_packed(F.col("key") * F.lit(10) + F.lit(i), pair) for i, pair in enumerate(combinations(others, 2))])
        hit = F.shiftright("key", 24) == n
        options = F.when(hit, finer) if options is None else options.when(hit, finer)
    return large.select(F.explode(options).alias("key"), "fp")


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member reachable from each of n members over the links left-right."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while (up := root[root]) is not root and (up != root).any():
            root = up
        live = root[left] != root[right]
        left, right = left[live], right[live]
    return root


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then verification: at least five agreeing bytes, at most ``max_bits`` differing bits."""
    differ = a ^ b
    shared = np.zeros(len(differ), np.uint8)
    for p in range(BYTES):
        shared += (differ >> np.uint64(8 * p)) & np.uint64(255) == 0
    out = shared >= BYTES - max_bits
    out[out] = np.bitwise_count(differ[out]) <= max_bits
    return out


def _small_runs(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside all runs of equal keys: neighbours at distance one, two, ... as long as runs are that long."""
    left, right = [], []
    at = np.flatnonzero(keys[1:] == keys[:-1]) if len(keys) > 1 else np.empty(0, np.int64)
    step = 1
    while len(at):
        ok = _linked(prints[at], prints[at + step], max_bits)
        left.append(at[ok])
        right.append(at[ok] + step)
        step += 1
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _masks(free: int, max_bits: int) -> np.ndarray:
    bits = [1 << i for i in range(64) if free >> i & 1]
    return np.array([sum(c) for k in range(1, max_bits + 1) for c in combinations(bits, k)], np.uint64)


def _large_run(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """Root of each member of one run (sorted, distinct), by the cheaper of comparing members and looking up neighbours."""
    n = len(prints)
    root = np.arange(n)
    varying = int(np.bitwise_or.reduce(prints ^ prints[0])) if n else 0
    n_free = varying.bit_count()
    lookups = sum(len(list(combinations(range(n_free), k))) for k in range(1, max_bits + 1)) if n_free <= 24 else n
    if lookups * 8 < n:
        for mask in _masks(varying, max_bits):
            other = prints ^ mask
            at = np.minimum(np.searchsorted(prints, other), n - 1)
            hit = np.flatnonzero(prints[at] == other)
            root = _merge(root, hit, at[hit])
        return root
    for start in range(0, n, 256):
        block = prints[start : start + 256]
        rest = prints[start:]
        i, j = np.nonzero(np.bitwise_count(block[:, None] ^ rest[None, :]) <= max_bits)
        i, j = i[i < j], j[i < j]
        ok = _linked(block[i], rest[j], max_bits)
        root = _merge(root, i[ok] + start, j[ok] + start)
    return root


def _merge(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _roots(len(root), root[left], root[right])[root]


def _run_links(
    batches: Iterator[pa.RecordBatch], max_bits: int, small: int = 64
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Forest edges (fp, root fp) of rows sorted by key, run by run; at most one run is held besides a batch."""

    def solve(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        ends = np.append(starts[1:], len(keys))
        big = ends - starts > small
        cool = np.ones(len(keys), bool)
        for s, e in zip(starts[big], ends[big], strict=True):
            cool[s:e] = False
            own = np.unique(prints[s:e])
            root = _large_run(own, max_bits)
            away = np.flatnonzero(root != np.arange(len(own)))
            yield own[away], own[root[away]]
        k, p = keys[cool], prints[cool]
        left, right = _small_runs(k, p, max_bits)
        root = _roots(len(k), left, right)
        away = np.flatnonzero(root != np.arange(len(k)))
        away = away[p[away] != p[root[away]]]
        yield p[away], p[root[away]]

    held_keys: list[np.ndarray] = []
    held_prints: list[np.ndarray] = []
    for batch in batches:
        held_keys.append(batch.column(0).to_numpy(zero_copy_only=False))
        held_prints.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
        if held_keys[0][0] == held_keys[-1][-1]:
            continue  # one run so far, and it may go on
        keys, prints = np.concatenate(held_keys), np.concatenate(held_prints)
        cut = int(np.searchsorted(keys, keys[-1]))
        yield from solve(keys[:cut], prints[:cut])
        held_keys, held_prints = [keys[cut:]], [prints[cut:]]
    if held_keys:
        yield from solve(np.concatenate(held_keys), np.concatenate(held_prints))


def _forest(index: DataFrame, max_bits: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _run_links((x for x in batches if x.num_rows), max_bits):
            a, b = np.maximum(a.view(np.int64), b.view(np.int64)), np.minimum(a.view(np.int64), b.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

    return index.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(work, "u bigint, v bigint")


def links(prints: DataFrame, max_bits: int = MAX_BITS, large: int = LARGE_POSTING) -> DataFrame:
    """Edges u > v between distinct fingerprints that connect exactly what links of ``max_bits`` connect.

    ``prints`` has distinct ``fp``. Large postings are known by counts, and join by key, so nothing is broadcast.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the index is complete for at most {MAX_BITS} differing bits")
    index = postings(prints)
    crowded = index.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > large).select("key")
    cool = _forest(index.join(crowded, "key", "left_anti"), max_bits)
    split = _forest(split_postings(index.join(crowded, "key", "left_semi")), max_bits)
    return cool.union(split).distinct()


# --- components -------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of ``edges`` (u > v) with the smallest node it reaches.

    Large-star and small-star rounds turn the edges into stars. Each round is a few groupings with partial
    minima and joins on the node; its edges are written to the shared folder. The number of rounds grows
    with the logarithm of a component's length; only a count and a checksum come to the driver.
    """
    spark = edges.sparkSession
    current, path = written(edges, "edges")
    state = None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        after, after_path = written(small.where("u != v").distinct(), "edges")
        sums = after.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        drop_written(spark, path)
        current, path = after, after_path
        if state == (sums["n"], sums["x"]):
            roots = current.select("v").distinct()
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
            )
        state = (sums["n"], sums["x"])


def near_duplicates(
    docs: DataFrame, keys: Sequence[str], best: Column, *, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``keys`` and ``fp`` of every row, and ``best``: the smallest ``best`` of the rows its links reach, itself included.

    Rows with equal fingerprints are one node (exact copies collapse before any shuffle of the index), so a
    group of copies of any size costs one fingerprint. A null or empty text has fingerprint zero and is
    linked like any other. Null keys are kept; a null ``best`` counts only where a component has no other.
    Repeated rows stay repeated. An empty table gives an empty result. Columns outside ``keys`` and ``text``
    are not read.
    """
    prints, _ = written(with_fingerprints(docs, keys, text, shingle), "prints")
    nodes = prints.groupBy("fp").agg(F.min(best).alias("own"), F.count(F.lit(1)).alias("copies"))
    nodes, _ = written(nodes, "nodes")
    parts, _ = written(components(links(nodes.select("fp"), max_bits)), "parts")
    linked = nodes.join(parts, F.col("fp") == F.col("node"))
    lowest = linked.groupBy("root").agg(F.min("own").alias("best"))
    member = parts.join(lowest, "root").select(F.col("node").alias("fp"), "best")
    label, _ = written(nodes.join(member, "fp", "left").select("fp", F.coalesce("best", "own").alias("best"), "copies"), "labels")
    # Copies of one text are not gathered: at most HOT_SHARE fingerprints have so many, and their labels are broadcast.
    crowd = F.col("copies") * HOT_SHARE > prints.count()
    hot = label.where(crowd).drop("copies")
    cool = prints.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(label.where(~crowd).drop("copies"), "fp")
    return cool.unionByName(prints.join(F.broadcast(hot), "fp"))


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], F.col("doc_id"))
    return found.select("doc_id", hex_print(F.col("fp")).alias("fingerprint"), F.col("best").alias("component_id"))


def keep_one(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component stays: that with the smallest doc_id (null last), then the smallest row hash.

    Rows that are equal in every column are one row. The columns are those of ``docs``.
    """
    id_, hash_ = "__dedup_id", "__dedup_hash"
    marked = docs.withColumns({id_: F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")), hash_: row_hash(docs)})
    found = near_duplicates(
        marked.select(id_, hash_, "text"), [id_, hash_], F.struct(id_, hash_), shingle=shingle, max_bits=max_bits
    )
    best = found.select("best.*").distinct()
    first = marked.join(best, [hash_, id_], "left_semi")
    # Only where a row occurs twice must whole rows meet once more to become one.
    if not found.groupBy(hash_, id_).count().where("count > 1").isEmpty():
        first = first.dropDuplicates([hash_, id_])
    return first.select(*[F.col(f"`{c}`") for c in docs.columns])
