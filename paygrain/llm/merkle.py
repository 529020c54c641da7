"""A Merkle manifest of a dataset as a persistent tree: what changed, proved against one root.

Rows are leaves. The leaves of each group (source) form a tree of runs of three, and the groups' roots, in the
order of the groups, form another on top. Leaves lie in pages, aligned blocks of 3**6 leaves, each with its whole
subtree; the pages' roots are the leaves of the next pages, and so on, so a tree of any size is a few tables of
small rows and nothing passes through one task.

A changed leaf makes a version of the tree by path copying: it copies its ancestors, first those inside its page,
then those above, and shares every other node with the base tree. A page knows what stands beside each of its
nodes; what stands beside the ancestors of the page itself comes to it in one row from the pages above. A version
is therefore a leaf and its copied ancestors, one row, whatever the number of versions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, written

#: The contract: nodes of a run, and what is hashed of a row, in this order.
FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels inside a page.
LEVELS = 6

_SIDES = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_SIDES_DDL = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- leaves -----------------------------------------------------------------------------------


def leaf_of(fields: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) of the fields: each as byte count, colon, value; a dash for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(docs: DataFrame, changed: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source") -> DataFrame:
    """``key``, ``grp``, ``leaf`` of every row and ``fresh``, its leaf with the columns of ``changed`` in place of its own."""
    changed = changed or {}
    own = [F.col(f"`{f}`") for f in fields]
    fresh = [changed.get(f, F.col(f"`{f}`")) for f in fields]
    return docs.select(F.col(key).alias("key"), F.col(group).alias("grp"), leaf_of(own).alias("leaf"), leaf_of(fresh).alias("fresh"))


def numbered(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with their place ``idx`` in the order of the columns (nulls first) and the part they lie in.

    Rows are dealt by ranges and counted by part; only the parts' counts, one row each, are summed in one place.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("pos", F.monotonically_increasing_id())
    kept, _ = written(sorted_.withColumn("part", F.shiftright("pos", 33)), label)
    sizes = kept.groupBy("part").agg(F.min("pos").alias("base"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("base")).alias("shift"))
    return kept.join(sizes, "part").withColumn("idx", F.col("pos") + F.col("shift")).drop("pos", "shift")


# --- subtrees in tasks ------------------------------------------------------------------------


def levels_of(n: int, most: int) -> int:
    """Levels of runs that bring n nodes of a group together, or ``most``, those of a page, if they take more."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FAN), levels + 1
    return levels


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """All nodes of a page by level, its own nodes first."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return out


def sides(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    """What stands before and after node ``i`` and each of its ancestors in its run, up to the root of the page."""
    out = []
    for level in tree[:-1]:
        run = i - i % FAN
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + FAN])))
        i //= FAN
    return out


def copies(leaf: str, path: Sequence[tuple[str, str]]) -> list[str]:
    """The ancestors of a leaf of a version: copies that share what stands beside them with the base tree."""
    out = []
    for before, after in path:
        leaf = digest(before + leaf + after)
        out.append(leaf)
    return out


# --- trees as tables --------------------------------------------------------------------------


def _paged(nodes: DataFrame, levels: int, extra: Sequence[str] = ()) -> DataFrame:
    """One row per page: gid, n (nodes of the group on this level), page, and its nodes in order."""
    member = F.struct("idx", "node", *extra)
    grouped = nodes.groupBy("gid", "n", F.expr(f"idx div {FAN**levels}").alias("page"))
    return grouped.agg(F.sort_array(F.collect_list(member)).alias("nodes"))


def _roots(pages: DataFrame, levels: int) -> DataFrame:
    """The pages' roots as nodes of the next level: gid, n, idx, node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            tops = [subtree(nodes, levels_of(n, levels))[-1][0] for n, nodes in zip(sizes, batch.column(3).to_pylist(), strict=True)]
            fewer = pa.array([-(-n // FAN**levels) for n in sizes], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fewer, batch.column(2), pa.array(tops, pa.string())], ["gid", "n", "idx", "node"])

    return pages.select("gid", "n", "page", F.col("nodes.node").alias("nodes")).mapInArrow(work, "gid bigint, n bigint, idx bigint, node string")


def above(nodes: DataFrame, most: int, levels: int = LEVELS) -> DataFrame:
    """For every node (gid, n, idx, node): ``path`` (what stands beside it and its ancestors) and ``top``, its group's root.

    ``most`` is the largest n. Each round takes pages of pages: three rounds reach 387 million nodes of a group.
    """
    if most <= 1:
        return nodes.select("gid", "idx", F.array().cast(_SIDES_DDL).alias("path"), F.col("node").alias("top"))
    pages, _ = written(_paged(nodes, levels), "merkle-pages")
    higher = above(_roots(pages, levels), -(-most // FAN**levels), levels).withColumnRenamed("idx", "page")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = subtree([x["node"] for x in row["nodes"]], levels_of(row["n"], levels))
                count = len(row["nodes"])
                paths = [[{"before": b, "after": a} for b, a in sides(tree, i)] + row["path"] for i in range(count)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["gid"]] * count, pa.int64()), pa.array([x["idx"] for x in row["nodes"]], pa.int64()),
                     pa.array(paths, _SIDES), pa.array([row["top"]] * count, pa.string())],
                    ["gid", "idx", "path", "top"],
                )

    return pages.join(higher, ["gid", "page"]).mapInArrow(work, f"gid bigint, idx bigint, path {_SIDES_DDL}, top string")


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The tree over ``rows`` (key, grp, leaf, fresh; see ``leaves``) and the version that each row's fresh leaf makes.

    One row per input row: ``key``, ``grp``, ``place`` (in its group), ``leaf``, ``subroot``, ``root``, ``proof`` (what stands
    before and after the leaf and each ancestor in its run) and ``copies`` (the ancestors of ``fresh`` in its version, the
    version's root last; empty if the leaf is itself the root).

    In a group rows stand by key, nulls first, rows of one key by their digests; repeated rows are leaves of their
    own. Groups stand in the order of their UTF-8 bytes, a null group first. An empty table has no root and gives no
    rows. Texts of any length are hashed whole, where they are read; only digests are shuffled. A group that holds
    most rows lies on many parts and pages. ``levels`` sets the size of the pages and changes no digest.
    """
    kept, _ = written(rows, "merkle-leaves")
    placed = numbered(kept, ["grp", "key", "leaf", "fresh"], "merkle-ordered")
    pieces = placed.groupBy("part", "grp").agg(F.min("idx").alias("least"), F.count(F.lit(1)).alias("rows"))
    pieces, _ = written(pieces, "merkle-pieces")
    groups = pieces.groupBy("grp").agg(F.min("least").alias("least"), F.sum("rows").alias("n"))
    groups, _ = written(numbered(groups, ["least"], "merkle-groups").select("grp", "least", "n", F.col("idx").alias("gid")), "merkle-gids")
    most, count = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    # A group is met part by part, so that no task gets all rows of one.
    own = pieces.drop("least").alias("p").join(groups.alias("g"), F.expr("p.grp <=> g.grp")).selectExpr("p.part", "p.grp", "gid", "least", "n")
    at = placed.alias("r").join(own.alias("o"), F.expr("r.part = o.part and r.grp <=> o.grp"))
    at = at.selectExpr("gid", "n", "idx - least as idx", "leaf as node", "key", "r.grp as grp", "fresh")
    pages, _ = written(_paged(at, levels, ["key", "grp", "fresh"]), "merkle-pages")

    inside = above(_roots(pages, levels), -(-(most or 1) // FAN**levels), levels)
    tops = inside.where("idx = 0").select(F.lit(0).cast("long").alias("gid"), F.lit(count).cast("long").alias("n"), F.col("gid").alias("idx"), F.col("top").alias("node"))
    tops, _ = written(tops, "merkle-tops")
    over = above(tops, count, levels).select(F.col("idx").alias("gid"), F.col("path").alias("last"), F.col("top").alias("root"))
    beside = inside.join(over, "gid").select("gid", F.col("idx").alias("page"), F.concat("path", "last").alias("path"), F.col("top").alias("subroot"), "root")
    kind, group = rows.schema["key"].dataType.simpleString(), rows.schema["grp"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(batch.schema.get_field_index("nodes"))
            for at, row in enumerate(batch.drop_columns(["nodes"]).to_pylist()):
                members = nodes[at].values
                leaf, fresh = members.field("node").to_pylist(), members.field("fresh").to_pylist()
                tree, higher = subtree(leaf, levels_of(row["n"], levels)), [(x["before"], x["after"]) for x in row["path"]]
                proofs, versions = [], []
                for i, new in enumerate(fresh):
                    path = sides(tree, i) + higher
                    proofs.append([{"before": b, "after": a} for b, a in path])
                    versions.append(copies(new, path))
                n = len(leaf)
                yield pa.RecordBatch.from_arrays(
                    [members.field("key"), members.field("grp"), members.field("idx"), members.field("node"), members.field("fresh"),
                     pa.array([row["subroot"]] * n, pa.string()), pa.array([row["root"]] * n, pa.string()),
                     pa.array(proofs, _SIDES), pa.array(versions, pa.list_(pa.string()))],
                    ["key", "grp", "place", "leaf", "fresh", "subroot", "root", "proof", "copies"],
                )

    return pages.join(beside, ["gid", "page"]).select("n", "nodes", "path", "subroot", "root").mapInArrow(
        work,
        f"key {kind}, grp {group}, place bigint, leaf string, fresh string, subroot string, root string, proof {_SIDES_DDL}, copies array<string>",
    )


def copied_nodes(found: DataFrame) -> DataFrame:
    """The nodes each version does not share with the base tree: version (its key), height above the leaf, node."""
    changed = found.where("fresh <> leaf")
    return changed.select(F.col("key").alias("version"), F.posexplode("copies").alias("height", "node")).withColumn("height", F.col("height") + 1)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf, with the root its version has after half of the documents lost their line feeds."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(leaves(docs, {"text": tampered}))
    folded = F.coalesce(F.try_element_at("copies", F.lit(-1)), F.col("fresh"))
    proof = F.array_join(F.transform("proof", lambda x: F.concat(x["before"], x["after"])), "")
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


# --- the same in SQL --------------------------------------------------------------------------

#: Levels spelt out in the statement: enough for 3**13 leaves of a source, and as many sources.
_SQL_LEVELS = 13


def _sql() -> str:
    def hashed(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    letters = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: {step}), 4294967295)"
    tables = [
        f"docs AS MATERIALIZED (SELECT *, CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents)",
        f"""hashed AS MATERIALIZED (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
            {hashed('text')} AS leaf, {hashed('other')} AS fresh FROM docs)""",
        """f0 AS MATERIALIZED (SELECT doc_id, g, leaf, fresh AS cur, '' AS proof,
            row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, fresh) - 1 AS i FROM hashed)""",
        "l0 AS MATERIALIZED (SELECT g, i, leaf AS h FROM f0)",
    ]

    def climb(nodes: str, rows: str, kept: str) -> tuple[str, str]:
        """The levels of one tree: nodes (g, i, h) upwards, and each row folded with what stands beside it."""
        for k in range(_SQL_LEVELS):
            tables.append(
                f"""{nodes}s{k} AS MATERIALIZED (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n,
                coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(h, '') OVER (PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
                FROM {nodes}{k})"""
            )
            tables.append(
                f"""{rows}{k + 1} AS MATERIALIZED (SELECT {kept}, r.g, r.i // 3 AS i, CASE WHEN n = 1 THEN cur ELSE sha256(before || cur || after) END AS cur,
                CASE WHEN n = 1 THEN proof ELSE proof || before || after END AS proof FROM {rows}{k} r JOIN {nodes}s{k} s ON r.g = s.g AND r.i = s.i)"""
            )
            tables.append(
                f"""{nodes}{k + 1} AS MATERIALIZED (SELECT g, i // 3 AS i, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
                FROM {nodes}s{k} GROUP BY g, i // 3, n)"""
            )
        return f"{nodes}{_SQL_LEVELS}", f"{rows}{_SQL_LEVELS}"

    subroots, folded = climb("l", "f", "doc_id, leaf")
    tables.append(f"t0 AS MATERIALIZED (SELECT 0 AS g, g AS i, h FROM {subroots})")
    tables.append(
        f"""u0 AS MATERIALIZED (SELECT doc_id, leaf, r.g AS own, 0 AS g, r.g AS i, cur, proof, h AS subroot
        FROM {folded} r JOIN {subroots} s ON r.g = s.g)"""
    )
    root, done = climb("t", "u", "doc_id, leaf, own, subroot")
    return f"""WITH {', '.join(tables)}
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified
        FROM {done}, {root}"""


SQL = _sql()
