from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from paygrain.llm import merkle as M

from .conftest import SF


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def brute_path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return out


def brute(rows, fresh_text):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of every row, by the contract read literally."""
    keyed = sorted(
        ((r, brute_leaf(r, r["text"]), brute_leaf(r, fresh_text(r))) for r in rows),
        key=lambda x: (x[0]["source"] is not None, (x[0]["source"] or "").encode(), x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1], x[2]),
    )
    groups = [list(g) for _, g in groupby(keyed, key=lambda x: x[0]["source"])]
    trees = [brute_levels([leaf for _, leaf, _ in g]) for g in groups]
    top = brute_levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for g, (members, tree) in enumerate(zip(groups, trees)):
        for i, (row, leaf, fresh) in enumerate(members):
            path = brute_path(tree, i) + brute_path(top, g)
            folded = fresh
            for before, after in path:
                folded = H(*before, folded, *after)
            out.append((row["doc_id"], leaf, tree[-1][0], top[-1][0], H(*[x for pair in path for x in (*pair[0], *pair[1])]), folded))
    return out


def found(df, levels=M.LEVELS):
    text = F.replace("text", F.lit("a"), F.lit("b"))
    rows = M.manifest(M.leaves(df, {"text": text}), levels).collect()
    out = []
    for r in rows:
        proof = H(*[x for p in r["proof"] for x in (p["before"], p["after"])])
        out.append((r["key"], r["leaf"], r["subroot"], r["root"], proof, r["copies"][-1] if r["copies"] else r["fresh"]))
    return out


def ordered(rows):
    return sorted(rows, key=str)


def swapped(row):
    return None if row["text"] is None else row["text"].replace("a", "b")


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_every_shape(spark, levels):
    """Groups of 1 to 40 leaves, a hot one, and more groups than a page holds; pages of 3, 9 and 729."""
    sizes = {None: 5, "": 1, "é": 2, "z": 3, "Z": 4, "hot": 900 if levels == 6 else 260, **{f"s{i}": 1 + i % 40 * (i < 3) for i in range(60)}}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 100003, f"text a {n}" if n % 5 else None, "en" if n % 3 else None, source, n))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    expected = brute([r.asDict() for r in df.collect()], swapped)
    assert ordered(found(df, levels)) == ordered(expected)
    assert len({r[3] for r in expected}) == 1


def test_more_sources_than_a_page_holds(spark):
    df = spark.range(800).selectExpr("id doc_id", "concat('a', id) text", "'en' lang", "concat('src', id) source", "id n_chars")
    assert ordered(found(df)) == ordered(brute([r.asDict() for r in df.collect()], swapped))


def test_messy_rows(messy, none):
    rows = [r.asDict() for r in messy.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert ordered(found(messy)) == ordered(brute(rows, swapped))
    assert found(none) == []


def test_a_text_of_ten_megabytes(spark):
    df = spark.range(3).selectExpr("id doc_id", "repeat('a b\n', 2500000) text", "'en' lang", "'s' source", "1L n_chars")
    assert ordered(found(df)) == ordered(brute([r.asDict() for r in df.collect()], swapped))


def test_versions_share_what_is_not_copied(spark):
    """A version's root is the root of the tree built anew with that one leaf changed."""
    df = spark.range(40).selectExpr("id doc_id", "concat('a', id) text", "'en' lang", "if(id % 4 = 0, 'x', 'y') source", "id n_chars")
    rows = [r.asDict() for r in df.collect()]
    got = M.manifest(M.leaves(df, {"text": F.replace("text", F.lit("a"), F.lit("b"))}), 1).collect()
    for r in got:
        anew = brute([{**x, "text": swapped(x)} if x["doc_id"] == r["key"] else x for x in rows], lambda x: x["text"])
        assert r["copies"][-1] == anew[0][3] != r["root"]
    nodes = M.copied_nodes(M.manifest(M.leaves(df, {"text": F.replace("text", F.lit("a"), F.lit("b"))}), 1))
    assert nodes.count() == sum(len(r["copies"]) for r in got)


def test_query_by_brute_force_and_sql(spark, documents):
    rows = [r.asDict() for r in documents.collect()]

    def tampered(r):
        odd = zlib.crc32(str(r["doc_id"]).encode()) % 2
        return r["text"] if odd or r["text"] is None else r["text"].replace("\n", "")

    got = [tuple(r) for r in M.op12_merkle_manifest(spark, SF).collect()]
    expected = [(*r, r[5] == r[3]) for r in brute(rows, tampered)]
    assert ordered(got) == ordered(expected) and {r[6] for r in got} == {True, False}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    assert ordered(con.sql(M.SQL).fetchall()) == ordered(got)
