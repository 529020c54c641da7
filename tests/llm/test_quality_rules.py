from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from paygrain.llm import quality_rules as Q

from .conftest import SF


def exact_tail(n, k, rate):
    r = Fraction(rate)
    return float(sum(math.comb(n, i) * r**i * (1 - r) ** (n - i) for i in range(k + 1)))


@pytest.mark.parametrize("n, k, rate", [(100, 0, 0.0125), (700, 3, 0.0125), (700, 8, 0.0125), (5000, 40, 0.0125), (50, 3, 0.1), (1, 0, 0.5)])
def test_binomial_tail_is_exact(spark, n, k, rate):
    got = spark.range(1).select(F.expr(Q.binomial_tail(f"{n}L", f"{k}L", rate)).alias("p")).first()["p"]
    assert got == pytest.approx(exact_tail(n, k, rate), rel=1e-8)


def test_binomial_tail_of_large_numbers(spark):
    """Far beyond what can be summed term by term: the tail at the mean is about a half."""
    n, rate = 10**9, 0.0125
    got = spark.range(1).select(F.expr(Q.binomial_tail(f"{n}L", f"{int(n * rate) - 1}L", rate)).alias("p")).first()["p"]
    assert 0.49 < got < 0.51


def brute(text):
    text = text or ""
    for blank in "\t\n\x0b\x0c\r":
        assert blank in Q.BLANKS
    words = [w for w in "".join(" " if c in Q.BLANKS else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(Q.BLANKS)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_measures_by_brute_force(messy, documents):
    for docs in (messy, documents):
        found = Q.measures(docs).join(docs.select(F.col("doc_id").alias("key"), "text").distinct(), "key").collect()
        for r in found:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(r["text"])


def labelled(spark, good, bad):
    """One stratum: ``good`` shares of symbols of good documents, ``bad`` of bad ones."""
    rows = [(i, "en", s, 1) for i, s in enumerate(good)] + [(10_000_000 + i, "en", s, 0) for i, s in enumerate(bad)]
    frame = spark.createDataFrame(rows, "key bigint, stratum string, s double, quality int")
    measured = frame.select(
        "key", "stratum", F.lit(100).cast("long").alias("n_words"), F.lit(500).cast("long").alias("word_chars"),
        (F.col("s") * 500).cast("long").alias("n_symbols"), F.lit(0).cast("long").alias("n_dup_lines"), F.lit(10).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_repeat_words"), F.lit(False).alias("base_failed"),
    )
    return measured, frame.select(F.col("key").alias("doc_id"), "quality")


def last_accepted(good, strata=1):
    """The cutoffs of the last step before the first that fails, by walking through the steps one at a time."""
    held = None
    for cuts in Q.vectors():
        k = sum(s > cuts.get("symbols", 9) for s in good)
        if exact_tail(len(good), k, Q.RISK) > Q.CONFIDENCE / strata:
            break
        held = cuts
    return held


def test_steps_go_from_lax_to_strict():
    assert len(Q.STEPS) == len(set(Q.STEPS)) == sum(len(r.cutoffs) for r in Q.RULES)
    for before, after in zip(Q.vectors(), Q.vectors()[1:]):
        assert all(after[name] <= cut for name, cut in before.items())
    assert Q.vectors()[-1] == {r.name: min(r.cutoffs) for r in Q.RULES}


def test_last_step_within_the_risk(spark):
    """Good documents at 0.08 and 0.35, more at 0.08 from stratum to stratum: each sequence ends where too many are rejected."""
    goods = {str(n): [0.0] * 2000 + [0.08] * n + [0.35] * 2 for n in (0, 5, 18, 20, 22, 24, 26, 28, 30, 60)}
    measured, labels = labelled(spark, [s for g in goods.values() for s in g], [])
    names = [name for name, g in goods.items() for _ in g]
    strata = spark.createDataFrame(list(enumerate(names)), "key bigint, stratum string")
    measured = measured.drop("stratum").join(strata, "key")
    found = {r["stratum"]: r for r in Q.cutoffs(measured, labels).collect()}
    for name, good in goods.items():
        want, got = last_accepted(good, len(goods)), found[name]
        assert {r.name: got[f"cut_{r.name}"] for r in Q.RULES} == {r.name: want.get(r.name) for r in Q.RULES}
        assert (got["n"], got["k"]) == (len(good), sum(s > want["symbols"] for s in good))
    assert {r["cut_symbols"] for r in found.values()} == {0.02, 0.1}


def test_accepted_cutoffs_reject_the_bad(spark):
    measured, labels = labelled(spark, [0.0] * 2000 + [0.08] * 5 + [0.35] * 2, [0.5] * 300)
    kept = Q.judge(measured, Q.cutoffs(measured, labels))
    assert kept.where("not kept").where("key < 10000000").count() == 7
    assert kept.where("kept").where("key >= 10000000").count() == 0


def test_all_rules_share_the_risk(spark):
    """Two rules that reject 1.2 % each would hold alone at 2 %, but not together."""
    frame, labels = labelled(spark, [0.0] * 3000, [])
    one = frame.withColumn("n_symbols", F.when(F.col("key") < 36, 150).otherwise(0).cast("long"))
    both = one.withColumn("n_dup_lines", F.when(F.col("key").between(36, 71), 6).otherwise(0).cast("long"))
    assert Q.cutoffs(one, labels).first()["cut_symbols"] == 0.02
    found = Q.cutoffs(both, labels).first()
    assert found["k"] == 36 and (found["cut_symbols"] >= 0.3) != (found["cut_lines"] >= 0.6)


def test_few_labels_give_no_cutoff(spark):
    measured, labels = labelled(spark, [0.0] * 60, [0.5] * 60)
    assert Q.cutoffs(measured, labels).count() == 0
    assert Q.judge(measured, Q.cutoffs(measured, labels)).where("not kept").count() == 0


@pytest.mark.parametrize("n, accepted", [(216, 0), (217, 4)])
def test_labels_that_four_strata_need(spark, n, accepted):
    """Without a rejection, four strata take 217 good labels each: 0.98 ** 217 is just below 0.05 / 4."""
    measured, labels = labelled(spark, [0.0] * (4 * n), [])
    measured = measured.withColumn("stratum", (F.col("key") % 4).cast("string"))
    assert Q.cutoffs(measured, labels).count() == accepted


def test_messy(spark, messy, none):
    labels = spark.createDataFrame([(None, 1), (5, None), (5, 1), (6, 0), (6, 1)], "doc_id bigint, quality int")
    for docs in (messy, none):
        measured = Q.measures(docs)
        assert Q.judge(measured, Q.cutoffs(measured, labels)).count() == docs.count()
        assert Q.judge(measured, Q.cutoffs(measured, labels.where("false"))).count() == docs.count()


@pytest.mark.parametrize("sf", [SF, SF.replace("sf0.001", "sf0.1")])
def test_query_against_its_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = Q.op8_quality_rules(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({Q.SQL})").fetchall())


def test_every_language_of_the_larger_table_has_cutoffs(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    measured = Q.measures(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    cuts = Q.cutoffs(measured, labels).collect()
    assert {r["stratum"] for r in cuts} == {"de", "en", "es", "fr"}
    assert all(r["k"] <= Q.RISK * r["n"] for r in cuts)


def test_plan_stays_in_the_jvm(spark, documents):
    plan = Q.measures(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
