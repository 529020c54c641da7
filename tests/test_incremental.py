"""Kept state against rebuilding, differences against comparing all rows, ranges against days."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal
from itertools import combinations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paygrain.operators import asof, bitmaps, digests, histories, intervals, islands, summaries

ARGS = ("k", "at", "v")


def stored_again(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_islands_after_random_late_rows(spark, tmp_path):
    """Five batches of rows in any order, values null now and then: equal to the rebuild after each."""
    rnd = random.Random(1)
    every = [(k, at, rnd.choice(["a", "b", None])) for k in range(8) for at in range(rnd.randint(1, 25))]
    rnd.shuffle(every)
    # Keys 0 and 1 come in order, so that islands are extended, not only made again.
    every.sort(key=lambda r: r[1] if r[0] < 2 else rnd.random() * 25)
    schema, step = "k long, at long, v string", len(every) // 5 + 1
    history, stored = [], None
    for i in range(0, len(every), step):
        batch = spark.createDataFrame(every[i : i + step], schema)
        history += every[i : i + step]
        whole = spark.createDataFrame(history, schema)
        stored = islands.islands(whole, *ARGS) if stored is None else islands.refresh(stored, batch, whole, *ARGS)
        stored = stored_again(spark, stored, tmp_path / str(i))
        assert rows(stored) == rows(islands.islands(whole, *ARGS))


def test_a_late_row_splits_and_joins(spark):
    frame = lambda data: spark.createDataFrame(data, "k long, at long, v string")
    base = [(1, 1, "a"), (1, 3, "a"), (2, 1, "a"), (2, 3, "b"), (2, 5, "a"), (3, 1, "x")]
    batch = [(1, 2, "b"), (2, 3, "a"), (3, 2, "x"), (3, 3, "y"), (4, 1, "n")]  # (2, 3) is a correction
    history = [r for r in base if r[:2] != (2, 3)] + batch
    stored = islands.islands(frame(base), *ARGS)
    assert rows(islands.late_entities(stored, frame(batch), "k", "at")) == [(1,), (2,)]
    assert rows(islands.refresh(stored, frame(batch), frame(history), *ARGS)) == [
        (1, 1, "a", 1, 1, 1), (1, 2, "b", 2, 2, 1), (1, 3, "a", 3, 3, 1), (2, 1, "a", 1, 5, 3),
        (3, 1, "x", 1, 2, 2), (3, 2, "y", 3, 3, 1), (4, 1, "n", 1, 1, 1),
    ]


def test_only_late_entities_are_read_again(spark, tmp_path):
    frame = lambda data: spark.createDataFrame(data, "k long, at long, v string")
    stored = islands.islands(frame([(1, 1, "a"), (2, 1, "a")]), *ARGS)
    broken = frame([(2, 0, "z")])  # a history that would spoil key 1, were it read for it
    got = islands.refresh(stored, frame([(1, 2, "b"), (2, 0, "z")]), broken, *ARGS)
    assert rows(got) == [(1, 1, "a", 1, 1, 1), (1, 2, "b", 2, 2, 1), (2, 1, "z", 0, 0, 1)]
    assert rows(islands.refresh(stored, frame([]), broken, *ARGS)) == rows(stored)


# --- digests ----------------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 4, 1024])
def test_drift(spark, buckets):
    source = spark.range(500).selectExpr("id k", "if(id % 9 = 0, null, id % 5) v", "cast(id as string) w")
    target = source.where("k not in (3, 77)").withColumn("v", F.expr("if(k in (8, 9), -1, v)"))
    target = target.unionByName(spark.createDataFrame([(900, None, "x")], "k long, v long, w string"))
    assert rows(digests.drift(source, target, "k", buckets=buckets)) == [
        (3, "missing"), (77, "missing"), (8, "altered"), (9, "altered"), (900, "deleted"),
    ]


def test_nulls_and_swapped_values_are_seen(spark):
    frame = lambda data: spark.createDataFrame(data, "k long, v string, w string")
    a = frame([(1, "x", None), (2, "p", "q"), (3, "", "")])
    assert rows(digests.drift(a, frame([(1, None, "x"), (2, "q", "p"), (3, "", None)]), "k", buckets=2)) == [
        (1, "altered"), (2, "altered"), (3, "altered"),
    ]


def test_equal_sides_shuffle_no_rows(spark):
    source = spark.range(1000).selectExpr("id k", "id % 7 v")
    found = digests.drift(source, source.repartition(5), "k")
    assert found.count() == 0
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    empty = source.where("false")
    assert digests.drift(empty, empty, "k").count() == 0 and digests.drift(source, empty, "k").count() == 1000


# --- bitmaps ----------------------------------------------------------------------------------


def test_every_grouping_from_one_state(spark):
    rnd = random.Random(2)
    data = [(rnd.choice("xyz"), rnd.choice([1, 2, None]), rnd.choice([None, 0, 1, 32767, 32768, 99999, rnd.randrange(200000)])) for _ in range(800)]
    df = spark.createDataFrame(data, "a string, b int, id long")
    state = bitmaps.merge_states(*[bitmaps.distinct_state(df.where(F.col("id") % 2 == i), ["a", "b"], "id") for i in (0, 1)])
    for by in (["a", "b"], ["a"], ["b"], []):
        expected = df.where("id is not null").groupBy(*by).agg(F.count_distinct("id").alias("n"))
        assert rows(bitmaps.distinct_counts(state, by, "n")) == rows(expected)
    sliced = bitmaps.distinct_counts(state.where("a = 'x'"), [], "n")
    assert rows(sliced) == rows(df.where("a = 'x'").agg(F.count_distinct("id").alias("n")))
    assert rows(bitmaps.distinct_counts(state.where("false"), [], "n")) == [(0,)]


# --- ranges -----------------------------------------------------------------------------------


def test_ranges_against_days(spark):
    rnd, d0 = random.Random(3), date(2025, 1, 1)
    data = []
    for i in range(160):
        start = d0 + timedelta(rnd.randrange(60))
        data.append((i, rnd.randrange(12), rnd.choice([1, 2, 3]), start, start + timedelta(rnd.choice([-1, 0, 1, 5, 20]))))
    data += [(200, 50, 1, d0, d0), (201, 50, 1, d0, d0), (202, None, 1, d0, None), (203, 51, 1, None, d0)]
    df = spark.createDataFrame(data, "id long, k long, r int, s date, e date")
    best = {}
    for i, k, r, s, e in data:
        for n in range((e - s).days + 1 if s and e else 0):
            day = (k, s + timedelta(n))
            best[day] = min(best.get(day, (9, 9)), (r, i))
    won = intervals.resolve_ranges(df, ["k"], "s", "e", F.col("r"), ["id"])
    days = intervals.explode_days(won, "lo", "hi", "day").collect()
    assert {(x.k, x.day): x.id for x in days} == {k: i for k, (_, i) in best.items()} and len(days) == len(best)
    # No two neighbouring stretches have the same winner.
    by = sorted((x.k, x.lo, x.hi, x.id) for x in won.collect())
    assert not any(a[0] == b[0] and a[3] == b[3] and b[1] - a[2] == timedelta(1) for a, b in zip(by, by[1:]))

    real = [(i, k, s, e) for i, k, _, s, e in data if s and e and s <= e]
    pairs = sum(a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3] for a, b in combinations(real, 2))
    total = Counter((k, s + timedelta(n)) for _, k, s, e in real for n in range((e - s).days + 1))
    figures = rows(intervals.overlap_figures(df, ["k"], "s", "e"))
    assert figures == [(pairs, sum(total.values()), sum(total.values()) - len(total))]
    assert rows(intervals.overlap_figures(df.where("false"), ["k"], "s", "e")) == [(0, 0, 0)]


# --- point in time as a merge -----------------------------------------------------------------


def _history(rnd, key, n):
    """Versions of one key that do not overlap, now and then with a gap; the last one open."""
    out, day = [], date(2020, 1, 1) + timedelta(rnd.randrange(20))
    for i in range(n):
        long = rnd.randrange(1, 9)
        end = None if i == n - 1 and rnd.random() < 0.5 else day + timedelta(long - 1)
        out.append((key, f"{key}-{i}", day, end))
        day += timedelta(long + rnd.choice([0, 0, 0, 4]))
    return out


@pytest.mark.parametrize("rows_per_task", [None, 5, 40])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_against_the_join(spark, rows_per_task, how):
    rnd = random.Random(5)
    versions = [v for k in range(6) for v in _history(rnd, k, rnd.choice([1, 3, 60]))] + [(None, "n", date(2020, 1, 1), None)]
    facts = [(i, 0 if i % 3 == 0 else rnd.choice([1, 2, 3, 4, 5, 9, None]), rnd.choice([None, date(2020, 1, 1) + timedelta(rnd.randrange(400))])) for i in range(400)]
    facts += facts[:30]
    f = spark.createDataFrame(facts, "id long, k long, day date").repartition(3)
    v = spark.createDataFrame(versions, "k long, name string, s date, e date")
    edges = asof.range_edges(f, "k", "day", rows_per_task) if rows_per_task else None
    got = asof.asof_join(f, v, "k", "day", "s", "e", how, edges)
    closed = v.withColumn("e", F.coalesce("e", F.lit("9999-12-31").cast("date")))
    expected = intervals.point_in_time_join(f, closed, "k", F.col("f.day"), "s", "e", how)
    assert rows(got, "id", "k", "day", "name", "s") == rows(expected, "id", "k", "day", "name", "s")
    for empty in (asof.asof_join(f.limit(0), v, "k", "day", "s", "e", how), asof.asof_join(f, v.limit(0), "k", "day", "s", "e", "inner")):
        assert empty.count() == 0
    assert asof.asof_join(f, v.limit(0), "k", "day", "s", "e", "left", edges).count() == len(facts)


def test_asof_with_very_many_versions_of_one_key(spark):
    v = spark.range(100_000).selectExpr("1L k", "id no", "date_add(date'1900-01-01', cast(id as int)) s", "date_add(date'1900-01-01', cast(id as int)) e")
    f = spark.range(50_000).selectExpr("id", "1L k", "date_add(date'1900-01-01', cast(id * 7 % 120000 as int)) day")
    edges = asof.range_edges(f, "k", "day", 4_000)
    (cut,) = edges.collect()
    assert len(cut["_edges"]) == 12
    numbered = f.groupBy(asof.range_number(F.lit(cut["_edges"]), F.col("day")).alias("r")).count().collect()
    assert max(r["count"] for r in numbered) < 6_000
    got = asof.asof_join(f, v, "k", "day", "s", "e", edges=edges)
    bad = got.where("no <> datediff(day, date'1900-01-01')").count()
    assert got.count() == f.where("day < date_add(date'1900-01-01', 100000)").count() and bad == 0
    plain = asof.asof_join(f, v, "k", "day", "s", "e")
    assert "Join" not in plain._jdf.queryExecution().executedPlan().toString()  # no fact meets a list of versions


# --- kept summaries ---------------------------------------------------------------------------


def test_summary_after_each_of_several_batches(spark, tmp_path):
    """Deletes, inserts, changes of group and of value, values and groups of NULL: equal to recomputation each time."""
    rnd, schema = random.Random(6), "id long, g string, h int, v decimal(12,2), q long"
    row = lambda i: (i, rnd.choice(["a", "b", "c", None]), rnd.choice([1, None]), rnd.choice([None, Decimal(rnd.randrange(-900, 900)) / 100]), rnd.choice([None, 3, -4]))
    fact = {i: row(i) for i in range(60)}
    groups, values = ["g", "h"], {"total": "v", "pieces": "q"}
    frame = lambda data: spark.createDataFrame(list(data), schema)
    stored = stored_again(spark, summaries.summarise(frame(fact.values()), groups, values), tmp_path / "0")
    for step in range(1, 5):
        keys = rnd.sample(range(90), 25)
        new = [row(i) for i in keys if rnd.random() < 0.7]
        if step == 3:  # a whole group goes
            keys, new = [i for i, r in fact.items() if r[1] == "a"], []
        old = summaries.replaced_rows(frame(fact.values()), frame([row(i) for i in keys]), "id")
        stored = summaries.apply_delta(stored, summaries.batch_delta(old, frame(new), groups, values), groups, values)
        stored = stored_again(spark, stored, tmp_path / str(step))
        fact = {i: r for i, r in fact.items() if i not in keys} | {r[0]: r for r in new}
        whole = frame(fact.values())
        assert rows(stored) == rows(summaries.summarise(whole, groups, values))
        assert step != 3 or "a" not in {r[0] for r in rows(stored)}
        for by in (groups, ["g"], []):
            plain = whole.groupBy(*by).agg(F.count("*").alias("n"), F.sum("v").alias("t"), F.sum("q").alias("p"))
            assert rows(summaries.totals(stored, by, values)) == rows(plain)


def test_unchanged_rows_make_no_delta_and_floats_are_refused(spark):
    df = spark.createDataFrame([(1, "a", 2)], "id long, g string, q long")
    assert summaries.batch_delta(df, df, ["g"], {"s": "q"}).count() == 0
    assert summaries.summarise(df.limit(0), ["g"], {"s": "q"}).count() == 0
    with pytest.raises(TypeError, match="exactly"):
        summaries.summarise(df.withColumn("q", F.col("q").cast("double")), ["g"], {"s": "q"})


# --- histories --------------------------------------------------------------------------------


def test_changed_ranges_against_days(spark):
    rnd, open_end, d0 = random.Random(7), date(9999, 12, 31), date(2019, 12, 1)
    before = [(k, n, s, e or open_end) for k in range(12) for _, n, s, e in _history(rnd, k, 6)]
    after = [(k, n if rnd.random() < 0.7 else n + "'", s, e) for k, n, s, e in before if k != 3 and rnd.random() < 0.9] + [(77, "x", d0, open_end)]
    schema = "k long, name string, s date, e date"
    frame = lambda data: spark.createDataFrame(data, schema)
    found = histories.changed_ranges(frame(before), frame(after), "k", "s", "e", "name").collect()

    def held(data):
        days = {(k, d0 + timedelta(i)): None for k in [*range(12), 77] for i in range(200)}
        for k, n, s, e in data:
            days |= {day: n for day in days if day[0] == k and s <= day[1] <= e}
        return days

    old, new = held(before), held(after)
    expected = {day for day in old if old[day] != new[day]}
    assert {day for day in old if any(r.k == day[0] and r.lo <= day[1] <= r.hi for r in found)} == expected
    for a in found:
        assert not any(a.k == b.k and a.hi < open_end and b.lo == a.hi + timedelta(1) for b in found)
    assert histories.changed_ranges(frame(before), frame(before), "k", "s", "e", "name").count() == 0
    assert histories.changed_ranges(frame([]), frame([]), "k", "s", "e", "name").count() == 0
    facts = spark.createDataFrame([day for day in old], "k long, day date")
    assert {tuple(r) for r in histories.stale_facts(facts, frame(before).selectExpr("k", "s lo", "e hi").where("false"), "k", "day").collect()} == set()
    changed = histories.changed_ranges(frame(before), frame(after), "k", "s", "e", "name")
    assert {tuple(r) for r in histories.stale_facts(facts, changed, "k", "day").collect()} == expected
