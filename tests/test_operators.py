"""Operators on small hand-made frames, against results worked out by hand or by brute force."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from paygrain.functions import dates, keys, text
from paygrain.operators import assign, calendar, intervals, measures, quality, rules, sequences, skew, snapshots, upserts
from paygrain.plans import reports

D = date.fromisoformat
OPEN = D("9999-12-31")


@pytest.fixture(scope="module")
def history(spark):
    """Random values per entity and day; entity 0 has a third of all rows."""
    rng = random.Random(4)
    data, day = [], D("2023-01-01")
    for i in range(600):
        entity = 0 if i % 3 == 0 else rng.randrange(1, 12)
        data.append((entity, day + timedelta(days=rng.randrange(400)), i, rng.choice("abc")))
    return data, spark.createDataFrame(data, "k int, day date, id int, v string").repartition(5).cache()


def by_entity(data):
    groups: dict[int, list] = {}
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups.values()


@pytest.mark.parametrize("chunked", [False, True])
def test_previous_and_next(history, chunked):
    data, df = history
    chunk = F.trunc("day", "month") if chunked else None
    back = sequences.with_previous(df, "k", ["day", "id"], {"p": "v", "pid": "id"}, chunk)
    ahead = sequences.with_next(df, "k", ["day", "id"], {"n": "v"}, chunk)
    want_back, want_ahead = [], []
    for group in by_entity(data):
        for before, row, after in zip([None, *group], group, [*group[1:], None], strict=False):
            want_back.append((*row, before and before[3], before and before[2]))
            want_ahead.append((*row, after and after[3]))
    key = lambda r: r[2]
    assert sorted((tuple(r) for r in back.collect()), key=key) == sorted(want_back, key=key)
    assert sorted((tuple(r) for r in ahead.collect()), key=key) == sorted(want_ahead, key=key)


@pytest.mark.parametrize("chunked", [False, True])
def test_islands_and_positions(history, chunked):
    data, df = history
    chunk = F.trunc("day", "month") if chunked else None
    numbered = sequences.islands(df, "k", ["day", "id"], "v", "island", chunk)
    placed = sequences.with_position(df, "k", ["day", "id"], "n", chunk)
    islands, places = {}, {}
    for group in by_entity(data):
        island, before = 0, None
        for n, row in enumerate(group, start=1):
            island += row[3] != before
            before = row[3]
            islands[row[2]], places[row[2]] = island, n
    assert {r.id: r.island for r in numbered.collect()} == islands
    assert {r.id: r.n for r in placed.collect()} == places


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [
            (1, datetime(2025, 1, 1, 10), "L1"),
            (1, datetime(2025, 1, 1, 11), "L1"),
            (1, datetime(2025, 1, 1, 11), "L2"),
            (2, datetime(2025, 1, 1, 12), "L1"),
            (2, datetime(2025, 1, 1, 9), "L3"),
        ],
        "pk int, updated timestamp_ntz, load_id string",
    )
    kept = sequences.latest_per_key(df, "pk", [F.col("updated").desc(), F.col("load_id").desc()])
    assert rows(kept, "pk", "load_id") == [(1, "L2"), (2, "L1")]


def test_overlap_join_by_month_equals_brute_force(spark):
    rng = random.Random(9)

    def ranges(n):
        out = []
        for i in range(n):
            start = D("2022-11-01") + timedelta(days=rng.randrange(300))
            end = None if rng.random() < 0.1 else start + timedelta(days=rng.randrange(-2, 120))
            out.append((0 if i % 3 == 0 else rng.randrange(1, 5), i, start, end))
        return out

    a, b = ranges(60), ranges(50)
    left = spark.createDataFrame(a, "k int, a int, s date, e date")
    right = spark.createDataFrame(b, "k int, b int, s2 date, e2 date")
    want = sorted(
        (x[1], y[1])
        for x in a
        for y in b
        if x[0] == y[0] and x[2] <= (y[3] or OPEN) and (x[3] or OPEN) >= y[2]
    )
    plain = intervals.interval_overlap_join(left, right, "k", ("s", "e"), ("s2", "e2"))
    assert sorted(map(tuple, plain.select("a", "b").collect())) == want
    # By month, an inverted range has no month and hence no partner.
    proper = [(x, y) for x, y in want if (a[x][3] or OPEN) >= a[x][2] and (b[y][3] or OPEN) >= b[y][2]]
    monthly = intervals.interval_overlap_join(
        left, right, "k", ("s", "e"), ("s2", "e2"), by_month=("2022-01-01", "2025-12-31")
    )
    got = sorted(map(tuple, monthly.where("(e is null or e >= s) and (e2 is null or e2 >= s2)").select("a", "b").collect()))
    assert got == proper


def test_hot_keys_are_split_and_nothing_changes(spark, history):
    data, df = history
    versions = spark.createDataFrame(
        [(k, f"{k}-{m}", date(2023, m, 1), date(2023, m + 1, 1) - timedelta(days=1)) for k in range(10) for m in range(1, 12)],
        "k int, name string, valid_from date, valid_to date",
    )
    hot = skew.hot_keys(df, "k", rows_per_task=60)
    assert {r.k: r._parts for r in hot.collect()}[0] == 4
    assert skew.split_rows(df, hot, "k").where("k = 0").select(skew.PART).distinct().count() == 4
    for how in ("inner", "left"):
        plain = intervals.point_in_time_join(df, versions, "k", F.col("f.day"), how=how)
        split = intervals.point_in_time_join(df, versions, "k", F.col("f.day"), how=how, hot=hot)
        assert split.columns == plain.columns and rows(split) == rows(plain)
        assert split.count() == (600 if how == "left" else plain.count())


def test_explode_days_skips_inverted_ranges(spark):
    df = spark.createDataFrame(
        [(1, D("2024-02-28"), D("2024-03-01")), (2, D("2024-02-02"), D("2024-02-01")), (3, D("2024-02-02"), None)],
        "id int, s date, e date",
    )
    days = intervals.explode_days(df, "s", "e", "day")
    assert rows(days, "id", "day") == [(1, D("2024-02-28")), (1, D("2024-02-29")), (1, D("2024-03-01"))]


def test_unknown_kinds_lose_to_ranked_ones(spark):
    df = spark.createDataFrame([(1, "OTHER", 1), (1, "B", 9), (1, "B", 8), (2, "OTHER", 4)], "k int, kind string, id int")
    won = intervals.resolve_by_priority(df, ["k"], "kind", ["A", "B"], ["id"])
    assert rows(won, "k", "kind", "id") == [(1, "B", 8), (2, "OTHER", 4)]


def test_completed_years_and_anniversary(spark):
    df = spark.createDataFrame(
        [
            (D("2020-06-30"), D("2023-01-01"), 2, 185),
            (D("2020-02-29"), D("2023-02-28"), 3, 0),
            (D("2022-05-10"), D("2022-05-10"), 0, 0),
            (D("2020-03-15"), D("2023-03-14"), 2, 364),
        ],
        "a date, b date, years int, days int",
    )
    got = df.select(dates.completed_years("a", "b"), dates.days_since_anniversary("a", "b"), "years", "days").collect()
    assert all((r[0], r[1]) == (r[2], r[3]) for r in got)


def test_surrogate_key_and_text(spark):
    df = spark.createDataFrame([(7, 2, "temporary "), (7, 3, "TEMPORARY"), (7, 4, None)], "k int, v int, c string")
    got = df.select(keys.surrogate_key("k", "v"), text.normalize_text("c"), text.is_dirty("c")).collect()
    assert got[0][0] == "6daefd26f15daae3638368cfbe10abd9"
    assert [(r[1], r[2]) for r in got] == [("TEMPORARY", True), ("TEMPORARY", False), (None, None)]


def test_draws_are_fixed_by_their_key(spark):
    df = spark.range(2000).select("id", keys.unit_draw("id").alias("u"), keys.portable_draw("id").alias("p"), keys.hash_percent("id").alias("h"))
    again = spark.range(2000).repartition(7).select("id", keys.unit_draw("id").alias("u"), keys.portable_draw("id").alias("p"), keys.hash_percent("id").alias("h"))
    assert rows(df) == rows(again)
    share = df.agg(F.avg("u"), F.avg("p"), F.avg((F.col("h") < 6).cast("double"))).first()
    assert abs(share[0] - 0.5) < 0.03 and abs(share[1] - 0.5) < 0.03 and abs(share[2] - 0.06) < 0.02


def test_delete_insert_and_lookback(spark):
    target = spark.createDataFrame(
        [(5, "old", datetime(2025, 1, 9)), (6, "kept", datetime(2025, 1, 10))], "id int, v string, ts timestamp_ntz"
    )
    source = spark.createDataFrame(
        [(5, "new", datetime(2025, 1, 9)), (9, "added", datetime(2025, 1, 7)), (6, "early", datetime(2025, 1, 6, 23))],
        "id int, v string, ts timestamp_ntz",
    )
    batch = upserts.lookback(source, target, "ts", 3)
    once = upserts.delete_insert(target, batch, "id")
    assert rows(once, "id", "v") == [(5, "new"), (6, "kept"), (9, "added")]
    assert rows(upserts.delete_insert(once, batch, "id")) == rows(once)
    assert upserts.lookback(source, target.limit(0), "ts").count() == 3


def test_snapshot_runs_and_backfill(spark):
    schema = "id int, updated timestamp_ntz"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    end = datetime(9999, 12, 31)
    s1 = snapshots.snapshot_timestamp(None, spark.createDataFrame([(1, t1)], schema), "id", "updated")
    now = spark.createDataFrame([(1, t2), (2, t2)], schema)
    s2 = snapshots.snapshot_timestamp(s1, now, "id", "updated")
    want = [(1, t1, t2), (1, t2, end), (2, t2, end)]
    assert sorted(map(tuple, s2.select("id", "dbt_valid_from", "dbt_valid_to").collect())) == want
    assert rows(snapshots.snapshot_timestamp(s2, now, "id", "updated")) == rows(s2)
    gone = snapshots.snapshot_timestamp(s2, now.where("id = 2"), "id", "updated")
    assert rows(gone) == rows(s2)

    grown = s2.withColumn("c", F.lit(None).cast("string"))
    today = spark.createDataFrame([(1, "X"), (2, None)], "id int, c string")
    filled = snapshots.snapshot_backfill(grown, today, "id", "c")
    assert sorted((r.id, r.dbt_valid_to, r.c) for r in filled.collect() if r.c) == [(1, end, "X")]
    assert rows(snapshots.snapshot_backfill(filled, today, "id", "c")) == rows(filled)


def test_insert_missing_compares_nulls(spark):
    target = spark.createDataFrame([("MX", "P004", 12), ("MX", "P001", None)], "c string, k string, m int")
    batch = spark.createDataFrame(
        [("MX", "P001", None), ("MX", "P004", 6), ("MX", "P004", 12)], "c string, k string, m int"
    )
    got = upserts.insert_missing(target, batch, ["c", "k"], null_safe=["m"])
    assert got.count() == 3 and got.where("m = 6").count() == 1


def test_period_calendar(spark):
    countries = spark.createDataFrame([("MX", "BIWEEKLY"), ("UY", "MONTHLY")], "country_code string, pay_frequency string")
    feb = F.lit("2024-02-01").cast("date")
    got = rows(calendar.pay_periods(countries, feb, feb), "country_code", "start_date", "end_date", "pay_date")
    assert got == [
        ("MX", D("2024-02-01"), D("2024-02-15"), D("2024-02-15")),
        ("MX", D("2024-02-16"), D("2024-02-29"), D("2024-02-29")),
        ("UY", D("2024-02-01"), D("2024-02-29"), D("2024-02-29")),
    ]
    five = spark.createDataFrame(
        [("MX", "BIWEEKLY"), ("CO", "BIWEEKLY"), ("PY", "MONTHLY"), ("AR", "MONTHLY"), ("UY", "MONTHLY")],
        "country_code string, pay_frequency string",
    )
    assert calendar.pay_periods(five, F.lit("2023-01-01").cast("date"), F.lit("2025-12-01").cast("date")).count() == 252


def test_column_calendar_ignores_open_ends(spark):
    df = spark.createDataFrame([(D("2023-05-01"),), (OPEN,), (None,)], "d date")
    assert calendar.column_calendar(df, "d").count() == 365
    assert calendar.column_calendar(df.where("d is null"), "d").count() == 0


def test_settlement_calculation(spark):
    def lines(hire, end, reason):
        df = spark.createDataFrame(
            [(1, "UY", Decimal("1000.00"), D(hire), D(end), reason)],
            "employment_id int, country_code string, monthly_salary decimal(18,2), hire_date date, termination_date date, termination_reason string",
        )
        head = rules.settlement_headers(df, F.lit("2025-12-31").cast("date"))
        rate = spark.createDataFrame([("UY", Decimal("0.0900"))], "country_code string, rate decimal(5,4)")
        return {r.concept_code: str(r.amount) for r in rules.settlement_lines(head, rate).collect()}

    assert lines("2020-06-30", "2023-01-01", "DISMISSAL") == {"F002": "253.42", "F001": "2000.00", "D002": "22.81"}
    assert lines("2022-06-30", "2023-01-01", "DISMISSAL")["F001"] == "1000.00"
    assert lines("2002-06-30", "2023-01-01", "DISMISSAL")["F001"] == "12000.00"
    assert set(lines("2020-06-30", "2023-01-01", "RESIGNATION")) == {"F002", "D002"}


def test_missing_catalog_stops(spark):
    countries = spark.createDataFrame([("MX",), ("UY",)], "country_code string")
    concepts = spark.createDataFrame([("MX", "F001"), ("UY", "F001"), ("MX", "F002")], "country_code string, concept_code string")
    with pytest.raises(ValueError, match="UY lacks settlement concept F002"):
        rules.require_catalog(countries, concepts, ["F001", "F002"])


def test_weighted_bucket_covers_every_slot(spark):
    weights = spark.createDataFrame([("a", 30), ("b", 0), ("c", 70)], "choice string, weight int")
    draws = spark.range(100).select("id", F.col("id").alias("draw"))
    got = assign.weighted_bucket(draws, "draw", weights, "choice", "weight", 100)
    assert {r.choice: r["count"] for r in got.groupBy("choice").count().collect()} == {"a": 30, "c": 70}


def test_currency_guard(spark):
    fact = spark.createDataFrame(
        [("MX", "P1", Decimal(100)), ("CO", "P2", Decimal(50))], "country_code string, concept_code string, signed_amount decimal(18,2)"
    )
    countries = spark.createDataFrame([("MX",), ("CO",)], "country_code string")

    def net(by, visible, rows_in):
        return rows(measures.measure(rows_in, by, net=measures.net(measures.one_country(visible, by))))

    assert net(["country_code"], countries, fact) == [("CO", Decimal("50.00")), ("MX", Decimal("100.00"))]
    assert net([], countries, fact) == [(None,)]
    assert net(["concept_code"], countries, fact) == [("P1", None), ("P2", None)]
    only = countries.where("country_code = 'MX'")
    sliced = measures.slice_by(fact, countries, "country_code", "country_code", F.col("country_code") == "MX")
    assert net([], only, sliced) == [(Decimal("100.00"),)]


def test_gate_raises_on_errors_only(spark):
    bad, good = spark.range(3), spark.range(0)
    report = quality.quality_report([quality.Check("a", good), quality.Check("b", bad, "warn")])
    assert {r.check_name: r.outcome for r in quality.enforce(report)} == {"a": "pass", "b": "warn"}
    with pytest.raises(quality.QualityError, match=r"b \(3\)"):
        quality.enforce(quality.quality_report([quality.Check("b", bad)]))


def test_fractional_weights_add_no_rows(spark):
    """A choice narrower than a slot takes none from its neighbours; doubles and shares work alike."""
    for kind in ("decimal(9,4)", "double"):
        weights = spark.createDataFrame([("a", "30.5"), ("b", "0.3"), ("c", "69.2")], "choice string, weight string").select(
            "choice", F.col("weight").cast(kind).alias("weight")
        )
        draws = spark.range(100).select("id", F.col("id").alias("draw"))
        got = assign.weighted_bucket(draws, "draw", weights, "choice", "weight", 100).collect()
        assert len(got) == 100
        assert {r.draw for r in got if r.choice == "a"} == set(range(31)) and not [r for r in got if r.choice == "b"]


def test_negative_weights_raise(spark):
    weights = spark.createDataFrame([("a", 30), ("b", -5)], "choice string, weight int")
    draws = spark.range(10).select("id", F.col("id").alias("draw"))
    with pytest.raises(Exception, match="negative"):
        assign.weighted_bucket(draws, "draw", weights, "choice", "weight", 100).collect()


def test_split_join_refuses_other_kinds(spark, history):
    _, df = history
    with pytest.raises(ValueError, match="inner and left"):
        intervals.point_in_time_join(df, df, "k", F.col("f.day"), how="full_outer")


def test_date_dimension_follows_the_dates(spark):
    late = spark.createDataFrame([(D("2031-03-04"),), (D("2012-07-01"),), (OPEN,), (None,)], "d date")
    days = calendar.dim_date_for(spark, [(late, "d"), (late.where("false"), "d")])
    edges = days.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(edges) == (D("2012-01-01"), D("2031-12-31"), (D("2031-12-31") - D("2012-01-01")).days + 1)
    usual = calendar.dim_date_for(spark, [(late.where("false"), "d")])
    assert rows(usual) == rows(calendar.dim_date(spark))


def test_reports_keep_what_is_not_listed(spark):
    """A country, an absence type and a pay date outside today's lists."""
    dates_ = calendar.dim_date(spark)
    paid = spark.createDataFrame(
        [("MX", 20240105, Decimal(5)), ("ZZ", 20240105, Decimal(7)), ("ZZ", 20990101, Decimal(1))],
        "country_code string, pay_date_key int, signed_amount decimal(18,2)",
    )
    countries = spark.createDataFrame([("MX",), ("ZZ",)], "country_code string")
    matrix = reports.net_matrix(paid, dates_, countries, ["MX"]).where("year is null and full_date is null").collect()
    assert sorted((r.MX, r.other) for r in matrix if r.MX) == [(Decimal("5.00"), Decimal("8.00"))]
    long = reports.net_long(paid, dates_).where("totals = 2")
    assert rows(long, "country_code", "net") == [("MX", Decimal("5.00")), ("ZZ", Decimal("8.00"))]
    away = spark.createDataFrame([("NEW", 20240105, "s"), ("VACATION", 20240105, "s")], "absence_type string, date_key int, employee_sk string")
    people = spark.createDataFrame([("s", "d")], "employee_sk string, department_name string")
    total = reports.absence_matrix(away, dates_, people, ["VACATION"]).where("is_total = 1").first()
    assert (total.vacation, total.other, total.total) == (1, 1, 2)


def test_row_checks_of_a_table_share_one_scan(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, v string")
    checks = [
        quality.RowCheck("id", df, F.col("id").isNull()),
        quality.RowCheck("v", df, ~F.col("v").isin("a"), "warn"),
        quality.Check("twice", quality.duplicate_keys(df, ["id"])),
    ]
    report = quality.quality_report(checks)
    assert rows(report) == [("id", "error", 1), ("twice", "error", 0), ("v", "warn", 1)]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
