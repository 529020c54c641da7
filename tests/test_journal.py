"""Commits cut short at every step, and where keys lie."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from payroll_fixture import Source, money
from pyspark.sql import functions as F

from paygrain.plans import build
from paygrain.sinks import tables
from paygrain.sinks.journal import Journal
from paygrain.sinks.key_index import KeyIndex
from paygrain.sinks.tables import journaled_upsert, read_snapshot, upsert_partitions, write_snapshot_run
from paygrain.sources import bronze, files
from paygrain.sources.contracts import contract_for
from paygrain.sources.watermarks import WatermarkStore

MOVEMENT = "payroll.PayrollMovement"


@pytest.fixture
def cut_commits(monkeypatch):
    """Every commit swaps in its first partition and dies."""
    write = tables._write_partitions

    def cut_short(df, path, partition):
        values = sorted(r[0] for r in df.select(partition).distinct().collect())
        write(df.where(F.col(partition) == values[0]), path, partition)
        raise OSError("power cut")

    def during(action):
        with monkeypatch.context() as m:
            m.setattr(tables, "_write_partitions", cut_short)
            with pytest.raises(OSError, match="power cut"):
                action()

    return during


def test_two_outstanding_loads(spark, tmp_path, cut_commits):
    """L2 changes every partition, L3 one, the commit of both is cut after the one: L2 is not lost."""
    layout, source = build.Layout(str(tmp_path)), Source()
    store, contract = WatermarkStore(spark, layout.state), contract_for(MOVEMENT)

    def extract(load):
        bronze.run_extract(spark, source.reader(spark), layout.bronze, store, contracts=[contract], load_id=load)

    def stage():
        build.stage_movements(spark, layout, contract)

    extract("L1")
    stage()
    source.put(MOVEMENT, *[(*r[:4], money(777)) for r in source.rows[MOVEMENT]], at=datetime(2025, 1, 9))
    extract("L2")
    source.put(MOVEMENT, (6, 2, 101, 1, money(888)), at=datetime(2025, 1, 10))
    extract("L3")
    cut_commits(stage)
    cut_commits(stage)
    stage()
    staged = spark.read.parquet(layout.staging(build.MOVEMENTS))
    assert {r.movement_id: r.amount for r in staged.collect()} == {i: money(888 if i == 6 else 777) for i in range(1, 11)}
    assert staged.count() == 10
    before = files.children(spark, layout.journal("staging-payroll_movement"))
    stage()  # nothing is pending
    assert files.children(spark, layout.journal("staging-payroll_movement")) == before


def test_fact_batch_of_more_than_three_days(spark, tmp_path, cut_commits):
    """Changes of the 10th and the 20th in different months; the commit is cut after the first month."""
    layout, source = build.Layout(str(tmp_path)), Source()
    store = WatermarkStore(spark, layout.state)

    def staged(load):
        bronze.run_extract(spark, source.reader(spark), layout.bronze, store, load_id=load)
        return build.staged_relations(spark, layout)

    build.build_marts(spark, layout, staged("L1"))
    source.put(MOVEMENT, (1, 1, 201, 3, money(5)), at=datetime(2025, 1, 20))
    source.put(MOVEMENT, (10, 3, 205, 3, money(6)), at=datetime(2025, 1, 10))
    s = staged("L2")
    cut_commits(lambda: build.build_movement_fact(spark, layout, s))
    fact = lambda: {r.movement_id: r.amount for r in spark.read.parquet(layout.mart("fct_payroll_movement")).collect()}
    assert fact()[1] == money(5) and fact()[10] == money(900)
    build.build_movement_fact(spark, layout, s)
    assert fact()[1] == money(5) and fact()[10] == money(6) and len(fact()) == 10
    incremental = fact()
    build.build_movement_fact(spark, layout, s, full=True)
    assert fact() == incremental


def test_old_rows_of_a_backfill_reach_the_fact(spark, tmp_path):
    """A load with a change far older than the lookback: the journal names it, its age does not matter."""
    layout, source = build.Layout(str(tmp_path)), Source()
    store = WatermarkStore(spark, layout.state)
    bronze.run_extract(spark, source.reader(spark), layout.bronze, store, load_id="L1")
    build.build_marts(spark, layout, build.staged_relations(spark, layout))
    source.put(MOVEMENT, (99, 1, 203, 4, money(9)), at=datetime(2024, 1, 1))
    bronze.run_extract(spark, source.reader(spark), layout.bronze, store, mode="backfill", table=MOVEMENT, load_id="L2")
    build.build_movement_fact(spark, layout, build.staged_relations(spark, layout))
    assert spark.read.parquet(layout.mart("fct_payroll_movement")).where("movement_id = 99").count() == 1


def test_late_history_reaches_older_facts(spark, tmp_path, cut_commits):
    """A corrected pay of old renumbers the versions after it; movements long past the lookback get the new ones."""
    layout, source = build.Layout(str(tmp_path)), Source()
    store = WatermarkStore(spark, layout.state)

    def staged(load):
        bronze.run_extract(spark, source.reader(spark), layout.bronze, store, load_id=load)
        return build.staged_relations(spark, layout)

    fact = lambda: rows(spark.read.parquet(layout.mart("fct_payroll_movement")))
    source.put(MOVEMENT, (10, 3, 205, 3, money(900)), at=datetime(2025, 3, 1))
    build.build_marts(spark, layout, staged("L1"))
    first = fact()
    source.put(MOVEMENT, (2, 1, 202, 3, money(1100)), at=datetime(2025, 4, 1))
    s = staged("L2")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(build, "build_movement_fact", lambda *a: None)
        build.build_marts(spark, layout, s)  # the dimension is new, the fact is not yet
    cut_commits(lambda: build.build_movement_fact(spark, layout, s))
    build.build_movement_fact(spark, layout, s)
    repaired = fact()
    kept = [n for n in files.children(spark, f"{layout.root}/marts") if "_versions-" in n]
    build.build_movement_fact(spark, layout, s, full=True)
    assert repaired == fact() and len(kept) == 1
    old = {r[0]: r[1] for r in first}
    assert {r[0] for r in repaired if r[1] != old[r[0]]} == {2, 3, 4, 5}


def test_repeated_run_id_keeps_both_closed_versions(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "id int, updated timestamp_ntz"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    write_snapshot_run(spark.createDataFrame([(1, t1), (2, t1)], schema), path, "id", "updated", "r1")
    write_snapshot_run(spark.createDataFrame([(1, t2), (2, t1)], schema), path, "id", "updated", "r2")
    write_snapshot_run(spark.createDataFrame([(1, t2), (2, t2)], schema), path, "id", "updated", "r2")
    closed = read_snapshot(spark, path).where("dbt_valid_to < timestamp_ntz '9999-01-01'")
    assert rows(closed, "id", "updated") == [(1, t1), (2, t1)]
    assert read_snapshot(spark, path).count() == 4


def test_marks_survive_a_crash_after_every_step(spark, tmp_path, monkeypatch):
    steps = [f for f in ("write_text", "rename", "remove")]
    old, new = {"t": datetime(2025, 1, 1)}, {"t": datetime(2025, 2, 2)}
    for after in range(4):
        store = WatermarkStore(spark, str(tmp_path / str(after) / "marks.json"))
        store.save({"t": datetime(2024, 1, 1)})
        store.save(old)
        done = []

        def counting(real):
            def call(*args):
                if len(done) == after:
                    raise OSError("power cut")
                done.append(1)
                return real(*args)

            return call

        with monkeypatch.context() as m:
            for name in steps:
                m.setattr(files, name, counting(getattr(files, name)))
            try:
                store.save(new)
            except OSError:
                assert after < 3
        assert store.load() in ([old] if after < 2 else [new])
        store.save(new)
        assert store.load() == new and len(files.children(spark, str(tmp_path / str(after)))) <= 2


def test_marks_of_an_unnumbered_file_are_read(spark, tmp_path):
    path = str(tmp_path / "marks.json")
    files.write_text(spark, path, '{"t": "2025-01-01T00:00:00"}')
    store = WatermarkStore(spark, path)
    assert store.load() == {"t": datetime(2025, 1, 1)}
    store.advance("u", datetime(2025, 1, 2))
    assert set(store.load()) == {"t", "u"} and not files.exists(spark, path)


def test_journal(spark, tmp_path):
    journal = Journal(spark, str(tmp_path / "j"))
    assert journal.batches() == [] and journal.last_position() is None
    first = journal.begin({"loads": ["a"]}, [1])
    second = journal.begin({"loads": ["a", "b"]}, [1, 2])
    assert [b.seq for b in journal.open_batches()] == [first, second] and journal.covered("loads") == set()
    journal.finish(second, {"at": 7}, repeats=[first])
    assert journal.open_batches() == [] and journal.covered("loads") == {"a", "b"} and journal.last_position() == {"at": 7}
    with pytest.raises(FileExistsError):
        journal.finish(second, {"at": 8})


# --- key index --------------------------------------------------------------------------------


def test_homes_do_not_read_the_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts = spark.range(5000).selectExpr("id", "cast(id % 7 as int) part", "'old' v")
    index = KeyIndex(spark, path, "id", "part", width=100)
    upsert_partitions(facts, path, "id", "part", index=index)
    index.ensure()
    batch = spark.range(250, 260).selectExpr("id", "9 part", "'new' v")
    homes = index.homes(batch)
    assert sorted(r[0] for r in homes.distinct().collect()) == list(range(7))
    assert all("/fact._keys/" in f for f in homes.inputFiles())
    plan = homes._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan


@pytest.mark.parametrize("kind", ["long", "string"])
def test_batches_with_and_without_an_index(spark, tmp_path, kind):
    """Keys that move, appear, and come back; the same table as without an index."""
    frame = lambda ids, part, v: spark.createDataFrame([(i, p, v) for i, p in zip(ids, part)], "id long, part int, v string").withColumn("id", F.col("id").cast(kind))
    batches = [
        frame(range(300), [i % 5 for i in range(300)], "a"),
        frame(range(0, 300, 3), [6] * 100, "b"),
        frame([3, 6, 900], [0, 7, 7], "c"),
        frame(range(0, 60, 3), [1] * 20, "d"),
    ]
    plain, indexed = str(tmp_path / "plain"), str(tmp_path / "indexed")
    index = KeyIndex(spark, indexed, "id", "part", width=50)
    for batch in batches:
        upsert_partitions(batch, plain, "id", "part")
        upsert_partitions(batch, indexed, "id", "part", index=index)
        table = spark.read.parquet(indexed).select("id", "part", "v")
        assert rows(table) == rows(spark.read.parquet(plain).select("id", "part", "v"))
    assert rows(spark.read.parquet(index.path).select("id", "part")) == rows(spark.read.parquet(indexed).select("id", "part"))


def test_a_key_that_moved_in_a_cut_commit_is_not_doubled(spark, tmp_path, cut_commits):
    """Key 1 moves to partition 0 and the commit is cut there; the next batch moves it on to partition 5."""
    path, schema = str(tmp_path / "t"), "id long, part int, v int"
    journal, index = Journal(spark, f"{path}._journal"), KeyIndex(spark, path, "id", "part")

    def put(data):
        frame = spark.createDataFrame(data, schema)
        journaled_upsert(frame, path, "id", "part", journal, {}, {}, [F.col("v").desc()], index)

    put([(1, 3, 1), (2, 3, 1), (4, 8, 1)])
    put([(2, 3, 2)])
    cut_commits(lambda: put([(1, 0, 3), (4, 9, 3)]))
    put([(1, 5, 4), (4, 9, 3)])
    assert rows(spark.read.parquet(path).select("id", "part", "v")) == [(1, 5, 4), (2, 3, 2), (4, 9, 3)]
    put([(1, 3, 5)])
    assert rows(spark.read.parquet(path).select("id", "part", "v")) == [(1, 3, 5), (2, 3, 2), (4, 9, 3)]


def test_date_partitions_are_repeated_by_type(spark, tmp_path, cut_commits):
    path, schema = str(tmp_path / "t"), "id long, day date, v int"
    journal, d = Journal(spark, f"{path}._journal"), date(2025, 1, 1)

    def put(data):
        journaled_upsert(spark.createDataFrame(data, schema), path, "id", "day", journal, {}, {})

    put([(1, d, 1), (2, d + timedelta(1), 1)])
    cut_commits(lambda: put([(1, d + timedelta(2), 2), (2, d + timedelta(3), 2)]))
    put([(1, d + timedelta(2), 2), (2, d + timedelta(3), 2)])
    assert rows(spark.read.parquet(path).select("id", "day", "v")) == [(1, d + timedelta(2), 2), (2, d + timedelta(3), 2)]
