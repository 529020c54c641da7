"""Extraction, contracts, partition-wise writes and the stream of loads."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from payroll_fixture import T0, Source
from pyspark.sql import functions as F

from paygrain import session
from paygrain.functions.dates import moment
from paygrain.sinks.export import bi_safe, export_for_bi
from paygrain.sinks import tables
from paygrain.sinks.tables import backfill_snapshot, read_snapshot, upsert_partitions, write_snapshot_run
from paygrain.sources import bronze, files
from paygrain.sources.contracts import contract_for, contract_violations, enforce_contract
from paygrain.sources.watermarks import EPOCH, WatermarkStore
from paygrain.streaming.loads import read_loads, upsert_stream

MOVEMENT = contract_for("payroll.PayrollMovement")


@pytest.fixture
def place(spark, tmp_path):
    root = str(tmp_path / "bronze")
    return root, WatermarkStore(spark, f"{root}/_state/watermarks.json")


def extract(spark, source, place, load_id, **kwargs):
    root, store = place
    return bronze.run_extract(spark, source.reader(spark), root, store, contracts=[MOVEMENT], load_id=load_id, **kwargs)


def test_window_is_half_open_and_frozen(spark):
    at = lambda m: datetime(2025, 1, 1, 10, m)
    df = spark.createDataFrame([(m, at(m)) for m in (0, 1, 5, 6)], "id int, UpdatedAt timestamp_ntz")
    window = bronze.incremental_window(df, "UpdatedAt", at(0), at(5))
    assert rows(window, "id") == [(1,), (5,)]
    assert bronze.freeze_high(df.limit(0), "UpdatedAt") is None


def test_unchanged_source_publishes_nothing(spark, place):
    source = Source()
    assert extract(spark, source, place, "L1").first().n_rows == 10
    assert extract(spark, source, place, "L2").first().n_rows == 0
    assert files.children(spark, f"{place[0]}/{MOVEMENT.folder}") == ["load_id=L1"]
    assert place[1].load() == {MOVEMENT.source: T0}


def test_modes(spark, place):
    source = Source()
    extract(spark, source, place, "L1")
    assert extract(spark, source, place, "L2", mode="backfill", table=MOVEMENT.source).first().n_rows == 10
    assert extract(spark, source, place, "L3", mode="full").first().n_rows == 10
    with pytest.raises(KeyError):
        extract(spark, source, place, "L4", mode="backfill", table="payroll.Nothing")
    with pytest.raises(ValueError):
        extract(spark, source, place, "L4", mode="full", table=MOVEMENT.source)
    with pytest.raises(FileExistsError):
        extract(spark, source, place, "L3", mode="full")


def test_crash_before_publish_leaves_no_load(spark, place, monkeypatch):
    source = Source()

    def crash(*_):
        raise OSError("power cut")

    monkeypatch.setattr(files, "rename", crash)
    with pytest.raises(OSError):
        extract(spark, source, place, "L1")
    assert not files.exists(spark, f"{place[0]}/{MOVEMENT.folder}/load_id=L1")
    assert place[1].load() == {}
    monkeypatch.undo()
    assert extract(spark, source, place, "L1").first().n_rows == 10


def test_crash_after_publish_repeats_the_window(spark, place, monkeypatch):
    source = Source()

    def crash(*_):
        raise OSError("power cut")

    monkeypatch.setattr(WatermarkStore, "advance", crash)
    with pytest.raises(OSError):
        extract(spark, source, place, "L1")
    monkeypatch.undo()
    assert extract(spark, source, place, "L2").first().n_rows == 10
    loads = bronze.bronze_scan(spark, place[0], MOVEMENT.folder, MOVEMENT.bronze_schema)
    assert loads.count() == 20
    from paygrain.sources.staging import stage

    assert rows(stage(loads, MOVEMENT), "movement_id", "_load_id") == sorted(
        [(i, "L2") for i in range(1, 11)], key=str
    )


def test_contract_rejects_nulls_and_misfits(spark):
    schema = MOVEMENT.schema
    good = spark.createDataFrame(
        [(1, 1, 1, 1, 10.25, T0, T0, "ignored")],
        "MovementId long, EmploymentId int, PeriodId int, ConceptId int, Amount double, CreatedAt timestamp_ntz, UpdatedAt timestamp_ntz, Extra string",
    )
    out = enforce_contract(good, schema)
    assert out.columns == MOVEMENT.columns and out.first().Amount == Decimal("10.25")
    for column, value in {"EmploymentId": F.lit(None).cast("int"), "Amount": F.lit(10.255), "PeriodId": F.lit(2**40)}.items():
        broken = good.withColumn(column, value)
        with pytest.raises(Exception, match=f"{column}: (NULL|value)"):
            enforce_contract(broken, schema).collect()
        assert rows(contract_violations(broken, schema), "column_name", "violations") == [(column, 1)]
    with pytest.raises(Exception, match="Amount"):
        enforce_contract(good.drop("Amount"), schema)


def test_older_loads_lack_a_column(spark, place):
    contract = contract_for("payroll.Employment")
    full = Source().frame(spark, contract.source)
    bronze.publish_load(full.drop("ContractType").limit(1), place[0], contract.folder, "L1")
    bronze.publish_load(full.where("EmploymentId = 2"), place[0], contract.folder, "L2")
    seen = bronze.bronze_scan(spark, place[0], contract.folder, contract.bronze_schema)
    assert rows(seen, "load_id", "ContractType") == [("L1", None), ("L2", "temporary ")]


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)], "id int, v string, p int")
    upsert_partitions(first, path, "id", "p")
    untouched = files.children(spark, f"{path}/p=3")
    # 1 changes, 3 moves and leaves its partition empty, 5 is new.
    batch = spark.createDataFrame([(1, "A", 1), (3, "C", 1), (5, "e", 4)], "id int, v string, p int")
    for _ in range(2):
        upsert_partitions(batch, path, "id", "p")
        got = spark.read.parquet(path)
        assert rows(got, "id", "v", "p") == [(1, "A", 1), (2, "b", 1), (3, "C", 1), (4, "d", 3), (5, "e", 4)]
    assert files.children(spark, f"{path}/p=3") == untouched
    assert not files.exists(spark, f"{path}/p=2")


def test_export_narrows_decimals_and_refuses_overflow(spark, tmp_path):
    wide = spark.createDataFrame([(Decimal("12.34"),)], "x decimal(38,2)")
    assert bi_safe(wide).dtypes == [("x", "decimal(18,2)")]
    report = export_for_bi(spark, {"t": wide}, str(tmp_path)).first()
    assert (report.table_name, report.n_rows) == ("t", 1)
    big = spark.createDataFrame([(Decimal(10) ** 20,)], "x decimal(38,2)")
    with pytest.raises(Exception, match="x: value does not fit"):
        export_for_bi(spark, {"t": big}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/t.parquet").first().x == Decimal("12.34")


def test_stream_keeps_the_newest_version(spark, place, tmp_path):
    source, (root, _) = Source(), place
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")

    def consume():
        loads = read_loads(spark, root, MOVEMENT)
        order = lambda: [F.col("UpdatedAt").desc(), F.col("load_id").desc()]
        upsert_stream(loads, target, checkpoint, "MovementId", order, "PeriodId").awaitTermination()
        return spark.read.parquet(target)

    extract(spark, source, place, "L1")
    assert consume().count() == 10
    source.put(MOVEMENT.source, (8, 2, 102, 2, Decimal("99.00")), at=datetime(2025, 2, 1))
    extract(spark, source, place, "L2")
    # A load that arrives late holds an older version of movement 9.
    late = source.frame(spark, MOVEMENT.source).where("MovementId = 9").withColumn("Amount", F.lit(1).cast("decimal(18,2)"))
    bronze.publish_load(late.withColumn("UpdatedAt", moment(EPOCH)), root, MOVEMENT.folder, "L3")
    got = consume()
    assert got.count() == 10
    assert rows(got.where("MovementId in (8, 9)"), "MovementId", "Amount") == [(8, Decimal("99.00")), (9, Decimal("900.00"))]


def test_snapshot_survives_a_crash_between_its_writes(spark, tmp_path, monkeypatch):
    """Stopped after the closed versions, run again under a new id: the versions of an undisturbed run."""
    schema = "id int, updated timestamp_ntz"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    first = spark.createDataFrame([(1, t1), (2, t1)], schema)
    now = spark.createDataFrame([(1, t2), (2, t1), (3, t2)], schema)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for path in (good, bad):
        write_snapshot_run(first, path, "id", "updated", "r1")
    write_snapshot_run(now, good, "id", "updated", "r2")
    write, calls = tables._write_partitions, []

    def once(df, path, partition):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("power cut")
        write(df, path, partition)

    monkeypatch.setattr(tables, "_write_partitions", once)
    with pytest.raises(OSError):
        write_snapshot_run(now, bad, "id", "updated", "r2")
    monkeypatch.undo()
    write_snapshot_run(now, bad, "id", "updated", "r3")
    assert rows(read_snapshot(spark, bad)) == rows(read_snapshot(spark, good))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad", "good"]


def test_backfill_of_a_stored_snapshot(spark, tmp_path):
    schema = "id int, updated timestamp_ntz"
    t1, t2 = datetime(2025, 1, 1), datetime(2025, 1, 2)
    path = str(tmp_path / "snap")
    write_snapshot_run(spark.createDataFrame([(1, t1), (2, t1), (3, t1)], schema), path, "id", "updated", "r1")
    write_snapshot_run(spark.createDataFrame([(1, t2), (2, t1), (3, t1)], schema), path, "id", "updated", "r2")
    closed = files.children(spark, f"{path}/closed_in=r2")
    today = spark.createDataFrame([(1, "X"), (2, "Y"), (3, None)], "id int, c string")
    assert backfill_snapshot(spark, path, today, "id", "c") == 2
    assert files.children(spark, f"{path}/closed_in=r2") == closed
    found = read_snapshot(spark, path).select("id", "dbt_valid_to", "c").collect()
    assert sorted((r.id, r.c) for r in found if r.c) == [(1, "X"), (2, "Y")]
    assert all(r.dbt_valid_to.year == 9999 for r in found if r.c) and len(found) == 4
    assert backfill_snapshot(spark, path, today, "id", "c") == 0


def test_upsert_computes_its_batch_once(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_partitions(spark.range(10).selectExpr("id", "id % 3 AS p", "'old' AS v"), path, "id", "p")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    batch = spark.range(4).selectExpr("id", "id % 2 AS p", "'new' AS v").mapInArrow(count, "id long, p long, v string")
    upsert_partitions(batch, path, "id", "p")
    assert seen.value == 4
    assert rows(spark.read.parquet(path).where("v = 'new'"), "id") == [(0,), (1,), (2,), (3,)]
    assert spark.read.parquet(path).count() == 10


def test_too_many_partitions_are_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_partitions(spark.range(4).selectExpr("id", "id AS p"), path, "id", "p")
    monkeypatch.setattr(tables, "MAX_PARTITIONS", 3)
    with pytest.raises(ValueError, match="too many"):
        upsert_partitions(spark.range(9).selectExpr("id", "id AS p"), path, "id", "p")


def test_replace_clears_what_a_crash_left(spark, tmp_path):
    fresh, target = str(tmp_path / "fresh"), str(tmp_path / "table")
    for path, n in ((target, 1), (f"{fresh}.old", 2), (fresh, 3)):
        spark.range(n).write.parquet(path)
    files.replace(spark, fresh, target)
    assert spark.read.parquet(target).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table"]


def test_no_machine_local_folder_on_a_cluster(spark):
    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Fake:
        def __init__(self, master, store):
            configuration = type("H", (), {"get": staticmethod(lambda key, default: store)})
            jsc = type("J", (), {"hadoopConfiguration": staticmethod(lambda: configuration)})
            self.conf, self.sparkContext = Conf, type("C", (), {"master": master, "_jsc": jsc})

    assert session.shared_dir(Fake("spark://host", "hdfs://name:8020/")) == "hdfs://name:8020/tmp"
    assert session.shared_dir(Fake("local[4]", "file:///")) == session.shared_dir(Fake("local", "file:///"))
    for master in ("spark://host", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            session.shared_dir(Fake(master, "file:///"))
    assert spark.sparkContext.applicationId in session.scratch_path(spark, "x")


def test_jdbc_reads_are_split_per_table():
    source = bronze.JdbcSource(None, "jdbc:x", {MOVEMENT.source: 16}, options={"user": "u"})
    split = source.ranged(MOVEMENT, 1, 900)
    assert {k: split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "user", "fetchsize")} == {
        "partitionColumn": "MovementId", "lowerBound": "1", "upperBound": "900", "numPartitions": "16", "user": "u", "fetchsize": "10000",
    }
    assert "partitionColumn" not in source.ranged(contract_for("payroll.Country"), "a", "z")
    assert "partitionColumn" not in source.ranged(MOVEMENT, None, None)
    assert source.newest_query(MOVEMENT) == "(SELECT MAX(UpdatedAt) AS newest FROM payroll.PayrollMovement) newest"
    assert source.edges_query(MOVEMENT).startswith("(SELECT MIN(MovementId) AS low, MAX(MovementId) AS high FROM")


def test_the_source_is_asked_for_its_newest_change(spark, place):
    source = Source()

    class Asked:
        asked = 0

        def __call__(self, contract):
            return source.frame(spark, contract.source)

        def newest(self, contract):
            self.asked += 1
            return T0

    reader = Asked()
    assert bronze.run_extract(spark, reader, *place, contracts=[MOVEMENT], load_id="L1").first().n_rows == 10
    assert reader.asked == 1


def test_ranges_of_equal_counts_are_complete_and_disjoint(spark):
    """Keys with a wide gap and a NULL: each range has its share of rows, and every row falls into one."""
    source = bronze.JdbcSource(None, "jdbc:x", {MOVEMENT.source: 4})
    keys = [*range(1000), *range(10**9, 10**9 + 1000), None]
    spark.createDataFrame([(k,) for k in keys], "MovementId long").createOrReplaceTempView("gappy_keys")
    asked = source.firsts_query(MOVEMENT, 4).replace(MOVEMENT.source, "gappy_keys")
    firsts = spark.sql(f"SELECT * FROM {asked}").orderBy("part")
    where = source.predicates("MovementId", [r.first_key for r in firsts.collect()])
    found = [spark.table("gappy_keys").where(p).count() for p in where]
    assert found == [501, 500, 500, 500]  # the NULL is in the first
    spark.catalog.dropTempView("gappy_keys")


def test_predicates_of_keys():
    of = bronze.JdbcSource.predicates
    assert of("k", []) == of("k", [7]) == of("k", [7, 7]) == ["1 = 1"]
    assert of("k", [1, 5, 5, 9]) == ["k < 5 OR k IS NULL", "k >= 5 AND k < 9", "k >= 9"]
    assert of("k", ["a", "o'b"]) == ["k < 'o''b' OR k IS NULL", "k >= 'o''b'"]
    moment = datetime(2025, 1, 2, 3, 4, 5)
    assert of("k", [moment, moment.replace(year=2026)])[1] == "k >= '2026-01-02 03:04:05'"
