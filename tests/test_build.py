"""The whole run on the hand-made payroll."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from payroll_fixture import D, Source, money
from pyspark.sql import functions as F

from paygrain.operators.quality import QualityError, quality_report
from paygrain.plans import build, checks
from paygrain.sinks.export import export_for_bi
from paygrain.sinks import tables
from paygrain.sinks.tables import read_snapshot
from paygrain.sources import bronze
from paygrain.sources.contracts import CONTRACTS, contract_for
from paygrain.sources.staging import register_views, stage_all
from paygrain.sources.watermarks import WatermarkStore

OPEN = date(9999, 12, 31)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """A source, its warehouse after the first run, and the report of its checks."""
    layout, source = build.Layout(str(tmp_path_factory.mktemp("wh"))), Source()
    store = WatermarkStore(spark, layout.state)
    bronze.run_extract(spark, source.reader(spark), layout.bronze, store, load_id="20250101T100000Z")
    report = build.transform(spark, layout, "20250101T100000Z")
    return layout, source, store, report


def mart(spark, layout, name):
    return spark.read.parquet(layout.mart(name))


def test_salary_versions(spark, warehouse):
    dim = mart(spark, warehouse[0], "dim_employee").where("employment_id = 1")
    columns = ["version", "monthly_salary", "valid_from", "valid_to", "is_current", "history_truncated"]
    assert rows(dim, *columns) == [
        (1, money(1000), D("2023-01-01"), D("2023-02-28"), False, True),
        (2, money(1200), D("2023-03-01"), D("2023-03-31"), False, True),
        (3, money(1000), D("2023-04-01"), OPEN, True, True),
    ]


def test_biweekly_version_starts_at_hire(spark, warehouse):
    dim = mart(spark, warehouse[0], "dim_employee").where("employment_id = 2")
    assert rows(dim, "version", "monthly_salary", "valid_from", "valid_to", "history_truncated", "contract_type", "full_name") == [
        (1, money(1000), D("2023-01-20"), OPEN, False, "TEMPORARY", "Luz Paz")
    ]


def test_unknown_contract_type(spark, warehouse):
    dim = mart(spark, warehouse[0], "dim_employee").where("employment_id = 3")
    assert {r.contract_type for r in dim.collect()} == {"UNKNOWN"}


def test_movement_fact(spark, warehouse):
    fact, dim = mart(spark, warehouse[0], "fct_payroll_movement"), mart(spark, warehouse[0], "dim_employee")
    got = fact.join(dim.select("employee_sk", "version"), "employee_sk")
    assert rows(got.where("employment_id in (1, 2)"), "movement_id", "version", "signed_amount", "pay_date_key") == sorted(
        [
            (1, 1, money(1000), 20230131),
            (2, 1, money(1000), 20230228),
            (3, 2, money(1200), 20230331),
            (4, 3, money(1000), 20230430),
            (5, 2, money(-60), 20230331),
            (6, 1, money(500), 20230131),
            (7, 1, money(500), 20230215),
            (8, 1, money(-20), 20230215),
        ],
        key=str,
    )


def test_settlement_pivot(spark, warehouse):
    fact = mart(spark, warehouse[0], "fct_settlement")
    assert rows(fact, "settlement_id", "vacation_amount", "indemnity_amount", "deductions_amount", "net_amount") == [
        (7, money(100), money(3000), money(9), money(3091))
    ]
    assert rows(fact, "termination_date_key", "settlement_date_key") == [(20240304, 20240310)]


def test_absence_days(spark, warehouse):
    fact = mart(spark, warehouse[0], "fct_absence_day")
    assert rows(fact, "absence_date", "absence_id") == [
        (D("2024-02-28"), 1),
        (D("2024-02-29"), 1),
        (D("2024-03-01"), 2),
        (D("2024-03-02"), 2),
        (D("2024-03-03"), 2),
        (D("2024-03-04"), 4),
    ]


def test_dim_date(spark, warehouse):
    dim = mart(spark, warehouse[0], "dim_date")
    assert dim.count() == 4383
    assert rows(dim.where("date_key = 20240107"), "month_name", "day_of_week", "is_weekend") == [("January", 0, True)]


def test_all_checks_reported(warehouse):
    report = {r.check_name: r for r in warehouse[3]}
    assert len(report) == 60
    assert {n for n, r in report.items() if r.outcome == "fail"} == set()
    assert report["absence_outside_employment"].violations == 1
    assert report["stg_employment_contract_type_not_null"].outcome == "warn"


def test_source_checks(spark, warehouse):
    """The hand-made payroll by the rules of the source data, worked out by hand."""
    layout, _, _, _ = warehouse
    staged = {c.folder: spark.read.parquet(layout.staging(c.folder)) for c in CONTRACTS}
    profile = spark.createDataFrame(
        [("MX", 0.33, 900, 1200), ("UY", 0.67, 950, 1200)], "country_code string, employee_share double, salary_min int, salary_max int"
    )
    rules = spark.createDataFrame([("UY", "P001", 1), ("UY", "P001", 2)], "country_code string, concept_code string, pay_month int")
    found = checks.source_checks(staged, profile, rules, F.lit("2024-12-31").cast("date"), movements=(5, 20))
    got = {r.check_name.removeprefix("source_"): r.violations for r in quality_report(found).collect()}
    assert len(got) == 16 and {r.severity for r in quality_report(found).collect()} == {"warn"}
    # Employment 3 earns 900 of at least 950; one of three birth dates is unknown; March and April are no pay
    # months; employment 3 was terminated on another day than its row changed.
    assert {n: v for n, v in got.items() if v} == {
        "salary_in_range": 1, "birth_date_null_share": 1, "pay_month": 2, "audit_coherence": 1, "base_pay_once": 4,
    }


def test_later_runs(spark, warehouse):
    """A correction, a late arrival and a new column value; then nothing new."""
    layout, source, store, _ = warehouse
    source.put("payroll.PayrollMovement", (8, 2, 102, 2, money(25)), (11, 1, 204, 4, money(70)), at=datetime(2025, 1, 2))
    source.put("payroll.Employment", (*source.rows["payroll.Employment"][2][:8], "INDEFINITE"), at=datetime(2025, 1, 3))
    report = bronze.run_extract(spark, source.reader(spark), layout.bronze, store, load_id="20250103T100000Z")
    assert {r.table_name: r.n_rows for r in report.collect() if r.n_rows} == {
        "payroll.PayrollMovement": 2,
        "payroll.Employment": 1,
    }
    build.transform(spark, layout, "20250103T100000Z")
    fact = mart(spark, layout, "fct_payroll_movement")
    assert fact.count() == 11
    assert rows(fact.where("movement_id in (8, 11)"), "movement_id", "amount") == [(11, money(70)), (8, money(25))]

    versions = read_snapshot(spark, layout.snapshot).where("employment_id = 3").orderBy("dbt_valid_from").collect()
    assert [(v.contract_type, v.dbt_valid_to) for v in versions] == [
        (None, datetime(2025, 1, 3)),
        ("INDEFINITE", datetime(9999, 12, 31)),
    ]

    tables = ["dim_employee", "fct_payroll_movement", "fct_settlement", "fct_absence_day"]
    before = {n: rows(mart(spark, layout, n)) for n in tables}
    snapshot_before = rows(read_snapshot(spark, layout.snapshot))
    empty = bronze.run_extract(spark, source.reader(spark), layout.bronze, store, load_id="20250104T100000Z")
    assert empty.agg(F.sum("n_rows")).first()[0] == 0
    build.transform(spark, layout, "20250104T100000Z")
    assert {n: rows(mart(spark, layout, n)) for n in tables} == before
    assert rows(read_snapshot(spark, layout.snapshot)) == snapshot_before


def test_staging_survives_a_crash_after_one_partition(spark, tmp_path, monkeypatch):
    """A commit that swapped in one of two partitions: the next run, with a new load or none, completes it."""
    layout, source = build.Layout(str(tmp_path)), Source()
    store, contract = WatermarkStore(spark, layout.state), contract_for("payroll.PayrollMovement")
    extract = lambda load: bronze.run_extract(spark, source.reader(spark), layout.bronze, store, contracts=[contract], load_id=load)
    extract("L1")
    build.stage_movements(spark, layout, contract)
    changed = [(*r[:4], money(777)) for r in source.rows[contract.source]]
    source.put(contract.source, *changed, at=datetime(2025, 1, 9))
    extract("L2")
    write = tables._write_partitions

    def cut_short(df, path, partition):
        values = sorted(r[0] for r in df.select(partition).distinct().collect())
        write(df.where(F.col(partition) == values[0]), path, partition)
        raise OSError("power cut")

    monkeypatch.setattr(tables, "_write_partitions", cut_short)
    with pytest.raises(OSError):
        build.stage_movements(spark, layout, contract)
    monkeypatch.undo()
    build.stage_movements(spark, layout, contract)
    staged = spark.read.parquet(layout.staging(build.MOVEMENTS))
    assert rows(staged, "amount") == [(money(777),)] * 10


def test_staging_views(spark, warehouse):
    register_views(stage_all(spark, warehouse[0].bronze))
    assert spark.sql("select count(*), count(distinct _load_id) from stg_payroll_movement").first()[0] == 11


def test_failed_check_keeps_last_export(spark, warehouse):
    layout, source, _, _ = warehouse
    exported = export_for_bi(spark, build.read_marts(spark, layout), layout.serving)
    assert {r.table_name: r.n_rows for r in exported.collect()}["fct_payroll_movement"] == 11
    source.put("payroll.PayrollMovement", (12, 1, 204, 999, money(1)), at=datetime(2025, 1, 5))
    with pytest.raises(QualityError, match="stg_payroll_movement_concept_id_exists"):
        build.run(spark, source.reader(spark), layout.root)
    assert spark.read.parquet(f"{layout.serving}/fct_payroll_movement.parquet").count() == 11
