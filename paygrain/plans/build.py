"""One run from the source to the BI export.

extract -> staging -> marts and snapshot -> checks -> export. A failing check with
severity ``error`` stops the run before the export, so BI keeps the last good one. Every
step can be repeated: it then leaves the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import moment
from ..operators import calendar, histories
from ..operators import quality as q
from ..operators.skew import hot_keys
from ..sinks.export import EXPORTED, export_for_bi
from ..sinks.journal import Journal
from ..sinks.key_index import KeyIndex
from ..sinks.tables import full_refresh, journaled_upsert, read_snapshot, write_snapshot_run
from ..sources import bronze, files
from ..sources.contracts import CONTRACTS, Contract
from ..sources.staging import stage, stage_all
from ..sources.watermarks import WatermarkStore
from . import checks, marts

# Accepted codes.
CONTRACT_TYPES = ["INDEFINITE", "TEMPORARY"]
CONCEPT_TYPES = ["EARNING", "DEDUCTION"]
ABSENCE_TYPES = ["VACATION", "SICK_LEAVE", "UNJUSTIFIED"]
ABSENCE_STATUSES = ["APPROVED", "CANCELLED"]

# The movements are by far the largest relation; their staging table is kept up to date
# load by load, partitioned by pay period. The others are small enough to rebuild.
MOVEMENTS = "payroll_movement"
# Fixed value: days before the newest change that an incremental batch takes again.
LOOKBACK_DAYS = 3


ExtraChecks = Callable[[Mapping[str, DataFrame]], Sequence[q.Check | q.RowCheck]]


@dataclass(frozen=True)
class Layout:
    """Where a warehouse keeps its layers."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def state(self) -> str:
        return f"{self.root}/_state/watermarks.json"

    @property
    def snapshot(self) -> str:
        return f"{self.root}/snapshots/employment"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving"

    def journal(self, name: str) -> str:
        return f"{self.root}/_state/journal/{name}"

    def staging(self, name: str) -> str:
        return f"{self.root}/staging/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"


def stage_movements(spark: SparkSession, layout: Layout, contract: Contract) -> None:
    """Bring the staged movements up to date from the loads that the journal does not list as staged.

    A load counts as staged once its whole batch is; what a run that died has left half done is taken again, however
    many loads it held and whatever rows of them lie in the table. The newest version of a key wins.
    """
    path, journal = layout.staging(MOVEMENTS), Journal(spark, layout.journal(f"staging-{MOVEMENTS}"))
    folders = files.children(spark, f"{layout.bronze}/{MOVEMENTS}")
    published = {f.removeprefix("load_id=") for f in folders if f.startswith("load_id=")}
    pending = sorted(published - journal.covered("loads") if files.exists(spark, path) else published)
    if not pending:
        return
    rows = bronze.bronze_scan(spark, layout.bronze, MOVEMENTS, contract.bronze_schema).where(F.col("load_id").isin(pending))
    newest = [F.col("updated_at").desc(), F.col("_load_id").desc()]
    index = KeyIndex(spark, path, "movement_id", "period_id")
    journaled_upsert(stage(rows, contract), path, "movement_id", "period_id", journal, {"loads": pending}, {}, newest, index)


def staged_relations(spark: SparkSession, layout: Layout) -> Mapping[str, DataFrame]:
    """Staging written once, so that marts and checks do not each repeat the deduplication."""
    for contract, df in zip(CONTRACTS, stage_all(spark, layout.bronze).values(), strict=True):
        if contract.folder == MOVEMENTS:
            stage_movements(spark, layout, contract)
        else:
            full_refresh(df, layout.staging(contract.folder))
    return {c.folder: spark.read.parquet(layout.staging(c.folder)) for c in CONTRACTS}


def _keep_versions(spark: SparkSession, layout: Layout, employee_dim: DataFrame) -> str:
    """Write the version history that a batch of the fact is tied to; its done record names the folder."""
    name = f"fct_payroll_movement._versions-{uuid.uuid4().hex[:12]}"
    held = F.struct("employee_sk", "hire_date").alias("held")
    employee_dim.select("employment_id", "hire_date", "valid_from", "valid_to", held).write.parquet(layout.mart(name))
    return name


def _drop_older_versions(spark: SparkSession, layout: Layout, kept: str) -> None:
    for name in files.children(spark, f"{layout.root}/marts"):
        if name.startswith("fct_payroll_movement._versions-") and name != kept:
            files.remove(spark, layout.mart(name))


def stale_movements(movements: DataFrame, period: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame | None:
    """Movements that fall into another employee version than under the history ``before``; None if there is none to look for.

    Movements are looked up in the periods from the first changed day on. Only where a changed range holds the day
    of hire, to which earlier pay is moved, all periods are.
    """
    changed = histories.changed_ranges(before, after, "employment_id", "valid_from", "valid_to", "held")
    hired = after.select("employment_id", "hire_date").distinct()
    changed = changed.join(hired, "employment_id").select("employment_id", "hire_date", "lo", "hi")
    first, early = changed.agg(F.min("lo"), F.max(F.col("hire_date").between(F.col("lo"), F.col("hi")))).first()
    if first is None:
        return None
    periods = period.select("period_id", "start_date")
    if not early:
        periods = periods.where(F.col("start_date") >= F.lit(first))
        movements = movements.where(F.col("period_id").isin([r[0] for r in periods.select("period_id").collect()]))
    dated = movements.join(periods, "period_id").alias("m")
    at = F.greatest(F.col("m.start_date"), F.col("c.hire_date"))
    same = F.col("m.employment_id") == F.col("c.employment_id")
    return dated.join(changed.alias("c"), same & at.between(F.col("c.lo"), F.col("c.hi")), "left_semi").select(*movements.columns)


def build_movement_fact(spark: SparkSession, layout: Layout, s: Mapping[str, DataFrame], full: bool = False) -> None:
    """The movement fact, incrementally: movements staged since the last completed batch, and recent changes.

    Which staged batches the fact has, and how far back "recent" goes (three days before the newest change it had
    then), says the fact's journal, not its rows: a batch that was cut short is taken again whole. An absent or empty
    table, or one without a completed batch, is built in full. Versions are renumbered when history changes: the
    history of the last completed batch is kept, and movements in ranges that differ from it are taken again too.
    """
    path, journal = layout.mart("fct_payroll_movement"), Journal(spark, layout.journal("fct_payroll_movement"))
    concept_dim, employee_dim = (spark.read.parquet(layout.mart(n)) for n in ("dim_concept", "dim_employee"))
    movements, index = s[MOVEMENTS], KeyIndex(spark, path, "movement_id", "pay_month")
    staged = [b for b in Journal(spark, layout.journal(f"staging-{MOVEMENTS}")).batches() if b.position is not None]
    newest = movements.agg(F.max("updated_at")).first()[0]
    position = {"staged": staged[-1].seq if staged else 0, "newest": newest and newest.isoformat()}
    last = journal.last_position() if not full and files.exists(spark, path) else None
    position["versions"] = _keep_versions(spark, layout, employee_dim)
    after = spark.read.parquet(layout.mart(position["versions"]))
    if last and last["newest"] and "versions" not in last:
        last = None  # from before histories were kept: nothing says which rows are stale
    if last and last["newest"]:
        recent = F.col("updated_at") >= moment(datetime.fromisoformat(last["newest"]) - timedelta(days=LOOKBACK_DAYS))
        since = [b for b in staged if b.seq > last["staged"]]
        # A staged batch names the periods it rewrote; one that built the table names none and stands for all.
        if any(not b.touched for b in since):
            recent = F.lit(True)
        elif since:
            loads, periods = {x for b in since for x in b.scope["loads"]}, {x for b in since for x in b.touched}
            recent = recent | (F.col("_load_id").isin(sorted(loads)) & F.col("period_id").isin(sorted(periods)))
        old = movements.where(~F.coalesce(recent, F.lit(False)))
        stale = stale_movements(old, s["payroll_period"], spark.read.parquet(layout.mart(last["versions"])), after)
        movements = movements.where(recent) if stale is None else movements.where(recent).unionByName(stale)
    hot = hot_keys(movements, "employment_id")
    fact = marts.fct_payroll_movement(movements, s["payroll_period"], concept_dim, employee_dim, hot).withColumn(
        "pay_month", F.expr("pay_date_key div 100").cast("int")
    )
    if last and last["newest"]:
        journaled_upsert(fact, path, "movement_id", "pay_month", journal, {"staged": position["staged"]}, position, index=index)
        _drop_older_versions(spark, layout, position["versions"])
        return
    unfinished = [b.seq for b in journal.open_batches()]
    seq = journal.begin({"full": True}, [])
    index.forget()
    full_refresh(fact, path, partition_by=["pay_month"])
    journal.finish(seq, position, unfinished)
    _drop_older_versions(spark, layout, position["versions"])


def build_marts(spark: SparkSession, layout: Layout, s: Mapping[str, DataFrame], full: bool = False) -> None:
    """Dimensions first, then the facts that need them."""
    dates = [
        (s["payroll_period"], "pay_date"),
        (s["employment"], "termination_date"),
        (s["settlement"], "settlement_date"),
        (s["absence"], "start_date"),
        (s["absence"], "end_date"),
    ]
    full_refresh(calendar.dim_date_for(spark, dates), layout.mart("dim_date"))
    full_refresh(marts.dim_country(s["country"]), layout.mart("dim_country"))
    full_refresh(marts.dim_concept(s["payroll_concept"]), layout.mart("dim_concept"))
    full_refresh(
        marts.dim_employee(
            s[MOVEMENTS],
            s["payroll_concept"],
            s["payroll_period"],
            s["country"],
            s["employment"],
            s["employee"],
            s["department"],
        ),
        layout.mart("dim_employee"),
    )
    employee_dim = spark.read.parquet(layout.mart("dim_employee"))
    build_movement_fact(spark, layout, s, full)
    full_refresh(
        marts.fct_settlement(
            s["settlement"],
            s["settlement_line"],
            s["payroll_concept"],
            s["employment"],
            s["department"],
            employee_dim,
        ),
        layout.mart("fct_settlement"),
    )
    days = marts.int_absence_days(s["absence"], s["employment"])
    full_refresh(marts.fct_absence_day(days, employee_dim), layout.mart("fct_absence_day"))


def read_marts(spark: SparkSession, layout: Layout) -> Mapping[str, DataFrame]:
    loaded = {name: spark.read.parquet(layout.mart(name)) for name in EXPORTED}
    loaded["fct_payroll_movement"] = loaded["fct_payroll_movement"].drop("pay_month")
    return loaded


def declared_checks(s: Mapping[str, DataFrame], m: Mapping[str, DataFrame], snapshot: DataFrame) -> Sequence[q.Check | q.RowCheck]:
    """Every check of staging, marts and snapshot. Those of single rows make one aggregate per table."""
    found: list[q.Check | q.RowCheck] = []

    def key(layer: str, df: DataFrame, column: str, where=None) -> None:
        found.append(q.Check(f"{layer}_{column}_unique", q.duplicate_keys(df, [column], where)))

    def present(layer: str, df: DataFrame, column: str, severity: str = "error") -> None:
        found.append(q.RowCheck(f"{layer}_{column}_not_null", df, F.col(column).isNull(), severity))

    def coded(layer: str, df: DataFrame, column: str, values: list[str], severity: str = "error") -> None:
        found.append(q.RowCheck(f"{layer}_{column}_accepted", df, ~F.col(column).isin(*values), severity))

    def refers(layer: str, df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> None:
        found.append(q.Check(f"{layer}_{column}_exists", q.fk_violations(df, column, parent, parent_key)))

    keys = {
        "country": "country_code",
        "department": "department_id",
        "employee": "employee_id",
        "employment": "employment_id",
        "payroll_concept": "concept_id",
        "payroll_period": "period_id",
        "payroll_movement": "movement_id",
        "settlement": "settlement_id",
        "settlement_line": "settlement_line_id",
        "absence": "absence_id",
    }
    for name, column in keys.items():
        key(f"stg_{name}", s[name], column)
        present(f"stg_{name}", s[name], column)
    coded("stg_employment", s["employment"], "contract_type", CONTRACT_TYPES, "warn")
    present("stg_employment", s["employment"], "contract_type", "warn")
    coded("stg_payroll_concept", s["payroll_concept"], "concept_type", CONCEPT_TYPES)
    refers("stg_payroll_movement", s[MOVEMENTS], "concept_id", s["payroll_concept"], "concept_id")
    refers("stg_payroll_movement", s[MOVEMENTS], "employment_id", s["employment"], "employment_id")
    refers("stg_absence", s["absence"], "employment_id", s["employment"], "employment_id")
    coded("stg_absence", s["absence"], "absence_type", ABSENCE_TYPES)
    coded("stg_absence", s["absence"], "status", ABSENCE_STATUSES)

    for name, column in {
        "dim_date": "date_key",
        "dim_country": "country_code",
        "dim_concept": "concept_key",
        "dim_employee": "employee_sk",
        "fct_payroll_movement": "movement_id",
        "fct_settlement": "settlement_id",
    }.items():
        key(name, m[name], column)
        present(name, m[name], column)
    present("dim_employee", m["dim_employee"], "contract_type")
    key("dim_employee_current", m["dim_employee"], "employment_id", F.col("is_current"))
    movement, settlement, absence = m["fct_payroll_movement"], m["fct_settlement"], m["fct_absence_day"]
    refers("fct_payroll_movement", movement, "employee_sk", m["dim_employee"], "employee_sk")
    refers("fct_payroll_movement", movement, "concept_key", m["dim_concept"], "concept_key")
    refers("fct_payroll_movement", movement, "country_code", m["dim_country"], "country_code")
    refers("fct_payroll_movement", movement, "pay_date_key", m["dim_date"], "date_key")
    refers("fct_settlement", settlement, "employee_sk", m["dim_employee"], "employee_sk")
    refers("fct_settlement", settlement, "termination_date_key", m["dim_date"], "date_key")
    present("fct_absence_day", absence, "employee_sk")
    refers("fct_absence_day", absence, "employee_sk", m["dim_employee"], "employee_sk")
    present("fct_absence_day", absence, "date_key")
    refers("fct_absence_day", absence, "date_key", m["dim_date"], "date_key")
    coded("fct_absence_day", absence, "absence_type", ABSENCE_TYPES)

    key("snapshot", snapshot, "dbt_scd_id")
    present("snapshot", snapshot, "dbt_scd_id")
    found += [
        q.Check("movements_reconcile", q.reconcile_counts(s[MOVEMENTS], movement)),
        q.Check("settlements_reconcile", q.reconcile_counts(s["settlement"], settlement)),
        q.Check("absence_day_once", q.duplicate_keys(absence, ["employment_id", "absence_date"])),
        q.Check("absence_only_approved", checks.not_approved(absence, s["absence"])),
        q.Check("absence_outside_employment", checks.absence_outside_employment(s["absence"], s["employment"]), "warn"),
    ]
    return found


def transform(spark: SparkSession, layout: Layout, run_id: str, full: bool = False, extra: ExtraChecks | None = None) -> list:
    """Staging, marts and snapshot from what bronze holds, then all checks.

    ``extra`` makes further checks from the staged relations, such as ``checks.source_checks``.
    """
    staged = staged_relations(spark, layout)
    build_marts(spark, layout, staged, full)
    write_snapshot_run(staged["employment"], layout.snapshot, "employment_id", "updated_at", run_id)
    declared = declared_checks(staged, read_marts(spark, layout), read_snapshot(spark, layout.snapshot))
    report = q.quality_report([*declared, *(extra(staged) if extra else [])])
    return q.enforce(report)


def run(
    spark: SparkSession, read: bronze.Reader, root: str, mode: str = "incremental", table: str | None = None,
    extra: ExtraChecks | None = None,
) -> DataFrame:
    """Everything in order; returns the export's report."""
    layout, load_id = Layout(root), bronze.new_load_id()
    store = WatermarkStore(spark, layout.state)
    bronze.run_extract(spark, read, layout.bronze, store, mode, table, load_id=load_id)
    transform(spark, layout, load_id, full=mode == "full", extra=extra)
    return export_for_bi(spark, read_marts(spark, layout), layout.serving)
