"""Schema contracts: the exact columns, types and nullability each source table lands with."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns every source table ends with.
AUDIT = "CreatedAt timestamp_ntz not null, UpdatedAt timestamp_ntz not null"


@dataclass(frozen=True)
class Contract:
    """A source table by its name and the columns it must arrive with, in SQL.

    The first column is the key; ``watermark`` says when a row last changed. The rest follows: the folder
    is the table's name in snake case. The SQL is parsed when a schema is first asked for, as that needs
    a session.
    """

    source: str
    ddl: str
    watermark: str = "UpdatedAt"

    @property
    def folder(self) -> str:
        name = self.source.rpartition(".")[2]
        return "".join("_" + c.lower() if c.isupper() and i else c.lower() for i, c in enumerate(name))

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def bronze_schema(self) -> T.StructType:
        """What a scan of the loads finds: the contract's columns and the load they came with."""
        return T.StructType([*self.schema, T.StructField("load_id", T.StringType())])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def key(self) -> str:
        return self.columns[0]


# The source tables, their columns and types.
TABLES = {
    "payroll.Country":
        "CountryCode string not null, Name string not null, CurrencyCode string not null, PayFrequency string not null",
    "payroll.Department": "DepartmentId int not null, CountryCode string not null, Name string not null",
    "payroll.Employee": "EmployeeId int not null, FirstName string not null, LastName string not null, BirthDate date",
    "payroll.Employment":
        "EmploymentId int not null, EmployeeId int not null, DepartmentId int not null, JobTitle string not null,"
        " MonthlySalary decimal(18,2) not null, HireDate date not null, TerminationDate date,"
        " TerminationReason string, ContractType string",
    "payroll.PayrollConcept":
        "ConceptId int not null, CountryCode string not null, Code string not null, Name string not null,"
        " ConceptType string not null",
    "payroll.PayrollPeriod":
        "PeriodId int not null, CountryCode string not null, StartDate date not null, EndDate date not null,"
        " PayDate date not null",
    "payroll.PayrollMovement":
        "MovementId bigint not null, EmploymentId int not null, PeriodId int not null, ConceptId int not null,"
        " Amount decimal(18,2) not null",
    "payroll.Settlement":
        "SettlementId int not null, EmploymentId int not null, SettlementDate date not null, Status string not null",
    "payroll.SettlementLine":
        "SettlementLineId bigint not null, SettlementId int not null, ConceptId int not null,"
        " Amount decimal(18,2) not null",
    "payroll.Absence":
        "AbsenceId int not null, EmploymentId int not null, AbsenceType string not null, StartDate date not null,"
        " EndDate date not null, Status string not null",
}
CONTRACTS = [Contract(source, f"{columns}, {AUDIT}") for source, columns in TABLES.items()]


def contract_for(source: str) -> Contract:
    for contract in CONTRACTS:
        if contract.source == source:
            return contract
    raise KeyError(f"unknown source table: {source}")


def _fits(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """True for a value the declared type can hold without changing it (NULL passes)."""
    if have == want:
        return F.lit(True)
    kept = column.try_cast(want)
    if isinstance(have, T.StringType):
        # Text is compared with what the typed value would be written as, as a number if it is one.
        return column.isNull() | kept.isNotNull()
    return column.isNull() | (kept.isNotNull() & (kept.try_cast(have) == column))


def enforce_contract(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Project onto the declared columns; a NULL or a value that does not fit fails the job.

    The tests are part of the projection, so they run while the rows are written and
    cost no pass of their own. Columns outside the contract are ignored, absent ones
    make the plan fail.
    """

    def checked(field: T.StructField) -> Column:
        column, have = F.col(field.name), df.schema[field.name].dataType
        value = column if have == field.dataType else column.try_cast(field.dataType)
        if have != field.dataType:
            misfit = F.raise_error(F.lit(f"{name}.{field.name}: value does not fit {field.dataType.simpleString()}"))
            value = F.when(_fits(column, have, field.dataType), value).otherwise(misfit.cast(field.dataType))
        if not field.nullable:
            missing = F.raise_error(F.lit(f"{name}.{field.name}: NULL in a NOT NULL column"))
            value = F.when(column.isNull(), missing.cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    return df.select(*[checked(f) for f in schema])


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column and reason, how many rows break the contract; one pass over the data."""
    tests: dict[tuple[str, str], Column] = {}
    for field in schema:
        column, have = F.col(field.name), df.schema[field.name].dataType
        if not field.nullable:
            tests[field.name, "null"] = column.isNull()
        if have != field.dataType:
            tests[field.name, "misfit"] = ~_fits(column, have, field.dataType)
    counts = df.agg(*[F.count(F.when(test, 1)).alias(f"_{i}") for i, test in enumerate(tests.values())])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(reason).alias("reason"), F.col(f"_{i}").alias("violations"))
        for i, (c, reason) in enumerate(tests)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*").where("violations > 0")


