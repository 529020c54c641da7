"""A payroll small enough to work out by hand, in the shape of the source tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from paygrain.sources.contracts import CONTRACTS, contract_for

T0 = datetime(2025, 1, 1, 9)
D = date.fromisoformat


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


COUNTRIES = [("MX", "Mexico", "MXN", "BIWEEKLY"), ("UY", "Uruguay", "UYU", "MONTHLY")]
DEPARTMENTS = [(1, "MX", "Ventas"), (2, "UY", "Finanzas")]
EMPLOYEES = [(10, "Ana", "Gil", D("1990-05-01")), (11, "Luz", "Paz", None), (12, "Teo", "Sol", D("1985-01-31"))]
# id, employee, department, title, salary, hire, termination, reason, contract type
EMPLOYMENTS = [
    (1, 10, 2, "Analista", money(1000), D("2022-05-10"), None, None, "INDEFINITE"),
    (2, 11, 1, "Gerente", money(1000), D("2023-01-20"), None, None, "temporary "),
    (3, 12, 2, "Auxiliar", money(900), D("2023-01-01"), D("2024-03-04"), "DISMISSAL", None),
]
CONCEPTS = [
    (1, "MX", "P001", "Sueldo", "EARNING"),
    (2, "MX", "D002", "IMSS", "DEDUCTION"),
    (3, "UY", "P001", "Sueldo", "EARNING"),
    (4, "UY", "D002", "BPS", "DEDUCTION"),
    (5, "UY", "F001", "Indemnizacion", "EARNING"),
    (6, "UY", "F002", "Vacaciones", "EARNING"),
]
PERIODS = [
    (101, "MX", D("2023-01-16"), D("2023-01-31"), D("2023-01-31")),
    (102, "MX", D("2023-02-01"), D("2023-02-15"), D("2023-02-15")),
    (201, "UY", D("2023-01-01"), D("2023-01-31"), D("2023-01-31")),
    (202, "UY", D("2023-02-01"), D("2023-02-28"), D("2023-02-28")),
    (203, "UY", D("2023-03-01"), D("2023-03-31"), D("2023-03-31")),
    (204, "UY", D("2023-04-01"), D("2023-04-30"), D("2023-04-30")),
    (205, "UY", D("2024-02-01"), D("2024-02-29"), D("2024-02-29")),
]
# id, employment, period, concept, amount
MOVEMENTS = [
    (1, 1, 201, 3, money(1000)),
    (2, 1, 202, 3, money(1000)),
    (3, 1, 203, 3, money(1200)),
    (4, 1, 204, 3, money(1000)),
    (5, 1, 203, 4, money(60)),
    (6, 2, 101, 1, money(500)),
    (7, 2, 102, 1, money(500)),
    (8, 2, 102, 2, money(20)),
    (9, 3, 201, 3, money(900)),
    (10, 3, 205, 3, money(900)),
]
SETTLEMENTS = [(7, 3, D("2024-03-10"), "PAID")]
LINES = [(71, 7, 6, money(100)), (72, 7, 5, money(3000)), (73, 7, 4, money(9))]
# id, employment, type, start, end, status
ABSENCES = [
    (1, 3, "VACATION", D("2024-02-28"), D("2024-03-02"), "APPROVED"),
    (2, 3, "SICK_LEAVE", D("2024-03-01"), D("2024-03-03"), "APPROVED"),
    (3, 3, "VACATION", D("2024-02-28"), D("2024-02-28"), "APPROVED"),
    (4, 3, "UNJUSTIFIED", D("2024-03-04"), D("2024-03-06"), "APPROVED"),
    (5, 3, "VACATION", D("2024-02-20"), D("2024-02-21"), "CANCELLED"),
]


class Source:
    """The source database: rows per table, each with its change time."""

    def __init__(self):
        tables = [
            COUNTRIES,
            DEPARTMENTS,
            EMPLOYEES,
            EMPLOYMENTS,
            CONCEPTS,
            PERIODS,
            MOVEMENTS,
            SETTLEMENTS,
            LINES,
            ABSENCES,
        ]
        self.rows = {
            c.source: [(*row, T0, T0) for row in data] for c, data in zip(CONTRACTS, tables, strict=True)
        }

    def put(self, table: str, *new: tuple, at: datetime) -> None:
        """Insert rows or replace those with the same key, changed at the given time."""
        keys = {row[0] for row in new}
        kept = [row for row in self.rows[table] if row[0] not in keys]
        self.rows[table] = kept + [(*row, T0, at) for row in new]

    def frame(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.createDataFrame(self.rows[table], contract_for(table).schema)

    def reader(self, spark: SparkSession):
        return lambda contract: self.frame(spark, contract.source)
