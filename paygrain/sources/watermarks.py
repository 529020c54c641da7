"""High-water marks: how far each source table has been extracted."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from . import files

# Fixed value: the mark of a table that was never extracted.
EPOCH = datetime(1900, 1, 1)


class WatermarkStore:
    """One small JSON file per bronze root. Each save appears whole under a new number, by one rename; the highest
    number counts. At every moment the old or the new marks are there. Files of earlier saves are removed afterwards.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.folder, _, self.name = path.rpartition("/")

    def _versions(self) -> list[int]:
        """Numbers of the saves that are there, in order; a file without a number is the oldest."""
        names = files.children(self.spark, self.folder)
        numbers = [n.removeprefix(f"{self.name}.") for n in names if n.startswith(f"{self.name}.")]
        return ([0] if self.name in names else []) + sorted(int(n) for n in numbers if n.isdigit())

    def _file(self, version: int) -> str:
        return f"{self.path}.{version:08d}" if version else self.path

    def load(self) -> dict[str, datetime]:
        found = self._versions()
        if not found:
            return {}
        saved = json.loads(files.read_text(self.spark, self._file(found[-1])))
        return {table: datetime.fromisoformat(mark) for table, mark in saved.items()}

    def save(self, marks: dict[str, datetime]) -> None:
        text = json.dumps({t: m.isoformat() for t, m in sorted(marks.items())}, indent=2)
        found = self._versions()
        temporary = f"{self.path}.writing-{uuid.uuid4().hex[:12]}"
        files.write_text(self.spark, temporary, text)
        files.rename(self.spark, temporary, self._file((found[-1] if found else 0) + 1))
        for version in found:
            files.remove(self.spark, self._file(version))

    def advance(self, table: str, mark: datetime) -> None:
        self.save({**self.load(), table: mark})

    def table(self) -> DataFrame:
        """The marks as rows."""
        return self.spark.createDataFrame(sorted(self.load().items()), "table_name string, watermark timestamp_ntz")
