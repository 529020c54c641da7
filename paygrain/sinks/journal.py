"""A commit journal beside a table: what each batch was about to do, and which batches are done.

Swapping partitions in is not one step, so a run that dies leaves some of a batch's partitions new and others old,
and nothing in the rows tells how far it came. The journal does: a batch writes an intent (its scope and the
partitions it will rewrite) before it touches the table and a done record (how far the table then is) after it. What
is not done is pending, whatever rows lie in the table; the next run takes it again and rewrites the partitions of
every open intent besides its own. Records are small files that appear whole, by a rename that never overwrites.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..sources import files

_INTENT, _DONE = ".intent.json", ".done.json"


@dataclass(frozen=True)
class Batch:
    """One batch of a table; ``position`` is None while it is open."""

    seq: int
    scope: Mapping
    touched: Sequence
    position: Mapping | None


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _publish(self, name: str, record: Mapping) -> None:
        beside = f"{self.path}/_writing-{uuid.uuid4().hex[:12]}"
        files.write_text(self.spark, beside, json.dumps(record, default=str))
        files.rename(self.spark, beside, f"{self.path}/{name}")

    def _records(self, kind: str) -> dict[int, Mapping]:
        names = [n for n in files.children(self.spark, self.path) if n.endswith(kind)]
        return {int(n.removesuffix(kind)): json.loads(files.read_text(self.spark, f"{self.path}/{n}")) for n in names}

    def batches(self) -> list[Batch]:
        """All batches in order. A batch that a later one has repeated is done as that one is."""
        done = self._records(_DONE)
        for record in list(done.values()):
            done |= {seq: record for seq in record["repeats"] if seq not in done}
        return [
            Batch(seq, r["scope"], r["touched"], done[seq]["position"] if seq in done else None)
            for seq, r in sorted(self._records(_INTENT).items())
        ]

    def open_batches(self) -> list[Batch]:
        return [b for b in self.batches() if b.position is None]

    def last_position(self) -> Mapping | None:
        """Where the table stands: the position of the newest batch that is done."""
        done = [b for b in self.batches() if b.position is not None]
        return done[-1].position if done else None

    def covered(self, name: str) -> set:
        """All members that the scopes of done batches list under ``name``."""
        return {x for b in self.batches() if b.position is not None for x in b.scope.get(name, [])}

    def begin(self, scope: Mapping, touched: Sequence) -> int:
        """Publish an intent. Of two runs that begin at once, one gets an error."""
        seq = max(self._records(_INTENT), default=0) + 1
        self._publish(f"{seq:08d}{_INTENT}", {"scope": scope, "touched": list(touched)})
        return seq

    def finish(self, seq: int, position: Mapping, repeats: Sequence[int] = ()) -> None:
        self._publish(f"{seq:08d}{_DONE}", {"position": position, "repeats": list(repeats)})
