"""Which directories of the target tables count, and the range of ts that each one holds.

A batch is committed by one record, written after its files: an entry for every directory it has
rows in. A compaction commits in the same way, with entries for the directories it wrote and for
those they stand in for. What no record names is not read, be it the trace of a stopped write, of a
stopped compaction, or a directory that was replaced.

There is an entry for each batch, entity type and month at most, fewer than files, whose list the
driver holds for every read anyway.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_BATCH = [("stage", _TEXT), ("run", _INT), ("batch", _LONG)]
_ENTRY = [("table_name", _TEXT), ("entity_type", _TEXT)]
_ENTRY += [(name, _LONG) for name in ("bucket", "rows", "low", "high")]
#: Entries with the address of another batch are dropped; those without are of this one.
_WRITTEN = T.StructType([T.StructField(*f) for f in [*_ENTRY, *[(f"of_{n}", t) for n, t in _BATCH]]])
_STORED = T.StructType([*_WRITTEN, *[T.StructField(*f) for f in _BATCH]])

LIVE, HISTORICAL, COMPACTED, REPLAY = "live", "history", "compacted", "replay"


@dataclass(frozen=True)
class Batch:
    """Address of one write."""

    stage: str
    run: int
    batch: int

    def path(self) -> str:
        return f"stage={self.stage}/run={self.run}/batch={self.batch}"


@dataclass(frozen=True)
class Entry:
    """A directory of a table. Only history directories have an entity type, a bucket and a range."""

    table: str
    batch: Batch
    entity_type: str | None = None
    bucket: int | None = None
    rows: int = 0
    low: int | None = None
    high: int | None = None

    def directory(self) -> tuple[str | None, int | None]:
        return self.entity_type, self.bucket

    def place(self) -> tuple:
        return self.table, self.batch, self.entity_type, self.bucket


class Manifest:
    """The records below a target's root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/manifest"

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(_STORED).option("basePath", self.path).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _STORED)

    def commit(self, table: str, batch: Batch, entries: list[Entry], drops: list[Entry] = ()) -> None:
        """Record what a batch has in a table. One file, so it is there whole or not at all."""
        rows = [(table, e.entity_type, e.bucket, e.rows, e.low, e.high, None, None, None) for e in entries]
        rows += [
            (table, d.entity_type, d.bucket, 0, None, None, d.batch.stage, d.batch.run, d.batch.batch)
            for d in drops
        ]
        frame = self.spark.createDataFrame(rows, _WRITTEN).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.path}/table={table}/{batch.path()}")

    def entries(self, table: str, batch: Batch | None = None) -> list[Entry]:
        """The committed entries of a table, or of one batch of it, without those dropped."""
        rows = self._rows().filter(F.col("table_name") == table)
        kept, dropped = [], set()
        for r in rows.collect():
            at = Batch(r["stage"], r["run"], r["batch"])
            if r["of_stage"] is None:
                kept.append(Entry(table, at, r["entity_type"], r["bucket"], r["rows"], r["low"], r["high"]))
            else:
                of = Batch(r["of_stage"], r["of_run"], r["of_batch"])
                dropped.add((table, of, r["entity_type"], r["bucket"]))
        return [e for e in kept if e.place() not in dropped and batch in (None, e.batch)]


@dataclass(frozen=True)
class Overlap:
    """The range of ts of a directory in which a row may be there more than once."""

    entity_type: str | None
    bucket: int | None
    low: int
    high: int


def overlaps(entries: list[Entry]) -> list[Overlap]:
    """The directories that more than one write may have the same rows in.

    The batches of one historical run share no key, and what was replayed shares none with what was
    there before it. So a directory needs no merging unless a live
    batch has rows in it, or a second historical run, or something besides a compacted batch.
    """
    by_directory: dict[tuple, list[Entry]] = defaultdict(list)
    for e in entries:
        by_directory[e.directory()].append(e)
    out = []
    for (entity_type, bucket), found in by_directory.items():
        runs = {e.batch.run for e in found if e.batch.stage == HISTORICAL}
        again = [e for e in found if e.batch.stage == LIVE]
        if len(runs) > 1 or (runs and any(e.batch.stage == COMPACTED for e in found)):
            again += [e for e in found if e.batch.stage == HISTORICAL]
        if again:
            out.append(Overlap(entity_type, bucket, min(e.low for e in again), max(e.high for e in again)))
    return out
