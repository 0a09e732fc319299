"""The progress record: where a run stands."""

from __future__ import annotations

from dataclasses import asdict, astuple, dataclass, fields, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.functions import utc_text

# A run keeps this many of its last records; the writer never replaces the one
# that a repeated step starts from.
_SLOTS = 4

_SLICE = T.StructType(
    [
        T.StructField("slice", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("planned", T.BooleanType()),
        T.StructField("done", T.BooleanType()),
        T.StructField("rows", T.LongType()),
    ]
)
SCHEMA = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("phase", T.StringType()),
        T.StructField("phase1_start_ts", T.LongType()),
        T.StructField("last_entity_id", T.StringType()),
        T.StructField("watermark_ts", T.LongType()),
        T.StructField("start_watermark_ts", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("migrated_rows", T.LongType()),
        T.StructField("skipped_rows", T.LongType()),
        T.StructField("skipped_entities", T.LongType()),
        T.StructField("completed_entities", T.LongType()),
        T.StructField("lag_ms", T.LongType()),
        T.StructField("started_ms", T.LongType()),
        T.StructField("saved_ms", T.LongType()),
        T.StructField("partitioning", T.StringType()),
        T.StructField("cast_strings", T.BooleanType()),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("slice_by", T.StringType()),
        T.StructField("staged", T.BooleanType()),
        T.StructField("slices", T.ArrayType(_SLICE)),
    ]
)
_STORED = T.StructType(
    [
        *SCHEMA,
        T.StructField("stage", T.StringType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("slot", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Slice:
    """One part of the historical phase: a range of ts, ``low <= ts < high``, where None is open,
    or, of a run that slices by entity, all rows of the entities whose hash has its number.

    A slice that is not planned was added for entities that came later. ``rows``
    is the number of history rows found in the table once the slice is done.
    """

    slice: int
    low: int | None = None
    high: int | None = None
    planned: bool = True
    done: bool = False
    rows: int = 0


@dataclass(frozen=True)
class Progress:
    """One record. ``stage`` and ``run`` name the run, ``step`` counts in it.

    Which entities are complete follows from the bucket index and the slices
    that are done; the record has their number only.
    """

    stage: str = "history"
    run: int = 1
    step: int = 0
    phase: str = "init"
    phase1_start_ts: int = 0
    last_entity_id: str | None = None
    watermark_ts: int = 0
    # Where the live run began: what a stream takes lies above it.
    start_watermark_ts: int = 0
    total_rows: int = 0
    migrated_rows: int = 0
    skipped_rows: int = 0
    skipped_entities: int = 0
    completed_entities: int = 0
    lag_ms: int | None = None
    started_ms: int = 0
    saved_ms: int = 0
    partitioning: str = "MONTHS"
    cast_strings: bool = False
    checkpoint: str | None = None
    slice_by: str = "ts"
    # The rows of a run that slices by entity are in its staging table.
    staged: bool = False
    slices: tuple[Slice, ...] = ()

    def slices_left(self) -> bool:
        """Whether the planned part of the historical phase is unfinished."""
        return any(s.planned and not s.done for s in self.slices)

    def with_slice(self, done: Slice) -> Progress:
        """The record with one slice added or changed."""
        kept = [s for s in self.slices if s.slice != done.slice]
        return replace(self, slices=tuple(sorted([*kept, done], key=lambda s: s.slice)))

    def next(self, **changes) -> Progress:
        return replace(self, step=self.step + 1, **changes)


class ProgressLog:
    """Progress records below a target's root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/progress"

    def table(self) -> DataFrame:
        """All kept records. Columns that are not known here are not read."""
        try:
            return self.spark.read.schema(_STORED).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _STORED)

    def save(self, record: Progress) -> Progress:
        values = asdict(record)
        values["slices"] = [astuple(s) for s in record.slices]
        row = tuple(values[name] for name in SCHEMA.fieldNames())
        directory = f"stage={record.stage}/run={record.run}/slot={record.step % _SLOTS}"
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/{directory}"
        )
        return record

    def find(self, condition=None) -> Progress | None:
        """The newest record, of those that meet the condition."""
        rows = self.table() if condition is None else self.table().filter(condition)
        newest = rows.orderBy(F.desc("saved_ms"), F.desc("run"), F.desc("step")).first()
        if newest is None:
            return None
        values = {f.name: newest[f.name] for f in fields(Progress)}
        # Records of earlier versions have no such columns.
        values["slice_by"], values["staged"] = values["slice_by"] or "ts", bool(values["staged"])
        values["slices"] = tuple(Slice(**s.asDict()) for s in newest["slices"] or ())
        return Progress(**values)

    def runs(self, stage: str) -> list[int]:
        """Runs of a stage that left a record."""
        found = self.table().filter(F.col("stage") == stage).select("run").distinct().collect()
        return sorted(r["run"] for r in found)

    def last_run(self) -> int:
        return self.table().agg(F.max("run")).first()[0] or 0


def status_report(progress: DataFrame) -> DataFrame:
    """The newest record as (position, field, value), ready to be shown."""
    newest = progress.orderBy(F.desc("saved_ms"), F.desc("run"), F.desc("step")).limit(1)
    seconds = (F.col("saved_ms") - F.col("started_ms")) / 1000
    settled = F.col("migrated_rows") + F.col("skipped_rows")
    rate = F.when(seconds > 0, settled / seconds)
    left = F.greatest(F.col("total_rows") - settled, F.lit(0))
    lines = [
        ("Phase", F.col("phase")),
        ("Started at", utc_text(F.col("started_ms"))),
        ("Partitioning", F.col("partitioning")),
        ("Cast strings", F.initcap(F.col("cast_strings").cast("string"))),
        ("Total rows", F.format_number("total_rows", 0)),
        ("Migrated rows", F.format_number("migrated_rows", 0)),
        ("Skipped rows", F.format_number("skipped_rows", 0)),
        ("Skipped entities", F.format_number("skipped_entities", 0)),
        ("Completed entities", F.format_number("completed_entities", 0)),
        ("Last entity ID", F.coalesce("last_entity_id", F.lit("—"))),
        (
            "Done",
            F.when(
                F.col("total_rows") > 0,
                F.concat(F.format_number(settled * 100 / F.col("total_rows"), 1), F.lit("%")),
            ),
        ),
        ("Rows per second", F.format_number(rate, 0)),
        ("Seconds left", F.when(rate > 0, F.format_number(left / rate, 0))),
        ("Watermark", F.when(F.col("watermark_ts") != 0, utc_text(F.col("watermark_ts")))),
        ("Lag ms", F.format_number("lag_ms", 0)),
    ]
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("field"), value.alias("value"))
            for i, (name, value) in enumerate(lines, 1)
        ]
    )
    return newest.select(F.inline(entries)).filter(F.col("value").isNotNull())
