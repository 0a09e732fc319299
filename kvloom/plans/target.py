"""The target tables as Parquet, and their current views.

Every write goes to a directory of its own,

    <table>/stage=<history|live|compacted>/run=<n>/batch=<n>/...

and replaces what is there, so that a step that runs again leaves the same
rows. A write counts once the manifest has a record of it. The current view of
a table takes, per primary key, the row written last, and merges only the
directories and the ranges of ts in which there can be more than one.

``compact`` stores the current view under another root; ``compact_crowded``
rewrites, under the same root, only the directories with many live batches.

History rows and rejected rows of a batch are written by one pass into the
directories ``outcome=accepted`` and ``outcome=rejected`` of the same tree.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.functions import directory_bucket, lookup_uuid
from kvloom.model import (
    HISTORY_COLUMNS,
    HISTORY_KEY,
    HISTORY_SCHEMA,
    INDEX_COLUMNS,
    INDEX_SCHEMA,
    LATEST_COLUMNS,
    LATEST_KEY,
    LATEST_SCHEMA,
    UNKNOWN_ENTITY,
    RunOptions,
)
from kvloom.operators.aggregates import first_by, latest_from_history
from kvloom.operators.enrich import index_rows
from kvloom.plans import manifest as m
from kvloom.plans.extent import Extent
from kvloom.plans.manifest import Batch, Entry, Manifest, Overlap
from kvloom.plans.progress import Progress, ProgressLog, Slice

HISTORY = "ts_kv_cf"
INDEX = "ts_kv_partitions_cf"
LATEST = "ts_kv_latest_cf"
REPLAYED = "replayed"
STAGING = "staging"
SLICE = "_slice"

_BATCH_FIELDS = [
    T.StructField("stage", T.StringType()),
    T.StructField("run", T.IntegerType()),
    T.StructField("batch", T.LongType()),
]
_BATCH = [f.name for f in _BATCH_FIELDS]
_REASON = T.StructField("reason", T.StringType())
_OUTCOME = T.StructField("outcome", T.StringType())
_BUCKET = T.StructField("bucket", T.LongType())

# Columns in the files followed by those in the directory names. The schema is
# given on every read: a bucket directory named 0 would be inferred as int.
_STORED = {
    HISTORY: T.StructType([*HISTORY_SCHEMA, _REASON, *_BATCH_FIELDS, _OUTCOME, _BUCKET]),
    INDEX: T.StructType([*INDEX_SCHEMA, *_BATCH_FIELDS]),
    LATEST: T.StructType([*LATEST_SCHEMA, *_BATCH_FIELDS]),
    # Rejected rows that have come in after all, by the key that they were rejected with.
    REPLAYED: T.StructType([*[HISTORY_SCHEMA[c] for c in ("entity_id", "key", "ts")], *_BATCH_FIELDS]),
}
_HISTORY_DIRECTORIES = ["outcome", "entity_type", "bucket"]
# Tasks that a directory is spread over without adaptive execution.
_SPREAD = 64
_PART = "_part"


def write_sequence() -> Column:
    """Sorts batches in the order in which they were written.

    A compacted batch stands in for all that its directory had before.
    """
    compacted = F.col("stage") == m.COMPACTED
    return F.struct(~compacted, F.col("run"), F.col("stage") == m.LIVE, F.col("batch"))


class Target:
    """The three target tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest = Manifest(spark, self.root)

    # -- schema --------------------------------------------------------------

    def init_schema(self) -> DataFrame:
        """Create the tables that do not exist yet; report tables and columns."""
        for table, schema in _STORED.items():
            if table == REPLAYED:
                continue
            # Without rows this leaves the bare folder; an existing one stays.
            directories = _BATCH + (["outcome", "entity_type", "bucket"] if table == HISTORY else [])
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy(*directories).parquet(f"{self.root}/{table}")
        rows = [
            (table, position, field.name, field.dataType.simpleString())
            for table, schema in (
                (HISTORY, HISTORY_SCHEMA),
                (INDEX, INDEX_SCHEMA),
                (LATEST, LATEST_SCHEMA),
            )
            for position, field in enumerate(schema.fields, 1)
        ]
        return self.spark.createDataFrame(
            rows, "table_name string, position int, column_name string, data_type string"
        )

    # -- writes --------------------------------------------------------------

    def write_history(
        self, shaped: DataFrame, batch: Batch, strategy: str, files: int = 1
    ) -> None:
        """Store accepted and rejected rows of one batch in one pass.

        The rows are brought together by target directory first, or every task
        would leave a file in every directory. ``files`` is the number of files
        that a directory is expected to need: an entity is then in one of them.
        Adaptive execution splits what is larger than a task should be, so a
        hot directory or entity does not end in one task. Inside a file the
        rows are in key order.
        """
        self._write_directories(shaped, batch, strategy, files)
        self.manifest.commit(HISTORY, batch, self._directories(batch))

    def _write_directories(self, shaped: DataFrame, batch: Batch, strategy: str, files: int) -> None:
        accepted = F.col("reason").isNull()
        bucket = directory_bucket("partition", strategy)
        placed = shaped.withColumns(
            {
                "bucket": F.when(accepted, bucket),
                "outcome": F.when(accepted, "accepted").otherwise("rejected"),
            }
        )
        together = list(_HISTORY_DIRECTORIES)
        # The session of the rows: a stream runs its batches in one of its own.
        if shaped.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            if files > 1:
                placed = placed.withColumn(_PART, F.pmod(F.xxhash64("entity_id"), F.lit(files)))
                together.append(_PART)
            gathered = placed.hint("rebalance", *together)
        else:
            spread = F.pmod(F.xxhash64("entity_id", "key", "ts"), F.lit(max(files, _SPREAD)))
            gathered = placed.repartition(*together, spread)
        ordered = gathered.sortWithinPartitions(*_HISTORY_DIRECTORIES, "entity_id", "key", "ts")
        ordered = ordered.drop(_PART)
        ordered.write.mode("overwrite").partitionBy(*_HISTORY_DIRECTORIES).parquet(
            f"{self.root}/{HISTORY}/{batch.path()}"
        )

    def _directories(self, batch: Batch) -> list[Entry]:
        """Entries of a batch whose history is written, from its directories and one column."""
        rows = self.stored(HISTORY, batch.path()).filter(F.col("outcome") == "accepted")
        found = rows.groupBy("entity_type", "bucket").agg(
            F.count("*").alias("rows"), F.min("ts").alias("low"), F.max("ts").alias("high")
        )
        return [Entry(HISTORY, batch, *r) for r in found.collect()]

    def written(self, batch: Batch) -> tuple[int, int | None]:
        """Accepted rows of a batch and their highest ts, as the manifest has them."""
        entries = self.manifest.entries(HISTORY, batch)
        return sum(e.rows for e in entries), max((e.high for e in entries), default=None)

    def write_index(self, batch: Batch) -> None:
        """Store the index entries of a batch whose history is written.

        They are read from the stored rows: four columns of a sorted file
        instead of the source and its joins once more.
        """
        entries = index_rows(self.written_history(batch))
        self._write_whole(INDEX, entries.sortWithinPartitions(*INDEX_COLUMNS), batch)

    def write_latest(self, latest: DataFrame, batch: Batch) -> None:
        self._write_whole(LATEST, latest.select(*LATEST_COLUMNS), batch)

    def _write_whole(self, table: str, rows: DataFrame, batch: Batch, instead: list[Entry] = ()) -> None:
        """Store a batch of a table without directories of its own, and commit it."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/{batch.path()}")
        self.manifest.commit(table, batch, [Entry(table, batch)], instead)

    # -- staging -------------------------------------------------------------

    def stage(self, rows: DataFrame, run: int, slices: int) -> None:
        """Keep source rows by hash ranges of their entity: one shuffle, then each range is read alone.

        Spellings of one id are in one range. A range with a hot entity is written by several tasks,
        as many as its measured size asks for.
        """
        entity = lookup_uuid(F.col("entity_id").cast("string"))
        placed = rows.withColumn(SLICE, F.pmod(F.xxhash64(entity), F.lit(slices)).cast("int"))
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            gathered = placed.hint("rebalance", SLICE)
        else:
            spread = F.pmod(F.xxhash64("entity_id", "key", "ts"), F.lit(_SPREAD))
            gathered = placed.repartition(SLICE, spread)
        gathered.sortWithinPartitions(SLICE, "entity_id", "key", "ts").write.mode("overwrite").partitionBy(
            SLICE
        ).parquet(f"{self.root}/{STAGING}/run={run}")

    def staged(self, rows: DataFrame, run: int, part: int | None = None) -> DataFrame:
        """Staged rows of all slices or of one, in the columns of ``rows``."""
        schema = T.StructType([*rows.schema, T.StructField(SLICE, T.IntegerType())])
        kept = self.spark.read.schema(schema).parquet(f"{self.root}/{STAGING}/run={run}")
        if part is not None:
            kept = kept.filter(F.col(SLICE) == part)
        return kept.drop(SLICE)

    def stage_replay(self, rows: DataFrame, batch: Batch) -> DataFrame:
        """Keep the rows of a replay, which reads them several times; a stopped one is made anew."""
        path = f"{self.root}/{STAGING}/{batch.path()}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    # -- stored rows ---------------------------------------------------------

    def stored(self, table: str, path: str = "") -> DataFrame:
        """All rows of a table with the columns of their directories."""
        base = f"{self.root}/{table}"
        reader = self.spark.read.schema(_STORED[table]).option("basePath", base)
        try:
            return reader.parquet(f"{base}/{path}" if path else base)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _STORED[table])

    def written_history(self, batch: Batch) -> DataFrame:
        """Accepted rows of one batch."""
        rows = self.stored(HISTORY, batch.path())
        return rows.filter(F.col("outcome") == "accepted").select(*HISTORY_COLUMNS)

    def refused(self, run: int) -> DataFrame:
        """Rejected rows of the historical phase of one run."""
        rows = self.stored(HISTORY, f"stage=history/run={run}")
        return rows.filter(F.col("outcome") == "rejected")

    def rejected(self) -> DataFrame:
        """Rejected rows of all batches, as they came.

        A row that later batches meet again is there once; rows that are equal
        within a batch, as those without an id may be, all count. Rows that
        were replayed are left out.
        """
        rows = self.refusals()
        columns = [c for c in HISTORY_COLUMNS if c not in ("entity_type", "partition")]
        times = rows.groupBy(*columns, "reason", *_BATCH).agg(F.count("*").alias("_times"))
        most = times.groupBy(*columns, "reason").agg(F.max("_times").cast("int").alias("_times"))
        repeated = F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_copy")
        return most.select(*columns, "reason", repeated).drop("_copy")

    def refusals(self) -> DataFrame:
        """Rejected rows with the batch that met them, but for those replayed."""
        rows = self.stored(HISTORY).filter(F.col("outcome") == "rejected")
        closed = self.manifest.entries(REPLAYED)
        if not closed:
            return rows
        replayed = self.committed(REPLAYED, closed).select("entity_id", "key", "ts").distinct()
        known = F.col("reason") == UNKNOWN_ENTITY
        left = rows.filter(known).join(replayed, ["entity_id", "key", "ts"], "left_anti")
        return rows.filter(~known).unionByName(left)

    def write_replay(self, shaped: DataFrame, closed: DataFrame, batch: Batch, strategy: str) -> None:
        """Store rows that were rejected before, and close their rejects.

        The rows count when everything else about them is stored, and their rejects are closed last:
        after a stop at any point, replaying again completes it.
        """
        self._write_directories(shaped, batch, strategy, 1)
        self.write_index(batch)
        self.write_latest(latest_from_history(self.written_history(batch)), batch)
        self.manifest.commit(HISTORY, batch, self._directories(batch))
        self._write_whole(REPLAYED, closed.select("entity_id", "key", "ts"), batch)

    def completed(self, state: Progress) -> DataFrame:
        """Entities all of whose rows a historical run has written.

        Where slices cut by ts, an entity is complete once all planned slices
        are. Where they cut by entity, those of a slice are complete with it,
        as are those of a later slice, cut out for entities that came after.
        """
        done = [s.slice for s in state.slices if s.done]
        rows = self.stored(INDEX, f"stage=history/run={state.run}")
        if state.slice_by == "ts" and state.slices_left():
            rows = rows.filter(F.lit(False))
        return rows.filter(F.col("batch").isin(done)).select("entity_id").distinct()

    # -- current views -------------------------------------------------------

    def committed(self, table: str, entries: list[Entry]) -> DataFrame:
        """The rows of these directories, and of no others."""
        base = f"{self.root}/{table}"
        paths = [f"{base}/{e.batch.path()}" for e in entries]
        if table == HISTORY:
            paths = [
                f"{p}/outcome=accepted/entity_type={e.entity_type}/bucket={e.bucket}"
                for p, e in zip(paths, entries)
            ]
        if not paths:
            return self.spark.createDataFrame([], _STORED[table])
        return self.spark.read.schema(_STORED[table]).option("basePath", base).parquet(*paths)

    def history(self) -> DataFrame:
        """``ts_kv_cf``: per primary key the row written last.

        Only directories with live rows or rows of several historical runs are
        merged, and of them the range of ts that those rows lie in. The rest
        is passed on as it is stored, without a shuffle.
        """
        return self._current(self.manifest.entries(HISTORY))

    def _current(self, entries: list[Entry]) -> DataFrame:
        merged = {(o.entity_type, o.bucket): o for o in m.overlaps(entries)}
        settled = self.committed(HISTORY, [e for e in entries if e.directory() not in merged])
        settled = settled.select(*HISTORY_COLUMNS)
        if not merged:
            return settled
        touched = self.committed(HISTORY, [e for e in entries if e.directory() in merged])
        inside = _within(touched, list(merged.values()))
        outside = touched.filter(~inside).select(*HISTORY_COLUMNS)
        return settled.unionByName(outside).unionByName(_last_written(touched.filter(inside)))

    def partition_index(self) -> DataFrame:
        """``ts_kv_partitions_cf``."""
        rows = self.committed(INDEX, self.manifest.entries(INDEX))
        return rows.select(*INDEX_COLUMNS).distinct()

    def latest(self) -> DataFrame:
        """``ts_kv_latest_cf``: per series the row of the highest ts, of equal
        ones the row written last."""
        rows = self.committed(LATEST, self.manifest.entries(LATEST))
        others = [c for c in LATEST_COLUMNS if c not in LATEST_KEY]
        return first_by(rows, LATEST_KEY, others, F.struct(F.col("ts"), write_sequence()))

    def series_slice(
        self, entity_type: str, entity_id: str, key: str, partition: int, strategy: str
    ) -> DataFrame:
        """Rows of one partition of ``ts_kv_cf`` in ts order.

        The bucket directory follows from the partition, so only that
        directory is read.
        """
        bucket = self.spark.range(1).select(
            directory_bucket(F.lit(partition).cast("long"), strategy)
        ).first()[0]
        entries = [
            e for e in self.manifest.entries(HISTORY) if e.directory() == (entity_type, bucket)
        ]
        wanted = (
            (F.col("entity_type") == entity_type)
            & (F.col("bucket") == bucket)
            & (F.col("entity_id") == entity_id)
            & (F.col("key") == key)
            & (F.col("partition") == partition)
        )
        return _last_written(self.committed(HISTORY, entries).filter(wanted)).orderBy("ts")

    # -- compaction ----------------------------------------------------------

    def compact(self, destination: Target, options: RunOptions, run: int) -> None:
        """Store the current views and the rejected rows under another root, as
        one historical batch.

        The caller switches readers to the new root and drops the old one.
        """
        batch = Batch("history", run, 0)
        current = self.history()
        refused = self.rejected().withColumns(
            {"entity_type": F.lit(None).cast("string"), "partition": F.lit(None).cast("long")}
        )
        destination.write_history(
            current.withColumn("reason", F.lit(None).cast("string")).unionByName(refused),
            batch,
            options.partitioning,
            Extent.of(current).files_per_directory(options),
        )
        destination._write_whole(INDEX, self.partition_index(), batch)
        destination.write_latest(self.latest(), batch)
        last = ProgressLog(self.spark, self.root).find() or Progress()
        ProgressLog(self.spark, destination.root).save(
            replace(last, stage="history", run=run, step=0, slices=(Slice(0, done=True),))
        )

    def compact_crowded(self, options: RunOptions, most_live: int = 10) -> int:
        """Rewrite what has more than so many live batches; returns the number of directories.

        Of the history, a directory (entity type and month) with more live batches is merged into
        one compacted batch; all others stay as they are. The index and the latest table count as
        one directory each. Readers switch with the record that the manifest gets at the end; until
        then, and after a stop, they read what they read before. Directories that were replaced stay
        for readers that began earlier; they can be deleted when there are none.

        To be run between live batches, not beside one.
        """
        rewritten = 0
        for table in (HISTORY, INDEX, LATEST):
            entries = self.manifest.entries(table)
            live: dict[tuple, int] = {}
            for e in entries:
                if e.batch.stage == m.LIVE:
                    live[e.directory()] = live.get(e.directory(), 0) + 1
            crowded = {d for d, n in live.items() if n > most_live}
            replaced = [e for e in entries if e.directory() in crowded]
            if not replaced:
                continue
            rewritten += len(crowded)
            batch = Batch(m.COMPACTED, 1, self.next_batch(m.COMPACTED, table))
            if table == HISTORY:
                current = self._current(replaced).withColumn("reason", F.lit(None).cast("string"))
                rows = max(
                    sum(e.rows for e in replaced if e.directory() == d) for d in crowded
                )
                self._write_directories(
                    current, batch, options.partitioning, max(1, rows // options.rows_per_file)
                )
                self.manifest.commit(HISTORY, batch, self._directories(batch), replaced)
            elif table == INDEX:
                self._write_whole(INDEX, self.partition_index(), batch, replaced)
            else:
                self._write_whole(LATEST, self.latest(), batch, replaced)
        return rewritten

    def next_batch(self, stage: str, table: str = HISTORY) -> int:
        """A number that no batch of the stage has, not even one that was stopped."""
        rows = self.stored(table).filter(F.col("stage") == stage)
        return (rows.agg(F.max("batch")).first()[0] or 0) + 1


def _within(rows: DataFrame, overlaps: list[Overlap]) -> Column:
    """Whether a row lies in a range in which its directory has to be merged.

    The ranges are few, one for each entity type and month at most, and compared as literals: a map
    lookup by directory, no join.
    """
    entries = []
    for o in overlaps:
        low, high = (F.lit(ts).cast("long") for ts in (o.low, o.high))
        entries += [F.lit(f"{o.entity_type}/{o.bucket}"), F.struct(low.alias("low"), high.alias("high"))]
    bounds = F.element_at(F.create_map(*entries), F.concat_ws("/", "entity_type", F.col("bucket").cast("string")))
    return F.coalesce(F.col("ts").between(bounds["low"], bounds["high"]), F.lit(False))


def _last_written(rows: DataFrame) -> DataFrame:
    """Per primary key of ``ts_kv_cf`` the row of the latest batch; combined before the shuffle."""
    others = [c for c in HISTORY_COLUMNS if c not in HISTORY_KEY]
    return first_by(rows, HISTORY_KEY, others, write_sequence()).select(*HISTORY_COLUMNS)
