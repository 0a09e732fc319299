"""The latest table as a stateful aggregation: one state row for each series, in update mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kvloom.model import SOURCE_COLUMNS, VALUE_COLUMNS, RunOptions
from kvloom.operators.enrich import latest_rows
from kvloom.plans.jobs import start_live_run
from kvloom.plans.manifest import Batch
from kvloom.plans.target import Target
from kvloom.sources.dimensions import load_dimensions
from kvloom.sources.queries import changed_since
from kvloom.sources.tables import SourceTables

_ARRIVED = "_arrived"
#: State outside the heap, for as many series as disks hold; to be set by the caller, as
#: ``spark.sql.streaming.stateStore.providerClass``, before the stream is defined.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_of_stream(stream: DataFrame) -> DataFrame:
    """The source row of the highest ts of each series, of equal ones the one that came last.

    The state is one row a series and outlives batches and restarts. The time of arrival is that of
    the batch, which the checkpoint keeps, so a repeated batch comes to the same state.
    """
    order = F.struct("ts", _ARRIVED)
    newest = F.max_by(F.struct("ts", *VALUE_COLUMNS), order).alias("_row")
    arrived = stream.withColumn(_ARRIVED, F.current_timestamp())
    return arrived.groupBy("entity_id", "key").agg(newest).select("entity_id", "key", "_row.*")


def start_latest(
    stream: DataFrame,
    source: SourceTables,
    target: Target,
    options: RunOptions,
    checkpoint: str,
    watermark: int | None = None,
    available_now: bool = False,
    now_ms: int | None = None,
) -> StreamingQuery:
    """Keep ``ts_kv_latest_cf`` up to date from a stream of ``ts_kv`` rows, without their history.

    A batch stores the series that it touched, each with its newest row of all batches, so a row that
    lands late changes nothing. Names and types are looked up for the series of the batch only, in
    tables that are read again. Rows at or below the watermark at which the run began are left out.
    """
    start = start_live_run(target, options, checkpoint, watermark, now_ms)
    changed = changed_since(stream.select(*SOURCE_COLUMNS), start.start_watermark_ts)

    def cycle(rows: DataFrame, number: int) -> None:
        dims = load_dimensions(source, keep=True)
        try:
            newest = latest_rows(rows.select(*SOURCE_COLUMNS), dims, options)
            target.write_latest(newest, Batch("live", start.run, number))
        finally:
            dims.release()

    writer = (
        newest_of_stream(changed)
        .writeStream.outputMode("update")
        .foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{options.live_sync_interval} seconds").start()
