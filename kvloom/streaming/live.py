"""Stream of source rows into the target tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kvloom.model import RunOptions
from kvloom.plans.jobs import apply_live_batch, start_live_run
from kvloom.plans.target import Target
from kvloom.sources.tables import SourceTables


def start_live(
    stream: DataFrame,
    source: SourceTables,
    target: Target,
    options: RunOptions,
    checkpoint: str,
    watermark: int | None = None,
    available_now: bool = False,
    now_ms: int | None = None,
) -> StreamingQuery:
    """Start the live phase over a stream of ``ts_kv`` rows.

    ``stream`` has the eight source columns; ``source`` gives the entity and
    key tables, read again in every batch. All rows above the watermark at
    which the run began are taken, in whatever order they land: the offsets of
    the stream already tell what is new. A stream watermark would act in
    stateful operators only, and there are none here.
    """
    run = start_live_run(target, options, checkpoint, watermark, now_ms).run

    def cycle(rows: DataFrame, number: int) -> None:
        apply_live_batch(rows, source, target, options, run, number, now_ms, streamed=True)

    writer = stream.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{options.live_sync_interval} seconds").start()
