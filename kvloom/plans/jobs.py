"""The jobs: preload, historical phase, live cycles."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.model import (
    HISTORY_KEY,
    LATE,
    LIVE_START_MARGIN_MS,
    UNKNOWN_ENTITY,
    VALUE_COLUMNS,
    RunOptions,
)
from kvloom.operators.aggregates import first_by, latest_from_history
from kvloom.operators.enrich import history_rows, latest_rows, shape_history, with_entity_types
from kvloom.operators.joins import lookup_join
from kvloom.plans.extent import Extent
from kvloom.plans.progress import Progress, ProgressLog, Slice
from kvloom.plans.manifest import REPLAY, Batch
from kvloom.plans.target import Target, write_sequence
from kvloom.sources.dimensions import Dimension, Dimensions, load_dimensions
from kvloom.sources.queries import changed_since
from kvloom.sources.tables import SourceTables


def now_millis() -> int:
    return int(time.time() * 1000)


def within(rows: DataFrame, part: Slice) -> DataFrame:
    """The rows of a slice; both bounds reach the scan."""
    if part.low is not None:
        rows = rows.filter(F.col("ts") >= part.low)
    if part.high is not None:
        rows = rows.filter(F.col("ts") < part.high)
    return rows


def run_historical(
    source: SourceTables,
    target: Target,
    options: RunOptions,
    resume: bool = False,
    now_ms: int | None = None,
) -> Progress:
    """Preload and historical phase: all source rows into the three tables.

    A resumed run keeps its number, its start time and its slices; it redoes
    the slices that are not finished and leaves out completed entities. Sliced
    by entity, the source is read once and staged: entities are complete slice
    by slice, and a resumed run reads what is staged. Rows that came after the
    staging belong to the live phase, which begins before it. The phase moves
    on only after everything is written.
    """
    now = now_millis if now_ms is None else (lambda: now_ms)
    log = ProgressLog(target.spark, target.root)
    state = log.find(F.col("stage") == "history") if resume else None
    if state is None:
        state = Progress(
            run=log.last_run() + 1,
            phase="phase0",
            started_ms=now(),
            saved_ms=now(),
            partitioning=options.partitioning,
            cast_strings=options.cast_strings,
            slice_by=options.slice_by,
        )
        log.save(state)
    check_settings(state, options, "slice_by")
    dims = load_dimensions(source, keep=True)
    try:
        return _write_historical(source, target, options, log, state, dims, now)
    finally:
        dims.release()


def check_settings(state: Progress, options: RunOptions, *more: str) -> None:
    """Raise if a run is to go on with other settings than it began with.

    The bucket is part of the primary key: rows under two partitionings would
    be there twice.
    """
    for name in ("partitioning", "cast_strings", *more):
        kept, given = getattr(state, name), getattr(options, name)
        if kept != given:
            raise ValueError(f"the run has {name}={kept!r}; it cannot go on with {given!r}")


def _write_historical(
    source: SourceTables,
    target: Target,
    options: RunOptions,
    log: ProgressLog,
    state: Progress,
    dims: Dimensions,
    now: Callable[[], int],
) -> Progress:
    rows = source.history()
    by_entity = state.slice_by == "entity"
    if by_entity:
        if not state.staged:
            # The only pass over the source; a stopped one is made anew.
            target.stage(rows, state.run, options.slices)
            state = log.save(state.next(staged=True, saved_ms=now()))
        extent = Extent.of(target.staged(rows, state.run))
        planned = tuple(Slice(i) for i in range(options.slices))
    else:
        extent = Extent.of(rows, options.slices)
        planned = extent.cut()
    state = state.next(
        phase="phase1",
        phase1_start_ts=state.phase1_start_ts or now(),
        total_rows=extent.rows,
        slices=state.slices or planned,
        saved_ms=now(),
    )
    log.save(state)

    completed = None
    if any(s.done for s in state.slices):
        completed = Dimension.measure(target.completed(state))
    todo = [s for s in state.slices if not s.done]
    if not todo and _new_entities(rows, dims, completed, options):
        todo = [Slice(len(state.slices), planned=False)]
    for part in todo:
        mine = within(rows, part)
        if by_entity and part.planned:
            # All rows of its entities, and of no others: none of them is complete yet.
            mine = target.staged(rows, state.run, part.slice)
        shaped = shape_history(mine, dims, options)
        if completed is not None and completed.rows and not (by_entity and part.planned):
            shaped = lookup_join(shaped, completed, "entity_id", "left_anti", options)
        batch = Batch("history", state.run, part.slice)
        target.write_history(
            shaped, batch, options.partitioning, extent.files_per_directory(options)
        )
        target.write_index(batch)
        # As the manifest has it, and anew if the slice is done again.
        done = replace(part, done=True, rows=target.written(batch)[0])
        state = state.next(saved_ms=now()).with_slice(done)
        state = replace(state, migrated_rows=sum(s.rows for s in state.slices))
        if by_entity:
            state = replace(state, **_completed_counts(target, state))
        dims.entities.release()
        dims.keys.release()
        if completed is not None:
            completed.release()
        if part is not todo[-1]:
            log.save(state)

    if source.find("ts_kv_latest") is None:
        # Without the table the newest stored values are the latest ones.
        newest = latest_from_history(target.history())
    else:
        newest = latest_rows(source.latest(), dims, options)
    target.write_latest(newest, Batch("history", state.run, 0))
    state = replace(state, **_entity_counts(target, state))
    return log.save(state.next(phase="live_sync", saved_ms=now()))


def _new_entities(
    rows: DataFrame, dims: Dimensions, completed: Dimension, options: RunOptions
) -> bool:
    """Whether the source has known entities that the run has not completed."""
    known = with_entity_types(rows.select("entity_id").distinct(), dims, options)
    known = known.filter(F.col("reason").isNull())
    return not lookup_join(known, completed, "entity_id", "left_anti", options).isEmpty()


def _completed_counts(target: Target, state: Progress) -> dict[str, object]:
    """Complete entities and the highest of them, after a slice."""
    found = target.completed(state).agg(F.count("*").alias("n"), F.max("entity_id").alias("last")).first()
    return {"completed_entities": found["n"], "last_entity_id": found["last"]}


def _entity_counts(target: Target, state: Progress) -> dict[str, object]:
    """What the tables of a run tell about skipped and completed entities."""
    refused = target.refused(state.run).select("entity_id", "key", "ts")
    if not all(s.planned for s in state.slices):
        # A slice added later meets rows of unknown entities again.
        refused = refused.distinct()
    none = F.lit(None).cast("string")
    skipped = (
        refused.groupBy("entity_id")
        .count()
        .agg(
            F.lit("skipped").alias("what"),
            F.count("*").alias("entities"),
            F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
            none.alias("last"),
        )
    )
    complete = target.completed(state).agg(
        F.lit("complete"), F.count("*"), F.lit(0).cast("long"), F.max("entity_id")
    )
    found = {r["what"]: r for r in skipped.union(complete).collect()}
    return {
        "skipped_rows": found["skipped"]["rows"],
        "skipped_entities": found["skipped"]["entities"],
        "completed_entities": found["complete"]["entities"],
        "last_entity_id": found["complete"]["last"],
    }


# -- live phase ----------------------------------------------------------------


def sync_once(
    rows: DataFrame, dims: Dimensions, options: RunOptions, watermark: int
) -> DataFrame:
    """History rows of one live cycle: known entities, ts above the watermark."""
    return history_rows(changed_since(rows, watermark), dims, options)


def start_live_run(
    target: Target,
    options: RunOptions,
    checkpoint: str | None,
    watermark: int | None = None,
    now_ms: int | None = None,
) -> Progress:
    """Open a live run, or find the one that belongs to a stream checkpoint.

    A new checkpoint counts its batches from 0 again, so it gets a run number
    of its own. The start watermark is the given one (0 takes everything), else
    the one that the newest live run saved, else lies shortly before the start
    of the historical phase. Settings are those of the run before.
    """
    saved_ms = now_millis() if now_ms is None else now_ms
    log = ProgressLog(target.spark, target.root)
    if checkpoint is not None:
        known = log.find((F.col("stage") == "live") & (F.col("checkpoint") == checkpoint))
        if known is not None:
            check_settings(known, options)
            return known
    last = log.find()
    state = last or Progress(
        started_ms=saved_ms, partitioning=options.partitioning, cast_strings=options.cast_strings
    )
    check_settings(state, options)
    start = watermark
    if start is None:
        live = log.find(F.col("stage") == "live")
        # A compacted target has the watermark of the one before in its only record.
        saved = live.watermark_ts if live is not None else state.watermark_ts or None
        before = (state.phase1_start_ts or saved_ms) - LIVE_START_MARGIN_MS
        start = before if saved is None else saved
    return log.save(
        replace(
            state,
            stage="live",
            run=log.last_run() + 1,
            step=0,
            phase="live_sync",
            watermark_ts=start,
            start_watermark_ts=start,
            checkpoint=checkpoint,
            saved_ms=saved_ms,
        )
    )


def apply_live_batch(
    rows: DataFrame,
    source: SourceTables,
    target: Target,
    options: RunOptions,
    run: int,
    number: int,
    now_ms: int | None = None,
    streamed: bool = False,
) -> Progress:
    """One live cycle: history, index, latest, then the watermark.

    A polled cycle sees the whole table again, so it takes what is above the
    watermark before batch ``number``, also when the batch is run again after
    its own watermark was saved: a repeated batch stores the same rows. A
    stream delivers each row once, so a ``streamed`` batch takes all that is
    above the watermark at which the run began, in whatever order it comes;
    with ``keep_late`` the rest is kept among the rejected rows. Entities and
    keys are read afresh, once a batch.
    """
    as_of = now_millis() if now_ms is None else now_ms
    log = ProgressLog(target.spark, target.root)
    mine = (F.col("stage") == "live") & (F.col("run") == run)
    before = log.find(mine & (F.col("step") == number))
    if before is None:
        raise LookupError(f"live run {run} has no record before batch {number}")
    check_settings(before, options)
    batch = Batch("live", run, number)
    dims = load_dimensions(source, keep=True)
    try:
        if streamed:
            start = before.start_watermark_ts
            if options.keep_late:
                late = F.when(F.col("ts") <= start, F.lit(LATE))
                shaped = shape_history(rows, dims, options)
                shaped = shaped.withColumn("reason", F.coalesce("reason", late))
            else:
                shaped = shape_history(changed_since(rows, start), dims, options)
        else:
            overlap = options.overlap_ms if number else 0
            changed = changed_since(rows, before.watermark_ts - overlap)
            shaped = shape_history(changed, dims, options)
        target.write_history(shaped, batch, options.partitioning)
    finally:
        dims.release()
    target.write_index(batch)
    target.write_latest(latest_from_history(target.written_history(batch)), batch)
    _, newest = target.written(batch)
    watermark = max(before.watermark_ts, before.watermark_ts if newest is None else newest)
    return log.save(
        before.next(watermark_ts=watermark, lag_ms=as_of - watermark, saved_ms=as_of)
    )


def replay_rejected(source: SourceTables, target: Target, options: RunOptions) -> int:
    """Take in rows that were rejected because their entity was unknown and is known now.

    Of several versions of a rejected row the one that came last is taken, and none where the table
    has the row already. They are a batch of their own, before any live batch that changes them later.
    Returns how many rows came in; run again, none do. Not to be run beside a batch.
    """
    log = ProgressLog(target.spark, target.root)
    state = log.find()
    if state is None:
        return 0
    check_settings(state, options)
    # Keys were rejected as text; those of a source with integer keys are ids.
    if not isinstance(source.history().schema["key"].dataType, T.StringType):
        options = options.override(hybrid_keys=True)
    dims = load_dimensions(source, keep=True)
    try:
        refused = target.refusals().filter(F.col("reason") == UNKNOWN_ENTITY)
        ids = dims.entities.selecting("entity_id")
        known = lookup_join(refused, ids, "entity_id", "left_semi", options)
        batch = Batch(REPLAY, state.run, target.next_batch(REPLAY))
        last = first_by(known, ["entity_id", "key", "ts"], VALUE_COLUMNS, write_sequence())
        rows = target.stage_replay(last, batch)
        touched = Dimension.measure(rows.select("entity_id").distinct())
        if not touched.rows:
            return 0
        shaped = shape_history(rows, dims, options)
        # Of the history, the rows of these entities only.
        there = lookup_join(target.history(), touched, "entity_id", "left_semi", options)
        missing = shaped.join(there.select(*HISTORY_KEY), HISTORY_KEY, "left_anti")
        target.write_replay(missing, rows, batch, options.partitioning)
        touched.release()
        return target.written(batch)[0]
    finally:
        dims.release()


def poll_live(
    source: SourceTables,
    target: Target,
    options: RunOptions,
    cycles: int,
    watermark: int | None = None,
    pause: bool = True,
) -> Progress:
    """Live cycles as batch jobs, for sources that cannot be streamed (JDBC)."""
    state = start_live_run(target, options, None, watermark)
    for number in range(cycles):
        if number and pause:
            time.sleep(options.live_sync_interval)
        state = apply_live_batch(source.history(), source, target, options, state.run, number)
    return state


def run_job(
    source: SourceTables,
    target: Target,
    options: RunOptions,
    historical_only: bool = False,
    resume: bool = False,
    cycles: int = 1,
) -> Progress:
    """The whole job: preload, historical phase, then live cycles."""
    state = run_historical(source, target, options, resume)
    return state if historical_only else poll_live(source, target, options, cycles)
