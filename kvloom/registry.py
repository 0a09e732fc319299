"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom import fixtures as fx
from kvloom.functions import (
    bucket_start,
    canonical_uuid,
    is_time_uuid,
    ntz_to_millis,
    retype_strings,
)
from kvloom.model import HISTORY_COLUMNS, SOURCE_COLUMNS, STRATEGIES, RunOptions
from kvloom.operators import aggregates as agg
from kvloom.operators import bitmaps, enrich
from kvloom.plans import jobs
from kvloom.plans.progress import ProgressLog, status_report
from kvloom.plans.target import HISTORY, INDEX, LATEST, Batch, Target
from kvloom.scratch import scratch_folder
from kvloom.sources import Dimension, ParquetSource, entity_map, key_map, load_dimensions
from kvloom.sources import queries as sq
from kvloom.sources.clustered import store_clustered
from kvloom.streaming.cursor import cursor_stream
from kvloom.streaming.latest import ROCKS_DB, start_latest
from kvloom.streaming.live import start_live

Query = Callable[[SparkSession, str], DataFrame]
_OPTIONS = RunOptions()
_MIDDLE = 1_705_276_800_000  # 2024-01-15 UTC


def _bucket(strategy: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fx.ts_kv(spark, sf_dir)
        return rows.select("entity_id", "key", "ts", bucket_start("ts", strategy).alias("partition"))

    return query


def bucket_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All strategies over dates that span several years."""
    orders = fx.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", ntz_to_millis(F.col("o_orderdate")).alias("ts")
    )
    return orders.select("*", *[bucket_start("ts", s).alias(s.lower()) for s in STRATEGIES])


def canonical_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = fx.ts_kv(spark, sf_dir).select(F.upper("entity_id").alias("given")).distinct()
    with_id = given.withColumn("entity_id", canonical_uuid(F.concat(F.lit("{"), "given", F.lit("}"))))
    return with_id.withColumn("time_based", is_time_uuid(F.col("entity_id")))


def _source(spark: SparkSession, sf_dir: str, *absent: str):
    return fx.telemetry_source(spark, sf_dir, absent)


def _on_history(make: Callable) -> Query:
    """A query over source rows and lookup tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = _source(spark, sf_dir)
        return make(source.history(), load_dimensions(source))

    return query


def _history_with(**given) -> Query:
    options = _OPTIONS.override(**given)
    return _on_history(lambda rows, dims: enrich.history_rows(rows, dims, options))


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, sf_dir)
    return enrich.latest_rows(source.latest(), load_dimensions(source), _OPTIONS)


def key_names_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, sf_dir, "key_dictionary", "ts_kv_dictionary")
    return enrich.with_key_names(source.history(), load_dimensions(source), _OPTIONS)


def latest_for_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, sf_dir)
    touched = sq.changed_since(source.history(), fx.START_WATERMARK)
    return sq.latest_for_entities(source.latest(), touched, _OPTIONS)


def _on_completed(make: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        completed = Dimension.measure(fx.completed_entities(spark, sf_dir))
        entities = fx.ts_kv(spark, sf_dir).select("entity_id").distinct()
        return make(entities, completed, _OPTIONS)

    return query


def _stored_by_entity(read: Callable) -> Query:
    """A query over the source rows when they are stored for access by entity."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_folder(spark, "clustered")
        store_clustered(fx.ts_kv(spark, sf_dir), f"{folder}/ts_kv", _OPTIONS.override(rows_per_file=300))
        return read(ParquetSource(spark, folder).history())

    return query


def entity_progress_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of three slices of the completed rows, out of all entities of the source."""
    rows = fx.ts_kv(spark, sf_dir)
    ordinals = Dimension.measure(bitmaps.entity_ordinals(rows))
    done = rows.join(fx.completed_entities(spark, sf_dir), "entity_id", "left_semi")
    parts = [done.filter(F.pmod("ts", F.lit(3)) == n) for n in range(3)]
    found = [bitmaps.slice_bitmaps(part, ordinals, _OPTIONS) for part in parts]
    return bitmaps.progress_of(reduce(DataFrame.union, found), ordinals.rows)


def _watermark(rows: DataFrame, dims) -> DataFrame:
    changed = sq.changed_since(rows, fx.START_WATERMARK)
    return agg.advance_watermark(changed, dims, _OPTIONS, fx.START_WATERMARK)


# -- jobs and streams: write the tables, then read them --------------------------


def _job(read: Callable, **given) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = Target(spark, scratch_folder(spark, "job"))
        options = _OPTIONS.override(slices=2, **given)
        jobs.run_historical(_source(spark, sf_dir), target, options)
        return read(target)

    return query


def _live(read: Callable, newer_first: bool = False, watermark: int = fx.START_WATERMARK) -> Query:
    """Two landings of the source rows after the start watermark, streamed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = _source(spark, sf_dir)
        folder = scratch_folder(spark, "live")
        target = Target(spark, f"{folder}/target")
        landing = f"{folder}/landing"
        rows = source.history()
        late = F.col("ts") > fx.SECOND_LANDING
        parts = [rows.filter(~late), rows.filter(late)]
        for part in reversed(parts) if newer_first else parts:
            part.write.mode("append").parquet(landing)
            stream = spark.readStream.schema(rows.schema).parquet(landing)
            start_live(
                stream,
                source,
                target,
                _OPTIONS,
                f"{folder}/checkpoint",
                watermark=watermark,
                available_now=True,
                now_ms=fx.AS_OF,
            ).awaitTermination()
        return read(target)

    return query


def live_from_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after the start watermark from a table that is asked by cursor, in two landings."""
    source = _source(spark, sf_dir)
    folder = scratch_folder(spark, "cursor")
    target = Target(spark, f"{folder}/target")
    rows = source.history()
    late = F.col("ts") > fx.SECOND_LANDING
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(f"{folder}/rows")
        stream = cursor_stream(spark, f"{folder}/rows", start_ts=fx.START_WATERMARK)
        start_live(
            stream,
            source,
            target,
            _OPTIONS,
            f"{folder}/checkpoint",
            watermark=fx.START_WATERMARK,
            available_now=True,
            now_ms=fx.AS_OF,
        ).awaitTermination()
    return target.history()


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest rows after the start watermark, kept as state; the later landing comes first."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    source = _source(spark, sf_dir)
    folder = scratch_folder(spark, "state")
    target = Target(spark, f"{folder}/target")
    rows = source.history()
    late = F.col("ts") > fx.SECOND_LANDING
    for part in (rows.filter(late), rows.filter(~late)):
        part.write.mode("append").parquet(f"{folder}/landing")
        start_latest(
            session.readStream.schema(rows.schema).parquet(f"{folder}/landing"),
            source,
            target,
            _OPTIONS,
            f"{folder}/checkpoint",
            watermark=fx.START_WATERMARK,
            available_now=True,
            now_ms=fx.AS_OF,
        ).awaitTermination()
    return target.latest()


def _marked(rows: DataFrame, which, mark: str = "!") -> DataFrame:
    """The rows with other values than before where the condition holds."""
    newer = F.concat(F.coalesce("str_v", F.lit("")), F.lit(mark))
    return rows.withColumn("str_v", F.when(which, newer).otherwise(F.col("str_v")))


def _changed(source):
    """The source whose rows above the start watermark have other values than before."""
    return source.replacing(ts_kv=_marked(source.history(), F.col("ts") > fx.START_WATERMARK))


def _replayed(target: Target, source) -> None:
    """History, then the changed live part twice, the second time over the first."""
    jobs.run_historical(source, target, _OPTIONS, now_ms=fx.PHASE1_START)
    run = jobs.start_live_run(target, _OPTIONS, None, fx.START_WATERMARK, now_ms=fx.AS_OF).run
    later = _changed(source)
    for number in (0, 0):
        jobs.apply_live_batch(later.history(), later, target, _OPTIONS, run, number, fx.AS_OF)


def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = Target(spark, scratch_folder(spark, "replay"))
    _replayed(target, _source(spark, sf_dir))
    return target.history()


def late_upsert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of several months, then live rows that change those of the oldest month only."""
    source = _source(spark, sf_dir)
    spread = source.history().withColumn("ts", F.col("ts") - (F.col("key") - 1) * fx.MONTHS_APART)
    source = source.replacing(ts_kv=spread)
    target = Target(spark, scratch_folder(spark, "late"))
    jobs.run_historical(source, target, _OPTIONS, now_ms=fx.PHASE1_START)
    run = jobs.start_live_run(target, _OPTIONS, None, 0, now_ms=fx.AS_OF).run
    late = _marked(spread.filter(F.col("key") == fx.OTHER_KEY), F.lit(True))
    jobs.apply_live_batch(late, source, target, _OPTIONS, run, 0, fx.AS_OF)
    return target.history()


def _in_levels(read: Callable) -> Query:
    """History, three live batches, a compaction of what they crowd, and another live batch."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = _source(spark, sf_dir)
        target = Target(spark, scratch_folder(spark, "levels"))
        jobs.run_historical(source, target, _OPTIONS, now_ms=fx.PHASE1_START)
        run = jobs.start_live_run(target, _OPTIONS, None, fx.START_WATERMARK, now_ms=fx.AS_OF).run
        rows = source.history()
        for number in range(3):
            part = _marked(rows.filter(F.pmod("ts", F.lit(3)) == number), F.lit(True))
            jobs.apply_live_batch(part, source, target, _OPTIONS, run, number, fx.AS_OF, streamed=True)
        target.compact_crowded(_OPTIONS, most_live=2)
        last = _marked(rows.filter(F.col("ts") > fx.SECOND_LANDING), F.lit(True), "?")
        jobs.apply_live_batch(last, source, target, _OPTIONS, run, 3, fx.AS_OF, streamed=True)
        return read(target)

    return query


def _compacted(read: Callable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch_folder(spark, "compact")
        target = Target(spark, f"{folder}/before")
        _replayed(target, _source(spark, sf_dir))
        compacted = Target(spark, f"{folder}/after")
        target.compact(compacted, _OPTIONS, 1)
        return read(compacted)

    return query


def report_of_a_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status report of a run that took a fixed time."""
    target = Target(spark, scratch_folder(spark, "job"))
    state = jobs.run_historical(_source(spark, sf_dir), target, _OPTIONS, now_ms=fx.PHASE1_START)
    log = ProgressLog(spark, target.root)
    log.save(state.next(saved_ms=fx.PHASE1_START + 1000 * fx.JOB_SECONDS))
    return status_report(log.table())


def job_latest_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest table of a source without ``ts_kv_latest``."""
    target = Target(spark, scratch_folder(spark, "job"))
    source = _source(spark, sf_dir).replacing(ts_kv_latest=None)
    jobs.run_historical(source, target, _OPTIONS)
    return target.latest()


def resume_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a resumed run adds to one that has completed some entities."""
    target = Target(spark, scratch_folder(spark, "resume"))
    source = _source(spark, sf_dir)
    before = fx.only_completed(source, fx.completed_entities(spark, sf_dir))
    jobs.run_historical(before, target, _OPTIONS)
    state = jobs.run_historical(source, target, _OPTIONS, resume=True)
    return target.written_history(Batch("history", state.run, state.slices[-1].slice))


def _replayed_rejects(read: Callable) -> Query:
    """A run without the asset table, then its rejects again, twice, when the assets are there."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = Target(spark, scratch_folder(spark, "rejects"))
        jobs.run_historical(_source(spark, sf_dir, "asset"), target, _OPTIONS)
        for _ in range(2):
            jobs.replay_rejected(_source(spark, sf_dir), target, _OPTIONS)
        return read(target)

    return query


class _Stopping(Target):
    """A target at which a run stops in the middle of its slices."""

    def write_index(self, batch: Batch) -> None:
        if batch.batch == 2:
            raise InterruptedError
        super().write_index(batch)


def resume_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run sliced by entity that stops in its third slice and goes on from what it staged."""
    folder = scratch_folder(spark, "by_entity")
    source = _source(spark, sf_dir)
    options = _OPTIONS.override(slices=4, slice_by="entity")
    try:
        jobs.run_historical(source, _Stopping(spark, folder), options)
    except InterruptedError:
        # The source has no rows any more: what follows is read from the staging table.
        empty = source.replacing(ts_kv=source.history().limit(0))
        jobs.run_historical(empty, Target(spark, folder), options, resume=True)
    return Target(spark, folder).history()


def key_names_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of text keys, some of which are ids."""
    source = _source(spark, sf_dir)
    rows = fx.with_text_keys(source.history())
    return enrich.with_key_names(rows, load_dimensions(source), _OPTIONS)


def _target_columns(target: Target) -> DataFrame:
    """How many rows of ``ts_kv_cf`` have a value, column by column."""
    filled = target.history().agg(*[F.count(c).alias(c) for c in HISTORY_COLUMNS])
    return filled.unpivot([], HISTORY_COLUMNS, "column_name", "filled").select(
        F.lit("ts_kv_cf").alias("table_name"), "column_name", "filled"
    )


def target_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and columns of the target, with the rows that a job left in each table."""
    target = Target(spark, scratch_folder(spark, "schema"))
    report = target.init_schema()
    jobs.run_historical(_source(spark, sf_dir), target, _OPTIONS)
    views = {HISTORY: target.history(), INDEX: target.partition_index(), LATEST: target.latest()}
    counts = [
        rows.agg(F.lit(table).alias("table_name"), F.count("*").alias("stored_rows"))
        for table, rows in views.items()
    ]
    return report.join(reduce(DataFrame.union, counts), "table_name")


def registered() -> dict[str, Query]:
    entity = fx.SAMPLE_ENTITY
    rows = fx.ts_kv
    return {
        "entity_map": lambda s, d: entity_map(_source(s, d)),
        "key_map": lambda s, d: key_map(_source(s, d)),
        "key_map_fallback": lambda s, d: key_map(_source(s, d, "key_dictionary")),
        "preload_summary": _on_history(agg.preload_summary),
        "source_count": lambda s, d: agg.source_count(rows(s, d)),
        "history_scan": lambda s, d: _source(s, d).history(),
        "latest_scan": lambda s, d: _source(s, d).latest(),
        "distinct_entities": lambda s, d: sq.distinct_entities(_source(s, d)),
        "distinct_entities_fallback": lambda s, d: sq.distinct_entities(
            _source(s, d, "ts_kv_latest")
        ),
        "entity_keys": lambda s, d: sq.entity_keys(_source(s, d).latest()),
        "keys_of_entity": lambda s, d: sq.keys_of_entity(_source(s, d).latest(), entity),
        "entity_page": lambda s, d: sq.entity_page(
            rows(s, d), entity, _OPTIONS, after=(2, _MIDDLE)
        ),
        "entity_page_min_ts": lambda s, d: sq.entity_page(
            rows(s, d), entity, _OPTIONS, min_ts=_MIDDLE
        ),
        "entity_page_by_ts": lambda s, d: sq.entity_page_by_ts(
            rows(s, d), entity, _MIDDLE, _OPTIONS
        ),
        "entity_key_page": lambda s, d: sq.entity_key_page(
            rows(s, d), entity, 1, _OPTIONS, _MIDDLE
        ),
        "changed_since": lambda s, d: sq.changed_since(rows(s, d), fx.START_WATERMARK),
        "changed_page": lambda s, d: sq.changed_page(
            rows(s, d), fx.START_WATERMARK, _OPTIONS, after=(_MIDDLE + 500_000_000, entity, 2)
        ),
        # Page sizes that cut at every size of the test tables.
        "changed_page_cut": lambda s, d: sq.changed_page(
            rows(s, d), fx.START_WATERMARK, _OPTIONS.override(batch_size=100), after=(_MIDDLE, entity, 2)
        ),
        "entity_page_cut": lambda s, d: sq.entity_page(
            rows(s, d), entity, _OPTIONS.override(batch_size=20), after=(1, _MIDDLE)
        ),
        "stored_entity_page": _stored_by_entity(
            lambda r: sq.entity_page(r, entity, _OPTIONS, after=(2, _MIDDLE))
        ),
        "stored_entity_key_page": _stored_by_entity(
            lambda r: sq.entity_key_page(r, entity, 1, _OPTIONS, _MIDDLE)
        ),
        "stored_entities_after": _stored_by_entity(lambda r: sq.entities_after(r, entity)),
        "entities_after": lambda s, d: sq.entities_after(rows(s, d), entity),
        "latest_for_entities": latest_for_entities,
        **{f"bucket_{s.lower()}": _bucket(s) for s in STRATEGIES},
        "bucket_orders": bucket_orders,
        "cast_strings": lambda s, d: retype_strings(rows(s, d)).select(*SOURCE_COLUMNS),
        "key_names_dictionary": _on_history(
            lambda r, dims: enrich.with_key_names(r, dims, _OPTIONS)
        ),
        "key_names_raw": key_names_raw,
        "key_names_hybrid": key_names_hybrid,
        "canonical_ids": canonical_ids,
        "history_rows": _history_with(),
        "history_rows_large_lookup": _history_with(broadcast_max_rows=0, broadcast_max_bytes=0),
        "history_rows_days": _history_with(partitioning="DAYS"),
        "history_rows_cast": _history_with(cast_strings=True),
        "partition_index": _on_history(
            lambda r, dims: enrich.index_rows(enrich.history_rows(r, dims, _OPTIONS))
        ),
        "partition_index_hours": _on_history(
            lambda r, dims: enrich.index_rows(
                enrich.history_rows(r, dims, _OPTIONS.override(partitioning="HOURS"))
            )
        ),
        "latest_rows": latest_rows,
        "latest_from_history": _on_history(
            lambda r, dims: agg.latest_from_history(enrich.history_rows(r, dims, _OPTIONS))
        ),
        "rejected_rows": _on_history(lambda r, dims: enrich.rejected_rows(r, dims, _OPTIONS)),
        "skipped_counts": _on_history(
            lambda r, dims: agg.skipped_counts(enrich.rejected_rows(r, dims, _OPTIONS))
        ),
        "pending_entities": _on_completed(agg.pending_entities),
        "entity_progress": _on_completed(agg.entity_progress),
        "entity_progress_bitmaps": entity_progress_bitmaps,
        "migrated_counts": _on_history(
            lambda r, dims: agg.migrated_counts(enrich.history_rows(r, dims, _OPTIONS))
        ),
        "watermark_advance": _on_history(_watermark),
        "lag_report": _on_history(
            lambda r, dims: agg.lag_report(_watermark(r, dims), fx.AS_OF, _OPTIONS)
        ),
        "sync_once": _on_history(
            lambda r, dims: jobs.sync_once(r, dims, _OPTIONS, fx.START_WATERMARK)
        ),
        "live_history": _live(Target.history),
        "live_latest": _live(Target.latest),
        "live_index": _live(Target.partition_index),
        "job_history": _job(Target.history),
        "job_index": _job(Target.partition_index),
        "job_latest": _job(Target.latest),
        "job_rejected": _job(Target.rejected),
        "job_rejected_cast": _job(Target.rejected, cast_strings=True),
        "job_latest_from_history": job_latest_from_history,
        "live_out_of_order": _live(Target.history, newer_first=True),
        "live_out_of_order_latest": _live(Target.latest, newer_first=True),
        "live_from_cursor": live_from_cursor,
        "stream_latest_state": stream_latest_state,
        "live_from_zero": _live(Target.history, watermark=0),
        "upsert_replay": upsert_replay,
        "late_upsert_history": late_upsert_history,
        "compacted_levels": _in_levels(Target.history),
        "compacted_levels_latest": _in_levels(Target.latest),
        "compacted_levels_index": _in_levels(Target.partition_index),
        "compacted_history": _compacted(Target.history),
        "compacted_rejected": _compacted(Target.rejected),
        "rejected_replay": _replayed_rejects(Target.history),
        "rejected_replay_latest": _replayed_rejects(Target.latest),
        "rejected_replay_left": _replayed_rejects(Target.rejected),
        "resume_history": resume_history,
        "resume_by_entity": resume_by_entity,
        "target_schema": target_schema,
        "target_columns": _job(_target_columns),
        "status_report": report_of_a_job,
    }
