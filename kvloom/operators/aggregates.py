"""Counts, latest values, watermark and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvloom.model import LATEST_COLUMNS, LATEST_KEY, VALUE_COLUMNS, RunOptions
from kvloom.operators.enrich import with_entity_types
from kvloom.operators.joins import lookup_join
from kvloom.sources.dimensions import Dimension, Dimensions


def first_by(rows: DataFrame, key: list[str], values: list[str], order: Column) -> DataFrame:
    """Per key the values of the row that is highest in the given order.

    Values with texts are aggregated over sorted rows. A hash before the key makes nearly all
    comparisons of that sort one of two integers; ids often begin alike.
    """
    highest = F.max_by(F.struct(*values), order).alias("_row")
    grouped = rows.groupBy(F.xxhash64(*key).alias("_hash"), *key).agg(highest)
    return grouped.select(*key, "_row.*")


def latest_per_series(rows: DataFrame, series: list[str]) -> DataFrame:
    """The row with the highest ``ts`` of each series.

    Map tasks combine first, so a hot series sends one row per task.
    """
    return first_by(rows, series, ["ts", *VALUE_COLUMNS], F.col("ts"))


def latest_from_history(history: DataFrame) -> DataFrame:
    """``ts_kv_latest_cf`` rows out of ``ts_kv_cf`` rows."""
    return latest_per_series(history, LATEST_KEY).select(*LATEST_COLUMNS)


def source_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("row_count"))


def preload_summary(rows: DataFrame, dims: Dimensions) -> DataFrame:
    """Entities, keys and source rows known before the historical phase."""
    return rows.agg(
        F.lit(dims.entities.rows).cast("long").alias("entity_count"),
        F.lit(dims.keys.rows).cast("long").alias("key_count"),
        F.count("*").alias("row_count"),
    )


def skipped_counts(rejected: DataFrame) -> DataFrame:
    """How many entities and rows were left out, by reason."""
    per_entity = rejected.groupBy("reason", "entity_id").agg(F.count("*").alias("n"))
    return per_entity.groupBy("reason").agg(
        F.count("*").alias("skipped_entities"), F.sum("n").alias("skipped_rows")
    )


def migrated_counts(history: DataFrame) -> DataFrame:
    """Target rows and series per entity type."""
    per_series = history.groupBy(*LATEST_KEY).agg(F.count("*").alias("n"))
    per_entity = per_series.groupBy("entity_type", "entity_id").agg(
        F.count("*").alias("s"), F.sum("n").alias("n")
    )
    return per_entity.groupBy("entity_type").agg(
        F.count("*").alias("entities"),
        F.sum("s").alias("series"),
        F.sum("n").alias("migrated_rows"),
    )


def pending_entities(
    entities: DataFrame, completed: Dimension, options: RunOptions
) -> DataFrame:
    """Entities that no earlier run has completed."""
    return lookup_join(entities, completed, "entity_id", "left_anti", options)


def entity_progress(
    entities: DataFrame, completed: Dimension, options: RunOptions
) -> DataFrame:
    """How many of the given entities are there, pending and done."""
    flagged = completed.selecting("entity_id", F.lit(True).alias("_done"))
    return lookup_join(entities, flagged, "entity_id", "left", options).agg(
        F.count("*").alias("total_entities"),
        F.count_if(F.col("_done").isNull()).alias("pending_entities"),
        F.count_if(F.col("_done").isNotNull()).alias("done_entities"),
    )


def advance_watermark(
    rows: DataFrame, dims: Dimensions, options: RunOptions, watermark: int
) -> DataFrame:
    """The watermark after a cycle over ``rows``; never lower than before.

    Rows of unknown entities do not move it.
    """
    known = with_entity_types(rows.select("entity_id", "ts"), dims, options).filter(
        F.col("reason").isNull()
    )
    start = F.lit(watermark).cast("long")
    return known.agg(F.greatest(start, F.max("ts")).alias("watermark_ts"))


def lag_report(watermark: DataFrame, as_of: int, options: RunOptions) -> DataFrame:
    """Distance of the watermark from ``as_of``, and whether that is near enough."""
    lag = F.lit(as_of).cast("long") - F.col("watermark_ts")
    return watermark.select(
        "watermark_ts",
        F.lit(as_of).cast("long").alias("as_of_ts"),
        lag.alias("lag_ms"),
        (lag < F.lit(options.lag_threshold_ms)).alias("ready"),
    )
