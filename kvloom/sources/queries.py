"""Queries on the source tables.

Filters compare stored columns with literals, so they reach the scan. Pages
are key ranges with a row limit, which Spark plans as a top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvloom.model import RunOptions, entity_literal
from kvloom.operators.joins import lookup_join
from kvloom.sources.dimensions import Dimension
from kvloom.sources.tables import SourceTables


def has_rows(source: SourceTables, table: str) -> bool:
    """Whether the table exists and has a row."""
    found = source.find(table)
    return found is not None and not found.isEmpty()


def distinct_entities(source: SourceTables) -> DataFrame:
    """Entities of ``ts_kv_latest``, or of ``ts_kv`` where that has no rows.

    Reads the smaller table. An entity that is missing there is not listed;
    jobs that must see all entities read ``ts_kv``.
    """
    rows = source.latest() if has_rows(source, "ts_kv_latest") else source.history()
    return rows.select("entity_id").distinct()


def entity_keys(latest: DataFrame) -> DataFrame:
    """Every (entity_id, key) pair, the key as text."""
    return latest.select("entity_id", F.col("key").cast("string").alias("key")).distinct()


def keys_of_entity(latest: DataFrame, entity_id: str) -> DataFrame:
    """Distinct keys of one entity, as text."""
    wanted = F.col("entity_id") == entity_literal(entity_id)
    return latest.filter(wanted).select(F.col("key").cast("string").alias("key")).distinct()


def entity_page(
    rows: DataFrame,
    entity_id: str,
    options: RunOptions,
    after: tuple | None = None,
    min_ts: int | None = None,
) -> DataFrame:
    """One page of an entity's rows in (key, ts) order, after a (key, ts) pair."""
    page = rows.filter(F.col("entity_id") == entity_literal(entity_id))
    if after is not None:
        key, ts = after
        page = page.filter((F.col("key") > key) | ((F.col("key") == key) & (F.col("ts") > ts)))
    if min_ts is not None:
        page = page.filter(F.col("ts") > min_ts)
    return page.orderBy("key", "ts").limit(options.batch_size)


def entity_key_page(
    rows: DataFrame, entity_id: str, key, options: RunOptions, after_ts: int | None = None
) -> DataFrame:
    """One page of one series in ts order, after a ts."""
    page = rows.filter((F.col("entity_id") == entity_literal(entity_id)) & (F.col("key") == key))
    if after_ts is not None:
        page = page.filter(F.col("ts") > after_ts)
    return page.orderBy("ts").limit(options.batch_size)


def entity_page_by_ts(
    rows: DataFrame, entity_id: str, after_ts: int, options: RunOptions
) -> DataFrame:
    """One page of an entity's rows of all keys in ts order, after a ts."""
    wanted = (F.col("entity_id") == entity_literal(entity_id)) & (F.col("ts") > after_ts)
    return rows.filter(wanted).orderBy("ts", "key").limit(options.batch_size)


def changed_since(rows: DataFrame, watermark: int) -> DataFrame:
    """All rows with a ts above the watermark."""
    return rows.filter(F.col("ts") > watermark)


def changed_page(
    rows: DataFrame, watermark: int, options: RunOptions, after: tuple | None = None
) -> DataFrame:
    """One page of the changed rows in (ts, entity_id, key) order.

    ``after`` is the (ts, entity_id, key) of the last row of the page before;
    rows that share its ts are not skipped.
    """
    page = changed_since(rows, watermark)
    if after is not None:
        ts, entity_id, key = after
        page = page.filter(
            (F.col("ts") > ts)
            | ((F.col("ts") == ts) & (F.col("entity_id") > entity_id))
            | ((F.col("ts") == ts) & (F.col("entity_id") == entity_id) & (F.col("key") > key))
        ).filter(F.col("ts") >= ts)
    return page.orderBy("ts", "entity_id", "key").limit(options.batch_size)


def entities_after(rows: DataFrame, entity_id: str) -> DataFrame:
    """Distinct entities above an id, in order."""
    after = F.col("entity_id") > entity_literal(entity_id)
    return rows.filter(after).select("entity_id").distinct().orderBy("entity_id")


def latest_for_entities(latest: DataFrame, entities: DataFrame, options: RunOptions) -> DataFrame:
    """The ``ts_kv_latest`` rows of a set of entities."""
    ids = Dimension.measure(entities.select("entity_id").distinct())
    return lookup_join(latest, ids, "entity_id", "left_semi", options)
