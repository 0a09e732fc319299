"""Source rows to target rows: names, types, buckets, rejects."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.functions import (
    bucket_start,
    is_canonical,
    is_time_uuid,
    key_id_of,
    lookup_uuid,
    retype_strings,
)
from kvloom.model import (
    BAD_TS,
    BAD_UUID,
    HISTORY_COLUMNS,
    INDEX_COLUMNS,
    LATEST_COLUMNS,
    SOURCE_COLUMNS,
    UNKNOWN_ENTITY,
    RunOptions,
)
from kvloom.operators.joins import lookup_join
from kvloom.sources.dimensions import Dimension, Dimensions

_RAW_KEY = "_raw_key"
_KEY_ID = "_key_id"
_GIVEN_ID = "_given_id"
_GIVEN_KEY = "_given_key"
_GIVEN_TEXT = "_given_text"


def with_key_names(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """Replace ``key`` by the key's name; a key without a name is its own name.

    With ``hybrid_keys`` a text key that reads like an integer is looked up as
    the id that it reads like, one row at a time: a column may hold ids and
    names side by side. Without, text keys are names.
    """
    text = isinstance(rows.schema["key"].dataType, T.StringType)
    if not dims.keys.rows or (text and not options.hybrid_keys):
        return rows.withColumn("key", F.col("key").cast("string"))
    if text:
        return _hybrid_key_names(rows, dims, options)
    names = dims.keys.selecting("key_id", F.col("key").alias("_name"))
    named = lookup_join(rows.withColumnRenamed("key", "key_id"), names, "key_id", "left", options)
    name = F.coalesce(F.col("_name"), F.col("key_id").cast("string"))
    columns = [name.alias("key") if c == "key" else c for c in rows.columns]
    if not dims.shared_names.rows:
        return named.select(*columns)
    raw_id = F.col("key_id").alias(_RAW_KEY)
    return _one_key_per_name(named.select(*columns, raw_id), dims.shared_names, options)


def _hybrid_key_names(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """Names of text keys. Of rows that end up with one name and share entity
    and ts, the one that came by id goes before the one that came by name."""
    names = dims.keys.selecting(F.col("key_id").alias(_KEY_ID), F.col("key").alias("_name"))
    raw = F.col("key")
    found = lookup_join(rows.withColumn(_KEY_ID, key_id_of(raw)), names, _KEY_ID, "left", options)
    name = F.coalesce(F.col("_name"), raw)
    # Which names come in several spellings: one pass over the keys, added up before the shuffle.
    forms = lookup_join(
        rows.select("key").distinct().withColumn(_KEY_ID, key_id_of(raw)), names, _KEY_ID, "left", options
    )
    several = forms.groupBy(name.alias("key")).count().filter("count > 1").select("key")
    shared = replace(Dimension.measure(several), held=dims.keys.held)
    columns = [name.alias("key") if c == "key" else F.col(c) for c in rows.columns]
    if not shared.rows:
        return found.select(*columns)
    order = F.struct(F.col(_KEY_ID).isNotNull(), F.col(_KEY_ID), raw).alias(_RAW_KEY)
    return _one_key_per_name(found.select(*columns, order), shared, options)


def _one_key_per_name(rows: DataFrame, names: Dimension, options: RunOptions) -> DataFrame:
    """Of rows that collide on a shared name keep the one of the highest key id.

    Only the rows under shared names are shuffled. Rejected rows reach no target
    table, so none of them takes another's place.
    """
    good = F.col("reason").isNull() if "reason" in rows.columns else F.lit(True)
    shared = lookup_join(rows, names, "key", "left_semi", options)
    order = Window.partitionBy("entity_id", "key", "ts").orderBy(F.col(_RAW_KEY).desc())
    kept = shared.filter(good).withColumn("_rank", F.row_number().over(order))
    kept = kept.filter("_rank = 1").drop("_rank")
    rest = lookup_join(rows, names, "key", "left_anti", options)
    out = rest.unionByName(kept)
    if "reason" in rows.columns:
        out = out.unionByName(shared.filter(~good))
    return out.drop(_RAW_KEY)


def with_entity_types(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """Add ``entity_type`` and ``reason``.

    Ids become canonical text; a row whose id is malformed or unknown keeps the
    given id and gets a reason.
    """
    given = F.col("entity_id").cast("string")
    keyed = rows.withColumns({"entity_id": lookup_uuid(given), _GIVEN_ID: given})
    typed = lookup_join(keyed, dims.entities, "entity_id", "left", options)
    # The pattern is matched for the rows without a type only.
    known_form = F.coalesce(is_canonical(F.col("entity_id")), F.lit(False))
    reason = F.when(
        F.col("entity_type").isNull(), F.when(known_form, UNKNOWN_ENTITY).otherwise(BAD_UUID)
    )
    if options.time_uuid_only:
        reason = F.when(~is_time_uuid(F.col("entity_id")), BAD_UUID).otherwise(reason)
    return (
        typed.withColumn("reason", reason)
        .withColumn(
            "entity_id",
            F.when(F.col("reason") == BAD_UUID, F.col(_GIVEN_ID)).otherwise(F.col("entity_id")),
        )
        .drop(_GIVEN_ID)
    )


def shape_history(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """All source rows in the shape of ``ts_kv_cf``, plus ``reason``.

    ``reason`` is null for the rows that belong to the target and names the
    fault of the others, so one pass over the source serves both. Rejected rows
    keep key and values as they came.
    """
    rows = with_entity_types(rows, dims, options)
    rows = rows.withColumn("partition", bucket_start("ts", options.partitioning))
    outside = F.when(F.col("partition").isNull() | F.col("ts").isNull(), BAD_TS)
    rows = rows.withColumns(
        {"reason": F.coalesce("reason", outside), _GIVEN_KEY: F.col("key").cast("string")}
    )
    accepted = F.col("reason").isNull()
    rows = with_key_names(rows, dims, options)
    rows = rows.withColumn("key", F.when(accepted, F.col("key")).otherwise(F.col(_GIVEN_KEY)))
    if options.cast_strings:
        held = rows.withColumns(
            {_GIVEN_TEXT: F.when(~accepted, F.col("str_v")), "str_v": F.when(accepted, F.col("str_v"))}
        )
        rows = retype_strings(held).withColumn("str_v", F.coalesce("str_v", _GIVEN_TEXT))
    return rows.select(*HISTORY_COLUMNS, "reason")


def history_rows(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """The rows of ``ts_kv_cf``."""
    shaped = shape_history(rows, dims, options)
    return shaped.filter(F.col("reason").isNull()).drop("reason")


def latest_rows(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """The rows of ``ts_kv_latest_cf``."""
    rows = with_entity_types(with_key_names(rows, dims, options), dims, options)
    if options.cast_strings:
        rows = retype_strings(rows)
    return rows.filter(F.col("reason").isNull()).select(*LATEST_COLUMNS)


def index_rows(history: DataFrame) -> DataFrame:
    """The rows of ``ts_kv_partitions_cf``: which buckets a series has."""
    return history.select(*INDEX_COLUMNS).distinct()


def rejected_rows(rows: DataFrame, dims: Dimensions, options: RunOptions) -> DataFrame:
    """Source rows that reach no target table, as they came, with the reason."""
    typed = with_entity_types(rows, dims, options)
    if options.partitioning == "INDEFINITE":
        outside = F.when(F.col("ts").isNull(), BAD_TS)
    else:
        outside = F.when(bucket_start("ts", options.partitioning).isNull(), BAD_TS)
    return (
        typed.withColumn("reason", F.coalesce("reason", outside))
        .filter(F.col("reason").isNotNull())
        .select(*SOURCE_COLUMNS, "reason")
    )
