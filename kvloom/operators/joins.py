"""Joins of a large table with a lookup table of measured size."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.model import RunOptions
from kvloom.sources.dimensions import Dimension

# Largest share of a lookup table that one task may hold as a hash table.
MAX_HASH_TABLE_BYTES = 64 << 20
_SALT = "_salt"
_PARTS = "_parts"


def lookup_join(
    rows: DataFrame, lookup: Dimension, on: str, how: str, options: RunOptions
) -> DataFrame:
    """Equi-join ``rows`` with a lookup table that is unique on ``on``.

    ``how`` is one of inner, left, left_semi and left_anti. Three ways, by
    measured sizes:

    * the lookup table is within the broadcast bounds: broadcast it, the rows
      stay where they are;
    * the keys that occur in the rows are within the bounds, as in a small
      batch: filter the lookup table by them and broadcast what is left, if
      that is within the bounds, too;
    * neither: shuffle both sides, the rows of hot keys over several tasks.

    In the second way the keys are held on the executors until the lookup table
    is released.
    """
    if lookup.fits_broadcast(options):
        return rows.join(F.broadcast(lookup.df), on, how)
    # One pass over the rows tells which keys occur and how often.
    counts = key_counts(rows, on).persist(StorageLevel.DISK_ONLY)
    needed = False
    try:
        present = counts.select(on)
        keys = Dimension.measure(present)
        if keys.fits_broadcast(options):
            used = Dimension.measure(lookup.df.join(F.broadcast(present), on, "left_semi"))
            if used.fits_broadcast(options):
                needed = True
                lookup.held.append(counts)
                return rows.join(F.broadcast(used.df), on, how)
        return spread_join(rows, lookup, on, how, counts)
    finally:
        if not needed:
            counts.unpersist()


def key_counts(rows: DataFrame, on: str) -> DataFrame:
    """Rows of each key; they are added up before the shuffle."""
    return rows.filter(F.col(on).isNotNull()).groupBy(on).count()


def hot_keys(
    rows: DataFrame, on: str, counts: DataFrame | None = None
) -> list[tuple[object, int]]:
    """Keys that alone exceed one task's share of the rows, with the number of
    shares they fill.

    With n tasks a key is hot if it holds more than one n-th of the rows with a
    key, so there are fewer than n of them.
    """
    counts = key_counts(rows, on) if counts is None else counts
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    share = max(total / tasks, 1.0)
    found = counts.filter(F.col("count") > F.lit(share)).collect()
    return [(r[on], math.ceil(r["count"] / share)) for r in found]


def spread_join(
    rows: DataFrame, lookup: Dimension, on: str, how: str, counts: DataFrame | None = None
) -> DataFrame:
    """Shuffle join that splits hot keys.

    A hot key is split into as many parts as it fills tasks' shares on the side
    of the rows, and repeated that often on the side of the lookup table. The
    repeats are at most twice the task count. Rows without a key are spread,
    too: they match nothing.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A hash table per task spares sorting the rows; it must fit the task, so
    # above that bound Spark sorts and merges.
    hint = "shuffle_hash" if lookup.bytes / tasks <= MAX_HASH_TABLE_BYTES else "merge"
    hot = hot_keys(rows, on, counts)
    schema = T.StructType(
        [T.StructField(on, rows.schema[on].dataType), T.StructField(_PARTS, T.IntegerType())]
    )
    parts = F.broadcast(spark.createDataFrame(hot, schema))
    # A hash of the row, not a random number: a task that runs again after the
    # loss of an executor must send every row to the same place.
    width = F.when(F.col(on).isNull(), F.lit(tasks)).otherwise(F.coalesce(_PARTS, F.lit(1)))
    salted_rows = (
        rows.join(parts, on, "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(*rows.columns), width).cast("int"))
        .drop(_PARTS)
    )
    repeats = F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1)
    salted_lookup = (
        lookup.df.join(parts, on, "left").withColumn(_SALT, F.explode(repeats)).drop(_PARTS)
    )
    joined = salted_rows.join(salted_lookup.hint(hint), [on, _SALT], how)
    return joined.drop(_SALT)
