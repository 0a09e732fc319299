"""Counts of entities that can be merged: bitmaps over dense numbers of the known entities.

A slice leaves a few kilobytes for every 32,768 entities, whatever the number of its rows. Bitmaps of
slices are put together by OR, so entities that several slices meet count once and no slice is read
again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kvloom.model import RunOptions
from kvloom.operators.joins import lookup_join
from kvloom.sources.dimensions import Dimension

_PART, _BEFORE = "_part", "_before"


def entity_ordinals(entities: DataFrame) -> DataFrame:
    """(entity_id, ordinal): distinct ids numbered from 1, without gaps.

    Ids are dealt by a hash, the same whenever a task runs again; every part is numbered by itself and
    shifted by the sizes of those before it. The sizes, one row a part, are all that comes together.
    Null ids have no number.
    """
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = entities.filter(F.col("entity_id").isNotNull()).select("entity_id").distinct()
    dealt = ids.withColumn(_PART, F.pmod(F.xxhash64("entity_id"), F.lit(parts)))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(_PART).count()
    before = sizes.select(_PART, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias(_BEFORE))
    place = F.row_number().over(Window.partitionBy(_PART).orderBy("entity_id"))
    numbered = dealt.withColumn("_place", place).join(F.broadcast(before), _PART)
    return numbered.select("entity_id", (F.col("_place") + F.col(_BEFORE)).alias("ordinal"))


def slice_bitmaps(rows: DataFrame, ordinals: Dimension, options: RunOptions) -> DataFrame:
    """(bucket, bitmap) of the numbered entities that have a row; others are left out.

    Tasks set bits before the shuffle, which carries one bitmap a task and bucket.
    """
    numbered = lookup_join(rows.select("entity_id"), ordinals, "entity_id", "inner", options)
    return numbered.groupBy(F.bitmap_bucket_number("ordinal").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ordinal")).alias("bitmap")
    )


def merged(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several slices as one, bucket by bucket."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def progress_of(bitmaps: DataFrame, total: int) -> DataFrame:
    """How many of so many entities the bitmaps have, and how many are left."""
    done = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0))
    counted = merged(bitmaps).agg(done.alias("done_entities"))
    number = F.lit(total).cast("long")
    return counted.select(
        number.alias("total_entities"), (number - F.col("done_entities")).alias("pending_entities"), "done_entities"
    )
