"""The two lookup tables: entity id to type, key id to key name."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.functions import canonical_uuid
from kvloom.model import (
    ENTITY_MAP_SCHEMA,
    ENTITY_TABLES,
    KEY_MAP_SCHEMA,
    KEY_TABLES,
    RunOptions,
)
from kvloom.sources.tables import SourceTables

log = logging.getLogger(__name__)

# Memory of one broadcast row beside its text: row header, hash slot, pointers.
ROW_OVERHEAD_BYTES = 64


@dataclass(frozen=True)
class Dimension:
    """A lookup table with a unique key and its measured size."""

    df: DataFrame
    rows: int
    bytes: int
    # What joins with this table hold on the executors until it is released.
    held: list[DataFrame] = field(default_factory=list, compare=False, repr=False)

    def selecting(self, *columns) -> Dimension:
        """The same rows with these columns; what is held for it is held for this table."""
        return Dimension(self.df.select(*columns), self.rows, self.bytes, self.held)

    def release(self) -> None:
        """Give up what joins hold; for when the rows that they made are written."""
        while self.held:
            self.held.pop().unpersist()

    @staticmethod
    def measure(df: DataFrame) -> Dimension:
        """Count the rows and the bytes of all columns in one distributed pass."""
        return measure_all([df])[0]

    def fits_broadcast(self, options: RunOptions) -> bool:
        return self.rows <= options.broadcast_max_rows and self.bytes <= options.broadcast_max_bytes


def measure_all(frames: list[DataFrame]) -> list[Dimension]:
    """Measure several tables in one job."""
    found = _sizes(frames)
    return [Dimension(df, *size) for df, size in zip(frames, found)]


def _sizes(frames: list[DataFrame], *counted: DataFrame) -> list[tuple[int, int]]:
    """Rows and bytes of tables, then the rows of one-column, one-row tables."""
    sizes = []
    for position, df in enumerate(frames):
        width = reduce(
            lambda a, b: a + b,
            [
                F.coalesce(F.octet_length(f.name), F.lit(0))
                if isinstance(f.dataType, T.StringType)
                else F.lit(8)
                for f in df.schema.fields
            ],
        )
        sizes.append(
            df.agg(
                F.lit(position).alias("position"),
                F.count("*").alias("rows"),
                F.coalesce(F.sum(width + F.lit(ROW_OVERHEAD_BYTES)), F.lit(0)).alias("bytes"),
            )
        )
    for position, df in enumerate(counted, len(frames)):
        sizes.append(df.select(F.lit(position), df[0], F.lit(0).cast("long")))
    found = sorted(tuple(r) for r in reduce(DataFrame.union, sizes).collect())
    return [(rows, size) for _, rows, size in found]


@dataclass(frozen=True)
class Dimensions:
    """Both lookup tables, measured, as the enrichment needs them."""

    entities: Dimension
    keys: Dimension
    # Key names that more than one source key ends up with; mostly empty.
    shared_names: Dimension

    def release(self) -> None:
        """Give up what ``load_dimensions(keep=True)`` and joins hold."""
        for part in (self.entities, self.keys, self.shared_names):
            part.release()
            part.df.unpersist()


def entity_map(source: SourceTables) -> DataFrame:
    """(entity_id, entity_type) over all entity tables that exist.

    An id in several tables takes the type of the table listed last. Tables are
    compared by position, an integer, so the aggregation stays a hash aggregate.
    """
    # Looking for a table takes a round trip, most of all where it is absent.
    with ThreadPoolExecutor(len(ENTITY_TABLES)) as pool:
        tables = list(pool.map(source.find, ENTITY_TABLES))
    parts = []
    for position, (table, found) in enumerate(zip(ENTITY_TABLES, tables)):
        if found is None:
            log.warning("entity table %s does not exist, skipped", table)
            continue
        parts.append(
            found.select(
                canonical_uuid(F.col("id").cast("string")).alias("entity_id"),
                F.lit(position).alias("position"),
            )
        )
    if not parts:
        return source.spark.createDataFrame([], ENTITY_MAP_SCHEMA)
    types = F.array(*[F.lit(t) for t in ENTITY_TABLES.values()])
    return (
        reduce(DataFrame.unionByName, parts)
        .filter(F.col("entity_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.max("position").alias("position"))
        .select("entity_id", F.get(types, F.col("position")).alias("entity_type"))
    )


def key_map(source: SourceTables) -> DataFrame:
    """(key_id, key) from the first dictionary table that exists, else empty."""
    for table in KEY_TABLES:
        found = source.find(table)
        if found is not None:
            return (
                found.select(F.col("key_id").cast("int").alias("key_id"), "key")
                # Equal entries go before the rows are sorted for the maximum of a text. Spark
                # would leave this step out before max, not before max_by.
                .distinct()
                .groupBy("key_id")
                .agg(F.max_by("key", "key").alias("key"))
            )
    log.info("no key dictionary, keys are used as they are")
    return source.spark.createDataFrame([], KEY_MAP_SCHEMA)


def shared_key_names(keys: DataFrame) -> DataFrame:
    """Names that two different source keys resolve to, one column ``key``.

    Two dictionary entries may carry one name, or a name may read like the id
    of a key that the dictionary lacks, which is then used as its own name.
    Only these names can bring two source rows to one target row.
    """
    repeated = keys.groupBy("key").count().filter("count > 1").select("key")
    id_like = (
        keys.select("key", F.col("key").try_cast("int").alias("key_id"))
        .filter(F.col("key_id").cast("string") == F.col("key"))
        .join(keys.select("key_id"), "key_id", "left_anti")
        .select("key")
    )
    return repeated.union(id_like).distinct()


def load_dimensions(source: SourceTables, keep: bool = False) -> Dimensions:
    """Read and measure the lookup tables.

    ``keep`` holds them on the executors for a job that uses them several
    times; a lost part is read again.
    """
    frames = [entity_map(source), key_map(source)]
    if keep:
        frames = [df.persist() for df in frames]
    names = F.col("key")
    id_like = names.try_cast("int").cast("string") == names
    # Names given twice and names that read like an id; mostly none.
    suspects = F.count("*") - F.count_distinct(names) + F.count_if(id_like)
    *sizes, (suspected, _) = _sizes(frames, frames[1].agg(suspects))
    entities, keys = (Dimension(df, *size) for df, size in zip(frames, sizes))
    if suspected:
        shared = Dimension.measure(shared_key_names(keys.df))
    else:
        shared = Dimension(keys.df.select("key").limit(0), 0, 0)
    return Dimensions(entities, keys, shared)
