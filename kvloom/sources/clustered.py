"""``ts_kv`` stored for access by entity: in ranges of its primary key, with bloom filters.

A page of an entity then reads the one or two files whose range holds it, and of those the row
groups that do, in place of the whole table. Ranges serve pages that go on behind an entity, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from kvloom.model import RunOptions

#: Bits that a bloom filter spends on an entity; one filter per row group.
_NDV = "parquet.bloom.filter.expected.ndv#entity_id"
_ENABLED = "parquet.bloom.filter.enabled#entity_id"
#: Ranges that are cut whatever the number of rows, and rows of a range where that is not enough.
_RANGES = 200
_ROWS_PER_RANGE = 1_000_000


def with_entity_filters(writer: DataFrameWriter, options: RunOptions) -> DataFrameWriter:
    """The writer, adding a bloom filter of the entity ids to each row group."""
    # A file has no more entities than rows.
    entities = min(options.entities_per_file, options.rows_per_file)
    return (
        writer.option(_ENABLED, "true")
        .option(_NDV, str(entities))
        .option("parquet.block.size", str(options.row_group_bytes))
    )


def store_clustered(rows: DataFrame, folder: str, options: RunOptions) -> None:
    """Store source rows in ranges of (entity_id, key, ts), each range in order.

    The ranges are cut at sampled quantiles of the whole key, so the rows of a hot entity are spread
    over as many files as their share asks for. Rows with a null id come first, and none is left out.

    Spark samples some hundred rows a range on the driver. So where files are to be small, there are
    fewer ranges than files: the task of a range ends a file at that many rows and begins the next one
    behind it.
    """
    found = rows.agg(F.count("*")).first()[0]
    files = max(1, -(-found // options.rows_per_file))
    ranges = min(files, max(_RANGES, -(-found // _ROWS_PER_RANGE)))
    order = ["entity_id", "key", "ts"]
    writer = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.mode("overwrite")
    if ranges < files:
        writer = writer.option("maxRecordsPerFile", options.rows_per_file)
    with_entity_filters(writer, options).parquet(folder)
