"""What several operators share: words, tables written on the way, rows dealt by size."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.scratch import scratch_folder

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_names(docs: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """The same rows with all columns but the used ones named by their place.

    So no column that is only passed on can clash with one that an operator adds; `toDF` with the
    old names puts them back.
    """
    return docs.toDF(*[c if c in used else f"passed_{i}" for i, c in enumerate(docs.columns)])


def kept_table(frame: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them from there: it cuts the lineage."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    frame.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `kept_table` that other kept tables were made of and nothing else will read."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            spark = table.sparkSession
            folder = file.rpartition("/")[0]
            if not re.search(r"-[0-9a-f]{32}$", folder):
                raise ValueError(f"{folder} is no folder of a kept table")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; of a null id as of an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def positions(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their position from 0 in ascending order, null last.

    Each range of values is numbered on its own and shifted by the sizes of the ranges before it,
    so that no task sees all values; only one row a range is brought together.
    """
    spark = values.sparkSession
    ranged = kept_table(
        values.select(F.col(column).alias("value"))
        .distinct()
        .repartitionByRange(shuffle_partitions(spark), F.col("value").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    return spark.sql(
        f"""
        WITH sizes AS (SELECT part, count(*) AS n FROM {{ranged}} GROUP BY part),
        starts AS (
            SELECT part, sum(n) OVER (ORDER BY part) - n AS start FROM sizes
        )
        SELECT r.value AS {column},
               row_number() OVER (PARTITION BY r.part ORDER BY r.value ASC NULLS LAST)
                 + s.start - 1 AS position
        FROM {{ranged}} r JOIN starts s ON r.part = s.part
        """,
        ranged=ranged,
    )
