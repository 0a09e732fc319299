"""Small telemetry tables for tests."""

from pyspark.sql import types as T

from kvloom.model import source_schema
from kvloom.sources import FrameSource


def eid(n: int) -> str:
    return f"550e8400-e29b-11d4-a716-{n:012d}"


def row(entity, key, ts, **values):
    """A source row with the given value columns set."""
    columns = ("bool_v", "str_v", "long_v", "dbl_v", "json_v")
    return (entity, key, ts, *[values.get(c) for c in columns])


def ts_kv(spark, rows, text_keys=False):
    schema = source_schema(T.StringType() if text_keys else T.IntegerType())
    return spark.createDataFrame(rows, schema)


def source(spark, rows, latest=(), keys=((1, "temperature"), (2, "humidity")), **tables):
    """A source of ``ts_kv`` rows with entities 1-9 in table ``device``."""
    frames = {
        "ts_kv": ts_kv(spark, rows),
        "ts_kv_latest": ts_kv(spark, list(latest)),
        "device": spark.createDataFrame([(eid(n),) for n in range(1, 10)], "id string"),
    }
    if keys is not None:
        frames["key_dictionary"] = spark.createDataFrame(list(keys), "key_id int, key string")
    frames.update(tables)
    return FrameSource(spark, frames)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*(columns or df.columns)).collect()}
