"""Telemetry tables as views over the events, customer and supplier tables.

The test data holds no telemetry. Each event becomes one ``ts_kv`` row with
exactly one value column set; customers and suppliers become entities. The
mapping leaves gaps on purpose: key 5 is in no dictionary, and some users are
no entity, so that unresolved keys and unknown entities occur in whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.functions import ntz_to_millis
from kvloom.operators.aggregates import latest_per_series
from kvloom.model import SOURCE_COLUMNS
from kvloom.sources.tables import FrameSource

# --- fixed values -----------------------------------------------------------
KEY_OF_EVENT = {"click": 1, "error": 2, "purchase": 3, "view": 4}
OTHER_KEY, OTHER_NAME = 5, "signup"
ERROR_TEXTS = ("42", "-100", "3.14", "hello", "", "9223372036854775808", "1e5", "1d")
PHASE1_START = 1_705_708_800_000  # 2024-01-20 UTC
# How long the job of the status report takes.
JOB_SECONDS = 40
START_WATERMARK = 1_705_708_740_000
AS_OF = 1_706_659_200_000  # 2024-01-31 UTC
SECOND_LANDING = 1_706_140_800_000  # 2024-01-25 UTC
MONTHS_APART = 45 * 86_400_000  # between the rows of one key and the next
SAMPLE_ENTITY = "00000000-0000-1000-8000-000000000007"
# ----------------------------------------------------------------------------

# Schemas of the columns that are read, so that no file is opened to infer one.
_SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "customer": "c_custkey long",
    "supplier": "s_suppkey long",
    "orders": "o_orderkey long, o_orderdate timestamp_ntz",
}


def entity_uuid(number: Column) -> Column:
    """A version-1 shaped id that carries a number."""
    return F.concat(F.lit("00000000-0000-1000-8000-"), F.lpad(number.cast("string"), 12, "0"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events_as_ts_kv(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    key = F.lit(OTHER_KEY)
    for name, number in KEY_OF_EVENT.items():
        key = F.when(kind == name, F.lit(number)).otherwise(key)
    texts = F.array(*[F.lit(t) for t in ERROR_TEXTS])
    position = F.pmod("event_id", F.lit(len(ERROR_TEXTS))).cast("int")
    return events.select(
        entity_uuid(F.col("user_id")).alias("entity_id"),
        key.alias("key"),
        ntz_to_millis(F.col("ts")).alias("ts"),
        F.when(~kind.isin(*KEY_OF_EVENT), value > 20).alias("bool_v"),
        F.when(kind == "error", F.get(texts, position)).alias("str_v"),
        F.when(kind == "view", F.floor(value).cast("long")).alias("long_v"),
        F.when(kind == "click", value).alias("dbl_v"),
        F.when(kind == "purchase", F.col("props")).alias("json_v"),
    )


def ts_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_ts_kv(read_table(spark, sf_dir, "events"))


def with_text_keys(rows: DataFrame) -> DataFrame:
    """The rows with text keys: by turns an id, an id with a zero before it, and a name."""
    names = F.create_map(*[F.lit(v) for name, number in KEY_OF_EVENT.items() for v in (number, name)])
    number = F.col("key").cast("string")
    named = F.coalesce(F.try_element_at(names, F.col("key")), F.lit(OTHER_NAME))
    turn = F.pmod("ts", F.lit(3))
    text = F.when(turn == 0, number).when(turn == 1, F.concat(F.lit("0"), number)).otherwise(named)
    return rows.withColumn("key", text)


def ts_kv_latest(history: DataFrame) -> DataFrame:
    return latest_per_series(history, ["entity_id", "key"]).select(*SOURCE_COLUMNS)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types found in the data that carry a key id of their own."""
    events = read_table(spark, sf_dir, "events")
    key_id = F.lit(None).cast("int")
    for name, number in KEY_OF_EVENT.items():
        key_id = F.when(F.col("event_type") == name, F.lit(number)).otherwise(key_id)
    kinds = events.filter(F.col("event_type").isin(*KEY_OF_EVENT)).select("event_type").distinct()
    return kinds.select(key_id.alias("key_id"), F.col("event_type").alias("key"))


def completed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that a run before the resumed one is said to have finished."""
    users = read_table(spark, sf_dir, "events").select("user_id").distinct()
    return users.filter(F.pmod("user_id", F.lit(3)) == 0).select(
        entity_uuid(F.col("user_id")).alias("entity_id")
    )


def telemetry_source(
    spark: SparkSession, sf_dir: str, absent: tuple[str, ...] = ()
) -> FrameSource:
    """All telemetry tables over one data folder, but for the absent ones."""
    history = ts_kv(spark, sf_dir)
    customers = read_table(spark, sf_dir, "customer")
    keys = dictionary(spark, sf_dir)
    frames = {
        "ts_kv": history,
        "ts_kv_latest": ts_kv_latest(history),
        "key_dictionary": keys,
        "ts_kv_dictionary": keys,
        "device": customers.filter(F.pmod("c_custkey", F.lit(7)) != 3).select(
            entity_uuid(F.col("c_custkey")).alias("id")
        ),
        "asset": read_table(spark, sf_dir, "supplier").select(
            entity_uuid(F.col("s_suppkey")).alias("id")
        ),
    }
    return FrameSource(spark, {k: v for k, v in frames.items() if k not in absent})


def only_completed(source: FrameSource, completed: DataFrame) -> FrameSource:
    """The source as it was when only the completed entities had rows."""
    return source.replacing(
        ts_kv=source.history().join(completed, "entity_id", "left_semi"),
        ts_kv_latest=source.latest().join(completed, "entity_id", "left_semi"),
    )
