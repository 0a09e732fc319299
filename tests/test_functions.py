import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from kvloom.functions import (
    bucket_start,
    canonical_uuid,
    directory_bucket,
    is_time_uuid,
    lookup_uuid,
    ntz_to_millis,
    retype_strings,
    utc_text,
)
from kvloom.functions.buckets import MAX_TS, MIN_TS
from kvloom.model import STRATEGIES


def buckets(spark, values, strategy):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ts long")
    return [
        r["b"]
        for r in df.select("i", bucket_start("ts", strategy).alias("b")).orderBy("i").collect()
    ]


# Literal cases of the behaviour to match.
CASES = [
    ("MONTHS", 1718445600000, 1717200000000),
    ("MONTHS", 1704067200000, 1704067200000),
    ("DAYS", 1718445600000, 1718409600000),
    ("YEARS", 1718445600000, 1704067200000),
    ("INDEFINITE", 1718445600000, 0),
    ("HOURS", 1718445600000, 1718445600000),
    ("HOURS", 1718447123000, 1718445600000),
    ("MINUTES", 1718447123000, 1718447100000),
]


def test_bucket_literals(spark):
    for strategy in STRATEGIES:
        mine = [(ts, b) for s, ts, b in CASES if s == strategy]
        assert buckets(spark, [ts for ts, _ in mine], strategy) == [b for _, b in mine]


@pytest.mark.parametrize("strategy", ["MINUTES", "HOURS", "DAYS", "MONTHS", "YEARS"])
def test_buckets_equal_calendar(spark, strategy):
    values = [
        0, -1, 1, -86_400_001, 951_782_399_999, 951_782_400_000, 1_710_054_000_000,
        1_730_613_600_000, MIN_TS, MAX_TS, -2_208_988_800_001, 4_102_444_799_999,
    ]
    kept = {
        "MINUTES": {"second": 0},
        "HOURS": {"second": 0, "minute": 0},
        "DAYS": {"second": 0, "minute": 0, "hour": 0},
        "MONTHS": {"second": 0, "minute": 0, "hour": 0, "day": 1},
        "YEARS": {"second": 0, "minute": 0, "hour": 0, "day": 1, "month": 1},
    }[strategy]
    epoch = datetime(1970, 1, 1)

    def expected(ts):
        from datetime import timedelta

        t = (epoch + timedelta(milliseconds=ts)).replace(microsecond=0, **kept)
        return (t - epoch) // timedelta(milliseconds=1)

    assert buckets(spark, values, strategy) == [expected(v) for v in values]


def test_ts_outside_calendar_has_no_bucket(spark):
    outside = [MAX_TS + 1, MIN_TS - 1, 2**63 - 1, -(2**63)]
    for strategy in STRATEGIES:
        want = [0] * 4 if strategy == "INDEFINITE" else [None] * 4
        assert buckets(spark, outside, strategy) == want


def test_unknown_strategy():
    with pytest.raises(ValueError):
        bucket_start(F.lit(0), "WEEKS")


def test_directory_bucket_is_coarse(spark):
    df = spark.createDataFrame([(1718447123000,)], "ts long")
    for strategy in STRATEGIES:
        part = bucket_start("ts", strategy)
        got = df.select(directory_bucket(part, strategy).alias("b")).first()["b"]
        want = {"YEARS": 1704067200000, "INDEFINITE": 0}.get(strategy, 1717200000000)
        assert got == want


def retyped(spark, texts):
    df = spark.createDataFrame(
        [(i, t, None, None) for i, t in enumerate(texts)],
        "i int, str_v string, long_v long, dbl_v double",
    )
    return {r["i"]: r for r in retype_strings(df).collect()}


def test_retype_integers(spark):
    texts = ["42", "-100", "+7", " 42 ", "\t1\n", "007", "9223372036854775807", "-9223372036854775808"]
    got = retyped(spark, texts)
    for i, t in enumerate(texts):
        assert (got[i]["str_v"], got[i]["long_v"], got[i]["dbl_v"]) == (None, int(t), None)


def test_retype_floats(spark):
    texts = ["3.14", "1e5", ".5", "5.", "-1.5E-3", " 2.5 ", "9223372036854775808", "1" * 40]
    got = retyped(spark, texts)
    for i, t in enumerate(texts):
        assert (got[i]["str_v"], got[i]["long_v"], got[i]["dbl_v"]) == (None, None, float(t))


def test_retype_words(spark):
    got = retyped(spark, ["NaN", "inf", "-Infinity", "+INF", "-nan"])
    values = [got[i]["dbl_v"] for i in range(5)]
    assert math.isnan(values[0]) and math.isnan(values[4])
    assert values[1:4] == [math.inf, -math.inf, math.inf]


def test_retype_leaves_other_texts(spark):
    texts = ["hello", "", " ", "1d", "2f", "0x10", "1_000", "1e", "e5", ".", "--1", "1 2", "١٢", "1 ", "1\u0085"]
    got = retyped(spark, texts)
    for i, t in enumerate(texts):
        assert (got[i]["str_v"], got[i]["long_v"], got[i]["dbl_v"]) == (t, None, None)


def test_retype_keeps_rows_without_text(spark):
    df = spark.createDataFrame(
        [(None, 5, None), (None, None, 2.5), ("7", 5, 2.5)], "str_v string, long_v long, dbl_v double"
    )
    got = {tuple(r) for r in retype_strings(df).select("str_v", "long_v", "dbl_v").collect()}
    assert got == {(None, 5, None), (None, None, 2.5), (None, 7, 2.5)}


def test_uuid_forms(spark):
    want = "550e8400-e29b-11d4-a716-446655440000"
    forms = [want, want.upper(), want.replace("-", ""), "{" + want + "}", "urn:uuid:" + want, f" {want} "]
    wrong = ["", "hello", want[:-1], want + "0", want.replace("5", "g"), None]
    df = spark.createDataFrame([(f,) for f in forms + wrong], "t string")
    got = df.select(
        canonical_uuid(F.col("t")).alias("c"), lookup_uuid(F.col("t")).alias("l")
    ).collect()
    assert [r["c"] for r in got] == [want] * len(forms) + [None] * len(wrong)
    assert [r["l"] for r in got][: len(forms)] == [want] * len(forms)


def test_time_uuid(spark):
    df = spark.createDataFrame([("550e8400-e29b-11d4-a716-446655440000",), ("550e8400-e29b-41d4-a716-446655440000",)], "t string")
    assert [r[0] for r in df.select(is_time_uuid(F.col("t"))).collect()] == [True, False]


def test_ntz_to_millis_and_text(spark):
    texts = ["2024-03-10 02:30:00.999999", "1969-12-31 23:59:59.9995", "2024-01-31 00:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ms = df.select("i", ntz_to_millis(F.col("t").cast("timestamp_ntz")).alias("ms"))
    got = [r["ms"] for r in ms.orderBy("i").collect()]
    assert got == [1710037800999, -1, 1706659200000]
    shown = [r[0] for r in ms.orderBy("i").select(utc_text(F.col("ms"))).collect()]
    assert shown == ["2024-03-10 02:30:00 UTC", "1969-12-31 23:59:59 UTC", "2024-01-31 00:00:00 UTC"]
    assert shown[0] == datetime.fromtimestamp(got[0] // 1000, timezone.utc).strftime(
        "%Y-%m-%d %H:%M:%S UTC"
    )
