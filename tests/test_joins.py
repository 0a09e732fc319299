import pytest
from helpers import as_set

from kvloom.model import RunOptions
from kvloom.operators.joins import hot_keys, lookup_join, spread_join
from kvloom.sources import Dimension

# No broadcast by size, so the shuffle join has to be taken.
SHUFFLE = RunOptions(broadcast_max_rows=0)


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows, more than a third under key 7, some without a key."""
    return spark.range(4000).selectExpr(
        "CASE WHEN id % 5 < 2 THEN 7 WHEN id % 50 = 49 THEN NULL ELSE cast(id % 200 as int) END AS k",
        "id AS v",
    )


@pytest.fixture(scope="module")
def lookup(spark):
    df = spark.range(0, 200, 2).selectExpr("cast(id as int) AS k", "concat('n', id) AS name")
    return Dimension.measure(df.union(spark.createDataFrame([(7, "hot")], "k int, name string")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffle_join_equals_broadcast_join(skewed, lookup, how):
    small = lookup_join(skewed, lookup, "k", how, RunOptions())
    large = lookup_join(skewed, lookup, "k", how, SHUFFLE)
    assert "BroadcastHashJoin" in plan(small)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.fixture
def eight_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_keys_are_few_and_split(skewed, eight_tasks):
    found = dict(hot_keys(skewed, "k"))
    assert set(found) == {7}
    # Two fifths of the rows and some more fill at least three of eight shares.
    assert found[7] >= 3


def test_a_key_of_few_shares_is_split_among_very_many_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(40_000).selectExpr("CASE WHEN id < 30 THEN -1 ELSE id END AS k")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")
    try:
        assert dict(hot_keys(rows, "k")) == {-1: 3}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_hot_key_is_spread_over_tasks(spark, skewed, lookup, eight_tasks):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(skewed, lookup, "k", "left")
        assert "ShuffledHashJoin" in plan(joined)
        per_task = joined.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 4000 and max(per_task) < 4000 / 3


def test_keys_present_in_few_rows_reduce_the_lookup(spark, lookup):
    rows = spark.createDataFrame([(2, "a"), (7, "b"), (7, "c"), (None, "d")], "k int, v string")
    # The lookup table is above the bounds, the three keys of the rows are not.
    options = RunOptions(broadcast_max_rows=3)
    joined = lookup_join(rows, lookup, "k", "left", options)
    assert plan(joined).count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan(joined) and "ShuffledHashJoin" not in plan(joined)
    assert as_set(joined, "v", "name") == {("a", "n2"), ("b", "hot"), ("c", "hot"), ("d", None)}
    assert as_set(lookup_join(rows, lookup, "k", "left_anti", options), "v") == {("d",)}


def test_what_a_join_holds_is_released_with_the_lookup_table(spark):
    def held():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    rows = spark.range(400).selectExpr("cast(id % 10 as int) AS k", "id AS v")
    large = Dimension.measure(spark.range(5000).selectExpr("cast(id as int) AS k", "id AS name"))
    before = held()
    for _ in range(3):
        joined = lookup_join(rows, large, "k", "inner", RunOptions(broadcast_max_rows=100))
        assert "BroadcastHashJoin" in plan(joined) and joined.count() == 400
    assert len(held() - before) == 1  # one plan, kept once
    large.release()
    assert held() <= before and large.held == []
    lookup_join(rows, large, "k", "inner", RunOptions(broadcast_max_rows=5)).count()
    assert held() <= before and large.held == []
