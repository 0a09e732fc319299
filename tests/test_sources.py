import pytest
from helpers import as_set, eid, row, source, ts_kv

from kvloom.model import ENTITY_TABLES, RunOptions
from kvloom.sources import (
    CatalogSource,
    FrameSource,
    JdbcSource,
    ParquetSource,
    entity_map,
    key_map,
    load_dimensions,
)
from kvloom.sources import queries as sq

ROWS = [
    row(eid(1), 1, 10, long_v=1),
    row(eid(1), 1, 20, long_v=2),
    row(eid(1), 2, 5, str_v="a"),
    row(eid(2), 1, 20, dbl_v=1.5),
    row(eid(3), 2, 20, bool_v=True),
]


def test_entity_map_reads_all_tables(spark):
    frames = {
        t: spark.createDataFrame([(eid(100 + i),), (eid(200 + i),)], "id string")
        for i, t in enumerate(ENTITY_TABLES)
    }
    got = as_set(entity_map(FrameSource(spark, frames)))
    assert len(got) == 36
    assert (eid(100), "DEVICE") in got and (eid(208), "USER") in got


def test_entity_map_later_table_wins_and_missing_are_skipped(spark):
    ids = spark.createDataFrame([(eid(1),)], "id string")
    upper = spark.createDataFrame([(eid(1).upper(),)], "id string")
    got = as_set(entity_map(FrameSource(spark, {"asset": upper, "device": ids})))
    assert got == {(eid(1), "ASSET")}
    assert as_set(entity_map(FrameSource(spark, {}))) == set()


def test_key_map_fallback_chain(spark):
    first = spark.createDataFrame([(1, "temperature")], "key_id int, key string")
    second = spark.createDataFrame([(1, "old")], "key_id int, key string")
    both = FrameSource(spark, {"key_dictionary": first, "ts_kv_dictionary": second})
    assert as_set(key_map(both)) == {(1, "temperature")}
    assert as_set(key_map(FrameSource(spark, {"ts_kv_dictionary": second}))) == {(1, "old")}
    assert as_set(key_map(FrameSource(spark, {}))) == set()


def test_key_map_sorts_distinct_entries_only(spark):
    entries = [(1, "a"), (1, "b"), (1, "a"), (2, None), (3, None), (3, "c")]
    keys = key_map(FrameSource(spark, {"key_dictionary": spark.createDataFrame(entries, "key_id int, key string")}))
    assert as_set(keys) == {(1, "b"), (2, None), (3, "c")}
    # A dictionary derived from many rows is reduced by hash before anything is sorted.
    plan = keys._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan and plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_dimension_sizes(spark):
    dims = load_dimensions(source(spark, ROWS))
    assert (dims.entities.rows, dims.keys.rows, dims.shared_names.rows) == (9, 2, 0)
    assert dims.entities.bytes >= 9 * (36 + 6)
    assert dims.entities.fits_broadcast(RunOptions())
    assert not dims.entities.fits_broadcast(RunOptions(broadcast_max_rows=8))
    assert not dims.entities.fits_broadcast(RunOptions(broadcast_max_bytes=100))


def test_shared_names(spark):
    keys = [(1, "temperature"), (2, "temperature"), (7, "5"), (8, "9"), (9, "x"), (10, "05")]
    dims = load_dimensions(source(spark, ROWS, keys=keys))
    # 9 is itself in the dictionary, so no raw key ends up as "9".
    assert as_set(dims.shared_names.df) == {("temperature",), ("5",)}


def test_distinct_entities_prefers_latest(spark):
    latest = [row(eid(8), 1, 1, long_v=1)]
    assert as_set(sq.distinct_entities(source(spark, ROWS, latest))) == {(eid(8),)}
    assert as_set(sq.distinct_entities(source(spark, ROWS))) == {(eid(1),), (eid(2),), (eid(3),)}
    only = FrameSource(spark, {"ts_kv": ts_kv(spark, ROWS)})
    assert not sq.has_rows(only, "ts_kv_latest")
    assert sq.distinct_entities(only).count() == 3


def test_missing_history_is_an_error(spark):
    with pytest.raises(LookupError):
        FrameSource(spark, {}).history()


def test_entity_pages_cover_the_entity(spark):
    rows = ts_kv(spark, ROWS)
    options = RunOptions(batch_size=2)
    first = sq.entity_page(rows, eid(1).upper(), options).collect()
    assert [(r["key"], r["ts"]) for r in first] == [(1, 10), (1, 20)]
    second = sq.entity_page(rows, eid(1), options, after=(1, 20)).collect()
    assert [(r["key"], r["ts"]) for r in second] == [(2, 5)]
    late = sq.entity_page(rows, eid(1), options, min_ts=9).collect()
    assert [(r["key"], r["ts"]) for r in late] == [(1, 10), (1, 20)]
    assert [r["ts"] for r in sq.entity_key_page(rows, eid(1), 1, options, 10).collect()] == [20]
    by_ts = sq.entity_page_by_ts(rows, eid(1), 0, options).collect()
    assert [r["ts"] for r in by_ts] == [5, 10]


def test_changed_pages_keep_equal_ts(spark):
    rows = ts_kv(spark, ROWS)
    options = RunOptions(batch_size=1)
    seen, after = [], None
    while True:
        page = sq.changed_page(rows, 10, options, after).collect()
        if not page:
            break
        after = (page[0]["ts"], page[0]["entity_id"], page[0]["key"])
        seen.append(after)
    assert seen == [(20, eid(1), 1), (20, eid(2), 1), (20, eid(3), 2)]
    assert sq.changed_since(rows, 20).isEmpty()


def test_entity_sets(spark):
    rows = ts_kv(spark, ROWS)
    assert [r[0] for r in sq.entities_after(rows, eid(1)).collect()] == [eid(2), eid(3)]
    assert as_set(sq.keys_of_entity(rows, eid(1))) == {("1",), ("2",)}
    assert sq.entity_keys(rows).count() == 4
    ids = spark.createDataFrame([(eid(2),), (eid(2),), (eid(9),)], "entity_id string")
    for options in (RunOptions(), RunOptions(broadcast_max_rows=0)):
        assert as_set(sq.latest_for_entities(rows, ids, options), "entity_id", "ts") == {(eid(2), 20)}


def test_parquet_and_catalog_sources(spark, tmp_path):
    root = str(tmp_path)
    ts_kv(spark, ROWS).write.parquet(f"{root}/ts_kv")
    spark.createDataFrame([(eid(1),)], "id string").write.parquet(f"{root}/device.parquet")
    src = ParquetSource(spark, root)
    assert src.history().count() == 5 and src.latest().isEmpty()
    assert src.find("asset") is None
    assert as_set(entity_map(src)) == {(eid(1), "DEVICE")}
    src.history().createOrReplaceTempView("ts_kv")
    try:
        catalog = CatalogSource(spark)
        assert catalog.history().count() == 5
        assert catalog.find("key_dictionary") is None
    finally:
        spark.catalog.dropTempView("ts_kv")


def test_filters_reach_the_parquet_scan(spark, tmp_path):
    root = str(tmp_path)
    ts_kv(spark, ROWS).write.parquet(f"{root}/ts_kv")
    rows = ParquetSource(spark, root).history()
    plan = sq.changed_since(rows, 10).select("ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,10)" in plan and "ReadSchema: struct<ts:bigint>" in plan
    page = sq.entity_page(rows, eid(1), RunOptions(), after=(1, 20))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(entity_id,{eid(1)})" in plan and "TakeOrderedAndProject" in plan


def test_jdbc_options(spark):
    options = RunOptions(batch_size=700, workers=6)
    jdbc = JdbcSource(spark, "jdbc:x:y", {"user": "u"}, options, ts_bounds=(100, 900))
    given = jdbc.reader_options("ts_kv")
    assert given == {
        "url": "jdbc:x:y", "dbtable": "ts_kv", "fetchsize": "700", "user": "u",
        "partitionColumn": "ts", "lowerBound": "100", "upperBound": "901", "numPartitions": "6",
    }
    assert "partitionColumn" not in jdbc.reader_options("device")
    with pytest.raises(ValueError):
        JdbcSource(spark, "jdbc:x:y", ts_bounds=(2, 1)).reader_options("ts_kv")
