from helpers import as_set, eid, row, source, ts_kv

from kvloom.functions.buckets import MAX_TS
from kvloom.model import RunOptions
from kvloom.operators import aggregates as agg
from kvloom.operators import enrich
from kvloom.sources import Dimension, load_dimensions

OPTIONS = RunOptions()
SHUFFLE = RunOptions(broadcast_max_rows=0)
TS = 1718445600000


def test_history_row(spark):
    src = source(spark, [row(eid(1).upper(), 1, TS, long_v=42)])
    got = enrich.history_rows(src.history(), load_dimensions(src), OPTIONS).collect()
    assert [tuple(r) for r in got] == [
        ("DEVICE", eid(1), "temperature", 1717200000000, TS, None, None, 42, None, None)
    ]


def test_unknown_key_is_its_own_name(spark):
    src = source(spark, [row(eid(1), 77, TS, long_v=1)])
    dims = load_dimensions(src)
    for options in (OPTIONS, SHUFFLE):
        assert as_set(enrich.history_rows(src.history(), dims, options), "key") == {("77",)}


def test_text_keys(spark):
    src = source(spark, [], keys=None, ts_kv=ts_kv(spark, [row(eid(1), "temp", TS, long_v=1)], True))
    got = enrich.history_rows(src.history(), load_dimensions(src), OPTIONS)
    assert as_set(got, "key", "long_v") == {("temp", 1)}


def test_text_keys_do_not_use_a_dictionary(spark):
    src = source(spark, [], ts_kv=ts_kv(spark, [row(eid(1), "1", TS, long_v=1)], True))
    names = OPTIONS.override(hybrid_keys=False)
    got = enrich.history_rows(src.history(), load_dimensions(src), names)
    assert as_set(got, "key") == {("1",)}


def test_hybrid_keys_are_resolved_one_by_one(spark):
    """Text that reads like an id of the dictionary gets its name, other text stays as it is."""
    given = {
        "1": "temperature", "01": "temperature", " +2\n": "humidity", "temperature": "temperature",
        "7": "7", "-1": "-1", "1.0": "1.0", "1e0": "1e0", "99999999999": "99999999999", "": "",
        "１": "１", "\xa01": "\xa01", None: None,
    }
    rows = [row(eid(1), key, TS + n, long_v=n) for n, key in enumerate(given)]
    src = source(spark, [], ts_kv=ts_kv(spark, rows, True), ts_kv_latest=ts_kv(spark, rows, True))
    dims = load_dimensions(src)
    want = {(n, name) for n, name in enumerate(given.values())}
    for options in (OPTIONS, SHUFFLE):
        assert as_set(enrich.history_rows(src.history(), dims, options), "long_v", "key") == want
        assert as_set(enrich.latest_rows(src.latest(), dims, options), "long_v", "key") == want


def test_spellings_of_one_key_keep_the_row_that_came_by_id(spark):
    rows = [
        row(eid(1), "temperature", TS, long_v=1),
        row(eid(1), "1", TS, long_v=2),
        row(eid(1), "humidity", TS, long_v=3),
        row(eid(1), "2", TS + 1, long_v=4),
        row(eid(2), "temperature", TS, long_v=5),
        row(eid(99), "1", TS, long_v=6),
    ]
    src = source(spark, [], ts_kv=ts_kv(spark, rows, True))
    dims = load_dimensions(src)
    for options in (OPTIONS, SHUFFLE):
        got = enrich.history_rows(src.history(), dims, options)
        assert sorted(r["long_v"] for r in got.collect()) == [2, 3, 4, 5]
    rejected = enrich.rejected_rows(src.history(), dims, OPTIONS)
    assert as_set(rejected, "entity_id", "key") == {(eid(99), "1")}


def test_shared_name_keeps_highest_key_id(spark):
    keys = [(1, "t"), (2, "t"), (7, "5")]
    rows = [
        row(eid(1), 1, TS, long_v=1),
        row(eid(1), 2, TS, long_v=2),
        row(eid(1), 2, TS + 1, long_v=3),
        row(eid(1), 5, TS, long_v=5),
        row(eid(1), 7, TS, long_v=7),
        row(eid(1), 9, TS, long_v=9),
    ]
    src = source(spark, rows, keys=keys)
    dims = load_dimensions(src)
    want = {("t", TS, 2), ("t", TS + 1, 3), ("5", TS, 7), ("9", TS, 9)}
    for options in (OPTIONS, SHUFFLE):
        got = enrich.history_rows(src.history(), dims, options)
        assert got.count() == 4
        assert as_set(got, "key", "ts", "long_v") == want


def test_rejects_have_reasons(spark):
    rows = [
        row(eid(1), 1, TS, long_v=1),
        row(eid(99), 1, TS, long_v=2),
        row("No-Uuid", 1, TS, long_v=3),
        row("Z" * 36, 1, TS, long_v=4),
        row(None, 1, TS, long_v=5),
        row(eid(2), 1, MAX_TS + 1, long_v=6),
    ]
    src = source(spark, rows)
    dims = load_dimensions(src)
    want = {
        (eid(99), "UNKNOWN_ENTITY"),
        ("No-Uuid", "BAD_UUID"),
        ("Z" * 36, "BAD_UUID"),
        (None, "BAD_UUID"),
        (eid(2), "BAD_TS"),
    }
    for options in (OPTIONS, SHUFFLE):
        assert as_set(enrich.rejected_rows(src.history(), dims, options), "entity_id", "reason") == want
        assert as_set(enrich.history_rows(src.history(), dims, options), "long_v") == {(1,)}
    everything = OPTIONS.override(partitioning="INDEFINITE")
    assert as_set(enrich.history_rows(src.history(), dims, everything), "long_v", "partition") == {
        (1, 0),
        (6, 0),
    }


def test_only_time_uuids_on_request(spark):
    random_id = "550e8400-e29b-41d4-a716-000000000001"
    both = spark.createDataFrame([(eid(1),), (random_id,)], "id string")
    src = source(spark, [row(eid(1), 1, TS), row(random_id, 1, TS)], device=both)
    dims = load_dimensions(src)
    assert enrich.history_rows(src.history(), dims, OPTIONS).count() == 2
    strict = OPTIONS.override(time_uuid_only=True)
    assert as_set(enrich.rejected_rows(src.history(), dims, strict), "entity_id", "reason") == {
        (random_id, "BAD_UUID")
    }


def test_cast_applies_to_history_and_latest(spark):
    rows = [row(eid(1), 1, TS, str_v="42"), row(eid(1), 2, TS, str_v="x", json_v='{"a": 1}')]
    src = source(spark, rows, latest=rows)
    dims = load_dimensions(src)
    casting = OPTIONS.override(cast_strings=True)
    want = {("temperature", None, 42, None), ("humidity", "x", None, '{"a": 1}')}
    columns = ("key", "str_v", "long_v", "json_v")
    assert as_set(enrich.history_rows(src.history(), dims, casting), *columns) == want
    assert as_set(enrich.latest_rows(src.latest(), dims, casting), *columns) == want
    assert as_set(enrich.latest_rows(src.latest(), dims, OPTIONS), "long_v") == {(None,)}


def test_index_latest_and_counts(spark):
    rows = [
        row(eid(1), 1, TS, long_v=1),
        row(eid(1), 1, TS + 1, str_v="new"),
        row(eid(2), 1, TS, dbl_v=0.5),
        row(eid(99), 1, TS + 9, long_v=0),
        row(eid(99), 2, TS + 9, long_v=0),
    ]
    src = source(spark, rows)
    dims = load_dimensions(src)
    history = enrich.history_rows(src.history(), dims, OPTIONS)
    assert enrich.index_rows(history).count() == 2
    latest = agg.latest_from_history(history)
    assert as_set(latest, "entity_id", "ts", "long_v", "str_v") == {
        (eid(1), TS + 1, None, "new"),
        (eid(2), TS, None, None),
    }
    rejected = enrich.rejected_rows(src.history(), dims, OPTIONS)
    assert as_set(agg.skipped_counts(rejected)) == {("UNKNOWN_ENTITY", 1, 2)}
    assert as_set(agg.migrated_counts(history)) == {("DEVICE", 2, 2, 3)}
    assert as_set(agg.preload_summary(src.history(), dims)) == {(9, 2, 5)}


def test_watermark_and_lag(spark):
    rows = [row(eid(1), 1, TS, long_v=1), row(eid(99), 1, TS + 9, long_v=0)]
    src = source(spark, rows)
    dims = load_dimensions(src)
    advanced = agg.advance_watermark(src.history(), dims, OPTIONS, 5)
    assert advanced.first()[0] == TS
    assert agg.advance_watermark(src.history(), dims, OPTIONS, TS + 50).first()[0] == TS + 50
    none = src.history().filter("ts < 0")
    assert agg.advance_watermark(none, dims, OPTIONS, 5).first()[0] == 5
    for distance, ready in ((29_999, True), (30_000, False)):
        report = agg.lag_report(advanced, TS + distance, OPTIONS).first()
        assert (report["lag_ms"], report["ready"]) == (distance, ready)


def test_pending(spark):
    entities = spark.createDataFrame([(eid(n),) for n in range(1, 6)], "entity_id string")
    done = Dimension.measure(entities.filter(f"entity_id <= '{eid(2)}'"))
    for options in (OPTIONS, SHUFFLE):
        assert agg.pending_entities(entities, done, options).count() == 3
        assert as_set(agg.entity_progress(entities, done, options)) == {(5, 3, 2)}
