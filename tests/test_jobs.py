from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from helpers import as_set, eid, row, source, ts_kv
from pyspark.sql import functions as F

from kvloom.model import HISTORY_COLUMNS, RunOptions
from kvloom.operators.aggregates import latest_per_series
from kvloom.plans import jobs
from kvloom.plans.extent import Extent
from kvloom.plans.progress import Progress, ProgressLog, Slice, status_report
from kvloom.plans.target import HISTORY, Batch, Target
from kvloom.sources import load_dimensions

OPTIONS = RunOptions()
DAY = 86_400_000
TS = 1718445600000  # 2024-06-15


def rows_of(*entities, days=range(40)):
    return [row(eid(n), 1 + d % 2, TS + d * DAY, long_v=d) for n in entities for d in days]


@pytest.fixture
def target(spark, tmp_path):
    return Target(spark, str(tmp_path / "target"))


def state_of(target):
    return ProgressLog(target.spark, target.root).find()


def test_schema_report_and_empty_tables(target):
    report = target.init_schema()
    target.init_schema()
    counts = {r["table_name"]: r["count"] for r in report.groupBy("table_name").count().collect()}
    assert counts == {"ts_kv_cf": 10, "ts_kv_partitions_cf": 4, "ts_kv_latest_cf": 9}
    assert target.history().columns == HISTORY_COLUMNS and target.history().isEmpty()
    assert target.partition_index().isEmpty() and target.latest().isEmpty()
    assert target.rejected().isEmpty()


def test_empty_source_is_a_no_op(spark, target):
    state = jobs.run_historical(source(spark, []), target, OPTIONS)
    assert (state.phase, state.migrated_rows, state.skipped_rows) == ("live_sync", 0, 0)
    assert target.history().isEmpty() and target.latest().isEmpty()


@pytest.mark.parametrize("slices", [1, 3])
def test_historical_run(spark, target, slices):
    data = rows_of(1, 2) + rows_of(99, days=range(3))
    latest = rows_of(1, 2, 99, days=[39])
    src = source(spark, data, latest)
    state = jobs.run_historical(src, target, OPTIONS.override(slices=slices), now_ms=TS)
    assert state.phase == "live_sync" and state.phase1_start_ts == TS
    assert (state.total_rows, state.migrated_rows) == (83, 80)
    assert (state.skipped_rows, state.skipped_entities) == (3, 1)
    assert (state.completed_entities, state.last_entity_id) == (2, eid(2))
    assert len(state.slices) == slices and not state.slices_left()
    dims = load_dimensions(src)
    want = as_set(jobs.history_rows(src.history(), dims, OPTIONS))
    assert target.history().count() == 80 and as_set(target.history()) == want
    assert target.partition_index().count() == 2 * 2 * 2
    assert as_set(target.latest(), "entity_id", "ts") == {(eid(n), TS + 39 * DAY) for n in (1, 2)}
    assert as_set(target.rejected(), "entity_id", "reason") == {(eid(99), "UNKNOWN_ENTITY")}
    assert target.rejected().count() == 3


def test_a_second_full_run_changes_nothing(spark, target):
    src = source(spark, rows_of(1, 2))
    jobs.run_historical(src, target, OPTIONS)
    state = jobs.run_historical(src, target, OPTIONS)
    assert state.run == 2
    assert target.history().count() == 80 == len(as_set(target.history()))


def test_resume_after_a_failure(spark, target, monkeypatch):
    src = source(spark, rows_of(1, 2))
    options = OPTIONS.override(slices=4)
    write_index = Target.write_index

    def failing(self, batch):
        if batch.batch == 2:
            raise RuntimeError("lost")
        write_index(self, batch)

    monkeypatch.setattr(Target, "write_index", failing)
    with pytest.raises(RuntimeError):
        jobs.run_historical(src, target, options, now_ms=TS)
    stopped = state_of(target)
    # The phase does not move on, and no entity is complete.
    assert stopped.phase == "phase1" and stopped.completed_entities == 0
    assert [s.done for s in stopped.slices] == [True, True, False, False]

    written = []
    monkeypatch.setattr(Target, "write_index", lambda s, b: (written.append(b.batch), write_index(s, b)))
    state = jobs.run_historical(src, target, options, resume=True, now_ms=TS + 999)
    assert written == [2, 3]
    assert state.run == stopped.run and state.phase1_start_ts == TS
    assert (state.migrated_rows, state.completed_entities) == (80, 2)
    assert target.history().count() == 80 == len(as_set(target.history()))
    assert target.stored(HISTORY).filter("outcome = 'accepted'").count() == 80


def test_entities_are_complete_slice_by_slice(spark, target, monkeypatch):
    everyone = rows_of(*range(1, 10), days=range(6)) + rows_of(99, days=[1, 2])
    # One id in two spellings, and one that is none.
    everyone += [row(eid(3).upper(), 1, TS + 77 * DAY, long_v=77), row("no id", 1, TS)]
    src = source(spark, everyone)
    options = OPTIONS.override(slices=4, slice_by="entity")
    write_index = Target.write_index

    def failing(self, batch):
        if batch.batch == 2:
            raise RuntimeError("lost")
        write_index(self, batch)

    monkeypatch.setattr(Target, "write_index", failing)
    with pytest.raises(RuntimeError):
        jobs.run_historical(src, target, options, now_ms=TS)
    stopped = state_of(target)
    assert stopped.staged and [s.done for s in stopped.slices] == [True, True, False, False]
    complete = as_set(target.completed(stopped))
    assert 0 < len(complete) == stopped.completed_entities < 9
    # All rows of a complete entity are there, though the run is in its middle.
    written = target.history().groupBy("entity_id").count().collect()
    assert {(r["entity_id"],) for r in written if r["count"] >= 6} >= complete

    monkeypatch.setattr(Target, "write_index", write_index)
    nothing = src.replacing(ts_kv=ts_kv(spark, []))
    state = jobs.run_historical(nothing, target, options, resume=True)
    assert (state.migrated_rows, state.completed_entities, state.last_entity_id) == (55, 9, eid(9))
    assert (state.total_rows, state.skipped_rows, state.skipped_entities) == (58, 3, 2)
    dims = load_dimensions(src)
    assert as_set(target.history()) == as_set(jobs.history_rows(src.history(), dims, OPTIONS))
    assert target.history().filter(f"entity_id = '{eid(3)}'").count() == 7

    # Entities that come later are taken by a slice of their own, from the source.
    grown = source(spark, everyone, device=spark.createDataFrame([(eid(n),) for n in (*range(1, 10), 99)], "id string"))
    state = jobs.run_historical(grown, target, options, resume=True)
    assert (state.migrated_rows, state.completed_entities) == (57, 10)
    with pytest.raises(ValueError):
        jobs.run_historical(src, target, OPTIONS, resume=True)


def test_rejects_are_replayed_once_their_entity_is_known(spark, target, monkeypatch):
    given = rows_of(1, days=range(3)) + rows_of(20, 21, days=range(3)) + [row("no id", 1, TS), row(eid(20), 9, TS)]
    src = source(spark, given)
    jobs.run_historical(src, target, OPTIONS)
    run = jobs.start_live_run(target, OPTIONS, None, watermark=0).run
    # The same rejects came again with other values.
    newer = source(spark, [row(eid(20), 1, TS, str_v="newer"), row(eid(20), 2, TS + 9 * DAY, str_v="late")])
    jobs.apply_live_batch(newer.history(), src, target, OPTIONS, run, 0)
    assert jobs.replay_rejected(src, target, OPTIONS) == 0
    grown = src.replacing(device=spark.createDataFrame([(eid(n),) for n in (1, 20)], "id string"))

    def stop(*_):
        raise RuntimeError("stopped")

    for step in ("write_index", "write_latest", "_write_whole"):
        with monkeypatch.context() as patch:
            patch.setattr(Target, step, stop)
            with pytest.raises(RuntimeError):
                jobs.replay_rejected(grown, target, OPTIONS)
        assert target.history().count() == 3
    assert jobs.replay_rejected(grown, target, OPTIONS) == 5
    assert jobs.replay_rejected(grown, target, OPTIONS) == 0
    mine = target.history().filter(f"entity_id = '{eid(20)}'")
    assert as_set(mine, "key", "ts", "str_v", "long_v") == {
        ("temperature", TS, "newer", None), ("humidity", TS + DAY, None, 1), ("temperature", TS + 2 * DAY, None, 2),
        ("humidity", TS + 9 * DAY, "late", None), ("9", TS, None, None),
    }
    assert as_set(target.rejected(), "entity_id") == {(eid(21),), ("no id",)} and target.rejected().count() == 4
    latest = as_set(target.latest().filter(f"entity_id = '{eid(20)}'"), "key", "ts")
    assert latest == {("temperature", TS + 2 * DAY), ("humidity", TS + 9 * DAY), ("9", TS)}
    assert target.partition_index().filter(f"entity_id = '{eid(20)}'").count() == 3
    # Live rows that come later go before what was replayed.
    again = source(spark, [row(eid(20), 1, TS, str_v="newest")])
    jobs.apply_live_batch(again.history(), grown, target, OPTIONS, run, 1)
    jobs.apply_live_batch(again.history(), grown, target, OPTIONS, run, 1)
    assert "newest" in {r["str_v"] for r in target.history().collect()}


def test_rows_are_ordered_by_a_hash_before_their_key(spark):
    rows = ts_kv(spark, [row(eid(1), 1, TS, str_v="a"), row(eid(1), 1, TS + 1, json_v="b"), row(None, 2, TS)])
    newest = latest_per_series(rows, ["entity_id", "key"])
    assert as_set(newest) == {(eid(1), 1, TS + 1, None, None, None, None, "b"), (None, 2, TS, None, None, None, None, None)}
    assert newest.columns == rows.columns
    sorts = [p for p in newest._jdf.queryExecution().executedPlan().toString().splitlines() if " Sort [" in p]
    assert sorts and not any("Sort [entity_id" in p for p in sorts)


def test_a_replay_makes_its_rows_once(spark, target, monkeypatch):
    jobs.run_historical(source(spark, rows_of(1, 20)), target, OPTIONS)
    grown = source(spark, [], device=spark.createDataFrame([(eid(n),) for n in (1, 20)], "id string"))
    closed = []
    write = Target.write_replay
    monkeypatch.setattr(Target, "write_replay", lambda self, *a: (closed.append(a[1]), write(self, *a)))
    assert jobs.replay_rejected(grown, target, OPTIONS) == 40
    # What is read several times lies in files; nothing is made again from the rejects.
    assert all("/staging/stage=replay/" in f for f in closed[0].inputFiles())
    assert "Aggregate" not in closed[0]._jdf.queryExecution().executedPlan().toString()
    assert jobs.replay_rejected(grown, target, OPTIONS) == 0 and target.rejected().isEmpty()


def test_resume_of_a_complete_run_takes_new_entities_only(spark, target):
    unknown = rows_of(99, days=[1, 2])
    jobs.run_historical(source(spark, rows_of(1) + unknown), target, OPTIONS)
    grown = source(spark, rows_of(1, days=range(60)) + rows_of(2) + unknown)
    state = jobs.run_historical(grown, target, OPTIONS, resume=True)
    added = target.written_history(Batch("history", state.run, 1))
    assert as_set(added, "entity_id") == {(eid(2),)} and added.count() == 40
    assert target.history().count() == state.migrated_rows == 80
    assert (state.completed_entities, state.skipped_rows, state.skipped_entities) == (2, 2, 1)
    assert target.rejected().count() == 2
    again = jobs.run_historical(grown, target, OPTIONS, resume=True)
    assert len(again.slices) == 2 and target.history().count() == 80


def test_resume_without_a_record_starts_anew(spark, target):
    state = jobs.run_historical(source(spark, rows_of(1)), target, OPTIONS, resume=True)
    assert state.run == 1 and state.migrated_rows == 40


def test_slices_cover_everything(spark):
    cut = Extent(10, (-2, 1, 1)).cut()
    assert cut[0].low is None and cut[-1].high is None
    assert [s.high for s in cut[:-1]] == [s.low for s in cut[1:]] == [-2, 1]
    assert Extent(0).cut() == (Slice(0),)


def test_a_stray_ts_changes_neither_slices_nor_files(spark):
    second = spark.range(1000).select((F.lit(TS) + F.col("id")).alias("ts"))
    for stray in (0, 253_000_000_000_000):
        extent = Extent.of(second.union(spark.range(1).select(F.lit(stray).alias("ts"))), 10)
        cut = extent.cut()
        sizes = [jobs.within(second, s).count() for s in cut]
        assert sum(sizes) == 1000 and max(sizes) <= 2 * 1000 / len(cut) and len(cut) == 10
        assert extent.months == 2 and extent.files_per_directory(OPTIONS.override(rows_per_file=100)) == 5
    assert Extent.of(second.limit(0), 4).cut() == (Slice(0),)


def test_files_per_directory():
    year = Extent(12_000_000, (), 13, 1)
    assert year.files_per_directory(OPTIONS.override(rows_per_file=100_000)) == 9
    assert year.files_per_directory(OPTIONS) == 1
    one = OPTIONS.override(rows_per_file=100_000, partitioning="INDEFINITE")
    assert year.files_per_directory(one) == 120


def test_settings_of_a_run_cannot_change(spark, target):
    src = source(spark, rows_of(1))
    jobs.run_historical(src, target, OPTIONS)
    days = OPTIONS.override(partitioning="DAYS")
    with pytest.raises(ValueError, match="partitioning"):
        jobs.run_historical(src, target, days, resume=True)
    with pytest.raises(ValueError, match="partitioning"):
        jobs.poll_live(src, target, days, 1)
    with pytest.raises(ValueError, match="cast_strings"):
        jobs.start_live_run(target, OPTIONS.override(cast_strings=True), None)


def test_start_watermark(spark, target):
    src = source(spark, rows_of(1))
    state = jobs.run_historical(src, target, OPTIONS, now_ms=TS)
    assert jobs.start_live_run(target, OPTIONS, None, 0, now_ms=TS).watermark_ts == 0
    first = jobs.start_live_run(target, OPTIONS, None, TS + 5, now_ms=TS + 1)
    assert first.watermark_ts == first.start_watermark_ts == TS + 5
    # A resumed historical run leaves the newest record, without a watermark.
    jobs.run_historical(src, target, OPTIONS, resume=True, now_ms=TS + 2)
    assert jobs.start_live_run(target, OPTIONS, None, now_ms=TS + 3).watermark_ts == TS + 5
    assert state.phase1_start_ts == TS


def test_rejected_rows_stay_as_they_came(spark, target):
    rows = [
        row(eid(50), 1, TS, str_v="0042"),
        row(eid(50), 2, TS, str_v="x"),
        row(None, 1, TS, str_v="7"),
        row(None, 1, TS, str_v="7"),
        row(eid(1), 1, None, str_v="8"),
    ]
    options = OPTIONS.override(cast_strings=True)
    state = jobs.run_historical(source(spark, rows), target, options)
    found = [tuple(r) for r in target.rejected().select("key", "str_v", "long_v").collect()]
    expected = [("1", "0042", None), ("2", "x", None), ("1", "7", None), ("1", "7", None), ("1", "8", None)]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert state.skipped_rows == 5
    after = Target(spark, target.root + "-after")
    target.compact(after, options, 1)
    assert after.rejected().count() == 5


def test_replayed_live_batch_changes_nothing(spark, target):
    src = source(spark, rows_of(1, 2))
    state = jobs.start_live_run(target, OPTIONS, None, watermark=TS + 29 * DAY, now_ms=TS)
    for _ in range(3):
        done = jobs.apply_live_batch(src.history(), src, target, OPTIONS, state.run, 0, TS)
    assert done.watermark_ts == TS + 39 * DAY and done.lag_ms == -39 * DAY
    assert target.history().count() == 20
    assert target.stored(HISTORY).count() == 20
    assert as_set(target.latest(), "entity_id", "key", "ts") == {
        (eid(n), k, TS + d * DAY) for n in (1, 2) for k, d in (("temperature", 38), ("humidity", 39))
    }


def test_live_row_replaces_history_row(spark, target):
    jobs.run_historical(source(spark, rows_of(1), rows_of(1, days=[39])), target, OPTIONS)
    change = [row(eid(1), 2, TS + 39 * DAY, str_v="changed"), row(eid(1), 1, TS + 40 * DAY, bool_v=True)]
    later = source(spark, change)
    state = jobs.start_live_run(target, OPTIONS, None, watermark=TS + 38 * DAY)
    jobs.apply_live_batch(later.history(), later, target, OPTIONS, state.run, 0)
    history = target.history()
    assert history.count() == 41
    replaced = history.filter(F.col("ts") == TS + 39 * DAY).collect()
    # The whole row is replaced, the old value does not remain beside it.
    assert [(r["str_v"], r["long_v"]) for r in replaced] == [("changed", None)]
    latest = as_set(target.latest(), "key", "ts", "str_v", "bool_v", "long_v")
    assert latest == {
        ("humidity", TS + 39 * DAY, "changed", None, None),
        ("temperature", TS + 40 * DAY, None, True, None),
    }


def test_late_and_unknown_rows(spark, target):
    state = jobs.start_live_run(target, OPTIONS, None, watermark=TS)
    first = source(spark, [row(eid(1), 1, TS + 10, long_v=1), row(eid(99), 1, TS + 90, long_v=1)])
    done = jobs.apply_live_batch(first.history(), first, target, OPTIONS, state.run, 0)
    assert done.watermark_ts == TS + 10
    second = source(spark, [row(eid(1), 1, TS + 9, long_v=2), row(eid(1), 1, TS + 11, long_v=3)])
    done = jobs.apply_live_batch(second.history(), second, target, OPTIONS, state.run, 1)
    assert done.watermark_ts == TS + 11
    assert as_set(target.history(), "ts") == {(TS + 10,), (TS + 11,)}
    wide = OPTIONS.override(overlap_ms=5)
    third = source(spark, [row(eid(1), 1, TS + 8, long_v=4), row(eid(1), 1, TS + 6, long_v=5)])
    jobs.apply_live_batch(third.history(), third, target, wide, state.run, 2)
    assert (TS + 8,) in as_set(target.history(), "ts")
    assert (TS + 6,) not in as_set(target.history(), "ts")


def test_start_watermark(spark, target):
    jobs.run_historical(source(spark, rows_of(1)), target, OPTIONS, now_ms=TS + 20 * DAY)
    state = jobs.start_live_run(target, OPTIONS, None)
    assert state.watermark_ts == TS + 20 * DAY - 60_000
    src = source(spark, rows_of(1))
    jobs.apply_live_batch(src.history(), src, target, OPTIONS, state.run, 0)
    # A later live run goes on from the saved watermark under its own number.
    following = jobs.start_live_run(target, OPTIONS, None)
    assert following.watermark_ts == TS + 39 * DAY and following.run == state.run + 1


def test_whole_job(spark, target):
    options = OPTIONS.override(live_sync_interval=0.0)
    src = source(spark, rows_of(1))
    assert jobs.run_job(src, target, options, historical_only=True).stage == "history"
    state = jobs.run_job(src, target, options, resume=True, cycles=2)
    assert (state.stage, state.step, state.phase) == ("live", 2, "live_sync")
    assert target.history().count() == 40


def test_compaction(spark, tmp_path, target):
    src = source(spark, rows_of(1, 2), rows_of(1, 2, days=[39]))
    jobs.run_historical(src, target, OPTIONS)
    state = jobs.start_live_run(target, OPTIONS, None, watermark=TS)
    jobs.apply_live_batch(src.history(), src, target, OPTIONS, state.run, 0)
    compacted = Target(spark, str(tmp_path / "compacted"))
    target.compact(compacted, OPTIONS, 1)
    assert compacted.stored(HISTORY).count() == 80 < target.stored(HISTORY).count()
    for view in ("history", "partition_index", "latest"):
        before, after = (as_set(getattr(t, view)()) for t in (target, compacted))
        assert before == after and before
    assert jobs.start_live_run(compacted, OPTIONS, None).watermark_ts == TS + 39 * DAY


def test_fine_buckets_share_a_directory_and_are_pruned(spark, target):
    options = OPTIONS.override(partitioning="DAYS")
    jobs.run_historical(source(spark, rows_of(1, 2)), target, options)
    names = as_set(target.stored(HISTORY), "bucket")
    assert names == {(1717200000000,), (1719792000000,)}
    one = target.series_slice("DEVICE", eid(1), "temperature", 1718409600000, "DAYS")
    assert [r["ts"] for r in one.collect()] == [TS]
    plan = one._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "entity_type" in pruned and "bucket" in pruned and "1717200000000" in pruned


def test_files_are_in_key_order(spark, target):
    mixed = [row(eid(n), k, TS + (d * 7 % 20) * DAY) for d in range(20) for n in (2, 1) for k in (2, 1)]
    jobs.run_historical(source(spark, mixed), target, OPTIONS)
    files = [p.removeprefix("file:") for p in target.stored(HISTORY).inputFiles()]
    assert len(files) == 2
    for file in files:
        names = ("entity_id", "key", "ts")
        table = pq.ParquetFile(file).read(columns=list(names))
        keys = list(zip(*(table[c].to_pylist() for c in names)))
        assert keys == sorted(keys) and len(keys) > 1


def test_progress_round_trip(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path))
    assert log.find() is None and log.last_run() == 0
    first = log.save(Progress(run=3, saved_ms=1, slices=(Slice(0, None, 5), Slice(1, 5, None, done=True))))
    assert log.find() == first
    for step in range(1, 10):
        last = log.save(replace(first, step=step, saved_ms=step, migrated_rows=step))
    assert log.find() == last and log.table().count() <= 4
    assert log.find(F.col("step") == 8).migrated_rows == 8


def test_status_report(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path))
    assert status_report(log.table()).isEmpty()
    log.save(
        Progress(
            phase="phase1", migrated_rows=1_234_567, skipped_rows=42, total_rows=2_469_218,
            started_ms=TS, saved_ms=TS + 10_000, watermark_ts=TS,
        )
    )
    shown = {r["field"]: r["value"] for r in status_report(log.table()).collect()}
    assert shown["Migrated rows"] == "1,234,567" and shown["Cast strings"] == "False"
    assert shown["Started at"] == shown["Watermark"] == "2024-06-15 10:00:00 UTC"
    assert shown["Done"] == "50.0%" and shown["Rows per second"] == "123,461"
    assert shown["Last entity ID"] == "—" and shown["Seconds left"] == "10"


def test_options():
    assert OPTIONS.override(partitioning=None, workers=9).workers == 9
    for wrong in ({"partitioning": "WEEKS"}, {"workers": 0}, {"speed": 1}):
        with pytest.raises(ValueError):
            OPTIONS.override(**wrong)


def test_history_without_adaptive_execution(spark, target):
    src = source(spark, rows_of(1, 2))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = jobs.run_historical(src, target, OPTIONS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert state.migrated_rows == 80 and target.history().count() == 80


def test_large_directories_keep_an_entity_in_one_file(spark, target):
    src = source(spark, rows_of(*range(1, 10)))
    options = OPTIONS.override(partitioning="INDEFINITE", rows_per_file=90)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        jobs.run_historical(src, target, options)
    finally:
        spark.conf.unset(coalesce)
    rows = target.stored(HISTORY).withColumn("file", F.input_file_name())
    assert rows.count() == 360 and rows.select("file").distinct().count() > 1
    assert rows.columns == [*target.stored(HISTORY).columns, "file"] and "_part" not in rows.columns
    per_entity = rows.groupBy("entity_id").agg(F.count_distinct("file").alias("n"))
    assert per_entity.agg(F.max("n")).first()[0] == 1


def test_text_key_source(spark, target):
    rows = ts_kv(spark, [row(eid(1), "temp", TS, long_v=1)], True)
    src = source(spark, [], keys=None, ts_kv=rows, ts_kv_latest=rows)
    jobs.run_historical(src, target, OPTIONS)
    assert as_set(target.history(), "key") == as_set(target.latest(), "key") == {("temp",)}
