"""Which directories are read and merged, and compaction of the crowded ones."""

import pytest
from helpers import as_set, eid, row, source
from test_jobs import DAY, OPTIONS, TS, rows_of

from kvloom.plans import jobs
from kvloom.plans import manifest as m
from kvloom.plans.manifest import Batch, Entry, overlaps
from kvloom.plans.target import HISTORY, INDEX, LATEST, Target


@pytest.fixture
def target(spark, tmp_path):
    return Target(spark, str(tmp_path / "target"))


def live(target, src, run, number, rows):
    given = source(target.spark, rows)
    return jobs.apply_live_batch(given.history(), src, target, OPTIONS, run, number, streamed=True)


def started(spark, target, days=range(0, 120, 3)):
    src = source(spark, rows_of(1, 2, days=days))
    jobs.run_historical(src, target, OPTIONS)
    return src, jobs.start_live_run(target, OPTIONS, None, watermark=0).run


def scanned(df, below):
    """Files under the scans that feed a node of the plan, by the text of the plan."""
    return [f for f in df.inputFiles() if below in f]


def test_only_the_touched_directory_is_merged(spark, target):
    src, run = started(spark, target)
    months = len(target.manifest.entries(HISTORY))
    assert months == 5
    live(target, src, run, 0, [row(eid(1), 1, TS, str_v="late"), row(eid(2), 1, TS + DAY, str_v="new")])
    entries = target.manifest.entries(HISTORY)
    (found,) = overlaps(entries)
    assert (found.bucket, found.low, found.high) == (1717200000000, TS, TS + DAY)
    touched = [e for e in entries if e.directory() == (found.entity_type, found.bucket)]
    # The scan under the aggregation has the files of that month: one of each of two batches.
    merging = target.committed(HISTORY, touched)
    assert len(merging.inputFiles()) == 2 < len(target.history().inputFiles()) == months + 1
    assert all("bucket=1717200000000" in f for f in merging.inputFiles())
    plan = target.history()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    history = {(r["entity_id"], r["ts"]): r["str_v"] for r in target.history().collect()}
    assert len(history) == 81 and history[eid(1), TS] == "late" and history[eid(2), TS + DAY] == "new"


def test_nothing_is_merged_without_live_rows(spark, target):
    started(spark, target)
    plan = target.history()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_two_historical_runs_are_merged_where_they_meet(spark, target):
    jobs.run_historical(source(spark, rows_of(1, days=range(0, 60))), target, OPTIONS)
    newer = [row(eid(1), 1 + d % 2, TS + d * DAY, str_v="again") for d in range(50, 120)]
    jobs.run_historical(source(spark, newer), target, OPTIONS)
    history = {r["ts"]: r["str_v"] for r in target.history().collect()}
    assert len(history) == 120 and sum(v == "again" for v in history.values()) == 70
    assert len(overlaps(target.manifest.entries(HISTORY))) == 1


def test_what_is_not_committed_is_not_read(spark, target):
    src, run = started(spark, target)
    batch = Batch("live", run, 0)
    shaped = jobs.shape_history(
        source(spark, [row(eid(1), 1, TS, str_v="lost")]).history(), jobs.load_dimensions(src), OPTIONS
    )
    target._write_directories(shaped, batch, "MONTHS", 1)
    assert "lost" not in {r["str_v"] for r in target.history().collect()}
    assert target.written(batch) == (0, None)
    live(target, src, run, 0, [row(eid(1), 1, TS, str_v="kept")])
    assert target.written(batch) == (1, TS)
    assert "kept" in {r["str_v"] for r in target.history().collect()}


def test_only_crowded_directories_are_rewritten(spark, target):
    src, run = started(spark, target)
    for n in range(4):
        rows = [row(eid(1), 1, TS, long_v=100 + n), row(eid(2), 2, TS + n * DAY, long_v=n)]
        live(target, src, run, n, rows + ([row(eid(1), 1, TS + 90 * DAY, str_v="x")] if n == 0 else []))
    before = {v: as_set(getattr(target, v)()) for v in ("history", "latest", "partition_index")}
    old = target.manifest.entries(HISTORY)
    assert target.compact_crowded(OPTIONS, most_live=3) == 3
    assert target.compact_crowded(OPTIONS, most_live=3) == 0
    new = target.manifest.entries(HISTORY)
    assert {e.place() for e in old if e.bucket != 1717200000000} < {e.place() for e in new}
    (only,) = [e for e in new if e.bucket == 1717200000000]
    assert only.batch.stage == m.COMPACTED and [o.bucket for o in overlaps(new)] == [1725148800000]
    assert all(len(target.manifest.entries(t)) == 1 for t in (INDEX, LATEST))
    for view, rows in before.items():
        assert as_set(getattr(target, view)()) == rows
    # Later batches win over the compacted one, and may be compacted again.
    for n in range(4, 8):
        live(target, src, run, n, [row(eid(1), 1, TS, long_v=100 + n)])
    for _ in range(2):
        assert (eid(1), TS, 107) in as_set(target.history(), "entity_id", "ts", "long_v")
        assert target.history().count() == len(before["history"])
        target.compact_crowded(OPTIONS, most_live=3)
    one = target.series_slice("DEVICE", eid(1), "temperature", 1717200000000, "MONTHS")
    assert one.filter(f"ts = {TS}").first()["long_v"] == 107


def test_a_stopped_compaction_leaves_the_old_view(spark, target, monkeypatch):
    src, run = started(spark, target)
    for n in range(3):
        live(target, src, run, n, [row(eid(1), 1, TS, long_v=n)])
    before = as_set(target.history())

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(m.Manifest, "commit", stop)
        with pytest.raises(RuntimeError):
            target.compact_crowded(OPTIONS, most_live=1)
    assert as_set(target.history()) == before
    files = len(target.stored(HISTORY).inputFiles())
    target.compact_crowded(OPTIONS, most_live=1)
    assert as_set(target.history()) == before
    assert len(target.stored(HISTORY).inputFiles()) == files + 1
    assert {e.batch.batch for e in target.manifest.entries(HISTORY) if e.batch.stage == m.COMPACTED} == {2}


def test_overlaps_by_stage():
    def entry(stage, run, batch, low, high, bucket=0):
        return Entry(HISTORY, Batch(stage, run, batch), "DEVICE", bucket, 1, low, high)

    assert overlaps([entry("history", 1, 0, 0, 9), entry("history", 1, 1, 10, 19)]) == []
    (one,) = overlaps([entry("history", 1, 0, 0, 9), entry("live", 2, 0, 5, 30), entry("live", 2, 1, 3, 4)])
    assert (one.low, one.high) == (3, 30)
    (two,) = overlaps([entry("compacted", 1, 1, 0, 50), entry("history", 3, 0, 7, 8)])
    assert (two.low, two.high) == (7, 8)
    assert overlaps([entry("compacted", 1, 1, 0, 50), entry("history", 3, 0, 7, 8, bucket=1)]) == []
