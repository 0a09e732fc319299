"""The stream by cursor: pages inside a tie of ts, restarts, ranges, late rows."""

import random

import pyarrow as pa
import pytest
from helpers import as_set, eid, row, source, ts_kv
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kvloom.model import RunOptions, source_schema
from kvloom.plans.target import HISTORY, Target
from kvloom.streaming.cursor import Cursor, CursorStreamReader, ParquetCursorTable, cursor_stream
from kvloom.streaming.live import start_live

TS = 1718445600000


def land(spark, folder, rows, files=1, text_keys=False):
    ts_kv(spark, rows, text_keys).repartition(files).write.mode("append").parquet(folder)


def table(folder, key_type=None):
    return ParquetCursorTable(folder, to_arrow_schema(source_schema(key_type)))


def places(batches):
    found = pa.Table.from_batches(batches).to_pylist() if batches else []
    return sorted((r["ts"], r["entity_id"], r["key"]) for r in found)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Many rows to a ts, in files whose ranges of ts overlap."""
    folder = str(tmp_path_factory.mktemp("cursor") / "rows")
    rnd = random.Random(1)
    rows = {(TS + rnd.randrange(12), eid(rnd.randrange(1, 6)), rnd.randrange(1, 4)) for _ in range(150)}
    half = sorted(rows, key=lambda r: rnd.random())
    for part in (half[:60], half[60:]):
        land(spark, folder, [row(e, k, ts, long_v=ts) for ts, e, k in part], files=3)
    return folder, sorted(rows)


def test_newest_and_pages_follow_the_order(landed):
    folder, rows = landed
    t = table(folder)
    assert t.newest(Cursor()) == Cursor(*rows[-1])
    assert t.newest(Cursor(*rows[-1])) == Cursor(*rows[-1])
    assert t.newest(Cursor(TS + 50)) == Cursor(TS + 50)
    for size in (1, 7, 1000):
        at, seen = Cursor(), []
        while (end := t.page_end(at, size)) != at:
            seen.append(end)
            at = end
        assert seen == [Cursor(*rows[min(i + size, len(rows)) - 1]) for i in range(0, len(rows), size)]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ranges_hold_every_row_once(landed, parts):
    folder, rows = landed
    t = table(folder)
    for low, high in ((None, len(rows) - 1), (10, 90), (30, 31), (5, 6)):
        above = Cursor() if low is None else Cursor(*rows[low])
        found = t.ranges(above, Cursor(*rows[high]), parts)
        assert len(found) <= parts + 1
        read = [b for part in found for b in t.read(part)]
        assert places(read) == rows[0 if low is None else low + 1 : high + 1]
    assert parts == 1 or len(t.ranges(Cursor(), Cursor(*rows[-1]), parts)) > 1


def test_a_watermark_lies_behind_all_rows_of_its_ts(landed):
    folder, rows = landed
    t = table(folder)
    read = [b for part in t.ranges(Cursor(TS + 3), Cursor(TS + 6), 4) for b in t.read(part)]
    assert places(read) == [r for r in rows if TS + 3 < r[0] <= TS + 6]
    assert Cursor(TS, "a", 1).rank() < Cursor(TS, "a", 2).rank() < Cursor(TS).rank() < Cursor(TS + 1, "", 0).rank()


def test_a_missing_folder_and_null_places(spark, tmp_path):
    t = table(str(tmp_path / "none"))
    assert t.newest(Cursor(5)) == Cursor(5) and t.ranges(Cursor(5), Cursor(6), 2) == []
    folder = str(tmp_path / "nulls")
    rows = [row(None, 1, TS - 1), row(eid(1), None, TS - 1), row(eid(1), 1, None), row(eid(1), 2, TS)]
    land(spark, folder, rows)
    t = table(folder)
    assert t.newest(Cursor()) == t.page_end(Cursor(), 9) == Cursor(TS, eid(1), 2)
    read = [b for part in t.ranges(Cursor(), Cursor(TS, eid(1), 2), 2) for b in t.read(part)]
    assert places(read) == [(TS, eid(1), 2)]


def test_a_uri_is_a_folder_too(landed):
    folder, rows = landed
    for uri in (f"file://{folder}", f"file:{folder}"):
        assert table(uri).newest(Cursor()) == Cursor(*rows[-1])


def test_text_keys(spark, tmp_path):
    folder = str(tmp_path / "text")
    land(spark, folder, [row(eid(1), k, TS) for k in ("b", "a", "é", "10", "9")], text_keys=True)
    t = table(folder, T.StringType())
    assert t.newest(Cursor()) == Cursor(TS, eid(1), "é")
    assert t.page_end(Cursor(), 3) == Cursor(TS, eid(1), "a")


def test_the_page_end_is_kept_before_it_is_told(landed, tmp_path):
    folder, rows = landed

    def reader():
        return CursorStreamReader(table(folder), Cursor(), 2, 10, str(tmp_path / "state"))

    assert Cursor.of(reader().latestOffset()) == Cursor(*rows[9])
    # A stream that failed before it knew of that page gets both pages next.
    end = reader().latestOffset()
    assert Cursor.of(end) == Cursor(*rows[19])
    parts = reader().partitions(Cursor().offset(), end)
    assert places([b for p in parts for b in reader().read(p)]) == rows[:20]
    assert reader().partitions(end, end) == []
    with pytest.raises(ValueError):
        CursorStreamReader(table(folder), Cursor(), 2, 10, None)


def run(spark, folder, target, src, checkpoint, available_now=True, **given):
    stream = cursor_stream(spark, folder, **given)
    query = start_live(stream, src, target, RunOptions(live_sync_interval=0.1), checkpoint, 0, available_now)
    if available_now:
        query.awaitTermination()
    else:
        query.processAllAvailable()
        query.stop()


def test_a_restart_inside_a_tie_loses_and_repeats_nothing(spark, tmp_path):
    target, src = Target(spark, str(tmp_path / "target")), source(spark, [])
    folder, checkpoint, state = (str(tmp_path / n) for n in ("rows", "checkpoint", "state"))
    tie = [row(eid(e), k, TS, long_v=10 * e + k) for e in (2, 4, 6) for k in (1, 2)]
    land(spark, folder, tie, files=2)
    given = {"page_rows": 4, "state_dir": state}
    run(spark, folder, target, src, checkpoint, available_now=False, **given)
    # The same ts again, above the cursor, and a later one.
    land(spark, folder, [row(eid(7), 1, TS, long_v=1), row(eid(1), 1, TS + 1, long_v=2)])
    run(spark, folder, target, src, checkpoint, available_now=False, **given)
    stored = target.stored(HISTORY).groupBy("batch").count().collect()
    assert sorted((r["batch"], r["count"]) for r in stored) == [(0, 4), (1, 2), (2, 2)]
    expected = {(eid(e), TS, 10 * e + k) for e in (2, 4, 6) for k in (1, 2)}
    expected |= {(eid(7), TS, 1), (eid(1), TS + 1, 2)}
    assert as_set(target.history(), "entity_id", "ts", "long_v") == expected
    assert target.stored(HISTORY).count() == len(expected)


def test_without_pages_a_batch_takes_what_is_there(spark, tmp_path):
    target, src = Target(spark, str(tmp_path / "target")), source(spark, [])
    folder, checkpoint = str(tmp_path / "rows"), str(tmp_path / "checkpoint")
    land(spark, folder, [row(eid(n), 1, TS + n // 2, long_v=n) for n in range(1, 6)], files=3)
    run(spark, folder, target, src, checkpoint, start_ts=TS)
    run(spark, folder, target, src, checkpoint, start_ts=TS)
    land(spark, folder, [row(eid(8), 1, TS + 2, long_v=8), row(eid(1), 1, TS + 2, long_v=1)])
    run(spark, folder, target, src, checkpoint, start_ts=TS)
    # A row below the cursor is not seen: entity 1 comes before entity 5 at the same ts.
    assert as_set(target.history(), "long_v") == {(n,) for n in (2, 3, 4, 5, 8)}
    assert as_set(target.stored(HISTORY), "batch") == {(0,), (1,)}
