"""Rows stored by entity: what a page reads of them; bitmaps of entities."""

import random

import pyarrow.parquet as pq
import pytest
from helpers import as_set, eid, row, ts_kv
from pyspark.sql import functions as F

from kvloom.model import RunOptions
from kvloom.operators import bitmaps
from kvloom.sources import Dimension, ParquetSource
from kvloom.sources import queries as sq
from kvloom.sources.clustered import store_clustered

TS = 1718445600000
OPTIONS = RunOptions(rows_per_file=2000, row_group_bytes=1 << 20, entities_per_file=100)


def scanned_rows(df):
    """Rows that the scans of an executed plan let through, and the files they opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PushedFilters" in text
    while plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    todo, rows, files = [plan], 0, 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            rows += node.metrics().apply("numOutputRows").value()
            files += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
    return rows, files


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """10,000 rows, a third of one entity, in five files."""
    rnd = random.Random(3)
    rows = [
        row(eid(50 if n % 3 == 0 else rnd.randrange(1, 100) * 2), n % 4, TS + n, long_v=n) for n in range(10_000)
    ]
    rows += [row(None, 1, TS)]
    folder = str(tmp_path_factory.mktemp("clustered"))
    store_clustered(ts_kv(spark, rows), f"{folder}/ts_kv", OPTIONS)
    return folder, rows


def test_a_page_reads_the_row_groups_of_its_entity(spark, stored):
    folder, rows = stored
    history = ParquetSource(spark, folder).history()
    files = history.inputFiles()
    assert history.count() == len(rows) and 4 <= len(files) <= 6
    page = sq.entity_page(history, eid(8), RunOptions())
    expected = sorted((r[1], r[2]) for r in rows if r[0] == eid(8))
    assert [(r["key"], r["ts"]) for r in page.collect()] == expected
    read, _ = scanned_rows(page)
    assert len(expected) <= read <= len(rows) / 2
    # An id between others, in no file: the bloom filters leave nothing to read.
    nothing = sq.entity_page(history, eid(9), RunOptions())
    assert scanned_rows(nothing)[0] == 0
    behind = sq.entities_after(history, eid(190))
    assert as_set(behind) == {(eid(n),) for n in (192, 194, 196, 198)}
    assert scanned_rows(behind)[0] < len(rows) / 2


def test_files_are_ranges_in_order_with_filters(stored):
    folder, rows = stored
    import glob

    bounds = []
    for path in glob.glob(f"{folder}/ts_kv/*.parquet"):
        file = pq.ParquetFile(path)
        table = file.read(columns=["entity_id", "key", "ts"]).to_pylist()
        places = [(r["entity_id"] or "", r["key"], r["ts"]) for r in table]
        assert places == sorted(places) and len(places) < len(rows) / 2
        bounds.append((places[0], places[-1]))
    bounds.sort()
    # The hot entity is in more than one file.
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert sum(low[0] <= eid(50) <= high[0] for low, high in bounds) > 1


def test_small_files_need_no_ranges_of_their_own(spark, tmp_path):
    """1,000 files of 10 rows: the driver is sent a sample for 200 ranges, not for all files."""
    rows = [row(eid(n % 70), n % 3, TS + n, long_v=n) for n in range(10_000)]
    folder = f"{tmp_path}/ts_kv"
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("clustered", "clustered")
    try:
        store_clustered(ts_kv(spark, rows), folder, RunOptions(rows_per_file=10))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("clustered") for s in tracker.getJobInfo(j).stageIds]
    infos = [tracker.getStageInfo(s) for s in stages]
    assert max(i.numTasks for i in infos if i) <= 200
    files = sorted(tmp_path.glob("ts_kv/*.parquet"))
    tables = [pq.read_table(f, columns=["entity_id", "key", "ts"]).to_pylist() for f in files]
    places = [[(r["entity_id"], r["key"], r["ts"]) for r in t] for t in tables]
    assert len(places) >= 1000 and max(map(len, places)) <= 10
    assert all(p == sorted(p) for p in places)
    places.sort()
    assert [p for part in places for p in part] == sorted((r[0], r[1], r[2]) for r in rows)


def test_ordinals_are_dense(spark):
    ids = spark.createDataFrame([(eid(n % 70),) for n in range(200)] + [(None,)], "entity_id string")
    found = bitmaps.entity_ordinals(ids.repartition(7))
    assert sorted(r["ordinal"] for r in found.collect()) == list(range(1, 71))
    assert found.select("entity_id").distinct().count() == 70
    assert as_set(found) == as_set(bitmaps.entity_ordinals(ids.repartition(2)))
    assert bitmaps.entity_ordinals(ids.limit(0)).count() == 0


def test_bitmaps_of_slices_are_merged(spark):
    many = spark.range(1, 70_001).select(F.concat(F.lit("e"), "id").alias("entity_id"))
    ordinals = Dimension.measure(bitmaps.entity_ordinals(many))
    slices = [many.filter(f"hash(entity_id) % 5 = {n} OR hash(entity_id) % 5 = {n + 1}") for n in (0, 1, 2)]
    other = spark.createDataFrame([("unknown",), (None,)], "entity_id string")
    for options in (RunOptions(), RunOptions(broadcast_max_rows=0)):
        found = [bitmaps.slice_bitmaps(s.union(s).union(other), ordinals, options) for s in slices]
        assert found[0].count() == 3  # 32,768 entities a bitmap
        both = found[0].union(found[1]).union(found[2])
        expected = many.filter("hash(entity_id) % 5 BETWEEN 0 AND 3").count()
        row_ = bitmaps.progress_of(both, ordinals.rows).first()
        assert (row_.total_entities, row_.done_entities) == (70_000, expected)
        assert row_.pending_entities == 70_000 - expected
    assert bitmaps.progress_of(found[0].limit(0), 5).first().asDict() == {
        "total_entities": 5, "pending_entities": 5, "done_entities": 0
    }
