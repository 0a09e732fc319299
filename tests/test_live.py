from helpers import as_set, eid, row, source, ts_kv

from kvloom.model import RunOptions, source_schema
from kvloom.plans import jobs
from kvloom.plans.target import HISTORY, Target
from kvloom.streaming.latest import ROCKS_DB, start_latest
from kvloom.streaming.live import start_live

OPTIONS = RunOptions()
TS = 1718445600000


def land(spark, folder, rows):
    ts_kv(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, target, src, checkpoint, **given):
    stream = spark.readStream.schema(source_schema()).parquet(folder)
    start_live(
        stream, src, target, OPTIONS, checkpoint, available_now=True, **given
    ).awaitTermination()


def test_stream_equals_batch_and_survives_restart(spark, tmp_path):
    target = Target(spark, str(tmp_path / "target"))
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    src = source(spark, [])
    first = [row(eid(n), 1, TS + n, long_v=n) for n in range(1, 6)] + [row(eid(1), 1, TS, long_v=0)]
    land(spark, folder, first)
    run(spark, folder, target, src, checkpoint, watermark=TS)
    assert as_set(target.history(), "ts") == {(TS + n,) for n in range(1, 6)}

    # A restart with the same checkpoint goes on in the same run. One row is
    # late, one entity is unknown, one row replaces an older latest value.
    land(
        spark,
        folder,
        [
            row(eid(1), 1, TS + 5, long_v=99),
            row(eid(50), 1, TS + 70, long_v=0),
            row(eid(1), 1, TS + 60, str_v="new"),
        ],
    )
    run(spark, folder, target, src, checkpoint)
    assert as_set(target.stored(HISTORY), "run", "batch") == {(1, 0), (1, 1)}
    assert as_set(target.history(), "ts") == {(TS + n,) for n in (1, 2, 3, 4, 5, 60)}
    assert as_set(target.rejected(), "entity_id") == {(eid(50),)}
    latest = {(eid(n), TS + n, n, None) for n in range(2, 6)} | {(eid(1), TS + 60, None, "new")}
    assert as_set(target.latest(), "entity_id", "ts", "long_v", "str_v") == latest

    # A new checkpoint is a new run: its batch 0 does not replace the old one.
    run(spark, folder, target, src, checkpoint + "2", watermark=TS)
    assert as_set(target.stored(HISTORY), "run") == {(1,), (2,)}
    assert as_set(target.history(), "ts") == {(TS + n,) for n in (1, 2, 3, 4, 5, 60)}

    batch = source(spark, first)
    dims = jobs.load_dimensions(batch)
    once = jobs.sync_once(batch.history(), dims, OPTIONS, TS)
    assert as_set(once, "ts", "long_v") == {(TS + n, n) for n in range(1, 6)}


def test_entities_created_later_are_seen(spark, tmp_path):
    target = Target(spark, str(tmp_path / "target"))
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    entities = str(tmp_path / "asset")

    class Growing(type(source(spark, []))):
        def find(self, name):
            return spark.read.parquet(entities) if name == "asset" else super().find(name)

    src = Growing(spark, {})
    spark.createDataFrame([(eid(1),)], "id string").write.parquet(entities)
    land(spark, folder, [row(eid(1), 1, TS + 1), row(eid(2), 1, TS + 1)])
    run(spark, folder, target, src, checkpoint, watermark=TS)
    spark.createDataFrame([(eid(2),)], "id string").write.mode("append").parquet(entities)
    land(spark, folder, [row(eid(2), 1, TS + 2)])
    run(spark, folder, target, src, checkpoint)
    assert as_set(target.history(), "entity_id", "ts") == {(eid(1), TS + 1), (eid(2), TS + 2)}


def test_latest_state_outlives_batches_and_restarts(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    target, src = Target(spark, str(tmp_path / "target")), source(spark, [])
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def landed(*rows):
        land(spark, folder, rows)
        stream = session.readStream.schema(source_schema()).parquet(folder)
        start_latest(stream, src, target, OPTIONS, checkpoint, TS, available_now=True).awaitTermination()
        return as_set(target.latest(), "entity_id", "key", "ts", "long_v")

    one, two = (eid(1), "temperature"), (eid(2), "humidity")
    assert landed(row(eid(1), 1, TS + 5, long_v=5), row(eid(1), 1, TS, long_v=0), row(eid(9), 1, TS - 1)) == {
        (*one, TS + 5, 5)
    }
    # Late rows change nothing; of equal ts the row that came last stays; unknown entities stay out.
    assert landed(row(eid(1), 1, TS + 3, long_v=3), row(eid(2), 2, TS + 1, long_v=1), row(eid(77), 1, TS + 9)) == {
        (*one, TS + 5, 5),
        (*two, TS + 1, 1),
    }
    assert landed(row(eid(1), 1, TS + 5, long_v=55), row(eid(2), 2, TS + 8, long_v=8)) == {
        (*one, TS + 5, 55),
        (*two, TS + 8, 8),
    }
    state = [p for p in (tmp_path / "checkpoint" / "state").rglob("*.zip")]
    assert state, "RocksDB writes its snapshots as zip files"
    # What the table has could be lost: the state alone brings the newest row back with the next one.
    other = Target(spark, str(tmp_path / "other"))
    land(spark, folder, [row(eid(1), 1, TS + 1, long_v=1)])
    stream = session.readStream.schema(source_schema()).parquet(folder)
    start_latest(stream, src, other, OPTIONS, checkpoint, TS, available_now=True).awaitTermination()
    assert as_set(other.latest(), "entity_id", "ts", "long_v") == {(eid(1), TS + 5, 55)}
