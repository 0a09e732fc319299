"""Blocks of documents that ask the whole corpus about their keys.

A model of the corpus grows with the corpus, so no task can hold it and none is sent to all tasks.
Documents are kept in blocks instead. A block asks about its distinct keys (hashes of n-grams,
phrases, table cells), each once; the questions of all blocks meet by ranges of the keys; and the
answers go back to the blocks that asked, in the order of their questions. So a key that a third
of all documents hold costs one row a block. Keys are packed: a row carries the keys that one
block has in one range, as arrays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.llm.common import shuffle_partitions
from kvloom.llm.remembered import within_group
from kvloom.scratch import scratch_folder

#: Bytes of text whose keys make up one range on average.
RANGE_BYTES = 4_000_000


@dataclass
class Blocks:
    """Documents with block_id, bucketed by it, so that no join by block moves them again."""

    rows: DataFrame
    n_rows: int
    n_bytes: int

    @property
    def ranges(self) -> int:
        """Ranges of keys: more for more text."""
        return max(self.n_bytes // RANGE_BYTES, shuffle_partitions(self.rows.sparkSession))


def make_blocks(docs: DataFrame, block_bytes: int) -> Blocks:
    """Store the rows with block_id: runs of rows of one partition of the input.

    A block has at most `block_bytes` of `text` together, or is a single longer text. Column
    `n_bytes` is added, the length of the text in UTF-8; a null text has 0.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    schema = T.StructType([*rows.schema.fields, T.StructField("block_id", T.LongType())])
    names = [*rows.columns, "block_id"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids = []
            for n in batch.column("n_bytes").to_pylist():
                if held and held + n > block_bytes:
                    block, held = block + 1, 0
                held += n + 16
                ids.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], names=names)

    name = f"blocks_{uuid.uuid4().hex}"
    (
        rows.mapInArrow(number, schema)
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", scratch_folder(spark, "blocks"))
        .bucketBy(shuffle_partitions(spark), "block_id")
        .sortBy("block_id")
        .saveAsTable(name)
    )
    stored = spark.table(name)
    # The plan knows files and buckets; the name is not needed again, and the files stay.
    spark.sql(f"DROP TABLE {name}")
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes")).first()
    return Blocks(stored, size["n"], size["bytes"] or 0)


def key_range(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each 64-bit key; it ascends with the key."""
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def range_parts(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, int, int]]:
    """Range, start and end for each range that ascending keys touch."""
    if len(keys):
        found = key_range(keys, ranges)
        starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])).tolist()
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            yield int(found[start]), start, end


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


QUESTION = "part int, block_id long, kind int, keys binary, payload binary"
ANSWER = "block_id long, kind int, part int, payload binary, total long, distinct long"


def question_rows(
    block_id: int, kind: int, keys: np.ndarray, payload: np.ndarray, ranges: int
) -> Iterator[tuple]:
    """The rows of one block's distinct ascending keys and what goes with each of them."""
    for part, start, end in range_parts(keys, ranges):
        yield part, block_id, kind, keys[start:end].tobytes(), payload[start:end].tobytes()


def as_table(rows: list[tuple], fields: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.large_binary(), "double": pa.float64()}
    kinds |= {"string": pa.string(), "boolean": pa.bool_()}
    named = [f.split() for f in fields.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(named)
    schema = pa.schema([(n, kinds[t] if t != "binary" else pa.binary()) for n, t in named])
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def ask(blocks: Blocks, questions: Callable[[int, pa.Table], Iterator[tuple]]) -> DataFrame:
    """`questions` gives the rows of `question_rows` for the rows of a block."""

    def run(table: pa.Table) -> pa.Table:
        return as_table(list(questions(table.column("block_id")[0].as_py(), table)), QUESTION)

    return blocks.rows.groupBy("block_id").applyInArrow(within_group(run), QUESTION)


def answer(
    questions: DataFrame, reply: Callable[..., tuple[list[bytes], int, int]]
) -> DataFrame:
    """Bring the questions about a range together and reply to them.

    `reply(kind, keys, payloads, counts)` gets all questions of a kind in a range: their keys, the
    payload of each asking row and its number of keys; it gives the answers to each row and two
    numbers about all keys, which go into a row without a block.
    """

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        part = table.column("part")[0].as_py()
        kinds = np.array(table.column("kind").to_pylist())
        asking = table.column("block_id").to_pylist()
        keys = table.column("keys").to_pylist()
        payloads = table.column("payload").to_pylist()
        for kind in np.unique(kinds).tolist():
            rows = np.flatnonzero(kinds == kind).tolist()
            raw, total, distinct = reply(
                kind,
                np.frombuffer(b"".join(keys[i] for i in rows), np.uint64),
                [payloads[i] for i in rows],
                [len(keys[i]) // 8 for i in rows],
            )
            out += [(asking[i], kind, part, r, None, None) for i, r in zip(rows, raw)]
            out.append((None, kind, part, None, total, distinct))
        return as_table(out, ANSWER)

    return questions.groupBy("part").applyInArrow(within_group(run), ANSWER)


def cut_up(answers: np.ndarray, counts: list[int]) -> list[bytes]:
    ends = np.cumsum(counts).tolist()
    return [answers[a:b].tobytes() for a, b in zip([0, *ends], ends)]


def equal_runs(*ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins in arrays that are in order together."""
    n = len(ordered[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in ordered])
    return np.flatnonzero(new)


def told(table: pa.Table, kind: int, dtype: type) -> np.ndarray:
    """A block's answers of a kind, in the order of its ascending keys."""
    rows = sorted(
        (p, raw)
        for k, p, raw in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "payload")))
        if k == kind
    )
    return np.frombuffer(b"".join(raw for _, raw in rows), dtype)


def with_answers(
    blocks: Blocks, answers: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str | T.StructType
) -> DataFrame:
    """Give each block its rows and its answers."""
    mine = answers.filter("block_id IS NOT NULL")
    both = blocks.rows.groupBy("block_id").cogroup(mine.groupBy("block_id"))
    return both.applyInArrow(within_group(finish), schema)
