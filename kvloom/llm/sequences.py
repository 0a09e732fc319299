"""Token ids as Arrow stream files of fixed-size lists.

Documents are dealt by ranges of their id. Each range writes one shard: an Arrow stream of record
batches, all of the same number of rows, whose rows are sequences of the same number of ids with
a mask of the same length. Ids are of the smaller of 16 and 32 bits that holds the vocabulary. Only
the end of a shard is padded, with mask 0. All batches take the same number of bytes, so the place of
any sequence follows from its number: one seek, and in a memory-mapped shard the arrays are views of
the file. A small table holds, for each document, its shard and the place of its first id there.

Shards are written to the shared folder under names that hold the task attempt; the table names
the shards of the attempts that Spark committed, so what a lost attempt left is never read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.bpe import byte_symbols, slices
from kvloom.llm.common import documents, kept_table, shuffle_partitions
from kvloom.llm.remembered import STORE_BYTES, Room
from kvloom.scratch import scratch_folder

#: Ids in a sequence and sequences in a batch.
SEQUENCE = 1024
BATCH = 256
#: Characters of chunks encoded in one call, and of a chunk that may be among them.
CALL, LONGEST = 50_000, 1_000
# Fixed value: how byte-level vocabularies cut a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def id_type(largest: int) -> type[np.unsignedinteger]:
    return np.uint16 if largest < 2**16 else np.uint32


def same_merges(path: str) -> tiktoken.Encoding | None:
    """The merges of a tokenizer's file for tiktoken, which takes ids for ranks; None if they differ."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    cut = spec.get("pre_tokenizer") or {}
    vocab, merges = spec["model"]["vocab"], spec["model"].get("merges", [])
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    made = [vocab.get(a + b, -1) for a, b in pairs]
    if spec.get("normalizer") or any(cut.get(k, v) != v for k, v in plain.items()) or not made:
        return None
    byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    singles = [vocab.get(symbol, -1) for symbol in byte_of]
    if min(made) <= max(singles) or min(singles) < 0 or any(a >= b for a, b in zip(made, made[1:])):
        return None
    ranks = {bytes(byte_of[c] for c in a + b): i for (a, b), i in zip(pairs, made)}
    ranks |= {bytes([byte]): i for byte, i in enumerate(singles)}
    return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """Ids of whole texts as the tokenizers library gives them, each distinct chunk once in a while.

    A byte-level vocabulary never joins what stands before a space with the space, so a text may
    be cut before a space between two other characters. Texts with longer runs of white space
    or with special tokens go to the library whole, as do very long chunks. The others are encoded by
    tiktoken, with the merges and the pattern of the same file, which takes a fifth of the time; a file
    whose merges are not in the order of their ids is left to the library. The chunks of a slice of texts are numbered by
    Arrow; their ids lie one behind the other in a pool, and those of the texts are taken from it by
    an array of places. The pool starts anew when it reaches a number of bytes.
    """

    whole = re.compile(r" (?<=\s )(?=\s|\Z)")

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        space = "Ġ"  # the character for the byte of a space
        self.starts = np.zeros(max(vocab.values()) + 1, bool)
        self.starts[[i for t, i in vocab.items() if t.startswith(space)]] = True
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.type = id_type(len(self.starts) - 1)
        self.merges = same_merges(path)
        #: The number of each chunk, and where its ids begin in the pool; one place more than chunks.
        self.numbers: dict[str, int] = {}
        self.room = Room(self.numbers, most=2 * STORE_BYTES)
        self.pool, self.places = np.zeros(0, self.type), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.type) for e in found]

    def encode_call(self, text: str) -> np.ndarray:
        """The ids of many chunks in one text."""
        if self.merges is None:
            return self.encode([text])[0]
        return np.array(self.merges.encode_ordinary(text), self.type)

    def learn(self, chunks: list[str]) -> np.ndarray:
        """The numbers of distinct chunks, each with a space before it, once their ids are known."""
        new = [c for c in chunks if c not in self.numbers]
        if self.room.take(len(new), sum(map(len, new))):
            self.pool, self.places = np.zeros(0, self.type), np.zeros(1, np.int64)
            new = chunks
            self.room.take(len(new), sum(map(len, new)))
        order, ids, sizes = self.encode_chunks(new)
        self.numbers.update(zip(order, range(len(self.numbers), len(self.numbers) + len(order))))
        self.pool = np.concatenate([self.pool, *ids])
        ends = self.places[-1] + np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))
        self.places = np.concatenate([self.places, ends])
        return np.fromiter(map(self.numbers.__getitem__, chunks), np.int64, len(chunks))

    def encode_chunks(self, new: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
        """The chunks in some order, their ids and how many each has.

        Many go to the library in one text; a token with a space begins each.
        """
        plain, rest = [], []
        for chunk in new:
            (plain if chunk and len(chunk) <= LONGEST and chunk.strip() == chunk else rest).append(chunk)
        order, found, sizes = [], [], []
        begin, held = 0, 0
        for i, chunk in enumerate([*plain, None]):
            held += len(chunk) + 1 if chunk else CALL + 1
            if held <= CALL or i == begin:
                continue
            call = plain[begin:i]
            begin, held = i, len(chunk or "") + 1
            ids = self.encode_call(" " + " ".join(call))
            first = np.flatnonzero(self.starts[ids])
            if len(first) == len(call):
                order += call
                found.append(ids)
                sizes.append(np.diff(first, append=len(ids)))
            else:
                rest += call
        alone = self.encode([" " + c for c in rest])
        sizes.append(np.array([len(ids) for ids in alone], np.int64))
        return order + rest, found + alone, sizes

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as bytes of the encoder's type."""
        odd = [bool(self.whole.search(t)) or any(s in t for s in self.special) for t in texts]
        # What stands before the first space has none before it.
        cuts = [len(t) if o else t.find(" ") for o, t in zip(odd, texts)]
        first = self.encode([t if c < 0 else t[:c] for c, t in zip(cuts, texts)])
        rest = [t[c + 1 :] if 0 <= c < len(t) else None for c, t in zip(cuts, texts)]
        lists = pc.split_pattern(pa.array(rest, pa.string()), " ")
        chunks = lists.flatten().dictionary_encode()
        number = self.learn(chunks.dictionary.to_pylist())[chunks.indices.to_numpy()]
        begins = self.places[number]
        sizes = self.places[number + 1] - begins
        ends = np.cumsum(sizes)
        place = np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        raw, wide = self.pool[place].tobytes(), np.dtype(self.type).itemsize
        after = np.append(0, ends)[lists.offsets.to_numpy()] * wide
        for ids, a, b in zip(first, after.tolist(), after[1:].tolist()):
            yield ids.tobytes() + raw[a:b]


_ENCODERS: dict[str, ChunkEncoder] = {}


def arrow_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a URI or local path, and the path in it.

    Known are local files, HDFS, S3 and the clouds of Arrow's build; Spark's names s3a and s3n of S3
    are understood. Names of stores that Arrow does not know raise ArrowInvalid.
    """
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


class ShardWriter:
    """Collects ids and writes full batches; the last one of a shard is padded."""

    def __init__(self, uri: str, kind: type[np.unsignedinteger], sequence: int, batch: int):
        self.kind, self.sequence = kind, sequence
        self.full = sequence * batch * np.dtype(kind).itemsize
        ids = pa.from_numpy_dtype(kind)
        self.schema = pa.schema(
            [("ids", pa.list_(ids, sequence)), ("mask", pa.list_(pa.bool_(), sequence))]
        )
        system, path = arrow_system(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(path)
        self.stream = pa.ipc.new_stream(self.file, self.schema)
        self.waiting: list[bytes] = []
        self.size = 0
        self.n_ids = 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.size += len(ids)
        self.n_ids += len(ids) // np.dtype(self.kind).itemsize
        if self.size >= self.full:
            self._write(False)

    def _write(self, last: bool) -> None:
        raw = b"".join(self.waiting)
        upto = len(raw) if last else len(raw) - len(raw) % self.full
        for start in range(0, upto, self.full):
            part = raw[start : min(upto, start + self.full)]
            ids = np.frombuffer(part.ljust(self.full, b"\0"), self.kind)
            mask = np.arange(len(ids)) < len(part) // ids.itemsize
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.sequence) for v in (ids, mask)]
            self.stream.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.waiting, self.size = [raw[upto:]], len(raw) - upto

    def close(self) -> None:
        self._write(True)
        self.stream.close()
        self.file.close()


class ShardReader:
    """A shard by place, in any order; memory-mapped where it is a local file.

    The first batch tells how many bytes every batch takes and how many sequences it has. Arrays
    that are returned are views of the batch; of a mapped file, nothing else is copied or read.
    """

    def __init__(self, uri: str):
        system, path = arrow_system(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.file = pa.memory_map(path) if local else system.open_input_file(path)
        self.schema = pa.ipc.read_schema(self.file)
        self.sequence = self.schema.field("ids").type.list_size
        self.first = self.file.tell()
        self.rows, self.bytes, self.n_batches = 0, 0, 0
        # Behind the last batch is a mark of eight bytes.
        if self.file.size() - self.first > 8:
            message = pa.ipc.read_message(self.file)
            self.bytes = self.file.tell() - self.first
            self.rows = pa.ipc.read_record_batch(message, self.schema).num_rows
            self.n_batches = (self.file.size() - self.first) // self.bytes
        self.at, self.arrays = -1, (np.zeros(0, np.uint16), pa.array([], pa.bool_()))

    @property
    def n_sequences(self) -> int:
        return self.n_batches * self.rows

    def _batch(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of a batch, its sequences one behind the other."""
        if number != self.at:
            if not 0 <= number < self.n_batches:
                raise IndexError(f"batch {number} of {self.n_batches}")
            self.file.seek(self.first + number * self.bytes)
            batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.file), self.schema)
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            self.at, self.arrays = number, (ids, batch.column("mask").flatten())
        return self.arrays

    def sequence_at(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of a sequence by its number in the shard."""
        if number < 0 or not self.rows:
            raise IndexError(f"sequence {number} of {self.n_sequences}")
        batch, row = divmod(number, self.rows)
        ids, mask = self._batch(batch)
        start = row * self.sequence
        return ids[start : start + self.sequence], mask.slice(start, self.sequence)

    def read(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from place `start` on, in parts of a batch at most."""
        per_batch = self.rows * self.sequence
        while n:
            number, within = divmod(start, per_batch)
            part = self._batch(number)[0][within : within + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self.file.close()


def write_sequences(
    docs: DataFrame, path: str, end_id: int, sequence: int = SEQUENCE, batch: int = BATCH
) -> DataFrame:
    """Write the ids of all texts, each followed by `end_id`; returns the table of documents.

    Its columns: doc_id, part, shard (URI), shard_start, n_tokens. Documents stand in ascending
    order of doc_id, null ids first, equal ids by text. A null text is an empty one: only the end
    id. Other columns are not used, whatever their names. A very long text is encoded whole and goes
    on over as many sequences as it needs. Without rows there are no shards.
    """
    folder = scratch_folder(docs.sparkSession, "shards")
    fields = "doc_id long, part int, shard string, shard_start long, n_tokens long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = ChunkEncoder(path)
        encoder = _ENCODERS[path]
        kind = max(encoder.type, id_type(end_id), key=lambda t: np.dtype(t).itemsize)
        end = kind(end_id).tobytes()
        task = TaskContext.get()
        uri = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}.arrows"
        shard = None
        for rows in batches:
            texts = [t or "" for t in rows.column("text").to_pylist()]
            for part in slices(texts, 2_000_000):
                shard = shard or ShardWriter(uri, kind, sequence, batch)
                starts, counts = [], []
                for ids in encoder(texts[part]):
                    if kind is not encoder.type:
                        ids = np.frombuffer(ids, encoder.type).astype(kind).tobytes()
                    starts.append(shard.n_ids)
                    shard.add(ids + end)
                    counts.append(shard.n_ids - starts[-1])
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id")[part.start : part.stop],
                        pa.array([task.partitionId()] * n, pa.int32()),
                        pa.array([uri] * n, pa.string()),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["doc_id", "part", "shard", "shard_start", "n_tokens"],
                )
        if shard:
            shard.close()

    ranged = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return kept_table(ranged.mapInArrow(write, fields), "sequences")


def read_sequences(table: DataFrame) -> DataFrame:
    """Read the shards back: doc_id, start, n_tokens, ids_crc32 for each row of the table.

    `start` counts the ids of all documents before; ids_crc32 is over little-endian 32-bit ids.
    """
    shards = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row a shard, and as many shards as range partitions: small enough to number and send.
    starts = table.sparkSession.sql(
        "SELECT part AS at, sum(n) OVER (ORDER BY part) - n AS before FROM {shards}", shards=shards
    )
    placed = table.join(F.broadcast(starts), F.col("part") == F.col("at"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for rows in batches:
            sums = []
            for uri, start, n in zip(*(rows.column(i).to_pylist() for i in (3, 4, 2))):
                if uri != opened:
                    if reader:
                        reader.close()
                    reader, opened = ShardReader(uri), uri
                crc = 0
                for ids in reader.read(start, n):
                    crc = zlib.crc32(ids.astype("<u4"), crc)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    # Rows come as they were written, each shard's in order; nothing is shuffled.
    return placed.select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "shard", "shard_start"
    ).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return read_sequences(write_sequences(documents(spark, sf_dir), path, end_id=2))
