"""Repeated passages by prefix-free parsing.

Texts are parsed into phrases that begin where a rolling hash has a certain value, so equal text
is cut into equal phrases wherever it stands. A phrase together with the bytes that its last
windows reach into is an entry of the dictionary; the parse is the sequence of entries. Three
questions to the corpus settle for every window of `length` bytes whether it starts in an earlier
document:

0. Entries: which document has this entry first? In every later one all its windows are repeated.
   What follows looks at first occurrences alone, that is at the dictionary, whatever the number
   of copies.
1. Anchors: the smallest rolling hash in a window anchors it, so equal windows have equal anchors.
   As an anchor may stand in very many surroundings, it is told apart by the bytes before it, where
   the window has enough of those, or else by the bytes after it. Windows whose anchor stands in
   such surroundings at a single place of the dictionary are nowhere else.
2. Suffixes: the other windows, as the bytes from the first to the last one of an anchor, are
   brought together by anchor. There the suffixes that start them are put in corpus order as far as
   `length` bytes; equal ones are neighbours, and the smallest document of such a run has it first.

The text itself stays in its block. Equal entries and equal suffixes of a block are asked for
once, so a passage that very many documents share costs one question a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm import blocks as B
from kvloom.llm.common import documents, kept_table, plain_names

#: Bytes of a repeated passage.
LENGTH = 50
#: A phrase begins where the hash of so many bytes is a multiple of PERIOD.
TRIGGER, PERIOD = 12, 128
#: Bytes in an anchor. A window of LENGTH bytes holds LENGTH - ANCHOR + 1 of them.
ANCHOR = 24
BLOCK_BYTES = 2_000_000
#: Positions worked on at a time, so that a very long text needs no more memory than others.
SEGMENT = 1_000_000
#: Windows put in order at a time; those of one anchor stay together.
WINDOWS = 400_000
_FACTORS = B.mixed(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)
_BYTES = B.mixed(np.arange(1000, 1256, dtype=np.uint64))
_FIRST = np.dtype([("second", "<u8"), ("doc", "<i8")])
_NO_ID = np.iinfo(np.int64).max


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each place on, built from those of shorter runs."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, length = _BYTES[data], 1
    out, done = None, 0
    level = 0
    while length <= size:
        if size & length:
            part = power[done : done + n]
            out = part.copy() if out is None else out * _FACTORS[32 + level] + part
            done += length
        if length * 2 <= size:
            power = power[: len(power) - length] * _FACTORS[level] + power[length:]
        length *= 2
        level += 1
    return B.mixed(out)


class Parse:
    """A block's texts as bytes, their phrases and, when known, which windows are candidates."""

    def __init__(self, table: pa.Table, length: int):
        self.length = length
        texts = [(t or "").encode() for t in table.column("text").to_pylist()]
        ids = table.column("doc_id").to_pylist()
        #: A null id is later than all others.
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        self.raw = b"".join(texts)
        self.data = np.frombuffer(self.raw, np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        triggers = []
        for low in range(0, len(self.data), SEGMENT):
            found = rolling(self.data[low : low + SEGMENT + TRIGGER - 1], TRIGGER)
            triggers.append(low + np.flatnonzero(found % np.uint64(PERIOD) == 0))
        triggers = np.concatenate([np.zeros(0, np.int64), *triggers])
        owner = np.searchsorted(self.ends, triggers, side="right")
        triggers = triggers[triggers + TRIGGER <= self.ends[owner]] if len(triggers) else triggers
        starts = self.ends - self.sizes
        begins = np.union1d(triggers, starts[self.sizes > 0])
        owner = np.searchsorted(self.ends, begins, side="right")
        following = np.append(begins[1:], len(self.data))
        #: Entries end where the last window that starts in the phrase ends.
        until = np.minimum(following + length - 1, self.ends[owner]) if len(begins) else begins
        some = until - begins >= length
        self.begins, self.until, self.owner = begins[some], until[some], owner[some]

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        view = memoryview(self.raw)
        digests = b"".join(
            xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(self.begins.tolist(), self.until.tolist())
        )
        both = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def entry_order(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key, second = self.entries()
        order = np.lexsort((second, key))
        return key, second, order, B.equal_runs(key[order], second[order])

    def first_in(self, order: np.ndarray, new: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """For each phrase whether no earlier document has its entry; `docs` answers question 0."""
        first = np.empty(len(order), np.int64)
        first[order] = np.repeat(docs, np.diff(new, append=len(order)))
        return first >= self.ids[self.owner]

    def windows(self, which: np.ndarray) -> np.ndarray:
        """Whether a window of one of these phrases starts at each place."""
        change = np.zeros(len(self.data) + 1, np.int8)
        change[self.begins[which]] += 1
        np.subtract.at(change, self.until[which] - self.length + 1, 1)
        return np.cumsum(change[:-1], dtype=np.int8) > 0

    def anchored(self, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of candidate windows of one anchor and side: first and last start, hash of both."""
        out = []
        n_anchors = self.length - ANCHOR + 1
        around = (self.length - ANCHOR) // 2
        for low in range(0, len(self.data), SEGMENT):
            here = np.flatnonzero(candidates[low : low + SEGMENT])
            if not len(here):
                continue
            data = self.data[low : low + SEGMENT + self.length - 1]
            value = rolling(data, ANCHOR)
            # The smallest hash, of equal ones the leftmost.
            place = np.arange(len(value), dtype=np.uint64)
            least = (value >> np.uint64(32) << np.uint64(32)) | place
            size = 1
            while size * 2 <= n_anchors:
                least = np.minimum(least[:-size], least[size:])
                size *= 2
            if size < n_anchors:
                least = np.minimum(least[: len(least) - (n_anchors - size)], least[n_anchors - size :])
            anchor = (least[here] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            # A window has so many bytes before its anchor, or else as many after it.
            before = anchor - here >= around
            new = np.ones(len(here), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (here[1:] != here[:-1] + 1) | (before[1:] != before[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(here)) - 1
            side = before[first]
            wide = rolling(data, ANCHOR + around)[anchor[first] - np.where(side, around, 0)]
            out.append((low + here[first], low + here[last], B.mixed(wide + side.astype(np.uint64))))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(v) for v in zip(*out))


def _reply_entries(keys: np.ndarray, payloads: list[bytes], asked: list[int]):
    got = np.frombuffer(b"".join(payloads), _FIRST)
    order = np.lexsort((got["second"], keys))
    new = B.equal_runs(keys[order], got["second"][order])
    out = np.empty(len(keys), np.int64)
    least = np.minimum.reduceat(got["doc"][order], new) if len(keys) else out
    out[order] = np.repeat(least, np.diff(new, append=len(keys)))
    return B.cut_up(out, asked), 0, 0


def _reply_anchors(keys: np.ndarray, payloads: list[bytes], asked: list[int]):
    several = np.frombuffer(b"".join(payloads), np.uint8)
    order = np.argsort(keys)
    new = B.equal_runs(keys[order])
    n = np.diff(new, append=len(keys))
    out = np.empty(len(keys), np.uint8)
    more = (n > 1) | (np.maximum.reduceat(several[order], new) > 0) if len(keys) else n > 1
    out[order] = np.repeat(more, n)
    return B.cut_up(out, asked), 0, 0


def pack_pieces(pieces: list[bytes], docs: np.ndarray) -> bytes:
    sizes = np.array([len(p) for p in pieces], np.uint8)
    return sizes.tobytes() + docs.astype(np.int64).tobytes() + b"".join(pieces)


def _batches(keys: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of about WINDOWS windows together; pieces of one anchor are in one batch."""
    order = np.argsort(keys, kind="stable")
    total = np.cumsum(counts[order])
    starts = B.equal_runs(keys[order])
    begin = 0
    while begin < len(order):
        upto = (total[begin - 1] if begin else 0) + WINDOWS
        following = starts[starts > begin]
        within = following[total[following - 1] <= upto]
        end = int(within[-1]) if len(within) else int(following[0]) if len(following) else len(order)
        if total[-1] <= upto:
            end = len(order)
        yield order[begin:end]
        begin = end


def _reply_suffixes(length: int) -> Callable:
    def reply(keys: np.ndarray, payloads: list[bytes], asked: list[int]):
        sizes = np.concatenate(
            [np.frombuffer(p, np.uint8, n) for p, n in zip(payloads, asked)]
        ).astype(np.int64)
        docs = np.concatenate([np.frombuffer(p, np.int64, n, n) for p, n in zip(payloads, asked)])
        data = np.frombuffer(b"".join([p[9 * n :] for p, n in zip(payloads, asked)]), np.uint8)
        views = np.lib.stride_tricks.sliding_window_view(data, length)
        counts = sizes - length + 1
        begins, outs = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        for some in _batches(keys, counts):
            n = counts[some]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows = views[np.repeat(begins[some], n) + inside]
            suffixes = np.ascontiguousarray(rows).view(f"S{length}").ravel()
            order = np.argsort(suffixes, kind="stable")
            new = B.equal_runs(suffixes[order])
            least = np.minimum.reduceat(np.repeat(docs[some], n)[order], new)
            place = np.repeat(outs[some], n) + inside
            out[place[order]] = np.repeat(least, np.diff(new, append=len(order)))
        ends = np.cumsum(asked)
        windows = [int(counts[e - n : e].sum()) for e, n in zip(ends, asked)]
        return B.cut_up(out, windows), 0, 0

    return reply


def find_repeats(blocks: B.Blocks, length: int) -> DataFrame:
    """All answers that the blocks need to know their repeated windows."""
    ranges = blocks.ranges
    replies = {0: _reply_entries, 1: _reply_anchors, 2: _reply_suffixes(length)}

    def reply(kind: int, keys: np.ndarray, payloads: list[bytes], asked: list[int]):
        return replies[kind](keys, payloads, asked)

    def ask_entries(block_id: int, table: pa.Table) -> Iterator[tuple]:
        parse = Parse(table, length)
        key, second, order, new = parse.entry_order()
        asked = np.empty(len(new), _FIRST)
        if len(new):
            asked["second"] = second[order][new]
            asked["doc"] = np.minimum.reduceat(parse.ids[parse.owner][order], new)
        yield from B.question_rows(block_id, 0, key[order][new], asked, ranges)

    def ask_anchors(table: pa.Table, told: pa.Table) -> pa.Table:
        parse, _, _, key = known_anchors(table, told, length)
        order = np.argsort(key)
        new = B.equal_runs(key[order])
        several = (np.diff(new, append=len(key)) > 1).astype(np.uint8)
        return B.as_table(
            list(B.question_rows(_block(table), 1, key[order][new], several, ranges)), B.QUESTION
        )

    def ask_suffixes(table: pa.Table, told: pa.Table) -> pa.Table:
        parse, first, last, key, piece_of, keep = known_pieces(table, told, length)
        rows = []
        if len(keep):
            docs = np.full(len(keep), _NO_ID)
            owner = np.searchsorted(parse.ends, first, side="right")
            np.minimum.at(docs, piece_of, parse.ids[owner])
            for part, a, b in B.range_parts(key[keep], ranges):
                pieces = [
                    parse.raw[s : e + length]
                    for s, e in zip(first[keep[a:b]].tolist(), last[keep[a:b]].tolist())
                ]
                packed = pack_pieces(pieces, docs[a:b])
                rows.append((part, _block(table), 2, key[keep[a:b]].tobytes(), packed))
        return B.as_table(rows, B.QUESTION)

    answers = kept_table(B.answer(B.ask(blocks, ask_entries), reply), "entries")
    for ask in (ask_anchors, ask_suffixes):
        more = B.with_answers(blocks, answers, ask, B.QUESTION)
        answers = answers.union(kept_table(B.answer(more, reply), "repeats"))
    return answers


def _block(table: pa.Table) -> int:
    return table.column("block_id")[0].as_py() if table.num_rows else -1


def known_anchors(table: pa.Table, told: pa.Table, length: int):
    """The parse, and the runs of windows of the phrases that no earlier document has."""
    parse = Parse(table, length)
    _, _, order, new = parse.entry_order()
    parse.first = parse.first_in(order, new, B.told(told, 0, np.int64))
    return parse, *parse.anchored(parse.windows(parse.first))


def known_pieces(table: pa.Table, told: pa.Table, length: int):
    """The runs whose anchor is elsewhere too; `piece_of` numbers the distinct ones among them.

    `keep` has one run for each of those numbers, in ascending order of anchors.
    """
    parse, first, last, key = known_anchors(table, told, length)
    order = np.argsort(key)
    new = B.equal_runs(key[order])
    several = np.empty(len(key), bool)
    several[order] = np.repeat(B.told(told, 1, np.uint8) > 0, np.diff(new, append=len(key)))
    first, last, key = first[several], last[several], key[several]
    view = memoryview(parse.raw)
    content = np.fromiter(
        (xxhash.xxh3_64_intdigest(view[a : b + length]) for a, b in zip(first.tolist(), last.tolist())),
        np.uint64,
        len(first),
    )
    order = np.lexsort((last - first, content, key))
    new = B.equal_runs(key[order], content[order], (last - first)[order])
    piece_of = np.empty(len(key), np.int64)
    piece_of[order] = np.repeat(np.arange(len(new)), np.diff(new, append=len(key)))
    return parse, first, last, key, piece_of, order[new]


def repeated_bytes(table: pa.Table, told: pa.Table, length: int) -> tuple[Parse, np.ndarray]:
    """The parse of a block and which of its bytes an earlier document has, too."""
    parse, first, last, key, piece_of, keep = known_pieces(table, told, length)
    removed = parse.windows(~parse.first)
    if len(first):
        docs = B.told(told, 2, np.int64)
        counts = last - first + 1
        starts = np.cumsum(counts[keep]) - counts[keep]
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        place = np.repeat(first, counts) + inside
        earliest = docs[np.repeat(starts[piece_of], counts) + inside]
        mine = parse.ids[np.searchsorted(parse.ends, place, side="right")]
        removed[place[earliest < mine]] = True
    change = np.zeros(len(parse.data) + 1, np.int32)
    at = np.flatnonzero(removed)
    change[at] += 1
    np.subtract.at(change, at + length, 1)
    return parse, np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, output: str = "digests", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Remove each byte in a run of `length` bytes that also starts in a document of a smaller id.

    `docs` has doc_id and text. `output`: "digests" gives doc_id, n_bytes, n_removed, n_spans,
    kept_sha256; "texts" gives all columns of `docs`, text being what remains (a character of
    which a part goes is dropped whole) and n_chars, if there, its length. A null text has no
    bytes and stays null. A null id is later than all others; rows of one id take nothing from
    each other. No rows in, no rows out.
    """
    if not ANCHOR <= length <= 128:
        raise ValueError(f"length must be from {ANCHOR} to 128")
    used = ("doc_id", "text", "n_chars")
    rows = plain_names(docs, used) if output == "texts" else docs.select("doc_id", "text")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    names = rows.columns
    blocks = B.make_blocks(rows, block_bytes)
    answers = find_repeats(blocks, length)

    def digests(table: pa.Table, told: pa.Table) -> pa.Table:
        parse, gone = repeated_bytes(table, told, length)
        out = []
        for i, end, size in zip(table.column("doc_id").to_pylist(), parse.ends, parse.sizes):
            mask = gone[end - size : end]
            kept = parse.data[end - size : end][~mask]
            spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
            out.append((i, int(size), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
        return B.as_table(out, digest)

    def texts(table: pa.Table, told: pa.Table) -> pa.Table:
        parse, gone = repeated_bytes(table, told, length)
        kept = []
        for text, end, size in zip(table.column("text").to_pylist(), parse.ends, parse.sizes):
            mask = gone[end - size : end]
            if text is None or not mask.any():
                kept.append(text)
            else:
                kept.append(parse.data[end - size : end][~mask].tobytes().decode(errors="ignore"))
        at = table.column_names.index("text")
        table = table.set_column(at, "text", pa.array(kept, pa.string()))
        return table.select(names)

    digest = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if output == "digests":
        return B.with_answers(blocks, answers, digests, digest)
    found = B.with_answers(blocks, answers, texts, rows.schema)
    if "n_chars" in names:
        kind = rows.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.length("text").cast(kind))
    return found.toDF(*docs.columns)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
