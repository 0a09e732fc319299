"""Periodic runs of words, found with a run-length grammar that recompression builds.

The words of a slice of documents are numbered and set in one row, an own mark around each document.
Recompression rewrites the row again and again: first every block of one symbol repeated becomes one
symbol, then symbols are dealt to two sides by a hash and every left symbol before a right one becomes
one symbol with it. Equal stretches are rewritten alike but for their edges, and each level is shorter
than the one below, so all levels together hold a few symbols a word.

How far two positions agree is answered on this grammar: climb while both stand where a symbol of the
next level begins and the symbols are equal, step over what is left at the edge, and where symbols
differ go down again. On each level that is one step at most, or one jump over the shorter of two
blocks. The same levels serve both directions, and many questions are answered side by side.

A run with period q and at least max(24, 3q) words holds, on a grid of a fixed width for each q, a
position whose word and the next few recur q words later. These candidates (n log n of them at most)
are extended exactly by two questions each. No suffix array is built.

Every document is worked on in the task that reads it: no shuffle, nothing kept between tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.blocks import mixed
from kvloom.llm.common import documents
from kvloom.llm.infill import byte_slices
from kvloom.llm.remembered import within_task

#: A run has at least so many words and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words that have to recur at a grid position before it is extended.
PROBE = 4
#: Bytes of text whose documents share a grammar.
SLICE_BYTES = 2_000_000
#: Candidates looked at side by side.
SIDE_BY_SIDE = 500_000


@dataclass
class Level:
    """One level of the grammar: its symbols, and where they stand in the level above.

    `left` and `right` tell how far the block around a symbol goes on before and after it, itself
    counted, on levels that lead to blocks. On the others, `side` is true for left symbols.
    """

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray | None = None
    right: np.ndarray | None = None
    child: np.ndarray | None = None
    final: np.ndarray | None = None


def _level(symbols: np.ndarray, heads: np.ndarray) -> Level:
    """Link the symbols with those above them, which begin at `heads`."""
    parent = np.cumsum(heads) - 1
    last = np.ones(len(symbols), bool)
    last[:-1] = heads[1:]
    return Level(symbols, parent, heads, last)


def recompress(symbols: np.ndarray, marks: int) -> list[Level]:
    """The levels of the grammar, the given row first; `marks` symbols from 0 on are left alone.

    Of the levels, those of even number lead to blocks and the others to pairs. It ends when nothing
    but single symbols between marks is left.
    """
    levels: list[Level] = []
    named = int(symbols.max()) + 1 if len(symbols) else marks
    child = final = None
    salt = 0
    while True:
        n = len(symbols)
        # Blocks: a symbol repeated becomes a new symbol, one for each symbol and number.
        heads = np.ones(n, bool)
        heads[1:] = symbols[1:] != symbols[:-1]
        level = _level(symbols, heads)
        begins = np.flatnonzero(heads)
        sizes = np.diff(np.append(begins, n))
        place = np.arange(n)
        level.left = place - begins[level.parent] + 1
        level.right = (begins + sizes)[level.parent] - place
        level.child, level.final = child, final
        levels.append(level)
        child, final = begins, begins + sizes - 1
        above = symbols[begins].copy()
        many = np.flatnonzero(sizes > 1)
        if len(many):
            _, names = np.unique(above[many] * (n + 1) + sizes[many], return_inverse=True)
            above[many] = names + named
            named += int(names.max()) + 1
        symbols, n = above, len(above)

        # Pairs: the sides are dealt anew on every level, by a hash of the symbol.
        plain = symbols >= marks
        if not (plain[1:] & plain[:-1]).any():
            level = _level(symbols, np.ones(n, bool))
            level.child, level.final = child, final
            levels.append(level)
            return levels
        salt += 1
        left = (mixed(symbols.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(63)) == 0
        joined = np.zeros(n, bool)
        joined[:-1] = left[:-1] & ~left[1:] & plain[:-1] & plain[1:]
        heads = np.ones(n, bool)
        heads[1:] = ~joined[:-1]
        level = _level(symbols, heads)
        level.child, level.final = child, final
        levels.append(level)
        child = np.flatnonzero(heads)
        final = np.flatnonzero(level.last)
        above = symbols[child].copy()
        two = np.flatnonzero(final > child)
        if len(two):
            keys = symbols[child[two]] * named + symbols[final[two]]
            _, names = np.unique(keys, return_inverse=True)
            above[two] = names + named
            named += int(names.max()) + 1
        symbols = above


def agree(levels: list[Level], x: np.ndarray, y: np.ndarray, forward: bool = True) -> np.ndarray:
    """How many words from x on equal those from y on, or backward from x and y, themselves counted.

    Both are positions on the lowest level, never the same; marks that occur once bound every answer.
    """
    step = 1 if forward else -1
    start = x
    x, y = x.copy(), y.copy()
    stopped = np.zeros(len(x), np.int64)
    live = np.arange(len(x))

    def walk(level: Level, who: np.ndarray, upto_edge: bool) -> np.ndarray:
        """Move over equal symbols of a level, once or to their end; who still agrees."""
        going = who[level.symbols[x[who]] == level.symbols[y[who]]]
        edge = level.first if forward else level.last
        out = []
        while len(going):
            if upto_edge:
                there = edge[x[going]] & edge[y[going]]
                out.append(going[there])
                going = going[~there]
            if not len(going):
                break
            if level.left is not None:
                rest = level.right if forward else level.left
                far = np.minimum(rest[x[going]], rest[y[going]]) * step
            else:
                far = step
            x[going] += far
            y[going] += far
            going = going[level.symbols[x[going]] == level.symbols[y[going]]]
        return np.concatenate(out) if out else going

    for depth, level in enumerate(levels[:-1]):
        up = walk(level, live, True)
        halted = np.ones(len(x), bool)
        halted[up] = False
        stopped[live[halted[live]]] = depth
        live = up
        if not len(live):
            break
        x[live], y[live] = level.parent[x[live]], level.parent[y[live]]
    if len(live):
        stopped[live] = len(levels) - 1
        walk(levels[-1], live, False)
    for depth in range(int(stopped.max(initial=0)), 0, -1):
        down = np.flatnonzero(stopped >= depth)
        level = levels[depth]
        inner = level.child if forward else level.final
        x[down], y[down] = inner[x[down]], inner[y[down]]
        walk(levels[depth - 1], down, False)
    return (x - start) * step


def grid(n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid positions i and periods q from low to below high, for n words.

    A run of q covers at least max(24, 3q) words, so at least that less q positions whose word recurs q
    words later; less PROBE - 1, whose next words recur, too. One of them is on a grid that wide.
    """
    q = np.arange(low, high)
    wide = np.maximum(LEAST_WORDS, LEAST_PERIODS * q) - q - (PROBE - 1)
    counts = (n - q - PROBE) // wide + 1
    ends = np.cumsum(counts)
    number = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    return number * np.repeat(wide, counts), np.repeat(q, counts)


def period_ranges(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of periods, each with a bounded number of grid positions."""
    low, most = 1, n // LEAST_PERIODS + 1
    while low < most:
        # At most n / width positions a period; widths grow with the period.
        wide = max(LEAST_WORDS, LEAST_PERIODS * low) - low - (PROBE - 1)
        high = min(most, low + max(1, SIDE_BY_SIDE // (n // wide + 1)))
        yield low, high
        low = high


def candidates(row: np.ndarray, start: int, n: int, known: np.ndarray, low: int, high: int) -> tuple:
    """Grid positions in `row`, and periods, whose words recur; none that a known run explains.

    A position i with period q lies in the run (s, e, p) of the document, and nothing new comes of it,
    if i and i + q are inside, p divides q and the run has at least 2q words.
    """
    i, q = grid(n, low, high)
    at = i + start
    for k in range(PROBE):
        good = row[at + k] == row[at + q + k]
        at, q = at[good], q[good]
    for s, e, p in known[-8:].tolist():
        new = ~((at >= s) & (at + q < e) & (q % p == 0) & (e - s >= 2 * q))
        at, q = at[new], q[new]
    return at, q


def extended(levels: list[Level], at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) around candidates, each once, with its smallest period."""
    found = []
    for a in range(0, len(at), SIDE_BY_SIDE):
        x, p = at[a : a + SIDE_BY_SIDE], q[a : a + SIDE_BY_SIDE]
        e = x + p + agree(levels, x, x + p)
        s = x - agree(levels, x - 1, x + p - 1, forward=False)
        good = e - s >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        found.append(np.stack([s[good], e[good], p[good]], axis=1))
    return smallest_periods(np.concatenate(found) if found else np.zeros((0, 3), np.int64))


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, ordered by start and period; multiples of its period go.

    The same stretch with another period has a multiple of its smallest one, as it is at least three
    times as long as either; and different stretches differ in start or end.
    """
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each row of word numbers: start, end and period, by start, then period."""
    sizes = np.array([len(r) for r in rows], np.int64)
    n_rows = len(rows)
    starts = np.cumsum(sizes + 1) - sizes
    out = [np.zeros((0, 3), np.int64) for _ in rows]
    wanted = np.flatnonzero(sizes >= LEAST_WORDS).tolist()
    if not wanted:
        return out
    marks = n_rows + 1
    row = np.empty(int(sizes.sum()) + marks, np.int64)
    for k, words in enumerate(rows):
        row[starts[k] - 1] = k
        row[starts[k] : starts[k] + sizes[k]] = words + marks
    row[-1] = n_rows
    levels: list[Level] | None = None
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    every = [np.zeros((0, 3), np.int64)]

    def extend() -> np.ndarray:
        nonlocal levels
        at, q = (np.concatenate(c) for c in zip(*waiting)) if waiting else (np.zeros(0, np.int64),) * 2
        waiting.clear()
        if not len(at):
            return every[0]
        if levels is None:
            levels = recompress(row, marks)
        every.append(extended(levels, at, q))
        return every[-1]

    for k in wanted:
        n = int(sizes[k])
        known = every[0]
        ranges = list(period_ranges(n))
        for low, high in ranges:
            waiting.append(candidates(row, int(starts[k]), n, known, low, high))
            if len(ranges) > 1:
                found = extend()
                known = np.concatenate([known, found])
                known = known[np.argsort(known[:, 1] - known[:, 0], kind="stable")]
    extend()
    runs = smallest_periods(np.concatenate(every))
    bounds = np.searchsorted(runs[:, 0], np.append(starts, len(row)))
    for k in wanted:
        out[k] = runs[bounds[k] : bounds[k + 1]] - np.array([starts[k], starts[k], 0])
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: all but those of a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest length by period; of equal ones the first, then of smallest period."""
    if not len(runs):
        return None
    length = runs[:, 1] - runs[:, 0]
    # Doubles leave out what cannot be the greatest; fractions decide among the rest.
    ratio = length / runs[:, 2]
    some = runs[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    s, e, p = min(some, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
    return s, e - s, p


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """For a tenth of the ids, words from some place on repeat their first few; else the same words."""
    h = crc32(str("" if doc_id is None else doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head = words[a : a + p]
    return words[:a] + (head * ((n - a) // p + 1))[: n - a]


DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(docs: DataFrame, output: str = "runs", repeat_tails: bool = False) -> DataFrame:
    """The periodic runs of every text, and the text without their repetitions.

    `docs` has doc_id and text; other columns are not returned, whatever their names. Words are what
    ASCII white space separates. A run is a stretch of at least 24 words and three periods that no
    neighbouring word extends; its period is the smallest. `output`: "runs" gives doc_id, n_words,
    runs (by start, then period) and collapsed, the words outside the repetitions joined by a space;
    "digests" gives doc_id, n_runs, start, length, period and exponent_milli of the run with the most
    periods (null without runs), runs_sha256 and collapsed_sha256. With `repeat_tails` the tails of a
    tenth of the texts are made periodic first, by a hash of the id.

    A null text is an empty one: no words, no runs, an empty collapsed text. A null doc_id is hashed
    as an empty string. Repeated rows give the same result each; ties between runs go to the smaller
    start, then period. Overlapping runs are all reported. A text longer than a slice is worked on
    alone, whole, with memory of some hundred times the number of its words in bytes. No rows give no
    rows.
    """
    fields = {"digests": DIGESTS, "runs": RUNS}[output]

    def report(words: list[bytes], runs: np.ndarray) -> tuple:
        stay = kept_words(len(words), runs)
        kept = b" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay).tolist()])
        lines = [(s, e - s, p) for s, e, p in runs.tolist()]
        if output == "runs":
            named = [dict(zip(("start", "length", "period"), line)) for line in lines]
            return len(words), named, kept.decode()
        best = strongest(runs)
        told = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in lines).encode()).hexdigest()
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return len(lines), *four, told, hashlib.sha256(kept).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            for some in byte_slices(texts, SLICE_BYTES):
                # bytes.split() takes exactly the ASCII white space.
                lines = [t.split() for t in texts[some]]
                if repeat_tails:
                    lines = [repeat_tail(w, i) for w, i in zip(lines, ids[some])]
                number: dict[bytes, int] = {}
                rows = [np.array([number.setdefault(w, len(number)) for w in line], np.int64) for line in lines]
                made = [report(w, r) for w, r in zip(lines, runs_of(rows))]
                columns = [ids[some], *zip(*made)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = {
        "long": pa.int64(),
        "string": pa.string(),
        "array": pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])),
    }
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [schema[f.split()[1].split("<")[0]] for f in fields.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(within_task(run), fields)


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_runs(documents(spark, sf_dir), output="digests", repeat_tails=True)
