"""Runs against a scan of every period, and grammar answers against word-by-word comparison."""

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from kvloom.llm import periods
from kvloom.llm.periods import agree, find_runs, kept_words, recompress, runs_of, strongest


def brute(words):
    """Start, end and smallest period of every run, from all periods."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in found.items())


def made_up(rnd):
    words, kinds = [], rnd.choice([1, 2, 3, 5, 50])
    for _ in range(rnd.randint(0, 8)):
        if rnd.random() < 0.6:
            part = [rnd.randrange(kinds) for _ in range(rnd.randint(1, rnd.choice([3, 12, 30])))]
            words += part * rnd.randint(1, 9) + part[: rnd.randint(0, len(part))]
        else:
            words += [rnd.randrange(kinds) for _ in range(rnd.randint(1, 20))]
    return np.array(words, np.int64)


@pytest.mark.parametrize("side_by_side", [500_000, 300, 7])
def test_all_runs_are_found(monkeypatch, side_by_side):
    monkeypatch.setattr(periods, "SIDE_BY_SIDE", side_by_side)
    rnd = random.Random(side_by_side)
    n_runs = 0
    for _ in range(25):
        rows = [made_up(rnd) for _ in range(rnd.randint(1, 15))]
        for row, found in zip(rows, runs_of(rows)):
            expected = brute(row.tolist())
            assert [(s, p, e) for s, e, p in found.tolist()] == expected
            n_runs += len(expected)
    assert n_runs > 100


@pytest.mark.parametrize("kinds", [1, 2, 40])
def test_agreement_in_both_directions(kinds):
    rnd = np.random.default_rng(kinds)
    middle = rnd.integers(0, kinds, 700)
    row = np.concatenate([[0], np.tile(middle, 3) + 2, [1]])
    levels = recompress(row, 2)
    x, y = rnd.integers(1, len(row) - 1, (2, 4000))
    x, y = x[x != y], y[x != y]
    ahead, back = agree(levels, x, y), agree(levels, x, y, forward=False)
    for a, b, f, r in zip(x.tolist(), y.tolist(), ahead.tolist(), back.tolist()):
        assert np.array_equal(row[a : a + f], row[b : b + f]) and row[a + f] != row[b + f]
        assert np.array_equal(row[a - r + 1 : a + 1], row[b - r + 1 : b + 1]) and row[a - r] != row[b - r]


def test_the_grammar_gives_the_row_back_and_is_small():
    row = np.concatenate([[0], np.random.default_rng(1).integers(2, 50, 4000), [1]])
    levels = recompress(row, 2)
    assert sum(len(level.symbols) for level in levels) < 12 * len(row)
    assert len(levels[-1].symbols) == 3
    for below, above in zip(levels, levels[1:]):
        # Equal symbols above stand over equal rows below.
        inside = {}
        for symbol, a, b in zip(above.symbols.tolist(), above.child.tolist(), above.final.tolist()):
            assert inside.setdefault(symbol, tuple(below.symbols[a : b + 1])) == tuple(below.symbols[a : b + 1])
        assert above.child[0] == 0 and np.array_equal(above.child[1:], above.final[:-1] + 1)


def test_long_rows_of_one_and_of_seven_words():
    for n in (60_001, 100_000):
        assert runs_of([np.zeros(n, np.int64)])[0].tolist() == [[0, n, 1]]
        assert runs_of([np.arange(n) % 7])[0].tolist() == [[0, n, 7]]
    assert len(runs_of([np.arange(50_000)])[0]) == 0


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, q, e in runs for i in range(s + q, e)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[2] - r[0], r[1]), r[0], r[1]), default=None)
    four = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
    return doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_documents_and_awkward_rows(documents, awkward, nothing):
    awkward = awkward.filter("doc_id <> 8 OR doc_id IS NULL")  # too long for the scan; see below
    for docs in (documents.filter("n_chars < 9000"), awkward, nothing):
        found = [tuple(r) for r in find_runs(docs, "digests", repeat_tails=True).collect()]
        expected = [expected_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(str, found)) == sorted(map(str, expected))
        assert docs is awkward or docs is nothing or any(r[1] for r in found)


def test_runs_and_collapsed_texts(awkward):
    rows = {r.doc_id: r for r in find_runs(awkward).collect()}
    assert rows[8].n_words == 30_000 and rows[8].collapsed == "lorem ipsum"
    assert [tuple(r) for r in rows[8].runs] == [(0, 30_000, 2)]
    assert rows[4].runs == [] and rows[4].collapsed == "" and rows[12].collapsed == "Two WORDS"
    assert len(rows[2].runs) == 0 and rows[2].n_words == 40


def test_ties_and_overlaps():
    runs = np.array([[0, 24, 8], [10, 40, 10], [50, 74, 8], [50, 80, 10]])
    assert strongest(runs) == (0, 24, 8)
    assert strongest(runs[:0]) is None
    assert strongest(np.array([[0, 24, 8], [30, 61, 10]])) == (30, 31, 10)
    assert np.flatnonzero(kept_words(50, runs[:2])).tolist() == [*range(8), *range(40, 50)]
