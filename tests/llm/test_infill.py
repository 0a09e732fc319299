"""Fill-in-the-middle against string cutting, and the learned index against the offsets."""

import hashlib
import random
import re

import numpy as np
import pytest

from kvloom.llm.infill import ERROR, Rates, fill_in_middle, fit_lines, restore, token_ends, transform_slice

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, salt=42, rates=(50, 80)):
    """Everything about one document: n, form, its three parts, the output."""
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digest = sha(f"{salt}:{'' if doc_id is None else doc_id}")
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    parts = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rates[0]:
        return len(tokens), "plain", parts, text
    prefix, middle, suffix = parts
    if h[3] % 100 < rates[1]:
        return len(tokens), "spm", parts, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", parts, f"<P>{prefix}<S>{suffix}<M>{middle}"


def digests(doc_id, text):
    n, form, (prefix, middle, _), output = brute(doc_id, text)
    lengths = (None, None) if form == "plain" else (len(prefix), len(middle))
    return doc_id, n, form, *lengths, sha(output), sha(text or "")


@pytest.mark.parametrize("shape", ["steady", "jumps", "one", "none", "steps"])
def test_lines_stay_within_the_bound_and_residuals_are_exact(shape):
    rnd = np.random.default_rng(4)
    gaps = {
        "steady": rnd.integers(1, 12, 50_000),
        "jumps": np.where(rnd.random(20_000) < 0.01, rnd.integers(1, 10**9, 20_000), rnd.integers(1, 9, 20_000)),
        "one": np.array([5]),
        "none": np.zeros(0, np.int64),
        "steps": np.repeat([1, 3_000, 1, 100_000], 700),
    }[shape]
    offsets = np.cumsum(gaps).astype(np.int64)
    index = fit_lines(offsets)
    ranks = np.arange(len(offsets))
    assert np.array_equal(index.offsets(ranks), offsets)
    assert np.abs(index.residual.astype(int)).max(initial=0) <= ERROR
    if shape == "steady":
        assert len(index.first) < len(offsets) / 100
        assert len(fit_lines(offsets, 8).first) > 2 * len(index.first)
        assert np.abs(fit_lines(offsets, 8).residual).max() <= 8


def test_each_line_is_as_long_as_the_bound_allows():
    """Greedy lines from the first offset: no slope fits one offset more."""
    offsets = np.cumsum(np.random.default_rng(5).integers(1, 30, 3_000)).astype(np.int64)
    error = 20
    index = fit_lines(offsets, error)
    for start, end in zip(index.first.tolist(), index.first[1:].tolist()):
        rise = (offsets[start + 1 : end + 1] - offsets[start]).astype(float)
        steps = np.arange(1, end - start + 1)
        assert ((rise - error + 0.5) / steps).max() > ((rise + error - 0.5) / steps).min()


def test_token_ends_of_odd_texts():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab é日\t\n \x1c\x85\xa0") for _ in range(rnd.randint(0, 9))) for _ in range(800)]
    raw = [t.encode() for t in texts]
    stops = np.cumsum([len(r) for r in raw])
    starts = stops - [len(r) for r in raw]
    ends, counts = token_ends(np.frombuffer(b"".join(raw), np.uint8), starts, stops)
    expected, at = [], 0
    for text in texts:
        for token in TOKEN.findall(text):
            at += len(token.encode())
            expected.append(at)
    assert ends.tolist() == expected
    assert counts.tolist() == [len(TOKEN.findall(t)) for t in texts]


def test_parts_of_odd_texts_and_back():
    rnd = random.Random(9)
    signs = ["<", "<P", "P>", "<S", "S>", ">", "M>", "é", "日", " ", "\n", "a", "<P>", "<M"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    ids = list(range(len(texts)))
    found = transform_slice(ids, [t.encode() for t in texts], 42, Rates(100, 50))
    forms = set()
    for i, text, (n, form, *parts) in zip(ids, texts, found):
        e_n, e_form, e_parts, output = brute(i, text, rates=(100, 50))
        forms.add(form)
        assert (n, form) == (e_n, e_form)
        assert form == "plain" or tuple(p.decode() for p in parts) == e_parts
        assert restore(output.encode(), form).decode() == text
    assert forms == {"plain", "spm", "psm"}


def test_documents_and_awkward_rows(documents, awkward, nothing):
    for docs in (documents, awkward, nothing):
        expected = [digests(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        found = [tuple(r) for r in fill_in_middle(docs).collect()]
        assert sorted(map(str, found)) == sorted(map(str, expected))


def test_texts_as_output(documents):
    rows = {r.doc_id: r for r in fill_in_middle(documents, output="texts").collect()}
    forms = set()
    for r in documents.collect():
        n, form, parts, output = brute(r.doc_id, r.text)
        got = rows[r.doc_id]
        forms.add(form)
        assert (got.n, got.form, got.output) == (n, form, output)
        assert (got.prefix, got.middle, got.suffix) == ((None,) * 3 if form == "plain" else parts)
    assert forms == {"plain", "spm", "psm"}
