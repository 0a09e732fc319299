import hashlib
import random

from kvloom.llm.repeats import remove_repeats

NO_ID = 2**63


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept bytes) of each row."""
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1):
            w = raw[k : k + length]
            first[w] = min(first.get(w, NO_ID), NO_ID if i is None else i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < (NO_ID if i is None else i):
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def check(docs, length=50, block_bytes=50_000):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = remove_repeats(docs, length, block_bytes=block_bytes).collect()
    expected = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, length)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    return found


def test_documents(documents):
    assert sum(r.n_removed for r in check(documents)) > 0


def test_awkward_rows(awkward, nothing):
    check(awkward)
    check(awkward, length=30)
    assert remove_repeats(nothing).count() == 0


def test_passages_shared_in_many_ways(spark):
    """Passages of every length about the limit, of one letter, at all offsets, in random text."""
    rnd = random.Random(5)
    letters = lambda n: "".join(rnd.choice("ab cdé\0") for _ in range(n))
    passages = [letters(n) for n in (24, 30, 48, 49, 50, 51, 80, 300)] + ["a" * 200, "ab" * 90]
    rows = []
    for i in range(150):
        parts = [letters(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, 20)
            parts += [p[cut:], letters(rnd.randint(0, 60))]
        rows.append((rnd.randint(0, 140), "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(docs, block_bytes=2_000)


def test_batches_keep_anchors_together(monkeypatch):
    import numpy as np

    import kvloom.llm.repeats as repeats

    monkeypatch.setattr(repeats, "WINDOWS", 10)
    rnd = np.random.default_rng(1)
    for _ in range(50):
        keys = rnd.integers(0, 8, rnd.integers(1, 40)).astype(np.uint64)
        counts = rnd.integers(1, 9, len(keys))
        batches = list(repeats._batches(keys, counts))
        assert sorted(np.concatenate(batches).tolist()) == list(range(len(keys)))
        assert sum(len(set(keys[b].tolist())) for b in batches) == len(set(keys.tolist()))
        for b in batches:
            assert counts[b].sum() <= 10 or len(set(keys[b].tolist())) == 1


def test_segments_do_not_show(spark, documents, monkeypatch):
    import kvloom.llm.repeats as repeats

    expected = sorted(map(tuple, remove_repeats(documents).collect()))
    monkeypatch.setattr(repeats, "SEGMENT", 997)
    table_of = lambda: documents.filter("doc_id < 20").toPandas()
    import pyarrow as pa

    table = pa.Table.from_pandas(table_of())
    parse = repeats.Parse(table, 50)
    runs = parse.anchored(parse.windows(parse.begins >= 0))
    monkeypatch.setattr(repeats, "SEGMENT", 2_000_000)
    whole = repeats.Parse(table, 50)
    assert (parse.begins == whole.begins).all() and (parse.until == whole.until).all()
    other = whole.anchored(whole.windows(whole.begins >= 0))
    starts = lambda r: [(s, k) for a, b, k in zip(*r) for s in range(a, b + 1)]
    assert starts(runs) == starts(other)
    assert len(expected) == documents.count()


def test_texts_keep_their_columns(awkward):
    found = remove_repeats(awkward, output="texts")
    assert found.columns == awkward.columns
    rows = {(r.doc_id, r.n_bytes): r for r in found.collect() if r.doc_id in (1, 10)}
    assert rows[(1, "4")].n_chars == len(rows[(1, "4")].text)
    assert rows[(10, "4")].text == "" and rows[(10, "4")].size == "1"
