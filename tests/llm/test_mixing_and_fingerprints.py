import hashlib
from collections import Counter

import numpy as np
import pytest
from compare import differences

from kvloom.llm.fingerprints import fingerprint_documents
from kvloom.llm.mixing import OP5_SQL, mix_sources, op5_mixing


def test_mix_equals_sql(spark, sf_dir):
    assert differences(spark, sf_dir, op5_mixing, OP5_SQL) == []


def check_mix(docs):
    rows = mix_sources(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    total = sum(sizes.values())
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: float(i % 3 + 1) for i, s in enumerate(names)}
    stopped = set()
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(3.0 * sizes[s] for s in stopped)
        level = rest / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * level > 3.0 * sizes[s]}
        if not above:
            break
        stopped |= above
    for r in rows:
        target = 3.0 * sizes[r.source] if r.source in stopped else weight[r.source] * level
        assert r.target == pytest.approx(target) and r.source_size == sizes[r.source]
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
    for s in names:
        mine = [r for r in rows if r.source == s]
        by_id = Counter()
        for r in mine:
            by_id[r.doc_id] += r.size
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(by_id.values()) / 2 + 1e-6
    assert sorted(map(str, rows)) == sorted(map(str, mix_sources(docs.repartition(7)).collect()))
    return rows


def test_mix_of_awkward_rows(awkward, nothing, spark):
    rows = check_mix(awkward)
    assert len(rows) == awkward.count() and "Range" in rows[0].asDict()
    assert mix_sources(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mix_sources(blank).collect()] == [(0, 0.0, 0)] * 2


def test_small_and_large_sources(spark):
    rows = [(i, "w " * (i % 50 + 1), "big") for i in range(3000)]
    rows += [(5000 + i, "w " * 10, f"s{i:02}") for i in range(30)]
    check_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def likeness(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    words = a.keys() | b.keys()
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words) if words else 1.0


def check_fingerprints(docs, partitions):
    def key(r):
        return (r.doc_id is None, -(r.doc_id or 0), r.text or "")

    rows = sorted(docs.select("doc_id", "text").collect(), key=key)
    found = fingerprint_documents(docs.repartition(partitions)).collect()
    texts = [r.text or "" for r in rows]
    expected, errors = [], []
    for i, text in enumerate(texts):
        third = len(text) // 3
        edited = text[: len(text) - third] + texts[(i + 1) % len(texts)][:third]
        expected.append((rows[i].doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        errors.append((likeness(text, edited), likeness(text, texts[(i + 1) % len(texts)])))
    by_key = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in found}
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in found)
    prints = {}
    for row, text in zip(expected, texts):
        assert prints.setdefault(text, by_key[row].fingerprint) == by_key[row].fingerprint
    return [
        (by_key[row].near_edited - e[0], by_key[row].near_next - e[1]) for row, e in zip(expected, errors)
    ], by_key


def test_fingerprints_of_documents(documents):
    errors, _ = check_fingerprints(documents, 5)
    errors = np.array(errors)
    assert np.abs(errors.mean(0)).max() < 0.03 and errors.std(0).max() < 0.09


def test_fingerprints_of_awkward_rows(awkward, nothing):
    _, rows = check_fingerprints(awkward, 2)
    blank = [r for r in rows.values() if r.doc_id in (4, 5)]
    assert {r.fingerprint for r in blank} == {""}
    assert fingerprint_documents(nothing).count() == 0
    one = fingerprint_documents(awkward.filter("doc_id = 1")).first()
    assert one.near_next == 1.0 and 0 < one.near_edited <= 1.0


def test_native(spark, sf_dir, documents):
    from kvloom.llm.fingerprints import op4_fingerprints

    for query in (op4_fingerprints, op5_mixing):
        plan = query(spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
