import math
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from kvloom.llm.scoring import score_texts


def brute(rows, order, prior):
    """Scores by the recursion, with counts of the whole corpus in one place."""
    counts, lines = Counter(), []
    for _, text, held_out in rows:
        line = ["<begin>", *(text or "").encode().lower().split(), "<end>"]
        lines.append(line)
        if not held_out:
            for n in range(1, order + 1):
                counts.update(tuple(line[i : i + n]) for i in range(len(line) - n + 1))
    words = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<begin>",)}
    n, v = sum(words.values()), len(words)

    def p(history, word):
        if not history:
            return (words.get((word,), 0) + 1) / (n + v + 1)
        total = counts[history]
        return (counts[(*history, word)] + prior * p(history[1:], word)) / (total + prior)

    out = []
    for line in lines:
        base = sum(math.log10(p((), w)) for w in line[1:])
        score = sum(
            math.log10(p(tuple(line[max(0, i - order + 1) : i]), line[i])) for i in range(1, len(line))
        )
        out.append((len(line) - 1, sum((w,) in words for w in line[1:]), n, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_recursion(documents, order):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    docs = documents.filter("doc_id < 60").withColumn("held_out", held_out)
    rows = [(r.doc_id, r.text, crc32(str(r.doc_id).encode()) % 7 == 2) for r in docs.collect()]
    expected = {r[0]: x for r, x in zip(rows, brute(rows, order, 3.0))}
    found = score_texts(docs, order=order, prior=3.0, block_bytes=40_000).collect()
    assert len(found) == len(rows)
    for r in found:
        n_tokens, known, total, base, score = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_the_model_beats_the_base_on_held_out_text(spark, sf_dir):
    from kvloom.llm.scoring import op1_scoring

    held = op1_scoring(spark, "/root/testdata/sf0.01").filter("held_out")
    row = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert row.score > row.base


def test_awkward_rows(awkward):
    found = score_texts(awkward.withColumn("held_out", F.col("doc_id") == 9)).collect()
    assert len(found) == awkward.count()
    empty = [r for r in found if r.doc_id in (4, 5, 6)]
    assert [r.n_tokens for r in empty] == [1, 1, 1] and len({r.score for r in empty}) == 1
    assert len({r.score for r in found if r.doc_id == 2}) == 1
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_no_rows_and_no_training_rows(nothing, awkward):
    assert score_texts(nothing.withColumn("held_out", F.lit(False))).count() == 0
    alone = score_texts(awkward.filter("doc_id = 1").withColumn("held_out", F.lit(True))).first()
    assert (alone.train_tokens, alone.n_known, alone.score) == (0, 0, 0.0)
