import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_near_duplicates import least_reachable, shingles
from test_repeats import brute

import corpus_pipeline as pipeline

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_results(spark, docs, sf_dir):
    results = [docs]
    for _, stage in pipeline.STAGES:
        results.append(stage(spark, results[-1], sf_dir).cache())
    return results


def test_every_stage_against_its_input(spark, sf_dir, documents):
    first, told, single, cleaned, mixed, last = stage_results(spark, documents, sf_dir)
    assert all(r.columns == documents.columns for r in (told, single, cleaned, mixed))

    rows = {r.doc_id: r for r in first.collect()}
    assert {r.doc_id for r in told.collect()} == {i for i, r in rows.items() if any(c.isalpha() for c in r.text)}

    sets = [(r.doc_id, shingles(r.text, 5)) for r in told.collect()]
    linked = [
        (a, b) for n, (a, s) in enumerate(sets) for b, t in sets[:n]
        if s and t and 100 * len(s & t) >= 80 * len(s | t)
    ]
    least = least_reachable([i for i, _ in sets], linked)
    assert {r.doc_id for r in single.collect()} == set(least.values())

    texts = [(r.doc_id, r.text) for r in single.collect()]
    expected = {i: kept.decode(errors="ignore") for i, _, _, _, kept in brute(texts, 50)}
    found = cleaned.collect()
    assert {r.doc_id: r.text for r in found} == expected
    assert all(r.n_chars == len(r.text) and r.lang == rows[r.doc_id].lang for r in found)

    copies = mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert 1 < copies <= 3
    assert mixed.count() == last.count()
    again = last.join(mixed.select("doc_id", "text").distinct(), "doc_id").filter("n_tokens > 0")
    assert again.count() > 0 and all(len(r.ids) == r.n_tokens for r in last.collect())


def test_awkward_rows_and_no_rows(spark, awkward, nothing, sf_dir):
    results = stage_results(spark, awkward, sf_dir)
    assert all(r.columns == awkward.columns for r in results[:-1])
    assert {r.size for r in results[4].collect()} == {"1"} and {r.score for r in results[1].collect()} == {"2"}
    assert results[-1].count() > 0
    assert [r.count() for r in stage_results(spark, nothing, sf_dir)] == [0] * 6


@pytest.mark.parametrize("lang", [None, "und"])
def test_letters_alone_decide_without_labels(spark, awkward, sf_dir, lang):
    docs = awkward.withColumn("lang", F.lit(lang).cast("string"))
    told = pipeline.language_id(spark, docs, sf_dir).collect()
    expected = [r.text for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert expected and sorted(r.text for r in told) == sorted(expected)


def test_one_row_stays_of_rows_that_share_an_id_or_have_none(spark, sf_dir):
    prose = [" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcde"]
    rows = [(7, prose[0])] * 3 + [(5, prose[0] + " end"), (9, prose[1]), (9, prose[1]), (9, prose[2])]
    rows += [(None, prose[3])] * 2 + [(None, prose[4]), (3, prose[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [(r.doc_id, r.text[0], r.text[-3:]) for r in pipeline.near_dedup(spark, docs, sf_dir).collect()]
    expected = [(5, "a", "end"), (9, "b", "b59"), (9, "c", "c59"), (None, "d", "d59"), (3, "e", "e59")]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_run_is_registered(spark, sf_dir):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10


@pytest.mark.parametrize("gone", [["corpus_pipeline"], ["kvloom.llm", "corpus_pipeline"]])
def test_the_rest_imports_without_the_operators(gone):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        f"        if any(name == g or name.startswith(g + '.') for g in {gone!r}):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'history_rows' in e.queries() and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
