import itertools
import math
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kvloom.llm import quality
from kvloom.llm.language import identify, ngram_counts, op8_language, train_profiles
from kvloom.llm.quality import op10_quality, score_quality, train_quality

ABSENT = (1 << 21) - 1


def grams(text):
    out = Counter()
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for word in words:
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != " ":
                    codes = [0 if c == " " else ord(c) for c in gram] + [ABSENT] * (3 - n)
                    out[(codes[0] << 42) | (codes[1] << 21) | codes[2]] += 1
    return out


def test_ngrams_are_counted_as_in_single_words(awkward, documents):
    texts = [r.text or "" for r in awkward.collect()] + ["a", "", "İß x日"]
    texts += [r.text for r in documents.limit(20).collect()]
    found = [Counter() for _ in texts]
    for i, gram, n in zip(*ngram_counts(texts)):
        found[i][int(gram)] += int(n)
    assert found == [grams(t) for t in texts]


def test_profiles_and_distances(spark):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("und", None), (None, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    profiles = train_profiles(docs, 20)
    by_lang = {}
    for r in profiles.collect():
        by_lang.setdefault(r.lang, {})[r.gram] = r.rank
    ranks = {}
    for text, lang in rows[:2]:
        ordered = sorted(grams(text).items(), key=lambda x: (-x[1], x[0]))
        ranks[lang] = {g: i for i, (g, _) in enumerate(ordered[:20])}
    assert by_lang == ranks
    text = "die Katze and"
    mine = [g for g, _ in sorted(grams(text).items(), key=lambda x: (-x[1], x[0]))][:20]
    away = {
        lang: sum(abs(known[g] - i) if g in known else 20 for i, g in enumerate(mine)) / (20 * len(mine))
        for lang, known in ranks.items()
    }
    row = identify(spark.createDataFrame([(text,)], "text string"), profiles, 20).first()
    best = min(sorted(away), key=away.get)
    assert row.lang_pred == best and math.isclose(row.score, 1 - away[best])


def test_many_languages_are_compared_in_turns(awkward):
    """Some languages of one profile each: in turns of one, two and all, ties included."""
    rows = awkward.withColumn("lang", F.concat(F.coalesce("lang", F.lit("x")), F.pmod(F.hash("text"), F.lit(3))))
    twins = rows.union(rows.withColumn("lang", F.concat(F.lit("a"), "lang")))
    profiles = train_profiles(twins)
    assert profiles.select("lang").distinct().count() > 6
    columns = ["doc_id", "text", "lang_pred", "score"]
    expected = sorted(map(str, identify(awkward, profiles).select(*columns).collect()))
    for most in (1, 2, 5):
        found = identify(awkward, profiles, languages=most).select(*columns).collect()
        assert sorted(map(str, found)) == expected


def test_held_out_languages(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = op8_language(spark, sf_dir).filter("held_out").join(truth, "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_of_awkward_rows(awkward, nothing):
    profiles = train_profiles(awkward)
    found = identify(awkward, profiles)
    assert found.columns == [*(c for c in awkward.columns if c != "score"), "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == awkward.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in identify(awkward, train_profiles(nothing)).collect()} == {"und"}
    assert identify(nothing, profiles).count() == 0


def test_marginals_by_enumeration():
    rnd = np.random.default_rng(4)
    sizes = [1, 2, 5, 3, 1, 4]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    score, pair = rnd.standard_normal(len(owner)), rnd.standard_normal((2, 2))
    good, both = quality.chain_marginals(score, owner, pair)
    for i, size in enumerate(sizes):
        mine = np.flatnonzero(owner == i)
        total, one, two = 0.0, np.zeros(size), np.zeros((size, 2, 2))
        for labels in itertools.product((0, 1), repeat=size):
            energy = sum(score[mine[k]] * labels[k] for k in range(size))
            energy += sum(pair[labels[k - 1], labels[k]] for k in range(1, size))
            weight = math.exp(energy)
            total += weight
            one += weight * np.array(labels)
            for k in range(1, size):
                two[k, labels[k - 1], labels[k]] += weight
        assert np.allclose(good[mine], one / total) and np.allclose(both[mine], two / total)


def test_line_features_do_not_depend_on_the_batch():
    texts = ["A line.\n\nB | C | d\n x x x", "", "\n", "One two one. 😀", "ÄÖ!! 12\tq"]
    owner, length, rows = quality.line_features(texts)
    for i, text in enumerate(texts):
        _, alone, single = quality.line_features([text])
        assert np.allclose(rows[owner == i], single) and (length[owner == i] == alone).all()
    assert (np.bincount(owner, minlength=5) == [3, 0, 0, 1, 1]).all()


def plain_features(line):
    """The features of a line, one after the other, from its characters."""
    kinds = {c: unicodedata.category(c) for c in line}
    n = lambda *starts: sum(kinds[c].startswith(starts) for c in line)
    words = line.split()
    stops = sum(c in ".,;:?'\"-" for c in line)
    letters, upper, spaces = n("L", "M"), n("Lu", "Lt"), sum(c.isspace() for c in line)
    digits, punctuation = n("N"), n("P") - sum(c in ".,;:?'\"-" for c in line)
    symbols = len(line) - letters - digits - n("P") - spaces
    w, size = len(words), len(line)
    return [
        math.log1p(size) / 5,
        letters / size,
        upper / max(letters, 1),
        digits / size,
        stops / w,
        min(punctuation / w, 3),
        min(symbols / w, 3),
        line.count("|") / w,
        len(set(words)) / w,
        min(sum(a == b for a, b in zip(words, words[1:])) / w, 1) * 2,
        min(letters / w, 30) / 10,
        math.log1p(w) / 3,
        float(upper > 0 and stops > 0),
    ]


def test_line_features_one_by_one(documents):
    texts = [r.text for r in documents.limit(40).collect()]
    texts += ["A line, a Line.", "x x x | x || 42 %%% $1.50", "ÄÖ über 日本 ½ ― “so”", "tab\there  and   there"]
    owner, length, rows = quality.line_features(texts)
    expected = [
        (i, len(line), plain_features(line)) for i, t in enumerate(texts) for line in t.split("\n") if line.split()
    ]
    assert owner.tolist() == [i for i, _, _ in expected] and length.tolist() == [n for _, n, _ in expected]
    assert np.allclose(rows, [f for _, _, f in expected])


def test_the_gradient_is_that_of_the_likelihood():
    """Slopes against differences of the likelihood, which sums over all label sequences."""
    rnd = np.random.default_rng(6)
    sizes, labels = [1, 3, 4, 2], np.array([1.0, 0.0, 1.0, 0.0])
    owner = np.repeat(np.arange(4), sizes)
    x, y = rnd.standard_normal((10, 3)), labels[owner]
    share = (1 / np.array(sizes))[owner] / 4
    weights, pair = rnd.standard_normal(3), rnd.standard_normal((2, 2))

    def likelihood(weights, pair):
        total = 0.0
        for i, size in enumerate(sizes):
            score = x[owner == i] @ weights

            def energy(line):
                return score @ np.array(line) + sum(pair[a, b] for a, b in zip(line, line[1:]))

            z = math.log(sum(math.exp(energy(line)) for line in itertools.product((0, 1), repeat=size)))
            total += (energy([int(labels[i])] * size) - z) / size / 4
        return total

    by_weight, by_pair = quality.slopes(x, y, owner, share, weights, pair)
    for value, slope in ((weights, by_weight), (pair, by_pair)):
        for at in np.ndindex(value.shape):
            step = np.zeros_like(value)
            step[at] = 1e-6
            ends = [(weights + s, pair) if value is weights else (weights, pair + s) for s in (step, -step)]
            assert math.isclose(slope[at], (likelihood(*ends[0]) - likelihood(*ends[1])) / 2e-6, abs_tol=1e-6)


def test_long_documents_are_fitted_in_several_chains(spark):
    assert quality.chains(np.array([0, 0, 0, 2, 2, 5]), 2).tolist() == [1, 1, 2, 3, 3, 4]
    assert quality.chains(np.zeros(0, int), 2).tolist() == []
    good = "The cat sat on the mat, and it was warm.\n"
    rows = [(i, good * (1 + i % 3) if i % 2 else "buy!!! now $$$ | 99\n" * (1 + i % 4)) for i in range(40)]
    rows += [(100, good * 5000), (102, "win $$$ | 7 7 7\n" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 1 OR doc_id = 100 AS int) AS quality")
    field = train_quality(docs, labels)
    found = {r.doc_id: r.score for r in score_quality(docs, field).collect()}
    assert all((score > 0.5) == (i % 2 == 1 or i == 100) for i, score in found.items())
    # A bound of characters leaves out whole documents, not long ones.
    assert train_quality(docs, labels, most_chars=1).prior in (0.0, 1.0)


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = op10_quality(spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    above = np.mean([[g > b for b in bad] for g in good])
    right = np.mean([r.predicted == r.quality for r in rows])
    assert above > 0.97 and right > 0.93


def test_quality_of_awkward_rows(spark, awkward, nothing):
    rows = [(1, 1), (3, 0), (9, 1), (9, 0), (None, 1), (12, None), (99, 1), (8, 1), (7, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    field = train_quality(awkward, labels)
    found = score_quality(awkward, field).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found if r.doc_id in (4, 5, 6)} == {field.prior}
    assert score_quality(nothing, field).count() == 0
    plain = train_quality(nothing, labels)
    assert {r.score for r in score_quality(awkward, plain).collect()} == {0.5}
