"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams of one to three characters, words padded
by a blank. A document goes to the language whose profile is nearest by out-of-place distance: for
each n-gram of the document's profile the difference of its ranks, or the length of a profile if
the language lacks it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kvloom.llm.bpe import slices
from kvloom.llm.common import documents, id_remainder, kept_table, positions

#: N-grams in a profile.
PROFILE = 300
#: Profiles of so many languages are sent to the tasks at once; more are compared in turns.
LANGUAGES = 5_000
#: Distinct n-grams that a task collects before it passes them on.
HELD = 1_000_000
_BITS = 21
_ABSENT = (1 << _BITS) - 1
_LETTERS: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; made once a worker."""
    if not _LETTERS:
        points = range(0x110000)
        _LETTERS.append(np.fromiter((chr(p).isalpha() for p in points), bool, len(points)))
    return _LETTERS[0]


def ngram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the text, n-gram and count, in order of text and n-gram.

    An n-gram is a number of three code points of 21 bits, 0 for the blank at the end of a word.
    """
    joined = " ".join(t.lower() for t in texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    letter = letter_table()[codes]
    # Of what is between two words one blank is left.
    keep = letter | np.concatenate([[False], letter[:-1]])
    codes, owner = np.where(letter, codes, 0)[keep], owner[keep]
    if not len(codes):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    alphabet, small = np.unique(codes, return_inverse=True)
    if alphabet[0]:
        alphabet, small = np.concatenate([[0], alphabet]).astype(alphabet.dtype), small + 1
    # Small codes keep the order of the code points; the last one stands for what is not there.
    missing = len(alphabet)
    base = missing + 1
    points = np.append(alphabet.astype(np.int64), _ABSENT)
    small = small.astype(np.int64)
    full = small > 0
    together = owner[:-1] == owner[1:]
    triple = together[:-1] & together[1:] & full[1:-1]
    # The blank before a text's first word stands nowhere in the array; before any other word it
    # is the one after the word before.
    first = np.flatnonzero(full & np.concatenate([[True], ~together]))
    second = small[np.minimum(first + 1, len(small) - 1)]
    parts = [
        (owner[full], small[full], missing, missing),
        (owner[:-1][together], small[:-1][together], small[1:][together], missing),
        (owner[:-2][triple], small[:-2][triple], small[1:-1][triple], small[2:][triple]),
        (owner[first], 0, small[first], missing),
        (owner[first], 0, small[first], second),
    ]
    keys = np.concatenate([((o * base + x) * base + y) * base + z for o, x, y, z in parts])
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(new, append=len(keys))
    rest, z = np.divmod(keys[new], base)
    rest, y = np.divmod(rest, base)
    text, x = np.divmod(rest, base)
    return text, (points[x] << 2 * _BITS) | (points[y] << _BITS) | points[z], counts


def train_profiles(docs: DataFrame, length: int = PROFILE) -> DataFrame:
    """lang, gram, rank: the most frequent n-grams of all rows that have text and lang.

    Tasks add n-grams up before the shuffle. Equal counts go by the n-gram's number. Repeated rows
    count as often as they stand there, a very long text counts whole. Without such rows there are no
    profiles.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def added_up() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            lang, gram, n = (np.concatenate(v) for v in zip(*held))
            order = np.lexsort((gram, lang))
            lang, gram, n = lang[order], gram[order], n[order]
            new = np.flatnonzero(
                np.concatenate([[True], (lang[1:] != lang[:-1]) | (gram[1:] != gram[:-1])])
            )
            return lang[new], gram[new], np.add.reduceat(n, new)

        def out() -> pa.RecordBatch:
            lang, gram, n = held[0]
            listed = list(names)
            return pa.RecordBatch.from_arrays(
                [pa.array([listed[i] for i in lang.tolist()], pa.string()), pa.array(gram), pa.array(n)],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for part in slices(texts, 1_000_000):
                ids = np.array([names.setdefault(x, len(names)) for x in langs[part]])
                text, gram, n = ngram_counts(texts[part])
                if len(text):
                    held.append((ids[text], gram, n))
                if sum(len(h[0]) for h in held) > HELD:
                    held[:] = [added_up()]
                    if len(held[0][0]) > HELD // 2:
                        yield out()
                        held.clear()
        if held:
            held[:] = [added_up()]
            yield out()

    grams = (
        docs.filter("text IS NOT NULL AND lang IS NOT NULL")
        .select("text", F.col("lang").cast("string"))
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    ranked = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return (
        grams.withColumn("rank", ranked)
        .filter(F.col("rank") <= length)
        .select("lang", "gram", (F.col("rank") - 1).alias("rank"))
    )


class Profiles:
    """The profiles of all languages as one table of ranks by n-gram and language."""

    def __init__(self, rows: list, length: int):
        self.langs = sorted({r["lang"] for r in rows})
        self.length = length
        self.grams = np.array(sorted({r["gram"] for r in rows}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        at = np.searchsorted(self.grams, np.array([r["gram"] for r in rows], np.int64))
        lang = {name: i for i, name in enumerate(self.langs)}
        for i, row in zip(at, rows):
            self.ranks[i, lang[row["lang"]]] = row["rank"]

    def predict(self, texts: list[str], letterless: str | None = "und") -> tuple[list[str | None], list[float]]:
        """Language and score of each text; the score is 1 for a distance of 0, 0 for the largest."""
        langs, scores = [letterless] * len(texts), [0.0] * len(texts)
        text, gram, count = ngram_counts(texts)
        if not len(text) or not self.langs:
            for i in np.unique(text):
                langs[i] = "und"
            return langs, scores
        most = count.max() + 1
        order = np.argsort(text * most + (most - 1 - count), kind="stable")
        text, gram = text[order], gram[order]
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        rank = np.arange(len(text)) - np.repeat(first, np.diff(first, append=len(text)))
        top = rank < self.length
        text, gram, rank = text[top], gram[top], rank[top]
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        at = np.where(self.grams[at] == gram, at, len(self.grams))
        known = self.ranks[at]
        away = np.where(known < 0, self.length, np.abs(known - rank[:, None]))
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        sizes = np.diff(first, append=len(text))
        distance = np.add.reduceat(away, first, axis=0) / (sizes * self.length)[:, None]
        for i, best, least in zip(text[first], distance.argmin(1), distance.min(1)):
            langs[i], scores[i] = self.langs[best], float(1 - least)
        return langs, scores


def turns(profiles: DataFrame, most: int) -> Iterator[DataFrame]:
    """The profiles of so many languages at a time, in code point order of their names."""
    kept = kept_table(profiles, "profiles")
    n = kept.select("lang").distinct().count()
    if n <= most:
        yield kept
        return
    turn = F.floor(F.col("position") / most)
    numbered = kept_table(
        kept.join(positions(kept, "lang").withColumn("turn", turn), "lang").select(*kept.columns, "turn"), "turns"
    )
    for number in range(-(-n // most)):
        yield numbered.filter(F.col("turn") == number).drop("turn")


def identify(
    docs: DataFrame,
    profiles: DataFrame,
    length: int = PROFILE,
    letterless: str | None = "und",
    languages: int = LANGUAGES,
) -> DataFrame:
    """The rows with lang_pred and score added.

    `docs` has text. A text that is null or has no letter gets `letterless` and 0; all others get
    `und` and 0 if there are no profiles. Of equal distances the language first in code point order is
    taken. Columns of `docs` named as the new ones are replaced; all others are passed on. Repeated
    rows stay, each with its own result; a very long text counts whole, a million characters and more
    in one go. No rows give no rows.

    Any number of languages is compared: with more than `languages`, rows are gone over in turns, each
    with the profiles of the next languages, and keep the best so far in between. So neither the
    driver nor a task holds more profiles than that.
    """
    rows = docs.drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*rows.schema.fields, *added])
    names = [*rows.columns, "lang_pred", "score"]
    found = None
    for some in turns(profiles, languages):
        model = Profiles(some.collect(), length)

        def predict(
            batches: Iterator[pa.RecordBatch], model: Profiles = model, again: bool = found is not None
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                langs: list[str | None] = []
                scores: list[float] = []
                for part in slices(texts, 1_000_000):
                    a, b = model.predict(texts[part], letterless)
                    langs += a
                    scores += b
                passed = batch.columns
                if again:
                    *passed, langs_before, scores_before = passed
                    before = zip(langs_before.to_pylist(), scores_before.to_pylist())
                    # Earlier languages go first; a text's first turn has told whether it has a letter.
                    best = [o if o[1] >= n[1] else n for o, n in zip(before, zip(langs, scores))]
                    langs, scores = [x for x, _ in best], [x for _, x in best]
                yield pa.RecordBatch.from_arrays(
                    [*passed, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names
                )

        found = (rows if found is None else kept_table(found, "languages")).mapInArrow(predict, schema)
    return found


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 3) == 1
    found = identify(docs.select("doc_id", "text"), train_profiles(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
