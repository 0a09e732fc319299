"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features and those of the lines beside it give a potential for
good; pairs of neighbouring lines have a potential for each pair of labels. Forward-backward gives
the probability that a line is good, and a document's quality is the mean over its lines weighted
by their length. A labelled document lends its label to all its lines.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kvloom.llm.bpe import slices
from kvloom.llm.common import documents, id_remainder

#: The field is fitted on at most so many labelled documents, no more of them than reach so many
#: characters together; whole documents of any length are taken.
SAMPLE_DOCS = 3_000
SAMPLE_CHARS = 20_000_000
#: Lines that a chain has in the fit; the lines of a longer document are several chains.
CHAIN_LINES = 500
#: Steps and rate of the fit, and the weight of the penalty on squared weights.
STEPS, RATE, PENALTY = 250, 0.05, 1e-3
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _PUNCT, _SYMBOL, _LINE = range(8)
_KINDS: list[np.ndarray] = []
N_OWN = 13


def kind_table() -> np.ndarray:
    """The kind of each code point of the basic plane; others count as lower-case letters."""
    if not _KINDS:
        table = np.full(0x10000, _SYMBOL, np.uint8)
        for p in range(0x10000):
            c = unicodedata.category(chr(p))
            if c[0] in "LM":
                table[p] = _UPPER if c in ("Lu", "Lt") else _LOWER
            elif c[0] == "N":
                table[p] = _DIGIT
            elif chr(p).isspace():
                table[p] = _SPACE
            elif c[0] == "P":
                table[p] = _PUNCT
        table[[ord(c) for c in ".,;:?'\"-"]] = _STOP
        table[ord("\n")] = _LINE
        _KINDS.append(table)
    return _KINDS[0]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and length of each line that is not blank, and its own features."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = np.where(codes < 0x10000, kind_table()[np.minimum(codes, 0xFFFF)], _LOWER)
    breaks = kind == _LINE
    line = np.concatenate([[0], np.cumsum(breaks)[:-1]])
    n_lines = int(line[-1]) + 1
    counts = np.bincount(line * 8 + kind, minlength=8 * n_lines).reshape(n_lines, 8).astype(float)
    bars = np.bincount(line[codes == ord("|")], minlength=n_lines)
    owner = np.searchsorted(ends, np.flatnonzero(breaks), side="right")
    # Words: a number for each from its characters and their places in it.
    inside = (kind != _SPACE) & (kind != _LINE)
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    n_words = np.bincount(line[starts], minlength=n_lines).astype(float)
    distinct = np.zeros(n_lines)
    again = np.zeros(n_lines)
    if len(starts):
        word = np.cumsum(np.concatenate([[0], np.diff(inside.astype(np.int8))]) == 1) + inside[0] - 1
        place = np.arange(len(codes)) - starts[np.maximum(word, 0)]
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
        value = np.add.reduceat(np.where(inside, mixed, np.uint64(0)), starts)
        at = line[starts]
        same = (value[1:] == value[:-1]) & (at[1:] == at[:-1])
        again += np.bincount(at[1:][same], minlength=n_lines)
        order = np.lexsort((value, at))
        value, at = value[order], at[order]
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (at[1:] != at[:-1])])
        distinct += np.bincount(at[new], minlength=n_lines)
    length = counts[:, :_LINE].sum(1)
    letters = counts[:, _LOWER] + counts[:, _UPPER]
    size, words = np.maximum(length, 1), np.maximum(n_words, 1)
    features = np.stack(
        [
            np.log1p(length) / 5,
            letters / size,
            counts[:, _UPPER] / np.maximum(letters, 1),
            counts[:, _DIGIT] / size,
            counts[:, _STOP] / words,
            np.minimum(counts[:, _PUNCT] / words, 3),
            np.minimum(counts[:, _SYMBOL] / words, 3),
            bars / words,
            distinct / words,
            np.minimum(again / words, 1) * 2,
            np.minimum(letters / words, 30) / 10,
            np.log1p(n_words) / 3,
            (counts[:, _UPPER] > 0) & (counts[:, _STOP] > 0),
        ],
        axis=1,
    )
    full = n_words > 0
    return owner[full], length[full], features[full]


def with_neighbours(owner: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A constant, a line's features and those of the lines before and after it in its text."""
    n, f = own.shape
    out = np.zeros((n, 1 + 3 * f + 2))
    out[:, 0] = 1
    out[:, 1 : 1 + f] = own
    if n > 1:
        same = owner[1:] == owner[:-1]
        out[1:, 1 + f : 1 + 2 * f][same] = own[:-1][same]
        out[:-1, 1 + 2 * f : 1 + 3 * f][same] = own[1:][same]
        out[1:, -2] = same
        out[:-1, -1] = same
    return out


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def chain_marginals(
    score: np.ndarray, owner: np.ndarray, pair: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is good, and those of the four pairs at each line but a first.

    `score` is the potential of good, that of bad is 0; `pair` the potentials of label pairs.
    Texts of like length go side by side, so a step handles a line of each of them.
    """
    n = len(score)
    good, both = np.zeros(n), np.zeros((n, 2, 2))
    if not n:
        return good, both
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    size = np.diff(first, append=n)
    order = np.argsort(size, kind="stable")
    node = np.stack([np.zeros(n), score], axis=1)
    begin = 0
    while begin < len(order):
        width = max(8, int(size[order[begin]] * 1.5))
        end = int(np.searchsorted(size[order], width, side="right"))
        end = max(begin + 1, min(end, begin + max(1, 2_000_000 // width)))
        some = order[begin:end]
        begin = end
        width = int(size[some].max())
        places = first[some, None] + np.arange(width)
        here = np.arange(width) < size[some, None]
        places = np.where(here, places, 0)
        forward = np.zeros((len(some), width, 2))
        forward[:, 0] = node[places[:, 0]]
        for t in range(1, width):
            step = _log_sum(forward[:, t - 1, :, None] + pair, 1) + node[places[:, t]]
            forward[:, t] = np.where(here[:, t, None], step, forward[:, t - 1])
        backward = np.zeros((len(some), width, 2))
        for t in range(width - 2, -1, -1):
            step = _log_sum((backward[:, t + 1] + node[places[:, t + 1]])[:, None, :] + pair, 2)
            backward[:, t] = np.where(here[:, t + 1, None], step, 0)
        total = _log_sum(forward[:, -1], 1)
        good[places[here]] = np.exp((forward + backward)[..., 1] - total[:, None])[here]
        if width > 1:
            joint = (
                forward[:, :-1, :, None] + pair + (backward[:, 1:] + node[places[:, 1:]])[:, :, None, :]
            )
            later = here[:, 1:]
            both[places[:, 1:][later]] = np.exp(joint - total[:, None, None, None])[later]
    return good, both


@dataclass
class LineField:
    """Weights of line features, potentials of label pairs and the share of good documents."""

    weights: np.ndarray
    pair: np.ndarray
    prior: float

    def qualities(self, texts: list[str]) -> np.ndarray:
        """The quality of each text; without lines it is the share of good ones in the sample."""
        owner, length, own = line_features(texts)
        good, _ = chain_marginals(with_neighbours(owner, own) @ self.weights, owner, self.pair)
        total = np.bincount(owner, length, minlength=len(texts))
        weighted = np.bincount(owner, length * good, minlength=len(texts))
        return np.clip(np.where(total > 0, weighted / np.maximum(total, 1), self.prior), 0, 1)


def slopes(
    x: np.ndarray, y: np.ndarray, owner: np.ndarray, share: np.ndarray, weights: np.ndarray, pair: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the conditional log-likelihood of labels `y`, each chain weighted by its share.

    The share is the same for all lines of a chain; labels within a chain are equal.
    """
    later = np.concatenate([[False], owner[1:] == owner[:-1]])
    seen = np.array([[(later & (y == 0)) @ share, 0], [0, (later & (y == 1)) @ share]])
    good, both = chain_marginals(x @ weights, owner, pair)
    return x.T @ ((y - good) * share), seen - np.tensordot(share, both, 1)


def chains(owner: np.ndarray, most: int) -> np.ndarray:
    """A number for each run of at most so many lines of one text; it ascends."""
    if not len(owner):
        return owner
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(first, append=len(owner)))
    return np.cumsum(place % most == 0)


def fit_field(texts: list[str], labels: list[int], chain_lines: int = CHAIN_LINES) -> LineField:
    """Maximum conditional likelihood by gradient steps; every label sequence is constant."""
    owner, _, own = line_features(texts)
    label = np.array(labels, float)
    prior = float(label.mean()) if len(label) else 0.5
    x = with_neighbours(owner, own)
    weights, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    if len(owner) and 0 < prior < 1:
        y = label[owner]
        # A text counts the same whatever its number of lines.
        share = 1 / np.bincount(owner)[owner] / len(np.unique(owner))
        chain = chains(owner, chain_lines)
        state = [np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))]
        for step in range(1, STEPS + 1):
            up = slopes(x, y, chain, share, weights, pair)
            for i, (value, rise) in enumerate(zip((weights, pair), up)):
                slope = rise - PENALTY * value
                state[2 * i] = 0.9 * state[2 * i] + 0.1 * slope
                state[2 * i + 1] = 0.999 * state[2 * i + 1] + 0.001 * slope**2
                mean, square = state[2 * i] / (1 - 0.9**step), state[2 * i + 1] / (1 - 0.999**step)
                value += RATE * mean / (np.sqrt(square) + 1e-8)
    return LineField(weights, pair, prior)


def train_quality(
    docs: DataFrame, labels: DataFrame, most_docs: int = SAMPLE_DOCS, most_chars: int = SAMPLE_CHARS
) -> LineField:
    """Fit on the labelled documents of the lowest hashes of doc_id, within the two bounds.

    `labels` has doc_id and quality; rows without either are not used, of several labels of one
    document the lowest counts, of several texts the first in order. Without rows of both labels, or
    without any, every quality is the prior. The last document within the bound of characters is
    taken whole, so one very long document may go beyond it.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_docs)
    )
    labelled = (
        docs.select("doc_id", "text")
        .filter("text IS NOT NULL")
        .join(F.broadcast(chosen), "doc_id")  # at most `most_docs` rows
    )
    sizes = labelled.groupBy("doc_id").agg(F.max(F.length("text")).alias("size"))
    upto = W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(upto), F.lit(0))
    within = sizes.withColumn("before", before).filter(F.col("before") < most_chars)
    rows = (
        labelled.join(F.broadcast(within.select("doc_id")), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
        .orderBy("doc_id")
        .collect()
    )
    return fit_field([r["text"] for r in rows], [r["quality"] for r in rows])


def score_quality(docs: DataFrame, field: LineField, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted (1 if the score is at least the threshold).

    A null or blank text gets the share of good documents in the sample. Repeated rows and null
    ids stay; other columns are not returned, whatever their names. The lines of a very long text are
    one chain, in memory at once. No rows give no rows.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [field.qualities(texts[part]) for part in slices(texts, 500_000)]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        score, "doc_id long, score double, predicted int"
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = id_remainder("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    field = train_quality(docs, labels.filter(~held_out))
    return score_quality(docs, field).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )
