"""Language-model scores by a weighted backoff automaton.

The states are the word sequences of up to order - 1 words seen in training; an arc leads from a
state by a word that was seen after it, weighted by the log10 probability of the word there. From
a state without an arc for the next word its failure arc leads to the state without the first
word, at the cost of the state's backoff weight; the root has an arc for every word. A text is
scored by one walk from left to right that carries the state and adds weights up.

Probabilities are smoothed with the next shorter history as prior: (c(hw) + m p(w|h')) / (c(h) + m),
so the backoff weight of h is m / (c(h) + m); the root has add-one probabilities.

The counts of the corpus are never in one place. Each block of documents asks for the counts of
its own n-grams and builds the part of the automaton that its texts can reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm import blocks as B
from kvloom.llm.common import documents, id_remainder, kept_table

#: Words in the longest n-gram, and the weight of the shorter history's probability.
ORDER = 2
PRIOR = 20.0
BLOCK_BYTES = 8_000_000
_END, _BEGIN = 0, 1
#: What cannot be a word, as words hold no white space.
_MARKS = (b"\n", b"\t")
RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


class BlockGrams:
    """The words of a block's texts as numbers, and its distinct n-grams of each order.

    A text is `begin w1 .. wn end`. Unigrams leave out `begin`; as a history it has a count of its
    own, kept as order 0.
    """

    def __init__(self, texts: list[str], order: int):
        numbers: dict[bytes, int] = {_MARKS[0]: _END, _MARKS[1]: _BEGIN}
        lines = []
        for text in texts:
            # Only A-Z are lower-cased, and only ASCII white space separates.
            words = text.encode().lower().split()
            lines.append([_BEGIN, *[numbers.setdefault(w, len(numbers)) for w in words], _END])
        self.lines = lines
        self.sizes = np.array([len(x) for x in lines])
        self.words = np.fromiter((w for x in lines for w in x), np.int64, int(self.sizes.sum()))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
        self.n_words = len(numbers)
        starts = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.words)) - np.repeat(starts, self.sizes)
        word = hashes[self.words]
        # key[k][i]: n-gram of k words that ends at i; at[k]: where there is one.
        self.at = [np.flatnonzero(place == 0), np.flatnonzero(place > 0)]
        key = [word, word]
        for k in range(2, order + 1):
            longer = np.zeros(len(word), np.uint64)
            here = np.flatnonzero(place >= k - 1)
            longer[here] = B.mixed(
                key[k - 1][here - 1] * np.uint64(0x9E3779B97F4A7C15) + word[here] + np.uint64(k)
            )
            key.append(longer)
            self.at.append(here)
        self.key = key
        self.grams: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.index: list[np.ndarray] = []
        for k in range(order + 1):
            grams, first, index = np.unique(
                B.mixed(key[k][self.at[k]]), return_index=True, return_inverse=True
            )
            self.grams.append(grams)
            self.first.append(self.at[k][first])
            self.index.append(index)


def log_probabilities(
    found: BlockGrams, counts: list[np.ndarray], n_train: int, n_distinct: int, order: int, prior: float
) -> Iterator[float]:
    """Walk the automaton over each text of the block; `counts` holds training counts by order."""
    v = found.n_words
    # The number that an n-gram ending at a place has among those of its order, or -1.
    place = []
    for k in range(order + 1):
        line = np.full(len(found.words), -1, np.int64)
        line[found.at[k]] = found.index[k]
        place.append(line)
    # State 0 is the root, then the seen histories, by order.
    state = []
    n_states = 1
    for k in range(order):
        seen = counts[k] > 0
        numbers = np.where(seen, n_states + np.cumsum(seen) - 1, 0)
        n_states += int(seen.sum())
        state.append(numbers)
    fail = np.zeros(n_states, np.int64)
    backoff = np.zeros(n_states)
    root = np.zeros(v)
    floor = 1.0 / (n_train + n_distinct + 1)
    root[:] = floor
    root[found.words[found.first[1]]] = (counts[1] + 1.0) * floor
    probability = [np.zeros(0), root[found.words[found.first[1]]]]
    keys = [np.arange(v)]
    weights = [np.log10(root)]
    targets = [np.zeros(v, np.int64)]
    if order > 1:
        targets[0][found.words[found.first[1]]] = state[1]
    for k in range(order):
        number = state[k]
        seen = number > 0
        backoff[number[seen]] = np.log10(prior / (counts[k][seen] + prior))
        if k > 1:
            fail[number[seen]] = state[k - 1][place[k - 1][found.first[k][seen]]]
    for k in range(2, order + 1):
        here = found.first[k]
        word = found.words[here]
        begins = place[k - 1][here - 1] < 0 if k == 2 else np.zeros(len(here), bool)
        history = np.where(begins, place[0][here - 1], place[k - 1][here - 1])
        total = np.where(
            begins, counts[0][np.where(begins, history, 0)] if len(counts[0]) else 0,
            counts[k - 1][np.where(begins, 0, history)],
        )
        shorter = probability[k - 1][place[k - 1][here]]
        probability.append((counts[k] + prior * shorter) / (total + prior))
        seen = counts[k] > 0
        source = np.where(
            begins, state[0][np.where(begins, history, 0)], state[k - 1][np.where(begins, 0, history)]
        )
        keys.append((source * v + word)[seen])
        weights.append(np.log10(probability[k][seen]))
        step = state[k] if k < order else state[k - 1][place[k - 1][here]]
        targets.append(step[seen])
    arcs = dict(zip(np.concatenate(keys).tolist(), range(sum(map(len, keys)))))
    arc = arcs.get
    weight, target = np.concatenate(weights).tolist(), np.concatenate(targets).tolist()
    fails, backoffs = fail.tolist(), backoff.tolist()
    begin = int(state[0][0]) if order > 1 else 0
    for line in found.lines:
        total, s = 0.0, begin
        for w in line[1:]:
            a = arc(s * v + w)
            while a is None:
                total += backoffs[s]
                s = fails[s]
                a = arc(s * v + w)
            total += weight[a]
            s = target[a]
        yield total


def score_texts(
    docs: DataFrame,
    training: str = "NOT held_out",
    order: int = ORDER,
    prior: float = PRIOR,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Score every text by a model of the texts for which `training` holds.

    `docs` has doc_id, text and held_out. A null text is an empty one: it has one token, its end.
    Repeated rows count as often as they stand there; null ids stay; a row for which `training`
    is null is not learned from; other columns are not returned, whatever their names. Without
    training texts all counts are 0 and every token has probability 1. A very long text is a block of
    its own, walked whole, with some fifty times its size in memory. No rows give no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        "held_out",
        F.coalesce(F.expr(training), F.lit(False)).alias("in_training"),
    )
    stored = B.make_blocks(rows, block_bytes)
    ranges = stored.ranges

    def questions(block_id: int, table: pa.Table) -> Iterator[tuple]:
        found = BlockGrams([t or "" for t in table.column("text").to_pylist()], order)
        train = np.repeat(table.column("in_training").to_numpy(), found.sizes)
        for k in range(order + 1):
            counts = np.bincount(
                found.index[k][train[found.at[k]]], minlength=len(found.grams[k])
            ).astype(np.uint32)
            yield from B.question_rows(block_id, k, found.grams[k], counts, ranges)

    def reply(kind: int, keys: np.ndarray, payloads: list[bytes], asked: list[int]):
        counts = np.frombuffer(b"".join(payloads), np.uint32)
        order_ = np.argsort(keys)
        new = B.equal_runs(keys[order_])
        totals = np.add.reduceat(counts[order_].astype(np.uint64), new)
        out = np.empty(len(keys), np.uint64)
        out[order_] = np.repeat(totals, np.diff(new, append=len(keys)))
        return B.cut_up(out, asked), int(totals.sum()), int((totals > 0).sum())

    answers = kept_table(B.answer(B.ask(stored, questions), reply), "counts")
    unigrams = answers.filter("block_id IS NULL AND kind = 1")
    row = unigrams.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct"),
    ).first()
    n_train, n_distinct = row["tokens"], row["distinct"]

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        found = BlockGrams([t or "" for t in table.column("text").to_pylist()], order)
        counts = [B.told(replies, k, np.uint64).astype(np.int64) for k in range(order + 1)]
        own = counts[1][found.index[1]]
        starts = np.cumsum(found.sizes - 1) - (found.sizes - 1)
        base = np.add.reduceat(np.log10((own + 1.0) / (n_train + n_distinct + 1)), starts)
        known = np.add.reduceat((own > 0).astype(np.int64), starts)
        scores = list(log_probabilities(found, counts, n_train, n_distinct, order, prior))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "held_out": table.column("held_out"),
                "n_tokens": pa.array(found.sizes - 1, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array([n_train] * len(scores), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    return B.with_answers(stored, answers, finish, RESULT)


def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return score_texts(docs.withColumn("held_out", id_remainder("doc_id", 7) == 2))
