"""Near-duplicate documents by MinHash with tensored banding.

Each of two collections holds a few short groups of minhashes. A table key joins a group of the
first with one of the second, so t groups in each give t * t tables for 2 t groups: the number of
minhashes grows with the square root of the number of tables. A pair is missed only if all groups
of one collection differ.

Links are confirmed on the full shingle sets. In every table cell the smallest document leads the
others. Each document is compared with the smallest of its leaders first, then with those of the
others that it is not connected to yet: a group of copies, exact or near, costs about as many
comparisons as it has members. What is left are documents that met a leader without becoming
connected to it: they may be linked to others that met it. A pair of sets so alike must share one of
the rarest shingles of each, near the front of their order by rarity, and of the smaller set nearer
still, so those documents are joined with the others by their rare shingles; pairs that could still
reach the similarity, and are not connected yet, are confirmed, too. After that no pair that shares a
cell is untested but those within one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm import blocks as B
from kvloom.llm.common import discard, documents, kept_table
from kvloom.llm.graph import components

#: Groups in each collection and minhashes in a group: 100 tables out of 40 minhashes. At a
#: similarity of 0.85 a pair is missed with a probability of 5e-6, at 0.8 of 7e-5.
GROUPS, IN_GROUP = 10, 2
BLOCK_BYTES = 8_000_000
_SEEDS = B.mixed(np.arange(1, 2 * 64 * 8, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_CELL = np.dtype([("least", "<i8"), ("several", "u1")])
_LEADER = np.dtype([("leader", "<i8"), ("shared", "u1")])


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Distinct shingles of each text as ascending 64-bit hashes.

    Only A-Z are lower-cased. A text with fewer words than a shingle has one: all its words; a
    text without words has none.
    """
    numbers: dict[bytes, int] = {}
    lines = [
        [numbers.setdefault(w, len(numbers)) for w in text.encode().lower().split()] for text in texts
    ]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    out = []
    for line in lines:
        words = hashes[np.array(line, np.int64)]
        n = min(width, len(words))
        if n:
            value = np.full(len(words) - n + 1, n, np.uint64)
            for k in range(n):
                value = B.mixed(value + words[k : len(words) - n + 1 + k])
            out.append(np.unique(value))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def table_keys(sets: list[np.ndarray], groups: int, in_group: int) -> np.ndarray:
    """The keys of each set that is not empty, one row a set, one column a table."""
    full = [s for s in sets if len(s)]
    if not full:
        return np.zeros((0, groups * groups), np.uint64)
    joined = np.concatenate(full)
    starts = np.cumsum([0, *[len(s) for s in full[:-1]]])
    both = []
    seed = iter(_SEEDS[: 2 * 2 * groups * in_group])
    for _ in range(2):
        collection = []
        for _ in range(groups):
            key = np.zeros(len(full), np.uint64)
            for _ in range(in_group):
                # The shingles are spread evenly; an odd factor puts them into another order.
                least = np.minimum.reduceat((joined ^ next(seed)) * next(seed), starts)
                key = B.mixed(key + least)
            collection.append(key)
        both.append(np.stack(collection, axis=1))
    table = np.arange(groups * groups, dtype=np.uint64).reshape(1, groups, groups)
    first, second = both[0][:, :, None], both[1][:, None, :]
    keys = B.mixed(B.mixed(first + table) + second)
    return keys.reshape(len(full), groups * groups)


def _ids_of(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").to_numpy(zero_copy_only=False)


def candidate_leaders(blocks: B.Blocks, width: int, groups: int, in_group: int) -> DataFrame:
    """doc_id, block_id, n_shingles, leaders: the smallest ids in the cells that others share."""
    ranges = blocks.ranges

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sets = shingle_sets([t or "" for t in table.column("text").to_pylist()], width)
        sizes = np.array([len(s) for s in sets])
        return sizes, np.flatnonzero(sizes > 0), table_keys(sets, groups, in_group)

    def cells(table: pa.Table) -> tuple:
        sizes, full, keys = keys_of(table)
        flat = keys.ravel()
        order = np.argsort(flat, kind="stable")
        return sizes, full, keys, order, flat[order], B.equal_runs(flat[order])

    def questions(block_id: int, table: pa.Table) -> Iterator[tuple]:
        _, full, keys, order, ordered, new = cells(table)
        if not len(full):
            return
        owner = np.repeat(_ids_of(table)[full], keys.shape[1])[order]
        asked = np.empty(len(new), _CELL)
        asked["least"] = np.minimum.reduceat(owner, new)
        asked["several"] = asked["least"] < np.maximum.reduceat(owner, new)
        yield from B.question_rows(block_id, 0, ordered[new], asked, ranges)

    def reply(kind: int, keys: np.ndarray, payloads: list[bytes], asked: list[int]):
        cell = np.frombuffer(b"".join(payloads), _CELL)
        order = np.argsort(keys)
        new = B.equal_runs(keys[order])
        n = np.diff(new, append=len(keys))
        out = np.empty(len(keys), _LEADER)
        least = np.minimum.reduceat(cell["least"][order], new)
        shared = np.maximum.reduceat(cell["several"][order], new) > 0
        shared |= least < np.maximum.reduceat(cell["least"][order], new)
        out["leader"][order] = np.repeat(least, n)
        out["shared"][order] = np.repeat(shared, n)
        return B.cut_up(out, asked), 0, 0

    schema = "doc_id long, block_id long, n_shingles long, leaders array<long>"

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        sizes, full, keys, order, ordered, new = cells(table)
        ids = _ids_of(table)
        leaders: list[list[int]] = [[] for _ in ids]
        if len(full):
            told = B.told(replies, 0, _LEADER)
            cell = np.empty(len(order), np.int64)
            cell[order] = np.repeat(np.arange(len(new)), np.diff(new, append=len(order)))
            cell = cell.reshape(keys.shape)
            for row, i in enumerate(full.tolist()):
                mine = told[cell[row]]
                found = np.unique(mine["leader"][mine["shared"] > 0])
                leaders[i] = found[found != ids[i]].tolist()
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "block_id": table.column("block_id"),
                "n_shingles": pa.array(sizes, pa.int64()),
                "leaders": pa.array(leaders, pa.list_(pa.int64())),
            }
        )

    answers = kept_table(B.answer(B.ask(blocks, questions), reply), "leaders")
    members = kept_table(B.with_answers(blocks, answers, finish, schema), "members")
    discard(answers)
    return members


def confirmed(
    blocks: B.Blocks, members: DataFrame, pairs: DataFrame, width: int, above: int, of: int
) -> DataFrame:
    """Those pairs (a, b) with of * intersection >= above * union on the full sets.

    `pairs` has a, b and the block_id of a. The set of each b goes once to every block that has an a
    to compare with it.
    """
    places = members.select("doc_id", "block_id").distinct()
    needed = pairs.select(F.col("b").alias("doc_id")).distinct().join(places, "doc_id")

    def sets_of(table: pa.Table, wanted: pa.Table) -> pa.Table:
        ids = set(wanted.column("doc_id").to_pylist())
        mine = [
            (i, t or "")
            for i, t in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist())
            if i in ids
        ]
        sets = shingle_sets([t for _, t in mine], width)
        return pa.table(
            {
                "b": pa.array([i for i, _ in mine], pa.int64()),
                "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            }
        )

    sets = kept_table(
        blocks.rows.groupBy("block_id")
        .cogroup(needed.groupBy("block_id"))
        .applyInArrow(sets_of, "b long, shingles binary"),
        "sets",
    )
    sent = (
        pairs.groupBy("block_id", "b")
        .agg(F.collect_set("a").alias("others"))  # at most the documents of a block
        .join(sets, "b")
    )

    def compare(table: pa.Table, wanted: pa.Table) -> pa.Table:
        todo = list(zip(*(wanted.column(c).to_pylist() for c in ("b", "others", "shingles"))))
        ids = {a for _, others, _ in todo for a in others}
        mine: dict[int, list[str]] = {}
        for i, text in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()):
            if i in ids:
                mine.setdefault(i, []).append(text or "")
        flat = [(i, t) for i, texts in mine.items() for t in texts]
        own: dict[int, list[np.ndarray]] = {}
        for (i, _), s in zip(flat, shingle_sets([t for _, t in flat], width)):
            own.setdefault(i, []).append(s)
        found = []
        for b, others, raw in todo:
            theirs = np.frombuffer(raw, np.uint64)
            for a in others:
                for s in own.get(a, []):
                    both = len(np.intersect1d(s, theirs, assume_unique=True))
                    if both and of * both >= above * (len(s) + len(theirs) - both):
                        found.append((a, b))
        return B.as_table(found, "a long, b long")

    links = kept_table(
        blocks.rows.groupBy("block_id")
        .cogroup(sent.groupBy("block_id"))
        .applyInArrow(compare, "a long, b long"),
        "links",
    )
    discard(sets)
    return links


_OPEN, _OTHER = 1, 2


def met_leaders(members: DataFrame, found: DataFrame) -> DataFrame:
    """a, block_id, ca, b: each document with its component, and every leader that it met."""
    placed = members.select(F.col("doc_id").alias("a"), "block_id", "leaders").join(
        found.select(F.col("id").alias("a"), "component"), "a", "left"
    )
    component = F.coalesce("component", "a").alias("ca")
    return placed.select("a", "block_id", component, F.explode("leaders").alias("b"))


def apart(met: DataFrame, found: DataFrame) -> DataFrame:
    """ca, b: components with the leaders outside them that a document of theirs met.

    There are far fewer of them than of documents and leaders, as a large group is one component.
    """
    leaders = found.select(F.col("id").alias("b"), "component")
    placed = met.select("ca", "b").distinct().join(leaders, "b", "left")
    return kept_table(placed.filter(F.col("ca") != F.coalesce("component", "b")).select("ca", "b"), "apart")


def unresolved_pairs(
    blocks: B.Blocks, members: DataFrame, met: DataFrame, open_: DataFrame, width: int, above: int, of: int
) -> DataFrame:
    """Pairs (a, b) of different components that may be linked though no leader connects them, and
    the block_id of a.

    `met` has a, its component ca and each leader b that it met; `open_` the (ca, b) that are apart.
    The frequency of a shingle among the documents in question puts the shingles of each set in one
    order, rarest first. Sets of n and m shingles with the wanted similarity have
    above / (above + of) * (n + m) in common, so the first common one stands where at least as many
    are left in both; in the smaller set, that is among its first n - 2 * above / (above + of) * n.
    """
    ranges = blocks.ranges
    posting = "shingle long, id long, block_id long, component long, kind int, n long, place long"
    asked_of = met.join(open_.select("b").distinct(), "b", "left_semi").select("a", "ca").distinct()
    waiting = met.join(open_, ["ca", "b"], "left_semi").select("a", F.lit(_OPEN).alias("open")).distinct()
    state = asked_of.join(waiting, "a", "left")
    # One row for each document in question, in the form of an answer to its block.
    marks = kept_table(
        state.join(members.select(F.col("doc_id").alias("a"), "block_id").distinct(), "a").select(
            "block_id",
            F.coalesce("open", F.lit(_OTHER)).alias("kind"),
            F.lit(0).alias("part"),
            F.lit(None).cast("binary").alias("payload"),
            F.col("a").alias("total"),
            F.col("ca").alias("distinct"),
        ),
        "marks",
    )

    def sets_of(table: pa.Table, told: pa.Table) -> tuple[list[tuple], list[np.ndarray]]:
        columns = (told.column(c).to_pylist() for c in ("kind", "total", "distinct"))
        state = {i: (k, c) for k, i, c in zip(*columns) if k in (_OPEN, _OTHER)}
        mine = [
            ((i, *state[i]), t or "")
            for i, t in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist())
            if i in state
        ]
        return [m for m, _ in mine], shingle_sets([t for _, t in mine], width)

    def counted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)

    def questions(table: pa.Table, told: pa.Table) -> pa.Table:
        keys, n = counted(sets_of(table, told)[1])
        n = np.minimum(n, 0xFFFF).astype(np.uint16)
        block_id = table.column("block_id")[0].as_py() if table.num_rows else -1
        return B.as_table(list(B.question_rows(block_id, 0, keys, n, ranges)), B.QUESTION)

    def reply(kind: int, keys: np.ndarray, payloads: list[bytes], asked: list[int]):
        n = np.frombuffer(b"".join(payloads), np.uint16).astype(np.int64)
        order = np.argsort(keys)
        new = B.equal_runs(keys[order])
        out = np.empty(len(keys), np.uint16)
        total = np.minimum(np.add.reduceat(n[order], new), 0xFFFF)
        out[order] = np.repeat(total, np.diff(new, append=len(keys)))
        return B.cut_up(out, asked), 0, 0

    def rare(table: pa.Table, told: pa.Table) -> pa.Table:
        who, sets = sets_of(table, told)
        keys, _ = counted(sets)
        frequency = B.told(told, 0, np.uint16)
        block_id = table.column("block_id")[0].as_py() if table.num_rows else -1
        rows = []
        for (i, kind, component), found in zip(who, sets):
            n = len(found)
            often = frequency[np.searchsorted(keys, found)]
            front = np.lexsort((found, often))[: n - -(-above * n // of) + 1]
            for p in np.flatnonzero(often[front] > 1).tolist():
                shingle = int(found[front[p]].view(np.int64))
                rows.append((shingle, i, block_id, component, kind, n, p))
        return B.as_table(rows, posting)

    asked = B.with_answers(blocks, marks, questions, B.QUESTION)
    answers = kept_table(B.answer(asked, reply), "frequencies")
    postings = kept_table(
        B.with_answers(
            blocks,
            answers.unionByName(marks),
            rare,
            posting,
        ),
        "postings",
    )
    # Of two sets the smaller one, of equal ones that of the smaller id, is looked for near its front.
    columns = ("id", "block_id", "component", "kind", "n", "place")
    near = (above + of) * (F.col("n") - F.col("place")) >= 2 * above * F.col("n")
    smaller = postings.filter(near).select("shingle", *[F.col(c).alias(f"x_{c}") for c in columns])
    ordered = F.struct("x_n", "x_id") < F.struct("n", "id")
    one_open = (F.col("x_kind") == _OPEN) | (F.col("kind") == _OPEN)
    both_left = F.least(F.col("x_n") - F.col("x_place"), F.col("n") - F.col("place"))
    possible = (above + of) * both_left >= above * (F.col("x_n") + F.col("n"))
    rest = kept_table(
        smaller.join(postings, "shingle")
        .filter(ordered & one_open & (F.col("x_component") != F.col("component")) & possible)
        .select(
            F.greatest("x_id", "id").alias("a"),
            F.least("x_id", "id").alias("b"),
            F.when(F.col("x_id") > F.col("id"), F.col("x_block_id")).otherwise(F.col("block_id")).alias("block_id"),
        )
        .distinct(),
        "rest",
    )
    discard(marks, answers, postings)
    return rest


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    above: int = 80,
    of: int = 100,
    groups: int = GROUPS,
    in_group: int = IN_GROUP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    `docs` has doc_id and text. Documents are linked if of * intersection >= above * union of
    their sets of `width`-word shingles. Null and blank texts have no shingles and no links. A row
    with a null id has no links, a null component and is kept. Rows that share an id are one node,
    linked by any of their texts. Other columns are not returned, whatever their names. A very long
    text is a block of its own, whole, with some ten times its size in memory. No rows give no rows.
    """
    named = docs.select(F.col("doc_id").cast("long"), "text")
    blocks = B.make_blocks(named.filter("doc_id IS NOT NULL"), block_bytes)
    members = candidate_leaders(blocks, width, groups, in_group)
    first = members.filter("size(leaders) > 0").select(
        F.col("doc_id").alias("a"), F.array_min("leaders").alias("b"), "block_id"
    )
    links = confirmed(blocks, members, kept_table(first.distinct(), "pairs"), width, above, of)
    found = components(links)
    met = met_leaders(members, found)
    open_ = apart(met, found)
    if open_.limit(1).count():
        pairs = met.join(open_, ["ca", "b"], "left_semi").select("a", "b", "block_id").distinct()
        pairs = kept_table(pairs.join(first, ["a", "b", "block_id"], "left_anti"), "pairs")
        links = links.union(confirmed(blocks, members, pairs, width, above, of).select("a", "b"))
        found = components(links)
        met = met_leaders(members, found)
        open_ = apart(met, found)
        if open_.limit(1).count():
            rest = unresolved_pairs(blocks, members, met, open_, width, above, of)
            if rest.limit(1).count():
                links = links.union(confirmed(blocks, members, rest, width, above, of).select("a", "b"))
                found = components(links)
    out = members.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    unnamed = named.filter("doc_id IS NULL").mapInArrow(
        lambda batches: (
            pa.record_batch(
                {
                    "doc_id": b.column("doc_id"),
                    "n_shingles": pa.array(
                        [len(s) for s in shingle_sets([t or "" for t in b.column("text").to_pylist()], width)],
                        pa.int64(),
                    ),
                }
            )
            for b in batches
        ),
        "doc_id long, n_shingles long",
    )
    return out.unionByName(
        unnamed.select(
            "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
        )
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=3, above=85, of=100)
