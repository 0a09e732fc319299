"""Near-duplicate vectors by NN-descent.

A neighbour graph holds for each vector its K most similar ones so far. It starts from orders of
the vectors by the signs of random projections: those that stand close to each other in an order
are compared in blocks of fixed size. Then neighbours of neighbours are compared: at each vector
its own neighbours and a sample of those that have it as theirs meet, until few lists change.

Pairs at or above the threshold are links, and what they connect are components. A list that holds
nothing but links is saturated and may lack others. So lists are enlarged: the descent goes on from
new orders with lists of vectors outside the own component, as long as lists are saturated.

Then recall is audited: the vectors with a row whose id is divisible by 50 are compared with all
vectors. If they have enough links to tell and none leads out of a component, the graph is taken.
If some do, they are kept and the descent is repeated. Where the audit still falls short, or has too
few links to prove anything, all vectors are compared with each other, part by part, for links that
join components. Within a component links are counted exactly: its members are dealt into chunks,
and every two chunks are compared in a task of their own, which returns counts, not pairs.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kvloom.llm.common import kept_table, shuffle_partitions
from kvloom.llm.graph import components

#: Neighbours in a list, orders to begin with, vectors compared side by side, sign bits.
NEIGHBOURS, ORDERS, BLOCK, SIGNS = 10, 8, 256, 24
#: New pairs that a vector passes on for each of its neighbours.
PASSED_ON = 4
#: Steps of a descent, and the share of changed list entries at which it ends early.
STEPS, CHANGED = 4, 0.01
#: Vectors in a chunk of a component.
CHUNK = 500
#: Parts of all vectors, as many as keep the tasks busy; more if one would have more bytes.
PARTS, PART_BYTES = 12, 8_000_000
#: Descents before all vectors are compared; ids of the audit's queries are divisible by this.
DESCENTS, EVERY = 3, 50
#: Links that an audit needs: with none of so many missed, recall is above 0.99 at a level of 0.95.
PROVEN = 300

log = logging.getLogger(__name__)


def scaled(a: np.ndarray) -> np.ndarray:
    """Rows in double precision, each times a power of two, so that no square is too large or small."""
    a = a.astype(np.float64)
    largest = np.abs(a).max(axis=1, keepdims=True, initial=0)
    return np.ldexp(a, -np.frexp(largest)[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All cosines between the rows of two arrays, in double precision."""
    a, b = scaled(a), scaled(b)
    return (a @ b.T) / np.outer(np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1)))


def _array(column: pa.ChunkedArray | pa.Array, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec (bytes), dim; without vectors that are null, zero or not finite."""
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    bad = F.exists(
        "embedding", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True))
    )
    good = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(
        ~bad & F.exists("embedding", lambda x: x != 0)
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.diff(lists.offsets.to_numpy())
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            raw += 0.0  # one form of zero, so that equal vectors have equal bytes
            raw, width = raw.tobytes(), np.dtype(kind).itemsize
            ends = np.cumsum(sizes * width).tolist()
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id"),
                    "vec": pa.array([raw[a:b] for a, b in zip([0, *ends], ends)], pa.binary()),
                    "dim": pa.array(sizes, pa.int32()),
                }
            )

    return good.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(
        pack, "vec_id long, vec binary, dim int"
    )


def top_lists(pairs: DataFrame, k: int) -> DataFrame:
    """The k most similar partners w of each u, equal ones by id."""
    rank = F.row_number().over(W.partitionBy("u").orderBy(F.desc("sim"), "w"))
    once = pairs.groupBy("u", "w").agg(F.max("sim").alias("sim"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def _best(
    sims: np.ndarray, ids: np.ndarray, labels: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """u, w and similarity of the k best columns of each row, of those with another label."""
    sims[labels[:, None] == labels[None, :]] = -2
    k = min(k, len(ids) - 1)
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), int)
    rows, best = np.repeat(np.arange(len(ids)), k), best.ravel()
    other = sims[rows, best] > -1.5
    rows, best = rows[other], best[other]
    return ids[rows], ids[best], sims[rows, best]


def _edges(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, w, sim = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, int),) * 3
    return pa.record_batch(
        {"u": pa.array(u, pa.int64()), "w": pa.array(w, pa.int64()), "sim": pa.array(sim, pa.float64())}
    )


_EDGE = "u long, w long, sim double"


def by_orders(nodes: DataFrame, kind: str, dim: int, seeds: list[int], k: int) -> DataFrame:
    """Pairs found by comparing neighbours in orders by the signs of random projections."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = scaled(_array(batch.column("vec"), kind, dim))
            data /= np.sqrt((data * data).sum(1))[:, None]
            for seed in seeds:
                values = data @ np.random.default_rng(seed).standard_normal((dim, SIGNS + 1))
                place = (values[:, :SIGNS] > 0) @ (1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))
                fine = ((np.tanh(values[:, SIGNS]) + 1) * 2**30).astype(np.int64)
                yield pa.record_batch(
                    {
                        "seed": pa.array([seed] * len(data), pa.int32()),
                        "place": pa.array((place << 32) | fine, pa.int64()),
                        "id": batch.column("id"),
                        "label": batch.column("label"),
                        "vec": batch.column("vec"),
                    }
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[tuple]) -> tuple:
            ids, labels = (np.array([r[c] for r in rows], np.int64) for c in (1, 2))
            data = np.frombuffer(b"".join(r[3] for r in rows), kind).reshape(-1, dim)
            return _best(cosines(data, data), ids, labels, k)

        held: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("seed", "id", "label", "vec"))):
                if held and (len(held) == BLOCK or held[0][0] != row[0]):
                    out.append(found(held))
                    held = []
                held.append(row)
            yield _edges(out)
        if held:
            yield _edges([found(held)])

    fields = "seed int, place long, id long, label long, vec binary"
    rows = nodes.select("id", "label", "vec").mapInArrow(project, fields)
    ordered = rows.repartitionByRange(
        shuffle_partitions(nodes.sparkSession), "seed", "place", "id"
    ).sortWithinPartitions("seed", "place", "id")
    return ordered.mapInArrow(compare, _EDGE)


def by_neighbours(nodes: DataFrame, graph: DataFrame, kind: str, dim: int, k: int, step: int) -> DataFrame:
    """Pairs found by comparing the neighbours of each vector, in both directions."""
    back = F.row_number().over(W.partitionBy("v").orderBy(F.xxhash64("u", F.lit(step)), "u"))
    reverse = graph.select(F.col("w").alias("v"), "u").withColumn("rank", back)
    around = (
        graph.select(F.col("u").alias("v"), F.col("w").alias("u"))
        .union(reverse.filter(F.col("rank") <= k).select("v", "u"))
        .distinct()
    )
    met = (
        around.join(nodes.select(F.col("id").alias("u"), "label", "vec"), "u")
        .groupBy("v")
        .agg(F.collect_list(F.struct("u", "label", "vec")).alias("near"))  # at most 2 k
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("near")
            flat = near.flatten()
            ids, labels = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("u", "label"))
            data = _array(flat.field("vec"), kind, dim)
            ends = np.cumsum(np.diff(near.offsets.to_numpy())).tolist()
            out = [
                _best(cosines(data[a:b], data[a:b]), ids[a:b], labels[a:b], PASSED_ON)
                for a, b in zip([0, *ends], ends)
                if b - a > 1
            ]
            yield _edges(out)

    return met.select("near").mapInArrow(compare, _EDGE)


def link_counts(
    nodes: DataFrame, members: DataFrame, kind: str, dim: int, threshold: float
) -> DataFrame:
    """id, links (other vectors linked, copies counted).

    `members` has id and component for the nodes of components of two and more.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    dealt = (
        members.join(sizes, "component")
        .withColumn("chunks", F.ceil(F.col("size") / CHUNK))
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
        .join(nodes, "id")
        .select(
            "component", "id", "vec", "copies", "chunk", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("other")
        )
        .select(
            "component",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            "chunk",
            "id",
            "vec",
            "copies",
        )
    )

    def count(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        chunk = table.column("chunk").to_numpy()
        ids = table.column("id").to_numpy()
        copies = table.column("copies").to_numpy()
        data = _array(table.column("vec"), kind, dim)
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        near = cosines(data[left], data[right]) >= threshold
        if i == j:
            np.fill_diagonal(near, False)
            out = [(left, near @ copies[right])]
        else:
            out = [(left, near @ copies[right]), (right, copies[left] @ near)]
        return pa.table(
            {
                "id": pa.array(np.concatenate([ids[rows] for rows, _ in out]), pa.int64()),
                "links": pa.array(np.concatenate([n for _, n in out]), pa.int64()),
            }
        )

    counted = dealt.groupBy("component", "i", "j").applyInArrow(count, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


class Forest:
    """Which of some labels hang together, and edges that say so: fewer than there are labels."""

    def __init__(self, labels: np.ndarray):
        self.names, self.at = np.unique(labels, return_inverse=True)
        self.root = np.arange(len(self.names))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = [(self.names[:0], self.names[:0])]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the label at each place of `a` with the one at the same place of `b`."""
        a, b = self.at[a], self.at[b]
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            high, first = np.unique(np.maximum(x, y)[apart], return_index=True)
            low = np.minimum(x, y)[apart][first]
            self.edges.append((self.names[high], self.names[low]))
            self.root[high] = low
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def joined(
    nodes: DataFrame,
    members: DataFrame,
    kind: str,
    dim: int,
    threshold: float,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """a, b: components that a link joins, or vectors that are in none; enough to connect all.

    Every vector is compared with every other one. They are dealt into parts, and every two parts
    meet in a task of their own, which returns fewer edges than it has components.
    """
    n = nodes.count()
    parts = max(min(PARTS, -(-n // (2 * CHUNK))), -(-n * dim * np.dtype(kind).itemsize // part_bytes), 1)
    dealt = (
        nodes.select("id", "vec")
        .join(members, "id", "left")
        .select(
            "id",
            F.coalesce("component", "id").alias("component"),
            "vec",
            F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("other"),
        )
        .select(
            F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "component", "vec"
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        part = table.column("part").to_numpy()
        forest = Forest(table.column("component").to_numpy())
        data = _array(table.column("vec"), kind, dim)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        for a in range(0, len(left), CHUNK):
            some = left[a : a + CHUNK]
            for b in range(a if i == j else 0, len(right), CHUNK):
                others = right[b : b + CHUNK]
                rows, columns = np.nonzero(cosines(data[some], data[others]) >= threshold)
                forest.join(some[rows], others[columns])
        a, b = (np.concatenate(ends) for ends in zip(*forest.edges))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("i", "j").applyInArrow(compare, "a long, b long")


def labelled(nodes: DataFrame, members: DataFrame | None) -> DataFrame:
    """The nodes with the component that each is in, or its id, as label."""
    if members is None:
        return nodes.withColumn("label", F.col("id"))
    placed = nodes.join(members, "id", "left")
    return placed.withColumn("label", F.coalesce("component", "id")).drop("component")


def audit(
    nodes: DataFrame, kind: str, dim: int, threshold: float, part_bytes: int = PART_BYTES
) -> tuple[int, int, DataFrame]:
    """Links of the queries among all vectors, how many lead to another label, and edges a, b for those.

    Queries and vectors are dealt into parts, and every two parts meet in a task of their own.
    """
    size = dim * np.dtype(kind).itemsize
    n, asking = nodes.agg(F.count(F.lit(1)), F.count_if("query")).first()
    n_asking = max(-(-asking * size // part_bytes), 1)
    parts = max(min(PARTS, -(-n // (2 * CHUNK))), -(-n * size // part_bytes), 1)

    def dealt(rows: DataFrame, mine: str, n_mine: int, other: str, n_other: int, asks: bool) -> DataFrame:
        return rows.select(
            F.pmod(F.xxhash64("id"), F.lit(n_mine)).alias(mine),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other),
            F.lit(asks).alias("asks"),
            "id",
            "label",
            "vec",
        )

    both = dealt(nodes.filter("query"), "i", n_asking, "j", parts, True).unionByName(
        dealt(nodes, "j", parts, "i", n_asking, False)
    )

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        data = _array(table.column("vec"), kind, dim)
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        forest = Forest(labels)
        links = missed = 0
        for a in range(0, len(left), CHUNK):
            for b in range(0, len(right), CHUNK):
                some, others = left[a : a + CHUNK], right[b : b + CHUNK]
                rows, columns = np.nonzero(cosines(data[some], data[others]) >= threshold)
                rows, columns = some[rows], others[columns]
                apart = labels[rows] != labels[columns]
                links += int((ids[rows] != ids[columns]).sum())
                missed += int(apart.sum())
                forest.join(rows[apart], columns[apart])
        a, b = (np.concatenate(ends) for ends in zip(*forest.edges))
        counts = [pa.array([None] * len(a) + [n], pa.int64()) for n in (links, missed)]
        ends = [pa.array([*x.tolist(), None], pa.int64()) for x in (a, b)]
        return pa.table([*ends, *counts], names=["a", "b", "links", "missed"])

    fields = "a long, b long, links long, missed long"
    found = kept_table(both.groupBy("i", "j").applyInArrow(compare, fields), "audit")
    totals = found.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("links", "missed")]).first()
    return totals[0], totals[1], found.filter("a IS NOT NULL").select("a", "b")


def descent(nodes: DataFrame, kind: str, dim: int, k: int, seeds: list[int]) -> DataFrame:
    """Lists u, w, sim of the k most similar vectors of other labels, as far as the descent finds them."""
    n = nodes.count()
    graph = kept_table(top_lists(by_orders(nodes, kind, dim, seeds, k), k), "graph")
    for step in range(STEPS):
        pairs = by_neighbours(nodes, graph, kind, dim, k, step)
        better = kept_table(top_lists(graph.union(pairs), k), "graph")
        changed = better.join(graph.select("u", "w"), ["u", "w"], "left_anti").count()
        graph = better
        if changed <= CHANGED * n * k:
            break
    return graph


def _linked(nodes: DataFrame, kind: str, dim: int, threshold: float, k: int) -> DataFrame:
    """id, links, component for the nodes of one dimension that have links."""
    links = members = None
    proven = False
    for number in range(DESCENTS):
        seeds = list(range(number * ORDERS, (number + 1) * ORDERS))
        graph = descent(labelled(nodes, members), kind, dim, k, seeds)
        near = graph.filter(F.col("sim") >= threshold)
        saturated = near.groupBy("u").count().filter(F.col("count") >= k).limit(1).count()
        found = near.select(F.col("u").alias("a"), F.col("w").alias("b"))
        links = found if links is None else links.union(found)
        members = components(links)
        audited, missed, more = audit(labelled(nodes, members), kind, dim, threshold)
        log.info("descent %d: %d of %d audited links lead out of a component", number, missed, audited)
        if missed:
            links = links.union(more)
            members = components(links)
        proven = audited >= PROVEN and not missed and not saturated
        if proven or audited < PROVEN:
            break
    if not proven:
        links = links.union(joined(nodes, members, kind, dim, threshold))
        members = components(links)
    return link_counts(nodes, members, kind, dim, threshold).join(members, "id").select("id", "links", "component")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, k: int = NEIGHBOURS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    `vectors` has vec_id and embedding (array of float or double). Vectors that are null, empty or
    zero or have a null or non-finite component have no links; nor do vectors of different length
    to each other, or rows with a null vec_id (null component, kept). Equal vectors are linked;
    rows of one vec_id must be equal. Components of any size are compared as if they were near one.
    Other columns are not returned, whatever their names; no rows in, no rows out.
    """
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = kept_table(usable(vectors), "vectors")
    nodes = kept_table(
        rows.groupBy("vec", "dim").agg(
            F.min("vec_id").alias("id"),
            F.count(F.lit(1)).cast("long").alias("copies"),
            F.max(F.pmod("vec_id", F.lit(EVERY)) == 0).alias("query"),
        ),
        "nodes",
    )
    linked = None
    for row in nodes.select("dim").distinct().orderBy("dim").collect():
        part = nodes.filter(F.col("dim") == row["dim"]).drop("dim")
        found = _linked(part, kind, row["dim"], threshold, k)
        linked = found if linked is None else linked.union(found)
    states = nodes.select("vec", "id", "copies")
    if linked is None:
        states = states.withColumn("links", F.lit(0)).withColumn("component", F.col("id"))
    else:
        states = states.join(linked, "id", "left")
    placed = rows.join(states, "vec").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    others = vectors.select(F.col("vec_id").cast("long")).join(
        rows.select("vec_id").distinct(), "vec_id", "left_anti"
    )
    alone = others.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
