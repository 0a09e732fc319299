"""Mixing sources to target weights by nested hash thresholds.

Tokens are summed by source and bucket of the document's hash. A source's budget falls into one
bucket: those below are taken whole, and only that one is cut into finer buckets, until the
threshold is a single hash value. Documents below it are taken by a filter; nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.common import WORD, documents, kept_table, positions

#: The hash has 60 bits and is cut in steps of 12.
HASH_BITS = 60
STEP_BITS = 12
#: Per-source rows up to this many are broadcast, more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mixing_hash(doc_id: str) -> Column:
    """60 bits of the MD5 of the id as text: the same in every run and every engine."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most_copies: int = 3
) -> DataFrame:
    """source, source_size, target: shares of the sum of all sizes.

    Sources in code point order, null last, take the weights in turn. A target stops at
    `most_copies` times its source's size; the excess is shared by weight among the others until
    none is above. With one level for all, a target is the smaller of weight * level and its stop;
    the level rises from round to round, and each round adds a few numbers up over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = positions(totals, "source").withColumnRenamed("source", "ranked")
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("position") % len(weights) + 1).cast("int"),
    )
    sources = kept_table(
        totals.join(ranked, F.col("source").eqNullSafe(F.col("ranked"))).select(
            "source",
            "source_size",
            (F.col("source_size") * float(most_copies)).alias("stop"),
            turn.alias("weight"),
        ),
        "sources",
    )
    level = 0.0
    while True:
        free = F.col("weight") * level <= F.col("stop")
        row = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).cast("double").alias("all"),
            F.coalesce(F.sum(F.when(~free, F.col("stop"))), F.lit(0.0)).alias("stopped"),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        risen = (row["all"] - row["stopped"]) / row["free"] if row["free"] else level
        if risen <= level:
            break
        level = risen
    target = F.least(F.col("weight") * level, F.col("stop"))
    return sources.select("source", "source_size", target.alias("target"))


def hash_thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, below: documents with a hash below it have about `budget` words together.

    `sizes` has source, size, hash; `budgets` has source, budget. The last value's documents are
    in if that comes nearer to the budget.
    """
    cut = budgets.select(
        F.col("source").alias("cut_source"),
        F.lit(0).cast("long").alias("prefix"),
        F.col("budget").alias("rest"),
    )
    for left in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = sizes.join(
            cut,
            F.col("source").eqNullSafe(F.col("cut_source"))
            & (F.shiftright("hash", left + STEP_BITS) == F.col("prefix")),
        )
        histogram = inside.groupBy(
            "cut_source", "rest", F.shiftright("hash", left).alias("bucket")
        ).agg(F.sum("size").alias("n"))
        # At most 2 ^ STEP_BITS rows a source stand in one window.
        cut = kept_table(
            sizes.sparkSession.sql(
                """
                SELECT cut_source, min_by(bucket, bucket) AS prefix,
                       min_by(rest - upto + n, bucket) AS rest, min_by(n, bucket) AS n
                FROM (
                    SELECT *, sum(n) OVER (PARTITION BY cut_source ORDER BY bucket) AS upto
                    FROM {histogram}
                )
                WHERE upto > rest GROUP BY cut_source
                """,
                histogram=histogram,
            ),
            "cut",
        )
    nearer = F.when(F.col("n") / 2 < F.col("rest"), 1).otherwise(0)
    return cut.select(F.col("cut_source").alias("source"), (F.col("prefix") + nearer).alias("below"))


def plan_mix(
    sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most_copies: int = 3
) -> DataFrame:
    """One row a source: source, source_size, target, copies, below.

    A document of the source is taken `copies` times, and once more if its hash is below `below`.
    """
    targets = kept_table(source_targets(sizes, weights, most_copies), "targets")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    planned = targets.withColumn("copies", F.coalesce(copies, F.lit(0)).cast("long"))
    budgets = planned.filter("source_size > 0 AND copies * source_size < target").select(
        "source", (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget")
    )
    below = hash_thresholds(sizes, budgets).withColumnRenamed("source", "cut_source")
    return kept_table(
        planned.join(below, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop(
            "cut_source"
        ),
        "mix",
    )


def mixed(sized: DataFrame, plan: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with source_size, target and taken; `sized` has source, size and hash."""
    small = plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    right = plan.withColumnRenamed("source", "plan_source")
    copies = F.col("copies") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    return sized.join(
        F.broadcast(right) if small else right,
        F.col("source").eqNullSafe(F.col("plan_source")),
    ).select(*columns, "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


NEW_COLUMNS = ("size", "source_size", "target", "taken", "hash", "copies", "below", "plan_source")


def with_sizes(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with size and hash, and the columns that came with them.

    Columns named as those that the operator works with are replaced.
    """
    names = [c for c in docs.columns if c.lower() not in NEW_COLUMNS]
    return docs.select(
        *names, word_count("text").alias("size"), mixing_hash("doc_id").alias("hash")
    ), names


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most_copies: int = 3
) -> DataFrame:
    """The documents with size, source_size, target and taken (words, repeats counted).

    `docs` has doc_id, text, source. A null or empty text has size 0 and takes nothing; sources
    without words have target 0; a null source is one of its own, after all others. Rows with one
    doc_id, repeated rows among them, are taken or left together. Columns of `docs` named as the new
    ones are replaced. Of a very long text only the number of its words is used; it is taken whole,
    so a source may miss its target by as much. No rows in, no rows out.
    """
    sized, names = with_sizes(docs)
    plan = plan_mix(kept_table(sized.select("source", "size", "hash"), "sizes"), weights, most_copies)
    return mixed(sized, plan, names)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: only sizes and hashes are kept on the way, not the texts."""
    sized, _ = with_sizes(documents(spark, sf_dir).select("doc_id", "source", "text"))
    sizes = kept_table(sized.select("doc_id", "source", "size", "hash"), "sizes")
    return mixed(sizes, plan_mix(sizes), ["doc_id"])


OP5_SQL = """
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::DOUBLE AS stop,
           ((row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
    FROM sized GROUP BY source
),
levels AS (
    SELECT weight, stop,
           ((SELECT sum(source_size)::DOUBLE FROM sources)
             - coalesce(sum(stop) OVER (ORDER BY stop / weight
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY stop / weight
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
),
targets AS (
    SELECT source, source_size,
           least(weight * (SELECT max(level) FROM levels WHERE weight * level <= stop), stop) AS target
    FROM sources
),
ordered AS (
    SELECT s.doc_id, s.size, s.hash, t.source_size, t.target,
           floor(t.target / t.source_size) AS copies,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto,
           sum(s.size) OVER (PARTITION BY s.source, s.hash) AS same
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, coalesce(target, 0.0) AS target,
       CASE WHEN source_size = 0 THEN 0 ELSE size * (copies::BIGINT
         + CASE WHEN upto - same / 2.0 < target - copies * source_size THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM ordered
"""
