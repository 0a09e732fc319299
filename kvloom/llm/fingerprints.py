"""Document fingerprints by consistent weighted sampling.

A document is its words with their counts as weights. For each sample every term draws
r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its own hash; with t = floor(ln(weight) / r + b) and
y = exp(r (t - b)) the term with the smallest c / (y exp(r)) is the sample, together with t. Two
documents have equal samples with the probability of their generalised Jaccard similarity, the sum
of the smaller weights over the sum of the larger ones.

All of it is DataFrame expressions: a text is exploded into words, words are added up per
document, and each sample is the minimum of a number that holds ln(c / (y exp(r))) above the
bits that name the term and t. A document's rows never leave the partition of its range of ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kvloom.llm.common import documents, kept_table, shuffle_partitions

#: Samples in a fingerprint.
SAMPLES = 64
#: Samples drawn from one row. Many more make generated code too long to be compiled well.
AT_ONCE = 4
#: Ranges of ids for each shuffle partition.
RANGES = 8
_ID_BITS = 31
_ID_MASK = (1 << _ID_BITS) - 1


def _uniform(hashed: Column, shift: int) -> Column:
    """21 of the bits of a hash as a number above 0 and below 1."""
    bits = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << 21) - 1).cast("long"))
    return (bits.cast("double") + 0.5) * F.lit(2.0**-21)


def sample_value(term: Column, log_weight: Column, step: Column, sample: int) -> Column:
    """The number whose minimum over the terms is the sample; null where log_weight is.

    Its low 31 bits name the term and t.
    """
    x, y = (F.xxhash64(term, step, F.lit(2 * sample + i)) for i in (0, 1))
    r = -F.log(_uniform(x, 0) * _uniform(x, 21))
    log_c = F.log(-F.log(_uniform(y, 0) * _uniform(y, 21)))
    b = _uniform(x, 42)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    scaled = F.floor((log_a + 256.0) * float(1 << 23)).cast("long")
    name = F.shiftrightunsigned(term, 64 - _ID_BITS).bitwiseXOR(t.bitwiseAND(F.lit(_ID_MASK)))
    return F.shiftleft(scaled, _ID_BITS).bitwiseOR(name)


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at or below the id, by halving."""
    if not bounds:
        return F.lit(0)
    listed = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(listed, at + step - 1) <= doc_id, at + step).otherwise(at),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, place (range, row) and the text and place of the next document.

    The order is descending by id, null ids last, equal ids by text; the first follows the last.
    Ranges of ids are numbered each on its own. The first document of a range goes to the end of
    the range before it as well, so that nothing has to look over all documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n = RANGES * shuffle_partitions(spark)
    probabilities = [i / n for i in range(1, n)]
    found = rows.agg(F.percentile_approx("doc_id", probabilities, max(10_000, 10 * n)).alias("b")).first()
    bounds = sorted(set(found["b"] or []))
    ranged = rows.withColumn("range", _range_of(F.col("doc_id"), bounds))
    tops = ranged.groupBy("range").agg(F.max("doc_id").alias("top"))
    # One row a range: few enough to be ordered in one place and sent to all.
    down = W.orderBy(F.desc("range"))
    tops = tops.select(
        F.col("range").alias("from_range"),
        "top",
        F.coalesce(F.lag("range").over(down), F.first("range").over(W.orderBy("range"))).alias("to_range"),
    )
    copied = ranged.join(
        F.broadcast(tops),
        (F.col("range") == F.col("from_range")) & F.col("doc_id").eqNullSafe(F.col("top")),
        "left",
    ).select(
        "doc_id",
        "text",
        F.col("range").alias("home"),
        F.posexplode(
            F.when(F.col("to_range").isNull(), F.array("range")).otherwise(F.array("range", "to_range"))
        ).alias("copy", "range"),
    )
    order = W.partitionBy("range").orderBy("copy", F.desc_nulls_last("doc_id"), "text")
    follows_copy = F.lead("copy").over(order) == 1
    return (
        copied.repartition("range")
        .select(
            "range",
            "copy",
            "doc_id",
            "text",
            F.row_number().over(order).alias("row"),
            F.lead("text").over(order).alias("next_text"),
            F.when(follows_copy, F.lead("home").over(order)).otherwise(F.col("range")).alias("next_range"),
            F.when(follows_copy, F.lit(1)).otherwise(F.row_number().over(order) + 1).alias("next_row"),
        )
        .filter("copy = 0")
        .drop("copy")
    )


def fingerprints(
    rows: DataFrame, keys: list[str], texts: list[str], samples: int = SAMPLES
) -> DataFrame:
    """keys, and for each column of texts the array of its samples (`<name>_samples`).

    A text without words has an array of nulls. `keys` tell the rows apart; if the rows are
    partitioned by some of them, nothing is shuffled.
    """
    words = [F.split(F.lower(F.col(t)), r"[\x20\x09-\x0D]+") for t in texts]
    counted = (
        rows.select(*keys, F.posexplode(F.array(*words)).alias("which", "words"))
        .select(*keys, "which", F.explode("words").alias("word"))
        .select(*keys, "which", F.xxhash64("word").alias("term"), (F.col("word") != "").alias("full"))
        .groupBy(*keys, "term")
        .agg(
            *[
                F.sum(F.when(F.col("full") & (F.col("which") == i), 1).otherwise(0)).alias(f"n{i}")
                for i in range(len(texts))
            ]
        )
        .select(
            *keys,
            "term",
            *[
                F.when(F.col(f"n{i}") > 0, F.log(F.col(f"n{i}").cast("double"))).alias(f"w{i}")
                for i in range(len(texts))
            ],
        )
    )
    steps = F.array(*[F.lit(i) for i in range(-(-samples // AT_ONCE))])
    drawn = (
        counted.select("*", F.explode(steps).alias("step"))
        .groupBy(*keys, "step")
        .agg(
            *[
                F.min(sample_value(F.col("term"), F.col(f"w{i}"), F.col("step"), k)).alias(f"s{i}_{k}")
                for k in range(AT_ONCE)
                for i in range(len(texts))
            ]
        )
    )
    named = [
        F.array(
            *[
                F.col(f"s{i}_{k}").bitwiseAND(F.lit(_ID_MASK).cast("long")).cast("int")
                for k in range(AT_ONCE)
            ]
        ).alias(f"a{i}")
        for i in range(len(texts))
    ]
    joined = drawn.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("step", *named))).alias("all"))
    return joined.select(
        *keys,
        *[
            F.slice(F.flatten(F.col(f"all.a{i}")), 1, samples).alias(f"{t}_samples")
            for i, t in enumerate(texts)
        ],
    )


def likeness(a: str, b: str) -> Column:
    """The share of equal samples; two texts without words are alike."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.size(a)


def as_text(samples: str) -> Column:
    """Eight hexadecimal digits a sample; empty without words."""
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and likenesses.

    `docs` has doc_id and text. Returned: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. A null text is an empty one. A text without words
    has an empty fingerprint, like only to another such. The next document is the one of the next
    smaller id, after the last the first; equal ids go by text, null ids come last. Repeated rows
    stay, other columns are not returned, whatever their names; no rows in, no rows out. A very long
    text is one row like any other: its words are spread over rows and added up before they meet.
    """
    rows = with_next(docs)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third)
    )
    keys = ["range", "row", "next_range", "next_row", "doc_id", "n_chars", "digest"]
    edits = rows.withColumn("edited", edited).select(
        *keys[:5],
        "text",
        "edited",
        n.cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("digest"),
    )
    table = kept_table(fingerprints(edits, keys, ["text", "edited"], samples), "fingerprints")
    following = table.select(
        F.col("range").alias("next_range"),
        F.col("row").alias("next_row"),
        F.col("text_samples").alias("next_samples"),
    )
    return table.join(following, ["next_range", "next_row"]).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("digest")).alias("edited_sha256"),
        as_text("text_samples").alias("fingerprint"),
        as_text("edited_samples").alias("edited_fingerprint"),
        likeness("text_samples", "edited_samples").alias("near_edited"),
        likeness("text_samples", "next_samples").alias("near_next"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))
