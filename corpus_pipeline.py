"""The corpus pipeline: five stages over the documents, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to
the shared folder and read again as the next one's docs. Columns of the documents are passed on;
the last stage returns tokens.

Null ids, languages, sources and texts are kept like any other; a null text is an empty one to
every operator, so language ID rejects it. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.bpe import encode_decode
from kvloom.llm.common import documents, id_remainder, kept_table, plain_names
from kvloom.llm.language import identify, train_profiles
from kvloom.llm.minhash import near_duplicates
from kvloom.llm.mixing import mix_sources
from kvloom.llm.repeats import remove_repeats

#: A text of a tokenizer's vocabulary, in the folder of the public tokenizers.
VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some profile knows; those without a letter go, and those as far from every
    profile as can be: none of their n-grams is in any.

    The profiles are learned from the documents themselves, but for the third that the operator's
    query holds out. Without a labelled text among them there are none, and letters alone decide.
    Null and empty texts go, repeated rows stay, a very long text counts whole.
    """
    plain = plain_names(docs, ("doc_id", "text", "lang"))
    training = plain.filter(id_remainder("doc_id", 3) != 1)
    found = identify(plain, train_profiles(training), letterless=None)
    known = found.filter("lang_pred IS NOT NULL AND (score > 0 OR lang_pred = 'und')")
    return known.select(*plain.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: five words to a shingle, similarity 0.8.

    Rows are told apart by a key of their own, so rows that share an id or have none are compared
    like any others. The row with the smallest id stays, one with a null id only if none has an id.
    Rows without words are linked to nothing and stay.
    """
    plain = plain_names(docs, ("doc_id", "text"))
    # Written, so that a row has the same key whenever it is read.
    keyed = kept_table(plain.withColumn("row_key", F.monotonically_increasing_id()), "keyed")
    rows = keyed.select(F.col("row_key").alias("doc_id"), "text")
    found = near_duplicates(rows, width=5, above=80, of=100)
    order = F.struct(F.isnull("doc_id"), "doc_id", F.xxhash64("text"), "row_key")
    placed = keyed.join(found.select(F.col("doc_id").alias("row_key"), "component_id"), "row_key")
    first = placed.groupBy("component_id").agg(F.min(order)["row_key"].alias("row_key"))
    kept = keyed.join(first.select("row_key"), "row_key", "left_semi")
    return kept.select(*plain.columns).toDF(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes and more that an earlier document has, too.

    Documents of which nothing is left stay, with an empty text; mixing takes nothing of them. Rows of
    one id take nothing from each other, and a null id is later than all others.
    """
    plain = plain_names(docs, ("doc_id", "text", "n_chars"))
    return remove_repeats(plain, output="texts").toDF(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times.

    A null source is one of its own. Rows of one id, repeated ones too, are taken or left together.
    """
    plain = plain_names(docs, ("doc_id", "text", "source"))
    taken = mix_sources(plain)
    times = F.array_repeat(F.lit(0), (F.col("taken") / F.col("size")).cast("int"))
    copies = taken.filter("taken > 0").select(*plain.columns, F.explode(times).alias("copy"))
    return copies.select(*plain.columns).toDF(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them, for every row; null texts have no ids."""
    import public_tokenizers

    return encode_decode(docs, public_tokenizers.path(VOCABULARY), output="ids")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: Profiles, minhashes and byte-wise passages are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return docs
