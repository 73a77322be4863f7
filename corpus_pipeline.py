"""The corpus pipeline: quality, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; the rows between stages have the columns of ``documents``, and more columns
of docs are left out.  No stage fails on nulls in any column, on empty or very
long texts, on repeated rows or keys, or on a table without rows, which gives one
without rows; what each makes of them its docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm import language_id, ngram_join, packing, quality, substring_dedup
from foliomill.llm.queries import tokenizer_path
from foliomill.session import bound_arrow_batches, cut, read_table, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near duplicates share this much of their sets of five-word shingles.
SHINGLE_WORDS, SHARED, OF = 5, 4, 5


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking puts at or above its threshold.

    Null and empty texts are scored like others, equal texts alike; without
    labels of both kinds the share of good ones decides for all.
    """
    bound_arrow_batches(spark)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), learn=F.lit(True))
    return quality.keep_good(docs.select(*COLUMNS), model)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filters recognise.

    Null and empty texts and texts without letters go; null languages teach nothing.
    """
    bound_arrow_batches(spark)
    model = language_id.fit(docs)
    return language_id.keep_known(docs.select(*COLUMNS), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of near duplicates.

    Texts without words and null keys are in no group and stay; of rows equal in
    key and text one stays.
    """
    bound_arrow_batches(spark)
    return ngram_join.keep_first(docs.select(*COLUMNS), SHINGLE_WORDS, SHARED, OF)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of sentences that stand elsewhere before; texts of repeats alone go.

    Null and empty texts stay.  n_chars is counted anew.
    """
    bound_arrow_batches(spark)
    cleaned = substring_dedup.remove_repeats(docs.select(*COLUMNS))
    left = cleaned.where(~((F.col("removed_units") > 0) & (F.trim("text") == "")))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens; null and empty texts have the end id alone."""
    bound_arrow_batches(spark)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("language id", keep_known_language),
    ("n-gram jaccard join", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: Models and tokenizers aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"), stays=True)
    return STAGES[-1][1](spark, docs, sf_dir)
