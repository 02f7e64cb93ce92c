"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept.  Stages but the last return the columns of documents.  Where
nulls, repeated rows and empty tables lead is told at each stage; a table
without rows passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontaminate, language, minhash, packing, suffix_dedup
from weftline.llm.tables import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: share of the leading language from which a document is kept
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a predicted language that makes up half of them at least.

    Null texts and texts without a letter go; null doc_ids and repeated rows
    are judged row by row.  Languages are learned from rows that have a lang; if
    none has, nothing can be told and every text with a letter would be lost,
    so then only texts without one go.  An empty table stays empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang", "source", "n_chars")
    names, logs = language.train(rows.filter(language.remainder("doc_id", 5) != 0))
    if not names:
        return rows.filter(F.col("text").rlike(r"\p{L}"))
    said = language.predict(rows, names, logs, COLUMNS)
    return said.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each group of near duplicates (five words, similarity 0.8).

    Documents without words (null and empty texts too) or without a doc_id are
    in no group and stay; repeated rows of one doc_id stay as they come.  An
    empty table stays empty.
    """
    found = minhash.near_duplicates(docs, percent=80)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out byte strings of 50 or more that an earlier document has; documents with nothing left go.

    The rest of a character cut in two goes with it.  n_chars is counted anew.
    Null texts have nothing left and go.  A row with a null doc_id is compared
    with nothing and stays whole; rows of one doc_id are not compared with each
    other.  An empty table stays empty.
    """
    left = suffix_dedup.suffix_dedup(docs, with_text=True, carry=("lang", "source"))
    return left.filter(F.length(F.trim("text")) > 0).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents with a window of ten words of a benchmark item, or all words of a shorter one.

    Null and empty texts have no words and stay; null doc_ids and repeated rows
    are judged row by row.  An empty table stays empty; without items all stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark, width=10, carry=("text", "lang", "source", "n_chars"))
    return found.filter(~F.col("contaminated")).select(*COLUMNS)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens.

    A null or empty text is its end token alone.  Every row is packed, also one
    without a doc_id or one that repeats another.  An empty table gives no rows.
    """
    return packing.pack_documents(docs, "byte_bpe_50k.json", capacity=2048, end_id=0)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("decontamination", decontamination), ("best_fit_packing", best_fit)]
#: language mixtures and packing are beyond SQL: tests hold the pipeline against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
