"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return
the columns of ``documents``. Rows that a stage keeps are unchanged, but for texts that lose words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sabermill.llm.decontaminate import decontaminate
from sabermill.llm.near_duplicates import near_duplicates
from sabermill.llm.pieces import decode_documents, encode_documents
from sabermill.llm.quality import classify
from sabermill.llm.queries import PIECES
from sabermill.llm.substrings import remove_repeats
from sabermill.llm.tables import table
from sabermill.session import fresh_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    scored = classify(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id.

    What is judged by id and text is dropped by both, as rows may share an id.
    """
    dropped = near_duplicates(docs).where("not kept").select("doc_id", "text_md5").distinct()
    text_md5 = F.md5(F.col("text"))
    return docs.withColumn("text_md5", text_md5).join(dropped, ["doc_id", "text_md5"], "left_anti").select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words in passages that also start earlier; a text may become empty."""
    done = remove_repeats(docs)
    changed = F.col("n_removed") > 0
    return done.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not contaminated").select(docs.columns)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    done = decode_documents(encode_documents(docs, PIECES), PIECES)
    given = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    return done.select("doc_id", "lang", "source", "n_pieces", "piece_ids", (F.col("decoded") == given).alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("substrings", without_repeats),
    ("decontamination", without_benchmark),
    ("pieces", as_pieces),
]

# The classifier, the sketches and the encoding can't be expressed in SQL; tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = fresh_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
