"""A corpus pipeline: documents to token ids in five stages, each by one of the training-data operators.

Each stage works on all rows that the one before kept, and all but the last return the columns of documents. ORACLE_SQL
is None: SQL cannot express the learned model, the hash-ordered mix or the encoding; tests hold the stages against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumenframe.llm.common import written
from lumenframe.llm.jaccard_join import keep_one_of_each
from lumenframe.llm.piece_codec import PieceModel, encode_pieces
from lumenframe.llm.quality_gam import score_quality, train_quality
from lumenframe.llm.queries import PIECES
from lumenframe.llm.source_mix import mixed_documents
from lumenframe.llm.suffix_dedup import suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels, does not reject (score of 0.3 or more)."""
    model = train_quality(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, threshold=0.3).filter("predicted = 1").select(*COLUMNS)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least id, of each group linked by a shingle similarity of 0.75 or more."""
    return keep_one_of_each(docs).select(*COLUMNS)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes covered by 100-byte strings that start earlier in the corpus. Characters that lose
    some of their bytes go; n_chars is that of the remaining text."""
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    cut = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", ""))
    out = suffix_dedup(docs, length=100, with_kept=True, carry=("lang", "source"))
    return out.withColumn("text", cut).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents' token ids, with n_tokens and whether decoding gives the text back."""
    return encode_pieces(docs, PieceModel.load(PIECES)).select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_near_duplicates),
    ("suffix-array dedup", without_repeated_strings),
    ("mixing sources", mixed),
    ("SentencePiece encoding", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage{i + 1}")
    return docs
