"""Listing and search modes. A limit of less than one still gives one row, as the format's query tool does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import contains_ci
from ..sources.catalog import SEMANTIC, SUPPORT


def limited(df: DataFrame, order: list, limit: int | None) -> DataFrame:
    """The first rows by a total order; a top-k in the plan, not a full sort."""
    return df if limit is None else df.orderBy(*order).limit(max(limit, 1))


def find_text(df: DataFrame, columns: list[str], text: str, order: list, limit: int | None = 100) -> DataFrame:
    """Rows in which any of the columns contains the text, A-Z and a-z alike; an empty text matches all."""
    hit = F.lit(text == "")
    for c in columns:
        hit = hit | contains_ci(F.col(c), text)
    return limited(df.filter(hit), order, limit)


def find_words(words: DataFrame, text: str, limit: int | None = 100) -> DataFrame:
    return find_text(words, ["text", "normalized_text"], text, ["line_no"], limit)


def list_ocr_observations(obs: DataFrame, text: str | None = None, limit: int | None = 100) -> DataFrame:
    return find_text(obs, ["raw_text", "normalized_text"], text or "", ["line_no"], limit)


def count_left(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """left with the number of right's rows of its key; right is counted before it is joined."""
    return left.join(right.groupBy(key).agg(F.count("*").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def list_speakers(speakers: DataFrame, words: DataFrame) -> DataFrame:
    """Speakers (speaker_id, ...) with word_count."""
    return count_left(speakers, words, "speaker_id", "word_count")


def list_color_observations(obs: DataFrame, bucket: str | None = None, min_coverage: float | None = None, limit: int | None = 100) -> DataFrame:
    """By a part of the dominant bucket's name and its coverage at least; rows without that coverage stay."""
    df = obs.withColumn("dominant_coverage", F.when(F.col("dominant_bucket") != "", F.try_element_at("bucket_coverage", F.col("dominant_bucket"))))
    if bucket:
        df = df.filter(contains_ci(F.col("dominant_bucket"), bucket))
    if min_coverage is not None and min_coverage >= 0:
        df = df.filter(F.col("dominant_coverage").isNull() | (F.col("dominant_coverage") >= min_coverage))
    return limited(df, ["line_no"], limit)


def relationship_class(kind: Column) -> Column:
    return F.when(kind.isin(*SUPPORT), "support").when(kind.isin(*SEMANTIC), "semantic").otherwise("unknown")


def list_relationships(edges: DataFrame, of_class: str | None = None, limit: int | None = 100) -> DataFrame:
    df = edges.withColumn("relationship_class", relationship_class(F.col("type")))
    if of_class and of_class != "all":
        df = df.filter(F.col("relationship_class") == of_class)
    return limited(df, ["line_no"], limit)


def relationship_summary(edges: DataFrame) -> DataFrame:
    c = relationship_class(F.col("type"))
    return edges.agg(
        F.count("*").alias("total"), *[F.count_if(c == k).alias(k) for k in ("support", "semantic", "unknown")]
    )


def transcript_summary(documents: DataFrame, words: DataFrame, speakers: DataFrame, segments: DataFrame) -> DataFrame:
    """Each package's transcript document with its three layers' row counts, which are null unless the document parsed."""
    out = documents
    for name, df in (("word_rows", words), ("speaker_rows", speakers), ("segment_rows", segments)):
        out = count_left(out, df, "package", name).withColumn(name, F.when(F.col("parsed"), F.col(name)))
    return out
