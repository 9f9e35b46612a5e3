"""Transcripts of several microphones in one room: turns, repeated turns, owners of words, and ranks of speakers.

words: package, source, chunk, word_no, text, start_us, end_us, confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import alphanumeric_key, token_lcs
from .intervals import merge_spans, overlap_join, union_length
from .transcript import ends_utterance

GAP_US, NEAR_US = 750_000, 500_000
ALIKE, LEAST_TOKENS = 0.6, 3


def with_turns(words: DataFrame, gap_us: int = GAP_US) -> DataFrame:
    """Add turn, numbered per source: it ends with its chunk, a sentence, or a gap."""
    order = Window.partitionBy("package", "source").orderBy("chunk", "start_us", "word_no")
    before = lambda c: F.lag(c).over(order)
    new = before("chunk").isNull() | (before("chunk") != F.col("chunk")) | ends_utterance(before("text")) | (F.col("start_us") - before("end_us") > gap_us)
    return words.withColumn("_new", new.cast("int")).withColumn("turn", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def turns(words: DataFrame, gap_us: int = GAP_US) -> DataFrame:
    """(package, source, turn, chunk, start_us, end_us, words, tokens)."""
    item = F.struct("start_us", "word_no", alphanumeric_key(F.col("text")).alias("t"))
    return with_turns(words, gap_us).groupBy("package", "source", "turn").agg(
        F.first("chunk").alias("chunk"), F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("words"),
        F.filter(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["t"]), lambda t: t != "").alias("tokens"),
    )


def repeated_turns(t: DataFrame, near_us: int = NEAR_US, alike: float = ALIKE) -> DataFrame:
    """Pairs of turns of two sources of one package and chunk, at most `near_us` apart, whose longest common subsequence
    covers at least `alike` of the shorter: (package, source_a, turn_a, source_b, turn_b, ratio)."""
    a = t.select("package", "chunk", F.col("source").alias("source_a"), F.col("turn").alias("turn_a"), F.col("tokens").alias("ta"), F.col("start_us").alias("l_start"), (F.col("end_us") + near_us + 1).alias("l_end"))
    b = t.select("package", "chunk", F.col("source").alias("source_b"), F.col("turn").alias("turn_b"), F.col("tokens").alias("tb"), F.col("start_us").alias("r_start"), (F.col("end_us") + near_us + 1).alias("r_end"))
    pair = overlap_join(a, b, 10_000_000, ["package", "chunk"]).filter("source_a < source_b")
    least = F.least(F.size("ta"), F.size("tb"))
    return pair.filter(least >= LEAST_TOKENS).withColumn("ratio", token_lcs("ta", "tb") / least).filter(F.col("ratio") >= alike).select("package", "source_a", "turn_a", "source_b", "turn_b", "ratio")


def turn_levels(t: DataFrame, frames: DataFrame) -> DataFrame:
    """Add snr: the median level of the source's signal frames during the turn, above its noise floor.

    frames: package, source, start_us, end_us, signal_db, noise_floor_db."""
    a = t.select("package", "source", "turn", F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    b = frames.select("package", "source", F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"), "signal_db", "noise_floor_db")
    level = overlap_join(a, b, 1_000_000, ["package", "source"]).groupBy("package", "source", "turn").agg((F.percentile("signal_db", 0.5) - F.first("noise_floor_db")).alias("snr"))
    return t.join(level, ["package", "source", "turn"], "left")


def owned_turns(t: DataFrame, pairs: DataFrame) -> DataFrame:
    """Turns without those that a source with a stronger signal repeats; equal or unknown levels go to the lesser source."""
    level = t.select("package", F.col("source").alias("s"), F.col("turn").alias("n"), F.coalesce("snr", F.lit(float("-inf"))).alias("v"))
    p = (
        pairs.join(level.withColumnsRenamed({"s": "source_a", "n": "turn_a", "v": "va"}), ["package", "source_a", "turn_a"])
        .join(level.withColumnsRenamed({"s": "source_b", "n": "turn_b", "v": "vb"}), ["package", "source_b", "turn_b"])
    )
    lost = p.select("package", F.when(F.col("va") >= F.col("vb"), F.col("source_b")).otherwise(F.col("source_a")).alias("source"), F.when(F.col("va") >= F.col("vb"), F.col("turn_b")).otherwise(F.col("turn_a")).alias("turn"))
    return t.join(lost.distinct(), ["package", "source", "turn"], "left_anti")


def source_profile(words: DataFrame, gap_us: int = GAP_US) -> DataFrame:
    """(package, source, speech_us, word_count, mean_confidence, rank): speech merged over gaps; rank by words, then source."""
    speech = merge_spans(words, ["package", "source"], "start_us", "end_us", gap_us).groupBy("package", "source").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("speech_us"))
    counts = words.groupBy("package", "source").agg(F.count("*").alias("word_count"), F.avg("confidence").alias("mean_confidence"))
    rank = F.row_number().over(Window.partitionBy("package").orderBy(F.desc("word_count"), "source"))
    return counts.join(speech, ["package", "source"], "left").fillna(0, ["speech_us"]).withColumn("rank", rank)


def source_overlap(words: DataFrame) -> DataFrame:
    """(package, source_a, source_b, both_us, ratio): speech in common, and its share of the shorter speech."""
    m = merge_spans(words, ["package", "source"], "start_us", "end_us")
    a = m.select("package", F.col("source").alias("source_a"), F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    b = m.select("package", F.col("source").alias("source_b"), F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"))
    both = overlap_join(a, b, 10_000_000, ["package"]).filter("source_a < source_b").groupBy("package", "source_a", "source_b").agg(F.sum(F.least("l_end", "r_end") - F.greatest("l_start", "r_start")).alias("both_us"))
    total = union_length(words, ["package", "source"], "start_us", "end_us")
    ta, tb = (total.select("package", F.col("source").alias(f"source_{k}"), F.col("covered_us").alias(f"us_{k}")) for k in "ab")
    return both.join(ta, ["package", "source_a"]).join(tb, ["package", "source_b"]).select("package", "source_a", "source_b", "both_us", (F.col("both_us") / F.least("us_a", "us_b")).alias("ratio"))


def reconcile(words: DataFrame, frames: DataFrame) -> DataFrame:
    """Words of the turns that their source owns, in order of start, end and source; all words of a repeated turn go with
    the weaker source's turn."""
    t = turn_levels(turns(words), frames)
    own = owned_turns(t, repeated_turns(t)).select("package", "source", "turn")
    n = F.row_number().over(Window.partitionBy("package").orderBy("start_us", "end_us", "source", "word_no"))
    return with_turns(words).join(own, ["package", "source", "turn"], "left_semi").withColumn("position", n)
