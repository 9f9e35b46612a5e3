"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

A source's target is cut into slots of `block` words, the last one as short as it needs to be. The van der Corput points
of 0, 1, 2 ... (numbers with their bits reversed, over a power of two) map through the cumulative slots to sources: each
point below their sum belongs to one slot, so a source gets all its slots, spread evenly over the whole schedule. Slots
are ranked per source, and the j-th slot of a source takes the j-th block of its words. A source's words are those of
its documents in shuffled order, followed by themselves once more, and blocks are cut every `block` words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, place, plain, with_row_ids, written

BLOCK = 256  # words of a slot
CELLS = 1024
#: Masks of every second bit, pair, four, eight and sixteen of 64, to reverse a number's bits.
SWAPS = ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF))
WEIGHTS = (5.0, 2.0, 1.0)
NO_WORD = r"[\x20\x09-\x0D]*"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> with sr (rank by code point, null last), weight and target.

    Weights repeat along the ranks. Targets in proportion to the weights sum to `share` of all sizes; none exceeds
    `most` times its source's size, and what is cut goes to the others by weight. Sources are summed rows, so the
    windows over all of them hold one row a source."""
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("sr", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sr") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    by_ratio = Window.partitionBy(F.lit(1)).orderBy("ratio", "sr")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, 0)
    level = (F.col("goal") - F.col("capped")) / F.col("left")
    return (
        ranked.withColumn("w", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", level)
        .withColumn("full", F.min((F.col("level") >= F.col("ratio")).cast("int")).over(upto))
        .withColumn("rest", F.first(F.when(F.col("full") == 0, F.col("level")), ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.when(F.col("full") == 1, F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("rest"))))
        .select("source", "source_size", "sr", "w", "target")
    )


def reversed_bits(c: Column, bits: int) -> Column:
    """The number made of the low `bits` bits of a long, 1 to 63 of them, from the last to the first."""
    for by, mask in SWAPS:
        m = F.lit(mask).cast("long")
        c = F.shiftright(c, by).bitwiseAND(m).bitwiseOR(F.shiftleft(c.bitwiseAND(m), by))
    c = F.shiftrightunsigned(c, 32).bitwiseOR(F.shiftleft(c, 32))
    return F.shiftrightunsigned(c, 64 - bits)


def _schedule(sources: DataFrame, slots: int, block: int) -> DataFrame:
    """(sr, block, slot): the place in the schedule of each block of each source.

    sources: sr, and its slots [lo, hi) of all `slots`."""
    spark = sources.sparkSession
    bits = max(1, (slots - 1).bit_length())
    cell = max(1, -(-slots // CELLS))
    chunk = max(16, math.isqrt(1 << bits))
    point = (
        spark.range(0, 1 << bits, 1, max(spark.sparkContext.defaultParallelism, 1 << max(0, bits - 20))).select(F.col("id").alias("slot"), reversed_bits(F.col("id"), bits).alias("u")).filter(F.col("u") < slots)
        .withColumn("cell", F.floor(F.col("u") / cell)).withColumn("chunk", F.floor(F.col("slot") / chunk))
    )
    share = sources.filter("hi > lo").select("sr", "lo", "hi").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))))
    of = point.join(share, "cell").filter("u >= lo and u < hi").select("slot", "chunk", "sr")
    counts = of.groupBy("sr", "chunk").agg(F.count("*").alias("c"))
    ahead = Window.partitionBy("sr").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("sr", "chunk", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("sr", "chunk").orderBy("slot")) - 1
    return of.withColumn("r", rank).join(offset, ["sr", "chunk"]).select("sr", (F.col("r") + F.col("offset")).alias("block"), "slot")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """One row for each input row: id, row_id, size (words), source_size, target, taken (words taken, repeats counted).

    A source's taken words are its target, rounded to a whole word; no row is taken more than twice its size, and a slot
    holds `block` words whatever the size of the table. The shuffle is a hash of id and text, so reruns agree. A null text
    has no words; null is a source of its own, ranked last; rows without words are taken 0 times; rows that repeat an id
    are separate rows, and ids may be of any type that sorts; an empty table gives an empty result. Other columns, whatever
    their names, are not looked at.
    """
    base = plain(docs).select(F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("_text"), F.col(place(docs, source_col)).cast("string").alias("source"))
    base = with_row_ids(base, "_id", "_text")
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("_text", F.lit(""))).cast("binary"))
    order = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    sized = written(base.select("_rid", "_id", "source", n_words("_text").alias("size"), order.alias("h")), "sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    upto = Window.partitionBy(F.lit(1)).orderBy("sr").rowsBetween(Window.unboundedPreceding, 0)  # one row a source
    words = F.floor(F.col("target") + 0.5)
    sources = written(
        targets.withColumn("words", words).withColumn("slots", F.ceil(F.col("words") / block)).withColumn("hi", F.sum("slots").over(upto)).withColumn("lo", F.col("hi") - F.col("slots"))
        .select("source", "source_size", "sr", "target", "words", "lo", "hi"),
        "sources",
    )
    slots = sources.agg(F.coalesce(F.max("hi"), F.lit(0))).first()[0]
    subs = max(16, math.isqrt(sized.count()))
    placed = sized.join(sources.select("source", "sr", "source_size", "target", "words"), sized.source.eqNullSafe(sources.source)).drop("source").withColumn(
        "sub", F.pmod("h", F.lit(subs))
    )
    ahead = Window.partitionBy("sr").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("sr", "sub").agg(F.sum("size").alias("s")).select("sr", "sub", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("sr", "sub").orderBy("h", "_rid").rowsBetween(Window.unboundedPreceding, -1)
    start = placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offset, ["sr", "sub"]).withColumn("start", F.col("offset") + F.col("before"))
    # The part of a row, [from, to) of its source's words, that lies before the target, in the first turn and in the second.
    turn = lambda ahead: F.struct((F.col("start") + ahead).alias("from"), F.least(F.col("start") + F.col("size") + ahead, F.col("words")).alias("to"))
    parts = F.filter(F.array(turn(F.lit(0)), turn(F.col("source_size"))), lambda p: p["to"] > p["from"])
    part = start.withColumn("part", F.explode_outer(parts)).withColumn(
        "block", F.explode_outer(F.when(F.col("part").isNotNull(), F.sequence(F.floor(F.col("part.from") / block), F.floor((F.col("part.to") - 1) / block))))
    )
    overlap = F.least(F.col("part.to"), (F.col("block") + 1) * block) - F.greatest(F.col("part.from"), F.col("block") * block)
    return (
        part.join(_schedule(sources, slots, block), ["sr", "block"], "left")
        .groupBy("_id", "_rid", "size", "source_size", "target")
        .agg(F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), overlap)), F.lit(0)).cast("long").alias("taken"))
        .select(F.col("_id").alias(id_col), "size", "source_size", "target", "taken", F.col("_rid").alias("row_id"))
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: rows of docs, repeated as often as the schedule takes them. Where a source's target ends inside a
    row, its last repeat holds the words of the last slot's own range, from the text's first character to the end of the
    last word taken, with all white space between. Rows not taken, and rows without words, do not appear."""
    names, text = docs.columns, place(docs, text_col)
    base = with_row_ids(plain(docs).withColumn("_i", F.col(place(docs, id_col))), "_i", text)
    mix = mix_sources(base.select("_rid", F.col(text).alias("_t"), F.col(place(docs, source_col)).alias("_s")), "_rid", "_t", "_s", **options).select(
        "_rid", F.floor(F.col("taken") / F.greatest("size", F.lit(1))).cast("int").alias("_whole"), (F.col("taken") % F.greatest("size", F.lit(1))).cast("int").alias("_part")
    ).filter("_whole > 0 or _part > 0")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({NO_WORD}{WORD})"), F.lit(1)), F.lit(1), F.col("_part")), "")
    out = base.join(mix, "_rid").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_whole") + F.when(F.col("_part") > 0, 1).otherwise(0))))
    out = out.withColumn(text, F.when(F.col("_copy") > F.col("_whole"), cut).otherwise(F.col(text)))
    return out.select(*[f"_c{i}" for i in range(len(names))]).toDF(*names)
