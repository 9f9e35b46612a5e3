"""Interval operators over whole-microsecond columns; spans are [start, end)."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Both have length, and share some of it."""
    return (s1 < e1) & (s2 < e2) & (s1 < e2) & (s2 < e1)


def overlap_us(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.least(e1, e2) - F.greatest(s1, s2)


def in_window(start: Column, end: Column, at_us: int | None = None, start_us: int | None = None, end_us: int | None = None) -> Column:
    """Does an edge's time match? An instant (start = end) must be the asked point, or lie in [start_us, end_us)."""
    if at_us is not None:
        if start_us is not None or end_us is not None:
            raise ValueError("a point in time excludes a window")
        return F.when(start == end, start == at_us).otherwise((start <= at_us) & (F.lit(at_us) < end))
    if start_us is None and end_us is None:
        return F.lit(True)
    ws, we = start_us or 0, (1 << 63) - 1 if end_us is None else end_us
    return F.when(start == end, (start >= ws) & (start < we)).otherwise((start < we) & (end > ws))


#: Rows up to which the smaller side of a join is sent to all executors by way of the driver.
FEW = 20_000


def by_size(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df as one side of an equality join: broadcast where it has few rows, else never, whatever Spark makes of the size of
    its files, which may be a hundredth of that of its rows in the driver's memory."""
    if rows is None:
        rows = df.limit(FEW + 1).count()
    return df.hint("broadcast" if rows <= FEW else "merge")


def _level(length: Column, width: int) -> Column:
    """How often `width` is doubled until it is a length; a span touches two bins of its own level, three at most."""
    return F.greatest(F.lit(0), F.ceil(F.log2(length / F.lit(width)))).cast("int")


def _levels(spans: DataFrame, length: Column, width: int) -> dict[int, int]:
    """The levels that occur, 64 numbers at most, and how many spans each has."""
    return dict(sorted(map(tuple, spans.groupBy(_level(length, width)).count().collect())))


def _bins(df: DataFrame, start: str, last: Column, own: Column, other: list[int], width: int, name: str) -> DataFrame:
    """A row for each bin, struct(level, number), that a span touches on its own level and on those of `other` above it."""
    at = lambda c, m: F.floor(c / (F.lit(width) * F.pow(F.lit(2.0), m))).cast("long")
    levels = F.concat(F.array(own), F.filter(F.array(*[F.lit(m) for m in other]), lambda m: m > own)) if other else F.array(own)
    every = F.flatten(F.transform(levels, lambda m: F.transform(F.sequence(at(F.col(start), m), at(last, m)), lambda b: F.struct(m.alias("m"), b.alias("b")))))
    return df.withColumn(f"{name}_own", own).withColumn(name, F.explode(every))


def overlap_join(left: DataFrame, right: DataFrame, width: int, on: list[str] | None = None, l: tuple[str, str] = ("l_start", "l_end"), r: tuple[str, str] = ("r_start", "r_end")) -> DataFrame:  # noqa: E741
    """Pairs of spans that overlap, one row each, as an equality join on time bins (plus the columns of `on`).

    Bins have levels, each twice as wide as the one below, from `width` on; a span's own level is that of its length, so
    long spans cost no more bins than short ones. Two spans meet on the higher of their levels, in the bin where their
    overlap starts. Which levels occur is counted first. Column names must differ between the sides but for `on`. The plan
    has no nested loop, whatever the sizes."""
    left, right = left.filter(F.col(l[0]) < F.col(l[1])), right.filter(F.col(r[0]) < F.col(r[1]))
    lengths = [F.col(x[1]) - F.col(x[0]) for x in (l, r)]
    found = [_levels(d, n, width) for d, n in zip((left, right), lengths)]
    a = _bins(left, l[0], F.col(l[1]) - 1, _level(lengths[0], width), list(found[1]), width, "_bin").withColumnRenamed("_bin_own", "_l_own")
    b = _bins(right, r[0], F.col(r[1]) - 1, _level(lengths[1], width), list(found[0]), width, "_bin").withColumnRenamed("_bin_own", "_r_own")
    start = F.greatest(F.col(l[0]), F.col(r[0]))
    here = F.floor(start / (F.lit(width) * F.pow(F.lit(2.0), F.col("_bin.m")))) == F.col("_bin.b")
    return (
        a.join(by_size(b, sum(found[1].values())), ["_bin", *(on or [])]).filter((F.col("_bin.m") == F.greatest("_l_own", "_r_own")) & (F.col(l[0]) < F.col(r[1])) & (F.col(r[0]) < F.col(l[1])) & here)
        .drop("_bin", "_l_own", "_r_own")
    )


def point_join(points: DataFrame, spans: DataFrame, width: int, point: str, span: tuple[str, str], on: list[str] | None = None) -> DataFrame:
    """Points with the spans that hold them (start <= point < end), as an equality join on time bins of the spans' levels."""
    spans = spans.filter(F.col(span[0]) < F.col(span[1]))
    length = F.col(span[1]) - F.col(span[0])
    found = _levels(spans, length, width)
    levels = list(found) or [0]
    a = points.withColumn("_bin", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.floor(F.col(point) / F.lit(width * 2.0**m)).cast("long").alias("b")) for m in levels])))
    b = _bins(spans, span[0], F.col(span[1]) - 1, _level(length, width), [], width, "_bin").drop("_bin_own")
    return a.join(by_size(b, sum(found.values())), ["_bin", *(on or [])]).filter((F.col(span[0]) <= F.col(point)) & (F.col(point) < F.col(span[1]))).drop("_bin")


def _sweep(groups: int):
    """A function of Arrow batches, sorted by `groups` columns, _t and spans before points, that gives each point (_p) with
    the span (_q) of the least order that holds it. Of a group's spans only those are kept that no earlier one outlasts, so
    their ends rise with their order, and the first that has not ended is the one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, orders, ends, at, carry = None, [], [], [], None
        for batch in batches:
            mine = batch.column("_q")
            pool = mine if carry is None else pa.concat_arrays([carry, mine])
            shift = len(pool) - len(mine)
            hits, spans = [], []
            columns = [batch.column(i).to_pylist() for i in range(groups)]
            for i, (g, t, e, o) in enumerate(zip(zip(*columns), *[batch.column(c).to_pylist() for c in ("_t", "_e", "_o")])):
                if g != group:
                    group, orders, ends, at = g, [], [], []
                if e is None:
                    gone = bisect_right(ends, t)
                    if gone:
                        del orders[:gone], ends[:gone], at[:gone]
                    if ends:
                        hits.append(i)
                        spans.append(at[0])
                    continue
                rank = (o is not None, o)
                k = bisect_right(orders, rank)
                if k and ends[k - 1] >= e:
                    continue
                last = bisect_right(ends, e, k)  # later ones that end no later
                orders[k:last], ends[k:last], at[k:last] = [rank], [e], [shift + i]
            if hits:
                yield pa.RecordBatch.from_arrays([batch.column("_p").take(pa.array(hits)), pool.take(pa.array(spans))], ["_p", "_q"])
            carry, at = pool.take(pa.array(at, pa.int64())), list(range(len(at)))

    return run


def first_match(points: DataFrame, spans: DataFrame, width: int, point: str, span: tuple[str, str], key: list[str], order: str, on: list[str] | None = None) -> DataFrame:
    """Each point with the first span, by `order`, that holds it; points are told apart by `key`.

    Points and spans of a time bin are gone through together in the order of time, so the work does not grow with how many
    spans hold a point, and a bin of any size is a stream."""
    on = on or []
    spans = spans.filter(F.col(span[0]) < F.col(span[1]))
    length = F.col(span[1]) - F.col(span[0])
    levels = list(_levels(spans, length, width)) or [0]
    p, q = F.struct(*points.columns).alias("_p"), F.struct(*[c for c in spans.columns if c not in on]).alias("_q")
    bins = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.floor(F.col(point) / F.lit(width * 2.0**m)).cast("long").alias("b")) for m in levels])).alias("_bin")
    a = points.filter(F.col(point).isNotNull()).select(*on, F.col(point).alias("_t"), p, bins).select(*on, "_bin.m", "_bin.b", "_t", "_p")
    b = _bins(spans, span[0], F.col(span[1]) - 1, _level(length, width), [], width, "_bin").select(*on, "_bin.m", "_bin.b", F.col(span[0]).alias("_t"), F.col(span[1]).alias("_e"), F.col(order).alias("_o"), q)
    for c in on:
        a, b = a.filter(F.col(c).isNotNull()), b.filter(F.col(c).isNotNull())
    group = [*on, "m", "b"]
    both = b.unionByName(a, allowMissingColumns=True).select(*group, "_t", "_e", "_o", "_p", "_q").repartition(*group).sortWithinPartitions(*group, "_t", F.col("_e").isNull())
    held = both.mapInArrow(_sweep(len(group)), both.select("_p", "_q").schema).select(*[F.col(f"_p.`{c}`") for c in [*on, *[c for c in points.columns if c not in on]]], "_q.*")
    w = Window.partitionBy(*key).orderBy(order)
    return held.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def merge_spans(df: DataFrame, key: list[str], start: str, end: str, gap: int = 0) -> DataFrame:
    """Spans of each key, merged where one starts at most `gap` after the furthest end before it; empty ones are left out."""
    order = Window.partitionBy(*key).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col(start) - reach > gap), 1).otherwise(0)
    return (
        df.filter(F.col(end) > F.col(start)).withColumn("_new", new)
        .withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("parts"))
    )


def union_length(df: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Total time covered by each key's spans."""
    return merge_spans(df, key, start, end).groupBy(*key).agg(F.sum(F.col(end) - F.col(start)).alias("covered_us"))


def intersect_spans(a: DataFrame, b: DataFrame, key: list[str], width: int) -> DataFrame:
    """Common parts of two span sets (start, end) for each key; each set is merged first."""
    left = merge_spans(a, key, "start", "end").select(*key, F.col("start").alias("l_start"), F.col("end").alias("l_end"))
    right = merge_spans(b, key, "start", "end").select(*key, F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return overlap_join(left, right, width, key).select(*key, F.greatest("l_start", "r_start").alias("start"), F.least("l_end", "r_end").alias("end"))


def shared_ratio(a: DataFrame, b: DataFrame, key: list[str], width: int) -> DataFrame:
    """Common time over the shorter set's time; 0 where one has none."""
    la = union_length(a, key, "start", "end").withColumnRenamed("covered_us", "a_us")
    lb = union_length(b, key, "start", "end").withColumnRenamed("covered_us", "b_us")
    both = intersect_spans(a, b, key, width).groupBy(*key).agg(F.sum(F.col("end") - F.col("start")).alias("both_us"))
    least = F.least(F.coalesce("a_us", F.lit(0)), F.coalesce("b_us", F.lit(0)))
    return la.join(lb, key, "full_outer").join(both, key, "left").select(
        *key, F.coalesce("both_us", F.lit(0)).alias("both_us"), F.when(least > 0, F.coalesce("both_us", F.lit(0)) / F.nullif(least, F.lit(0))).otherwise(0.0).alias("ratio")
    )


def tumbling(df: DataFrame, at: str, width: int) -> DataFrame:
    """Add window_start, the start of the fixed window of `width` that holds the time."""
    return df.withColumn("window_start", (F.floor(F.col(at) / F.lit(width)) * width).cast("long"))


def sliding_plan(durations: DataFrame, duration: str, length: int, overlap: int) -> DataFrame:
    """Chunks of `length` that overlap by `overlap` and cover [0, duration): ordinal, span, and overlaps with neighbours."""
    if not 0 <= overlap < length:
        raise ValueError("overlap must be less than length, and neither negative")
    step, d = length - overlap, F.col(duration)
    return (
        durations.filter(d > 0).withColumn("start_us", F.explode(F.sequence(F.lit(0).cast("long"), d - 1, F.lit(step).cast("long"))))
        .withColumn("ordinal", (F.col("start_us") / step).cast("long"))
        .withColumn("end_us", F.least(F.col("start_us") + length, d))
        .withColumn("overlap_before_us", F.when(F.col("ordinal") == 0, 0).otherwise(F.least(F.lit(overlap), F.col("start_us"))).cast("long"))
        .withColumn("overlap_after_us", F.when(F.col("start_us") + step < d, F.least(F.lit(overlap), d - F.col("start_us") - step)).otherwise(0).cast("long"))
        .withColumn("chunk_id", F.format_string("chunk_%06d", F.col("ordinal")))
    )


def context_windows(counts: DataFrame, count: str, size: int, margin: int) -> DataFrame:
    """Tumbling windows of `size` over [0, count) with a margin of context on either side."""
    n = F.col(count)
    return (
        counts.filter(n > 0).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), n - 1, F.lit(size).cast("long"))))
        .withColumn("end", F.least(F.col("start") + size, n))
        .withColumn("process_start", F.greatest(F.col("start") - margin, F.lit(0)))
        .withColumn("process_end", F.least(F.col("end") + margin, n))
    )


def band_join(left: DataFrame, right: DataFrame, delta: int, at: tuple[str, str], on: list[str] | None = None) -> DataFrame:
    """Pairs of moments at most `delta` apart, by bins as wide as delta joined to themselves and their neighbours."""
    width = max(1, delta)
    a = left.withColumn("_bin", F.floor(F.col(at[0]) / F.lit(width)).cast("long"))
    own = F.floor(F.col(at[1]) / F.lit(width)).cast("long")
    b = right.withColumn("_bin", F.explode(F.array(own - 1, own, own + 1)))
    return a.join(b, ["_bin", *(on or [])]).filter(F.abs(F.col(at[0]) - F.col(at[1])) <= delta).drop("_bin")
