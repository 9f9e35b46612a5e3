"""Differences of two tables or documents under numeric tolerances."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geometry import box_iou, cosine_similarity
from .lineage import settled

#: Tolerances of the profile.
TOLERANCES = {"confidence": 0.001, "loudness": 0.1, "true_peak": 0.1, "spectrum": 0.1, "bucket": 0.005, "coverage_total": 0.001, "box_iou": 0.995, "centroid_px": 1.0,
              "depth_mae": 0.002, "depth_p99": 0.010, "depth_spearman": 0.995, "cosine": 0.999, "mask_iou": 0.995, "mask_p95_px": 1.0}
VERDICTS = ("byte_equivalent", "structurally_equivalent", "numerically_equivalent", "not_equivalent")


def compare_tables(a: DataFrame, b: DataFrame, key: list[str], tolerance: dict[str, float]) -> DataFrame:
    """(key, occurrence, column, verdict) of all differences: missing on one side, changed beyond its tolerance, or within it.

    Rows of one key are matched by their place among equals (a multiset per key). Columns without a tolerance must be equal,
    null being equal to null only."""
    columns = [c for c in a.columns if c not in key]
    place = lambda df: df.withColumn("occurrence", F.row_number().over(Window.partitionBy(*key).orderBy(*columns)))
    x = place(a).select(*key, "occurrence", F.struct(*columns).alias("x"))
    y = place(b).select(*key, "occurrence", F.struct(*columns).alias("y"))
    both = x.join(y, [*key, "occurrence"], "full_outer")
    verdicts = []
    for c in columns:
        p, q = F.col(f"x.{c}"), F.col(f"y.{c}")
        far = F.abs(p - q) > tolerance[c] if c in tolerance else F.lit(True)
        verdicts.append(F.struct(F.lit(c).alias("column"), F.when(p.eqNullSafe(q), "equal").when(F.coalesce(far, F.lit(True)), "changed").otherwise("within_tolerance").alias("verdict")))
    one_side = F.array(F.struct(F.lit("*").alias("column"), F.when(F.col("x").isNull(), "only_right").otherwise("only_left").alias("verdict")))
    found = F.when(F.col("x").isNull() | F.col("y").isNull(), one_side).otherwise(F.array(*verdicts))
    return both.select(*key, "occurrence", F.explode(found).alias("d")).select(*key, "occurrence", "d.column", "d.verdict").filter("verdict <> 'equal'")


def verdict(differences: DataFrame, bytes_equal: bool = False) -> DataFrame:
    """One row: differences by kind and the verdict."""
    d = differences.agg(F.count_if(F.col("verdict") == "within_tolerance").alias("within"), F.count_if(F.col("verdict") != "within_tolerance").alias("beyond"))
    return d.withColumn("verdict", F.when(F.col("beyond") > 0, VERDICTS[3]).when(F.col("within") > 0, VERDICTS[2]).otherwise(VERDICTS[0] if bytes_equal else VERDICTS[1]))


def flatten_json(df: DataFrame, v: str, key: list[str]) -> DataFrame:
    """(key, pointer, type, value) of every scalar of a VARIANT column, at any depth; empty containers stand for themselves.

    Levels are opened one after another until none has a container with members; each is settled, so none is computed
    twice."""
    level = df.select(*key, F.lit("").alias("pointer"), F.col(v).alias("_v"))
    out = None
    while True:
        kind = F.schema_of_variant("_v")
        nested = F.coalesce(kind.rlike("^(OBJECT|ARRAY)<.") & ~kind.isin("OBJECT<>", "ARRAY<>", "ARRAY<VOID>"), F.lit(False))
        flat = level.filter(~nested).select(*key, "pointer", F.schema_of_variant("_v").alias("type"), F.to_json("_v").alias("value"))
        out = flat if out is None else out.unionByName(flat)
        level = level.filter(nested)
        if not level.head(1):
            return out
        level.createOrReplaceTempView("_flatten_level")
        names = ", ".join(f"t.`{k}`" for k in key)
        level = settled(df.sparkSession.sql(f"select {names}{',' if names else ''} concat(t.pointer, '/', coalesce(e.key, cast(e.pos as string))) as pointer, e.value as _v from _flatten_level t, lateral variant_explode(t._v) e"))


def compare_json(a: DataFrame, b: DataFrame, v: str, key: list[str], rules: list[tuple[str, float]]) -> DataFrame:
    """Differences of documents by pointer; rules are (pointer pattern, absolute tolerance), the first that matches counts.

    Only number against number is tolerated; a missing pointer always differs."""
    x = flatten_json(a, v, key).withColumnsRenamed({"type": "xt", "value": "x"})
    y = flatten_json(b, v, key).withColumnsRenamed({"type": "yt", "value": "y"})
    p, q = F.col("x").try_cast("double"), F.col("y").try_cast("double")
    numbers = F.col("xt").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & F.col("yt").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    near = F.lit(None).cast("double")
    for pattern, t in reversed(rules):
        near = F.when(F.col("pointer").rlike(pattern), F.lit(t)).otherwise(near)
    same = F.when(numbers, p == q).otherwise(F.col("x").eqNullSafe(F.col("y")) & F.col("xt").eqNullSafe(F.col("yt")))
    kind = F.when(F.col("xt").isNull(), "only_right").when(F.col("yt").isNull(), "only_left").when(same, "equal").when(numbers & (F.abs(p - q) <= near), "within_tolerance").otherwise("changed")
    return x.join(y, [*key, "pointer"], "full_outer").select(*key, "pointer", "x", "y", kind.alias("verdict")).filter("verdict <> 'equal'")


def boxes_equal(a: Column, b: Column) -> Column:
    return (a == b) | (box_iou(a, b) >= TOLERANCES["box_iou"])


def vectors_equal(a: Column, b: Column) -> Column:
    return cosine_similarity(a, b) >= TOLERANCES["cosine"]


def _before(counts: DataFrame, key: list[str], value: str, name: str) -> DataFrame:
    """counts (key, value, _n), one row a value, with `name`, how many of the key's rows have a smaller value, nulls being
    least: ranges of the values are counted, then gone through each by itself."""
    parts = settled(counts.repartitionByRange(*key, value).withColumn("_p", F.spark_partition_id()))
    w = Window.partitionBy(*key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    above = parts.groupBy(*key, "_p").agg(F.sum("_n").alias("_c")).withColumn("_b", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    own = Window.partitionBy(*key, "_p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.withColumn("_r", F.coalesce(F.sum("_n").over(own), F.lit(0)))
    same = counted["_p"] == above["_p"]
    for k in key:
        same = same & counted[k].eqNullSafe(above[k])
    return counted.join(above.hint("broadcast"), same).select(*[counted[c] for c in counts.columns], (F.col("_r") + F.col("_b")).alias(name))  # a row a range


def depth_metrics(pairs: DataFrame, key: list[str], a: str, b: str) -> DataFrame:
    """(key, mae, p99, spearman) of two depth values a row: nearest-rank 99th percentile, ranks averaged over ties.

    Equal pairs are counted first; ranks come from counts by ranges of values, and ranks' means are known, so no task holds
    a key's rows."""
    n = settled(pairs.groupBy(*key, F.col(a).alias("_x"), F.col(b).alias("_y")).agg(F.count("*").alias("_n")))
    n = n.withColumn("_d", F.abs(F.col("_x") - F.col("_y")))
    by = lambda df, c: df.groupBy(*key, c).agg(F.sum("_n").alias("_n"))

    def joined(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
        """Equal keys, null being equal to null."""
        r = right.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)], *[c for c in right.columns if c not in columns])
        on = F.lit(True)
        for i, c in enumerate(columns):
            on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
        return left.join(r, on).drop(*[f"_k{i}" for i in range(len(columns))])

    def ranked(c: str, name: str) -> DataFrame:
        return _before(by(n, c), key, c, name).withColumn(name, F.col(name) + (F.col("_n") + 1) / 2).drop("_n")

    r = joined(joined(n, ranked("_x", "_ra"), [*key, "_x"]), ranked("_y", "_rb"), [*key, "_y"])
    all_ = n.groupBy(*key).agg(F.sum("_n").alias("_all"), F.sum(F.when(F.col("_d").isNotNull(), F.col("_n"))).alias("_some"))
    r = joined(r, all_, key)
    da, db = F.col("_ra") - (F.col("_all") + 1) / 2, F.col("_rb") - (F.col("_all") + 1) / 2
    total = lambda c: F.sum(c * F.col("_n"))
    spread = F.sqrt(total(da * da)) * F.sqrt(total(db * db))
    stat = r.groupBy(*key).agg((total(F.col("_d")) / F.max("_some")).alias("mae"), (total(da * db) / F.nullif(spread, F.lit(0.0))).alias("spearman"))
    d = joined(_before(by(n.filter("_d is not null"), "_d"), key, "_d", "_at"), all_, key)
    want = F.greatest(F.ceil(F.col("_some") * 0.99), F.lit(1))
    p99 = d.filter((F.col("_at") < want) & (want <= F.col("_at") + F.col("_n"))).select(*key, F.col("_d").alias("p99"))
    p = p99.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "p99")
    on = F.lit(True)
    for i, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return stat.join(p, on, "left").select(*key, "mae", "p99", "spearman")


def entry_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries of only one of two packages: (entry, side)."""
    x, y = a.select("entry").distinct(), b.select("entry").distinct()
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def squared_distance(on: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distance of every pixel to the nearest set one: column distances, then, row by row, the
    least of column distance and offset."""
    h, w = on.shape
    far = float(h * h + w * w + 1)
    rows = np.arange(h)[:, None]
    above = np.maximum.accumulate(np.where(on, rows, -h - w), 0)
    below = np.minimum.accumulate(np.where(on, rows, 2 * h + w)[::-1], 0)[::-1]
    col = np.minimum(np.minimum(rows - above, below - rows).astype(float) ** 2, far)
    x = np.arange(w)
    offset = (x[:, None] - x[None, :]).astype(float) ** 2
    return np.stack([(col[r][None, :] + offset).min(1) for r in range(h)]) if h else col


def boundary(mask: np.ndarray) -> np.ndarray:
    """Set pixels with an unset neighbour (or the raster's edge) on one of four sides."""
    p = np.pad(mask, 1)
    return mask & ~(p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:])


def mask_metrics(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """IoU, and the nearest-rank 95th percentile of the distances from either boundary to the other."""
    either = int((a | b).sum())
    if not either:
        return 1.0, 0.0
    if not a.any() or not b.any():
        return 0.0, float("inf")
    x, y = boundary(a), boundary(b)
    d = np.sort(np.sqrt(np.concatenate([squared_distance(y)[x], squared_distance(x)[y]])))
    return int((a & b).sum()) / either, float(d[max(0, int(np.ceil(0.95 * d.size)) - 1)])
