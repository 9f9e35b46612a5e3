"""Findings: constraints and references as queries that return (code, severity, key, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SEVERITIES = ("info", "warning", "error", "fatal")


def findings(rows: DataFrame, code: str, severity: str, key: Column, message: str) -> DataFrame:
    return rows.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), F.lit(message).alias("message"))


def check(rows: DataFrame, bad: Column, code: str, severity: str, key: Column, message: str) -> DataFrame:
    """Rows that break a constraint."""
    return findings(rows.filter(F.coalesce(bad, F.lit(False))), code, severity, key, message)


def unresolved(rows: DataFrame, column: str, owner: DataFrame, owner_column: str, code: str, severity: str, key: Column, message: str) -> DataFrame:
    """Rows with a reference that the owner does not have."""
    ids = owner.select(F.col(owner_column).alias("_id")).distinct()
    return findings(rows.filter(F.col(column).isNotNull()).join(ids, F.col(column) == F.col("_id"), "left_anti"), code, severity, key, message)


def duplicates(rows: DataFrame, columns: list[str], code: str, severity: str, message: str) -> DataFrame:
    many = rows.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1")
    return findings(many, code, severity, F.concat_ws("|", *columns), message)


def out_of_order(rows: DataFrame, target: str, order: list[str], start: str, end: str) -> DataFrame:
    """Windows that start before the furthest end of those before them (of the same target, in file order), with reach."""
    w = Window.partitionBy(target).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("reach", F.max(end).over(w)).filter(F.col(start) < F.col("reach"))


def bad_time(start: Column, end: Column) -> Column:
    return (start < 0) | (end <= start)


def bad_box(box: Column) -> Column:
    """Not four numbers in [0, 1] with x0 < x1 and y0 < y1."""
    g = lambda i: F.get(box, F.lit(i))
    inside = F.forall(box, lambda v: v.isNotNull() & (v >= 0) & (v <= 1))
    return (F.size(box) != 4) | ~inside | (g(0) >= g(2)) | (g(1) >= g(3))


def bad_confidence(c: Column) -> Column:
    return c.isNull() | F.isnan(c) | (c < 0) | (c > 1)


def bad_coverage(cov: Column, total: Column, dominant: Column, buckets: tuple[str, ...], tolerance: float = 1e-6) -> Column:
    """Unknown bucket, share outside [0, 1], sum unlike the total or 1, or a dominant bucket that is not the largest."""
    values = F.map_values(cov)
    s = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    known = F.forall(F.map_keys(cov), lambda k: k.isin(*buckets))
    inside = F.forall(values, lambda v: (v >= 0) & (v <= 1 + tolerance))
    return ~known | ~inside | (F.abs(s - total) > tolerance) | (F.abs(s - 1) > tolerance) | (F.coalesce(F.try_element_at(cov, dominant), F.lit(-1.0)) < F.array_max(values))


def bad_bands(bands: Column, n: int = 10) -> Column:
    """Not exactly n bands that are null or finite."""
    return (F.size(bands) != n) | F.exists(bands, lambda v: F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(False)))


def schema_findings(rows: DataFrame, schema: dict, key: Column, code: str = "ERR_SCHEMA") -> DataFrame:
    """Rows against a flat schema: required names, and for properties type, enum, minimum, maximum, pattern, minItems,
    maxItems. All rules are looked at in one pass over the rows."""
    kinds = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
    rules: list[tuple[Column, str]] = [(F.col(name).isNull(), f"{name} is missing") for name in schema.get("required", [])]
    for name, rule in schema.get("properties", {}).items():
        c = F.col(name)
        if rule.get("type") in kinds:
            rules.append((c.isNotNull() & c.try_cast(kinds[rule["type"]]).isNull(), f"{name} is no {rule['type']}"))
        for word, bad, what in (
            ("enum", lambda v: ~c.isin(*v), "is not listed"), ("minimum", lambda v: c < v, "is too small"), ("maximum", lambda v: c > v, "is too large"),
            ("pattern", lambda v: ~c.rlike(v), "does not match"), ("minItems", lambda v: F.size(c) < v, "has too few items"), ("maxItems", lambda v: F.size(c) > v, "has too many items"),
        ):
            if word in rule:
                rules.append((bad(rule[word]), f"{name} {what}"))
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(what)) for bad, what in rules]) if rules else F.array().cast("array<string>"))
    broken = rows.select(key.cast("string").alias("key"), F.explode(found).alias("message"))
    return broken.select(F.lit(code).alias("code"), F.lit("error").alias("severity"), "key", "message")


def status(all_findings: DataFrame, core: tuple[str, ...] = ()) -> DataFrame:
    """One row: findings by severity, and the roll-up status. Only findings that affect the core count (none named: all)."""
    affects = F.col("code").isin(*core) if core else F.lit(True)
    counts = all_findings.agg(*[F.count_if(F.col("severity") == s).alias(f"{s}s") for s in SEVERITIES],
                              F.count_if(affects & F.col("severity").isin("error", "fatal")).alias("_bad"), F.count_if(affects & (F.col("severity") == "warning")).alias("_warn"))
    verdict = F.when(F.col("_bad") > 0, "invalid").when(F.col("_warn") > 0, "valid_with_warnings").otherwise("valid")
    return counts.withColumn("status", verdict).drop("_bad", "_warn")
