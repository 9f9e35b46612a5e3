import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import block_knn as m


def dot(q, v):
    total = 0.0  # sum() compensates its rounding
    for a, b in zip(q, v):
        total += float(a) * float(b)
    return total


def brute(rows, queries, k):
    out = []
    for qi, q in queries:
        scored = sorted(((-dot(q, v), i) for i, v in rows if i != qi))[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(3)
    x = r.normal(size=(900, 24)).astype(np.float32)
    x[100:140] = x[7]  # ties
    x[200:230] *= 1e-3
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = sorted(tuple(t) for t in m.block_knn(df, df.filter("vec_id % 20 = 0"), k=20, query_bytes=10 * 24 * 8, candidate_rows=50).collect())
    want = brute(rows, [t for t in rows if t[0] % 20 == 0], 20)
    assert got == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (None, [1.0, 1.0]), (7, []), (20, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as tile", "2 as part", "3 as vid")
    got = sorted(tuple(t) for t in m.block_knn(df, df.filter("vec_id % 20 = 0"), k=20).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -2.0)]
    assert m.block_knn(df.limit(0), df.limit(0)).count() == 0


def test_floors_leave_little_to_return(spark, monkeypatch):
    """Beyond the first group of candidates, a query returns what may still be among its best, not k of each group."""
    r = np.random.default_rng(5)
    x = r.normal(size=(2000, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(2000)], "vec_id long, embedding array<float>")
    plain_merge = m._merge
    seen = spark.sparkContext.accumulator(0)

    def merge(k):
        def run(batches):
            def counted():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b

            yield from plain_merge(k)(counted())

        return run

    monkeypatch.setattr(m, "_merge", merge)
    assert m.block_knn(df, df.filter("vec_id % 20 = 0"), k=10, candidate_rows=25).count() == 1000
    assert seen.value < 0.25 * 100 * 10 * 80  # queries x k x groups, also counting what each round passes on


def test_names_and_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.5], "x"), (20, [1.0, 2.0], "y")], "vec_id int, embedding array<double>, `a.b` string").toDF("vec_id", "embedding", "EMBEDDING")
    assert [tuple(r) for r in m.block_knn(df, df).orderBy("query_id").collect()] == [(1, 1, 20, 2.0), (20, 1, 1, 2.0)]
    with pytest.raises(ValueError):
        m.block_knn(df.select(F.lit("a").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding")), df)
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        m.block_knn(mixed, mixed)


def test_bound_holds():
    r = np.random.default_rng(1)
    a, b = r.normal(size=(50, 8)), r.normal(size=(60, 8))
    qa, sa, na = m.quantised(a)
    qb, sb, nb = m.quantised(b)
    unit = sa[:, None] * sb[None, :]
    err = np.abs(a @ b.T - (qa.astype(float) @ qb.astype(float).T) * unit)
    assert (err <= unit * (0.5 * na[:, None] + 0.5 * nb[None, :] + 0.25 * 8)).all()
