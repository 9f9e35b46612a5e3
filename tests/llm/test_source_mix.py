import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import source_mix as m


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        level = (goal - sum(2 * sizes[s] for s in full)) / sum(w[s] for s in rest) if rest else 0
        over = [s for s in rest if w[s] * level > 2 * sizes[s]]
        if not over:
            return {s: 2 * sizes[s] if s in full else w[s] * level for s in names}
        full |= set(over)


def brute_taken(df, sizes, want):
    """Words of each document in the first floor(target + 1/2) words of its source's shuffled words, gone through twice."""
    subs = max(16, math.isqrt(df.count()))
    rows = [(r, int(hashlib.md5(f"7|{r.doc_id}|{r.text or ''}".encode()).hexdigest()[:15], 16)) for r in df.collect()]
    out = {}
    for source in sizes:
        mine = [r for r, h in sorted(((r, h) for r, h in rows if r.source == source), key=lambda x: (x[1] % subs, x[1], x[0].doc_id))]
        stream = [r.doc_id for r in mine for _ in re.findall(r"[^\x20\x09-\x0D]+", r.text or "")]
        for r in mine:
            out[r.doc_id] = 0
        for i in range(math.floor(want[source] + 0.5)):
            out[stream[i % len(stream)]] += 1
    return out


def test_schedule(spark):
    """Every block of every source has one slot, and any stretch of slots holds each source by its share."""
    counts = [700, 3, 250, 1, 0, 46]
    lo = [sum(counts[:i]) for i in range(len(counts))]
    sources = spark.createDataFrame([(i, a, a + n) for i, (a, n) in enumerate(zip(lo, counts))], "sr int, lo long, hi long")
    got = sorted((r.slot, r.sr, r.block) for r in m._schedule(sources, 1000, 256).collect())
    assert [s for s, _, _ in got] == sorted({s for s, _, _ in got}) and len(got) == 1000
    for sr, n in enumerate(counts):
        assert [b for _, s, b in got if s == sr] == list(range(n))
    bits = spark.range(8).select(m.reversed_bits(F.col("id"), 3)).collect()
    assert [r[0] for r in bits] == [0, 4, 2, 6, 1, 5, 3, 7]
    for end in range(50, 1000, 50):
        first = [sr for _, sr, _ in got[:end]]
        for sr, n in enumerate(counts):
            assert abs(first.count(sr) - n * end / 1000) <= 6


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 16)])
def test_mix(spark, seed, block):
    r = random.Random(seed)
    rows = []
    for i in range(700):
        text = None if r.random() < 0.02 else " \n".join("w" for _ in range(int(r.paretovariate(1) * 20) % 3000))
        rows.append((i, text, "big" if r.random() < 0.4 else r.choice(["a", "b", "ä", "", None, "zz", "tiny"] if i % 50 else ["rare"])))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = {x.doc_id: x for x in m.mix_sources(df, block=block).collect()}
    assert sorted(got) == [i for i, _, _ in rows]
    sizes, taken = {}, {}
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert got[i].size == n and 0 <= got[i].taken <= 2 * n
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + got[i].taken
    want = targets(sizes)
    for i, _, s in rows:
        assert got[i].source_size == sizes[s]
        assert got[i].target == pytest.approx(want[s])
    for s in sizes:  # also for sources of a few words among large ones
        assert taken[s] == math.floor(want[s] + 0.5), s
    assert {i: x.taken for i, x in got.items()} == brute_taken(df, sizes, want)
    again = {x.doc_id: x.taken for x in m.mix_sources(df.repartition(3), block=block).collect()}
    assert again == {i: x.taken for i, x in got.items()}


def test_documents_of_the_mix(spark):
    rows = [(i, "  " * (i % 2) + "\n ".join(f"w{i}_{j}" for j in range(i % 17)) + "\t", f"s{i % 3}", i) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, sr int")
    taken = {x.doc_id: x.taken for x in m.mix_sources(df).collect()}
    words = {}
    for x in m.mixed_documents(df).collect():
        assert x.sr == x.doc_id and rows[x.doc_id][1].startswith(x.text)
        words[x.doc_id] = words.get(x.doc_id, 0) + len(x.text.split())
    assert words == {i: t for i, t in taken.items() if t}


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b", None), (1, "c", "x"), (1, "c", "x"), (2, None, None)], "doc_id long, text string, source string")
    got = m.mix_sources(df).collect()
    assert sorted(x.size for x in got) == [0, 1, 1, 2]
    assert m.mix_sources(df.limit(0)).count() == 0
    assert m.mix_sources(df.filter("text is null")).first().taken == 0


def test_ids_and_names_of_any_kind(spark):
    df = spark.createDataFrame([("b", "x y", "s", 1, 2), ("a", "x y z", "s", 3, 4), ("a", None, "t", 5, 6)], "doc_id string, text string, source string, `a.b` int, Text2 int")
    assert sorted((r.doc_id, r.size) for r in m.mix_sources(df).collect()) == [("a", 0), ("a", 3), ("b", 2)]
    clash = df.toDF("doc_id", "text", "source", "a.b", "TEXT")
    out = m.mixed_documents(clash)
    assert out.columns == clash.columns and sum(len(r[1].split()) for r in out.collect()) == 8  # of 5 words, one and a half times
    assert m.mix_sources(df.selectExpr("cast(doc_id = 'a' as double) / 3 as doc_id", "text", "source")).count() == 3
