import random
import re

import pytest

from lumenframe.llm import jaccard_join as m


def tokens(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [tokens(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return [(d, len(s), rows[find(i)][0]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def corpus(seed, n=250):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdXYé") for _ in range(r.randint(1, 5))) for _ in range(200)]
    passage = [r.choice(vocab) for _ in range(40)]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 6, 9, 30, 80, 150]))] for _ in range(14)]
    rows = []
    for i in range(n):
        k = r.random()
        if k < 0.6:
            w = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                w[r.randrange(len(w))] = r.choice(vocab)
            if r.random() < 0.3:
                w = w[: max(1, int(len(w) * r.uniform(0.7, 1)))]
        elif k < 0.75:
            w = passage + [r.choice(vocab) for _ in range(r.choice([0, 1, 5, 12, 20]))]
        elif k < 0.8:
            w = [r.choice(vocab) for _ in range(r.randint(0, 5))]
        else:
            w = [r.choice(vocab) for _ in range(60)]
        rows.append((i * 3, r.choice([" ", "\n", "\t \x0b"]).join(w) if r.random() > 0.03 else None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(df).collect())
    assert got == brute(rows)


def test_odd_rows(spark):
    t = "one two three four five six seven"
    rows = [(4, t), (4, t), (9, t.upper()), (4, "x"), (7, "X"), (None, "q r"), (8, ""), (6, None), (5, "q\tr")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as rid", "1 as n", "'z' as toks")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_shingles, r.component_id) for r in m.jaccard_components(df).collect())
    assert got == [(False, 0, 1, None), (True, 4, 1, 4), (True, 4, 3, 4), (True, 4, 3, 4), (True, 5, 1, None), (True, 6, 0, 6), (True, 7, 1, 4), (True, 8, 0, 8), (True, 9, 3, 4)]
    assert m.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    from lumenframe.llm.components import components

    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    want = sorted((v, find(v)) for v in top)
    got = sorted((r.v, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == want


def test_shingle_in_every_document(spark, monkeypatch):
    """Parts send a shingle that many of their documents share once, and answers reach all of these documents."""
    r = random.Random(11)
    vocab = [f"v{i}" for i in range(40)]
    head = [r.choice(vocab) for _ in range(30)]
    rows = [(i, " ".join(head + [r.choice(vocab) for _ in range(r.choice([0, 3, 8, 14]))])) for i in range(150)]
    monkeypatch.setattr(m, "BATCH", 2000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in m.jaccard_components(df).collect()) == sorted(brute(rows))
    part = m._part([i for i, _ in rows], [t.encode() for _, t in rows], 5, 7).to_pylist()
    sent = [m.unpack(x["data"]) for x in part if x["kind"] == m.TOKENS]
    distinct = {t for _, text in rows for t in tokens(text)}
    assert sum((one.size + some.size) // 7 for _, _, _, one, some, _ in sent) == len(distinct)


def test_ids_and_names_of_any_kind(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([("b", t, "x"), ("a", t, "y"), ("c", "z", None)], "doc_id string, text string, `a.b` string").toDF("doc_id", "text", "TEXT")
    assert {x.doc_id: x.component_id for x in m.jaccard_components(df).collect()} == {"a": "a", "b": "a", "c": "c"}
    kept = m.keep_one_of_each(df)
    assert kept.columns == df.columns and sorted(x[0] for x in kept.collect()) == ["a", "c"]
