import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from lumenframe.llm import suffix_dedup as m


def brute(rows, length):
    """rows: (id, text or None) in order."""
    seen, out = set(), []
    for _, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            s = body[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    base = [" ".join(r.choice(words) for _ in range(r.randint(1, 160))) for _ in range(8)]
    rows = []
    for i in range(n):
        k = r.random()
        if k < 0.35:
            t = r.choice(base)
        elif k < 0.6:
            b = r.choice(base)
            a = r.randrange(len(b))
            t = " ".join(r.choice(words) for _ in range(20)) + b[a : a + 300] + " ".join(r.choice(words) for _ in range(20))
        elif k < 0.7:
            t = r.choice("ax") * r.randint(0, 400)
        elif k < 0.75:
            t = r.choice([None, "", "short"])
        elif k < 0.85:
            t = (r.choice(base)[:37] + " ") * 9
        else:
            t = " ".join(r.choice(words) for _ in range(120))
        rows.append((i, t))
    return rows


@pytest.mark.parametrize("seed,length,small", [(1, 100, False), (2, 100, True), (3, 48, True), (4, 71, True)])
def test_against_brute_force(spark, monkeypatch, seed, length, small):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if small:  # many parts, one bucket group at a time
        monkeypatch.setattr(m, "BATCH", 1500)
        monkeypatch.setattr(m, "SUFFIXES", 64)
        monkeypatch.setattr(m, "BLOCK", 700)
    got = m.suffix_dedup(df, length=length).orderBy("doc_id").collect()
    want = brute(rows, length)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want
    for r, (_, t) in zip(got, rows):
        body = (t or "").encode()
        for a, b in reversed(list(zip(r.removed[::2], r.removed[1::2]))):
            body = body[:a] + body[b:]
        assert bytes(r.kept) == body


def test_odd_rows(spark):
    text = "the same long sentence is told here again and again without any change, word for word, as it was told before"
    rows = [(None, text), (5, text), (5, text + "!"), (5, text), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rid", "2 as _spans", "3 as n_bytes")
    got = m.suffix_dedup(df).collect()
    by = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in got)
    n = len(text)
    assert by == [(False, 0, n, 0), (True, 2, 0, 0), (True, 5, n, n), (True, 5, n, n), (True, 5, n + 1, n)]
    assert m.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_passage_in_every_document(spark, monkeypatch):
    """A bucket that all parts ship to takes their copies in bites, and what it holds does not grow with them."""
    r = random.Random(9)
    passage = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    rows = [(i, f"{r.random()} {passage} {r.random()}") for i in range(400)]
    monkeypatch.setattr(m, "BATCH", 600)
    monkeypatch.setattr(m, "BITE", 4000)
    got = m.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).orderBy("doc_id").collect()
    assert [(x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got] == brute(rows, 100)

    held = []
    plain_load = m._Records.load
    monkeypatch.setattr(m._Records, "load", staticmethod(lambda blocks, length: held.append(sum(map(m.plain_size, blocks))) or plain_load(blocks, length)))
    part = lambda i: m._Records(*(np.array([v], t) for v, t in ((77, np.uint64), (i, np.int64), (5, np.int64), (3, np.int64), (2, np.int64))), np.frombuffer(passage[:102].encode(), np.uint8), np.array([0]))
    blocks = [part(i).blocks(100) for i in range(1, 2000)]
    batch = pa.RecordBatch.from_arrays([pa.array([4] * len(blocks), pa.int32()), pa.nulls(len(blocks), pa.int64()), pa.array(blocks, pa.binary())], names=["bucket", "rid", "data"])
    rids = [x for b in m._sort_buckets(100, 8)(iter([batch])) for x in b.column(0).to_pylist()]
    assert sorted(rids) == list(range(2, 2000)) and max(held) < 5000


def test_ids_and_names_of_any_kind(spark):
    text = "the same long sentence is told here again and again without any change, word for word, as it was told before"
    df = spark.createDataFrame([("b", text, 1), ("a", text, 2)], "doc_id string, text string, `a.b` int").toDF("doc_id", "text", "TEXT")
    assert {x.doc_id: x.n_removed for x in m.suffix_dedup(df).collect()} == {"a": 0, "b": len(text)}
    odd = spark.createDataFrame([(1.7, text), (1.5, text)], "doc_id double, text string")
    assert {x.doc_id: x.n_removed for x in m.suffix_dedup(odd).collect()} == {1.5: 0, 1.7: len(text)}


def test_cover():
    for a in range(m.COVER_PERIOD):
        for b in range(m.COVER_PERIOD):
            d = m._SHIFT[a, b]
            assert (a + d) % m.COVER_PERIOD in m.COVER and (b + d) % m.COVER_PERIOD in m.COVER
