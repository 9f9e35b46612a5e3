import random

import pytest

from lumenframe.llm import source_mix
from tests.llm.test_jaccard_join import brute as brute_links
from tests.llm.test_suffix_dedup import brute as brute_spans

pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    r = random.Random(6)
    vocab = ["".join(r.choice("abcdefgé") for _ in range(r.randint(2, 8))) for _ in range(500)]
    base = [[r.choice(vocab) for _ in range(90)] for _ in range(12)]
    shared = " ".join(r.choice(vocab) for _ in range(35))
    rows, labels = [], []
    for i in range(400):
        w = list(r.choice(base)) if r.random() < 0.3 else [r.choice(vocab) for _ in range(r.randint(12, 90))]
        if r.random() < 0.4:
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.2:
            w.insert(len(w) // 2, shared)
        good = r.random() < 0.75
        text = " ".join(w if good else [x + "###" for x in w])
        rows.append((i, text, "en", r.choice(["a", "b", None]), len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    out.append(docs.orderBy("doc_id").collect())
    for i, (_, f) in enumerate(pipeline.STAGES):
        f(spark, docs, d).write.parquet(f"{d}/out{i}")
        docs = spark.read.parquet(f"{d}/out{i}")
        if i + 1 < len(pipeline.STAGES):
            assert docs.columns == list(pipeline.COLUMNS)
        out.append(docs.collect())
    return spark, d, out


def test_stages(stages):
    _, _, (docs, good, one, cut, mix, ids) = stages
    assert {r.doc_id for r in good} == {r.doc_id for r in docs if "###" not in r.text}
    rows = sorted((r.doc_id, r.text) for r in good)
    assert {r.doc_id for r in one} == {d for d, _, top in brute_links(rows) if d == top}
    rows = sorted((r.doc_id, r.text) for r in one)
    want = {d: n - gone for (d, _), (n, gone, _, _) in zip(rows, brute_spans(rows, 100))}
    assert sorted(want) == sorted(r.doc_id for r in cut)
    for r in cut:
        assert 0 <= want[r.doc_id] - len(r.text.encode()) <= 2 * 2 and r.n_chars == len(r.text)
    taken = {}
    for r in mix:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    size = {r.doc_id: len(r.text.split()) for r in cut}
    assert all(0 < n <= 2 * size[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 0.02 * sum(size.values())
    assert sorted((r.doc_id, r.n_chars) for r in ids) == sorted((r.doc_id, r.n_chars) for r in mix)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in ids)


def test_run(stages):
    spark, d, out = stages
    got = pipeline.run(spark, d).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((r.doc_id, r.n_tokens) for r in out[-1])
    assert source_mix.mixed_documents(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_stages_on_odd_rows(spark, tmp_path):
    t = "a good long line of plain words that goes on and on until there are more than enough of them here"
    rows = [(None, t, "en", None, None), (1, None, None, "a", 0), (2, "", "en", "a", 0), (3, t, "en", "b", 5), (3, t, "en", "b", 5), (3, t + " end", None, "b", None), (4, "x " * 60_000, "en", "b", 1), (5, "é" * 5000, "de", None, 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(3, None, 0), (3, 1, None), (None, 1, 1), (4, 0, 0), (77, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for n, docs in enumerate((spark.createDataFrame(rows, schema), spark.createDataFrame([], schema))):
        docs = docs.withColumns({"_rid": source_mix.F.lit(1), "rid": source_mix.F.lit(2), "score": source_mix.F.lit("x")})
        for i, (_, f) in enumerate(pipeline.STAGES):
            f(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"odd{n}_{i}"))
            docs = spark.read.parquet(str(tmp_path / f"odd{n}_{i}"))
        assert docs.count() == 0 if n else docs.filter("not round_trip").count() == 0
    kept = spark.read.parquet(str(tmp_path / "odd0_1"))
    assert kept.filter("doc_id = 3").count() == 0 and kept.filter("doc_id is null").count() == 1  # one of the equal texts stays
