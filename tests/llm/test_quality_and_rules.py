import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from lumenframe.llm import quality_gam, rule_forest, shingles, text_stats


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside |= set(range(i, i + 5))
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
        "n_repeat_words": len(inside), "n_distinct": len(set(words)), "n_top_word": max(Counter(words).values(), default=0),
        "n_same_next": sum(a == b for a, b in zip(words, words[1:])),
    }


def texts(seed, n=200):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abß€|*#AB1.!") for _ in range(r.randint(1, 5))) for _ in range(30)]
    out = ["", " ", "\n\n", "a", "a b c d e a b c d e", "x\ny\nx\n x\n", "€" * 300]
    for _ in range(n):
        out.append("".join(r.choice(vocab) + r.choice([" ", "\n", "\t", " \x0b", "\r\n", "  "]) for _ in range(int(r.paretovariate(1) * 4) % 400)))
    return out


def test_counts_against_brute_force():
    rows = texts(1)
    got = text_stats.counts([t.encode() for t in rows])
    for i, t in enumerate(rows):
        for k, v in brute_counts(t).items():
            assert got[k][i] == v, (t, k)
    x = text_stats.features(got)
    assert np.isfinite(x).all() and not x[0].any()


def labelled(spark, n=1500):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        good = r.random() < 0.8
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(15, 60))]
        rows.append((i, " ".join(words if good else [w + r.choice(["###", "$$", "|"]) for w in words])))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_quality_on_the_held_out_fold(spark):
    docs, labels, truth = labelled(spark)
    odd = spark.createDataFrame([(9000, None), (9001, ""), (9001, ""), (None, "one two three")], docs.schema)
    got = quality_gam.quality_scores(docs.unionByName(odd), labels).collect()
    assert len(got) == len(truth) + 4
    right = seen = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        if r.held_out and r.doc_id in truth:
            seen += 1
            right += r.predicted == truth[r.doc_id]
    assert seen > 200 and right >= 0.99 * seen
    again = quality_gam.quality_scores(docs.repartition(7), labels.repartition(3))
    assert {r.doc_id: round(r.score, 9) for r in again.collect()}.items() <= {r.doc_id: round(r.score, 9) for r in got}.items()


def test_quality_of_no_rows(spark):
    docs, labels, _ = labelled(spark, 30)
    assert quality_gam.quality_scores(docs.limit(0), labels).count() == 0
    assert quality_gam.quality_scores(docs, labels.limit(0)).count() == 30
    model = quality_gam.train_quality(docs, labels)
    clash = docs.selectExpr("*", "1 as score", "2 as _text", "3 as _c0")
    assert quality_gam.score_quality(clash, model).columns == ["doc_id", "text", "_text", "_c0", "score", "predicted"]


def test_pairwise_interactions_are_learned():
    r = np.random.default_rng(0)
    x = r.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit_gam(x, y, pair_rounds=60)
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


def test_rule_forest(spark):
    docs, labels, truth = labelled(spark)
    odd = spark.createDataFrame([(9000, None), (9001, "too short"), (9002, " ".join(["a b c d e f"] * 4))], docs.schema)
    both = docs.unionByName(odd)
    forest = rule_forest.train_rules(docs, labels)
    got = {r.doc_id: r for r in rule_forest.rule_verdicts(both, forest).collect()}
    for r in both.collect():
        want, g = brute_counts(r.text or ""), got[r.doc_id]
        assert [g[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == [want[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert g.base_failed == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert not (g.base_failed and g.kept)
    assert np.mean([got[i].kept for i, q in truth.items() if q]) > 0.98
    assert np.mean([got[i].kept for i, q in truth.items() if not q]) < 0.05
    assert rule_forest.rule_verdicts(docs.limit(0), forest).count() == 0
    untrained = rule_forest.train_rules(docs, labels.limit(0))
    assert rule_forest.rule_verdicts(docs, untrained).filter("kept").count() == len(truth)


@pytest.mark.parametrize("n", [1, 2, 10, 256])
def test_average_path(n):
    assert rule_forest._average_path(n) >= 0


def test_scores_against_table_lookups(spark):
    """The score of each text, looked up table by table in plain Python from statistics counted by brute force elsewhere."""
    docs, labels, _ = labelled(spark, 400)
    model = quality_gam.train_quality(docs, labels)
    got = {r.doc_id: r.score for r in quality_gam.score_quality(docs, model).collect()}
    for r in docs.collect():
        x = text_stats.features(text_stats.counts([r.text.encode()]))[0].tolist()
        bin_of = lambda cuts, v: sum(c <= v for c in cuts.tolist())
        margin = model.base + sum(t[bin_of(c, v)] for c, t, v in zip(model.cuts, model.tables, x))
        for (a, b), t in zip(model.pairs, model.pair_tables):
            margin += t[bin_of(model.pair_cuts[a], x[a])][bin_of(model.pair_cuts[b], x[b])]
        assert got[r.doc_id] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_verdicts_against_paths(spark):
    """kept, from paths walked one node at a time through each tree."""
    docs, labels, _ = labelled(spark, 400)
    forest = rule_forest.train_rules(docs, labels)
    got = {r.doc_id: r for r in rule_forest.rule_verdicts(docs, forest).collect()}
    for r in docs.limit(60).collect():
        x = rule_forest.rule_statistics(text_stats.counts([r.text.encode()]))[0]
        total = 0.0
        for feature, cut, path in zip(forest.feature, forest.cut, forest.path):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + (2 if x[feature[node]] >= cut[node] else 1)
            total += path[node]
        score = 2 ** (-total / len(forest.feature) / forest.norm)
        assert got[r.doc_id].anomaly == pytest.approx(score, abs=1e-9)
        assert got[r.doc_id].kept == (not got[r.doc_id].base_failed and score <= forest.threshold + 1e-12)


def test_paths_end_where_rows_are_alone():
    """A leaf's path is its depth and the average path of the rows in it, as a walk over the sample's rows tells."""
    x = np.random.default_rng(2).uniform(size=(300, 4))
    x[:5] += 3  # anomalies
    forest = rule_forest.grow_forest(x, trees=50, sample=64)
    score = forest.score(x)
    assert score[:5].min() > np.median(score[5:])
    for feature, path in zip(forest.feature, forest.path):
        for node in np.flatnonzero(path > 0):
            assert feature[node] == -1 and path[node] >= int(np.log2(node + 1))


def plain_threshold(score, good):
    """The threshold by trying each score."""
    best, at = -1.0, sorted(set(score))
    for i, c in enumerate(at):
        kept = sum(s <= c for s, y in zip(score, good) if y) / sum(good)
        caught = sum(s > c for s, y in zip(score, good) if not y) / (len(good) - sum(good))
        if kept >= 0.99 and kept + caught >= best - 1e-12:
            best, threshold = kept + caught, c + (at[i + 1] - c) / 2 if i + 1 < len(at) else 1.0
    return threshold


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_calibration_by_ranges_of_scores(spark, seed):
    r = random.Random(seed)
    good = [r.random() < 0.7 for _ in range(600)]
    score = [round(r.betavariate(2, 5) if y else r.betavariate(4, 3), r.choice([2, 6])) for y in good]
    df = spark.createDataFrame([(s, int(y), int(not y)) for s, y in zip(score, good)], "score double, good long, bad long")
    assert rule_forest.calibrate(df) == pytest.approx(plain_threshold(score, good), abs=1e-12)
    assert rule_forest.calibrate(df.filter("good = 1")) == rule_forest.calibrate(df.limit(0)) == 1.0


def test_forest_from_all_labelled_rows(spark):
    """What leaves hold and the threshold come from each labelled row outside the fold, however many there are."""
    r = random.Random(31)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(300)]
    rows = []
    for i in range(26_000):
        good = r.random() < 0.9
        rows.append((i, " ".join(w + "#" * (r.random() < (0.2 if good else 0.5)) for w in r.choices(vocab, k=12)), int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    forest = rule_forest.train_rules(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    own = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5]
    c = text_stats.counts([t.encode() for t, _ in own])
    fine = ~rule_forest._failed(c)
    x, good = rule_forest.rule_statistics(c)[fine], np.array([y for _, y in own])[fine] == 1
    assert len(x) > 20_000
    for t, node in enumerate(forest.leaves(x)):
        held = np.bincount(node, minlength=forest.path.shape[1]) * (256 / len(x))
        for i in np.unique(node).tolist():
            low = int(held[i])
            rest = [rule_forest._average_path(n) for n in (low, low + 1)]
            assert forest.path[t, i] == pytest.approx(int(np.log2(i + 1)) + rest[0] + (held[i] - low) * (rest[1] - rest[0]))
    score = np.round(forest.score(x), 12)
    kept = lambda at: (score[good] <= at).mean()
    caught = lambda at: (score[~good] > at).mean()
    assert kept(forest.threshold) >= 0.99
    best = max(kept(s) + caught(s) for s in np.unique(score) if kept(s) >= 0.99)
    assert kept(forest.threshold) + caught(forest.threshold) == pytest.approx(best, abs=1e-12)
    got = rule_forest.trained_verdicts(df.select("doc_id", "text"), df.select("doc_id", "quality")).filter("not base_failed").toPandas().set_index("doc_id")
    want = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert np.allclose(got.anomaly.reindex(want).dropna().to_numpy(), forest.score(x), atol=1e-9)


def test_names_of_any_kind(spark):
    docs, labels, _ = labelled(spark, 60)
    odd = docs.selectExpr("cast(doc_id as string) as doc_id", "text", "1 as `a.b`", "2 as x").toDF("doc_id", "text", "a.b", "TEXT")
    names = labels.selectExpr("cast(doc_id as string) as doc_id", "quality", "0 as q").toDF("doc_id", "quality", "a.b")
    got = quality_gam.quality_scores(odd, names)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 60
    model = quality_gam.train_quality(odd, names)
    assert quality_gam.score_quality(odd, model).columns == ["doc_id", "text", "a.b", "TEXT", "score", "predicted"]
    assert rule_forest.rule_verdicts(odd, rule_forest.train_rules(odd, names)).count() == 60


def test_long_text_in_steps(monkeypatch):
    """Counts and hashes do not depend on how many bytes are looked at together."""
    rows = [t.encode() for t in texts(6, 40)]
    want = text_stats.counts(rows)
    hashes = shingles.shingle_hashes(rows, 5)
    for module in (text_stats, shingles):
        monkeypatch.setattr(module, "STEP", 32)
    monkeypatch.setattr(shingles, "_UP", shingles._powers(shingles._B, 32))
    monkeypatch.setattr(shingles, "_DOWN", shingles._powers(shingles._B_INV, 32))
    got = text_stats.counts(rows)
    assert all((got[k] == want[k]).all() for k in want)
    assert all((a == b).all() for a, b in zip(shingles.shingle_hashes(rows, 5), hashes))


def test_memory_of_a_long_text():
    """A text of 30 MB takes less than 25 bytes for each of its own, so one of 100 MB fits an executor of 3 GB."""
    code = (
        "import random, resource; from lumenframe.llm import shingles, text_stats; r = random.Random(1);"
        "w = [''.join(r.choice('abcdefghijk') for _ in range(r.randint(2, 9))) for _ in range(50000)];"
        "t = ' '.join(r.choice(w) for _ in range(230000)).encode() * 20; peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024;"
        "before = peak(); shingles.shingle_hashes([t], 5); text_stats.counts([t]); print((peak() - before) / len(t))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(__file__).resolve().parents[2])
    assert float(out.stdout) < 25
