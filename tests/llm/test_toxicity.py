import math
import random
import time

from lumenframe.llm import toxicity as m


def test_folding():
    assert m.fold("1d10t").strip() == "idiot"
    assert m.fold("STÜPІD").strip() == "stupid"  # with a Cyrillic letter
    assert m.fold("st​up­id!").strip() == "stupid"
    assert m.fold("lo$er.").strip() == "loser"


def rows(seed, n=1200):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghilmnoprst") for _ in range(r.randint(2, 8))) for _ in range(400)]
    bad = ["vermisch", "clodpole", "gormless"]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.randint(10, 80))]
        toxic = r.random() < 0.25
        if toxic:
            for _ in range(r.randint(1, 3)):
                w = r.choice(bad) + r.choice(["", "ing", "s", "ed"])
                w = w.replace("o", "0") if r.random() < 0.3 else w.upper() if r.random() < 0.2 else w
                words.insert(r.randrange(len(words)), w)
        elif r.random() < 0.2:
            words[3:3] = ["saint", "clodpole"]  # a harmless phrase with a toxic word
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out(spark):
    docs, labels = rows(3)
    df, lf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = m.toxicity_scores(df, lf).collect()
    truth = dict(labels)
    test = [r for r in got if r.held_out]
    assert len(got) == len(docs) and len(test) > 150
    right = sum(r.predicted == truth[r.doc_id] for r in test)
    assert right >= 0.97 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    lexicon = m.train_toxicity(df, lf)
    assert any("saint clodpole" in e for e in lexicon.exceptions)
    assert lexicon.hits(m.fold("the saint clodpole came"))[1] == 0 and lexicon.hits(m.fold("you cl0dpole"))[1] == 1


def test_matching_against_brute_force():
    r = random.Random(8)
    entries = {" ab": 1.0, " abc": 2.5, " b ": 0.5, " cab": 3.0}
    lexicon = m.Lexicon(entries, [" b cab ", " abcc "])
    for _ in range(400):
        text = " " + " ".join("".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(8)) + " "
        covered = [(i, i + len(e) - 1) for e in lexicon.exceptions for i in range(len(text)) if text.startswith(e, i)]
        best = {}
        for e, w in entries.items():
            for i in range(len(text)):
                if text.startswith(e, i) and not any(a <= i < b for a, b in covered):
                    best[i] = max(best.get(i, 0), w)
        total, n = lexicon.hits(text)
        assert (round(total, 9), n) == (round(sum(best.values()), 9), len(best))


def test_odd_rows(spark):
    docs, labels = rows(5, 60)
    lf = spark.createDataFrame(labels, "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x " * 100_000)], "doc_id long, text string").selectExpr("*", "1 as score", "2 as _text", "'q' as hits")
    got = m.toxicity_scores(odd, lf).collect()
    assert len(got) == 4 and all(r.predicted == 0 for r in got)
    assert m.toxicity_scores(odd.limit(0), lf).count() == 0
    assert m.toxicity_scores(odd, lf.limit(0)).filter("predicted = 0").count() == 4


def test_score_from_weights_and_length(spark):
    lexicon = m.Lexicon({" ab": 1.5, " cd ": 2.0}, [" ab cd "], (-2.0, 1.5, 0.25))
    df = spark.createDataFrame([(1, "ab x cd"), (2, "x y"), (3, "ab cd")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in m.score_toxicity(df, lexicon).collect()}
    z = -2.0 + 1.5 * math.log1p(3.5) + 0.25 * math.log1p(100 * 3.5 / 4)  # five spaces would be four words and both ends
    assert abs(got[1] - 1 / (1 + math.exp(-z))) < 1e-9
    assert got[2] == 1 / (1 + math.exp(2.0))
    assert got[3] == got[2]  # the phrase covers both


def test_every_entry_that_qualifies_is_kept():
    toxic = {f" entry{i:05d} ": 20 for i in range(30_000)}
    assert len(m.choose(toxic, {}, 100, 100)) == 30_000


def test_many_hits_and_exceptions_take_linear_time():
    lexicon = m.Lexicon({" bad": 1.0}, [" not bad "])
    began = time.perf_counter()
    assert lexicon.hits(" not bad" * 100_000 + " bad ") == (1.0, 1)
    assert time.perf_counter() - began < 10


def test_names_of_any_kind(spark):
    docs, labels = rows(5, 60)
    df = spark.createDataFrame([(str(i), t, 1, 2) for i, t in docs], "doc_id string, text string, a int, b int").toDF("doc_id", "text", "a.b", "Score")
    lf = spark.createDataFrame([(str(i), y) for i, y in labels], "doc_id string, toxic int")
    assert m.toxicity_scores(df, lf).count() == 60
    assert m.score_toxicity(df, m.Lexicon({})).columns == ["doc_id", "text", "a.b", "score", "predicted", "weight", "hits"]
