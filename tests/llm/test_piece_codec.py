import os
import random

import numpy as np
import pytest

from lumenframe.llm import piece_codec as m

PATH = "/opt/tokenizers/piece_bpe_32k.model"
needs_model = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


def texts(seed, n=1500):
    r = random.Random(seed)
    out = [" " * k for k in range(40)] + ["a" + " " * k + "b" for k in range(40)] + [" " * k + "\n" + " " * k for k in range(20)] + ["a" * 3000, "é" * 200]
    return out + ["".join(r.choice("   abcTheinng▁\n\t.,é中ﬁ😀<0x>A1\0") for _ in range(r.randint(0, 60))) for _ in range(n)]


@needs_model
def test_same_ids_as_the_library():
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PATH)
    codec = m.Codec(m.PieceModel.load(PATH))
    rows = texts(1)
    for _ in range(2):  # the second time from known words
        for t, p in zip(rows, codec.encode(rows)):
            ids = np.frombuffer(p, np.int32)
            assert ids.tolist() == sp.encode(t), t
            assert codec.decode(ids) == t.replace(m.MARK, " ")


def unigram():
    r = random.Random(2)
    pieces = {"▁", *"abc", "▁a", "ab", "abc", "bc", "ca", "▁ab", "cab", "bca"}
    rows = [("<unk>", 0.0, m.UNKNOWN)] + [(p, -r.uniform(1, 9), m.NORMAL) for p in sorted(pieces)]
    return m.PieceModel([p for p, _, _ in rows], [s for _, s, _ in rows], [k for _, _, k in rows], m.UNIGRAM).indexed()


def test_unigram_is_the_best_path():
    model = unigram()
    codec = m.Codec(model)

    def best(word):
        table = [0.0] + [float("-inf")] * len(word)
        for i in range(1, len(word) + 1):
            for j in range(i):
                k = model.index.get(word[j:i])
                s = model.scores[k] if k is not None else codec.floor if i - j == 1 else float("-inf")
                table[i] = max(table[i], table[j] + s)
        return table[-1]

    r = random.Random(3)
    words = sorted({"▁" + "".join(r.choice("abcx") for _ in range(r.randint(0, 9))) for _ in range(300)})
    for word, ids in codec.sorted_words(words):
        assert "".join(model.pieces[k] if k >= 0 else chr(-1 - k) for k in ids) == word
        assert sum(model.scores[k] if k >= 0 else codec.floor for k in ids) == pytest.approx(best(word))


@needs_model
def test_tables(spark):
    model = m.PieceModel.load(PATH)
    df = spark.createDataFrame([(1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, None), (3, "", "y"), (None, "ab\n c", "z")], "doc_id long, text string, ids string")
    got = m.encode_pieces(df, model)
    assert got.columns == ["doc_id", "text", "ids", "n_tokens", "round_trip"]
    rows = got.collect()
    assert [r.n_tokens for r in rows] == [2, 2, 0, 0, 3] and all(r.round_trip for r in rows)
    back = m.decode_pieces(got, model).collect()
    assert [r.decoded for r in back] == ["Hello world", "Hello world", "", "", "ab\n c"]
    assert m.encode_pieces(df.limit(0), model).count() == 0


@needs_model
def test_ids_outside_the_model_raise():
    codec = m.Codec(m.PieceModel.load(PATH))
    for ids in ([-1], [len(codec.text)], [5, -7]):
        with pytest.raises(ValueError):
            codec.decode(np.array(ids, np.int64))
    assert codec.decode(np.zeros(0, np.int64)) == ""


def test_pieces_that_reach_over_a_cut_are_refused():
    def field(number, body):
        return bytes([number << 3 | 2, len(body)]) + body

    def model(*pieces):
        return b"".join(field(1, field(1, p.encode())) for p in pieces)

    assert m.PieceModel.parse(model("a", "▁a", "▁▁")).pieces == ["a", "▁a", "▁▁"]
    for odd in ("a▁", "a▁b", "a\nb"):
        with pytest.raises(ValueError):
            m.PieceModel.parse(model("a", odd))


@needs_model
def test_names_of_any_kind(spark):
    df = spark.createDataFrame([(1, "Hello world", "x", 2)], "doc_id long, text string, a string, b int").toDF("doc_id", "text", "a.b", "IDS")
    got = m.encode_pieces(df, m.PieceModel.load(PATH))
    assert got.columns == ["doc_id", "text", "a.b", "ids", "n_tokens", "round_trip"]
    assert m.decode_pieces(got, m.PieceModel.load(PATH), out_col="A.B").columns == ["doc_id", "text", "ids", "n_tokens", "round_trip", "A.B"]
