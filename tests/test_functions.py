from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumenframe.functions import color, geometry, text, timing


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_normalize(spark):
    rows = [("  A\t\tB \n c. D , e; F: $ 5 ! x ",), ("Éa É",), ("",), (None,)]
    got = one(spark, rows, "s string", text.normalize_text(F.col("s")), text.alphanumeric_key(F.col("s")))
    assert got[0] == ("a b c.d ,e;f:$5 !x", "abcdef5x") and got[1] == ("Éa É", "a") and got[2:] == [("", ""), (None, None)]


def test_lookalikes(spark):
    rows = [("$2.O65.512",), ("Flips: 1O43",), ("S774",), ("SOLD 4.Benjamin BOSS.",), ("lO1 S5S",)]
    got = [r[0] for r in one(spark, rows, "s string", text.read_digit_lookalikes(F.col("s")))]
    assert got == ["$2.065.512", "Flips: 1043", "S774", "SOLD 4.Benjamin BOSS.", "101 S55"]


def test_near_identical(spark):
    rows = [("ouythispark", "buythispark"), ("flips1043", "flips1044"), ("abcdefgh", "abcdefgh"), ("rentispaid", "yourrentispaidnow"), ("ab", "xyz"), ("", "")]
    got = [r[0] for r in one(spark, rows, "a string, b string", text.near_identical(F.col("a"), F.col("b")))]
    assert got == [True, False, True, True, False, True]
    sims = one(spark, [("kitten", "sitting"), ("", ""), ("abcd", "abce")], "a string, b string", text.similarity(F.col("a"), F.col("b"), 0.5), text.similarity(F.col("a"), F.col("b"), 0.9))
    assert sims[0] == (pytest.approx(1 - 3 / 7), 0.0) and sims[1] == (1.0, 1.0) and sims[2] == (0.75, 0.0)


def test_better_reading(spark):
    rows = [("ab", "a"), ("", "abc"), ("abc", "abc"), ("abcd", "abcde"), ("abc", "zzzzzzz"), ("abcd", "xabcdyy"), ("abcd", "zzzzzzzz")]
    assert [r[0] for r in one(spark, rows, "a string, b string", text.roi_text_is_better(F.col("a"), F.col("b")))] == [False, True, False, False, True, True, False]


def test_numbers():
    found = [(n["raw_text"], n["numeric_value"], n["number_kind"], n["unit"]) for n in text.numbers_in("Paid $1,234. 50 of 12,000 on March 3, 2021 at 3.5")]
    assert found == [("$1,234. 50", "1234.50", "decimal", "currency_unknown"), ("12,000", "12000", "decimal", None), ("3.5", "3.5", "decimal", None), ("3", "3", "integer", None), ("2021", "2021", "integer", None)]
    assert text.numbers_in("7 apples") == [] and text.numbers_in(None) == []


def test_token_matches(spark):
    assert text.longest_common_run(list("abxcd"), list("zabycd")) == (3, 4, 2)  # of equals, the one that ends last in b
    assert text.longest_common_run(list("abxab"), list("ab")) == (0, 0, 2)  # and then first in a
    assert text.longest_common_run(["", "a"], ["", "a"]) == (1, 1, 1) and text.longest_common_run([], ["a"]) == (0, 0, 0)
    assert len(text.common_subsequence(list("ABCBDAB"), list("BDCABA"))) == 4
    assert one(spark, [(["a", "b", "c"], ["b", "c", "d"])], "a array<string>, b array<string>", text.token_lcs("a", "b")) == [(2,)]
    vocab = {k: i for i, k in enumerate("[CLS] [SEP] [UNK] un ##aff ##able ,".split())}
    got = one(spark, [("Unaffable, zz",)], "s string", text.word_pieces(vocab)("s"))
    assert got == [([0, 3, 4, 5, 6, 2, 1],)]


def test_time(spark):
    rows = [(Decimal(5), 2), (Decimal(7), 2), (Decimal(-5), 2), (Decimal(-7), 2), (Decimal(10**30 + 1), 2), (Decimal(4), 3)]
    got = one(spark, rows[:4] + rows[5:], "n decimal(38,0), d int", timing.divide_half_even(F.col("n"), F.col("d")))
    assert [r[0] for r in got] == [2, 4, -2, -4, 1]
    secs = one(spark, [(0,), (1_500_000,), (-1,), (12_345_678,), (1_000_100,)], "us long", timing.microseconds_to_seconds(F.col("us")))
    assert [r[0] for r in secs] == ["0.000", "1.500", "-0.000001", "12.345678", "1.0001"]
    assert [r[0] for r in one(spark, [(2.5,), (-2.5,), (0.4,)], "x double", timing.round_half_away(F.col("x")))] == [3.0, -3.0, 0.0]


def test_colours(spark):
    rows = [(0, 0, 0), (255, 255, 255), (128, 128, 128), (255, 0, 0), (0, 255, 0), (0, 0, 255), (255, 255, 0), (139, 69, 19)]
    c = color.srgb8_to_oklch(*[F.col(x).cast("double") for x in "rgb"])
    got = one(spark, rows, "r int, g int, b int", color.color_bucket(c["l"], c["c"], c["h"]))
    assert [r[0] for r in got] == ["black", "white", "gray", "orange", "green", "blue", "green", "brown"]


def test_boxes(spark):
    a, b = F.col("a"), F.col("b")
    rows = [([0.0, 0, 2, 2], [1.0, 1, 3, 3]), ([0.0, 0, 1, 1], [1.0, 0, 2, 1]), ([0.0, 0, 4, 4], [1.0, 1, 2, 2]), ([0.0, 0], [0.0, 0, 1, 1])]
    rows = [([float(v) for v in x], [float(v) for v in y]) for x, y in rows]
    got = one(spark, rows, "a array<double>, b array<double>", geometry.box_iou(a, b), geometry.box_iom(a, b), geometry.box_contains(a, b), geometry.center_distance(a, b))
    assert got[0][:2] == (pytest.approx(1 / 7), 0.25) and got[1][:2] == (0.0, 0.0) and got[2][1:3] == (1.0, True) and got[3] == (0.0, 0.0, False, 1.0)
    assert one(spark, [([1.0, 0.0], [1.0, 1.0]), ([0.0], [1.0]), ([], [])], "a array<double>, b array<double>", geometry.cosine_similarity(a, b)) == [(pytest.approx(0.5**0.5),), (-1.0,), (-1.0,)]
