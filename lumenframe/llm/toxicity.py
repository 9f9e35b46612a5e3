"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding maps look-alike letters, accents and digits that stand for letters to plain a-z, and everything else to a
space. The lexicon (beginnings of words, and whole words) and its weights are learned from labelled rows, and so are
exception phrases: longer matches whose rows are labelled as clean. A score comes from the summed weights and from
their share of the text's length.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fit_rows, held_out, kept_columns, place, plain

MAX_FIT_ROWS = 20_000  # labelled rows at most that lexicon and weights are learned from
MIN_ROWS = 3  # toxic rows that an entry needs
SHORTEST, LONGEST = 4, 10  # letters of a beginning

#: Letters that look alike, and digits and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t", "ß": "ss", "æ": "ae", "œ": "oe",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
#: Characters that vanish: soft hyphen, zero-width ones, combining marks.
VANISH = {"­", "​", "‌", "‍", "⁠", "﻿"}


class _Fold(dict):
    def __missing__(self, code: int) -> str:
        ch = chr(code)
        out = ""
        for c in unicodedata.normalize("NFKD", ch).lower():
            if c in VANISH or unicodedata.combining(c):
                continue
            c = LOOKALIKES.get(c, c)
            out += c if c.isalpha() else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Folded text: words of letters between single or more spaces, with a space at either end."""
    return f" {text.translate(_FOLD)} "


def _entries(word: str) -> Iterator[str]:
    """Lexicon entries that a folded word would match: its beginnings, and itself."""
    for n in range(SHORTEST, min(LONGEST, len(word) - 1) + 1):
        yield " " + word[:n]
    if len(word) >= SHORTEST - 1:
        yield f" {word} "


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    coef: tuple[float, ...] = (-4.0, 2.0, 0.5)
    _machine: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "coef": self.coef, "_machine": None}

    def machine(self):
        if self._machine is None:
            m = ahocorasick.Automaton()
            for k, w in self.weights.items():
                m.add_word(k, (w, len(k)))
            for k in self.exceptions:
                m.add_word(k, (None, len(k)))
            m.make_automaton()
            self._machine = m
        return self._machine

    def hits(self, folded: str) -> tuple[float, int]:
        """Sum of weights and number of words hit; a word counts once, with its heaviest entry, unless an exception covers it."""
        if not self.weights:
            return 0.0, 0
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (w, n) in self.machine().iter(folded):
            start = end - n + 1
            if w is None:
                covered.append((start, end))
            elif w > best.get(start, 0.0):
                best[start] = w
        if covered:
            covered.sort()
            first = [a for a, _ in covered]
            reach = list(accumulate((b for _, b in covered), max))
            best = {s: w for s, w in best.items() if not (i := bisect_right(first, s)) or reach[i - 1] <= s}
        return sum(best.values()), len(best)

    def score(self, total: float, words: int) -> float:
        a, b, c = self.coef
        if total <= 0:
            return float(1.0 / (1.0 + np.exp(-min(a, 0.0))))
        z = a + b * np.log1p(total) + c * np.log1p(100.0 * total / max(1, words))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))


def _texts(batch: pa.RecordBatch, at: int = 0) -> Iterator[str]:
    for t in batch.column(at):
        yield t.as_buffer().to_pybytes().decode("utf-8", "replace") if t.is_valid else ""


def _emit_counts(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["entry", "rows"])


def _count(known: frozenset | None, spill: int = 400_000):
    """Rows in which each entry occurs; only known ones if given. Counts are summed a part at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                seen = {e for w in set(fold(text).split()) for e in _entries(w)}
                counts.update(seen if known is None else seen & known)
                if len(counts) > spill:
                    yield _emit_counts(counts)
                    counts = Counter()
        if counts:
            yield _emit_counts(counts)

    return run


def _phrases(lexicon: Lexicon):
    """(phrase, toxic rows, clean rows) of the words that the lexicon hits, alone and with a neighbour on either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(_texts(batch), batch.column(1).to_pylist()):
                words, seen = fold(text).split(), set()
                for i, w in enumerate(words):
                    if lexicon.hits(f" {w} ")[1]:
                        seen.add(f" {w} ")
                        if i:
                            seen.add(f" {words[i - 1]} {w} ")
                        if i + 1 < len(words):
                            seen.add(f" {w} {words[i + 1]} ")
                for p in seen:
                    counts.setdefault(p, [0, 0])[1 - y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
            names=["entry", "toxic", "clean"],
        )

    return run


def _hit_rows(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(*lexicon.hits(f := fold(t)), f.count(" ")) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.int64()), batch.column(1)], names=["total", "words", "y"])

    return run


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries at least 20 times as frequent in toxic rows as in clean ones (smoothed); weight: log of that ratio.

    A longer entry is left out where a shorter one already covers all but a few of the clean rows' difference."""
    out: dict[str, float] = {}
    share = max(n_toxic, 1) / max(n_clean, 1)
    for e in sorted(toxic, key=lambda e: (len(e), e)):
        t, c = toxic[e], clean.get(e, 0)
        if t < MIN_ROWS:
            continue
        w = float(np.log((t + 0.5) / ((c + 0.5) * share)))
        if w < np.log(20.0) or t < 4 * c:
            continue
        if any(out.get(e[:n], 0.0) >= 0.9 * w for n in range(SHORTEST + 1, len(e))):
            continue
        out[e] = w
    return out


def _calibrated(total: np.ndarray, words: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic weights for (1, log total, log density), by damped Newton steps with a small ridge."""
    x = np.stack([np.ones(total.size), np.log1p(total), np.where(total > 0, np.log1p(100 * total / np.maximum(words, 1)), 0.0)], 1)
    b = np.zeros(3)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (mu * (1 - mu))[:, None]).T @ x + np.diag([1e-3, 1e-1, 1e-1])
        step = np.linalg.solve(h, x.T @ (y - mu) - np.array([1e-3, 1e-1, 1e-1]) * b)
        b = b + np.clip(step, -2, 2)
    return tuple(float(v) for v in b)


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Lexicon:
    """Learn entries, weights and exceptions from at most `max_rows` labelled rows outside the held-out fold.

    The lexicon holds every entry that qualifies; their number is bounded by the training rows' words alone."""
    rows = fit_rows(docs, labels, label, max_rows, id_col, text_col).select("text", "y").persist()
    try:
        n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
        n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
        if not n_toxic or not n_clean:
            return Lexicon({})
        count = lambda y, known: (
            rows.filter(F.col("y") == y).select("text").mapInArrow(_count(known), "entry string, rows long").groupBy("entry").agg(F.sum("rows").alias("rows"))
        )
        # No more entries reach the driver than toxic rows times words a row, divided by MIN_ROWS; max_rows bounds that.
        toxic = {r["entry"]: r["rows"] for r in count(1, None).filter(F.col("rows") >= MIN_ROWS).toLocalIterator()}
        clean = {r["entry"]: r["rows"] for r in count(0, frozenset(toxic)).collect()}
        lexicon = Lexicon(choose(toxic, clean, n_toxic, n_clean))
        phrases = rows.mapInArrow(_phrases(lexicon), "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        odd = phrases.filter("clean >= 3 and clean > 4 * toxic").collect()
        lexicon.exceptions = sorted(r["entry"] for r in odd if r["entry"] not in lexicon.weights)
        got = rows.mapInArrow(_hit_rows(lexicon), "total double, words long, y int").toArrow()
        total, words, y = (got.column(c).to_numpy().astype(float) for c in ("total", "words", "y"))
        order = np.lexsort((y, words, total))
        lexicon.coef = _calibrated(total[order], words[order], y[order])
        return lexicon
    finally:
        rows.unpersist()


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs with score (0 to 1), predicted (1 if score >= threshold, else 0), weight (summed) and hits (words) added.

    Whole texts are scored, null and empty ones with no hit. Every row keeps its columns, repeated rows included; columns
    of the four names, whatever their case, are replaced, and other names (with dots, or unlike in case only) stay as they
    are. An empty table gives an empty result.
    """
    added = ("score", "predicted", "weight", "hits")
    keep, places = kept_columns(docs, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, hits, score = [], [], []
            for text in _texts(batch, len(places)):
                folded = fold(text)
                w, h = lexicon.hits(folded)
                weight.append(w)
                hits.append(h)
                score.append(lexicon.score(w, folded.count(" ")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in places), pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32()), pa.array(weight, pa.float64()), pa.array(hits, pa.int64())],
                names=[*places, *added],
            )

    rows = plain(docs)
    src = rows.select(*places, F.col(place(docs, text_col)).alias("_text"))
    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in places) + "score double, predicted int, weight double, hits long"
    return src.mapInArrow(run, schema).toDF(*keep, *added)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """One row for each input row: id, held_out, score, predicted, weight, hits."""
    lexicon = train_toxicity(docs, labels, "toxic", max_rows, id_col, text_col)
    rows = plain(docs).select(F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("_body"))
    out = score_toxicity(rows.select("_id", held_out("_id").alias("held_out"), "_body"), lexicon, "_body", threshold)
    return out.drop("_body").toDF(id_col, "held_out", "score", "predicted", "weight", "hits")
