"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after another and adds a shallow tree over the feature's bins to its lookup table;
then the strongest pairs get tables over coarser bins in the same way. A score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fit_rows, held_out, kept_columns, place, plain
from .text_stats import FEATURES, batch_counts, features

MAX_FIT_ROWS = 20_000  # labelled rows at most that the model learns from
BINS, PAIR_BINS, PAIRS = 48, 8, 8


@dataclass
class Gam:
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(x.shape[0], self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cuts, x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            out += table[np.searchsorted(self.pair_cuts[a], x[:, a], "right"), np.searchsorted(self.pair_cuts[b], x[:, b], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between distinct values, at quantiles; also just above the least value, where many rows may stand."""
    q = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])
    v = np.unique(x)
    if v.size > 1:
        q = np.append(q, (v[0] + v[1]) / 2)
    return np.unique(q)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, reg: float) -> np.ndarray:
    """Newton steps of a tree with a few leaves over ordered bins, given each bin's gradient and hessian sums."""
    edges = [0, g.size]
    G, H = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
    gain = lambda a, b: (G[b] - G[a]) ** 2 / (H[b] - H[a] + reg)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                k = np.arange(a + 1, b)
                win = gain(a, k) + gain(k, b) - gain(a, b)
                i = int(np.argmax(win))
                if win[i] > best[0]:
                    best = (float(win[i]), int(k[i]))
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(g.size)
    for a, b in zip(edges, edges[1:]):
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + reg)
    return out


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, rate: float = 0.12, reg: float = 5.0) -> Gam:
    n, p = x.shape
    if n == 0:
        return Gam([np.zeros(0)] * p, [np.zeros(1)] * p, [np.zeros(0)] * p, [], [], 0.0)
    mean = (y.sum() + 1.0) / (n + 2.0)
    base = float(np.log(mean / (1 - mean)))
    cuts = [_cuts(x[:, j], BINS) for j in range(p)]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    tables = [np.zeros(c.size + 1) for c in cuts]
    margin = np.full(n, base)
    prob = lambda: 1.0 / (1.0 + np.exp(-margin))
    for _ in range(rounds):
        for j in range(p):
            mu = prob()
            step = rate * _tree(np.bincount(bins[j], y - mu, cuts[j].size + 1), np.bincount(bins[j], mu * (1 - mu), cuts[j].size + 1), 3, reg)
            tables[j] += step
            margin += step[bins[j]]
    pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(p)]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(pair_cuts)]
    mu = prob()
    gains = []
    for a in range(p):
        for b in range(a + 1, p):
            w = pair_cuts[b].size + 1
            cell = coarse[a] * w + coarse[b]
            size = (pair_cuts[a].size + 1) * w
            g, h = np.bincount(cell, y - mu, size), np.bincount(cell, mu * (1 - mu), size)
            gains.append((float((g * g / (h + reg)).sum()), a, b))
    pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros((pair_cuts[a].size + 1, pair_cuts[b].size + 1)) for a, b in pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(pairs, pair_tables):
            w = table.shape[1]
            cell = coarse[a] * w + coarse[b]
            mu = prob()
            g = np.bincount(cell, y - mu, table.size).reshape(table.shape)
            h = np.bincount(cell, mu * (1 - mu), table.size).reshape(table.shape)
            rows = _tree(g.sum(1), h.sum(1), 2, reg)  # the first split by one feature, the second inside each side
            step = np.zeros_like(table)
            for level in np.unique(rows):
                side = rows == level
                step[side] = _tree(g[side].sum(0), h[side].sum(0), 2, reg)[None, :]
            table += rate * step
            margin += (rate * step)[coarse[a], coarse[b]]
    return Gam(cuts, tables, pair_cuts, pairs, pair_tables, base)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch_counts(batch.column(0)))
        flat = pa.array(x.astype(np.float32).ravel(), pa.float32())
        rows = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, x.shape[1]), pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([rows, batch.column(1)], names=["x", "y"])


def feature_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most `most` training rows, on the driver: a few kB for every hundred rows."""
    rows = fit_rows(docs, labels, label, most, id_col, text_col).select("text", "y").mapInArrow(_feature_rows, "x array<float>, y int").toArrow()
    y = rows.column("y").to_numpy().astype(float)
    x = np.array(rows.column("x").combine_chunks().flatten().to_numpy(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # results must not depend on the order in which rows arrive
    return x[order], y[order]


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Gam:
    return fit_gam(*feature_sample(docs, labels, label, max_rows, id_col, text_col))


def score_quality(docs: DataFrame, model: Gam, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs with `score` (0 to 1, higher: label 1 likelier) and `predicted` (1 if score >= threshold, else 0) added.

    Whole texts are scored; null and empty texts get the score of their statistics, which are all 0. Every row keeps its
    columns, repeated rows included; columns named score or predicted, whatever their case, are replaced, and other names
    (with dots, or unlike in case only) stay as they are. An empty table gives an empty result.
    """
    keep, places = kept_columns(docs, ("score", "predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(features(batch_counts(batch.column("_text")))) if batch.num_rows else np.zeros(0)
            cols = [batch.column(c) for c in places]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=[*places, "score", "predicted"])

    rows = plain(docs)
    src = rows.select(*places, F.col(place(docs, text_col)).alias("_text"))
    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in places) + "score double, predicted int"
    return src.mapInArrow(run, schema).toDF(*keep, "score", "predicted")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """One row for each input row: id, held_out, score, predicted. Learns from at most `max_rows` rows outside the fold."""
    model = train_quality(docs, labels, "quality", max_rows, id_col, text_col)
    rows = plain(docs).select(F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("_body"))
    out = score_quality(rows.select("_id", held_out("_id").alias("held_out"), "_body"), model, "_body", threshold)
    return out.drop("_body").toDF(id_col, "held_out", "score", "predicted")
