"""Quality rules with an isolation forest on their statistics.

Trees split random samples of rule statistics at random; a document whose paths are short is unlike the rest. Each tree
draws its own sample from all labelled rows, as the method has it; what a leaf holds is counted over all of them, and the
threshold of the anomaly score is calibrated on all of them so that almost all good documents stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import held_out, place, plain, written
from .text_stats import batch_counts

TREES, SAMPLE = 200, 256
MAX_LOST = 0.01  # share of good calibration rows that the threshold may reject
STEPS = 4096  # ranges of scores in which labelled rows are counted side by side
DIGITS = 12  # of scores that count as different in calibration
COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Rules: a statistic and the limit above which (or, for "short words", below which) it counts.
RULES = {
    "symbols": 0.05, "marks": 0.3, "inner capitals": 0.3, "repeated lines": 0.3, "repeated neighbours": 0.3, "top word": 0.4,
    "digits": 0.4, "brackets": 0.1, "quotes": 0.1, "long words": 12.0, "short words": 2.0,
}


def rule_statistics(c: dict[str, np.ndarray]) -> np.ndarray:
    """By how much each text breaks each rule; 0 where it keeps to it."""
    words = np.maximum(c["n_words"], 1).astype(float)
    chars = np.maximum(c["word_chars"], 1).astype(float)
    letters = np.maximum(c["n_upper"] + c["n_lower"] + c["n_wide"], 1).astype(float)
    values = {
        "symbols": c["n_symbols"] / chars, "marks": c["n_mark"] / words, "inner capitals": np.maximum(0, c["n_upper"] - c["n_capital"]) / letters,
        "repeated lines": c["n_dup_lines"] / np.maximum(c["n_lines"], 1), "repeated neighbours": c["n_same_next"] / words, "top word": c["n_top_word"] / words,
        "digits": c["n_digit"] / chars, "brackets": c["n_bracket"] / chars, "quotes": c["n_quote"] / chars, "long words": c["word_chars"] / words,
    }
    over = [np.maximum(0.0, values[k] - RULES[k]) for k in RULES if k != "short words"]
    return np.stack([*over, np.where(c["n_words"] > 0, np.maximum(0.0, RULES["short words"] - c["word_chars"] / words), 0.0)], 1)


def _average_path(n: float) -> float:
    return 0.0 if n <= 1 else 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    feature: np.ndarray  # [tree, node], -1 at leaves
    cut: np.ndarray
    path: np.ndarray  # depth of a leaf and the average path of the rows it holds
    depth: int
    norm: float
    sample: int = SAMPLE  # rows that each tree was grown on
    threshold: float = 1.0

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf in which each row ends, tree by tree."""
        rows = np.arange(x.shape[0])
        for feature, cut in zip(self.feature, self.cut):
            node = np.zeros(x.shape[0], np.int64)
            for _ in range(self.depth):
                f = feature[node]
                go = f >= 0
                node = np.where(go, 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= cut[node]), node)
            yield node

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / that of a random tree): near 1 for anomalies, below 0.5 for the usual."""
        total = np.zeros(x.shape[0])
        for path, node in zip(self.path, self.leaves(x)):
            total += path[node]
        return 2.0 ** (-(total / max(1, len(self.feature))) / self.norm)

    def weigh(self, tree: np.ndarray, node: np.ndarray, n: np.ndarray) -> None:
        """Let paths count on from what leaves hold of all rows, `n` in `node` of `tree`, as of one tree's sample."""
        if not n.size:
            return
        rest = np.array([_average_path(i) for i in range(self.sample + 2)])
        level = np.floor(np.log2(np.arange(self.path.shape[1]) + 1.0))
        size = np.zeros(self.path.shape)
        size[tree, node] = n * (self.sample * len(self.path) / n.sum())  # in parts of a row, too
        self.path = np.where(self.feature < 0, level + np.interp(size, np.arange(rest.size), rest), 0.0)


def grow_forest(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 17) -> Forest:
    """Trees on a random sample each; where there are rows enough, no row serves two trees."""
    rng = np.random.default_rng(seed)
    sample = max(1, min(sample, x.shape[0]))
    own = rng.permutation(x.shape[0])[: trees * sample].reshape(trees, sample) if x.shape[0] >= trees * sample else None
    depth = max(1, math.ceil(math.log2(max(2, sample))))
    size = 2 ** (depth + 1) - 1
    feature, cut, path = np.full((trees, size), -1, np.int64), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees if x.shape[0] else 0):
        stack = [(0, x[rng.choice(x.shape[0], sample, replace=False) if own is None else own[t]], 0)]
        while stack:
            node, rows, level = stack.pop()
            low, high = rows.min(0), rows.max(0)
            split = np.flatnonzero(high > low)
            if level == depth or rows.shape[0] <= 1 or not split.size:
                path[t, node] = level + _average_path(rows.shape[0])
                continue
            f = int(rng.choice(split))
            at = rng.uniform(low[f], high[f])
            right = rows[:, f] >= at
            if right.all() or not right.any():
                path[t, node] = level + _average_path(rows.shape[0])
                continue
            feature[t, node], cut[t, node] = f, at
            stack += [(2 * node + 1, rows[~right], level + 1), (2 * node + 2, rows[right], level + 1)]
    return Forest(feature, cut, path, depth, max(1e-9, _average_path(sample)), sample)


def calibrate(scored: DataFrame, lost: float = MAX_LOST) -> float:
    """The threshold with the best balance of rejected bad and kept good rows that loses at most `lost` of the good.

    scored: score (0 to 1), good and bad, numbers of rows; every score is a candidate. Rows are counted by ranges of
    scores, then within each range, so that only one sum for each of STEPS ranges comes to the driver."""
    scored = scored.groupBy("score").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).withColumn("step", F.floor(F.col("score") * STEPS).cast("int"))
    sums = sorted(tuple(r) for r in scored.groupBy("step").agg(F.sum("good"), F.sum("bad")).collect())
    n_good, n_bad = sum(r[1] for r in sums), sum(r[2] for r in sums)
    if not n_good or not n_bad:
        return 1.0
    below, g, b = [], 0, 0
    for step, good, bad in sums:
        below.append((step, g, b))
        g, b = g + good, b + bad
    upto = Window.partitionBy("step").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = scored.sparkSession.createDataFrame(below, "step int, g long, b long")
    kept = scored.join(F.broadcast(before), "step").select("score", (F.col("g") + F.sum("good").over(upto)).alias("g"), (F.col("b") + F.sum("bad").over(upto)).alias("b"))
    value = F.col("g") * F.lit(n_bad) - F.col("b") * F.lit(n_good)  # kept good and caught bad, as whole numbers
    # Of equals, the one that keeps most; the last score keeps all, so there is one.
    best = kept.filter(F.col("g") / F.lit(n_good) >= 1 - lost).orderBy(value.desc(), F.col("score").desc()).head().score
    over = scored.filter(F.col("score") > best).agg(F.min("score")).head()[0]
    return 1.0 if over is None else best + (over - best) / 2


def _failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))


def _arrays(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), width)


def _statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, the counts, base_failed and x, by how much each text breaks each rule, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch_counts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c[k], pa.int64()) for k in COUNTED], pa.array(_failed(c)), _lists(rule_statistics(c))],
                names=["_id", *COUNTED, "base_failed", "x"],
            )

    src = plain(docs).select(F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, " + ", ".join(f"{k} long" for k in COUNTED) + ", base_failed boolean, x array<double>")


def _verdicts(stats: DataFrame, forest: Forest, id_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = forest.score(_arrays(batch.column("x"), len(RULES)))
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            kept = ~failed & (score <= forest.threshold)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("_id", *COUNTED, "base_failed")), pa.array(kept), pa.array(score, pa.float64())],
                names=["_id", *COUNTED, "base_failed", "kept", "anomaly"],
            )

    kind = stats.schema["_id"].dataType.simpleString()
    out = stats.mapInArrow(run, f"_id {kind}, " + ", ".join(f"{k} long" for k in COUNTED) + ", base_failed boolean, kept boolean, anomaly double")
    return out.withColumnRenamed("_id", id_col)


def _masses(forest: Forest):
    """For each tree, how many labelled rows end in each leaf."""
    size = forest.feature.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(forest.feature.shape, np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy()
            for t, node in enumerate(forest.leaves(_arrays(batch.column(0), len(RULES)))):
                held[t] += np.bincount(node, n, size).astype(np.int64)
        t, node = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(node, pa.int32()), pa.array(held[t, node], pa.int64())], names=["tree", "node", "n"])

    return run


def _scored(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.round(forest.score(_arrays(batch.column(0), len(RULES))), DIGITS)
            yield pa.RecordBatch.from_arrays([pa.array(score, pa.float64()), batch.column(1), batch.column(2)], names=["score", "good", "bad"])

    return run


def _trained(stats: DataFrame, labels: DataFrame, label: str, id_col: str) -> Forest:
    y = plain(labels).select(F.col(place(labels, id_col)).alias("_id"), F.col(place(labels, label)).cast("int").alias("_y"))
    y = y.filter("_y is not null and _id is not null").filter(~held_out("_id")).groupBy("_id").agg(F.max("_y").alias("y"))
    rows = written(stats.filter("not base_failed").select("_id", "x").join(y, "_id"), "labelled")
    sample = rows.orderBy(F.xxhash64("_id", F.lit(11)), "_id", "x").limit(TREES * SAMPLE).select("x").toArrow()  # all that the trees draw
    x = _arrays(sample.column("x").combine_chunks(), len(RULES))
    forest = grow_forest(x[np.lexsort(x.T)])  # results must not depend on the order in which rows arrive
    # Most rows break no rule, or few of them alike, so equal ones are looked at together.
    rows = written(rows.groupBy("x").agg(F.sum((F.col("y") == 1).cast("long")).alias("good"), F.sum((F.col("y") != 1).cast("long")).alias("bad")), "distinct")
    held = rows.select("x", (F.col("good") + F.col("bad")).alias("n")).mapInArrow(_masses(forest), "tree int, node int, n long").groupBy("tree", "node").agg(F.sum("n").alias("n")).toArrow()
    forest.weigh(*(held.column(c).to_numpy() for c in ("tree", "node", "n")))
    forest.threshold = calibrate(rows.mapInArrow(_scored(forest), "score double, good long, bad long"))
    return forest


def train_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Forest:
    """Trees from all labelled rows outside the held-out fold (labels unseen), threshold from the same rows' labels.

    Texts that fail the base rules are left out: those rules decide about them. Rows that repeat an id all have its label."""
    return _trained(_statistics(docs, id_col, text_col), labels, label, id_col)


def rule_verdicts(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, anomaly.

    base_failed: fewer than 10 words, or more than a fifth of the words in five-word windows that the text repeats.
    kept is false if base_failed, else whether the anomaly score is at most the forest's threshold. Null and empty
    texts have no words and fail; repeated rows get one row each; an empty table gives an empty result; other columns,
    whatever their names, are not looked at.
    """
    return _verdicts(_statistics(docs, id_col, text_col), forest, id_col)


def trained_verdicts(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rule_verdicts by train_rules of the same rows, whose texts are counted once and their statistics written."""
    stats = written(_statistics(docs, id_col, text_col), "statistics")
    return _verdicts(stats, _trained(stats, labels, label, id_col), id_col)
