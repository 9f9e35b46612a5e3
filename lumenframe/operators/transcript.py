"""Transcript operators: speakers for words, sequence decoding, chunk reconciliation, clustering of voices."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geometry import cosine_similarity
from ..functions.text import longest_common_run
from .intervals import overlap_join, union_length

TOLERANCE_US, GAP_US, EXPANSION_WORDS = 500_000, 750_000, 8
BIN = 1_000_000


def overlap_per_speaker(words: DataFrame, segments: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key, word_no, speaker_id, overlap_us, share): overlap summed per speaker, and its share of the word."""
    key = key or []
    w = words.select(*key, "word_no", F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    s = segments.select(*key, "speaker_id", F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"))
    both = F.least("l_end", "r_end") - F.greatest("l_start", "r_start")
    total = overlap_join(w, s, BIN, key).groupBy(*key, "word_no", "speaker_id").agg(F.sum(both).alias("overlap_us"), F.first(F.col("l_end") - F.col("l_start")).alias("_len"))
    return total.withColumn("share", F.col("overlap_us") / F.col("_len")).drop("_len")


def assign_speakers(words: DataFrame, segments: DataFrame, key: list[str] | None = None) -> DataFrame:
    """words with speaker_id: that of the segment of largest overlap (the first on ties), else of the nearest segment up
    to 0.5 s away, else speaker_unknown.

    words: key, word_no, start_us, end_us; segments: key, seg_no, speaker_id, start_us, end_us. Segments widened by the
    tolerance meet words by time bins, so both rules need one join."""
    key = key or []
    w = words.select(*key, "word_no", F.col("start_us").alias("ws"), F.col("end_us").alias("we"))
    # Words without length have no overlap but may be near; one more microsecond on either side keeps touching ones.
    wide_w = w.withColumn("l_start", F.col("ws") - 1).withColumn("l_end", F.greatest("we", "ws") + 1)
    wide_s = segments.select(*key, "seg_no", "speaker_id", F.col("start_us").alias("ss"), F.col("end_us").alias("se"),
                             (F.col("start_us") - TOLERANCE_US).alias("r_start"), (F.greatest("start_us", "end_us") + TOLERANCE_US).alias("r_end"))
    pair = overlap_join(wide_w, wide_s, BIN, key)
    over = F.least("we", "se") - F.greatest("ws", "ss")
    dist = F.when(F.col("we") <= F.col("ss"), F.col("ss") - F.col("we")).when(F.col("ws") >= F.col("se"), F.col("ws") - F.col("se")).otherwise(0)
    pair = pair.withColumn("over", over).withColumn("dist", dist).filter((F.col("over") > 0) | (F.col("dist") <= TOLERANCE_US))
    rank = F.struct(F.when(F.col("over") > 0, -F.col("over")).otherwise(1), F.when(F.col("over") > 0, 0).otherwise(F.col("dist")), F.col("seg_no"))
    best = pair.groupBy(*key, "word_no").agg(F.min_by("speaker_id", rank).alias("speaker_id"))
    return words.join(best, [*key, "word_no"], "left").withColumn("speaker_id", F.coalesce("speaker_id", F.lit("speaker_unknown")))


def ends_utterance(text: Column) -> Column:
    """Is the last character a full stop, a question mark or an exclamation mark? White space after it counts as another."""
    return F.coalesce(F.right(text, F.lit(1)).isin(".", "?", "!"), F.lit(False))


def utterances(words: DataFrame, key: list[str]) -> DataFrame:
    """Add utterance: words of a stream up to one that ends a sentence or is followed by a gap of more than 0.75 s."""
    order = Window.partitionBy(*key).orderBy("word_no")
    before = ends_utterance(F.lag("text").over(order)) | (F.col("start_us") - F.lag("end_us").over(order) > GAP_US)
    return words.withColumn("utterance", F.sum(F.coalesce(before, F.lit(False)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def dominant_speaker(segments: DataFrame, key: list[str]) -> DataFrame:
    """(key, dominant): the speaker with the most time, the first by name on ties."""
    total = segments.groupBy(*key, "speaker_id").agg(F.sum(F.greatest(F.lit(0).cast("long"), F.col("end_us") - F.col("start_us"))).alias("us")).filter("us > 0")
    return total.groupBy(*key).agg(F.min_by("speaker_id", F.struct(-F.col("us"), "speaker_id")).alias("dominant"))


def expand_sustained_speakers(words: DataFrame, segments: DataFrame, key: list[str]) -> DataFrame:
    """Utterances in which another than the dominant speaker has at least 8 words, and no equal, become that speaker's.

    Words of a stream without a dominant speaker (no segments, or none of a positive length) stay as they are."""
    u = utterances(words, key).join(dominant_speaker(segments, key), key, "left")
    votes = u.filter("speaker_id <> 'speaker_unknown' and speaker_id <> dominant").groupBy(*key, "utterance", "speaker_id").agg(F.count("*").alias("n")).filter(F.col("n") >= EXPANSION_WORDS)
    top = votes.groupBy(*key, "utterance").agg(F.max("n").alias("n"), F.max_by("speaker_id", "n").alias("winner"), F.collect_list("n").alias("all"))
    top = top.filter(F.size(F.filter("all", lambda x: x == F.col("n"))) == 1).select(*key, "utterance", "winner")
    return u.join(top, [*key, "utterance"], "left").withColumn("speaker_id", F.coalesce("winner", "speaker_id")).drop("winner", "dominant")


#: Fixed values of the decoder: emissions, and penalties of a change in fluent speech, at segment borders, at boundaries.
AGREE, DISAGREE, UNKNOWN, EMBEDDING = 1.0, -0.35, -0.20, 4.0
FLUENT, SEGMENT, BOUNDARY = 0.85, 0.25, 0.15


def viterbi_speakers(segment: list[int], similarity: np.ndarray, start: list[int], end: list[int], closes: list[bool], speakers: int) -> list[int]:
    """The best speaker for each word: segment evidence plus embedding evidence, less what changes cost."""
    n = len(segment)
    if not n or speakers <= 0:
        return []
    f = np.float32
    emit = np.full((n, speakers), f(UNKNOWN), f)
    for i, s in enumerate(segment):
        if 0 <= s < speakers:
            emit[i] = f(DISAGREE)
            emit[i, s] = f(AGREE)
    if similarity is not None and similarity.size:
        emit += np.where(similarity > -1.0, similarity.astype(f) * f(EMBEDDING), f(0)).astype(f)
    score, back = emit[0].copy(), np.zeros((n, speakers), int)
    for i in range(1, n):
        if closes[i - 1] or start[i] - end[i - 1] > GAP_US:
            cost = BOUNDARY
        elif segment[i - 1] >= 0 and segment[i] >= 0 and segment[i - 1] != segment[i]:
            cost = SEGMENT
        else:
            cost = FLUENT
        step = np.repeat(score[None, :], speakers, 0) - f(cost) * (1 - np.eye(speakers, dtype=f))
        back[i] = step.argmax(1)
        score = step.max(1) + emit[i]
    out = [int(score.argmax())]
    for i in range(n - 1, 0, -1):
        out.append(int(back[i, out[-1]]))
    return out[::-1]


def decode_speakers(words: DataFrame, speakers: int, key: str = "stream") -> DataFrame:
    """(key, word_no, decoded) by Viterbi for each stream: a fold over its words in order.

    words: key, word_no, text, start_us, end_us, segment_speaker (-1: none), similarity (array, may be null)."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("word_no")
        sims = np.array([s if s is not None and len(s) == speakers else [-1.0] * speakers for s in p["similarity"]], float).reshape(-1, speakers)
        closes = p["text"].fillna("").str[-1:].isin([".", "?", "!"]).tolist()
        path = viterbi_speakers(p["segment_speaker"].astype(int).tolist(), sims, p["start_us"].tolist(), p["end_us"].tolist(), closes, speakers)
        return pd.DataFrame({key: p[key], "word_no": p["word_no"], "decoded": path})

    kind = words.schema[key].dataType.simpleString()
    return words.groupBy(key).applyInPandas(one, f"{key} {kind}, word_no long, decoded int")


#: Fixed values of the repairs: words of an island, words and delay of a late change, words of a punctuated island and its
#: least overlap with a segment, and the overlap by which a segment decides among three or more speakers.
ISLAND_WORDS, LATE_WORDS, LATE_US, CLAUSE_WORDS, CLAUSE_SHARE, LOCK_SHARE = 2, 3, 250_000, 3, 0.50, 0.60
CLAUSE_ENDS = (".", "?", "!", ",", ";", ":")


def _run_end(speaker: list[int], i: int) -> int:
    """The place after the run of equal speakers that begins at i."""
    j = i + 1
    while j < len(speaker) and speaker[j] == speaker[i]:
        j += 1
    return j


def join_islands(speaker: list[int], start: list[int], end: list[int]) -> None:
    """Runs of at most ISLAND_WORDS words between two runs of one other speaker become that speaker's, if the next word
    follows without a gap. Runs are looked at from the first to the last, each as the ones before it have left it."""
    i = 0
    while i < len(speaker):
        j = _run_end(speaker, i)
        if 0 < i and j < len(speaker) and j - i <= ISLAND_WORDS and start[j] - end[j - 1] <= GAP_US and speaker[i - 1] == speaker[j] != speaker[i]:
            speaker[i:j] = [speaker[j]] * (j - i)
        i = j


def advance_handoffs(speaker: list[int], start: list[int], end: list[int], segments: list[tuple[int, int]]) -> None:
    """Where a segment's speaker takes over a few words late, the words since its start become that speaker's.

    segments: (start, speaker) in order. The first word whose middle lies within LATE_US after the start of a segment of
    another speaker than the one before it, and that is not that speaker's yet, begins the change, if the speaker's own
    words begin within LATE_WORDS words after it and no gap lies between."""
    middle = np.array([a + (b - a) // 2 for a, b in zip(start, end)], np.int64)
    for (_, before), (begin, now) in zip(segments, segments[1:]):
        if now < 0 or before == now:
            continue
        near = np.flatnonzero((middle >= begin) & (middle <= begin + LATE_US))
        if not near.size or speaker[near[0]] == now:
            continue
        first = int(near[0])
        for i in range(first + 1, min(len(speaker), first + LATE_WORDS + 2)):
            if start[i] - end[i - 1] > GAP_US:
                break
            if speaker[i] == now:
                speaker[first:i] = [now] * (i - first)
                break


def return_clauses(speaker: list[int], text: list[str], best: list[int], share: list[float], supported: list[bool]) -> None:
    """Runs of at most CLAUSE_WORDS words, one of them with a clause's end, go to the one other speaker whose segments cover
    CLAUSE_SHARE of each of their words, unless a word's speaker is supported by its voice."""
    i = 0
    while i < len(speaker):
        j = _run_end(speaker, i)
        other = {best[k] for k in range(i, j)}
        fits = len(other) == 1 and min(other) >= 0 and min(other) != speaker[i] and not any(supported[i:j]) and min(share[i:j]) >= CLAUSE_SHARE
        if j - i <= CLAUSE_WORDS and fits and any(t.endswith(CLAUSE_ENDS) for t in text[i:j]):
            speaker[i:j] = [best[i]] * (j - i)
        i = j


def repair_speakers(words: DataFrame, segments: DataFrame, key: str = "stream", steps: tuple[str, ...] = ("islands", "handoffs", "clauses", "locks")) -> DataFrame:
    """words with speaker repaired, in the order of steps: `join_islands`, `advance_handoffs`, `return_clauses`, and locks,
    by which in streams of three or more speakers the one whose segments cover LOCK_SHARE of a word has it.

    words: key, word_no, text, start_us, end_us, speaker (a number, -1: unknown), supported (by voice; may be missing).
    segments: key, seg_no, speaker, start_us, end_us. What covers a word is found by a join; the repairs are a fold over one
    stream's words, so a worker holds one recording."""
    kind = words.schema[key].dataType.simpleString()
    rest = [c for c in words.columns if c not in (key, "word_no", "speaker")]
    voiced = F.coalesce(F.col("supported"), F.lit(False)) if "supported" in words.columns else F.lit(False)
    cover = overlap_per_speaker(words, segments.filter("speaker >= 0").withColumnRenamed("speaker", "speaker_id"), [key])
    top = cover.groupBy(key, "word_no").agg(F.max(F.struct("overlap_us", F.negative("speaker_id").alias("m"), "share")).alias("t"))
    slim = words.join(top, [key, "word_no"], "left").select(
        key, "word_no", F.coalesce("text", F.lit("")).alias("text"), "start_us", "end_us", "speaker", voiced.alias("supported"),
        F.coalesce(-F.col("t.m"), F.lit(-1)).alias("best"), F.coalesce("t.share", F.lit(0.0)).alias("share"),
    )

    def one(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        w, g = a.sort_values("word_no"), b.sort_values("seg_no")
        speaker, start, end = ([int(x) for x in w[c]] for c in ("speaker", "start_us", "end_us"))
        best, share, supported = [int(x) for x in w["best"]], [float(x) for x in w["share"]], [bool(x) for x in w["supported"]]
        for step in steps:
            if step == "islands":
                join_islands(speaker, start, end)
            elif step == "handoffs":
                advance_handoffs(speaker, start, end, [(int(s), int(n)) for s, n in zip(g["start_us"], g["speaker"])])
            elif step == "clauses":
                return_clauses(speaker, w["text"].tolist(), best, share, supported)
            elif len(g) and int(g["speaker"].max()) >= 2:
                speaker = [n if s >= LOCK_SHARE and n >= 0 and not v else x for x, n, s, v in zip(speaker, best, share, supported)]
        return pd.DataFrame({key: w[key].to_numpy(), "word_no": w["word_no"].to_numpy(), "speaker": speaker})

    fixed = slim.groupBy(key).cogroup(segments.select(key, "seg_no", "speaker", "start_us").groupBy(key)).applyInPandas(one, f"{key} {kind}, word_no long, speaker int")
    return words.select(key, "word_no", *rest).join(fixed, [key, "word_no"])


#: Fixed value: consecutive tokens that two chunks must share to be joined at them.
ANCHOR_TOKENS = 4


def token_key(text: str) -> str:
    """Letters and digits of the ASCII range in lower case."""
    return "".join(c for c in text.lower() if c.isascii() and c.isalnum())


def join_chunk(done: list[dict], chunk: int, words: list[dict], overlap_end: int) -> None:
    """Append a chunk's words to those of the chunks before it.

    If the last word stems from the chunk before, the longest run of equal tokens of that chunk's words and of the new words
    that start before `overlap_end` is looked for. A run of ANCHOR_TOKENS or more is the anchor: new words are taken from
    its end on, and if both copies of it overlap in time, the chunk before keeps nothing after its own copy. Without an
    anchor, new words are taken from the first one that starts at or after the end of the last word. The chunk before
    then loses words that start at or after the first new one, and its last word ends there at the latest. A chunk that
    has nothing to add changes nothing."""
    if not done:
        done += words
        return
    anchor, tail = (0, 0, 0), len(done)
    if done[-1]["chunk"] == chunk - 1:
        while tail and done[tail - 1]["chunk"] == chunk - 1:
            tail -= 1
        early = [w for w in words if w["start_us"] < overlap_end]
        if min(len(done) - tail, len(early)) >= ANCHOR_TOKENS:  # else no run is an anchor
            anchor = longest_common_run([token_key(w["token"]) for w in done[tail:]], [token_key(w["token"]) for w in early])
    mine, theirs, length = anchor
    keep = len(done)
    if length >= ANCHOR_TOKENS:
        first, after = tail + mine, theirs + length
        if done[first + length - 1]["end_us"] > words[theirs]["start_us"] and words[after - 1]["end_us"] > done[first]["start_us"]:
            keep = first + length
    else:
        after = next((i for i, w in enumerate(words) if w["start_us"] >= done[-1]["end_us"]), len(words))
    if after >= len(words):
        return
    seam = words[after]["start_us"]
    while keep and done[keep - 1]["start_us"] >= seam:
        keep -= 1
    del done[keep:]
    if done and done[-1]["end_us"] > seam:
        done[-1]["end_us"] = seam
    done += words[after:]


def reconcile_chunks(words: DataFrame, chunks: DataFrame, key: str = "stream") -> DataFrame:
    """(key, position, token, start_us, end_us, chunk): words of overlapping chunks as one sequence; see `join_chunk`.

    words: key, chunk (ordinals), word_no, token, start_us, end_us from the chunk's start; those without a length are left
    out. chunks: key, chunk, chunk_start_us, overlap_before_us. The fold over a stream's chunks is sequential, a stream a
    group, so a worker holds the words of one recording."""
    kind = words.schema[key].dataType.simpleString()
    timed = words.filter("end_us > start_us").join(chunks.select(key, "chunk", "chunk_start_us", "overlap_before_us"), [key, "chunk"])
    slim = timed.select(
        key, "chunk", "word_no", "token", (F.col("start_us") + F.col("chunk_start_us")).alias("start_us"), (F.col("end_us") + F.col("chunk_start_us")).alias("end_us"),
        (F.col("chunk_start_us") + F.col("overlap_before_us")).alias("overlap_end"),
    )

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        done: list[dict] = []
        p = pdf.sort_values(["chunk", "word_no"])
        for chunk, rows in groupby(zip(*(p[c].tolist() for c in ("chunk", "token", "start_us", "end_us", "overlap_end"))), lambda r: r[0]):
            rows = list(rows)
            join_chunk(done, chunk, [{"token": t or "", "start_us": s, "end_us": e, "chunk": chunk} for _, t, s, e, _ in rows], rows[0][4])
        out = {c: [w[c] for w in done] for c in ("token", "start_us", "end_us", "chunk")}
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(done), "position": range(len(done)), **out})

    return slim.groupBy(key).applyInPandas(one, f"{key} {kind}, position long, token string, start_us long, end_us long, chunk long")


#: The least similarity at which clusters join, and the least drop of similarity at which joining stops early.
FLOOR, GAP = 0.14, 0.10
#: Up to so many observations sums of similarities are held for all pairs (200 MB).
PAIRS_HELD = 5000


def cluster_observations(x: np.ndarray, start: list | None = None, cannot: set[tuple[int, int]] = frozenset()) -> list[int]:
    """A cluster for each voice observation: average-link clustering by cosine similarity.

    The two clusters of greatest mean similarity join, the first of equals, as long as it is FLOOR or more and no pair of
    them is in `cannot`. If similarity drops by GAP or more from one joining to the next, the joinings after the greatest
    drop are undone. Vectors without a component beyond 1e-6 have no similarity to any other. Clusters are numbered by
    their earliest `start` (by their first member where none is given).

    Each cluster knows the best of those after it. As a joining makes no mean greater than both that it comes from, a lost
    best still bounds its row, which is looked through again only when that bound is the greatest. Beyond PAIRS_HELD
    observations nothing is held for pairs: the sum of similarities of two clusters is the product of the sums of their unit
    vectors (the same but for rounding)."""
    n = len(x)
    ids = np.flatnonzero(np.abs(x).max(1) > 1e-6) if n else np.zeros(0, int)
    sums = x[ids] / np.maximum(np.linalg.norm(x[ids], axis=1, keepdims=True), 1e-12) if n else np.zeros((0, 0))
    size, live = np.ones(len(ids)), np.ones(len(ids), bool)
    barred: dict[int, set[int]] = {}
    for a, b in cannot:
        barred.setdefault(a, set()).add(b)
        barred.setdefault(b, set()).add(a)
    best, at, stale = np.full(len(ids), -2.0), np.zeros(len(ids), int), np.zeros(len(ids), bool)
    total = sums @ sums.T if len(ids) <= PAIRS_HELD else None

    def row(i: int) -> np.ndarray:
        return sums @ sums[i] if total is None else total[i]

    def means(i: int, rows: np.ndarray) -> np.ndarray:
        """Mean similarity of cluster i to clusters, -2 where they may not join."""
        out = np.where(live, rows / (size * size[i]), -2.0)
        shut = [k for k in np.searchsorted(ids, sorted(barred.get(int(ids[i]), ()))) if k < len(ids)] if barred else []
        out[[k for k in shut if int(ids[k]) in barred[int(ids[i])]]] = -2.0
        return out

    def look(i: int, mean: np.ndarray) -> None:
        best[i], stale[i] = -2.0, False
        if i + 1 < len(mean):
            at[i] = i + 1 + int(mean[i + 1 :].argmax())
            best[i] = mean[at[i]]

    for begin in range(0, len(ids), 256):
        for i, rows in enumerate(sums[begin : begin + 256] @ sums.T if total is None else total[begin : begin + 256], begin):
            look(i, means(i, rows))
    joined: list[tuple[int, int, float]] = []
    while len(ids):
        a = int(best.argmax())
        if best[a] < FLOOR:
            break
        if stale[a]:
            look(a, means(a, row(a)))
            continue
        b = int(at[a])
        joined.append((int(ids[a]), int(ids[b]), float(best[a])))
        if total is None:
            sums[a] += sums[b]
        else:
            total[a] += total[b]
            total[:, a] += total[:, b]
        size[a] += size[b]
        live[b], best[b], stale[b] = False, -2.0, False
        gone = barred.pop(int(ids[b]), set())
        for k in gone:
            barred[k].discard(int(ids[b]))
            barred[k].add(int(ids[a]))
        if gone:
            barred.setdefault(int(ids[a]), set()).update(gone)
        mean = means(a, row(a))
        stale |= live & ((at == a) | (at == b))
        up = np.flatnonzero(live[:a] & ((mean[:a] > best[:a]) | ((mean[:a] == best[:a]) & (a <= at[:a]))))
        best[up], at[up], stale[up] = mean[up], a, False
        look(a, mean)
        if live.sum() * 2 < len(ids):  # those that are gone cost no more products
            place = np.cumsum(live) - 1
            stale |= ~live[at]
            sums, size, best, at, stale, ids = sums[live], size[live], best[live], place[at[live]], stale[live], ids[live]
            total = None if total is None else total[np.ix_(live, live)]
            live = np.ones(len(ids), bool)
    if len(joined) > 1:
        drop = -np.diff([s for _, _, s in joined])
        if drop.max() >= GAP:
            joined = joined[: int(drop.argmax()) + 1]
    into = list(range(n))
    for a, b, _ in joined:
        into[b] = a
    first: dict[int, tuple] = {}
    for i in range(n):  # a cluster joins one before it
        into[i] = into[into[i]]
        mine = (start[i] if start is not None else i, i)
        first[into[i]] = min(first.get(into[i], mine), mine)
    rank = {c: k for k, c in enumerate(sorted(first, key=first.get))}
    return [rank[c] for c in into]


def speaker_count(x: np.ndarray, cannot: set[tuple[int, int]] = frozenset()) -> int:
    """Speakers by the largest gap of the eigenvalues of a nearest-neighbour affinity's normalized Laplacian."""
    n = len(x)
    if n <= 1:
        return n
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    d = np.clip(1 - u @ u.T, 0, None)
    np.fill_diagonal(d, np.inf)
    k = max(1, min(n - 1, int(np.ceil(np.sqrt(n)))))
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    scale = np.maximum(np.take_along_axis(d, near, 1)[:, -1], 1e-6)
    a = np.zeros((n, n))
    for i in range(n):
        for j in near[i]:
            if (i, j) not in cannot and (j, i) not in cannot:
                a[i, j] = a[j, i] = np.exp(-d[i, j] ** 2 / (scale[i] * scale[j]))
    deg = np.maximum(a.sum(1), 1e-12)
    lap = np.eye(n) - a / np.sqrt(deg[:, None] * deg[None, :])
    values = np.linalg.eigvalsh(lap)
    gaps = np.diff(values)
    if gaps.max() <= 1e-9:
        return max(1, int((values < 1e-9).sum()))
    return int(gaps.argmax()) + 1


def cluster_streams(observations: DataFrame, key: str = "stream") -> DataFrame:
    """(key, obs_no, cluster) for each stream's voice observations (key, obs_no, embedding; start_us, if there is one).

    A stream is one group: a worker holds its vectors and one sum for each, and nothing for pairs."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("obs_no")
        start = p["start_us"].tolist() if "start_us" in p else None
        return pd.DataFrame({key: p[key], "obs_no": p["obs_no"], "cluster": cluster_observations(np.array(p["embedding"].tolist(), float), start)})

    kind = observations.schema[key].dataType.simpleString()
    return observations.groupBy(key).applyInPandas(one, f"{key} {kind}, obs_no long, cluster int")


def speaker_shares(segments: DataFrame, key: list[str], dominant: float = 0.95) -> DataFrame:
    """(key, speaker_id, us, share, collapse): collapse where one speaker has at least `dominant` of all speech."""
    us = segments.groupBy(*key, "speaker_id").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("us"))
    total = Window.partitionBy(*key)
    return us.withColumn("share", F.col("us") / F.sum("us").over(total)).withColumn("collapse", F.max("share").over(total) >= dominant)


def collapse_dominant(segments: DataFrame, key: list[str]) -> DataFrame:
    """segments (key, speaker as number, start_us, end_us) where one speaker with 0.95 of all speech or more takes all."""
    share = speaker_shares(segments.select(*key, F.col("speaker").alias("speaker_id"), "start_us", F.greatest("start_us", "end_us").alias("end_us")), key)
    all_ = share.groupBy(*key).agg(F.max("collapse").alias("_c"), F.count("*").alias("_n"))
    one = F.coalesce(F.col("_c") & (F.col("_n") > 1), F.lit(False))
    return segments.join(all_, key, "left").withColumn("speaker", F.when(one, F.lit(0)).otherwise(F.col("speaker"))).drop("_c", "_n")


#: Speakers and observations needed, shares of two large tracks, and the most that they may overlap.
STITCH_SPEAKERS, STITCH_OBSERVATIONS, STITCH_BOTH, STITCH_EACH, STITCH_OVERLAP = 8, 8, 0.70, 0.15, 0.01


def stitch_tracks(segments: DataFrame, observations: DataFrame, key: list[str]) -> DataFrame:
    """segments (key, speaker, start_us, end_us) where the two speakers with most time become one, if they never really
    speak together: both have 0.15 of all speech, together 0.70, and overlap in 0.01 of the shorter one's at most. Only
    where a stream has 8 speakers and 8 observations (key, observations); the higher number goes, those above move down."""
    live = segments.filter("end_us > start_us")
    us = live.groupBy(*key, "speaker").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("us"))
    top = us.groupBy(*key).agg(
        F.sum("us").alias("all_us"), F.sort_array(F.collect_list(F.struct((-F.col("us")).alias("m"), F.col("speaker").alias("s")))).alias("t")
    )  # one entry a speaker
    numbers = segments.groupBy(*key).agg((F.max("speaker") + 1).alias("speakers"))
    top = top.join(numbers, key).join(observations.select(*key, "observations"), key)
    top = top.filter((F.col("speakers") >= STITCH_SPEAKERS) & (F.col("observations") >= STITCH_OBSERVATIONS) & (F.size("t") >= 2))
    top = top.select(*key, "all_us", *[F.get("t", F.lit(i))["s"].alias(f"s{i}") for i in (0, 1)], *[(-F.get("t", F.lit(i))["m"]).alias(f"u{i}") for i in (0, 1)])
    top = top.filter((F.col("u1") >= STITCH_EACH * F.col("all_us")) & (F.col("u0") + F.col("u1") >= STITCH_BOTH * F.col("all_us")))
    mine = live.join(top, key)
    a = mine.filter("speaker = s0").select(*key, F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    b = mine.filter("speaker = s1").select(*key, F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"))
    both = overlap_join(a, b, BIN, key).groupBy(*key).agg(F.sum(F.least("l_end", "r_end") - F.greatest("l_start", "r_start")).alias("both"))
    pair = top.join(both, key, "left").filter(F.coalesce("both", F.lit(0)) <= STITCH_OVERLAP * F.col("u1")).select(*key, F.least("s0", "s1").alias("keep"), F.greatest("s0", "s1").alias("gone"))
    to = F.when(F.col("speaker") == F.col("gone"), F.col("keep")).when(F.col("speaker") > F.col("gone"), F.col("speaker") - 1).otherwise(F.col("speaker"))
    return segments.join(pair, key, "left").withColumn("speaker", to).drop("keep", "gone")


#: When many small tracks beside a dominant one are taken for one voice.
FRAGMENT_SPEAKERS, FRAGMENT_OBSERVATIONS, FRAGMENT_ALIKE = 5, 8, 0.80
FRAGMENT_DOMINANT, FRAGMENT_OTHERS, FRAGMENT_LARGEST = (0.75, 0.90), 0.08, 0.15


def collapse_fragments(segments: DataFrame, voices: DataFrame, observations: DataFrame, key: list[str]) -> DataFrame:
    """segments (key, speaker, start_us, end_us) where all speakers beside a dominant one become one voice: the dominant one
    has 0.75 to 0.90 of all speech, the others 0.08 together and 0.15 each at most, and the voices (key, speaker,
    embedding) of the largest two are alike by 0.80. Only where a stream has 5 speakers and 8 observations. Of the two
    that are left, the one that starts first is 0."""
    span = segments.filter("speaker >= 0").groupBy(*key, "speaker").agg(
        F.sum(F.greatest(F.lit(0), F.col("end_us") - F.col("start_us"))).alias("us"), F.min("start_us").alias("first")
    )
    order = Window.partitionBy(*key).orderBy(F.desc("us"), "speaker")
    ranked = span.withColumn("rank", F.row_number().over(order))
    e = lambda i: F.max(F.when(F.col("rank") == i, F.col("embedding")))
    of = lambda i, c: F.max(F.when(F.col("rank") == i, F.col(c)))
    stat = ranked.join(voices.select(*key, "speaker", "embedding"), [*key, "speaker"], "left").groupBy(*key).agg(
        F.sum("us").alias("all_us"), (F.max("speaker") + 1).alias("speakers"), of(1, "us").alias("dominant_us"), of(2, "us").alias("largest_us"), of(1, "speaker").alias("dominant"),
        of(1, "first").alias("begins"), F.min(F.when(F.col("rank") > 1, F.col("first"))).alias("others_begin"), of(3, "us").alias("second_us"), e(2).alias("v2"), e(3).alias("v3"),
    )
    share = lambda c: F.col(c) / F.col("all_us")
    signal = lambda v: F.coalesce(F.exists(v, lambda z: F.abs(z) > 1e-6), F.lit(False))
    alike = F.when(F.coalesce("second_us", F.lit(0)) <= 0, F.lit(True)).otherwise(signal("v2") & signal("v3") & (cosine_similarity(F.col("v2"), F.col("v3")) >= FRAGMENT_ALIKE))
    hit = stat.join(observations.select(*key, "observations"), key).filter(
        (F.col("speakers") >= FRAGMENT_SPEAKERS) & (F.col("observations") >= FRAGMENT_OBSERVATIONS) & (F.col("largest_us") > 0) & share("dominant_us").between(*FRAGMENT_DOMINANT)
        & (1 - share("dominant_us") >= FRAGMENT_OTHERS) & (share("largest_us") <= FRAGMENT_LARGEST) & alike
    ).select(*key, "dominant", (F.col("begins") <= F.col("others_begin")).alias("leads"))
    own = F.when(F.col("speaker") == F.col("dominant"), F.col("leads")).otherwise(~F.col("leads"))
    to = F.when(F.col("dominant").isNull() | (F.col("speaker") < 0), F.col("speaker")).otherwise(F.when(own, 0).otherwise(1))
    return segments.join(hit, key, "left").withColumn("speaker", to).drop("dominant", "leads")


def word_records(words: DataFrame, key: list[str]) -> DataFrame:
    """Words numbered by start within their stream, with ids."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy("start_us", "end_us", "word_no"))
    return words.withColumn("id", F.format_string("word_%06d", n))


def speaker_records(words: DataFrame, segments: DataFrame, key: list[str]) -> DataFrame:
    """(key, speaker_id, total_speech_us, word_count, rank): time covered by a speaker's segments, words, and the rank by
    words, then name."""
    covered = union_length(segments, [*key, "speaker_id"], "start_us", "end_us").withColumnRenamed("covered_us", "total_speech_us")
    said = words.groupBy(*key, "speaker_id").agg(F.count("*").alias("word_count"))
    out = covered.join(said, [*key, "speaker_id"], "full_outer").fillna(0, ["total_speech_us", "word_count"])
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("word_count"), "speaker_id")))
