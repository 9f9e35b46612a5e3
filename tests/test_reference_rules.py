"""Rules with fixed thresholds, each against a plain walk over the rows that states the rule once more."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import equivalence, graph, intervals, ocr, timeline, transcript, validate


def rows(df, *by):
    return sorted(map(tuple, df.collect())) if not by else [tuple(r) for r in df.orderBy(*by).collect()]


def test_ends_utterance(spark):
    df = spark.createDataFrame([("a.",), ("a. ",), ("a.\n",), ("?",), ("",), (None,), ("x!y",)], "t string")
    assert [r[0] for r in df.select(transcript.ends_utterance(F.col("t"))).collect()] == [True, False, False, True, False, False, False]


# --- chunks ---------------------------------------------------------------------------------------------------------
def run_of(a, b):
    """Longest common run by trying all pairs of places."""
    best = None
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] and a[i + n] == b[j + n]:
                n += 1
            if n:
                cand = (n, j + n, -(i + n))
                if best is None or cand > best[0]:
                    best = (cand, (i, j, n))
    return best[1] if best else (0, 0, 0)


def walk_chunks(chunks):
    """chunks: [(begin, overlap_before, [(text, start, end)])]; the same rule, kept as simple as possible."""
    key = lambda t: "".join(c for c in t.lower() if c.isalnum())
    out = []  # (text, start, end, chunk)
    for c, (begin, overlap, words) in enumerate(chunks):
        new = [(t, begin + s, begin + e, c) for t, s, e in words if e > s]
        if not new:
            continue
        if not out:
            out = new
            continue
        match, tail = (0, 0, 0), []
        if out[-1][3] == c - 1:
            while len(tail) < len(out) and out[-1 - len(tail)][3] == c - 1:
                tail.insert(0, out[-1 - len(tail)])
            match = run_of([key(w[0]) for w in tail], [key(w[0]) for w in new if w[1] < begin + overlap])
        i, j, n = match
        kept = out
        if n >= 4:
            base = len(out) - len(tail)
            mine, theirs = out[base + i : base + i + n], new[j : j + n]
            if mine[-1][2] > theirs[0][1] and theirs[-1][2] > mine[0][1]:
                kept = out[: base + i + n]
            rest = new[j + n :]
        else:
            rest = list(new)
            while rest and rest[0][1] < out[-1][2]:
                rest.pop(0)
        if not rest:
            continue
        out = list(kept)
        while out and out[-1][1] >= rest[0][1]:
            out.pop()
        if out:
            t, s, e, k = out[-1]
            out[-1] = (t, s, min(e, rest[0][1]), k)
        out += rest
    return out


def test_chunks(spark):
    r = random.Random(3)
    words, plan, want = [], [], []
    for stream in range(60):
        said, at = [], 0
        for _ in range(80):
            n = r.randint(50, 400)
            said.append((r.choice(["the", "The", "of", "a,", "one", "two", "three", "four.", "five", "six", "--"]), at, at + n))
            at += n + r.choice([0, 0, 30, 500])
        chunks, begin, c = [], 0, 0
        while begin < at:
            length, overlap = 6000, 0 if c == 0 else 1500
            own = []
            for t, s, e in said:
                if begin <= s < begin + length and r.random() > 0.03:
                    jitter = r.choice([0, 0, 0, -20, 40])
                    own.append((t if r.random() > 0.05 else "eh", max(0, s - begin + jitter), max(0, e - begin + jitter) if r.random() > 0.02 else 0))
            if r.random() < 0.05:
                own = []
            chunks.append((begin, overlap, own))
            begin += length - 1500
            c += 1
        for c, (b, overlap, own) in enumerate(chunks):
            plan.append((stream, c, b, overlap))
            words += [(stream, c, i, t, s, e) for i, (t, s, e) in enumerate(own)]
        want += [(stream, i, t, s, e, c) for i, (t, s, e, c) in enumerate(walk_chunks(chunks))]
    w = spark.createDataFrame(words, "stream int, chunk int, word_no long, token string, start_us long, end_us long").repartition(3)
    p = spark.createDataFrame(plan, "stream int, chunk int, chunk_start_us long, overlap_before_us long")
    assert rows(transcript.reconcile_chunks(w, p)) == sorted(want)
    assert transcript.reconcile_chunks(w.limit(0), p).count() == 0


# --- voices ---------------------------------------------------------------------------------------------------------
def walk_clusters(x, start, cannot):
    """Average-link clustering by recomputing every mean of every pair of clusters at every step."""
    cos = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
    live = [bool((np.abs(v) > 1e-6).any()) for v in x]
    groups, steps = [[i] for i in range(len(x))], []

    def mean(a, b):
        if any((min(i, j), max(i, j)) in cannot for i in a for j in b):
            return -2.0
        got = [cos(x[i], x[j]) for i in a for j in b if live[i] and live[j]]
        return sum(got) / len(got) if got else -2.0

    while len(groups) > 1:
        best = (-2.0, 0, 0)
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                m = mean(groups[i], groups[j])
                if m > best[0] + 1e-12:
                    best = (m, i, j)
        if best[0] < 0.14:
            break
        groups = [list(g) for g in groups]
        groups[best[1]] += groups.pop(best[2])
        steps.append((best[0], [list(g) for g in groups]))
    if len(steps) > 1:
        drops = [a[0] - b[0] for a, b in zip(steps, steps[1:])]
        if max(drops) >= 0.10:
            groups = steps[drops.index(max(drops))][1]
    groups.sort(key=lambda g: min((start[i], i) for i in g))
    return [next(k for k, g in enumerate(groups) if i in g) for i in range(len(x))]


@pytest.mark.parametrize("seed", range(12))
def test_clusters(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 16))
    base = r.normal(size=(3, 6))
    x = np.stack([base[r.integers(0, 3)] + r.normal(0, r.choice([0.2, 0.8, 1.5]), 6) for _ in range(n)])
    x[r.random(n) < 0.1] = 0.0
    start = r.permutation(n).tolist()
    cannot = {(i, j) for i in range(n) for j in range(i + 1, n) if r.random() < 0.05}
    assert transcript.cluster_observations(x, start, cannot) == walk_clusters(x, start, cannot)


def test_one_voice_of_moderate_likeness():
    """Six vectors of one voice with a mean cosine far below 0.86 are one speaker."""
    r = np.random.default_rng(1)
    x = np.ones(40) + r.normal(0, 0.95, (6, 40))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (u @ u.T)[np.triu_indices(6, 1)].mean() < 0.7
    assert len(set(transcript.cluster_observations(x))) == 1
    assert transcript.cluster_observations(np.zeros((0, 3))) == []


def test_tracks_that_become_one(spark):
    seg = [("p", 7, 0, 400), ("p", 2, 500, 900), ("p", 0, 950, 980)] + [("p", s, 1000 + 10 * s, 1010 + 10 * s) for s in (1, 3, 4, 5, 6, 8)]
    df = spark.createDataFrame(seg, "k string, speaker int, start_us long, end_us long")
    seen = spark.createDataFrame([("p", 9)], "k string, observations int")
    got = transcript.stitch_tracks(df, seen, ["k"])
    assert rows(got.select("start_us", "speaker")) == sorted((s, 2 if n == 7 else n - 1 if n > 7 else n) for _, n, s, _ in seg)
    clash = df.withColumn("end_us", F.when(F.col("speaker") == 7, 520).otherwise(F.col("end_us")))  # both speak for 20 of 400
    assert rows(transcript.stitch_tracks(clash, seen, ["k"]).select("speaker")) == rows(clash.select("speaker"))
    assert rows(transcript.stitch_tracks(df, seen.withColumn("observations", F.lit(7)), ["k"]).select("speaker")) == rows(df.select("speaker"))

    one = spark.createDataFrame([("p", 3, 0, 95), ("p", 1, 100, 105), ("q", 1, 0, 90), ("q", 0, 90, 100)], "k string, speaker int, start_us long, end_us long")
    assert rows(transcript.collapse_dominant(one, ["k"]).select("k", "start_us", "speaker")) == [("p", 0, 0), ("p", 100, 0), ("q", 0, 1), ("q", 90, 0)]

    many = [("p", 4, 10, 810), ("p", 0, 0, 10), ("p", 1, 820, 900), ("p", 2, 900, 950), ("p", 3, 950, 1010)]
    frag = spark.createDataFrame(many, "k string, speaker int, start_us long, end_us long")
    alike = spark.createDataFrame([("p", 1, [1.0, 0.1]), ("p", 3, [1.0, 0.0]), ("p", 4, [0.0, 1.0])], "k string, speaker int, embedding array<double>")
    assert rows(transcript.collapse_fragments(frag, alike, seen, ["k"]).select("start_us", "speaker")) == [(0, 0), (10, 1), (820, 0), (900, 0), (950, 0)]
    unlike = spark.createDataFrame([("p", 1, [1.0, 0.1]), ("p", 3, [0.0, 1.0])], "k string, speaker int, embedding array<double>")
    assert rows(transcript.collapse_fragments(frag, unlike, seen, ["k"]).select("speaker")) == rows(frag.select("speaker"))


# --- pictures -------------------------------------------------------------------------------------------------------
def walk_cuts(diffs):
    """(transition, cut) of each difference, with the state of the walk spelled out."""
    out, going = [], False
    for i, d in enumerate(diffs):
        three = diffs[i : i + 3]
        begins = len(three) == 3 and min(three) >= 0.12
        transition = begins and not going
        if begins:
            going = True
        elif d < 0.12:
            going = False
        follows = diffs[i + 1] if i + 1 < len(diffs) else 1.0
        out.append((transition, (d >= 0.08 and follows <= 0.05) or d >= 0.30 or transition))
    return out


def test_cuts(spark):
    r = random.Random(4)
    data, want = [], []
    for k in range(80):
        diffs = [r.choice([0.0, 0.03, 0.05, 0.06, 0.08, 0.11, 0.12, 0.13, 0.2, 0.3, 0.31]) for _ in range(r.randint(0, 25))]
        data += [(k, 0, None)] + [(k, i + 1, d) for i, d in enumerate(diffs)]
        want += [(k, 0, False, False)] + [(k, i + 1, *w) for i, w in enumerate(walk_cuts(diffs))]
    df = spark.createDataFrame(data, "k int, i int, d double").repartition(3)
    assert rows(timeline.visual_cuts(df, ["k"], "i", "d").select("k", "i", "transition", "cut")) == sorted(want)


def walk_samples(duration, gap, margin, target, least):
    if duration <= 0:
        return []
    end = duration - margin if duration > margin else duration
    step = max(gap, end // target)
    times = [0]
    while times[-1] + step < end:
        times.append(times[-1] + step)
    if times[-1] < end:
        times.append(end)
    if len(times) < least:
        times = [end * (2 * i + 1) // (2 * least) for i in range(least)]
    return sorted(set(times))


def test_samples(spark):
    durations = [-5, 0, 1, 2, 50_000, 100_000, 100_001, 900_000, 1_100_000, 2_100_000, 2_100_001, 7_654_321, 700_000_000]
    df = spark.createDataFrame([(d,) for d in durations], "d long")
    got = timeline.sampling_grid(df, "d").groupBy("d").agg(F.sort_array(F.collect_list("at_us")).alias("t")).collect()
    assert {r.d: r.t for r in got} == {d: t for d in durations if (t := walk_samples(d, 1_000_000, 100_000, 600, 3))}


def test_identities(spark):
    r = random.Random(6)

    def iou(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        both = max(0.0, w) * max(0.0, h)
        area = lambda c: (c[2] - c[0]) * (c[3] - c[1])
        return both / (area(a) + area(b) - both) if both else 0.0

    cos = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
    regions, tracks = [], {}
    for t in range(20):
        at = r.randint(0, 3) * 1_000_000
        kind = r.choice(["detector", "objectness_detector"]) if t % 2 else "motion_group"
        voice = np.array([r.gauss(0, 1) for _ in range(4)]) if t % 3 == 0 else np.array([1.0, 2.0, 0.5, 1.0])
        for i in range(r.randint(1, 5)):
            x, y, s = r.choice([0.1, 0.15]), r.choice([0.1, 0.12]), r.choice([0.25, 0.3])
            e = (voice + np.array([r.gauss(0, 0.2) for _ in range(4)])).tolist() if "detector" in kind and r.random() > 0.1 else []
            row = (t, i, at, [x, y, x + s, y + s], s * s, kind, r.choice([-1, 0, 0, 1]), e)
            regions.append(row)
            tracks.setdefault(t, []).append(row)
            at += 500_000
    df = spark.createDataFrame(regions, "track int, region_no int, at_us long, box array<double>, area double, source string, category int, embedding array<double>")
    pairs = [(a, b, 1_000_000) for a in tracks for b in tracks if a != b]

    def appearance(p, q):
        use = lambda g: [x for x in g if "detector" in x[5] and x[7]]
        best = -1.0
        for y in use(q):
            s = sorted((cos(x[7], y[7]) for x in use(p) if x[6] < 0 or y[6] < 0 or x[6] == y[6]), reverse=True)
            if len(s) >= 2:
                best = max(best, s[1])
        return best

    want = {}
    for a, b, since in pairs:
        p, q = tracks[a], tracks[b]
        hits = [m for y in q if y[2] >= since for m in [max((iou(x[3], y[3]) for x in p if x[2] == y[2]), default=0.0)] if m > 0]
        overlap = sum(hits) / len(hits) if hits else 0.0
        areas = [sum(x[4] for x in g) / len(g) for g in (p, q)]
        forward, gap = appearance(p, q), q[0][2] - p[-1][2]
        again = -1.0
        if min(areas) / max(areas) >= 0.60:
            if forward >= 0.90:
                again = forward
            elif gap >= 1_000_000 and min(forward, appearance(q, p)) >= 0.85:
                again = min(forward, appearance(q, p))
        moving = all(x[5] == "motion_group" for x in p + q)
        ends = iou(p[-1][3], q[0][3])
        want[a, b] = (overlap, again, ends if moving and 0 < gap <= 1_000_000 and ends >= 0.5 else -1.0)
    got = timeline.identity_scores(spark.createDataFrame(pairs, "before int, after int, overlap_start_us long"), df).collect()
    assert len(got) == len(pairs)
    for x in got:
        assert (x.overlap, x.reacquired, x.group) == pytest.approx(want[x.before, x.after], abs=1e-9), (x.before, x.after)
    assert {w[1] > 0 for w in want.values()} == {w[2] > 0 for w in want.values()} == {True, False}


def test_reuse_of_readings(spark):
    r = np.random.default_rng(7)
    w, h = 40, 30
    first = r.integers(0, 256, (h, w, 3)).astype(np.uint8)
    still, other = [5, 5, 25, 15], [26, 16, 38, 28]
    rasters = [first.copy() for _ in range(7)]
    rasters[1][20:, 28:] = 255 - rasters[1][20:, 28:]  # the second box changes in the second picture
    frames = [("p", i, w, h, bytes(x.tobytes())) for i, x in enumerate(rasters) if i != 5]
    boxes = [("p", i, n, b, f"text {i}.{n}", 0.5 + i / 100) for i in range(7) for n, b in enumerate([still, other])]
    got = ocr.reuse_readings(
        spark.createDataFrame(boxes, "package_id string, sample long, box_no long, box array<int>, text string, score double").repartition(3),
        spark.createDataFrame(frames, "package_id string, sample long, width int, height int, rgb binary"),
    )
    seen = {(x.sample, x.box_no): (x.reused, x.text) for x in got.collect()}
    assert len(seen) == 14
    assert [seen[i, 0] for i in range(7)] == [
        (False, "text 0.0"), (True, "text 0.0"), (True, "text 0.0"),  # a group of three samples
        (False, "text 3.0"), (True, "text 3.0"), (False, "text 5.0"),  # no picture of the sixth sample
        (False, "text 6.0"),
    ]
    assert [seen[i, 1] for i in range(3)] == [(False, "text 0.1"), (False, "text 1.1"), (False, "text 2.1")]


def test_one_reading_goes_to_one_box():
    frame = (1, np.zeros((50, 50), np.uint8))
    samples = [(0, frame, [(0, 0, 10, 10)]), (1, frame, [(0, 0, 10, 9), (0, 0, 10, 10)]), (2, frame, [(30, 30, 30, 40), (0, 0, 10, 10)])]
    assert ocr.read_group(samples) == [(0, 0, False, 0, 0), (1, 0, False, 1, 0), (1, 1, True, 0, 0), (2, 0, False, 2, 0), (2, 1, True, 0, 0)]
    assert ocr.read_group([(0, frame, [(0, 0, 9, 9)]), (2, frame, [(0, 0, 9, 9)])])[1][2] is False  # a sample is missing between


# --- joins, documents, findings ---------------------------------------------------------------------------------------
def test_spans_of_all_lengths(spark):
    r = random.Random(8)

    def spans(n):
        out = []
        for i in range(n):
            length = int(10 ** r.uniform(0, 10)) if r.random() > 0.1 else r.choice([0, -5, 1, 1_000_000, 2_000_000])
            s = r.randint(-(10**9), 10**10)
            out.append((i, s, s + length))
        return out

    a, b = spans(150), spans(150)
    da = spark.createDataFrame(a, "i int, l_start long, l_end long")
    db = spark.createDataFrame(b, "j int, r_start long, r_end long")
    want = sorted((i, j) for i, s, e in a for j, t, u in b if s < e and t < u and s < u and t < e)
    assert rows(intervals.overlap_join(da, db, 1_000_000).select("i", "j")) == want
    points = [(i, s) for i, s, _ in a] + [(1000 + i, e) for i, _, e in a]
    dp = spark.createDataFrame(points, "p int, at long")
    held = sorted((p, j) for p, at in points for j, t, u in b if t <= at < u)
    assert rows(intervals.point_join(dp, db, 1_000_000, "at", ("r_start", "r_end")).select("p", "j")) == held
    long = spark.createDataFrame([(1, 0, 36_000_000_000)], "i int, l_start long, l_end long")  # ten hours
    assert intervals._bins(long, "l_start", F.col("l_end") - 1, intervals._level(F.col("l_end") - F.col("l_start"), 1_000_000), [], 1_000_000, "_bin").count() <= 3
    assert intervals.overlap_join(da.limit(0), db, 1_000_000).count() == 0


@pytest.mark.parametrize("depth", [1, 7, 8, 9, 20, 60])
def test_difference_at_any_depth(spark, depth):
    doc = lambda x: '{"a":' * depth + str(x) + "}" * depth
    of = lambda x: spark.createDataFrame([(1, doc(x))], "i int, t string").select("i", F.parse_json("t").alias("v"))
    got = equivalence.compare_json(of(1), of(2), "v", ["i"], []).collect()
    assert [(x.pointer, x.verdict) for x in got] == [("/a" * depth, "changed")]


def test_schema_rules_in_one_pass(spark):
    df = spark.createDataFrame([("1", "ab", [1, 2, 3]), (None, "x", [])], "id string, s string, a array<int>")
    schema = {"required": ["id"], "properties": {"s": {"pattern": "^a"}, "a": {"minItems": 1, "maxItems": 2}}}
    found = validate.schema_findings(df, schema, F.coalesce("id", F.lit("?")))
    assert rows(found.select("key", "message")) == [("1", "a has too many items"), ("?", "a has too few items"), ("?", "id is missing"), ("?", "s does not match")]
    assert str(found._jdf.queryExecution().optimizedPlan()).count("LogicalRDD") == 1
    assert validate.schema_findings(df, {}, F.col("id")).count() == 0


def test_health_of_an_empty_graph(spark):
    edges = spark.createDataFrame([], "source_id string, target_id string, relationship_class string")
    objects = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    got = graph.health(edges, objects).first().asDict()
    assert got == {"total_edges": 0, "support_edges": 0, "semantic_edges": 0, "unknown_edges": 0, "total_nodes": 0, "unresolved_endpoints": 0, "orphan_objects": 1, "total_objects": 1}


# --- scenes and recognised text -----------------------------------------------------------------------------------------
def test_scenes_by_a_walk(spark):
    r = random.Random(10)
    names = ("blue", "gray", "green", "red")
    data, want = [], []
    for k in range(40):
        covers = []
        for _ in range(r.randint(1, 14)):
            if covers and r.random() < 0.5:
                covers.append(dict(covers[-1]))
                continue
            parts = [r.choice([0, 0, 1, 2, 5]) for _ in names]
            total = sum(parts) or 1
            covers.append({n: p / total for n, p in zip(names, parts) if p or r.random() < 0.3})
        data += [(k, i, i * 100, c) for i, c in enumerate(covers)]
        runs = []
        top = lambda c: min(names, key=lambda n: (-c.get(n, 0.0), n))
        diverse = lambda c: sum(c.get(n, 0.0) >= 0.05 for n in names if n != "gray")
        for i, c in enumerate(covers):
            p = covers[i - 1] if i else None
            new = p is None or top(c) != top(p) or sum(abs(c.get(n, 0.0) - p.get(n, 0.0)) for n in names) > 0.5 or abs(c.get(top(p), 0.0) - p.get(top(p), 0.0)) > 0.35 or abs(diverse(c) - diverse(p)) >= 2
            runs = runs + [[i]] if new else runs[:-1] + [runs[-1] + [i]]
        merged = []
        for run in runs:  # a short run joins the scene before it
            if merged and len(run) < 3:
                merged[-1] += run
            else:
                merged.append(list(run))
        if len(merged) > 1 and len(merged[0]) < 3:  # the first joins the one after it
            merged[1] = merged[0] + merged[1]
            merged.pop(0)
        want += [(k, n, m[0] * 100, m[-1] * 100, len(m)) for n, m in enumerate(merged)]
    df = spark.createDataFrame(data, "k int, i int, at long, bucket_coverage map<string,double>").repartition(3)
    got = timeline.scenes(df, "k", "i", "at", 3, buckets=names).select("k", "scene", "start_us", "end_us", "frames")
    assert rows(got) == sorted(want)


def test_observations_by_a_walk(spark):
    r = random.Random(11)
    key = lambda t: "".join(c for c in t.lower() if c.isascii() and c.isalnum())

    def digits_read(t):  # whole texts are single runs here
        if any(c.isdigit() for c in t) and not any(c.isalpha() and c not in "OoIlSB" for c in t):
            return ("S" if t.startswith("S") else "") + t[t.startswith("S") :].translate(str.maketrans("OoIlSB", "001158"))
        return t

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i] + [0] * len(b), row
            for j, y in enumerate(b, 1):
                row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
        return row[-1]

    def alike(a, b):
        if a == b:
            return True
        digits = lambda t: [c for c in t if c.isdigit()]
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        if digits(a) != digits(b):
            return False
        for front in range(3):
            for back in range(3):
                piece = short[front : len(short) - back]
                if len(short) > front + back and 2 * len(piece) >= len(long) and piece in long:
                    return True
        return not long or 1 - distance(short, long) / len(long) >= 0.8

    def iou(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h) if w > 0 and h > 0 else 0.0

    texts = ["Openinghours", "Openinghour", "0peninghours", "penin", "Total100", "Total1O0", "Total200", "1O0", "100", "IOO", "x", "Exit", "Exlt"]
    data, want = [], []
    for package in range(12):
        items = []
        for i in range(r.randint(1, 25)):
            x, y = r.choice([0.0, 2.0, 60.0]), r.choice([0.0, 1.0])
            items.append((i, r.choice(texts), [x, y, x + 20, y + 10], r.randint(0, 12) * 1_000_000, r.randint(0, 30), round(r.random(), 2), r.random() < 0.3))
        data += [(package, *t) for t in items]
        live = [t for t in items if len(key(t[1])) >= 2]
        groups: dict = {}
        place = {}
        for t in live:
            for p in groups.setdefault(key(t[1]), []):
                if any(iou(t[2], o[2]) > 0.3 for o in p):
                    p.append(t)
                    place[t[0]] = p[0][0]
                    break
            else:
                groups[key(t[1])].append([t])
                place[t[0]] = t[0]
        top = {p: p for p in place.values()}

        def find(p):
            while top[p] != p:
                p = top[p]
            return p

        for a in live:
            for b in live:
                if abs(a[3] - b[3]) <= 5_000_000 and iou(a[2], b[2]) > 0.3 and alike(key(digits_read(a[1])), key(digits_read(b[1]))):
                    x, y = find(place[a[0]]), find(place[b[0]])
                    top[max(x, y)] = min(x, y)
        for root in sorted({find(p) for p in top}):
            own = [t for t in live if find(place[t[0]]) == root]
            read = [t[5] for t in own if not t[6]]
            readings = max(1, len(read))
            mean = sum(read) / len(read) if read else sum(t[5] for t in own) / len(own)
            if readings == 1 and mean < 0.5:
                continue
            count = {}
            for t in own:
                count[key(t[1])] = count.get(key(t[1]), 0) + 1
            best = min(count, key=lambda k: (-count[k], -len(k), k))
            raw = min((t for t in own if key(t[1]) == best), key=lambda t: (-len(t[1]), t[0]))[1]
            want.append((package, root, raw, min(t[3] for t in own), max(t[3] for t in own), len(own), readings, round(min(1.0, mean + 0.1 * (readings - 1)) if readings > 1 else mean, 9)))
    df = spark.createDataFrame(data, "package_id int, line_no long, raw_text string, box array<double>, at_us long, frame long, confidence double, reused boolean").repartition(3)
    got = ocr.reconcile(df, 10).select("package_id", "root", "raw_text", "start_us", "end_us", "detections", "readings", F.round("confidence", 9).alias("c"))
    assert rows(got) == sorted(want)


def walk_repairs(words, segments):
    """words: (text, start, end, speaker, supported); segments: (start, end, speaker). One rule after the other."""
    now = [w[3] for w in words]
    cover = []
    for _, s, e, _, _ in words:
        us = {}
        for a, b, n in segments:
            if n >= 0 and e > s and min(e, b) > max(s, a):
                us[n] = us.get(n, 0) + min(e, b) - max(s, a)
        best = min(us, key=lambda n: (-us[n], n)) if us else -1
        cover.append((best, us[best] / (e - s) if us else 0.0))
    i = 0
    while i < len(now):
        j = i
        while j + 1 < len(now) and now[j + 1] == now[i]:
            j += 1
        if i and j + 1 < len(now) and j - i < 2 and words[j + 1][1] - words[j][2] <= 750_000 and now[i - 1] == now[j + 1] and now[i] != now[i - 1]:
            for k in range(i, j + 1):
                now[k] = now[i - 1]
        i = j + 1
    for k in range(1, len(segments)):
        begin, n = segments[k][0], segments[k][2]
        if n == segments[k - 1][2] or n < 0:
            continue
        late = [i for i, w in enumerate(words) if 0 <= w[1] + (w[2] - w[1]) // 2 - begin <= 250_000]
        if not late or now[late[0]] == n:
            continue
        for i in range(late[0] + 1, min(len(words), late[0] + 5)):
            if words[i][1] - words[i - 1][2] > 750_000:
                break
            if now[i] == n:
                for x in range(late[0], i):
                    now[x] = n
                break
    i = 0
    while i < len(now):
        j = i
        while j + 1 < len(now) and now[j + 1] == now[i]:
            j += 1
        run = range(i, j + 1)
        if len(run) <= 3 and any(words[k][0][-1:] in (".", "?", "!", ",", ";", ":") and words[k][0] for k in run):
            if all(not words[k][4] and cover[k][0] >= 0 and cover[k][1] >= 0.5 and cover[k][0] != now[k] and cover[k][0] == cover[i][0] for k in run):
                for k in run:
                    now[k] = cover[i][0]
        i = j + 1
    if segments and max(n for _, _, n in segments) >= 2:
        now = [c[0] if c[0] >= 0 and c[1] >= 0.6 and not w[4] else x for x, c, w in zip(now, cover, words)]
    return now


def test_repairs_by_a_walk(spark):
    r = random.Random(13)
    words, segs, want = [], [], []
    for stream in range(120):
        at, own = 0, []
        few = r.choice([1, 2, 3])
        for _ in range(r.randint(1, 40)):
            n = r.choice([100_000, 200_000, 300_000, 0])
            own.append((r.choice(["a", "b.", "c,", "", "d"]), at, at + n, own[-1][3] if own and r.random() < 0.6 else r.randint(-1, few), r.random() < 0.1))
            at += n + r.choice([0, 0, 50_000, 800_000])
        turn, seg = 0, []
        while turn < at and r.random() > 0.02:
            n = r.choice([150_000, 400_000, 900_000])
            seg.append((turn, turn + n, r.randint(-1 if r.random() < 0.1 else 0, few)))
            turn += n - r.choice([0, 0, 60_000])
        words += [(stream, i, *w) for i, w in enumerate(own)]
        segs += [(stream, i, s, e, n) for i, (s, e, n) in enumerate(seg)]
        want += [(stream, i, n) for i, n in enumerate(walk_repairs(own, seg))]
    w = spark.createDataFrame(words, "stream int, word_no long, text string, start_us long, end_us long, speaker int, supported boolean").repartition(3)
    g = spark.createDataFrame(segs, "stream int, seg_no long, start_us long, end_us long, speaker int")
    got = transcript.repair_speakers(w, g)
    assert got.columns == ["stream", "word_no", "text", "start_us", "end_us", "supported", "speaker"]
    assert rows(got.select("stream", "word_no", "speaker")) == sorted(want)
    alternating = [0, 1, 0, 1, 0]
    transcript.join_islands(alternating, [0, 1, 2, 3, 4], [1, 2, 3, 4, 5])
    assert alternating == [0] * 5


def test_shot_borders_by_a_walk(spark):
    r = random.Random(14)
    shots, lengths, want = [], [], []
    for k in range(60):
        n = r.randint(1, 12)
        spans = [(a, a + r.randint(0, 30)) for a in (r.randint(0, 200) for _ in range(n))]
        spans = sorted(spans) if k % 2 else spans
        d = r.choice([0, 3, 50, 100, 300])
        shots += [(k, i, *s) for i, s in enumerate(spans)]
        lengths.append((k, d))
        border = [0] + [(spans[i - 1][1] + spans[i][0]) // 2 for i in range(1, n)] + [d]
        step = 1 if d >= n else 0
        for i in range(1, n + 1):
            border[i] = max(border[i], border[i - 1] + step)
        if border[n] > d:
            border[n] = d
            for i in range(n, 0, -1):
                border[i - 1] = min(border[i - 1], border[i] - step)
        want += [(k, i, border[i], border[i + 1]) for i in range(n)]
    df = spark.createDataFrame(shots, "k int, shot_no int, first_us long, last_us long").repartition(3)
    got = timeline.shot_spans(df, spark.createDataFrame(lengths, "k int, duration_us long"), ["k"])
    assert rows(got.select("k", "shot_no", "from_us", "to_us")) == sorted(want)


def test_color_targets(spark):
    f = spark.createDataFrame([("p", "a", 1, False), ("p", "b", 2, True), ("p", "c", 3, False)], "k string, frame_id string, at_us long, keyframe boolean")
    g = spark.createDataFrame([("p", "shot", 0, "s1", 0, 9, ["c", "b", "a"]), ("p", "scene", 0, "z1", 0, 9, ["c", "a"]), ("p", "shot", 1, "s2", 0, 9, ["zz"])], "k string, target_type string, target_no int, target_id string, start_us long, end_us long, frame_ids array<string>")
    t = timeline.color_targets(f, g, ["k"])
    assert {x.target_id: (x.frame_ids, x.sampling_basis) for x in t.collect()} == {
        "a": (["a"], "full_frame"), "b": (["b"], "full_frame"), "c": (["c"], "full_frame"), "s1": (["b"], "keyframe_full_frame"), "z1": (["c", "a"], "keyframe_full_frame"),
    }
    assert rows(timeline.missing_frames(f, g, ["k"])) == [("p", "shot", "s2", "zz")]
    px = spark.createDataFrame([("p", "a", "red", 3), ("p", "b", "blue", 1), ("p", "c", "blue", 3)], "k string, frame_id string, bucket string, n long")
    got = timeline.color_records(t, px, ["k"], ("blue", "red")).orderBy("color_observation_id").collect()
    assert [(x.color_observation_id[-1], x.target_id, x.dominant_bucket) for x in got] == [("1", "a", "red"), ("2", "b", "blue"), ("3", "c", "blue"), ("4", "z1", "blue"), ("5", "s1", "blue")]
    assert got[3].bucket_coverage == {"blue": 0.5, "red": 0.5} and got[3].coverage_total == 1.0
