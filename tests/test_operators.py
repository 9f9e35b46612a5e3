import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import audio, edges, equivalence, export, graph, index, intervals, ocr, search, timeline, transcript, validate
from lumenframe.sources import blocks


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_limits_and_colours(spark):
    w = spark.createDataFrame([(1, "Hello", "hello"), (2, None, "HELLO there"), (3, "x", None)], "line_no long, text string, normalized_text string")
    assert [r.line_no for r in search.find_words(w, "hEl").collect()] == [1, 2]
    assert [r.line_no for r in search.find_words(w, "", 0).collect()] == [1]
    c = spark.createDataFrame([(1, "red", {"red": 0.2}), (2, "dark red", {"red": 0.9}), (3, "", {}), (4, "red", {"red": 0.7})], "line_no long, dominant_bucket string, bucket_coverage map<string,double>")
    assert [r.line_no for r in search.list_color_observations(c, "RED", 0.5).collect()] == [2, 4]
    assert [r.line_no for r in search.list_color_observations(c, None, 0.5).collect()] == [2, 3, 4]
    e = spark.createDataFrame([(1, "near"), (2, "has_mask"), (3, "zzz")], "line_no long, type string")
    assert rows(search.relationship_summary(e)) == [(3, 1, 1, 1)]
    assert [r.line_no for r in search.list_relationships(e, "unknown").collect()] == [3]


def test_transcript_summary(spark):
    doc = spark.createDataFrame([("p", True), ("q", False)], "package string, parsed boolean")
    w = spark.createDataFrame([("p",), ("p",), ("q",)], "package string")
    got = rows(search.transcript_summary(doc, w, w.limit(0), w.filter("package = 'p'")), "package")
    assert got == [("p", True, 2, 0, 2), ("q", False, None, None, None)]


def test_time_windows(spark):
    e = spark.createDataFrame([(1, 5, 5), (2, 0, 5), (3, 5, 9), (4, 9, 9)], "i int, start_us long, end_us long")
    f = lambda **k: [r.i for r in e.filter(intervals.in_window(F.col("start_us"), F.col("end_us"), **k)).orderBy("i").collect()]
    assert f() == [1, 2, 3, 4] and f(at_us=5) == [1, 3] and f(start_us=5, end_us=9) == [1, 3] and f(end_us=5) == [2]
    with pytest.raises(ValueError):
        intervals.in_window(F.col("a"), F.col("b"), at_us=1, end_us=2)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_range_joins_against_brute_force(spark, width):
    r = random.Random(width)
    a = [(i, s := r.randint(-50, 50), s + r.randint(0, 20)) for i in range(60)]
    b = [(i, s := r.randint(-50, 50), s + r.randint(-3, 30)) for i in range(60)]
    x, y = spark.createDataFrame(a, "i int, l_start long, l_end long"), spark.createDataFrame(b, "j int, r_start long, r_end long")
    want = sorted((i, j) for i, s, e in a for j, t, u in b if s < e and t < u and s < u and t < e)
    assert rows(intervals.overlap_join(x, y, width).select("i", "j"), "i", "j") == want
    want = sorted((i, j) for i, s, _ in a for j, t, u in b if t <= s < u)
    assert rows(intervals.point_join(x, y, width, "l_start", ("r_start", "r_end")).select("i", "j"), "i", "j") == want
    plan = intervals.overlap_join(x, y, width)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_spans(spark):
    s = spark.createDataFrame([("a", 0, 10), ("a", 10, 12), ("a", 13, 15), ("a", 2, 3), ("a", 20, 20), ("b", 5, 1)], "k string, start long, end long")
    assert rows(intervals.merge_spans(s, ["k"], "start", "end").select("start", "end", "parts"), "start") == [(0, 12, 3), (13, 15, 1)]
    assert rows(intervals.merge_spans(s, ["k"], "start", "end", 1).select("start", "end"), "start") == [(0, 15)]
    t = spark.createDataFrame([("a", 11, 14)], "k string, start long, end long")
    assert rows(intervals.intersect_spans(s, t, ["k"], 10), "start") == [("a", 11, 12), ("a", 13, 14)]
    assert rows(intervals.shared_ratio(s, t, ["k"], 10).select("both_us", "ratio")) == [(2, pytest.approx(2 / 3))]


def test_loudness(spark):
    w = spark.createDataFrame([("s", 0, 10, -20.0, -1.0), ("s", 10, 20, -60.0, None), ("s", 20, 30, None, -3.0), ("q", 0, 10, -80.0, None), ("s", 5, 5, -1.0, 9.0)], "target_id string, start_us long, end_us long, momentary_lufs double, true_peak_dbtp double")
    assert rows(audio.loudness_range(w, 5, 25), "target_id") == [("q", 1, 5, None, None), ("s", 3, 20, -20.0, -1.0)]
    with pytest.raises(ValueError):
        audio.loudness_range(w, 5, 5)
    b = spark.createDataFrame([("s", 0, 10, [10.0, None] + [0.0] * 10), ("s", 10, 20, [20.0, 5.0] + [0.0] * 10)], "target_id string, start_us long, end_us long, bands array<double>")
    got = rows(audio.spectrum_range(b, 0, 20).select("band", "window_count", "mean_db", "max_db"), "band")
    assert len(got) == 10 and got[0] == (0, 2, 17.4, 20.0) and got[1] == (1, 1, 5.0, 5.0)
    t = np.arange(19200) / 48000
    levels = audio.band_levels(np.sin(2 * np.pi * 1000 * t), 48000)
    assert int(np.argmax(levels)) == 5 and levels[5] == pytest.approx(10 * np.log10(0.5), abs=0.3)


def queue_search(edge_list, start, depth, direction, limit):
    """The search with a queue, for comparison."""
    out, into = {}, {}
    for i, (_, s, t) in enumerate(edge_list):
        out.setdefault(s, []).append(i)
        into.setdefault(t, []).append(i)
    seen, nodes, found, done, queue, hit = {start}, [(start, 0)], [], set(), [(start, 0)], False
    while queue and not hit:
        at, d = queue.pop(0)
        if d >= depth:
            continue
        slots = [(i, 0) for i in out.get(at, [])] * (direction != "incoming") + [(i, 1) for i in into.get(at, [])] * (direction != "outgoing")
        for i, side in slots:
            if limit is not None and len(found) >= limit:
                hit = True
                break
            rid, s, t = edge_list[i]
            if rid:
                if rid in done:
                    continue
                done.add(rid)
            found.append((i, side, d + 1))
            n = t if side == 0 else s
            if n not in seen:
                seen.add(n)
                nodes.append((n, d + 1))
                queue.append((n, d + 1))
    return nodes, found, hit


@pytest.mark.parametrize("seed", range(5))
def test_traversal_against_a_queue(spark, seed):
    r = random.Random(seed)
    e = [(r.choice(["", f"r{r.randint(0, 30)}"]), f"n{r.randint(0, 9)}", f"n{r.randint(0, 9)}") for _ in range(25)]
    df = spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(e)], "edge_idx long, relationship_id string, source_id string, target_id string").repartition(3)
    direction, limit, depth = r.choice(["both", "outgoing", "incoming"]), r.choice([None, 0, 3, 8, 25]), r.choice([1, 2, 3])
    t = graph.traverse(df, "n0", depth, direction, limit)
    nodes, found, hit = queue_search(e, "n0", depth, direction, limit)
    assert rows(t.nodes.select("node", "depth", "node_rank"), "node_rank") == [(n, d, i) for i, (n, d) in enumerate(nodes)]
    assert rows(t.edges.select("edge_idx", "dir", "depth", "edge_rank"), "edge_rank") == [(i, s, d, k + 1) for k, (i, s, d) in enumerate(found)]
    assert t.limit_applied == hit


def test_paths_context_health(spark):
    e = [("a", "n0", "n1"), ("b", "n1", "n2"), ("c", "n0", "n3"), ("d", "n3", "n2"), ("e", "n2", "n2"), ("f", "n4", "gone")]
    df = spark.createDataFrame([(i, *x, "near", 0, 0) for i, x in enumerate(e)], "edge_idx long, relationship_id string, source_id string, target_id string, type string, start_us long, end_us long")
    df = graph.select_edges(df)
    assert [s["edge_idx"] for s in graph.shortest_path(df, "n0", "n2", 3, "outgoing")] == [0, 1]
    assert graph.shortest_path(df, "n0", "n0") == [] and graph.shortest_path(df, "n0", "n4", 5) is None
    assert rows(graph.star(df, "n2").select("edge_idx", "direction"), "edge_idx") == [(1, "incoming"), (3, "incoming"), (4, "outgoing")]
    assert rows(graph.context(df, "n1", 1).nodes.select("node"), "node") == [("n0",), ("n2",)]
    objects = spark.createDataFrame([(f"n{i}", "frame") for i in range(6)], "id string, kind string")
    h = graph.health(df, objects).first()
    assert (h.total_edges, h.total_nodes, h.unresolved_endpoints, h.orphan_objects, h.total_objects) == (6, 6, 1, 1, 6)
    assert rows(graph.orphans_by_layer(df, objects)) == [("frame", 1)]


def test_masks_and_depth(spark):
    m = lambda *on: blocks.rle_encode(np.isin(np.arange(16), on))
    data = [("f", "a", 1, 4, 4, m(0, 1, 2, 3), 1.0), ("f", "b", 2, 4, 4, m(2, 3, 4), 2.0), ("f", "c", 3, 4, 4, m(0, 1), None), ("f", "d", 4, 2, 8, m(0), 1.0), ("g", "e", 1, 4, 4, m(0), 1.0)]
    df = spark.createDataFrame(data, "frame_id string, region_id string, line_no long, width int, height int, rle binary, depth double")
    got = {(r.source_id, r.target_id, r.type) for r in edges.mask_relations(df).collect()}
    assert got == {("a", "b", "occludes"), ("b", "a", "occluded_by"), ("a", "c", "overlaps"), ("a", "c", "contains"), ("c", "a", "contained_by")}
    assert ("b", "a", "occludes") in {(r.source_id, r.target_id, r.type) for r in edges.mask_relations(df, "spec").collect()}
    d = {(r.source_id, r.target_id, r.type) for r in edges.depth_relations(df).collect()}
    assert ("a", "b", "foreground_relative_to") in d and ("b", "a", "background_relative_to") in d and len(d) == 4


def test_reference_builders(spark):
    obs = spark.createDataFrame([("o1", 1, 0, 5, ["c1", "zz", "c2"])], "text_observation_id string, line_no long, start_us long, end_us long, evidence_crop_refs array<string>")
    crops = spark.createDataFrame([("c1",), ("c2",)], "crop_id string")
    colors = spark.createDataFrame([("k1", "frame", "f1", 1), ("k2", "frame", "f9", 2), ("k3", "odd", "x", 3)], "id string, target_type string, target_id string, line_no long").withColumn("start_us", F.lit(0)).withColumn("end_us", F.lit(0))
    frames = spark.createDataFrame([("f1",)], "id string")
    kinds = edges.by_target_kind(5, colors, "id", "target_type", "target_id", {"frame": (frames, "id")}, "rel_color_target_", "color_observation_of")
    all_ = edges.number(edges.evidence_crops(2, obs, crops).unionByName(kinds))
    assert rows(all_.select("id", "source_id", "target_id"), "seq") == [("rel_obs_crop_000001", "o1", "c1"), ("rel_obs_crop_000002", "o1", "c2"), ("rel_color_target_000003", "k1", "f1"), ("rel_color_target_000004", "k3", "x")]
    assert edges.dangling(colors, "target_id", frames, "id").count() == 2
    regions = spark.createDataFrame([("e1", 1, 0, [0.0, 0.0, 1.0, 1.0]), ("e2", 2, None, [0.0, 0.0, 1.0, 1.0])], "entity_id string, line_no long, pts_us long, box_norm array<double>")
    shots = spark.createDataFrame([("s1", 1, 0, 10), ("s2", 2, 5, 5)], "id string, line_no long, start_us long, end_us long")
    assert rows(edges.point_in_spans(13, regions, shots, "id", "rel_entity_shot_", "appears_in_shot").select("source_id", "target_id")) == [("e1", "s1")]
    texts = spark.createDataFrame([("t1", 1, 0, 1, [0.5, 0.5, 2.0, 2.0])], "text_region_id string, line_no long, start_us long, end_us long, bbox_norm array<double>")
    assert rows(edges.text_entity_overlaps(11, texts, regions).select("source_id", "target_id")) == [("t1", "e1")]


def test_speakers(spark):
    words = spark.createDataFrame([(1, 0, 10), (2, 100, 110), (3, 700_000, 700_010), (4, 5, 5), (5, 610_010, 610_020)], "word_no long, start_us long, end_us long")
    segs = spark.createDataFrame([(1, "A", 5, 10), (2, "B", 0, 5), (3, "C", 110, 200)], "seg_no long, speaker_id string, start_us long, end_us long")
    got = rows(transcript.assign_speakers(words, segs).select("word_no", "speaker_id"), "word_no")
    # Ties go to the first segment; a touching segment is at distance 0; more than half a second away is nobody's.
    assert got == [(1, "A"), (2, "C"), (3, "speaker_unknown"), (4, "A"), (5, "speaker_unknown")]
    edge = spark.createDataFrame([(1, 500_200, 500_300), (2, 500_201, 500_300)], "word_no long, start_us long, end_us long")
    assert rows(transcript.assign_speakers(edge, segs).select("word_no", "speaker_id"), "word_no") == [(1, "C"), (2, "speaker_unknown")]
    per = rows(transcript.overlap_per_speaker(words, segs).select("word_no", "speaker_id", "overlap_us", "share"), "word_no", "speaker_id")
    assert per[:2] == [(1, "A", 5, 0.5), (1, "B", 5, 0.5)]


def test_viterbi_against_enumeration():
    import itertools

    r = np.random.default_rng(2)
    f = np.float32
    for _ in range(20):
        n, k = 6, 3
        seg = r.integers(-1, k, n).tolist()
        sim = r.uniform(-1.2, 1, (n, k))
        start = np.cumsum(r.choice([100, 900_000], n)).tolist()
        end = [s + 50 for s in start]
        closes = (r.random(n) < 0.3).tolist()
        got = transcript.viterbi_speakers(seg, sim, start, end, closes, k)

        def value(path):
            total = f(0)
            for i, s in enumerate(path):
                e = transcript.UNKNOWN if not 0 <= seg[i] < k else transcript.AGREE if seg[i] == s else transcript.DISAGREE
                total += f(e) + (f(sim[i, s]) * f(4) if sim[i, s] > -1 else f(0))
                if i and path[i - 1] != s:
                    total -= f(0.15 if closes[i - 1] or start[i] - end[i - 1] > 750_000 else 0.25 if seg[i - 1] >= 0 and seg[i] >= 0 and seg[i - 1] != seg[i] else 0.85)
            return total

        best = max(map(value, itertools.product(range(k), repeat=n)))
        assert value(got) == pytest.approx(best, abs=1e-4)


def test_utterances_and_chunks(spark):
    w = [("s", i, "word" if i % 12 else "end.", i * 1000, i * 1000 + 500, "B" if 3 <= i <= 11 else "A") for i in range(24)]
    df = spark.createDataFrame(w, "k string, word_no long, text string, start_us long, end_us long, speaker_id string")
    segs = spark.createDataFrame([("s", "A", 0, 100), ("s", "B", 0, 50)], "k string, speaker_id string, start_us long, end_us long")
    got = dict(rows(transcript.expand_sustained_speakers(df, segs, ["k"]).select("word_no", "speaker_id"), "word_no"))
    assert {got[i] for i in range(1, 13)} == {"B"} and got[0] == "A" and got[13] == "A"
    none = transcript.expand_sustained_speakers(df, segs.filter("k = 'other'"), ["k"])
    assert rows(none.select("word_no", "speaker_id"), "word_no") == [(x[1], x[5]) for x in w]  # no segments: words stay


def test_voices():
    r = np.random.default_rng(0)
    base = np.eye(3)
    x = np.concatenate([base[i] + r.normal(0, 0.02, (6, 3)) for i in range(3)])
    assert transcript.cluster_observations(x) == [0] * 6 + [1] * 6 + [2] * 6
    assert transcript.speaker_count(x) == 3 and transcript.speaker_count(x[:1]) == 1
    assert len(set(transcript.cluster_observations(x[:2], cannot={(0, 1)}))) == 2


def test_scenes(spark):
    cov = [{"red": 1.0}, {"red": 0.95, "blue": 0.05}, {"blue": 0.9, "red": 0.1}, {"red": 1.0}, {"red": 1.0}]
    f = spark.createDataFrame([("p", i, i * 10, c) for i, c in enumerate(cov)], "k string, i int, at long, bucket_coverage map<string,double>")
    assert [r.boundary for r in timeline.scene_boundaries(f, ["k"], "i").orderBy("i").collect()] == [True, False, True, True, False]
    got = rows(timeline.scenes(f, "k", "i", "at", 2).select("scene", "start_us", "end_us", "frames"), "scene")
    assert got == [(0, 0, 20, 3), (1, 30, 40, 2)]
    assert timeline.merge_short([1, 3, 1, 2], 2) == [0, 0, 0, 1] and timeline.merge_short([1, 1], 1) == [0, 1]
    t = timeline.associate(pd.DataFrame([(0, "a", [0, 0, 2, 2]), (1, "b", [0, 0, 2, 2.2]), (1, "c", [5, 5, 6, 6]), (2, "d", [5, 5, 6, 6.1])], columns=["frame", "region", "box"]))
    assert t["track"].tolist() == [0, 0, 1, 1]


def test_reconcile(spark):
    d = [("p", i, t, [0.0, 0.0, 10.0, 5.0], at, i, 0.6, False) for i, (t, at) in enumerate([("Rent $1O0", 0), ("Rent $100", 1_000_000), ("Rent $100", 2_000_000), ("Rent $200", 2_500_000), ("zz", 9_000_000)])]
    d += [("p", 9, "low", [50.0, 50.0, 60.0, 60.0], 0, 0, 0.1, False)]
    df = spark.createDataFrame(d, "package_id string, line_no long, raw_text string, box array<double>, at_us long, frame long, confidence double, reused boolean")
    got = rows(ocr.reconcile(df, 10).select("raw_text", "start_us", "end_us", "detections", "confidence"), "start_us")
    assert got == [("Rent $100", 0, 2_000_000, 3, pytest.approx(0.8)), ("Rent $200", 2_500_000, 2_500_000, 1, 0.6), ("zz", 9_000_000, 9_000_000, 1, 0.6)]
    e = ocr.emit_records(ocr.reconcile(df, 10), 100, 50, ["package_id"]).orderBy("start_us").first()
    assert e.text_region_id == "text_region_000001" and e.bbox_norm == [0.0, 0.0, 0.1, 0.1] and e.bbox_px == [0, 0, 10, 5]


def test_validation(spark):
    w = spark.createDataFrame([("a", 1, 0, 10), ("a", 2, 20, 30), ("a", 3, 25, 26), ("a", 4, 28, 40)], "t string, i int, s long, e long")
    assert rows(validate.out_of_order(w, "t", ["i"], "s", "e").select("i", "reach"), "i") == [(3, 30), (4, 30)]
    b = spark.createDataFrame([(1, [0.0, 0.0, 1.0, 1.0]), (2, [0.0, 0.0, 1.0]), (3, [0.5, 0.0, 0.5, 1.0]), (4, [0.0, 0.0, 2.0, 1.0])], "i int, b array<double>")
    assert [r.i for r in b.filter(validate.bad_box(F.col("b"))).orderBy("i").collect()] == [2, 3, 4]
    c = spark.createDataFrame([(1, {"red": 0.5, "blue": 0.5}, 1.0, "blue"), (2, {"red": 0.6, "blue": 0.4}, 1.0, "blue"), (3, {"red": 0.5}, 0.5, "red"), (4, {"zz": 1.0}, 1.0, "zz")], "i int, m map<string,double>, t double, d string")
    assert [r.i for r in c.filter(validate.bad_coverage(F.col("m"), F.col("t"), F.col("d"), ("red", "blue"))).orderBy("i").collect()] == [2, 3, 4]
    s = spark.createDataFrame([("1", "person", 0.5), (None, "dog", 2.0), ("x", None, -1.0)], "id string, kind string, c double")
    schema = {"required": ["id"], "properties": {"id": {"type": "integer"}, "kind": {"enum": ["person"]}, "c": {"minimum": 0, "maximum": 1}}}
    assert validate.schema_findings(s, schema, F.col("id")).count() == 5
    f = spark.createDataFrame([("W", "warning"), ("E", "error")], "code string, severity string")
    assert validate.status(f).first().status == "invalid" and validate.status(f, ("W",)).first().status == "valid_with_warnings" and validate.status(f.limit(0)).first().status == "valid"


def test_equivalence(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (1, 2.0, "y"), (2, None, "z"), (3, 1.0, "w")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.05, "x"), (1, 2.5, "y"), (2, None, "z"), (4, 1.0, "w")], "k int, v double, s string")
    got = rows(equivalence.compare_tables(a, b, ["k"], {"v": 0.1}), "k", "occurrence", "column")
    assert got == [(1, 1, "v", "within_tolerance"), (1, 2, "v", "changed"), (3, 1, "*", "only_left"), (4, 1, "*", "only_right")]
    assert equivalence.verdict(equivalence.compare_tables(a, a, ["k"], {})).first().verdict == "structurally_equivalent"
    j = lambda *t: spark.createDataFrame([(i, x) for i, x in enumerate(t)], "i int, t string").select("i", F.parse_json("t").alias("v"))
    x, y = j('{"a":{"c":[1,2]},"s":"q","n":null}'), j('{"a":{"c":[1.0005,3]},"s":"r","m":1,"n":0}')
    got = {r.pointer: r.verdict for r in equivalence.compare_json(x, y, "v", ["i"], [("^/a/c/", 0.001)]).collect()}
    assert got == {"/a/c/0": "within_tolerance", "/a/c/1": "changed", "/s": "changed", "/m": "only_right", "/n": "changed"}
    p = spark.createDataFrame([("a",), ("b",)], "entry string")
    assert rows(equivalence.entry_sets(p, p.filter("entry = 'a'"))) == [("b", "left")]


def test_index(spark):
    layers = {
        "text_regions": spark.createDataFrame([(1, "r1", 0, 5), (2, "r1", 7, 9)], "line_no long, text_region_id string, start_us long, end_us long"),
        "text_observations": spark.createDataFrame([(1, "o1", "r1", "Hi there"), (2, "o2", "zz", "there")], "line_no long, text_observation_id string, text_region_id string, normalized_text string"),
        "color_observations": spark.createDataFrame([(1, "c1", "frame", "f1", {"red": 0.4, "blue": 0.6})], "line_no long, color_observation_id string, target_type string, target_id string, bucket_coverage map<string,double>"),
        "relationships": spark.createDataFrame([(1, "e", "near", "a", "b")], "line_no long, id string, type string, source_id string, target_id string"),
    }
    t = index.project(layers)
    assert rows(t["text_fts"].select("text_observation_id", "start_us"), "text_observation_id") == [("o1", 0), ("o2", None)]
    assert t["color_bucket_coverage"].count() == 2 and t["relationships"].first().relationship_class == "semantic" and t["text_regions"].count() == 1
    inv = index.inverted_index(layers["text_observations"], "text_observation_id", "normalized_text")
    assert rows(index.match(inv, ["hi", "there"], "text_observation_id")) == [("o1", 2)]
    n = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    same = index.table_digest(n.repartition(3), "n").first()
    assert same == index.table_digest(n, "n").first() and same != index.table_digest(n.distinct(), "n").first()


def test_export(spark, tmp_path):
    o = spark.createDataFrame([(1, "f1", "A"), (2, "f1", "B")], "line_no long, fid string, name string")
    r = spark.createDataFrame([(1, "f1", ["f1", "x"], '{"id":1}'), (2, "q", [], "{}")], "i int, ref string, refs array<string>, value string")
    one = export.resolve(r, "ref", o, "fid", ["name"], "frame", "line_no")
    assert [(x.frame.found, x.frame.name) for x in one.orderBy("i").collect()] == [(True, "A"), (False, None)]
    many = export.resolve_list(one, "i", "refs", o, "fid", ["name"], "frames", "line_no").orderBy("i").collect()
    assert [(x.ref, x.found, x.name) for x in many[0].frames] == [("f1", True, "A"), ("x", False, None)] and many[1].frames is None
    out = [x.value for x in export.append_resolved(one, ["frame"]).orderBy("i").collect()]
    assert out == ['{"id":1,"svp_export":{"frame":{"found":true,"name":"A"}}}', '{"svp_export":{"frame":{"found":false}}}']
    export.write_jsonl(r.select("i", "ref"), str(tmp_path / "o"), ["i"])
    assert [x.value for x in spark.read.text(str(tmp_path / "o")).collect()] == ['{"i":1,"ref":"f1"}', '{"i":2,"ref":"q"}']
    assert rows(export.with_line_numbers(r.repartition(3), ["i"]).select("i", "line_no"), "i") == [(1, 1), (2, 2)]
