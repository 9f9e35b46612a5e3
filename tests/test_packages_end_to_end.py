import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import equivalence, export, graph, intervals, microphones, relationships, transcript
from lumenframe.sources import layers

FILES = {
    "transcript/words.jsonl": ['{"id":"w1","speaker_id":"sp1","start_us":0,"end_us":100}', '{"id":"w2","speaker_id":"zz","start_us":150,"end_us":160}', "{bad"],
    "transcript/speakers.jsonl": ['{"id":"sp1"}'],
    "transcript/speaker_segments.jsonl": ['{"segment_id":"g1","speaker_id":"sp1","start_us":0,"end_us":120}', '{"id":"g2","speaker_id":"sp1","start_us":40,"end_us":300}'],
    "timeline/frames.jsonl": ['{"id":"f1","shot_id":"s1","scene_id":"none","pts_us":0}', '{"id":"f2","shot_id":"s1","pts_us":50}'],
    "timeline/shots.jsonl": ['{"id":"s1","start_us":0,"end_us":60}'],
    "timeline/scenes.jsonl": ['{"id":"c1","start_us":0,"end_us":10}'],
    "entities/entities.jsonl": ['{"id":"e1"}', '{"id":"e2"}'],
    "entities/entity_tracks.jsonl": ['{"id":"t1","entity_id":"e1"}'],
    "spatial/regions.jsonl": [
        '{"id":"r1","entity_id":"e1","track_id":"t1","frame_id":"f1","pts_us":0,"box_norm":[0,0,0.1,0.1]}', '{"id":"r2","entity_id":"e2","frame_id":"f1","pts_us":0,"box_norm":[0.1,0.1,0.2,0.2]}',
        '{"id":"r3","entity_id":"e1","frame_id":"f2","pts_us":50,"box_norm":[0.5,0,0.6,0.1]}', '{"id":"r4","entity_id":"e2","frame_id":"f2","pts_us":50,"box_norm":[0.61,0.1,0.71,0.2]}',
    ],
    "spatial/masks.index.jsonl": ['{"id":"m1","region_id":"r3"}', '{"id":"m2","region_id":"nope"}'],
    "spatial/depth.index.jsonl": ['{"id":"d1","frame_id":"f1"}'],
    "text/text_regions.jsonl": ['{"text_region_id":"x1","shot_id":"s1","scene_id":"gone","start_us":0,"end_us":60,"bbox_norm":[0,0,1,1],"confidence":0.5}'],
    "text/text_observations.jsonl": ['{"text_observation_id":"o1","text_region_id":"x1","evidence_crop_refs":["k1","k9"]}'],
    "text/numeric_values.jsonl": ['{"numeric_value_id":"n1","text_observation_id":"o1"}'],
    "text/evidence_crops.jsonl": ['{"crop_id":"k1"}'],
    "colors/color_observations.jsonl": ['{"color_observation_id":"q1","target_type":"frame","target_id":"f1"}', '{"color_observation_id":"q2","target_type":"frame","target_id":"f9"}', '{"color_observation_id":"q3","target_type":"other","target_id":"f9"}'],
    "embeddings/embeddings.index.jsonl": ['{"id":"v1","input_kind":"text_observation","input_ref":"x1"}', '{"id":"v2","input_kind":"word","input_ref":"gone"}'],
}

WANT = {
    ("appears_in_shot", "x1", "s1"), ("observation_in_region", "o1", "x1"), ("has_evidence_crop", "o1", "k1"), ("numeric_value_from_observation", "n1", "o1"), ("word_spoken_by", "w1", "sp1"),
    ("word_in_speaker_segment", "w1", "g1"), ("word_in_speaker_segment", "w2", "g2"), ("color_observation_of", "q1", "f1"), ("color_observation_of", "q3", "f9"), ("depth_for_frame", "d1", "f1"),
    ("embedding_source_is", "v1", "x1"), ("appears_in_frame", "e1", "r1"), ("appears_in_frame", "e2", "r2"), ("appears_in_frame", "e1", "r3"), ("appears_in_frame", "e2", "r4"), ("track_observation", "t1", "r1"),
    ("region_in_frame", "r1", "f1"), ("region_in_frame", "r2", "f1"), ("region_in_frame", "r3", "f2"), ("region_in_frame", "r4", "f2"), ("has_mask", "r3", "m1"), ("near", "r1", "r2"), ("near", "r3", "r4"),
    ("enters_frame", "e1", "f1"), ("enters_frame", "e2", "f1"), ("exits_frame", "e1", "f2"), ("exits_frame", "e2", "f2"), ("text_region_overlaps_entity", "x1", "e1"), ("text_region_overlaps_entity", "x1", "e2"),
    ("frame_in_shot", "f1", "s1"), ("frame_in_shot", "f2", "s1"), ("appears_in_shot", "e1", "s1"), ("appears_in_shot", "e2", "s1"), ("appears_in_scene", "e1", "c1"), ("appears_in_scene", "e2", "c1"),
    ("visible_during_speech", "x1", "g1"), ("visible_during_speech", "x1", "g2"), ("visible_during_speech", "e1", "g1"), ("visible_during_speech", "e2", "g1"), ("visible_during_speech", "e1", "g2"), ("visible_during_speech", "e2", "g2"),
    ("visible_during_word_range", "x1", "w1"), ("speaker_active_during_entity_visible", "g1", "e1"), ("speaker_active_during_entity_visible", "g1", "e2"), ("speaker_active_during_entity_visible", "g2", "e1"),
    ("speaker_active_during_entity_visible", "g2", "e2"), ("moves_with", "e1", "e2"),
}


def test_build_all(spark, tmp_path):
    for name, lines in FILES.items():
        p = tmp_path / "pkg" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("\n".join(lines))
    lines = layers.read_jsonl(layers.directory_entries(spark, str(tmp_path / "pkg"))).persist()
    views = {n: relationships.view(lines, n) for n in relationships.VIEWS}
    edges = relationships.build_all(views).collect()
    assert {(r.type, r.source_id, r.target_id) for r in edges} == WANT
    assert sorted(r.seq for r in edges) == list(range(1, len(edges) + 1)) and len({r.id for r in edges}) == len(edges)
    first = min(edges, key=lambda r: r.seq)
    assert first.id == "rel_tr_shot_000001" and first.confidence == 0.5
    # Index and lines give the same graph.
    rows = spark.createDataFrame([(r.id, r.type, r.source_id, r.target_id, r.start_us, r.end_us, r.confidence) for r in edges], "id string, type string, source_id string, target_id string, start_us long, end_us long, confidence double")
    rows.coalesce(1).write.parquet(str(tmp_path / "relationships.parquet"))
    export.export_package({"relationships/relationships.jsonl": rows.withColumn("line_no", F.monotonically_increasing_id())}, str(tmp_path / "out"))
    with pytest.raises(FileExistsError):
        export.export_package({"a.jsonl": rows.withColumn("line_no", F.lit(1))}, str(tmp_path / "out"))
    text = spark.read.text(str(tmp_path / "out" / "relationships" / "relationships.jsonl")).withColumn("line_no", F.monotonically_increasing_id())
    from_lines = relationships.load_edges(spark, str(tmp_path / "missing.parquet"), layers.lines_of(text))
    from_index = relationships.load_edges(spark, str(tmp_path / "relationships.parquet"), layers.lines_of(text))
    nodes = [sorted(map(tuple, graph.traverse(e, "x1", 2).nodes.select("node", "depth").collect())) for e in (from_lines, from_index)]
    assert nodes[0] == nodes[1] and len(nodes[0]) > 5


def test_microphones(spark):
    say = "we should take the early train tomorrow.".split()
    w = [("p", s, 0, i, t, i * 1000 + 10 * s, i * 1000 + 900, 0.9) for s in (1, 2) for i, t in enumerate(say)]
    w += [("p", 2, 0, 50 + i, t, 5_000_000 + i * 1000, 5_000_000 + i * 1000 + 900, 0.8) for i, t in enumerate("only the second one hears this.".split())]
    words = spark.createDataFrame(w, "package string, source int, chunk int, word_no long, text string, start_us long, end_us long, confidence double")
    f = spark.createDataFrame([("p", 1, 0, 10_000_000, -40.0, -60.0), ("p", 2, 0, 10_000_000, -20.0, -60.0)], "package string, source int, start_us long, end_us long, signal_db double, noise_floor_db double")
    t = microphones.turns(words)
    assert t.count() == 3
    assert [(r.source_a, r.source_b, r.ratio) for r in microphones.repeated_turns(t).collect()] == [(1, 2, 1.0)]
    got = microphones.reconcile(words, f).orderBy("position").collect()
    assert {r.source for r in got} == {2} and len(got) == len(say) + 6
    assert [(r.source, r.word_count, r.rank) for r in microphones.source_profile(words).orderBy("rank").collect()] == [(2, 13, 1), (1, 7, 2)]
    assert microphones.source_overlap(words).first().ratio == pytest.approx(1.0, abs=0.02)


def test_bands_and_records(spark):
    a = spark.createDataFrame([(i, t) for i, t in enumerate([0, 5, 11, 30])], "i int, at long")
    b = a.select(F.col("i").alias("j"), F.col("at").alias("bt"))
    got = sorted((r.i, r.j) for r in intervals.band_join(a, b, 5, ("at", "bt")).filter("i < j").collect())
    assert got == [(0, 1)]
    w = spark.createDataFrame([("s", "A", 1, 0, 5), ("s", "B", 2, 5, 9), ("s", "A", 3, 9, 12)], "k string, speaker_id string, word_no long, start_us long, end_us long")
    assert [r.id for r in transcript.word_records(w, ["k"]).orderBy("word_no").collect()] == ["word_000001", "word_000002", "word_000003"]
    assert [(r.speaker_id, r.total_speech_us, r.word_count) for r in transcript.speaker_records(w, w, ["k"]).orderBy("rank").collect()] == [("A", 8, 2), ("B", 4, 1)]


def test_mask_metrics():
    r = np.random.default_rng(3)
    on = r.random((9, 13)) < 0.1
    y, x = np.nonzero(on)
    want = [[min((y - i) ** 2 + (x - j) ** 2) for j in range(13)] for i in range(9)]
    assert (equivalence.squared_distance(on) == np.array(want)).all()
    a = np.zeros((12, 12), bool)
    a[2:8, 2:8] = True
    b = np.roll(a, 1, 1)
    iou, p95 = equivalence.mask_metrics(a, b)
    assert iou == pytest.approx(30 / 42) and p95 == 1.0 and equivalence.mask_metrics(a, a) == (1.0, 0.0)
    assert equivalence.mask_metrics(a, a & False)[0] == 0.0
