import json


from lumenframe.operators import package_checks as m
from lumenframe.sources import blocks

REGISTRY = m.Registry(
    observation_types=("caption",), color_buckets=("red", "blue"), color_spaces=("oklch",), sampling_bases=("grid",), bucket_registry_version="1",
    schemas={
        "text/text_observations.jsonl": {"type": "object", "required": ["text_observation_id"], "properties": {"source_frame_ids": {"type": "array", "items": {"type": "string", "pattern": "^f"}}}},
        "provenance/capture.json": {"type": "object", "additionalProperties": False, "required": ["tool"], "properties": {"tool": {"type": "string", "enum": ["a", "b"]}, "n": {"type": "integer", "minimum": 1, "maximum": 3}, "o": {"type": "object", "required": ["x"]}}},
    },
)


def packages(spark, files):
    rows = [(p, e, bytearray(c if isinstance(c, bytes) else c.encode())) for p, entries in files.items() for e, c in entries.items()]
    return spark.createDataFrame(rows, "package string, entry string, content binary")


def lines(*records):
    return "".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)


BASE = {"manifest.json": '{"canonical_analysis_raster": {"width": 100, "height": 50}}', "timeline/frames.jsonl": lines({"id": "f1"}), "provenance/x.json": "{}"}
GOOD_REGION = {"text_region_id": "r", "bbox_norm": [0, 0, 0.5, 1.0], "bbox_px": [0, 0, 50, 50], "start_us": 1, "end_us": 1, "confidence": 1, "observation_type": "caption"}
GOOD_COLOR = {"bucket_coverage": {"red": 0.75, "blue": 0.25}, "coverage_total": 1.0, "dominant_bucket": "red", "color_space": "oklch", "sampling_basis": "grid", "color_bucket_registry_version": "1"}


def codes(spark, extra, package="p"):
    found = m.validate_package(packages(spark, {package: BASE | extra}), REGISTRY)
    return sorted((r.code, r.path) for r in found.collect())


def test_a_valid_package(spark):
    files = {"text/text_regions.jsonl": lines(GOOD_REGION), "colors/color_observations.jsonl": lines(GOOD_COLOR), "entities/entities.jsonl": lines({"entity_type": "visual_entity"}),
             "transcript/transcript.json": '{"speaker_count": 1, "diarization": {"status": "ran"}}', "provenance/capture.json": '{"tool": "a", "n": 2}', "spatial/masks.bin": blocks.write_block(b"abc")}
    assert codes(spark, files) == []


def test_layout_blocks_entities_capture(spark):
    files = {"../x": "", "odd/y.json": "{}", "spatial/a.bin": b"nope" * 60, "entities/entities.jsonl": lines({"entity_type": "dog"}, {"entity_type": 5}, {"entity_type": "face_region"}),
             "provenance/capture.json": '{"tool": "z", "n": 9, "o": {}, "more": 1}'}
    found = packages(spark, {"p": {k: v for k, v in (BASE | files).items() if k != "manifest.json"}})
    got = m.validate_package(found, REGISTRY)
    assert sorted((r.code, r.severity, r.path) for r in got.filter("code not like 'ERR_PROV%'").collect()) == [
        ("ERR_CORE_INVALID_BLOCK_HEADER", "error", "/spatial/a.bin@0"), ("ERR_CORE_INVALID_ENTITY_RECORD", "error", "/entities/entities.jsonl:1"), ("ERR_CORE_INVALID_ENTITY_RECORD", "error", "/entities/entities.jsonl:2"),
        ("ERR_CORE_MISSING_MANIFEST", "fatal", "/manifest.json"), ("ERR_CORE_PATH_TRAVERSAL", "fatal", "/../x"), ("ERR_CORE_UNKNOWN_ROOT_SECTION", "error", "/odd/y.json"),
    ]
    assert sorted(r.message for r in got.filter("code like 'ERR_PROV%'").collect()) == ["$.n: is beyond its maximum", "$.o.x: is missing", "$.tool: is not listed", "$: has unknown members"]


def test_text_records(spark):
    bad = [GOOD_REGION | c for c in ({"bbox_norm": [0, 0, 1.5, 1]}, {"bbox_px": [0, 0, 101, 50]}, {"bbox_px": [0, 0, 1.5, 2]}, {"start_us": 2}, {"frame_start": 3, "frame_end": 1}, {"confidence": 1.5}, {"confidence": "x"}, {"observation_type": "zz"}, {"bbox_norm": [0, 0, 1]})]
    got = codes(spark, {
        "text/text_regions.jsonl": lines(GOOD_REGION, *bad),
        "text/text_observations.jsonl": lines({"text_observation_id": "o", "text_region_id": "r", "raw_text": "A", "normalized_text": "a"}, {"text_observation_id": "o2", "text_region_id": "zz", "raw_text": "A"}, {"source_frame_ids": ["f1", "g"]}),
        "text/numeric_values.jsonl": lines({"text_region_id": "r", "text_observation_id": "no", "raw_text": "", "confidence": None}),
    })
    r, o = "/text/text_regions.jsonl:", "/text/text_observations.jsonl:"
    assert got == sorted([
        ("ERR_TEXT_INVALID_BOUNDING_BOX", r + "2"), ("ERR_TEXT_INVALID_BOUNDING_BOX", r + "3"), ("ERR_TEXT_INVALID_BOUNDING_BOX", r + "4"), ("ERR_TEXT_INVALID_TIMING", r + "5"), ("ERR_TEXT_INVALID_TIMING", r + "6"),
        ("ERR_TEXT_INVALID_CONFIDENCE", r + "7"), ("ERR_TEXT_INVALID_CONFIDENCE", r + "8"), ("ERR_TEXT_INVALID_REGION_RECORD", r + "9"), ("ERR_TEXT_INVALID_BOUNDING_BOX", r + "10"),
        ("ERR_TEXT_INVALID_NORMALIZED_TEXT", o + "2"), ("ERR_TEXT_INVALID_REFERENCE", o + "2"), ("ERR_TEXT_INVALID_OBSERVATION_RECORD", o + "3"), ("ERR_TEXT_INVALID_OBSERVATION_RECORD", o + "3"),
        ("ERR_TEXT_INVALID_CONFIDENCE", "/text/numeric_values.jsonl:1"), ("ERR_TEXT_INVALID_REFERENCE", "/text/numeric_values.jsonl:1"),
    ])


def test_malformed_line_is_the_layers_only_finding(spark):
    assert codes(spark, {"text/text_regions.jsonl": lines(GOOD_REGION | {"confidence": 9}, "{broken")}) == [("ERR_TEXT_INVALID_REGION_RECORD", "/text/text_regions.jsonl")]


def test_color_records(spark):
    changes = [{"bucket_coverage": {"red": 0.75, "green": 0.25}}, {"bucket_coverage": {"red": 1.5}}, {"coverage_total": 0.9}, {"dominant_bucket": "blue"}, {"dominant_bucket": "green"}, {"color_space": "rgb"}, {"sampling_basis": "x"}, {"color_bucket_registry_version": "2"}, {"bucket_coverage": {"red": "1"}}, {"bucket_coverage": 5}]
    got = codes(spark, {"colors/color_observations.jsonl": lines(GOOD_COLOR, *[GOOD_COLOR | c for c in changes])})
    at = lambda i: f"/colors/color_observations.jsonl:{i}"
    total = "ERR_COLOR_INVALID_PERCENTAGE_TOTAL"
    assert got == sorted([
        ("ERR_COLOR_INVALID_BUCKET_ID", at(2)), ("ERR_COLOR_INVALID_PERCENTAGE_BOUNDS", at(3)), (total, at(3)), (total, at(3)), (total, at(4)), ("ERR_COLOR_INVALID_DOMINANT_BUCKET", at(5)), ("ERR_COLOR_INVALID_DOMINANT_BUCKET", at(6)),
        ("ERR_COLOR_INVALID_COLOR_SPACE", at(7)), ("ERR_COLOR_INVALID_SAMPLING_BASIS", at(8)), ("ERR_COLOR_INVALID_OBSERVATION_RECORD", at(9)),
        ("ERR_COLOR_INVALID_PERCENTAGE_BOUNDS", at(10)), (total, at(10)), (total, at(10)), ("ERR_COLOR_INVALID_DOMINANT_BUCKET", at(10)),
    ])


def test_audio_series(spark):
    w = lambda t, s, e, **more: {"target_id": t, "start_us": s, "end_us": e, "momentary_lufs": -20.0, "shortterm_lufs": None, "true_peak_dbtp": 1} | more
    b = lambda t, s, e, bands: {"target_id": t, "start_us": s, "end_us": e, "bands": bands}
    got = codes(spark, {
        "media/audio/audio_absence.json": '{"original_audio_stream_ids": ["a", "b"]}',
        "media/audio/loudness.jsonl": lines(w("a", 0, 10), w("b", 5, 10), w("a", 9, 20), w("a", 20, 20), w("c", 0, 1), w("b", 10, 11, momentary_lufs="x"), {"target_id": "b"}),
        "media/audio/loudness_summary.json": '{"streams": [{"target_id": "a"}, {"target_id": "q"}]}',
        "media/audio/spectrum.jsonl": lines(b("a", 0, 5, [0.5] * 9 + [None]), b("a", 5, 9, [1] * 9), b("a", 9, 12, ["x"] * 10)),
        "media/audio/spectrum_summary.json": json.dumps({"band_centers_hz": [1] * 10}),
    })
    at = lambda i: f"/media/audio/loudness.jsonl:{i}"
    s = "/media/audio/spectrum.jsonl:"
    assert got == sorted([
        ("ERR_MEDIA_INVALID_LOUDNESS_TIMING", at(3)), ("ERR_MEDIA_INVALID_LOUDNESS_TIMING", at(4)), ("ERR_MEDIA_INVALID_LOUDNESS_TARGET", at(5)), ("ERR_MEDIA_INVALID_LOUDNESS_VALUE", at(6)),
        *[("ERR_MEDIA_INVALID_LOUDNESS_VALUE", at(7))] * 3, ("ERR_MEDIA_INVALID_LOUDNESS_TARGET", "/media/audio/loudness_summary.json"),
        ("ERR_MEDIA_INVALID_SPECTRUM_VALUE", s + "2"), ("ERR_MEDIA_INVALID_SPECTRUM_VALUE", s + "3"), ("ERR_MEDIA_INVALID_SPECTRUM_SUMMARY", "/media/audio/spectrum_summary.json"),
    ])
    free = codes(spark, {"media/audio/audio_absence.json": '{"original_audio_stream_ids": ["a", 5]}', "media/audio/loudness.jsonl": lines(w("zz", 0, 1))})
    assert free == []  # a list that is not in form is no authority


def test_diarization(spark):
    t = lambda **d: {"transcript/transcript.json": json.dumps(d)}
    assert codes(spark, t(speaker_count=1, diarization={"status": "fallback_one_speaker"})) == [("WARN_DIARIZATION_FALLBACK", "/transcript/transcript.json")]
    assert codes(spark, t(speaker_count=0)) == [("ERR_DIARIZATION_UNAVAILABLE", "/transcript/transcript.json")]
    assert codes(spark, {"transcript/transcript.json": "{no"}) == [("ERR_DIARIZATION_UNAVAILABLE", "/transcript/transcript.json")]
    source = {"speaker_id": "s", "source_audio_stream_id": "m1", "source_audio_stream_ids": ["m1", "m2"]}
    mic = t(speaker_count=1, diarization={"status": "microphone_stream_assignment", "processor_id": "x"}, speaker_sources=[source])
    rec = {"source_assignment_evidence": 1, "cross_anchor_chunk_content_evidence": 1, "maximum_duplicate_word_time_delta_us": 1}
    proc = {"id": "x", "input_refs": ["i1", "i2"], "input_streams": [{"source_audio_stream_id": "m1", "input_ref": "i1"}, {"source_audio_stream_id": "m2", "input_ref": "i2"}], "reconciliation": rec}
    good = mic | {"provenance/processors.jsonl": lines(proc), "transcript/asr_chunk_provenance.jsonl": lines({"input_ref": "i1"})}
    assert codes(spark, good) == []
    for change in ({"provenance/processors.jsonl": lines({"id": "y"})}, {"transcript/asr_chunk_provenance.jsonl": lines({"input_ref": "zz"})}, {"provenance/processors.jsonl": lines(proc | {"reconciliation": {}})}):
        assert ("ERR_DIARIZATION_UNAVAILABLE", "/provenance/processors.jsonl") in codes(spark, good | change)


def test_status_and_index(spark):
    files = {"p": BASE, "q": BASE | {"transcript/transcript.json": '{"speaker_count": 1, "diarization": {"status": "fallback_one_speaker"}}'}, "r": {"manifest.json": "{}"}}
    entries = packages(spark, files)
    got = m.package_status(entries, m.validate_package(entries, REGISTRY)).orderBy("package").collect()
    assert [(r.package, r.status) for r in got] == [("p", "valid"), ("q", "valid_with_warnings"), ("r", "invalid")]
    a = spark.createDataFrame([("p", "t", 2, "x"), ("p", "u", 1, "y"), ("p", "w", 1, "z")], "package string, table string, rows long, digest string")
    b = spark.createDataFrame([("p", "t", 2, "x"), ("p", "u", 1, "other"), ("p", "v", 0, None)], "package string, table string, rows long, digest string")
    assert sorted((r.code, r.path) for r in m.index_findings(a, b).collect()) == [("ERR_CORE_INDEX_LOGICAL_MISMATCH", "/index/u"), ("ERR_CORE_INDEX_MANIFEST_INVALID", "/index/v"), ("ERR_CORE_INDEX_SCHEMA_INVALID", "/index/w")]
    assert m.validate_package(entries.limit(0), REGISTRY).count() == 0
