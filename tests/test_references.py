import json

from lumenframe.operators import export, package_checks
from lumenframe.sources import layers


def test_references_of_records(spark, tmp_path):
    files = {
        "timeline/frames.jsonl": [{"id": "f1", "frame_index": 7, "pts_us": 70}, {"id": "f1", "frame_index": 8}, {"id": 5}, {"id": "f2"}],
        "text/evidence_crops.jsonl": [{"crop_id": "c1", "crop_file_path": "a.png", "source_frame_id": "f2"}, {"crop_id": "c2", "crop_file_path": 9}, {"crop_id": "c1", "crop_file_path": "z.png"}],
        "text/text_observations.jsonl": [{"source_frame_ids": ["f1", "zz"], "evidence_crop_refs": ["c1", "c2", "c9"]}, {"source_frame_ids": ["f1", 5], "evidence_crop_refs": []}, {"source_frame_ids": "f1"}],
        "timeline/shots.jsonl": [{"start_frame_id": "f1", "end_frame_id": 3}],
        "spatial/masks.index.jsonl": [{"frame_id": "no", "block_file": "m.bin", "block_offset": 10}, {"block_file": "m.bin", "block_offset": 11}, {"block_file": "m.bin", "block_offset": 1.5}],
        "entities/entities.jsonl": [{"frame_id": "f1"}],
    }
    for name, records in files.items():
        path = tmp_path / "pkg" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps(r) + "\n" for r in records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")  # lines of one file are read in many blocks
    try:
        root = str(tmp_path / "pkg")
        lines = layers.directory_lines(spark, root)
        one = sorted((r.entry, r.line_no, str(r.v)) for r in lines.collect())
        assert one == sorted((r.entry, r.line_no, str(r.v)) for r in layers.read_jsonl(layers.directory_entries(spark, root)).collect())
        held = spark.createDataFrame([(root, "a.png", "layers/a.png")], "package string, entry string, file string")
        blocks = spark.createDataFrame([(root, "m.bin", 10, 0, "m.raw", 0, 99)], "package string, block_file string, block_offset long, block_ordinal int, decoded_file string, decoded_offset long, decoded_length long")
        rows = export.resolve_records(lines, held, blocks).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = sorted((r.entry.split("/")[1], r.line_no, r.member, -1 if r.position is None else r.position, r.ref, r.found) for r in rows)
    assert got == sorted([
        ("evidence_crops.jsonl", 1, "source_frame_id", -1, "f2", True), ("evidence_crops.jsonl", 1, "crop_file_path", -1, "a.png", True), ("evidence_crops.jsonl", 3, "crop_file_path", -1, "z.png", False),
        ("text_observations.jsonl", 1, "source_frame_ids", 0, "f1", True), ("text_observations.jsonl", 1, "source_frame_ids", 1, "zz", False),
        ("text_observations.jsonl", 1, "evidence_crop_refs", 0, "c1", True), ("text_observations.jsonl", 1, "evidence_crop_refs", 1, "c2", True), ("text_observations.jsonl", 1, "evidence_crop_refs", 2, "c9", False),
        ("shots.jsonl", 1, "start_frame_id", -1, "f1", True), ("masks.index.jsonl", 1, "frame_id", -1, "no", False),
        ("masks.index.jsonl", 1, "block_file", -1, "m.bin", True), ("masks.index.jsonl", 2, "block_file", -1, "m.bin", False), ("masks.index.jsonl", 3, "block_file", -1, "m.bin", False),
    ])
    first = next(r for r in rows if r.ref == "f1" and r.member == "start_frame_id")
    assert (first.frame_index, first.pts_us) == ("7", "70")
    crop = {r.ref: r.file for r in rows if r.member == "evidence_crop_refs"}
    assert crop == {"c1": "layers/a.png", "c2": None, "c9": None}


def test_index_and_its_manifest(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    b = spark.createDataFrame([], "i int")
    said = export.write_index({"a": a, "b": b}, str(tmp_path / "index"))
    assert sorted((r.table, r.rows) for r in said.collect()) == [("a", 3), ("b", 0)]
    held = export.index_manifest({n: spark.read.parquet(str(tmp_path / "index" / f"{n}.parquet")).repartition(3) for n in ("a", "b")})
    with_package = lambda df: df.selectExpr("'p' as package", "*")
    assert package_checks.index_findings(with_package(said), with_package(held)).count() == 0
    changed = export.index_manifest({"a": a.distinct(), "b": b})
    assert [(r.code, r.path) for r in package_checks.index_findings(with_package(said), with_package(changed)).collect()] == [("ERR_CORE_INDEX_LOGICAL_MISMATCH", "/index/a")]
