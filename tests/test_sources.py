import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.sources import blocks, layers


@pytest.fixture
def package(tmp_path):
    files = {
        "manifest.json": '{"package_id": "p"}',
        "transcript/words.jsonl": '{"id":"w1","text":"Hi","start_us":0,"end_us":5}\n\n{broken\n{"id":5,"text":"x","start_us":1.5}\n  \n{"id":"w1","text":"again","start_us":7}\n',
        "transcript/speakers.jsonl": '{"id":"","speaker_id":"s1","display_name":"A"}\n',
        "timeline/frames.jsonl": "",
        "transcript/transcript.json": "{not json",
    }
    root = tmp_path / "pkg"
    for name, text in files.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    z = tmp_path / "pkg.zip"
    with zipfile.ZipFile(z, "w") as out:
        for name, text in files.items():
            out.writestr(name, text)
        out.writestr("../evil.json", "{}")
    return str(root), str(z)


@pytest.mark.parametrize("form", [0, 1])
def test_directory_and_zip_read_alike(spark, package, form):
    entries = layers.directory_entries(spark, package[0]) if form == 0 else layers.zip_entries(spark, package[1])
    assert {r.entry for r in entries.collect()} == {"manifest.json", "transcript/words.jsonl", "transcript/speakers.jsonl", "timeline/frames.jsonl", "transcript/transcript.json"}
    words = layers.read_jsonl(entries, "transcript/words.jsonl").orderBy("line_no")
    assert [(r.line_no, r.malformed) for r in words.collect()] == [(1, False), (3, True), (4, False), (6, False)]
    v = F.col("v")
    got = words.select(layers.string_field(v, "id").alias("id"), layers.int_field(v, "start_us").alias("i"), layers.number_field(v, "start_us").alias("n")).collect()
    assert [(r.id, r.i, r.n) for r in got if r.id is not None] == [("w1", 0, 0.0), ("", None, None), ("", None, 1.5), ("w1", 7, 7.0)]
    listed = {r.entry: r for r in layers.list_layers(entries).collect()}
    assert len(listed) == 28 and listed["transcript/words.jsonl"].record_count == 3 and listed["transcript/words.jsonl"].malformed_count == 1
    assert listed["timeline/frames.jsonl"].present and not listed["timeline/shots.jsonl"].present
    docs = {r.entry: r.parsed for r in layers.read_documents(entries).collect()}
    assert docs == {"manifest.json": True, "transcript/transcript.json": False}
    objects = {r.id: r for r in layers.object_catalog(layers.read_jsonl(entries)).collect()}
    assert set(objects) == {"w1", "s1"} and json.loads(objects["w1"].summary)["text"] == "again" and objects["s1"].kind == "speaker"
    counts = {r.entry: (r.records, r.malformed, r.first_malformed_line) for r in layers.layer_counts(layers.read_jsonl(entries)).collect()}
    assert counts["transcript/words.jsonl"] == (3, 1, 3)


def test_blocks(spark, tmp_path):
    vec = np.arange(8, dtype="<f4")
    data = blocks.write_block(vec.tobytes(), block_type=4, start_us=-5, end_us=9) + blocks.write_block(b"x" * 999, width=3)
    (tmp_path / "a.bin").write_bytes(data)
    (tmp_path / "b.bin").write_bytes(data[:-1])
    (tmp_path / "c.bin").write_bytes(b"nope" + data[4:])
    df = blocks.read_blocks(spark, str(tmp_path)).withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("raw", blocks.decompressed("payload"))
    got = {(r.name, r.block_index): r for r in df.collect()}
    assert got["a.bin", 0].raw == vec.tobytes() and got["a.bin", 0].start_us == -5 and got["a.bin", 1].raw == b"x" * 999 and got["a.bin", 1].width == 3
    assert got["b.bin", 1].problem == "truncated payload" and got["c.bin", 0].problem == "bad magic"
    back = df.filter("name = 'a.bin' and block_index = 0").select(blocks.float32_vector("raw").alias("v")).first().v
    assert back == vec.tolist()


def test_run_lengths_and_depth():
    r = np.random.default_rng(1)
    for _ in range(50):
        m = r.random(int(r.integers(0, 400))) < r.random()
        assert (blocks.rle_decode(blocks.rle_encode(m), m.size) == m).all()
    assert blocks.rle_decode(bytes([5]), 4) is None and blocks.rle_decode(bytes([128]), 0) is None
    assert blocks.depth_to_uint16(np.array([1.0, 1.0])) is None and blocks.depth_to_uint16(np.array([0.0, np.nan])) is None
    assert blocks.depth_to_uint16(np.array([0.0, 1.0, 2.0])).tolist() == [0, 32768, 65535]


def test_unsafe_names():
    assert not any(map(layers._safe, ["/a", "a/../b", "a//b", "", "a\\b", "./a"])) and layers._safe("a/b.json")
