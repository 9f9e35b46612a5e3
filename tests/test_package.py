import struct

import pytest

from lumenframe.sources import layers, package


def test_write_read_and_embed(spark, tmp_path):
    entries = [("manifest.json", b'{"package_id":"p1"}'), ("mimetype", b"application/x"), ("text/text_regions.jsonl", b'{"id":"a"}\nbad\n'), ("media/primary/video.mp4", b"v"), ("odd/file.txt", b"")]
    a, b = str(tmp_path / "a.zip"), str(tmp_path / "b.zip")
    package.write_package(entries, a)
    package.write_package(entries[::-1], b)
    body = open(a, "rb").read()
    assert body == open(b, "rb").read()
    with pytest.raises(ValueError):
        package.write_package([("../x", b"")], b)
    got = layers.zip_entries(spark, a)
    codes = {(r.code, r.entry) for r in package.layout(got).collect()}
    assert codes == {("ERR_CORE_UNKNOWN_ROOT_SECTION", "odd/file.txt"), ("ERR_CORE_MISSING_SECTION", "timeline"), ("ERR_CORE_MISSING_SECTION", "provenance")}
    row = package.inspect(got).first()
    assert (row.entries, row.records, row.malformed, row.package_id, row.documents) == (5, 1, 1, "p1", 1)
    assert {r.entry: r.media for r in package.media_policy(got).collect()}["media/primary/video.mp4"] == "primary_media"
    assert package.dump(got, "manifest.json").first().text == '{"package_id":"p1"}'
    uuid = bytes(range(16))
    box = lambda kind, payload: struct.pack(">I4s", 8 + len(payload), kind) + payload
    media = box(b"ftyp", b"isom") + box(b"uuid", b"\0" * 16) + box(b"uuid", uuid + body) + struct.pack(">I4sQ", 1, b"mdat", 20) + b"data"
    assert [k for k, _, _ in package.boxes(media)] == [b"ftyp", b"uuid", b"uuid", b"mdat"]
    assert package.embedded_package(media, b"\1" * 16) is None and list(package.boxes(b"\0\0\0\x04abcd")) == []
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "clip.mp4").write_bytes(media)
    assert package.embedded_entries(spark, str(tmp_path / "m"), uuid).count() == 5
