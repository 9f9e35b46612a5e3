"""Packages as files: layout checks, summaries, deterministic ZIP writing, and packages embedded in ISO media files.

These work on one package at a time and on its entry names or bytes; observations themselves are read by `layers`."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .layers import _safe, layer_counts, read_documents, read_jsonl

#: Root sections of a package and those it cannot be without.
ROOTS = ("manifest.json", "mimetype", "media", "transcript", "timeline", "entities", "spatial", "text", "colors", "embeddings", "relationships", "index", "provenance")
REQUIRED = ("manifest.json", "timeline", "provenance")
AUDIO_VIDEO = (".mp4", ".mov", ".mkv", ".webm", ".m4a", ".mp3", ".wav", ".flac", ".aac", ".ogg", ".avi")
SAFE_SUFFIXES = (".json", ".jsonl", ".bin", ".sqlite", ".png", ".jpg", ".webp", ".txt")


def layout(entries: DataFrame) -> DataFrame:
    """(package, code, entry): unsafe names, unknown root sections, and required sections that are missing."""
    root = F.split("entry", "/")[0]
    parts = F.split("entry", "/")
    unsafe = F.col("entry").startswith("/") | F.col("entry").contains("\\") | F.exists(parts, lambda p: p.isin("", ".", ".."))
    names = entries.select("package", "entry", root.alias("root"))
    odd = names.filter(unsafe).select("package", F.lit("ERR_CORE_UNSAFE_PATH").alias("code"), "entry")
    unknown = names.filter(~unsafe & ~F.col("root").isin(*ROOTS)).select("package", F.lit("ERR_CORE_UNKNOWN_ROOT_SECTION").alias("code"), "entry")
    need = entries.select("package").distinct().withColumn("root", F.explode(F.array(*[F.lit(r) for r in REQUIRED])))
    missing = need.join(names, ["package", "root"], "left_anti").select("package", F.when(F.col("root") == "manifest.json", "ERR_CORE_MISSING_MANIFEST").otherwise("ERR_CORE_MISSING_SECTION").alias("code"), F.col("root").alias("entry"))
    return odd.unionByName(unknown).unionByName(missing)


def media_policy(entries: DataFrame) -> DataFrame:
    """Add media: what a sidecar may hold. The primary media's folder first, then harmless suffixes, then audio and video."""
    name = F.lower("entry")
    ends = lambda names: F.greatest(*[name.endswith(n) for n in names])
    return entries.withColumn("media", F.when(name.startswith("media/primary/"), "primary_media").when(ends(SAFE_SUFFIXES), "data").when(ends(AUDIO_VIDEO), "media").otherwise("other"))


def inspect(entries: DataFrame) -> DataFrame:
    """One row for each package: entries, documents, records and malformed lines, and the manifest's package_id."""
    lines = layer_counts(read_jsonl(entries)).groupBy("package").agg(F.sum("records").alias("records"), F.sum("malformed").alias("malformed"))
    manifest = read_documents(entries).filter("entry = 'manifest.json'").select("package", F.try_variant_get("v", "$.package_id", "string").alias("package_id"))
    sizes = entries.groupBy("package").agg(F.count("*").alias("entries"), F.sum(F.length("content")).alias("bytes"), F.count_if(F.col("entry").endswith(".json")).alias("documents"))
    return sizes.join(lines, "package", "left").join(manifest, "package", "left").fillna(0, ["records", "malformed"])


def dump(entries: DataFrame, entry: str) -> DataFrame:
    """(package, text) of one document as compact JSON."""
    return read_documents(entries).filter((F.col("entry") == entry) & F.col("parsed")).select("package", F.to_json("v").alias("text"))


def write_package(entries: list[tuple[str, bytes]], path: str, with_media: bool = True) -> None:
    """A ZIP whose bytes depend on names and contents only: sorted, with a fixed time; mimetype first and stored.

    For one package on one machine; without media it is the sidecar form."""
    rows = sorted((n, c) for n, c in entries if with_media or not n.startswith("media/primary/"))
    if bad := [n for n, _ in rows if not _safe(n)]:
        raise ValueError(f"unsafe entry name: {bad[0]}")
    if len({n for n, _ in rows}) != len(rows):
        raise ValueError("an entry is there twice")
    with zipfile.ZipFile(path, "w") as z:
        for name, content in sorted(rows, key=lambda r: (r[0] != "mimetype", r[0])):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_STORED if name == "mimetype" else zipfile.ZIP_DEFLATED
            z.writestr(info, content)


def boxes(data: bytes) -> Iterator[tuple[bytes, int, int]]:
    """(type, start of the payload, end) of the top-level boxes of an ISO media file; stops at the first broken one."""
    at = 0
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            if at + 16 > len(data):
                return
            (size,) = struct.unpack_from(">Q", data, at + 8)
            head = 16
        elif size == 0:
            size = len(data) - at
        if size < head or at + size > len(data):
            return
        yield kind, at + head, at + size
        at += size


def embedded_package(data: bytes, uuid: bytes) -> tuple[int, int] | None:
    """Byte range of the ZIP inside the `uuid` box with the given 16-byte id; None without one."""
    for kind, start, end in boxes(data):
        if kind == b"uuid" and data[start : start + 16] == uuid:
            return start + 16, end
    return None


def embedded_entries(spark: SparkSession, path: str, uuid: bytes) -> DataFrame:
    """(package, entry, content) of packages embedded in media files, read where the files lie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("package", pa.string()), ("entry", pa.string()), ("content", pa.binary())])
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer().to_pybytes()
                if span := embedded_package(data, uuid):
                    with zipfile.ZipFile(io.BytesIO(data[span[0] : span[1]])) as z:
                        for info in z.infolist():
                            if not info.is_dir() and _safe(info.filename):
                                yield pa.RecordBatch.from_pydict({"package": [name], "entry": [info.filename], "content": [z.read(info)]}, schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "package string, entry string, content binary")
