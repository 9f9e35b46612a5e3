"""Binary block streams: 160-byte headers, zstd payloads, run-length masks, depth and embedding tensors."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, FloatType

MAGIC, HEADER = b"SVPB", 160
#: Fixed layout, little-endian from byte 0 to 75: magic, version, header size, type, compression, endian, flags, sizes,
#: three extents, dtype, start frame, frames, start and end microseconds. Hashes at 76 and 108; 140 to 159 are zero.
_FIXED = struct.Struct("<4sHHBBBBQQIIIIQQqq")
FIELDS = ("version", "header_size", "block_type", "compression", "endian", "flags", "uncompressed_size", "compressed_size", "width", "height", "channels", "dtype", "start_frame", "frame_count", "start_us", "end_us")
SCHEMA = "path string, block_index int, block_offset long, " + ", ".join(f"{f} long" for f in FIELDS) + ", payload_hash string, header_hash string, problem string, payload binary"


def pack_header(**values: int) -> bytes:
    """A header with the given fields; hashes are left for the writer."""
    defaults = {"version": 1, "header_size": HEADER, "endian": 1} | values
    return _FIXED.pack(MAGIC, *[defaults.get(f, 0) for f in FIELDS]).ljust(HEADER, b"\0")


def write_block(payload: bytes, digest=lambda b: hashlib.sha256(b).digest(), **values: int) -> bytes:
    """One block: header, and the payload compressed with zstd. SHA-256 stands in for the format's own digest."""
    body = zstandard.ZstdCompressor().compress(payload)
    head = bytearray(pack_header(compression=1, uncompressed_size=len(payload), compressed_size=len(body), **values))
    head[76:108] = digest(body)
    head[108:140] = digest(bytes(head[:108]))
    return bytes(head) + body


def parse_blocks(data: bytes, digest=None) -> list[dict]:
    """Blocks of a stream in order; the first broken header ends it, with its problem told."""
    out, at = [], 0
    while at < len(data):
        row = {"block_index": len(out), "block_offset": at, "problem": None, "payload": None}
        if len(data) - at < HEADER:
            out.append(row | dict.fromkeys(FIELDS) | {"payload_hash": None, "header_hash": None, "problem": "truncated header"})
            break
        head = data[at : at + HEADER]
        magic, *values = _FIXED.unpack(head[: _FIXED.size])
        row |= dict(zip(FIELDS, values)) | {"payload_hash": head[76:108].hex(), "header_hash": head[108:140].hex()}
        body = data[at + HEADER : at + HEADER + row["compressed_size"]]
        if magic != MAGIC:
            row["problem"] = "bad magic"
        elif row["header_size"] != HEADER:
            row["problem"] = "bad header size"
        elif any(head[140:160]):
            row["problem"] = "reserved bytes are not zero"
        elif len(body) < row["compressed_size"]:
            row["problem"] = "truncated payload"
        elif digest and (digest(body) != head[76:108] or digest(head[:108]) != head[108:140]):
            row["problem"] = "hash mismatch"
        else:
            row["payload"] = body
        out.append(row)
        if row["payload"] is None:
            break
        at += HEADER + row["compressed_size"]
    return out


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of all streams under a path, one row each, read where the files lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for row in parse_blocks(content.as_buffer().to_pybytes()):
                    yield pa.RecordBatch.from_pylist([{"path": path} | row], schema=_arrow)

    _arrow = pa.schema([("path", pa.string()), ("block_index", pa.int32()), ("block_offset", pa.int64()), *[(f, pa.int64()) for f in FIELDS], ("payload_hash", pa.string()), ("header_hash", pa.string()), ("problem", pa.string()), ("payload", pa.binary())])
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


@pandas_udf(BinaryType())
def decompressed(payload: pd.Series) -> pd.Series:
    """zstd payloads, decoded; null where decoding fails."""

    def one(b):
        try:
            return None if b is None else zstandard.ZstdDecompressor().decompress(b, max_output_size=1 << 31)
        except zstandard.ZstdError:
            return None

    return payload.map(one)


def rle_encode(pixels: np.ndarray) -> bytes:
    """Runs of a 0/1 raster in row order, background first, each as LEB128."""
    flat = np.asarray(pixels, bool).ravel()
    edge = np.flatnonzero(np.diff(flat)) + 1
    runs = np.diff(np.concatenate([[0], edge, [flat.size]]))
    if flat.size and flat[0]:
        runs = np.concatenate([[0], runs])
    out = bytearray()
    for n in runs.tolist() if flat.size else []:
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
    return bytes(out)


def rle_decode(data: bytes, total: int) -> np.ndarray | None:
    """The raster of `total` pixels; None unless the runs fill it exactly."""
    runs, n, shift = [], 0, 0
    for b in data:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            runs.append(n)
            n = shift = 0
    if shift or sum(runs) != total:
        return None
    return np.repeat(np.arange(len(runs)) % 2, runs).astype(bool)


def depth_to_uint16(depth: np.ndarray) -> np.ndarray | None:
    """A depth raster scaled from its least to its largest value to 0 .. 65535; None for constant or non-finite ones."""
    d = np.asarray(depth, np.float64)
    if d.size == 0 or not np.isfinite(d).all() or d.max() == d.min():
        return None
    return np.floor((d - d.min()) / (d.max() - d.min()) * 65535 + 0.5).astype(np.uint16)


@pandas_udf(ArrayType(FloatType()))
def float32_vector(payload: pd.Series) -> pd.Series:
    return payload.map(lambda b: None if b is None else np.frombuffer(b, "<f4"))
