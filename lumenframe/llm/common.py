"""Helpers shared by the training-data operators: row ids, written intermediates, packed blocks."""

from __future__ import annotations

import struct
import tempfile
import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A word is a run of anything but space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
NONWORD_CHARS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, a local session (tests) gets a temporary one, and on
    a cluster it is an error, as executors could not read each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="lumenframe-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def plain(df: DataFrame) -> DataFrame:
    """df with its columns named _c0, _c1 ... by position, so that names with dots, or unlike in case only, do no harm."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> str:
    """The name in plain(df) of a column: of that very name, else the first whose name differs in case only."""
    names = df.columns
    if name in names:
        return f"_c{names.index(name)}"
    low = [n.lower() for n in names]
    if name.lower() not in low:
        raise ValueError(f"no column {name!r} among {names}")
    return f"_c{low.index(name.lower())}"


def kept_columns(df: DataFrame, replaced: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """Names of the columns to keep beside new ones that replace their namesakes, whatever their case, and their places
    in plain(df)."""
    gone = {n.lower() for n in replaced}
    kept = [(n, f"_c{i}") for i, n in enumerate(df.columns) if n.lower() not in gone]
    return [n for n, _ in kept], [c for _, c in kept]


def written(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """Cut lineage: write to the shared folder as Parquet and read back; removed when the application ends.

    The path is added to `scratch`, so that `discard` can remove it once nothing that is still to run reads it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lumenframe/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    for path in scratch:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
    scratch.clear()


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of a plan's input; used only to choose how many parts to make."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def buckets_for(df: DataFrame, each: int = 4 << 20, least: int = 256, most: int = 1 << 20) -> int:
    """Number of buckets so that one holds about `each` bytes of stored input."""
    n = min(1 << 60, plan_bytes(df)) // each
    return int(max(least, min(most, n)))


def partitions_for(spark: SparkSession, buckets: int) -> int:
    return max(1, min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def with_row_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add `_rid`, a long unique to each row that orders rows as (id nulls first, text).

    Where ids are whole numbers, unique and not null, the id itself serves and nothing is moved. Otherwise (ids of any
    other type, too) the rows are sorted by id and text, numbered, and written once so that the numbers cannot change
    when a task runs again.
    """
    if docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        ids = docs.select(F.col(id_col).alias("_i"))
        odd = ids.groupBy("_i").count().filter((F.col("count") > 1) | F.col("_i").isNull()).limit(1)
        if not odd.head(1):
            return docs.withColumn("_rid", F.col(id_col).cast("long"))
    numbered = docs.sort(F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first()).withColumn(
        "_rid", F.monotonically_increasing_id()
    )
    return written(numbered, "rows")


def held_out(id_col: str = "doc_id"):
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled training rows (text, y): none of the held-out fold, at most `most`, picked by a hash of the id."""
    y = plain(labels).select(F.col(place(labels, id_col)).alias("_id"), F.col(place(labels, label)).cast("int").alias("_y"))
    y = y.filter("_y is not null and _id is not null").groupBy("_id").agg(F.max("_y").alias("y"))
    picked = y.filter(~held_out("_id")).orderBy(F.xxhash64(F.col("_id"), F.lit(11)), F.col("_id")).limit(most)
    # The picked ids are at most `most` rows by the limit, so they are broadcast and the texts of all others stay where
    # they are; an id that many rows repeat gives one row.
    rows = plain(docs).select(F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("text")).join(F.broadcast(picked), "_id")
    return rows.groupBy("_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def pack(*arrays: np.ndarray) -> bytes:
    """Several one-dimensional arrays as one compressed block."""
    head = struct.pack("<B", len(arrays))
    body = []
    for a in arrays:
        code = a.dtype.str.encode()
        head += struct.pack("<B", len(code)) + code + struct.pack("<Q", a.size)
        body.append(a.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(body))


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, at, spec = raw[0], 1, []
    for _ in range(n):
        k = raw[at]
        dtype = np.dtype(raw[at + 1 : at + 1 + k].decode())
        (size,) = struct.unpack_from("<Q", raw, at + 1 + k)
        spec.append((dtype, size))
        at += 9 + k
    out = []
    for dtype, size in spec:
        out.append(np.frombuffer(raw, dtype, size, at))
        at += size * dtype.itemsize
    return out


def plain_size(block: bytes) -> int:
    """Bytes of a block once it is unpacked, as its frame tells."""
    return zstandard.frame_content_size(block)


def ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... (n[0] of them), lo[1], ... as one array."""
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(n) - n
    return np.arange(total, dtype=np.int64) + np.repeat(lo.astype(np.int64) - first, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser on uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
