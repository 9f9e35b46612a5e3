"""Scans of observation packages: exported directories and ZIP packages, line-delimited JSON and JSON documents.

Records stay VARIANT, so that a field of the wrong type is missing rather than fatal, as the readers of the format have
it; fields are read by type. A package is a directory in the exported form, or a table (entry, content) of a ZIP's
entries. Lines are numbered from 1, and order is by that number wherever it matters.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .catalog import KNOWN_LAYERS, OBJECT_LAYERS

LINES = "entry string, line_no long, v variant, malformed boolean"


def _safe(name: str) -> bool:
    """Entry names stay inside the package."""
    return bool(name) and not name.startswith("/") and "\\" not in name and "\0" not in name and all(p not in ("", ".", "..") for p in name.split("/"))


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                for info in z.infolist():
                    if not info.is_dir() and _safe(info.filename):
                        yield pa.RecordBatch.from_pydict({"package": [path], "entry": [info.filename], "content": [z.read(info)]}, schema=pa.schema([("package", pa.string()), ("entry", pa.string()), ("content", pa.binary())]))


def zip_entries(spark: SparkSession, path: str) -> DataFrame:
    """(package, entry, content) of ZIP packages, read where they lie; entries with unsafe names are left out."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_unzip, "package string, entry string, content binary")


def directory_entries(spark: SparkSession, path: str) -> DataFrame:
    """(package, entry, content) of one exported directory. Files are read where they lie; empty ones, which file scans
    leave out, come from the directory's listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = F.regexp_extract("path", f"^(.*?{_quoted(path.rstrip('/'))})/", 1)
    found = files.select(F.lit(path).alias("package"), F.substring("path", F.length(root) + 2, F.length("path")).alias("entry"), "content")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listing = where.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(where, True)
    empty, prefix = [], re.compile(f"^.*?{_quoted(path.rstrip('/'))}/")
    while listing.hasNext():
        status = listing.next()
        if status.getLen() == 0:
            empty.append((path, prefix.sub("", status.getPath().toString()), bytearray()))
    return found.unionByName(spark.createDataFrame(empty, "package string, entry string, content binary")) if empty else found


def _quoted(text: str) -> str:
    """A Java pattern that matches the path of a URI or plain path."""
    return re.escape(urlparse(text).path or text)


def read_jsonl(entries: DataFrame, entry: str | None = None) -> DataFrame:
    """(package, entry, line_no, v, malformed): non-blank lines of .jsonl entries; a malformed line has v null."""
    df = entries.filter(F.col("entry") == entry) if entry else entries.filter(F.col("entry").endswith(".jsonl"))
    lines = df.select("package", "entry", F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("p", "line"))
    lines = lines.filter(F.btrim("line", F.lit(" \t\r")) != "")
    v = F.try_parse_json("line")
    return lines.select("package", "entry", (F.col("p") + 1).cast("long").alias("line_no"), v.alias("v"), (v.isNull()).alias("malformed"))


def directory_lines(spark: SparkSession, path: str) -> DataFrame:
    """read_jsonl of one exported directory's .jsonl files without holding any of them: (package, entry, line_no, v,
    malformed).

    Files are read in blocks, in parallel, whatever their size; lines are counted block by block and numbered inside
    theirs. Only line feeds end a line."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").option("lineSep", "\n").text(path)
    text = files.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    counts = text.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    offset = counts.select(F.col("path").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("path", "block").orderBy("at"))
    lines = text.withColumn("r", own).join(offset, (F.col("path") == F.col("p")) & (F.col("block") == F.col("b")))
    root = F.regexp_extract("path", f"^(.*?{_quoted(path.rstrip('/'))})/", 1)
    lines = lines.select(F.lit(path).alias("package"), F.substring("path", F.length(root) + 2, F.length("path")).alias("entry"), (F.col("r") + F.col("offset")).cast("long").alias("line_no"), F.col("value").alias("line"))
    lines = lines.filter(F.btrim("line", F.lit(" \t\r")) != "")
    v = F.try_parse_json("line")
    return lines.select("package", "entry", "line_no", v.alias("v"), v.isNull().alias("malformed"))


def read_documents(entries: DataFrame) -> DataFrame:
    """(package, entry, v, parsed) of .json entries; parsed is false where the content is not JSON."""
    v = F.try_parse_json(F.col("content").cast("string"))
    return entries.filter(F.col("entry").endswith(".json")).select("package", "entry", v.alias("v"), v.isNotNull().alias("parsed"))


def lines_of(text: DataFrame, value: str = "value", order: str = "line_no") -> DataFrame:
    """The same for a text table (line_no, value) that holds one entry."""
    v = F.try_parse_json(value)
    return text.filter(F.btrim(value, F.lit(" \t\r")) != "").select(F.col(order).cast("long").alias("line_no"), v.alias("v"), v.isNull().alias("malformed"))


def layer_counts(lines: DataFrame) -> DataFrame:
    """(package, entry, records, malformed, first_malformed_line) of line entries."""
    return lines.groupBy("package", "entry").agg(
        F.count_if(~F.col("malformed")).alias("records"), F.count_if("malformed").alias("malformed"), F.min(F.when(F.col("malformed"), F.col("line_no"))).alias("first_malformed_line")
    )


def list_layers(entries: DataFrame) -> DataFrame:
    """Each known layer of each package: present, record_count, malformed_count; documents count as one record."""
    known = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(s).alias("section"), F.lit(e).alias("entry")) for i, (s, e) in enumerate(KNOWN_LAYERS)])
    wanted = entries.select("package").distinct().select("package", F.explode(known).alias("k")).select("package", "k.*")
    counts = layer_counts(read_jsonl(entries))
    there = entries.select("package", "entry").distinct().withColumn("present", F.lit(True))
    return (
        wanted.join(there, ["package", "entry"], "left").join(counts, ["package", "entry"], "left")
        .select(
            "package", "seq", "section", "entry", F.coalesce("present", F.lit(False)).alias("present"),
            F.when(F.col("entry").endswith(".jsonl"), F.coalesce("records", F.lit(0))).otherwise(F.coalesce("present", F.lit(False)).cast("int")).cast("long").alias("record_count"),
            F.coalesce("malformed", F.lit(0)).cast("long").alias("malformed_count"),
        )
    )


def _kind(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def string_field(v: Column, field: str) -> Column:
    """A string field; "" where it is missing or of another type."""
    return F.when(_kind(v, field) == "STRING", F.try_variant_get(v, f"$.{field}", "string")).otherwise(F.lit(""))


def int_field(v: Column, field: str) -> Column:
    """A whole-number field; null where it is missing or of another type (1.0 is another type)."""
    return F.when(_kind(v, field) == "BIGINT", F.try_variant_get(v, f"$.{field}", "bigint"))


def number_field(v: Column, field: str) -> Column:
    """A number field as double; null where it is missing or not a number."""
    return F.when(_kind(v, field).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(v, f"$.{field}", "double"))


def first_id(v: Column, fields: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(string_field(v, f), F.lit("")) for f in fields])


def object_catalog(lines: DataFrame) -> DataFrame:
    """(package, id, kind, entry, summary): objects of the 17 object layers; of records with one id the last layer's last wins."""
    spark = lines.sparkSession
    order = spark.createDataFrame([(e, i, k) for i, (e, _, k, _) in enumerate(OBJECT_LAYERS)], "entry string, layer int, kind string")
    parts = None
    for entry, ids, _, fields in OBJECT_LAYERS:
        one = lines.filter((F.col("entry") == entry) & ~F.col("malformed")).select(
            "package", "entry", "line_no", first_id(F.col("v"), ids).alias("id"),
            F.to_json(F.struct(*[F.try_variant_get("v", f"$.{f}", "variant").alias(f) for f in fields])).alias("summary"),
        )
        parts = one if parts is None else parts.unionByName(one)
    last = F.max_by(F.struct("kind", "entry", "summary"), F.struct("layer", "line_no")).alias("o")
    return parts.filter("id is not null").join(F.broadcast(order), "entry").groupBy("package", "id").agg(last).select("package", "id", "o.kind", "o.entry", "o.summary")
