"""Export: references of layer rows resolved and appended, and layers written out in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.catalog import REFERENCE_RULES
from .index import table_digest
from .intervals import by_size
from .lineage import settled


def _lookup(owner: DataFrame, key: str, order: str | None, fields: list[str]) -> DataFrame:
    """One row for each id: the first in file order, or where no order is given the least by its fields."""
    df = owner.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    pick = F.min_by(F.struct(*fields), order) if order else F.min(F.struct(*fields))
    return df.groupBy(F.col(key).alias("_k")).agg(pick.alias("_o"))


def resolve(rows: DataFrame, column: str, owner: DataFrame, key: str, fields: list[str], name: str, order: str | None = None) -> DataFrame:
    """Add struct(found, ...fields) for a single reference; unresolved ones have found false."""
    hit = rows.join(_lookup(owner, key, order, fields), F.col(column) == F.col("_k"), "left")
    return hit.withColumn(name, F.struct(F.col("_k").isNotNull().alias("found"), *[F.col(f"_o.{f}").alias(f) for f in fields])).drop("_k", "_o")


def _joined(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """rows with the columns of table where it has them; rows without a whole key stay where they are."""
    whole = F.lit(True)
    for c in on:
        whole = whole & F.col(c).isNotNull()
    return rows.filter(whole).join(table, on, "left").unionByName(rows.filter(~whole), allowMissingColumns=True)


def resolve_list(rows: DataFrame, row_key: str, column: str, owner: DataFrame, key: str, fields: list[str], name: str, order: str | None = None) -> DataFrame:
    """Add an array of struct(ref, found, ...fields) for a list of references, in the list's order."""
    each = rows.select(row_key, F.posexplode(column).alias("_p", "_ref"))
    hit = each.join(_lookup(owner, key, order, fields), F.col("_ref") == F.col("_k"), "left")
    item = F.struct("_p", F.struct(F.col("_ref").alias("ref"), F.col("_k").isNotNull().alias("found"), *[F.col(f"_o.{f}").alias(f) for f in fields]).alias("item"))
    lists = hit.groupBy(row_key).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["item"]).alias(name))
    return rows.join(lists, row_key, "left")


def resolve_records(lines: DataFrame, files: DataFrame, blocks: DataFrame) -> DataFrame:
    """(package, entry, line_no, member, position, ref, found, frame_index, pts_us, file, block_offset, block_ordinal,
    decoded_file, decoded_offset, decoded_length): one row for each reference that the 15 rules name, in lists with its place.

    lines: package, entry, line_no, v, malformed of all layers. Frames and crops are looked up by id, the first record of an
    id being the one that counts; crops and entry paths in files (package, entry, file), the exported files but for block
    streams; blocks by file and offset in blocks (package, block_file, block_offset, block_ordinal, decoded_file,
    decoded_offset, decoded_length). A member of another type than its rule's is passed over, as is a list with anything but
    texts in it; what is not there has found false."""
    spark = lines.sparkSession
    good = lines.filter(~F.col("malformed"))
    value = F.try_variant_get("v", F.concat(F.lit("$."), F.col("member")), "variant")
    shape = F.schema_of_variant(value)
    one = F.when((shape == "STRING") & ~F.col("kind").endswith("_list"), F.array(F.try_variant_get(value, "$", "string")))
    many = F.when(shape.isin("ARRAY<STRING>", "ARRAY<VOID>") & F.col("kind").endswith("_list"), F.try_variant_get(value, "$", "array<string>"))
    many = F.when(F.forall(many, lambda x: x.isNotNull()), many)
    offset = F.when(F.schema_of_variant(F.try_variant_get("v", "$.block_offset", "variant")) == "BIGINT", F.try_variant_get("v", "$.block_offset", "bigint"))

    def of_kind(name: str) -> DataFrame:
        """References of the rules of a kind, from the entries that those name."""
        rules = [(*r,) for r in REFERENCE_RULES if r[2].startswith(name)]
        named = good.filter(F.col("entry").isin(*sorted({r[0] for r in rules}))).join(F.broadcast(spark.createDataFrame(rules, "entry string, member string, kind string")), "entry")
        refs = named.select("package", "entry", "line_no", "member", "kind", offset.alias("block_offset"), F.posexplode(F.coalesce(one, many)).alias("position", "ref"))
        return refs.withColumn("position", F.when(F.col("kind").endswith("_list"), F.col("position"))).withColumn("block_offset", F.when(F.col("kind") == "block", F.col("block_offset")))

    def records(entry: str, key: str, *fields: str) -> DataFrame:
        text = lambda f: F.when(F.schema_of_variant(F.try_variant_get("v", f"$.{f}", "variant")) == "STRING", F.try_variant_get("v", f"$.{f}", "string"))
        df = good.filter(F.col("entry") == entry).select("package", "line_no", text(key).alias("ref"), *[F.to_json(F.try_variant_get("v", f"$.{f}", "variant")).alias(f) if f != "crop_file_path" else text(f).alias(f) for f in fields])
        return df.filter("ref is not null").groupBy("package", "ref").agg(F.min_by(F.struct(*fields), "line_no").alias("r"))

    frames = settled(records("timeline/frames.jsonl", "id", "frame_index", "pts_us").select("package", "ref", "r.frame_index", "r.pts_us", F.lit(True).alias("found")))
    crops = records("text/evidence_crops.jsonl", "crop_id", "crop_file_path").select("package", "ref", F.col("r.crop_file_path").alias("path"), F.lit(True).alias("found"))
    held = files.select("package", F.col("entry").alias("path"), "file").dropDuplicates(["package", "path"])
    crops = settled(_joined(crops, held, ["package", "path"]).drop("path"))
    # Each kind meets its own table only, so that no reference without a key travels with all others of its kind.
    out = [
        of_kind("frame").join(by_size(frames), ["package", "ref"], "left"),
        of_kind("crop").join(by_size(crops), ["package", "ref"], "left"),
        of_kind("entry_path").join(held.select("package", F.col("path").alias("ref"), "file"), ["package", "ref"], "left").withColumn("found", F.col("file").isNotNull()),
        _joined(of_kind("block"), blocks.withColumnRenamed("block_file", "ref"), ["package", "ref", "block_offset"]).withColumn("found", F.col("block_ordinal").isNotNull()),
    ]
    every = out[0]
    for part in out[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    return every.select(
        "package", "entry", "line_no", "member", "position", "ref", F.coalesce("found", F.lit(False)).alias("found"), "frame_index", "pts_us", "file", "block_offset", "block_ordinal", "decoded_file", "decoded_offset", "decoded_length"
    )


#: Fixed value: the member that exported records carry.
MEMBER = "svp_export"


def append_resolved(rows: DataFrame, resolved: list[str], text: str = "value") -> DataFrame:
    """Append the resolved references to each record's JSON text as its last member."""
    extra = F.to_json(F.struct(*resolved))
    body = F.rtrim(F.col(text))
    empty = F.regexp_replace(body, r"\s", "") == "{}"
    return rows.withColumn(text, F.concat(F.expr(f"substring(rtrim({text}), 1, length(rtrim({text})) - 1)"), F.when(empty, "").otherwise(","), F.lit(f'"{MEMBER}":'), extra, F.lit("}")))


def write_jsonl(rows: DataFrame, path: str, order: list[str], columns: list[str] | None = None) -> None:
    """One compact JSON object a line, ordered within and across part files (range partitions in name order)."""
    names = columns or [c for c in rows.columns]
    rows.sort(*order).select(F.to_json(F.struct(*names)).alias("value")).write.mode("error").text(path)


def index_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, digest) of the given tables; the digest does not depend on the order of rows."""
    out = None
    for name, df in tables.items():
        one = table_digest(df, name)
        out = one if out is None else out.unionByName(one)
    return out


def write_index(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write tables, and last of all their manifest (manifest.parquet), which is read back and returned: an index without
    one is not complete."""
    where = path.rstrip("/")
    for name, df in tables.items():
        df.write.mode("error").parquet(f"{where}/{name}.parquet")
    spark = next(iter(tables.values())).sparkSession
    held = {name: spark.read.parquet(f"{where}/{name}.parquet") for name in tables}
    index_manifest(held).write.mode("error").parquet(f"{where}/manifest.parquet")
    return spark.read.parquet(f"{where}/manifest.parquet")


def counts_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of the given tables."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def with_line_numbers(df: DataFrame, order: list[str]) -> DataFrame:
    """Number the rows of one layer from 1: ranges of the order are counted, then numbered each by itself."""
    parts = settled(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    counts = parts.groupBy("_p").agg(F.count("*").alias("_c"))
    before = counts.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return parts.withColumn("_r", own).join(before, "_p").withColumn("line_no", (F.col("_r") + F.col("_b")).cast("long")).drop("_p", "_r", "_b")


def export_package(layers: dict[str, DataFrame], path: str, order: str = "line_no", drop: tuple[str, ...] = ("line_no",)) -> None:
    """Write each layer (entry -> rows) as JSON lines under a staging folder and publish it by one rename.

    Fails if the target is there already; a failed run leaves the target untouched."""
    spark = next(iter(layers.values())).sparkSession
    target = path.rstrip("/")
    stage = f"{target}.staging"
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jvm(target)):
        raise FileExistsError(target)
    fs.delete(jvm(stage), True)
    for entry, rows in layers.items():
        write_jsonl(rows, f"{stage}/{entry}", [order], [c for c in rows.columns if c not in drop])
    if not fs.rename(jvm(stage), jvm(target)):
        raise OSError(f"{stage} could not be renamed")
