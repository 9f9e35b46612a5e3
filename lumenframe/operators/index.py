"""The relational index: tables projected from layers, their canonical row stream, and text and vector search on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geometry import dot
from .search import relationship_class

#: Tables of the index and the columns of each; the first is the primary key.
TABLES = {
    "svp_meta": ("key", "value"),
    "text_regions": ("text_region_id", "observation_type", "start_us", "end_us", "shot_id", "scene_id", "confidence"),
    "text_observations": ("text_observation_id", "text_region_id", "raw_text", "normalized_text", "layout_class", "confidence"),
    "text_fts": ("text_observation_id", "normalized_text", "start_us", "end_us"),
    "numeric_values": ("numeric_value_id", "text_observation_id", "text_region_id", "raw_text", "numeric_value", "number_kind", "unit"),
    "color_observations": ("color_observation_id", "target_type", "target_id", "start_us", "end_us", "dominant_bucket", "coverage_total"),
    "color_bucket_coverage": ("color_observation_id", "bucket", "coverage"),
    "color_targets": ("target_id", "target_type", "observations"),
    "entities": ("id", "entity_type", "first_seen_us", "last_seen_us"),
    "entity_tracks": ("id", "entity_id", "start_us", "end_us", "region_count"),
    "spatial_regions": ("id", "entity_id", "track_id", "frame_id", "pts_us"),
    "spatial_masks": ("id", "region_id", "frame_id", "width", "height"),
    "relationships": ("id", "type", "relationship_class", "source_id", "target_id", "start_us", "end_us", "confidence"),
    "vector_index": ("id", "embedding_set_id", "input_ref", "input_kind", "embedding"),
    "objects": ("id", "kind", "entry", "summary"),
    "temporal_spans": ("id", "kind", "start_us", "end_us"),
    "binary_blocks": ("block_id", "block_file", "block_offset", "block_length"),
}


def first_per_key(df: DataFrame, key: str, order: str = "line_no") -> DataFrame:
    """Later rows of a primary key are dropped, as a failed insert drops them."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def project(layers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The index tables that the given layers (text_regions, color_observations, relationships, ...) make up."""
    out = {}
    for name, spec in TABLES.items():
        columns = list(spec)
        if name in layers:
            df = layers[name]
            have = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns if c != "relationship_class"]
            rows = first_per_key(df, columns[0]) if "line_no" in df.columns else df
            if name == "relationships":  # edges keep the order of their lines
                have, columns = ([*have, F.col("line_no")], [*columns, "line_no"]) if "line_no" in df.columns else (have, columns)
                out[name] = rows.select(*have).withColumn("relationship_class", relationship_class(F.col("type"))).select(*columns)
            else:
                out[name] = rows.select(*have)
    if "text_observations" in layers and "text_regions" in layers:
        spans = first_per_key(layers["text_regions"], "text_region_id").select("text_region_id", "start_us", "end_us")
        obs = first_per_key(layers["text_observations"], "text_observation_id").drop("start_us", "end_us")
        out["text_fts"] = obs.join(spans, "text_region_id", "left").select(*TABLES["text_fts"])
    if "color_observations" in layers:
        c = first_per_key(layers["color_observations"], "color_observation_id")
        out["color_bucket_coverage"] = c.select("color_observation_id", F.explode("bucket_coverage").alias("bucket", "coverage"))
        out["color_targets"] = c.groupBy("target_id").agg(F.first("target_type").alias("target_type"), F.count("*").alias("observations"))
    return out


def temporal_spans(layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(id, kind, start_us, end_us) of all layers (kind -> table, id column) with a time."""
    out = None
    for kind, (df, key) in layers.items():
        one = df.select(F.col(key).alias("id"), F.lit(kind).alias("kind"), "start_us", "end_us")
        out = one if out is None else out.unionByName(one)
    return out


def typed(c: Column, kind: str) -> Column:
    """A scalar of the row stream: null, or its type's letter and its text."""
    letter = {"bigint": "i", "int": "i", "smallint": "i", "double": "r", "float": "r", "boolean": "i", "binary": "b"}.get(kind, "t")
    text = F.hex(c) if letter == "b" else c.cast("string")
    return F.when(c.isNull(), "n").otherwise(F.concat(F.lit(letter), F.length(text).cast("string"), F.lit(":"), text))


def row_digests(df: DataFrame) -> DataFrame:
    """(row_hash): SHA-256 of each row's typed scalars in column order."""
    kinds = dict(df.dtypes)
    return df.select(F.sha2(F.concat_ws(",", *[typed(F.col(c), kinds[c]) for c in df.columns]), 256).alias("row_hash"))


def table_digest(df: DataFrame, name: str) -> DataFrame:
    """(table, rows, digest): a digest over all rows that does not depend on their order.

    Rows' hashes are summed slice by slice as whole numbers, so that no task ever holds all rows; equal tables have equal
    digests, and repeated rows count."""
    h = row_digests(df)
    part = lambda i: F.sum(F.conv(F.substring("row_hash", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).cast("string")
    return h.agg(F.count("*").alias("rows"), F.sha2(F.concat_ws("|", *[F.coalesce(part(i), F.lit("0")) for i in range(5)]), 256).alias("digest")).select(F.lit(name).alias("table"), "rows", "digest")


def inverted_index(df: DataFrame, key: str, text: str) -> DataFrame:
    """(token, key, count) of lower-cased letter and digit tokens."""
    return df.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))).alias("token")).groupBy("token", key).agg(F.count("*").alias("n"))


def match(index: DataFrame, tokens: list[str], key: str) -> DataFrame:
    """(key, score) of rows that hold all the tokens; score is the tokens' summed count."""
    return index.filter(F.col("token").isin(*tokens)).groupBy(key).agg(F.count("*").alias("_t"), F.sum("n").alias("score")).filter(F.col("_t") == len(set(tokens))).drop("_t")


def nearest(vectors: DataFrame, query: list[float], key: str, column: str, k: int) -> DataFrame:
    """The k rows of largest cosine with one query vector: a scan and a top-k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    size = sum(x * x for x in query) ** 0.5
    cos = dot(F.col(column), q) / F.nullif(F.sqrt(dot(F.col(column), F.col(column))) * F.lit(size), F.lit(0.0))
    return vectors.select(key, cos.alias("cosine")).filter("cosine is not null").orderBy(F.desc("cosine"), key).limit(k)
