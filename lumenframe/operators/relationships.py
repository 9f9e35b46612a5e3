"""All relationship builders over a package's layers, in their order, under one numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.layers import int_field, number_field, string_field
from . import edges as eg
from .export import with_line_numbers
from .intervals import by_size

#: Typed views of layers, as the entry and its fields with their types.
VIEWS = {
    "words": ("transcript/words.jsonl", (("id", "string"), ("speaker_id", "string"), ("text", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "speakers": ("transcript/speakers.jsonl", (("id", "string"), ("display_name", "string"))),
    "segments": ("transcript/speaker_segments.jsonl", (("segment_id", "string"), ("id", "string"), ("speaker_id", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "frames": ("timeline/frames.jsonl", (("id", "string"), ("shot_id", "string"), ("scene_id", "string"), ("pts_us", "whole"))),
    "shots": ("timeline/shots.jsonl", (("id", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "scenes": ("timeline/scenes.jsonl", (("id", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "entities": ("entities/entities.jsonl", (("id", "string"), ("entity_type", "string"))),
    "tracks": ("entities/entity_tracks.jsonl", (("id", "string"), ("entity_id", "string"))),
    "regions": ("spatial/regions.jsonl", (("id", "string"), ("entity_id", "string"), ("track_id", "string"), ("frame_id", "string"), ("pts_us", "whole"), ("box_norm", "numbers"))),
    "masks": ("spatial/masks.index.jsonl", (("id", "string"), ("region_id", "string"))),
    "depth": ("spatial/depth.index.jsonl", (("id", "string"), ("frame_id", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "text_regions": ("text/text_regions.jsonl", (("text_region_id", "string"), ("shot_id", "string"), ("scene_id", "string"), ("start_us", "whole"), ("end_us", "whole"), ("confidence", "number"), ("bbox_norm", "numbers"))),
    "text_observations": ("text/text_observations.jsonl", (("text_observation_id", "string"), ("text_region_id", "string"), ("start_us", "whole"), ("end_us", "whole"), ("confidence", "number"), ("evidence_crop_refs", "strings"))),
    "numeric_values": ("text/numeric_values.jsonl", (("numeric_value_id", "string"), ("text_observation_id", "string"), ("start_us", "whole"), ("end_us", "whole"), ("confidence", "number"))),
    "crops": ("text/evidence_crops.jsonl", (("crop_id", "string"),)),
    "colors": ("colors/color_observations.jsonl", (("color_observation_id", "string"), ("target_type", "string"), ("target_id", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "embeddings": ("embeddings/embeddings.index.jsonl", (("id", "string"), ("input_ref", "string"), ("input_kind", "string"), ("start_us", "whole"), ("end_us", "whole"))),
    "edges": ("relationships/relationships.jsonl", (("id", "string"), ("type", "string"), ("source_id", "string"), ("target_id", "string"), ("start_us", "whole"), ("end_us", "whole"), ("confidence", "number"))),
}


def view(lines: DataFrame, name: str) -> DataFrame:
    """A layer with typed fields and line_no; malformed lines are passed over."""
    entry, fields = VIEWS[name]
    v = F.col("v")

    def typed(field: str, kind: str):
        if kind in ("strings", "numbers"):
            item = "array<string>" if kind == "strings" else "array<double>"
            return F.filter(F.try_variant_get(v, f"$.{field}", item), lambda x: x.isNotNull()).alias(field)
        return {"string": string_field, "whole": int_field, "number": number_field}[kind](v, field).alias(field)

    rows = lines.filter(~F.col("malformed"))
    if "entry" in lines.columns:
        rows = rows.filter(F.col("entry") == entry)
    return rows.select("line_no", *[typed(field, kind) for field, kind in fields])


def relationship_edges(lines: DataFrame) -> DataFrame:
    """The edge table of the relationships layer: missing or mistyped times are 0, confidence 1."""
    e = view(lines, "edges")
    return e.select(
        F.col("line_no").alias("edge_idx"), F.col("id").alias("relationship_id"), "type", "source_id", "target_id",
        F.coalesce("start_us", F.lit(0)).alias("start_us"), F.coalesce("end_us", F.lit(0)).alias("end_us"), F.coalesce("confidence", F.lit(1.0)).alias("confidence"),
    )


def load_edges(spark, index_path: str | None, lines: DataFrame) -> DataFrame:
    """The index's relationships table where it can be read, else the layer's lines."""
    if index_path:
        try:
            t = spark.read.parquet(index_path)
            # Edges have the order of their lines, or of their ids in an index without it, however its files are read.
            t = t if "line_no" in t.columns else with_line_numbers(t, ["id"])
            return t.select(F.col("line_no").cast("long").alias("edge_idx"), F.col("id").alias("relationship_id"), "type", "source_id", "target_id", "start_us", "end_us", "confidence")
        except Exception as e:  # an index that is not there or not readable is no error
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e) and "FAILED_READ_FILE" not in str(e):
                raise
    return relationship_edges(lines)


def build_all(layers: dict[str, DataFrame]) -> DataFrame:
    """Edges of builders 1 to 16 and 19 from the layers' typed views (`view`), numbered; mask and depth relations need
    decoded blocks and come from `edges.mask_relations` and `edges.depth_relations`."""
    t = layers
    instant = lambda df: df.withColumn("start_us", F.col("pts_us")).withColumn("end_us", F.col("pts_us"))
    named = t["segments"].withColumn("segment_id", F.coalesce(F.nullif("segment_id", F.lit("")), "id"))
    ref = eg.reference_edges
    regions = t["regions"].filter("id <> ''")
    at = instant(regions)
    own_ids = lambda df: by_size(df.select("id").distinct())

    def owned(owner: DataFrame, column: str, prefix: str, kind: str) -> DataFrame:
        """owner -> region for regions whose owner exists."""
        rows = at.join(own_ids(owner), at[column] == owner["id"], "left_semi")
        return rows.select(*eg._edge(8, prefix, kind, F.col(column), F.col("id"), F.col("start_us"), F.col("end_us"), [F.col("line_no"), F.lit(0 if column == "entity_id" else 1)]))

    mask_time = regions.groupBy(F.col("id").alias("region_id")).agg(F.max_by("pts_us", "line_no").alias("pts_us"))
    masks = instant(t["masks"].filter("id <> '' and region_id <> ''").join(mask_time.hint("merge"), "region_id"))
    text_ids = t["text_regions"].select(F.col("text_region_id").alias("id")).unionByName(t["text_observations"].select(F.col("text_observation_id").alias("id")))
    known = own_ids(t["entities"])
    seen = regions.join(known, regions.entity_id == known.id, "left_semi")
    frame_times = instant(t["frames"])
    parts = [
        ref(1, t["text_regions"], "text_region_id", "shot_id", t["shots"], "id", "rel_tr_shot_", "appears_in_shot", "start_us", "end_us", "confidence"),
        ref(1, t["text_regions"], "text_region_id", "scene_id", t["scenes"], "id", "rel_tr_scene_", "appears_in_scene", "start_us", "end_us", "confidence"),
        ref(2, t["text_observations"], "text_observation_id", "text_region_id", t["text_regions"], "text_region_id", "rel_obs_region_", "observation_in_region", "start_us", "end_us", "confidence"),
        eg.evidence_crops(2, t["text_observations"], t["crops"]),
        ref(3, t["numeric_values"], "numeric_value_id", "text_observation_id", t["text_observations"], "text_observation_id", "rel_num_obs_", "numeric_value_from_observation", "start_us", "end_us", "confidence"),
        ref(4, t["words"], "id", "speaker_id", t["speakers"], "id", "rel_word_speaker_", "word_spoken_by", "start_us", "end_us"),
        eg.word_segments(4, t["words"], named),
        eg.by_target_kind(5, t["colors"], "color_observation_id", "target_type", "target_id", {"frame": (t["frames"], "id"), "shot": (t["shots"], "id"), "scene": (t["scenes"], "id"), "region": (regions, "id")}, "rel_color_target_", "color_observation_of"),
        ref(6, t["depth"], "id", "frame_id", t["frames"], "id", "rel_depth_frame_", "depth_for_frame", "start_us", "end_us"),
        eg.by_target_kind(7, t["embeddings"], "id", "input_kind", "input_ref", {"text_observation": (text_ids, "id"), "text_region": (t["text_regions"], "text_region_id"), "transcript": (t["words"], "id"), "word": (t["words"], "id")}, "rel_emb_source_", "embedding_source_is"),
        owned(t["entities"], "entity_id", "rel_entity_region_", "appears_in_frame"),
        owned(t["tracks"], "track_id", "rel_track_region_", "track_observation"),
        ref(8, at, "id", "frame_id", t["frames"], "id", "rel_region_frame_", "region_in_frame", "start_us", "end_us"),
        masks.select(*eg._edge(8, "rel_region_mask_", "has_mask", F.col("region_id"), F.col("id"), F.coalesce("start_us", F.lit(0)), F.coalesce("end_us", F.lit(0)), [F.col("line_no"), F.lit(3)])),
        eg.near_regions(9, regions),
        eg.enters_exits(10, regions, t["entities"], t["frames"]),
        eg.text_entity_overlaps(11, t["text_regions"], seen),
        ref(12, frame_times, "id", "shot_id", t["shots"], "id", "rel_frame_shot_", "frame_in_shot", "start_us", "end_us"),
        ref(12, frame_times, "id", "scene_id", t["scenes"], "id", "rel_frame_scene_", "frame_in_scene", "start_us", "end_us"),
        eg.point_in_spans(13, seen, t["shots"], "id", "rel_entity_shot_", "appears_in_shot"),
        eg.point_in_spans(13, seen, t["scenes"], "id", "rel_entity_scene_", "appears_in_scene"),
        eg.span_overlaps(14, t["text_regions"], "text_region_id", named, "segment_id", "rel_tr_speech_", "visible_during_speech"),
        eg.point_in_spans(14, seen, named, "segment_id", "rel_entity_speech_", "visible_during_speech"),
        eg.span_overlaps(15, t["text_regions"], "text_region_id", t["words"], "id", "rel_tr_word_", "visible_during_word_range"),
        eg.segments_while_visible(16, named, seen),
        eg.motion(19, regions, t["entities"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return eg.number(out)
