"""Relationship builders: observation tables joined into typed edges.

Each builder returns (builder, prefix, type, source_id, target_id, start_us, end_us, confidence, order...) rows; `number`
gives all edges one sequence over the builders in their order, and ids made of prefix and number. Tables are DataFrames
with the fields of the format; each has line_no, the place in its layer, and order keys come from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import box_iou, center, center_distance
from ..sources.blocks import rle_decode
from .export import with_line_numbers
from .intervals import by_size, first_match, overlap_join, point_join

#: Thresholds of the spatial rules.
NEAR, MASK_IOU, CONTAINMENT, STATIONARY, MOVES_WITH = 0.15, 0.1, 0.8, 0.02, 0.05
BIN = 1_000_000  # microseconds; about the length of a spoken segment


def _edge(builder: int, prefix: str, kind: str | Column, source: Column, target: Column, start: Column, end: Column, order: list[Column], confidence: Column | None = None, name: Column | None = None) -> list[Column]:
    name = F.lit(None).cast("string") if name is None else name
    kind = F.lit(kind) if isinstance(kind, str) else kind
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return [
        F.lit(builder).alias("builder"), prefix.alias("prefix"), kind.alias("type"), source.alias("source_id"), target.alias("target_id"),
        start.cast("long").alias("start_us"), end.cast("long").alias("end_us"), F.coalesce(confidence if confidence is not None else F.lit(1.0), F.lit(1.0)).alias("confidence"),
        F.struct(F.coalesce(name, F.lit("")).alias("name"), *[o.cast("long").alias(f"o{i}") for i, o in enumerate([*order, *[F.lit(None)] * (2 - len(order))])]).alias("ord"),
    ]


def _ids(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.coalesce(F.col(column), F.lit("")) != "").select(F.col(column).alias("_id")).distinct()


def _owned(df: DataFrame, column: str, owner: DataFrame, owner_id: str) -> DataFrame:
    """Rows whose reference exists; the others are dangling and counted by `dangling`."""
    return df.join(by_size(_ids(owner, owner_id)), F.col(column) == F.col("_id"), "left_semi")


def dangling(df: DataFrame, column: str, owner: DataFrame, owner_id: str) -> DataFrame:
    """Rows with a reference that does not exist."""
    return df.filter(F.coalesce(F.col(column), F.lit("")) != "").join(by_size(_ids(owner, owner_id)), F.col(column) == F.col("_id"), "left_anti")


def reference_edges(builder: int, rows: DataFrame, source: str, target: str, owner: DataFrame, owner_id: str, prefix: str, kind: str, start: str, end: str, confidence: str | None = None) -> DataFrame:
    """The common shape: one edge for each row whose reference exists, in the rows' order."""
    return _owned(rows, target, owner, owner_id).select(
        *_edge(builder, prefix, kind, F.col(source), F.col(target), F.coalesce(start, F.lit(0)), F.coalesce(end, F.lit(0)), [F.col("line_no")], F.col(confidence) if confidence else None)
    )


def evidence_crops(builder: int, observations: DataFrame, crops: DataFrame) -> DataFrame:
    """An edge for each crop an observation names, if it exists."""
    rows = observations.select("text_observation_id", "line_no", "start_us", "end_us", F.posexplode("evidence_crop_refs").alias("p", "crop_id"))
    return _owned(rows, "crop_id", crops, "crop_id").select(
        *_edge(builder, "rel_obs_crop_", "has_evidence_crop", F.col("text_observation_id"), F.col("crop_id"), F.col("start_us"), F.col("end_us"), [F.col("line_no"), F.col("p")])
    )


def word_segments(builder: int, words: DataFrame, segments: DataFrame) -> DataFrame:
    """A word's midpoint (truncated) in the first segment, in file order, that holds it."""
    mid = words.withColumn("mid", F.expr("div(start_us + end_us, 2)")).select("id", "line_no", "mid", F.col("start_us").alias("w_start"), F.col("end_us").alias("w_end"))
    segs = segments.select(F.col("segment_id"), F.col("line_no").alias("s_line"), F.col("start_us").alias("s_start"), F.col("end_us").alias("s_end"))
    return first_match(mid, segs, BIN, "mid", ("s_start", "s_end"), ["line_no"], "s_line").select(
        *_edge(builder, "rel_word_seg_", "word_in_speaker_segment", F.col("id"), F.col("segment_id"), F.col("w_start"), F.col("w_end"), [F.col("line_no")])
    )


def by_target_kind(builder: int, rows: DataFrame, source: str, kind_col: str, target: str, owners: dict[str, tuple[DataFrame, str]], prefix: str, kind: str) -> DataFrame:
    """References into the table that the row's kind names; rows of other kinds are taken as they are."""
    known = None
    for name, (df, column) in owners.items():
        ids = _ids(df, column).withColumn("_kind", F.lit(name))
        known = ids if known is None else known.unionByName(ids)
    listed = F.col(kind_col).isin(*owners)
    found = rows.join(by_size(known), (F.col(kind_col) == F.col("_kind")) & (F.col(target) == F.col("_id")), "left")
    return found.filter(~F.coalesce(listed, F.lit(False)) | F.col("_id").isNotNull()).filter(F.coalesce(target, F.lit("")) != "").select(
        *_edge(builder, prefix, kind, F.col(source), F.col(target), F.coalesce("start_us", F.lit(0)), F.coalesce("end_us", F.lit(0)), [F.col("line_no")])
    )


def near_regions(builder: int, regions: DataFrame) -> DataFrame:
    """Regions of one frame that do not overlap, with centres at most NEAR apart; each pair once, in file order.

    Centres lie in cells three times as wide as NEAR. A cell meets itself and four of its neighbours, so that each pair of
    cells meets once and a crowded frame is many keys; only regions within NEAR of a neighbour are sent to it."""
    x0, y0, x1, y1 = (F.get("box_norm", F.lit(i)) for i in range(4))
    a = regions.filter("frame_id <> '' and id <> '' and size(box_norm) >= 4").select("frame_id", "id", "line_no", "pts_us", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    reach = NEAR * (1 + 1e-9)
    cell = lambda low, high, by=0.0: F.floor(((F.col(low) + F.col(high)) / 2 + by) / (3 * reach)).cast("int")
    a = a.withColumn("cx", cell("x0", "x1")).withColumn("cy", cell("y0", "y1"))
    right, above, below = cell("x0", "x1", reach) > F.col("cx"), cell("y0", "y1", reach) > F.col("cy"), cell("y0", "y1", -reach) < F.col("cy")
    near = ((0, 0, F.lit(True)), (0, 1, above), (1, -1, right & below), (1, 0, right), (1, 1, right & above))
    steps = F.explode(F.array_compact(F.array(*[F.when(there, F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))) for i, j, there in near])))
    b = a.select("frame_id", *[F.col(c).alias(f"o_{c}") for c in ("id", "line_no", "pts_us", "x0", "y0", "x1", "y1")], F.col("cx").alias("o_cx"), F.col("cy").alias("o_cy"), steps.alias("s"))
    b = b.select("frame_id", *[c for c in b.columns if c.startswith("o_") and c not in ("o_cx", "o_cy")], (F.col("o_cx") + F.col("s.i")).alias("cx"), (F.col("o_cy") + F.col("s.j")).alias("cy"), (F.col("s.i") + F.abs("s.j") == 0).alias("same"))
    pair = a.join(b.hint("merge"), ["frame_id", "cx", "cy"]).filter((~F.col("same") | (F.col("line_no") < F.col("o_line_no"))) & (F.col("id") != F.col("o_id")) & (F.col("line_no") != F.col("o_line_no")))
    apart = (F.least("x1", "o_x1") <= F.greatest("x0", "o_x0")) | (F.least("y1", "o_y1") <= F.greatest("y0", "o_y0"))
    middle = lambda p, q: (F.col(p) + F.col(q)) / 2
    dx, dy = middle("x0", "x1") - middle("o_x0", "o_x1"), middle("y0", "y1") - middle("o_y0", "o_y1")
    hit = pair.filter(apart & (F.sqrt(dx * dx + dy * dy) <= NEAR))
    first = F.col("line_no") < F.col("o_line_no")
    of = lambda c, mine: F.when(first == mine, F.col(c)).otherwise(F.col(f"o_{c}"))
    return hit.select(*_edge(builder, "rel_spatial_near_", "near", of("id", True), of("id", False), of("pts_us", True), of("pts_us", True), [of("line_no", True), of("line_no", False)]))


def enters_exits(builder: int, regions: DataFrame, entities: DataFrame, frames: DataFrame) -> DataFrame:
    """First and last frame of each entity, the first in file order on ties; no exit in the frame of the entry."""
    rows = _owned(_owned(regions.filter("pts_us is not null"), "entity_id", entities, "id"), "frame_id", frames, "id")
    ends = rows.groupBy("entity_id").agg(
        F.min(F.struct("pts_us", "line_no", "frame_id")).alias("first"), F.max(F.struct("pts_us", F.negative("line_no").alias("m"), "frame_id")).alias("last")
    )
    enters = ends.select(*_edge(builder, "rel_entity_enters_", "enters_frame", F.col("entity_id"), F.col("first.frame_id"), F.col("first.pts_us"), F.col("first.pts_us"), [F.lit(0)], name=F.col("entity_id")))
    exits = ends.filter("last.frame_id <> first.frame_id").select(*_edge(builder, "rel_entity_exits_", "exits_frame", F.col("entity_id"), F.col("last.frame_id"), F.col("last.pts_us"), F.col("last.pts_us"), [F.lit(1)], name=F.col("entity_id")))
    return enters.unionByName(exits)


def text_entity_overlaps(builder: int, text_regions: DataFrame, regions: DataFrame) -> DataFrame:
    """A spatial region's moment inside a text region's span, and boxes that overlap: one edge for each spatial region."""
    t = text_regions.select("text_region_id", F.col("line_no").alias("t_line"), F.col("start_us").alias("t_start"), F.col("end_us").alias("t_end"), F.col("bbox_norm").alias("t_box"))
    r = regions.filter("pts_us is not null").select("entity_id", "line_no", "pts_us", "box_norm")
    hit = point_join(r, t, BIN, "pts_us", ("t_start", "t_end")).filter(box_iou(F.col("t_box"), F.col("box_norm")) > 0)
    return hit.select(*_edge(builder, "rel_tr_entity_", "text_region_overlaps_entity", F.col("text_region_id"), F.col("entity_id"), F.col("pts_us"), F.col("pts_us"), [F.col("t_line"), F.col("line_no")]))


def point_in_spans(builder: int, regions: DataFrame, spans: DataFrame, span_id: str, prefix: str, kind: str) -> DataFrame:
    """A region's entity at its moment in each shot, scene or segment that holds it."""
    s = spans.select(F.col(span_id).alias("span_id"), F.col("line_no").alias("s_line"), F.col("start_us").alias("s_start"), F.col("end_us").alias("s_end"))
    r = regions.filter("pts_us is not null and entity_id <> ''").select("entity_id", "line_no", "pts_us")
    return point_join(r, s, BIN, "pts_us", ("s_start", "s_end")).select(
        *_edge(builder, prefix, kind, F.col("entity_id"), F.col("span_id"), F.col("pts_us"), F.col("pts_us"), [F.col("line_no"), F.col("s_line")])
    )


def span_overlaps(builder: int, left: DataFrame, left_id: str, right: DataFrame, right_id: str, prefix: str, kind: str) -> DataFrame:
    """Spans that share time, for the time they share."""
    a = left.select(F.col(left_id).alias("l_id"), F.col("line_no").alias("l_line"), F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    b = right.select(F.col(right_id).alias("r_id"), F.col("line_no").alias("r_line"), F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"))
    return overlap_join(a, b, BIN).select(
        *_edge(builder, prefix, kind, F.col("l_id"), F.col("r_id"), F.greatest("l_start", "r_start"), F.least("l_end", "r_end"), [F.col("l_line"), F.col("r_line")])
    )


def segments_while_visible(builder: int, segments: DataFrame, regions: DataFrame) -> DataFrame:
    """Each segment once with each entity that has a moment in it."""
    s = segments.select("segment_id", F.col("line_no").alias("s_line"), F.col("start_us").alias("s_start"), F.col("end_us").alias("s_end"))
    r = regions.filter("pts_us is not null and entity_id <> ''").select("entity_id", "line_no", "pts_us")
    first = point_join(r, s, BIN, "pts_us", ("s_start", "s_end")).groupBy("segment_id", "s_line", "s_start", "s_end", "entity_id").agg(F.min("line_no").alias("line_no"))
    return first.select(*_edge(builder, "rel_seg_entity_", "speaker_active_during_entity_visible", F.col("segment_id"), F.col("entity_id"), F.col("s_start"), F.col("s_end"), [F.col("s_line"), F.col("line_no")]))


def motion(builder: int, regions: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities that stand still (an edge to themselves) and pairs of moving ones with about the same displacement.

    Displacement runs from the first to the last region in file order. Pairs are found through cells of the displacement
    plane as wide as the threshold, each joined to itself and its neighbours."""
    rows = _owned(regions.filter("id <> '' and size(box_norm) >= 4"), "entity_id", entities, "id")
    m = rows.groupBy("entity_id").agg(
        F.min_by(F.struct("box_norm", "pts_us"), "line_no").alias("f"), F.max_by(F.struct("box_norm", "pts_us"), "line_no").alias("l"), F.count("*").alias("n")
    ).filter("n >= 2")
    (fx, fy), (lx, ly) = center(F.col("f.box_norm")), center(F.col("l.box_norm"))
    m = m.withColumn("dx", lx - fx).withColumn("dy", ly - fy).withColumn("d", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")))
    m = m.select("entity_id", "dx", "dy", "d", F.coalesce("f.pts_us", F.lit(0)).alias("first"), F.coalesce("l.pts_us", F.lit(0)).alias("last"))
    still = m.filter(F.col("d") <= STATIONARY).select(
        *_edge(builder, "rel_stationary_", "stationary_relative_to_camera", F.col("entity_id"), F.col("entity_id"), F.col("first"), F.col("last"), [F.lit(0)], name=F.concat(F.lit("0"), F.col("entity_id")))
    )
    cell = lambda c: F.floor(F.col(c) / MOVES_WITH).cast("long")
    moving = m.filter(F.col("d") > STATIONARY).withColumn("cx", cell("dx")).withColumn("cy", cell("dy"))
    b = moving.select(*[F.col(c).alias(f"b_{c}") for c in ("entity_id", "dx", "dy", "first", "last")], "cx", "cy")
    near = F.explode(F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    a = moving.withColumn("c", near).drop("cx", "cy").select("*", "c.cx", "c.cy")
    gap = F.sqrt((F.col("dx") - F.col("b_dx")) ** 2 + (F.col("dy") - F.col("b_dy")) ** 2)
    pairs = a.join(b.hint("merge"), ["cx", "cy"]).filter(F.col("entity_id") < F.col("b_entity_id")).filter(gap <= MOVES_WITH)
    return still.unionByName(
        pairs.select(*_edge(builder, "rel_moves_with_", "moves_with", F.col("entity_id"), F.col("b_entity_id"), F.least("first", "b_first"), F.greatest("last", "b_last"), [F.lit(1)], name=F.concat(F.lit("1"), F.col("entity_id"), F.lit("\0"), F.col("b_entity_id"))))
    )


def mask_relations(masks: DataFrame, polarity: str = "reference") -> DataFrame:
    """Pairs of masks of one frame and raster: (frame_id, source_id, target_id, type).

    masks: frame_id, region_id, line_no, width, height, rle (binary), depth (mean depth under the mask, or null). Where
    both depths are known and differ and the masks' IoU reaches MASK_IOU, the nearer occludes the other; otherwise they
    overlap, and one contains the other at CONTAINMENT. polarity: "reference" takes the smaller depth as nearer, "spec"
    the larger. A frame's masks are one group, bounded by what a frame can show."""
    if polarity not in ("reference", "spec"):
        raise ValueError("polarity is reference or spec")

    def frame(pdf):
        import pandas as pd

        rows = []
        items = []
        for r in pdf.sort_values("line_no").itertuples():
            m = rle_decode(bytes(r.rle), int(r.width) * int(r.height))
            if m is not None:
                items.append((r.region_id, (int(r.width), int(r.height)), m, r.depth))
        for i, (a, size_a, ma, da) in enumerate(items):
            for b, size_b, mb, db in items[i + 1 :]:
                if size_a != size_b or a == b:
                    continue
                both, either = int((ma & mb).sum()), int((ma | mb).sum())
                if not both or not either:
                    continue
                if both / either >= MASK_IOU and da == da and db == db and da is not None and db is not None and da != db:
                    front, back = (a, b) if (da < db) == (polarity == "reference") else (b, a)
                    rows += [(front, back, "occludes"), (back, front, "occluded_by")]
                    continue
                if both / either >= MASK_IOU:
                    rows.append((a, b, "overlaps"))
                if both / int(mb.sum()) >= CONTAINMENT:
                    rows += [(a, b, "contains"), (b, a, "contained_by")]
                elif both / int(ma.sum()) >= CONTAINMENT:
                    rows += [(b, a, "contains"), (a, b, "contained_by")]
        frame_id = pdf["frame_id"].iloc[0]
        return pd.DataFrame([(frame_id, *r) for r in rows], columns=["frame_id", "source_id", "target_id", "type"])

    return masks.groupBy("frame_id").applyInPandas(frame, "frame_id string, source_id string, target_id string, type string")


def depth_relations(depths: DataFrame, polarity: str = "reference") -> DataFrame:
    """foreground_relative_to and background_relative_to for region pairs of a frame with different mean depth.

    depths: frame_id, region_id, line_no, depth."""
    a = depths.filter("depth is not null")
    b = a.select("frame_id", F.col("region_id").alias("other"), F.col("line_no").alias("line2"), F.col("depth").alias("depth2"))
    nearer = (F.col("depth") < F.col("depth2")) if polarity == "reference" else (F.col("depth") > F.col("depth2"))
    pair = a.join(b.hint("merge"), "frame_id").filter("line_no < line2 and depth <> depth2")
    front = pair.select("frame_id", F.when(nearer, F.col("region_id")).otherwise(F.col("other")).alias("f"), F.when(nearer, F.col("other")).otherwise(F.col("region_id")).alias("b"))
    e = F.explode(F.array(F.struct(F.col("f").alias("source_id"), F.col("b").alias("target_id"), F.lit("foreground_relative_to").alias("type")), F.struct(F.col("b").alias("source_id"), F.col("f").alias("target_id"), F.lit("background_relative_to").alias("type"))))
    return front.select("frame_id", e.alias("e")).select("frame_id", "e.*")


def number(edges: DataFrame, width: int = 6) -> DataFrame:
    """Number all edges from 1 by builder and order, and make their ids; no task holds all edges."""
    out = with_line_numbers(edges, ["builder", "ord", "type", "source_id", "target_id"]).withColumnRenamed("line_no", "seq")
    return out.select(F.concat("prefix", F.lpad(F.col("seq").cast("string"), width, "0")).alias("id"), "seq", "type", "source_id", "target_id", "start_us", "end_us", "confidence")
