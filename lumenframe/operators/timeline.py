"""Colour summaries, scenes and the timeline."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.color import BUCKETS
from ..functions.geometry import box_iou, cosine_similarity

#: Scene thresholds.
L1_CHANGE, DOMINANT_JUMP, DIVERSITY_CHANGE, DIVERSITY_COVERAGE = 0.5, 0.35, 2, 0.05
#: More than the rounding of a sum of a few dozen shares, and less than the least step of a distance between shares of up
#: to 7 million samples (1 / (2 n m)): a distance of just L1_CHANGE is no change, in whatever order it is summed.
L1_ROUNDING = 1e-14
NEUTRAL = ("gray", "black", "white")


def summarize_samples(samples: DataFrame, key: list[str], bucket: str = "bucket", buckets: tuple[str, ...] = BUCKETS) -> DataFrame:
    """(key, bucket_coverage, coverage_total, dominant_bucket, sampled): each bucket's share of a target's samples, with
    all registered buckets; the first by name dominates on ties."""
    n = samples.groupBy(*key, bucket).agg(F.count("*").alias("n"))
    total = n.groupBy(*key).agg(
        F.sum("n").alias("sampled"), F.map_from_entries(F.collect_list(F.struct(bucket, "n"))).alias("counts"), F.min_by(bucket, F.struct(-F.col("n"), F.col(bucket))).alias("dominant_bucket")
    )
    names = F.array(*[F.lit(b) for b in buckets])
    share = F.map_from_arrays(names, F.transform(names, lambda b: F.coalesce(F.try_element_at("counts", b), F.lit(0)) / F.col("sampled")))
    out = total.withColumn("bucket_coverage", share)
    return out.withColumn("coverage_total", F.aggregate(F.map_values("bucket_coverage"), F.lit(0.0), lambda s, x: s + x)).drop("counts")


def scene_boundaries(frames: DataFrame, key: list[str], order: str, coverage: str = "bucket_coverage", buckets: tuple[str, ...] = BUCKETS) -> DataFrame:
    """Add dominant and boundary: does a scene begin at this frame, by dominant bucket, distribution, its share or diversity?"""
    w = Window.partitionBy(*key).orderBy(order)
    get = lambda m, b: F.coalesce(F.try_element_at(m, F.lit(b)), F.lit(0.0))
    cov = F.col(coverage)
    values = F.array(*[F.struct((-get(cov, b)).alias("m"), F.lit(b).alias("b")) for b in sorted(buckets)])
    diverse = sum((F.when(get(cov, b) >= DIVERSITY_COVERAGE, 1).otherwise(0) for b in buckets if b not in NEUTRAL), F.lit(0))
    df = frames.withColumn("dominant", F.array_min(values)["b"]).withColumn("_div", diverse)
    before = F.lag(coverage).over(w)
    df = df.withColumn("_c", before).withColumn("_d", F.lag("dominant").over(w)).withColumn("_v", F.lag("_div").over(w))
    l1 = sum((F.abs(get(cov, b) - get(F.col("_c"), b)) for b in buckets), F.lit(0.0))
    jump = F.abs(F.coalesce(F.try_element_at(cov, F.col("_d")), F.lit(0.0)) - F.coalesce(F.try_element_at(F.col("_c"), F.col("_d")), F.lit(0.0)))
    change = (F.col("dominant") != F.col("_d")) | (l1 - L1_CHANGE > L1_ROUNDING) | (jump > DOMINANT_JUMP) | (F.abs(F.col("_div") - F.col("_v")) >= DIVERSITY_CHANGE)
    return df.withColumn("boundary", F.col("_c").isNull() | change).drop("_c", "_d", "_v", "_div")


def merge_short(sizes: list[int], least: int) -> list[int]:
    """Run number of each segment after short ones joined the one before (the first, if short, the one after)."""
    out, total = [], []
    for n in sizes:
        if least > 1 and n < least and total:
            total[-1] += n
        else:
            total.append(n)
        out.append(len(total) - 1)
    if least > 1 and len(total) > 1 and total[0] < least:
        out = [max(0, i - 1) for i in out]
    return out


def scenes(frames: DataFrame, key: str, order: str, at: str, least: int = 1, **options) -> DataFrame:
    """(key, scene, start_us, end_us, frames, dominant): runs between boundaries, short ones merged by an ordered fold."""
    b = scene_boundaries(frames, [key], order, **options)
    run = F.sum(F.col("boundary").cast("int")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    runs = b.withColumn("run", run).groupBy(key, "run").agg(F.min(at).alias("start_us"), F.max(at).alias("end_us"), F.count("*").alias("frames"), F.min_by("dominant", order).alias("dominant"))
    kind = frames.schema[key].dataType.simpleString()

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("run")
        return pd.DataFrame({key: p[key], "run": p["run"], "scene": merge_short(p["frames"].tolist(), least)})

    joined = runs.join(runs.groupBy(key).applyInPandas(fold, f"{key} {kind}, run long, scene int"), [key, "run"])
    return joined.groupBy(key, "scene").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("frames").alias("frames"), F.min_by("dominant", "run").alias("dominant"))


def shot_spans(shots: DataFrame, durations: DataFrame, key: list[str], order: str = "shot_no", first: str = "first_us", last: str = "last_us") -> DataFrame:
    """shots (key, shot_no, times of the first and last frame) with from_us and to_us: shots meet halfway between one's last
    and the next one's first frame, the first begins at 0 and the last ends with the recording (key, duration_us).

    Borders never run backwards; they lie a microsecond apart where the recording is long enough for that."""
    w = Window.partitionBy(*key).orderBy(order)
    all_ = Window.partitionBy(*key)
    n, i = F.count("*").over(all_), F.row_number().over(w)
    df = shots.join(durations.select(*key, F.col("duration_us").cast("long").alias("_d")), key).withColumn("_i", i).withColumn("_n", n)
    df = df.withColumn("_step", F.when(F.col("_d") >= F.col("_n"), 1).otherwise(0))
    # Borders by their number: 0 before the first shot, then one at the end of each.
    df = df.withColumn("_q", F.lead(first).over(w))
    df = df.withColumn("_b", F.when(F.col("_i") == F.col("_n"), F.col("_d")).otherwise(F.expr(f"div({last} + _q, 2)")))
    number = F.col("_i") * F.col("_step")
    # Each border at least a step after all before it (and after border 0, at 0) ...
    df = df.withColumn("_b", number + F.greatest(F.lit(0), F.max(F.col("_b") - number).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    # ... and, counted back from the end of the recording, at least a step before all after it.
    df = df.withColumn("_b", F.when(F.col("_i") == F.col("_n"), F.col("_d")).otherwise(F.col("_b")))
    df = df.withColumn("to_us", number + F.min(F.col("_b") - number).over(w.rowsBetween(0, Window.unboundedFollowing)))
    zero = F.least(F.lit(0), F.min(F.col("_b") - number).over(all_))
    return df.withColumn("from_us", F.coalesce(F.lag("to_us").over(w), zero)).drop("_d", "_i", "_n", "_step", "_q", "_b")


def scene_spans(scenes: DataFrame, shots: DataFrame, key: list[str]) -> DataFrame:
    """scenes (key, scene_id, start_us, end_us, frame_ids) with shot_ids, from_us and to_us: a scene has the shots (key,
    shot_no, shot_id, frame_ids, from_us, to_us) that share a frame with it, in order, and reaches from the first one's
    beginning to the last one's end; without a shot it keeps its own times."""
    s = scenes.select(*key, "scene_id", F.explode("frame_ids").alias("_f"))
    t = shots.select(*key, "shot_no", "shot_id", "from_us", "to_us", F.explode("frame_ids").alias("_f"))
    own = s.join(t, [*key, "_f"]).select(*key, "scene_id", F.struct("shot_no", "shot_id", "from_us", "to_us").alias("_s")).distinct()
    of = own.groupBy(*key, "scene_id").agg(F.sort_array(F.collect_list("_s")).alias("_s"))
    ends = scenes.join(of, [*key, "scene_id"], "left")
    first, last = F.get("_s", F.lit(0))["from_us"], F.try_element_at("_s", F.lit(-1))["to_us"]
    ids = F.coalesce(F.transform("_s", lambda x: x["shot_id"]), F.array().cast("array<string>"))
    return ends.withColumn("shot_ids", ids).withColumn("from_us", F.coalesce(first, "start_us")).withColumn("to_us", F.coalesce(last, "end_us")).drop("_s")


def color_targets(frames: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """(key, target_type, target_id, start_us, end_us, frame_ids, sampling_basis, part, place): what colours are observed of.

    Every frame (key, frame_id, at_us, keyframe) is a target by itself, in order of id; then come scenes and then shots
    (key, target_type, target_no, target_id, start_us, end_us, frame_ids), each sampled on its keyframes, or on all of its
    frames where none is one. A frame that a range names but that does not exist is an error to be found by
    `missing_frames`, and is not sampled."""
    one = frames.select(
        *key, F.lit("frame").alias("target_type"), F.col("frame_id").alias("target_id"), F.col("at_us").alias("start_us"), F.col("at_us").alias("end_us"),
        F.array("frame_id").alias("frame_ids"), F.lit("full_frame").alias("sampling_basis"), F.lit(0).alias("part"), F.struct(F.lit(0).cast("long").alias("n"), F.col("frame_id").alias("id")).alias("place"),
    )
    named = ranges.select(*key, "target_type", "target_no", "target_id", "start_us", "end_us", F.posexplode("frame_ids").alias("_p", "frame_id")).join(frames.select(*key, "frame_id", "keyframe"), [*key, "frame_id"])
    seen = named.groupBy(*key, "target_type", "target_no", "target_id", "start_us", "end_us").agg(F.sort_array(F.collect_list(F.struct("_p", "frame_id", "keyframe"))).alias("_f"))
    of = lambda fs: F.transform(fs, lambda f: f["frame_id"])
    marked = of(F.filter("_f", lambda f: f["keyframe"]))
    many = seen.select(
        *key, "target_type", "target_id", "start_us", "end_us", F.when(F.size(marked) > 0, marked).otherwise(of(F.col("_f"))).alias("frame_ids"), F.lit("keyframe_full_frame").alias("sampling_basis"),
        F.when(F.col("target_type") == "scene", 1).otherwise(2).alias("part"), F.struct(F.col("target_no").cast("long").alias("n"), F.col("target_id").alias("id")).alias("place"),
    )
    return one.unionByName(many)


def missing_frames(frames: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """(key, target_type, target_id, frame_id): frames that ranges name and that do not exist."""
    return ranges.select(*key, "target_type", "target_id", F.explode("frame_ids").alias("frame_id")).join(frames.select(*key, "frame_id"), [*key, "frame_id"], "left_anti").select(*key, "target_type", "target_id", "frame_id").distinct()


def color_records(targets: DataFrame, pixels: DataFrame, key: list[str], buckets: tuple[str, ...] = BUCKETS) -> DataFrame:
    """targets with color_observation_id, bucket_coverage, dominant_bucket and coverage_total from the pixels' buckets (key,
    frame_id, bucket, n) of all their sampled frames; numbered per key in the order of the targets. Targets without pixels
    are left out."""
    each = targets.select(*key, "target_type", "target_id", F.explode("frame_ids").alias("frame_id")).join(pixels, [*key, "frame_id"])
    n = each.groupBy(*key, "target_type", "target_id", "bucket").agg(F.sum("n").alias("n"))
    of = n.groupBy(*key, "target_type", "target_id").agg(
        F.sum("n").alias("_all"), F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("_n"), F.min_by("bucket", F.struct(-F.col("n"), F.col("bucket"))).alias("dominant_bucket")
    ).filter("_all > 0")
    names = F.array(*[F.lit(b) for b in buckets])
    share = F.map_from_arrays(names, F.transform(names, lambda b: F.coalesce(F.try_element_at("_n", b), F.lit(0)) / F.col("_all")))
    out = targets.join(of, [*key, "target_type", "target_id"]).withColumn("bucket_coverage", share)
    out = out.withColumn("coverage_total", F.aggregate(F.map_values("bucket_coverage"), F.lit(0.0), lambda s, x: s + x))
    number = F.row_number().over(Window.partitionBy(*key).orderBy("part", "place"))
    return out.withColumn("color_observation_id", F.format_string("color_obs_%06d", number)).drop("_all", "_n", "part", "place")


#: The sampling of a recording's pictures, in microseconds and samples.
SAMPLE_GAP_US, SAMPLE_MARGIN_US, SAMPLE_TARGET, SAMPLE_LEAST = 1_000_000, 100_000, 600, 3


def sampling_grid(streams: DataFrame, duration: str, gap: int = SAMPLE_GAP_US, margin: int = SAMPLE_MARGIN_US, target: int = SAMPLE_TARGET, least: int = SAMPLE_LEAST) -> DataFrame:
    """Add at_us: 0 and every `gap` up to `margin` before the end, and that last moment itself.

    The gap grows where more than about `target` samples would fit; where there are fewer than `least`, as many moments in
    the middles of equal cells are taken instead. Streams without a duration have none; a stream no longer than the margin
    is sampled up to its end."""
    d = F.col(duration).cast("long")
    end = F.when(d > margin, d - margin).otherwise(d)
    step = F.greatest(F.lit(gap).cast("long"), F.expr("div(_end, {})".format(target))) if target > 0 else F.lit(gap).cast("long")
    times = F.concat(F.sequence(F.lit(0).cast("long"), F.col("_end") - 1, step), F.array(F.col("_end")))
    cells = F.transform(F.sequence(F.lit(0), F.lit(max(0, least - 1))), lambda i: F.floor(F.col("_end") * (2 * i + 1) / F.lit(2 * max(1, least))).cast("long"))
    return (
        streams.filter(d > 0).withColumn("_end", end).withColumn("_t", times)
        .withColumn("at_us", F.explode(F.array_distinct(F.when(F.size("_t") < least, cells).otherwise(F.col("_t"))))).drop("_end", "_t")
    )


#: Mean differences of neighbouring pictures. A cut settles at once, is hard, or begins a lasting transition.
CUT, SETTLED, HARD, LASTING, LASTING_FRAMES = 0.08, 0.05, 0.30, 0.12, 3


def visual_cuts(frames: DataFrame, key: list[str], order: str, diff: str) -> DataFrame:
    """Add transition and cut for frames with their difference from the one before (null for the first).

    transition: the first of at least LASTING_FRAMES differences in a row of LASTING or more. cut: a transition, a
    difference of HARD or more, or one of CUT or more whose next is at most SETTLED (the last frame has no next)."""
    w = Window.partitionBy(*key).orderBy(order)
    d = F.col(diff)
    row = F.lit(True)
    for i in range(LASTING_FRAMES):
        row = row & F.coalesce(F.lead(diff, i).over(w) >= LASTING, F.lit(False))
    begins = row & (F.coalesce(F.lag(diff).over(w), F.lit(0.0)) < LASTING)
    settles = (d >= CUT) & (F.coalesce(F.lead(diff).over(w), F.lit(1.0)) <= SETTLED)
    return frames.withColumn("transition", begins).withColumn("cut", F.coalesce(settles | (d >= HARD), F.lit(False)) | F.col("transition"))


#: When a track is taken for an earlier one that comes again.
ALIKE, ALIKE_BOTH_WAYS, SAME_AREA, CONSENSUS, FRAGMENT_GAP_US = 0.90, 0.85, 0.60, 2, 1_000_000
GROUP_GAP_US, GROUP_IOU = 1_000_000, 0.50


def overlap_scores(pairs: DataFrame, regions: DataFrame) -> DataFrame:
    """pairs (before, after, overlap_start_us) with overlap: at each region of `after` from overlap_start_us on, the best
    IoU with a region of `before` of the same time; their mean where positive, 0 if none is.

    regions: track, region_no, at_us, box."""
    y = regions.select(F.col("track").alias("after"), "region_no", "at_us", F.col("box").alias("box_y"))
    x = regions.select(F.col("track").alias("before"), "at_us", F.col("box").alias("box_x"))
    hit = pairs.join(y, "after").filter("at_us >= overlap_start_us").join(x, ["before", "at_us"]).withColumn("iou", box_iou(F.col("box_x"), F.col("box_y")))
    best = hit.groupBy("before", "after", "overlap_start_us", "region_no").agg(F.max("iou").alias("iou")).filter("iou > 0")
    mean = best.groupBy("before", "after", "overlap_start_us").agg(F.avg("iou").alias("overlap"))
    return pairs.join(mean, ["before", "after", "overlap_start_us"], "left").fillna(0.0, ["overlap"])


def appearance_scores(pairs: DataFrame, regions: DataFrame, k: int = CONSENSUS) -> DataFrame:
    """pairs (before, after) with appearance: over the regions of `after`, the greatest k-th best cosine with those of
    `before`; -1 where no region of `after` has k to compare with.

    regions: track, region_no, source, category (negative: unknown), embedding. Only regions that a detector found and that
    have an embedding count; of two known categories only equal ones are compared."""
    found = regions.filter(F.col("source").contains("detector") & (F.size("embedding") > 0))
    y = found.select(F.col("track").alias("after"), F.col("region_no").alias("y_no"), F.col("category").alias("y_cat"), F.col("embedding").alias("e_y"))
    x = found.select(F.col("track").alias("before"), F.col("region_no").alias("x_no"), F.col("category").alias("x_cat"), F.col("embedding").alias("e_x"))
    both = pairs.select("before", "after").distinct().join(y, "after").join(x, "before").filter("x_cat < 0 or y_cat < 0 or x_cat = y_cat")
    both = both.withColumn("cos", F.coalesce(F.when(F.size("e_x") == F.size("e_y"), cosine_similarity(F.col("e_x"), F.col("e_y"))), F.lit(-1.0)))
    rank = F.row_number().over(Window.partitionBy("before", "after", "y_no").orderBy(F.desc("cos"), "x_no"))
    kth = both.withColumn("_n", rank).filter(F.col("_n") == k).groupBy("before", "after").agg(F.max("cos").alias("appearance"))
    return pairs.join(kth, ["before", "after"], "left").fillna(-1.0, ["appearance"])


def identity_scores(pairs: DataFrame, regions: DataFrame) -> DataFrame:
    """pairs (before, after, overlap_start_us) with overlap, reacquired and group: scores by which `after` is taken for
    `before`; -1 where a rule does not hold.

    reacquired: the appearance, where mean areas are alike by SAME_AREA. It must reach ALIKE; with a gap of FRAGMENT_GAP_US
    or more between the tracks, the lesser of the appearances in both directions must reach ALIKE_BOTH_WAYS instead. group:
    the IoU of the last box before and the first one after, of tracks of motion groups only, at most GROUP_GAP_US
    apart, from GROUP_IOU on. regions: track, region_no, at_us, box, area, source, category, embedding."""
    at = F.struct("at_us", "region_no")
    ends = regions.groupBy("track").agg(
        F.avg("area").alias("area"), F.min("at_us").alias("first_us"), F.max("at_us").alias("last_us"), F.min_by("box", at).alias("first_box"), F.max_by("box", at).alias("last_box"),
        F.every(F.coalesce(F.col("source") == "motion_group", F.lit(False))).alias("moving"),
    )
    side = lambda name: ends.select(F.col("track").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ends.columns if c != "track"])
    flipped = appearance_scores(pairs.select(F.col("after").alias("before"), F.col("before").alias("after")).distinct(), regions)
    flipped = flipped.select(F.col("after").alias("before"), F.col("before").alias("after"), F.col("appearance").alias("back"))
    p = appearance_scores(overlap_scores(pairs, regions), regions).join(flipped, ["before", "after"]).join(side("before"), "before").join(side("after"), "after")
    gap = F.col("after_first_us") - F.col("before_last_us")
    larger = F.greatest("before_area", "after_area")
    same_area = F.when(larger > 0, F.least("before_area", "after_area") / larger).otherwise(0.0) >= SAME_AREA
    least = F.least("appearance", "back")
    again = F.when(~same_area, -1.0).when(F.col("appearance") >= ALIKE, F.col("appearance")).when((gap >= FRAGMENT_GAP_US) & (least >= ALIKE_BOTH_WAYS), least).otherwise(-1.0)
    iou = box_iou(F.col("before_last_box"), F.col("after_first_box"))
    group = F.when(F.col("before_moving") & F.col("after_moving") & (gap > 0) & (gap <= GROUP_GAP_US) & (iou >= GROUP_IOU), iou).otherwise(-1.0)
    return p.select("before", "after", "overlap_start_us", "overlap", again.alias("reacquired"), group.alias("group"))


def rewrite_frames(catalog: DataFrame, existing: DataFrame, key: str = "frame_id") -> DataFrame:
    """Frames of the catalog with the fields that existing rows add."""
    extra = [c for c in existing.columns if c not in catalog.columns]
    return catalog.join(existing.select(key, *extra).dropDuplicates([key]), key, "left")


def associate(frames: pd.DataFrame, iou_at_least: float = 0.3, most_lost: int = 5) -> pd.DataFrame:
    """Greedy tracks over (frame, box): best overlap first, one region for a track in a frame; lost ones age and end."""

    def iou(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        if w <= 0 or h <= 0:
            return 0.0
        area = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
        return w * h / area if area > 0 else 0.0

    live: dict[int, tuple] = {}
    lost: dict[int, int] = {}
    rows, fresh = [], 0
    for frame, group in frames.sort_values(["frame", "region"]).groupby("frame", sort=True):
        used = set()
        for r in group.itertuples():
            scored = sorted(((-iou(live[t], r.box), t) for t in live if t not in used))
            if scored and -scored[0][0] >= iou_at_least:
                t = scored[0][1]
            else:
                t, fresh = fresh, fresh + 1
            used.add(t)
            live[t], lost[t] = r.box, 0
            rows.append((frame, r.region, t))
        for t in [t for t in live if t not in used]:
            lost[t] += 1
            if lost[t] > most_lost:
                del live[t]
    return pd.DataFrame(rows, columns=["frame", "region", "track"])


def track_entities(regions: DataFrame, key: str = "package_id") -> DataFrame:
    """(key, frame, region, track) by association in frame order, a package a group."""
    kind = regions.schema[key].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = associate(pdf[["frame", "region", "box"]])
        out.insert(0, key, pdf[key].iloc[0])
        return out

    return regions.groupBy(key).applyInPandas(one, f"{key} {kind}, frame long, region string, track int")


def depth_under_mask(depth: np.ndarray, mask: np.ndarray) -> float | None:
    return float(depth[mask].mean()) if mask.shape == depth.shape and mask.any() else None


def coverage_share(cov: Column, bucket: Column) -> Column:
    return F.coalesce(F.try_element_at(cov, bucket), F.lit(0.0))
