"""Whole captures: from members to clouds, structure, openings, drift arms, results and batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.config import PROFILES, Drift, Intervals, Reconstruction, Structure
from voxelyard.operators import capabilities, drift, frames, grid, intervals, openings, planes, polygon, project, resample, validate
from voxelyard.operators.cut import cut, store
from voxelyard.sources import capture as cap

KEY = ["capture_id"]


def batch_status(rows: DataFrame, by: list[str], succeeded: str = "succeeded") -> DataFrame:
    """Per batch: counts and ok, partial or failed."""
    s = rows.groupBy(*by).agg(F.count("*").alias("n_captures"), F.count_if(F.col(succeeded)).alias("succeeded"), F.count_if(~F.col(succeeded)).alias("failed"))
    return s.withColumn("status", F.when(F.col("failed") == 0, "ok").when(F.col("succeeded") == 0, "failed").otherwise("partial"))


def ordered_distinct(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Per group: the distinct values in the order of their first place (warnings)."""
    first = rows.groupBy(*by, value).agg(F.min(order).alias("vy_at"))
    return first.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("vy_at", F.col(value).alias("v")))), lambda s: s["v"]).alias("warnings"))


@dataclass
class Reconstructed:
    points: DataFrame  # capture_id, frame_id, x, y, z: before fusion
    cloud: DataFrame  # capture_id, x, y, z: fused
    poses: DataFrame
    counts: DataFrame  # capture_id, sampled, valid, frames, skipped
    frames: DataFrame  # capture_id, frame_id, sampled, valid, problem (why the frame was skipped, or null)


def reconstruct(
    members: DataFrame, config: Reconstruction = PROFILES["fast"], evenly: bool = True, only: DataFrame | None = None, offsets: DataFrame | None = None,
    indexed: validate.Index | None = None,
) -> Reconstructed:
    """All captures of members at once; `only` keeps the captures it lists (the valid ones). indexed: the
    index of members, where there is one already."""
    at_hand = indexed or validate.index(members)
    poses, depth, conf = at_hand.poses.where("problem is null"), at_hand.depth, at_hand.confidence
    if only is not None:
        poses = poses.join(only.select("capture_id"), "capture_id", "left_semi")  # without poses no frame matches
    matched = frames.match_frames(depth.where("code is null"), conf.where("code is null"), poses)
    pick = frames.keyframes if evenly else frames.contiguous
    wanted = cut(pick(matched, config.maximum_frames))
    decoded = cap.pixels(members, depth, conf, wanted, config.pixel_stride)
    pixels = decoded.where("problem is null")
    cam = at_hand.camera.where("valid").select("capture_id", *[F.col(c).alias(f"k{c}") for c in ("fx", "fy", "cx", "cy")])
    if offsets is not None:
        poses = project.offset_poses(poses, offsets, ["capture_id", "frame_id"])
    posed = project.with_rotation(poses.join(cam, "capture_id"))
    kept = pixels.withColumn("depth_m", project.depth_metres("depth_mm")).where(project.depth_gate("depth_m", "confidence", config))
    met = kept.join(posed.drop("fx", "fy", "cx", "cy"), ["capture_id", "frame_id"])
    # the camera matrix is for the colour image; each capture may have depth images of a size of its own
    sx, sy = F.col("width") / config.intrinsics_width, F.col("height") / config.intrinsics_height
    met = met.withColumns({"fx": F.col("kfx") * sx, "fy": F.col("kfy") * sy, "cx": F.col("kcx") * sx, "cy": F.col("kcy") * sy})
    points = project.to_world(project.backproject(met)).select("capture_id", "frame_id", "x", "y", "z")
    fused = project.voxel_fuse(points, config.voxel_size_m).select("capture_id", *[F.col(c).cast("float").alias(c) for c in "xyz"], "n_points")
    per_frame = decoded.withColumn("z", project.depth_metres("depth_mm")).groupBy("capture_id", "frame_id").agg(
        F.count("u").alias("sampled"), F.count_if(project.depth_gate("z", "confidence", config)).alias("valid"), F.max("problem").alias("problem")
    )
    asked = cut(wanted.select("capture_id", "frame_id").join(per_frame, ["capture_id", "frame_id"], "left").select(
        "capture_id", "frame_id", F.coalesce("sampled", F.lit(0)).alias("sampled"), F.coalesce("valid", F.lit(0)).alias("valid"),
        F.coalesce("problem", F.when(F.col("sampled").isNull(), "the images of the frame are missing").when(F.col("valid") == 0, "no pixel passes the depth gate")).alias("problem"),
    ))
    counts = asked.groupBy("capture_id").agg(
        F.sum("sampled").alias("sampled"), F.sum("valid").alias("valid"), F.count("*").alias("frames"), F.count("problem").alias("skipped")
    )
    return Reconstructed(points, fused, poses, counts, asked)


@dataclass
class Measured:
    floors: DataFrame
    ceilings: DataFrame
    outlines: DataFrame
    walls: DataFrame
    openings: DataFrame
    rejections: DataFrame
    warnings: DataFrame
    opening_status: DataFrame
    adjacency: DataFrame
    laid: DataFrame  # capture_id, fx, fy, h: the cloud on the floor
    ground: DataFrame  # capture_id, x, y: the points of the floor
    ceiling_heights: DataFrame  # capture_id, height: the points of the ceiling
    cells: DataFrame  # the trimmed cells of the floor


def measure(cloud: DataFrame, trajectory: DataFrame, config: Structure = Structure()) -> Measured:
    """Structure of each capture's cloud (capture_id, x, y, z). trajectory: capture_id, y."""
    points = cut(cloud.select("capture_id", *[F.col(c).cast("double").alias(c) for c in "xyz"]))
    floors = cut(planes.detect_floor(points, trajectory, KEY, config))
    near = points.join(floors.select("capture_id", *[F.col(c).alias(f"f{c}") for c in ("nx", "ny", "nz", "d")]), KEY)
    on = F.abs(F.col("fnx") * F.col("x") + F.col("fny") * F.col("y") + F.col("fnz") * F.col("z") + F.col("fd")) <= config.plane_inlier_m
    origin = near.where(on).groupBy(*KEY).agg(*[F.avg(c).alias(f"o{c}") for c in "xyz"])
    framed = planes.floor_frame(floors.select("capture_id", "nx", "ny", "nz", "d")).join(origin, KEY)
    laid = cut(planes.on_floor(points, framed, KEY).select("capture_id", "fx", "fy", "h"))
    ground = laid.where(F.abs("h") <= config.plane_inlier_m).select("capture_id", F.col("fx").alias("x"), F.col("fy").alias("y"))
    cells = cut(grid.trimmed_centres(ground, config.grid_size_m, KEY, config.trim_percentile))
    outline = cut(polygon.outlines(cells, KEY, config))
    ceilings = cut(planes.detect_ceiling(points, floors, KEY, config))
    found = planes.detect_walls(laid.select("capture_id", F.col("fx").alias("x"), F.col("fy").alias("z"), "h"), KEY, config)
    walls = cut(openings.wall_ids(found, KEY, "nx", "nz").withColumnRenamed("nz", "ny"))
    seen = openings.study(laid, walls, cells, ceilings, KEY, config)
    above = points.join(ceilings.select("capture_id", *[F.col(c).alias(f"c{c}") for c in ("nx", "ny", "nz", "d")]), KEY).where(
        F.abs(F.col("cnx") * F.col("x") + F.col("cny") * F.col("y") + F.col("cnz") * F.col("z") + F.col("cd")) <= config.plane_inlier_m
    )
    heights = planes.on_floor(above.select("capture_id", "x", "y", "z"), framed, KEY).select("capture_id", F.col("h").alias("height"))
    return Measured(
        floors, ceilings, outline, walls, seen.openings, seen.rejections, structure_warnings(floors, ceilings, outline, walls, config, seen), seen.status, seen.adjacency,
        laid, ground, heights, cells,
    )


def intervals_of(m: Measured, config: Intervals = Intervals(), structure: Structure = Structure()) -> tuple[DataFrame, DataFrame]:
    """(intervals, notes) of what measure gives, by resampling its points with the planes held fixed."""
    plan = cut(resample.outline_interval(m.ground, KEY, ["x", "y"], config, structure))
    floor = m.laid.where(F.abs("h") <= structure.plane_inlier_m).select("capture_id", F.col("h").alias("height"))
    ceiling = cut(resample.ceiling_interval(floor, m.ceiling_heights, KEY, ["height"], config))
    opened = m.openings.select("capture_id").distinct()
    if opened.isEmpty():
        widths = m.openings.select("capture_id", "opening_id", F.col("width_m").alias("value"), *[F.lit(None).cast("double").alias(c) for c in ("low", "high")], F.lit(0).cast("long").alias("n_samples"))
    else:  # captures without an opening have nothing to resample
        some = [df.join(opened, KEY, "left_semi") for df in (m.laid, m.walls, m.cells, m.ceilings)]
        widths = cut(intervals.width_intervals(intervals.opening_widths(*some, KEY, config, structure), m.openings, KEY, config))
    return intervals.assemble(m.outlines, plan, m.ceilings, ceiling, m.openings, widths, m.floors.select("capture_id"), KEY, config)


def structure_warnings(
    floors: DataFrame, ceilings: DataFrame, outline: DataFrame, walls: DataFrame, config: Structure = Structure(), seen: openings.Studied | None = None
) -> DataFrame:
    """Per capture: warnings, an array of the messages whose conditions hold, in order."""
    n_walls = walls.groupBy(*KEY).agg(F.count("*").alias("n_walls"))
    met = floors.join(ceilings.select("capture_id", "ceiling_height"), KEY, "left").join(outline, KEY, "left").join(n_walls, KEY, "left")
    none = F.lit(None).cast("string")
    if seen is None:
        met = met.withColumns({"unseen": none, "n_openings": F.lit(0), "n_adjacent": F.lit(0)})
    else:
        joined = seen.adjacency.groupBy(*KEY).agg(F.count("*").alias("n_adjacent"))
        met = met.join(seen.status.select("capture_id", F.col("reason").alias("unseen"), "n_openings"), KEY, "left").join(joined, KEY, "left")
    c = F.col
    messages = F.array(
        F.when(c("ceiling_height").isNull(), "no ceiling was found; heights are unavailable"),
        F.when(c("method") == "convex_hull", F.concat(F.lit("the outline is a convex hull: "), F.coalesce("reason", F.lit("")))),
        F.when(c("method").isNull(), F.concat(F.lit("no outline: "), F.coalesce("reason", F.lit("")))),
        F.when(c("support") < 0.60, "the outline holds little scanned floor"),
        F.when(c("rmse_m") > 0.03, "the floor fits its plane loosely"),
        F.when(c("inlier_ratio") < 0.05, "few points lie on the floor"),
        F.when(c("area_m2") > 200, "the area is larger than a room's"),
        F.when(c("length_m") > 20, "a dimension is larger than a room's"),
        F.when(c("sprawl") > config.sprawl_ratio, "the outline is long for its area"),
        F.when(F.coalesce("n_walls", F.lit(0)) == 0, "no wall was found").when(F.col("n_walls") < 2, "fewer than two walls were found"),
        F.when(c("unseen").isNotNull(), F.concat(F.lit("openings are unavailable: "), "unseen")),
        F.when(F.coalesce("n_openings", F.lit(0)) > 0, "opening widths are estimates from the scan and not judged against truth"),
        F.when(F.coalesce("n_adjacent", F.lit(0)) > 0, "regions that an opening joins are scanned floor, not rooms with names"),
    )
    return met.select("capture_id", F.filter(messages, lambda m: m.isNotNull()).alias("warnings"))


def results(members: DataFrame, profile: str = "fast", structure: Structure = Structure(), resampling: Intervals | None = Intervals()) -> dict[str, DataFrame]:
    """Every published table of a batch of captures, keyed by capture_id. A capture that fails has a
    status and its issues, and doesn't touch the others; a frame that fails is an issue of its capture
    and left out. resampling None: no intervals, and a note that says so."""
    members = store(members)  # archives are unpacked once
    at_hand = validate.index(members)
    issues, summary = validate.validate(members, at_hand)
    good = summary.where("valid").select("capture_id")
    got = reconstruct(members, PROFILES[profile], only=good, indexed=at_hand)
    got.cloud = cut(got.cloud)
    measured = measure(got.cloud, got.poses.select("capture_id", F.col("ty").alias("y")), structure)
    path = frames.trajectory(got.poses, KEY, ["frame_no"], ("tx", "ty", "tz"))
    extent = project.bounds(got.cloud, KEY)
    status = summary.select("capture_id", "valid", "n_matched", "errors", "warnings").join(measured.floors.select("capture_id", F.lit(True).alias("measured")), KEY, "left")
    status = status.withColumn("succeeded", F.coalesce("measured", F.lit(False)))
    points = got.cloud.groupBy(*KEY).agg(F.count("*").alias("points"))
    quality = quality_metrics(got.counts, measured.floors, measured.outlines, measured.warnings, points, measured.ceilings, measured.walls, path)
    if resampling is None:
        spans, notes = None, measured.floors.select("capture_id", F.lit("intervals were not asked for").alias("message"))
    else:
        spans, notes = intervals_of(measured, resampling, structure)
    claims = capabilities.capabilities(summary.select("capture_id"), measured.ceilings, measured.opening_status, measured.adjacency, KEY)
    skipped = got.frames.where("problem is not null").select(
        "capture_id", F.lit("warning").alias("severity"), F.lit("frame_skipped").alias("code"), F.concat(F.lit("frame "), "frame_id", F.lit(": "), "problem").alias("message")
    )
    issues = issues.unionByName(skipped)
    return {
        "status": status, "issues": issues, "frames": got.frames, "cloud": got.cloud, "bounds": extent, "trajectory": path, "counts": got.counts, "floors": measured.floors,
        "ceilings": measured.ceilings, "outlines": measured.outlines, "walls": measured.walls, "openings": measured.openings,
        "rejections": measured.rejections, "warnings": measured.warnings, "quality": quality, "hashes": cap.capture_hashes(members),
        "opening_status": measured.opening_status, "adjacency": measured.adjacency, "capabilities": claims, "interval_notes": notes,
    } | ({} if spans is None else {"intervals": spans})


def quality_metrics(
    counts: DataFrame, floors: DataFrame, outline: DataFrame, warnings: DataFrame, points: DataFrame, ceilings: DataFrame, walls: DataFrame, path: DataFrame,
    least_support: float = 0.60,
) -> DataFrame:
    """Per capture: ratios clipped to 0 .. 1, the floor's fit and its agreement with the world's up, the number
    of walls, whether there is a ceiling, the distance between the path's ends, and confidence: caution where
    a warning stands or the outline holds little floor, else good. points: capture_id, points (fused)."""
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    n_walls = walls.groupBy(*KEY).agg(F.count("*").alias("n_walls"))
    roof = ceilings.select("capture_id").distinct().withColumn("roof", F.lit(True))
    met = counts.join(floors.select("capture_id", "inlier_ratio", "rmse_m", "ny"), KEY, "left").join(outline.select("capture_id", "support"), KEY, "left").join(warnings, KEY, "left")
    met = met.join(points, KEY, "left").join(n_walls, KEY, "left").join(roof, KEY, "left").join(path.select("capture_id", "end_distance_m"), KEY, "left")
    doubt = (F.coalesce(F.size("warnings"), F.lit(0)) > 0) | (F.coalesce("support", F.lit(0.0)) < least_support)
    return met.select(
        "capture_id", clip(F.col("valid") / F.greatest("sampled", F.lit(1))).alias("valid_depth_ratio"),
        clip(F.coalesce("points", F.lit(0)) / F.greatest("valid", F.lit(1))).alias("voxel_retention_ratio"), clip(F.col("inlier_ratio")).alias("floor_inlier_ratio"),
        "rmse_m", F.least(F.lit(1.0), F.abs("ny")).alias("up_alignment"), F.coalesce("n_walls", F.lit(0)).alias("n_walls"), F.coalesce("roof", F.lit(False)).alias("ceiling_available"),
        clip(F.col("support")).alias("boundary_support"), F.col("end_distance_m").alias("closure_m"), F.when(doubt, "caution").otherwise("good").alias("confidence"),
    )


def drift_ablation(members: DataFrame, profile: str = "fast", structure: Structure = Structure(), config: Drift = Drift()) -> DataFrame:
    """Per capture: the verdict on correcting vertical drift. decision is unavailable where too few
    frames see the floor or no offset results."""
    members = store(members)
    at_hand = validate.index(members)
    base = reconstruct(members, PROFILES[profile], indexed=at_hand)
    base.points, base.cloud = cut(base.points), cut(base.cloud)
    poses = base.poses.select("capture_id", F.col("ty").alias("y"))
    control = measure(base.cloud, poses, structure)
    floor = control.floors.select("capture_id", "nx", "ny", "nz", "d")
    residuals = cut(drift.frame_residuals(base.points, floor, KEY, "frame_id", config))
    enough = residuals.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") >= config.minimum_frames)
    offsets = cut(drift.pose_offsets(drift.smoothed(residuals.join(enough.select("capture_id"), KEY), KEY, "frame_id", "residual_m", config.window), floor, KEY, config))
    moved = reconstruct(members, PROFILES[profile], offsets=offsets, indexed=at_hand)
    moved.cloud = cut(moved.cloud)
    corrected = measure(moved.cloud, poses, structure)
    arms = _arm(base.cloud, control, "control", config).unionByName(_arm(moved.cloud, corrected, "corrected", config))
    verdict = drift.judge(cut(arms), KEY, config)
    usable = offsets.select("capture_id").distinct().withColumn("vy_ok", F.lit(True))
    met = members.select("capture_id").distinct().join(verdict, KEY, "left").join(usable, KEY, "left")
    return met.select(
        "capture_id", F.coalesce(F.col("accepted") & F.col("vy_ok"), F.lit(False)).alias("accepted"),
        F.when(F.col("vy_ok").isNull() | F.col("decision").isNull(), "unavailable").otherwise(F.col("decision")).alias("decision"), "improvement",
    )


def _arm(cloud: DataFrame, m: Measured, name: str, config: Drift) -> DataFrame:
    n = cloud.groupBy(*KEY).agg(F.count("*").alias("points"))
    trimmed = drift.trimmed_residual(cloud, m.floors.select("capture_id", "nx", "ny", "nz", "d"), KEY, config.trimmed_quantile).select("capture_id", "trimmed_rmse_m")
    walls = m.walls.groupBy(*KEY).agg(F.avg("rmse_m").alias("wall_rmse_m"), F.count("*").alias("walls"))
    met = n.join(m.floors.select("capture_id", "inlier_ratio", "rmse_m"), KEY).join(trimmed, KEY, "left").join(walls, KEY, "left").join(m.outlines.select("capture_id", "support"), KEY, "left")
    return met.select("capture_id", F.lit(name).alias("arm"), "points", "inlier_ratio", "trimmed_rmse_m", "rmse_m", "wall_rmse_m", F.coalesce("walls", F.lit(0)).alias("walls"), "support")
