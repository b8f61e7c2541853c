"""Validation of captures: every rule gives issue rows (capture_id, severity, code, message)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelyard.operators import frames as fr
from voxelyard.operators.cut import cut
from voxelyard.sources import capture as cap


def expectation(rows: DataFrame, broken: Column, severity: str, code: str, message: Column) -> DataFrame:
    """Issue rows for the rows that break a rule."""
    return rows.where(F.coalesce(broken, F.lit(False))).select("capture_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), message.alias("message"))


@dataclass
class Index:
    """What validation and reconstruction both need of the members, worked out once."""

    members: DataFrame
    root: DataFrame
    camera: DataFrame
    poses: DataFrame  # problem says why a row is invalid
    depth: DataFrame  # code says why a file doesn't count
    confidence: DataFrame


def index(members: DataFrame) -> Index:
    root = cut(cap.roots(members))
    files = lambda kind: cut(cap.frame_files(members, root, kind))
    return Index(members, root, cut(cap.camera_matrices(members, root)), cut(cap.poses(members, root)), files("depth"), files("confidence"))


def validate(members: DataFrame, indexed: Index | None = None) -> tuple[DataFrame, DataFrame]:
    """(issues, summary): summary has valid (no error), the counts of frames and of issues."""
    at_hand = indexed or index(members)
    ids = members.select("capture_id").distinct()
    opened = cap.member_problems(members).select("capture_id", F.lit("error").alias("severity"), "code", "message")
    root = at_hand.root
    no_root = ids.join(root, "capture_id", "left")
    issues = [
        opened,
        expectation(no_root, F.col("root").isNull(), "error", "capture_open_failed", F.lit("no folder holds the poses or the camera matrix")),
        expectation(root, F.col("n_roots") > 1, "error", "capture_open_failed", F.lit("several folders could be the capture's root")),
    ]
    at = lambda name: F.when(F.col("root") == "", F.lit(name)).otherwise(F.concat("root", F.lit("/" + name)))
    own = members.where("problem is null").select("capture_id", cap.normalised(F.col("member")).alias("member"), "size")
    for name, code_missing, code_empty, severity in (
        (cap.CAMERA, "missing_required_file", "empty_required_file", "error"), (cap.POSES, "missing_required_file", "empty_required_file", "error"),
        (cap.IMU, "imu_missing", None, "warning"), (cap.VIDEO, "rgb_video_missing", "rgb_video_empty", "warning"),
    ):
        met = root.select("capture_id", at(name).alias("member")).join(own, ["capture_id", "member"], "left")
        issues.append(expectation(met, F.col("size").isNull(), severity, code_missing, F.concat(F.lit("missing: "), "member")))
        if code_empty:
            issues.append(expectation(met, F.col("size") == 0, severity, code_empty, F.concat(F.lit("empty: "), "member")))
    camera = at_hand.camera
    issues.append(expectation(camera, ~F.col("valid"), "error", "invalid_camera_matrix", F.lit("not a 3 x 3 camera matrix")))
    poses = at_hand.poses
    issues.append(expectation(poses, F.col("problem").isNotNull(), "error", "invalid_odometry", F.concat(F.lit("row "), F.col("row_no").cast("string"), F.lit(": "), "problem")))
    good = poses.where("problem is null")
    depth, conf = at_hand.depth, at_hand.confidence
    for files, kind in ((depth, "depth"), (conf, "confidence")):
        for code, severity in (("invalid_frame_filename", "warning"), ("duplicate_frame_file", "error"), ("empty_frame_file", "error")):
            issues.append(expectation(files, F.col("code") == code, severity, code, F.col("member")))
        some = root.select("capture_id").join(files.where("code is null").select("capture_id").distinct().withColumn("some", F.lit(True)), "capture_id", "left")
        issues.append(expectation(some, F.col("some").isNull(), "error", f"missing_{kind}_frames", F.lit(f"no valid {kind} frame")))
    d, c = depth.where("code is null"), conf.where("code is null")
    key = ["capture_id", "frame_id"]
    summary = cut(fr.match_summary(d, c, good, key, ["capture_id"]))
    for stream, name in (("depth", "depth"), ("confidence", "confidence"), ("pose", "odometry")):
        issues.append(expectation(summary, F.col(f"missing_{stream}") > 0, "warning", f"frames_missing_{name}", F.concat(F.col(f"missing_{stream}").cast("string"), F.lit(f" frames lack {name}"))))
    counted = ids.join(summary, "capture_id", "left")
    issues.append(expectation(counted, F.coalesce("n_matched", F.lit(0)) == 0, "error", "no_matched_frames", F.lit("no frame has depth, confidence and a pose")))
    back = fr.order_violations(good, ["capture_id"], "row_no", "timestamp")
    issues.append(expectation(back, F.col("violations") > 0, "warning", "odometry_timestamp_order", F.concat(F.col("violations").cast("string"), F.lit(" timestamps go back"))))
    norm = fr.norm_violations(good, ("qx", "qy", "qz", "qw"), ["capture_id"])
    issues.append(expectation(norm, F.col("violations") > 0, "warning", "odometry_quaternion_norm", F.concat(F.col("violations").cast("string"), F.lit(" quaternions aren't of length 1"))))
    issues += _images(members, d, c, fr.match_frames(d, c, good, key))
    every = issues[0]
    for i in issues[1:]:
        every = every.unionByName(i)
    every = cut(every)
    per = every.groupBy("capture_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = counted.join(per, "capture_id", "left").na.fill(0)
    return every, cut(out.withColumn("valid", F.col("errors") == 0))


def require_valid(members: DataFrame) -> DataFrame:
    """The matched frames of every capture (capture_id, frame_id); a capture with an error ends the job.

    The strict way in, for callers that would rather have no result than a partial one.
    """
    at_hand = index(members)
    issues, summary = validate(members, at_hand)
    wrong = issues.where("severity = 'error'").groupBy("capture_id").agg(F.min(F.concat("code", F.lit(": "), "message")).alias("why"))
    matched = fr.match_frames(at_hand.depth.where("code is null"), at_hand.confidence.where("code is null"), at_hand.poses.where("problem is null"), ["capture_id", "frame_id"])
    met = summary.select("capture_id").join(wrong, "capture_id", "left").join(matched.select("capture_id", "frame_id"), "capture_id", "left")
    stop = F.when(F.col("why").isNotNull(), F.raise_error(F.concat("capture_id", F.lit(" is not valid: "), "why")))
    return met.withColumn("stop", stop).where("stop is null").select("capture_id", "frame_id")


def _images(members: DataFrame, depth: DataFrame, conf: DataFrame, matched: DataFrame) -> list[DataFrame]:
    """Rules on the images of three frames of each capture: the first, the middle and the last."""
    w = Window.partitionBy("capture_id")
    at = F.row_number().over(w.orderBy("frame_id")) - 1
    n = F.count("*").over(w)
    picked = matched.withColumns({"at": at, "n": n}).where("at = 0 or at = n - 1 or at = floor(n / 2)").select("capture_id", "frame_id")
    names = depth.select("capture_id", "frame_id", "member", F.lit("depth").alias("kind")).unionByName(
        conf.select("capture_id", "frame_id", "member", F.lit("confidence").alias("kind"))
    ).join(picked, ["capture_id", "frame_id"])
    names = cut(names)
    held = members.select("capture_id", cap.normalised(F.col("member")).alias("member"), "content").join(names.select("capture_id", "member"), ["capture_id", "member"])
    looked = cut(cap.inspect(held).join(names, ["capture_id", "member"]))
    d, c = looked.where("kind = 'depth'"), looked.where("kind = 'confidence'")
    out = [expectation(x, F.col("problem").isNotNull(), "error", "invalid_frame_image", F.concat("member", F.lit(": "), "problem")) for x in (d, c)]
    size = F.count_distinct(F.when(F.col("problem").isNull(), F.struct("width", "height")))
    for x, kind in ((d, "depth"), (c, "confidence")):
        out.append(expectation(x.groupBy("capture_id").agg(size.alias("n")), F.col("n") > 1, "error", f"inconsistent_{kind}_size", F.lit(f"{kind} images differ in size")))
    both = d.select("capture_id", "frame_id", F.struct("width", "height").alias("a")).join(c.select("capture_id", "frame_id", F.struct("width", "height").alias("b")), ["capture_id", "frame_id"])
    out.append(expectation(both.where("a <> b").select("capture_id").distinct(), F.lit(True), "error", "depth_confidence_size_mismatch", F.lit("depth and confidence differ in size")))
    out.append(expectation(d, F.col("mode") != "I;16", "error", "invalid_depth_mode", F.concat("member", F.lit(" is "), "mode")))
    out.append(expectation(c, F.col("mode") != "L", "error", "invalid_confidence_mode", F.concat("member", F.lit(" is "), "mode")))
    out.append(expectation(c, (F.col("mode") == "L") & (F.col("high") > 2), "error", "invalid_confidence_values", F.concat("member", F.lit(" has values over 2"))))
    return out
