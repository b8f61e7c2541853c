"""Frames of a capture: matching, missing ids, keyframes, order and inventory, trajectory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ids(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    return df.select(*keys).where(" and ".join(f"{k} is not null" for k in keys)).distinct().withColumn(flag, F.lit(True))


def presence(depth: DataFrame, confidence: DataFrame, poses: DataFrame, keys: list[str] = ["capture_id", "frame_id"]) -> DataFrame:
    """Which of the three streams hold each id: has_depth, has_confidence, has_pose."""
    parts = [
        _ids(df, keys, "x").select(*keys, *[F.lit(flag == f).alias(f) for f in ("has_depth", "has_confidence", "has_pose")])
        for df, flag in ((depth, "has_depth"), (confidence, "has_confidence"), (poses, "has_pose"))
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # one shuffle for the three-way match and all anti joins
    return every.groupBy(*keys).agg(*[F.max(f).alias(f) for f in ("has_depth", "has_confidence", "has_pose")])


def match_frames(depth: DataFrame, confidence: DataFrame, poses: DataFrame, keys: list[str] = ["capture_id", "frame_id"]) -> DataFrame:
    """Ids in all three streams."""
    return presence(depth, confidence, poses, keys).where("has_depth and has_confidence and has_pose").select(*keys)


def match_summary(depth: DataFrame, confidence: DataFrame, poses: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Per capture: counts of each stream, of matched ids and of the ids missing from each."""
    p = presence(depth, confidence, poses, keys)
    flags = {"depth": "has_depth", "confidence": "has_confidence", "pose": "has_pose"}
    return p.groupBy(*by).agg(
        *[F.count_if(F.col(f)).alias(f"n_{n}") for n, f in flags.items()],
        F.count_if(F.col("has_depth") & F.col("has_confidence") & F.col("has_pose")).alias("n_matched"),
        *[F.count_if(~F.col(f)).alias(f"missing_{n}") for n, f in flags.items()],
    )


def missing_from(ids: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Ids that other lacks."""
    return ids.join(other.select(*on), on, "left_anti")


def keyframes(frames: DataFrame, maximum: int, by: list[str] = ["capture_id"], order: str = "frame_id", stride: int = 1) -> DataFrame:
    """Every stride-th frame in order of id, then at most `maximum` evenly spread ones.

    Position k of m is round(k (n - 1) / (m - 1)), halves to even; one frame is the first.
    """
    window = Window.partitionBy(*by).orderBy(order)
    placed = frames.withColumn("vy_at", F.row_number().over(window) - 1).where(F.col("vy_at") % stride == 0)
    placed = placed.withColumn("vy_at", (F.col("vy_at") / stride).cast("long")).withColumn("vy_n", F.count("*").over(Window.partitionBy(*by)))
    # place p is chosen if some k rounds to it; k is near p (m - 1) / (n - 1)
    m = F.lit(maximum).cast("long")
    near = F.col("vy_at") * (m - 1) / F.greatest(F.col("vy_n") - 1, F.lit(1))
    ks = F.array(*[F.floor(near) + d for d in (-1, 0, 1, 2)])
    hit = F.exists(ks, lambda k: (k >= 0) & (k < m) & (F.rint(k * (F.col("vy_n") - 1) / F.greatest(m - 1, F.lit(1))) == F.col("vy_at")))
    chosen = F.when(F.col("vy_n") <= m, F.lit(True)).when(m == 1, F.col("vy_at") == 0).otherwise(hit)
    return placed.where(chosen).drop("vy_at", "vy_n")


def contiguous(frames: DataFrame, maximum: int, by: list[str] = ["capture_id"], order: str = "frame_id") -> DataFrame:
    """The first `maximum` frames."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return frames.withColumn("vy_at", at).where(F.col("vy_at") <= maximum).drop("vy_at")


def order_violations(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Per capture: how many values are below the one before, in file order."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    return rows.select(*by, (F.col(value) < before).alias("back")).groupBy(*by).agg(F.count_if("back").alias("violations"), F.count("*").alias("n_rows"))


def norm_violations(poses: DataFrame, q: tuple[str, str, str, str], by: list[str], tolerance: float = 0.05) -> DataFrame:
    """Per capture: quaternions whose length is further than the tolerance from 1."""
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in q[1:]), F.col(q[0]) * F.col(q[0])))
    return poses.groupBy(*by).agg(F.count_if(F.abs(norm - 1) > tolerance).alias("violations"), F.count("*").alias("n_rows"))


def inventory(frames: DataFrame, by: list[str], time: str, width: str, height: str) -> DataFrame:
    """Per capture: count, first and last time, duration, the common size or null."""
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    return frames.groupBy(*by).agg(
        F.count("*").alias("n_frames"), F.min(time).alias("first_s"), F.max(time).alias("last_s"),
        (F.max(time) - F.min(time)).alias("duration_s"), one(width).alias("width"), one(height).alias("height"),
    )


def bounded_ids(df: DataFrame, by: list[str], id_col: str, limit: int = 10) -> DataFrame:
    """Per capture: the first ids as text, `...` where there are more (the limit is the report's)."""
    # ids are ranked before they are gathered: a list never holds more than the limit
    ranked = df.select(*by, id_col).distinct().withColumn("vy_at", F.row_number().over(Window.partitionBy(*by).orderBy(id_col)))
    return ranked.groupBy(*by).agg(
        F.concat(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("vy_at") <= limit, F.struct("vy_at", F.col(id_col).cast("string").alias("id"))))), lambda s: s["id"]), ", "),
            F.when(F.max("vy_at") > limit, F.lit(", ...")).otherwise(""),
        ).alias("ids")
    )


def trajectory(rows: DataFrame, by: list[str], order: list[str], xyz: tuple[str, str, str]) -> DataFrame:
    """Per capture: path length, distance between the ends, number of poses."""
    w = Window.partitionBy(*by).orderBy(*order)
    step = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), 2) for c in xyz[1:]), F.pow(F.col(xyz[0]) - F.lag(xyz[0]).over(w), 2)))
    at = F.struct(*[F.col(c) for c in order])
    steps = rows.withColumn("vy_step", step).withColumn("vy_at", at).withColumn("vy_p", F.struct(*[F.col(c).alias(n) for c, n in zip(xyz, "xyz")]))
    ends = steps.groupBy(*by).agg(
        F.coalesce(F.sum("vy_step"), F.lit(0.0)).alias("path_m"), F.min_by("vy_p", "vy_at").alias("a"), F.max_by("vy_p", "vy_at").alias("b"), F.count("*").alias("n_poses")
    )
    gap = F.sqrt(sum((F.pow(F.col(f"b.{c}") - F.col(f"a.{c}"), 2) for c in "yz"), F.pow(F.col("b.x") - F.col("a.x"), 2)))
    return ends.select(*by, "path_m", gap.alias("end_distance_m"), "n_poses")
