"""Vertical drift: residuals by frame, smoothing, offsets, and the judgement of a correction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelyard.config import Drift
from voxelyard.functions.columns import dot


def frame_residuals(points: DataFrame, planes: DataFrame, by: list[str], frame: str = "frame_id", config: Drift = Drift()) -> DataFrame:
    """Per frame: mean signed distance to the plane of the points in its band; enough points only."""
    far = dot(("nx", "ny", "nz"), ("x", "y", "z")) + F.col("d")
    met = points.join(planes, by).withColumn("far", far).where(F.abs("far") <= config.band_m)
    return met.groupBy(*by, frame).agg(F.avg("far").alias("residual_m"), F.count("*").alias("n_points")).where(F.col("n_points") >= config.minimum_frame_points)


def smoothed(rows: DataFrame, by: list[str], order: str, value: str, window: int = 9) -> DataFrame:
    """Adds smooth: a centred mean whose ends are padded by odd reflection (2 x end - mirrored).

    The half-width is min(window // 2, (n - 1) // 2); two values or fewer stay as they are. Linear
    sequences are left unchanged. The mean is the sum of a frame of rows, which stops at the ends, and
    what the mirrored values of the few rows near each end add to it: one window, no join.
    """
    w = Window.partitionBy(*by)
    o = w.orderBy(order)
    h = window // 2
    v = F.col(value)
    r = rows.withColumns({"vy_p": F.row_number().over(o) - 1, "vy_n": F.count("*").over(w)})
    r = r.withColumn("vy_h", F.when((F.col("vy_n") <= 2) | F.lit(window <= 1), 0).otherwise(F.least(F.lit(h), ((F.col("vy_n") - 1) / 2).cast("int"))))
    back = F.col("vy_n") - 1 - F.col("vy_p")
    ends = {f"vy_low{k}": F.max(F.when(F.col("vy_p") == k, v)).over(w) for k in range(h + 1)} | {f"vy_high{k}": F.max(F.when(back == k, v)).over(w) for k in range(h + 1)}
    r = r.withColumns(ends)
    total = v.cast("double")
    for k in range(1, h + 1):
        total = F.when(F.col("vy_h") == k, F.sum(v).over(o.rowsBetween(-k, k))).otherwise(total)
    for k in range(1, h + 1):
        for side, away in (("low", F.col("vy_p")), ("high", back)):
            total = total + F.when(F.col("vy_h") - away >= k, 2 * F.col(f"vy_{side}0") - F.col(f"vy_{side}{k}")).otherwise(0.0)
    return r.withColumn("smooth", total / (2 * F.col("vy_h") + 1)).drop("vy_p", "vy_n", "vy_h", *ends)


def pose_offsets(smooth: DataFrame, planes: DataFrame, by: list[str], config: Drift = Drift()) -> DataFrame:
    """Per frame: offset_m = smooth less its median, clamped; tiny ones dropped; dx, dy, dz = -offset n."""
    middle = smooth.groupBy(*by).agg(F.median("smooth").alias("vy_m"))
    m = F.lit(config.maximum_offset_m)
    off = F.greatest(-m, F.least(m, F.col("smooth") - F.col("vy_m")))
    out = smooth.join(middle, by).withColumn("offset_m", off).where(F.abs("offset_m") >= 1e-6).join(planes.select(*by, "nx", "ny", "nz"), by)
    return out.withColumns({f"d{c}": -F.col("offset_m") * F.col(f"n{c}") for c in "xyz"}).drop("vy_m", "nx", "ny", "nz")


def trimmed_residual(points: DataFrame, planes: DataFrame, by: list[str], quantile: float = 0.30) -> DataFrame:
    """RMS of the closest round(quantile n) distances (halves to even, one at least)."""
    far = F.abs(dot(("nx", "ny", "nz"), ("x", "y", "z")) + F.col("d"))
    w = Window.partitionBy(*by)
    met = points.join(planes, by).withColumn("far", far)
    ranked = met.withColumns({"rn": F.row_number().over(w.orderBy("far")), "n": F.count("*").over(w)})
    k = F.greatest(F.rint(F.lit(quantile) * F.col("n")), F.lit(1.0))
    return ranked.where(F.col("rn") <= k).groupBy(*by).agg(F.sqrt(F.avg(F.col("far") * F.col("far"))).alias("trimmed_rmse_m"), F.count("*").alias("n_used"))


def judge(arms: DataFrame, by: list[str], config: Drift = Drift()) -> DataFrame:
    """arms: by, arm (control, corrected), points, inlier_ratio, trimmed_rmse_m, rmse_m, wall_rmse_m,
    walls, support. Per capture: accepted, decision (the first gate that fails, or accepted), improvement."""
    names = ("points", "inlier_ratio", "trimmed_rmse_m", "rmse_m", "wall_rmse_m", "walls", "support")
    pick = lambda arm, c: F.max(F.when(F.col("arm") == arm, F.col(c)))
    a = arms.groupBy(*by).agg(*[pick(arm, c).alias(f"{p}_{c}") for arm, p in (("control", "a"), ("corrected", "b")) for c in names])
    c = F.col
    both = c("a_trimmed_rmse_m").isNotNull() & c("b_trimmed_rmse_m").isNotNull()
    base = F.when(both, c("a_trimmed_rmse_m")).otherwise(c("a_rmse_m"))
    cand = F.when(both, c("b_trimmed_rmse_m")).otherwise(c("b_rmse_m"))
    gain = (base - cand) / base
    decision = (
        F.when((c("a_points") > 0) & (c("a_points") - c("b_points") > c("a_points") * config.maximum_point_loss), "points_lost")
        .when(c("a_inlier_ratio") - c("b_inlier_ratio") > config.maximum_inlier_drop, "inliers_lost")
        .when(base <= 0, "no_baseline")
        .when(gain < config.minimum_improvement, "no_improvement")
        .when((c("a_wall_rmse_m") > 0) & c("b_wall_rmse_m").isNotNull() & ((c("b_wall_rmse_m") - c("a_wall_rmse_m")) / c("a_wall_rmse_m") > config.maximum_wall_regression), "walls_worse")
        .when(c("b_walls") < c("a_walls"), "walls_lost")
        .when(c("a_support") - c("b_support") > config.maximum_support_drop, "support_lost")
        .otherwise("accepted")
    )
    return a.withColumns({"decision": decision, "improvement": F.when(base > 0, gain)}).select(*by, (c("decision") == "accepted").alias("accepted"), "decision", "improvement")
