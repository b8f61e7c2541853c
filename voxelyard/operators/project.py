"""From depth pixels to world points: gates, pinhole back-projection, pose, voxel fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelyard.config import Reconstruction
from voxelyard.functions.columns import cell, finite
from voxelyard.operators.cut import cut


def depth_metres(mm: str | Column) -> Column:
    """Millimetres to metres in single precision, as sensors' tools do."""
    mm = F.col(mm) if isinstance(mm, str) else mm
    return (mm.cast("float") * F.lit(0.001).cast("float")).cast("float")


def depth_gate(depth_m: str, confidence: str, config: Reconstruction = Reconstruction()) -> Column:
    """Finite, within the range (bounds included) and confident enough."""
    z = F.col(depth_m)
    low, high = F.lit(config.minimum_depth_m).cast("float"), F.lit(config.maximum_depth_m).cast("float")
    return finite(z) & (z >= low) & (z <= high) & (F.col(confidence) >= config.minimum_confidence)


def on_stride(u: str, v: str, stride: int) -> Column:
    return (F.col(u) % stride == 0) & (F.col(v) % stride == 0)


def scaled_intrinsics(df: DataFrame, width: int, height: int, config: Reconstruction = Reconstruction()) -> DataFrame:
    """fx, fy, cx, cy of the colour image's size, scaled to the depth image's by axis."""
    sx, sy = width / config.intrinsics_width, height / config.intrinsics_height
    return df.withColumns({"fx": F.col("fx") * sx, "fy": F.col("fy") * sy, "cx": F.col("cx") * sx, "cy": F.col("cy") * sy})


def backproject(df: DataFrame, u: str = "u", v: str = "v", z: str = "depth_m", k: tuple = ("fx", "fy", "cx", "cy")) -> DataFrame:
    """Camera coordinates xc, yc, zc of each pixel, in double precision."""
    fx, fy, cx, cy = (F.col(c) if isinstance(c, str) else F.lit(float(c)) for c in k)
    depth = F.col(z).cast("double")
    return df.withColumns({"xc": (F.col(u) - cx) * depth / fx, "yc": (F.col(v) - cy) * depth / fy, "zc": depth})


def rotation(qx: Column, qy: Column, qz: Column, qw: Column) -> list[list[Column]]:
    """The matrix of a quaternion, normalised first."""
    n = F.sqrt(qx * qx + qy * qy + qz * qz + qw * qw)
    x, y, z, w = qx / n, qy / n, qz / n, qw / n
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


def with_rotation(poses: DataFrame) -> DataFrame:
    """r00 .. r22 beside each pose, so that the matrix is made once a frame and not once a pixel."""
    r = rotation(*(F.col(c) for c in ("qx", "qy", "qz", "qw")))
    return poses.withColumns({f"r{i}{j}": r[i][j] for i in range(3) for j in range(3)})


def to_world(df: DataFrame, single: bool = True) -> DataFrame:
    """x, y, z = R (xc, yc, zc) + (tx, ty, tz); stored in single precision by default."""
    c = [F.col("xc"), F.col("yc"), F.col("zc")]
    out = {}
    for i, (name, t) in enumerate((("x", "tx"), ("y", "ty"), ("z", "tz"))):
        p = F.col(f"r{i}0") * c[0] + F.col(f"r{i}1") * c[1] + F.col(f"r{i}2") * c[2] + F.col(t)
        out[name] = p.cast("float") if single else p
    return df.withColumns(out)


def world_points(pixels: DataFrame, poses: DataFrame, config: Reconstruction = Reconstruction(), on: list[str] = ["capture_id", "frame_id"], single: bool = True) -> DataFrame:
    """pixels (u, v, depth_mm, confidence) with poses (tx..tz, qx..qw, fx..cy) to points x, y, z.

    The gates run before the join. A pose row is one a frame; Spark broadcasts them if they're small.
    """
    kept = (
        pixels.where(on_stride("u", "v", config.pixel_stride))
        .withColumn("depth_m", depth_metres("depth_mm")).where(depth_gate("depth_m", "confidence", config))
    )
    return to_world(backproject(kept.join(with_rotation(poses), on)), single)


def pixel_counts(pixels: DataFrame, by: list[str], config: Reconstruction = Reconstruction()) -> DataFrame:
    """Per group: strided pixels, and those that pass the gates."""
    m = pixels.where(on_stride("u", "v", config.pixel_stride)).withColumn("vy_z", depth_metres("depth_mm"))
    return m.groupBy(*by).agg(F.count("*").alias("sampled"), F.count_if(depth_gate("vy_z", "confidence", config)).alias("valid"))


def voxel_fuse(points: DataFrame, size: float, by: list[str] = ["capture_id"], xyz: tuple = ("x", "y", "z"), single_keys: bool = False) -> DataFrame:
    """One centroid (the mean) and count for each voxel: vx, vy, vz, x, y, z, n_points.

    One hash aggregate with a partial step before the shuffle, so memory is bounded by voxels.
    single_keys computes the keys in single precision, for points that lie on voxel faces.
    """
    def key(c: str) -> Column:
        if single_keys:
            return F.floor((F.col(c).cast("float") / F.lit(size).cast("float")).cast("float")).cast("long")
        return cell(c, size)

    names = [key(c).alias(n) for c, n in zip(xyz, ("vx", "vy", "vz"))]
    return points.groupBy(*by, *names).agg(*[F.avg(F.col(c).cast("double")).alias(n) for c, n in zip(xyz, "xyz")], F.count("*").alias("n_points"))


def voxel_fold(points: DataFrame, size: float, batch: str, by: list[str] = ["capture_id"], batches: int | None = None) -> DataFrame:
    """Fusion batch by batch, fused centroids re-entering with weight 1 (a recency-weighted mean).

    batch: column with the frames' batch number from 0. A loop of as many aggregates as batches; every
    few rounds the cloud is checkpointed. voxel_fuse is the unbiased form.
    """
    if batches is None:
        batches = (points.agg(F.max(batch).alias("m")).first()["m"] or 0) + 1
    rows = points.select(*by, "x", "y", "z", batch)
    cloud = None
    for b in range(batches):
        part = rows.where(F.col(batch) == b).select(*by, "x", "y", "z")
        cloud = voxel_fuse(part if cloud is None else cloud.unionByName(part), size, by).select(
            *by, *[F.col(c).cast("float").alias(c) for c in "xyz"]
        )
        if b % 8 == 7:
            cloud = cut(cloud)
    return cloud


def bounds(points: DataFrame, by: list[str] = ["capture_id"], limit_m: float = 100.0) -> DataFrame:
    """Per capture: extent by axis, number of points, and whether an extent is over the limit."""
    out = points.groupBy(*by).agg(*[f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))], F.count("*").alias("n_points"))
    wide = F.greatest(*[F.col(f"max_{c}") - F.col(f"min_{c}") for c in "xyz"]) > limit_m
    return out.withColumn("too_wide", wide)


def offset_poses(poses: DataFrame, offsets: DataFrame, on: list[str]) -> DataFrame:
    """Poses moved by (dx, dy, dz) where an offset exists."""
    met = poses.join(offsets.select(*on, "dx", "dy", "dz"), on, "left")
    return met.withColumns({f"t{c}": F.col(f"t{c}") + F.coalesce(f"d{c}", F.lit(0.0)) for c in "xyz"}).drop("dx", "dy", "dz")
