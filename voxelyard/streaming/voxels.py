"""Voxel fusion over a stream of points (an extension: fusion is an associative aggregate)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxelyard.operators.project import voxel_fuse


def fuse_stream(points: DataFrame, size: float, name: str, checkpoint: str, by: list[str] = ["capture_id"]) -> StreamingQuery:
    """Keeps the fused cloud of a streaming DataFrame of points up to date in the in-memory table `name`.

    State is one row a voxel. The mean of each voxel is that of all points seen so far, in any order.
    """
    return voxel_fuse(points, size, by).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).start()


def fuse_into(points: DataFrame, size: float, path: str, checkpoint: str, by: list[str] = ["capture_id"]) -> StreamingQuery:
    """Keeps the sums of a stream's voxels in Parquet at path: for clouds that no driver should hold.

    Each micro-batch writes its own sums, a row a voxel, to a folder by its number; a batch that is run
    again writes the same folder again. read_fused adds the batches up.
    """
    voxel = [F.floor(F.col(c) / size).cast("long").alias(f"v{c}") for c in "xyz"]

    def write(rows: DataFrame, number: int) -> None:
        sums = rows.groupBy(*by, *voxel).agg(*[F.sum(F.col(c).cast("double")).alias(f"s{c}") for c in "xyz"], F.count("*").alias("n_points"))
        sums.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def read_fused(spark: SparkSession, path: str, by: list[str] = ["capture_id"]) -> DataFrame:
    """by, vx, vy, vz, x, y, z (the mean of all points so far) and n_points, of what fuse_into wrote."""
    rows = spark.read.parquet(path)
    total = rows.groupBy(*by, "vx", "vy", "vz").agg(*[F.sum(f"s{c}").alias(f"s{c}") for c in "xyz"], F.sum("n_points").alias("n_points"))
    return total.select(*by, "vx", "vy", "vz", *[(F.col(f"s{c}") / F.col("n_points")).alias(c) for c in "xyz"], "n_points")


def frame_counts(frames: DataFrame, time: str, window: str = "10 seconds", late: str = "30 seconds", by: list[str] = ["capture_id"]) -> DataFrame:
    """Frames by capture and tumbling window of event time; rows later than the watermark are dropped
    by Spark, as a late-data rule and not as a sampling."""
    return frames.withWatermark(time, late).groupBy(*by, F.window(time, window)).agg(F.count("*").alias("n_frames"))
