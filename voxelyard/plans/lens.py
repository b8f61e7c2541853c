"""Deterministic views of the driver's tables as captures, in DataFrames and in SQL.

The tables are orders and events, not scans. Each lens says once, in both languages, how their
columns are read as pixels, poses, points, bins and measurements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def depth_px(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("frame"), (F.col("l_partkey") % 256).alias("u"), (F.col("l_suppkey") % 192).alias("v"),
        (F.floor("l_extendedprice") % 6000).cast("long").alias("depth_mm"), (F.col("l_linenumber") % 3).cast("long").alias("confidence"),
    )


DEPTH_PX = """depth_px AS (
    SELECT l_orderkey AS frame, l_partkey % 256 AS u, l_suppkey % 192 AS v,
           CAST(floor(l_extendedprice) AS BIGINT) % 6000 AS depth_mm, CAST(l_linenumber % 3 AS BIGINT) AS confidence FROM lineitem)"""


def pose(spark: SparkSession, sf: str) -> DataFrame:
    """Position, a quaternion about y that is not always of length 1, and a capture for each order."""
    half = F.col("o_orderkey") % 360 * F.lit(0.008726646259971648)
    scale = F.when(F.col("o_orderkey") % 10 == 0, F.lit(1.1)).otherwise(F.lit(1.0))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("frame"), (F.col("o_custkey") % 8).alias("capture"),
        (F.col("o_custkey") % 100 / F.lit(10.0)).alias("tx"), (F.col("o_totalprice") / F.lit(100000.0)).alias("ty"), (F.col("o_orderkey") % 50 / F.lit(10.0)).alias("tz"),
        F.lit(0.0).alias("qx"), (F.sin(half) * scale).alias("qy"), F.lit(0.0).alias("qz"), (F.cos(half) * scale).alias("qw"),
    )


POSE = """pose AS (
    SELECT o_orderkey AS frame, o_custkey % 8 AS capture,
           CAST(o_custkey % 100 AS DOUBLE) / 10.0 AS tx, o_totalprice / 100000.0 AS ty, CAST(o_orderkey % 50 AS DOUBLE) / 10.0 AS tz,
           CAST(0 AS DOUBLE) AS qx, sin(o_orderkey % 360 * CAST(0.008726646259971648 AS DOUBLE)) * CASE WHEN o_orderkey % 10 = 0 THEN CAST(1.1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS qy,
           CAST(0 AS DOUBLE) AS qz, cos(o_orderkey % 360 * CAST(0.008726646259971648 AS DOUBLE)) * CASE WHEN o_orderkey % 10 = 0 THEN CAST(1.1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS qw
    FROM orders)"""


def cloud(spark: SparkSession, sf: str) -> DataFrame:
    e = lambda i: (F.element_at("embedding", i).cast("double") * 10).alias("xyz"[i - 1])
    return table(spark, sf, "embeddings").select(F.col("label").cast("long").alias("capture"), "vec_id", e(1), e(2), e(3))


CLOUD = """cloud AS (
    SELECT CAST(label AS BIGINT) AS capture, vec_id, CAST(embedding[1] AS DOUBLE) * 10 AS x, CAST(embedding[2] AS DOUBLE) * 10 AS y,
           CAST(embedding[3] AS DOUBLE) * 10 AS z FROM embeddings)"""


def traj(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("capture"), "event_id", F.col("value").alias("v"), (F.col("event_id") % 97 / F.lit(10.0)).alias("x"), (F.col("value") / F.lit(10.0)).alias("y"),
        (F.col("event_id") % 13 / F.lit(10.0)).alias("z"),
    )


TRAJ = """traj AS (
    SELECT user_id AS capture, event_id, "value" AS v, CAST(event_id % 97 AS DOUBLE) / 10.0 AS x, "value" / 10.0 AS y,
           CAST(event_id % 13 AS DOUBLE) / 10.0 AS z FROM events)"""


def bins(spark: SparkSession, sf: str) -> DataFrame:
    """Open bins of a wall for each user."""
    return table(spark, sf, "events").select(F.col("user_id").alias("wall"), F.floor(F.col("value") / 5).cast("long").alias("bin")).distinct()


BINS = """bins AS (SELECT DISTINCT user_id AS wall, CAST(floor("value" / 5) AS BIGINT) AS bin FROM events)"""


def wall_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Per user and bin of event_id: the heights seen there are the values."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("wall"), (F.col("event_id") % 12).alias("bin"), (F.col("value") / F.lit(20.0)).alias("h"), "event_id",
    )


WALL_BINS = """wall_bins AS (
    SELECT user_id AS wall, event_id % 12 AS bin, "value" / 20.0 AS h, event_id FROM events)"""


def truth_pred(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each part is a wall or an opening; its truth is the mean quantity of lines that were not
    returned, its prediction that of lines not accepted, so either may be missing."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    q, flag = F.col("l_quantity"), F.col("l_returnflag")
    per = li.groupBy("p_partkey", "p_brand").agg(F.avg(F.when(flag != "R", q)).alias("t"), F.avg(F.when(flag != "A", q)).alias("p"))
    name = F.concat(F.lit("c"), (F.col("p_partkey") % 3).cast("string"), F.lit("-"), F.col("p_brand"))
    tier = F.when(F.col("p_partkey") % 3 == 0, "photo").when(F.col("p_partkey") % 3 == 1, "video").otherwise("lidar")
    metric = F.when(F.col("p_partkey") % 4 == 3, "opening_width").otherwise("wall_length")
    rows = per.select(name.alias("capture_name"), tier.alias("tier"), F.col("p_brand").alias("room_id"), metric.alias("metric"), F.concat(F.lit("W"), F.col("p_partkey").cast("string")).alias("target_id"), "p_partkey", "t", "p")
    truth = rows.where("t is not null").select("capture_name", "tier", "room_id", "metric", "target_id", F.col("t").alias("value"))
    pred = rows.where("p is not null").select("capture_name", "metric", "target_id", F.col("p").alias("value"))
    groups = rows.select("capture_name", F.col("room_id").alias("repeatability_group")).distinct()
    return truth, pred, groups


TRUTH_PRED = """per AS (
    SELECT p_partkey, p_brand, avg(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS t, avg(CASE WHEN l_returnflag <> 'A' THEN l_quantity END) AS p
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_brand),
tp AS (
    SELECT 'c' || CAST(p_partkey % 3 AS VARCHAR) || '-' || p_brand AS capture_name,
           CASE p_partkey % 3 WHEN 0 THEN 'photo' WHEN 1 THEN 'video' ELSE 'lidar' END AS tier, p_brand AS room_id,
           CASE WHEN p_partkey % 4 = 3 THEN 'opening_width' ELSE 'wall_length' END AS metric, 'W' || CAST(p_partkey AS VARCHAR) AS target_id, p_partkey, t, p FROM per),
truth AS (SELECT capture_name, tier, room_id, metric, target_id, t AS truth FROM tp WHERE t IS NOT NULL),
pred AS (SELECT capture_name, metric, target_id, p AS predicted FROM tp WHERE p IS NOT NULL),
met AS (
    SELECT t.*, p.predicted FROM truth t LEFT JOIN pred p USING (capture_name, metric, target_id)
    UNION ALL
    SELECT p.capture_name, c.tier, c.room_id, p.metric, p.target_id, CAST(NULL AS DOUBLE), p.predicted
    FROM pred p JOIN (SELECT DISTINCT capture_name, tier, room_id FROM truth) c USING (capture_name)
    WHERE p.metric = 'opening_width' AND NOT EXISTS (SELECT 1 FROM truth t WHERE t.capture_name = p.capture_name AND t.metric = p.metric AND t.target_id = p.target_id)),
gated AS (
    SELECT *, abs(predicted - truth) AS absolute_error, abs(predicted - truth) / truth * 100 AS percentage_error,
           CASE WHEN metric = 'opening_width' THEN CAST(0.02 AS DOUBLE) WHEN tier = 'photo' THEN CAST(8 AS DOUBLE) WHEN tier = 'video' THEN CAST(3 AS DOUBLE) END AS threshold FROM met),
evaluated AS (
    SELECT *, CASE WHEN truth IS NULL THEN 'failed' WHEN predicted IS NULL THEN 'missing_prediction' WHEN threshold IS NULL THEN 'not_evaluated'
                   WHEN CASE WHEN metric = 'opening_width' THEN absolute_error ELSE percentage_error END <= threshold + 1e-12 THEN 'passed' ELSE 'failed' END AS status FROM gated)"""
