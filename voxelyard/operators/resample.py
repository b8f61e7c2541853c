"""Bootstrap draws and percentile intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelyard.config import Intervals, Structure
from voxelyard.functions.columns import lcg

#: Places of a group whose rows travel as one array.
BLOCK = 1024


def draws(rows: DataFrame, by: list[str], order: list[str], values: list[str], resamples: int = 64, seed: int = 29) -> DataFrame:
    """n of n rows with replacement for each resample: by, rep, and the values.

    Row i of resample r is the row at place lcg(r, i) mod n, found by an equi-join on (by, place // BLOCK), so
    each resample is a shuffle of narrow rows; the draws are the same in any partitioning. Each task holds its
    own blocks' rows packed in arrays; they are never broadcast, for they grow with the input.
    """
    w = Window.partitionBy(*by)
    placed = rows.select(*by, *values, (F.row_number().over(w.orderBy(*order)) - 1).cast("long").alias("vy_i"), F.count("*").over(w).alias("vy_n"))
    picks = placed.select(*by, "vy_i", "vy_n", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))).alias("rep"))
    at = lcg(F.col("rep").cast("long") * 1000003 + F.col("vy_i") * 7 + (seed - 24)) % F.col("vy_n")
    block = F.floor(F.col("vy_i") / BLOCK).alias("vy_block")
    blocks = placed.groupBy(*by, block).agg(F.sort_array(F.collect_list(F.struct("vy_i", *values))).alias("vy_rows"))
    asked = picks.select(*by, "rep", at.alias("vy_i")).withColumn("vy_block", block)
    met = asked.join(blocks.hint("shuffle_hash"), [*by, "vy_block"])
    row = F.col("vy_rows")[(F.col("vy_i") % BLOCK).cast("int")]
    return met.select(*by, "rep", *[row[v].alias(v) for v in values])


def interval(samples: DataFrame, by: list[str], value: str, confidence: float = 0.95, least: int = 2) -> DataFrame:
    """Two-sided percentile interval of each group's samples; groups with too few have none."""
    tail = (1 - confidence) / 2
    got = samples.groupBy(*by).agg(
        F.percentile(value, F.lit(tail)).alias("low"), F.percentile(value, F.lit(1 - tail)).alias("high"), F.count(value).alias("n_samples")
    )
    return got.where(F.col("n_samples") >= least)


def mean_interval(rows: DataFrame, by: list[str], order: list[str], value: str, config: Intervals = Intervals()) -> DataFrame:
    means = draws(rows, by, order, [value], config.resamples, config.seed).groupBy(*by, "rep").agg(F.avg(value).alias("m"))
    return interval(means, by, "m", config.confidence, config.minimum_successes)


def ceiling_interval(floor_heights: DataFrame, ceiling_heights: DataFrame, by: list[str], order: list[str], config: Intervals = Intervals()) -> DataFrame:
    """Interval of the difference of the two resampled means (columns: by, order, height)."""
    a = draws(floor_heights, by, order, ["height"], config.resamples, config.seed).groupBy(*by, "rep").agg(F.avg("height").alias("lo"))
    b = draws(ceiling_heights, by, order, ["height"], config.resamples, config.seed + 1).groupBy(*by, "rep").agg(F.avg("height").alias("hi"))
    return interval(a.join(b, [*by, "rep"]).withColumn("v", F.col("hi") - F.col("lo")), by, "v", config.confidence, config.minimum_successes)


def outline_interval(points: DataFrame, by: list[str], order: list[str], config: Intervals = Intervals(), structure: Structure = Structure()) -> DataFrame:
    """Reruns trimming, the outline choice and its measures for each resample.

    Per capture and metric (area_m2, perimeter_m, length_m, width_m): low, high, n_samples, and
    agreement, the share of resamples that chose the most frequent method. Each resample is a group
    of its own for the outline kernel.
    """
    from voxelyard.operators.grid import trimmed_centres
    from voxelyard.operators.polygon import outlines

    rep = [*by, "rep"]
    sample = draws(points, by, order, ["x", "y"], config.resamples, config.seed)
    found = outlines(trimmed_centres(sample, structure.grid_size_m, rep, structure.trim_percentile), rep, structure).where("method is not null")
    measures = found.select(*by, F.expr("stack(4, 'area_m2', area_m2, 'perimeter_m', perimeter_m, 'length_m', length_m, 'width_m', width_m) as (metric, value)"))
    method = found.groupBy(*by, "method").agg(F.count("*").alias("n")).groupBy(*by).agg((F.max("n") / F.sum("n")).alias("agreement"))
    return interval(measures, [*by, "metric"], "value", config.confidence, config.minimum_successes).join(method, by).withColumn("bimodal", F.col("agreement") < config.agreement)
