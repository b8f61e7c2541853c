"""Precision intervals of a run's measures by resampling, and a note for each interval that is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.config import Intervals, Structure
from voxelyard.operators import openings as op
from voxelyard.operators import resample
from voxelyard.operators.cut import cut

OUTLINE_METRICS = ("area_m2", "perimeter_m", "length_m", "width_m")


def opening_widths(points: DataFrame, walls: DataFrame, cells: DataFrame, ceilings: DataFrame | None, by: list[str] = ["capture_id"], config: Intervals = Intervals(), structure: Structure = Structure()) -> DataFrame:
    """Per opening id and resample: width_m, from the opening detector run anew on resampled points.

    Walls, floor cells and ceilings stay as they are: the widths show how steady the edges are, not
    the planes. Only points in the height of the walls' band are drawn from. by, rep is the detector's key,
    so all resamples of all captures are one plan.
    """
    rep = [*by, "rep"]
    reps = F.explode(F.sequence(F.lit(0), F.lit(config.resamples - 1))).alias("rep")
    drawn = resample.draws(points.select(*by, "fx", "fy", "h"), by, ["fx", "fy", "h"], ["fx", "fy", "h"], config.resamples, config.seed + 1)
    each = lambda df: None if df is None else df.select("*", reps)
    found, _ = op.analyse(cut(drawn), each(walls), each(cells), each(ceilings), rep, structure)
    return found.select(*rep, "opening_id", "width_m")


def width_intervals(widths: DataFrame, openings: DataFrame, by: list[str] = ["capture_id"], config: Intervals = Intervals()) -> DataFrame:
    """Per published opening: low, high, n_samples of the resamples that found it; null bounds where too few did."""
    key = [*by, "opening_id"]
    found = resample.interval(widths, key, "width_m", config.confidence, 0)
    met = openings.select(*key, F.col("width_m").alias("value")).join(found, key, "left").withColumn("n_samples", F.coalesce("n_samples", F.lit(0)))
    enough = F.col("n_samples") >= config.minimum_successes
    return met.withColumns({c: F.when(enough, F.col(c)) for c in ("low", "high")})


def assemble(
    outlines: DataFrame, plan: DataFrame, ceilings: DataFrame, ceiling: DataFrame, openings: DataFrame, widths: DataFrame,
    captures: DataFrame, by: list[str] = ["capture_id"], config: Intervals = Intervals(),
) -> tuple[DataFrame, DataFrame]:
    """(intervals, notes). plan: outline_interval; ceiling: ceiling_interval; widths: width_intervals.

    intervals: by, metric, target_id, unit, value, low, high, confidence_level, n_samples. notes: by,
    message, one for each interval that a capture has no claim to, and for unsteady outlines.
    """
    none = F.lit(None).cast("string").alias("target_id")
    published = outlines.where("method is not null").select(*by, F.expr("stack(4, " + ", ".join(f"'{m}', {m}" for m in OUTLINE_METRICS) + ") as (metric, value)"))
    unit = F.when(F.col("metric") == "area_m2", "square_metre").otherwise("metre").alias("unit")
    plans = plan.join(published, [*by, "metric"]).select(*by, "metric", none, unit, "value", "low", "high", "n_samples")
    heights = ceiling.join(ceilings.select(*by, F.col("ceiling_height").alias("value")), by).select(
        *by, F.lit("ceiling_height_m").alias("metric"), none, F.lit("metre").alias("unit"), "value", "low", "high", "n_samples"
    )
    opened = widths.where("low is not null").select(
        *by, F.lit("opening_width_m").alias("metric"), F.col("opening_id").alias("target_id"), F.lit("metre").alias("unit"), "value", "low", "high", "n_samples"
    )
    intervals = plans.unionByName(heights).unionByName(opened).withColumn("confidence_level", F.lit(config.confidence))

    def note(rows: DataFrame, message: F.Column) -> DataFrame:
        return rows.select(*by, message.alias("message"))

    area = plan.where("metric = 'area_m2'")
    n = F.lit(config.resamples)
    notes = [
        note(captures.join(area, by, "left_anti"), F.lit("no interval for the outline: too few resamples gave one")),
        note(area.where(F.col("n_samples") < n), F.format_string("%d of %d resamples gave no outline and don't count", n - F.col("n_samples"), n)),
        note(area.where("bimodal"), F.format_string("the resamples disagree on how the outline is drawn (%.0f %% agree): its interval spans two answers", F.col("agreement") * 100)),
        note(captures.join(ceilings, by, "left_anti"), F.lit("no interval for the ceiling: none was found")),
        note(ceilings.join(ceiling, by, "left_anti"), F.lit("no interval for the ceiling: too few resamples")),
        note(widths.where("low is null"), F.format_string("no interval for %s: %d of %d resamples found it", F.col("opening_id"), F.col("n_samples"), n)),
    ]
    every = notes[0]
    for x in notes[1:]:
        every = every.unionByName(x)
    return intervals, every
