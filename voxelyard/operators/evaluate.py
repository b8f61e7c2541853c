"""Scoring predictions against truth: gates, misses and phantoms, repeatability, coverage, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelyard.config import GATES, GATE_SLACK, OPENING_PASS_RATE, REPEAT_SPREAD_M, REPEAT_SPREAD_PERCENT

TARGET = ["capture_name", "metric", "target_id"]

#: The input tiers of a benchmark (fixed values).
TIERS = ("photo", "video", "lidar")


def unpivot_scalars(df: DataFrame, ids: list[str], metrics: dict[str, str]) -> DataFrame:
    """Scalar columns to rows: ids, metric, target_id (null), value. Null values give no row."""
    out = df.unpivot(ids, [*metrics], "vy_c", "value").where("value is not null")
    named = F.create_map(*[F.lit(x) for kv in metrics.items() for x in kv])[F.col("vy_c")]
    return out.select(*ids, named.alias("metric"), F.lit(None).cast("string").alias("target_id"), F.col("value").cast("double").alias("value"))


def threshold(metric: Column, tier: Column) -> tuple[Column, Column]:
    """The gate's threshold and unit for a metric and tier; null where there is none."""
    value, unit = F.lit(None).cast("double"), F.lit(None).cast("string")
    for (m, t), (v, u) in GATES.items():
        hit = (metric == m) & (F.lit(True) if t is None else tier == t)
        value, unit = F.when(hit, F.lit(v)).otherwise(value), F.when(hit, F.lit(u)).otherwise(unit)
    return value, unit


def judged(rows: DataFrame) -> DataFrame:
    """rows: metric, tier, truth, predicted. Adds absolute_error, percentage_error, threshold, unit,
    gated and status."""
    limit, unit = threshold(F.col("metric"), F.col("tier"))
    t, p = F.col("truth"), F.col("predicted")
    r = rows.withColumns({
        "absolute_error": F.abs(p - t), "percentage_error": F.when(t > 0, F.abs(p - t) / t * 100),
        "threshold": limit, "unit": unit,
    })
    error = F.when(F.col("unit") == "metre", F.col("absolute_error")).otherwise(F.col("percentage_error"))
    gated = F.col("threshold").isNotNull()
    status = (
        F.when(t.isNull(), "failed").when(p.isNull(), "missing_prediction").when(~gated, "not_evaluated")
        .when(error <= F.col("threshold") + GATE_SLACK, "passed").otherwise("failed")
    )
    return r.withColumns({"gated": gated, "status": status})


def evaluate(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """truth: capture_name, tier, room_id, metric, target_id, value (scalars, walls, openings of each
    capture). predicted: capture_name, metric, target_id, value. Every truth is kept; openings that
    were predicted and aren't true are phantoms (truth null, failed).
    """
    key = [F.col("metric"), F.coalesce("target_id", F.lit("")).alias("vy_t")]
    t = truth.select("capture_name", "tier", "room_id", *key, "target_id", F.col("value").cast("double").alias("truth"))
    p = predicted.select("capture_name", *key, F.col("value").cast("double").alias("predicted"))
    on = ["capture_name", "metric", "vy_t"]
    met = t.join(p, on, "left")
    captures = truth.select("capture_name", "tier", "room_id").distinct()
    phantom = (
        p.where("metric = 'opening_width'").join(t.select(*on), on, "left_anti").join(captures, "capture_name")
        .select(*on, "tier", "room_id", F.col("vy_t").alias("target_id"), F.lit(None).cast("double").alias("truth"), "predicted")
    )
    return judged(met.unionByName(phantom).drop("vy_t"))


def statuses(evaluated: DataFrame, by: list[str]) -> DataFrame:
    s = F.col("status")
    return evaluated.groupBy(*by).agg(*[F.count_if(s == x).alias(x) for x in ("passed", "failed", "missing_prediction", "not_evaluated")])


def summary_status(evaluated: DataFrame, by: list[str]) -> DataFrame:
    """Per group one word: failed before missing_prediction before not_evaluated before passed (a metric's
    gates, a tier's walls, a metric's repeatability)."""
    s = F.col("status")
    some = lambda x: F.coalesce(F.max(s == x), F.lit(False))
    word = F.when(some("failed"), "failed").when(some("missing_prediction"), "missing_prediction").when(some("not_evaluated"), "not_evaluated").otherwise("passed")
    return evaluated.groupBy(*by).agg(F.count("*").alias("n_measurements"), word.alias("status"))


def rooms_all_tiers(captures: DataFrame, rooms: DataFrame, tiers: tuple[str, ...] = TIERS) -> DataFrame:
    """One row: declared where every room has a capture of every tier, else not_met. captures: room_id, tier."""
    per = captures.groupBy("room_id").agg(F.count_distinct(F.when(F.col("tier").isin(*tiers), F.col("tier"))).alias("n_tiers"))
    met = rooms.select("room_id").distinct().join(per, "room_id", "full_outer").agg(F.count("*").alias("n_rooms"), F.coalesce(F.min(F.coalesce("n_tiers", F.lit(0))), F.lit(0)).alias("least"))
    return met.select("n_rooms", F.when((F.col("n_rooms") > 0) & (F.col("least") == len(tiers)), "declared").otherwise("not_met").alias("status"))


def protocol_warnings(captures: DataFrame, rooms: DataFrame, results: DataFrame, least_rooms: int = 3, tiers: tuple[str, ...] = TIERS) -> DataFrame:
    """code, subject: what a benchmark lacks to be complete, and names that truth and results don't share.

    captures: capture_name, room_id, tier, repeatability_group. rooms: room_id. results: capture_name.
    """
    lone = rooms.select("room_id").distinct().join(captures, "room_id", "left_anti").select(F.lit("room_without_capture").alias("code"), F.col("room_id").alias("subject"))
    few = rooms.agg(F.count_distinct("room_id").alias("n")).where(F.col("n") < least_rooms).select(F.lit("too_few_rooms"), F.col("n").cast("string"))
    seen = captures.agg(F.collect_set("tier").alias("seen"), F.count("repeatability_group").alias("n"))
    absent = seen.select(F.lit("tier_missing"), F.explode(F.array_except(F.array(*map(F.lit, tiers)), "seen")))
    unrepeated = seen.where("n = 0").select(F.lit("no_repeated_capture"), F.lit(None).cast("string"))
    partly = captures.groupBy("room_id").agg(F.count_distinct("tier").alias("n")).where(F.col("n") < len(tiers)).select(F.lit("room_lacks_tiers"), "room_id")
    extra = results.select("capture_name").distinct().join(captures, "capture_name", "left_anti").select(F.lit("result_without_truth"), "capture_name")
    none = captures.select("capture_name").distinct().join(results, "capture_name", "left_anti").select(F.lit("truth_without_result"), "capture_name")
    out = lone
    for x in (few, absent, unrepeated, partly, extra, none):
        out = out.union(x)
    return out


def guarded(captures: DataFrame, hashes: DataFrame) -> DataFrame:
    """captures with problem: why a capture must not be scored, or null.

    captures: capture_name, expected_input_sha256. hashes: capture_name, sha256. A name that could lead
    out of a folder, a name that repeats, and an input other than the one that the truth was taken for.
    """
    n = captures.groupBy("capture_name").agg(F.count("*").alias("n"))
    met = captures.join(n, "capture_name").join(hashes.select("capture_name", "sha256"), "capture_name", "left")
    name = F.col("capture_name")
    plain = ~name.rlike(r"[/\\]") & ~name.isin("", ".", "..")
    problem = F.when(name.isNull() | ~plain, "the name is not a plain name").when(F.col("n") > 1, "the name repeats").when(
        F.lower("expected_input_sha256") != F.lower("sha256"), "the input is not the one that the truth was taken for"
    )
    return met.withColumn("problem", problem).drop("n", "sha256")


def repeatability(evaluated: DataFrame, groups: DataFrame) -> DataFrame:
    """groups: capture_name, repeatability_group. Spread of ceiling heights and wall lengths over the
    captures of each group of two or more, its status, the accuracy of the group and the class."""
    sized = groups.where("repeatability_group is not null").groupBy("repeatability_group").agg(F.count("*").alias("n_captures"))
    met = (
        evaluated.where(F.col("metric").isin("ceiling_height", "wall_length") & F.col("truth").isNotNull())
        .join(groups, "capture_name").join(sized.where("n_captures >= 2"), "repeatability_group")
    )
    p = met.groupBy("repeatability_group", "metric", "target_id").agg(
        F.max("n_captures").alias("n_captures"), F.count("predicted").alias("n_predicted"), F.max("truth").alias("truth"),
        (F.max("predicted") - F.min("predicted")).alias("spread_m"),
        F.when(F.count("*") < F.max("n_captures"), "not_evaluated")
        .when(F.max((F.col("status") == "missing_prediction")), "missing_prediction")
        .when(F.max((F.col("status") == "failed")), "failed")
        .when(F.min((F.col("status") == "passed")), "passed").otherwise("not_evaluated").alias("accuracy"),
        F.countDistinct("room_id").alias("n_rooms"),
    )
    p = p.withColumn("relative_spread_percent", F.col("spread_m") / F.col("truth") * 100)
    steady = (F.col("spread_m") <= REPEAT_SPREAD_M + GATE_SLACK) | (
        (F.col("metric") == "wall_length") & (F.col("relative_spread_percent") <= REPEAT_SPREAD_PERCENT + GATE_SLACK)
    )
    whole = F.col("n_predicted") == F.col("n_captures")
    kind = (
        F.when(~whole, "incomplete")
        .when(F.col("accuracy") == "passed", F.when(steady, "accurate_and_repeatable").otherwise("accurate_not_repeatable"))
        .when(F.col("accuracy") == "failed", F.when(steady, "biased_but_repeatable").otherwise("biased_and_not_repeatable"))
        .otherwise("not_evaluated")
    )
    return p.withColumns({
        "status": F.when(~whole, "missing_prediction").when(steady, "passed").otherwise("failed"),
        "classification": kind,
        "one_room": F.col("n_rooms") == 1,
        **{c: F.when(whole, F.col(c)) for c in ("spread_m", "relative_spread_percent")},
    }).drop("n_rooms")


def openings_summary(evaluated: DataFrame, by: list[str] = []) -> DataFrame:
    """Detection of openings: the pass rate counts misses and phantoms against it."""
    o = evaluated.where("metric = 'opening_width'")
    true = F.col("truth").isNotNull()
    s = o.groupBy(*by).agg(
        F.count_if(true).alias("expected"), F.count_if(true & F.col("predicted").isNotNull()).alias("matched"),
        F.count_if(true & (F.col("status") == "passed")).alias("passed"), F.count_if(true & F.col("predicted").isNull()).alias("missed"),
        F.count_if(~true).alias("phantoms"),
    )
    total = F.col("expected") + F.col("phantoms")
    rate = F.when(total > 0, F.col("passed") / total)
    return s.withColumns({"pass_rate": rate, "status": F.when(total == 0, "not_evaluated").when(rate >= OPENING_PASS_RATE, "passed").otherwise("failed")})


def coverage(intervals: DataFrame, by: list[str] = []) -> DataFrame:
    """intervals: low, high, truth. The share of intervals that hold the truth (bounds included)."""
    hit = (F.col("low") <= F.col("truth")) & (F.col("truth") <= F.col("high"))
    return intervals.where("truth is not null").groupBy(*by).agg(F.count("*").alias("n_intervals"), F.count_if(hit).alias("covered"), F.avg(hit.cast("double")).alias("coverage_rate"))


def overall(evaluated: DataFrame, repeat: DataFrame) -> DataFrame:
    """One row: failed_gates if any gated measurement failed or is missing or any spread failed, else
    incomplete if anything is missing or not evaluated, else passed. The opening rate has no say."""
    s = F.col("status")
    e = evaluated.agg(
        F.coalesce(F.max((s == "failed") | ((s == "missing_prediction") & F.col("gated"))), F.lit(False)).alias("bad"),
        F.coalesce(F.max(s.isin("missing_prediction", "not_evaluated")), F.lit(False)).alias("open"), F.count("*").alias("n_measurements"),
    )
    r = repeat.agg(F.coalesce(F.max(s == "failed"), F.lit(False)).alias("r_bad"), F.coalesce(F.max(s.isin("missing_prediction", "not_evaluated")), F.lit(False)).alias("r_open"))
    both = e.join(r)  # one row each
    return both.select("n_measurements", F.when(F.col("bad") | F.col("r_bad"), "failed_gates").when(F.col("open") | F.col("r_open"), "incomplete").otherwise("passed").alias("status"))
