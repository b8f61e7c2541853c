"""What a run can and can't claim, as rows: capability, status and an explanation for each capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YES, PARTLY, UNJUDGED, NO = "supported", "supported_with_limitations", "not_evaluated", "not_implemented"

#: Fixed names and statuses, in the order of the report; the explanations are ours. A status of None depends on the capture.
CAPABILITIES = [
    ("lidar_capture_ingestion", YES, "folders and ZIP archives of depth captures are read and checked"),
    ("photo_ingestion", YES, "photos are listed, measured and checked for copies"),
    ("video_ingestion", YES, "videos are listed by name and hash; their streams are not decoded here"),
    ("metric_reconstruction", YES, "from depth, confidence, camera matrix and poses"),
    ("measured_floor_plan", PARTLY, "the border of the scanned floor, or its convex hull where the border fails a check"),
    ("ceiling_measurement", PARTLY, None),
    ("wall_identity", None, None),
    ("opening_detection", None, None),
    ("room_adjacency", None, None),
    ("independent_sample_processing", YES, "every capture of a batch stands alone"),
    ("multi_room_stitching", UNJUDGED, "there is no truth to judge it by"),
    ("photo_only_reconstruction", NO, "photos alone are not turned into measures"),
    ("video_only_reconstruction", NO, "videos alone are not turned into measures"),
    ("damage_detection", NO, "dark lines are screened for review; nothing is called damage"),
    ("concealed_condition_prediction", NO, "what a scan doesn't show is not guessed"),
    ("repair_scope_generation", NO, "scopes come from a reviewer's decisions alone"),
    ("ground_truth_accuracy", UNJUDGED, "a run has no reference dimensions"),
    ("live_mobile_processing", NO, "captures are processed after they are recorded"),
]


def capabilities(captures: DataFrame, ceilings: DataFrame, openings: DataFrame, adjacency: DataFrame, by: list[str] = ["capture_id"]) -> DataFrame:
    """captures: by. openings: the status table of operators.openings. 18 rows for each capture."""
    joined = adjacency.groupBy(*by).agg(F.count("*").alias("n_adjacent"))
    has = ceilings.select(*by).distinct().withColumn("has_ceiling", F.lit(True))
    met = captures.select(*by).join(has, by, "left").join(openings, by, "left").join(joined, by, "left").na.fill(0, ["n_adjacent"])
    rows = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("capability"), F.lit(s).cast("string").alias("status"), F.lit(e).cast("string").alias("explanation")) for i, (n, s, e) in enumerate(CAPABILITIES, 1)])
    c = F.col
    ready = F.coalesce(c("openings_status") == "available", F.lit(False))
    every = met.withColumnsRenamed({"status": "openings_status", "reason": "openings_reason"}).withColumn("r", F.explode(rows)).select(
        *by, "has_ceiling", "openings_status", "openings_reason", "n_walls", "n_openings", "n_candidates", "n_adjacent", "r.*"
    )
    why = F.coalesce("openings_reason", F.lit("openings were not looked for"))
    status = F.when(c("capability").isin("wall_identity", "opening_detection"), F.when(ready, PARTLY).otherwise(UNJUDGED)).when(
        c("capability") == "room_adjacency", F.when(c("n_adjacent") > 0, PARTLY).otherwise(UNJUDGED)).otherwise(c("status"))
    text = (
        F.when(c("capability") == "ceiling_measurement", F.when(c("has_ceiling"), "a ceiling passed the checks").otherwise("no ceiling passed the checks in this capture"))
        .when(c("capability") == "wall_identity", F.when(ready, F.format_string("%d walls have names that hold for this capture and these settings", "n_walls")).otherwise(why))
        .when(c("capability") == "opening_detection", F.when(ready, F.format_string("%d of %d candidates passed; their widths are not judged against truth", "n_openings", "n_candidates")).otherwise(why))
        .when(c("capability") == "room_adjacency", F.when(c("n_adjacent") > 0, F.format_string("%d openings join two regions of scanned floor, which need not be rooms", "n_adjacent")).otherwise("no opening was seen to join two regions of scanned floor"))
        .otherwise(c("explanation"))
    )
    return every.select(*by, "place", "capability", status.alias("status"), text.alias("explanation"))
