"""JSON documents: ground truth, results, anchors, observation manifests, screening and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WALL = "struct<wall_id: string, length_m: double>"
OPENING = "struct<opening_id: string, wall_id: string, width_m: double>"
ROOM = f"struct<room_id: string, floor_area_m2: double, principal_length_m: double, principal_width_m: double, ceiling_height_m: double, walls: array<{WALL}>, openings: array<{OPENING}>>"
CAPTURE = "struct<capture_name: string, room_id: string, tier: string, repeatability_group: string, expected_input_sha256: string>"
TRUTH = f"property_id string, measurement_method string, rooms array<{ROOM}>, captures array<{CAPTURE}>"
ANCHORS = "source array<array<double>>, target array<array<double>>"
VIEW = "struct<view_id: string, world_from_camera: array<array<double>>, observations: map<string, array<double>>>"
MANIFEST = f"camera_matrix array<array<double>>, translation_unit string, maximum_reprojection_error_px double, views array<{VIEW}>"
DECISIONS = "reviewer string, decisions array<struct<relative_path: string, confirmed: boolean, action: string, quantity_basis: string, unit_rate: double, note: string>>"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each document, with the schema; a document that isn't JSON ends the job."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def unknown_fields(spark: SparkSession, path: str, allowed: set[str]) -> DataFrame:
    """field: top-level names of each document that the schema doesn't have."""
    raw = spark.read.option("wholetext", "true").text(path)
    keys = raw.select(F.explode(F.json_object_keys("value")).alias("field"))
    return keys.where(~F.col("field").isin(*allowed)).distinct()


def truth_rows(doc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(truth, groups) as operators.evaluate takes them, from one ground-truth document a row."""
    from voxelyard.operators.evaluate import unpivot_scalars

    rooms = doc.select(F.explode("rooms").alias("r")).select("r.*")
    captures = doc.select(F.explode("captures").alias("c")).select("c.*")
    scalars = unpivot_scalars(rooms, ["room_id"], {"floor_area_m2": "floor_area", "principal_length_m": "principal_length", "principal_width_m": "principal_width", "ceiling_height_m": "ceiling_height"})
    walls = rooms.select("room_id", F.explode("walls").alias("w")).select("room_id", F.lit("wall_length").alias("metric"), F.col("w.wall_id").alias("target_id"), F.col("w.length_m").alias("value"))
    opened = rooms.select("room_id", F.explode("openings").alias("o")).select("room_id", F.lit("opening_width").alias("metric"), F.col("o.opening_id").alias("target_id"), F.col("o.width_m").alias("value"))
    every = scalars.unionByName(walls).unionByName(opened)
    truth = captures.select("capture_name", "tier", "room_id").join(every, "room_id")
    return truth.select("capture_name", "tier", "room_id", "metric", "target_id", "value"), captures.select("capture_name", "repeatability_group")


def captures_of(doc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(captures, rooms) of a ground-truth document, as operators.evaluate's guards take them."""
    captures = doc.select(F.explode("captures").alias("c")).select("c.capture_name", "c.room_id", "c.tier", "c.repeatability_group", "c.expected_input_sha256")
    return captures, doc.select(F.explode("rooms").alias("r")).select("r.room_id")


def anchor_rows(doc: DataFrame) -> DataFrame:
    """pair, sx, sy, tx, ty of an anchors document; lists of unequal length or of fewer than two points are errors."""
    bad = (F.size("source") != F.size("target")) | (F.size("source") < 2)
    checked = doc.select("*", F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.lit("anchors need two lists of the same two or more points"))).alias("bad")).where("bad is null")
    both = checked.select(F.explode(F.arrays_zip("source", "target")).alias("p"))
    at = lambda side, i: F.get(F.col(f"p.{side}"), F.lit(i))
    return both.select(F.lit("pair").alias("pair"), at("source", 0).alias("sx"), at("source", 1).alias("sy"), at("target", 0).alias("tx"), at("target", 1).alias("ty"))


def prediction_rows(results: dict[str, DataFrame]) -> DataFrame:
    """capture_name, metric, target_id, value of the tables that operators.runs.results gives."""
    name = F.col("capture_id").alias("capture_name")
    none = F.lit(None).cast("string").alias("target_id")
    outline = results["outlines"].select(name, F.expr("stack(3, 'floor_area', area_m2, 'principal_length', length_m, 'principal_width', width_m) as (metric, value)"), none)
    ceiling = results["ceilings"].select(name, F.lit("ceiling_height").alias("metric"), F.col("ceiling_height").alias("value"), none)
    walls = results["walls"].select(name, F.lit("wall_length").alias("metric"), F.col("length_m").alias("value"), F.col("wall_id").alias("target_id"))
    opened = results["openings"].select(name, F.lit("opening_width").alias("metric"), F.col("width_m").alias("value"), F.col("opening_id").alias("target_id"))
    every = outline.unionByName(ceiling).unionByName(walls).unionByName(opened)
    return every.where("value is not null").select("capture_name", "metric", "target_id", "value")


def observations(doc: DataFrame) -> DataFrame:
    """track, view_id, gate_px (of its document; 3 where it has none), u, v and the view's projection p00 .. p23 (camera matrix x camera-from-world).

    The camera pose is rigid, so its inverse is the transposed rotation and the turned-back
    translation. A unit other than metre and fewer than two views are errors.
    """
    bad = F.when(F.col("translation_unit") != "metre", F.raise_error(F.lit("the translation unit must be metre"))).when(
        F.size("views") < 2, F.raise_error(F.lit("at least two views are required"))
    )
    gate = F.coalesce("maximum_reprojection_error_px", F.lit(3.0)).alias("gate_px")
    v = doc.select("camera_matrix", gate, F.explode("views").alias("v"), bad.alias("bad")).where("bad is null")
    rows = v.select("camera_matrix", "gate_px", "v.view_id", F.col("v.world_from_camera").alias("w"), F.explode("v.observations").alias("track", "uv"))
    r = lambda i, j: F.get(F.get("w", F.lit(j)), F.lit(i))  # noqa: E731  transposed
    t = [-(r(i, 0) * F.get(F.get("w", F.lit(0)), F.lit(3)) + r(i, 1) * F.get(F.get("w", F.lit(1)), F.lit(3)) + r(i, 2) * F.get(F.get("w", F.lit(2)), F.lit(3))) for i in range(3)]
    k = lambda i, j: F.get(F.get("camera_matrix", F.lit(i)), F.lit(j))
    ext = [[r(i, 0), r(i, 1), r(i, 2), t[i]] for i in range(3)]
    p = {f"p{i}{j}": k(i, 0) * ext[0][j] + k(i, 1) * ext[1][j] + k(i, 2) * ext[2][j] for i in range(3) for j in range(4)}
    return rows.select(F.col("track").alias("track"), "view_id", "gate_px", F.get("uv", F.lit(0)).alias("u"), F.get("uv", F.lit(1)).alias("v"), *[c.alias(n) for n, c in p.items()])
