"""Whole captures, rendered here, from images to measures, in one job."""

import os

import pytest

from tests import scenes
from voxelyard.config import Intervals
from voxelyard.operators import evaluate, runs
from voxelyard.sources import documents

@pytest.fixture(scope="module")
def batch(spark):
    captures = {"box": scenes.rendered(), "wide": scenes.rendered(5.0, 4.0), "bad": {"readme.txt": b"x"}}
    tables = runs.results(scenes.members(spark, captures), "fast", resampling=Intervals(resamples=10, minimum_successes=6))
    return {n: df.persist() for n, df in tables.items()}


def test_measures_of_rendered_rooms(batch):
    o = {r.capture_id: r for r in batch["outlines"].collect()}
    assert set(o) == {"box", "wide"}
    for name, (w, d) in {"box": (4, 3), "wide": (5, 4)}.items():
        assert abs(o[name].area_m2 - w * d) <= 0.08 * w * d and abs(o[name].length_m - w) <= 0.2 and abs(o[name].width_m - d) <= 0.2
    assert all(abs(r.ceiling_height - 2.5) <= 0.03 for r in batch["ceilings"].collect()) and batch["ceilings"].count() == 2
    walls = {}
    for r in batch["walls"].collect():
        walls.setdefault(r.capture_id, []).append(r.rmse_m)
    assert all(len(x) >= 4 and max(x) < 0.03 for x in walls.values())
    assert batch["openings"].count() == 0


def test_one_bad_capture_fails_alone(batch):
    s = {r.capture_id: r.succeeded for r in batch["status"].collect()}
    assert s == {"box": True, "wide": True, "bad": False}
    assert runs.batch_status(batch["status"].selectExpr("1 as b", "succeeded"), ["b"]).first().status == "partial"
    q = {r.capture_id: r for r in batch["quality"].collect()}
    assert 0.5 < q["box"].valid_depth_ratio <= 1 and q["box"].confidence in ("good", "caution")


def test_intervals_and_notes_of_a_run(batch):
    rows = {(r.capture_id, r.metric): r for r in batch["intervals"].collect()}
    for name, area in (("box", 12), ("wide", 20)):
        for metric in ("area_m2", "perimeter_m", "length_m", "width_m", "ceiling_height_m"):
            r = rows[name, metric]
            assert r.low <= r.high and r.n_samples >= 6 and r.unit == ("square_metre" if metric == "area_m2" else "metre")
        assert abs(rows[name, "area_m2"].high - area) < 0.15 * area and rows[name, "ceiling_height_m"].high - rows[name, "ceiling_height_m"].low < 0.05
    assert not any("ceiling" in r.message for r in batch["interval_notes"].collect())
    assert not [r for r in rows if r[1] == "opening_width_m"]


def test_what_a_run_says_about_itself(batch):
    status = {r.capture_id: r for r in batch["opening_status"].collect()}
    assert set(status) == {"box", "wide"} and all(r.status == "available" and r.n_openings == 0 for r in status.values())
    claims = {(r.capture_id, r.capability): r.status for r in batch["capabilities"].collect()}
    assert len(claims) == 54 and claims["box", "opening_detection"] == "supported_with_limitations" and claims["bad", "opening_detection"] == "not_evaluated"
    q = {r.capture_id: r for r in batch["quality"].collect()}["box"]
    assert q.ceiling_available and q.n_walls >= 4 and q.up_alignment > 0.99 and 0 < q.voxel_retention_ratio < 1 and q.closure_m >= 0
    assert batch["frames"].where("problem is not null").count() == 0 and batch["adjacency"].count() == 0


def test_truth_and_predictions_meet(spark, batch):
    rows = [("box", "lidar", "r", "ceiling_height", None, 2.5), ("box", "lidar", "r", "floor_area", None, 12.0), ("wide", "lidar", "s", "opening_width", "W01-O1", 0.9)]
    truth = spark.createDataFrame(rows, "capture_name string, tier string, room_id string, metric string, target_id string, value double")
    e = {(r.capture_name, r.metric): r.status for r in evaluate.evaluate(truth, documents.prediction_rows(batch)).collect()}
    assert e["box", "floor_area"] == "not_evaluated" and e["wide", "opening_width"] == "missing_prediction" and e["box", "ceiling_height"] in ("passed", "failed")


@pytest.mark.skipif(not os.environ.get("VOXELYARD_SLOW"), reason="two reconstructions and two measures: minutes")
def test_drift_is_judged(spark):
    """A steady capture has nothing to gain: whatever gate speaks, the correction is not accepted."""
    row = runs.drift_ablation(scenes.members(spark, {"still": scenes.rendered()}), "fast").first()
    assert not row.accepted and row.decision in ("unavailable", "no_baseline", "no_improvement", "walls_lost", "support_lost", "walls_worse", "points_lost", "inliers_lost")
