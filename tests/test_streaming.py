import json

import numpy as np

from voxelyard.operators.project import voxel_fuse
from voxelyard.sources import documents
from voxelyard.streaming.voxels import frame_counts, fuse_stream


def test_streamed_fusion_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([("a", *map(float, p)) for p in rng.uniform(0, 1, (300, 3))], "capture_id string, x double, y double, z double")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    q = fuse_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), 0.25, "fused", str(tmp_path / "ck"))
    q.processAllAvailable()
    key = lambda rows: sorted((r.vx, r.vy, r.vz, round(r.x, 9), round(r.y, 9), round(r.z, 9), r.n_points) for r in rows)
    got = key(spark.table("fused").collect())
    q.stop()
    assert got == key(voxel_fuse(df, 0.25).collect())


def test_windowed_counts(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 00:00:09"), ("a", "2024-01-01 00:00:11")], "capture_id string, t string").selectExpr("capture_id", "cast(t as timestamp) t")
    assert sorted(r.n_frames for r in frame_counts(df, "t").collect()) == [1, 2]


def test_documents(spark, tmp_path):
    truth = {
        "property_id": "p", "measurement_method": "laser",
        "rooms": [{"room_id": "r", "floor_area_m2": 12.0, "ceiling_height_m": None, "walls": [{"wall_id": "W01", "length_m": 4.0}], "openings": [{"opening_id": "W01-O1", "width_m": 0.9}]}],
        "captures": [{"capture_name": "a", "room_id": "r", "tier": "lidar", "repeatability_group": "g"}, {"capture_name": "b", "room_id": "r", "tier": "photo"}],
    }
    (tmp_path / "t.json").write_text(json.dumps(truth | {"surprise": 1}))
    t, g = documents.truth_rows(documents.read_json(spark, str(tmp_path / "t.json"), documents.TRUTH))
    assert {(r.capture_name, r.metric, r.target_id, r.value) for r in t.collect()} == {
        (c, *x) for c in "ab" for x in (("floor_area", None, 12.0), ("wall_length", "W01", 4.0), ("opening_width", "W01-O1", 0.9))
    }
    assert g.count() == 2
    assert [r.field for r in documents.unknown_fields(spark, str(tmp_path / "t.json"), set(truth)).collect()] == ["surprise"]
    eye = [[1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0], [0, 0, 0, 1.0]]
    moved = [[1.0, 0, 0, 1.0], *eye[1:]]
    m = {"camera_matrix": [[100.0, 0, 50], [0, 100.0, 50], [0, 0, 1.0]], "translation_unit": "metre", "views": [
        {"view_id": "v0", "world_from_camera": eye, "observations": {"a": [50.0, 50.0]}}, {"view_id": "v1", "world_from_camera": moved, "observations": {"a": [30.0, 50.0]}}]}
    (tmp_path / "m.json").write_text(json.dumps(m))
    from voxelyard.operators.register import triangulate

    p = triangulate(documents.observations(documents.read_json(spark, str(tmp_path / "m.json"), documents.MANIFEST)), ["track"]).first()
    assert np.allclose([p.x, p.y, p.z], [0, 0, 5])
