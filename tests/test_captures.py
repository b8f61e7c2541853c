"""Sources, validation, reconstruction and outputs on captures made here."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import scenes
from voxelyard.config import PROFILES, Reconstruction
from voxelyard.operators import frames, project, runs, sinks, validate
from voxelyard.sources import capture as cap
from voxelyard.sources import png


def codes(spark, captures):
    issues, summary = validate.validate(scenes.members(spark, captures))
    return {(r.capture_id, r.severity, r.code) for r in issues.collect()}, {r.capture_id: r for r in summary.collect()}


@pytest.mark.parametrize("image", [np.arange(60, dtype=np.uint16).reshape(5, 12) * 1000, np.arange(60, dtype=np.uint8).reshape(12, 5), np.arange(90, dtype=np.uint8).reshape(5, 6, 3)])
def test_png_round_trip(image):
    assert (png.decode(png.encode(image)) == image).all()


def test_png_filters():
    import struct
    import zlib

    rng = np.random.default_rng(0)
    image = rng.integers(0, 65536, (5, 7)).astype(np.uint16)
    rows = image.astype(">u2").view(np.uint8).reshape(5, 14).astype(int)
    raw = b""
    for y, kind in enumerate((0, 1, 2, 3, 4)):
        up = rows[y - 1] if y else np.zeros(14, int)
        left = np.concatenate([[0, 0], rows[y][:-2]])
        corner = np.concatenate([[0, 0], up[:-2]])
        p = left + up - corner
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        guess = (np.zeros(14, int), left, up, (left + up) // 2, paeth)[kind]
        raw += bytes([kind]) + bytes(((rows[y] - guess) % 256).astype(np.uint8))
    head = struct.pack(">IIBBBBB", 7, 5, 16, 0, 0, 0, 0)
    data = png.SIGNATURE + png._chunk(b"IHDR", head) + png._chunk(b"IDAT", zlib.compress(raw)) + png._chunk(b"IEND", b"")
    assert (png.decode(data) == image).all()
    for bad in (b"no", data[:40], png.encode(image)[:-30]):
        with pytest.raises(ValueError):
            png.decode(bad)


def test_valid_capture_and_its_mutations(spark):
    good = scenes.tiny_capture()
    def without(*names, **more):
        return {k: v for k, v in good.items() if k not in names} | more
    odd = without("odometry.csv") | {"odometry.csv": good["odometry.csv"].replace(b"11, 000001", b"9, 000001").replace(b"0, 0, 0, 1, 100", b"0, 0, 0, 2, 100", 1)}
    twice = without("odometry.csv") | {"odometry.csv": good["odometry.csv"] + b"13, 000002, 0, 0, 0, 0, 0, 0, 1, 100, 100, 2, 1.5, , \n"}
    captures = {
        "good": good, "no_poses": without("odometry.csv"), "no_confidence": without("confidence/000001.png"), "no_imu": without("imu.csv", "rgb.mp4"),
        "matrix": without("camera_matrix.csv") | {"camera_matrix.csv": b"1,0\n0,1\n"}, "twice": twice, "odd": odd, "empty": without("depth/000000.png") | {"depth/000000.png": b""},
        "name": good | {"depth/abc.png": b"x"}, "broken": without("depth/000000.png") | {"depth/000000.png": b"no image"},
        "values": good | {"confidence/000000.png": png.encode(np.full((3, 4), 9, np.uint8))}, "mode": good | {"depth/000000.png": png.encode(np.full((3, 4), 9, np.uint8))},
        "sizes": good | {"depth/000000.png": png.encode(np.full((4, 4), 9, np.uint16))}, "escape": good | {"../escape.txt": b"x"}, "nothing": {"readme.txt": b"x"},
        "alias": good | {"depth/2.png": good["depth/000002.png"]},
    }
    got, summary = codes(spark, captures)
    want = {
        ("no_poses", "error", "missing_required_file"), ("no_poses", "error", "no_matched_frames"), ("no_confidence", "warning", "frames_missing_confidence"),
        ("no_imu", "warning", "imu_missing"), ("no_imu", "warning", "rgb_video_missing"), ("matrix", "error", "invalid_camera_matrix"), ("twice", "error", "invalid_odometry"),
        ("odd", "warning", "odometry_timestamp_order"), ("odd", "warning", "odometry_quaternion_norm"), ("empty", "error", "empty_frame_file"), ("name", "warning", "invalid_frame_filename"),
        ("broken", "error", "invalid_frame_image"), ("values", "error", "invalid_confidence_values"), ("mode", "error", "invalid_depth_mode"),
        ("sizes", "error", "inconsistent_depth_size"), ("sizes", "error", "depth_confidence_size_mismatch"), ("escape", "error", "capture_open_failed"),
        ("nothing", "error", "capture_open_failed"), ("alias", "error", "duplicate_frame_file"),
    }
    assert want <= got
    assert not [c for c in got if c[0] == "good"] and summary["good"].valid and summary["good"].n_matched == 3
    assert summary["no_confidence"].valid and summary["no_confidence"].n_matched == 2 and not summary["twice"].valid


def test_sources_read_folders_and_archives(spark, tmp_path):
    files = scenes.tiny_capture()
    for name, body in files.items():
        p = tmp_path / "in" / "one" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(body)
    (tmp_path / "in" / "two.zip").write_bytes(scenes.archive(files))
    (tmp_path / "in" / "bad.zip").write_bytes(b"no archive")
    a = cap.read_folders(spark, str(tmp_path / "in"))
    b = cap.read_archives(spark, str(tmp_path / "in"))
    assert {r.capture_id for r in a.select("capture_id").distinct().collect()} == {"one"}
    both = a.unionByName(b)
    _, summary = validate.validate(both)
    got = {r.capture_id: r.valid for r in summary.collect()}
    assert got == {"one": True, "two": True, "bad": False}
    assert len({r.sha256 for r in cap.capture_hashes(b).collect()}) == 1


def test_reconstruction_counts_and_places(spark):
    m = scenes.members(spark, {"a": scenes.tiny_capture(), "b": scenes.tiny_capture(n=2, confidence=lambda i: 0)})
    got = runs.reconstruct(m, Reconstruction(10, 1, 0.08, 5, intrinsics_width=4, intrinsics_height=3))
    pts = got.points.where("capture_id = 'a'").collect()
    assert len(pts) == 36 and got.points.where("capture_id = 'b'").count() == 0
    first = [p for p in pts if p.frame_id == "000000"]
    assert abs(min(p.x for p in first) - (0 - 2) / 100) < 1e-6 and {round(p.z, 3) for p in first} == {1.0}
    assert {round(p.x - q.x, 3) for p, q in zip(sorted((p for p in pts if p.frame_id == "000001"), key=lambda p: (p.y, p.x)), sorted(first, key=lambda p: (p.y, p.x)))} <= {1.0, 0.999, 0.98, 0.981, 0.99, 1.001}
    counts = {r.capture_id: (r.sampled, r.valid) for r in got.counts.collect()}
    assert counts == {"a": (36, 36), "b": (24, 0)}


def test_small_exact_vectors(spark):
    d = spark.createDataFrame([(0,), (250,), (1000,), (5000,)], "mm int").select(project.depth_metres("mm").alias("z")).collect()
    assert np.allclose([r.z for r in d], [0, 0.25, 1, 5])
    rows = [(0.1, 2), (0.5, 0), (2.0, 1), (6.0, 2), (float("nan"), 2)]
    ok = spark.createDataFrame(rows, "z float, c int").select(project.depth_gate("z", "c").alias("ok")).collect()
    assert [r.ok for r in ok] == [False, False, True, False, False]
    k = project.scaled_intrinsics(spark.createDataFrame([(1600.0, 1500.0, 960.0, 720.0)], "fx double, fy double, cx double, cy double"), 256, 192).first()
    assert np.allclose([k.fx, k.fy, k.cx, k.cy], [213.3333333, 200, 128, 96])
    v = project.voxel_fuse(spark.createDataFrame([(0.01, 0.01, 0.01), (0.03, 0.01, 0.01), (0.21, 0.0, 0.0)], "x double, y double, z double"), 0.1, []).orderBy("vx").collect()
    assert len(v) == 2 and np.allclose([v[0].x, v[0].y, v[0].z], [0.02, 0.01, 0.01]) and v[0].n_points == 2
    q = spark.createDataFrame([(0.0, 0.7071067811865476, 0.0, 0.7071067811865476)], "qx double, qy double, qz double, qw double")
    r = project.with_rotation(q).first()
    assert np.allclose([[r[f"r{i}{j}"] for j in range(3)] for i in range(3)], [[0, 0, 1], [0, 1, 0], [-1, 0, 0]])


def test_keyframes_round_halves_to_even(spark):
    f = spark.createDataFrame([("a", i) for i in range(5)], "capture_id string, frame_id int")
    assert sorted(r.frame_id for r in frames.keyframes(f, 3).collect()) == [0, 2, 4]
    big = spark.createDataFrame([("a", i) for i in range(1000)], "capture_id string, frame_id int")
    for m in (1, 2, 7, 333, 999):
        want = {0} if m == 1 else {round(k * 999 / (m - 1)) for k in range(m)}
        assert {r.frame_id for r in frames.keyframes(big, m).collect()} == want


def test_voxel_fold_has_the_same_voxels(spark):
    rng = np.random.default_rng(4)
    p = spark.createDataFrame([("a", int(i % 3), *map(float, rng.uniform(0, 1, 3))) for i in range(600)], "capture_id string, batch int, x double, y double, z double")
    keys = lambda df: {(r.vx, r.vy, r.vz) for r in project.voxel_fuse(df, 0.2).collect()}
    assert keys(project.voxel_fold(p, 0.2, "batch")) == keys(p)
    one = project.voxel_fuse(p, 0.2).collect()
    assert all(r.vx * 0.2 <= r.x <= (r.vx + 1) * 0.2 for r in one)


def test_outputs(tmp_path):
    p = np.random.default_rng(0).normal(size=(20, 3)).astype(np.float32)
    assert (sinks.read_ply(sinks.ply(p)) == p).all() and np.allclose(sinks.read_ply(sinks.ply(p, True)), p)
    with pytest.raises(ValueError):
        sinks.ply(np.array([[0, np.nan, 0]]))
    svg = sinks.plan_svg([(0, 0), (4, 0), (4, 3), (0, 3)], "a <room>")
    assert "4.00 m" in svg and "&lt;room&gt;" in svg
    assert "unavailable" in sinks.report("t", {"s": [{"a": None, "b": 1.5}], "none": []})
    sinks.publish({"a.txt": "x", "b.bin": b"y"}, tmp_path / "out")
    (tmp_path / "out" / "other").write_text("stays")
    with pytest.raises(FileExistsError):
        sinks.publish({"a.txt": "z", "c": "n"}, tmp_path / "out")
    assert not (tmp_path / "out" / "c").exists()
    sinks.publish({"a.txt": "z"}, tmp_path / "out", overwrite=True)
    assert (tmp_path / "out" / "a.txt").read_text() == "z" and (tmp_path / "out" / "other").exists()
    image = png.decode(sinks.topdown_png([(0, 0, 1.0), (3, 3, 2.0)], 4))
    assert image[3, 0] < 255 and image[0, 3] == 0


def test_output_names(spark):
    rows = spark.createDataFrame([("A b.zip",), ("a-b",), ("..x..",), ("C",)], "name string")
    got = {r.name: (r.output, r.collides) for r in cap.output_names(rows).collect()}
    assert got == {"A b.zip": ("A-b", True), "a-b": ("a-b", True), "..x..": ("x", False), "C": ("C", False)}


def test_profiles():
    assert PROFILES["fast"].voxel_size_m == 0.04
    with pytest.raises(ValueError):
        Reconstruction(0)
