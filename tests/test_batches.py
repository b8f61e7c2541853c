"""Batches with damaged parts, folders given in any way, and what a run says about itself."""

import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import scenes
from voxelyard import cli
from voxelyard.config import Intervals, Reconstruction, Structure
from voxelyard.operators import capabilities, evaluate, grid, intervals, openings, project, register, runs, validate
from voxelyard.sources import capture as cap
from voxelyard.sources import documents, png
from voxelyard.streaming.voxels import fuse_into, read_fused

TINY = Reconstruction(10, 1, 0.08, 5, intrinsics_width=4, intrinsics_height=3)


def test_bad_frames_and_archives_fail_alone(spark, tmp_path):
    good = scenes.tiny_capture(n=7)
    broken = dict(good) | {"depth/000001.png": b"no image", "confidence/000004.png": png.encode(np.full((4, 4), 2, np.uint8))}
    body = bytearray(scenes.archive(good))
    with zipfile.ZipFile(io.BytesIO(bytes(body))) as z:
        at = z.getinfo("root/depth/000003.png")
        body[at.header_offset + 30 + len(at.filename) + 5] ^= 0xFF
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in good.items():
            z.writestr(f"root/{name}", content)
    flipped = bytearray(packed.getvalue())
    with zipfile.ZipFile(io.BytesIO(bytes(flipped))) as z:
        at = z.getinfo("root/odometry.csv")
        flipped[at.header_offset + 30 + len(at.filename) + 2] ^= 0xFF
    (tmp_path / "stored.zip").write_bytes(bytes(body))
    (tmp_path / "deflated.zip").write_bytes(bytes(flipped))
    (tmp_path / "whole.zip").write_bytes(scenes.archive(good))
    members = cap.read_archives(spark, str(tmp_path)).unionByName(scenes.members(spark, {"broken": broken, "good": good}))
    _, summary = validate.validate(members)
    valid = {r.capture_id: r.valid for r in summary.collect()}
    assert valid == {"stored": False, "deflated": False, "whole": True, "broken": True, "good": True}
    got = runs.reconstruct(members, TINY, only=summary.where("valid"))
    counts = {r.capture_id: (r.frames, r.skipped, r.sampled) for r in got.counts.collect()}
    assert counts == {"whole": (7, 0, 84), "good": (7, 0, 84), "broken": (7, 2, 60)}
    skipped = {(r.capture_id, r.frame_id): r.problem for r in got.frames.where("problem is not null").collect()}
    assert set(skipped) == {("broken", "000001"), ("broken", "000004")} and "differ in size" in skipped["broken", "000004"]
    assert {r.capture_id for r in got.points.select("capture_id").distinct().collect()} == {"whole", "good", "broken"}


def test_links_in_archives_are_refused(spark, tmp_path):
    out = io.BytesIO(scenes.archive(scenes.tiny_capture()))
    with zipfile.ZipFile(out, "a") as z:
        link = zipfile.ZipInfo("root/depth/link.png")
        link.external_attr = 0o120777 << 16
        z.writestr(link, "/etc/passwd")
    (tmp_path / "link.zip").write_bytes(out.getvalue())
    issues, _ = validate.validate(cap.read_archives(spark, str(tmp_path)))
    assert any(r.code == "capture_open_failed" and "symbolic link" in r.message for r in issues.collect())


@pytest.mark.parametrize("name", ["scans (1)", "a[1].b", "plain"])
def test_paths_are_taken_as_they_are(spark, tmp_path, name):
    files = scenes.tiny_capture()
    one = tmp_path / name / "first"
    for member, body in files.items():
        (one / member).parent.mkdir(parents=True, exist_ok=True)
        (one / member).write_bytes(body)
    (tmp_path / name / "second.zip").write_bytes(scenes.archive(files))
    ids = lambda path: {r.capture_id: r.n for r in cli._members(spark, str(path)).groupBy("capture_id").agg(F.count("*").alias("n")).collect()}
    assert ids(tmp_path / name) == {"first": len(files), "second": len(files)}
    assert ids(one) == {"first": len(files)} and ids(tmp_path / name / "second.zip") == {"second": len(files)}
    _, summary = validate.validate(cli._members(spark, str(one)))
    assert summary.first().valid


def test_captures_that_share_a_name_are_an_error(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "Scan.zip").write_bytes(scenes.archive(scenes.tiny_capture()))
    with pytest.raises(ValueError, match="share a name"):
        cli._members(spark, str(tmp_path))
    assert cli._members(spark, str(tmp_path / "x")).select("capture_id").distinct().count() == 1


def test_strict_index_raises(spark):
    good = scenes.members(spark, {"good": scenes.tiny_capture()})
    assert validate.require_valid(good).count() == 3
    bad = scenes.members(spark, {"good": scenes.tiny_capture(), "bad": {"readme.txt": b"x"}})
    with pytest.raises(Exception, match="bad"):
        validate.require_valid(bad).collect()


def laid(spark, points, captures=("a",)):
    """A room's points on the floor: x, z and height as fx, fy, h."""
    return spark.createDataFrame([(c, float(x), float(z), float(y)) for c in captures for x, y, z in points], "capture_id string, fx double, fy double, h double")


LINES = [("W01", 0.0, -1.0, 2.0), ("W02", 1.0, 0.0, 3.0), ("W03", 0.0, 1.0, 2.0), ("W04", -1.0, 0.0, 3.0)]


@pytest.fixture(scope="module")
def studied(spark):
    room = laid(spark, scenes.room_with_openings(points=12_000))
    walls = spark.createDataFrame([("a", *w) for w in LINES], "capture_id string, wall_id string, nx double, ny double, offset double")
    ground = room.where("abs(h) <= 0.03").selectExpr("capture_id", "fx as x", "fy as y")
    config = Structure()
    cells = grid.trimmed_centres(ground, config.grid_size_m, ["capture_id"], config.trim_percentile).persist()
    ceilings = spark.createDataFrame([("a", 2.5)], "capture_id string, ceiling_height double")
    return room.persist(), walls, cells, ceilings, openings.study(room, walls, cells, ceilings, ["capture_id"], config)


def test_opening_status(spark, studied):
    room, walls, cells, ceilings, got = studied
    s = got.status.first()
    assert (s.status, s.reason, s.n_walls) == ("available", None, 4) and s.n_openings == 2 and s.n_candidates >= 2
    status = lambda r, w, c: openings.study(r, w, cells, c, ["capture_id"]).status.first().reason
    assert "no wall" in status(room, walls.where("false"), ceilings)
    assert "too few points" in status(room.limit(20), walls, ceilings)
    low = spark.createDataFrame([("a", 0.1)], "capture_id string, ceiling_height double")
    assert "too little height" in status(room, walls, low)
    far = walls.withColumn("offset", F.col("offset") + 50)
    assert "scanned along" in status(room, far, ceilings)


def test_bootstrap_opening_widths(studied):
    room, walls, cells, ceilings, got = studied
    config = Intervals(resamples=10, minimum_successes=6)
    widths = intervals.opening_widths(room, walls, cells, ceilings, ["capture_id"], config)
    out = {r.opening_id: r for r in intervals.width_intervals(widths, got.openings, ["capture_id"], config).collect()}
    assert len(out) == 2
    for r in out.values():
        assert r.n_samples >= 6 and r.low <= r.high and abs(r.low - r.value) < 0.1 and abs(r.high - r.value) < 0.1
    strict = Intervals(resamples=10, minimum_successes=11)
    assert all(r.low is None for r in intervals.width_intervals(widths, got.openings, ["capture_id"], strict).collect())


def test_capabilities(spark, studied):
    *_, ceilings, got = studied
    ids = spark.createDataFrame([("a",), ("b",)], "capture_id string")
    rows = capabilities.capabilities(ids, ceilings, got.status, got.adjacency).orderBy("capture_id", "place").collect()
    assert len(rows) == 36 and [r.capability for r in rows[:18]] == [c for c, *_ in capabilities.CAPABILITIES]
    of = {(r.capture_id, r.capability): (r.status, r.explanation) for r in rows}
    assert all(s and e for s, e in of.values())
    assert of["a", "opening_detection"][0] == "supported_with_limitations" and of["b", "opening_detection"][0] == "not_evaluated"
    assert "no ceiling" in of["b", "ceiling_measurement"][1] and "no ceiling" not in of["a", "ceiling_measurement"][1]


def test_a_full_wall_looks_no_further(spark):
    rng = np.random.default_rng(5)
    holes = [(1.0 + 1.6 * i, 1.8 + 1.6 * i, -1, 2.1) for i in range(9)]
    parts = [scenes.wall_points(rng, (0, 0), (16, 0), 2.5, 30_000, holes), scenes.floor_points(0, 16, 0, 3), scenes.floor_points(0, 16, -1.5, 0)]
    room = laid(spark, np.concatenate(parts))
    walls = spark.createDataFrame([("a", "W01", 0.0, 1.0, 0.0)], "capture_id string, wall_id string, nx double, ny double, offset double")
    ground = room.where("abs(h) <= 0.03").selectExpr("capture_id", "fx as x", "fy as y")
    cells = grid.trimmed_centres(ground, 0.1, ["capture_id"], 0.5)
    found, rejected = openings.analyse(room, walls, cells, None)
    ids = sorted(r.opening_id for r in found.collect())
    if len(ids) == 6:  # the cap speaks before any other reason, for each run after the sixth opening
        last = max(r.right_m for r in found.collect())
        late = [r for r in rejected.collect() if r.run_start is not None and r.run_start * 0.05 > last]
        assert late and {r.reason for r in late} == {"the wall has its full number of openings"}
    assert ids == [f"W01-O{i}" for i in range(1, len(ids) + 1)] and len(ids) <= 6


def test_components_end_when_nothing_changes(spark):
    path = [(x, 0) for x in range(600)] + [(599, y) for y in range(1, 300)]
    cells = spark.createDataFrame([("a", x, y) for x, y in path], "capture_id string, cx long, cy long")
    got = grid.components(cells, ["capture_id"]).select("comp_x", "comp_y", "comp_size").distinct().collect()
    assert [tuple(r) for r in got] == [(0, 0, len(path))]


def test_guards_name_what_must_not_be_scored(spark):
    rows = [("a", "AB"), ("b", "cd"), ("../c", None), ("d", None), ("d", None), ("e", None)]
    captures = spark.createDataFrame(rows, "capture_name string, expected_input_sha256 string")
    hashes = spark.createDataFrame([("a", "ab"), ("b", "xx"), ("e", "yy")], "capture_name string, sha256 string")
    got = {r.capture_name: r.problem for r in evaluate.guarded(captures, hashes).collect()}
    assert got["a"] is None and got["e"] is None
    assert "not the one" in got["b"] and "plain name" in got["../c"] and "repeats" in got["d"]


def test_anchored_stitch_moves_walls_and_outline(spark, tmp_path):
    import json
    import math

    turn = lambda x, y: (math.cos(0.5) * x - math.sin(0.5) * y + 2, math.sin(0.5) * x + math.cos(0.5) * y - 1)
    points = [(0, 0), (4, 0), (4, 3)]
    (tmp_path / "anchors.json").write_text(json.dumps({"source": points, "target": [turn(*p) for p in points]}))
    anchors = documents.anchor_rows(documents.read_json(spark, str(tmp_path / "anchors.json"), documents.ANCHORS))
    walls = lambda f: spark.createDataFrame([("pair", w, *f(*a), *f(*b)) for w, a, b in (("W01", (0.0, 0.0), (4.0, 0.0)), ("W02", (4.0, 0.0), (4.0, 3.0)))], "pair string, wall_id string, x1 double, y1 double, x2 double, y2 double")
    transform, moved, matches = register.anchored_stitch(anchors, walls(lambda x, y: (x, y)), walls(turn), ["pair"])
    t = transform.first()
    assert abs(t.theta - 0.5) < 1e-9 and t.max_m < 1e-9 and t.problem is None and t.n == 3
    assert {(r.wall_id_a, r.wall_id_b) for r in matches.collect()} == {("W01", "W01"), ("W02", "W02")}
    outline = spark.createDataFrame([("pair", [{"x": 4.0, "y": 3.0}])], "pair string, vertices array<struct<x: double, y: double>>")
    v = register.moved_outline(outline, transform, ["pair"]).first().vertices[0]
    assert np.allclose([v.x, v.y], turn(4, 3))
    (tmp_path / "one.json").write_text(json.dumps({"source": [[0, 0]], "target": [[1, 1]]}))
    with pytest.raises(Exception, match="two or more"):
        documents.anchor_rows(documents.read_json(spark, str(tmp_path / "one.json"), documents.ANCHORS)).collect()


def test_tables_are_published_whole_or_not_at_all(spark, tmp_path):
    out = str(tmp_path / "out")
    good, bad = spark.range(3), spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        cli._save({"a": good, "b": bad}, out, False)
    assert not list(tmp_path.iterdir())
    cli._save({"a": good}, out, False)
    with pytest.raises(FileExistsError):
        cli._save({"a": good}, out, False)
    cli._save({"c": good}, out, True)
    assert spark.read.parquet(f"{out}/a").count() == spark.read.parquet(f"{out}/c").count() == 3 and len(list(tmp_path.iterdir())) == 1


def test_stream_into_tables(spark, tmp_path):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([("a", *map(float, p)) for p in rng.uniform(0, 1, (300, 3))], "capture_id string, x double, y double, z double")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    q = fuse_into(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), 0.25, str(tmp_path / "sums"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    key = lambda rows: sorted((r.vx, r.vy, r.vz, round(r.x, 9), round(r.y, 9), round(r.z, 9), r.n_points) for r in rows)
    assert key(read_fused(spark, str(tmp_path / "sums")).collect()) == key(project.voxel_fuse(df, 0.25).collect())
