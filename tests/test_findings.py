"""Reviewers' findings: cases that failed before they were fixed."""

import itertools
import math
import random

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voxelyard.functions.columns import between
from voxelyard.operators import openings, register, resample
from voxelyard.plans import catalog


def bands(folder):
    """Events as walls of few points, and DuckDB over them."""
    rng = random.Random(7)
    rows = [(w, rng.randrange(97), round(rng.uniform(0, 300), 2)) for w in range(60) for _ in range(w + 5)]
    rows += [(60, 1, 5.0)] * 2 + [(60, 4 + i, 7.0) for i in range(46)]  # equal neighbours: 0.05 (1 - d) + 0.05 d is not 0.05
    frame = pd.DataFrame([(97 * i + e, w, v) for i, (w, e, v) in enumerate(rows)], columns=["event_id", "user_id", "value"])
    frame.to_parquet(folder / "events.parquet")
    c = duckdb.connect()
    c.register("events", frame)
    return c


def test_extents_follow_the_last_bit_of_quantile_cont(spark, tmp_path):
    """F5."""
    c = bands(tmp_path)
    want = {r[0]: r[1:] for r in c.execute(f"WITH {catalog.BAND}, {catalog.SIZES} SELECT wall, start_m, end_m, height_m, n_band, bins FROM sized").fetchall()}
    got = openings.extents(catalog._band(spark, str(tmp_path)), ["wall"]).collect()
    assert {r["wall"]: (r["start_m"], r["end_m"], r["height_m"], r["n_band"], r["bins"]) for r in got} == want


def test_extents_of_odd_walls(spark):
    rows = [(None, 1.0, 2.0), (None, 3.0, 4.0), ("none", None, None), ("some", None, 1.0), ("some", 2.0, None)]
    got = {r["wall"]: r for r in openings.extents(spark.createDataFrame(rows, "wall string, along double, h double"), ["wall"]).collect()}
    assert got[None]["n_band"] == 2 and abs(got[None]["end_m"] - 2.98) < 1e-12
    assert (got["none"]["start_m"], got["none"]["height_m"], got["none"]["n_band"]) == (None, None, 1)
    assert (got["some"]["start_m"], got["some"]["height_m"], got["some"]["n_band"]) == (2.0, 1.0, 2)
    large = spark.range(1).select(between(F.lit(1e308), F.lit(1.1e308), F.lit(0.01))).first()[0]
    assert abs(large / 1.001e308 - 1) < 1e-12


def test_band_profile_where_an_end_is_one_bit_off(spark, tmp_path):
    """an end of a wall one bit off drops its first points and moves its bins."""
    c = bands(tmp_path)
    got = [tuple(r) for r in catalog.QUERIES["wall_band_profile"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=lambda r: r[:2]) == sorted(c.execute(catalog.SQL["wall_band_profile"]).fetchall(), key=lambda r: r[:2])


def test_band_profile_of_walls_without_key_or_height(spark, tmp_path):
    """they had rows without a void, or with one from nowhere to 0, where the SQL has none."""
    rows = [(i, 1, i * 37 % 211 / 2) for i in range(60)] + [(i, None, i / 3) for i in range(30)] + [(i, 3, None) for i in range(20)] + [(i, 4, None if i % 3 else i * 1.1) for i in range(40)]
    spark.createDataFrame(rows, "event_id long, user_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES["wall_band_profile"](spark, str(tmp_path)).collect()]
    assert {r[0] for r in got} == {1, 4}
    assert sorted(got, key=lambda r: r[:2]) == sorted(c.execute(catalog.SQL["wall_band_profile"]).fetchall(), key=lambda r: r[:2])


def test_draws_are_not_broadcast(spark):
    """a table that grows with the input went to the driver and to every executor."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2500, "a").otherwise("b").alias("g"), "id", (F.col("id") % 11).cast("double").alias("v"), (F.col("id") * 2).alias("w"))
    got = resample.draws(rows, ["g"], ["id"], ["v", "w"], 3, 29)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ShuffledHashJoin" in plan
    want = []
    for g, first, n in (("a", 0, 2500), ("b", 2500, 500)):
        for rep in range(3):
            places = [(1103515245 * ((rep * 1000003 + i * 7 + 5) % 2**31) + 12345) % 2**31 % n for i in range(n)]
            want += [(g, rep, float((first + at) % 11), 2 * (first + at)) for at in places]
    assert sorted(map(tuple, got.select("g", "rep", "v", "w").collect())) == sorted(want)


def test_stitching_tries_every_pair_of_walls_both_ways(spark):
    """one call of pandas a room and twenty of numpy a hypothesis; the best of all is the same as tried one by one."""
    rng = np.random.default_rng(5)
    rooms = {k: rng.uniform(-3, 3, (2 + k, 4)).round(1) for k in range(5)}
    moved = {k: np.roll(w, k, 0) + [0.4, -0.1, 0.5, -0.1] for k, w in rooms.items()}
    frame = lambda walls: spark.createDataFrame([(k, f"w{i}", *map(float, x)) for k, w in walls.items() for i, x in enumerate(w)], "room long, wall_id string, x1 double, y1 double, x2 double, y2 double")
    got = register.auto_stitch(frame(rooms), frame(moved), ["room"])
    assert "InPandas" not in got._jdf.queryExecution().executedPlan().toString()
    got = {r["room"]: r for r in got.collect()}
    for k, p in rooms.items():
        q = moved[k]
        (ta, ma, la), (tb, mb, lb) = ((np.arctan2(w[:, 3] - w[:, 1], w[:, 2] - w[:, 0]), (w[:, :2] + w[:, 2:]) / 2, np.hypot(*(w[:, 2:] - w[:, :2]).T)) for w in (p, q))
        best = None
        for i, j, turn in itertools.product(range(len(p)), range(len(q)), (0.0, math.pi)):
            theta = tb[j] - ta[i] + turn
            placed = (ma - ma[i]) @ np.array([[math.cos(theta), -math.sin(theta)], [math.sin(theta), math.cos(theta)]]).T + mb[j]
            found = []
            for x, y in itertools.product(range(len(p)), range(len(q))):
                d = abs(ta[x] + theta - tb[y]) % math.pi
                d, g, r = math.degrees(min(d, math.pi - d)), math.hypot(*(placed[x] - mb[y])), abs(la[x] - lb[y]) / max(la[x], lb[y])
                if d <= 12 and g <= 0.75 and r <= 0.3:
                    found.append(((d / 12 + g / 0.75 + r / 0.3) / 3, x, y))
            kept = []
            for e in sorted(found):
                if not any(e[1] == o[1] or e[2] == o[2] for o in kept):
                    kept.append(e)
            rank = kept and (len(kept), round(sum(la[x] for _, x, _ in kept), 9), -round(sum(e[0] for e in kept) / len(kept), 9))
            if kept and (best is None or rank > best[0]):
                best = (rank, kept)
        assert [(f"w{x}", f"w{y}") for _, x, y in best[1]] == [(e["a"], e["b"]) for e in got[k]["pairs"]]
        assert abs(got[k]["score"] + best[0][2]) < 1e-8
