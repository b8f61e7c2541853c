"""Planes and lines: moments, robust fits, histogram peaks, floors, ceilings and walls."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxelyard.config import Structure
from voxelyard.functions.columns import cross, dot, finite, lcg, percentile
from voxelyard.operators.cut import cut


def classify(nx: Column, ny: Column, nz: Column, tolerance_deg: float = 15.0) -> Column:
    """horizontal, vertical or other, by the angle between the normal and up (y)."""
    up = F.abs(ny) / F.sqrt(nx * nx + ny * ny + nz * nz)
    t = math.radians(tolerance_deg)
    return F.when(up >= math.cos(t), "horizontal").when(up <= math.sin(t), "vertical").otherwise("other")


def moments(points: DataFrame, by: list[str], xyz: tuple = ("x", "y", "z")) -> DataFrame:
    """Count, means and population covariances: one aggregate with a partial step."""
    c = [F.col(n).cast("double") for n in xyz]
    pairs = [("xx", 0, 0), ("yy", 1, 1), ("zz", 2, 2), ("xy", 0, 1), ("xz", 0, 2), ("yz", 1, 2)]
    return points.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.avg(c[i]).alias(f"m{n}") for i, n in enumerate("xyz")],
        *[F.covar_pop(c[i], c[j]).alias(f"c{n}") for n, i, j in pairs],
    )


_NORMAL = "nx double, ny double, nz double, d double, rms double"


def total_least_squares(m: DataFrame) -> DataFrame:
    """The plane n.p + d = 0 of each row of moments, n.up >= 0, and the residual's RMS.

    An Arrow-batched function over one row a plane (never over points): a 3 x 3 eigenproblem.
    """
    def solve(frames):
        for f in frames:
            c = np.stack([f[k].to_numpy(float) for k in ("cxx", "cxy", "cxz", "cxy", "cyy", "cyz", "cxz", "cyz", "czz")], axis=1).reshape(-1, 3, 3)
            values, vectors = np.linalg.eigh(c)
            n = vectors[:, :, 0]
            n = np.where(n[:, 1:2] < 0, -n, n)
            mean = f[["mx", "my", "mz"]].to_numpy(float)
            yield f.assign(nx=n[:, 0], ny=n[:, 1], nz=n[:, 2], d=-(n * mean).sum(1), rms=np.sqrt(np.maximum(values[:, 0], 0)))

    schema = T.StructType([*m.schema.fields, *T._parse_datatype_string(_NORMAL).fields])
    return m.mapInPandas(solve, schema)


def line_fit(points: DataFrame, by: list[str], x: str = "x", y: str = "z") -> DataFrame:
    """Total least squares line of each group: its angle theta, mean, and RMS distance. Closed form."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    m = points.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(a).alias("mx"), F.avg(b).alias("my"),
        F.var_pop(a).alias("sxx"), F.var_pop(b).alias("syy"), F.covar_pop(a, b).alias("sxy"),
    )
    root = F.sqrt(F.pow(F.col("sxx") - F.col("syy"), 2) + 4 * F.pow("sxy", F.lit(2.0)))
    return m.select(
        *by, "n", "mx", "my", (0.5 * F.atan2(2 * F.col("sxy"), F.col("sxx") - F.col("syy"))).alias("theta"),
        F.sqrt(F.greatest((F.col("sxx") + F.col("syy") - root) / 2, F.lit(0.0))).alias("rms"),
    )


def histogram_peak(points: DataFrame, by: list[str], value: str, width: float = 0.04) -> DataFrame:
    """Per group: the fullest bin (the lowest of equals) of ceil(range / width) bins, and its count."""
    v = F.col(value).cast("double")
    r = points.groupBy(*by).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    r = r.withColumn("bins", F.greatest(F.ceil((F.col("hi") - F.col("lo")) / width), F.lit(1)).cast("long"))
    w = (F.col("hi") - F.col("lo")) / F.col("bins")
    at = F.when(w == 0, F.lit(0)).otherwise(F.least(F.floor((v - F.col("lo")) / w), F.col("bins") - 1)).cast("long")
    n = points.join(r, by).groupBy(*by, "lo", "hi", "bins", at.alias("bin")).agg(F.count("*").alias("n"))
    best = n.groupBy(*by, "lo", "hi", "bins").agg(F.max(F.struct("n", (-F.col("bin")).alias("minus"))).alias("best"))
    bin_ = -F.col("best.minus")
    return best.select(*by, bin_.alias("bin"), F.col("best.n").alias("n"), (F.col("lo") + (bin_ + 0.5) * (F.col("hi") - F.col("lo")) / F.col("bins")).alias("centre"))


def linspace_sample(points: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """At most `most` rows of each group, evenly spread in the order; adds rn (from 0) and m."""
    w = Window.partitionBy(*by)
    placed = points.withColumn("vy_rn", F.row_number().over(w.orderBy(*order)) - 1).withColumn("vy_n", F.count("*").over(w))
    m = F.least(F.col("vy_n"), F.lit(most))
    k = F.floor(F.col("vy_rn") * m / F.col("vy_n"))  # place rn is the first of its k
    first = (F.col("vy_rn") == 0) | (k > F.floor((F.col("vy_rn") - 1) * m / F.col("vy_n")))
    return placed.where(first).withColumns({"rn": k.cast("long"), "m": m.cast("long")}).drop("vy_rn", "vy_n")


def hypotheses(groups: DataFrame, by: list[str], iterations: int, seed: int) -> DataFrame:
    """groups (by, m): h and three distinct places i0, i1, i2 of 0 .. m - 1 for each iteration."""
    h = groups.where("m >= 3").select(*by, "m", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("h"))
    draw = lambda k: lcg(F.col("h").cast("long") * 7919 + seed * 104729 + k * 15485863)
    h = h.withColumn("i0", draw(1) % F.col("m"))
    h = h.withColumn("i1", (F.col("i0") + 1 + draw(2) % (F.col("m") - 1)) % F.col("m"))
    lo, hi = F.least("i0", "i1"), F.greatest("i0", "i1")
    third = draw(3) % (F.col("m") - 2)
    third = third + F.when(third >= lo, 1).otherwise(0)
    third = third + F.when(third >= hi, 1).otherwise(0)
    return h.withColumn("i2", third)


def ransac(points: DataFrame, by: list[str], order: list[str], iterations: int = 300, seed: int = 17, inlier: float = 0.05, most: int = 20_000, orientation: str | None = None, tolerance_deg: float = 15.0) -> DataFrame:
    """Per group: the plane of three sampled points with most inliers (the first of equals).

    points: x, y, z. Hypotheses meet the sample by an equi-join on the group; both sides are bounded
    by the iterations and the sample size, and the counts are aggregated before anything moves.
    """
    sample = linspace_sample(points.select(*by, *[F.col(c).cast("double").alias(c) for c in "xyz"]), by, order, most)
    h = hypotheses(sample.groupBy(*by).agg(F.max("m").alias("m")), by, iterations, seed)
    for k in range(3):
        p = sample.select(*by, F.col("rn").alias(f"i{k}"), *[F.col(c).alias(f"{c}{k}") for c in "xyz"])
        h = h.join(p, [*by, f"i{k}"])
    u = tuple(F.col(f"{c}1") - F.col(f"{c}0") for c in "xyz")
    v = tuple(F.col(f"{c}2") - F.col(f"{c}0") for c in "xyz")
    n = cross(u, v)
    h = h.withColumns({"ux": n[0], "uy": n[1], "uz": n[2]}).withColumn("len", F.sqrt(dot(("ux", "uy", "uz"), ("ux", "uy", "uz")))).where("len >= 1e-10")
    flip = F.when(F.col("uy") < 0, -1.0).otherwise(1.0) / F.col("len")
    h = h.select(*by, "h", *[(F.col(f"u{c}") * flip).alias(f"n{c}") for c in "xyz"], "x0", "y0", "z0")
    h = h.withColumn("d", -dot(("nx", "ny", "nz"), ("x0", "y0", "z0")))
    if orientation:
        h = h.where(classify(F.col("nx"), F.col("ny"), F.col("nz"), tolerance_deg) == orientation)
    h = h.select(*by, "h", "nx", "ny", "nz", "d")
    near = F.abs(dot(("nx", "ny", "nz"), ("x", "y", "z")) + F.col("d")) <= inlier
    counts = sample.select(*by, "x", "y", "z").join(h, by).groupBy(*by, "h", "nx", "ny", "nz", "d").agg(F.count_if(near).alias("inliers"))
    best = F.max_by(F.struct("nx", "ny", "nz", "d", "h", "inliers"), F.struct("inliers", (-F.col("h")).alias("minus")))
    return counts.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def refine(points: DataFrame, planes: DataFrame, by: list[str], inlier: float, rounds: int = 2) -> DataFrame:
    """Refits each plane to its inliers by total least squares, and again to the new inliers."""
    now = planes.select(*by, "nx", "ny", "nz", "d")
    for _ in range(rounds + 1):
        inside = points.join(now, by).where(F.abs(dot(("nx", "ny", "nz"), ("x", "y", "z")) + F.col("d")) <= inlier)
        now = cut(total_least_squares(moments(inside, by)).select(*by, "nx", "ny", "nz", "d"))
    return now


def inlier_statistics(points: DataFrame, planes: DataFrame, by: list[str], inlier: float) -> DataFrame:
    """Per plane: inliers, their share of the points, RMS residual, robust spans on the plane's own axes (span_x
    along world x laid on the plane, span_z across it), so that a tilted plane has its full extent."""
    far = dot(("nx", "ny", "nz"), ("x", "y", "z")) + F.col("d")
    k = F.col("nx")
    raw = (1 - k * F.col("nx"), -k * F.col("ny"), -k * F.col("nz"))
    length = F.greatest(F.sqrt(dot(raw, raw)), F.lit(1e-9))
    a = tuple(x / length for x in raw)
    n = (F.col("nx"), F.col("ny"), F.col("nz"))
    b = (a[1] * n[2] - a[2] * n[1], a[2] * n[0] - a[0] * n[2], a[0] * n[1] - a[1] * n[0])
    place = (F.col("x"), F.col("y"), F.col("z"))
    met = points.join(planes, by).withColumn("vy_far", far).withColumn("vy_in", F.abs("vy_far") <= inlier)
    met = met.withColumns({"vy_x": dot(a, place), "vy_z": dot(b, place)})
    v = lambda c: F.when(F.col("vy_in"), F.col(f"vy_{c}").cast("double"))
    return met.groupBy(*by, "nx", "ny", "nz", "d").agg(
        F.count_if("vy_in").alias("inliers"), F.avg(F.col("vy_in").cast("double")).alias("inlier_ratio"),
        F.sqrt(F.avg(F.when(F.col("vy_in"), F.col("vy_far") * F.col("vy_far")))).alias("rmse_m"),
        *[(F.percentile(v(c), F.lit(0.99)) - F.percentile(v(c), F.lit(0.01))).alias(f"span_{c}") for c in "xz"],
    )


def robust_span(points: DataFrame, by: list[str], value: str) -> DataFrame:
    """99th percentile less the 1st."""
    return points.groupBy(*by).agg((percentile(value, 0.99) - percentile(value, 0.01)).alias("span"), F.count("*").alias("n"))


def _horizontal(points: DataFrame, window: Column, by: list[str], config: Structure, seed: int) -> DataFrame:
    """Seeds on the fullest bin of heights in the window, then fits; one row for each group found."""
    candidates = cut(points.where(window).select(*by, "x", "y", "z"))
    peak = histogram_peak(candidates, by, "y", config.histogram_bin_m).select(*by, "centre")
    seeded = candidates.join(peak, by).where(F.abs(F.col("y") - F.col("centre")) <= config.seed_half_band_m).select(*by, "x", "y", "z")
    sample = cut(linspace_sample(seeded, by, ["x", "y", "z"], config.ransac_sample).select(*by, "x", "y", "z"))
    found = cut(ransac(sample, by, ["x", "y", "z"], config.ransac_iterations, seed, config.plane_inlier_m, config.ransac_sample, "horizontal", config.angle_tolerance_deg))
    planes = refine(candidates, found, by, config.plane_inlier_m)
    planes = planes.where(classify(F.col("nx"), F.col("ny"), F.col("nz"), config.angle_tolerance_deg) == "horizontal")
    return inlier_statistics(candidates, planes, by, config.plane_inlier_m)


def detect_floor(points: DataFrame, trajectory: DataFrame, by: list[str] = ["capture_id"], config: Structure = Structure()) -> DataFrame:
    """Per capture: the floor, below the median camera height. Captures without one have no row."""
    camera = trajectory.groupBy(*by).agg(F.median("y").alias("camera_y"))
    lo, hi = config.floor_below_camera_m
    below = (F.col("y") <= F.col("camera_y") - lo) & (F.col("y") >= F.col("camera_y") - hi)
    found = _horizontal(points.where(finite("x", "y", "z")).join(camera, by), below, by, config, config.ransac_seed)
    ok = (F.col("inliers") >= config.minimum_plane_inliers) & (F.greatest("span_x", "span_z") >= config.minimum_plane_span_m)
    return found.where(ok).withColumn("height", -F.col("d") / F.col("ny"))


def detect_ceiling(points: DataFrame, floors: DataFrame, by: list[str] = ["capture_id"], config: Structure = Structure()) -> DataFrame:
    """Per capture: the ceiling, if one passes the stricter gates; ceiling_height above the floor."""
    base = floors.select(*by, *[F.col(c).alias(f"f{c}") for c in ("nx", "ny", "nz", "d")])
    above = dot(("fnx", "fny", "fnz"), ("x", "y", "z")) + F.col("fd")
    lo, hi = config.ceiling_above_floor_m
    whole = points.where(finite("x", "y", "z"))
    found = _horizontal(whole.join(base, by), (above >= lo) & (above <= hi), by, config, config.ransac_seed + 1)
    total = whole.groupBy(*by).agg(F.count("*").alias("total"))
    least = F.greatest(F.lit(config.minimum_plane_inliers), F.lit(config.ceiling_minimum_inliers), F.col("total") * config.ceiling_minimum_ratio)
    met = found.join(total, by).join(base, by)
    ok = (F.col("inliers") >= least) & (F.greatest("span_x", "span_z") >= config.ceiling_minimum_span_m)
    return met.where(ok).withColumn("ceiling_height", -F.col("d") / F.col("ny") + F.col("fd") / F.col("fny")).drop("fnx", "fny", "fnz", "fd", "total")


def floor_frame(floors: DataFrame) -> DataFrame:
    """Adds the floor's axes: ax (world x laid on the plane) and az = ax x up."""
    k = F.col("nx")
    raw = (1 - k * F.col("nx"), -k * F.col("ny"), -k * F.col("nz"))
    length = F.sqrt(dot(raw, raw))
    f = floors.withColumns({f"ax{c}": v / length for c, v in zip("xyz", raw)})
    z = cross(("axx", "axy", "axz"), ("nx", "ny", "nz"))
    return f.withColumns({f"az{c}": v for c, v in zip("xyz", z)})


def on_floor(points: DataFrame, frames: DataFrame, by: list[str], origin: tuple = ("ox", "oy", "oz")) -> DataFrame:
    """Adds fx, fy (floor coordinates) and h (height above the floor) to each point."""
    o = tuple(F.col(c) - F.col(b) for c, b in zip("xyz", origin))
    met = points.join(frames, by)
    return met.withColumns({
        "fx": dot(o, ("axx", "axy", "axz")), "fy": dot(o, ("azx", "azy", "azz")),
        "h": dot(("nx", "ny", "nz"), ("x", "y", "z")) + F.col("d"),
    })


def canonical(theta: Column) -> tuple[Column, Column]:
    """The unit normal of a line at angle theta, with its first component positive, or zero and the
    second not negative."""
    a, b = -F.sin(theta), F.cos(theta)
    flip = F.when((a < 0) | ((a == 0) & (b < 0)), -1.0).otherwise(1.0)
    return a * flip, b * flip


def duplicate_walls(walls: DataFrame, by: list[str], rank: str, angle_deg: float = 10.0, offset_m: float = 0.15) -> DataFrame:
    """Pairs (rank_a < rank_b) of walls of one capture that are the same wall.

    walls: a few for each capture (at most maximum_walls), joined on the capture.
    """
    a = walls.select(*by, *[F.col(c).alias(f"{c}_a") for c in (rank, "nx", "nz", "offset")])
    b = walls.select(*by, *[F.col(c).alias(f"{c}_b") for c in (rank, "nx", "nz", "offset")])
    d = F.col("nx_a") * F.col("nx_b") + F.col("nz_a") * F.col("nz_b")
    aligned = F.when(d < 0, -F.col("offset_b")).otherwise(F.col("offset_b"))
    same = (F.abs(d) >= math.cos(math.radians(angle_deg))) & (F.abs(F.col("offset_a") - aligned) <= offset_m)
    return a.join(b, by).where((F.col(f"{rank}_a") < F.col(f"{rank}_b")) & same).select(*by, f"{rank}_a", f"{rank}_b")


def peel_walls(frame: pd.DataFrame, config: Structure) -> list[dict]:
    """The walls of one capture's points (columns x, z, h), found and removed one by one.

    Hypotheses come from the portable generator that ransac uses, stepped twice with the high bits
    folded in between, so that the two places of a hypothesis don't move in step.
    """
    def draw(turn: int, kind: int, m: int) -> np.ndarray:
        step = lambda x: (1103515245 * (x % 2147483648) + 12345) % 2147483648
        x = step(np.arange(config.ransac_iterations) * 7919 + (config.ransac_seed + 100 + turn) * 104729 + kind * 15485863)
        return (step(x ^ (x >> 13)) >> 7) % m

    turn = 0
    frame = frame.sort_values(["x", "z", "h"])
    xz, h = frame[["x", "z"]].to_numpy(float), frame["h"].to_numpy(float)
    alive = np.flatnonzero(h > config.wall_clearance_m)
    total, least = len(xz), max(20, config.minimum_plane_inliers // 4, int(config.wall_minimum_ratio * len(xz)))
    walls: list[dict] = []
    misses = 0
    while len(walls) < config.maximum_walls and misses < 4 * config.maximum_walls and len(alive) >= max(least, 3):
        at = alive[np.linspace(0, len(alive) - 1, min(len(alive), config.ransac_sample)).astype(int)]
        p = xz[at]
        i, j = draw(turn, 1, len(p)), draw(turn, 2, len(p))
        turn += 1
        v = p[j] - p[i]
        length = np.hypot(v[:, 0], v[:, 1])
        good = length > 0.05
        if not good.any():
            break
        n = np.stack([-v[good, 1], v[good, 0]], 1) / length[good, None]
        c = (n * p[i[good]]).sum(1)
        best, score = -1, -1
        for k in range(len(n)):
            s = int((np.abs(p @ n[k] - c[k]) <= config.wall_inlier_m).sum())
            if s > score:
                best, score = k, s
        if score * len(alive) / len(p) < least:
            break
        inside = alive[np.abs(xz[alive] @ n[best] - c[best]) <= config.wall_inlier_m]
        q = xz[inside]
        mean = q.mean(0)
        (sxx, sxy), (_, syy) = np.cov(q.T, bias=True)
        theta = 0.5 * math.atan2(2 * sxy, sxx - syy)
        normal = np.array([-math.sin(theta), math.cos(theta)])
        if normal[0] < 0 or (normal[0] == 0 and normal[1] < 0):
            normal = -normal
        offset = float(normal @ mean)
        mask = np.abs(xz[alive] @ normal - offset) <= config.wall_inlier_m
        inside = alive[mask]
        along = xz[inside] @ np.array([-normal[1], normal[0]])
        lo, hi = np.percentile(along, [1, 99]) if len(along) else (0.0, 0.0)
        low, high = np.percentile(h[inside], [1, 99]) if len(inside) else (0.0, 0.0)
        ok = hi - lo >= config.wall_minimum_span_m and high - low >= config.wall_minimum_height_m
        for w in walls:
            d = normal[0] * w["nx"] + normal[1] * w["nz"]
            if abs(d) >= math.cos(math.radians(config.wall_duplicate_angle_deg)) and abs(offset - math.copysign(1, d) * w["offset"]) <= config.wall_duplicate_offset_m:
                ok = False
        if ok:
            rms = float(np.sqrt(np.mean(np.square(xz[inside] @ normal - offset))))
            walls.append({
                "nx": float(normal[0]), "nz": float(normal[1]), "offset": offset, "inliers": len(inside),
                "inlier_ratio": len(inside) / total, "rmse_m": rms, "length_m": float(hi - lo), "height_m": float(high - low),
                "start_m": float(lo), "end_m": float(hi),
            })
        else:
            misses += 1
        alive = alive[~mask] if mask.any() else alive[np.abs(xz[alive] @ n[best] - c[best]) > config.wall_inlier_m]
    walls.sort(key=lambda w: (-w["inliers"], w["offset"]))
    return walls


WALLS = "wall_no int, nx double, nz double, offset double, inliers long, inlier_ratio double, rmse_m double, length_m double, height_m double, start_m double, end_m double"


def detect_walls(points: DataFrame, by: list[str] = ["capture_id"], config: Structure = Structure()) -> DataFrame:
    """points: x, z (plan) and h (height above the floor). One row for each wall, best first.

    Peeling is sequential, so each capture is one grouped-map task; a fused cloud has the size of
    its voxels, which bounds it.
    """
    keys = [points.schema[c] for c in by]
    schema = T.StructType([*keys, *T._parse_datatype_string(WALLS).fields])

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [{**{c: frame[c].iloc[0] for c in by}, "wall_no": i, **w} for i, w in enumerate(peel_walls(frame, config))]
        return pd.DataFrame(rows, columns=schema.names)

    return points.select(*by, "x", "z", "h").groupBy(*by).applyInPandas(one, schema)
