"""The query catalogue: each operator applied to the driver's tables, and its SQL counterpart.

A query without SQL applies an operator whose result SQL can't express (grouped kernels).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelyard.config import Drift, Intervals, Reconstruction, Structure
from voxelyard.functions.columns import rounded
from voxelyard.operators import capabilities, drift, evaluate, frames, grid, media, openings, planes, polygon, project, register, resample
from voxelyard.plans import lens
from voxelyard.sources import capture as cap

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Registers a query under its function's name; views are the lens CTEs that its SQL reads."""
    def register_(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = ("WITH RECURSIVE " + ", ".join(views) + (", " if sql.lstrip().startswith("+") else " ") + sql.lstrip().removeprefix("+")) if views else sql
        return f

    return register_


def r(*names: str, digits: int = 6) -> list:
    return [rounded(n, digits).alias(n) for n in names]


K = (203.7, 211.3, 128.0, 96.0)  # fx, fy, cx, cy of the lens' camera
LENS = Reconstruction(pixel_stride=4)

# ---- frames


@query("""+ d AS (SELECT DISTINCT frame FROM depth_px), c AS (SELECT DISTINCT frame FROM depth_px WHERE confidence > 0), p AS (SELECT DISTINCT frame FROM pose),
    a AS (SELECT frame FROM d UNION SELECT frame FROM c UNION SELECT frame FROM p),
    f AS (SELECT a.frame, d.frame IS NOT NULL AS hd, c.frame IS NOT NULL AS hc, p.frame IS NOT NULL AS hp FROM a LEFT JOIN d USING (frame) LEFT JOIN c USING (frame) LEFT JOIN p USING (frame))
    SELECT CAST(frame % 8 AS BIGINT) AS part, count(*) FILTER (hd) AS n_depth, count(*) FILTER (hc) AS n_confidence, count(*) FILTER (hp) AS n_pose, count(*) FILTER (hd AND hc AND hp) AS n_matched,
           count(*) FILTER (NOT hd) AS missing_depth, count(*) FILTER (NOT hc) AS missing_confidence, count(*) FILTER (NOT hp) AS missing_pose FROM f GROUP BY 1""", lens.DEPTH_PX, lens.POSE)
def frame_match_inventory(spark: SparkSession, sf: str) -> DataFrame:
    part = lambda df: df.select((F.col("frame") % 8).alias("part"), "frame")
    d = lens.depth_px(spark, sf)
    return frames.match_summary(part(d), part(d.where("confidence > 0")), part(lens.pose(spark, sf)), ["part", "frame"], ["part"])


@query("""SELECT o_orderkey AS frame FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def frames_missing_pose_anti(spark: SparkSession, sf: str) -> DataFrame:
    return frames.missing_from(lens.pose(spark, sf).select("frame"), lens.depth_px(spark, sf), ["frame"])


@query("""+ o AS (SELECT capture, frame, row_number() OVER (PARTITION BY capture ORDER BY frame) - 1 AS p, count(*) OVER (PARTITION BY capture) AS n FROM pose),
    k AS (SELECT DISTINCT capture, CAST(round_even(CAST(k AS DOUBLE) * (n - 1) / 199, 0) AS BIGINT) AS p FROM (SELECT DISTINCT capture, n FROM o) , range(200) t(k))
    SELECT o.capture, o.frame FROM o LEFT JOIN k USING (capture, p) WHERE o.n <= 200 OR k.p IS NOT NULL""", lens.POSE)
def keyframes_even(spark: SparkSession, sf: str) -> DataFrame:
    return frames.keyframes(lens.pose(spark, sf).select("capture", "frame"), 200, ["capture"], "frame")


@query("""+ o AS (SELECT capture, frame, row_number() OVER (PARTITION BY capture ORDER BY frame) AS p FROM pose) SELECT capture, frame FROM o WHERE p <= 50""", lens.POSE)
def keyframes_contiguous(spark: SparkSession, sf: str) -> DataFrame:
    return frames.contiguous(lens.pose(spark, sf).select("capture", "frame"), 50, ["capture"], "frame")


@query("""+ l AS (SELECT capture, v < lag(v) OVER (PARTITION BY capture ORDER BY event_id) AS back FROM traj)
    SELECT capture, count(*) FILTER (back) AS violations, count(*) AS n_rows FROM l GROUP BY capture""", lens.TRAJ)
def odometry_order_violations(spark: SparkSession, sf: str) -> DataFrame:
    return frames.order_violations(lens.traj(spark, sf), ["capture"], "event_id", "v")


@query("""SELECT capture, count(*) FILTER (abs(sqrt(qx*qx + qy*qy + qz*qz + qw*qw) - 1) > 0.05) AS violations, count(*) AS n_rows FROM pose GROUP BY capture""", lens.POSE)
def quaternion_norm_violations(spark: SparkSession, sf: str) -> DataFrame:
    return frames.norm_violations(lens.pose(spark, sf), ("qx", "qy", "qz", "qw"), ["capture"])


@query("""SELECT frame % 16 AS part, count(*) AS n_frames, round(min(u), 6) AS first_s, round(max(u), 6) AS last_s, round(max(u) - min(u), 6) AS duration_s,
    CASE WHEN min(confidence) = max(confidence) THEN min(confidence) END AS width, CASE WHEN min(v) = max(v) THEN min(v) END AS height
    FROM (SELECT frame, CAST(u AS DOUBLE) AS u, v, confidence FROM depth_px) GROUP BY 1""", lens.DEPTH_PX)
def capture_inventory(spark: SparkSession, sf: str) -> DataFrame:
    d = lens.depth_px(spark, sf).withColumns({"part": F.col("frame") % 16, "u": F.col("u").cast("double")})
    return frames.inventory(d, ["part"], "u", "confidence", "v").select("part", "n_frames", *r("first_s", "last_s", "duration_s"), "width", "height")


@query("""+ k AS (SELECT DISTINCT capture, frame FROM pose), n AS (SELECT capture, frame, row_number() OVER (PARTITION BY capture ORDER BY frame) AS p, count(*) OVER (PARTITION BY capture) AS n FROM k)
    SELECT capture, string_agg(CAST(frame AS VARCHAR), ', ' ORDER BY frame) || CASE WHEN max(n) > 10 THEN ', ...' ELSE '' END AS ids FROM n WHERE p <= 10 GROUP BY capture""", lens.POSE)
def bounded_id_list(spark: SparkSession, sf: str) -> DataFrame:
    return frames.bounded_ids(lens.pose(spark, sf), ["capture"], "frame")


@query("""+ s AS (SELECT capture, event_id, x, y, z, sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2) + pow(z - lag(z) OVER w, 2)) AS step FROM traj WINDOW w AS (PARTITION BY capture ORDER BY event_id))
    SELECT capture, round(coalesce(sum(step), 0), 4) AS path_m, round(sqrt(pow(arg_max(x, event_id) - arg_min(x, event_id), 2) + pow(arg_max(y, event_id) - arg_min(y, event_id), 2) + pow(arg_max(z, event_id) - arg_min(z, event_id), 2)), 4) AS end_distance_m,
    count(*) AS n_poses FROM s GROUP BY capture""", lens.TRAJ)
def trajectory_stats(spark: SparkSession, sf: str) -> DataFrame:
    t = frames.trajectory(lens.traj(spark, sf), ["capture"], ["event_id"], ("x", "y", "z"))
    return t.select("capture", *r("path_m", "end_distance_m", digits=4), "n_poses")


# ---- projection and fusion

GATED = """, gated AS (
    SELECT *, CAST(CAST(depth_mm AS FLOAT) * CAST(0.001 AS FLOAT) AS FLOAT) AS depth_m FROM depth_px WHERE u % 4 = 0 AND v % 4 = 0),
valid AS (SELECT *, CAST(depth_m AS DOUBLE) AS zz FROM gated WHERE depth_m >= CAST(0.2 AS FLOAT) AND depth_m <= CAST(5 AS FLOAT) AND confidence >= 1),
camera AS (SELECT *, (u - 128.0) * zz / 203.7 AS xc, (v - 96.0) * zz / 211.3 AS yc, zz AS zc FROM valid)"""
WORLD = GATED + """, world AS (
    SELECT c.*, p.capture, p.ty, CAST((1 - 2 * (ny*ny + nz*nz)) * xc + 2 * (nx*ny - nz*nw) * yc + 2 * (nx*nz + ny*nw) * zc + tx AS DOUBLE) AS x,
           2 * (nx*ny + nz*nw) * xc + (1 - 2 * (nx*nx + nz*nz)) * yc + 2 * (ny*nz - nx*nw) * zc + p.ty AS y,
           2 * (nx*nz - ny*nw) * xc + 2 * (ny*nz + nx*nw) * yc + (1 - 2 * (nx*nx + ny*ny)) * zc + tz AS z
    FROM camera c JOIN (SELECT *, qx / n AS nx, qy / n AS ny, qz / n AS nz, qw / n AS nw FROM (SELECT *, sqrt(qx*qx + qy*qy + qz*qz + qw*qw) AS n FROM pose)) p USING (frame))"""


def _world(spark: SparkSession, sf: str) -> DataFrame:
    poses = lens.pose(spark, sf).withColumns({n: F.lit(v) for n, v in zip(("fx", "fy", "cx", "cy"), K)})
    return project.world_points(lens.depth_px(spark, sf), poses, LENS, ["frame"], single=False)


@query("""SELECT frame % 16 AS part, count(*) AS sampled, count(*) FILTER (z >= CAST(0.2 AS FLOAT) AND z <= CAST(5 AS FLOAT) AND confidence >= 1) AS valid
    FROM (SELECT *, CAST(CAST(depth_mm AS FLOAT) * CAST(0.001 AS FLOAT) AS FLOAT) AS z FROM depth_px WHERE u % 4 = 0 AND v % 4 = 0) GROUP BY 1""", lens.DEPTH_PX)
def depth_filter_counts(spark: SparkSession, sf: str) -> DataFrame:
    return project.pixel_counts(lens.depth_px(spark, sf).withColumn("part", F.col("frame") % 16), ["part"], LENS)


@query(GATED + " SELECT frame, u, v, depth_mm, round(xc, 6) + 0.0 AS xc, round(yc, 6) + 0.0 AS yc, round(zc, 6) + 0.0 AS zc FROM camera", lens.DEPTH_PX)
def backproject_points(spark: SparkSession, sf: str) -> DataFrame:
    d = lens.depth_px(spark, sf).where(project.on_stride("u", "v", 4)).withColumn("depth_m", project.depth_metres("depth_mm"))
    p = project.backproject(d.where(project.depth_gate("depth_m", "confidence", LENS)), k=K)
    return p.select("frame", "u", "v", "depth_mm", *r("xc", "yc", "zc"))


@query(WORLD + """ SELECT capture, round(min(x), 5) + 0.0 AS min_x, round(max(x), 5) + 0.0 AS max_x, round(min(y), 5) + 0.0 AS min_y, round(max(y), 5) + 0.0 AS max_y,
    round(min(z), 5) + 0.0 AS min_z, round(max(z), 5) + 0.0 AS max_z, count(*) AS n_points,
    greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) > 100 AS too_wide FROM world GROUP BY capture""", lens.DEPTH_PX, lens.POSE)
def world_points_bounds(spark: SparkSession, sf: str) -> DataFrame:
    b = project.bounds(_world(spark, sf), ["capture"])
    return b.select("capture", *r("min_x", "max_x", "min_y", "max_y", "min_z", "max_z", digits=5), "n_points", "too_wide")


@query("""+ p AS (SELECT CAST(floor((u - 128.0) * z / 203.7 / 0.08) AS BIGINT) AS vx, CAST(floor((v - 96.0) * z / 211.3 / 0.08) AS BIGINT) AS vy, CAST(floor(z / 0.08) AS BIGINT) AS vz,
        (u - 128.0) * z / 203.7 AS x, (v - 96.0) * z / 211.3 AS y, z FROM (SELECT u, v, confidence, depth_mm / CAST(1000 AS DOUBLE) AS z FROM depth_px) WHERE z >= 0.2 AND z <= 5 AND confidence >= 1)
    SELECT vx, vy, vz, round(avg(x), 9) + 0.0 AS x, round(avg(y), 9) + 0.0 AS y, round(avg(z), 9) + 0.0 AS z, count(*) AS n_points FROM p GROUP BY vx, vy, vz""", lens.DEPTH_PX)
def voxel_fuse(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: pixels of all frames to camera space, gated, and fused to 8 cm voxels."""
    d = lens.depth_px(spark, sf).withColumn("depth_m", F.col("depth_mm") / F.lit(1000.0)).where("depth_m >= 0.2D and depth_m <= 5D and confidence >= 1")
    p = project.backproject(d, k=K).select(F.col("xc").alias("x"), F.col("yc").alias("y"), F.col("zc").alias("z"))
    return project.voxel_fuse(p, 0.08, []).select("vx", "vy", "vz", *r("x", "y", "z", digits=9), "n_points")


@query(WORLD + """ SELECT capture, CAST(floor(x / 0.5) AS BIGINT) AS vx, CAST(floor(y / 0.5) AS BIGINT) AS vy, CAST(floor(z / 0.5) AS BIGINT) AS vz, round(avg(x), 5) + 0.0 AS x,
    round(avg(y), 5) + 0.0 AS y, round(avg(z), 5) + 0.0 AS z, count(*) AS n_points FROM world GROUP BY 1, 2, 3, 4""", lens.DEPTH_PX, lens.POSE)
def world_cloud(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels, poses, gates, projection, transform and fusion: the metric cloud of each capture."""
    return project.voxel_fuse(_world(spark, sf), 0.5, ["capture"]).select("capture", "vx", "vy", "vz", *r("x", "y", "z", digits=5), "n_points")


# the fold itself: the second batch's centroids re-enter with weight 1
@query("""+ b AS (SELECT x, y, z, vec_id % 2 AS batch FROM cloud),
    one AS (SELECT avg(x) AS x, avg(y) AS y, avg(z) AS z FROM b WHERE batch = 0 GROUP BY floor(x / 0.8), floor(y / 0.8), floor(z / 0.8)),
    two AS (SELECT CAST(CAST(x AS FLOAT) AS DOUBLE) AS x, CAST(CAST(y AS FLOAT) AS DOUBLE) AS y, CAST(CAST(z AS FLOAT) AS DOUBLE) AS z FROM one UNION ALL SELECT x, y, z FROM b WHERE batch = 1)
    SELECT CAST(floor(x / 0.8) AS BIGINT) AS vx, CAST(floor(y / 0.8) AS BIGINT) AS vy, CAST(floor(z / 0.8) AS BIGINT) AS vz, count(*) AS n_members FROM two GROUP BY 1, 2, 3""", lens.CLOUD)
def voxel_fold_members(spark: SparkSession, sf: str) -> DataFrame:
    c = lens.cloud(spark, sf).withColumn("batch", F.col("vec_id") % 2)
    first = project.voxel_fold(c.where("batch = 0"), 0.8, "batch", [], 1)
    two = first.select(*[F.col(a).cast("double") for a in "xyz"]).unionByName(c.where("batch = 1").select("x", "y", "z"))
    return project.voxel_fuse(two, 0.8, []).select("vx", "vy", "vz", F.col("n_points").alias("n_members"))


# ---- grids

G = 0.5
CELLS = f"cells AS (SELECT DISTINCT capture, CAST(floor(x / {G}) AS BIGINT) AS cx, CAST(floor(y / {G}) AS BIGINT) AS cy FROM cloud)"


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return grid.occupancy(lens.cloud(spark, sf), G, ["capture"])


@query("SELECT capture, cx, cy FROM cells", lens.CLOUD, CELLS)
def occupancy_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf)


@query("""SELECT a.capture, a.cx, a.cy, count(b.cx) AS n_near FROM cells a JOIN cells b ON a.capture = b.capture AND abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND (a.cx, a.cy) <> (b.cx, b.cy)
    GROUP BY ALL HAVING count(b.cx) >= 2""", lens.CLOUD, CELLS)
def cells_supported_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return grid.neighbour_counts(_cells(spark, sf), ["capture"]).where("n_near >= 2")


@query("""+ o AS (SELECT a.a, b.b FROM range(-1, 2) a(a), range(-1, 2) b(b)), d AS (SELECT DISTINCT capture, cx + a AS cx, cy + b AS cy FROM cells, o)
    SELECT d.capture, d.cx, d.cy FROM d, o JOIN d e ON e.capture = d.capture AND e.cx = d.cx + o.a AND e.cy = d.cy + o.b GROUP BY ALL HAVING count(*) = 9""".replace("FROM d, o JOIN d e ON", "FROM d CROSS JOIN o JOIN d e ON"), lens.CLOUD, CELLS)
def cells_closed(spark: SparkSession, sf: str) -> DataFrame:
    return grid.closed(_cells(spark, sf), ["capture"])


@query("""+ s(nx, ny, ax, ay, bx, by_) AS (VALUES (0, -1, 0, 0, 1, 0), (1, 0, 1, 0, 1, 1), (0, 1, 1, 1, 0, 1), (-1, 0, 0, 1, 0, 0))
    SELECT capture, cx + ax AS ax, cy + ay AS ay, cx + bx AS bx, cy + by_ AS "by" FROM cells c, s WHERE NOT EXISTS (SELECT 1 FROM cells o WHERE o.capture = c.capture AND o.cx = c.cx + s.nx AND o.cy = c.cy + s.ny)""", lens.CLOUD, CELLS)
def cells_boundary_edges(spark: SparkSession, sf: str) -> DataFrame:
    return grid.boundary_edges(_cells(spark, sf), ["capture"])


@query("""+ reach AS (SELECT capture, cx, cy, cx AS rx, cy AS ry FROM cells UNION SELECT q.capture, q.cx, q.cy, c.cx, c.cy FROM reach q JOIN cells c ON c.capture = q.capture AND abs(c.cx - q.rx) + abs(c.cy - q.ry) = 1),
    l AS (SELECT capture, cx, cy, min((rx, ry)) AS m, count(*) AS comp_size FROM reach GROUP BY capture, cx, cy)
    SELECT capture, cx, cy, m[1] AS comp_x, m[2] AS comp_y, comp_size FROM l""", lens.CLOUD, CELLS)
def cells_components(spark: SparkSession, sf: str) -> DataFrame:
    return grid.components(_cells(spark, sf), ["capture"])


@query("""+ q AS (SELECT capture, quantile_cont(x, 0.005) AS x0, quantile_cont(x, 0.995) AS x1, quantile_cont(y, 0.005) AS y0, quantile_cont(y, 0.995) AS y1 FROM cloud GROUP BY capture),
    c AS (SELECT DISTINCT capture, CAST(floor(x / 0.5) AS BIGINT) AS cx, CAST(floor(y / 0.5) AS BIGINT) AS cy FROM cloud JOIN q USING (capture) WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1),
    n AS (SELECT a.capture, a.cx, a.cy, count(b.cx) AS n FROM c a LEFT JOIN c b ON a.capture = b.capture AND abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND (a.cx, a.cy) <> (b.cx, b.cy) GROUP BY ALL)
    SELECT capture, cx, cy, (cx + 0.5) * CAST(0.5 AS DOUBLE) AS x, (cy + 0.5) * CAST(0.5 AS DOUBLE) AS y FROM (SELECT *, count(*) FILTER (n >= 2) OVER (PARTITION BY capture) AS kept FROM n) WHERE n >= 2 OR kept < 3""", lens.CLOUD)
def boundary_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    return grid.trimmed_centres(lens.cloud(spark, sf), G, ["capture"])


# ---- planes and lines


@query("""SELECT capture, count(*) AS n, round(avg(x), 6) + 0.0 AS mx, round(avg(y), 6) + 0.0 AS my, round(avg(z), 6) + 0.0 AS mz, round(covar_pop(x, x), 6) + 0.0 AS cxx, round(covar_pop(y, y), 6) + 0.0 AS cyy, round(covar_pop(z, z), 6) + 0.0 AS czz,
    round(covar_pop(x, y), 6) + 0.0 AS cxy, round(covar_pop(x, z), 6) + 0.0 AS cxz, round(covar_pop(y, z), 6) + 0.0 AS cyz FROM cloud GROUP BY capture""", lens.CLOUD)
def plane_moments(spark: SparkSession, sf: str) -> DataFrame:
    return planes.moments(lens.cloud(spark, sf), ["capture"]).select("capture", "n", *r("mx", "my", "mz", "cxx", "cyy", "czz", "cxy", "cxz", "cyz"))


@query()
def plane_least_squares(spark: SparkSession, sf: str) -> DataFrame:
    return planes.total_least_squares(planes.moments(lens.cloud(spark, sf), ["capture"])).select("capture", "n", "nx", "ny", "nz", "d", "rms")


@query("""SELECT vec_id, CASE WHEN abs(y) / sqrt(x*x + y*y + z*z) >= cos(radians(15)) THEN 'horizontal' WHEN abs(y) / sqrt(x*x + y*y + z*z) <= sin(radians(15)) THEN 'vertical' ELSE 'other' END AS kind FROM cloud""", lens.CLOUD)
def plane_classify(spark: SparkSession, sf: str) -> DataFrame:
    c = lens.cloud(spark, sf)
    return c.select("vec_id", planes.classify(F.col("x"), F.col("y"), F.col("z")).alias("kind"))


@query("""+ m AS (SELECT capture, count(*) AS n, avg(x) AS mx, avg(z) AS my, var_pop(x) AS sxx, var_pop(z) AS syy, covar_pop(x, z) AS sxy FROM cloud GROUP BY capture)
    SELECT capture, n, round(mx, 6) + 0.0 AS mx, round(my, 6) + 0.0 AS my, round(0.5 * atan2(2 * sxy, sxx - syy), 6) + 0.0 AS theta, round(sqrt(greatest((sxx + syy - sqrt(pow(sxx - syy, 2) + 4 * sxy * sxy)) / 2, 0)), 6) + 0.0 AS rms FROM m""", lens.CLOUD)
def line_tls(spark: SparkSession, sf: str) -> DataFrame:
    return planes.line_fit(lens.cloud(spark, sf), ["capture"]).select("capture", "n", *r("mx", "my", "theta", "rms"))


@query("""+ e AS (SELECT capture, min(y) AS lo, max(y) AS hi, greatest(CAST(ceil((max(y) - min(y)) / 0.25) AS BIGINT), 1) AS b FROM cloud GROUP BY capture),
    n AS (SELECT capture, lo, hi, b, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((y - lo) / ((hi - lo) / b)) AS BIGINT), b - 1) END AS bin, count(*) AS n FROM cloud JOIN e USING (capture) GROUP BY ALL),
    t AS (SELECT *, row_number() OVER (PARTITION BY capture ORDER BY n DESC, bin) AS k FROM n)
    SELECT capture, bin, n, round(lo + (bin + 0.5) * (hi - lo) / b, 6) + 0.0 AS centre FROM t WHERE k = 1""", lens.CLOUD)
def height_histogram_peak(spark: SparkSession, sf: str) -> DataFrame:
    return planes.histogram_peak(lens.cloud(spark, sf), ["capture"], "y", 0.25).select("capture", F.col("bin").cast("long").alias("bin"), "n", *r("centre"))


LCG = "((1103515245 * ((({}) % 2147483648 + 2147483648) % 2147483648) + 12345) % 2147483648)"


@query(f"""+ s AS (SELECT capture, x, y, z, row_number() OVER (PARTITION BY capture ORDER BY x, y, z) - 1 AS rn, count(*) OVER (PARTITION BY capture) AS m FROM cloud),
    h0 AS (SELECT capture, m, CAST(h AS BIGINT) AS h, {LCG.format('h * 7919 + 17 * 104729 + 15485863')} % m AS i0 FROM (SELECT DISTINCT capture, m FROM s), range(300) t(h)),
    h1 AS (SELECT *, (i0 + 1 + {LCG.format('h * 7919 + 17 * 104729 + 2 * 15485863')} % (m - 1)) % m AS i1, {LCG.format('h * 7919 + 17 * 104729 + 3 * 15485863')} % (m - 2) AS t0 FROM h0),
    h2 AS (SELECT *, t0 + CASE WHEN t0 >= least(i0, i1) THEN 1 ELSE 0 END AS t1 FROM h1), h3 AS (SELECT *, t1 + CASE WHEN t1 >= greatest(i0, i1) THEN 1 ELSE 0 END AS i2 FROM h2),
    g AS (SELECT h3.capture, h, a.x AS x0, a.y AS y0, a.z AS z0, b.x - a.x AS ux, b.y - a.y AS uy, b.z - a.z AS uz, c.x - a.x AS vx, c.y - a.y AS vy, c.z - a.z AS vz
        FROM h3 JOIN s a ON a.capture = h3.capture AND a.rn = i0 JOIN s b ON b.capture = h3.capture AND b.rn = i1 JOIN s c ON c.capture = h3.capture AND c.rn = i2),
    n AS (SELECT *, uy * vz - uz * vy AS a, uz * vx - ux * vz AS b, ux * vy - uy * vx AS c FROM g),
    p AS (SELECT capture, h, x0, y0, z0, a * f AS a, b * f AS b, c * f AS c FROM (SELECT *, CASE WHEN b < 0 THEN -1.0 ELSE 1.0 END / sqrt(a*a + b*b + c*c) AS f FROM n WHERE sqrt(a*a + b*b + c*c) >= 1e-10)),
    k AS (SELECT p.capture, h, count(*) FILTER (abs(a * s.x + b * s.y + c * s.z - (a * x0 + b * y0 + c * z0)) <= 0.3) AS inliers FROM p JOIN s USING (capture) GROUP BY ALL)
    SELECT capture, max(inliers) AS inliers, CAST(arg_max(h, (inliers, -h)) AS INTEGER) AS h FROM k GROUP BY capture""", lens.CLOUD)
def ransac_best_plane(spark: SparkSession, sf: str) -> DataFrame:
    return planes.ransac(lens.cloud(spark, sf), ["capture"], ["x", "y", "z"], 300, 17, 0.3).select("capture", "inliers", "h")


@query("""SELECT event_type, round(quantile_cont("value", 0.99) - quantile_cont("value", 0.01), 6) AS span, count(*) AS n FROM events GROUP BY event_type""")
def robust_span(spark: SparkSession, sf: str) -> DataFrame:
    return planes.robust_span(lens.table(spark, sf, "events"), ["event_type"], "value").select("event_type", *r("span"), "n")


@query("""+ f AS (SELECT capture, avg(x) AS ox, avg(y) AS oy, avg(z) AS oz, CAST(0.1 AS DOUBLE) AS nx, CAST(0.98 AS DOUBLE) AS ny, CAST(0.17 AS DOUBLE) AS nz FROM cloud GROUP BY capture),
    u AS (SELECT *, sqrt(pow(1 - nx * nx, 2) + pow(nx * ny, 2) + pow(nx * nz, 2)) AS l, -(nx * ox + ny * oy + nz * oz) AS d FROM f),
    a AS (SELECT *, (1 - nx * nx) / l AS axx, -nx * ny / l AS axy, -nx * nz / l AS axz FROM u),
    b AS (SELECT *, axy * nz - axz * ny AS azx, axz * nx - axx * nz AS azy, axx * ny - axy * nx AS azz FROM a)
    SELECT vec_id, round((x - ox) * axx + (y - oy) * axy + (z - oz) * axz, 6) + 0.0 AS fx, round((x - ox) * azx + (y - oy) * azy + (z - oz) * azz, 6) + 0.0 AS fy, round(nx * x + ny * y + nz * z + d, 6) + 0.0 AS h FROM cloud JOIN b USING (capture)""", lens.CLOUD)
def floor_projection(spark: SparkSession, sf: str) -> DataFrame:
    c = lens.cloud(spark, sf)
    f = c.groupBy("capture").agg(*[F.avg(a).alias(f"o{a}") for a in "xyz"]).withColumns({"nx": F.lit(0.1), "ny": F.lit(0.98), "nz": F.lit(0.17)})
    f = f.withColumn("d", -(F.col("nx") * F.col("ox") + F.col("ny") * F.col("oy") + F.col("nz") * F.col("oz")))
    return planes.on_floor(c, planes.floor_frame(f), ["capture"]).select("vec_id", *r("fx", "fy", "h"))


WALLS = """walls AS (SELECT o_custkey AS capture, frame AS rank, CASE WHEN qw < 0 OR (qw = 0 AND qy < 0) THEN -qw ELSE qw END / sqrt(qw*qw + qy*qy) AS nx, CASE WHEN qw < 0 OR (qw = 0 AND qy < 0) THEN -qy ELSE qy END / sqrt(qw*qw + qy*qy) AS nz, ty AS "offset"
    FROM pose JOIN orders ON o_orderkey = frame)"""


def _walls(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer is a room, each of its orders a wall."""
    n = F.sqrt(F.col("qw") * F.col("qw") + F.col("qy") * F.col("qy"))
    s = F.when((F.col("qw") < 0) | ((F.col("qw") == 0) & (F.col("qy") < 0)), -1.0).otherwise(1.0)
    room = lens.table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame"), F.col("o_custkey").alias("room"))
    return lens.pose(spark, sf).join(room, "frame").select(F.col("room").alias("capture"), F.col("frame").alias("rank"), (F.col("qw") * s / n).alias("nx"), (F.col("qy") * s / n).alias("nz"), F.col("ty").alias("offset"))


@query("""SELECT a.capture, a.rank AS rank_a, b.rank AS rank_b FROM walls a JOIN walls b ON a.capture = b.capture AND a.rank < b.rank
    WHERE abs(a.nx * b.nx + a.nz * b.nz) >= cos(radians(10)) AND abs(a."offset" - CASE WHEN a.nx * b.nx + a.nz * b.nz < 0 THEN -b."offset" ELSE b."offset" END) <= 0.15""", lens.POSE, WALLS)
def wall_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return planes.duplicate_walls(_walls(spark, sf), ["capture"], "rank")


@query("""+ o AS (SELECT capture, rank, row_number() OVER (PARTITION BY capture ORDER BY round(cos(2 * atan2(nz, nx)), 3), round(sin(2 * atan2(nz, nx)), 3), round("offset", 4), rank) AS k FROM walls)
    SELECT capture, rank AS wall_no, CASE WHEN k < 10 THEN 'W0' ELSE 'W' END || CAST(k AS VARCHAR) AS wall_id FROM o""", lens.POSE, WALLS)
def wall_identity(spark: SparkSession, sf: str) -> DataFrame:
    w = _walls(spark, sf).withColumnRenamed("rank", "wall_no")
    return openings.wall_ids(w, ["capture"], "nx", "nz").select("capture", "wall_no", "wall_id")


@query()
def wall_peel(spark: SparkSession, sf: str) -> DataFrame:
    c = lens.cloud(spark, sf).withColumn("h", F.col("y") + 4)
    return planes.detect_walls(c, ["capture"], Structure(minimum_plane_inliers=8, wall_minimum_span_m=0.2, wall_minimum_height_m=0.2, wall_inlier_m=0.3))


# ---- polygons

POLY = """poly AS (SELECT capture, event_id AS no, x, y FROM traj)"""


def _poly(spark: SparkSession, sf: str) -> DataFrame:
    return lens.traj(spark, sf).select("capture", F.col("event_id").alias("no"), "x", "y")


@query("""+ e AS (SELECT capture, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM poly WINDOW w AS (PARTITION BY capture ORDER BY no))
    SELECT capture, round(0.5 * sum(x * y2 - x2 * y), 3) + 0.0 AS area_m2, round(sum(sqrt(pow(x2 - x, 2) + pow(y2 - y, 2))), 3) + 0.0 AS perimeter_m, count(*) AS n_vertices FROM e GROUP BY capture""", lens.TRAJ, POLY)
def shoelace_perimeter(spark: SparkSession, sf: str) -> DataFrame:
    return polygon.measure(_poly(spark, sf), ["capture"]).select("capture", *r("area_m2", "perimeter_m", digits=3), "n_vertices")


RING = """ring AS (SELECT capture, vec_id AS no, x, y FROM cloud)"""


def _ring(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors of each label are the corners of a ring."""
    return lens.cloud(spark, sf).select("capture", F.col("vec_id").alias("no"), "x", "y")


@query("""+ e AS (SELECT capture, no, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM ring WINDOW w AS (PARTITION BY capture ORDER BY no)),
    t AS (SELECT capture, no, atan2(y2 - y, x2 - x) AS t FROM e WHERE x2 <> x OR y2 <> y),
    b AS (SELECT t.capture, t.no, t.t, max(p.x * cos(t.t) + p.y * sin(t.t)) - min(p.x * cos(t.t) + p.y * sin(t.t)) AS a, max(p.y * cos(t.t) - p.x * sin(t.t)) - min(p.y * cos(t.t) - p.x * sin(t.t)) AS b FROM t JOIN ring p USING (capture) GROUP BY t.capture, t.no, t.t),
    k AS (SELECT *, row_number() OVER (PARTITION BY capture ORDER BY round(a * b, 9), no) AS k, degrees(t) + CASE WHEN b > a THEN 90 ELSE 0 END + 90 AS g FROM b)
    SELECT capture, round(greatest(a, b), 5) AS length_m, round(least(a, b), 5) AS width_m, round(g - 180 * floor(g / 180) - 90, 4) + 0.0 AS angle_deg FROM k WHERE k = 1""", lens.CLOUD, RING)
def min_area_box(spark: SparkSession, sf: str) -> DataFrame:
    return polygon.minimum_box(_ring(spark, sf), ["capture"]).select("capture", *r("length_m", "width_m", digits=5), *r("angle_deg", digits=4))


@query("""+ e AS (SELECT capture, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY capture) AS m, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2 FROM ring WINDOW w AS (PARTITION BY capture ORDER BY no)),
    p AS (SELECT a.capture, sign((a.x2 - a.x) * (b.y - a.y) - (a.y2 - a.y) * (b.x - a.x)) * sign((a.x2 - a.x) * (b.y2 - a.y) - (a.y2 - a.y) * (b.x2 - a.x)) AS s,
        sign((b.x2 - b.x) * (a.y - b.y) - (b.y2 - b.y) * (a.x - b.x)) * sign((b.x2 - b.x) * (a.y2 - b.y) - (b.y2 - b.y) * (a.x2 - b.x)) AS t
        FROM e a JOIN e b ON a.capture = b.capture AND a.i < b.i - 1 AND NOT (a.i = 0 AND b.i = a.m - 1))
    SELECT capture, count(*) FILTER (s < 0 AND t < 0) AS crossings, count(*) AS pairs FROM p GROUP BY capture""", lens.CLOUD, RING)
def segment_intersections(spark: SparkSession, sf: str) -> DataFrame:
    ring = _ring(spark, sf).withColumn("no", F.row_number().over(Window.partitionBy("capture").orderBy("no")) - 1)
    return polygon.crossings(ring, ["capture"])


@query("""+ he AS (SELECT p.capture, p.x, p.y FROM cloud p JOIN cloud q ON q.capture = p.capture AND (q.x <> p.x OR q.y <> p.y)
        WHERE NOT EXISTS (SELECT 1 FROM cloud c WHERE c.capture = p.capture AND ((q.x - p.x) * (c.y - p.y) - (q.y - p.y) * (c.x - p.x) < 0
            OR ((q.x - p.x) * (c.y - p.y) - (q.y - p.y) * (c.x - p.x) = 0 AND pow(c.x - p.x, 2) + pow(c.y - p.y, 2) > pow(q.x - p.x, 2) + pow(q.y - p.y, 2))))),
    hv AS (SELECT DISTINCT capture, x, y FROM he), hs AS (SELECT capture, min((x, y)) AS s FROM hv GROUP BY capture)
    SELECT hv.capture, CAST(row_number() OVER (PARTITION BY hv.capture ORDER BY CASE WHEN x = s[1] AND y = s[2] THEN 0 ELSE 1 END, atan2(y - s[2], x - s[1])) - 1 AS INTEGER) AS no, x, y FROM hv JOIN hs USING (capture)""", lens.CLOUD)
def convex_outline(spark: SparkSession, sf: str) -> DataFrame:
    return polygon.hulls(lens.cloud(spark, sf), ["capture"])


@query()
def outline_select(spark: SparkSession, sf: str) -> DataFrame:
    c = grid.trimmed_centres(lens.cloud(spark, sf), 0.5, ["capture"])
    return polygon.outlines(c, ["capture"], Structure(grid_size_m=0.5, concave_simplify_m=0.6)).drop("vertices")


# ---- walls and openings

WALL = ["wall"]
SIZES = """sizes AS (SELECT wall, quantile_cont(along, 0.01) AS start_m, quantile_cont(along, 0.99) AS end_m, quantile_cont(h, 0.99) AS height_m, count(*) AS n_band FROM band GROUP BY wall),
    sized AS (SELECT *, greatest(CAST(round_even((end_m - start_m) / 0.05, 0) AS INTEGER), 1) AS bins FROM sizes)"""
BAND = """band AS (SELECT user_id AS wall, event_id % 97 / CAST(20 AS DOUBLE) AS along, "value" / 20.0 AS h FROM events)"""


def _band(spark: SparkSession, sf: str) -> DataFrame:
    e = lens.table(spark, sf, "events")
    return e.select(F.col("user_id").alias("wall"), (F.col("event_id") % 97 / F.lit(20.0)).alias("along"), (F.col("value") / F.lit(20.0)).alias("h"))


@query("+ " + SIZES + """ SELECT wall, round(start_m, 6) AS start_m, round(end_m, 6) AS end_m, round(height_m, 6) AS height_m, n_band, bins, round((end_m - start_m) / bins, 6) AS bin_m FROM sized""", BAND)
def wall_extents(spark: SparkSession, sf: str) -> DataFrame:
    return openings.extents(_band(spark, sf), WALL).select("wall", *r("start_m", "end_m", "height_m"), "n_band", "bins", *r("bin_m"))


@query("+ " + SIZES + """, p AS (SELECT wall, least(CAST(floor((along - start_m) / ((end_m - start_m) / bins)) AS INTEGER), bins - 1) AS bin, h FROM band JOIN sized USING (wall) WHERE along >= start_m AND along <= end_m),
    c AS (SELECT wall, bin, count(*) AS n, max(h) AS max_h FROM p GROUP BY wall, bin),
    f AS (SELECT wall, CAST(b AS INTEGER) AS bin, height_m FROM sized, unnest(range(bins)) t(b)),
    v AS (SELECT wall, bin, h FROM p JOIN sized USING (wall) WHERE h < height_m UNION ALL SELECT wall, bin, 0 FROM f UNION ALL SELECT wall, bin, height_m FROM f),
    g AS (SELECT wall, bin, h, lead(h) OVER (PARTITION BY wall, bin ORDER BY h) AS nxt FROM v),
    b AS (SELECT wall, bin, h AS void_low, nxt AS void_high, row_number() OVER (PARTITION BY wall, bin ORDER BY nxt - h DESC, h) AS k FROM g WHERE nxt IS NOT NULL)
    SELECT f.wall, f.bin, coalesce(n, 0) AS n, round(max_h, 6) AS max_h, coalesce(n, 0) >= 3 AND coalesce(max_h >= 0.45 * height_m, false) AS material, round(void_low, 6) + 0.0 AS void_low, round(void_high, 6) AS void_high,
        void_high - void_low >= 0.4 AS open_bin, coalesce(n, 0) > 0 AS observed FROM f LEFT JOIN c USING (wall, bin) JOIN b ON b.wall = f.wall AND b.bin = f.bin AND k = 1""", BAND)
def wall_band_profile(spark: SparkSession, sf: str) -> DataFrame:
    band = _band(spark, sf)
    sizes = openings.extents(band, WALL)
    size_of = sizes.select("wall", "start_m", "end_m", "bins", "bin_m", "height_m")
    p = openings.profile(band.join(size_of.withColumnRenamed("height_m", "vy_top"), WALL), size_of, WALL)
    return p.select("wall", "bin", "n", *r("max_h"), "material", *r("void_low", "void_high"), "open_bin", "observed")


@query("""+ v AS (SELECT wall, bin, h FROM wall_bins UNION ALL SELECT DISTINCT wall, bin, CAST(0 AS DOUBLE) FROM wall_bins UNION ALL SELECT DISTINCT wall, bin, CAST(50 AS DOUBLE) FROM wall_bins),
    g AS (SELECT wall, bin, h, lead(h) OVER (PARTITION BY wall, bin ORDER BY h) AS nxt FROM v), k AS (SELECT *, row_number() OVER (PARTITION BY wall, bin ORDER BY nxt - h DESC, h) AS k FROM g WHERE nxt IS NOT NULL)
    SELECT wall, bin, round(h, 6) + 0.0 AS void_low, round(nxt, 6) AS void_high FROM k WHERE k = 1""", lens.WALL_BINS)
def largest_void(spark: SparkSession, sf: str) -> DataFrame:
    w = lens.wall_bins(spark, sf)
    g = w.select("wall", "bin").distinct().withColumn("top", F.lit(50.0))
    return openings.largest_gap(w, ["wall", "bin"], "h", g, "top").select("wall", "bin", *r("void_low", "void_high"))


RUNS = """runs AS (SELECT wall, min(bin) AS run_start, max(bin) AS run_end, count(*) AS run_bins FROM (SELECT wall, bin, bin - row_number() OVER (PARTITION BY wall ORDER BY bin) AS i FROM bins) GROUP BY wall, i)"""


@query("SELECT wall, run_start, run_end, run_bins FROM runs", lens.BINS, RUNS)
def void_runs(spark: SparkSession, sf: str) -> DataFrame:
    return openings.runs(lens.bins(spark, sf), WALL)


ALL_BINS = """all_bins AS (SELECT wall, bin, max(o) AS open FROM (SELECT wall, bin, 1 AS o FROM bins UNION ALL SELECT wall, CAST(b AS BIGINT), 0 FROM (SELECT DISTINCT wall FROM bins), range(40) t(b)) GROUP BY wall, bin)"""


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    """Forty bins a wall: those with an event are open."""
    b = lens.bins(spark, sf)
    walls = b.select("wall").distinct().select("wall", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(39).cast("long"))).alias("bin"))
    every = b.withColumn("open", F.lit(1)).unionByName(walls.withColumn("open", F.lit(0))).groupBy("wall", "bin").agg(F.max("open").alias("open"))
    return every.withColumn("closed", F.col("open") == 0)


@query("""SELECT r.wall, run_start, run_end, run_bins, round(coalesce(avg(1 - b.open) FILTER (b.bin < run_start), 0), 6) AS left_support, round(coalesce(avg(1 - b.open) FILTER (b.bin > run_end), 0), 6) AS right_support
    FROM runs r LEFT JOIN all_bins b ON b.wall = r.wall AND (b.bin BETWEEN run_start - 4 AND run_start - 1 OR b.bin BETWEEN run_end + 1 AND run_end + 4) GROUP BY ALL""", lens.BINS, RUNS, ALL_BINS)
def void_flanks(spark: SparkSession, sf: str) -> DataFrame:
    f = openings.flanks(openings.runs(lens.bins(spark, sf), WALL), _profile(spark, sf), WALL)
    return f.select("wall", "run_start", "run_end", "run_bins", *r("left_support", "right_support"))


@query("""+ f AS (SELECT r.*, coalesce(avg(1 - b.open) FILTER (b.bin < run_start), 0) AS l, coalesce(avg(1 - b.open) FILTER (b.bin > run_end), 0) AS rr FROM runs r LEFT JOIN all_bins b ON b.wall = r.wall AND (b.bin BETWEEN run_start - 4 AND run_start - 1 OR b.bin BETWEEN run_end + 1 AND run_end + 4) GROUP BY ALL)
    SELECT wall, run_start, run_end, CASE WHEN run_start = 0 OR run_end = 39 THEN 'touches the end of the scanned wall' WHEN run_start < 4 OR 39 - run_end < 4 THEN 'too little wall beside the void' WHEN run_bins * 0.25 > 3 THEN 'wider than an opening can be'
        WHEN l < 0.75 OR rr < 0.75 THEN 'the flanking wall is fragmented' END AS reason FROM f""", lens.BINS, RUNS, ALL_BINS)
def void_rejections(spark: SparkSession, sf: str) -> DataFrame:
    f = openings.flanks(openings.runs(lens.bins(spark, sf), WALL), _profile(spark, sf), WALL)
    c = openings.reject_reason(F.col("run_start"), F.col("run_end"), F.lit(40), F.col("run_bins") * 0.25, F.col("left_support"), F.col("right_support"))
    return f.select("wall", "run_start", "run_end", c.alias("reason"))


VOIDS = """b0 AS (SELECT wall, bin, min(h) AS void_low, max(h) AS void_high FROM wall_bins GROUP BY wall, bin), ob AS (SELECT * FROM b0 WHERE void_high - void_low >= 8),
    vr AS (SELECT wall, min(bin) AS run_start, max(bin) AS run_end FROM (SELECT wall, bin, bin - row_number() OVER (PARTITION BY wall ORDER BY bin) AS i FROM ob) GROUP BY wall, i)"""


def _voids(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    b = lens.wall_bins(spark, sf).groupBy("wall", "bin").agg(F.min("h").alias("void_low"), F.max("h").alias("void_high")).withColumn("height_m", F.lit(60.0))
    return openings.runs(b.where("void_high - void_low >= 8"), WALL), b


@query("""+ c AS (SELECT vr.wall, run_start, run_end, max(void_low) AS sill_m, min(void_high) AS head_m FROM vr JOIN b0 ON b0.wall = vr.wall AND bin BETWEEN CASE WHEN run_end - run_start >= 2 THEN run_start + 1 ELSE run_start END AND CASE WHEN run_end - run_start >= 2 THEN run_end - 1 ELSE run_end END GROUP BY ALL)
    SELECT wall, run_start, run_end, round(sill_m, 6) AS sill_m, round(head_m, 6) AS head_m, round(head_m - sill_m, 6) AS void_m, CASE WHEN head_m - sill_m >= 0.4 THEN CASE WHEN sill_m <= 0.2 THEN CASE WHEN head_m - sill_m >= 1.5 THEN 'door_like' ELSE 'unclassified_gap' END
        WHEN sill_m >= 0.3 AND head_m < 60 - 0.12 THEN 'window_like' ELSE 'unclassified_gap' END END AS kind FROM c""", lens.WALL_BINS, VOIDS)
def void_classify(spark: SparkSession, sf: str) -> DataFrame:
    runs, b = _voids(spark, sf)
    return openings.classify(runs, b, WALL).select("wall", "run_start", "run_end", *r("sill_m", "head_m", "void_m"), "kind")


@query("""+ u AS (SELECT wall, run_start, run_end, run_start * CAST(0.5 AS DOUBLE) AS a, (run_end + 1) * CAST(0.5 AS DOUBLE) AS b FROM vr),
    m AS (SELECT u.*, max(along) FILTER (hit AND along <= a AND along >= a - 2) AS l, count(*) FILTER (hit AND along <= a AND along >= a - 2) AS nl, min(along) FILTER (hit AND along >= b AND along <= b + 2) AS r, count(*) FILTER (hit AND along >= b AND along <= b + 2) AS nr
        FROM u JOIN (SELECT user_id AS wall, event_id % 97 / CAST(10 AS DOUBLE) AS along, "value" / 20.0 BETWEEN 1.05 AND 7.95 AS hit FROM events) USING (wall) GROUP BY ALL),
    e AS (SELECT *, l + CAST(2 AS DOUBLE) / nl / 2 AS s, r - CAST(2 AS DOUBLE) / nr / 2 AS t FROM m)
    SELECT wall, run_start, run_end, round(CASE WHEN nl > 0 AND nr > 0 AND t > s THEN s ELSE a END, 6) AS left_m, round(CASE WHEN nl > 0 AND nr > 0 AND t > s THEN t ELSE b END, 6) AS right_m FROM e""", lens.WALL_BINS, VOIDS)
def void_edges(spark: SparkSession, sf: str) -> DataFrame:
    runs, _ = _voids(spark, sf)
    rows = runs.withColumns({"start_m": F.lit(0.0), "bin_m": F.lit(0.5), "sill_m": F.lit(1.0), "head_m": F.lit(8.0)})
    e = lens.table(spark, sf, "events").select(F.col("user_id").alias("wall"), (F.col("event_id") % 97 / F.lit(10.0)).alias("along"), (F.col("value") / F.lit(20.0)).alias("h"))
    return openings.refine_edges(rows, e, WALL).select("wall", "run_start", "run_end", *r("left_m", "right_m"))


WLINES = """lines AS (SELECT capture, CAST(w AS BIGINT) AS wall, cos(w * CAST(0.7 AS DOUBLE)) AS nx, sin(w * CAST(0.7 AS DOUBLE)) AS ny, CAST(0.1 AS DOUBLE) * w AS "offset", CAST(-2 AS DOUBLE) AS start_m, CAST(2 AS DOUBLE) AS end_m FROM (SELECT DISTINCT capture FROM cloud), range(4) t(w))"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Four lines through each label's cloud."""
    w = F.col("wall").cast("double")
    c = lens.cloud(spark, sf).select("capture").distinct().withColumn("wall", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    return c.withColumns({"nx": F.cos(w * 0.7), "ny": F.sin(w * 0.7), "offset": w * 0.1, "start_m": F.lit(-2.0), "end_m": F.lit(2.0)})


PROBES = """pr AS (SELECT l.*, s.s AS side, start_m + (end_m - start_m) * p / 20 AS pos FROM lines l, (VALUES (1), (-1)) s(s), range(21) t(p)),
    pc AS (SELECT *, CAST(floor((("offset" + side * 0.45) * nx - pos * ny) / 0.5) AS BIGINT) AS cx, CAST(floor((("offset" + side * 0.45) * ny + pos * nx) / 0.5) AS BIGINT) AS cy FROM pr),
    ph AS (SELECT pc.capture, wall, side, count(c.cx) / CAST(21 AS DOUBLE) AS support FROM pc LEFT JOIN cells c ON c.capture = pc.capture AND c.cx = pc.cx AND c.cy = pc.cy GROUP BY ALL)"""
WIDE = Structure(grid_size_m=0.5)


@query("SELECT capture, wall, round(support, 6) AS support FROM ph WHERE side = 1", lens.CLOUD, CELLS, WLINES, PROBES)
def floor_probe_support(spark: SparkSession, sf: str) -> DataFrame:
    return openings.floor_support(_lines(spark, sf), _cells(spark, sf), ["capture"], ["capture", "wall"], F.lit(1.0), WIDE).select("capture", "wall", *r("support"))


@query("SELECT capture, wall, CASE WHEN round(sum(support * side) * 21, 0) >= 0 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS inside FROM ph GROUP BY capture, wall", lens.CLOUD, CELLS, WLINES, PROBES)
def interior_side(spark: SparkSession, sf: str) -> DataFrame:
    return openings.interior_sign(_lines(spark, sf), _cells(spark, sf), ["capture"], ["capture", "wall"], WIDE)


@query("""SELECT l.capture, l.wall, count(*) FILTER (-(x * nx + y * ny - "offset") > 0.12 AND -(x * nx + y * ny - "offset") <= 1.12 AND y * nx - x * ny BETWEEN -1 AND 1 AND z BETWEEN -1 AND 2) AS pass_points FROM lines l JOIN cloud USING (capture) GROUP BY ALL""", lens.CLOUD, WLINES)
def pass_through(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).withColumns({"inside": F.lit(1.0), "left_m": F.lit(-1.0), "right_m": F.lit(1.0), "sill_m": F.lit(-1.0), "head_m": F.lit(2.0)})
    p = lens.cloud(spark, sf).select("capture", F.col("x").alias("fx"), F.col("y").alias("fy"), F.col("z").alias("h"))
    return openings.pass_through(rows, p, ["capture"], ["capture", "wall"])


@query("""+ a AS (SELECT wall, run_start, run_bins <= 2 AS ok, coalesce(sum(CASE WHEN run_bins <= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY wall ORDER BY run_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM runs)
    SELECT wall, run_start, before >= 6 AS capped, CASE WHEN ok AND before < 6 THEN 'W' || CAST(wall AS VARCHAR) || '-O' || CAST(CAST(before AS BIGINT) + 1 AS VARCHAR) END AS opening_id FROM a""", lens.BINS, RUNS)
def opening_cap(spark: SparkSession, sf: str) -> DataFrame:
    runs = openings.runs(lens.bins(spark, sf), WALL).withColumn("wall_id", F.concat(F.lit("W"), F.col("wall").cast("string")))
    return openings.capped(runs, WALL, "run_start", F.col("run_bins") <= 2).select("wall", "run_start", "capped", "opening_id")


@query("""SELECT vec_id, CASE WHEN x >= 1 AND y >= 0.85 AND z >= 0.8 AND capture % 3 <> 0 THEN 'high' WHEN x >= 0.75 AND y >= 0.5 AND capture % 3 <> 0 THEN 'medium' ELSE 'low' END AS confidence, z * 10 >= 10 OR y >= 0.5 AS published FROM cloud""", lens.CLOUD)
def opening_confidence(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("capture") % 3 == 0, "unclassified_gap").otherwise("door_like")
    c = openings.confidence(F.col("x"), F.col("x"), F.col("y"), F.col("z"), kind)
    return lens.cloud(spark, sf).select("vec_id", c.alias("confidence"), openings.published(F.col("z") * 10, F.col("y")).alias("published"))


@query()
def adjacency(spark: SparkSession, sf: str) -> DataFrame:
    config = Structure(grid_size_m=0.5, minimum_region_m2=1.0)
    areas = openings.side_areas(_cells(spark, sf), _lines(spark, sf).drop("start_m", "end_m"), ["capture"], ["capture", "wall"], config)
    rows = _lines(spark, sf).withColumnsRenamed({"start_m": "left_m", "end_m": "right_m"})
    return openings.adjacency(rows, areas, ["capture", "wall"], ["capture", "wall"], (0.9, 1.4), config)


CAPABLE = ", ".join(f"({i}, '{n}', {'NULL' if s is None else repr(s)})" for i, (n, s, _) in enumerate(capabilities.CAPABILITIES, 1))


@query(f"""+ cp AS (SELECT DISTINCT capture FROM cloud), ca(place, capability, fixed) AS (VALUES {CAPABLE})
    SELECT capture, CAST(place AS INTEGER) AS place, capability, CASE WHEN capability IN ('wall_identity', 'opening_detection') THEN CASE WHEN capture % 3 <> 0 THEN 'supported_with_limitations' ELSE 'not_evaluated' END
        WHEN capability = 'room_adjacency' THEN CASE WHEN capture % 4 = 0 THEN 'supported_with_limitations' ELSE 'not_evaluated' END ELSE fixed END AS status FROM cp CROSS JOIN ca""", lens.CLOUD)
def capability_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Captures by number: every third without openings, every fourth with adjacent regions, every second with a ceiling."""
    c = lens.cloud(spark, sf).select("capture").distinct()
    ready = F.when(F.col("capture") % 3 != 0, "available").otherwise("unavailable")
    status = c.select("capture", ready.alias("status"), F.lit(None).cast("string").alias("reason"), *[F.lit(2).alias(n) for n in ("n_walls", "n_candidates", "n_openings", "n_rejections")])
    got = capabilities.capabilities(c, c.where("capture % 2 = 0"), status, c.where("capture % 4 = 0"), ["capture"])
    return got.select("capture", "place", "capability", "status")


# ---- drift and intervals

FLOOR = "CAST(0 AS DOUBLE) AS nx, CAST(1 AS DOUBLE) AS ny, CAST(0 AS DOUBLE) AS nz"


def _plane(df: DataFrame, d: float) -> DataFrame:
    return df.select("capture").distinct().withColumns({"nx": F.lit(0.0), "ny": F.lit(1.0), "nz": F.lit(0.0), "d": F.lit(d)})


@query(WORLD + """ SELECT capture, frame % 64 AS part, round(avg(y - 1.5), 5) + 0.0 AS residual_m, count(*) AS n_points FROM world WHERE abs(y - 1.5) <= 1.0 GROUP BY 1, 2 HAVING count(*) >= 2""", lens.DEPTH_PX, lens.POSE)
def frame_residuals(spark: SparkSession, sf: str) -> DataFrame:
    w = _world(spark, sf).withColumn("part", F.col("frame") % 64)
    out = drift.frame_residuals(w, _plane(lens.pose(spark, sf), -1.5), ["capture"], "part", Drift(band_m=1.0, minimum_frame_points=2))
    return out.select("capture", "part", *r("residual_m", digits=5), "n_points")


SMOOTH = """n AS (SELECT capture, event_id, v, row_number() OVER (PARTITION BY capture ORDER BY event_id) - 1 AS p, count(*) OVER (PARTITION BY capture) AS n FROM traj),
    pad AS (SELECT capture, p, v FROM n UNION ALL SELECT a.capture, -b.p, 2 * a.v - b.v FROM n a JOIN n b ON a.capture = b.capture AND a.p = 0 AND b.p BETWEEN 1 AND 4
        UNION ALL SELECT a.capture, 2 * (a.n - 1) - b.p, 2 * a.v - b.v FROM n a JOIN n b ON a.capture = b.capture AND a.p = a.n - 1 AND b.p BETWEEN a.n - 5 AND a.n - 2),
    sm AS (SELECT n.capture, n.event_id, avg(q.v) AS smooth FROM n JOIN pad q ON q.capture = n.capture AND q.p BETWEEN n.p - h AND n.p + h GROUP BY ALL)"""


@query("+ " + SMOOTH.replace("n AS (SELECT capture, event_id, v,", "n AS (SELECT capture, event_id, v, least(4, (count(*) OVER (PARTITION BY capture) - 1) // 2) * CASE WHEN count(*) OVER (PARTITION BY capture) <= 2 THEN 0 ELSE 1 END AS h,", 1) + " SELECT capture, event_id, round(smooth, 5) + 0.0 AS smooth FROM sm", lens.TRAJ)
def residual_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    return drift.smoothed(lens.traj(spark, sf), ["capture"], "event_id", "v", 9).select("capture", "event_id", *r("smooth", digits=5))


@query("""+ m AS (SELECT capture, median(v / 1000) AS m FROM traj GROUP BY capture), o AS (SELECT t.capture, event_id, greatest(-0.1, least(0.1, v / 1000 - m)) AS offset_m FROM traj t JOIN m USING (capture))
    SELECT capture, event_id, round(offset_m, 6) + 0.0 AS offset_m, round(-offset_m, 6) + 0.0 AS dy FROM o WHERE abs(offset_m) >= 1e-6""", lens.TRAJ)
def pose_offsets(spark: SparkSession, sf: str) -> DataFrame:
    t = lens.traj(spark, sf).select("capture", "event_id", (F.col("v") / 1000).alias("smooth"))
    return drift.pose_offsets(t, _plane(t, 0.0), ["capture"]).select("capture", "event_id", *r("offset_m", "dy"))


@query("""+ d AS (SELECT capture, abs(y - 0.2) AS far, row_number() OVER (PARTITION BY capture ORDER BY abs(y - 0.2)) AS rn, count(*) OVER (PARTITION BY capture) AS n FROM cloud)
    SELECT capture, round(sqrt(avg(far * far)), 6) AS trimmed_rmse_m, count(*) AS n_used FROM d WHERE rn <= greatest(round_even(0.3 * n, 0), 1) GROUP BY capture""", lens.CLOUD)
def trimmed_residual(spark: SparkSession, sf: str) -> DataFrame:
    c = lens.cloud(spark, sf)
    return drift.trimmed_residual(c, _plane(c, -0.2), ["capture"]).select("capture", *r("trimmed_rmse_m"), "n_used")


ARM = """SELECT l_suppkey AS capture, count(*) AS points, avg(CASE WHEN l_quantity <= 40 THEN 1.0 ELSE 0.0 END) AS inlier_ratio, stddev_pop(l_quantity) / 10 AS rmse_m, stddev_pop(l_discount) AS wall_rmse_m, CAST(count(DISTINCT l_linenumber) AS BIGINT) AS walls, avg(l_tax) * 10 AS support FROM lineitem"""


@query(f"""WITH a AS ({ARM} GROUP BY l_suppkey), b AS (SELECT capture, points - points % 3 % 2 AS points, inlier_ratio - 0.001 * (capture % 4) AS inlier_ratio, rmse_m * (0.8 + 0.05 * (capture % 7)) AS rmse_m, wall_rmse_m * (0.98 + 0.02 * (capture % 6)) AS wall_rmse_m, walls - CASE WHEN capture % 9 = 0 THEN 1 ELSE 0 END AS walls, support - 0.005 * (capture % 8) AS support FROM a),
    j AS (SELECT a.capture, (a.rmse_m - b.rmse_m) / a.rmse_m AS gain, CASE WHEN a.points > 0 AND a.points - b.points > a.points * 0.005 THEN 'points_lost' WHEN a.inlier_ratio - b.inlier_ratio > 0.002 THEN 'inliers_lost' WHEN a.rmse_m <= 0 THEN 'no_baseline' WHEN (a.rmse_m - b.rmse_m) / a.rmse_m < 0.05 THEN 'no_improvement'
        WHEN a.wall_rmse_m > 0 AND (b.wall_rmse_m - a.wall_rmse_m) / a.wall_rmse_m > 0.05 THEN 'walls_worse' WHEN b.walls < a.walls THEN 'walls_lost' WHEN a.support - b.support > 0.02 THEN 'support_lost' ELSE 'accepted' END AS decision FROM a JOIN b USING (capture))
    SELECT capture, decision = 'accepted' AS accepted, decision, round(gain, 5) + 0.0 AS improvement FROM j""".replace("0.8 + 0.05", "CAST(0.8 AS DOUBLE) + CAST(0.05 AS DOUBLE)").replace("0.98 + 0.02", "CAST(0.98 AS DOUBLE) + CAST(0.02 AS DOUBLE)"))
def drift_judge(spark: SparkSession, sf: str) -> DataFrame:
    a = lens.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("capture")).agg(
        F.count("*").alias("points"), F.avg((F.col("l_quantity") <= 40).cast("double")).alias("inlier_ratio"), (F.stddev_pop("l_quantity") / 10).alias("rmse_m"),
        F.stddev_pop("l_discount").alias("wall_rmse_m"), F.count_distinct("l_linenumber").alias("walls"), (F.avg("l_tax") * 10).alias("support"),
    )
    c = F.col("capture")
    b = a.withColumns({
        "points": F.col("points") - F.col("points") % 3 % 2, "inlier_ratio": F.col("inlier_ratio") - 0.001 * (c % 4), "rmse_m": F.col("rmse_m") * (0.8 + 0.05 * (c % 7)),
        "wall_rmse_m": F.col("wall_rmse_m") * (0.98 + 0.02 * (c % 6)), "walls": F.col("walls") - F.when(c % 9 == 0, 1).otherwise(0), "support": F.col("support") - 0.005 * (c % 8),
    })
    arms = a.withColumn("arm", F.lit("control")).unionByName(b.withColumn("arm", F.lit("corrected"))).withColumn("trimmed_rmse_m", F.lit(None).cast("double"))
    return drift.judge(arms, ["capture"]).select("capture", "accepted", "decision", *r("improvement", digits=5))


@query(f"""+ p AS (SELECT event_type, "value" AS v, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events),
    k AS (SELECT event_type, CAST(rep AS INTEGER) AS rep, {LCG.format('rep * 1000003 + i * 7 + 5')} % n AS i FROM p, range(64) t(rep)),
    m AS (SELECT k.event_type, rep, avg(v) AS m FROM k JOIN p ON p.event_type = k.event_type AND p.i = k.i GROUP BY ALL)
    SELECT event_type, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high, count(*) AS n_samples FROM m GROUP BY event_type""".replace("+ p AS", "WITH p AS", 1))
def bootstrap_mean_interval(spark: SparkSession, sf: str) -> DataFrame:
    return resample.mean_interval(lens.table(spark, sf, "events"), ["event_type"], ["event_id"], "value").select("event_type", *r("low", "high"), "n_samples")


@query()
def bootstrap_outline(spark: SparkSession, sf: str) -> DataFrame:
    c = lens.cloud(spark, sf)
    return resample.outline_interval(c, ["capture"], ["vec_id"], Intervals(), Structure(grid_size_m=0.5, concave_simplify_m=0.6))


# ---- registration

PAIRS = """pairs AS (SELECT capture, tx AS sx, tz AS sy, tx * cos(0.4) - tz * sin(0.4) + 3 + 0.01 * qy AS tx, tx * sin(0.4) + tz * cos(0.4) - 2 + 0.01 * qw AS ty FROM pose)"""


@query("""+ m AS (SELECT capture, count(*) AS n, avg(sx) AS msx, avg(sy) AS msy, avg(tx) AS mtx, avg(ty) AS mty, covar_pop(sx, tx) + covar_pop(sy, ty) AS d, covar_pop(sx, ty) - covar_pop(sy, tx) AS c, var_pop(sx) + var_pop(sy) + var_pop(tx) + var_pop(ty) AS s FROM pairs GROUP BY capture)
    SELECT capture, n, round(atan2(c, d), 5) AS theta, round(mtx - (cos(atan2(c, d)) * msx - sin(atan2(c, d)) * msy), 5) AS dx, round(mty - (sin(atan2(c, d)) * msx + cos(atan2(c, d)) * msy), 5) AS dy, round(sqrt(greatest(s - 2 * sqrt(d * d + c * c), 0)), 4) AS rmse_m FROM m""", lens.POSE, PAIRS)
def rigid_fit(spark: SparkSession, sf: str) -> DataFrame:
    p = lens.pose(spark, sf).withColumns({"sx": F.col("tx"), "sy": F.col("tz")})
    a = F.lit(0.4)
    p = p.select("capture", "sx", "sy", (F.col("sx") * F.cos(a) - F.col("sy") * F.sin(a) + 3 + 0.01 * F.col("qy")).alias("tx"), (F.col("sx") * F.sin(a) + F.col("sy") * F.cos(a) - 2 + 0.01 * F.col("qw")).alias("ty"))
    return register.rigid_fit(p, ["capture"]).select("capture", "n", *r("theta", "dx", "dy", digits=5), *r("rmse_m", digits=4))


@query("""+ m AS (SELECT capture, count(*) AS n, avg(sx) AS msx, avg(sy) AS msy, avg(tx) AS mtx, avg(ty) AS mty, covar_pop(sx, tx) + covar_pop(sy, ty) AS d, covar_pop(sx, ty) - covar_pop(sy, tx) AS c FROM pairs GROUP BY capture),
    f AS (SELECT capture, n, atan2(c, d) AS theta, mtx - (cos(atan2(c, d)) * msx - sin(atan2(c, d)) * msy) AS dx, mty - (sin(atan2(c, d)) * msx + cos(atan2(c, d)) * msy) AS dy FROM m)
    SELECT capture, f.n, round(theta, 5) AS theta, round(dx, 5) AS dx, round(dy, 5) AS dy, round(max(sqrt(pow(cos(theta) * sx - sin(theta) * sy + dx - tx, 2) + pow(sin(theta) * sx + cos(theta) * sy + dy - ty, 2))), 4) AS max_m, CASE WHEN f.n < 2 THEN 'fewer than two anchors' END AS problem
    FROM f JOIN pairs USING (capture) GROUP BY ALL""", lens.POSE, PAIRS)
def anchored_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Each capture's poses are anchors of its turned and shifted copy; a wall is laid on its copy."""
    p = lens.pose(spark, sf).withColumns({"sx": F.col("tx"), "sy": F.col("tz")})
    a = F.lit(0.4)
    p = p.select("capture", "sx", "sy", (F.col("sx") * F.cos(a) - F.col("sy") * F.sin(a) + 3 + 0.01 * F.col("qy")).alias("tx"), (F.col("sx") * F.sin(a) + F.col("sy") * F.cos(a) - 2 + 0.01 * F.col("qw")).alias("ty"))
    wall = p.select("capture").distinct().select("capture", F.lit("W01").alias("wall_id"), *[F.lit(v).alias(n) for n, v in (("x1", 0.0), ("y1", 0.0), ("x2", 2.0), ("y2", 0.0))])
    transform, _, _ = register.anchored_stitch(p, wall, wall, ["capture"])
    return transform.select("capture", "n", *r("theta", "dx", "dy", digits=5), *r("max_m", digits=4), "problem")


ROOM = """room AS (SELECT o_custkey AS capture, frame AS wall_id, tx AS x1, tz AS y1, tx + 3 * qw + ty / 10 AS x2, tz + 3 * qy AS y2 FROM pose JOIN orders ON o_orderkey = frame)"""


def _room(spark: SparkSession, sf: str) -> DataFrame:
    room = lens.table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame"), F.col("o_custkey").alias("room"))
    return lens.pose(spark, sf).join(room, "frame").select(
        F.col("room").alias("capture"), F.col("frame").alias("wall_id"), F.col("tx").alias("x1"), F.col("tz").alias("y1"),
        (F.col("tx") + 3 * F.col("qw") + F.col("ty") / 10).alias("x2"), (F.col("tz") + 3 * F.col("qy")).alias("y2"),
    )


def _moved_room(spark: SparkSession, sf: str) -> DataFrame:
    room = _room(spark, sf)
    return room.withColumns({"x1": F.col("x1") + 0.2, "x2": F.col("x2") + 0.3, "y1": F.col("y1") - 0.1, "y2": F.col("y2") - 0.1})


@query("""+ w AS (SELECT *, atan2(y2 - y1, x2 - x1) AS ang, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM room),
    v AS (SELECT *, atan2(y2 - y1, x2 - x1) AS ang, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM (SELECT capture, wall_id, x1 + 0.2 AS x1, x2 + 0.3 AS x2, y1 - 0.1 AS y1, y2 - 0.1 AS y2 FROM room)),
    t AS (SELECT w.capture, w.wall_id AS wall_id_a, v.wall_id AS wall_id_b, abs(w.ang - v.ang) - pi() * floor(abs(w.ang - v.ang) / pi()) AS t, sqrt(pow(w.mx - v.mx, 2) + pow(w.my - v.my, 2)) AS gap_m, abs(w.len - v.len) / greatest(w.len, v.len) AS length_error FROM w JOIN v USING (capture)),
    u AS (SELECT *, degrees(least(t, pi() - t)) AS angle_deg FROM t)
    SELECT capture, wall_id_a, wall_id_b, round((angle_deg / 15 + gap_m + length_error / 0.35) / 3, 5) AS score FROM u WHERE angle_deg <= 15 AND gap_m <= 1 AND length_error <= 0.35""", lens.POSE, ROOM)
def wall_match_candidates(spark: SparkSession, sf: str) -> DataFrame:
    m = register.match_candidates(_room(spark, sf), _moved_room(spark, sf), ["capture"])
    return m.select("capture", "wall_id_a", "wall_id_b", *r("score", digits=5))


@query("""+ w AS (SELECT *, atan2(y2 - y1, x2 - x1) AS ang, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM room),
    v AS (SELECT *, atan2(y2 - y1, x2 - x1) AS ang, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM (SELECT capture, wall_id, x1 + 0.2 AS x1, x2 + 0.3 AS x2, y1 - 0.1 AS y1, y2 - 0.1 AS y2 FROM room)),
    t AS (SELECT w.capture, w.wall_id AS wall_id_a, v.wall_id AS wall_id_b, abs(w.ang - v.ang) - pi() * floor(abs(w.ang - v.ang) / pi()) AS t, sqrt(pow(w.mx - v.mx, 2) + pow(w.my - v.my, 2)) AS gap_m, abs(w.len - v.len) / greatest(w.len, v.len) AS length_error FROM w JOIN v USING (capture)),
    u AS (SELECT *, degrees(least(t, pi() - t)) AS angle_deg FROM t),
    cd AS (SELECT *, row_number() OVER (PARTITION BY capture ORDER BY (angle_deg / 15 + gap_m + length_error / 0.35) / 3, wall_id_a, wall_id_b) AS rn FROM u WHERE angle_deg <= 15 AND gap_m <= 1 AND length_error <= 0.35),
    gr AS (SELECT capture, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS ua, CAST([] AS BIGINT[]) AS ub, false AS taken, CAST(NULL AS BIGINT) AS wall_id_a, CAST(NULL AS BIGINT) AS wall_id_b FROM (SELECT DISTINCT capture FROM cd)
        UNION ALL SELECT g.capture, c.rn, CASE WHEN list_contains(ua, c.wall_id_a) OR list_contains(ub, c.wall_id_b) THEN ua ELSE list_append(ua, c.wall_id_a) END,
            CASE WHEN list_contains(ua, c.wall_id_a) OR list_contains(ub, c.wall_id_b) THEN ub ELSE list_append(ub, c.wall_id_b) END,
            NOT (list_contains(ua, c.wall_id_a) OR list_contains(ub, c.wall_id_b)), c.wall_id_a, c.wall_id_b FROM gr g JOIN cd c ON c.capture = g.capture AND c.rn = g.rn + 1)
    SELECT capture, wall_id_a, wall_id_b FROM gr WHERE taken""", lens.POSE, ROOM)
def wall_match_greedy(spark: SparkSession, sf: str) -> DataFrame:
    found = register.greedy_matches(register.match_candidates(_room(spark, sf), _moved_room(spark, sf), ["capture"]), ["capture"])
    return found.select("capture", "wall_id_a", "wall_id_b")


@query("""+ a AS (SELECT capture, atan2(y2 - y1, x2 - x1) - pi() * floor(atan2(y2 - y1, x2 - x1) / pi()) AS a FROM room)
    SELECT capture, max(CASE WHEN degrees(least(abs(p.a - q.a), pi() - abs(p.a - q.a))) > 25 THEN 1 ELSE 0 END) = 1 AS diverse FROM a p JOIN a q USING (capture) GROUP BY capture""", lens.POSE, ROOM)
def orientation_diversity(spark: SparkSession, sf: str) -> DataFrame:
    return register.diverse(_room(spark, sf), ["capture"])


@query()
def room_stitch(spark: SparkSession, sf: str) -> DataFrame:
    """Rooms of at most sixteen walls are stitched to moved copies of themselves."""
    as_text = lambda df: df.withColumn("wall_id", F.col("wall_id").cast("string"))
    return register.auto_stitch(as_text(_room(spark, sf)), as_text(_moved_room(spark, sf)), ["capture"]).drop("pairs")


@query()
def triangulate_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Each part is a point; each of its order lines a view of it from a place along x."""
    li = lens.table(spark, sf, "lineitem")
    x, y, z = F.col("l_partkey") % 20 / 10.0, F.col("l_partkey") % 7 / 10.0, 4.0 + F.col("l_partkey") % 5
    tx = (F.col("l_linenumber") * 0.5 + F.col("l_suppkey") % 10 * 0.05).cast("double")
    rows = li.select(F.col("l_partkey").alias("track"), x.alias("px"), y.alias("py"), z.alias("pz"), tx.alias("tx"))
    u, v = 100.0 * (F.col("px") - F.col("tx")) / F.col("pz") + 50.0, 100.0 * F.col("py") / F.col("pz") + 50.0
    one = {"p00": 100.0, "p01": 0.0, "p02": 50.0, "p10": 0.0, "p11": 100.0, "p12": 50.0, "p13": 0.0, "p20": 0.0, "p21": 0.0, "p22": 1.0, "p23": 0.0}
    obs = rows.select("track", u.alias("u"), v.alias("v"), (-100.0 * F.col("tx")).alias("p03"), *[F.lit(c).alias(n) for n, c in one.items()])
    got = register.triangulate(obs, ["track"])
    return got.select("track", *r("x", "y", "z", digits=4), "n_views", "reason")


# ---- media


@query("""WITH a AS (SELECT CAST(doc_id AS VARCHAR) AS path, md5(text) AS hash FROM documents), f AS (SELECT hash, min(path) AS first FROM a WHERE hash IS NOT NULL GROUP BY hash)
    SELECT path, a.hash, CASE WHEN first <> path THEN first END AS duplicate_of FROM a LEFT JOIN f USING (hash)""")
def media_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    a = lens.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), F.md5("text").alias("hash"))
    return media.mark_duplicates(a)


@query("""WITH m AS (SELECT event_id, CAST(event_id * 37 % 1000 AS INTEGER) AS width, CAST(event_id * 91 % 900 AS INTEGER) AS height, "value" / 200 AS mean_luminance, event_id % 100 / CAST(100 AS DOUBLE) AS dark, event_id % 83 / CAST(83 AS DOUBLE) AS bright, event_id % 11 / CAST(10000 AS DOUBLE) AS sharp FROM events),
    q AS (SELECT event_id, list_filter([CASE WHEN width < 640 OR height < 480 THEN 'fewer pixels than 640 by 480' END, CASE WHEN mean_luminance < 0.08 THEN 'underexposed on average' WHEN mean_luminance > 0.92 THEN 'overexposed on average' END,
        CASE WHEN dark > 0.65 THEN 'black in most places' END, CASE WHEN bright > 0.65 THEN 'white in most places' END, CASE WHEN sharp < 0.0004 THEN 'too little fine detail' END], lambda x: x IS NOT NULL) AS r FROM m)
    SELECT event_id, array_to_string(r, '; ') AS reasons, len(r) = 0 AS accepted FROM q""")
def media_quality_reasons(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    m = lens.table(spark, sf, "events").select(
        e, (e * 37 % 1000).cast("int").alias("width"), (e * 91 % 900).cast("int").alias("height"), (F.col("value") / 200).alias("mean_luminance"),
        (e % 100 / F.lit(100.0)).alias("dark_fraction"), (e % 83 / F.lit(83.0)).alias("bright_fraction"), (e % 11 / F.lit(10000.0)).alias("sharpness"),
    )
    return media.quality_reasons(m).select("event_id", F.array_join("reasons", "; ").alias("reasons"), "accepted")


@query("""WITH d AS (SELECT user_id, max("value") AS duration FROM events GROUP BY user_id)
    SELECT user_id, CAST(k AS INTEGER) AS k, round(least(0.25, duration * 0.02) + k * (duration - 2 * least(0.25, duration * 0.02)) / 7, 6) AS at_s FROM d, range(8) t(k)""")
def video_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    d = lens.table(spark, sf, "events").groupBy("user_id").agg(F.max("value").alias("duration"))
    return media.even_timestamps(d, "duration", 8).select("user_id", "k", *r("at_s"))


@query("""WITH i AS (SELECT CAST(p_partkey AS VARCHAR) AS relative_path, CASE WHEN p_size > 25 THEN 'crack_like_visual_anomaly' END AS classification, CASE WHEN p_size > 5 THEN p_size / CAST(10 AS DOUBLE) END AS ext, p_retailprice / 1000 AS area FROM part),
    d AS (SELECT CAST(l_partkey + CASE WHEN l_linenumber = 7 THEN 1000000000 ELSE 0 END AS VARCHAR) AS relative_path, l_orderkey, l_returnflag = 'R' AS confirmed, CASE WHEN l_linestatus = 'O' THEN ' fill ' ELSE '' END AS action, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'candidate_area_m2' WHEN 3 THEN 'volume' ELSE 'maximum_candidate_extent_m' END AS basis, l_quantity - 5 AS unit_rate FROM lineitem),
    m AS (SELECT d.relative_path, i.relative_path AS known, classification, trim(action) AS action, coalesce(basis, 'maximum_candidate_extent_m') AS quantity_basis, unit_rate, CASE coalesce(basis, 'maximum_candidate_extent_m') WHEN 'maximum_candidate_extent_m' THEN ext WHEN 'candidate_area_m2' THEN area END AS quantity FROM d LEFT JOIN i USING (relative_path) WHERE confirmed)
    SELECT relative_path, classification, action, round(quantity, 6) AS quantity, CASE WHEN quantity_basis = 'candidate_area_m2' THEN 'square_metre' ELSE 'metre' END AS unit, quantity_basis, round(quantity * unit_rate, 4) + 0.0 AS estimated_cost,
        CASE WHEN known IS NULL THEN 'unknown image' WHEN action = '' THEN 'no action' WHEN quantity_basis NOT IN ('maximum_candidate_extent_m', 'candidate_area_m2') THEN 'unsupported quantity basis' WHEN quantity IS NULL OR quantity <= 0 THEN 'no scaled quantity' WHEN unit_rate < 0 THEN 'negative unit rate' END AS problem FROM m""")
def repair_scope(spark: SparkSession, sf: str) -> DataFrame:
    p = lens.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("relative_path"), F.when(F.col("p_size") > 25, "crack_like_visual_anomaly").alias("classification"),
        F.when(F.col("p_size") > 5, F.col("p_size") / F.lit(10.0)).alias("maximum_candidate_extent_m"), (F.col("p_retailprice") / 1000).alias("candidate_area_m2"),
    )
    n = F.col("l_linenumber")
    d = lens.table(spark, sf, "lineitem").select(
        (F.col("l_partkey") + F.when(n == 7, 1000000000).otherwise(0)).cast("string").alias("relative_path"), (F.col("l_returnflag") == "R").alias("confirmed"),
        F.when(F.col("l_linestatus") == "O", " fill ").otherwise("").alias("action"),
        F.when(n == 1, None).when(n == 2, "candidate_area_m2").when(n == 3, "volume").otherwise("maximum_candidate_extent_m").alias("quantity_basis"),
        (F.col("l_quantity") - 5).alias("unit_rate"), F.lit(None).cast("string").alias("note"),
    )
    s = media.repair_scope(p, d)
    return s.select("relative_path", "classification", "action", *r("quantity"), "unit", "quantity_basis", *r("estimated_cost", digits=4), "problem")


# ---- evaluation


def _evaluated(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    truth, pred, groups = lens.truth_pred(spark, sf)
    return evaluate.evaluate(truth, pred), groups


@query("""SELECT capture_name, metric, target_id, round(truth, 6) AS truth, round(predicted, 6) AS predicted, round(absolute_error, 6) + 0.0 AS absolute_error, round(percentage_error, 6) + 0.0 AS percentage_error, threshold, status FROM evaluated""", lens.TRUTH_PRED)
def evaluate_gates(spark: SparkSession, sf: str) -> DataFrame:
    e, _ = _evaluated(spark, sf)
    return e.select("capture_name", "metric", "target_id", *r("truth", "predicted", "absolute_error", "percentage_error"), "threshold", "status")


@query("""SELECT tier, metric, count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'missing_prediction') AS missing_prediction, count(*) FILTER (status = 'not_evaluated') AS not_evaluated FROM evaluated GROUP BY tier, metric""", lens.TRUTH_PRED)
def evaluate_status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.statuses(_evaluated(spark, sf)[0], ["tier", "metric"])


@query("""SELECT tier, count(*) AS n_measurements, CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' WHEN count(*) FILTER (status = 'missing_prediction') > 0 THEN 'missing_prediction' WHEN count(*) FILTER (status = 'not_evaluated') > 0 THEN 'not_evaluated' ELSE 'passed' END AS status FROM evaluated WHERE metric = 'wall_length' GROUP BY tier""", lens.TRUTH_PRED)
def evaluate_tier_walls(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.summary_status(_evaluated(spark, sf)[0].where("metric = 'wall_length'"), ["tier"])


def _captures(spark: SparkSession, sf: str) -> DataFrame:
    return _evaluated(spark, sf)[0].select("capture_name", "room_id", "tier").distinct()


@query("""+ c AS (SELECT DISTINCT capture_name, room_id, tier FROM evaluated), rt AS (SELECT room_id, count(DISTINCT CASE WHEN tier IN ('photo', 'video', 'lidar') THEN tier END) AS n FROM c GROUP BY 1)
    SELECT count(*) AS n_rooms, CASE WHEN count(*) > 0 AND min(n) = 3 THEN 'declared' ELSE 'not_met' END AS status FROM rt""", lens.TRUTH_PRED)
def evaluate_rooms_all_tiers(spark: SparkSession, sf: str) -> DataFrame:
    c = _captures(spark, sf)
    return evaluate.rooms_all_tiers(c, c.select("room_id"))


@query("""+ c AS (SELECT DISTINCT capture_name, room_id, tier FROM evaluated), pc AS (SELECT DISTINCT capture_name FROM evaluated WHERE predicted IS NOT NULL AND length(capture_name) % 2 = 0)
    SELECT 'too_few_rooms' AS code, CAST(count(DISTINCT room_id) AS VARCHAR) AS subject FROM c HAVING count(DISTINCT room_id) < 3
    UNION ALL SELECT 'tier_missing', t FROM (VALUES ('photo'), ('video'), ('lidar')) v(t) WHERE NOT EXISTS (SELECT 1 FROM c WHERE tier = t)
    UNION ALL SELECT 'no_repeated_capture', NULL
    UNION ALL SELECT 'room_lacks_tiers', room_id FROM c GROUP BY room_id HAVING count(DISTINCT tier) < 3
    UNION ALL SELECT 'truth_without_result', capture_name FROM (SELECT DISTINCT capture_name FROM c) WHERE capture_name NOT IN (SELECT capture_name FROM pc)""", lens.TRUTH_PRED)
def evaluate_protocol(spark: SparkSession, sf: str) -> DataFrame:
    c = _captures(spark, sf).withColumn("repeatability_group", F.lit(None).cast("string"))
    done = _evaluated(spark, sf)[0].where("predicted is not null and length(capture_name) % 2 = 0").select("capture_name")
    return evaluate.protocol_warnings(c, c.select("room_id"), done)


REPEAT = """g AS (SELECT DISTINCT capture_name, p_brand AS repeatability_group FROM tp JOIN per USING (p_partkey)), sz AS (SELECT repeatability_group, count(*) AS n_captures FROM g GROUP BY 1),
    rp AS (SELECT repeatability_group, metric, 'W' || CAST(CAST(substr(target_id, 2) AS BIGINT) // 3 AS VARCHAR) AS target_id, truth, predicted, status, n_captures FROM evaluated JOIN g USING (capture_name) JOIN sz USING (repeatability_group) WHERE metric = 'wall_length' AND truth IS NOT NULL AND n_captures >= 2),
    ra AS (SELECT repeatability_group, metric, target_id, max(n_captures) AS n_captures, count(predicted) AS n_predicted, max(truth) AS truth, max(predicted) - min(predicted) AS spread, CASE WHEN count(*) < max(n_captures) THEN 'not_evaluated' WHEN count(*) FILTER (status = 'missing_prediction') > 0 THEN 'missing_prediction' WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed'
        WHEN count(*) FILTER (status <> 'passed') = 0 THEN 'passed' ELSE 'not_evaluated' END AS accuracy FROM rp GROUP BY 1, 2, 3)"""


@query("""+ """ + REPEAT + """, rs AS (SELECT *, n_predicted = n_captures AS whole, spread <= 0.01 + 1e-12 OR spread / truth * 100 <= 0.5 + 1e-12 AS steady FROM ra)
    SELECT repeatability_group, metric, target_id, n_captures, n_predicted, accuracy, round(CASE WHEN whole THEN spread END, 6) AS spread_m, CASE WHEN NOT whole THEN 'missing_prediction' WHEN steady THEN 'passed' ELSE 'failed' END AS status,
        CASE WHEN NOT whole THEN 'incomplete' WHEN accuracy = 'passed' THEN CASE WHEN steady THEN 'accurate_and_repeatable' ELSE 'accurate_not_repeatable' END WHEN accuracy = 'failed' THEN CASE WHEN steady THEN 'biased_but_repeatable' ELSE 'biased_and_not_repeatable' END ELSE 'not_evaluated' END AS classification FROM rs""", lens.TRUTH_PRED)
def evaluate_repeatability(spark: SparkSession, sf: str) -> DataFrame:
    """Three neighbouring parts stand for one wall measured by the brand's three captures."""
    e, groups = _evaluated(spark, sf)
    e = e.where("metric = 'wall_length'").withColumn("target_id", F.concat(F.lit("W"), F.floor(F.expr("cast(substring(target_id, 2) as bigint)") / 3).cast("string")))
    rep = evaluate.repeatability(e, groups)
    return rep.select("repeatability_group", "metric", "target_id", "n_captures", "n_predicted", "accuracy", *r("spread_m"), "status", "classification")


@query("""+ o AS (SELECT tier, count(*) FILTER (truth IS NOT NULL) AS expected, count(*) FILTER (truth IS NOT NULL AND predicted IS NOT NULL) AS matched, count(*) FILTER (truth IS NOT NULL AND status = 'passed') AS passed, count(*) FILTER (truth IS NOT NULL AND predicted IS NULL) AS missed, count(*) FILTER (truth IS NULL) AS phantoms FROM evaluated WHERE metric = 'opening_width' GROUP BY tier)
    SELECT tier, expected, matched, passed, missed, phantoms, round(passed / CAST(expected + phantoms AS DOUBLE), 6) AS pass_rate, CASE WHEN passed / CAST(expected + phantoms AS DOUBLE) >= 0.85 THEN 'passed' ELSE 'failed' END AS status FROM o""", lens.TRUTH_PRED)
def evaluate_openings_rate(spark: SparkSession, sf: str) -> DataFrame:
    o = evaluate.openings_summary(_evaluated(spark, sf)[0], ["tier"])
    return o.select("tier", "expected", "matched", "passed", "missed", "phantoms", *r("pass_rate"), "status")


@query("""+ """ + REPEAT + """, rs AS (SELECT *, n_predicted = n_captures AS whole, spread <= 0.01 + 1e-12 OR spread / truth * 100 <= 0.5 + 1e-12 AS steady FROM ra),
    f AS (SELECT (SELECT count(*) FROM evaluated) AS n, (SELECT count(*) FROM evaluated WHERE status = 'failed' OR (status = 'missing_prediction' AND threshold IS NOT NULL)) + (SELECT count(*) FROM rs WHERE whole AND NOT steady) AS bad, (SELECT count(*) FROM evaluated WHERE status IN ('missing_prediction', 'not_evaluated')) + (SELECT count(*) FROM rs WHERE NOT whole) AS open)
    SELECT n AS n_measurements, CASE WHEN bad > 0 THEN 'failed_gates' WHEN open > 0 THEN 'incomplete' ELSE 'passed' END AS status FROM f""", lens.TRUTH_PRED)
def evaluate_overall(spark: SparkSession, sf: str) -> DataFrame:
    e, groups = _evaluated(spark, sf)
    walls = e.where("metric = 'wall_length'").withColumn("target_id", F.concat(F.lit("W"), F.floor(F.expr("cast(substring(target_id, 2) as bigint)") / 3).cast("string")))
    return evaluate.overall(e, evaluate.repeatability(walls, groups))


@query("""WITH i AS (SELECT p_brand, avg(l_quantity) - 0.4 AS low, avg(l_quantity) + 0.4 AS high, avg(CASE WHEN l_linenumber <= 4 THEN l_quantity END) AS truth FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
    SELECT count(*) AS n_intervals, count(*) FILTER (truth BETWEEN low AND high) AS covered, round(avg(CASE WHEN truth BETWEEN low AND high THEN 1.0 ELSE 0.0 END), 6) AS coverage_rate FROM i WHERE truth IS NOT NULL""")
def interval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    li = lens.table(spark, sf, "lineitem").join(lens.table(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    i = li.groupBy("p_brand").agg((F.avg("l_quantity") - 0.4).alias("low"), (F.avg("l_quantity") + 0.4).alias("high"), F.avg(F.when(F.col("l_linenumber") <= 4, F.col("l_quantity"))).alias("truth"))
    return evaluate.coverage(i).select("n_intervals", "covered", *r("coverage_rate"))


# ---- batches and outputs


@query("""SELECT o_custkey % 100 AS batch, count(*) AS n_captures, count(*) FILTER (o_orderstatus = 'F') AS succeeded, count(*) FILTER (o_orderstatus <> 'F') AS failed,
    CASE WHEN count(*) FILTER (o_orderstatus <> 'F') = 0 THEN 'ok' WHEN count(*) FILTER (o_orderstatus = 'F') = 0 THEN 'failed' ELSE 'partial' END AS status FROM orders GROUP BY 1""")
def batch_status_rollup(spark: SparkSession, sf: str) -> DataFrame:
    from voxelyard.operators.runs import batch_status

    o = lens.table(spark, sf, "orders").select((F.col("o_custkey") % 100).alias("batch"), (F.col("o_orderstatus") == "F").alias("succeeded"))
    return batch_status(o, ["batch"])


@query("""+ q AS (SELECT capture, quantile_cont(x, 0.005) AS x0, quantile_cont(x, 0.995) AS x1, quantile_cont(z, 0.005) AS z0, quantile_cont(z, 0.995) AS z1 FROM cloud GROUP BY capture),
    e AS (SELECT capture, x0 - 0.05 * (x1 - x0) AS x0, x1 + 0.05 * (x1 - x0) AS x1, z0 - 0.05 * (z1 - z0) AS z0, z1 + 0.05 * (z1 - z0) AS z1 FROM q),
    b AS (SELECT capture, least(CAST(floor((x - x0) / ((x1 - x0) / 20)) AS BIGINT), 19) AS bx, least(CAST(floor((z - z0) / ((z1 - z0) / 20)) AS BIGINT), 19) AS bz FROM cloud JOIN e USING (capture) WHERE x BETWEEN x0 AND x1 AND z BETWEEN z0 AND z1)
    SELECT capture, bx, bz, count(*) AS n, round(ln(1 + count(*)), 6) AS shade FROM b GROUP BY ALL""", lens.CLOUD)
def topdown_density(spark: SparkSession, sf: str) -> DataFrame:
    from voxelyard.operators.sinks import topdown

    return topdown(lens.cloud(spark, sf), ["capture"], 20).select("capture", "bx", "bz", "n", *r("shade"))


@query("""WITH f AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY user_id, event_type) SELECT user_id, string_agg(event_type, '|' ORDER BY first) AS warnings FROM f GROUP BY user_id""")
def warnings_distinct_ordered(spark: SparkSession, sf: str) -> DataFrame:
    from voxelyard.operators.runs import ordered_distinct

    return ordered_distinct(lens.table(spark, sf, "events"), ["user_id"], "event_id", "event_type").select("user_id", F.array_join("warnings", "|").alias("warnings"))


@query("""SELECT page_id, regexp_matches(url, '(^/)|(^[A-Za-z]:[^/])') OR len(list_filter(string_split(replace(url, '\\', '/'), '/'), lambda x: x IN ('', '.', '..'))) > 0 AS unsafe FROM (SELECT page_id, substr(url, 9) AS url FROM pages)""".replace("\\\\", "\\"))
def member_path_safety(spark: SparkSession, sf: str) -> DataFrame:
    return lens.table(spark, sf, "pages").select("page_id", F.expr("substring(url, 9)").alias("url")).select("page_id", cap.unsafe(F.col("url")).alias("unsafe"))


@query("""WITH o AS (SELECT p_partkey, regexp_replace(regexp_replace(p_name || '.zip', '(?i)\\.zip$', ''), '[^A-Za-z0-9._-]+', '-', 'g') AS n FROM part), t AS (SELECT p_partkey, regexp_replace(n, '^[.-]+|[.-]+$', '', 'g') AS output FROM o)
    SELECT p_partkey, output, count(*) OVER (PARTITION BY lower(output)) > 1 AS collides FROM t""".replace("\\\\", "\\"))
def output_names(spark: SparkSession, sf: str) -> DataFrame:
    p = lens.table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(".zip")).alias("name"))
    return cap.output_names(p).select("p_partkey", "output", "collides")
