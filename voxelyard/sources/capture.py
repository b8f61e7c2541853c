"""Captures: folders or ZIP archives with depth and confidence images, poses and a camera matrix.

A capture becomes rows: members (capture_id, member, size, content). From there on everything is a
DataFrame keyed by capture, so a batch of captures is one job. Files come from Spark's binaryFile
source, so any store that Spark reads will do.
"""

from __future__ import annotations

import io
import lzma
import re
import stat
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelyard.sources import png

POSES = "odometry.csv"
CAMERA = "camera_matrix.csv"
IMU = "imu.csv"
VIDEO = "rgb.mp4"
MEMBERS = "capture_id string, member string, size long, content binary, problem string"


def normalised(member: Column) -> Column:
    return F.regexp_replace(member, r"\\", "/")


def unsafe(member: Column) -> Column:
    """Whether a member name could leave the capture: absolute, with a drive, or with odd parts."""
    m = normalised(member)
    return m.startswith("/") | m.rlike(r"^[A-Za-z]:") | F.exists(F.split(m, "/"), lambda p: p.isin("", ".", ".."))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """All files below path; its letters are taken as they are, not as a pattern."""
    literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal)


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """Members of each folder below path (capture_id: the folder's name).

    A path that itself holds the poses or the camera matrix is one capture, called by its own name.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")
    begin = F.instr("path", root + "/")
    files = _files(spark, path).where(begin > 0).withColumn("inner", F.col("path").substr(begin + F.lit(len(root) + 1), F.length("path")))
    own = not files.where(F.col("inner").isin(POSES, CAMERA)).select("inner").isEmpty()
    inner = F.concat(F.lit(root.rpartition("/")[2] + "/"), "inner") if own else F.col("inner")
    return files.where(inner.contains("/") & ~F.lower("inner").endswith(".zip")).select(
        F.substring_index(inner, "/", 1).alias("capture_id"), inner.alias("member"),
        F.col("length").alias("size"), "content", F.lit(None).cast("string").alias("problem"),
    )


def name_collisions(spark: SparkSession, path: str) -> DataFrame:
    """capture_id, sources: names that several folders or archives below path would share (case ignored).

    Reads names only. Results are kept by name, so such captures would be taken for one.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")
    files = _files(spark, path).select("path", F.instr("path", root + "/").alias("at"))
    inner = F.when(F.col("at") > 0, F.col("path").substr(F.col("at") + F.lit(len(root) + 1), F.length("path"))).otherwise(F.substring_index("path", "/", -1))
    source = F.when(F.lower("path").endswith(".zip"), F.col("path")).when(inner.contains("/"), F.substring_index(inner, "/", 1))
    name = F.regexp_replace(F.substring_index(source, "/", -1), "(?i)\\.zip$", "")
    named = files.select(name.alias("capture_id"), source.alias("source")).where("source is not null").distinct()
    return named.groupBy(F.lower("capture_id").alias("key")).agg(F.min("capture_id").alias("capture_id"), F.array_sort(F.collect_set("source")).alias("sources")).where(
        F.size("sources") > 1
    ).select("capture_id", "sources")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Members of each ZIP archive in path (capture_id: the file's name without .zip).

    A damaged archive gives a row with the problem, so that it fails alone, and so does a symbolic link.
    """
    files = _files(spark, path).where(F.lower("path").endswith(".zip"))

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in f[["path", "content"]].itertuples(index=False):
                capture = name.rsplit("/", 1)[-1][:-4]
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for i in z.infolist():
                            if stat.S_ISLNK(i.external_attr >> 16):
                                yield pd.DataFrame([(capture, i.filename, 0, None, f"symbolic link: {i.filename}")], columns=["capture_id", "member", "size", "content", "problem"])
                            elif not i.is_dir():
                                yield pd.DataFrame([(capture, i.filename, i.file_size, z.read(i), None)], columns=["capture_id", "member", "size", "content", "problem"])
                except (zipfile.BadZipFile, zlib.error, lzma.LZMAError, struct.error, RuntimeError, OSError, EOFError, ValueError) as e:
                    yield pd.DataFrame([(capture, None, 0, None, f"{type(e).__name__}: {e}")], columns=["capture_id", "member", "size", "content", "problem"])

    return files.select("path", "content").mapInPandas(unpack, MEMBERS)


def member_problems(members: DataFrame) -> DataFrame:
    """capture_id, code, message: damaged archives, unsafe names and names that repeat."""
    m = normalised(F.col("member"))
    damaged = members.where("problem is not null").select("capture_id", F.lit("capture_open_failed").alias("code"), F.col("problem").alias("message"))
    bad = members.where("problem is null").where(unsafe(F.col("member"))).select("capture_id", F.lit("capture_open_failed").alias("code"), F.concat(F.lit("unsafe member path: "), "member").alias("message"))
    twice = members.where("problem is null").groupBy("capture_id", m.alias("m")).agg(F.count("*").alias("n")).where("n > 1").select(
        "capture_id", F.lit("capture_open_failed").alias("code"), F.concat(F.lit("repeated member: "), "m").alias("message")
    )
    return damaged.unionByName(bad).unionByName(twice)


def roots(members: DataFrame) -> DataFrame:
    """Per capture: root, the folder that holds the poses and the camera matrix, and n_roots.

    A folder with one of the two counts where none has both.
    """
    m = normalised(F.col("member"))
    base, parent = F.substring_index(m, "/", -1), F.when(m.contains("/"), F.regexp_replace(m, "/[^/]*$", "")).otherwise("")
    found = members.where(base.isin(POSES, CAMERA)).groupBy("capture_id", parent.alias("root")).agg(F.count_distinct(base).alias("n"))
    best = Window.partitionBy("capture_id")
    top = found.withColumn("most", F.max("n").over(best)).where("n = most")
    return top.groupBy("capture_id").agg(F.min("root").alias("root"), F.count("*").alias("n_roots"), F.max("n").alias("n_required"))


def _csv(members: DataFrame, root: DataFrame, name: str) -> DataFrame:
    """capture_id, line_no, cells (trimmed) of the lines of one text member that aren't blank."""
    at = F.when(F.col("root") == "", F.lit(name)).otherwise(F.concat("root", F.lit("/" + name)))
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "")
    lines = (
        members.join(root.select("capture_id", "root"), "capture_id").where(normalised(F.col("member")) == at)
        .select("capture_id", F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("line_no", "line")).where(F.trim("line") != "")
    )
    return lines.select("capture_id", "line_no", F.transform(F.split("line", ","), lambda c: F.trim(c)).alias("cells"))


def camera_matrices(members: DataFrame, root: DataFrame) -> DataFrame:
    """Per capture: fx, fy, cx, cy and valid (3 x 3, finite, positive focal lengths, last row 0 0 1)."""
    rows = _csv(members, root, CAMERA)
    cells = rows.select("capture_id", "line_no", F.transform("cells", lambda c: c.try_cast("double")).alias("v"))
    m = cells.groupBy("capture_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "v"))).alias("r"))  # a matrix: few lines
    good_shape = (F.size("r") == 3) & F.forall("r", lambda x: (F.size(x["v"]) == 3) & F.forall(x["v"], lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))))
    at = lambda i, j: F.get(F.get("r", F.lit(i))["v"], F.lit(j))
    out = m.select("capture_id", good_shape.alias("shape"), at(0, 0).alias("fx"), at(1, 1).alias("fy"), at(0, 2).alias("cx"), at(1, 2).alias("cy"), at(2, 0).alias("a"), at(2, 1).alias("b"), at(2, 2).alias("c"))
    ok = F.col("shape") & (F.col("fx") > 0) & (F.col("fy") > 0) & (F.abs("a") <= 1e-6) & (F.abs("b") <= 1e-6) & (F.abs(F.col("c") - 1) <= 1e-6)
    return out.select("capture_id", "fx", "fy", "cx", "cy", F.coalesce(ok, F.lit(False)).alias("valid"))


FIELDS = ("timestamp", "frame", "x", "y", "z", "qx", "qy", "qz", "qw", "fx", "fy", "cx", "cy")


def poses(members: DataFrame, root: DataFrame) -> DataFrame:
    """capture_id, row_no, frame_id, timestamp, tx..tz, qx..qw, fx..cy, problem: one row a pose.

    Columns are found by the header's names; extra columns are ignored, short lines padded. problem
    says why a row is invalid, or null.
    """
    rows = _csv(members, root, POSES)
    first = Window.partitionBy("capture_id").orderBy("line_no")
    named = rows.withColumn("header", F.first("cells").over(first)).withColumn("n", F.row_number().over(first)).where("n > 1")
    value = {f: F.get("cells", (F.array_position("header", f) - 1).cast("int")) for f in FIELDS}
    missing = F.filter(F.array(*[F.when(F.array_position("header", f) == 0, F.lit(f)) for f in FIELDS]), lambda x: x.isNotNull())
    number = {f: value[f].try_cast("double") for f in FIELDS if f != "frame"}
    frame = value["frame"].try_cast("long")
    names = {"x": "tx", "y": "ty", "z": "tz"}
    got = named.select("capture_id", F.col("line_no").alias("row_no"), missing.alias("missing"), F.format_string("%06d", frame).alias("frame_id"), frame.alias("frame_no"), *[v.alias(names.get(f, f)) for f, v in number.items()])
    finite = F.lit(True)
    for f in number:
        c = F.col(names.get(f, f))
        finite = finite & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in ("qy", "qz", "qw")), F.col("qx") * F.col("qx")))
    repeats = F.count("*").over(Window.partitionBy("capture_id", "frame_no"))
    problem = (
        F.when(F.size("missing") > 0, F.concat(F.lit("missing columns: "), F.array_join("missing", ", ")))
        .when(F.col("frame_no").isNull(), "frame is not a number").when(~finite, "a value is not a finite number")
        .when(norm < 1e-8, "the quaternion has no length").when((F.col("fx") <= 0) | (F.col("fy") <= 0), "a focal length is not positive")
        .when(repeats > 1, "the frame repeats")
    )
    return got.withColumn("problem", problem).drop("missing")


def imu_summary(members: DataFrame, root: DataFrame) -> DataFrame:
    """Per capture with an IMU file: samples, first_s, last_s."""
    rows = _csv(members, root, IMU)
    first = Window.partitionBy("capture_id").orderBy("line_no")
    named = rows.withColumn("header", F.first("cells").over(first)).withColumn("n", F.row_number().over(first)).where("n > 1")
    t = F.get("cells", (F.array_position("header", "timestamp") - 1).cast("int")).try_cast("double")
    return named.select("capture_id", t.alias("t")).groupBy("capture_id").agg(F.count("t").alias("samples"), F.min("t").alias("first_s"), F.max("t").alias("last_s"))


def frame_files(members: DataFrame, root: DataFrame, folder: str) -> DataFrame:
    """capture_id, frame_id, member, size, code: direct children <root>/<folder>/*.png by number.

    code is null, or invalid_frame_filename, duplicate_frame_file (not the first by name) or
    empty_frame_file.
    """
    m = normalised(F.col("member"))
    prefix = F.when(F.col("root") == "", F.lit(folder + "/")).otherwise(F.concat("root", F.lit(f"/{folder}/")))
    inside = members.join(root.select("capture_id", "root"), "capture_id").where(m.startswith(prefix))
    stem = F.regexp_extract(F.expr("substring(replace(member, '\\\\', '/'), length(root) + 1)"), rf"^/?{folder}/([^/]+)\.(?i:png)$", 1)
    files = inside.select("capture_id", m.alias("member"), "size", stem.alias("stem")).where("stem <> ''")
    number = F.when(F.col("stem").rlike(r"^\d{1,18}$"), F.col("stem").cast("long"))
    placed = files.withColumn("no", number).withColumn("frame_id", F.format_string("%06d", F.col("no")))
    nth = F.row_number().over(Window.partitionBy("capture_id", "no").orderBy("member"))
    code = F.when(F.col("no").isNull(), "invalid_frame_filename").when(nth > 1, "duplicate_frame_file").when(F.col("size") == 0, "empty_frame_file")
    return placed.withColumn("code", code).select("capture_id", "frame_id", "member", "size", "code")


def pixels(members: DataFrame, depth: DataFrame, confidence: DataFrame, wanted: DataFrame, stride: int = 1) -> DataFrame:
    """Pixel rows of the wanted frames: capture_id, frame_id, u, v, depth_mm, confidence, width, height, problem.

    Only the wanted frames' contents are decoded, and the stride is applied before pixels are rows. A
    frame that can't be decoded, or whose two images differ in size, is one row with the problem
    alone; it touches no other frame. The names are picked first; contents meet them in one join.
    """
    def named(side: DataFrame, kind: str) -> DataFrame:
        picked = side.where("code is null").join(wanted.select("capture_id", "frame_id"), ["capture_id", "frame_id"])
        return picked.select("capture_id", "frame_id", "member", F.lit(kind).alias("kind"))

    names = named(depth, "depth").unionByName(named(confidence, "conf"))
    files = members.where("problem is null").select("capture_id", normalised(F.col("member")).alias("member"), "content")
    held = names.join(files, ["capture_id", "member"])
    pairs = held.groupBy("capture_id", "frame_id").agg(*[F.max(F.when(F.col("kind") == k, F.col("content"))).alias(k) for k in ("depth", "conf")]).where(
        "depth is not null and conf is not null"
    )
    columns = ["capture_id", "frame_id", "u", "v", "depth_mm", "confidence", "width", "height", "problem"]

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for capture, frame, d, c in f.itertuples(index=False):
                try:
                    z, k = png.decode(bytes(d)), png.decode(bytes(c))
                    if z.ndim != 2 or z.shape != k.shape:
                        raise ValueError(f"depth {z.shape} and confidence {k.shape} differ in size")
                except (ValueError, zlib.error, struct.error, IndexError) as e:
                    yield pd.DataFrame([(capture, frame, *[None] * 6, f"{type(e).__name__}: {e}")], columns=columns).astype({c: "Int32" for c in columns[2:8]})
                    continue
                v, u = np.mgrid[0 : z.shape[0] : stride, 0 : z.shape[1] : stride]
                yield pd.DataFrame({
                    "capture_id": capture, "frame_id": frame, "u": u.ravel().astype(np.int32), "v": v.ravel().astype(np.int32),
                    "depth_mm": z[::stride, ::stride].ravel().astype(np.int32), "confidence": k[::stride, ::stride].ravel().astype(np.int32),
                    "width": np.int32(z.shape[1]), "height": np.int32(z.shape[0]), "problem": None,
                })

    return pairs.mapInPandas(unpack, "capture_id string, frame_id string, u int, v int, depth_mm int, confidence int, width int, height int, problem string")


def inspect(members: DataFrame) -> DataFrame:
    """capture_id, member, width, height, mode, low, high, problem for PNG members."""
    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for capture, member, content in f.itertuples(index=False):
                try:
                    image = png.decode(bytes(content))
                    mode = {(2, 2): "I;16", (2, 1): "L", (3, 1): "RGB"}[image.ndim, image.dtype.itemsize]
                    out.append((capture, member, image.shape[1], image.shape[0], mode, int(image.min()), int(image.max()), None))
                except (ValueError, KeyError, zlib.error, struct.error, IndexError) as e:
                    out.append((capture, member, None, None, None, None, None, str(e)))
            yield pd.DataFrame(out, columns=["capture_id", "member", "width", "height", "mode", "low", "high", "problem"]).astype({c: "Int64" for c in ("width", "height", "low", "high")})

    return members.where("content is not null").select("capture_id", normalised(F.col("member")).alias("member"), "content").mapInPandas(
        look, "capture_id string, member string, width long, height long, mode string, low long, high long, problem string"
    )


def capture_hashes(members: DataFrame) -> DataFrame:
    """Per capture: the SHA-256 of its members, framed: name length, name, size, bytes, by name.

    The members come sorted in batches and are hashed as they pass; no capture is held in memory.
    """
    import hashlib

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, last, h = [], None, None
        for b in batches:
            for i in range(b.num_rows):
                capture, name, body = b.column(0)[i].as_py(), b.column(1)[i].as_py().encode(), b.column(2)[i].as_buffer()
                if capture != last:
                    if h is not None:
                        done.append((last, h.hexdigest()))
                    last, h = capture, hashlib.sha256()
                h.update(len(name).to_bytes(8, "big") + name + body.size.to_bytes(8, "big"))
                h.update(body)
        if h is not None:
            done.append((last, h.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.string())], ["capture_id", "sha256"])

    whole = members.where("content is not null").select("capture_id", "member", "content")
    return whole.repartition("capture_id").sortWithinPartitions("capture_id", "member").mapInArrow(work, "capture_id string, sha256 string")


def output_names(names: DataFrame, name: str = "name") -> DataFrame:
    """Adds output (a safe folder name) and collides (another name has the same, case ignored)."""
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, "(?i)\\.zip$", ""), "[^A-Za-z0-9._-]+", "-"), "^[.-]+|[.-]+$", "")
    out = names.withColumn("output", safe)
    return out.withColumn("collides", F.count("*").over(Window.partitionBy(F.lower("output"))) > 1)
