"""Command line: python -m voxelyard.cli COMMAND ... Exit codes: 0, 2 for an expected error, 1 else."""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def session() -> SparkSession:
    return SparkSession.builder.appName("voxelyard").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _members(spark: SparkSession, path: str) -> DataFrame:
    from voxelyard.sources import capture as cap

    if same := cap.name_collisions(spark, path).limit(20).collect():
        raise ValueError("captures share a name: " + "; ".join(f"{r['capture_id']} ({', '.join(r['sources'])})" for r in same))
    return cap.read_archives(spark, path).unionByName(cap.read_folders(spark, path))


def _free(spark: SparkSession, out: str, overwrite: bool) -> None:
    """Refuse a result folder that holds something before any work is done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not overwrite and fs.exists(path) and len(fs.listStatus(path)):
        raise FileExistsError(f"{out} is not empty (--overwrite replaces the tables of the same names)")


def _save(tables: dict[str, DataFrame], out: str, overwrite: bool) -> None:
    """All tables or none: they are written beside the target and moved there once all are whole. Tables
    of other names stay."""
    spark = next(iter(tables.values())).sparkSession
    _free(spark, out, overwrite)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = out.rstrip("/")
    staged = f"{out}.staged-{uuid.uuid4().hex[:8]}"
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        for name, df in tables.items():
            df.write.parquet(f"{staged}/{name}")
        fs.mkdirs(path(out))
        for name in tables:
            fs.delete(path(f"{out}/{name}"), True)
            if not fs.rename(path(f"{staged}/{name}"), path(f"{out}/{name}")):
                raise OSError(f"could not move {name} to {out}")
    finally:
        fs.delete(path(staged), True)


def _show(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    (df.select(*columns) if columns else df).show(50, truncate=60)


def validate(a: argparse.Namespace) -> int:
    from voxelyard.operators.validate import validate as check

    issues, summary = check(_members(session(), a.path))
    _show(issues)
    _show(summary)
    return 0 if summary.where("not valid").isEmpty() else 2


def reconstruct(a: argparse.Namespace) -> int:
    from voxelyard.config import PROFILES
    from voxelyard.operators import runs

    got = runs.reconstruct(_members(session(), a.path), PROFILES[a.profile], evenly=not a.contiguous)
    _save({"cloud": got.cloud, "counts": got.counts}, a.out, a.overwrite)
    return 0


def run(a: argparse.Namespace) -> int:
    from voxelyard.operators import runs

    from voxelyard.config import Intervals

    spark = session()
    _free(spark, a.out, a.overwrite)
    tables = runs.results(_members(spark, a.path), a.profile, resampling=None if a.no_intervals else Intervals())
    _save(tables, a.out, a.overwrite)
    status = spark.read.parquet(f"{a.out.rstrip('/')}/status")
    _show(status)
    return 0 if not status.where("succeeded").isEmpty() else 2


def measure(a: argparse.Namespace) -> int:
    from voxelyard.operators import runs

    spark = session()
    m = runs.measure(spark.read.parquet(a.path), spark.read.parquet(a.trajectory))
    _save({n: getattr(m, n) for n in ("floors", "ceilings", "outlines", "walls", "openings", "rejections", "warnings")}, a.out, a.overwrite)
    return 0


def ablate(a: argparse.Namespace) -> int:
    from voxelyard.operators import runs

    _save({"ablation": runs.drift_ablation(_members(session(), a.path), a.profile)}, a.out, a.overwrite)
    return 0


def evaluate(a: argparse.Namespace) -> int:
    from voxelyard.operators import evaluate as ev
    from voxelyard.sources import documents

    spark = session()
    _free(spark, a.out, a.overwrite)
    odd = documents.unknown_fields(spark, a.ground_truth, {"property_id", "measurement_method", "rooms", "captures"}).limit(20).collect()
    if odd:
        raise ValueError("unknown fields in the ground truth: " + ", ".join(sorted(r["field"] for r in odd)))
    doc = documents.read_json(spark, a.ground_truth, documents.TRUTH)
    truth, groups = documents.truth_rows(doc)
    captures, rooms = documents.captures_of(doc)
    tables = {n: spark.read.parquet(f"{a.path.rstrip('/')}/{n}") for n in ("outlines", "ceilings", "walls", "openings", "status", "hashes")}
    done = tables["status"].where("succeeded").selectExpr("capture_id as capture_name")
    if wrong := ev.guarded(captures, tables["hashes"].withColumnRenamed("capture_id", "capture_name")).where("problem is not null").limit(20).collect():
        raise ValueError("; ".join(f"{r['capture_name']}: {r['problem']}" for r in wrong))
    e = ev.evaluate(truth, documents.prediction_rows(tables)).persist()
    r = ev.repeatability(e, groups)
    _save({
        "measurements": e, "repeatability": r, "openings": ev.openings_summary(e), "overall": ev.overall(e, r), "gates": ev.summary_status(e, ["metric"]),
        "tier_walls": ev.summary_status(e.where("metric = 'wall_length'"), ["tier"]), "repeatability_gates": ev.summary_status(r, ["metric"]),
        "rooms_all_tiers": ev.rooms_all_tiers(captures, rooms), "protocol": ev.protocol_warnings(captures, rooms, done),
    }, a.out, a.overwrite)
    return 0


def ingest(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from voxelyard.operators import media

    files = session().read.format("binaryFile").option("recursiveFileLookup", "true").load(a.path)
    photos = media.assets(files).withColumn("sha256", F.sha2("content", 256))
    measured = media.mark_duplicates(media.quality_reasons(media.measure(photos.where("kind = 'photo'"))))
    _save({"assets": photos.drop("content"), "photos": measured}, a.out, a.overwrite)
    return 0


def stitch(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from voxelyard.operators import register
    from voxelyard.sources import documents

    spark = session()
    _free(spark, a.out, a.overwrite)
    walls = lambda p: register.walls_as_segments(spark.read.parquet(f"{p.rstrip('/')}/walls").withColumn("pair", F.lit("pair")), ["pair"])
    if a.anchors:
        anchors = documents.anchor_rows(documents.read_json(spark, a.anchors, documents.ANCHORS))
        transform, moved, matches = register.anchored_stitch(anchors, walls(a.path), walls(a.other), ["pair"])
        outline = spark.read.parquet(f"{a.path.rstrip('/')}/outlines").withColumn("pair", F.lit("pair"))
        _save({"stitch": transform, "walls": moved, "matches": matches, "outline": register.moved_outline(outline, transform, ["pair"])}, a.out, a.overwrite)
        return 0
    _save({"stitch": register.auto_stitch(walls(a.path), walls(a.other), ["pair"])}, a.out, a.overwrite)
    return 0


def triangulate_media(a: argparse.Namespace) -> int:
    from voxelyard.operators import register
    from voxelyard.sources import documents

    doc = documents.read_json(session(), a.path, documents.MANIFEST)
    _save({"points": register.triangulate(documents.observations(doc), ["track"])}, a.out, a.overwrite)
    return 0


def screen_damage(a: argparse.Namespace) -> int:
    from voxelyard.operators import media

    files = media.assets(session().read.format("binaryFile").option("recursiveFileLookup", "true").load(a.path)).where("kind = 'photo'")
    _save({"screen": media.screen_photos(files, metres_per_pixel=a.metres_per_pixel)}, a.out, a.overwrite)
    return 0


def scope_repair(a: argparse.Namespace) -> int:
    from pyspark.sql import functions as F

    from voxelyard.operators import media
    from voxelyard.sources import documents

    spark = session()
    decisions = documents.read_json(spark, a.decisions, documents.DECISIONS)
    if decisions.where("trim(coalesce(reviewer, '')) = ''").count():
        raise ValueError("the decisions need a reviewer")
    d = decisions.select(F.explode("decisions").alias("d")).select("d.*")
    images = spark.read.parquet(f"{a.path.rstrip('/')}/screen").withColumns({
        "relative_path": F.element_at(F.split("path", "/"), -1), "classification": F.when(F.col("status") == "review_required", "crack_like_visual_anomaly"),
    })
    lines = media.repair_scope(images.select("relative_path", "classification", "maximum_candidate_extent_m", "candidate_area_m2"), d)
    wrong = lines.where("problem is not null").first()
    if wrong:
        raise ValueError(f"{wrong['relative_path']}: {wrong['problem']}")
    _save({"scope": lines.drop("problem")}, a.out, a.overwrite)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="voxelyard", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, f, *more: tuple, out: bool = True) -> None:
        c = sub.add_parser(name)
        c.add_argument("path")
        if out:
            c.add_argument("--out", required=True)
            c.add_argument("--overwrite", action="store_true")
        for flags, kw in more:
            c.add_argument(*flags, **kw)
        c.set_defaults(run=f)

    profile = (("--profile",), {"choices": ("test", "fast", "quality"), "default": "fast"})
    add("validate", validate, out=False)
    add("reconstruct", reconstruct, profile, (("--contiguous",), {"action": "store_true"}))
    plain = (("--no-intervals",), {"action": "store_true"})
    add("run", run, profile, plain)
    add("batch", run, profile, plain)
    add("measure", measure, (("--trajectory",), {"required": True}))
    add("ablate", ablate, profile)
    add("evaluate", evaluate, (("--ground-truth",), {"required": True}))
    add("ingest", ingest)
    add("stitch", stitch, (("other",), {}), (("--anchors",), {"help": "JSON with source and target points that correspond"}))
    add("triangulate-media", triangulate_media)
    add("screen-damage", screen_damage, (("--metres-per-pixel",), {"type": float}))
    add("scope-repair", scope_repair, (("--decisions",), {"required": True}))
    return p


def main(argv: Sequence[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(a)
    except (ValueError, FileExistsError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
