"""The driver's contract: entry, queries, SQL counterparts, and the guard on the optional operators."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from voxelyard import cli
from voxelyard.plans import catalog

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(rows, columns):
    def one(v):
        if isinstance(v, float):
            return None if v != v else round(v, 9) + 0.0
        return v

    return sorted(str([one(r[c]) for c in columns]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    got = [r.asDict() for r in catalog.QUERIES[name](spark, SF).collect()]
    cur = duck.execute(catalog.SQL[name])
    names = [d[0] for d in cur.description]
    want = [dict(zip(names, row)) for row in cur.fetchall()]
    assert len(got) == len(want)
    if got:
        assert sorted(got[0]) == sorted(names)
    assert norm(got, sorted(names)) == norm(want, sorted(names))


def test_wall_peel_equals_plain_peeling(spark):
    """Few captures of the small tables hold a wall: what the query gives is what peeling gives for each."""
    from voxelyard.config import Structure
    from voxelyard.operators.planes import peel_walls
    from voxelyard.plans import lens

    config = Structure(minimum_plane_inliers=8, wall_minimum_span_m=0.2, wall_minimum_height_m=0.2, wall_inlier_m=0.3)
    rows = lens.cloud(spark, SF).selectExpr("capture", "x", "z", "y + 4 as h").toPandas()
    want = sorted((c, i, round(w["offset"], 9), w["inliers"]) for c, f in rows.groupby("capture") for i, w in enumerate(peel_walls(f, config)))
    got = catalog.QUERIES["wall_peel"](spark, SF).collect()
    assert sorted((r.capture, r.wall_no, round(r.offset, 9), r.inliers) for r in got) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL) - {"wall_peel"}))
def test_query_without_sql_has_rows(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert df.columns and len(df.collect()) >= 1


def test_entry_without_the_optional_operators(tmp_path):
    for item in ("__spark_entry__.py", "voxelyard"):
        src = ROOT / item
        if src.is_dir():
            import shutil

            shutil.copytree(src, tmp_path / item, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            (tmp_path / item).write_bytes(src.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'voxel_fuse' in q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q; e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""}).returncode == 0


def test_command_line_surface():
    commands = {
        "validate", "reconstruct", "run", "batch", "measure", "ablate", "evaluate", "ingest", "stitch", "triangulate-media", "screen-damage", "scope-repair",
    }
    sub = next(a for a in cli.parser()._actions if a.choices)
    assert set(sub.choices) == commands
    with pytest.raises(SystemExit) as e:
        cli.main(["unknown"])
    assert e.value.code == 2
