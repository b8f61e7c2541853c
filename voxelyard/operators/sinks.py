"""Outputs: density rasters, PLY clouds, SVG plans, JSON documents, Markdown reports, staged writes.

Tables are best written as Parquet by Spark. The files here are for people: one capture's small,
already reduced results, collected on the driver.
"""

from __future__ import annotations

import json
import math
import os
import shutil
import tempfile
from collections.abc import Iterable
from html import escape
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.functions.columns import percentile
from voxelyard.sources import png


def topdown(points: DataFrame, by: list[str], size: int = 1000, a: str = "x", b: str = "z") -> DataFrame:
    """2-D histogram of each capture seen from above: bx, bz, n, shade = log(1 + n). The range is the
    0.5th to the 99.5th percentile, widened by 5 %."""
    box = points.groupBy(*by).agg(*[percentile(c, p).alias(f"{n}_{c}") for c in (a, b) for n, p in (("lo", 0.005), ("hi", 0.995))])
    for c in (a, b):
        wide = 0.05 * (F.col(f"hi_{c}") - F.col(f"lo_{c}"))
        box = box.withColumns({f"vy_lo_{c}": F.col(f"lo_{c}") - wide, f"vy_hi_{c}": F.col(f"hi_{c}") + wide})
    met = points.join(box, by).where(" and ".join(f"{c} between vy_lo_{c} and vy_hi_{c}" for c in (a, b)))
    at = lambda c: F.least(F.floor((F.col(c) - F.col(f"vy_lo_{c}")) / ((F.col(f"vy_hi_{c}") - F.col(f"vy_lo_{c}")) / size)), F.lit(size - 1)).cast("long")
    return met.groupBy(*by, at(a).alias("bx"), at(b).alias("bz")).agg(F.count("*").alias("n")).withColumn("shade", F.log1p("n"))


def topdown_png(rows: Iterable, size: int) -> bytes:
    """rows of topdown for one capture to a grey image."""
    image = np.zeros((size, size))
    for bx, bz, shade in rows:
        image[size - 1 - bz, bx] = shade
    top = image.max() or 1.0
    return png.encode(np.rint(255 * (1 - image / top)).astype(np.uint8))


def ply(points: np.ndarray, ascii_form: bool = False) -> bytes:
    """A point cloud; points that aren't finite are an error."""
    p = np.asarray(points, "<f4").reshape(-1, 3)
    if not np.isfinite(p).all():
        raise ValueError("a point is not finite")
    kind = "ascii" if ascii_form else "binary_little_endian"
    head = f"ply\nformat {kind} 1.0\nelement vertex {len(p)}\nproperty float x\nproperty float y\nproperty float z\nend_header\n"
    body = "".join(f"{x:.9g} {y:.9g} {z:.9g}\n" for x, y, z in p.tolist()).encode() if ascii_form else p.tobytes()
    return head.encode() + body


def read_ply(data: bytes) -> np.ndarray:
    head, _, body = data.partition(b"end_header\n")
    n = int(next(line.split()[2] for line in head.decode().splitlines() if line.startswith("element vertex")))
    if b"format ascii" in head:
        return np.array([[*map(float, line.split())] for line in body.decode().splitlines()[:n]], np.float32).reshape(-1, 3)
    return np.frombuffer(body, "<f4", 3 * n).reshape(-1, 3).copy()


def plan_svg(vertices: list[tuple[float, float]], title: str = "", openings: Iterable[tuple[float, float, float, float]] = (), most_labels: int = 14) -> str:
    """A floor plan: the outline with edge lengths (the longest ones where there are many)."""
    v = np.array(vertices, float)
    low, span = v.min(0), float(max(np.ptp(v, axis=0).max(), 1e-6))
    k = 800 / span
    at = lambda p: (40 + (p[0] - low[0]) * k, 40 + (low[1] + span - p[1]) * k)
    points = " ".join(f"{x:.1f},{y:.1f}" for x, y in map(at, v))
    edges = [(v[i], v[(i + 1) % len(v)]) for i in range(len(v))]
    edges.sort(key=lambda e: -math.hypot(*(e[1] - e[0])))
    labels = "".join(
        f'<text x="{x:.1f}" y="{y:.1f}" font-size="14">{math.hypot(*(b - a)):.2f} m</text>' for a, b in (edges[:most_labels] if len(edges) > 12 else edges) for x, y in [at((a + b) / 2)]
    )
    gaps = "".join('<line x1="{:.1f}" y1="{:.1f}" x2="{:.1f}" y2="{:.1f}" stroke="red" stroke-width="4"/>'.format(*at((o[0], o[1])), *at((o[2], o[3]))) for o in openings)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="880" height="880"><title>{escape(title)}</title><polygon points="{points}" fill="#eee" stroke="black" stroke-width="2"/>{gaps}{labels}</svg>\n'


def path_svg(xz: list[tuple[float, float]], title: str = "") -> str:
    v = np.array(xz, float).reshape(-1, 2)
    low, span = (v.min(0), float(max(np.ptp(v, axis=0).max(), 1e-6))) if len(v) else (np.zeros(2), 1.0)
    k = 800 / span
    points = " ".join(f"{40 + (x - low[0]) * k:.1f},{40 + (low[1] + span - z) * k:.1f}" for x, z in v)
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="880" height="880"><title>{escape(title)}</title><polyline points="{points}" fill="none" stroke="steelblue" stroke-width="2"/></svg>\n'


def document(value: object) -> str:
    return json.dumps(value, indent=2, ensure_ascii=False, default=str) + "\n"


def report(title: str, sections: dict[str, list[dict]]) -> str:
    """Markdown: a table for each section; empty ones say so."""
    out = [f"# {title}", ""]
    for name, rows in sections.items():
        out += [f"## {name}", ""]
        if not rows:
            out += ["None.", ""]
            continue
        cols = [*rows[0]]
        cell = lambda x: "unavailable" if x is None else f"{x:.3f}" if isinstance(x, float) else str(x).replace("|", "\\|").replace("\n", " ")
        out += ["| " + " | ".join(cols) + " |", "|" + " --- |" * len(cols), *("| " + " | ".join(cell(r[c]) for c in cols) + " |" for r in rows), ""]
    return "\n".join(out)


def publish(files: dict[str, bytes | str], folder: str | Path, overwrite: bool = False) -> None:
    """Writes all files or none: into a folder beside the target, then renamed one by one.

    Existing files of the same names are an error unless overwrite; other files stay.
    """
    target = Path(folder)
    taken = [n for n in files if (target / n).exists()]
    if taken and not overwrite:
        raise FileExistsError(f"{target}: {', '.join(sorted(taken))}")
    target.mkdir(parents=True, exist_ok=True)
    staged = Path(tempfile.mkdtemp(prefix=".staged-", dir=target.parent))
    try:
        for name, body in files.items():
            (staged / name).write_bytes(body.encode() if isinstance(body, str) else body)
        for name in files:
            os.replace(staged / name, target / name)
    finally:
        shutil.rmtree(staged, ignore_errors=True)
