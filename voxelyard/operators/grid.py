"""Occupancy grids: cells, closing, neighbours, boundary edges, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelyard.functions.columns import cell, finite, percentile
from voxelyard.operators.cut import cut

NEAR_4 = [(1, 0), (-1, 0), (0, 1), (0, -1)]
NEAR_8 = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)]
KEY = ["cx", "cy"]


def occupancy(points: DataFrame, size: float, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
    return points.where(finite(x, y)).select(*by, cell(x, size).alias("cx"), cell(y, size).alias("cy")).distinct()


def _shifted(cells: DataFrame, offsets: list[tuple[int, int]], by: list[str]) -> DataFrame:
    """Each cell moved by each offset (repeats stay)."""
    steps = F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy")) for a, b in offsets])
    return cells.select(*by, "cx", "cy", F.explode(steps).alias("s")).select(*by, (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"))


def neighbour_counts(cells: DataFrame, by: list[str], offsets: list[tuple[int, int]] = NEAR_8) -> DataFrame:
    """cells with n_near, the occupied neighbours: an aggregate of shifted cells, no self join."""
    own = cells.select(*by, *KEY, F.lit(1).alias("own"), F.lit(0).alias("near"))
    near = _shifted(cells, offsets, by).select(*by, *KEY, F.lit(0).alias("own"), F.lit(1).alias("near"))
    return own.unionByName(near).groupBy(*by, *KEY).agg(F.max("own").alias("own"), F.sum("near").alias("n_near")).where("own = 1").drop("own")


def closed(cells: DataFrame, by: list[str], radius: int = 1) -> DataFrame:
    """Square dilation, then erosion within the dilated set."""
    square = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)]
    dilated = _shifted(cells, square, by).distinct()
    met = _shifted(dilated, square, by).groupBy(*by, *KEY).agg(F.count("*").alias("n"))
    return met.where(F.col("n") == len(square)).drop("n")


def boundary_edges(cells: DataFrame, by: list[str]) -> DataFrame:
    """Directed edges (ax, ay) -> (bx, by_) of cells without a neighbour there, counter-clockwise."""
    sides = [((0, -1), (0, 0), (1, 0)), ((1, 0), (1, 0), (1, 1)), ((0, 1), (1, 1), (0, 1)), ((-1, 0), (0, 1), (0, 0))]
    side = F.array(*[
        F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("nx", "ny", "ax", "ay", "bx", "by"), (*n, *a, *b))]) for n, a, b in sides
    ])
    every = cells.select(*by, *KEY, F.explode(side).alias("s")).select(
        *by, (F.col("cx") + F.col("s.nx")).alias("nx"), (F.col("cy") + F.col("s.ny")).alias("ny"),
        *[(F.col("cx" if c in "ax bx" else "cy") + F.col(f"s.{c}")).alias(f"{c}_") for c in ("ax", "ay", "bx", "by")],
    )
    taken = cells.select(*by, F.col("cx").alias("nx"), F.col("cy").alias("ny"))
    return every.join(taken, [*by, "nx", "ny"], "left_anti").select(*by, *[F.col(f"{c}_").alias(c if c not in by else f"{c}_") for c in ("ax", "ay", "bx")], F.col("by_").alias("by"))


def components(cells: DataFrame, by: list[str]) -> DataFrame:
    """cells with comp_x, comp_y (the smallest cell of the 4-connected component) and comp_size.

    Labels spread to neighbours and then jump to their label's label, so rounds grow with the
    logarithm of a component's width. Each round's labels are checkpointed, and the loop ends when
    nothing changes.
    """
    label = F.struct("cx", "cy")
    now = cut(cells.select(*by, *KEY).withColumn("label", label))
    while True:
        steps = F.array(*[F.struct(F.lit(a).cast("long").alias("dx"), F.lit(b).cast("long").alias("dy")) for a, b in [(0, 0), *NEAR_4]])
        told = now.select(*by, *KEY, "label", F.explode(steps).alias("s")).select(
            *by, (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"), "label",
            ((F.col("s.dx") == 0) & (F.col("s.dy") == 0)).alias("own"),
        )
        spread = told.groupBy(*by, *KEY).agg(F.min("label").alias("least"), F.max(F.when(F.col("own"), F.col("label"))).alias("label")).where("label is not null")
        jump = spread.select(*by, F.col("cx").alias("jx"), F.col("cy").alias("jy"), F.col("least").alias("further"))
        new = (
            spread.withColumn("jx", F.col("least.cx")).withColumn("jy", F.col("least.cy"))
            .join(jump, [*by, "jx", "jy"]).select(*by, *KEY, F.least("least", "further").alias("new"), "label")
        )
        new = cut(new)
        changed = new.where("new <> label").limit(1).count()
        now = new.select(*by, *KEY, F.col("new").alias("label"))
        if not changed:
            break
    sized = now.groupBy(*by, "label").agg(F.count("*").alias("comp_size"))
    return now.join(sized, [*by, "label"]).select(*by, *KEY, F.col("label.cx").alias("comp_x"), F.col("label.cy").alias("comp_y"), "comp_size")


def trimmed_centres(points: DataFrame, size: float, by: list[str], percent: float = 0.5, x: str = "x", y: str = "y", least_near: int = 2) -> DataFrame:
    """Centres of the cells that outline fitting uses.

    Points inside the percentile box, cells with enough of eight neighbours; where fewer than three
    cells survive, all of the box's cells.
    """
    low, high = percent / 100, 1 - percent / 100
    box = points.where(finite(x, y)).groupBy(*by).agg(
        *[percentile(c, p).alias(f"vy_{n}{i}") for i, c in enumerate((x, y)) for n, p in (("lo", low), ("hi", high))]
    )
    inside = points.join(box, by).where(
        F.col(x).between(F.col("vy_lo0"), F.col("vy_hi0")) & F.col(y).between(F.col("vy_lo1"), F.col("vy_hi1"))
    )
    counted = neighbour_counts(occupancy(inside, size, by, x, y), by)
    kept = counted.groupBy(*by).agg(F.count_if(F.col("n_near") >= least_near).alias("vy_kept"))
    return counted.join(kept, by).where((F.col("n_near") >= least_near) | (F.col("vy_kept") < 3)).select(
        *by, *KEY, ((F.col("cx") + 0.5) * size).alias("x"), ((F.col("cy") + 0.5) * size).alias("y")
    )
