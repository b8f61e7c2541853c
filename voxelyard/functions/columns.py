"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiplier and increment of the portable generator, modulo 2^31 (fixed values).
LCG = (1103515245, 12345, 1 << 31)


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cell(x: str | Column, size: float) -> Column:
    """The index of the grid cell that holds x."""
    return F.floor(col(x).cast("double") / F.lit(size)).cast("long")


def finite(*xs: str | Column) -> Column:
    out = F.lit(True)
    for x in xs:
        x = col(x).cast("double")
        out = out & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return out


def lcg(seed: Column) -> Column:
    """A number in 0 .. 2^31 - 1 from an integer seed; the same in any SQL engine."""
    a, c, m = LCG
    return (F.lit(a).cast("long") * F.pmod(seed.cast("long"), F.lit(m).cast("long")) + F.lit(c)) % F.lit(m).cast("long")


def dot(a: tuple, b: tuple) -> Column:
    out = col(a[0]) * col(b[0])
    for x, y in zip(a[1:], b[1:]):
        out = out + col(x) * col(y)
    return out


def cross(a: tuple, b: tuple) -> tuple[Column, Column, Column]:
    a, b = [*map(col, a)], [*map(col, b)]
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def percentile(x: str | Column, p: float) -> Column:
    """Exact, linear between neighbours."""
    return F.percentile(col(x), F.lit(p))


def between(low: Column, high: Column, part: Column) -> Column:
    """low (1 - part) + high part, the first product not rounded before the sum, as a fused multiply-add gives it.

    DuckDB's quantile_cont is computed so; bins and roundings at ties follow its last bit. The product's rounding error
    comes from halves of the factors (Dekker), the sum's from two-sum; where halving overflows the plain sum stands.
    """
    def halves(x: Column) -> tuple[Column, Column]:
        c = x * F.lit(134217729.0)
        top = c - (c - x)
        return top, x - top

    rest = F.lit(1.0) - part
    (a, b), (c, d) = halves(low), halves(rest)
    product, other = low * rest, high * part
    lost = ((a * c - product) + a * d + b * c) + b * d
    total = product + other
    back = total - product
    fused = total + (((product - (total - back)) + (other - back)) + lost)
    return F.when(part == 0, low).when(finite(fused), fused).otherwise(total)


def rounded(x: str | Column, digits: int) -> Column:
    """Rounded, without a negative zero."""
    return F.round(col(x), digits) + F.lit(0.0)
