"""Boxes, Hilbert order and the Albers equal-area projection as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extent over which boxes are put in Hilbert order: x0, y0, x1, y1.
EXTENT = (-2356095.0, 270000.0, 2260000.0, 3175000.0)
#: Left and top of the pixel grid that regions are snapped to.
GRID_LEFT, GRID_TOP, GRID_PIXEL = -2356095.0, 3172605.0, 30.0
HILBERT_BITS = 16

# GRS80 and the conterminous Albers parallels, origin and central meridian.
A, INV_F = 6378137.0, 298.257222101
PARALLELS, LAT0, LON0 = (29.5, 45.5), 23.0, -96.0
_E2 = 2 / INV_F - 1 / INV_F**2
_E = math.sqrt(_E2)


def box_overlap(a: str, b: str) -> Column:
    """Area of the intersection of boxes a and b (aliases with xmin, ymin, xmax, ymax)."""
    side = lambda lo, hi: F.least(F.col(f"{a}.{hi}"), F.col(f"{b}.{hi}")) - F.greatest(F.col(f"{a}.{lo}"), F.col(f"{b}.{lo}"))
    zero = F.lit(0)
    return F.greatest(side("xmin", "xmax"), zero) * F.greatest(side("ymin", "ymax"), zero)


def bbox_filter(x0: float, y0: float, x1: float, y1: float) -> Column:
    """Boxes that touch a window; plain comparisons, so that row groups are skipped."""
    return (F.col("xmax") >= x0) & (F.col("xmin") <= x1) & (F.col("ymax") >= y0) & (F.col("ymin") <= y1)


def hilbert(x: Column, y: Column, bits: int = HILBERT_BITS) -> Column:
    """Position of cell (x, y) on the Hilbert curve of 2**bits cells a side."""
    long = lambda v: F.lit(v).cast("bigint")
    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), long(0).alias("d"))

    def step(acc: Column, k: Column) -> Column:
        s = F.expr("1L")
        s = F.call_function("shiftleft", s, k)
        rx = (acc["x"].bitwiseAND(s) > 0).cast("bigint")
        ry = (acc["y"].bitwiseAND(s) > 0).cast("bigint")
        d = acc["d"] + s * s * ((3 * rx).bitwiseXOR(ry))
        flip = (ry == 0) & (rx == 1)
        fx = F.when(flip, s - 1 - acc["x"].bitwiseAND(s - 1)).otherwise(acc["x"].bitwiseAND(s - 1))
        fy = F.when(flip, s - 1 - acc["y"].bitwiseAND(s - 1)).otherwise(acc["y"].bitwiseAND(s - 1))
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["d"])


def hilbert_of_box(xmin: Column, ymin: Column, xmax: Column, ymax: Column, extent: tuple[float, float, float, float] = EXTENT) -> Column:
    """Hilbert position of a box's centre within an extent; outside it is clamped."""
    top = (1 << HILBERT_BITS) - 1
    cell = lambda mid, lo, hi: F.least(F.greatest(F.floor((mid - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(top + 1))), F.lit(0)), F.lit(top))
    return hilbert(cell((xmin + xmax) / 2, extent[0], extent[2]), cell((ymin + ymax) / 2, extent[1], extent[3]))


def _q(sin: float) -> float:
    return (1 - _E2) * (sin / (1 - _E2 * sin * sin) - math.log((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))


def albers_constants() -> tuple[float, float, float]:
    """(n, C, rho0) of the projection."""
    m2 = lambda p: math.cos(p) ** 2 / (1 - _E2 * math.sin(p) ** 2)
    p1, p2 = map(math.radians, PARALLELS)
    q1, q2, q0 = (_q(math.sin(p)) for p in (p1, p2, math.radians(LAT0)))
    n = (m2(p1) - m2(p2)) / (q2 - q1)
    c = m2(p1) + n * q1
    return n, c, A * math.sqrt(c - n * q0) / n


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres (Snyder, USGS PP 1395, 1987, p. 101)."""
    n, c, rho0 = albers_constants()
    sin = F.sin(F.radians(lat))
    q = (1 - _E2) * (sin / (1 - _E2 * sin * sin) - F.ln((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))
    rho = A * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - LON0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column, rounds: int = 6) -> tuple[Column, Column]:
    """Metres to degrees, with a fixed number of refinements."""
    n, c, rho0 = albers_constants()
    dy = rho0 - y
    q = (c - (x * x + dy * dy) * (n * n) / (A * A)) / n

    def refine(phi: Column, _: Column) -> Column:
        s = F.sin(phi)
        w = 1 - _E2 * s * s
        return phi + w * w / (2 * F.cos(phi)) * (q / (1 - _E2) - s / w + F.ln((1 - _E * s) / (1 + _E * s)) / (2 * _E))

    lat = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.asin(q / 2), refine)
    return LON0 + F.degrees(F.atan2(x, dy)) / n, F.degrees(lat)
