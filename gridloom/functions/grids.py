"""Grids, boxes and polygons on columns, and map projections in closed form (WGS 84)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACINGS = (60, 120, 240, 480, 960, 1920, 3840)  # fixed values: allowed grid spacings in metres
EDGE = 7.5  # half of a 15 m pixel
A, FLAT = 6378137.0, 1 / 298.257223563
E2 = FLAT * (2 - FLAT)
E1 = math.sqrt(E2)


def snapped(lo: Column, hi: Column, spacing: int, axis: str) -> tuple[Column, Column]:
    """Grid edges of an interval: x is rounded up less half a pixel, y down plus it."""
    if spacing not in SPACINGS:
        raise ValueError(f"grid spacing must be one of {SPACINGS}")
    turn = (lambda c: F.ceil(c / spacing) * spacing - EDGE) if axis == "x" else (lambda c: F.floor(c / spacing) * spacing + EDGE)
    ok = lambda c: F.when(lo < hi, c).otherwise(F.raise_error(F.lit(f"{axis} interval is empty")).cast("double"))
    return ok(turn(lo)), ok(turn(hi))


def centres(lo: Column, hi: Column, spacing: int, descending: bool = False) -> Column:
    """Cell centres between two snapped edges."""
    n = F.floor((hi - lo) / spacing).cast("int")
    k = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(k, lambda i: (hi - spacing / 2 - i * spacing) if descending else (lo + spacing / 2 + i * spacing))


def outward(lo: Column, hi: Column, step: float) -> tuple[Column, Column]:
    return F.floor(lo / step) * step, F.ceil(hi / step) * step


def box(points: Column) -> Column:
    """(x_min, y_min, x_max, y_max) of an array of [x, y] points."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("x_min"), F.array_min(ys).alias("y_min"), F.array_max(xs).alias("x_max"), F.array_max(ys).alias("y_max"))


def polygon_text(points: Column) -> Column:
    """Coordinates flattened, four decimals, comma-separated."""
    return F.array_join(F.transform(F.flatten(points), lambda x: F.format_string("%.4f", x)), ",")


def point_box(x: Column, y: Column, half: float = 0.001) -> Column:
    return F.array(x - half, y - half, x + half, y + half)


def densified(x0: Column, y0: Column, x1: Column, y1: Column, fractions: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75)) -> Column:
    """Closed ring of a rectangle with interior points on each side."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    ring = [F.array(a[0] + f * (b[0] - a[0]), a[1] + f * (b[1] - a[1])) for a, b in zip(corners, corners[1:] + corners[:1], strict=True) for f in map(F.lit, fractions)]
    return F.array(*ring, F.array(x0, y0))


def tile_centre(m: Column, step: int = 50) -> Column:
    """Truncated toward zero, then floored to the step."""
    return F.floor(m.cast("long") / step).cast("long") * step


def wrapped_longitude(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting over the edges of a closed ring of [x, y] points; points on an edge are outside."""
    edges = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

    def crosses(e: Column) -> Column:
        ax, ay, bx, by = e["a"][0], e["a"][1], e["b"][0], e["b"][1]
        return ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / F.nullif(by - ay, F.lit(0.0)) + ax)

    def touches(e: Column) -> Column:
        ax, ay, bx, by = e["a"][0], e["a"][1], e["b"][0], e["b"][1]
        on_line = (bx - ax) * (y - ay) == (by - ay) * (x - ax)
        return on_line & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))

    inside = F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1
    return inside & ~F.exists(edges, lambda e: F.coalesce(touches(e), F.lit(False)))


def _meridian() -> tuple[float, tuple[float, ...], tuple[float, ...]]:
    n = FLAT / (2 - FLAT)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    return radius, alpha, beta


def utm_forward(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing by Krueger's series (third order)."""
    radius, alpha, _ = _meridian()
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - E1 * F.atanh(E1 * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000 + 0.9996 * radius * x, F.when(south, 10000000.0).otherwise(0.0) + 0.9996 * radius * y


def utm_inverse(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    radius, _, beta = _meridian()
    xi0 = (y - F.when(south, 10000000.0).otherwise(0.0)) / (0.9996 * radius)
    eta0 = (x - 500000) / (0.9996 * radius)
    xi, eta = xi0, eta0
    for j, b in enumerate(beta, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = _geodetic_from_conformal(chi)
    return zone * 6 - 183 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def _geodetic_from_conformal(chi: Column) -> Column:
    e2, e4, e6, e8 = E2, E2**2, E2**3, E2**4
    return (
        chi
        + (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi)
        + (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi)
        + (7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi)
        + (4279 * e8 / 161280) * F.sin(8 * chi)
    )


def _t(phi: Column) -> Column:
    s = F.sin(phi)
    return F.tan(math.pi / 4 - phi / 2) / F.pow((1 - E1 * s) / (1 + E1 * s), F.lit(E1 / 2))


def _polar_scale(standard: float) -> float:
    phi = math.radians(standard)
    s = math.sin(phi)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - E1 * s) / (1 + E1 * s)) ** (E1 / 2)
    return A * math.cos(phi) / math.sqrt(1 - E2 * s * s) / t


def polar_forward(lon: Column, lat: Column, standard: float = 70.0, meridian: float = -45.0, south: bool = False) -> tuple[Column, Column]:
    """Polar stereographic x and y (north: 70/-45; south: 71/0)."""
    rho = _polar_scale(standard) * _t(F.radians(-lat if south else lat))
    lam = F.radians(lon - meridian)
    return rho * F.sin(lam), (rho if south else -rho) * F.cos(lam)


def polar_inverse(x: Column, y: Column, standard: float = 70.0, meridian: float = -45.0, south: bool = False) -> tuple[Column, Column]:
    t = F.hypot(x, y) / _polar_scale(standard)
    lat = F.degrees(_geodetic_from_conformal(math.pi / 2 - 2 * F.atan(t)))
    lon = meridian + F.degrees(F.atan2(x, y if south else -y))
    return wrapped_longitude(lon), (-lat if south else lat)
