"""Vector, seasonal and packing arithmetic on columns; a missing value is null throughout."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


def magnitude(x: Column, y: Column) -> Column:
    return F.hypot(x, y)


def magnitude_error(x: Column, y: Column, ex: Column, ey: Column) -> Column:
    """Component errors propagated to the magnitude; null for a zero vector."""
    return F.hypot(ex * x, ey * y) / F.nullif(F.hypot(x, y), F.lit(0.0))


def magnitude_error_sum(x: Column, y: Column, ex: Column, ey: Column) -> Column:
    """The repair form: errors weighted by the components' sizes."""
    return (ex * F.abs(x) + ey * F.abs(y)) / F.nullif(F.hypot(x, y), F.lit(0.0))


def mean_count(nx: Column, ny: Column) -> Column:
    return F.ceil((nx + ny) / 2)


def along(x: Column, y: Column, fx: Column, fy: Column) -> Column:
    """Component of (x, y) along the direction of (fx, fy)."""
    return (x * fx + y * fy) / F.nullif(F.hypot(fx, fy), F.lit(0.0))


def along_abs(x: Column, y: Column, fx: Column, fy: Column) -> Column:
    """Errors combine with the absolute direction."""
    return (F.abs(x) * F.abs(fx) + F.abs(y) * F.abs(fy)) / F.nullif(F.hypot(fx, fy), F.lit(0.0))


def wrap_degrees(deg: Column) -> Column:
    """To [0, 360], where positive multiples of a full turn become 360."""
    turned = F.pmod(deg, F.lit(360.0))
    return F.when((deg > 0) & (turned == 0), F.lit(360.0)).otherwise(turned)


def seasonal(ax: Column, px: Column, ay: Column, py: Column, year: float = 365.25) -> tuple[Column, Column]:
    """Amplitude and day of maximum of the sum of two seasonal signals of one period."""
    a, b = px * (TWO_PI / year), py * (TWO_PI / year)
    re, im = ax * F.cos(a) + ay * F.cos(b), ax * F.sin(a) + ay * F.sin(b)
    return F.hypot(re, im), wrap_degrees(F.degrees(F.atan2(im, re))) * (year / 360)


def seasonal_along(fx: Column, fy: Column, ax: Column, px: Column, ay: Column, py: Column, year: float = 365.25) -> tuple[Column, Column]:
    """Seasonal amplitude and phase in the direction of the mean flow."""
    theta = F.atan2(fy, fx)
    return seasonal(ax * F.cos(theta), px, ay * F.sin(theta), py, year)


def seasonal_rotated(theta: Column, ax: Column, px: Column, ay: Column, py: Column, year: float = 365.24) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """Amplitude and phase of both components after turning the axes by ``theta``."""
    s, c = F.sin(theta), F.cos(theta)
    return seasonal(ax * c, px, -ay * s, py, year), seasonal(ax * s, px, ay * c, py, year)


def radar_components(vr: Column, va: Column, factor: Column, m: tuple[Column, Column, Column, Column], sx: Column, sy: Column) -> tuple[Column, Column]:
    """Range and azimuth displacement turned into map components by a 2x2 matrix."""
    di, dj = vr / F.nullif(factor, F.lit(0.0)), va / F.nullif(factor, F.lit(0.0))
    return m[0] * di * sx + m[1] * dj * sy, m[2] * di * sx + m[3] * dj * sy


def inverse_2x2(a: Column, b: Column, c: Column, d: Column) -> tuple[Column, Column, Column, Column]:
    det = F.nullif(a * d - b * c, F.lit(0.0))
    return d / det, -b / det, -c / det, a / det


def percent_difference(a: Column, b: Column) -> Column:
    return 100 * (a - b) / F.nullif((a + b) / 2, F.lit(0.0))


def shift_rms(sx: Column, sy: Column) -> Column:
    return F.sqrt((sx * sx + sy * sy) / 2)


def restored(matrix: Column, days: Column, valid: Column) -> Column:
    return F.when(valid.isNotNull(), matrix * days)


def noise_magnitude(ex: Column, ey: Column) -> Column:
    """Standard deviation of the length of a normal error vector with equal axes
    (Rayleigh law with the root-mean-square axis), the closed form of a simulation."""
    return F.sqrt((ex * ex + ey * ey) / 2 * (2 - math.pi / 2))


# Fill, least and largest value of each packed type.
PACKED = {"short": (-32767, -32768, 32767), "ushort": (32767, 0, 65535), "ubyte": (255, 0, 255), "mask": (0, 0, 255), "uint": (0, 0, 4294967295)}


def packed(x: Column, kind: str, clamp: bool = True) -> Column:
    """Half-even rounding to a packed integer, the fill where missing; values beyond the
    type are clamped or, without ``clamp``, fail."""
    fill, lo, hi = PACKED[kind]
    r = F.rint(x)
    r = F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(float(hi))), F.lit(float(lo)))) if clamp else F.when(r.between(lo, hi) | r.isNull(), r).otherwise(F.raise_error(F.lit(f"value beyond {kind}")).cast("double"))
    return F.coalesce(r, F.lit(float(fill))).cast("long" if kind == "uint" else "int")


def unpacked(x: Column, kind: str) -> Column:
    return F.nullif(x, F.lit(PACKED[kind][0])).cast("double")
