"""Map projection and sphere columns: polar stereographic and transverse Mercator on the lunar sphere.

All functions take and give columns, so they stay inside generated code. Projections are described by six columns, by
default named kind ('ps' or 'tm'), lat0, lon0, k0, fe, fn.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

#: Radius of the sphere in metres.
RADIUS = 1_737_400.0


class Projection:
    """The columns of a projection; ``prefix`` names another set of them."""

    def __init__(self, prefix: str = ""):
        self.kind, self.lat0, self.lon0, self.k0, self.fe, self.fn = (F.col(prefix + c) for c in ("kind", "lat0", "lon0", "k0", "fe", "fn"))


def wrap(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360)) - 180


def published(value: Column, digits: int = 6) -> Column:
    return F.round(value, digits)


def published_longitude(lon: Column, digits: int = 6) -> Column:
    """Rounded longitude; 180 after rounding becomes -180."""
    r = F.round(lon, digits)
    return F.when(r >= 180, r - 360).otherwise(r)


def forward(p: Projection, lat: Column, lon: Column) -> tuple[Column, Column]:
    """(x, y) in metres."""
    k = p.k0 * RADIUS
    phi, lam = F.radians(lat), F.radians(lon - p.lon0)
    s = F.when(p.lat0 < 0, 1.0).otherwise(-1.0)
    rho = 2 * k * F.tan(math.pi / 4 + s * phi / 2)
    b = F.cos(phi) * F.sin(lam)
    ps = p.kind == "ps"
    x = F.when(ps, p.fe + rho * F.sin(lam)).otherwise(p.fe + k / 2 * F.log((1 + b) / (1 - b)))
    y = F.when(ps, p.fn + s * rho * F.cos(lam)).otherwise(p.fn + k * (F.atan2(F.tan(phi), F.cos(lam)) - F.radians(p.lat0)))
    return x, y


def inverse(p: Projection, x: Column, y: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees; the longitude is wrapped, at a pole it is the central meridian."""
    k = p.k0 * RADIUS
    dx, dy = x - p.fe, y - p.fn
    s = F.when(p.lat0 < 0, 1.0).otherwise(-1.0)
    c = 2 * F.atan(F.hypot(dx, dy) / (2 * k))
    d = dy / k + F.radians(p.lat0)
    ps = p.kind == "ps"
    lat = F.when(ps, s * (c - math.pi / 2)).otherwise(F.asin(F.sin(d) / F.cosh(dx / k)))
    lon = F.when(ps & (dx == 0) & (dy == 0), 0.0).when(ps, F.atan2(dx, s * dy)).otherwise(F.atan2(F.sinh(dx / k), F.cos(d)))
    return F.degrees(lat), wrap(F.degrees(lon) + p.lon0)


def pixel_to_lonlat(p: Projection, x_min: Column, y_max: Column, px: Column, col: Column, row: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of continuous pixel coordinates whose origin is the outer corner of the upper left pixel."""
    return inverse(p, x_min + col * px, y_max - row * px)


def lonlat_to_pixel(p: Projection, x_min: Column, y_max: Column, px: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """(col, row)."""
    x, y = forward(p, lat, lon)
    return (x - x_min) / px, (y_max - y) / px


def scale_factor(p: Projection, lat: Column, lon: Column) -> Column:
    """The point scale factor, in closed form."""
    phi, lam = F.radians(lat), F.radians(lon - p.lon0)
    return F.when(p.kind == "ps", p.k0 * 2 / (1 + F.sin(F.abs(phi)))).otherwise(p.k0 / F.sqrt(1 - F.pow(F.cos(phi) * F.sin(lam), F.lit(2))))


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), F.lit(2)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * RADIUS * F.asin(F.sqrt(F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0))))


def bearing(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Azimuth from a point to another, clockwise from north, 0 to 360."""
    p1, p2, dl = F.radians(lat), F.radians(to_lat), F.radians(to_lon - lon)
    return F.pmod(F.degrees(F.atan2(F.sin(dl) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl))), F.lit(360.0))


def mean_coordinate(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Aggregates: the direction of the mean of the points' vectors."""
    p, q = F.radians(lat), F.radians(lon)
    x, y, z = F.avg(F.cos(p) * F.cos(q)), F.avg(F.cos(p) * F.sin(q)), F.avg(F.sin(p))
    return F.degrees(F.atan2(z, F.hypot(x, y))), F.degrees(F.atan2(y, x))


#: Names of projections in parameter strings, and of the kinds here.
KINDS = {"stere": "ps", "tmerc": "tm"}


def projection_of(crs: Column) -> Column:
    """A ``+proj=... +lat_0=...`` string as struct(kind, lat0, lon0, k0, fe, fn, radius); null for other projections.

    Parameters that are missing have the value that leaves a map unchanged.
    """
    found = F.str_to_map(F.regexp_replace(crs, r"\+", ""), F.lit(" "), F.lit("="))
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.element_at(found, "proj"))

    def number(default: float, *names: str) -> Column:
        return F.coalesce(*[F.element_at(found, n).try_cast("double") for n in names], F.lit(default))

    return F.when(kind.isNotNull(), F.struct(kind.alias("kind"), number(0.0, "lat_0").alias("lat0"), number(0.0, "lon_0").alias("lon0"), number(1.0, "k", "k_0").alias("k0"),
                                             number(0.0, "x_0").alias("fe"), number(0.0, "y_0").alias("fn"), number(RADIUS, "R").alias("radius")))


def grid_record(x_min: Column, y_max: Column, px: Column, py: Column, width: Column, height: Column) -> Column:
    """The published grid: origin to the millimetre, pixel sizes to the micrometre."""
    return F.struct(F.round(x_min, 3).alias("x_min"), F.round(y_max, 3).alias("y_max"), F.round(px, 6).alias("px"), F.round(py, 6).alias("py"), width.cast("int").alias("width"), height.cast("int").alias("height"))


def footprint_key(kind: Column, lat0: Column, lon0: Column, x_min: Column, y_max: Column, width_m: Column, height_m: Column, digits: int = 3) -> Column:
    """Projection and rounded grid box as one text: equal for observations that share a footprint."""
    edges = (x_min, x_min + width_m, y_max - height_m, y_max)
    return F.concat_ws("|", kind, lat0.cast("string"), lon0.cast("string"), *[F.round(e, digits).cast("string") for e in edges])


def north_up(a: Column, b: Column, d: Column, e: Column) -> Column:
    """Whether an affine transform has no rotation, columns to the east and rows to the south."""
    return (b == 0) & (d == 0) & (a > 0) & (e < 0)
