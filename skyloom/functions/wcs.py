"""World coordinates as columns: tangent projection, linear and SIP terms, corners, separations, polygons."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EDGE_EXCLUSION, FOOTPRINT_BUFFER, INSET_LARGE, INSET_NORMAL, INSET_SMALL, PAD_SIZE, SIDES

CORNER_ORDER = ((0, 0), (0, 1), (1, 1), (1, 0))


def _lit(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def _named(**fields: Column) -> Column:
    return F.named_struct(*(x for name, c in fields.items() for x in (F.lit(name), c)))


def tan_to_sky(xi, eta, crval1, crval2) -> tuple[Column, Column]:
    """Right ascension and declination of a tangent plane's (xi, eta), all in degrees."""
    a0, d0 = F.radians(_lit(crval1)), F.radians(_lit(crval2))
    x, y = F.radians(_lit(xi)), F.radians(_lit(eta))
    rho = F.sqrt(x * x + y * y)
    c = F.atan(rho)
    centre = (F.abs(_lit(xi)) <= 1e-8) & (F.abs(_lit(eta)) <= 1e-8)
    safe = F.when(centre, F.lit(1.0)).otherwise(rho)
    dec = F.asin(F.cos(c) * F.sin(d0) + y * F.sin(c) * F.cos(d0) / safe)
    ra = a0 + F.atan2(x * F.sin(c), safe * F.cos(d0) * F.cos(c) - y * F.sin(d0) * F.sin(c))
    return F.when(centre, _lit(crval1)).otherwise(F.degrees(ra)), F.when(centre, _lit(crval2)).otherwise(F.degrees(dec))


def sky_to_tan(ra, dec, crval1, crval2) -> tuple[Column, Column]:
    a, d, d0 = F.radians(_lit(ra) - _lit(crval1)), F.radians(_lit(dec)), F.radians(_lit(crval2))
    below = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    return F.degrees(F.cos(d) * F.sin(a) / below), F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / below)


def pixel_to_sky(x, y) -> tuple[Column, Column]:
    """Of a cell row's columns; scales apply before the rotation."""
    u, v = (_lit(x) - F.col("crpix1") + 1) * F.col("cdelt1"), (_lit(y) - F.col("crpix2") + 1) * F.col("cdelt2")
    return tan_to_sky(F.col("pc1_1") * u + F.col("pc1_2") * v, F.col("pc2_1") * u + F.col("pc2_2") * v, "crval1", "crval2")


def sky_to_pixel(ra, dec) -> tuple[Column, Column]:
    """Of a cell row's columns; scales apply after the rotation, as the file standard has it."""
    xi, eta = sky_to_tan(ra, dec, "crval1", "crval2")
    a, b = F.col("cdelt1") * F.col("pc1_1"), F.col("cdelt1") * F.col("pc1_2")
    c, d = F.col("cdelt2") * F.col("pc2_1"), F.col("cdelt2") * F.col("pc2_2")
    det = a * d - b * c
    return (d * xi - b * eta) / det + F.col("crpix1") - 1, (a * eta - c * xi) / det + F.col("crpix2") - 1


def _poly(coefficients: dict[tuple[int, int], float], u: Column, v: Column) -> Column:
    out = F.lit(0.0)
    for (p, q), c in sorted(coefficients.items()):
        term = F.lit(c)
        for factor, power in ((u, p), (v, q)):
            for _ in range(power):
                term = term * factor
        out = out + term
    return out


def sip_pixel_to_sky(x, y, frame: dict) -> tuple[Column, Column]:
    """frame: crval, crpix, cd (2 x 2), a and b (coefficients by powers)."""
    xi, eta = _sip_to_tan(_lit(x), _lit(y), frame)
    return tan_to_sky(xi, eta, F.lit(frame["crval"][0]), F.lit(frame["crval"][1]))


def _sip_to_tan(x: Column, y: Column, frame: dict) -> tuple[Column, Column]:
    u, v = x + 1 - frame["crpix"][0], y + 1 - frame["crpix"][1]
    uu, vv = u + _poly(frame["a"], u, v), v + _poly(frame["b"], u, v)
    (c11, c12), (c21, c22) = frame["cd"]
    return c11 * uu + c12 * vv, c21 * uu + c22 * vv


def frame_points_on_cell(points: Column, frame: dict) -> Column:
    """An array of frame points (x, y) as points of the row's cell. Each step is a function of the one before, so that no expression is written out twice."""
    pair = lambda f, a, b: lambda p: _named(**dict(zip((a, b), f(p))))
    plane = F.transform(points, pair(lambda p: _sip_to_tan(p["x"], p["y"], frame), "xi", "eta"))
    sky = F.transform(plane, pair(lambda p: tan_to_sky(p["xi"], p["eta"], F.lit(frame["crval"][0]), F.lit(frame["crval"][1])), "ra", "dec"))
    return F.transform(sky, pair(lambda p: sky_to_pixel(p["ra"], p["dec"]), "x", "y"))


def sip_sky_to_pixel(ra, dec, frame: dict, rounds: int = 6) -> tuple[Column, Column]:
    """The inverse, by fixed-point steps on the distortion."""
    xi, eta = sky_to_tan(ra, dec, F.lit(frame["crval"][0]), F.lit(frame["crval"][1]))
    (c11, c12), (c21, c22) = frame["cd"]
    det = c11 * c22 - c12 * c21
    u0, v0 = (c22 * xi - c12 * eta) / det, (c11 * eta - c21 * xi) / det
    start = F.struct(u0.alias("u"), v0.alias("v"))
    step = lambda s, _: F.struct((u0 - _poly(frame["a"], s["u"], s["v"])).alias("u"), (v0 - _poly(frame["b"], s["u"], s["v"])).alias("v"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    return end["u"] + frame["crpix"][0] - 1, end["v"] + frame["crpix"][1] - 1


def _corner_list(lo_x, hi_x, lo_y, hi_y, side: str | None = None) -> list[Column]:
    names = [] if side is None else [F.lit(side).alias("side")]
    pick = lambda c, lo, hi: (hi if c else lo).cast("double")
    return [F.struct(*names, F.lit(i).alias("corner"), pick(cx, lo_x, hi_x).alias("px"), pick(cy, lo_y, hi_y).alias("py")) for i, (cx, cy) in enumerate(CORNER_ORDER)]


def _on_sky(points: list[Column], fields: tuple[str, ...]) -> Column:
    """One projection expression for all points, as the function of an array."""

    def one(p):
        ra, dec = pixel_to_sky(p["px"], p["py"])
        return _named(**{f: p[f] for f in fields}, ra=ra, dec=dec)

    return F.transform(F.array(*points), one)


def corners(buffer: float) -> Column:
    return _on_sky(_corner_list(F.lit(buffer), F.col("naxis1") - buffer, F.lit(buffer), F.col("naxis2") - buffer), ("corner",))


def inset_corners(large: int = INSET_LARGE, small: int = INSET_SMALL, normal: int = INSET_NORMAL) -> Column:
    """Insets by the cell's place in its 10 x 10 grid."""
    low = lambda c: F.when(F.col(c) == 0, normal).otherwise(large)
    high = lambda c: F.when(F.col(c) == 9, normal).otherwise(small)
    return _on_sky(_corner_list(low("x"), F.col("naxis1") - high("x"), low("y"), F.col("naxis2") - high("y")), ("corner",))


def centre() -> tuple[Column, Column]:
    return pixel_to_sky(F.floor(F.col("naxis1") / 2), F.floor(F.col("naxis2") / 2))


def padding_corners(pad: int = PAD_SIZE, edge: int = EDGE_EXCLUSION) -> Column:
    """The corners of the regions to pad, by side, as (side, corner, ra, dec)."""
    n1, n2 = F.col("naxis1"), F.col("naxis2")
    span = {-1: lambda n: (F.lit(-pad), F.lit(edge)), 0: lambda n: (F.lit(0), n), 1: lambda n: (n - edge, n + pad)}
    out = []
    for side, dx, dy in SIDES:
        (lx, hx), (ly, hy) = span[dx](n1), span[dy](n2)
        out += _corner_list(lx, hx, ly, hy, side)
    return _on_sky(out, ("side", "corner"))


def separation(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance in degrees."""
    a1, d1, a2, d2 = (F.radians(_lit(c)) for c in (ra1, dec1, ra2, dec2))
    h = F.pow(F.sin((d2 - d1) / 2), F.lit(2.0)) + F.cos(d1) * F.cos(d2) * F.pow(F.sin((a2 - a1) / 2), F.lit(2.0))
    return F.degrees(2 * F.asin(F.sqrt(F.least(h, F.lit(1.0)))))


def in_polygon(x, y, polygon) -> Column:
    """Even-odd rule on literal or column vertices: lower edge open, upper closed."""
    px, py, cond = _lit(x), _lit(y), F.lit(0)
    points = [(_lit(a), _lit(b)) for a, b in polygon]
    for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
        level = y1 == y2
        at = F.when(level, F.lit(0.0)).otherwise((py - y1) * (x2 - x1) / F.when(level, F.lit(1.0)).otherwise(y2 - y1) + x1)
        hit = (py > F.least(y1, y2)) & (py <= F.greatest(y1, y2)) & (px <= F.greatest(x1, x2)) & ((x1 == x2) | (px <= at))
        cond = cond + F.when(hit, 1).otherwise(0)
    return cond % 2 == 1


def octagon(width: int, height: int, buffer: int = FOOTPRINT_BUFFER) -> list[tuple[float, float]]:
    """The frame's buffered footprint: each side moved outwards, the corners cut; in order around the frame."""
    b, w, h = buffer, width, height
    return [(-b, 0), (-b, h), (0, h + b), (w, h + b), (w + b, h), (w + b, 0), (w, -b), (0, -b)]


def unit_vector(ra, dec) -> tuple[Column, Column, Column]:
    a, d = F.radians(_lit(ra)), F.radians(_lit(dec))
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def edge_normals(ring, n: int) -> list[tuple[Column, Column, Column]]:
    """The normals of the great circles through a ring's n edges. ring: column with (ra, dec) in order."""
    ring = _lit(ring)
    v = [unit_vector(ring[i]["ra"], ring[i]["dec"]) for i in range(n)]
    return [(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]) for a, b in zip(v, v[1:] + v[:1])]


def on_one_side(point, normals) -> Column:
    """Inside a convex spherical polygon: on the same side of every edge's great circle."""
    side = [n[0] * point[0] + n[1] * point[1] + n[2] * point[2] for n in normals]
    return reduce(and_, (c >= 0 for c in side)) | reduce(and_, (c <= 0 for c in side))


def footprint_normals(spark, width: int, height: int, frame: dict, buffer: int = FOOTPRINT_BUFFER) -> list[tuple[float, float, float]]:
    """The normals of the footprint's eight edges on the sky; the eight points are mapped once, on the driver."""
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(octagon(width, height, buffer))], "i int, x double, y double")
    x, y, z = unit_vector(*sip_pixel_to_sky("x", "y", frame))
    v = [tuple(r)[1:] for r in sorted(points.select("i", x.alias("ux"), y.alias("uy"), z.alias("uz")).collect())]
    return [(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]) for a, b in zip(v, v[1:] + v[:1])]


def inside_normals(ra, dec, normals) -> Column:
    """on_one_side() of a point on the sky; each step is a function of the one before, so that no expression is written out twice."""
    sky = F.array(F.struct(_lit(ra).alias("ra"), _lit(dec).alias("dec")))
    unit = F.transform(sky, lambda p: _named(**dict(zip("xyz", unit_vector(p["ra"], p["dec"])))))
    return F.transform(unit, lambda v: on_one_side([v[c] for c in "xyz"], normals))[0]


def sky_on_frame(ra, dec, frame: dict) -> Column:
    """A point on the sky as a struct (x, y) of the frame's pixels."""
    return F.transform(F.array(F.struct(_lit(ra).alias("ra"), _lit(dec).alias("dec"))), lambda p: _named(**dict(zip("xy", sip_sky_to_pixel(p["ra"], p["dec"], frame)))))[0]


def cd_matrix(cd, cdelt, pc, default: float = 1 / 3600) -> Column:
    """CD, or else CDELT times PC, or else a default scale."""
    return F.coalesce(_lit(cd), _lit(cdelt) * _lit(pc), F.lit(default))


def frame_pixels(spark, height: int, width: int, oversampling: int = 1):
    """pix, and the coordinates of each sub-pixel's centre, row by row."""
    n = oversampling
    grid = spark.range(height * n * width * n)
    at = lambda c: (c + 0.5) / n - 0.5
    return grid.select(F.col("id").alias("pix"), at(F.col("id") % (width * n)).alias("px"), at(F.floor(F.col("id") / (width * n))).alias("py"))


def half_even(c) -> Column:
    return F.bround(_lit(c), 0).cast("int")
