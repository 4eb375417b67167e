"""Queries of the row step on whole rasters, beside the same in SQL on pixels."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..constants import SIDES
from ..operators import row_step, rows
from .registry import _TAN, query

#: A small geometry; sigma and radius of the kernel.
G = row_step.Geometry(32, 32, 8, 2, 8)
SIGMA, RADIUS = 2.0, 6
#: The second projection lies on the first, turned and shifted by less than a pixel.
TURN, SHIFT = 0.02, (0.37, -0.21)
_TOP, _BOTTOM = G.height + G.pad - G.edge, G.pad + G.edge
_SIDES = ", ".join(f"('{s}', {dx}, {dy})" for s, dx, dy in SIDES)
_CELLS = f"""own AS (SELECT cell_id, CAST(cell_id % 2 AS INT) AS projection, CAST(floor(floor(cell_id / 2) / 5) AS INT) AS row, CAST(row_number() OVER (PARTITION BY cell_id % 2, floor(floor(cell_id / 2) / 5) ORDER BY cell_id) - 1 AS INT) AS k
  FROM (SELECT DISTINCT cell_id FROM {{image}}) i),
heads AS (SELECT cell_id, projection, row, k, {G.width} AS naxis1, {G.height} AS naxis2, 3e1 AS crval1, -2e1 AS crval2, 405e-1 + {SHIFT[0]}e0 * projection - {G.step} * k AS crpix1, 405e-1 + {SHIFT[1]}e0 * projection - {G.shift} * row AS crpix2,
  -1e-3 AS cdelt1, 1e-3 AS cdelt2, cos({TURN}e0 * projection) AS pc1_1, -sin({TURN}e0 * projection) AS pc1_2, sin({TURN}e0 * projection) AS pc2_1, cos({TURN}e0 * projection) AS pc2_2 FROM own),
needs AS (SELECT DISTINCT a.cell_id, s.side, b.cell_id AS source FROM heads a CROSS JOIN (SELECT * FROM (VALUES {_SIDES}) AS t(side, dx, dy)) s
  JOIN heads b ON b.projection <> a.projection AND (b.row = a.row AND b.k = a.k OR b.row = a.row + s.dy AND b.k = a.k + s.dx))"""


def _needs(heads):
    """The rows of `needs`: its either-or as two joins, each of them with keys, so that cells don't meet all cells."""
    a = heads.select("cell_id", "projection", "row", "k", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for s, dx, dy in SIDES))).alias("s"))
    b = heads.select(F.col("cell_id").alias("source"), F.col("projection").alias("other"), "row", "k")
    at = lambda row, k: a.select("cell_id", "projection", F.col("s.side").alias("side"), row.alias("row"), k.alias("k")).join(b, ["row", "k"])
    both = at(F.col("row"), F.col("k")).unionByName(at(F.col("row") + F.col("s.dy"), F.col("k") + F.col("s.dx")))
    return both.where("other <> projection").select("cell_id", "side", "source").distinct()


def _setting(r):
    """The cells' headers, what each needs of the other projection, and their rasters as a bucketed table."""
    image = r("image")
    spark = image.sparkSession
    heads = spark.sql(f"WITH {_CELLS} SELECT * FROM heads", image=image)
    needs = _needs(heads)
    rasters = rows.rasters(image, ["cell_id"], G.height, G.width, {"value": float("nan")}).withColumnRenamed("value", "data")
    return row_step.store_rasters(rasters, heads, 8), row_step.padding_jobs(heads, needs, G)


def _long(rasters, y: str, x: str, value: str):
    at = rasters.select("cell_id", "w", F.posexplode("data").alias("at", "v")).where(~F.isnan("v"))
    return at.select("cell_id", F.floor(F.col("at") / F.col("w")).cast("int").alias(y), (F.col("at") % F.col("w")).alias(x), F.round("v", 6).alias(value))


def _sky(px: str, py: str, cols: str, source: str) -> str:
    """ra, dec in radians of pixels of a local header: cd_ij, crval in radians, u and v from its reference pixel."""
    return f"""SELECT {cols}, a0 + atan2(xi, cos(d0) - eta * sin(d0)) AS ra, atan2(sin(d0) + eta * cos(d0), sqrt(xi * xi + (cos(d0) - eta * sin(d0)) * (cos(d0) - eta * sin(d0)))) AS dec
  FROM (SELECT *, radians(cdelt1 * pc1_1 * ({px}) + cdelt1 * pc1_2 * ({py})) AS xi, radians(cdelt2 * pc2_1 * ({px}) + cdelt2 * pc2_2 * ({py})) AS eta FROM {source})"""


#: The rows' arrays with the rims of the rows beside them, from heads and image.
_ROWS = f"""raster AS (SELECT h.cell_id, projection, row, k, CAST(a.range AS INT) AS y, CAST(b.range AS INT) AS x, coalesce(i.value, 'NaN') AS value FROM heads h CROSS JOIN range({G.height}) a CROSS JOIN range({G.width}) b
  LEFT JOIN image i ON i.cell_id = h.cell_id AND i.y = a.range AND i.x = b.range),
placed AS (SELECT projection, row, y + {G.pad} AS my, {G.pad} + k * {G.step} + x AS mx, arg_max(value, k) AS value FROM raster WHERE k = 0 OR x >= {G.keep} GROUP BY ALL),
pairs AS (SELECT projection, row, lag(row) OVER (PARTITION BY projection ORDER BY row) AS before, lead(row) OVER (PARTITION BY projection ORDER BY row) AS after FROM (SELECT DISTINCT projection, row FROM heads)),
p AS (SELECT * FROM placed JOIN pairs USING (projection, row)),
crossed AS (SELECT projection, row, my, mx, value FROM p WHERE (after IS NULL OR my < {_TOP}) AND (before IS NULL OR my >= {_BOTTOM})
  UNION ALL SELECT projection, before, my + {G.shift}, mx, value FROM p WHERE before IS NOT NULL AND my >= {_TOP - G.shift} AND my < {G.window[0] - G.shift}
  UNION ALL SELECT projection, after, my - {G.shift}, mx, value FROM p WHERE after IS NOT NULL AND my >= {G.shift} AND my < {G.shift + _BOTTOM})"""
_WINDOWS = f"""WITH {_CELLS.replace("{image}", "image")},
{_ROWS},
sides AS (SELECT n.*, h.* EXCLUDE (cell_id), {G.pad} + k * {G.step} AS s, CASE WHEN contains(side, 'top') OR contains(side, 'bottom') THEN {G.width} ELSE {_BOTTOM} END AS w,
  CASE WHEN contains(side, 'left') OR contains(side, 'right') THEN {G.height} ELSE {_BOTTOM} END AS h FROM needs n JOIN heads h USING (cell_id)),
centred AS (SELECT *, CASE WHEN contains(side, 'right') THEN s + {G.width} + {(G.pad - G.edge) / 2}e0 WHEN contains(side, 'left') THEN s - {(G.pad - G.edge) / 2}e0 ELSE s + {G.width / 2}e0 END AS cx,
  CASE WHEN contains(side, 'bottom') THEN {_BOTTOM / 2}e0 WHEN contains(side, 'top') THEN {G.pad + G.height} + {(G.pad - G.edge) / 2}e0 ELSE {G.pad + G.height / 2}e0 END AS cy FROM sides),
sky AS ({_TAN.format(k="cell_id, side, source, k, projection, row, w, h, cx, cy, cdelt1, cdelt2, pc1_1, pc1_2, pc2_1, pc2_2", src=f"SELECT *, cx - s AS px, cy - {G.pad} AS py FROM centred")}),
regions AS (SELECT *, CAST(trunc(cy - h / 2.0) AS INT) AS y0, CAST(trunc(cx - w / 2.0) AS INT) AS x0, radians(ra) AS a0, radians(dec) AS d0 FROM sky),
kept AS (SELECT r.* EXCLUDE (ra, dec) FROM regions r JOIN (SELECT projection, max(k) AS most FROM heads GROUP BY 1) m USING (projection) WHERE y0 >= 0 AND x0 >= 0 AND y0 + h <= {G.window[0]} AND x0 + w <= {2 * G.pad + G.width} + most * {G.step}),
points AS ({_sky("x - w / 2.0", "y - h / 2.0", "source, side, projection, row, y0 + y - 1 AS my, x0 + x - 1 AS mx", "(SELECT k.*, unnest(range(1, w + 1)) AS x, y FROM (SELECT *, unnest(range(1, h + 1)) AS y FROM kept) k)")}),
back AS (SELECT p.*, h.crpix1, h.crpix2, h.cdelt1 * h.pc1_1 AS a, h.cdelt1 * h.pc1_2 AS b, h.cdelt2 * h.pc2_1 AS c, h.cdelt2 * h.pc2_2 AS d, radians(crval2) AS d1, ra - radians(crval1) AS da FROM (SELECT source, side, projection, row, my, mx, ra, dec FROM points) p JOIN heads h ON h.cell_id = p.source),
plane AS (SELECT *, degrees(cos(dec) * sin(da) / f) AS xi, degrees((cos(d1) * sin(dec) - sin(d1) * cos(dec) * cos(da)) / f) AS eta FROM (SELECT *, sin(d1) * sin(dec) + cos(d1) * cos(dec) * cos(da) AS f FROM back)),
spots AS (SELECT source, side, projection, row, my, mx, (d * xi - b * eta) / (a * d - b * c) + crpix1 - 1 AS sx, (a * eta - c * xi) / (a * d - b * c) + crpix2 - 1 AS sy FROM plane),
clean AS (SELECT cell_id AS source, y, x, value FROM raster WHERE NOT isnan(value) AND y >= {G.edge} AND x >= {G.edge} AND y < {G.height - G.edge} AND x < {G.width - G.edge}),
taps AS (SELECT spots.*, CASE WHEN dy = 1 THEN sy - floor(sy) ELSE 1 - sy + floor(sy) END * CASE WHEN dx = 1 THEN sx - floor(sx) ELSE 1 - sx + floor(sx) END AS weight, CAST(floor(sy) AS INT) + dy AS y, CAST(floor(sx) AS INT) + dx AS x FROM spots CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(dy, dx)),
seen AS (SELECT source, side, projection, row, my, mx, sum(weight * value) AS value FROM taps JOIN clean USING (source, y, x) GROUP BY ALL HAVING count(*) = 4),
new AS (SELECT projection, row, my, mx, arg_max(value, (source, side)) AS value FROM seen GROUP BY ALL),
full_rows AS (SELECT projection, row, my, mx, coalesce(n.value, c.value) AS value FROM crossed c FULL JOIN new n USING (projection, row, my, mx))"""


@query(_WINDOWS + f"""
SELECT h.cell_id, CAST(my AS INT) AS wy, CAST(mx - k * {G.step} AS INT) AS wx, round(value, 6) AS value FROM full_rows f JOIN heads h ON h.projection = f.projection AND h.row = f.row AND f.mx >= h.k * {G.step} AND f.mx < h.k * {G.step} + {G.window[1]} WHERE NOT isnan(value)""")
def cross_projection_padding(r):
    """What surrounds each cell, its row's neighbours, the rims of the rows beside it, and padding resampled from the cells of the other projection."""
    rasters, jobs = _setting(r)
    return _long(row_step.around(rasters, row_step.pieces_of(rasters, G, jobs), G), "wy", "wx", "value")


_KERNEL = [math.exp(-d * d / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
_WEIGHTS = ", ".join(f"({d}, {w / sum(_KERNEL)!r}e0)" if "e" not in repr(w / sum(_KERNEL)) else f"({d}, {w / sum(_KERNEL)!r})" for d, w in zip(range(-RADIUS, RADIUS + 1), _KERNEL))


#: The convolved cells, smooth, from heads and full_rows.
_SMOOTH = f"""g(d, g) AS (VALUES {_WEIGHTS}),
down AS (SELECT projection, row, my + d AS my, mx, sum(value * g) AS value FROM full_rows CROSS JOIN g WHERE NOT isnan(value) GROUP BY projection, row, my + d, mx),
both_ways AS (SELECT projection, row, my, mx + d AS mx, sum(value * g) AS value FROM down CROSS JOIN g GROUP BY projection, row, my, mx + d),
smooth AS (SELECT h.cell_id, CAST(b.my - {G.pad} AS INT) AS y, CAST(b.mx - {G.pad} - k * {G.step} AS INT) AS x, b.value AS smooth FROM both_ways b JOIN full_rows f ON f.projection = b.projection AND f.row = b.row AND f.my = b.my AND f.mx = b.mx AND NOT isnan(f.value)
JOIN heads h ON h.projection = b.projection AND h.row = b.row AND b.my >= {G.pad} AND b.my < {G.pad + G.height} AND b.mx >= {G.pad} + h.k * {G.step} AND b.mx < {G.pad} + h.k * {G.step} + {G.width})"""


@query(_WINDOWS + ",\n" + _SMOOTH + "SELECT cell_id, y, x, round(smooth, 6) AS smooth FROM smooth")
def row_step_smooth(r):
    """Every cell's raster after its row's step: rims, padding, convolution, extraction."""
    rasters, jobs = _setting(r)
    return _long(row_step.row_step(rasters, G, jobs, SIGMA, RADIUS), "y", "x", "smooth")
