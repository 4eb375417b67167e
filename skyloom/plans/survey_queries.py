"""The whole run on the test tables, beside the same in one SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.work import folder
from .registry import _A, _FLAT, _FOOTPRINT, _OWN, _SIP, _TAN, _W, _XYZ, FRAME, _edge, _sip_of, query
from .row_steps import _ROWS, _SMOOTH, RADIUS, SIGMA, G
from .survey import Setting, survey_run

#: A cell's rim by its place in the grid; frame offsets are scaled so that they are whole cell pixels.
INSET, SCALE = (4, 2, 1), 20
#: Projections lie side by side under the frame, each a little off so that no two centres are equally near.
_CELLS = f"""SELECT cell_id, projection, y, x, {G.width} AS naxis1, {G.height} AS naxis2, 31e0 + (projection % 3 - 1) * 55e-2 + (projection - 2000) * 137e-4 AS crval1, -19e0 + (floor(projection / 3) % 3 - 1) * 55e-2 + (projection - 2000) * 91e-4 AS crval2,
  165e-1 - (x - 7) * {G.step}e0 AS crpix1, 165e-1 - (y - 7) * {G.shift}e0 AS crpix2, 1e0 AS pc1_1, 0e0 AS pc1_2, 0e0 AS pc2_1, 1e0 AS pc2_2, -5e-3 AS cdelt1, 5e-3 AS cdelt2 FROM {{cells}}"""

_OF = "survey AS MATERIALIZED (" + _CELLS.replace("{cells}", "cells") + ")"
_STEPS = "(VALUES (0, -5e-1, -5e-1), (1, -5e-1, 5e-1), (2, 5e-1, 5e-1), (3, 5e-1, -5e-1)) q(i, dx, dy)"
_CORNERS = "(VALUES (0, 0, 0), (1, 0, 1), (2, 1, 1), (3, 1, 0)) q(corner, cx, cy)"


def _rim(axis: str, pick: str, size: int) -> str:
    large, small, normal = INSET
    return f"CAST(CASE {pick} WHEN 1 THEN {size} - CASE {axis} WHEN 9 THEN {normal} ELSE {small} END ELSE CASE {axis} WHEN 0 THEN {normal} ELSE {large} END END AS DOUBLE)"


_QUADS = [(f"x{i}", f"y{i}") for i in range(4)]
_INSIDE = " + ".join(_edge(a, b).replace("y >", "j.range >").replace("y <=", "j.range <=").replace("(y -", "(j.range -").replace("x <=", "i.range <=") for a, b in zip(_QUADS, _QUADS[1:] + _QUADS[:1]))
_BOUND = lambda c, n: f"greatest(0, least(CAST({c} AS INT), {n - 1}))"
_LEAST, _MOST = (lambda c, f=f: f"{f}({c}0, {c}1, {c}2, {c}3)" for f in ("least", "greatest"))
#: The mapping: best (pix, cell_id), heads (cells used, with their places), filled (cell pixels of frame pixels) and moved (whole shifts).
_MAPPED = f"""{_OF}, {_FOOTPRINT.replace("FROM cells", "FROM survey")}, {_OWN},
corners AS (SELECT cell_id, corner, {_XYZ} FROM ({_TAN.format(k="cell_id, corner", src=f"SELECT *, {_rim('x', 'cx', G.width)} AS px, {_rim('y', 'cy', G.height)} AS py FROM survey, {_CORNERS}")}) WHERE cell_id IN (SELECT cell_id FROM near)),
sides AS (SELECT a.cell_id, a.y * b.z - a.z * b.y AS x, a.z * b.x - a.x * b.z AS y, a.x * b.y - a.y * b.x AS z FROM corners a JOIN corners b ON b.cell_id = a.cell_id AND b.corner = (a.corner + 1) % 4),
points AS (SELECT pix, px, py, {_XYZ} FROM ({_SIP})),
hits AS (SELECT pix, cell_id, any_value(px) AS px, any_value(py) AS py FROM points p, sides s GROUP BY pix, cell_id HAVING bool_and(p.x * s.x + p.y * s.y + p.z * s.z >= 0) OR bool_and(p.x * s.x + p.y * s.y + p.z * s.z <= 0)),
best AS MATERIALIZED (SELECT pix, arg_min(cell_id, (sqrt(power(px - fx, 2) + power(py - fy, 2)), cell_id)) AS cell_id FROM hits JOIN own USING (cell_id) GROUP BY pix),
heads AS (SELECT cell_id, projection, y AS row, x - min(x) OVER (PARTITION BY projection) AS k FROM survey WHERE cell_id IN (SELECT cell_id FROM best)),
ends AS (SELECT b.pix * 4 + i AS pix, (b.pix % 64) + dx AS px, (b.pix // 64) + dy AS py FROM best b, {_STEPS}),
ends_sky AS (SELECT pix // 4 AS pix, pix % 4 AS i, CASE WHEN px = 315e-1 AND py = 315e-1 THEN 31e0 ELSE ra END AS ra, CASE WHEN px = 315e-1 AND py = 315e-1 THEN -19e0 ELSE dec END AS dec FROM ({_sip_of("SELECT pix, px, py FROM ends")})),
on_cell AS (SELECT pix, cell_id, i, xi / cdelt1 + crpix1 - 1 AS x, eta / cdelt2 + crpix2 - 1 AS y FROM ({_FLAT.format(k="pix, cell_id, i, cdelt1, cdelt2, crpix1, crpix2", a0="crval1", d0="crval2", src="(SELECT * FROM ends_sky JOIN best USING (pix) JOIN survey USING (cell_id))")})),
quads AS (SELECT pix, cell_id, {", ".join(f"max(CASE i WHEN {i} THEN {c} END) AS {c}{i}" for i in range(4) for c in "xy")} FROM on_cell GROUP BY 1, 2),
filled AS (SELECT cell_id, CAST(j.range AS INT) AS y, CAST(i.range AS INT) AS x, max(pix) AS pix FROM quads, range({G.width}) i, range({G.height}) j
  WHERE i.range BETWEEN {_BOUND(f"floor({_LEAST('x')})", G.width)} AND {_BOUND(f"ceil({_MOST('x')})", G.width)} AND j.range BETWEEN {_BOUND(f"floor({_LEAST('y')})", G.height)} AND {_BOUND(f"ceil({_MOST('y')})", G.height)} AND ({_INSIDE}) % 2 = 1 GROUP BY 1, 2, 3),
both_ends AS (SELECT cell_id * 100 + offset_id * 10 + w AS pix, fx + w * dx * {SCALE} AS px, fy + w * dy * {SCALE} AS py FROM own, offsets, (VALUES (0), (1)) q(w)),
ends_seen AS (SELECT pix // 100 AS id, pix // 10 % 10 AS offset_id, pix % 10 AS w, ra, dec FROM ({_sip_of("SELECT pix, px, py FROM both_ends")})),
on_cells AS (SELECT cell_id, offset_id, w, xi / cdelt1 AS x, eta / cdelt2 AS y FROM ({_FLAT.format(k="cell_id, offset_id, w, cdelt1, cdelt2", a0="crval1", d0="crval2", src="(SELECT * FROM ends_seen JOIN survey ON survey.cell_id = ends_seen.id)")})),
moved AS (SELECT offset_id, cell_id, CAST(round_even(sum(CASE w WHEN 1 THEN x ELSE -x END), 0) AS INT) AS sx, CAST(round_even(sum(CASE w WHEN 1 THEN y ELSE -y END), 0) AS INT) AS sy FROM on_cells WHERE cell_id IN (SELECT cell_id FROM heads) GROUP BY 1, 2)"""
#: Its results on pixels: raster (every pixel of the cells used, with bits) and smooth.
_SMOOTHED = f"""combined AS (SELECT cell_id, y, x, sum({_W} * (1 + 2 * sinh(value / {_A}))) AS value, bit_or(mask) AS mask FROM pixels WHERE NOT isnan(value) GROUP BY 1, 2, 3),
{_ROWS.replace("LEFT JOIN image i", "LEFT JOIN combined i")}, full_rows AS (SELECT * FROM crossed),
{_SMOOTH}"""


def _setting() -> Setting:
    return Setting(FRAME, 64, 64, G, INSET, sigma=SIGMA, radius=RADIUS, buckets=8)


def _inputs(r):
    spark = r("cells").sparkSession
    return spark.sql(_CELLS, cells=r("cells")), r("pixels"), r("offsets").select("offset_id", (F.col("dx") * SCALE).alias("dx"), (F.col("dy") * SCALE).alias("dy"))


@query(f"""WITH {_MAPPED} SELECT CAST(cell_id AS INT) AS cell_id, y, x, CAST(pix AS BIGINT) AS pix FROM filled""")
def survey_mapping(r):
    """The run's first stage from its store: the frame pixel of every cell pixel, from the catalogue alone."""
    cells, pixels, offsets = _inputs(r)
    from .survey import Run, _map

    stage = Run(cells.sparkSession, folder(cells.sparkSession, "survey")).stage("mapping", {}, {}, lambda: _map(cells, offsets, _setting()))
    return stage.tables["assignment"].select("cell_id", "y", "x", "pix")


@query(f"""WITH {_MAPPED}, {_SMOOTHED},
seen AS (SELECT m.offset_id, f.pix, s.smooth, coalesce(c.mask, 0) AS mask, ((f.y - m.sy) % {G.height} + {G.height}) % {G.height} AS sy, ((f.x - m.sx) % {G.width} + {G.width}) % {G.width} AS sx FROM filled f JOIN moved m USING (cell_id)
  LEFT JOIN smooth s ON s.cell_id = f.cell_id AND s.y = ((f.y - m.sy) % {G.height} + {G.height}) % {G.height} AND s.x = ((f.x - m.sx) % {G.width} + {G.width}) % {G.width}
  LEFT JOIN combined c ON c.cell_id = f.cell_id AND c.y = ((f.y - m.sy) % {G.height} + {G.height}) % {G.height} AND c.x = ((f.x - m.sx) % {G.width} + {G.width}) % {G.width})
SELECT CAST(offset_id AS INT) AS offset_id, CAST(pix AS BIGINT) AS pix, round(coalesce(sum(CASE WHEN mask & 4096 = 0 THEN smooth END), 0) / count(*), 6) AS flux, count(*) AS count, round(count(*) FILTER (mask <> 0) / count(*), 6) AS mask_ratio FROM seen GROUP BY 1, 2""")
def survey_template(r):
    """Catalogue, frame and pixels to templates in one run of four stages; a second run over the same inputs, which reads its result, computes none."""
    cells, pixels, offsets = _inputs(r)
    spark = cells.sparkSession
    root = folder(spark, "survey")
    survey_run(spark, root, cells, pixels, offsets, _setting())
    again = survey_run(spark, root, cells, pixels, offsets, _setting())
    if any(stage.computed for stage in again):
        raise RuntimeError("a stage that was whole was computed again")
    return again[-1].tables["template"].select("offset_id", "pix", F.round("flux", 6).alias("flux"), "count", F.round("mask_ratio", 6).alias("mask_ratio"))
