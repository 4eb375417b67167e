"""Every registered query over the test tables, beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from ..adapters import relation, with_ctes
from ..constants import BAND_WEIGHTS, BANDS, EXPECTED_ARRAYS, MASK_BITS, SIDES
from ..functions import bits, names, photometry, wcs
from ..operators import analysis, catalog, combine, downsample, extraction, inventory, kernels, mapping, padding, rows

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers f(r), where r(name) gives a table or adapter."""

    def add(f):
        _QUERIES[f.__name__] = lambda spark, sf_dir, f=f: f(lambda n: relation(spark, sf_dir, n))
        if oracle:
            _ORACLES[f.__name__] = with_ctes(oracle)
        return f

    return add


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def r6(c, name: str):
    return F.round(c, 6).alias(name)


# ---- templates ----

_ROLLED = """rolled AS (SELECT s.offset_id, a.pix, i.value, i.mask FROM assignment a JOIN shifts s ON s.cell_id = a.cell_id
  JOIN {image} i ON i.cell_id = a.cell_id AND i.y = (((a.y - s.sy) % 32) + 32) % 32 AND i.x = (((a.x - s.sx) % 32) + 32) % 32 WHERE a.pix >= 0)"""
_R_BAND = "(SELECT cell_id, y, x, value, mask FROM pixels WHERE band = 0)"


@query(f"""WITH {_ROLLED.format(image="image")} SELECT offset_id, pix, round(coalesce(sum(CASE WHEN NOT isnan(value) AND mask & 4096 = 0 THEN value END), 0), 6) AS flux_sum,
  count(*) AS count, count(*) FILTER (mask <> 0) AS mask_count FROM rolled GROUP BY offset_id, pix""")
def template_downsample(r):
    """The flagship."""
    return downsample.template(r("assignment"), r("image"), r("shifts")).withColumn("flux_sum", F.round("flux_sum", 6))


@query(f"""WITH {_ROLLED.format(image=_R_BAND)} SELECT offset_id, pix, round(coalesce(sum(CASE WHEN mask & 4096 = 0 THEN value END), 0), 6) AS flux_sum,
  count(*) AS count, count(*) FILTER (mask <> 0) AS mask_count FROM rolled GROUP BY offset_id, pix""")
def template_nan_variant(r):
    """NaN poisons the sum."""
    image = r("pixels").where("band = 0").select("cell_id", "y", "x", "value", "mask")
    return downsample.template(r("assignment"), image, r("shifts"), nan_poisons=True).withColumn("flux_sum", F.round("flux_sum", 6))


@query(f"""WITH {_ROLLED.format(image="image")} SELECT offset_id, pix, round(coalesce(sum(CASE WHEN NOT isnan(value) AND mask & 4096 = 0 THEN value END), 0), 6) AS flux_sum,
  count(*) AS count, count(*) FILTER (mask <> 0) AS mask_count FROM rolled WHERE pix % 8 BETWEEN 2 AND 5 AND pix // 8 BETWEEN 1 AND 8 GROUP BY offset_id, pix""")
def template_roi(r):
    """The region is cut before the join."""
    return downsample.template(r("assignment"), r("image"), r("shifts"), roi=(2, 6, 1, 9, 8)).withColumn("flux_sum", F.round("flux_sum", 6))


@query(f"""WITH {_ROLLED.format(image="image")}, s AS (SELECT offset_id, pix, coalesce(sum(CASE WHEN mask & 4096 = 0 THEN value END), 0) AS f, count(*) AS n, count(*) FILTER (mask <> 0) AS m FROM rolled GROUP BY ALL)
SELECT o.offset_id, CAST(g.range AS INTEGER) AS pix, round(coalesce(f, 0), 6) AS flux_sum, coalesce(n, 0) AS count, coalesce(m, 0) AS mask_count
FROM range(200) g CROSS JOIN offsets o LEFT JOIN s ON s.offset_id = o.offset_id AND s.pix = g.range""")
def template_dense(r):
    """A10: zeros where nothing fell."""
    sums = downsample.template(r("assignment"), r("image"), r("shifts"))
    pixels = sums.sparkSession.range(200).select(F.col("id").cast("int").alias("pix"))
    return downsample.dense(sums, pixels, r("offsets")).select("offset_id", "pix", r6("flux_sum", "flux_sum"), "count", "mask_count")


@query(f"""WITH {_ROLLED.format(image="image")} SELECT offset_id, (pix % 8) // 2 AS bx, pix // 8 // 2 AS by, pix % 8 % 2 AS sub_x, pix // 8 % 2 AS sub_y, count(*) AS count FROM rolled GROUP BY ALL""")
def template_oversampled(r):
    """The frame grid of 8 columns as a 4-column one, oversampled twice."""
    t = downsample.template(r("assignment"), r("image"), r("shifts"))
    bx, by, sx, sy = downsample.sub_pixel(F.col("pix"), 4, 2)
    return t.select("offset_id", bx.alias("bx"), by.alias("by"), sx.alias("sub_x"), sy.alias("sub_y"), "count")


@query("""SELECT a.pix, round(sum(i.value), 6) AS flux_sum, count(*) AS count, count(*) FILTER (i.mask <> 0) AS mask_count FROM assignment a JOIN image i USING (cell_id, y, x)
WHERE a.pix >= 0 AND a.y BETWEEN 2 AND 29 AND a.x BETWEEN 2 AND 29 GROUP BY a.pix""")
def legacy_downsample(r):
    """A12 J16 K09."""
    return downsample.plain_downsample(r("assignment"), r("image"), trim=2).withColumn("flux_sum", F.round("flux_sum", 6))


@query("""SELECT pix, round(CASE WHEN n > 0 THEN s / n ELSE 0 END, 9) AS flux, round(CASE WHEN n > 0 THEN m / n ELSE 0 END, 6) AS mask_ratio FROM (
SELECT a.pix, sum(i.value) AS s, count(*) AS n, count(*) FILTER (i.mask % 2 = 1 OR i.mask <> 0) AS m FROM assignment a JOIN image i USING (cell_id, y, x) WHERE a.pix >= 0 GROUP BY a.pix)""")
def flux_average(r):
    """K07 P43."""
    return downsample.averages(downsample.plain_downsample(r("assignment"), r("image"))).select("pix", F.round("flux", 9).alias("flux"), r6("mask_ratio", "mask_ratio"))


_RUNS = """WITH runs AS (SELECT a.cell_id, a.pix, round(sum(CASE WHEN isnan(i.value) THEN 0 ELSE i.value END), 6) AS flux_sum, count(*) AS count FROM assignment a JOIN image i USING (cell_id, y, x) GROUP BY 1, 2) """


@query(_RUNS + "SELECT * FROM runs WHERE pix >= 0")
def run_sums(r):
    """W11."""
    return downsample.run_sums(r("assignment"), r("image")).withColumn("flux_sum", F.round("flux_sum", 6))


@query(_RUNS + "SELECT cell_id, pix, flux_sum, count FROM (SELECT *, dense_rank() OVER (PARTITION BY cell_id ORDER BY pix) AS k FROM runs) WHERE k > 1")
def run_sums_legacy(r):
    """W11 with the dropped first run."""
    return downsample.run_sums(r("assignment"), r("image"), drop_first_run=True).withColumn("flux_sum", F.round("flux_sum", 6))


@query("SELECT y // 2 AS by, x // 2 AS bx, round(sum(value), 6) AS total FROM grid GROUP BY 1, 2")
def block_sum(r):
    """A11."""
    return downsample.block_sum(r("grid"), 2).withColumn("total", F.round("total", 6))


@query("""SELECT CAST(CASE WHEN x % 5 = 0 THEN -1 ELSE x END + CASE WHEN x % 5 = 0 THEN 0 ELSE y END * 32 AS INTEGER) AS idx, count(*) AS n FROM grid GROUP BY 1""")
def split_axis_index(r):
    """P44."""
    g = r("grid").select(F.when(F.col("x") % 5 == 0, 65535).otherwise(F.col("x")).alias("px"), F.when(F.col("x") % 5 == 0, 65535).otherwise(F.col("y")).alias("py"))
    return g.groupBy(downsample.split_axis_index(F.col("px"), F.col("py"), 32).alias("idx")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT c.cell_id, c.name FROM cells c JOIN assignment a USING (cell_id) WHERE a.pix >= 0 AND a.pix % 8 BETWEEN 2 AND 3 AND a.pix // 8 BETWEEN 1 AND 2")
def roi_cells(r):
    """F07 J07 U04 S13."""
    return downsample.roi_cells(r("assignment"), r("cells"), 2, 4, 1, 3, 8).select("cell_id", "name")


@query("SELECT cell_id, CAST(ntile((SELECT CAST(greatest(1, ceil(count(*) / 20.0)) AS BIGINT) FROM cells)) OVER (ORDER BY name) - 1 AS INTEGER) AS batch FROM cells")
def batches(r):
    """W10."""
    return downsample.batches(r("cells"))


@query("SELECT offset_id, cell_id, CAST(round_even(dx * 37 + cell_id / 2.0, 0) AS INTEGER) AS sx, CAST(round_even(dy * 41 - cell_id / 4.0, 0) AS INTEGER) AS sy FROM cells CROSS JOIN offsets")
def shift_rounding(r):
    """Half to even."""
    o = r("cells").withColumn("o", downsample.for_each_offset(r("offsets"))).select("cell_id", "o.*")
    return downsample.whole_shifts(o.select("offset_id", "cell_id", (F.col("dx") * 37 + F.col("cell_id") / 2).alias("sx"), (F.col("dy") * 41 - F.col("cell_id") / 4).alias("sy")))


@query("""SELECT cell_id, count(*) AS n, bool_or(pix = -1) AS has_unmapped FROM (SELECT cell_id, pix FROM assignment WHERE cell_id % 2 = 0 UNION ALL SELECT cell_id, pix FROM assignment WHERE cell_id % 3 = 0
UNION ALL SELECT cell_id, pix FROM assignment WHERE cell_id % 2 <> 0 AND cell_id % 3 <> 0) GROUP BY 1""")
def concatenated_partials(r):
    """Partials that overlap and cover all cells together."""
    a = r("assignment").select("cell_id", "pix")
    return _unmapped(a.where("cell_id % 2 = 0").unionByName(a.where("cell_id % 3 = 0")).unionByName(a.where("cell_id % 2 <> 0 AND cell_id % 3 <> 0")))


def _unmapped(partials):
    return partials.groupBy("cell_id").agg(F.count("*").alias("n"), F.bool_or(F.col("pix") == -1).alias("has_unmapped"))


# ---- bands, masks, headers ----

_W = "CASE band " + " ".join(f"WHEN {i} THEN {BAND_WEIGHTS[b]}e0" for i, b in enumerate(BANDS)) + " END"
_A = repr(photometry.A)


@query(f"""SELECT cell_id, y, x, round(sum({_W} * (1 + 2 * sinh(value / {_A}))), 6) AS value, round(sqrt(sum(power({_W} * sqrt(1 + 2 * sinh(weight / {_A})), 2))), 6) AS error,
  bit_or(mask) AS mask, count(*) AS n_bands FROM pixels WHERE NOT isnan(value) GROUP BY cell_id, y, x""")
def band_combine(r):
    """A04 A05 A07 P20 L04."""
    return combine.combine_bands(r("pixels")).withColumn("value", F.round("value", 6)).withColumn("error", F.round("error", 6))


@query("SELECT cell_id, y, x, bit_or(mask) AS mask FROM pixels GROUP BY 1, 2, 3")
def mask_combine(r):
    """A06 K13."""
    return combine.combine_masks(r("pixels"))


@query("""SELECT coalesce(a.cell_id, m.cell_id, w.cell_id) AS cell_id, count(*) AS n, count(value) AS n_image, count(mask) AS n_mask, count(weight) AS n_weight FROM
(SELECT cell_id, band, y, x, value FROM pixels WHERE x % 3 <> 0) a FULL JOIN (SELECT cell_id, band, y, x, mask FROM pixels WHERE x % 5 <> 0) m USING (cell_id, band, y, x)
FULL JOIN (SELECT cell_id, band, y, x, weight FROM pixels WHERE y % 4 <> 0) w ON w.cell_id = coalesce(a.cell_id, m.cell_id) AND w.band = coalesce(a.band, m.band) AND w.y = coalesce(a.y, m.y) AND w.x = coalesce(a.x, m.x) GROUP BY 1""")
def join_kinds(r):
    """J13 S10."""
    p = r("pixels")
    k = ["cell_id", "band", "y", "x"]
    j = combine.join_kinds(p.where("x % 3 <> 0").select(*k, "value"), p.where("x % 5 <> 0").select(*k, "mask"), p.where("y % 4 <> 0").select(*k, "weight"))
    return j.groupBy("cell_id").agg(F.count("*").alias("n"), F.count("value").alias("n_image"), F.count("mask").alias("n_mask"), F.count("weight").alias("n_weight"))


_FLAGS = ", ".join(f"('{n}', {b})" for n, b in MASK_BITS)
_DECODE = f"SELECT m, (SELECT coalesce(string_agg(n, ',' ORDER BY k), '') FROM (SELECT n, b, row_number() OVER () AS k FROM (VALUES {_FLAGS}) v(n, b)) WHERE m & b <> 0) AS plain FROM v"
_MASKS = "v AS (SELECT DISTINCT CAST(mask AS BIGINT) AS m FROM pixels UNION SELECT unnest([0, 128, 8575, 32768]))"


@query(f"WITH {_MASKS}, d AS ({_DECODE}) SELECT m AS mask, CASE m WHEN 8575 THEN 'MASK.VALUE' WHEN 32768 THEN 'MARK.VALUE' ELSE plain END AS flags, plain FROM d")
def mask_decode(r):
    """P22 P24."""
    m = r("pixels").select(F.col("mask").cast("long").alias("mask")).union(r("pixels").sparkSession.sql("SELECT explode(array(0L, 128L, 8575L, 32768L)) AS mask")).distinct()
    return m.select("mask", F.concat_ws(",", bits.decode("mask")).alias("flags"), F.concat_ws(",", bits.decode("mask", special=False)).alias("plain"))


@query(f"WITH {_MASKS} SELECT m AS mask, CAST(CASE WHEN m IN (8575, 32768) THEN m ELSE m & 32767 END AS INTEGER) AS again FROM v")
def mask_encode(r):
    """Decoding and encoding give the mask back."""
    m = r("pixels").select(F.col("mask").cast("long").alias("mask")).union(r("pixels").sparkSession.sql("SELECT explode(array(0L, 128L, 8575L, 32768L)) AS mask")).distinct()
    return m.select("mask", bits.encode(bits.decode("mask")).alias("again"))


@query("SELECT cell_id, sum(mask & ~32)::BIGINT AS cleared, sum(CASE WHEN value > 2 THEN (mask & ~32) | 32 ELSE mask & ~32 END)::BIGINT AS marked, count(*) FILTER (mask & 4096 > 0) AS n_ignored FROM pixels GROUP BY 1")
def mask_saturation(r):
    """P25 P26."""
    return r("pixels").groupBy("cell_id").agg(F.sum(bits.clear_sat("mask")).alias("cleared"), F.sum(bits.clear_sat("mask", F.col("value") > 2)).alias("marked"), F.count_if(bits.ignored("mask")).alias("n_ignored"))


@query("""SELECT event_id, CASE WHEN ok THEN bo ELSE 1000e0 END AS boffset, CASE WHEN ok THEN bs ELSE 1000e0 END AS bsoften, CASE WHEN ok THEN 30e0 ELSE 1e0 END AS exptime FROM (
SELECT event_id, CAST(event_id % 50 AS DOUBLE) AS bo, round(value, 3) AS bs, event_id % 7 <> 0 AND event_id % 11 <> 0 AS ok FROM events)""")
def header_numbers(r):
    """All three or none."""
    e = r("events")
    header = F.map_from_entries(F.array(
        F.struct(F.lit("BOFFSET").alias("k"), F.when(F.col("event_id") % 7 == 0, "n/a").otherwise((F.col("event_id") % 50).cast("string")).alias("v")),
        F.struct(F.lit("BSOFTEN").alias("k"), F.round("value", 3).cast("string").alias("v")),
        F.struct(F.when(F.col("event_id") % 11 == 0, "OTHER").otherwise("EXPTIME").alias("k"), F.lit("30").alias("v"))))
    return e.select("event_id", photometry.header_numbers(header).alias("h")).select("event_id", "h.boffset", "h.bsoften", "h.exptime")


@query("SELECT source_id, round(power(10e0, (25 - phot_rp_mean_mag) / 2.5), 4) AS flux, round(power(10e0, 4e0) * phot_rp_mean_mag, 4) AS threshold FROM stars")
def star_fluxes(r):
    """P38."""
    return r("stars").select("source_id", F.round(photometry.mag_to_flux(F.col("phot_rp_mean_mag")), 4).alias("flux"), F.round(photometry.replacement_threshold(F.col("phot_rp_mean_mag")), 4).alias("threshold"))


@query("""SELECT CAST(event_id AS BIGINT) AS frame_id, CAST(CAST(event_id AS DOUBLE) / 2 AS VARCHAR) AS cd, CAST((10 - 0.5) * 2 + 0.5 - 6 AS VARCHAR) AS crpix, CAST(NULL AS VARCHAR) AS extra, 'c' AS a20, 'none' AS origin FROM events""")
def header_build(r):
    """The headers of every frame."""
    return _headers(r("events"))


def _headers(e):
    h = F.create_map(F.lit("CD1_1"), F.col("event_id").cast("double").cast("string"), F.lit("CRPIX1"), F.lit("10.0"), F.lit("EXTRA"), F.lit("x"), F.lit("A_2_0"), F.lit("c"))
    built = analysis.scaled_wcs(analysis.template_header(h, ["CD1_1", "CRPIX1"], ["A_", "B_"], {"ORIGIN": "none"}), 2, x_min=3)
    get = lambda k: F.try_element_at("h", F.lit(k))
    rows = e.select(F.col("event_id").alias("frame_id"), built.alias("h"))
    return rows.select("frame_id", get("CD1_1").alias("cd"), get("CRPIX1").alias("crpix"), get("EXTRA").alias("extra"), get("A_2_0").alias("a20"), get("ORIGIN").alias("origin"))


# ---- names and text formats ----


@query("""SELECT name, CAST(split_part(name, '.', 2) AS INTEGER) AS projection, split_part(name, '.', 3) AS cell, CAST(substr(split_part(name, '.', 3), 2, 1) AS INTEGER) AS y, CAST(substr(split_part(name, '.', 3), 3, 1) AS INTEGER) AS x,
  split_part(name, '.', 2) AS first_number, 'rings.v3.' || name || '.stk.r.unconv.mask.fits' AS mask_file FROM cells""")
def cell_name_parse(r):
    """P01 P02 S08 D3."""
    return r("cells").select("name", names.cell_projection("name").alias("projection"), names.cell_digits("name").alias("cell"), names.cell_y("name").alias("y"), names.cell_x("name").alias("x"), names.first_number_part("name").alias("first_number"), names.band_file("name", "r", "mask").alias("mask_file"))


@query("""SELECT cell_id, regexp_extract(p, '(skycell\\.\\d+\\.\\d+)', 1) AS cell, regexp_extract(p, 'skycell\\.\\d+\\.\\d+_([a-zA-Z0-9_]+)', 1) AS variant, printf('sector_%04d_camera_%d_ccd_%d.zarr', projection % 100, 1 + cell_id % 4, 1 + x % 4) AS store
FROM (SELECT *, '/a/tess_s20_' || name || '_data/0.0' AS p FROM cells)""")
def store_paths(r):
    """S12 S13 S15 P36."""
    c = r("cells").withColumn("p", F.concat(F.lit("/a/tess_s20_"), "name", F.lit("_data/0.0")))
    return c.select("cell_id", names.cell_in_path("p").alias("cell"), names.variant_in_path("p").alias("variant"), names.store_path(F.col("projection") % 100, 1 + F.col("cell_id") % 4, 1 + F.col("x") % 4).alias("store"))


@query("SELECT cell_id, CAST(cell_id % 90 AS INTEGER) AS sector, CAST(cell_id % 4 AS INTEGER) AS camera, 3 AS ccd FROM cells")
def frame_file_parts(r):
    """P35."""
    path = F.format_string("/d/tess2020-s%04d-%d-3-0165-s_ffic.fits", F.col("cell_id") % 90, F.col("cell_id") % 4)
    return r("cells").select("cell_id", names.frame_file_parts(path).alias("p")).select("cell_id", "p.sector", "p.camera", "p.ccd")


@query("SELECT cell_id, k AS k, CAST(cell_id + k AS DOUBLE) AS dx, CAST(k AS DOUBLE) / 4 AS dy FROM cells, (VALUES (0), (1)) v(k)")
def offset_list(r):
    """P37 D15."""
    text = F.format_string("%d, 0.0,%d,0.25", F.col("cell_id"), F.col("cell_id") + 1)
    return r("cells").select("cell_id", F.posexplode(names.offset_pairs(text)).alias("k", "o")).select("cell_id", "k", "o.dx", "o.dy")


_SPLIT = "list_filter(list_transform(string_split(replace(coalesce(pad_skycell, ''), '/', ','), ','), lambda p: trim(p)), lambda p: p <> '')"
_SIDES = "[" + ", ".join(f"'{s}'" for s, _, _ in SIDES) + "]"
_PAIRS = f"pairs AS (SELECT DISTINCT name, ({_SIDES})[dir + 1] AS side, CAST(k - 1 AS INTEGER) AS rank, l[k] AS pad_cell FROM (SELECT name, dir, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT name, dir, {_SPLIT} AS l FROM padding)))"


@query(f"WITH {_PAIRS} SELECT * FROM pairs")
def padding_parse(r):
    """P32 D7 X05."""
    return padding.padding_pairs(r("padding"))


@query(f"WITH {_PAIRS} SELECT name, array_to_string(list_sort(list_distinct(list(pad_cell))), ',') AS pads FROM pairs WHERE pad_cell <> name GROUP BY name")
def all_padding_cells(r):
    """J19."""
    return padding.all_padding_cells(padding.padding_pairs(r("padding"))).select("name", F.concat_ws(",", "pads").alias("pads"))


@query(f"WITH {_PAIRS} SELECT DISTINCT name FROM cells UNION SELECT pad_cell FROM pairs")
def cells_to_fetch(r):
    """U01."""
    return r("cells").select("name").union(padding.padding_pairs(r("padding")).select("pad_cell")).distinct()


@query("SELECT cell_id, cell_id % 4 <> 3 AND cell_id % 8 = 0 AS top, cell_id % 4 <> 3 AND cell_id % 8 = 1 AS r, cell_id % 4 <> 3 AND cell_id % 8 < 6 AND cell_id % 8 <> 3 AS any_flag FROM cells")
def flag_parse(r):
    """P33 P34 F16."""
    flags = F.concat(F.lit("["), F.concat_ws(", ", *(F.when(F.col("cell_id") % 8 == i, "True").otherwise("False") for i in range(6)), F.lit("False"), F.lit("False")), F.lit("]"))
    text = F.when(F.col("cell_id") % 4 == 3, "not a list").otherwise(flags)
    parsed = r("cells").select("cell_id", names.flag_list(F.when(F.col("cell_id") % 4 == 3, "[true]").otherwise(text)).alias("f"))
    return parsed.select("cell_id", names.flags_to_struct("f")["top"].alias("top"), names.flags_to_struct("f")["right"].alias("r"), names.any_flag("f").alias("any_flag"))


@query("SELECT DISTINCT CAST(projection AS VARCHAR) AS projection FROM cells ORDER BY 1 LIMIT 3")
def projections_sorted(r):
    """A15 F10 F09."""
    return rows.sorted_projections(r("cells"), 3)


@query("SELECT projection, array_to_string(list_sort(list_distinct(list(name))), ',') AS names FROM cells GROUP BY 1")
def store_listing(r):
    """S14."""
    return inventory.store_listing(r("cells")).select("projection", F.concat_ws(",", "names").alias("names"))


# ---- coordinates ----

_TAN = """SELECT {k}, CASE WHEN abs(xi) <= 1e-8 AND abs(eta) <= 1e-8 THEN crval1 ELSE degrees(radians(crval1) + atan2(u * sin(c), s * cos(d0) * cos(c) - v * sin(d0) * sin(c))) END AS ra,
  CASE WHEN abs(xi) <= 1e-8 AND abs(eta) <= 1e-8 THEN crval2 ELSE degrees(asin(cos(c) * sin(d0) + v * sin(c) * cos(d0) / s)) END AS dec
FROM (SELECT *, atan(sqrt(u * u + v * v)) AS c, CASE WHEN abs(xi) <= 1e-8 AND abs(eta) <= 1e-8 THEN 1 ELSE sqrt(u * u + v * v) END AS s, radians(crval2) AS d0 FROM (SELECT *, radians(xi) AS u, radians(eta) AS v FROM (
SELECT {k}, crval1, crval2, pc1_1 * ((px - crpix1 + 1) * cdelt1) + pc1_2 * ((py - crpix2 + 1) * cdelt2) AS xi, pc2_1 * ((px - crpix1 + 1) * cdelt1) + pc2_2 * ((py - crpix2 + 1) * cdelt2) AS eta FROM ({src}))))"""
_CORNERS = "(VALUES (0, 0, 0), (1, 0, 1), (2, 1, 1), (3, 1, 0)) q(corner, cx, cy)"


@query("SELECT cell_id, round(ra, 6) AS ra, round(dec, 6) AS dec FROM (" + _TAN.format(k="cell_id", src="SELECT *, CAST(naxis1 // 2 AS DOUBLE) AS px, CAST(naxis2 // 2 AS DOUBLE) AS py FROM cells") + ")")
def cell_centres(r):
    """P03 P04 P07."""
    ra, dec = wcs.centre()
    return r("cells").select("cell_id", r6(ra, "ra"), r6(dec, "dec"))


@query("SELECT cell_id, corner, round(ra, 6) AS ra, round(dec, 6) AS dec FROM (" + _TAN.format(k="cell_id, corner", src=f"SELECT *, CASE cx WHEN 1 THEN naxis1 - 120e0 ELSE 120e0 END AS px, CASE cy WHEN 1 THEN naxis2 - 120e0 ELSE 120e0 END AS py FROM cells, {_CORNERS}") + ")")
def cell_corners(r):
    """P05 D2."""
    return r("cells").select("cell_id", F.explode(wcs.corners(120.0)).alias("c")).select("cell_id", "c.corner", r6(F.col("c.ra"), "ra"), r6(F.col("c.dec"), "dec"))


@query("SELECT cell_id, corner, round(ra, 6) AS ra, round(dec, 6) AS dec FROM (" + _TAN.format(k="cell_id, corner", src=f"""SELECT *, CAST(CASE cx WHEN 1 THEN naxis1 - CASE x WHEN 9 THEN 200 ELSE 70 END ELSE CASE x WHEN 0 THEN 200 ELSE 410 END END AS DOUBLE) AS px,
  CAST(CASE cy WHEN 1 THEN naxis2 - CASE y WHEN 9 THEN 200 ELSE 70 END ELSE CASE y WHEN 0 THEN 200 ELSE 410 END END AS DOUBLE) AS py FROM cells, {_CORNERS}""") + ")")
def cell_corners_inset(r):
    """P06."""
    return r("cells").select("cell_id", F.explode(wcs.inset_corners()).alias("c")).select("cell_id", "c.corner", r6(F.col("c.ra"), "ra"), r6(F.col("c.dec"), "dec"))


_SIDE_ROWS = ", ".join(f"('{s}', {dx}, {dy})" for s, dx, dy in SIDES)
_SPAN = "CASE {d} WHEN -1 THEN CASE {c} WHEN 1 THEN 10 ELSE -480 END WHEN 0 THEN CASE {c} WHEN 1 THEN {n} ELSE 0 END ELSE CASE {c} WHEN 1 THEN {n} + 480 ELSE {n} - 10 END END"


@query("SELECT cell_id, side, corner, round(ra, 6) AS ra, round(dec, 6) AS dec FROM (" + _TAN.format(k="cell_id, side, corner", src=f"SELECT *, CAST({_SPAN.format(d='dx', c='cx', n='naxis1')} AS DOUBLE) AS px, CAST({_SPAN.format(d='dy', c='cy', n='naxis2')} AS DOUBLE) AS py FROM cells, {_CORNERS}, (VALUES {_SIDE_ROWS}) s(side, dx, dy)") + ")")
def padding_regions(r):
    """P15."""
    return r("cells").select("cell_id", F.explode(wcs.padding_corners()).alias("c")).select("cell_id", "c.side", "c.corner", r6(F.col("c.ra"), "ra"), r6(F.col("c.dec"), "dec"))


@query("SELECT cell_id, round(avg(ra), 6) AS ra, round(avg(dec), 6) AS dec FROM (" + _TAN.format(k="cell_id, corner", src=f"SELECT *, CASE cx WHEN 1 THEN naxis1 - 120e0 ELSE 120e0 END AS px, CASE cy WHEN 1 THEN naxis2 - 120e0 ELSE 120e0 END AS py FROM cells, {_CORNERS}") + ") GROUP BY cell_id")
def mean_centres(r):
    """P16."""
    mean = lambda f: F.aggregate(F.transform("c", lambda p: p[f]), F.lit(0.0), lambda a, v: a + v) / 4
    return r("cells").select("cell_id", wcs.corners(120.0).alias("c")).select("cell_id", r6(mean("ra"), "ra"), r6(mean("dec"), "dec"))


@query("""SELECT cell_id, round((xi / cdelt1) + crpix1 - 1, 3) AS px, round(eta / cdelt2 + crpix2 - 1, 3) AS py FROM (SELECT *, degrees(cos(d) * sin(a) / b) AS xi, degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / b) AS eta FROM (
SELECT *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a) AS b FROM (SELECT *, radians(0.25) AS a, radians(crval2 + 0.125) AS d, radians(crval2) AS d0 FROM cells)))""")
def sky_to_pixel(r):
    """P10 P46."""
    px, py = wcs.sky_to_pixel(F.col("crval1") + 0.25, F.col("crval2") + 0.125)
    return r("cells").select("cell_id", F.round(px, 3).alias("px"), F.round(py, 3).alias("py"))


FRAME = {"crval": (31.0, -19.0), "crpix": (32.5, 32.5), "cd": ((-0.02, 0.001), (0.001, 0.02)), "a": {(2, 0): 1e-5, (1, 1): -2e-6, (0, 2): 3e-6}, "b": {(2, 0): 2e-6, (1, 1): 1e-5, (0, 2): -1e-5}}
_SIP = """SELECT pix, degrees(radians(31e0) + atan2(xi * sin(c), s * cos(d0) * cos(c) - eta * sin(d0) * sin(c))) AS ra, degrees(asin(cos(c) * sin(d0) + eta * sin(c) * cos(d0) / s)) AS dec, px, py
FROM (SELECT *, sqrt(xi * xi + eta * eta) AS s, atan(sqrt(xi * xi + eta * eta)) AS c, radians(-19e0) AS d0 FROM (SELECT *, radians(-0.02e0 * uu + 0.001e0 * vv) AS xi, radians(0.001e0 * uu + 0.02e0 * vv) AS eta FROM (
SELECT *, u + 3e-6 * v * v + -2e-6 * u * v + 1e-5 * u * u AS uu, v + -1e-5 * v * v + 1e-5 * u * v + 2e-6 * u * u AS vv FROM (SELECT *, px + 1 - 32.5e0 AS u, py + 1 - 32.5e0 AS v FROM (
SELECT range AS pix, (range % 64 + 0.5e0) - 0.5e0 AS px, (range // 64 + 0.5e0) - 0.5e0 AS py FROM range(4096))))))"""


def _sip_of(source: str) -> str:
    """The way from frame pixels to the sky as SQL; source gives pix, px, py."""
    return _SIP[: _SIP.rindex("SELECT range AS pix")] + source + ")))))"


def _skies(points) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS pix, {float(x)}e0 AS px, {float(y)}e0 AS py" for i, (x, y) in enumerate(points))


_EVENT_PIXELS = "SELECT event_id AS pix, CAST(event_id % 64 AS DOUBLE) AS px, CAST(user_id % 64 AS DOUBLE) AS py FROM events"


def _event_pixels(r):
    """A frame pixel for each event."""
    return r("events").select(F.col("event_id").alias("pix"), (F.col("event_id") % 64).cast("double").alias("px"), (F.col("user_id") % 64).cast("double").alias("py"))


@query(f"SELECT CAST(pix AS BIGINT) AS pix, round(ra, 6) AS ra, round(dec, 6) AS dec FROM ({_sip_of(_EVENT_PIXELS)})")
def sip_forward(r):
    """The sky under each event's pixel."""
    ra, dec = wcs.sip_pixel_to_sky("px", "py", FRAME)
    return _event_pixels(r).select(F.col("pix").cast("bigint").alias("pix"), r6(ra, "ra"), r6(dec, "dec"))


@query(f"SELECT CAST(pix AS BIGINT) AS pix, px, py FROM ({_EVENT_PIXELS})")
def sip_inverse(r):
    """The way to the sky and back, for each event's pixel."""
    ra, dec = wcs.sip_pixel_to_sky("px", "py", FRAME)
    sky = _event_pixels(r).select("pix", ra.alias("ra"), dec.alias("dec"))
    x, y = wcs.sip_sky_to_pixel("ra", "dec", FRAME)
    return sky.select(F.col("pix").cast("bigint").alias("pix"), (F.round(x, 5) + 0.0).alias("px"), (F.round(y, 5) + 0.0).alias("py"))


@query("SELECT pix, s, CAST(4096 * 0 + (CAST(pix AS BIGINT) // 64 * 2 + s // 2) * 128 + (pix % 64 * 2 + s % 2) AS BIGINT) AS sub, (pix % 64 * 2 + s % 2 + 0.5e0) / 2 - 0.5e0 AS px, (pix // 64 * 2 + s // 2 + 0.5e0) / 2 - 0.5e0 AS py FROM (SELECT DISTINCT pix FROM assignment WHERE pix >= 0), (VALUES (0), (1), (2), (3)) v(s)")
def oversampled_grid(r):
    """The four sub-pixels of every frame pixel that a cell pixel falls on, of a grid of 64 columns oversampled twice."""
    grid = wcs.frame_pixels(r("assignment").sparkSession, 64, 64, 2)
    bx, by, sx, sy = downsample.sub_pixel(F.col("pix").cast("int"), 64, 2)
    own = grid.select(F.col("pix").alias("sub"), "px", "py", (by * 64 + bx).cast("int").alias("pix"), (sy * 2 + sx).cast("int").alias("s"))
    return own.join(r("assignment").where("pix >= 0").select("pix").distinct(), "pix").select("pix", "s", "sub", "px", "py")


_CENTRES = _TAN.format(k="cell_id", src="SELECT *, floor(naxis1 / 2) AS px, floor(naxis2 / 2) AS py FROM cells")
_XYZ = "cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z"
_FOOTPRINT = f"""v AS (SELECT pix, {_XYZ} FROM ({_sip_of(_skies(wcs.octagon(64, 64)))})),
e AS (SELECT a.y * b.z - a.z * b.y AS x, a.z * b.x - a.x * b.z AS y, a.x * b.y - a.y * b.x AS z FROM v a JOIN v b ON b.pix = (a.pix + 1) % 8),
centres AS (SELECT cell_id, ra, dec, {_XYZ} FROM ({_CENTRES})),
near AS (SELECT cell_id, any_value(ra) AS ra, any_value(dec) AS dec FROM centres c, e GROUP BY cell_id HAVING bool_and(c.x * e.x + c.y * e.y + c.z * e.z >= 0) OR bool_and(c.x * e.x + c.y * e.y + c.z * e.z <= 0))"""


@query(f"WITH {_FOOTPRINT} SELECT cell_id, round(ra, 6) AS ra, round(dec, 6) AS dec FROM near")
def footprint_cells(r):
    """Cells whose centre lies in the eight-sided buffered footprint."""
    return mapping.cells_in_footprint(r("cells"), FRAME, 64, 64).select("cell_id", r6("ra", "ra"), r6("dec", "dec"))


def _back(rounds: int) -> str:
    """The fixed-point steps of the inverse distortion as nested SQL; from u0, v0."""
    sql = "SELECT *, u0 AS u, v0 AS v FROM plane"
    for _ in range(rounds):
        sql = f"SELECT * REPLACE (u0 - (3e-6 * v * v + -2e-6 * u * v + 1e-5 * u * u) AS u, v0 - (-1e-5 * v * v + 1e-5 * u * v + 2e-6 * u * u) AS v) FROM ({sql})"
    return sql


_FLAT = """SELECT {k}, degrees(cos(d) * sin(a) / b) AS xi, degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / b) AS eta FROM (SELECT *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a) AS b
  FROM (SELECT *, radians(ra - {a0}) AS a, radians(dec) AS d, radians({d0}) AS d0 FROM {src}))"""


_OWN = f"""flat AS ({_FLAT.format(k="cell_id", a0="31e0", d0="-19e0", src="near")}),
plane AS (SELECT cell_id, (0.02e0 * xi - 0.001e0 * eta) / -0.000401e0 AS u0, (-0.02e0 * eta - 0.001e0 * xi) / -0.000401e0 AS v0 FROM flat),
own AS (SELECT cell_id, u + 32.5e0 - 1 AS fx, v + 32.5e0 - 1 AS fy FROM ({_back(6)}))"""


@query(f"""WITH {_FOOTPRINT}, {_OWN},
points AS (SELECT cell_id * 100 + offset_id * 10 + w AS pix, fx + w * dx AS px, fy + w * dy AS py FROM own, offsets, (VALUES (0), (1)) q(w)),
sky AS (SELECT pix // 100 AS id, pix // 10 % 10 AS offset_id, pix % 10 AS w, ra, dec FROM ({_sip_of("SELECT pix, px, py FROM points")})),
cp AS (SELECT cell_id, offset_id, w, xi / cdelt1 AS x, eta / cdelt2 AS y FROM ({_FLAT.format(k="cell_id, offset_id, w, cdelt1, cdelt2", a0="crval1", d0="crval2", src="(SELECT * FROM sky JOIN cells ON cells.cell_id = sky.id)")}))
SELECT CAST(offset_id AS INTEGER) AS offset_id, CAST(cell_id AS INTEGER) AS cell_id, round(sum(CASE w WHEN 1 THEN x ELSE -x END), 3) + 0 AS sx, round(sum(CASE w WHEN 1 THEN y ELSE -y END), 3) + 0 AS sy FROM cp GROUP BY 1, 2""")
def cell_shifts(r):
    """Frame offset to cell pixel shift, at the centre of each cell in the footprint."""
    near = mapping.cells_in_footprint(r("cells"), FRAME, 64, 64)
    return mapping.cell_shifts(near, r("offsets"), FRAME).select("offset_id", "cell_id", (F.round("sx", 3) + 0.0).alias("sx"), (F.round("sy", 3) + 0.0).alias("sy"))


_INSET = _TAN.format(k="cell_id, corner", src=f"""SELECT *, CAST(CASE cx WHEN 1 THEN naxis1 - CASE x WHEN 9 THEN 200 ELSE 70 END ELSE CASE x WHEN 0 THEN 200 ELSE 410 END END AS DOUBLE) AS px,
  CAST(CASE cy WHEN 1 THEN naxis2 - CASE y WHEN 9 THEN 200 ELSE 70 END ELSE CASE y WHEN 0 THEN 200 ELSE 410 END END AS DOUBLE) AS py FROM cells, {_CORNERS}""")


@query(f"""WITH {_FOOTPRINT}, {_OWN}, corners AS (SELECT cell_id, corner, {_XYZ} FROM ({_INSET}) WHERE cell_id IN (SELECT cell_id FROM near)),
sides AS (SELECT a.cell_id, a.y * b.z - a.z * b.y AS x, a.z * b.x - a.x * b.z AS y, a.x * b.y - a.y * b.x AS z FROM corners a JOIN corners b ON b.cell_id = a.cell_id AND b.corner = (a.corner + 1) % 4),
points AS (SELECT pix, px, py, {_XYZ} FROM ({_SIP})),
hits AS (SELECT pix, cell_id, any_value(px) AS px, any_value(py) AS py FROM points p, sides s GROUP BY pix, cell_id HAVING bool_and(p.x * s.x + p.y * s.y + p.z * s.z >= 0) OR bool_and(p.x * s.x + p.y * s.y + p.z * s.z <= 0)),
best AS (SELECT pix, arg_min(cell_id, sqrt(power(px - fx, 2) + power(py - fy, 2))) AS cell_id FROM hits JOIN own USING (cell_id) GROUP BY pix)
SELECT CAST(pix AS BIGINT) AS pix, CAST(cell_id AS INTEGER) AS cell_id, CAST(dense_rank() OVER (ORDER BY cell_id) - 1 AS INTEGER) AS dense_id FROM best""")
def frame_mapping(r):
    """From the catalogue and a frame to the cell of each pixel, in one run."""
    return mapping.frame_mapping(r("cells"), FRAME, 64, 64)


_PLACES = """SELECT *, CASE WHEN contains(side, 'top') OR contains(side, 'bottom') THEN naxis1 ELSE 490 END AS width, CASE WHEN contains(side, 'left') OR contains(side, 'right') THEN naxis2 ELSE 490 END AS height,
  CASE WHEN contains(side, 'right') THEN s + naxis1 + 235e0 WHEN contains(side, 'left') THEN s - 235e0 ELSE s + naxis1 / 2e0 END AS cx,
  CASE WHEN contains(side, 'bottom') THEN 245e0 WHEN contains(side, 'top') THEN 480 + naxis2 + 235e0 ELSE 480 + naxis2 / 2e0 END AS cy
FROM (SELECT *, 480 + (x - 5) * (naxis1 - 480) AS s FROM cells), (VALUES ('top'), ('right'), ('top_right'), ('bottom'), ('left'), ('bottom_left'), ('bottom_right'), ('top_left')) q(side)"""


@query("SELECT cell_id, side, width, height, cx, cy, round(ra, 6) AS ra, round(dec, 6) AS dec FROM (" + _TAN.format(k="cell_id, side, width, height, cx, cy", src=f"SELECT *, cx - s AS px, cy - 480 AS py FROM ({_PLACES})") + ")")
def padding_placement(r):
    """Place, shape and sky centre of each cell's padding, by side."""
    out = rows.padding_placement(r("cells").withColumn("k", F.col("x") - 5))
    return out.withColumn("ra", r6("ra", "ra")).withColumn("dec", r6("dec", "dec"))


@query("SELECT cell_id, band, y - 4 AS y, x + 6 AS x, value FROM pixels WHERE y >= 4 AND x < 26 AND NOT isnan(value) AND weight > 0.7")
def stitch_valid(r):
    """reprojected pixels inside the array, numbers, with a footprint."""
    moved = r("pixels").withColumn("y", F.col("y") - 4).withColumn("x", F.col("x") + 6).withColumn("footprint", F.when(F.col("weight") > 0.7, 1.0).otherwise(0.0))
    return rows.valid_for_stitching(moved, 32, 32).select("cell_id", "band", "y", "x", "value")


_SEP = "degrees(2 * asin(sqrt(least(power(sin((radians(d2) - radians(d1)) / 2), 2) + cos(radians(d1)) * cos(radians(d2)) * power(sin((radians(a2) - radians(a1)) / 2), 2), 1))))"


@query(f"SELECT source_id, round({_SEP}, 6) AS separation FROM (SELECT source_id, ra AS a1, dec AS d1, 30e0 AS a2, -20e0 AS d2 FROM stars) WHERE {_SEP} < 1.5")
def radius_filter(r):
    """P13 P14 F02."""
    s = r("stars").withColumn("s", wcs.separation("ra", "dec", 30.0, -20.0)).where("s < 1.5")
    return s.select("source_id", r6(F.col("s"), "separation"))


_EDGES = [((28.5, -21.5), (31.0, -21.75)), ((31.0, -21.75), (31.5, -18.5)), ((31.5, -18.5), (28.75, -18.25)), ((28.75, -18.25), (28.5, -21.5))]
_IN = " + ".join(f"CASE WHEN dec > least({a[1]}e0, {b[1]}e0) AND dec <= greatest({a[1]}e0, {b[1]}e0) AND ra <= greatest({a[0]}e0, {b[0]}e0) AND ({a[0]}e0 = {b[0]}e0 OR ra <= (dec - {a[1]}e0) * ({b[0]}e0 - {a[0]}e0) / ({b[1]}e0 - {a[1]}e0) + {a[0]}e0) THEN 1 ELSE 0 END" for a, b in _EDGES)


@query(f"SELECT source_id, phot_rp_mean_mag FROM stars WHERE phot_rp_mean_mag < 18 AND ({_IN}) % 2 = 1")
def star_query(r):
    """S06 S05 P19."""
    return catalog.in_region(catalog.checked(r("stars")), [e[0] for e in _EDGES]).select("source_id", "phot_rp_mean_mag")


@query(f"SELECT count(*) AS n FROM stars WHERE phot_rp_mean_mag < 18 AND ({_IN}) % 2 = 1")
def star_count(r):
    """A27."""
    return catalog.in_region(r("stars"), [e[0] for e in _EDGES]).agg(F.count("*").alias("n"))


@query("""SELECT source_id, x, y, phot_rp_mean_mag AS mag, phot_rp_mean_mag > 13.5 AND phot_rp_mean_mag < 17 AS in_model, phot_rp_mean_mag <= 14 AS replaced FROM (SELECT *, round((ra - 28) * 200, 3) AS x, round((dec + 22) * 200, 3) AS y FROM stars WHERE ra BETWEEN 28.5 AND 31 AND dec BETWEEN -21.5 AND -19)
WHERE x >= 120 AND x < 580 AND y >= 110 AND y < 500 AND x >= 145 AND x < 700 - 145 AND y >= 145 AND y < 700 - 145""")
def star_regions(r):
    """F03 F04 F05 F06 A18."""
    s = catalog.on_pixels(r("stars"), lambda ra, dec: (F.round((ra - 28) * 200, 3), F.round((dec + 22) * 200, 3)), 28.5, 31, -21.5, -19, 120, 580, 110, 500)
    model, replaced = catalog.magnitude_bands("mag")
    return catalog.away_from_edge(s, 700, 700, 145).select("source_id", "x", "y", "mag", model.alias("in_model"), replaced.alias("replaced"))


@query("SELECT cell_id, CASE WHEN cell_id % 3 = 0 THEN cell_id * 1e-5 WHEN cell_id % 3 = 1 THEN cdelt1 * pc1_1 ELSE 1e0 / 3600 END AS cd FROM cells")
def cd_matrix(r):
    """P31."""
    k = F.col("cell_id") % 3
    return r("cells").select("cell_id", wcs.cd_matrix(F.when(k == 0, F.col("cell_id") * 1e-5), F.when(k == 1, F.col("cdelt1")), F.when(k == 1, F.col("pc1_1"))).alias("cd"))


# ---- mapping ----

_QUAD = "b AS (SELECT cell_id, CAST(cell_id * 3 % 50 AS DOUBLE) AS x0, CAST(cell_id * 7 % 50 AS DOUBLE) AS y0 FROM cells)"


def _near(r):
    points = wcs.frame_pixels(r("region").sparkSession, 64, 64)
    boxes = r("cells").select("cell_id", (F.col("cell_id") * 3 % 50).cast("double").alias("x0"), (F.col("cell_id") * 7 % 50).cast("double").alias("y0"))
    cover = boxes.withColumn("py", F.explode(F.sequence(F.col("y0").cast("int"), F.col("y0").cast("int") + 13))).withColumn("px", F.explode(F.sequence(F.col("x0").cast("int"), F.col("x0").cast("int") + 13)))
    hits = cover.select((F.col("py") * 64 + F.col("px")).cast("long").alias("pix"), "cell_id")
    centres = boxes.select("cell_id", (F.col("x0") + 6.5).alias("cx"), (F.col("y0") + 6.5).alias("cy"))
    return mapping.nearest_centre(hits, points, centres)


_NEAREST = f"""WITH {_QUAD}, h AS (SELECT CAST((y0 + j.range) * 64 + x0 + i.range AS BIGINT) AS pix, cell_id, sqrt(power(x0 + i.range - (x0 + 6.5e0), 2) + power(y0 + j.range - (y0 + 6.5e0), 2)) AS d FROM b, range(14) i, range(14) j),
n AS (SELECT pix, arg_min(cell_id, (d, cell_id)) AS cell_id, min(d) AS distance FROM h GROUP BY pix) """


@query(_NEAREST + "SELECT pix, cell_id, round(distance, 6) AS distance FROM n")
def nearest_centre(r):
    """A01 D4."""
    return _near(r).withColumn("distance", F.round("distance", 6))


@query(_NEAREST + "SELECT cell_id, CAST(dense_rank() OVER (ORDER BY cell_id) - 1 AS INTEGER) AS dense_id, array_to_string(list_sort(list(pix)), ',') AS pixels, count(*) AS n_pixels FROM n GROUP BY cell_id")
def pixel_lists(r):
    """A02 J02 D6 K04."""
    near = _near(r)
    ids = mapping.dense_ids(near).select("cell_id", "dense_id").distinct()
    return mapping.pixel_lists(near).join(ids, "cell_id").select("cell_id", "dense_id", F.concat_ws(",", F.transform("pixels", lambda p: p.cast("string"))).alias("pixels"), "n_pixels")


def _boxes(r):
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = F.col("cell_id") % 40 + 0.5, F.col("cell_id") * 7 % 40 + 0.25
    return r("cells").select(F.col("cell_id").alias("id"), F.array(p(x, y), p(x - 1, y + 5), p(x + 5, y + 6), p(x + 6, y + 1)).alias("quad"))


def _edge(a, b):
    (ax, ay), (bx, by) = a, b
    return f"CASE WHEN y > least({ay}, {by}) AND y <= greatest({ay}, {by}) AND x <= greatest({ax}, {bx}) AND ({ax} = {bx} OR x <= (y - ({ay})) * (({bx}) - ({ax})) / (({by}) - ({ay})) + ({ax})) THEN 1 ELSE 0 END"


_Q = [("qx", "qy"), ("qx - 1", "qy + 5"), ("qx + 5", "qy + 6"), ("qx + 6", "qy + 1")]
_FILL = f"""WITH q AS (SELECT cell_id AS id, CAST(cell_id % 40 + 0.5 AS DOUBLE) AS qx, CAST(cell_id * 7 % 40 + 0.25 AS DOUBLE) AS qy FROM cells),
f AS (SELECT id, CAST(j.range AS INTEGER) AS y, CAST(i.range AS INTEGER) AS x FROM q, range(40) i, range(40) j WHERE ({" + ".join(_edge(a, b).replace("y >", "j.range >").replace("y <=", "j.range <=").replace("(y -", "(j.range -").replace("x <=", "i.range <=") for a, b in zip(_Q, _Q[1:] + _Q[:1]))}) % 2 = 1) """


@query(_FILL + "SELECT id, y, x FROM f")
def rectangle_fill(r):
    """J04 P19."""
    return mapping.fill_rectangles(_boxes(r), 40, 40)


@query(_FILL + "SELECT y, x, max(id) AS pix FROM f GROUP BY y, x")
def last_writer(r):
    """A03 D5."""
    return mapping.last_writer(mapping.fill_rectangles(_boxes(r), 40, 40))


def _ring(r):
    """Small quads around the cells' own positions on the sky, spread over the star field and its surroundings."""
    ra0, dec0 = 28.0 + F.col("cell_id") * 37 % 40 / 10.0, -22.0 + F.col("cell_id") * 13 % 40 / 10.0
    v = lambda dx, dy: F.struct((ra0 + dx).alias("ra"), (dec0 + dy).alias("dec"))
    return r("cells").select("cell_id", F.array(v(0.0, 0.0), v(0.02, 0.4), v(0.41, 0.42), v(0.4, 0.01)).alias("ring"))


_V = "cos(radians({d})) * cos(radians({a})) AS {n}x, cos(radians({d})) * sin(radians({a})) AS {n}y, sin(radians({d})) AS {n}z"
_VS = ", ".join(_V.format(a=f"a0 + {dx}e0", d=f"d0 + {dy}e0", n=f"v{i}") for i, (dx, dy) in enumerate(((0.0, 0.0), (0.02, 0.4), (0.41, 0.42), (0.4, 0.01))))
_SIDE = "((v{i}y * v{j}z - v{i}z * v{j}y) * px + (v{i}z * v{j}x - v{i}x * v{j}z) * py + (v{i}x * v{j}y - v{i}y * v{j}x) * pz)"
_ALL = lambda op: " AND ".join(_SIDE.format(i=i, j=(i + 1) % 4) + op + " 0" for i in range(4))


@query(f"""WITH c AS (SELECT cell_id, {_VS} FROM (SELECT cell_id, 28e0 + cell_id * 37 % 40 / 10e0 AS a0, -22e0 + cell_id * 13 % 40 / 10e0 AS d0 FROM cells)), p AS (SELECT source_id AS id, {_V.format(a="ra", d="dec", n="p")} FROM stars)
SELECT id, cell_id FROM p, c WHERE ({_ALL(" >=")}) OR ({_ALL(" <=")})""")
def spatial_join(r):
    """Buckets and the exact test, once for each place and ring."""
    return mapping.same_places(r("stars").select(F.col("source_id").alias("id"), "ra", "dec"), _ring(r))


def _sky_of(source: str) -> str:
    """_sip_of() with the frame's reference point, where the projection's formula has no value, on its own place."""
    at = "px = 315e-1 AND py = 315e-1"
    return f"SELECT pix, CASE WHEN {at} THEN 31e0 ELSE ra END AS ra, CASE WHEN {at} THEN -19e0 ELSE dec END AS dec FROM ({_sip_of(source)})"


_ENDS = [(f"x{i}", f"y{i}") for i in range(4)]
_SPAN = lambda c: f"unnest(generate_series(greatest(0, least(199, CAST(floor(least({c}0, {c}1, {c}2, {c}3)) AS INT))), greatest(0, least(199, CAST(ceil(greatest({c}0, {c}1, {c}2, {c}3)) AS INT)))))"


@query(_NEAREST + f""", places AS (SELECT pix AS cell_id, ra AS crval1, dec AS crval2 FROM ({_sky_of("SELECT cell_id AS pix, cell_id * 3 % 50 + 65e-1 AS px, cell_id * 7 % 50 + 65e-1 AS py FROM cells")})),
ends AS (SELECT pix * 4 + i AS pix, pix % 64 + dx AS px, pix // 64 + dy AS py FROM n, (VALUES (0, -5e-1, -5e-1), (1, -5e-1, 5e-1), (2, 5e-1, 5e-1), (3, 5e-1, -5e-1)) q(i, dx, dy)),
sky AS (SELECT pix // 4 AS pix, pix % 4 AS i, ra, dec FROM ({_sky_of("SELECT pix, px, py FROM ends")})),
on_cell AS (SELECT pix, cell_id, i, xi / -5e-3 + 995e-1 AS x, eta / 5e-3 + 995e-1 AS y FROM ({_FLAT.format(k="pix, cell_id, i", a0="crval1", d0="crval2", src="(SELECT * FROM sky JOIN n USING (pix) JOIN places USING (cell_id))")})),
quads AS (SELECT pix, cell_id, {", ".join(f"max(CASE i WHEN {i} THEN {c} END) AS {c}{i}" for i in range(4) for c in "xy")} FROM on_cell GROUP BY 1, 2),
spots AS (SELECT *, {_SPAN("x")} AS x FROM (SELECT *, {_SPAN("y")} AS y FROM quads))
SELECT cell_id, CAST(y AS INT) AS y, CAST(x AS INT) AS x, max(pix) AS pix FROM spots WHERE ({" + ".join(_edge(a, b) for a, b in zip(_ENDS, _ENDS[1:] + _ENDS[:1]))}) % 2 = 1 GROUP BY 1, 2, 3""")
def cell_mapping(r):
    """A frame's pixels to the pixels of every cell that is nearest to some of them, through the sky. Cells lie on the sky under
    their boxes of the nearest-centre result."""
    ra, dec = wcs.sip_pixel_to_sky(F.col("cell_id") * 3 % 50 + 6.5, F.col("cell_id") * 7 % 50 + 6.5, FRAME)
    cells = r("cells").withColumn("crval1", ra).withColumn("crval2", dec).withColumn("crpix1", F.lit(100.5)).withColumn("crpix2", F.lit(100.5)).withColumn("cdelt1", F.lit(-0.005)).withColumn("cdelt2", F.lit(0.005))
    return mapping.cell_assignment(cells, _near(r).select("cell_id", "pix"), FRAME, 1, 64, 200)


# ---- padding ----


@query("""SELECT cell_id, bool_or(x BETWEEN 1 AND 30 AND y BETWEEN 26 AND 30 AND pix <> -1) AS top, bool_or(x BETWEEN 26 AND 30 AND y BETWEEN 1 AND 30 AND pix <> -1) AS right, bool_or(x BETWEEN 26 AND 30 AND y BETWEEN 26 AND 30 AND pix <> -1) AS top_right,
bool_or(x BETWEEN 1 AND 30 AND y BETWEEN 1 AND 5 AND pix <> -1) AS bottom, bool_or(x BETWEEN 1 AND 5 AND y BETWEEN 1 AND 30 AND pix <> -1) AS left, bool_or(x BETWEEN 1 AND 5 AND y BETWEEN 1 AND 5 AND pix <> -1) AS bottom_left,
bool_or(x BETWEEN 26 AND 30 AND y BETWEEN 1 AND 5 AND pix <> -1) AS bottom_right, bool_or(x BETWEEN 1 AND 5 AND y BETWEEN 26 AND 30 AND pix <> -1) AS top_left FROM assignment GROUP BY cell_id""".replace(" AS right", ' AS "right"').replace(" AS left", ' AS "left"'))
def edge_strips(r):
    """F13."""
    return padding.edge_strips(r("assignment"), 32, 32, 5, 1)


_F = {s: f"cell_id % {3 + i} = 0" for i, (s, _, _) in enumerate(SIDES)}


@query(f"""SELECT cell_id, CASE WHEN NOT ({_F['bottom']} OR {_F['left']} OR {_F['top_left']} OR {_F['bottom_left']} OR {_F['bottom_right']}) THEN false WHEN x > 0 AND x < 9 AND y > 0 AND y < 9 THEN true WHEN x = 0 AND y = 0 THEN false
WHEN y = 0 THEN NOT ({_F['bottom']} OR {_F['bottom_left']} OR {_F['bottom_right']}) WHEN x = 0 THEN NOT ({_F['left']} OR {_F['top_left']} OR {_F['bottom_left']}) WHEN y = 9 THEN NOT ({_F['top']} OR {_F['top_left']} OR {_F['top_right']})
ELSE NOT ({_F['right']} OR {_F['top_right']} OR {_F['bottom_right']}) END AS fail FROM (SELECT cell_id, (x + 5) % 10 AS x, (y + cell_id) % 10 AS y FROM cells)""")
def good_side_fail(r):
    """F14."""
    c = r("cells").select("cell_id", ((F.col("x") + 5) % 10).alias("x"), ((F.col("y") + F.col("cell_id")) % 10).alias("y"), *((F.col("cell_id") % (3 + i) == 0).alias(s) for i, (s, _, _) in enumerate(SIDES)))
    return c.select("cell_id", padding.good_side_fail(F.col("y"), F.col("x")).alias("fail"))


@query(f"""SELECT name, side, CASE WHEN y + dy BETWEEN 0 AND 9 AND x + dx BETWEEN 0 AND 9 THEN 'skycell.' || projection || '.0' || (y + dy) || (x + dx) END AS neighbour FROM cells, (VALUES {_SIDE_ROWS}) s(side, dx, dy)""")
def neighbour_cells(r):
    """J08."""
    return padding.neighbours(r("cells"))


_POS = """pos AS (SELECT name, projection, y, x, CASE WHEN k = 1 THEN 'first' WHEN k = n THEN 'last' ELSE 'interior' END AS cell_position, CASE WHEN y = lo THEN 'bottom' WHEN y = hi THEN 'top' ELSE 'middle' END AS row_position,
CAST(k - 1 AS INTEGER) AS cell_index, CAST(dr - 1 AS INTEGER) AS row_index FROM (SELECT *, row_number() OVER (PARTITION BY projection, y ORDER BY x) AS k, count(*) OVER (PARTITION BY projection, y) AS n,
min(y) OVER (PARTITION BY projection) AS lo, max(y) OVER (PARTITION BY projection) AS hi, dense_rank() OVER (PARTITION BY projection ORDER BY y) AS dr FROM cells))"""


@query(f"WITH {_POS} SELECT * FROM pos")
def cell_positions(r):
    """W02 W03 W04."""
    return padding.row_positions(r("cells"))


_PAIR2 = _PAIRS.replace("FROM padding", "FROM (SELECT name, dir, CASE WHEN pad_skycell LIKE 'skycell.%' THEN replace(pad_skycell, 'skycell.2', 'skycell.3') ELSE pad_skycell END AS pad_skycell FROM padding)")
_REQ = f"""{_PAIR2}, {_POS}, req AS (SELECT p.*, q.projection, q.y, q.x, cell_position, row_position FROM pairs p JOIN pos q USING (name) WHERE TRY_CAST(split_part(pad_cell, '.', 2) AS INTEGER) <> q.projection
AND (NOT contains(side, 'top') OR row_position = 'top') AND (NOT contains(side, 'bottom') OR row_position = 'bottom') AND (NOT contains(side, 'left') OR cell_position = 'first') AND (NOT contains(side, 'right') OR cell_position = 'last'))"""


def _requirements(r):
    p = r("padding").withColumn("pad_skycell", F.when(F.col("pad_skycell").like("skycell.%"), F.replace("pad_skycell", F.lit("skycell.2"), F.lit("skycell.3"))).otherwise(F.col("pad_skycell")))
    return padding.requirements(padding.padding_pairs(p), padding.row_positions(r("cells")))


@query(f"WITH {_REQ} SELECT name, side, pad_cell, rank FROM req")
def cross_projection_requirements(r):
    """F11."""
    return _requirements(r).select("name", "side", "pad_cell", "rank")


@query(f"""WITH {_REQ} SELECT pad_cell, array_to_string(list_sort(list_distinct(list(t))), ',') AS targets, count(*) AS n_uses FROM (SELECT pad_cell, 'current' AS t FROM req WHERE y <= 7 UNION ALL SELECT pad_cell, 'next' FROM req WHERE y > 5) GROUP BY 1""")
def padding_jobs(r):
    """J14 X05."""
    q = _requirements(r)
    return padding.jobs(q.where("y <= 7"), q.where("y > 5")).select("pad_cell", F.concat_ws(",", "targets").alias("targets"), "n_uses")


_WIDE = ", ".join(f"coalesce(array_to_string(list_sort(list_distinct(list(pad_cell) FILTER (side = '{s}'))), '/'), '') AS pad_skycell_{s}" for s, _, _ in SIDES)


@query(f"WITH {_PAIRS} SELECT c.cell_id, {_WIDE} FROM cells c LEFT JOIN pairs p ON p.name = c.name GROUP BY c.cell_id")
def attach_padding(r):
    """J03."""
    return padding.attach(r("cells"), padding.padding_pairs(r("padding"))).select("cell_id", *(f"pad_skycell_{s}" for s, _, _ in SIDES))


@query()
def padding_search(r):
    """The best cover of each region that another projection has to fill."""
    points = lambda c: F.transform(c, lambda p: F.struct(p["ra"].alias("ra"), p["dec"].alias("dec")))
    # a number of its own, as few bytes of cells make much work; corners are computed once a cell, and a side takes its four
    c = r("cells").repartition(int(r("cells").sparkSession.conf.get("spark.sql.shuffle.partitions")), "name")
    quads = c.select("name", points(wcs.corners(0.0)).alias("quad"))
    every = c.select("name", points(wcs.padding_corners()).alias("all"))
    regions = every.select("name", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.slice("all", 4 * i + 1, 4).alias("region")) for i, (s, _, _) in enumerate(SIDES)))).alias("s")).select("name", "s.side", "s.region")
    return padding.best_padding(padding.candidates(regions, quads)).withColumn("coverage", F.round("coverage", 6))


# ---- rows and stencils ----


@query("SELECT projection, y, lead(y) OVER (PARTITION BY projection ORDER BY y) AS next_y FROM (SELECT DISTINCT projection, y FROM cells)")
def row_pairs(r):
    """W01."""
    return rows.row_pairs(r("cells"))


@query("SELECT projection, y, array_to_string(list(name ORDER BY x), ',') AS names FROM cells GROUP BY 1, 2")
def row_lists(r):
    """A16 W09."""
    return rows.row_lists(r("cells")).select("projection", "y", F.concat_ws(",", "names").alias("names"))


@query("""SELECT projection, w AS width, h AS height, max_cells, min_x, n_rows, 480 + max_cells * (w - 480) + 960 AS master_width, h + 960 AS master_height FROM (
SELECT projection, max(naxis1) AS w, max(naxis2) AS h, max(n) AS max_cells, least(min(mx), 10) AS min_x, count(*) AS n_rows FROM (SELECT projection, y, max(naxis1) AS naxis1, max(naxis2) AS naxis2, count(*) AS n, min(x) AS mx FROM cells GROUP BY 1, 2) GROUP BY 1)""")
def master_geometry(r):
    """A17 P40."""
    return rows.master_size(rows.projection_facts(r("cells")))


_ASM = """src AS (SELECT c.projection, c.y AS row, c.x - 5 AS k, p.y, p.x, p.value FROM cells c JOIN image p USING (cell_id)),
asm AS (SELECT projection, row, y + 8 AS my, 8 + k * 24 + x AS mx, arg_max(value, k) AS value FROM src WHERE k = 0 OR x >= 6 GROUP BY 1, 2, 3, 4)"""


def _assembled(r):
    src = r("cells").select("cell_id", "projection", F.col("y").alias("row"), (F.col("x") - 5).alias("k")).join(r("image"), "cell_id")
    return rows.assemble(src, 32, 32, 8, 2, 8)


@query(f"WITH {_ASM} SELECT projection, row, my, mx, round(value, 6) AS value FROM asm")
def row_assembly(r):
    """W05."""
    return _assembled(r).withColumn("value", F.round("value", 6))


@query(f"""WITH {_ASM}, pr AS (SELECT projection, y, lead(y) OVER (PARTITION BY projection ORDER BY y) AS ny, lag(y) OVER (PARTITION BY projection ORDER BY y) AS py FROM (SELECT DISTINCT projection, y FROM cells))
SELECT a.projection, a.row, my, mx, round(value, 6) AS value FROM asm a JOIN pr ON pr.projection = a.projection AND pr.y = a.row WHERE (ny IS NULL OR my < 38) AND (py IS NULL OR my >= 10)
UNION ALL SELECT a.projection, py, my + 24, mx, round(value, 6) FROM asm a JOIN pr ON pr.projection = a.projection AND pr.y = a.row WHERE py IS NOT NULL AND my + 24 >= 38 AND my + 24 < 48
UNION ALL SELECT a.projection, ny, my - 24, mx, round(value, 6) FROM asm a JOIN pr ON pr.projection = a.projection AND pr.y = a.row WHERE ny IS NOT NULL AND my >= 24 AND my < 34""")
def cross_row(r):
    """J15."""
    return rows.cross_row(_assembled(r), rows.row_pairs(r("cells")), 32, 8, 2, 8).withColumn("value", F.round("value", 6))


@query(f"WITH {_ASM} SELECT c.name, my - 8 AS y, mx - (8 + (c.x - 5) * 24) AS x, round(value, 6) AS value FROM cells c JOIN asm a ON a.projection = c.projection AND a.row = c.y WHERE mx BETWEEN 8 + (c.x - 5) * 24 AND 8 + (c.x - 5) * 24 + 31 AND my BETWEEN 8 AND 39")
def cell_extract(r):
    """L06."""
    cells = r("cells").select("name", "projection", F.col("y").alias("row"), (F.col("x") - 5).alias("k"))
    return rows.extract(_assembled(r), cells, 32, 32, 8, 8).withColumn("value", F.round("value", 6))


_G2 = rows.kernel(1.5, 2)
_TAPS2 = ", ".join(f"({i - 2}, {w!r}e0)" for i, w in enumerate(_G2.tolist()))


@query(f"""WITH t AS (SELECT * FROM (VALUES {_TAPS2}) t(d, w)), a AS (SELECT g.y + d AS y, g.x, sum(value * w) AS value FROM grid g, t GROUP BY 1, 2),
a2 AS (SELECT g.y, g.x, coalesce(a.value, 0) AS value FROM grid g LEFT JOIN a ON a.y = g.y AND a.x = g.x), b AS (SELECT a2.y, a2.x + d AS x, sum(value * w) AS value FROM a2, t GROUP BY 1, 2)
SELECT g.y, g.x, round(coalesce(b.value, 0), 6) AS smooth FROM grid g LEFT JOIN b ON b.y = g.y AND b.x = g.x""")
def stencil_separable(r):
    """W06 with a small radius: the same plan as for the full one."""
    down, across = rows.separable_taps(_G2)
    first = rows.stencil(r("grid"), down).select("y", "x", F.col("smooth").alias("value"))
    return rows.stencil(first, across).select("y", "x", r6("smooth", "smooth"))


_TAPS3 = ", ".join(f"({dy}, {dx}, {w!r}e0)" for dy, dx, w in rows.psf_taps())


@query(f"WITH s AS (SELECT g.y + dy AS y, g.x + dx AS x, sum(value * w) AS v FROM grid g, (VALUES {_TAPS3}) t(dy, dx, w) GROUP BY 1, 2) SELECT g.y, g.x, round(coalesce(v, 0), 6) AS smooth FROM grid g LEFT JOIN s ON s.y = g.y AND s.x = g.x")
def stencil_psf(r):
    """W07."""
    return rows.stencil(r("grid"), rows.psf_taps()).select("y", "x", r6("smooth", "smooth"))


@query("SELECT CAST(least(x // 6, 4) AS INTEGER) AS chunk, count(*) AS n, CAST(count(*) FILTER (y < 2 OR y >= 30 OR x < 2 OR x >= 30) AS BIGINT) AS rim FROM grid GROUP BY 1")
def x_chunks(r):
    """W12 P39."""
    g = r("grid").withColumn("v", rows.edge_to_nan(F.col("value"), F.col("y"), F.col("x"), 32, 32, 2))
    return g.groupBy(rows.x_chunks(F.col("x"), 32, 5).alias("chunk")).agg(F.count("*").alias("n"), F.count_if(F.isnan("v")).alias("rim"))


@query("""WITH p AS (SELECT i.cell_id, i.y, i.x, i.y AS gy, i.x + 24 * (c.x - 5) AS gx, c.y AS row, c.projection, i.mask FROM image i JOIN cells c USING (cell_id))
SELECT cell_id, y, x, m AS row_mask FROM p JOIN (SELECT projection, row, gy, gx, arg_max(mask, cell_id) AS m FROM p GROUP BY 1, 2, 3, 4) USING (projection, row, gy, gx)""")
def unified_row_mask(r):
    """A19 A18, of every row of every projection."""
    return _row_masks(r, r("cells"))


def _row_masks(r, cells):
    at = cells.select("cell_id", "projection", F.col("y").alias("row"), F.lit(0).alias("y0"), (24 * (F.col("x") - 5)).alias("x0"))
    return rows.unified_mask(r("image").select("cell_id", "y", "x", "mask"), at)


# ---- statistics ----


@query("""SELECT cell_id, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.9), 6) AS percentile, round(stddev_pop(v), 6) AS std, count(v) AS n FROM (SELECT cell_id, CASE WHEN isnan(value) THEN NULL ELSE value END AS v FROM pixels) GROUP BY 1""")
def nan_stats(r):
    """A13."""
    return analysis.nan_stats(r("pixels"), ["cell_id"]).select("cell_id", r6("median", "median"), r6("percentile", "percentile"), r6("std", "std"), "n")


@query("SELECT cell_id, round(sqrt(avg((value - 1.5) * (value - 1.5))), 6) AS noise FROM pixels WHERE NOT isnan(value) AND value < 1.5 GROUP BY 1")
def noise_level(r):
    """A14."""
    return analysis.noise_level(r("pixels").withColumn("value", F.col("value") - 1.5), ["cell_id"]).withColumn("noise", F.round("noise", 6))


@query("SELECT frame_id, detector, round(crval1 - avg(crval1) OVER (PARTITION BY detector), 6) AS d FROM frames")
def detrend(r):
    """A20 D17."""
    return analysis.detrended(r("frames"), ["crval1"], ["detector"]).select("frame_id", "detector", (F.round("crval1_detrended", 6) + 0.0).alias("d"))


@query("SELECT frame_id, round(epoch_us(date_obs) / 8.64e10 + 40587, 6) AS mjd FROM frames")
def frame_mjd(r):
    """P41."""
    return r("frames").select("frame_id", r6(analysis.modified_julian_date(F.col("date_obs")), "mjd"))


@query("SELECT k, CAST(regexp_extract(k, '^[AB]_(\\d+)_(\\d+)$', 1) AS INTEGER) + CAST(regexp_extract(k, '^[AB]_(\\d+)_(\\d+)$', 2) AS INTEGER) AS ord, n FROM (SELECT k, count(*) AS n FROM frames, (VALUES ('A_2_0'), ('B_1_2'), ('A_0_4')) v(k) GROUP BY k)")
def coefficient_orders(r):
    """Coefficient keys of header maps."""
    h = F.create_map(*(F.lit(x) for k in ("A_2_0", "B_1_2", "AP_1_0", "CRVAL1", "A_0_4") for x in (k, "1")))
    keys = r("frames").select(F.explode(F.map_keys(names.select_header(h, [], r"^[AB]_\d+_\d+$"))).alias("k"))
    return keys.groupBy("k").agg(F.count("*").alias("n")).select("k", names.coefficient_order("k").alias("ord"), "n")


@query("SELECT projection, arg_min(crpix1, cell_id) AS crpix1, arg_min(name, cell_id) AS name FROM cells GROUP BY 1")
def first_wcs(r):
    """A25."""
    return analysis.first_by_projection(r("cells"), "cell_id", ["crpix1", "name"])


@query("SELECT cell_id, CAST(sum(n) AS BIGINT) AS buffered FROM (SELECT cell_id, band, count(*) AS n FROM pixels GROUP BY 1, 2) GROUP BY 1")
def buffer_size(r):
    """A26."""
    arrays = r("pixels").groupBy("cell_id", "band").agg(F.collect_list("x").alias("xs"))
    return arrays.groupBy("cell_id").agg(F.sum(F.size("xs")).alias("buffered"))


@query("SELECT y, x, round(value, 3) > 200 OR y >= 29 OR x < 4 OR x >= 28 AS masked FROM grid")
def mask_area(r):
    """Forced margins."""
    g = r("grid").withColumn("ratio", F.round("value", 3))
    return analysis.mask_ratio_area(g, 32, 32, 3, 4, 200.0).select("y", "x", "masked")


# ---- inventory ----

_EXPECTED = "[" + ", ".join(f"'{a}'" for a in EXPECTED_ARRAYS) + "]"
_CELLS = f"""s AS (SELECT cell_id, count(*) AS n_arrays, CAST(12 - count(*) FILTER (list_contains({_EXPECTED}, array_name)) AS INTEGER) AS n_missing, CAST(count(*) FILTER (NOT list_contains({_EXPECTED}, array_name) AND NOT contains(array_name, '_temp_')) AS INTEGER) AS n_extra,
CAST(count(*) FILTER (contains(array_name, '_temp_')) AS INTEGER) AS n_temp, CAST(count(*) FILTER (NOT readable AND NOT contains(array_name, '_temp_')) AS INTEGER) AS n_corrupted, CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM inventory GROUP BY 1),
c AS (SELECT *, n_missing = 0 AS complete, n_corrupted > 0 OR n_temp > 0 AS corrupted FROM s)"""


@query(f"WITH {_CELLS} SELECT * FROM c")
def inventory_cells(r):
    """A21 A22 A23 D16."""
    return inventory.cell_summary(r("inventory")).drop("missing_text", "corruption_text")


@query(f"WITH {_CELLS} SELECT count(*) AS total, count(*) FILTER (complete) AS complete, count(*) FILTER (corrupted) AS corrupted, count(*) - count(*) FILTER (complete) - count(*) FILTER (corrupted) AS incomplete, round(100e0 * count(*) FILTER (complete) / count(*), 6) AS percent_complete, round(sum(total_bytes) / 1048576e0, 6) AS megabytes FROM c")
def inventory_totals(r):
    """A24."""
    return inventory.totals(inventory.cell_summary(r("inventory")))


@query(f"SELECT cell_id, array_name FROM (SELECT cell_id, unnest({_EXPECTED}) AS array_name FROM cells) EXCEPT SELECT cell_id, array_name FROM inventory")
def missing_arrays(r):
    """J11 J12 U03."""
    return inventory.missing_arrays(r("cells"), r("inventory"))


@query(f"SELECT cell_id, array_name FROM (SELECT cell_id, unnest({_EXPECTED}) AS array_name FROM cells) EXCEPT SELECT cell_id, array_name FROM inventory WHERE readable")
def resume_ingest(r):
    """T05."""
    return inventory.to_fetch(r("cells"), r("inventory"))


@query("SELECT cell_id, array_name, contains(array_name, '_temp_') AS temp FROM inventory WHERE contains(array_name, '_temp_') OR NOT readable")
def cleanup_arrays(r):
    """X01 X02."""
    i = r("inventory")
    return inventory.temp_arrays(i).unionByName(inventory.corrupted_arrays(i)).select("cell_id", "array_name", inventory.is_temp().alias("temp"))


@query(f"WITH {_CELLS} SELECT (SELECT count(*) FROM inventory WHERE contains(array_name, '_temp_')) AS temp, (SELECT count(*) FROM inventory WHERE contains(array_name, '_temp_') OR NOT readable) AS corrupted, (SELECT round(coalesce(sum(size_bytes), 0) / 1048576e0, 6) FROM inventory WHERE contains(array_name, '_temp_')) AS temp_mb, (SELECT count(*) FROM c WHERE NOT complete AND NOT corrupted) AS incomplete")
def cleanup_preview(r):
    """X03 X04."""
    return inventory.cleanup_preview(r("inventory"), inventory.cell_summary(r("inventory")))


@query("SELECT cell_id, band, bool_and(isnan(value)) AS all_nan, bool_and(value = 0) AS all_zero, CASE WHEN bool_and(isnan(value)) THEN 'All NaN values' WHEN bool_and(value = 0) THEN 'All zero values' END AS note FROM pixels WHERE y < 10 AND x < 10 GROUP BY 1, 2")
def array_health(r):
    """A21."""
    return inventory.array_health(r("pixels"), ["cell_id", "band"])


@query("SELECT projection FROM cells INTERSECT SELECT DISTINCT CAST(2000 + cell_id // 25 AS INTEGER) FROM inventory WHERE array_name = 'r_temp_1'")
def stored_projections(r):
    """U05."""
    return r("cells").select("projection").intersect(r("inventory").where("array_name = 'r_temp_1'").select((2000 + F.floor(F.col("cell_id") / 25)).cast("int").alias("projection")))


@query("SELECT cell_id, y, x, mask FROM image WHERE cell_id = 7")
def select_array(r):
    """S17."""
    return r("image").where("cell_id = 7").select("cell_id", "y", "x", "mask")


# ---- kernels ----


def _rasters(r):
    e = r("embeddings").withColumn("key", F.floor(F.col("vec_id") / 32).cast("string")).withColumn("line", (F.col("vec_id") % 32).cast("int"))
    data = F.transform("embedding", lambda v: v.cast("double"))
    stacked = e.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("line", data.alias("d")))).alias("l"))
    return stacked.select("key", F.size("l").alias("h"), F.lit(64).alias("w"), F.flatten(F.transform("l", lambda s: s["d"])).alias("data"))


#: A small grid, so that most sources lie in several chunks; an error that differs from line to line.
_SOURCES = extraction.Rules(size=16, bright=8.0)
_NOISE = "4e-2 + 2e-3 * (vec_id % 5)"


def _source_oracle() -> str:
    s = _SOURCES
    return f"""WITH RECURSIVE px AS (SELECT key, y, CAST(u.x AS INT) AS x, CAST(embedding[u.x + 1] AS DOUBLE) AS v, e FROM (SELECT CAST(CAST(floor(vec_id / 32) AS INT) AS STRING) AS key, CAST(vec_id % 32 AS INT) AS y, embedding, {_NOISE} AS e FROM embeddings) r CROSS JOIN range(64) u(x)),
bright AS (SELECT key, {s.bright}e0 * median(e) AS level FROM px GROUP BY 1),
real AS (SELECT key, y, x, v, e, v > level AS hot FROM px JOIN bright USING (key)),
k(d, k) AS (VALUES (-1, 1), (0, 2), (1, 1)),
filtered AS (SELECT key, y + a.d AS y, x + b.d AS x, sum(a.k * b.k * v / (e * e)) / sqrt(sum(a.k * a.k * b.k * b.k / (e * e))) AS snr FROM real CROSS JOIN k a CROSS JOIN k b WHERE NOT hot GROUP BY 1, 2, 3),
over AS MATERIALIZED (SELECT key, y, x, v, CAST(y AS BIGINT) * 4294967296 + x + 1 AS id FROM real JOIN filtered USING (key, y, x) WHERE NOT hot AND snr > {s.sigma}),
near AS MATERIALIZED (SELECT a.key, a.id, b.id AS other FROM over a JOIN over b ON a.key = b.key AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 AND a.id <> b.id),
seeds AS (SELECT key, id FROM over o WHERE NOT EXISTS (SELECT 1 FROM near n WHERE n.key = o.key AND n.id = o.id AND n.other < o.id)),
reach AS (SELECT key, id AS seed, id FROM seeds UNION SELECT r.key, r.seed, n.other FROM reach r JOIN near n ON n.key = r.key AND n.id = r.id),
owned AS (SELECT key, id, min(seed) AS label FROM reach GROUP BY 1, 2),
sized AS (SELECT *, count(*) OVER (PARTITION BY key, label) AS area FROM owned)
SELECT key, y, x, v AS value, label FROM over JOIN sized USING (key, id) WHERE area >= {s.min_area} UNION ALL SELECT key, y, x, v, -1 FROM real WHERE hot"""


@query(_source_oracle())
def source_detect(r):
    """Background to zero, sources labelled over the borders of chunks; every pixel that is kept, with its source."""
    lines = r("embeddings").select(F.floor(F.col("vec_id") / 32).cast("string").alias("key"), (F.col("vec_id") % 32).alias("y"), F.expr(_NOISE).alias("error"), F.posexplode("embedding").alias("x", "value"))
    stored = extraction.store_chunks(extraction.chunks(lines, _SOURCES.size), 8)
    return extraction.kept_pixels(extraction.extract(stored, _SOURCES, 8), _SOURCES.size)


@query()
def star_repair(r):
    """Bright stars' cores from a model. Held against invariants in the tests."""
    stars = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(m).alias("mag")) for x, y, m in ((10.0, 8.0, 15.0), (30.0, 16.0, 16.0), (50.0, 20.0, 13.0))))
    rasters = _rasters(r).withColumn("mask", F.transform("data", lambda v: F.lit(0))).withColumn("stars", stars)
    out = kernels.replace_saturated(rasters, half=3)
    return out.select("key", F.posexplode(F.arrays_zip("data", "mask")).alias("at", "p")).select("key", "at", F.round("p.data", 6).alias("value"), "p.mask")


@query("""WITH t AS (SELECT y * 32 + x AS id, y * 0.9e0 + 0.25e0 AS sy, x * 0.9e0 + 0.4e0 AS sx FROM grid), n AS (SELECT id, CAST(floor(sy) AS INTEGER) + dy AS y, CAST(floor(sx) AS INTEGER) + dx AS x,
  CASE dy WHEN 1 THEN sy - floor(sy) ELSE 1 - (sy - floor(sy)) END * CASE dx WHEN 1 THEN sx - floor(sx) ELSE 1 - (sx - floor(sx)) END AS w FROM t, (VALUES (0), (1)) a(dy), (VALUES (0), (1)) b(dx))
SELECT id, round(CASE WHEN count(g.value) = 4 THEN sum(w * g.value) END, 6) AS value FROM n LEFT JOIN grid g USING (y, x) GROUP BY id""")
def resample(r):
    """J17."""
    g = r("grid").withColumn("k", F.lit(0))
    targets = r("grid").select(F.lit(0).alias("k"), (F.col("y") * 32 + F.col("x")).alias("id"), (F.col("y") * 0.9 + 0.25).alias("sy"), (F.col("x") * 0.9 + 0.4).alias("sx"))
    return kernels.resample(g, targets, ["k"]).select("id", r6("value", "value"))


_TAPS6 = ", ".join(f"({i - 6}, {w!r}e0)" for i, w in enumerate(rows.kernel(2.0, 6).tolist()))


@query(f"""WITH t AS (SELECT * FROM (VALUES {_TAPS6}) t(d, w)), s AS (SELECT g.y + a.d AS y, g.x + b.d AS x, sum(value * a.w * b.w) AS smooth FROM grid g, t a, t b GROUP BY 1, 2)
SELECT g.y, g.x, round(coalesce(smooth, 0), 6) AS smooth FROM grid g LEFT JOIN s ON s.y = g.y AND s.x = g.x""")
def gaussian_tiles(r):
    """The full-radius way, on tiles with halo, at a small radius; each tile's inner pixels."""
    size, halo = 16, 6
    out = rows.convolve_tiles(rows.tiles(r("grid"), size, halo, []), 2.0, halo)
    place = out.select(F.split("key", "/").alias("k"), F.posexplode("data").alias("at", "value")).where(~F.isnan("value"))
    y, x = F.floor(F.col("at") / (size + 2 * halo)) - halo, F.col("at") % (size + 2 * halo) - halo
    inner = place.where((y >= 0) & (y < size) & (x >= 0) & (x < size))
    return inner.select((y + F.col("k")[0].cast("int") * size).cast("int").alias("y"), (x + F.col("k")[1].cast("int") * size).cast("int").alias("x"), r6("value", "smooth"))


@query("SELECT cell_id, frame_index, n FROM (SELECT detector AS cell_id, CAST(row_number() OVER (PARTITION BY detector ORDER BY date_obs, frame_id) - 1 AS INTEGER) AS frame_index, CAST(frame_id AS BIGINT) AS n FROM frames)")
def frame_order(r):
    """D17 W09."""
    f = analysis.running_index(r("frames"), "detector", ["date_obs", "frame_id"])
    return f.select(F.col("detector").alias("cell_id"), "frame_index", F.col("frame_id").alias("n"))


@query("""SELECT projection, y AS row, count(*) = 5 AS complete, array_to_string(list_sort(list(name)), ',') AS names FROM cells GROUP BY 1, 2""")
def gathered_rows(r):
    """T03 T04 at rest."""
    from ..streaming.gather import gathered_batch

    c = r("cells")
    expected = c.groupBy("projection", F.col("y").alias("row")).agg(F.concat_ws(",", F.transform(F.sequence(F.lit(5), F.lit(9)), lambda x: F.format_string("skycell.%d.0%d%d", "projection", F.first("y"), x))).alias("expected"))
    arrivals = c.select("projection", F.col("y").alias("row"), "name").join(expected, ["projection", "row"])
    return gathered_batch(arrivals).drop("missing")


@query(f"""SELECT cell_id, count(*) AS n, round(sum(value), 4) AS value FROM (SELECT cell_id, y, x, sum({_W} * (1 + 2 * sinh(value / {_A}))) AS value FROM pixels WHERE NOT isnan(value) GROUP BY 1, 2, 3) GROUP BY 1""")
def pipeline_combined(r):
    """The driver's first result."""
    from .pipeline import run

    out = run(r("pixels"), r("assignment"), r("shifts"))["combined"]
    return out.groupBy("cell_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


from . import row_steps, stores, survey_queries  # noqa: E402, F401  its queries use this module's
