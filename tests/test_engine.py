"""Invariants and fixed edge cases of the template engine."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import bits, names, wcs
from skyloom.operators import downsample, kernels, mapping, padding, rows
from skyloom.sources import fits, store
from skyloom.streaming import gather

SCHEMA = "cell_id int, y int, x int, value double, mask int"


@pytest.fixture()
def image(spark):
    data = [(1, y, x, float("nan") if (y, x) == (0, 0) else y * 4.0 + x, 4096 if x == 1 else 0) for y in range(4) for x in range(4)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture()
def assignment(spark):
    return spark.createDataFrame([(1, y, x, y // 2 * 2 + x // 2) for y in range(4) for x in range(4)], "cell_id int, y int, x int, pix int")


def shift(spark, sx, sy):
    return spark.createDataFrame([(0, 1, sx, sy)], "offset_id int, cell_id int, sx int, sy int")


def template(spark, assignment, image, sx=0, sy=0, **o):
    return {r.pix: (r.flux_sum, r["count"], r.mask_count) for r in downsample.template(assignment, image, shift(spark, sx, sy), height=4, width=4, **o).collect()}


def test_contract_of_sums(spark, assignment, image):
    assert template(spark, assignment, image) == {0: (4.0, 4, 2), 1: (2 + 3 + 6 + 7.0, 4, 0), 2: (8.0 + 12, 4, 2), 3: (10 + 11 + 14 + 15.0, 4, 0)}
    assert np.isnan(template(spark, assignment, image, nan_poisons=True)[0][0])


def test_cyclic_shifts(spark, assignment, image):
    whole = template(spark, assignment, image)
    assert template(spark, assignment, image, 4, -8) == whole
    assert template(spark, assignment, image, 2, 0) == {0: whole[1], 1: whole[0], 2: whole[3], 3: whole[2]}


def test_region_is_the_crop(spark, assignment, image):
    whole = template(spark, assignment, image)
    assert template(spark, assignment, image, roi=(1, 2, 0, 2, 2)) == {k: v for k, v in whole.items() if k % 2 == 1}
    with pytest.raises(ValueError):
        downsample.check_roi(2, 2, 0, 1, 4)


def test_all_nan_group_sums_to_zero(spark, assignment, image):
    nan = image.withColumn("value", F.lit(float("nan")))
    assert {v[0] for v in template(spark, assignment, nan).values()} == {0.0}


def test_runs_of_a_fully_mapped_cell(spark, assignment, image):
    assert downsample.run_sums(assignment, image).count() == 4
    assert downsample.run_sums(assignment, image, drop_first_run=True).count() == 3


def test_half_even(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, -0.5, 1.5, 2.5)], "v double")
    assert [r[0] for r in df.select(wcs.half_even("v")).collect()] == [0, 0, 2, 2]


def test_masks(spark):
    df = spark.createDataFrame([(v,) for v in (8575, 32768, 0, 128)], "m int").select(bits.decode("m").alias("d"), bits.encode(bits.decode("m")).alias("e"))
    assert [r.d for r in df.collect()] == [["MASK.VALUE"], ["MARK.VALUE"], [], ["SUSPECT", "BURNTOOL"]]
    assert [r.e for r in df.collect()] == [8575, 32768, 0, 128]


def test_point_on_an_edge(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (0.0, 1.0), (2.0, 1.0), (1.0, 1.0)], "x double, y double")
    got = [r[0] for r in df.select(wcs.in_polygon("x", "y", square)).collect()]
    assert got == [False, True, False, True, True]  # lower edge open, upper edge closed, left edge open, right edge closed


def test_tangent_point(spark):
    ra, dec = wcs.tan_to_sky(F.lit(0.0), F.lit(0.0), F.lit(31.0), F.lit(-19.0))
    assert tuple(spark.range(1).select(ra, dec).first()) == (31.0, -19.0)


def test_spatial_join_across_zero(spark):
    v = lambda a, d: {"ra": a, "dec": d}
    cells = spark.createDataFrame([(1, [v(359.8, -0.2), v(359.8, 0.2), v(360.2, 0.2), v(360.2, -0.2)])], "cell_id int, ring array<struct<ra:double,dec:double>>")
    points = spark.createDataFrame([(1, 0.1, 0.0), (2, 359.9, 0.1), (3, 0.3, 0.0)], "id int, ra double, dec double")
    assert sorted(r.id for r in mapping.points_in_cells(points, cells).collect()) == [1, 2]


def test_spatial_join_meets_the_opposite_of_a_cell(spark):
    """The exact test holds for the opposite of a cell as well, and each pair is met once, also of rings whose box is the whole circle."""
    v = lambda a, d: {"ra": a, "dec": d}
    rings = [(1, [v(a, -20.5), v(a, -19.5), v(a + 1.0, -19.5), v(a + 1.0, -20.5)]) for a in [30.0]] + [(2, [v(210.0, 19.5), v(210.0, 20.5), v(211.0, 20.5), v(211.0, 19.5)]), (3, [v(359.5, -0.5), v(359.5, 0.5), v(0.5, 0.5), v(0.5, -0.5)])]
    cells = spark.createDataFrame(rings, "cell_id int, ring array<struct<ra:double,dec:double>>")
    points = spark.createDataFrame([(1, 30.5, -20.0), (2, 210.5, 20.0), (3, 30.5, 20.0), (4, 0.1, 0.1), (5, 180.1, -0.1)], "id int, ra double, dec double")
    assert sorted((r.id, r.cell_id) for r in mapping.points_in_cells(points, cells).collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (4, 3), (5, 3)]


def test_places_and_rings_that_stand_often(spark):
    """Every pair of many points at one place and many cells of one ring, once, without a test a pair, in several lists."""
    ring = "array(named_struct('ra', a, 'dec', 0e0), named_struct('ra', a, 'dec', 1e0), named_struct('ra', a + 1e0, 'dec', 1e0), named_struct('ra', a + 1e0, 'dec', 0e0))"
    cells = spark.range(1500).selectExpr("cast(id as int) AS cell_id", "id % 3 * 5e0 AS a").selectExpr("cell_id", f"{ring} AS ring")
    points = spark.range(40).selectExpr("id", "id % 4 * 5e0 + 0.5e0 AS ra", "0.5e0 AS dec").union(spark.sql("SELECT 99L, CAST(NULL AS DOUBLE), 0.5e0"))
    df = mapping.same_places(points, cells)
    got = [tuple(r) for r in df.collect()]
    assert sorted(got) == sorted((i, c) for i in range(40) for c in range(1500) if i % 4 == c % 3)
    assert sorted(got) == sorted(map(tuple, mapping.points_in_cells(points, cells).collect()))


def test_sorted_tables_have_few_files(spark, tmp_path):
    """Files of a table by cell don't grow with its cells; a cell lies in one of them."""
    df = spark.range(6000).selectExpr("cast(id % 300 as int) AS cell_id", "cast(id as int) AS y", "0 AS x")
    store.write_sorted(df, str(tmp_path / "t"), ["cell_id", "y", "x"])
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 4
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.select("cell_id", F.input_file_name().alias("file")).distinct().groupBy("cell_id").count().where("count <> 1").count() == 0
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_nearest_centre_keeps_no_hits(spark):
    """The least cell of equal distances, by aggregates of plain numbers: hits are not sorted for them."""
    hits = spark.createDataFrame([(0, 5), (0, 3), (0, 4), (1, 3), (1, 9)], "pix long, cell_id int")
    points = spark.createDataFrame([(0, 0.0, 0.0), (1, 5.0, 0.0)], "pix long, px double, py double")
    centres = spark.createDataFrame([(3, 3.0, 4.0), (4, -3.0, 4.0), (5, 9.0, 9.0), (9, 5.0, 1.0)], "cell_id int, cx double, cy double")
    df = mapping.nearest_centre(hits, points, centres)
    assert sorted(map(tuple, df.collect())) == [(0, 3, 5.0), (1, 9, 1.0)]
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_row_positions_of_single_cells_and_rows(spark):
    df = spark.createDataFrame([("a", 1, 0, 3), ("b", 1, 2, 0), ("c", 1, 2, 1), ("d", 2, 5, 5)], "name string, projection int, y int, x int")
    got = {r.name: (r.cell_position, r.row_position) for r in padding.row_positions(df).collect()}
    assert got == {"a": ("first", "bottom"), "b": ("first", "top"), "c": ("last", "top"), "d": ("first", "bottom")}
    assert {(r.y, r.next_y) for r in rows.row_pairs(df.where("projection = 1")).collect()} == {(0, 2), (2, None)}


def test_clip_area():
    square = [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert padding.clip_area(square, [(1, 1), (1, 3), (3, 3), (3, 1)]) == 1
    assert padding.clip_area(square, [(5, 5), (6, 5), (6, 6), (5, 6)]) == 0


def test_best_padding(spark):
    v = lambda a, b, c, d: [{"ra": a, "dec": b}, {"ra": a, "dec": d}, {"ra": c, "dec": d}, {"ra": c, "dec": b}]
    quad = "array<struct<ra:double,dec:double>>"
    regions = spark.createDataFrame([("t", "top", v(0.0, 0.0, 0.1, 0.1)), ("u", "top", v(1.0, 0.0, 1.1, 0.1)), ("v", "top", v(2.0, 0.0, 2.1, 0.1))], f"name string, side string, region {quad}")
    cells = spark.createDataFrame([("full", v(-0.1, -0.1, 0.2, 0.2)), ("left", v(0.9, -0.1, 1.06, 0.2)), ("right", v(1.05, -0.1, 1.2, 0.2)), ("part", v(2.05, 0.0, 2.2, 0.1))], f"name string, quad {quad}")
    got = {r.name: (r.status, r.pad_cell) for r in padding.best_padding(padding.candidates(regions, cells)).collect()}
    assert got == {"t": ("full_coverage", "full"), "u": ("combined_coverage", "left/right"), "v": ("partial_coverage", "part")}


def test_pairs_of_candidates_are_clipped_no_further_than_needed(monkeypatch):
    """The choice of a search through all pairs, with one polygon at a time, from a few of them."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    box = lambda a, d, w, h: [(a + x, d + y) for x, y in ((0.0, 0.0), (0.0, h), (w, h), (w, 0.0))]
    records, want = [], []
    for n in range(6):
        region = box(10.0 + n, 50.0, 0.1, 0.1)
        quads = [box(10.0 + n + float(a), 49.9, float(w), 0.3) for a, w in zip(rng.uniform(-0.1, 0.08, 60), rng.uniform(0.05, 0.14, 60))]
        if n == 5:
            quads = [q for q in quads if q[2][0] < 15.09]  # nothing covers the right side
        whole, area = padding.clip_area(region, region), [padding.clip_area(region, q) for q in quads]
        own = [(f"c{i:02d}", float(rng.random()), 100 * a / whole, q, a) for i, (q, a) in enumerate(zip(quads, area)) if 0 < 100 * a / whole < padding.FULL_COVERAGE]
        both = [
            ((a[1] + b[1]) / 2, a[0], b[0]) for i, a in enumerate(own) for b in own[i + 1 :]
            if 100 * (a[4] + b[4] - abs(padding._area(padding._intersection(padding._intersection(region, a[3]), b[3])))) / whole >= padding.FULL_COVERAGE
        ]
        points = lambda q: [{"ra": x, "dec": y} for x, y in q]
        records.append({"name": f"r{n}", "side": "top", "region": points(region), "found": [{"cell": c, "distance": d, "coverage": v, "quad": points(q)} for c, d, v, q, _ in own]})
        least = min((-v, d, c) for c, d, v, _, _ in own)
        want.append(("combined_coverage", "/".join(min(both)[1:]), -least[0]) if both else ("partial_coverage", least[2], -least[0]))
    assert {w[0] for w in want} == {"combined_coverage", "partial_coverage"}
    clipped, real = [], padding._intersections
    monkeypatch.setattr(padding, "_intersections", lambda *a: clipped.append(len(a[2])) or real(*a))
    got = [r for b in padding._best(iter(pa.Table.from_pylist(records).to_batches())) for r in b.to_pylist()]
    assert [(r["status"], r["pad_cell"], r["coverage"]) for r in got] == want
    n = [len(r["found"]) for r in records]
    assert sum(clipped) < sum(k * (k - 1) // 2 for k in n) / 4


def test_convolution_of_tiles_is_the_stencil(spark):
    r = np.random.default_rng(0)
    a = r.random((12, 12))
    grid = spark.createDataFrame([(y, x, float(a[y, x])) for y in range(12) for x in range(12)], "y int, x int, value double")
    down, across = rows.separable_taps(rows.kernel(1.2, 3))
    first = rows.stencil(grid, down).select("y", "x", F.col("smooth").alias("value"))
    want = {(q.y, q.x): q.smooth for q in rows.stencil(first, across).collect()}
    tile = spark.createDataFrame([("t", 12, 12, a.ravel().tolist())], "key string, h int, w int, data array<double>")
    got = np.array(rows.convolve_tiles(tile, 1.2, 3).first().data).reshape(12, 12)
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_star_replacement_marks_what_it_changes():
    y, x = np.mgrid[0:60, 0:60]
    star = lambda cy, cx, f: f * np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / 4)
    data = 1 + star(12, 12, 10) + star(12, 40, 12) + star(40, 30, 50000)
    broken = data.copy()
    broken[39:42, 29:32] = 9000
    mask = np.where((y >= 39) & (y < 42) & (x >= 29) & (x < 32), 32, 0)
    out, m = kernels.replace_stars(broken, mask, [(12, 12, 15.0), (40, 12, 15.5), (30, 40, 12.0)], half=6)
    assert abs(out[40, 30] / data[40, 30] - 1) < 0.1
    assert ((out != broken) <= ((m & 32) > 0)).all() and (m & 32).any()
    assert kernels.replace_stars(broken, mask, [(30, 40, 12.0)], half=6)[1] is mask


def test_fits_round_trip(spark, tmp_path):
    a = np.arange(12, dtype=np.float32).reshape(3, 4)
    b = np.array([[0, 65535]], np.uint16)
    fits.write_image(str(tmp_path / "f.fits"), [({"SECTOR": 20, "NOTE": "it's"}, None), ({"CRVAL1": 1.5, "CRVAL2": 2.0}, a), ({}, b)])
    fits.write_image(str(tmp_path / "g.fits.gz"), [({}, a.astype(np.int32))])
    fits.register(spark)
    got = {(r.path.rsplit("/", 1)[1], r.hdu): r for r in spark.read.format("fits").load(str(tmp_path)).collect()}
    assert got["f.fits", 0].header["NOTE"] == "it's" and got["f.fits", 1].data == a.ravel().tolist()
    assert got["f.fits", 2].data == [0.0, 65535.0] and (got["g.fits.gz", 0].h, got["g.fits.gz", 0].w) == (3, 4)
    found = spark.read.format("fits").option("hdu", "image").load(str(tmp_path / "f.fits")).collect()
    assert [(r.hdu, r.height, r.width) for r in found] == [(1, 3, 4)]


def test_fits_export(spark, tmp_path):
    fits.register(spark)
    df = spark.createDataFrame([("a", {"SECTOR": "20"}, 1, 2, [1.5, 2.5], [3, 4])], "key string, header map<string,string>, h int, w int, data array<double>, count array<int>")
    df.write.format("fits").mode("append").save(str(tmp_path / "out"))
    got = {r.hdu: r for r in spark.read.format("fits").load(str(tmp_path / "out")).collect()}
    assert got[0].header["SECTOR"] == "20" and got[1].data == [1.5, 2.5] and got[2].data == [3.0, 4.0]


def test_rasters_at_once(spark):
    """The same rasters as a key at a time, over more rows than are filled together; facts come in rows of their own."""
    n = 700
    pixels = spark.range(n * 5).selectExpr(f"cast(id % {n} as int) AS k", "cast(id % 5 as int) AS y", "cast(id % 64 as int) AS x", "if(id % 11 = 0, null, id * 0.5D) AS v", "id AS m")
    fill = {"v": float("nan"), "m": -1.0}
    own = pixels.unionByName(spark.range(n).selectExpr("cast(id as int) AS k", "concat('n', id) AS name"), allowMissingColumns=True)
    key = lambda r: (r.k, r.h, r.w, np.array(r.v).tobytes(), np.array(r.m).tobytes())
    got = rows.rasters_at_once(own, ["k"], ["name"], 5, 64, fill, 3).collect()
    assert sorted(map(key, got)) == sorted(map(key, rows.rasters(pixels, ["k"], 5, 64, fill).collect())) and all(r.name == f"n{r.k}" for r in got)
    with pytest.raises(Exception, match="outside"):
        rows.rasters_at_once(pixels.withColumn("name", F.lit("")), ["k"], ["name"], 4, 64, fill, 3).collect()


def test_stitching_and_smoothing(spark):
    from skyloom.plans.pipeline import stitch_and_convolve

    cells = spark.createDataFrame([(i, f"c{i}", 1, i // 2, i % 2) for i in range(4)], "cell_id int, name string, projection int, row int, k int")
    image = spark.createDataFrame([(c, y, x, 1.0) for c in range(4) for y in range(12) for x in range(12)], "cell_id int, y int, x int, value double")
    got = {(r.name, r.y, r.x): r.value for r in stitch_and_convolve(image, cells, 12, 4, 1, 4, 1.0, 2, tile=8).collect()}
    assert len(got) == 4 * 144
    assert abs(got["c0", 6, 6] - 1) < 1e-9 and abs(got["c0", 11, 6] - 1) < 1e-9  # the rim is filled from the row above
    assert got["c0", 0, 6] < 0.9  # nothing below the first row


def test_store(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    df = spark.createDataFrame([(1, "skycell.1.055", "r", 0, 0, 1.0), (1, "skycell.1.056", "r", 0, 0, 2.0)], "projection int, cell string, band string, y int, x int, value double")
    store.write_arrays(df, path)
    store.write_arrays(df.where("cell = 'skycell.1.056'").withColumn("value", F.lit(5.0)), path)
    assert [r.value for r in store.read_cell(spark, path, "1.055").collect()] == [1.0]
    assert [r.value for r in store.read_cell(spark, path, "skycell.1.056").collect()] == [5.0]
    assert store.fetch_once(df.select("band"), f"file://{tmp_path}/c") and not store.fetch_once(df.select("band"), f"file://{tmp_path}/c")
    store.write_csv(df.groupBy("band").agg(F.collect_list("y").alias("ys")), f"file://{tmp_path}/d")
    assert spark.read.csv(f"file://{tmp_path}/d", header=True).first().ys == "[0,0]"
    assert {r.cell for r in store.list_files(spark, path, "*.parquet").collect()} == {"skycell.1.055", "skycell.1.056"}


def test_files_of_a_store_grow_with_rows_not_with_cells(spark, tmp_path):
    from skyloom.plans import registry
    from skyloom.sources import work

    for name in ("array_store", "convolved_store"):
        registry.queries()[name](spark, "/root/testdata/sf0.01")
    stores = work.folder(spark, "any").rsplit("/", 1)[0].removeprefix("file://")
    for name in ("arrays-*", "convolved-*"):
        path = max(Path(stores).glob(name), key=lambda p: p.stat().st_mtime)
        assert 0 < len(list(path.rglob("*.parquet"))) <= 8  # of 100 cells

    path = f"file://{tmp_path}/s"
    df = spark.range(300).selectExpr("1 AS projection", "'skycell.1.' || lpad(id DIV 3, 3, '0') AS cell", "0 AS y", "CAST(id % 3 AS INT) AS x", "CAST(id AS DOUBLE) AS value")
    store.write_cells(df, path)
    store.write_cells(df.where("cell = 'skycell.1.056' AND x = 1").withColumn("value", F.lit(-5.0)), path)
    store.write_cells(df.where("cell = 'skycell.1.057'").withColumn("value", F.lit(-6.0)), path)
    want = {(r.cell, r.x): r.value for r in df.collect() if r.cell not in ("skycell.1.056", "skycell.1.057")} | {("skycell.1.056", 1): -5.0} | {("skycell.1.057", x): -6.0 for x in range(3)}
    got = store.read_cells(spark, path)
    assert got.columns[:5] == df.columns and got.count() == len(want)
    assert {(r.cell, r.x): r.value for r in got.collect()} == want
    assert [r.value for r in store.read_cells(spark, path, "1.056").collect()] == [-5.0]
    with pytest.raises(Exception, match="lost"):
        store.write_cells(df.withColumn("value", F.raise_error(F.lit("lost")).cast("double")), path)
    assert {(r.cell, r.x): r.value for r in store.read_cells(spark, path).collect()} == want


def test_star_contract(spark):
    from skyloom.operators.catalog import checked

    with pytest.raises(ValueError, match="dec"):
        checked(spark.createDataFrame([(1.0, 2.0)], "ra double, phot_rp_mean_mag double"))


def test_gathering_a_stream(spark, tmp_path):
    rows_ = [(1, 5, "a", "a,b"), (1, 6, "c", "c,d"), (1, 5, "b", "a,b")]
    for i, r in enumerate(rows_):
        spark.createDataFrame([r], "projection int, row int, name string, expected string").write.mode("append").parquet(f"{tmp_path}/in")
    stream = gather.read_arrivals(spark, f"{tmp_path}/in", "projection int, row int, name string, expected string", 1)
    q = gather.gather_rows(stream, 10_000).writeStream.format("memory").queryName("gathered").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {(r.row, r.complete) for r in spark.sql("SELECT * FROM gathered").collect()}
    assert (5, True) in got


def test_names(spark):
    df = spark.createDataFrame([("skycell.2000.059",), ("short",), ("skycell.x.1",)], "n string")
    got = df.select(names.cell_projection("n"), names.cell_y("n"), names.cell_x("n"), names.first_number_part("n")).collect()
    assert [tuple(r) for r in got] == [(2000, 5, 9, "2000"), (None, None, None, None), (None, None, None, "1")]


def suppliers(spark, path, keys):
    spark.createDataFrame([(k,) for k in keys], "s_suppkey long").write.parquet(f"{path}/supplier.parquet")
    return str(path)


def brute_candidates(regions, quads):
    """Every region against every cell."""
    unit = lambda a, d: np.array([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)])
    middle = lambda q: unit(*np.radians(np.mean([(p["ra"], p["dec"]) for p in q], axis=0)))
    plane = lambda q: [(p["ra"], p["dec"]) for p in q]
    out = {}
    for name, side, region in regions:
        for cell, quad in quads:
            if name != cell and np.degrees(2 * np.arcsin(np.linalg.norm(middle(region) - middle(quad)) / 2)) < padding.SEARCH_RADIUS:
                r = plane(region)
                coverage = 100 * padding.clip_area(r, plane(quad)) / padding.clip_area(r, r)
                if coverage > 0:
                    out[name, side, cell] = round(coverage, 6)
    return out


def test_candidates_against_brute_force(spark):
    rng = np.random.default_rng(2)
    quad = "array<struct<ra:double,dec:double>>"
    box = lambda a, d, w, h: [{"ra": a + x, "dec": d + y} for x, y in ((0.0, 0.0), (0.0, h), (w, h), (w, 0.0))]
    regions, quads = [], []
    for a0, d0, wide in ((10.0, 0.0, 1.0), (359.5, -20.0, 1.0), (-0.5, 20.0, 1.0), (100.0, 60.0, 2.0), (200.0, 88.9, 60.0), (300.0, -89.6, 90.0), (190.0, 0.2, 1.0)):
        for i in range(25):
            a, d = a0 + wide * rng.random(), d0 + rng.random() * 0.9
            quads.append((f"c{len(quads)}", box(float(a), float(min(d, 89.5)), 0.3 * wide, 0.3)))
            a, d = a0 + wide * rng.random(), d0 + rng.random() * 0.9
            regions.append((f"r{len(regions)}", "top", box(float(a), float(min(d, 89.8)), 0.3 * wide, 0.05)))
    found = padding.candidates(spark.createDataFrame(regions, f"name string, side string, region {quad}"), spark.createDataFrame(quads, f"name string, quad {quad}")).collect()
    want = brute_candidates(regions, quads)
    assert len(found) == len(want) > 500
    assert {(r.name, r.side, r.cell): round(r.coverage, 6) for r in found} == want


def test_padding_search_covers_all_projections(spark, tmp_path):
    from skyloom.plans import registry

    sf = suppliers(spark, tmp_path, [*range(25), *range(250, 275), *range(990, 1000)])
    got = {(r.name, r.side): (r.coverage, r.pad_cell) for r in registry.queries()["padding_search"](spark, sf).collect()}
    cells = registry.relation(spark, sf, "cells")
    quads = [(r.name, r.quad) for r in cells.select("name", wcs.corners(0.0).alias("quad")).collect()]
    regions = [(r.name, p, [q for q in r.all if q["side"] == p]) for r in cells.select("name", wcs.padding_corners().alias("all")).collect() for p in {q["side"] for q in r.all}]
    best = {}
    for (name, side, _), coverage in brute_candidates(regions, quads).items():
        best[name, side] = max(best.get((name, side), 0), coverage)
    assert {k: round(c, 4) for k, (c, _) in got.items()} == {k: round(c, 4) for k, c in best.items()}
    assert {n.split(".")[1] for n, _ in got} == {"2000", "2010", "2039"}


def test_headers_of_every_frame(spark):
    from skyloom.plans import registry

    sf = "/root/testdata/sf0.001"
    got = [r.frame_id for r in registry.queries()["header_build"](spark, sf).collect()]
    assert sorted(got) == sorted(r.event_id for r in registry.relation(spark, sf, "events").select("event_id").collect())


def test_unified_masks_keep_rows_apart(spark):
    masks = spark.createDataFrame([(c, 0, x, 2**c) for c in range(5) for x in range(3)], "cell_id int, y int, x int, mask int")
    at = spark.createDataFrame([(0, 1, 5, 0, 0), (1, 1, 5, 2, 0), (2, 1, 6, 0, 0), (3, 1, 6, 2, 0), (4, 2, 5, 0, 0)], "cell_id int, projection int, row int, x0 int, y0 int")
    got = {(r.cell_id, r.x): r.row_mask for r in rows.unified_mask(masks, at).collect()}
    assert got == {(c, x): 2 ** (c + 1 if c in (0, 2) and x == 2 else c) for c in range(5) for x in range(3)}


def test_every_row_gets_a_unified_mask(spark):
    from skyloom.plans import registry

    sf = "/root/testdata/sf0.01"
    got = {r.cell_id for r in registry.queries()["unified_row_mask"](spark, sf).select("cell_id").distinct().collect()}
    assert got == {r.cell_id for r in registry.relation(spark, sf, "image").join(registry.relation(spark, sf, "cells"), "cell_id").select("cell_id").distinct().collect()}


def brute_mapping(owned):
    """(cell, y, x) to the highest of the cell's frame pixels over it. owned: (pix, cell_id)."""
    from skyloom.plans.registry import FRAME

    def sky(x, y):
        u, v = x + 1 - FRAME["crpix"][0], y + 1 - FRAME["crpix"][1]
        uu = u + sum(c * u**p * v**q for (p, q), c in FRAME["a"].items())
        vv = v + sum(c * u**p * v**q for (p, q), c in FRAME["b"].items())
        xi, eta = np.radians(np.array(FRAME["cd"]) @ [uu, vv])
        a0, d0 = np.radians(FRAME["crval"])
        n = np.array([np.cos(d0) * np.cos(a0), np.cos(d0) * np.sin(a0), np.sin(d0)])
        east, north = np.array([-np.sin(a0), np.cos(a0), 0]), np.array([-np.sin(d0) * np.cos(a0), -np.sin(d0) * np.sin(a0), np.cos(d0)])
        s = n + xi * east + eta * north
        return s / np.linalg.norm(s)

    out = {}
    for pix, cell in owned:
        n = sky(cell * 3 % 50 + 6.5, cell * 7 % 50 + 6.5)
        east = np.array([-n[1], n[0], 0]) / np.hypot(n[0], n[1])
        px, py = pix % 64, pix // 64
        quad = []
        for dx, dy in ((-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5), (0.5, -0.5)):
            s = sky(px + dx, py + dy)
            s = s / (s @ n)
            quad.append((np.degrees(s @ east) / -0.005 + 99.5, np.degrees(s @ np.cross(n, east)) / 0.005 + 99.5))
        (x0, y0), (x1, y1) = np.floor(np.min(quad, axis=0)).astype(int), np.ceil(np.max(quad, axis=0)).astype(int)
        for y in range(max(y0, 0), min(y1, 199) + 1):
            for x in range(max(x0, 0), min(x1, 199) + 1):
                crossings = sum((ay < y) != (by < y) and x <= ax + (y - ay) * (bx - ax) / (by - ay) for (ax, ay), (bx, by) in zip(quad, quad[1:] + quad[:1]))
                if crossings % 2:
                    out[cell, y, x] = max(pix, out.get((cell, y, x), -1))
    return out


def test_cell_mapping_against_brute_force(spark, tmp_path):
    from skyloom.plans import registry

    sf = suppliers(spark, tmp_path, [0, 1, 2, 17])
    spark.range(1).write.parquet(f"{sf}/region.parquet")
    owned = [(r.pix, r.cell_id) for r in registry._near(lambda n: registry.relation(spark, sf, n)).collect()]
    got = {(r.cell_id, r.y, r.x): r.pix for r in registry.queries()["cell_mapping"](spark, sf).collect()}
    assert len({c for c, _, _ in got}) == 4
    assert got == brute_mapping(owned)


def test_cell_mapping_of_all_cells(spark):
    from skyloom.plans import registry

    sf = "/root/testdata/sf0.01"
    owned = {(r.cell_id, r.pix) for r in registry._near(lambda n: registry.relation(spark, sf, n)).collect()}
    mapped = registry.queries()["cell_mapping"](spark, sf).collect()
    assert len({(r.cell_id, r.y, r.x) for r in mapped}) == len(mapped)
    assert {(r.cell_id, r.pix) for r in mapped} == owned and len({c for c, _ in owned}) == 50


def test_partials_cover_all_cells(spark):
    from skyloom.plans import registry

    sf = "/root/testdata/sf0.001"
    got = {r.cell_id for r in registry.queries()["concatenated_partials"](spark, sf).collect()}
    assert got == {r.cell_id for r in registry.relation(spark, sf, "assignment").select("cell_id").distinct().collect()}


def test_a_tile_of_the_full_radius(spark):
    size, halo = 512, rows.PSF_RADIUS
    r = np.random.default_rng(2)
    at = r.choice(900 * 900, 4000, replace=False)
    value = r.random(4000)
    df = spark.createDataFrame([(int(a // 900), int(a % 900), float(v)) for a, v in zip(at, value)], "y int, x int, value double")
    out = {x.key: np.array(x.data).reshape(x.h, x.w) for x in rows.convolve_tiles(rows.tiles(df, size, halo, []).where("key in ('0/0', '1/1')"), rows.PSF_SIGMA, halo).collect()}
    assert {k: v.shape for k, v in out.items()} == {"0/0": (size + 2 * halo,) * 2, "1/1": (size + 2 * halo,) * 2}
    g = rows.kernel()
    for key, tile in out.items():
        ty, tx = map(int, key.split("/"))
        inner = [(a // 900, a % 900) for a in at.tolist() if a // 900 // size == ty and a % 900 // size == tx][:5]
        assert inner
        for y, x in inner:
            dy, dx = at // 900 - y, at % 900 - x
            near = (abs(dy) <= halo) & (abs(dx) <= halo)
            want = (value[near] * g[dy[near] + halo] * g[dx[near] + halo]).sum()
            assert abs(tile[y - ty * size + halo, x - tx * size + halo] - want) < 1e-9


def test_stitching_takes_valid_pixels_only(spark):
    base = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, 2.0)], "k int, y int, x int, value double")
    new = spark.createDataFrame([(0, 1, 0, 1, 5.0, 1.0), (0, 2, 0, 1, 7.0, 1.0), (0, 3, 0, 0, float("nan"), 1.0), (0, 3, 1, 1, 4.0, 1.0), (0, 3, 0, 0, 9.0, 0.0), (0, 3, 5, 0, 9.0, 1.0)], "k int, source int, y int, x int, value double, footprint double")
    got = rows.stitch(base, rows.valid_for_stitching(new, 2, 2), ["k"])
    assert sorted(map(tuple, got.collect())) == [(0, 0, 0, 1.0), (0, 0, 1, 7.0), (0, 1, 1, 4.0)]


def test_row_pairs_go_over_gaps(spark):
    cells = spark.createDataFrame([(1, 5), (1, 6), (1, 8), (1, 8), (2, 7)], "projection int, y int")
    assert sorted(map(tuple, rows.row_pairs(cells).collect()), key=str) == [(1, 5, 6), (1, 6, 8), (1, 8, None), (2, 7, None)]
