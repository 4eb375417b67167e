"""The row step on whole rasters: what is exchanged, and the full radius."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import row_step, rows


def _cells(spark, places):
    return spark.createDataFrame([(i, p, r, k) for i, (p, r, k) in enumerate(places)], "cell_id int, projection int, row int, k int")


def _rasters(spark, g, n, seed=0, holes=0.02):
    r = np.random.default_rng(seed)
    data = r.normal(10, 3, (n, g.height, g.width))
    data[r.random(data.shape) < holes] = np.nan
    return data, spark.createDataFrame([(i, g.height, g.width, d.ravel().tolist()) for i, d in enumerate(data)], "cell_id int, h int, w int, data array<double>")


def test_only_strips_are_exchanged(spark):
    g = row_step.Geometry(32, 32, 8, 2, 8)
    places = [(0, r, k) for r in range(3) for k in range(3)]
    data, rasters = _rasters(spark, g, 9)
    table = row_step.store_rasters(rasters, _cells(spark, places), 4)
    pieces = row_step.pieces_of(table, g)
    out = row_step.row_step(table, g, sigma=2.0, radius=6)
    assert out.count() == 9
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    spans = [x.strip() for x in plan.splitlines() if "Exchange" in x]
    assert len(spans) == 1 and "cell_id" in spans[0]  # the strips', on their way to the cells that take them
    sizes = {(r.cell_id, r.kind): r.n for r in pieces.groupBy("cell_id", "kind").agg(F.sum(F.size("data")).alias("n")).collect()}
    assert sizes[4, 0] == 32 * (14 + 10)
    assert sum(sizes.values()) < 3 * 9 * 32 * 32


def test_equal_to_the_pixel_operators(spark):
    g = row_step.Geometry(32, 40, 8, 2, 8)
    places = [(0, 0, 0), (0, 0, 1), (0, 0, 2), (0, 1, 0), (0, 3, 0), (0, 3, 1), (1, 0, 0)]
    cells = _cells(spark, places)
    data, rasters = _rasters(spark, g, len(places))
    pixels = rasters.select("cell_id", F.posexplode("data").alias("at", "value")).select("cell_id", F.floor(F.col("at") / g.width).cast("int").alias("y"), (F.col("at") % g.width).alias("x"), "value")
    placed = rows.assemble(cells.join(pixels, "cell_id"), g.height, g.width, g.overlap, g.edge, g.pad)
    full = rows.cross_row(placed, rows.row_pairs(cells.select("projection", F.col("row").alias("y"))), g.height, g.overlap, g.edge, g.pad)
    row_arrays = {}
    for r in full.collect():
        row_arrays.setdefault((r.projection, r.row), {})[r.my, r.mx] = r.value
    got = {r.cell_id: np.array(r.data).reshape(r.h, r.w) for r in row_step.around(row_step.store_rasters(rasters, cells, 3), row_step.pieces_of(row_step.store_rasters(rasters, cells, 3), g), g).collect()}
    for i, (p, row, k) in enumerate(places):
        own = row_arrays[p, row]
        want = np.array([[own.get((y, x + k * g.step), np.nan) for x in range(g.window[1])] for y in range(g.window[0])])
        assert np.array_equal(got[i], want, equal_nan=True), i


def test_the_full_radius(spark):
    g = row_step.Geometry(700, 1500)
    data, rasters = _rasters(spark, g, 2, holes=0.001)
    out = {r.cell_id: np.array(r.data).reshape(r.h, r.w) for r in row_step.row_step(row_step.store_rasters(rasters, _cells(spark, [(0, 0, 0), (0, 0, 1)]), 2), g).collect()}
    row = np.full((700, 2520), np.nan)
    row[:, :1500] = data[0]
    row[:, 1020 + 470 :] = data[1][:, 470:]
    k = rows.kernel()
    dense = np.nan_to_num(row)
    for y, x in ((0, 0), (350, 900), (699, 1499), (100, 1490), (600, 2519)):
        ys, xs = np.arange(max(0, y - 470), min(700, y + 471)), np.arange(max(0, x - 470), min(2520, x + 471))
        want = k[ys - y + 470] @ dense[np.ix_(ys, xs)] @ k[xs - x + 470]
        for cell, left in ((0, 0), (1, 1020)):
            if left <= x < left + 1500:
                got = out[cell][y, x - left]
                assert np.isnan(row[y, x]) == np.isnan(got) and (np.isnan(got) or abs(got - want) < 1e-9)


def test_resampling_follows_the_headers():
    head = dict(crval1=30.0, crval2=-20.0, crpix1=16.0, crpix2=16.0, cd1_1=-1e-3, cd1_2=0.0, cd2_1=0.0, cd2_2=1e-3)
    y, x = np.mgrid[0:32, 0:32].astype(float)
    assert np.allclose(row_step._pixels(head, *row_step._sky(head, x, y)), (x, y), atol=1e-7)
    data = 2 * x + 3 * y
    moved = head | {"crpix1": 16.25, "crpix2": 15.5}
    got = row_step.resampled(data, head, moved, 32, 32)
    inside = ~np.isnan(got)
    assert inside.sum() > 900 and np.allclose(got[inside], (data - 2 * 0.25 + 3 * 0.5)[inside], atol=1e-6)
    behind = row_step._pixels(head, np.radians(np.array([210.0])), np.radians(np.array([20.0])))
    assert np.isnan(behind).all() and np.isnan(row_step.bilinear(data, *behind)).all()


def test_cells_must_be_wide(spark):
    with pytest.raises(ValueError, match="wide"):
        row_step.Geometry(32, 20, 8, 2, 8).check()


def test_what_cells_need_is_joined_by_keys(spark):
    """The same rows as the SQL text's either-or, without a nested loop over all pairs of cells."""
    from skyloom.plans import registry, row_steps  # noqa: F401  the registry first, which imports the others

    image = spark.range(95).selectExpr("cast(id * 3 as int) AS cell_id", "0 AS y", "0 AS x", "1e0 AS value")
    heads = spark.sql(f"WITH {row_steps._CELLS} SELECT * FROM heads", image=image)
    want = spark.sql(f"WITH {row_steps._CELLS} SELECT * FROM needs", image=image)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        needs = row_steps._needs(heads)
        plan = needs._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, needs.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert got and got == sorted(map(tuple, want.collect()))
