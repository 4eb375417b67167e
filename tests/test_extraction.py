"""Sources over the borders of chunks, beside a search of the whole raster."""

import numpy as np
from pyspark.sql import functions as F

from skyloom.operators import extraction
from skyloom.operators.extraction import Rules


def whole(data, error, rules):
    """Labels by flooding the whole raster, pixel by pixel."""
    h, w = data.shape
    if np.isnan(error).all():
        return np.full((h, w), extraction.BRIGHT)
    level = rules.bright * np.nanmedian(error)
    over = np.zeros((h, w), bool)
    for y in range(h):
        for x in range(w):
            a = b = 0.0
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    i, j, k = y + dy, x + dx, (2 - abs(dy)) * (2 - abs(dx))
                    if 0 <= i < h and 0 <= j < w and np.isfinite(data[i, j]) and data[i, j] <= level and error[i, j] > 0 and np.isfinite(error[i, j]):
                        a, b = a + k * data[i, j] / error[i, j] ** 2, b + (k / error[i, j]) ** 2
            over[y, x] = np.isfinite(data[y, x]) and data[y, x] <= level and a > rules.sigma * np.sqrt(b)
    out = np.where(data > level, extraction.BRIGHT, 0).astype(np.int64)
    seen = np.zeros((h, w), bool)
    for y, x in np.argwhere(over).tolist():
        if seen[y, x]:
            continue
        seen[y, x], members, todo = True, [], [(y, x)]
        while todo:
            i, j = todo.pop()
            members.append((i, j))
            for p in range(max(0, i - 1), min(h, i + 2)):
                for q in range(max(0, j - 1), min(w, j + 2)):
                    if over[p, q] and not seen[p, q]:
                        seen[p, q] = True
                        todo.append((p, q))
        if len(members) >= rules.min_area:
            for i, j in members:
                out[i, j] = (y << 32) + x + 1
    return out


def stored(spark, rasters, size):
    rows = []
    for key, (data, error) in rasters.items():
        for cy in range(-(-data.shape[0] // size)):
            for cx in range(-(-data.shape[1] // size)):
                part = np.s_[cy * size : (cy + 1) * size, cx * size : (cx + 1) * size]
                rows.append((key, cy, cx, *data[part].shape, data[part].ravel().tolist(), error[part].ravel().tolist()))
    return extraction.store_chunks(spark.createDataFrame(rows, "key string, cy int, cx int, h int, w int, data array<double>, error array<double>"), 3)


def together(df, shapes, size):
    out = {k: (np.full(s, np.nan), np.full(s, -9, np.int64)) for k, s in shapes.items()}
    for r in df.collect():
        for a, v in zip(out[r.key], (r.data, r.label)):
            a[r.cy * size : r.cy * size + r.h, r.cx * size : r.cx * size + r.w] = np.array(v).reshape(r.h, r.w)
    return out


def test_equal_to_a_search_of_the_whole_raster(spark):
    rules = Rules(size=7, sigma=2.5, bright=20.0, min_area=5)
    r = np.random.default_rng(4)
    rasters = {}
    for key, shape in (("ragged", (30, 25)), ("one chunk", (6, 7)), ("a line", (1, 40))):
        rasters[key] = r.normal(0, 1.4, shape), r.uniform(0.5, 1.5, shape)
    data, error = r.normal(0, 0.3, (35, 35)), np.ones((35, 35))
    data[r.random(data.shape) < 0.02] = np.nan
    data[2, 2:33] = data[2:30, 32] = data[29, 5:33] = data[6:30, 5] = data[6, 5:28] = 8.0  # one spiral through most chunks
    data[14, 20:24] = 3.0  # on a border
    data[20, 13] = 100.0
    error[17] = 0.0
    error[3, 3:8] = np.nan
    rasters["spiral"] = data, error
    rasters["no error"] = data.copy(), np.full(data.shape, np.nan)
    got = together(extraction.extract(stored(spark, rasters, rules.size), rules, 3), {k: d.shape for k, (d, _) in rasters.items()}, rules.size)
    for key, (data, error) in rasters.items():
        want = whole(data, error, rules)
        assert np.array_equal(got[key][1], want), key
        assert np.array_equal(got[key][0], np.where(want == 0, 0.0, data), equal_nan=True), key
    spiral = got["spiral"][1]
    assert len(np.unique(spiral[[2, 2, 29], [4, 30, 20]])) == 1 and spiral[20, 13] == extraction.BRIGHT


def test_chunks_of_pixels(spark):
    pixels = spark.createDataFrame([("a", 0, 0, 1.0, 2.0), ("a", 5, 9, 3.0, 4.0), ("b", 1, 1, None, 1.0)], "key string, y int, x int, value double, error double")
    got = {(r.key, r.cy, r.cx): (r.data, r.error) for r in extraction.chunks(pixels, 4).collect()}
    assert set(got) == {("a", 0, 0), ("a", 1, 2), ("b", 0, 0)}
    assert got["a", 1, 2][0][5] == 3.0 and got["a", 1, 2][1][5] == 4.0 and np.isnan(got["b", 0, 0][0][5]) and np.isnan(got["a", 0, 0][0][1])


def test_medians_are_exact(spark):
    r = np.random.default_rng(0)
    values = {"odd": r.normal(0, 1e6, 45), "even": r.normal(-3, 1e-9, 50), "equal": np.full(30, -0.0), "few": np.array([np.nan] * 28 + [2.0, -7.5]), "none": np.full(9, np.nan), "wide": np.array([1e300, -1e300, 0.0, np.inf, -np.inf])}
    table = stored(spark, {k: (np.zeros((1, len(v))), v[None]) for k, v in values.items()}, 16)
    got = {x.key: x["median"] for x in extraction.medians(table).collect()}
    assert got.pop("none") is None
    assert got == {k: np.nanmedian(v) for k, v in values.items() if k != "none"}


def test_classes_of_hubs_and_long_paths(spark):
    edges = [("hub", 0, i) for i in range(1, 200)] + [("path", i, i + 1) for i in range(60)] + [("path", 100, 101), ("hub", 7, 7)]
    got = {(r.key, r.id): r.root for r in extraction.classes(spark.createDataFrame(edges, "key string, a long, b long")).collect()}
    assert got == {("hub", i): 0 for i in range(1, 200)} | {("path", i): 0 for i in range(1, 61)} | {("path", 101): 100}


def test_no_chunks(spark):
    empty = spark.createDataFrame([], "key string, cy int, cx int, h int, w int, data array<double>, error array<double>")
    assert extraction.extract(extraction.store_chunks(empty, 2), Rules(size=4), 2).count() == 0


def test_only_rims_are_exchanged(spark):
    rasters = {"a": (np.zeros((48, 48)), np.ones((48, 48)))}
    table = stored(spark, rasters, 16)
    strips = extraction.strips_of(table, 16)
    assert strips.agg(F.sum(F.size("data"))).first()[0] == 9 * (4 * 2 * 16 + 4 * 4)
    plan = strips._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
