"""The step from rasters of cells to smoothed rasters: neighbours' rims, cross-projection padding, convolution.

A cell's raster stays where it is: rasters are a table bucketed by cell, so that both passes over it need no shuffle.
The first pass cuts the rims that other cells' surroundings need and resamples what is padding for cells of other
projections; these strips are all that is exchanged. The second pass puts a cell's surroundings together (its window of
the row's array, `pad` wide on each side), smooths them and cuts the cell out. A task holds one raster and its window.

Every row of a projection and every projection goes at once: rims are the neighbours' as they are before padding and
smoothing. A window is a piece of the row's array, from the places of its cells; of cells that overlap the later one
counts, its first `overlap - edge` columns left out.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CELL_OVERLAP, EDGE_EXCLUSION, PAD_SIZE, PSF_RADIUS, PSF_SIGMA
from ..shipping import ship
from ..sources.work import folder
from .rows import as_lists, kernel, lists, padding_placement, row_pairs

#: Lines that are transformed together.
STRIP = 256


class Geometry(NamedTuple):
    height: int
    width: int
    overlap: int = CELL_OVERLAP
    edge: int = EDGE_EXCLUSION
    pad: int = PAD_SIZE

    @property
    def step(self) -> int:
        return self.width - self.overlap

    @property
    def keep(self) -> int:
        return self.overlap - self.edge

    @property
    def shift(self) -> int:
        """From a row's array to that of the row before."""
        return self.height - self.overlap

    @property
    def window(self) -> tuple[int, int]:
        return self.height + 2 * self.pad, self.width + 2 * self.pad

    def check(self) -> None:
        if min(self.width - 2 * self.overlap + self.edge, self.step - self.keep) < self.pad or self.keep < 0:
            raise ValueError("cells must be so wide that a window meets its next neighbours only")


def layout(cells: DataFrame) -> DataFrame:
    """cells: cell_id, projection, row, k (the place in the row). Adds whether it is its row's last, whether rows are before and after its own, and who takes its rims: dr rows on (-1, 0, 1), dk places on."""
    own = cells.select("cell_id", "projection", "row", "k")
    pairs = row_pairs(own.select("projection", F.col("row").alias("y"))).select("projection", F.col("y").alias("row"), F.col("next_y").alias("after"))
    before = pairs.where("after is not null").select("projection", F.col("after").alias("row"), F.col("row").alias("before"))
    rows = own.withColumn("last", F.col("k") == F.max("k").over(Window.partitionBy("projection", "row"))).join(pairs, ["projection", "row"]).join(before, ["projection", "row"], "left")
    steps = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dk).alias("dk"), F.col(r).alias("row")) for dr, r in ((-1, "before"), (0, "row"), (1, "after")) for dk in (-1, 0, 1) if dr or dk))
    near = rows.select(F.col("cell_id").alias("of"), "projection", "k", F.explode(steps).alias("s")).select("of", "projection", F.col("s.row").alias("row"), (F.col("k") + F.col("s.dk")).alias("k"), "s.dr", "s.dk")
    takes = near.join(own, ["projection", "row", "k"]).groupBy(F.col("of").alias("cell_id")).agg(F.collect_list(F.struct("dr", "dk", F.col("cell_id").alias("id"))).alias("takers"))  # eight at most
    flags = rows.select("cell_id", "projection", "row", "k", "last", F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after"))
    return flags.join(takes, "cell_id", "left")


def store_rasters(rasters: DataFrame, cells: DataFrame, buckets: int = 200) -> DataFrame:
    """rasters (cell_id, h, w, data) with their layout as a table bucketed by cell, in the shared folder; a cell without a raster has no place."""
    spark = rasters.sparkSession
    name = f"rasters_{uuid.uuid4().hex}"
    placed = layout(cells.join(rasters.select("cell_id"), "cell_id", "left_semi"))
    rows = rasters.select("cell_id", "h", "w", F.col("data").cast("array<double>").alias("data")).join(placed, "cell_id")
    rows.repartition(buckets, "cell_id").write.bucketBy(buckets, "cell_id").sortBy("cell_id").option("path", folder(spark, name)).format("parquet").saveAsTable(name)
    return spark.table(name)


# ---- coordinates ----


def _sky(h: dict, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Radians of pixels from 0, by a tangent-plane header."""
    u, v = x + 1 - h["crpix1"], y + 1 - h["crpix2"]
    xi, eta = np.radians(h["cd1_1"] * u + h["cd1_2"] * v), np.radians(h["cd2_1"] * u + h["cd2_2"] * v)
    a0, d0 = np.radians(h["crval1"]), np.radians(h["crval2"])
    down = np.cos(d0) - eta * np.sin(d0)
    return a0 + np.arctan2(xi, down), np.arctan2(np.sin(d0) + eta * np.cos(d0), np.hypot(xi, down))


def _pixels(h: dict, ra: np.ndarray, dec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pixels from 0 of points on the sky; NaN behind it."""
    a, d0 = ra - np.radians(h["crval1"]), np.radians(h["crval2"])
    front = np.sin(d0) * np.sin(dec) + np.cos(d0) * np.cos(dec) * np.cos(a)
    with np.errstate(invalid="ignore", divide="ignore"):
        front = np.where(front > 0, front, np.nan)
        xi, eta = np.degrees(np.cos(dec) * np.sin(a) / front), np.degrees((np.cos(d0) * np.sin(dec) - np.sin(d0) * np.cos(dec) * np.cos(a)) / front)
    det = h["cd1_1"] * h["cd2_2"] - h["cd1_2"] * h["cd2_1"]
    return (h["cd2_2"] * xi - h["cd1_2"] * eta) / det + h["crpix1"] - 1, (h["cd1_1"] * eta - h["cd2_1"] * xi) / det + h["crpix2"] - 1


def bilinear(data: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values at points; NaN unless all four neighbours are there and are numbers."""
    h, w = data.shape
    x0, y0 = np.floor(x), np.floor(y)
    inside = (x0 >= 0) & (y0 >= 0) & (x0 + 1 < w) & (y0 + 1 < h)
    i, j = np.where(inside, y0, 0).astype(np.int64), np.where(inside, x0, 0).astype(np.int64)
    fx, fy = x - x0, y - y0
    # one at a time, so that no more than a strip's worth of memory is needed
    out = data[i, j] * (1 - fx) * (1 - fy)
    if w > 1 and h > 1:
        for dy, dx, weight in ((0, 1, fx * (1 - fy)), (1, 0, (1 - fx) * fy), (1, 1, fx * fy)):
            out += data[np.minimum(i + dy, h - 1), np.minimum(j + dx, w - 1)] * weight
    return np.where(inside, out, np.nan)


def resampled(data: np.ndarray, source: dict, target: dict, height: int, width: int) -> np.ndarray:
    """A source's raster on a target's pixels, a strip of lines at a time."""
    out = np.empty((height, width))
    for a in range(0, height, STRIP):
        y, x = np.mgrid[a : min(a + STRIP, height), 0:width].astype(np.float64)
        out[a : a + STRIP] = bilinear(data, *_pixels(source, *_sky(target, x, y)))
    return out


# ---- cross-projection padding ----

_HEADER = ("crval1", "crval2", "crpix1", "crpix2", "cd1_1", "cd1_2", "cd2_1", "cd2_2")
_HEAD_TYPE = "struct<" + ",".join(f"{x}:double" for x in _HEADER) + ">"


def _cd(i: int, j: int):
    return (F.col(f"cdelt{i}") * F.col(f"pc{i}_{j}")).cast("double").alias(f"cd{i}_{j}")


def padding_jobs(cells: DataFrame, needs: DataFrame, g: Geometry) -> DataFrame:
    """What each source cell is to be resampled for. cells: headers, projection, row, k; needs: cell_id, side, source (a cell of any projection). Regions that leave their row's array are left out, as a whole.

    Returns source and jobs, an array with the region's place in the row's array, both headers and the cells whose windows it meets."""
    cd = [_cd(i, j) for i in (1, 2) for j in (1, 2)]
    places = padding_placement(cells, g.pad, g.edge, g.overlap)
    sizes = cells.groupBy("projection").agg((2 * g.pad + F.max("k") * g.step + g.width).alias("master"))
    own = needs.join(places, ["cell_id", "side"]).join(cells.select("cell_id", "projection", "row", *cd), "cell_id").join(sizes, "projection")
    own = own.withColumn("y0", (F.col("cy") - F.col("height") / 2).cast("int")).withColumn("x0", (F.col("cx") - F.col("width") / 2).cast("int"))
    own = own.where((F.col("y0") >= 0) & (F.col("x0") >= 0) & (F.col("y0") + F.col("height") <= g.window[0]) & (F.col("x0") + F.col("width") <= F.col("master")))
    head = F.struct(F.col("ra").alias("crval1"), F.col("dec").alias("crval2"), (F.col("width") / 2).alias("crpix1"), (F.col("height") / 2).alias("crpix2"), "cd1_1", "cd1_2", "cd2_1", "cd2_2").cast(_HEAD_TYPE)
    own = own.select("cell_id", "side", "source", "projection", "row", "y0", "x0", F.col("height").cast("int").alias("h"), F.col("width").cast("int").alias("w"), head.alias("target"))
    met = F.sequence(F.greatest(F.lit(0), F.floor((F.col("x0") - g.window[1]) / g.step).cast("int") + 1), F.floor((F.col("x0") + F.col("w") - 1) / g.step).cast("int"))
    met = own.withColumn("k", F.explode(met)).join(cells.select("projection", "row", "k", F.col("cell_id").alias("taker")), ["projection", "row", "k"])
    one = met.groupBy("source", "cell_id", "side", "y0", "x0", "h", "w", "target").agg(F.collect_list(F.struct(F.col("taker").alias("id"), "k")).alias("takers"))  # the few cells of a row whose windows meet the region
    heads = cells.select(F.col("cell_id").alias("source"), F.struct("crval1", "crval2", "crpix1", "crpix2", *cd).cast(_HEAD_TYPE).alias("head"))
    return one.join(heads, "source").groupBy("source").agg(F.first("head").alias("head"), F.collect_list(F.struct("side", "y0", "x0", "h", "w", "target", "takers")).alias("jobs"))  # a cell's neighbours


# ---- the two passes ----

PIECES = "cell_id int, kind int, source int, side string, y0 int, x0 int, h int, w int, data array<double>"


def _piece(to: int, kind: int, source: int, side: str, y0: int, x0: int, data: np.ndarray) -> tuple:
    return to, kind, source, side, y0, x0, *data.shape, np.ascontiguousarray(data)


def rims(raster: np.ndarray, cell: dict, g: Geometry):
    """What the cells around this one need of it: pieces in the coordinates of their windows."""
    lo, hi = 0 if cell["k"] == 0 else g.keep, g.width if cell["last"] else g.width - g.edge
    for t in cell["takers"] or []:
        dr, dk = t["dr"], t["dk"]
        x0, x1 = max(lo, dk * g.step - g.pad), min(hi, dk * g.step + g.width + g.pad)
        down = {0: 0, -1: g.shift, 1: -g.shift}[dr]  # from this row's array to the taker's
        y0, y1 = {0: (0, g.height), -1: (g.height + g.pad - g.edge, g.window[0]), 1: (0, g.pad + g.edge)}[dr]
        y0, y1 = (max(0, y0 - down - g.pad), min(g.height, y1 - down - g.pad)) if dr else (y0, y1)
        if x0 < x1 and y0 < y1:
            yield _piece(t["id"], dr, cell["cell_id"], "", y0 + g.pad + down, x0 + g.pad - dk * g.step, raster[y0:y1, x0:x1])


def paddings(raster: np.ndarray, source: int, head: dict, jobs: list[dict], g: Geometry):
    """What other cells' windows take of this one, resampled; its own rim left out."""
    own = raster.copy()
    if g.edge:
        own[: g.edge] = own[-g.edge :] = own[:, : g.edge] = own[:, -g.edge :] = np.nan
    for job in jobs:
        region = resampled(own, head, job["target"], job["h"], job["w"])
        if np.isnan(region).all():
            continue
        for t in job["takers"]:
            left = job["x0"] - t["k"] * g.step
            a, b = max(0, -left), min(job["w"], g.window[1] - left)
            if a < b:
                yield _piece(t["id"], 2, source, job["side"], job["y0"], left + a, region[:, a:b])


def window_of(raster: np.ndarray, cell: dict, pieces: list[tuple], g: Geometry) -> np.ndarray:
    """A cell's surroundings in its row's array: the row, the rims of the rows beside it, then padding, of which the highest source counts."""
    out = np.full(g.window, np.nan)
    lo, hi = 0 if cell["k"] == 0 else g.keep, g.width if cell["last"] else g.width - g.edge
    out[g.pad : g.pad + g.height, g.pad + lo : g.pad + hi] = raster[:, lo:hi]
    put = lambda p: out.__setitem__((slice(p[4], p[4] + p[6]), slice(p[5], p[5] + p[7])), p[8].reshape(p[6], p[7]))
    for p in pieces:
        if p[1] == 0:
            put(p)
    if cell["has_after"]:
        out[g.height + g.pad - g.edge :] = np.nan
    if cell["has_before"]:
        out[: g.pad + g.edge] = np.nan
    for p in pieces:
        if p[1] in (-1, 1):
            put(p)
    for p in sorted((p for p in pieces if p[1] == 2), key=lambda p: (p[2], p[3])):
        place = out[p[4] : p[4] + p[6], p[5] : p[5] + p[7]]
        new = p[8].reshape(p[6], p[7])
        place[...] = np.where(np.isnan(new), place, new)
    return out


def smoothed(window: np.ndarray, weights: np.ndarray, g: Geometry) -> np.ndarray:
    """The cell's part of its window, convolved along both axes with NaN as 0 and put back after; a strip of lines at a time."""
    radius = len(weights) // 2
    if radius > g.pad:
        raise ValueError("the kernel is wider than what is around a cell")
    hole = np.isnan(window[g.pad : g.pad + g.height, g.pad : g.pad + g.width])
    a = np.nan_to_num(window, nan=0.0, posinf=np.inf, neginf=-np.inf)

    def lines(rows: np.ndarray, n: int) -> np.ndarray:
        """Each row filtered; the n places from pad on."""
        size = rows.shape[1] + len(weights) - 1
        full = np.fft.irfft(np.fft.rfft(rows, size, axis=1) * np.fft.rfft(weights, size), size, axis=1)
        return full[:, g.pad + radius : g.pad + radius + n]

    across = np.empty((a.shape[0], g.width))
    for i in range(0, a.shape[0], STRIP):
        across[i : i + STRIP] = lines(a[i : i + STRIP], g.width)
    out = np.empty((g.height, g.width))
    for j in range(0, g.width, STRIP):
        out[:, j : j + STRIP] = lines(np.ascontiguousarray(across[:, j : j + STRIP].T), g.height).T
    out[hole] = np.nan
    return out


def _table(pieces) -> pa.Table:
    cols = list(zip(*pieces)) or [[]] * 9
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
    return pa.table({n: v for n, v in zip(("cell_id", "kind", "source", "side", "y0", "x0", "h", "w", "data"), [*(pa.array(c, k) for c, k in zip(cols, kinds)), as_lists(list(cols[8]), pa.float64())])})


def _cell(rows: pa.Table) -> tuple[np.ndarray, dict]:
    c = {n: rows[n][0].as_py() for n in rows.column_names if n != "data"}
    return lists(rows["data"].combine_chunks())[0].astype(np.float64).reshape(c["h"], c["w"]), c


def pieces_of(rasters: DataFrame, g: Geometry, jobs: DataFrame | None = None) -> DataFrame:
    """The strips that cells' windows need of other cells: PIECES. rasters: of store_rasters(); jobs: of padding_jobs()."""
    g.check()
    ship(rasters.sparkSession)

    def cut(rows: pa.Table) -> pa.Table:
        return _table([p for i in range(len(rows)) for p in rims(*_cell(rows.slice(i, 1)), g)])

    if jobs is None:
        return rasters.groupBy("cell_id").applyInArrow(cut, PIECES)

    def cut_both(rows: pa.Table, work: pa.Table) -> pa.Table:
        if not len(rows):
            return _table([])
        raster, cell = _cell(rows)
        found = list(rims(raster, cell, g))
        if len(work):
            found += paddings(raster, cell["cell_id"], work["head"][0].as_py(), work["jobs"][0].as_py(), g)
        return _table(found)

    return rasters.groupBy("cell_id").cogroup(jobs.groupBy("source")).applyInArrow(cut_both, PIECES)


def around(rasters: DataFrame, pieces: DataFrame, g: Geometry, finish=None) -> DataFrame:
    """cell_id, h, w, data: each cell's window, or what finish makes of it."""
    ship(rasters.sparkSession)

    def join(rows: pa.Table, strips: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({"cell_id": pa.array([], pa.int32()), "h": pa.array([], pa.int32()), "w": pa.array([], pa.int32()), "data": pa.array([], pa.list_(pa.float64()))})
        raster, cell = _cell(rows)
        if raster.shape != (g.height, g.width):
            raise ValueError(f"cell {cell['cell_id']} has a raster of {raster.shape}")
        meta = list(zip(*(strips[n].to_pylist() for n in ("cell_id", "kind", "source", "side", "y0", "x0", "h", "w")))) if len(strips) else []
        own = [(*m, d) for m, d in zip(meta, lists(strips["data"].combine_chunks()))] if meta else []
        out = window_of(raster, cell, own, g)
        out = out if finish is None else finish(out)
        return pa.table({"cell_id": rows["cell_id"].combine_chunks().cast(pa.int32()), "h": pa.array([out.shape[0]], pa.int32()), "w": pa.array([out.shape[1]], pa.int32()), "data": as_lists([out], pa.float64())})

    return rasters.groupBy("cell_id").cogroup(pieces.groupBy("cell_id")).applyInArrow(join, "cell_id int, h int, w int, data array<double>")


def row_step(rasters: DataFrame, g: Geometry, jobs: DataFrame | None = None, sigma: float = PSF_SIGMA, radius: int = PSF_RADIUS) -> DataFrame:
    """Each cell's raster after its row's step: neighbours' rims, padding, convolution with NaN restored, and the cell cut out again."""
    weights = kernel(sigma, radius)
    return around(rasters, pieces_of(rasters, g, jobs), g, lambda window: smoothed(window, weights, g))
