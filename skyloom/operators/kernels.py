"""Numerical kernels on whole rasters, one raster a row: star replacement, resampling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..constants import SAT_BIT, STAR_HALF_SIZE, ZERO_POINT
from ..shipping import ship
from .rows import as_lists, lists

RASTER = "key string, h int, w int, data array<double>"


def star_model(data: np.ndarray, stars: list[tuple[float, float, float]], half: int) -> np.ndarray | None:
    """Median of the normalised stamps of stars that aren't saturated."""
    h, w = data.shape
    stamps = []
    for x, y, _ in stars:
        cx, cy = round(x), round(y)
        if half <= cx < w - half and half <= cy < h - half:
            s = data[cy - half : cy + half + 1, cx - half : cx + half + 1]
            s = s - np.nanmedian(s)
            if np.isfinite(s).all() and s.sum() > 0:
                stamps.append(s / s.sum())
    return np.clip(np.median(stamps, axis=0), 0, None) if stamps else None


def replace_stars(data: np.ndarray, mask: np.ndarray, stars: list[tuple[float, float, float]], half: int = STAR_HALF_SIZE, faint: tuple = (13.5, 17.0), limit: float = 14.0, threshold: float = 15.0, legacy_mask: bool = False):
    """Data and mask with bright stars' cores from a fitted model plus background; the saturation bit marks what was replaced.

    legacy_mask: only the mask's lowest bit keeps a pixel out of the fit, else any bit."""
    model = star_model(data, [s for s in stars if faint[0] < s[2] < faint[1]], half)
    if model is None or not model.max():
        return data, mask
    out, bits, shape = data.copy(), mask & ~(1 << SAT_BIT), model / model.sum()
    least = 10 ** ((threshold - ZERO_POINT) / -2.5) * shape.max()
    for x, y, mag in stars:
        cx, cy = round(x), round(y)
        if mag > limit or not (half <= cx < data.shape[1] - half and half <= cy < data.shape[0] - half):
            continue
        at = np.s_[cy - half : cy + half + 1, cx - half : cx + half + 1]
        own, m = data[at], mask[at]
        good = np.isfinite(own) & ((m & 1 == 0) if legacy_mask else (m == 0))
        if good.sum() < 3:
            continue
        a = np.stack([shape[good], np.ones(good.sum())], axis=1)
        flux, background = np.linalg.lstsq(a, own[good], rcond=None)[0]
        core = flux * shape > least
        out[at] = np.where(core, flux * shape + background, out[at])
        bits[at] = np.where(core, bits[at] | 1 << SAT_BIT, bits[at])
    return out, bits


def replace_saturated(rasters: DataFrame, **options) -> DataFrame:
    """rasters: key, h, w, data, mask, stars (array of x, y, mag)."""

    def step(batches):
        for b in batches:
            datas, masks = [], []
            for h, w, data, mask, stars in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), lists(b.column(3)), lists(b.column(4)), b.column(5).to_pylist()):
                d, m = replace_stars(data.astype(np.float64).reshape(h, w), mask.astype(np.int64).reshape(h, w), [(s["x"], s["y"], s["mag"]) for s in stars or []], **options)
                datas.append(d)
                masks.append(m)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), as_lists(datas, pa.float64()), as_lists(masks, pa.int32())], names=["key", "h", "w", "data", "mask"])

    ship(rasters.sparkSession)
    return rasters.select("key", "h", "w", "data", "mask", "stars").mapInArrow(step, RASTER + ", mask array<int>")


def resample(grid: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Bilinear values at targets (keys, id, sy, sx) from a grid (keys, y, x, value); null unless all four neighbours are there and no NaN."""
    from pyspark.sql import functions as F

    y0, x0 = F.floor("sy").cast("int"), F.floor("sx").cast("int")
    fy, fx = F.col("sy") - y0, F.col("sx") - x0
    taps = F.array(*(F.struct((y0 + dy).alias("y"), (x0 + dx).alias("x"), ((fy if dy else 1 - fy) * (fx if dx else 1 - fx)).alias("w")) for dy in (0, 1) for dx in (0, 1)))
    rows = targets.select(*keys, "id", F.explode(taps).alias("t")).select(*keys, "id", F.col("t.y").alias("y"), F.col("t.x").alias("x"), F.col("t.w").alias("w"))
    rows = rows.join(grid.select(*keys, "y", "x", "value").where(~F.isnan("value")), [*keys, "y", "x"], "left")
    return rows.groupBy(*keys, "id").agg(F.when(F.count("value") == 4, F.sum(F.col("w") * F.col("value"))).alias("value"))
