"""Bands to one image: weighted sums, errors, masks; and pairing images with their masks, weights and headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BAND_WEIGHTS, BANDS
from ..functions import photometry


def weight_of(band):
    """A band's weight; band is its place in r, i, z, y."""
    out = F.lit(None).cast("double")
    for i, name in reversed(list(enumerate(BANDS))):
        out = F.when(band == i, F.lit(BAND_WEIGHTS[name])).otherwise(out)
    return out


def combine_bands(pixels: DataFrame, converted: bool = True, boffset=None, bsoften=None, exptime=None) -> DataFrame:
    """cell_id, y, x, value, error, mask, n_bands. Missing bands lower the flux, they are not made up for; NaN counts as missing."""
    p = pixels.where(~F.isnan("value"))
    one = F.lit(1.0)
    bo, bs, ex = (one if c is None else c for c in (boffset, bsoften, exptime))
    flux = photometry.flux(F.col("value"), bo, bs, ex) if converted else F.col("value")
    error = photometry.flux_error(F.col("weight"), bo, bs, ex) if converted else F.col("weight")
    w = weight_of(F.col("band"))
    return p.groupBy("cell_id", "y", "x").agg(F.sum(w * flux).alias("value"), F.sqrt(F.sum((w * error) * (w * error))).alias("error"), F.bit_or("mask").alias("mask"), F.count("*").alias("n_bands"))


def combine_masks(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("cell_id", "y", "x").agg(F.coalesce(F.bit_or("mask"), F.lit(0)).alias("mask"))


def join_kinds(image: DataFrame, mask: DataFrame, weight: DataFrame) -> DataFrame:
    """Image, mask and weight by position; whatever is missing stays null."""
    keys = ["cell_id", "band", "y", "x"]
    return image.join(mask, keys, "full_outer").join(weight, keys, "full_outer")


def cell_arrays(rows: DataFrame) -> DataFrame:
    """(cell_id, band, kind, size) as one row a cell and band, a column a kind."""
    return rows.groupBy("cell_id", "band").pivot("kind", ["image", "mask", "weight"]).agg(F.max("size"))
