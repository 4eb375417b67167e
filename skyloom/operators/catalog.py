"""Star catalogues: the contract, regions and magnitude bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EPSF_BRIGHT, EPSF_FAINT, REPLACE_LIMIT, STAR_HALF_SIZE, STAR_LIMIT
from ..functions.wcs import in_polygon

REQUIRED = ("ra", "dec", "phot_rp_mean_mag")


def checked(stars: DataFrame) -> DataFrame:
    missing = [c for c in REQUIRED if c not in stars.columns]
    if missing:
        raise ValueError(f"the star catalogue lacks {', '.join(missing)}")
    return stars


def in_region(stars: DataFrame, corners: list[tuple[float, float]], limit: float = STAR_LIMIT) -> DataFrame:
    """Stars brighter than the limit inside a polygon; its box comes first, so that the scan can skip."""
    ra, dec = [c[0] for c in corners], [c[1] for c in corners]
    box = F.col("ra").between(min(ra), max(ra)) & F.col("dec").between(min(dec), max(dec)) & (F.col("phot_rp_mean_mag") < limit)
    return stars.where(box).where(in_polygon("ra", "dec", corners))


def on_pixels(stars: DataFrame, to_pixel, ra0: float, ra1: float, dec0: float, dec1: float, x0: float, x1: float, y0: float, y1: float) -> DataFrame:
    """Two steps: the box on the sky, closed; then pixels, half-open. to_pixel: (ra, dec) columns to (x, y) columns."""
    near = stars.where(F.col("ra").between(ra0, ra1) & F.col("dec").between(dec0, dec1))
    x, y = to_pixel(F.col("ra"), F.col("dec"))
    rows = near.select("source_id", x.alias("x"), y.alias("y"), F.col("phot_rp_mean_mag").alias("mag"))
    return rows.where((F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1))


def magnitude_bands(mag="phot_rp_mean_mag"):
    """(serves the point-spread model, is replaced); the bands overlap."""
    m = F.col(mag)
    return (m > EPSF_BRIGHT) & (m < EPSF_FAINT), m <= REPLACE_LIMIT


def away_from_edge(stars: DataFrame, width: int, height: int, half: int = STAR_HALF_SIZE) -> DataFrame:
    return stars.where((F.col("x") >= half) & (F.col("x") < width - half) & (F.col("y") >= half) & (F.col("y") < height - half))
