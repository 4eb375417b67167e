"""Statistics of images and of frame headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nan_stats(pixels: DataFrame, keys: list[str], percentile: float = 0.9) -> DataFrame:
    v = F.when(~F.isnan("value"), F.col("value"))
    return pixels.groupBy(*keys).agg(F.median(v).alias("median"), F.percentile(v, F.lit(percentile)).alias("percentile"), F.stddev_pop(v).alias("std"), F.count(v).alias("n"))


def noise_level(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Deviation of the negative values and their mirror images, whose mean is zero."""
    return pixels.where((F.col("value") < 0) & ~F.isnan("value")).groupBy(*keys).agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("noise"))


def detrended(frames: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Columns minus their mean. The means are aggregated and joined, so a large group is not sorted in one task."""
    means = frames.groupBy(*keys).agg(*(F.avg(c).alias(f"mean_{c}") for c in columns))
    return frames.join(means, keys).select(*frames.columns, *((F.col(c) - F.col(f"mean_{c}")).alias(f"{c}_detrended") for c in columns))


def modified_julian_date(timestamp):
    return F.unix_micros(timestamp.cast("timestamp")) / 8.64e10 + 40587.0


def first_by_projection(cells: DataFrame, order: str, columns: list[str]) -> DataFrame:
    return cells.groupBy("projection").agg(F.min_by(F.struct(*columns), order).alias("m")).select("projection", *(F.col(f"m.{c}").alias(c) for c in columns))


def mask_ratio_area(ratios: DataFrame, height: int, width: int, rows: int = 30, columns: int = 44, least: float = 1e-7) -> DataFrame:
    """Which pixels count as masked: a smoothed ratio above the least, the top rows and both side margins."""
    forced = (F.col("y") >= height - rows) | (F.col("x") < columns) | (F.col("x") >= width - columns)
    return ratios.withColumn("masked", (F.col("ratio") > least) | forced)


def running_index(frames: DataFrame, key: str, order: list[str]) -> DataFrame:
    return frames.withColumn("frame_index", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def template_header(header, keys: list[str], prefixes: list[str], defaults: dict[str, str]):
    """A header for the result: listed keys and prefixes of the frame's, after defaults."""
    h = F.col(header) if isinstance(header, str) else header
    own = F.map_filter(h, lambda k, v: k.isin(*keys) | F.reduce(F.array(*(F.startswith(k, F.lit(p)) for p in prefixes)), F.lit(False), lambda a, b: a | b))
    given = F.create_map(*(F.lit(x) for pair in sorted(defaults.items()) for x in pair))
    return F.map_concat(F.map_filter(given, lambda k, v: ~F.map_contains_key(own, k)), own)


def scaled_wcs(header, oversampling: int, x_min: int = 0, y_min: int = 0):
    """CD divided by the oversampling; reference pixels moved to the region and, unlike the legacy form, scaled with it."""
    n = oversampling

    def value(k, v):
        number = v.try_cast("double")
        return F.when(k.rlike("^CD[12]_[12]$"), (number / n).cast("string")).when(k == "CRPIX1", ((number - 0.5) * n + 0.5 - x_min * n).cast("string")).when(k == "CRPIX2", ((number - 0.5) * n + 0.5 - y_min * n).cast("string")).otherwise(v)

    return F.transform_values(F.col(header) if isinstance(header, str) else header, value)
