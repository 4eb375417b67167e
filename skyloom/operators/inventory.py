"""Inventory of the array store and its upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EXPECTED_ARRAYS


def array_health(pixels: DataFrame, keys: list[str], corner: int = 10) -> DataFrame:
    """Notes on each array's first corner: all NaN, all zero."""
    own = pixels.where((F.col("y") < corner) & (F.col("x") < corner)).groupBy(*keys).agg(F.bool_and(F.isnan("value")).alias("all_nan"), F.bool_and(F.col("value") == 0).alias("all_zero"))
    return own.withColumn("note", F.when(F.col("all_nan"), "All NaN values").when(F.col("all_zero"), "All zero values"))


def is_temp(name="array_name"):
    return F.col(name).contains("_temp_")


def cell_summary(arrays: DataFrame) -> DataFrame:
    """Per cell: arrays present, missing, extra, temporary and unreadable, bytes, complete, corrupted."""
    expected = F.array(*(F.lit(a) for a in sorted(EXPECTED_ARRAYS)))
    names = F.array_sort(F.collect_set("array_name"))
    own = arrays.groupBy("cell_id").agg(
        names.alias("names"), F.array_sort(F.collect_set(F.when(is_temp(), F.col("array_name")))).alias("temp"),
        F.array_sort(F.collect_set(F.when(~F.col("readable") & ~is_temp(), F.col("array_name")))).alias("bad"), F.sum("size_bytes").alias("total_bytes"), F.count("*").alias("n_arrays"),
    )
    own = own.withColumn("missing", F.array_except(expected, "names")).withColumn("extra", F.array_except("names", F.array_union(expected, "temp")))
    return own.select(
        "cell_id", "n_arrays", F.size("missing").alias("n_missing"), F.size("extra").alias("n_extra"), F.size("temp").alias("n_temp"), F.size("bad").alias("n_corrupted"), "total_bytes",
        (F.size("missing") == 0).alias("complete"), ((F.size("bad") > 0) | (F.size("temp") > 0)).alias("corrupted"), F.concat_ws(",", "missing").alias("missing_text"), F.concat_ws("; ", "bad").alias("corruption_text"),
    )


def totals(cells: DataFrame) -> DataFrame:
    """Counts over all cells; incomplete is what is neither complete nor corrupted, which can go below zero."""
    return cells.agg(
        F.count("*").alias("total"), F.count_if("complete").alias("complete"), F.count_if("corrupted").alias("corrupted"),
        (F.count("*") - F.count_if("complete") - F.count_if("corrupted")).alias("incomplete"), F.round(100.0 * F.count_if("complete") / F.count("*"), 6).alias("percent_complete"),
        F.round(F.sum("total_bytes") / 1048576.0, 6).alias("megabytes"),
    )


def missing_arrays(cells: DataFrame, arrays: DataFrame) -> DataFrame:
    expected = cells.select("cell_id", F.explode(F.array(*(F.lit(a) for a in EXPECTED_ARRAYS))).alias("array_name"))
    return expected.join(arrays.select("cell_id", "array_name"), ["cell_id", "array_name"], "left_anti")


def to_fetch(cells: DataFrame, arrays: DataFrame, overwrite: bool = False) -> DataFrame:
    """What an ingest that is run again still has to fetch: all, or what isn't there and readable."""
    return missing_arrays(cells, arrays.limit(0) if overwrite else arrays.where("readable"))


def temp_arrays(arrays: DataFrame) -> DataFrame:
    return arrays.where(is_temp())


def corrupted_arrays(arrays: DataFrame) -> DataFrame:
    return arrays.where(~F.col("readable") & ~is_temp())


def incomplete_cells(cells: DataFrame) -> DataFrame:
    return cells.where(~F.col("complete") & ~F.col("corrupted"))


def cleanup_preview(arrays: DataFrame, cells: DataFrame) -> DataFrame:
    """What a clean-up would remove. The preview counts unreadable temporary arrays as corrupted too."""
    a = arrays.agg(F.count_if(is_temp()).alias("temp"), F.count_if(~F.col("readable") | is_temp()).alias("corrupted"), F.coalesce(F.round(F.sum(F.when(is_temp(), F.col("size_bytes"))) / 1048576.0, 6), F.lit(0.0)).alias("temp_mb"))
    return a.crossJoin(incomplete_cells(cells).agg(F.count("*").alias("incomplete")))  # one row each


def store_listing(cells: DataFrame) -> DataFrame:
    return cells.groupBy("projection").agg(F.array_sort(F.collect_set("name")).alias("names"))
