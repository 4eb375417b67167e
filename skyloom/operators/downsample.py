"""Re-binning cell pixels onto the frame's grid, for any set of offsets.

Cell rasters are joined by position after a cyclic whole-pixel shift. The assignment is aggregated straight into
(offset, pixel) sums, partially in each task, so what is shuffled is one row a task, offset and frame pixel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BATCH_SIZE, IGNORE_BITS
from ..functions.bits import ignored
from ..functions.wcs import half_even

H = W = 32


def whole_shifts(shifts: DataFrame) -> DataFrame:
    """Fractional shifts rounded half to even."""
    return shifts.withColumn("sx", half_even("sx")).withColumn("sy", half_even("sy"))


def rolled(assignment: DataFrame, shifts: DataFrame, image: DataFrame, height: int = H, width: int = W) -> DataFrame:
    """Assignment rows with the shifted image's value and mask. Shifts are one row a cell and offset: few, and small against the pixels; Spark chooses how to join them by their size."""
    shifted = assignment.where("pix >= 0").join(shifts, "cell_id").withColumn("y", F.pmod(F.col("y") - F.col("sy"), F.lit(height))).withColumn("x", F.pmod(F.col("x") - F.col("sx"), F.lit(width)))
    return shifted.join(image, ["cell_id", "y", "x"])


def _sums(rows: DataFrame, keys: list[str], bits, nan_poisons: bool) -> DataFrame:
    clean = ~ignored("mask", bits) & (F.lit(True) if nan_poisons else ~F.isnan("value"))
    return rows.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(clean, F.col("value"))), F.lit(0.0)).alias("flux_sum"), F.count("*").alias("count"), F.count_if(F.col("mask") != 0).alias("mask_count")
    )


def template(assignment, image, shifts, bits=IGNORE_BITS, nan_poisons: bool = False, roi=None, height: int = H, width: int = W) -> DataFrame:
    """offset_id, pix, flux_sum, count, mask_count. count has every pixel, flux_sum the clean ones, mask_count any set bit.

    roi: (x_min, x_max, y_min, y_max, frame width), half-open, applied to the assignment before any join."""
    if roi is not None:
        x0, x1, y0, y1, w = check_roi(*roi)
        fx, fy = F.col("pix") % w, F.floor(F.col("pix") / w)
        assignment = assignment.where((F.col("pix") >= 0) & (fx >= x0) & (fx < x1) & (fy >= y0) & (fy < y1))
    return _sums(rolled(assignment, shifts, image, height, width), ["offset_id", "pix"], bits, nan_poisons)


def check_roi(x_min: int, x_max: int, y_min: int, y_max: int, width: int, oversampling: int = 1):
    if not (0 <= x_min < x_max <= width and 0 <= y_min < y_max):
        raise ValueError("a region needs 0 <= min < max within the frame")
    if (x_max - x_min) % oversampling or (y_max - y_min) % oversampling:
        raise ValueError("a region's sides are multiples of the oversampling")
    return x_min, x_max, y_min, y_max, width


MOST_OFFSETS = 10_000


def for_each_offset(offsets: DataFrame):
    """A generator column with a struct for each offset. Offsets are a run's parameters; too many of them are an error, none is dropped."""
    given = offsets.limit(MOST_OFFSETS + 1).collect()
    if len(given) > MOST_OFFSETS:
        raise ValueError(f"at most {MOST_OFFSETS} offsets in a run")
    kinds = {f.name: f.dataType for f in offsets.schema.fields}
    return F.explode(F.array(*(F.struct(*(F.lit(v).cast(kinds[k]).alias(k) for k, v in r.asDict().items())) for r in given)))


def dense(sums: DataFrame, pixels: DataFrame, offsets: DataFrame) -> DataFrame:
    """Every pixel of every offset, zeros where nothing fell. pixels: pix; offsets: offset_id."""
    every = pixels.withColumn("o", for_each_offset(offsets.select("offset_id"))).select("pix", F.col("o.offset_id").alias("offset_id"))
    return every.join(sums, ["offset_id", "pix"], "left").fillna(0, ["flux_sum", "count", "mask_count"])


def run_sums(assignment: DataFrame, image: DataFrame, drop_first_run: bool = False) -> DataFrame:
    """Sums of each cell's runs of equal pixel; drop_first_run leaves out each cell's least pixel, taken to be the unassigned one."""
    from pyspark.sql import Window

    rows = assignment.join(image, ["cell_id", "y", "x"])
    runs = rows.groupBy("cell_id", "pix").agg(F.sum(F.when(~F.isnan("value"), F.col("value")).otherwise(0.0)).alias("flux_sum"), F.count("*").alias("count"))
    if not drop_first_run:
        return runs.where("pix >= 0")
    return runs.withColumn("run", F.dense_rank().over(Window.partitionBy("cell_id").orderBy("pix"))).where("run > 1").drop("run")


def block_sum(grid: DataFrame, k: int) -> DataFrame:
    return grid.groupBy(F.floor(F.col("y") / k).cast("int").alias("by"), F.floor(F.col("x") / k).cast("int").alias("bx")).agg(F.sum("value").alias("total"))


def plain_downsample(assignment: DataFrame, image: DataFrame, trim: int = 0, height: int = H, width: int = W) -> DataFrame:
    """Sum, count and mask count without shifts, ignored bits or care for NaN; the cell's rim may be trimmed."""
    inside = (F.col("y") >= trim) & (F.col("y") < height - trim) & (F.col("x") >= trim) & (F.col("x") < width - trim)
    rows = assignment.where((F.col("pix") >= 0) & inside).join(image, ["cell_id", "y", "x"])
    return rows.groupBy("pix").agg(F.sum("value").alias("flux_sum"), F.count("*").alias("count"), F.count_if(F.col("mask") != 0).alias("mask_count"))


def averages(sums: DataFrame) -> DataFrame:
    some = F.col("count") > 0
    return sums.withColumn("flux", F.when(some, F.col("flux_sum") / F.col("count")).otherwise(0.0)).withColumn("mask_ratio", F.when(some, F.col("mask_count") / F.col("count")).otherwise(0.0))


def split_axis_index(px, py, width: int):
    """Index of a pixel given as two axes, in which 65535 stands for none."""
    x = F.when(px == 65535, -1).otherwise(px)
    return (x + F.when(py == 65535, 0).otherwise(py) * width).cast("int")


def sub_pixel(pix, width: int, n: int) -> tuple:
    """Base pixel (x, y) and sub-pixel (x, y) of an oversampled index."""
    x, y = pix % (width * n), F.floor(pix / (width * n))
    return F.floor(x / n).cast("int"), F.floor(y / n).cast("int"), (x % n).cast("int"), (y % n).cast("int")


def roi_cells(assignment: DataFrame, cells: DataFrame, x0: int, x1: int, y0: int, y1: int, width: int) -> DataFrame:
    """The cells that have a pixel in the region."""
    inside = assignment.where((F.col("pix") >= 0) & (F.col("pix") % width >= x0) & (F.col("pix") % width < x1) & (F.floor(F.col("pix") / width) >= y0) & (F.floor(F.col("pix") / width) < y1))
    return cells.join(inside.select("cell_id").distinct(), "cell_id", "left_semi")


def batches(cells: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Nearly equal batches of at most `size`, in name order. The catalogue is counted once and ranked in one task: it has a row a cell."""
    from pyspark.sql import Window

    n = max(1, -(-cells.count() // size))
    return cells.select("cell_id", (F.ntile(n).over(Window.orderBy("name")) - 1).alias("batch"))
