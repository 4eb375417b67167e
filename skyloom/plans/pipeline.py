"""The whole run, from bands and mapping to templates, as one lazily built set of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..constants import IGNORE_BITS
from ..operators import combine, downsample


@dataclass
class Config:
    ignore_bits: tuple[int, ...] = IGNORE_BITS
    roi: tuple[int, int, int, int, int] | None = None
    height: int = 32
    width: int = 32
    outputs: dict[str, str] = field(default_factory=dict)


def run(pixels: DataFrame, assignment: DataFrame, shifts: DataFrame, config: Config | None = None) -> dict[str, DataFrame]:
    """Combined cells and templates; with outputs, tables of those names are written too. Nothing runs before a result is used or written."""
    from ..sources.store import write_table

    c = config or Config()
    cells = combine.combine_bands(pixels)
    image = cells.select("cell_id", "y", "x", "value", "mask")
    templates = downsample.template(assignment, image, shifts, c.ignore_bits, roi=c.roi, height=c.height, width=c.width)
    results = {"combined": cells, "template": downsample.averages(templates)}
    for name, path in c.outputs.items():
        write_table(results[name], path)
    return results


def stitch_and_convolve(image: DataFrame, cells: DataFrame, size: int, overlap: int, edge: int, pad: int, sigma: float, radius: int, tile: int = 512) -> DataFrame:
    """Rows of cells put together, their rims taken from the rows beside them, smoothed in tiles with halo, and cut into cells again.

    image: cell_id, y, x, value; cells: cell_id, name, projection, row, k. Rows depend on their neighbours as they are before smoothing only, so all rows go at once."""
    from pyspark.sql import functions as F

    from ..operators import rows

    placed = rows.assemble(cells.join(image, "cell_id"), size, size, overlap, edge, pad)
    pairs = rows.row_pairs(cells.select("projection", F.col("row").alias("y")))
    full = rows.cross_row(placed, pairs, size, overlap, edge, pad)
    tiles = rows.tiles(full.select("projection", "row", F.col("my").alias("y"), F.col("mx").alias("x"), "value"), tile, radius, ["projection", "row"])
    side = tile + 2 * radius
    smooth = rows.convolve_tiles(tiles, sigma, radius).select(F.split("key", "/").alias("k"), F.posexplode("data").alias("at", "value"))
    y, x = F.floor(F.col("at") / side).cast("int") - radius, F.col("at") % side - radius
    own = smooth.where((y >= 0) & (y < tile) & (x >= 0) & (x < tile) & ~F.isnan("value"))
    part = lambda i: F.col("k")[i].cast("int")
    back = own.select(part(0).alias("projection"), part(1).alias("row"), (part(2) * tile + y).alias("my"), (part(3) * tile + x).alias("mx"), "value")
    return rows.extract(back, cells.select("name", "projection", "row", "k"), size, size, overlap, pad)
