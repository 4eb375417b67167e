"""Rows of cells: geometry, assembly, overlaps between rows, convolution and extraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CELL_OVERLAP, EDGE_EXCLUSION, PAD_SIZE, PSF_RADIUS, PSF_SIGMA, SIDES
from ..functions import wcs
from ..shipping import ship
from ..sources.work import settled

#: Values of rasters that are filled together, and pixels of a task that are dealt together.
MANY_VALUES = 1 << 20


def lists(column) -> list[np.ndarray]:
    """An Arrow list column's values as views on its buffer, without Python numbers; NaN for nulls in a list of floats."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def as_lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    flat = np.concatenate([a.ravel() for a in arrays]) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(a.size for a in arrays)]), pa.int32()), pa.array(flat).cast(kind))


def projection_facts(cells: DataFrame) -> DataFrame:
    """Typical size (of the largest area), cells in the longest row, least x (10 at most), number of rows."""
    per_row = cells.groupBy("projection", "y").agg(F.count("*").alias("n"), F.min("x").alias("min_x"), F.max(F.struct((F.col("naxis1") * F.col("naxis2")).alias("area"), "naxis1", "naxis2")).alias("m"))
    return per_row.groupBy("projection").agg(
        F.max("m").alias("m"), F.max("n").alias("max_cells"), F.least(F.min("min_x"), F.lit(10)).alias("min_x"), F.count("*").alias("n_rows")
    ).select("projection", F.col("m.naxis1").alias("width"), F.col("m.naxis2").alias("height"), "max_cells", "min_x", "n_rows")


def master_size(facts: DataFrame) -> DataFrame:
    step = F.col("width") - CELL_OVERLAP
    return facts.withColumn("master_width", PAD_SIZE + F.col("max_cells") * step + CELL_OVERLAP + PAD_SIZE).withColumn("master_height", F.col("height") + 2 * PAD_SIZE)


def row_lists(cells: DataFrame) -> DataFrame:
    return cells.groupBy("projection", "y").agg(F.transform(F.sort_array(F.collect_list(F.struct("x", "name"))), lambda s: s["name"]).alias("names"))


def row_pairs(cells: DataFrame) -> DataFrame:
    """Each row with the next one that exists."""
    rows = cells.select("projection", "y").distinct()
    return rows.withColumn("next_y", F.lead("y").over(Window.partitionBy("projection").orderBy("y")))


def sorted_projections(cells: DataFrame, limit: int | None = None) -> DataFrame:
    """Projections in the order of their names."""
    out = cells.select(F.col("projection").cast("string").alias("projection")).distinct().orderBy("projection")
    return out if limit is None else out.limit(limit)


def assemble(pixels: DataFrame, height: int, width: int, overlap: int, edge: int, pad: int) -> DataFrame:
    """pixels: projection, row, k (place in the row), y, x, value. Returns the row's array (projection, row, my, mx, value); of cells that overlap the higher one counts."""
    keep = overlap - edge
    placed = pixels.where((F.col("k") == 0) | (F.col("x") >= keep)).select(
        "projection", "row", (F.col("y") + pad).alias("my"), (pad + F.col("k") * (width - overlap) + F.col("x")).alias("mx"), "k", "value"
    )
    return placed.groupBy("projection", "row", "my", "mx").agg(F.max_by("value", "k").alias("value"))


def cross_row(rows: DataFrame, pairs: DataFrame, height: int, overlap: int, edge: int, pad: int) -> DataFrame:
    """The top rim of each row from the row after it, and that one's bottom rim from this one.

    A row without a next one keeps its own top rim."""
    own = rows.join(pairs.select("projection", F.col("y").alias("row"), F.col("next_y").alias("next_row")), ["projection", "row"])
    own = own.join(pairs.where("next_y is not null").select("projection", F.col("next_y").alias("row"), F.col("y").alias("prev_row")), ["projection", "row"], "left")
    top, bottom = height + pad - edge, pad + edge
    shift = height - overlap  # from a row's array to that of the row before
    my, above, below = F.col("my"), F.col("next_row"), F.col("prev_row")
    at = lambda row, y: F.struct(row.alias("row"), y.alias("my"))
    # the places of a pixel: in its own row, in the row before as its top rim, in the row after as its bottom rim
    places = F.array(
        F.when((above.isNull() | (my < top)) & (below.isNull() | (my >= bottom)), at(F.col("row"), my)),
        F.when(below.isNotNull() & (my >= top - shift) & (my < height + 2 * pad - shift), at(below, my + shift)),
        F.when(above.isNotNull() & (my >= shift) & (my < shift + bottom), at(above, my - shift)),
    )
    return own.select("projection", F.explode(F.array_compact(places)).alias("p"), "mx", "value").select("projection", "p.row", "p.my", "mx", "value")


def extract(rows: DataFrame, cells: DataFrame, height: int, width: int, overlap: int, pad: int) -> DataFrame:
    """Each cell's part of its row's array. cells: projection, row, k, name."""
    step = width - overlap
    left = pad + F.col("k") * step
    inner = F.col("mx") - pad
    # the places in the row whose cells can hold a column, by arithmetic, so that a pixel meets those only
    places = F.sequence(F.greatest(F.lit(0), F.floor((inner - width) / step).cast("int") + 1), F.floor(inner / step).cast("int"))
    near = rows.where((F.col("my") >= pad) & (F.col("my") < pad + height) & (inner >= 0)).withColumn("k", F.explode(places))
    hits = near.join(cells, ["projection", "row", "k"])
    return hits.select("name", (F.col("my") - pad).alias("y"), (F.col("mx") - left).alias("x"), "value")


def padding_placement(cells: DataFrame, pad: int = PAD_SIZE, edge: int = EDGE_EXCLUSION, overlap: int = CELL_OVERLAP) -> DataFrame:
    """Where the raster of each cell's padding lies in its row's array, by side: cell_id, side, width, height, cx, cy and the centre on the sky.

    cells: their headers and k, the place in the row. A side takes the cell's length along it; a corner's name holds both
    its sides, so it has the cell's width and height."""
    reach, across = (pad - edge) / 2, pad + edge
    start = pad + F.col("k") * (F.col("naxis1") - overlap)
    has = lambda part: F.col("side").contains(part)
    rows = cells.withColumn("side", F.explode(F.array(*(F.lit(name) for name, _, _ in SIDES)))).withColumn("start", start)
    rows = rows.withColumn("width", F.when(has("top") | has("bottom"), F.col("naxis1")).otherwise(across)).withColumn("height", F.when(has("left") | has("right"), F.col("naxis2")).otherwise(across))
    cx = F.when(has("right"), F.col("start") + F.col("naxis1") + reach).when(has("left"), F.col("start") - reach).otherwise(F.col("start") + F.col("naxis1") / 2)
    cy = F.when(has("bottom"), F.lit((pad + edge) / 2)).when(has("top"), pad + F.col("naxis2") + reach).otherwise(pad + F.col("naxis2") / 2)
    rows = rows.withColumn("cx", cx).withColumn("cy", cy)
    ra, dec = wcs.pixel_to_sky(F.col("cx") - F.col("start"), F.col("cy") - pad)
    return rows.select("cell_id", "side", "width", "height", "cx", "cy", ra.alias("ra"), dec.alias("dec"))


def valid_for_stitching(pixels: DataFrame, height, width) -> DataFrame:
    """The reprojected pixels (y, x, value, footprint) that may go into an array: inside it, a number, and seen by the source."""
    inside = (F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width)
    return pixels.where(inside & F.col("value").isNotNull() & ~F.isnan("value") & (F.col("footprint") > 0))


def stitch(rows: DataFrame, padding: DataFrame, keys: list[str]) -> DataFrame:
    """rows (keys, y, x, value) with valid padding pixels in their place; of several for one place the highest source counts. padding: keys, source, y, x, value."""
    at = [*keys, "y", "x"]
    new = padding.groupBy(*at).agg(F.max_by("value", "source").alias("new"))
    return rows.join(new, at, "full").select(*at, F.coalesce("new", "value").alias("value"))


def kernel(sigma: float = PSF_SIGMA, radius: int = PSF_RADIUS) -> np.ndarray:
    g = np.exp(-np.arange(-radius, radius + 1) ** 2 / (2.0 * sigma * sigma))
    return g / g.sum()


def stencil(grid: DataFrame, taps: list[tuple[int, int, float]], keys: list[str] = []) -> DataFrame:  # noqa: B006
    """Sum of weighted neighbours, for small kernels: each pixel is copied to the places that it reaches. taps: dy, dx, weight; a pixel counts as 0 outside the raster or if it is NaN."""
    t = F.explode(F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(float(w)).alias("w")) for dy, dx, w in taps)))
    spread = grid.where(~F.isnan("value")).select(*keys, "y", "x", "value", t.alias("t"))
    spread = spread.select(*keys, (F.col("y") + F.col("t.dy")).alias("y"), (F.col("x") + F.col("t.dx")).alias("x"), (F.col("value") * F.col("t.w")).alias("value"))
    sums = spread.groupBy(*keys, "y", "x").agg(F.sum("value").alias("smooth"))
    return grid.join(sums, [*keys, "y", "x"], "left").withColumn("smooth", F.when(~F.isnan("value"), F.coalesce("smooth", F.lit(0.0))).otherwise(F.lit(float("nan"))))


def separable_taps(g: np.ndarray) -> tuple[list, list]:
    r = len(g) // 2
    return [(i - r, 0, w) for i, w in enumerate(g.tolist())], [(0, i - r, w) for i, w in enumerate(g.tolist())]


def psf_taps(std: float = 0.8, size: int = 3) -> list[tuple[int, int, float]]:
    """A normalised Gaussian on a small grid whose centre is size / 2, half a pixel off the middle one."""
    w = [(y, x, float(np.exp(-((y - size / 2) ** 2 + (x - size / 2) ** 2) / (2 * std * std)))) for y in range(size) for x in range(size)]
    total = sum(v for *_, v in w)
    return [(y - size // 2, x - size // 2, v / total) for y, x, v in w]


def convolve_tiles(tiles: DataFrame, sigma: float = PSF_SIGMA, radius: int = PSF_RADIUS) -> DataFrame:
    """Large kernels: tiles (key, h, w, data) with their halo already in place are filtered along both axes by FFT, NaN as 0 and put back after."""
    g = kernel(sigma, radius)

    def one_axis(a: np.ndarray, axis: int) -> np.ndarray:
        n = a.shape[axis] + len(g) - 1
        shape = [1, 1]
        shape[axis] = -1
        spectrum = np.fft.rfft(a, n, axis=axis) * np.fft.rfft(g, n).reshape(shape)
        return np.take(np.fft.irfft(spectrum, n, axis=axis), range(radius, radius + a.shape[axis]), axis=axis)

    def step(batches):
        for batch in batches:
            out = []
            for h, w, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), lists(batch.column(3))):
                a = data.astype(np.float64).reshape(h, w)
                hole = np.isnan(a)
                smooth = one_axis(one_axis(np.where(hole, 0.0, a), 0), 1)
                out.append(np.where(hole, np.nan, smooth))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), as_lists(out, pa.float64())], names=["key", "h", "w", "data"])

    ship(tiles.sparkSession)
    return tiles.select("key", "h", "w", "data").mapInArrow(step, "key string, h int, w int, data array<double>")


def tiles(pixels: DataFrame, size: int, halo: int, keys: list[str]) -> DataFrame:
    """Long pixels to tiles with a halo, NaN where there is none: a pixel is copied to each tile whose halo holds it, and a tile's pixels are scattered into its raster."""
    reach = lambda c: F.sequence(F.floor((c - halo) / size).cast("int"), F.floor((c + halo) / size).cast("int"))
    rows = pixels.withColumn("ty", F.explode(reach(F.col("y")))).withColumn("tx", F.explode(reach(F.col("x"))))
    side = size + 2 * halo
    place = (F.col("y") - F.col("ty") * size + halo) * side + F.col("x") - F.col("tx") * size + halo
    name = F.concat_ws("/", *(F.col(k).cast("string") for k in [*keys, "ty", "tx"])).alias("key")
    own = rows.select(name, place.cast("int").alias("at"), F.col("value").cast("double").alias("value"))

    def scatter(group: pa.Table) -> pa.Table:
        out = np.full(side * side, np.nan)
        out[group["at"].to_numpy()] = group["value"].to_numpy()
        return pa.table({"key": pa.array([group["key"][0].as_py()]), "h": pa.array([side], pa.int32()), "w": pa.array([side], pa.int32()), "data": as_lists([out], pa.float64())})

    ship(pixels.sparkSession)
    return own.groupBy("key").applyInArrow(scatter, "key string, h int, w int, data array<double>")


def rasters(pixels: DataFrame, keys: list[str], height: int, width: int, fill: dict[str, float]) -> DataFrame:
    """Long pixels (keys, y, x, values) to whole rasters: keys, h, w and an array of doubles for each value of fill, which says what stands where no pixel is."""
    kinds = ", ".join(f"`{k}` {pixels.schema[k].dataType.simpleString()}" for k in keys)

    def scatter(group: pa.Table) -> pa.Table:
        at = group["y"].to_numpy() * np.int64(width) + group["x"].to_numpy()
        cols = {k: group[k].slice(0, 1) for k in keys} | {"h": pa.array([height], pa.int32()), "w": pa.array([width], pa.int32())}
        for name, empty in fill.items():
            out = np.full(height * width, empty, np.float64)
            out[at] = group[name].to_numpy(zero_copy_only=False)
            cols[name] = as_lists([out], pa.float64())
        return pa.table(cols)

    ship(pixels.sparkSession)
    own = pixels.select(*keys, F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), *(F.col(n).cast("double").alias(n) for n in fill))
    return own.groupBy(*keys).applyInArrow(scatter, f"{kinds}, h int, w int, " + ", ".join(f"{n} array<double>" for n in fill))


def rasters_at_once(pixels: DataFrame, keys: list[str], facts: list[str], height: int, width: int, fill: dict[str, float], parts: int) -> DataFrame:
    """rasters() of very many keys (whole numbers) with small rasters. They are dealt as a table of `parts` buckets by keys is, and a task fills those of a bucket together. A row without y brings the key's facts, which need no join then.

    What is shuffled are pieces, not rows: the pixels of a bucket in a task, sorted and compressed, a quarter of the bytes. They are a table before, so that the shuffles behind pixels are gone by then."""
    size = height * width
    at_once = max(1, MANY_VALUES // (size * len(fill)))
    part = F.pmod(F.hash(*keys), F.lit(parts)).alias("part")
    own = pixels.dropna(subset=keys).select(part, *keys, *facts, F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), *(F.col(n).cast("double").alias(n) for n in fill))

    def number(table: pa.Table, name: str) -> np.ndarray:
        return table[name].to_numpy(zero_copy_only=False)

    def packed(table: pa.Table) -> pa.RecordBatch:
        table = table.take(pa.array(np.lexsort([number(table, c) for c in ("x", "y", *keys[::-1], "part")]))).combine_chunks()
        of = number(table, "part")
        starts = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
        pieces = []
        for i, j in zip(starts, [*starts[1:], len(of)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.slice(i, j - i))
            pieces.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(of[starts], pa.int32()), pa.array(pieces, pa.binary())], names=["part", "piece"])

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= MANY_VALUES:
                yield packed(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield packed(pa.Table.from_batches(held))

    def filled(batches):
        pieces = [pa.ipc.open_stream(piece.as_py()).read_all() for batch in batches for piece in batch.column(0)]
        if not pieces:
            return
        table = pa.concat_tables(pieces)
        table = table.take(pa.array(np.lexsort([number(table, k) for k in keys[::-1]]))).combine_chunks()
        first = np.any([np.diff(number(table, k), prepend=number(table, k)[0] - 1) != 0 for k in keys], axis=0)
        key = np.cumsum(first) - 1
        heads = {k: table[k].filter(pa.array(first)).combine_chunks() for k in keys}
        for fact in facts:
            has = np.flatnonzero(table[fact].is_valid().to_numpy(zero_copy_only=False))
            row = np.full(key[-1] + 1, -1)
            row[key[has]] = has
            heads[fact] = table[fact].combine_chunks().take(pa.array(row, mask=row < 0))
        seen = table["y"].is_valid().to_numpy(zero_copy_only=False)
        y, x = number(table, "y")[seen].astype(np.int64), number(table, "x")[seen].astype(np.int64)
        if len(y) and not (0 <= y.min() and y.max() < height and 0 <= x.min() and x.max() < width):
            raise ValueError(f"a pixel outside of {height} x {width}")
        key, at, values = key[seen], y * width + x, {name: number(table, name)[seen] for name in fill}
        for a in range(0, len(row_keys := heads[keys[0]]), at_once):
            n = min(at_once, len(row_keys) - a)
            i, j = np.searchsorted(key, [a, a + n])
            cols = {k: c.slice(a, n) for k, c in heads.items()} | {"h": pa.array([height] * n, pa.int32()), "w": pa.array([width] * n, pa.int32())}
            for name, empty in fill.items():
                out = np.full(n * size, empty, np.float64)
                out[(key[i:j] - a) * size + at[i:j]] = values[name][i:j]
                cols[name] = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(out))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    ship(pixels.sparkSession)
    kinds = ", ".join(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in [*keys, *facts])
    pieces = settled(own.mapInArrow(pack, "part int, piece binary"), "pieces")
    return pieces.repartitionById(parts, F.col("part")).select("piece").mapInArrow(filled, f"{kinds}, h int, w int, " + ", ".join(f"{n} array<double>" for n in fill))


def edge_to_nan(value, y, x, height: int, width: int, edge: int = EDGE_EXCLUSION):
    return F.when((y < edge) | (y >= height - edge) | (x < edge) | (x >= width - edge), float("nan")).otherwise(value)


def x_chunks(x, width: int, n: int):
    """The chunk of a column of pixels; what is left over belongs to the last one."""
    return F.least(F.floor(x / (width // n)).cast("int"), F.lit(n - 1))


def unified_mask(masks: DataFrame, positions: DataFrame) -> DataFrame:
    """Masks of each row's cells on common ground; the later cell of a row counts, and every cell gets the result back. positions: cell_id, projection, row, x0, y0."""
    placed = masks.join(positions, "cell_id").withColumn("gy", F.col("y") + F.col("y0")).withColumn("gx", masks["x"] + F.col("x0"))
    ground = ["projection", "row", "gy", "gx"]
    top = placed.groupBy(*ground).agg(F.max_by("mask", "cell_id").alias("row_mask"))
    return placed.join(top, ground).select("cell_id", "y", masks["x"].alias("x"), "row_mask")
