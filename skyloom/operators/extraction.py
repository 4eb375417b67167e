"""Sources in rasters that are stored as chunks: what stands out of the noise, joined over the chunks' borders.

A raster is a set of chunks on a grid and is never one row. Chunks are a table bucketed by their place, so that no pass over
them needs a shuffle; what is exchanged are strips of two pixels, the pixels of components that reach a border, and a
row for each such component. Pieces of a source in different chunks are tied by the border pixels that both have seen and
their classes are found by distributed stars, so a source may have any size and shape.

A pixel belongs to a source if it is a number, is not bright, and the matched filter 1 2 1 / 2 4 2 / 1 2 1 over its neighbours,
each weighted by its inverse variance, is above sigma; sources are components over 8 neighbours of min_area pixels or
more. Bright is what is above `bright` times the median error of the whole raster; bright pixels are kept but don't count
in the filter, nor do pixels that are no numbers or whose error isn't a positive number. A raster without any error is left as it is.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from ..sources.work import cut, folder
from .rows import as_lists, lists

PLACE = ["key", "cy", "cx"]
#: Strips that a chunk needs of those around it: one pixel for the filter, one more for what touches its border.
RIM = 2
#: Labels of pixels in no source and of bright ones; a source's label is that of its first pixel.
NONE, BRIGHT = 0, -1


class Rules(NamedTuple):
    size: int = 1024
    sigma: float = 2.5
    bright: float = 20.0
    min_area: int = 5


# ---- chunks ----


def chunks(pixels: DataFrame, size: int) -> DataFrame:
    """Long pixels (key, y, x, value, error) to chunks: key, cy, cx, h, w, data, error; NaN where no pixel is."""
    at = (F.pmod("y", F.lit(size)) * size + F.pmod("x", F.lit(size))).cast("int")
    own = pixels.select(F.col("key").cast("string").alias("key"), F.floor(F.col("y") / size).cast("int").alias("cy"), F.floor(F.col("x") / size).cast("int").alias("cx"), at.alias("at"), F.col("value").cast("double").alias("data"), F.col("error").cast("double").alias("error"))

    def scatter(group: pa.Table) -> pa.Table:
        cols = {k: group[k].slice(0, 1) for k in PLACE} | {"h": pa.array([size], pa.int32()), "w": pa.array([size], pa.int32())}
        for name in ("data", "error"):
            out = np.full(size * size, np.nan)
            out[group["at"].to_numpy()] = group[name].to_numpy(zero_copy_only=False)
            cols[name] = as_lists([out], pa.float64())
        return pa.table(cols)

    ship(pixels.sparkSession)
    return own.groupBy(*PLACE).applyInArrow(scatter, "key string, cy int, cx int, h int, w int, data array<double>, error array<double>")


def store_chunks(rows: DataFrame, buckets: int = 200) -> DataFrame:
    """Chunks, or anything else that has their places, as a table bucketed by place in the shared folder."""
    spark = rows.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    rows.repartition(buckets, *PLACE).write.bucketBy(buckets, *PLACE).sortBy(*PLACE).option("path", folder(spark, name)).format("parquet").saveAsTable(name)
    return spark.table(name)


def _raster(rows: pa.Table, name: str) -> np.ndarray:
    return lists(rows[name].combine_chunks())[0].astype(np.float64).reshape(rows["h"][0].as_py(), rows["w"][0].as_py())


def _apart(df: DataFrame) -> DataFrame:
    """df with columns of its own, so that it may meet the table that it was made from."""
    return df.select(*(F.col(c).alias(c) for c in df.columns))


def _place(rows: pa.Table) -> tuple[str, int, int]:
    return tuple(rows[c][0].as_py() for c in PLACE)


# ---- the median of a raster ----

_DIGIT = 16


def _ordered(a: np.ndarray) -> np.ndarray:
    """Numbers as unsigned integers of the same order."""
    u = (a + 0.0).view(np.uint64)
    return np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))


def _number(u: int) -> float:
    u = u ^ (1 << 63) if u >> 63 else ~u & (1 << 64) - 1
    return float(np.array([u], np.uint64).view(np.float64)[0])


def medians(stored: DataFrame, column: str = "error") -> DataFrame:
    """key, median: the exact median of all numbers of a column in a raster's chunks, null if there are none.

    The two middle numbers are found 16 bits at a time: each pass counts a digit of the numbers that begin as the middle ones do,
    so a chunk sends at most 65,536 counts of each and a raster's are as many at most. Four passes over one column."""
    ship(stored.sparkSession)
    places = stored.select(*PLACE)
    counts = "key string, side int, digit int, n long"

    def count(shift: int):
        def of(rows: pa.Table, want: pa.Table) -> pa.Table:
            out = [pa.table({"key": pa.array([], pa.string()), "side": pa.array([], pa.int32()), "digit": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})]
            if len(rows):
                flat = lists(rows[column].combine_chunks())[0].astype(np.float64)
                u = _ordered(flat[~np.isnan(flat)])
                for side, prefix in zip(want["side"].to_pylist(), want["prefix"].to_pylist()):
                    own = u if shift + _DIGIT == 64 else u[u >> np.uint64(shift + _DIGIT) == np.uint64(prefix)]
                    digit, n = np.unique((own >> np.uint64(shift) & np.uint64((1 << _DIGIT) - 1)).astype(np.int32), return_counts=True)
                    k = len(digit)
                    out.append(pa.table({"key": pa.array([rows["key"][0].as_py()] * k, pa.string()), "side": pa.array([side] * k, pa.int32()), "digit": digit, "n": pa.array(n, pa.int64())}))
            return pa.concat_tables(out)

        return of

    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    want = places.select("key").distinct().select("key", sides, F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("rank"))
    for shift in (48, 32, 16, 0):
        per_chunk = places.join(want, "key").select(*PLACE, "side", "prefix")
        found = stored.select(*PLACE, column).groupBy(*PLACE).cogroup(_apart(per_chunk).groupBy(*PLACE)).applyInArrow(count(shift), counts)
        found = found.groupBy("key", "side", "digit").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("key", "side").orderBy("digit"))
        found = found.withColumn("upto", upto).join(want.drop("digit"), ["key", "side"])
        if shift == 48:
            total = F.sum("n").over(Window.partitionBy("key", "side"))
            found = found.withColumn("rank", F.floor((total - 1 + F.col("side")) / 2))
        found = found.where("rank < upto and rank >= upto - n")
        # the last digit is kept apart: with it the prefix would not fit a signed number
        step = (F.col("prefix") * (1 << _DIGIT) + F.col("digit")).alias("prefix")
        want = cut(found.select("key", "side", "prefix" if shift == 0 else step, (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "digit"), "digits")
    ends = "key string, side int, value double"

    def back(batches):
        for b in batches:
            values = [_number(p << _DIGIT | d) for p, d in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(values, pa.float64())], names=["key", "side", "value"])

    middle = want.select("key", "side", "prefix", "digit").mapInArrow(back, ends).groupBy("key").agg(F.avg("value").alias("median"))
    return places.select("key").distinct().join(middle, "key", "left")


# ---- detection in a chunk ----


def _filtered(a: np.ndarray, side: float, middle: float) -> np.ndarray:
    """Without its outermost pixels: weights (side, middle, side) along both axes."""
    rows = side * a[:-2] + middle * a[1:-1] + side * a[2:]
    return side * rows[:, :-2] + middle * rows[:, 1:-1] + side * rows[:, 2:]


def over_noise(data: np.ndarray, error: np.ndarray, level: float, sigma: float) -> np.ndarray:
    """True where the matched filter is above sigma; the outermost pixels are left out."""
    real = np.isfinite(data) & ~(data > level)
    good = real & np.isfinite(error) & (error > 0)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        weight = np.where(good, 1 / (error * error), 0.0)
        signal = _filtered(np.where(good, data, 0.0) * weight, 1, 2)
        noise = np.sqrt(_filtered(weight, 1, 4))
        return (signal > sigma * noise) & real[1:-1, 1:-1]


def label(mask: np.ndarray) -> np.ndarray:
    """Components of a boolean raster over 8 neighbours, by spreading the least index until nothing changes."""
    n = mask.size
    ids = np.where(mask, np.arange(n).reshape(mask.shape), n)
    while True:
        p = np.pad(ids, 1, constant_values=n)
        least = np.minimum.reduce([p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
        least = np.where(mask, least, n)
        jumped = np.append(least.ravel(), n)[least]  # follow the representative one step further
        least = np.where(mask, np.minimum(least, jumped), n)
        if (least == ids).all():
            return least
        ids = least


STRIPS = "key string, cy int, cx int, y0 int, x0 int, h int, w int, data array<double>, error array<double>"


def strips_of(stored: DataFrame, size: int) -> DataFrame:
    """What each of the eight chunks around a chunk needs of it, in the coordinates of the one that takes it, its rim included."""

    def step(rows: pa.Table) -> pa.Table:
        key, cy, cx = _place(rows)
        both = [_raster(rows, n) for n in ("data", "error")]
        h, w = both[0].shape
        parts = {-1: lambda n: (0, min(RIM, n)), 0: lambda n: (0, n), 1: lambda n: (max(0, size - RIM), n)}
        out = []
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                (y0, y1), (x0, x1) = parts[dy](h), parts[dx](w)
                if (dy or dx) and y0 < y1 and x0 < x1:
                    out.append((cy + dy, cx + dx, y0 - dy * size + RIM, x0 - dx * size + RIM, y1 - y0, x1 - x0, *(np.ascontiguousarray(a[y0:y1, x0:x1]) for a in both)))
        cols = list(zip(*out)) or [[]] * 8
        names = ("cy", "cx", "y0", "x0", "h", "w")
        return pa.table({"key": pa.array([key] * len(out), pa.string()), **{n: pa.array(c, pa.int32()) for n, c in zip(names, cols)}, "data": as_lists(list(cols[6]), pa.float64()), "error": as_lists(list(cols[7]), pa.float64())})

    ship(stored.sparkSession)
    return stored.groupBy(*PLACE).applyInArrow(step, STRIPS)


LABELLED = "key string, cy int, cx int, h int, w int, data array<double>, seg array<int>, ids array<long>, areas array<int>, pixels array<long>, owners array<int>"


def labelled(stored: DataFrame, strips: DataFrame, levels: DataFrame, rules: Rules) -> DataFrame:
    """Chunks with their own components. seg: 0 no source, -1 bright, -2 - i the component ids[i], which reaches over the border,
    else the first pixel of a source that lies in the chunk, from 1. areas: of ids, in this chunk; pixels: those of ids on both
    sides of the border, of owners[i]. levels: key, level (null: the raster is left as it is, all of it bright)."""
    size = rules.size
    facts = strips.select(*STRIPS_COLS, F.lit(None).cast("double").alias("level")).unionByName(stored.select(*PLACE).join(levels, "key").select(*PLACE, "level"), allowMissingColumns=True)

    def step(rows: pa.Table, given: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({f.name: pa.array([], f.type) for f in _LABELLED})
        key, cy, cx = _place(rows)
        own, err = _raster(rows, "data"), _raster(rows, "error")
        h, w = own.shape
        window = [np.full((h + 2 * RIM, w + 2 * RIM), np.nan) for _ in range(2)]
        window[0][RIM : RIM + h, RIM : RIM + w], window[1][RIM : RIM + h, RIM : RIM + w] = own, err
        level = None
        starts = given["y0"].to_pylist()
        left, hs, ws = (given[n].to_pylist() for n in ("x0", "h", "w"))
        found = [lists(given[n].combine_chunks()) for n in ("data", "error")]
        for i, y0 in enumerate(starts):
            if y0 is None:
                level = given["level"][i].as_py()
                continue
            for a, values in zip(window, found):
                rim = values[i].astype(np.float64).reshape(hs[i], ws[i])
                room = a[y0 : y0 + hs[i], left[i] : left[i] + ws[i]]
                room[...] = rim[: room.shape[0], : room.shape[1]]
        base = {"key": key, "cy": cy, "cx": cx, "h": h, "w": w}
        if level is None:
            return _labelled(base, own, np.full(own.shape, BRIGHT), [], [], [], [])
        over = over_noise(*window, level, rules.sigma)
        ids = label(over)  # of the chunk and one pixel around it
        wide = w + 2
        ring = np.ones(over.shape, bool)
        ring[1:-1, 1:-1] = False
        inner = ids[1:-1, 1:-1]
        names, first, areas = np.unique(inner[inner < over.size], return_index=True, return_counts=True)
        opened = np.isin(names, ids[ring])

        def pixel(at):
            """Of a place in the chunk and its rim; a number over the whole raster, from 1."""
            return (cy * size + at // wide - 1 << 32) + (cx * size + at % wide - 1) + 1

        kinds = np.where(opened, -2 - (np.cumsum(opened) - 1), 0)
        closed = np.where(~opened & (areas >= rules.min_area), names + 1, 0)  # the place within, later
        table = np.zeros(over.size + 1, np.int64)
        table[names] = np.where(opened, kinds, np.where(closed > 0, ((names // wide - 1) * w + names % wide - 1) + 1, 0))
        seg = np.where(own > level, BRIGHT, table[inner])
        border = np.zeros(over.shape, bool)
        border[:2] = border[-2:] = border[:, :2] = border[:, -2:] = True
        at = np.flatnonzero(border.ravel() & over.ravel())
        owner = table[ids.ravel()[at]]
        at, owner = at[owner < BRIGHT], owner[owner < BRIGHT]
        return _labelled(base, own, seg, pixel(names[opened]), areas[opened], pixel(at), -2 - owner)

    ship(stored.sparkSession)
    return stored.groupBy(*PLACE).cogroup(_apart(facts).groupBy(*PLACE)).applyInArrow(step, LABELLED)


STRIPS_COLS = [c.split()[0] for c in STRIPS.split(", ")]
_LABELLED = pa.schema([("key", pa.string()), *((n, pa.int32()) for n in ("cy", "cx", "h", "w")), ("data", pa.list_(pa.float64())), ("seg", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("areas", pa.list_(pa.int32())), ("pixels", pa.list_(pa.int64())), ("owners", pa.list_(pa.int32()))])


def _labelled(base: dict, *arrays) -> pa.Table:
    fields = list(_LABELLED)[5:]
    scalars = {f.name: pa.array([base[f.name]], f.type) for f in list(_LABELLED)[:5]}
    return pa.table(scalars | {f.name: as_lists([np.asarray(a)], f.type.value_type) for f, a in zip(fields, arrays)})


# ---- components over borders ----


def classes(edges: DataFrame) -> DataFrame:
    """edges: key, a, b. Returns key, id, root (the class's least id) of every id that isn't its class's least.

    Large and small stars in turn until nothing changes, each round a table; hubs' rows are met by sums in each task and a join that Spark splits where it is skewed."""
    now = cut(edges.select("key", F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    print_of = lambda df: df.agg(F.count("*"), F.expr("bit_xor(xxhash64(key, u, v))")).first()
    before = print_of(now)
    while before[0]:
        both = now.union(now.select("key", F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("key", "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, ["key", "u"]).select("key", F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "large")
        least = large.groupBy("key", "u").agg(F.min("v").alias("m"))
        small = large.join(least, ["key", "u"]).where("v <> m").select("key", F.col("v").alias("u"), F.col("m").alias("v")).union(least).distinct()
        now = cut(small, "small")
        after = print_of(now)
        if after == before:
            break
        before = after
    return now.select("key", F.col("u").alias("id"), F.col("v").alias("root"))


def _roots(parts: DataFrame, min_area: int) -> DataFrame:
    """key, cy, cx, roots: for each component over a border (in the order of ids) the label of its source, 0 if that is too small."""
    pixels = parts.select("key", "ids", F.explode(F.arrays_zip("pixels", "owners")).alias("p")).select("key", F.col("p.pixels").alias("at"), F.get("ids", F.col("p.owners")).alias("id"))
    seen = pixels.groupBy("key", "at").agg(F.collect_set("id").alias("l"))  # of four chunks at most
    edges = seen.where(F.size("l") > 1).select("key", F.array_min("l").alias("a"), F.explode("l").alias("b"))
    found = classes(edges)
    own = parts.select(*PLACE, F.posexplode(F.arrays_zip("ids", "areas")).alias("i", "c")).select(*PLACE, "i", F.col("c.ids").alias("id"), F.col("c.areas").alias("area"))
    own = cut(own.join(found, ["key", "id"], "left").select(*PLACE, "i", "area", F.coalesce("root", "id").alias("root")), "owned")
    whole = own.groupBy("key", "root").agg(F.sum("area").alias("area")).where(F.col("area") >= min_area).select("key", "root", F.lit(True).alias("kept"))
    kept = own.join(whole, ["key", "root"], "left").select(*PLACE, "i", F.when(F.col("kept"), F.col("root")).otherwise(F.lit(NONE).cast("long")).alias("root"))
    return kept.groupBy(*PLACE).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "root"))), lambda s: s["root"]).alias("roots"))


EXTRACTED = "key string, cy int, cx int, h int, w int, data array<double>, label array<long>"


def extract(stored: DataFrame, rules: Rules = Rules(), buckets: int = 200) -> DataFrame:
    """Chunks with the background at 0 and each pixel's label: 0 background, -1 bright, else its source's first pixel, y * 2^32 + x + 1 over the whole raster.

    stored: of store_chunks()."""
    size = rules.size
    levels = medians(stored).select("key", (F.col("median") * rules.bright).alias("level"))
    parts = store_chunks(labelled(stored, strips_of(stored, size), levels, rules), buckets)
    roots = _roots(parts.select(*PLACE, "ids", "areas", "pixels", "owners").where(F.size("ids") > 0), rules.min_area)

    def step(rows: pa.Table, given: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({"key": pa.array([], pa.string()), **{n: pa.array([], pa.int32()) for n in ("cy", "cx", "h", "w")}, "data": pa.array([], pa.list_(pa.float64())), "label": pa.array([], pa.list_(pa.int64()))})
        _, cy, cx = _place(rows)
        data, w = _raster(rows, "data").ravel(), rows["w"][0].as_py()
        seg = lists(rows["seg"].combine_chunks())[0].astype(np.int64)
        at = seg - 1
        out = np.where(seg > 0, (cy * size + at // w << 32) + cx * size + at % w + 1, np.where(seg == BRIGHT, BRIGHT, NONE))
        if len(given):
            roots = lists(given["roots"].combine_chunks())[0].astype(np.int64)
            over = seg < BRIGHT
            out[over] = roots[-2 - seg[over]]
        data = np.where(out == NONE, 0.0, data)
        return pa.table({**{n: rows[n] for n in ("key", "cy", "cx", "h", "w")}, "data": as_lists([data], pa.float64()), "label": as_lists([out], pa.int64())})

    ship(stored.sparkSession)
    return parts.select(*PLACE, "h", "w", "data", "seg").groupBy(*PLACE).cogroup(_apart(roots).groupBy(*PLACE)).applyInArrow(step, EXTRACTED)


def kept_pixels(extracted: DataFrame, size: int) -> DataFrame:
    """key, y, x, value, label of all pixels that aren't background."""
    at = extracted.select("key", "cy", "cx", "w", F.posexplode(F.arrays_zip("data", "label")).alias("at", "p")).where(F.col("p.label") != NONE)
    y, x = F.col("cy") * size + F.floor(F.col("at") / F.col("w")).cast("int"), F.col("cx") * size + F.col("at") % F.col("w")
    return at.select("key", y.alias("y"), x.alias("x"), F.col("p.data").alias("value"), F.col("p.label").alias("label"))
