"""Which cells pad which: edge strips, neighbours, cross-projection candidates, requirements and jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FULL_COVERAGE, SEARCH_RADIUS, SIDES
from ..functions.names import cell_name, padding_names
from ..shipping import ship


def edge_strips(assignment: DataFrame, height: int, width: int, pad: int, edge: int, legacy: bool = False) -> DataFrame:
    """Per cell, for each side: is there an assigned pixel in its strip? legacy with edge 0 looks only at bottom_left."""
    y, x, used = F.col("y"), F.col("x"), F.col("pix") != -1
    low = lambda c: (c >= edge) & (c < edge + pad)
    high = lambda c, n: (c >= n - edge - pad) & (c < n - edge)
    inner = lambda c, n: (c >= edge) & (c < n - edge)
    part = {-1: low, 0: None, 1: None}
    out = []
    for side, dx, dy in SIDES:
        cx = inner(x, width) if dx == 0 else part[-1](x) if dx < 0 else high(x, width)
        cy = inner(y, height) if dy == 0 else part[-1](y) if dy < 0 else high(y, height)
        seen = F.bool_or(cx & cy & used)
        out.append((F.lit(False) if legacy and edge == 0 and side != "bottom_left" else seen).alias(side))
    return assignment.groupBy("cell_id").agg(*out)


def good_side_fail(y, x):
    """Does a cell lack padding on a side where neighbours of its own projection should be? Of columns named as the sides."""
    s = {side: F.col(side) for side, _, _ in SIDES}
    any_bad = s["bottom"] | s["left"] | s["top_left"] | s["bottom_left"] | s["bottom_right"]
    rule = (
        F.when((x > 0) & (x < 9) & (y > 0) & (y < 9), True)
        .when((x == 0) & (y == 0), False)
        .when(y == 0, ~(s["bottom"] | s["bottom_left"] | s["bottom_right"]))
        .when(x == 0, ~(s["left"] | s["top_left"] | s["bottom_left"]))
        .when(y == 9, ~(s["top"] | s["top_left"] | s["top_right"]))
        .otherwise(~(s["right"] | s["top_right"] | s["bottom_right"]))
    )
    return F.when(any_bad, rule).otherwise(False)


def neighbours(cells: DataFrame) -> DataFrame:
    """name, side, neighbour (null where the grid ends and another projection has to help)."""
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for s, dx, dy in SIDES)))
    rows = cells.select("name", "projection", "y", "x", sides.alias("s")).withColumn("ny", F.col("y") + F.col("s.dy")).withColumn("nx", F.col("x") + F.col("s.dx"))
    inside = F.col("ny").between(0, 9) & F.col("nx").between(0, 9)
    return rows.select("name", F.col("s.side").alias("side"), F.when(inside, cell_name("projection", "ny", "nx")).alias("neighbour"))


def clip_area(subject: list, clip: list) -> float:
    """Area shared by two convex polygons, planar."""
    return abs(_area(_intersection(subject, clip)))


def _polygons(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An Arrow list column of points (ra, dec) as x and y (a row a vertex, a column a polygon) and numbers of vertices."""
    points, ends = column.flatten(), column.offsets.to_numpy() - column.offsets[0].as_py()
    k = np.diff(ends)
    at = np.arange(len(points)) - np.repeat(ends[:-1], k), np.repeat(np.arange(len(k)), k)
    out = np.zeros((2, max(1, k.max(initial=0)), len(k)))
    for axis, name in zip(out, ("ra", "dec")):
        axis[at] = points.field(name).to_numpy(zero_copy_only=False)
    return out[0], out[1], k


def _areas(x: np.ndarray, y: np.ndarray, k: np.ndarray) -> np.ndarray:
    """_area() of many polygons, bit by bit: Python's sum of floats keeps what rounding lost, and so does this."""
    rows = np.arange(len(k))
    total, lost = np.zeros(len(k)), np.zeros(len(k))
    for j in range(len(x)):
        px, py = (x[k - 1, rows], y[k - 1, rows]) if j == 0 else (x[j - 1], y[j - 1])
        term = np.where(j < k, px * y[j] - x[j] * py, 0.0)
        more = total + term
        lost += np.where(np.abs(total) >= np.abs(term), (total - more) + term, (term - more) + total)
        total = more
    return (total + lost) / 2


def _intersections(x, y, k, cx, cy, ck) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """_intersection() of many polygons with many convex ones, bit by bit."""
    rows = np.arange(len(k))
    turned = _areas(cx, cy, ck) < 0
    for i in range(len(cx)):
        live = i < ck
        at = lambda i: np.clip(np.where(turned, ck - 1 - i, i), 0, None)
        a, b = at(ck - 1 if i == 0 else i - 1), at(i)
        ax, ay = cx[a, rows], cy[a, rows]
        side = (cx[b, rows] - ax) * (y - ay) - (cy[b, rows] - ay) * (x - ax)
        inside = (side >= 0) | ~live
        ox, oy, ok = np.zeros((2 * len(x), len(k))), np.zeros((2 * len(x), len(k))), np.zeros(len(k), np.int64)
        for j in range(len(x)):
            p = np.full(len(k), j - 1) if j else k - 1
            crossed = np.flatnonzero((j < k) & (inside[p, rows] != inside[j]))
            q = p[crossed]
            t = side[q, crossed] / (side[q, crossed] - side[j, crossed])
            ox[ok[crossed], crossed] = x[q, crossed] + t * (x[j, crossed] - x[q, crossed])
            oy[ok[crossed], crossed] = y[q, crossed] + t * (y[j, crossed] - y[q, crossed])
            ok[crossed] += 1
            kept = np.flatnonzero((j < k) & inside[j])
            ox[ok[kept], kept], oy[ok[kept], kept] = x[j, kept], y[j, kept]
            ok[kept] += 1
        most = max(1, ok.max(initial=0))
        x, y, k = ox[:most], oy[:most], ok
    return x, y, k


def _percent(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.where(whole != 0, 100 * part / np.where(whole != 0, whole, 1.0), 0.0)


def _coverage(batches):
    """Adds coverage (percent of region that quad covers) to rows of (region, quad)."""
    for batch in batches:
        r, q = (_polygons(batch.column(batch.schema.get_field_index(c))) for c in ("region", "quad"))
        values = _percent(np.abs(_areas(*_intersections(*r, *q))), np.abs(_areas(*_intersections(*r, *r))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, "coverage"])


def _with_type(df: DataFrame, more: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", " + more


def candidates(regions: DataFrame, cells: DataFrame, radius: float = SEARCH_RADIUS) -> DataFrame:
    """regions: name, side, region (four (ra, dec)); cells: name, quad. The cells that cover part of a region, with coverage and distance of centres.

    Centres are met by buckets of the radius's size in declination and right ascension, so the join has a key; a cell is
    copied to every bucket that a circle of the radius around its centre touches."""
    from ..functions.wcs import separation

    mean = lambda c, f: F.aggregate(F.transform(c, lambda p: p[f]), F.lit(0.0), lambda a, v: a + v) / 4
    r = regions.select("name", "side", "region", mean("region", "ra").alias("ra"), mean("region", "dec").alias("dec"))
    c = cells.select(F.col("name").alias("cell"), "quad", mean("quad", "ra").alias("cra"), mean("quad", "dec").alias("cdec"))
    size = radius * 1.0000001
    c = c.withColumn("band", F.explode(F.array(*(F.floor(F.col("cdec") / size) + i for i in (-1, 0, 1)))))
    per = F.greatest(F.lit(1.0), F.floor(360.0 / size * F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs(F.col("band") * size), F.abs((F.col("band") + 1) * size)))))))
    polar = F.abs(F.col("cdec")) + size >= 90
    reach = F.when(polar, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(size))) / F.cos(F.radians("cdec"))))) + 1e-6)
    at = lambda ra: F.floor(ra / 360.0 * per).cast("long")
    touched = F.sequence(at(F.col("cra") - reach), at(F.col("cra") + reach))
    c = c.withColumn("bucket", F.explode(F.array_distinct(F.transform(touched, lambda i: F.pmod(i, per.cast("long"))))))
    r = r.withColumn("band", F.floor(F.col("dec") / size))
    r = r.withColumn("bucket", F.pmod(at(F.col("ra")), per.cast("long")))
    near = r.join(c, ["band", "bucket"]).where(F.col("name") != F.col("cell"))
    near = near.withColumn("distance", separation("ra", "dec", "cra", "cdec")).where(F.col("distance") < radius).select("name", "side", "region", "cell", "quad", "distance")
    ship(near.sparkSession)
    return near.mapInArrow(_coverage, _with_type(near, "coverage double")).where("coverage > 0")


def _area(p: list) -> float:
    return sum(p[i - 1][0] * p[i][1] - p[i][0] * p[i - 1][1] for i in range(len(p))) / 2


def _intersection(subject: list, clip: list) -> list:
    if _area(clip) < 0:
        clip = clip[::-1]
    out = list(subject)
    for i in range(len(clip)):
        (ax, ay), (bx, by) = clip[i - 1], clip[i]
        given, out = out, []
        for j in range(len(given)):
            p, q = given[j - 1], given[j]
            sp, sq = ((bx - ax) * (v[1] - ay) - (by - ay) * (v[0] - ax) for v in (p, q))
            if (sp >= 0) != (sq >= 0):
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            if sq >= 0:
                out.append(q)
    return out


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of different places of each run, the lower first."""
    after = np.concatenate([np.zeros(0, np.int64), *(np.arange(n - 1, -1, -1) for n in sizes.tolist())])
    first = np.repeat(np.concatenate([np.zeros(0, np.int64), *(np.arange(a, a + n) for a, n in zip(starts.tolist(), sizes.tolist()))]), after)
    ends = np.cumsum(after)
    return first, first + 1 + np.arange(len(first)) - np.repeat(ends - after, after)


def _best_pairs(region, quad, starts, sizes, distance, other) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions by number whose full union two of their candidates have, with the pair of least mean distance, then lowest places. other: a number for each candidate, the same where they have one name.

    A union is never more than the sum of both, so only pairs whose sum is enough are clipped, in the order asked for and no further than the first that is enough."""
    of = np.repeat(np.arange(len(starts)), sizes)
    at = np.concatenate([np.zeros(0, np.int64), *(np.arange(a, a + n) for a, n in zip(starts.tolist(), sizes.tolist()))])
    own = tuple(a[..., of] for a in region)
    cut = _intersections(*own, *(a[..., at] for a in quad))
    part, whole = np.abs(_areas(*cut)), np.abs(_areas(*_intersections(*region, *region)))
    i, j = _pairs(np.cumsum(sizes) - sizes, sizes)
    enough = (_percent(part[i] + part[j], whole[of[i]]) >= FULL_COVERAGE) & (other[at[i]] != other[at[j]])
    i, j = i[enough], j[enough]
    order = np.lexsort((j, i, (distance[at[i]] + distance[at[j]]) / 2, of[i]))
    i, j = i[order], j[order]
    group = of[i]
    rank = np.arange(len(i)) - np.searchsorted(group, group)
    best, low, high = np.full(len(starts), -1), 0, 4
    while True:
        left = np.flatnonzero((rank >= low) & (best[group] < 0))
        if not len(left):
            break
        left = left[rank[left] < high]
        for a in range(0, len(left), CLIPPED):
            n = left[a : a + CLIPPED]
            both = np.abs(_areas(*_intersections(*(v[..., i[n]] for v in cut), *(v[..., at[j[n]]] for v in quad))))
            full = n[_percent(part[i[n]] + part[j[n]] - both, whole[group[n]]) >= FULL_COVERAGE]
            full = full[best[group[full]] < 0]
            hit, first = np.unique(group[full], return_index=True)
            best[hit] = full[first]
        low, high = high, high * 4
    done = np.flatnonzero(best >= 0)
    return done, at[i[best[done]]], at[j[best[done]]]


#: Pairs that are clipped together, and those that are held together.
CLIPPED, HELD = 1 << 14, 1 << 20
BEST = "name string, side string, status string, pad_cell string, coverage double"


def _best(batches):
    """Of rows (name, side, region, found: a list of (cell, distance, coverage, quad) by cell), the choice of each."""
    for batch in batches:
        region, found = _polygons(batch.column(2)), batch.column(3)
        each, starts = found.flatten(), found.offsets.to_numpy() - found.offsets[0].as_py()
        starts, sizes = starts[:-1].astype(np.int64), np.diff(starts).astype(np.int64)
        cell, distance, coverage = each.field("cell"), each.field("distance").to_numpy(), each.field("coverage").to_numpy()
        quad, of = _polygons(each.field("quad")), np.repeat(np.arange(len(sizes)), sizes)
        single = np.lexsort((np.arange(len(of)), distance, -coverage, of))[starts]
        best = coverage[single]
        pad, status = cell.take(pa.array(single)), np.where(best >= FULL_COVERAGE, "full_coverage", "partial_coverage").astype(object)
        open_ = np.flatnonzero(best < FULL_COVERAGE)
        other = cell.dictionary_encode().indices.to_numpy()
        groups = np.cumsum(sizes[open_] ** 2) // (2 * HELD)
        first, second = np.full(len(sizes), -1), np.full(len(sizes), -1)
        for g in np.unique(groups):
            own = open_[groups == g]
            done, i, j = _best_pairs(tuple(v[..., own] for v in region), quad, starts[own], sizes[own], distance, other)
            first[own[done]], second[own[done]] = i, j
        pairs = np.flatnonzero(first >= 0)
        status[pairs] = "combined_coverage"
        both = pc.binary_join_element_wise(cell.take(pa.array(first[pairs])), cell.take(pa.array(second[pairs])), "/")
        pad = pc.replace_with_mask(pad, pa.array(first >= 0), both)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(status, pa.string()), pad, pa.array(best)], names=["name", "side", "status", "pad_cell", "coverage"])


def best_padding(found: DataFrame) -> DataFrame:
    """name, side, status and padding cell: one full cover, else the pair with full union and least mean distance, else the best single one."""
    lists = F.sort_array(F.collect_list(F.struct("cell", "distance", "coverage", "quad"))).alias("found")
    ship(found.sparkSession)
    return found.groupBy("name", "side").agg(F.first("region").alias("region"), lists).mapInArrow(_best, BEST)


def row_positions(cells: DataFrame) -> DataFrame:
    """Each cell's place in its row and its row's place in the projection."""
    row, proj = Window.partitionBy("projection", "y"), Window.partitionBy("projection")
    number = F.row_number().over(row.orderBy("x"))
    at = F.when(number == 1, "first").when(number == F.count("*").over(row), "last").otherwise("interior")
    level = F.when(F.col("y") == F.min("y").over(proj), "bottom").when(F.col("y") == F.max("y").over(proj), "top").otherwise("middle")
    rows = F.dense_rank().over(proj.orderBy("y")) - 1
    return cells.select("name", "projection", "y", "x", at.alias("cell_position"), level.alias("row_position"), (number - 1).alias("cell_index"), rows.alias("row_index"))


def padding_pairs(padding: DataFrame) -> DataFrame:
    """One row a listed padding cell: name, side, pad_cell, rank."""
    sides = F.array(*(F.lit(s) for s, _, _ in SIDES))
    rows = padding.select("name", F.element_at(sides, F.col("dir") + 1).alias("side"), F.posexplode(padding_names("pad_skycell")).alias("rank", "pad_cell"))
    return rows.distinct()


def requirements(pairs: DataFrame, positions: DataFrame) -> DataFrame:
    """Pairs across projections whose side lies on the matching rim of the projection."""
    from ..functions.names import cell_projection

    r = pairs.join(positions, "name").where(cell_projection("pad_cell") != F.col("projection"))
    need = lambda word, ok: ~F.col("side").contains(word) | ok
    return r.where(
        need("top", F.col("row_position") == "top") & need("bottom", F.col("row_position") == "bottom")
        & need("left", F.col("cell_position") == "first") & need("right", F.col("cell_position") == "last")
    )


def jobs(current: DataFrame, following: DataFrame) -> DataFrame:
    """One load for each padding cell that the current row, the next, or both want, with the targets."""
    tagged = current.select("pad_cell", F.lit("current").alias("target"), "name", "side").unionByName(following.select("pad_cell", F.lit("next").alias("target"), "name", "side"))
    return tagged.groupBy("pad_cell").agg(F.sort_array(F.collect_set("target")).alias("targets"), F.count("*").alias("n_uses"))


def attach(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """The cell list with a column a side, empty where nothing pads."""
    wide = pairs.groupBy("name").pivot("side", [s for s, _, _ in SIDES]).agg(F.concat_ws("/", F.array_sort(F.collect_set("pad_cell"))))
    wide = wide.select("name", *(F.col(s).alias(f"pad_skycell_{s}") for s, _, _ in SIDES))
    return cells.join(wide, "name", "left").fillna("", [f"pad_skycell_{s}" for s, _, _ in SIDES])


def all_padding_cells(pairs: DataFrame) -> DataFrame:
    """Per cell, its padding cells without itself, in order."""
    return pairs.where(F.col("pad_cell") != F.col("name")).groupBy("name").agg(F.array_sort(F.collect_set("pad_cell")).alias("pads"))
