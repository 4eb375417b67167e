"""Names, paths and small text formats, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import SIDES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cell_projection(name) -> Column:
    """Projection of `skycell.<projection>.<0yx>`; null if it isn't a number or the name is short."""
    return F.try_element_at(F.split(_col(name), r"\."), F.lit(2)).try_cast("int")


def cell_digits(name) -> Column:
    return F.try_element_at(F.split(_col(name), r"\."), F.lit(3))


def cell_y(name) -> Column:
    return F.substring(cell_digits(name), 2, 1).try_cast("int")


def cell_x(name) -> Column:
    return F.substring(cell_digits(name), 3, 1).try_cast("int")


def first_number_part(name) -> Column:
    """The first part that has digits only."""
    return F.try_element_at(F.filter(F.split(_col(name), r"\."), lambda p: p.rlike("^[0-9]+$")), F.lit(1))


def cell_name(projection, y, x) -> Column:
    return F.format_string("skycell.%d.0%d%d", _col(projection), _col(y), _col(x))


def cell_in_path(path) -> Column:
    return F.regexp_extract(_col(path), r"(skycell\.\d+\.\d+)", 1)


def variant_in_path(path) -> Column:
    return F.regexp_extract(_col(path), r"skycell\.\d+\.\d+_([a-zA-Z0-9_]+)", 1)


def band_file(name, band: str | Column, kind: str = "image") -> Column:
    """File name of a band's image, mask or weight; band: its name or a column of names."""
    end = {"image": "unconv.fits", "mask": "unconv.mask.fits", "weight": "unconv.wt.fits"}[kind]
    return F.concat(F.lit("rings.v3."), _col(name), F.lit(".stk."), F.lit(band) if isinstance(band, str) else band, F.lit(f".{end}"))


def store_path(sector, camera, ccd) -> Column:
    return F.format_string("sector_%04d_camera_%d_ccd_%d.zarr", _col(sector), _col(camera), _col(ccd))


def catalogue_path(sector, camera, ccd) -> Column:
    return F.format_string("sector_%04d/camera_%d/ccd_%d/tess_s%04d_%d_%d_master_skycells_list.csv", *map(_col, (sector, camera, ccd, sector, camera, ccd)))


def frame_file_parts(path) -> Column:
    """sector, camera and ccd of a frame file's name `...-s0020-3-3-...`."""
    parts = F.split(F.element_at(F.split(_col(path), "/"), -1), "-")
    number = lambda i: F.try_element_at(parts, F.lit(i))
    return F.struct(F.substring(number(2), 2, 9).try_cast("int").alias("sector"), number(3).try_cast("int").alias("camera"), number(4).try_cast("int").alias("ccd"))


def offset_pairs(text) -> Column:
    """(dx, dy) pairs of a comma list; an odd number of values is an error."""
    values = F.transform(F.split(_col(text), ","), lambda v: F.trim(v).cast("double"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size(values) / 2).cast("int") - 1), lambda i: F.struct(values[2 * i].alias("dx"), values[2 * i + 1].alias("dy")))
    return F.when(F.size(values) % 2 == 0, pairs).otherwise(F.raise_error(F.lit("offsets come in pairs")))


def padding_names(text) -> Column:
    """Names of a list with slashes or commas; null and empty give none."""
    parts = F.transform(F.split(F.coalesce(_col(text), F.lit("")), "[/,]"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def flag_list(text) -> Column:
    """Eight booleans from a printed list; eight times false if it isn't one."""
    flags = F.from_json(F.lower(_col(text)), "array<boolean>")
    return F.when(F.size(flags) == 8, flags).otherwise(F.array(*[F.lit(False)] * 8))


def flags_to_struct(flags) -> Column:
    return F.struct(*(_col(flags)[i].alias(side) for i, (side, _, _) in enumerate(SIDES)))


def any_flag(flags) -> Column:
    return F.exists(_col(flags), lambda x: x)


def coefficient_order(key) -> Column:
    """n + m of a key `A_n_m` or `B_n_m`; null for other keys."""
    k = _col(key)
    return F.when(k.rlike(r"^[AB]_\d+_\d+$"), F.regexp_extract(k, r"^[AB]_(\d+)_(\d+)$", 1).cast("int") + F.regexp_extract(k, r"^[AB]_(\d+)_(\d+)$", 2).cast("int"))


def select_header(header, keys: list[str], pattern: str) -> Column:
    """The entries of a header map whose key is listed or matches."""
    return F.map_filter(_col(header), lambda k, v: k.isin(*keys) | k.rlike(pattern))
