"""The run from a catalogue, a frame and the survey's pixels to templates, in stages that can be taken up again.

Each stage writes its tables as one version of its store. A version's name is a digest of the stage's parameters and of the
versions that it read, and the version appears under its name only when it is whole; so a run does just those stages
whose version isn't there: none the second time, only the last when offsets' masks change, all after a new catalogue.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FOOTPRINT_BUFFER, IGNORE_BITS, PSF_RADIUS, PSF_SIGMA
from ..functions import wcs
from ..operators import combine, downsample, mapping, row_step, rows
from ..sources import store
from ..sources.work import cut


@dataclass
class Setting:
    """Parameters of a run. frame: world coordinates of the frame, width x height pixels; inset: a cell's rim by its place in the grid (see wcs.inset_corners)."""

    frame: dict
    width: int
    height: int
    geometry: row_step.Geometry
    inset: tuple[int, int, int] | None = None
    buffer: int = FOOTPRINT_BUFFER
    sigma: float = PSF_SIGMA
    radius: int = PSF_RADIUS
    ignore_bits: tuple[int, ...] = IGNORE_BITS
    roi: tuple[int, int, int, int, int] | None = None
    buckets: int = 200
    versions: dict[str, str] = field(default_factory=dict)


class Stage(NamedTuple):
    """What a stage left: its store's version and tables, and whether this run computed it."""

    name: str
    version: str
    tables: dict[str, DataFrame]
    computed: bool


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order; one scan. Equal rows count, as their hashes are added up."""
    flat = [F.to_json(c) if df.schema[c].dataType.typeName() in ("map", "variant") else F.col(c) for c in df.columns]
    n, total = df.agg(F.count("*"), F.sum(F.xxhash64(*flat).cast("decimal(20,0)"))).first()
    return hashlib.sha256(f"{df.schema.simpleString()} {n} {total}".encode()).hexdigest()[:16]


class Run:
    """Stages below a folder that all machines share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.done = spark, root, []

    def stage(self, name: str, parameters: dict, inputs: dict[str, str], make) -> Stage:
        """The tables of a stage: read if its version is there, else made by make() and committed. inputs: versions of what it reads."""
        known = json.dumps({"stage": name, "parameters": parameters, "inputs": inputs}, sort_keys=True, default=repr)
        version = hashlib.sha256(known.encode()).hexdigest()[:16]
        path = f"{self.root}/{name}/{version}"
        computed = not store.exists(self.spark, path)
        if computed:
            tables = make()
            manifest = self.spark.createDataFrame([(name, version, known, sorted(tables))], "stage string, version string, made_of string, tables array<string>")
            store.commit({**tables, "manifest": manifest.coalesce(1)}, f"{self.root}/{name}", version)
        listed = self.spark.read.parquet(f"{path}/manifest").first()["tables"]
        out = Stage(name, version, {t: self.spark.read.parquet(f"{path}/{t}") for t in listed}, computed)
        self.done.append(out)
        return out


def _map(cells: DataFrame, offsets: DataFrame, s: Setting) -> dict[str, DataFrame]:
    """The cells under the frame with their places, the cell pixels of each frame pixel, and whole shifts for each offset."""
    near = mapping.cells_in_footprint(cells, s.frame, s.width, s.height, s.buffer)
    owner = mapping.frame_mapping(cells, s.frame, s.width, s.height, buffer=s.buffer, ring=s.inset and wcs.inset_corners(*s.inset))
    used = cut(near.join(owner.select("cell_id").distinct(), "cell_id", "left_semi"), "used")
    first = used.groupBy("projection").agg(F.min("x").alias("first"))
    placed = used.join(first, "projection").select("cell_id", "projection", F.col("y").alias("row"), (F.col("x") - F.col("first")).alias("k"))
    shifts = downsample.whole_shifts(mapping.cell_shifts(used, offsets, s.frame))
    assigned = mapping.cell_assignment(cells, owner.select("cell_id", "pix"), s.frame, 1, s.width, s.geometry.height)
    return {"cells": placed, "owner": owner, "assignment": assigned, "shifts": shifts}


def _combine(pixels: DataFrame, cells: DataFrame, s: Setting) -> dict[str, DataFrame]:
    own = combine.combine_bands(pixels.join(cells.select("cell_id"), "cell_id", "left_semi"))
    made = rows.rasters(own, ["cell_id"], s.geometry.height, s.geometry.width, {"value": float("nan"), "mask": 0.0})
    return {"rasters": made.select("cell_id", "h", "w", F.col("value").alias("data"), F.col("mask").cast("array<int>").alias("mask"))}


def _smooth(rasters: DataFrame, cells: DataFrame, needs: DataFrame | None, headers: DataFrame, s: Setting) -> dict[str, DataFrame]:
    stored = row_step.store_rasters(rasters.drop("mask"), cells, s.buckets)
    jobs = None
    if needs is not None:
        jobs = row_step.padding_jobs(headers.drop("row", "k", "projection").join(cells, "cell_id"), needs, s.geometry)
    smooth = row_step.row_step(stored, s.geometry, jobs, s.sigma, s.radius)
    return {"rasters": smooth.join(rasters.select("cell_id", "mask"), "cell_id")}


def _template(mapped: dict[str, DataFrame], rasters: DataFrame, s: Setting) -> dict[str, DataFrame]:
    at = rasters.select("cell_id", "w", F.posexplode(F.arrays_zip("data", "mask")).alias("at", "p"))
    image = at.select("cell_id", F.floor(F.col("at") / F.col("w")).cast("int").alias("y"), (F.col("at") % F.col("w")).alias("x"), F.col("p.data").alias("value"), F.col("p.mask").alias("mask"))
    sums = downsample.template(mapped["assignment"], image, mapped["shifts"], s.ignore_bits, roi=s.roi, height=s.geometry.height, width=s.geometry.width)
    return {"template": downsample.averages(sums)}


def survey_run(spark: SparkSession, root: str, cells: DataFrame, pixels: DataFrame, offsets: DataFrame, setting: Setting, needs: DataFrame | None = None) -> list[Stage]:
    """mapping, combined, smoothed and template, each done only if its version isn't below root yet.

    cells: cell_id, projection, y, x and headers; pixels: cell_id, y, x, band, value, weight, mask; offsets: offset_id, dx, dy in
    frame pixels; needs: padding of other projections (see row_step.padding_jobs). setting.versions names the inputs' versions;
    for one that it doesn't name, a digest of all rows is taken."""
    s, run = setting, Run(spark, root)
    given = {"cells": cells, "pixels": pixels, "offsets": offsets} | ({} if needs is None else {"needs": needs})
    v = {name: s.versions.get(name) or fingerprint(df) for name, df in given.items()}
    mapped = run.stage("mapping", {"frame": repr(s.frame), "size": (s.width, s.height), "inset": s.inset, "buffer": s.buffer, "raster": s.geometry.height}, {n: v[n] for n in ("cells", "offsets")}, lambda: _map(cells, offsets, s))
    combined = run.stage("combined", {"size": s.geometry[:2]}, {"pixels": v["pixels"], "mapping": mapped.version}, lambda: _combine(pixels, mapped.tables["cells"], s))
    smoothed = run.stage("smoothed", {"geometry": s.geometry, "sigma": s.sigma, "radius": s.radius}, {"combined": combined.version, "mapping": mapped.version} | {n: v[n] for n in v if n == "needs"}, lambda: _smooth(combined.tables["rasters"], mapped.tables["cells"], needs, cells, s))
    run.stage("template", {"bits": s.ignore_bits, "roi": s.roi}, {"smoothed": smoothed.version, "mapping": mapped.version}, lambda: _template(mapped.tables, smoothed.tables["rasters"], s))
    return run.done
