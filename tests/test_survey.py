"""The staged run: what is computed again after a change, and what a failure leaves."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from skyloom.plans import registry, survey, survey_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return survey_queries._inputs(lambda n: registry.relation(spark, SF, n))


def computed(stages):
    return [s.name for s in stages if s.computed]


def rows(stages):
    return {(r.offset_id, r.pix): (round(r.flux, 9), r["count"]) for r in stages[-1].tables["template"].collect()}


def test_only_what_changed_is_computed(spark, inputs, tmp_path):
    root = f"file://{tmp_path}/run"
    names = {"cells": "c1", "pixels": "p1", "offsets": "o1"}
    s = dataclasses.replace(survey_queries._setting(), versions=names)
    first = survey.survey_run(spark, root, *inputs, s)
    assert computed(first) == ["mapping", "combined", "smoothed", "template"]
    assert [sorted(x.tables) for x in first] == [["assignment", "cells", "owner", "shifts"], ["rasters"], ["rasters"], ["template"]]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "run").rglob("*") if p.is_file()}
    again = survey.survey_run(spark, root, *inputs, s)
    assert computed(again) == [] and rows(again) == rows(first)
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "run").rglob("*") if p.is_file()}
    masks = survey.survey_run(spark, root, *inputs, dataclasses.replace(s, ignore_bits=(3,)))
    assert computed(masks) == ["template"] and rows(masks) != rows(first)
    part = survey.survey_run(spark, root, *inputs, dataclasses.replace(s, roi=(0, 5, 0, 64, 64)))
    assert computed(part) == ["template"]
    assert rows(part) == {k: v for k, v in rows(first).items() if k[1] % 64 < 5} and rows(part)
    sharp = survey.survey_run(spark, root, *inputs, dataclasses.replace(s, sigma=1.0))
    assert computed(sharp) == ["smoothed", "template"]
    cells, pixels, offsets = inputs
    brighter = survey.survey_run(spark, root, cells, pixels.withColumn("value", F.col("value") + 1), offsets, dataclasses.replace(s, versions=names | {"pixels": "p2"}))
    assert computed(brighter) == ["combined", "smoothed", "template"] and rows(brighter) != rows(first)


def test_a_failed_stage_leaves_the_ones_before(spark, inputs, tmp_path):
    root = f"file://{tmp_path}/run"
    cells, pixels, offsets = inputs
    s = dataclasses.replace(survey_queries._setting(), versions={"cells": "c1", "pixels": "p1", "offsets": "o1"})
    broken = pixels.withColumn("value", F.when(F.col("cell_id") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        survey.survey_run(spark, root, cells, broken, offsets, s)
    assert not [x for x in (tmp_path / "run").glob("combined/*") if not x.name.startswith(".")]
    assert computed(survey.survey_run(spark, root, cells, pixels, offsets, s)) == ["combined", "smoothed", "template"]


def test_digests_of_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    assert survey.fingerprint(df) == survey.fingerprint(df.orderBy(F.desc("k")))
    assert len({survey.fingerprint(x) for x in (df, df.distinct(), df.limit(0), df.withColumn("k", F.col("k") + 1), df.withColumn("m", F.create_map("k", "v")))}) == 5


def test_padding_of_other_projections_changes_the_cells_that_need_it(spark, inputs):
    cells, pixels, offsets = inputs
    s = survey_queries._setting()
    ids = [r.cell_id for r in cells.orderBy("cell_id").limit(5).collect()]
    # five places in a row, the first two of one projection and the others of the next
    placed = spark.createDataFrame([(c, int(k > 1), 0, k) for k, c in enumerate(ids)], "cell_id int, projection int, row int, k int")
    headers = cells.drop("crpix1", "crpix2", "crval1", "crval2").join(placed.select("cell_id", "row", "k", "projection").withColumnRenamed("projection", "p"), "cell_id")
    headers = headers.withColumn("crval1", F.lit(30.0)).withColumn("crval2", F.lit(-20.0)).withColumn("crpix1", 40.5 + 0.37 * F.col("p") - 24.0 * F.col("k")).withColumn("crpix2", 40.5 - 0.21 * F.col("p") - 24.0 * F.col("row")).drop("p", "row", "k")
    needs = spark.createDataFrame([(ids[1], "right", ids[2])], "cell_id int, side string, source int")
    rasters = survey._combine(pixels, placed, s)["rasters"]
    plain, padded = ({r.cell_id: r.data for r in survey._smooth(rasters, placed, n, headers, s)["rasters"].collect()} for n in (None, needs))
    changed = {c for c in plain if any(a != b and not (a != a and b != b) for a, b in zip(plain[c], padded[c]))}
    assert changed == {ids[1]}
