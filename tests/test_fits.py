"""The FITS source: what it reads, what it leaves, and tile compression."""

import gzip
import io
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.sources import fits, store, tiled

SKY = {"CTYPE1": "RA---TAN", "CTYPE2": "DEC--TAN", "CRVAL1": 1.5, "CRVAL2": 2.0}


class Counting(io.BytesIO):
    """A file that knows how many bytes were read."""

    total = 0

    def read(self, n=-1):
        out = super().read(n)
        self.total += len(out)
        return out


def test_headers_are_read_without_data():
    a = np.arange(2_000_000, dtype=np.float32).reshape(1000, 2000)
    f = Counting(fits.file_bytes([({}, None), (SKY, a), ({"EXTNAME": "END"}, a[:3])]))
    got = [b.to_pylist()[0] for b in fits.rows_of(f, "p", fits.Wanted(("hdu", "extname", "height", "width")))]
    assert [(r["hdu"], r["extname"], r["height"], r["width"]) for r in got] == [(0, None, 0, 0), (1, None, 1000, 2000), (2, "END", 3, 2000)]
    assert f.total < 10 * fits.BLOCK
    f.total = 0
    f.seek(0)
    (last,) = fits.rows_of(f, "p", fits.Wanted(("data",), chunk=4096, only=(("extname", frozenset(["END"])),)))
    assert last.to_pylist()[0]["data"] == a[:3].ravel().tolist() and f.total < 100_000


@pytest.mark.parametrize("rice", [False, True])
def test_chunks_make_up_the_image(rice):
    a = np.random.default_rng(1).integers(-300, 300, (70, 45)).astype(np.int16)
    out = np.full(a.shape, np.nan)
    for b in fits.rows_of(io.BytesIO(fits.file_bytes([({}, None), ({"BSCALE": 0.5, "BZERO": 3.0, "BLANK": 7}, a)], rice)), "p", fits.Wanted(rule="second", chunk=16)):
        (r,) = b.to_pylist()
        assert (r["height"], r["width"], dict(r["header"])["NAXIS1"]) == (70, 45, "45")
        out[r["y0"] : r["y0"] + r["h"], r["x0"] : r["x0"] + r["w"]] = np.array(r["data"]).reshape(r["h"], r["w"])
    assert np.array_equal(out, np.where(a == 7, np.nan, a * 0.5 + 3.0), equal_nan=True)


def test_rules_filters_and_broken_files(spark, tmp_path):
    fits.register(spark)
    a = np.arange(6, dtype=np.int32).reshape(2, 3)
    fits.write_image(str(tmp_path / "plain.fits"), [({"CCD": 1}, a)])
    fits.write_image(str(tmp_path / "two.fits"), [({}, a), ({"EXTNAME": "X"} | SKY, a + 1)], rice=True)
    fits.write_image(str(tmp_path / "none.fits.gz"), [({}, None)])
    (tmp_path / "cut.fits").write_bytes((tmp_path / "two.fits").read_bytes()[:-2880])
    load = lambda **o: spark.read.format("fits").options(**o).load(str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r for r in load(hdu="second", errors="row").collect()}
    assert got["plain.fits"].hdu == 0 and got["plain.fits"].data == a.ravel().tolist() and got["two.fits"].data == (a + 1).ravel().tolist()
    assert got["none.fits.gz"].data is None and got["none.fits.gz"].error is None and got["cut.fits"].error and got["cut.fits"].hdu is None
    with pytest.raises(Exception, match="cut.fits|buffer|size|tile"):
        load(hdu="second").collect()
    some = load(errors="row").where("hdu = 1 and extname = 'X' and path like '%two.fits'")
    assert [(r.hdu, r.data) for r in some.collect()] == [(1, (a + 1).ravel().tolist())]
    assert " = 1" not in some._jdf.queryExecution().executedPlan().toString()  # the source has taken the filter over
    whole = fits.from_files(spark.read.format("binaryFile").load(str(tmp_path / "two.fits")), fits.Wanted(("path", "data"), "image"), ("length",)).collect()
    assert [r.data for r in whole] == [(a + 1).ravel().tolist()] and whole[0].length == (tmp_path / "two.fits").stat().st_size


def _headers(content, **o):
    return [(b.column(0)[0].as_py(), b.column(1)[0].as_py()) for b in fits.file_rows("p.fits", fits.Wanted(("hdu", "error"), **o), content)]


@pytest.mark.parametrize("packed", [False, True])
def test_a_file_that_lost_a_part_is_no_file_with_less(packed):
    a = np.arange(6, dtype=np.int32).reshape(2, 3)
    whole = fits.file_bytes([({}, None), (SKY, a), ({"EXTNAME": "X"}, a)])
    own = gzip.compress if packed else bytes
    assert [h for h, _ in _headers(own(whole))] == [0, 1, 2] == [h for h, _ in _headers(own(whole + bytes(9 * fits.BLOCK)))]
    assert len(_headers(own(whole[: 4 * fits.BLOCK + 24]))) == 3  # the last block need not be filled up
    cut = [b"", b"none of it", b"\0" * len(whole), whole[: fits.BLOCK + 80], whole[: 2 * fits.BLOCK + 23], whole[: 4 * fits.BLOCK]]
    cut += [whole[: 3 * fits.BLOCK] + bytes(2 * fits.BLOCK) + whole, whole + bytes(10 * fits.BLOCK), whole.replace(b"END".ljust(80), b" " * 80)]
    for content in cut:
        with pytest.raises(ValueError, match="p.fits can't be read"):
            _headers(own(content))
        (row,) = _headers(own(content), tolerant=True)
        assert row[0] is None and row[1]
        with pytest.raises(ValueError, match="p.fits can't be read"):
            _headers(own(content), tolerant=True, only=(("hdu", frozenset([0])),))
    if packed:
        with pytest.raises(ValueError, match="p.fits can't be read"):
            _headers(own(whole)[:-20])
    torn = fits.file_bytes([({}, a), (SKY, a)], rice=True)
    torn = torn.replace(b"'RICE_1  '", b"'NONE    '")
    got = [b.to_pylist()[0] for b in fits.file_rows("p.fits", fits.Wanted(("hdu", "data", "error"), tolerant=True), own(torn))]
    assert [(r["hdu"], r["data"], bool(r["error"])) for r in got] == [(None, None, True)]  # not its first image as well


def test_failures_of_the_store_are_no_rows(spark, tmp_path):
    fits.register(spark)
    with pytest.raises(OSError):
        list(fits.file_rows(str(tmp_path / "gone.fits"), fits.Wanted(tolerant=True)))
    with pytest.raises(Exception, match="gone"):
        spark.read.format("fits").load(str(tmp_path / "gone")).collect()
    with pytest.raises(Exception, match="needs the field error"):
        spark.read.format("fits").schema("path string, hdu int").option("errors", "row").load(str(tmp_path)).collect()
    none = spark.createDataFrame([], "key string, h int, w int, data array<double>")
    none.write.format("fits").mode("append").save(str(tmp_path / "none"))
    assert spark.read.format("fits").load(str(tmp_path / "none")).count() == 0


def test_headers_of_a_broken_frame_are_not_left_out(spark, monkeypatch):
    from skyloom.plans import registry, stores

    whole = stores._frame_files

    def broken(r):
        path = whole(r)
        one = next(Path(path.removeprefix("file://")).rglob("*_ffic.fits"))
        one.write_bytes(one.read_bytes()[:3000])
        return path

    monkeypatch.setattr(stores, "_frame_files", broken)
    with pytest.raises(Exception, match="can't be read"):
        registry.queries()["frame_headers"](spark, "/root/testdata/sf0.001").collect()


def test_small_files_share_tasks_and_batches(spark, tmp_path):
    fits.register(spark)
    for i in range(40):
        fits.write_image(str(tmp_path / f"f{i:02d}.fits"), [({"CCD": i}, np.full((2, 3), i, np.int32))])
    df = spark.read.format("fits").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 8
    assert sorted((r.path[-6:-5], r.data) for r in df.collect()) == sorted((str(i % 10), [float(i)] * 6) for i in range(40))
    files = [(f"p{i}", size) for i, size in enumerate([5 << 20] * 2000 + [90 << 20] * 3)]
    dealt = fits.packed(files)
    sizes = dict(files)
    assert [f for d in dealt for f in d] == [f for f, _ in files] and all(len(d) == 1 or sum(sizes[f] for f in d) <= fits.TASK_BYTES for d in dealt)
    assert len(dealt) == 2000 // 12 + 1 + 3 and len(fits.packed([(str(i), 0) for i in range(100_000)])) == -(-100_000 // fits.TASK_FILES)
    one = list(fits.rows_of(io.BytesIO(fits.file_bytes([({}, np.zeros((300, 3), np.int32))])), "p", fits.Wanted(chunk=1)))
    merged = list(fits.together(iter(one)))
    assert len(one) == 900 and [len(b) for b in merged] == [256, 256, 256, 132] and [r for b in merged for r in b.to_pylist()] == [r for b in one for r in b.to_pylist()]


def test_one_write_of_tiles_and_plain_images(spark, tmp_path):
    """A column says of each row whether its image becomes tiles, so that files of both kinds, in several folders, are one write."""
    fits.register(spark)
    rows = [("near/a", {"BITPIX": "32"}, 1, 2, [1.0, 2.0], True), ("far/b", None, 1, 2, [0.5, 2.5], False)]
    df = spark.createDataFrame(rows, "key string, header map<string,string>, h int, w int, data array<double>, rice boolean")
    df.write.format("fits").mode("append").save(str(tmp_path))
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.fits*")) == ["far/b.fits", "near/a.fits.fz"]
    got = spark.read.format("fits").option("hdu", "second").load(str(tmp_path)).collect()
    assert sorted(r.data for r in got) == [[0.5, 2.5], [1.0, 2.0]]


@settings(max_examples=150, deadline=None)
@given(st.sampled_from([np.uint8, np.int16, np.int32]), st.integers(1, 90), st.integers(1, 5), st.sampled_from(["any", "small", "spikes", "same"]), st.integers(0, 10**6))
def test_rice_tiles_read_back(kind, n, t, how, seed):
    r, i = np.random.default_rng(seed), np.iinfo(kind)
    a = {"any": r.integers(i.min, i.max, (t, n), endpoint=True), "small": r.normal(40, 4, (t, n)), "spikes": np.where(r.random((t, n)) < 0.05, i.max, 3), "same": np.full((t, n), i.max)}[how].astype(kind)
    assert np.array_equal(tiled.rice_decode(tiled.rice_encode(a), n, a.dtype.itemsize), a)


def test_rice_bits_of_the_standard():
    # one block of int16: first value 10, then code 3 (two low bits) and the mapped differences 0 2 1 7
    bits = f"{10:016b}" + "0011" + "100" + "110" + "101" + "0111"
    tile = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiled.rice_decode([tile], 4, 2).tolist() == [[10, 11, 10, 6]]


@pytest.mark.parametrize("how", ["NO_DITHER", "SUBTRACTIVE_DITHER_1", "SUBTRACTIVE_DITHER_2"])
@pytest.mark.parametrize("kind", ["RICE_1", "GZIP_1"])
def test_quantised_floats(how, kind):
    r = np.random.default_rng(3)
    a = r.normal(100, 5, (6, 20))
    a[1, 3], a[2, 4] = np.nan, 0.0
    scale, zero = 0.01, 90.0
    rows, heap, at = b"", b"", 0
    for y in range(6):
        less = tiled.dither(y, 20, 77) if how != "NO_DITHER" else 0
        q = np.rint((np.nan_to_num(a[y]) - zero) / scale + less)
        q = np.where(np.isnan(a[y]), tiled.MISSING, np.where((a[y] == 0) & (how == "SUBTRACTIVE_DITHER_2"), tiled.ZERO, q)).astype(np.int32)
        part = b"" if y == 5 else tiled.rice_encode(q[None])[0] if kind == "RICE_1" else gzip.compress(q.astype(">i4").tobytes())
        raw = gzip.compress(a[y].astype(">f4").tobytes()) if y == 5 else b""  # a tile that was not quantised
        rows += np.array([len(part), at], ">i4").tobytes() + np.array([len(raw), at + len(part)], ">i4").tobytes() + np.array([scale, zero], ">f8").tobytes()
        heap += part + raw
        at = len(heap)
    cards = {"NAXIS1": "32", "NAXIS2": "6", "TFIELDS": "4", "TTYPE1": "COMPRESSED_DATA", "TFORM1": "1PB(99)", "TTYPE2": "GZIP_COMPRESSED_DATA", "TFORM2": "1PB(99)", "TTYPE3": "ZSCALE", "TFORM3": "1D", "TTYPE4": "ZZERO", "TFORM4": "1D", "ZIMAGE": "T", "ZBITPIX": "-32", "ZNAXIS": "2", "ZNAXIS1": "20", "ZNAXIS2": "6", "ZCMPTYPE": kind, "ZQUANTIZ": how, "ZDITHER0": "77"}
    data = rows + heap
    got = tiled.read_rows(cards, 1, 6, lambda at, n: data[at : at + n])
    assert np.isnan(got[0, 3]) and np.nanmax(np.abs(got - a[1:])) <= scale / 2 + 1e-5
    assert how != "SUBTRACTIVE_DITHER_2" or got[1, 4] == 0.0


def test_many_files_together_are_the_files_alone():
    r = np.random.default_rng(5)
    images = [r.integers(-300, 300, shape).astype(kind) for kind in (np.int16, np.int32, np.uint8, np.uint16) for shape in ((4, 40), (4, 40), (7, 33), (1, 5))] + [r.normal(size=(4, 40))]
    files = [([({}, None), (SKY | {"BSCALE": 0.5}, a)], rice) for a in images for rice in (True, False)]
    content = fits.files_bytes(files)
    assert content == [fits.file_bytes(*f) for f in files]
    parts = [(io.BytesIO(c), fits.chosen(list(fits.headers(io.BytesIO(c))), "second")[0], 0, a.shape[0]) for c, (((_, (_, a))), _) in zip(content, files)]
    for got, (_, (_, a)) in zip(fits.read_many(parts), (f[0] for f in files)):
        assert np.array_equal(got, a if a.dtype == np.uint16 else a * 0.5)


def test_archives_of_many_files(spark):
    """Small files share those of an archive, each comes from the first place that has it, and one that is missing or broken is an error."""
    fits.register(spark)
    a = np.arange(64.0 * 64).reshape(64, 64) % 7
    rows = [(i, f"2000/{i}/c{i}.{kind}", 64, 64, (a + i + shift).ravel().tolist(), {"BITPIX": "16"}, kind != "wt", place) for i in range(60) for place, shift in (("near", 0), ("far", 100), ("else", 200)) for kind in ("image", "wt") if place != "near" or i % 2]
    files = fits.to_contents(spark.createDataFrame(rows, "cell int, key string, h int, w int, data array<double>, header map<string,string>, rice boolean, place string"), ("cell", "place", "rice"))
    archive = store.write_archive(files.repartition(2, "cell"), ["cell"], 2)
    where = [Path(p.removeprefix("file://")) for p in archive.inputFiles()]
    assert len(where) == 6 and sum(p.stat().st_size for p in where) < sum(len(c.content) for c in files.select("content").collect()) / 5
    wanted = lambda *ends: spark.range(60).selectExpr("cast(id as int) AS cell", f"array({', '.join(f"concat('c', id, '.{e}.fits')" for e in ends)}) AS names").repartition(2, "cell")
    found = store.nearest_contents(wanted("image", "wt", "none"), archive, ["cell"], ["near", "far"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # of the names: contents stay where they are
    got = {r.cell: r.files for r in found.collect()}
    assert len(got) == 60 and all(f[0].path == f"2000/{i}/c{i}.image.fits.fz" and f[1].path == f"2000/{i}/c{i}.wt.fits" and f[2] is None for i, f in got.items())
    pixels = fits.to_pixels(store.nearest_contents(wanted("image", "wt"), archive, ["cell"], ["near", "far"]), ("v", "w"), "w", ("cell",)).collect()
    assert len(pixels) == 60 * 64 * 64 and all(r.v == r.w == (r.y * 64 + r.x) % 7 + r.cell + (0 if r.cell % 2 else 100) for r in pixels)
    with pytest.raises(Exception, match="no file of the kind w"):
        fits.to_pixels(found.select("cell", F.expr("array(files[0], files[2])").alias("files")), ("v", "w"), "w", ("cell",)).collect()
    for name, change in (("can't be read", "substring(files[0].content, 1, 6000)"), ("can't be read", "cast('text' AS binary)")):
        broken = found.selectExpr("cell", f"array(named_struct('path', files[0].path, 'content', {change}), files[1]) AS files")
        with pytest.raises(Exception, match=name):
            fits.to_pixels(broken, ("v", "w"), "w", ("cell",)).collect()


def test_pixels_of_images_larger_than_a_batch(spark):
    a = np.full((1100, 1000), np.nan)
    a[::100, ::100] = np.arange(110).reshape(11, 10)
    one = [("x.fits", fits.file_bytes([({}, a)])), ("y.fits.gz", gzip.compress(fits.file_bytes([({}, None), ({}, np.nan_to_num(a) + 1)]), 1))]
    small = [("s.fits", fits.file_bytes([({}, a[:2, :2])]))] * 2
    df = spark.createDataFrame([(1, one), (2, small)], "id int, files array<struct<path string, content binary>>").coalesce(1)
    got = fits.to_pixels(df, ("v", "w"), "v", ("id",)).collect()
    assert sorted(r[:] for r in got) == [(1, y * 100, x * 100, y * 10.0 + x, y * 10.0 + x + 1) for y in range(11) for x in range(10)] + [(2, 0, 0, 0.0, 0.0)]
    with pytest.raises(Exception, match="different shapes"):
        fits.to_pixels(spark.createDataFrame([(1, [one[0], small[0]])], df.schema), ("v", "w"), "v", ("id",)).collect()


def test_band_fetch_has_no_file_for_each_image(spark):
    from skyloom.plans import registry

    top = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) / "skyloom-stores"
    before = {p for p in top.rglob("*") if p.is_file()}
    assert registry.queries()["band_fetch"](spark, "/root/testdata/sf0.001").count() > 5000
    new = [p for p in top.rglob("*") if p.is_file() and p not in before]
    assert len(new) < 40 and not any(".fits" in p.name for p in new)  # 10 cells have 167 survey files
