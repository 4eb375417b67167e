"""FITS files: cards, images (plain or tile-compressed), and a Spark data source that reads their HDUs as rows."""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, WriterCommitMessage

from ..shipping import ship
from . import tiled

# Numbers of the BITPIX card and what they stand for.
KINDS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
BLOCK = 2880
# Fixed value: bytes that a record of ten blocks has, to which a file may be filled up.
FILL = 10 * BLOCK
#: Rows of an image that are read at a time, and the rows and columns of a raster row.
CHUNK = 1024
#: Bytes and files that one task reads at most (a larger file alone has its own), and rows and values that it hands over together.
TASK_BYTES, TASK_FILES, BATCH_ROWS, BATCH_VALUES = 64 << 20, 256, 256, 1 << 20
#: Small files that are made or read together.
BATCH_FILES = 64
#: What a file that is no FITS file, or not a whole one, leads to.
ERRORS = (gzip.BadGzipFile, zlib.error, EOFError, ValueError, KeyError, IndexError)
# What a celestial axis's type begins with.
CELESTIAL = ("RA", "DEC", "GLON", "GLAT", "ELON", "ELAT")


def card(key: str, value) -> str:
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, (int, float, np.number)):
        text = f"{value!r:>20}" if not isinstance(value, np.number) else f"{value.item()!r:>20}"
    else:
        text = "'" + str(value).replace("'", "''").ljust(8) + "'"
    return f"{key:<8}= {text}"[:80].ljust(80)


def parse_card(line: str) -> tuple[str, str] | None:
    if line[8:10] != "= ":
        return None
    value = line[10:]
    if value.lstrip().startswith("'"):
        inner = value.lstrip()[1:]
        end = 0
        while True:
            end = inner.index("'", end)
            if inner[end : end + 2] != "''":
                break
            end += 2
        return line[:8].strip(), inner[:end].replace("''", "'").rstrip()
    return line[:8].strip(), value.split("/")[0].strip()


def header_bytes(cards: dict) -> bytes:
    text = "".join(card(k, v) for k, v in cards.items()) + "END".ljust(80)
    return text.encode("ascii").ljust(-(-len(text) // BLOCK) * BLOCK)


def file_bytes(hdus: list[tuple[dict, np.ndarray | None]], rice: bool = False) -> bytes:
    """hdus: extra cards and data; the first is the primary one. Unsigned 16- and 32-bit data get the usual offset. rice: images of whole numbers (of at most 32 bits, after the primary HDU) become tables of Rice-coded tiles."""
    return files_bytes([(hdus, rice)])[0]


def files_bytes(files: list[tuple[list[tuple[dict, np.ndarray | None]], bool]]) -> list[bytes]:
    """file_bytes() of each of files; images of one shape and kind are coded together."""
    own = [[_offset(*hdu) for hdu in hdus] for hdus, _ in files]
    alike: dict[tuple, list[tuple[int, int]]] = {}
    for k, (_, rice) in enumerate(files):
        for i, (_, data) in enumerate(own[k]):
            if rice and i and data is not None and data.ndim == 2 and data.size and data.dtype.kind in "iu" and data.dtype.itemsize <= 4:
                alike.setdefault((data.shape, data.dtype), []).append((k, i))
    tables = {at: table for places in alike.values() for at, table in zip(places, tiled.compressed_alike([own[k][i][1] for k, i in places]))}
    return [b"".join(_hdu_bytes(i, extra, data, tables.get((k, i))) for i, (extra, data) in enumerate(hdus)) for k, hdus in enumerate(own)]


def _offset(extra: dict, data: np.ndarray | None) -> tuple[dict, np.ndarray | None]:
    if data is None or data.dtype not in (np.uint16, np.uint32):
        return extra, data
    zero = 1 << (8 * data.dtype.itemsize - 1)
    return extra | {"BZERO": zero, "BSCALE": 1}, (data.astype(np.int64) - zero).astype(f"i{data.dtype.itemsize}")


def _hdu_bytes(i: int, extra: dict, data: np.ndarray | None, table: tuple[dict, bytes] | None) -> bytes:
    cards: dict = {"SIMPLE": True} if i == 0 else {"XTENSION": "IMAGE"}
    body = b""
    if table is not None:
        cards, body = {"XTENSION": "BINTABLE"} | table[0], table[1]
    elif data is None:
        cards |= {"BITPIX": 8, "NAXIS": 0}
    else:
        bits = next(k for k, v in KINDS.items() if np.dtype(v).newbyteorder("=") == data.dtype.newbyteorder("="))
        cards |= {"BITPIX": bits, "NAXIS": data.ndim} | {f"NAXIS{k + 1}": n for k, n in enumerate(data.shape[::-1])}
        body = data.astype(KINDS[bits]).tobytes()
    if i and table is None:
        cards |= {"PCOUNT": 0, "GCOUNT": 1}
    return header_bytes(cards | extra) + body.ljust(-(-len(body) // BLOCK) * BLOCK, b"\0")


def write_image(path: str, hdus: list[tuple[dict, np.ndarray | None]], rice: bool = False) -> None:
    """A file that is there whole or not at all; on any file system that pyarrow opens."""
    data = file_bytes(hdus, rice)
    fs, at = located(path)
    part = f"{at}.part-{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as f:
        f.write(gzip.compress(data, 1) if path.endswith(".gz") else data)
    fs.move(part, at)


def located(path: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


class Hdu(NamedTuple):
    """What a header says, and where the data begin."""

    number: int
    cards: dict[str, str]
    at: int
    size: int

    @property
    def tiled(self) -> bool:
        return self.cards.get("ZIMAGE") == "T"

    @property
    def shape(self) -> tuple[int, ...]:
        """Of the image, slowest axis first; none without one."""
        if self.cards.get("XTENSION", "IMAGE").strip() == "BINTABLE" and not self.tiled or self.cards.get("XTENSION") == "TABLE":
            return ()
        z = "Z" if self.tiled else ""
        return tuple(int(self.cards[f"{z}NAXIS{i}"]) for i in range(int(self.cards.get(f"{z}NAXIS", 0)), 0, -1))

    @property
    def header(self) -> dict[str, str]:
        return tiled.image_cards(self.cards) if self.tiled else self.cards

    @property
    def celestial(self) -> bool:
        """Has an image, and axes on the sky."""
        c = self.cards
        return bool(self.shape) and "CRVAL1" in c and "CRVAL2" in c and all(c.get(f"CTYPE{i}", CELESTIAL[i - 1]).startswith(CELESTIAL) for i in (1, 2))


def piece(f: BinaryIO, at: int, size: int) -> bytes:
    """Bytes from a place on, fewer where the file ends; not every store seeks beyond its end."""
    if isinstance(f, pa.NativeFile) and at >= f.size():
        return b""
    f.seek(at)
    return f.read(size)


def headers(f: BinaryIO) -> Iterator[Hdu]:
    """The HDUs of a file; their data are skipped, not read. A file that ends within an HDU, or has no header where one should begin, is an error, since HDUs that it lost would look like none. Up to nine blank blocks may follow the last HDU."""
    at = number = 0
    while True:
        cards: dict[str, str] = {}
        done, begin = False, at
        while not done:
            block = piece(f, at, BLOCK)
            if at == begin and not block.startswith(b"XTENSION=" if number else b"SIMPLE  ="):
                rest = block if len(block) < BLOCK else block + piece(f, at + BLOCK, FILL - BLOCK)
                if number and len(rest) < FILL and not rest.strip(b"\0 "):
                    return
                raise ValueError(f"no header at byte {at}, where HDU {number} should begin")
            if len(block) < BLOCK:
                raise EOFError(f"the file ends in the header of HDU {number}")
            at += BLOCK
            text = block.decode("ascii", "replace")
            for i in range(0, BLOCK, 80):
                line = text[i : i + 80]
                if line.rstrip() == "END":
                    done = True
                    break
                if found := parse_card(line):
                    cards[found[0]] = found[1]
        axes = [int(cards[f"NAXIS{i + 1}"]) for i in range(int(cards.get("NAXIS", 0)))]
        counted = axes[1:] if axes[:1] == [0] and cards.get("GROUPS") == "T" else axes
        size = abs(int(cards.get("BITPIX", 8))) // 8 * int(cards.get("GCOUNT", 1)) * (int(cards.get("PCOUNT", 0)) + int(np.prod(counted))) if axes else 0
        if size and not piece(f, at + size - 1, 1):
            raise EOFError(f"the file ends in the data of HDU {number}")
        yield Hdu(number, cards, at, size)
        at += -(-size // BLOCK) * BLOCK
        number += 1


def read_rows(f: BinaryIO, hdu: Hdu, y0: int, y1: int) -> np.ndarray:
    """Rows y0 to y1 of the last two axes, scaled; only these are read. Whole numbers without scale stay so."""
    return read_many([(f, hdu, y0, y1)])[0]


def read_many(parts: list[tuple[BinaryIO, Hdu, int, int]]) -> list[np.ndarray]:
    """read_rows() of each of parts; tiles are decoded together."""
    tables = [(hdu.cards, y0, y1, lambda at, size, f=f, hdu=hdu: piece(f, hdu.at + at, size)) for f, hdu, y0, y1 in parts if hdu.tiled]
    decoded = iter(tiled.read_many(tables))
    out = []
    for f, hdu, y0, y1 in parts:
        width, cards = hdu.shape[-1], hdu.cards
        if hdu.tiled:
            raw = next(decoded)
        else:
            kind = np.dtype(KINDS[int(cards["BITPIX"])])
            raw = np.frombuffer(piece(f, hdu.at + y0 * width * kind.itemsize, (y1 - y0) * width * kind.itemsize), kind).reshape(y1 - y0, width)
            if "BLANK" in cards and kind.kind in "iu":
                raw = np.where(raw == int(cards["BLANK"]), np.nan, raw)
        zero, scale = float(cards.get("BZERO", 0)), float(cards.get("BSCALE", 1))
        out.append(raw if (zero, scale) == (0.0, 1.0) else raw * scale + zero)
    return out


def chosen(hdus: list[Hdu], rule: str) -> list[Hdu]:
    """all; image: the first with an image and axes on the sky, else the primary one; second: the one after the primary if there is one, else that; a number."""
    if rule == "all":
        return hdus
    if rule == "image":
        return [next((h for h in hdus if h.celestial), hdus[0])] if hdus else []
    if rule == "second":
        return hdus[1:2] or hdus[:1]
    return [h for h in hdus if h.number == int(rule)]


SCHEMA = "path string, hdu int, extname string, header map<string,string>, height int, width int, y0 int, x0 int, h int, w int, data array<double>, error string"
_KINDS = {"path": pa.string(), "hdu": pa.int32(), "extname": pa.string(), "header": pa.map_(pa.string(), pa.string()), "height": pa.int32(), "width": pa.int32(), "y0": pa.int32(), "x0": pa.int32(), "h": pa.int32(), "w": pa.int32(), "data": pa.list_(pa.float64()), "error": pa.string()}


class Wanted(NamedTuple):
    """fields: which of SCHEMA's; rule: see chosen(); tolerant: a file that is no FITS file, or not a whole one, is a row with an error; only: values that hdu or extname must have."""

    fields: tuple[str, ...] = tuple(_KINDS)
    rule: str = "all"
    chunk: int = CHUNK
    tolerant: bool = False
    only: tuple[tuple[str, frozenset], ...] = ()


def rows_of(f: BinaryIO, path: str, wanted: Wanted) -> Iterator[pa.RecordBatch]:
    """A row a chunk of an image, its data as numbers of 64 bits; one without data for an HDU without an image, or if data aren't wanted."""
    if f.read(2) == b"\x1f\x8b":
        f.seek(0)
        f = gzip.GzipFile(fileobj=f)  # type: ignore[assignment]
    for hdu in chosen(list(headers(f)), wanted.rule):
        shape, extname = hdu.shape, hdu.cards.get("EXTNAME")
        if any({"hdu": hdu.number, "extname": extname}[k] not in v for k, v in wanted.only):
            continue
        planes = int(np.prod(shape[:-2]))
        height, width = (shape[-2] if len(shape) > 1 else 1, shape[-1]) if shape else (0, 0)
        facts = {"path": path, "hdu": hdu.number, "extname": extname, "header": list(hdu.header.items()), "height": height, "width": width}

        def batch(y: int, x: int, h: int, w: int, data: np.ndarray | None) -> pa.RecordBatch:
            own = facts | {"y0": y, "x0": x, "h": h, "w": w, "error": None}  # noqa: B023
            values = pa.nulls(1, _KINDS["data"]) if data is None else pa.ListArray.from_arrays(pa.array([0, data.size], pa.int32()), pa.array(np.ascontiguousarray(data, np.float64).ravel()))
            return pa.RecordBatch.from_arrays([values if k == "data" else pa.array([own[k]], _KINDS[k]) for k in wanted.fields], names=list(wanted.fields))

        if not width or "data" not in wanted.fields and not {"y0", "x0", "h", "w"} & set(wanted.fields):
            yield batch(0, 0, height, width, None)
            continue
        for y in range(0, planes * height, wanted.chunk):  # further axes lie below each other
            h = min(wanted.chunk, planes * height - y)
            rows = read_rows(f, hdu, y, y + h) if "data" in wanted.fields else None
            for x in range(0, width, wanted.chunk):
                w = min(wanted.chunk, width - x)
                yield batch(y, x, h, w, None if rows is None else rows[:, x : x + w])


def file_rows(path: str, wanted: Wanted, content: bytes | None = None) -> Iterator[pa.RecordBatch]:
    """rows_of() of a file, or of its content. What the store can't give is always an error, since a further try may have it. A file whose content can't be read is one too, or, if wanted, one row that says so and no others: for that it is read twice, not kept."""

    def read() -> Iterator[pa.RecordBatch]:
        try:
            if content is not None:
                yield from rows_of(io.BytesIO(content), path, wanted)
                return
            fs, at = located(path)
            with fs.open_input_file(at) as f:
                yield from rows_of(f, path, wanted)
        except ERRORS as e:
            raise ValueError(f"{path} can't be read: {type(e).__name__}: {e}") from e

    if wanted.tolerant and "error" in wanted.fields and not wanted.only:  # with `only`, nobody knows whether the file has what is asked for
        try:
            for _ in read():
                pass
        except ValueError as e:
            own = {"path": path, "error": str(e)}
            yield pa.RecordBatch.from_arrays([pa.array([own.get(k)], _KINDS[k]) for k in wanted.fields], names=list(wanted.fields))
            return
    yield from read()


def packed(files: list[tuple[str, int]]) -> list[list[str]]:
    """Files (path, bytes to read) dealt to tasks in their order, so that many small ones share one."""
    out: list[list[str]] = []
    most = max(1, min(TASK_FILES, -(-len(files) // 8)))  # few files still go to several tasks
    room = 0
    for path, size in files:
        if not out or size > room or len(out[-1]) == most:
            out.append([])
            room = TASK_BYTES
        out[-1].append(path)
        room -= size
    return out


def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches, each of bounded rows and values."""
    held: list[pa.RecordBatch] = []
    values = 0
    for b in batches:
        size = sum(len(c.flatten()) for c in b.columns if pa.types.is_list(c.type))
        if held and (values + size > BATCH_VALUES or len(held) == BATCH_ROWS):
            yield pa.concat_batches(held)
            held, values = [], 0
        held.append(b)
        values += size
    if held:
        yield pa.concat_batches(held)


class FitsReader(DataSourceReader):
    """Opens only the files that the filters leave, reads headers by blocks, and data only of the chosen HDUs and only if they are asked for."""

    def __init__(self, path: str, wanted: Wanted):
        self.path, self.wanted = path, wanted
        self.files: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        only = dict(self.wanted.only)
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = frozenset(f.value) if isinstance(f, In) else frozenset([f.value]) if isinstance(f, EqualTo) else None
            if name in ("hdu", "extname") and values is not None:
                only[name] = only.get(name, values) & values
            elif name == "path" and (values is not None or isinstance(f, StringEndsWith)):
                self.files.append(("end", f.value) if values is None else ("in", values))
            else:
                yield f
        self.wanted = self.wanted._replace(only=tuple(only.items()))

    def partitions(self):
        fs, at = located(self.path)
        scheme = self.path[: self.path.index("://") + 3] if "://" in self.path else ""
        info = fs.get_file_info(at)
        if info.type == pa.fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = fs.get_file_info(pa.fs.FileSelector(at, recursive=True)) if info.type == pa.fs.FileType.Directory else [info]
        names = sorted((scheme + x.path, x.size) for x in found if x.type == pa.fs.FileType.File and ".fits" in x.base_name and ".part-" not in x.base_name)
        data = "data" in self.wanted.fields
        return [InputPartition(p) for p in packed([(n, size if data else 0) for n, size in names if all(n.endswith(v) if how == "end" else n in v for how, v in self.files)])]

    def read(self, partition):
        paths = [] if partition is None else partition.value  # Spark makes one of no partitions
        yield from together(b for path in paths for b in file_rows(path, self.wanted))


def _numbers(column: pa.ListArray, i: int) -> np.ndarray:
    a, b = column.offsets[i].as_py(), column.offsets[i + 1].as_py()
    return column.values.slice(a, b - a).to_numpy(zero_copy_only=False)


def _file_of(cols: dict, i: int, rice: bool) -> tuple[list[tuple[dict, np.ndarray | None]], bool]:
    """The HDUs of the file that row i of columns stands for, and whether it has tiles; see FitsWriter."""
    h, w = cols["h"][i].as_py(), cols["w"][i].as_py()
    header: dict = {k: _value(v) for k, v in (cols["header"][i].as_py() or [])} if "header" in cols else {}
    header.pop("EXTNAME", None)
    data = _numbers(cols["data"], i).reshape(h, w)
    image: tuple = (header | {"EXTNAME": "FLUX_SUM"}, data.astype(np.float32))
    if (bits := header.pop("BITPIX", None)) is not None:
        raw = (data - header.get("BZERO", 0)) / header.get("BSCALE", 1)
        raw = np.where(np.isnan(raw), header.get("BLANK", 0), np.rint(raw)).astype("u1" if bits == 8 else f"i{bits // 8}")
        image = (header | {"EXTNAME": "FLUX_SUM"}, raw)
    alone = "primary" in cols and cols["primary"][i].as_py()
    hdus = [image] if alone else [({k: v for k, v in header.items() if k not in ("BZERO", "BSCALE", "BLANK")}, None), image]
    hdus += [({"EXTNAME": name.upper()}, _numbers(cols[name], i).reshape(h, w).astype(np.int32)) for name in ("count", "mask") if name in cols and cols[name][i].is_valid]
    return hdus, cols["rice"][i].as_py() if "rice" in cols else rice


class FitsWriter(DataSourceArrowWriter):
    """One file a row: key names it (with folders), header (optional) gives its cards, data its image, count and mask (optional) further ones. primary (optional): whether the image is the primary HDU, not the one after it. rice (optional): whether its whole numbers become tiles; without it, the option says so.

    A header with BITPIX 8, 16 or 32 stores whole numbers, by its BSCALE and BZERO, NaN as its BLANK; else data are 32-bit floats."""

    def __init__(self, path: str, rice: bool):
        self.path, self.rice = path, rice

    def write(self, iterator) -> WriterCommitMessage:
        for batch in iterator:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(len(batch)):
                hdus, rice = _file_of(cols, i, self.rice)
                fs, at = located(f"{self.path.rstrip('/')}/{cols['key'][i].as_py()}")
                fs.create_dir(at.rpartition("/")[0], recursive=True)
                write_image(f"{self.path.rstrip('/')}/{cols['key'][i].as_py()}.fits{'.fz' if rice else ''}", hdus, rice)  # a task that runs again writes the same file
        return WriterCommitMessage()

    def commit(self, messages) -> None:
        """Without rows too there is a folder: one that is not there is an error to the reader."""
        fs, at = located(self.path)
        fs.create_dir(at, recursive=True)


def _value(text: str):
    """A card's value as a number if it looks like one."""
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


class FitsSource(DataSource):
    """After register(spark): spark.read.format("fits").load(path) gives SCHEMA, a row a chunk; a schema with fewer of its fields reads no more than these need. Options: hdu (all, image, second or a number: see chosen()), chunk (rows and columns of a row's raster), errors=row (a file that is no whole FITS file is a row whose field error, which must be asked for, says why; it has no hdu, so it stays an error if rows are filtered by hdu or extname).

    df.write.format("fits").mode("append").save(path) writes a file a row; option compress=rice for tiles. Files are on a file system that pyarrow opens and all executors see; for others, from_contents()."""

    @classmethod
    def name(cls):
        return "fits"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        fields, tolerant = tuple(f.name for f in schema.fields), self.options.get("errors") == "row"
        if tolerant and "error" not in fields:
            raise ValueError("errors=row needs the field error: without it a file that can't be read looks like any other")
        return FitsReader(self.options["path"], Wanted(fields, self.options.get("hdu", "all"), int(self.options.get("chunk", CHUNK)), tolerant))

    def writer(self, schema, overwrite):
        return FitsWriter(self.options["path"], self.options.get("compress") == "rice")


def register(spark: SparkSession) -> None:
    """Makes the source known, with filters pushed down."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FitsSource)


def from_files(files: DataFrame, wanted: Wanted = Wanted(), keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of files (path), or of their content if files have such a column, as spark.read.format("binaryFile") gives it from any store that Spark reads; with the columns `keep` of files."""
    whole = "content" in files.columns
    own = files.select("path", *(["content"] if whole else []), *keep)
    first = 1 + whole

    def each(batches):
        for batch in batches:
            for i, path in enumerate(batch.column(0).to_pylist()):
                for rows in file_rows(path, wanted, batch.column(1)[i].as_py() if whole else None):
                    kept = [pa.concat_arrays([batch.column(first + k).slice(i, 1)] * len(rows)) for k in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*kept, *rows.columns], names=[*keep, *rows.schema.names])

    def step(batches):
        yield from together(each(batches))

    ship(files.sparkSession)
    kinds = dict(x.split(" ", 1) for x in SCHEMA.split(", "))
    kept = [f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keep]
    return own.mapInArrow(step, ", ".join([*kept, *(f"{k} {kinds[k]}" for k in wanted.fields)]))


def to_contents(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The files that FitsWriter would write of the same rows, as path (the key with its ending) and content, for archives of many small files; with the columns `keep`."""
    own = rows.select(*[c for c in rows.columns if c not in keep], *keep)

    def step(batches):
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for a in range(0, len(batch), BATCH_FILES):
                some = range(a, min(a + BATCH_FILES, len(batch)))
                files = [_file_of(cols, i, False) for i in some]
                paths = pa.array([f"{cols['key'][i].as_py()}.fits{'.fz' if rice else ''}" for i, (_, rice) in zip(some, files)], pa.string())
                yield pa.RecordBatch.from_arrays([*(cols[k].slice(a, len(some)) for k in keep), paths, pa.array(files_bytes(files), pa.binary())], names=[*keep, "path", "content"])

    ship(rows.sparkSession)
    kept = [f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keep]
    return own.mapInArrow(step, ", ".join([*kept, "path string", "content binary"]))


def to_pixels(sets: DataFrame, kinds: tuple[str, ...], seen: str, keep: tuple[str, ...]) -> DataFrame:
    """Pixels of images that lie over each other: y, x and a number of each kind, where the kind `seen` has one. sets: the columns `keep`, and files (path, content) in the order of kinds, of which the HDU after the primary one is read, or that; a file that is missing is an error."""
    own = sets.select(*keep, "files")

    def opened(row: list[dict | None]) -> list[tuple[BinaryIO, Hdu]]:
        out = []
        for kind, file in zip(kinds, row, strict=True):
            if file is None:
                raise FileNotFoundError(f"no file of the kind {kind}")
            try:
                f: BinaryIO = io.BytesIO(file["content"])
                f = gzip.GzipFile(fileobj=f) if file["content"][:2] == b"\x1f\x8b" else f  # type: ignore[assignment]
                out.append((f, chosen(list(headers(f)), "second")[0]))
            except ERRORS as e:
                raise ValueError(f"{file['path']} can't be read: {type(e).__name__}: {e}") from e
        if len({hdu.shape for _, hdu in out}) > 1 or len(out[0][1].shape) != 2:
            raise ValueError(f"images of different shapes: {[(file['path'], hdu.shape) for file, (_, hdu) in zip(row, out)]}")
        return out

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list]]:
        """Rows of the batch with their images, each a run of lines at a time."""
        for i in range(len(batch)):
            images = opened(batch.column(len(keep))[i].as_py())
            height, width = images[0][1].shape
            lines = max(1, BATCH_VALUES // width)
            for y in range(0, height, lines):
                yield i, y, [(f, hdu, y, min(y + lines, height)) for f, hdu in images]

    def together(batch: pa.RecordBatch, held: list[tuple[int, int, list]]) -> pa.RecordBatch:
        rasters = read_many([p for _, _, own in held for p in own])
        places, columns = [], []
        for k, (i, y, _) in enumerate(held):
            own = rasters[k * len(kinds) : (k + 1) * len(kinds)]
            at = np.nonzero(~np.isnan(own[kinds.index(seen)]))
            places.append((np.full(len(at[0]), i), at[0] + y, at[1]))
            columns.append([r[at].astype(np.float64) for r in own])
        row, y, x = (np.concatenate(p) for p in zip(*places))
        kept = [batch.column(k).take(pa.array(row)) for k in range(len(keep))]
        values = [pa.array(np.concatenate(c)) for c in zip(*columns)]
        return pa.RecordBatch.from_arrays([*kept, pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), *values], names=[*keep, "y", "x", *kinds])

    def step(batches):
        for batch in batches:
            held, values = [], 0
            for part in parts(batch):
                size = sum((y1 - y0) * hdu.shape[-1] for _, hdu, y0, y1 in part[2])
                if held and (values + size > BATCH_VALUES // 4 or len(held) == BATCH_FILES):
                    yield together(batch, held)
                    held, values = [], 0
                held.append(part)
                values += size
            if held:
                yield together(batch, held)

    ship(sets.sparkSession)
    kept = [f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keep]
    return own.mapInArrow(step, ", ".join([*kept, "y int", "x int", *(f"{k} double" for k in kinds)]))
