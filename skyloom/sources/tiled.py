"""Tile-compressed FITS images: tables whose rows hold the Rice-coded or gzipped tiles of an image.

The Rice code is the one of the FITS standard: a tile's first value as it is, then blocks of 32 differences, each with the
number of low bits that its values keep; what is above them is written in unary. Tiles are decoded side by side, a
pixel of all of them at a time, over arrays of bits."""

from __future__ import annotations

import gzip

import numpy as np

BLOCK = 32
#: Bits that tiles decoded together may have; their places take 8 bytes a bit.
MOST_BITS = 1 << 23
# By bytes of a value, the bits of a block's number, and the largest number of low bits.
RICE = {1: (3, 6), 2: (4, 14), 4: (5, 25)}


def _lengths(v: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (v >> low) + 1 + low


def rice_encode(tiles: np.ndarray) -> list[bytes]:
    """tiles: rows of values, int8, int16 or int32 (bytes that aren't signed as they are)."""
    size = tiles.dtype.itemsize
    head, most = RICE[size]
    width = 8 * size
    t, n = tiles.shape
    values = tiles.astype(np.int64)
    d = np.diff(values, axis=1, prepend=values[:, :1])
    d = (d + (1 << (width - 1))) % (1 << width) - (1 << (width - 1))  # differences wrap around
    v = np.where(d < 0, -2 * d - 1, 2 * d)
    blocks = -(-n // BLOCK)
    real = (np.arange(blocks * BLOCK) < n).reshape(blocks, BLOCK)
    v = np.pad(v, ((0, 0), (0, blocks * BLOCK - n))).reshape(t, blocks, BLOCK)
    mean = v.sum(axis=2) / real.sum(axis=1)
    low = np.clip(np.floor(np.log2(np.maximum(mean, 1))).astype(np.int64), 0, most)
    nothing, raw = v.max(axis=2) == 0, None
    sizes = np.where(real, _lengths(v, low[:, :, None]), 0)
    raw = (low >= most) | (sizes.sum(axis=2) > real.sum(axis=1) * width)
    raw &= ~nothing
    code = np.where(nothing, 0, np.where(raw, most + 1, low + 1))
    sizes = np.where(real, np.where(nothing[:, :, None], 0, np.where(raw[:, :, None], width, sizes)), 0)
    per_block = head + sizes.sum(axis=2)
    total = -(-(width + per_block.sum(axis=1)) // 8) * 8
    base = np.cumsum(total) - total
    at_block = base[:, None] + width + np.cumsum(per_block, axis=1) - per_block
    at = at_block[:, :, None] + head + np.cumsum(sizes, axis=2) - sizes
    bits = np.zeros(int(total.sum()), np.uint8)

    def put(places: np.ndarray, numbers: np.ndarray, lens) -> None:
        """Numbers of up to `width` bits, highest bit first, from places on."""
        lens = np.broadcast_to(lens, places.shape)
        for b in range(int(lens.max(initial=0))):
            has = lens > b
            bits[places[has] + lens[has] - 1 - b] = (numbers[has] >> b) & 1

    put(base, values[:, 0] & ((1 << width) - 1), width)
    put(at_block, code, head)
    spelled = real & ~nothing[:, :, None]
    plain = spelled & raw[:, :, None]
    put(at[plain], v[plain], width)
    coded = spelled & ~raw[:, :, None]
    k = np.broadcast_to(low[:, :, None], v.shape)[coded]
    top = v[coded] >> k
    bits[at[coded] + top] = 1
    put(at[coded] + top + 1, v[coded] & ((1 << k) - 1), k)
    packed = np.packbits(bits).tobytes()
    ends = (np.cumsum(total) // 8).tolist()
    return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _decode(tiles: list[bytes], n: int, size: int, block: int) -> np.ndarray:
    head, most = RICE[size]
    width = 8 * size
    data = np.frombuffer(b"".join(tiles) + bytes(16), np.uint8)
    ends = np.cumsum([len(x) for x in tiles])
    place = np.r_[0, ends[:-1]].astype(np.int64) * 8
    bits = np.unpackbits(data)
    ones = np.where(bits, np.arange(len(bits)), len(bits) - 1)
    following = np.minimum.accumulate(ones[::-1])[::-1]
    padded = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
    window = np.zeros(len(data), np.uint64)
    for i in range(8):
        window |= padded[i : i + len(data)] << np.uint64(56 - 8 * i)

    def take(at: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The numbers of lens bits that begin at places; 0 where lens is 0."""
        w = window[np.minimum(at >> 3, len(window) - 1)] << (at & 7).astype(np.uint64)
        return np.where(lens > 0, w >> np.uint64(1) >> np.maximum(63 - lens, 0).astype(np.uint64), 0).astype(np.int64)

    full = np.full(len(tiles), width, np.int64)
    first = take(place, full)
    place = place + width
    v = np.zeros((n, len(tiles)), np.int64)
    for i in range(n):
        if i % block == 0:
            code = take(place, np.full(len(tiles), head, np.int64))
            place = place + head
            low = np.clip(code - 1, 0, most)
            nothing, raw = code == 0, code == most + 1
            plain, some_raw = not nothing.any() and not raw.any(), raw.any()
        stop = following[np.minimum(place, len(following) - 1)]
        top = stop - place
        after = stop + 1
        value = top << low | take(after, low)
        after = after + low
        if not plain:
            if some_raw:
                value, after = np.where(raw, take(place, full), value), np.where(raw, place + width, after)
            value, after = np.where(nothing, 0, value), np.where(nothing, place, after)
        v[i], place = value, after
    if len(place) and (place > ends * 8).any():
        raise ValueError("a Rice-coded tile is shorter than its pixels")
    d = (v >> 1) ^ -(v & 1)
    out = (np.cumsum(d, axis=0) + first).T & ((1 << width) - 1)
    return out if size == 1 else np.where(out >> (width - 1), out - (1 << width), out)


def rice_decode(tiles: list[bytes], n: int, size: int, block: int = BLOCK) -> np.ndarray:
    """Tiles of n values of `size` bytes; int64, a row a tile."""
    out, held, bits = [np.zeros((0, n), np.int64)], [], 0
    for tile in tiles:
        if held and bits + 8 * len(tile) > MOST_BITS:
            out.append(_decode(held, n, size, block))
            held, bits = [], 0
        held.append(tile)
        bits += 8 * len(tile)
    if held:
        out.append(_decode(held, n, size, block))
    return np.concatenate(out)


def _randoms() -> np.ndarray:
    """The standard's 10,000 random numbers: x -> 16807 x modulo 2^31 - 1, from 1."""
    out, seed = np.empty(10000, np.float64), 1
    for i in range(10000):
        seed = 16807 * seed % 2147483647
        out[i] = seed / 2147483647
    return out


_RANDOM: list[np.ndarray] = []


def dither(row: int, n: int, zero: int) -> np.ndarray:
    """What is taken from the n quantised values of a tile (number from 0) before scaling; zero: the ZDITHER0 card."""
    if not _RANDOM:
        _RANDOM.append(_randoms())
    r = _RANDOM[0]
    k = (row + zero - 1) % 10000
    out, at = np.empty(n), int(r[k] * 500)
    done = 0
    while done < n:
        part = r[at : at + n - done]
        out[done : done + len(part)] = part
        done += len(part)
        if done < n:
            k = (k + 1) % 10000
            at = int(r[k] * 500)
    return out - 0.5


# What stands for a missing value and, with the second kind of dithering, for 0.
MISSING, ZERO = -2147483647, -2147483646


class Columns:
    """The columns of a binary table by name: offset in a row and format."""

    def __init__(self, cards: dict[str, str]):
        self.at: dict[str, tuple[int, str]] = {}
        offset = 0
        sizes = {"L": 1, "B": 1, "I": 2, "J": 4, "K": 8, "A": 1, "E": 4, "D": 8, "P": 8, "Q": 16}
        for i in range(1, int(cards["TFIELDS"]) + 1):
            form = cards[f"TFORM{i}"]
            digits = form[: len(form) - len(form.lstrip("0123456789"))]
            kind = form[len(digits)]
            self.at[cards.get(f"TTYPE{i}", "").strip()] = (offset, kind)
            offset += int(digits or 1) * sizes[kind]
        self.width = offset

    def numbers(self, rows: bytes, n: int, name: str) -> np.ndarray | None:
        """A scalar column, or the (length, place) pairs of one of variable length."""
        if name not in self.at:
            return None
        offset, kind = self.at[name]
        of = {"P": (">i4", 2), "Q": (">i8", 2), "D": (">f8", 1), "E": (">f4", 1), "J": (">i4", 1)}[kind]
        part = np.frombuffer(rows, np.uint8).reshape(n, self.width)[:, offset : offset + np.dtype(of[0]).itemsize * of[1]]
        return np.ascontiguousarray(part).view(of[0])


def tile_shape(cards: dict[str, str]) -> tuple[int, int]:
    h, w = int(cards["ZNAXIS2"]), int(cards["ZNAXIS1"])
    return min(h, int(cards.get("ZTILE2", 1))), min(w, int(cards.get("ZTILE1", w)))


def read_rows(cards: dict[str, str], y0: int, y1: int, read) -> np.ndarray:
    """Rows y0 to y1 of an image, not yet scaled by BSCALE and BZERO; NaN where a value is missing. read(at, size): bytes of the table's data."""
    return read_many([(cards, y0, y1, read)])[0]


def read_many(images: list[tuple]) -> list[np.ndarray]:
    """read_rows() of each of images, whose Rice-coded tiles of one form are decoded together."""
    out: list = [None] * len(images)
    answers: dict[int, np.ndarray | None] = dict.fromkeys(range(len(images)))
    steps = [_rows(*image) for image in images]
    while answers:
        asked: dict[tuple[int, int, int], list[tuple[int, list[bytes]]]] = {}
        for i, answer in answers.items():
            try:
                tiles, *form = steps[i].send(answer)
                asked.setdefault(tuple(form), []).append((i, tiles))
            except StopIteration as e:
                out[i] = e.value
        answers = {}
        for form, own in asked.items():
            decoded = rice_decode([x for _, tiles in own for x in tiles], *form)
            ends = np.cumsum([len(tiles) for _, tiles in own])
            answers |= {i: decoded[end - len(tiles) : end] for (i, tiles), end in zip(own, ends.tolist())}
    return out


def _rows(cards: dict[str, str], y0: int, y1: int, read):
    """read_rows() as a generator: it yields Rice-coded tiles and what rice_decode() is to know of them, and is sent their values."""
    h, w = int(cards["ZNAXIS2"]), int(cards["ZNAXIS1"])
    th, tw = tile_shape(cards)
    across = -(-w // tw)
    columns, stride = Columns(cards), int(cards["NAXIS1"])
    heap = int(cards.get("THEAP", stride * int(cards["NAXIS2"])))
    first, last = y0 // th, -(-y1 // th)
    kind, bits = cards["ZCMPTYPE"], int(cards["ZBITPIX"])
    n_rows = (last - first) * across
    table = read(first * across * stride, n_rows * stride)
    settings = {cards[f"ZNAME{i}"]: int(cards[f"ZVAL{i}"]) for i in range(1, 10) if f"ZNAME{i}" in cards and cards[f"ZVAL{i}"].lstrip("-").isdigit()}
    lens = {name: columns.numbers(table, n_rows, name) for name in ("COMPRESSED_DATA", "GZIP_COMPRESSED_DATA", "UNCOMPRESSED_DATA")}
    scale, zero, blank = (columns.numbers(table, n_rows, x) for x in ("ZSCALE", "ZZERO", "ZBLANK"))
    missing = int(cards["ZBLANK"]) if "ZBLANK" in cards else int(cards["BLANK"]) if "BLANK" in cards and bits > 0 else None
    out = np.empty(((last - first) * th, w))
    groups: dict[tuple[int, int], list[int]] = {}
    for i in range(n_rows):
        y, x = divmod(i + first * across, across)
        groups.setdefault((min(th, h - y * th), min(tw, w - x * tw)), []).append(i)
    for (rows, cols), members in groups.items():
        n = rows * cols
        rice = [i for i in members if lens["COMPRESSED_DATA"] is not None and lens["COMPRESSED_DATA"][i, 0] > 0]
        got: dict[int, np.ndarray] = {}
        content = {i: read(heap + int(lens["COMPRESSED_DATA"][i, 1]), int(lens["COMPRESSED_DATA"][i, 0])) for i in rice}
        if kind in ("RICE_1", "RICE_ONE"):
            decoded = yield [content[i] for i in rice], n, settings.get("BYTEPIX", 4), settings.get("BLOCKSIZE", BLOCK)
            got.update(zip(rice, decoded))
        elif kind == "GZIP_1":
            form = f">i{bits // 8}" if bits > 0 and scale is None else ">i4" if scale is not None else f">f{-bits // 8}"
            form = ">u1" if form == ">i1" else form
            got.update((i, np.frombuffer(gzip.decompress(content[i]), form)) for i in rice)
        else:
            raise ValueError(f"tiles of the kind {kind} aren't known")
        for i in members:
            quantised = scale is not None and i in got
            if i not in got:  # tiles that could not be coded
                name = "GZIP_COMPRESSED_DATA" if lens["GZIP_COMPRESSED_DATA"] is not None and lens["GZIP_COMPRESSED_DATA"][i, 0] > 0 else "UNCOMPRESSED_DATA"
                form = f">f{-bits // 8}" if bits < 0 else ">u1" if bits == 8 else f">i{bits // 8}"
                count, at = map(int, lens[name][i])
                raw = gzip.decompress(read(heap + at, count)) if name.startswith("GZIP") else read(heap + at, count * np.dtype(form).itemsize)
                got[i] = np.frombuffer(raw, form)
            own = got[i].astype(np.float64)
            gone = None if bits < 0 and not quantised else missing if blank is None else int(blank[i, 0])
            if gone is None and quantised:
                gone = MISSING
            value = own
            if quantised:
                how = cards.get("ZQUANTIZ", "NO_DITHER")
                less = dither(i + first * across, n, int(cards.get("ZDITHER0", 1))) if how.startswith("SUBTRACTIVE") else 0.0
                value = (own - less) * float(scale[i, 0]) + float(zero[i, 0])
                value = np.where(own == ZERO, 0.0, value) if how == "SUBTRACTIVE_DITHER_2" else value
            if gone is not None:
                value = np.where(own == gone, np.nan, value)
            y, x = divmod(i, across)
            out[y * th : y * th + rows, x * tw : x * tw + cols] = value.reshape(rows, cols)
    return out[y0 - first * th : y1 - first * th]


def image_cards(cards: dict[str, str]) -> dict[str, str]:
    """The header of the image that a table holds."""
    table = ("XTENSION", "BITPIX", "NAXIS", "PCOUNT", "GCOUNT", "TFIELDS", "TTYPE", "TFORM", "TUNIT", "THEAP", "ZIMAGE", "ZCMPTYPE", "ZTILE", "ZNAME", "ZVAL", "ZQUANTIZ", "ZDITHER", "ZBLANK", "ZSCALE", "ZZERO")
    out = {k: v for k, v in cards.items() if not k.startswith(table)}
    return out | {"BITPIX": cards["ZBITPIX"], "NAXIS": cards["ZNAXIS"]} | {k[1:]: v for k, v in cards.items() if k.startswith("ZNAXIS") and k != "ZNAXIS"}


def compressed(data: np.ndarray, tile_rows: int = 1) -> tuple[dict, bytes]:
    """Cards and data of the table that holds an image of whole numbers in Rice-coded tiles of full rows; int16, int32 or uint8."""
    h, w = data.shape
    parts = []
    for y in range(0, h, max(1, tile_rows * (1 << 18) // max(1, w * tile_rows))):
        rows = data[y : y + max(1, tile_rows * (1 << 18) // max(1, w * tile_rows))]
        whole = len(rows) // tile_rows * tile_rows
        parts += rice_encode(rows[:whole].reshape(-1, tile_rows * w)) if whole else []
        parts += rice_encode(rows[whole:].reshape(1, -1)) if whole < len(rows) else []
    return _table(parts, data, tile_rows)


def compressed_alike(images: list[np.ndarray]) -> list[tuple[dict, bytes]]:
    """compressed() of images of one shape and kind, whose tiles are coded together."""
    h, w = images[0].shape
    most = (1 << 18) // (h * w)
    if most < 2:
        return [compressed(x) for x in images]
    out = []
    for a in range(0, len(images), most):
        some = images[a : a + most]
        parts = rice_encode(np.concatenate(some))
        out += [_table(parts[i * h : i * h + h], x, 1) for i, x in enumerate(some)]
    return out


def _table(parts: list[bytes], data: np.ndarray, tile_rows: int) -> tuple[dict, bytes]:
    h, w = data.shape
    size = data.dtype.itemsize
    lens = np.array([len(x) for x in parts])
    table = np.stack([lens, np.cumsum(lens) - lens], axis=1).astype(">i4").tobytes()
    heap = b"".join(parts)
    cards = {
        "BITPIX": 8, "NAXIS": 2, "NAXIS1": 8, "NAXIS2": len(parts), "PCOUNT": len(heap), "GCOUNT": 1, "TFIELDS": 1, "TTYPE1": "COMPRESSED_DATA", "TFORM1": f"1PB({max([0, *lens.tolist()])})",
        "ZIMAGE": True, "ZBITPIX": 8 * size, "ZNAXIS": 2, "ZNAXIS1": w, "ZNAXIS2": h, "ZTILE1": w, "ZTILE2": tile_rows, "ZCMPTYPE": "RICE_1", "ZNAME1": "BLOCKSIZE", "ZVAL1": BLOCK, "ZNAME2": "BYTEPIX", "ZVAL2": size,
    }
    return cards, table + heap
