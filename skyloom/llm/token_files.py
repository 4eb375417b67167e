"""Token files: a concatenated id array with Elias-Fano document boundaries.

A file holds documents in ascending doc_id order: their ids one after another (16 bits each if the vocabulary allows),
the boundaries and the doc_ids as Elias-Fano sequences. A sequence of n values below u keeps floor(log2(u / n)) low
bits of each as they are and the high bits in unary; select finds the i-th one by a directory of every 256th one and
byte popcounts, so no 64-bit table is needed. A document's place among all files is its file's base plus its offset.

Defined results: null and empty texts have only the end id; a null doc_id sorts first and reads back as null; equal
doc_ids are ordered by a hash of the text, then the text; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PieceTable, gathered, input_bytes, keeps, only, operator, strings, written

SHARD_BYTES, MOST_SHARDS = 8 << 20, 100_000
#: Ids in a file, about; a document is never cut.
FILE_IDS = 2 << 20
END = 1
EVERY = 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: Of each byte: its ones, the ones before each bit, and the bit of the n-th one.
_ONES = _BITS.sum(axis=1)
_LOWER = np.cumsum(_BITS, axis=1) - _BITS
_NTH = np.argsort(1 - _BITS, axis=1, kind="stable")
PIECES, TOGETHER, CALL_BYTES = 600_000, 500, 16 << 20


class EliasFano:
    """A non-decreasing sequence of integers from 0."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = ((values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, np.packbits(low.astype(np.uint8).ravel()), np.packbits(high), ones[::EVERY].astype(np.uint32))

    def select(self, i: int) -> int:
        """Place of the i-th one among the high bits."""
        at = int(self.directory[i // EVERY])
        left = i % EVERY
        if not left:
            return at
        bits = np.unpackbits(self.high[at // 8 : at // 8 + 1])[at % 8 + 1 :]
        if bits.sum() >= left:
            return at + 1 + int(np.flatnonzero(bits)[left - 1])
        left -= int(bits.sum())
        byte = at // 8 + 1
        while _ONES[self.high[byte]] < left:
            left -= int(_ONES[self.high[byte]])
            byte += 1
        return 8 * byte + int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1]))[left - 1])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low, first = 0, i * self.low_bits
        if self.low_bits:
            own = np.unpackbits(self.low[first // 8 : (first + self.low_bits + 7) // 8])[first % 8 :][: self.low_bits]
            low = int((own.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum())
        return (self.select(i) - i) << self.low_bits | low

    def places(self, i: np.ndarray) -> np.ndarray:
        """select for many i at once: from each one's directory entry, byte by byte, all of them together."""
        at = self.directory[i // EVERY].astype(np.int64)  # the bit of the value that the directory has
        byte, left = at >> 3, i % EVERY + _LOWER[self.high[at >> 3], at & 7]  # values before the wanted one, from the byte's start
        todo = np.flatnonzero(left >= _ONES[self.high[byte]])
        while len(todo):
            left[todo] -= _ONES[self.high[byte[todo]]]
            byte[todo] += 1
            todo = todo[left[todo] >= _ONES[self.high[byte[todo]]]]
        return 8 * byte + _NTH[self.high[byte], left]

    def take(self, i: np.ndarray) -> np.ndarray:
        """The values at many places."""
        i = np.asarray(i, np.int64)
        out = (self.places(i) - i).astype(np.uint64) << np.uint64(self.low_bits)
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            out |= ((self.low[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(k)
        return out

    def all(self) -> np.ndarray:
        """Every value, by one scan of the bits, without the directory; the check on take()."""
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n].astype(np.uint64)
        low = np.unpackbits(self.low, count=self.n * self.low_bits).reshape(self.n, self.low_bits).astype(np.uint64)
        return (ones - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.low_bits) | (low << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.directory)], "<u4")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.directory.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence at a place of data, and where it ends."""
        n, low_bits, low, high, directory = map(int, np.frombuffer(data, "<u4", 5, at))
        at += 20
        parts = np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, high, at + low), np.frombuffer(data, "<u4", directory, at + low + high)
        return cls(n, low_bits, *parts), at + low + high + 4 * directory


MAGIC = b"EFTOKEN1"


def pack(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """A file. ids: of each document, as little-endian integers of `width` bytes. doc_ids: ascending, nulls first."""
    nulls = sum(x is None for x in doc_ids)
    real = np.array(doc_ids[nulls:], np.int64)
    base = int(real[0]) if len(real) else 0
    ends = np.cumsum([len(x) // width for x in ids])
    head = MAGIC + np.array([width, nulls], "<u4").tobytes() + np.array([base], "<i8").tobytes()
    return head + EliasFano.build((real.astype(object) - base).astype(np.uint64)).to_bytes() + EliasFano.build(ends).to_bytes() + b"".join(ids)


class TokenFile:
    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        (self.width, self.nulls), (self.base,) = map(int, np.frombuffer(data, "<u4", 2, 8)), map(int, np.frombuffer(data, "<i8", 1, 16))
        self.names, at = EliasFano.from_bytes(data, 24)
        self.ends, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{self.width}", -1, at) if at < len(data) else np.zeros(0, f"<u{self.width}")

    def __len__(self) -> int:
        return self.ends.n

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.names[i - self.nulls]

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0 : self.ends[i]]


class Encoder:
    """A tokenizer of the tokenizers library over whole texts; pieces between spaces are remembered, up to PIECES of them.

    Its normaliser and splitter drop white space and never join what stands on both sides of it, so the ids of a text
    are those of its pieces in order."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized and t.content.startswith("<")]
        self.mark_id, self.mark = special[0] if special else (-1, "")
        self.pieces = PieceTable(self._new, f"<u{self.width}", PIECES)
        self.plain = self._words_are_plain()

    def _new(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece. A word of a-z goes to the model at once, as nothing before it would change or cut it; the
        others go through the whole tokenizer, many as one text, cut by a special token, on whose two sides it works apart."""
        kind, word = self.pieces.kind, self.tokenizer.model.tokenize
        out: list = [np.array([t.id for t in word(p)], kind) if self.plain and p.isascii() and p.isalpha() and p.islower() else None for p in pieces]
        joined = [i for i, p in enumerate(pieces) if out[i] is None and self.mark and "<" not in p]
        for start in range(0, len(joined), TOGETHER):
            own = joined[start : start + TOGETHER]
            (got,) = self.tokenizer.encode_batch_fast([self.mark.join([pieces[i] for i in own])], add_special_tokens=False)
            ids = np.array(got.ids, kind)
            cuts = np.flatnonzero(ids == self.mark_id).tolist()
            for i, a, b in zip(own, [-1, *cuts], [*cuts, len(ids)], strict=True):
                out[i] = ids[a + 1 : b]
        other = [i for i in range(len(pieces)) if out[i] is None]
        for i, e in zip(other, self.tokenizer.encode_batch_fast([pieces[i] for i in other], add_special_tokens=False)):
            out[i] = np.array(e.ids, kind)
        return out

    def _words_are_plain(self) -> bool:
        """Does the tokenizer lower-case, and give a word of a-z to its model whole and as it is? Asked of the tokenizer itself."""
        t, letters = self.tokenizer, "abcdefghijklmnopqrstuvwxyz"
        if not (t.normalizer and t.pre_tokenizer) or t.normalizer.normalize_str(letters.upper() + letters) != letters * 2:
            return False
        cut = lambda x: [p for p, _ in t.pre_tokenizer.pre_tokenize_str(x)]
        return cut(letters) == [letters] and cut(f"{letters}., {letters}") == [letters, ".,", letters]

    def spell(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, which have no space, one word after the other, and the number of each one's, without remembering any. A piece that several of them have is spelled once."""
        if self.plain:
            words = pc.replace_substring_regex(words, r"([a-z])([.,])", r"\1 \2")
        cut = pc.split_pattern(words, " ")
        flat = cut.flatten().dictionary_encode()
        ids, at = self._new(strings(flat.dictionary)), flat.indices.to_numpy()
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        ends, own = np.cumsum(lens), lens[at]
        total = np.concatenate([[0], np.cumsum(own)])
        every = np.concatenate([np.zeros(0, self.pieces.kind), *ids])[np.repeat((ends - lens)[at] - total[:-1], own) + np.arange(total[-1])]
        return every, np.diff(total[cut.offsets.to_numpy()])

    def __call__(self, texts, end: int | None = END) -> list[bytes]:
        """texts: strings, as a list or an Arrow array without nulls.

        Where words are plain, A-Z are lower-cased beforehand and a point or comma is set apart from the letter before it."""
        tail = b"" if end is None else np.array([end], self.pieces.kind).tobytes()
        texts = pc.replace_substring(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "\n", " ")
        if self.plain:
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,])", r"\1 \2")
        return [x.tobytes() + tail for x in self.pieces.ids(pc.split_pattern(texts, " "))]


_ENCODERS: dict[str, Encoder] = {}


keeps("tokens", _ENCODERS.clear)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _files(path: str):
    def step(batches):
        only("tokens")
        encode = encoder(path)
        part, before, names, ids, size = 0, 0, [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(names)], pa.int64()),
                    pa.array([size // encode.width], pa.int64()), pa.array([pack(names, ids, encode.width)], pa.binary()),
                ],
                names=["part", "ids_before", "n_docs", "n_ids", "content"],
            )

        for batch in gathered(batches, CALL_BYTES):
            for name, own in zip(batch.column(0).to_pylist(), encode(pc.fill_null(batch.column(1), ""))):
                names.append(name)
                ids.append(own)
                size += len(own)
                if size >= FILE_IDS * encode.width:
                    yield flush()
                    part, before, names, ids, size = part + 1, before + size // encode.width, [], [], 0
        if names:
            yield flush()

    return step


@operator
def write_files(docs: DataFrame, path: str) -> DataFrame:
    """The files in doc_id order: shard, part, ids before it in the shard, documents, ids, bytes. Documents are range-partitioned by doc_id; ties are dealt by a hash of the text."""
    total = input_bytes(docs)
    shards = max(16, min(MOST_SHARDS, total // SHARD_BYTES))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("h", F.xxhash64("text"))
    own = own.repartitionByRange(shards, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    files = own.select("doc_id", "text").mapInArrow(_files(path), "part int, ids_before long, n_docs long, n_ids long, content binary")
    return written(files.withColumn("shard", F.spark_partition_id()), "token-files")


def with_base(files: DataFrame) -> DataFrame:
    """files with `base`, the ids in all files before. There are MOST_SHARDS shards at most, so their sums are ordered in one task and broadcast."""
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_base"))
    return files.join(F.broadcast(bases), "shard").withColumn("base", F.col("shard_base") + F.col("ids_before"))


def _read(batches):
    for batch in batches:
        for base, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f = TokenFile(content)
            ends = f.ends.take(np.arange(len(f))).astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            names = [None] * f.nulls + (f.names.take(np.arange(f.names.n)).astype(np.int64) + f.base).tolist()
            crc = [zlib.crc32(f.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(starts + base), pa.array(ends - starts), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_files(files: DataFrame) -> DataFrame:
    """Each document's place among all ids, its number of ids, and their crc32."""
    return with_base(files).select("base", "content").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame, path: str) -> DataFrame:
    return read_files(write_files(docs, path))
