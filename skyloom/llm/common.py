"""What the text operators share: table access, the shared work folder, blocks, byte-level words."""

from __future__ import annotations

import functools
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import shipping

#: `[\x20\x09-\x0D]`, which is also what bytes.split() and bytes.strip() take as white space.
WHITE = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 2 << 20
#: What a batch of rows may hold on its way to Python and back, so that a worker's memory is bounded by bytes, not by rows.
BATCH_BYTES = 4 << 20
#: Keys that hold more than 1 / HOT of all rows are hot; so there are fewer than HOT of them, which bounds their broadcast.
HOT = 10_000


def ship(spark: SparkSession) -> None:
    """Gives the executors this package and bounds batches by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    shipping.ship(spark)


def operator(f):
    """An operator whose first argument is a DataFrame: the executors get the package before it runs."""

    @functools.wraps(f)
    def with_package(df, *args, **kwargs):
        ship(df.sparkSession)
        return f(df, *args, **kwargs)

    return with_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _top(spark: SparkSession) -> str:
    """This application's folder in the one that the cluster shares; in a temporary folder only where none is set and everything runs in one process, as in tests."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        top = f"file://{tempfile.gettempdir()}/skyloom-checkpoints"
        spark.conf.set("spark.checkpoint.dir", top)
        spark.sparkContext.setCheckpointDir(top)
    return f"{top.rstrip('/')}/skyloom/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    return f"{_top(spark)}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def let_go(*tables: DataFrame) -> None:
    """Deletes tables that written() made and that nothing reads any more."""
    for df in tables:
        if path := df.__dict__.pop("_work_path", None):
            _remove(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; results that were not stored yet can't be computed after it."""
    _remove(spark, _top(spark))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and a lost executor loses nothing. The shuffles behind it go at once."""
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_work_path"] = path
    return out


def hot_keys(counts: DataFrame, n: str = "n") -> DataFrame:
    """The rows of counts (one a key, n: how many rows the key has) whose key is hot; fewer than HOT."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    return counts.where(F.col(n) * HOT > F.lit(total))


def join_facts(rows: DataFrame, facts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """rows with the facts of their key, both sides having one column of that name. facts: one row of bounded size a key, n of them in rows.

    Hot keys' facts are broadcast, so that their rows stay where they are; the others meet in a shuffle."""
    hot = hot_keys(facts, n)
    if hot.isEmpty():
        return rows.join(facts, key)
    common = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts.join(F.broadcast(hot.select(key)), key, "left_anti"), key)
    return common.unionByName(rest)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size, without running anything; 64 MB a partition where it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else df.rdd.getNumPartitions() << 26


def n_blocks(df: DataFrame, block_bytes: int = BLOCK_BYTES, least: int = 64) -> int:
    """How many blocks cut df to about block_bytes each; grows with the input."""
    return min(2**31 - 1, max(least, -(-input_bytes(df) // block_bytes)))


def free_name(stem: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever the case."""
    name, lower = f"__{stem}", {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def utf8(column) -> list[bytes]:
    """A string column's values as bytes; null becomes b''."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The values of a string column without nulls or spaces, joined and cut again, which takes a tenth of the time of to_pylist()."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(column)], column), " ")[0].as_py().split(" ") if len(column) else []


def hash64(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


#: What workers keep between tasks, by operator: how to let it go.
_KEPT: dict[str, object] = {}


def keeps(operator: str, let_go) -> None:
    _KEPT[operator] = let_go


def only(operator: str = "") -> None:
    """At a task's start: lets go of what other operators keep in this worker, so that a pipeline's stages don't add up."""
    for name, let_go in _KEPT.items():
        if name != operator:
            let_go()


class WordHashes:
    """64-bit hashes of words; the dictionary is emptied when it reaches `most` entries."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            if len(known) > self.most:
                known.clear()
            for w in set(words):
                if w not in known:
                    known[w] = hash64(w)
            return np.array([known[w] for w in words], dtype=np.uint64)


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser on an array."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed + 1) * _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


def shingles(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, in order; one for the whole sequence if it is shorter; none without words."""
    if len(word_hashes) == 0:
        return np.zeros(0, np.uint64)
    n = min(n, len(word_hashes))
    m = len(word_hashes) - n + 1
    h = np.full(m, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h += word_hashes[i : i + m] * (_MIX[i % 3] + np.uint64(2 * i))
    return mixed(h)


def batch_shingles(texts: list[bytes], n: int, hashes: WordHashes) -> tuple[list[np.ndarray], np.ndarray]:
    """shingles() of each text's words, A-Z lower-cased, computed for all texts at once; and the numbers of words."""
    words, lens = [], []
    for t in texts:
        own = t.lower().split()
        words += own
        lens.append(len(own))
    h = hashes(words)
    ends = np.cumsum(lens)
    all_runs = shingles(h, n) if len(h) >= n else h[:0]
    out = []
    for end, size in zip(ends.tolist(), lens):
        start = end - size
        out.append(all_runs[start : end - n + 1] if size >= n else shingles(h[start:end], n))
    return out, np.array(lens, np.int64)


def text_slices(texts: list[bytes], most: int = 1 << 20):
    """Slices of about `most` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def gathered(batches, most: int):
    """Batches joined until they hold about `most` bytes, for work that pays once a call."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class PieceTable(dict):
    """Numbers pieces of text in order of appearance and holds the ids of each. When it holds `most` pieces, it keeps those that more than one call had, the most frequent half of `most` at most.

    encode_new: from a list of new pieces to their lists of ids (arrays)."""

    def __init__(self, encode_new, kind: str, most: int):
        super().__init__()
        self.encode_new, self.kind, self.most = encode_new, kind, most
        self.fresh: list[str] = []
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0
        self.starts, self.lens, self.calls = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def forget(self) -> None:
        calls = self.calls[: len(self)]
        keep = np.flatnonzero(calls > 1)
        if len(keep) > self.most // 2:
            keep = np.sort(keep[np.argpartition(-calls[keep], self.most // 2)[: self.most // 2]])
        pieces = list(self)
        self.clear()
        self.update(zip([pieces[i] for i in keep.tolist()], range(len(keep))))
        starts, lens = self.starts[keep], self.lens[keep]
        ends = np.cumsum(lens)
        self.used = int(ends[-1]) if len(ends) else 0
        self.flat[: self.used] = self.flat[np.repeat(starts - ends + lens, lens) + np.arange(self.used)]
        self.starts[: len(keep)], self.lens[: len(keep)], self.calls[: len(keep)] = ends - lens, lens, 1
        self.calls[len(keep) :] = 0

    def __missing__(self, piece: str) -> int:
        i = len(self)
        self[piece] = i
        self.fresh.append(piece)
        return i

    def _learn(self) -> None:
        ids = self.encode_new(self.fresh)
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        done, total = len(self) - len(ids), int(lens.sum())
        while len(self.starts) < len(self):
            self.starts, self.lens, self.calls = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens, self.calls))
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, self.flat])
        self.starts[done : len(self)] = self.used + np.cumsum(lens) - lens
        self.lens[done : len(self)] = lens
        if total:
            self.flat[self.used : self.used + total] = np.concatenate(ids)
        self.used += total
        self.fresh = []

    def parts(self, cut: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts cut into pieces: all ids, the number of ids of each piece, and the bounds of the texts among the pieces.

        Arrow numbers the pieces of this call, so that each distinct one is looked up once."""
        if len(self) > self.most:
            self.forget()
        own = cut.flatten().dictionary_encode()
        numbers = np.fromiter((self[u] for u in own.dictionary.to_pylist()), np.int64, len(own.dictionary))
        if self.fresh:
            self._learn()
        self.calls[numbers] += 1
        at = numbers[own.indices.to_numpy()] if len(own) else numbers[:0]
        lens = self.lens[at]
        total = np.cumsum(lens)
        out = self.flat[np.repeat(self.starts[at] - total + lens, lens) + np.arange(total[-1] if len(total) else 0)]
        return out, lens, cut.offsets.to_numpy() - cut.offsets[0].as_py() if len(cut) else np.zeros(1, np.int32)

    def ids(self, cut: pa.ListArray) -> list[np.ndarray]:
        """For texts cut into pieces, the ids of each text."""
        out, lens, bounds = self.parts(cut)
        ends = np.concatenate([[0], np.cumsum(lens)])[bounds]
        return [out[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
