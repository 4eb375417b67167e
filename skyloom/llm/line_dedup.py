"""Line dedup with a sharded minimal perfect hash.

Rows of (line hash, block, documents) are dealt to shards by hash. Each shard builds a minimal perfect hash over its
distinct line hashes; the hash's ranks index two arrays, of 32-bit fingerprints and of document counts. Each block of
documents asks every shard about its own distinct line hashes (8 bytes each) and gets back those that are frequent;
no line is shipped. Hot lines, fewer than HOT, form a shard of their own whose arrays go to all blocks, so that a line
that stands in every document is no row of every block in one task.

Defined results: a null or empty text is one empty line, which is never dropped; each row counts as a document, also
with a repeated or null id; other columns are kept as they are, whatever they are called. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, hash64, hot_keys, mixed, n_blocks, only, operator, text_slices, utf8, written

MOST = 65535


class PerfectHash:
    """Levels of bit arrays; a key's rank among all set bits is its place, from 0 to n - 1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [np.cumsum(x, dtype=np.int64) for x in levels]
        starts = np.concatenate([[0], np.cumsum([int(x[-1]) for x in ones])]) if ones else [0]
        self.ranks = [x - 1 + int(s) for x, s in zip(ones, starts)]

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        """keys: distinct, uint64."""
        levels, left = [], keys
        while len(left):
            m = max(64, int(gamma * len(left)))
            at = (mixed(left, len(levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Places; -1 for a key that certainly isn't in the set."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for i, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(todo):
                break
            at = (mixed(keys[todo], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u4", n, 4), 4 + 4 * n, []
        for m in map(int, sizes):
            size = -(-m // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=m).astype(bool))
            at += size
        return cls(levels)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 77) >> np.uint64(32)).astype(np.uint32)


def keys_of(text: bytes) -> list[bytes]:
    """The key of each line: stripped of ASCII white space, A-Z lower-cased."""
    return [x.strip() for x in text.lower().split(b"\n")]


def _line_rows(batches):
    """(hash, block, documents that have the line) of each slice of a batch."""
    only()
    for batch in batches:
        blocks, all_texts = batch.column(1).to_numpy(zero_copy_only=False), utf8(batch.column(0))
        for s in text_slices(all_texts):
            own = [np.fromiter({hash64(k) for k in keys_of(t) if k}, np.uint64) for t in all_texts[s]]
            both = np.empty(sum(map(len, own)), dtype=[("h", np.int64), ("b", np.int32)])
            if not len(both):
                continue
            both["h"], both["b"] = np.concatenate(own).view(np.int64), np.repeat(blocks[s], [len(x) for x in own])
            both, n = np.unique(both, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both["h"]), pa.array(both["b"]), pa.array(n.astype(np.int64))], names=["h", "block", "n"])


INDEX = "shard int, n_lines long, places binary, fingerprints binary, counts binary"


class LineIndex:
    """The perfect hash with the fingerprints and counts at its places."""

    def __init__(self, places: PerfectHash, fingerprints: np.ndarray, counts: np.ndarray):
        self.places, self.fingerprints, self.counts = places, fingerprints, counts

    @classmethod
    def build(cls, keys: np.ndarray, totals: np.ndarray) -> LineIndex:
        places = PerfectHash.build(keys)
        at = places(keys)
        out = cls(places, np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint16))
        out.fingerprints[at], out.counts[at] = _fingerprints(keys), np.minimum(totals, MOST)
        return out

    def frequent(self, keys: np.ndarray, min_docs: int) -> np.ndarray:
        at = self.places(keys)
        return (at >= 0) & (self.fingerprints[at] == _fingerprints(keys)) & (self.counts[at] >= min_docs) if len(self.counts) else np.zeros(len(keys), bool)


def _build(rows: pa.Table) -> pa.Table:
    index = LineIndex.build(rows["h"].to_numpy().view(np.uint64), rows["n"].to_numpy())
    return pa.table({
        "shard": pa.array([rows["shard"][0].as_py()], pa.int32()), "n_lines": pa.array([rows.num_rows], pa.int64()), "places": pa.array([index.places.to_bytes()], pa.binary()),
        "fingerprints": pa.array([index.fingerprints.tobytes()], pa.binary()), "counts": pa.array([index.counts.tobytes()], pa.binary()),
    })


def _probe(min_docs: int):
    def step(asked: pa.Table, index: pa.Table) -> pa.Table:
        h, block = asked["h"].to_numpy(), asked["block"].to_numpy()
        if not len(index) or not len(h):
            return pa.table({"block": pa.array([], pa.int32()), "h": pa.array([], pa.int64())})
        read = lambda name, kind: np.frombuffer(index[name][0].as_py(), kind)
        hit = LineIndex(PerfectHash.from_bytes(index["places"][0].as_py()), read("fingerprints", np.uint32), read("counts", np.uint16)).frequent(h.view(np.uint64), min_docs)
        return pa.table({"block": pa.array(block[hit], pa.int32()), "h": pa.array(h[hit], pa.int64())})

    return step


def line_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row a shard: the perfect hash and its two arrays. counts: h, n; one row a hash."""
    return counts.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(_build, INDEX)


def _shard(shards: int):
    return F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int")


def _drop(at: int, names: list[str], extra: bool, hot: LineIndex, min_docs: int):
    def step(docs: pa.Table, frequent: pa.Table) -> pa.Table:
        texts = utf8(docs.column(at).combine_chunks())
        keys = np.array([hash64(k) if k else 0 for t in texts for k in keys_of(t)], np.uint64)
        known, of = np.unique(keys, return_inverse=True)
        gone = ((hot.frequent(known, min_docs) | np.isin(known, frequent["h"].to_numpy().view(np.uint64))) & (known != 0))[of]
        kept, lines, dropped, start = [], [], [], 0
        for text in texts:
            own = text.split(b"\n")
            bad = gone[start : start + len(own)]
            start += len(own)
            n = int(bad.sum())
            kept.append(b"\n".join([x for x, g in zip(own, bad.tolist()) if not g]) if n else text)
            lines.append(len(own))
            dropped.append(n)
        out = docs.set_column(at, names[at], pa.array(kept, pa.binary()).cast(pa.string()))
        out = out.select(list(range(len(names))))
        if extra:
            out = out.append_column("n_lines", pa.array(lines, pa.int64())).append_column("n_dropped", pa.array(dropped, pa.int64()))
        return out

    return step


@operator
def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, counts: bool = False) -> DataFrame:
    """docs (doc_id, text and any others) without the lines whose key stands in at least min_docs documents.

    counts: append n_lines and n_dropped (docs must not have such columns then)."""
    if min_docs > MOST:
        raise ValueError(f"min_docs is at most {MOST}, what a place of the count array holds")
    blocks = n_blocks(docs)
    block = F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(blocks)).cast("int")
    rows = written(docs.select("text", block.alias("block")).mapInArrow(_line_rows, "h long, block int, n long"), "line-rows")
    totals = written(rows.groupBy("h").agg(F.sum("n").alias("n")), "line-counts")  # combined in each task first, so a hot line is a row a task
    common = hot_keys(totals)
    hot = common.toPandas()  # fewer than HOT rows
    index = line_index(totals.join(F.broadcast(common.select("h")), "h", "left_anti"), blocks)
    asked = rows.select("h", "block").join(F.broadcast(common.select("h")), "h", "left_anti").distinct()
    frequent = asked.withColumn("shard", _shard(blocks)).groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe(min_docs), "block int, h long")
    names = docs.columns
    mark = free_name("block", names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + (", n_lines long, n_dropped long" if counts else "")
    step = _drop(names.index("text"), names, counts, LineIndex.build(hot["h"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)), min_docs)
    return docs.withColumn(mark, block).groupBy(mark).cogroup(frequent.groupBy("block")).applyInArrow(step, schema)


def digest(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    kept = drop_frequent_lines(docs.select(F.col("doc_id").cast("long"), "text"), min_docs, counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
