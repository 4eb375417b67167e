r"""Repeated byte strings by merging Burrows-Wheeler transforms.

Texts are bytes; a position is repeated if the LENGTH bytes from it also start somewhere else. The alphabet is
blocks: a symbol is the hash of SYMBOL bytes, and a text has one symbol sequence for each phase, so that every byte
position is a suffix and DEPTH symbols are LENGTH bytes.

1. Candidates. In every window of LENGTH bytes the least hash of its GRAM-byte strings is the window's anchor, found
   from its bytes alone: equal windows have equal anchors at equal offsets. Anchors that stand once in the corpus are
   dropped; each remaining occurrence brings a snippet, the bytes of the windows whose anchor it is.
2. Buckets of anchors go to tasks. A bucket's snippets are cut into shards of SHARD bytes, several in most buckets;
   each shard sorts its own suffixes by prefix doubling and yields its transform. The shards are merged by refining an
   interleave: from the order by the first k symbols, the transforms' symbols give the order by k + 1, stably, and a
   boundary appears where neighbours first differ, which is their common prefix. After DEPTH steps the intervals
   without a boundary are the repeated windows; only the merge tells them. No suffix is compared or sorted again.
3. An anchor of more than SPLIT distinct snippets (the edge of a passage that very many texts have) is no one task's:
   its windows are dealt by their own first and last SYMBOL bytes, and only those whose pair of ends stands twice go on.

Equal texts are analysed once; if there are several, all of a text of LENGTH bytes or more is repeated. Snippets of
equal bytes and offset are combined before they are shuffled, so a passage that stands in very many texts is one row a
task inside, and only its edges differ.

Defined results: null and empty texts have no bytes; each row is a text, also with a repeated id; extra columns are
ignored. An empty table gives none. Hashes have 64 bits; texts are told apart by 60 bits of their SHA-256. What the thin alphabet
of four symbols loses: the order of suffixes is that of hashes, not of bytes, so equal strings stand together but sorted
neighbours mean nothing more, and repeats are found at LENGTH bytes only, not at every length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, join_facts, let_go, mixed, n_blocks, only, operator, text_slices, utf8, written

LENGTH, GRAM = 200, 50
DEPTH = 4
SYMBOL = LENGTH // DEPTH
#: Bytes of text behind a bucket, the least number of buckets, and bytes of snippets in a shard.
BUCKET, LEAST, SHARD = 1 << 20, 64, 1 << 15
SPLIT = 4096
_R = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2 ** 64."""
    with np.errstate(over="ignore"):
        up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _R, np.uint64))])
        down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, pow(_R, -1, 1 << 64), np.uint64))])
    return up, down


_UP, _DOWN = _powers(1 << 16)
_STEP = 1 << 16


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the strings of `width` bytes, one a position."""
    global _UP, _DOWN
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    if len(_UP) <= n:
        _UP, _DOWN = _powers(2 * n)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:n])])
        return mixed((total[width:] - total[: n - width + 1]) * _DOWN[: n - width + 1], width)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of LENGTH bytes in order: the place of each one's anchor; and the hashes of all places."""
    h = rolling(data, GRAM)
    width = LENGTH - GRAM + 1
    m = len(h) - width + 1
    if m <= 0:
        return np.zeros(0, np.int64), h
    # minima of hash and place, the later place first, by blocks of `width`; the last 20 bits of a hash give way to the place
    size = -(-len(h) // width) * width
    key = np.full(size, np.uint64(2**64 - 1))
    if len(h) < 1 << 20:
        bits, top = np.uint64(20), h >> np.uint64(20)
    else:
        bits, top = np.uint64(len(h).bit_length()), np.unique(h >> np.uint64(20), return_inverse=True)[1].astype(np.uint64)
    key[: len(h)] = (top << bits) + (np.uint64(len(h)) - np.arange(len(h), dtype=np.uint64))
    blocks = key.reshape(-1, width)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(left[:m], right[width - 1 : width - 1 + m])
    return len(h) - (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), h


def _anchor_rows(batches):
    """(anchor, text, place) of each slice of a batch."""
    only()
    for batch in batches:
        all_texts, keys = utf8(batch.column(1)), batch.column(0).to_numpy()
        for s in text_slices(all_texts):
            found, places, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
            for text in all_texts[s]:
                at, h = anchors(np.frombuffer(text, np.uint8))
                at = np.unique(at)
                found.append(h[at])
                places.append(at)
                owners.append(len(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(keys[s], owners)), pa.array(np.concatenate(places))], names=["anchor", "key", "at"])


SNIPPET = "anchor long, key long, first long, before int, bytes binary"


def _snippets(batches):
    """The windows of each wanted anchor: where the first one starts, how far before the anchor that is, and their bytes."""
    only()
    for batch in batches:
        cols = [[], [], [], [], []]
        for key, text, wanted in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
            at, h = anchors(np.frombuffer(text, np.uint8))
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            ends = np.r_[starts[1:], len(at)]
            chosen = np.isin(at[starts], np.array(wanted, np.int64))
            for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist()):
                for c, x in zip(cols, (int(h[at[a]].view(np.int64)), key, a, int(at[a]) - a, text[a : b - 1 + LENGTH])):
                    c.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["anchor", "key", "first", "before", "bytes"])


def _stable(values: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative integers, by sorting value and place as one number."""
    bits = np.uint64(max(1, len(values).bit_length()))
    key = (values.astype(np.uint64) << bits) | np.arange(len(values), dtype=np.uint64)
    key.sort()
    return (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _pair_ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense ranks of the pairs (a, b) of ranks below their number."""
    n = len(a)
    bits = np.uint64(max(1, n.bit_length()))
    if 3 * int(bits) > 64:
        return np.unique(a * (n + 1) + b, return_inverse=True)[1]
    key = ((a.astype(np.uint64) << bits | b.astype(np.uint64)) << bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    pair = key >> bits
    out = np.empty(n, np.int64)
    out[(key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = np.cumsum(np.r_[False, pair[1:] != pair[:-1]])
    return out


class Shard:
    """Symbol sequences of some snippets, their sorted suffixes and the transform.

    Rows are all (snippet, place), from 0 to the snippet's length. Places without a whole symbol are the ends of the
    SYMBOL sequences, and the first SYMBOL places have an end before them, so both are as many."""

    def __init__(self, snippets: list[bytes]):
        sizes = np.array([len(s) + 1 for s in snippets], np.int64)
        data = np.frombuffer(b"\0".join(snippets) + b"\0", np.uint8)
        self.n = n = len(data)
        self.snippet = np.repeat(np.arange(len(snippets)), sizes)
        self.place = np.arange(n) - (np.cumsum(sizes) - sizes)[self.snippet]
        left = sizes[self.snippet] - self.place
        symbol = np.zeros(n, np.uint64)
        symbol[: n - SYMBOL + 1] = np.maximum(rolling(data, SYMBOL), np.uint64(1))
        symbol[left <= SYMBOL] = 0
        # ranks by 1, 2, 4 symbols; an end is less than any symbol, and nothing comes after it
        rank, depth = np.unique(symbol, return_inverse=True)[1], 1
        while depth < DEPTH:
            step = depth * SYMBOL
            later = np.zeros(n, np.int64)
            later[: max(0, n - step)] = rank[step:]
            later[left <= step] = 0
            rank, depth = _pair_ranks(rank, later), 2 * depth
        self.order = _stable(rank)
        before = np.zeros(n, np.uint64)
        before[SYMBOL:] = symbol[:-SYMBOL]
        before[self.place < SYMBOL] = 0
        self.transform = before[self.order]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The interleave of the shards' suffixes by their first DEPTH symbols: shard, row in its order, and common prefix with the row before (in symbols, DEPTH at most)."""
    sizes = np.array([s.n for s in shards], np.int64)
    all_bwt = np.concatenate([s.transform for s in shards])
    alphabet, symbols = np.unique(all_bwt, return_inverse=True)
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(shards), dtype=np.uint16 if len(shards) < 1 << 16 else np.int64), sizes)
    common = np.full(len(owner), DEPTH, np.int64)
    common[0] = 0
    boundary = np.zeros(len(owner), bool)
    boundary[0] = True
    assert alphabet[0] == 0  # the end
    for step in range(DEPTH):
        # the next unused symbol of each row's shard
        seen = np.argsort(owner, kind="stable")
        row = np.empty(len(owner), np.int64)
        row[seen] = np.arange(len(owner))  # rows of shard 0 first, in order: their places in all_bwt
        symbol = symbols[row]
        order = _stable(symbol)
        group = np.cumsum(boundary)[order]
        symbol, owner = symbol[order], owner[order]
        boundary = np.r_[True, (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])]
        boundary |= symbol == 0  # no two ends are equal
        common = np.where(boundary & (common == DEPTH), step, common)
    seen = np.argsort(owner, kind="stable")
    row = np.empty(len(owner), np.int64)
    row[seen] = np.arange(len(owner))
    return owner, row - base[owner], np.where(boundary, np.minimum(common, DEPTH - 1), DEPTH)


def repeated_places(snippets: list[bytes], weights: np.ndarray, shard_bytes: int = SHARD) -> list[tuple[int, np.ndarray]]:
    """For each snippet that has any: the places whose LENGTH bytes also stand at another place. weights: how many times the snippet stands."""
    shards, owners, start, size = [], [], 0, 0
    for i, s in enumerate(snippets):
        size += len(s)
        if size >= shard_bytes or i == len(snippets) - 1:
            shards.append(Shard(snippets[start : i + 1]))
            owners.append(start)
            start, size = i + 1, 0
    shard, row, common = merge(shards)
    ends = np.cumsum([s.n for s in shards])
    at = row + (ends - [s.n for s in shards])[shard]
    snippet = np.concatenate([k + s.snippet[s.order] for k, s in zip(owners, shards)])[at]
    place = np.concatenate([s.place[s.order] for s in shards])[at]
    lens = np.array([len(s) for s in snippets], np.int64)
    whole = place + LENGTH <= lens[snippet]
    interval = np.cumsum(common < DEPTH) - 1
    times = np.bincount(interval[whole], weights=weights[snippet[whole]], minlength=interval[-1] + 1)
    hit = whole & (times[interval] > 1)
    s, p = snippet[hit], place[hit]
    order = np.lexsort((p, s))
    s, p = s[order], p[order]
    cuts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else []
    return [(int(s[a]), x) for a, x in zip(cuts, np.split(p, cuts[1:]) if len(s) else [])]


def _runs(sorted_places: np.ndarray) -> list[tuple[int, int]]:
    """[first, last] of each run of consecutive places."""
    cuts = np.flatnonzero(np.diff(sorted_places) > 1)
    return list(zip(sorted_places[np.r_[0, cuts + 1]].tolist(), sorted_places[np.r_[cuts, len(sorted_places) - 1]].tolist()))


def _bucket(rows: pa.Table) -> pa.Table:
    """One bucket of distinct snippets with their numbers: the (snippet, places) runs of repeated places; shift is added to a snippet's places."""
    found = repeated_places(rows["bytes"].to_pylist(), rows["n"].to_numpy())
    ids, shift = rows["snippet"].to_numpy(), rows["shift"].to_numpy()
    out = [(int(ids[i]), a + int(shift[i]), b + int(shift[i])) for i, places in found for a, b in _runs(places)]
    return pa.table({"snippet": pa.array([x[0] for x in out], pa.int64()), "a": pa.array([x[1] for x in out], pa.int64()), "b": pa.array([x[2] for x in out], pa.int64())})


def _ends(batches):
    """The windows of snippets, by a hash of their anchor, their place about it and their first and last SYMBOL bytes."""
    for batch in batches:
        out = [[np.zeros(0, np.uint64)], [], [np.zeros(0, np.int32)], []]
        anchor, before = batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
        for i, data in enumerate(batch.column(3).to_pylist()):
            h = rolling(np.frombuffer(data, np.uint8), SYMBOL)
            m = len(data) - LENGTH + 1
            at = np.arange(m)
            with np.errstate(over="ignore"):
                out[0].append(mixed(h[:m] + mixed(h[LENGTH - SYMBOL : LENGTH - SYMBOL + m], 1) + mixed(anchor[i] + (int(before[i]) - at).astype(np.uint64), 2), 3))
            out[1].append(m)
            out[2].append(at.astype(np.int32))
        sizes = np.array(out[1], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out[0]).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(np.concatenate(out[2])), pa.array(np.repeat(batch.column(4).to_numpy(), sizes))],
            names=["ends", "snippet", "shift", "n"],
        )


def split_windows(hot: DataFrame) -> DataFrame:
    """hot: snippet, anchor, before, bytes, n. Returns ends, snippet, shift, bytes (of one window), n for the windows whose ends stand more than once."""
    windows = written(hot.select("snippet", "anchor", "before", "bytes", "n").mapInArrow(_ends, "ends long, snippet long, shift int, n long"), "windows")
    many = windows.groupBy("ends").agg(F.sum("n").alias("times")).where("times > 1").select("ends")
    return windows.join(many, "ends", "left_semi").join(hot.select("snippet", "bytes"), "snippet").select("ends", "snippet", "shift", F.expr(f"substring(bytes, shift + 1, {LENGTH})").alias("bytes"), "n")


def covered(n: int, runs: list[tuple[int, int]]) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    for a, b in runs:
        edges[a] += 1
        edges[b + LENGTH] -= 1
    return np.cumsum(edges[:n]) > 0


def _remove(batches):
    for batch in batches:
        out = []
        for text, copies, runs in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            n = len(text)
            gone = np.ones(n, bool) if copies > 1 and n >= LENGTH else covered(n, [(r["a"], r["b"]) for r in runs or []])
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((n, int(gone.sum()), spans, kept))
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array([hashlib.sha256(k).hexdigest() for k in cols[3]], pa.string()), pa.array(cols[3], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


@operator
def bucketed(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """texts: key (long, distinct), text. Returns where the snippets stand (key, snippet, first), and the distinct ones by bucket (snippet, shift, bytes, n, bucket)."""
    blocks = n_blocks(texts, BUCKET, LEAST)
    found = written(texts.select("key", "text").mapInArrow(_anchor_rows, "anchor long, key long, at long"), "anchors")
    many = written(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "many")
    # a hot anchor's rows stay where they are; the others meet theirs in a shuffle
    hot = F.broadcast(many.where(F.col("n") * HOT > found.count()).select("anchor"))
    rest = found.join(hot, "anchor", "left_anti").join(many.select("anchor"), "anchor", "left_semi")
    wanted = found.join(hot, "anchor", "left_semi").unionByName(rest).groupBy("key").agg(F.collect_list("at").alias("wanted"))
    pieces = texts.join(wanted, "key").select("key", "text", "wanted").mapInArrow(_snippets, SNIPPET)
    pieces = written(pieces.withColumn("snippet", F.xxhash64("anchor", "before", "bytes")), "snippets")
    # equal snippets once, with their number; combined in each task before the shuffle
    distinct = pieces.groupBy("snippet", "anchor", "before", "bytes").agg(F.count("*").alias("n"))
    large = written(pieces.select("anchor", "snippet").distinct().groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT).select("anchor"), "large")
    let_go(found, many)
    if large.isEmpty():
        own = distinct.select("snippet", F.lit(0).alias("shift"), "bytes", "n", F.col("anchor").alias("by"))
    else:
        distinct = written(distinct, "distinct")
        windows = split_windows(distinct.join(large, "anchor", "left_semi"))
        own = distinct.join(large, "anchor", "left_anti").select("snippet", F.lit(0).alias("shift"), "bytes", "n", F.col("anchor").alias("by"))
        own = own.unionByName(windows.select("snippet", "shift", "bytes", "n", F.col("ends").alias("by")))
    bucket = F.pmod(F.xxhash64("by"), F.lit(blocks)).cast("int")
    return pieces.select("key", "snippet", "first"), own.select("snippet", "shift", "bytes", "n", bucket.alias("bucket"))


def repeated_runs(texts: DataFrame) -> DataFrame:
    """texts: key (long, distinct), text. Returns key and the runs [a, b] of repeated starts, as rows."""
    pieces, own = bucketed(texts)
    runs = own.groupBy("bucket").applyInArrow(_bucket, "snippet long, a long, b long")
    return pieces.join(runs, "snippet").select("key", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))


@operator
def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("key", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("long"))
    copies = written(own.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")), "copies")
    once = own.join(copies.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).select("key", "text").dropDuplicates(["key"])
    runs = repeated_runs(written(once, "texts")).groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    # a text that stands several times goes as a whole or has no window, so its runs don't count: its facts are small
    facts = copies.select("key", "copies").join(runs, "key", "left").withColumn("runs", F.when(F.col("copies") == 1, F.col("runs")))
    joined = join_facts(own, written(facts, "facts"), "key", "copies").select("doc_id", "text", "copies", "runs")
    return joined.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("kept")
