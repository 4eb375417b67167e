"""N-gram Jaccard join through a token-group matrix, and its connected components.

Documents with equal shingle sets form one node. Tokens (shingles) are ordered by how often a bounded sketch has
counted them, rare ones first; two sets of a Jaccard similarity of at least t share a token among the first
n - ceil(t * n) + 1 of each, and LEAST tokens among LEAST - 1 more; only those are shuffled. Where two sets meet at a
token, the tokens before it that no other set has are lost to both overlaps; what is left of each set, its cap, bounds
the overlap there.

1. Groups: each node is compared with two hubs at most, of the nodes of its size class that it shares tokens with the
   one that has the most shared tokens itself, relative to its size: the source of a family of edited copies has no tokens of its own, its
   copies have. Components of the links so found are the groups; nodes without a link are groups of their own.
2. Matrix: the rows (token, group) of the tokens that more than one node has. A node is a query to the groups,
   other than its own, that hold LEAST of its tokens within the caps; of two groups that meet, only one side asks.
3. A query and a group meet where the group's members are: the union of their tokens bounds the overlap with the
   query, and only groups that can reach the threshold are opened and their members compared one by one, until one is
   similar. Since components are asked for, one link between a query and a group is enough.
4. Components of the groups by alternating large-star and small-star steps.

Large groups are split into salted parts of PART members, of which each has its own union. No pair is emitted within
a group, and nothing about single documents comes to the driver.

Defined results: null, empty and white texts have an empty set and no links, n_shingles 0 and their own id as
component; a text of fewer words than a shingle has its whole sequence as one; each row is a document, also with a
repeated id; null ids are ignored by the minimum, unless a component has no other; extra columns are ignored or kept.
Sets are told apart by 64-bit sums of 64-bit shingle hashes.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, batch_shingles, free_name, join_facts, let_go, mixed, n_blocks, operator, text_slices, utf8, written

N, PERCENT = 5, 75
#: Bits of the filter that documents pass before they are joined with the wanted ones.
FILTER_BITS = 24
#: Size of the sketch that orders tokens: 2 ** SKETCH_BITS counters of 16 bits are broadcast, whatever the input.
SKETCH_BITS, SKETCH_CHUNK = 24, 1 << 16
PART = 500
#: Queries that a part's members are compared with in one task.
QUERIES = 5000
#: Pairs of a query and an entry that a task looks at together.
MEETINGS = 1 << 20


def _flat_sets(texts: list[bytes], n: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts one after another, each sorted, and their sizes."""
    runs, _ = batch_shingles(texts, n, hashes)
    lens = np.array([len(x) for x in runs], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *runs])
    ends = np.cumsum(lens)
    for a, b in zip((ends - lens).tolist(), ends.tolist()):
        flat[a:b].sort()
    owner = np.repeat(np.arange(len(texts)), lens)
    fresh = np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])][: len(flat)]
    return flat[fresh], np.bincount(owner[fresh], minlength=len(texts))


def _sets(texts: list[bytes], n: int, hashes: WordHashes) -> list[np.ndarray]:
    flat, sizes = _flat_sets(texts, n, hashes)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(texts) else []


def _nodes(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sets' identities, as signed 64-bit integers."""
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(flat, 5), dtype=np.uint64)])
        ends = np.cumsum(sizes)
        return (total[ends] - total[ends - sizes] + sizes.astype(np.uint64)).view(np.int64)


FIRST = "doc_id long, h long, node long, size long, chunk int, counts binary"


def _first_pass(n: int):
    """doc_id, h, node and size of each row; and, at a task's end, its part of the sketch in chunks."""

    def step(batches):
        hashes, mask = WordHashes(), np.uint64((1 << SKETCH_BITS) - 1)
        counts = np.zeros(1 << SKETCH_BITS, np.uint16)
        for batch in batches:
            texts, nodes, sizes = utf8(batch.column(2)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for s in text_slices(texts):
                flat, own = _flat_sets(texts[s], n, hashes)
                nodes.append(_nodes(flat, own))
                sizes.append(own)
                at, times = np.unique(flat & mask, return_counts=True)
                counts[at] = np.minimum(counts[at] + times, 65535)
            m = len(texts)
            cols = [batch.column(0), batch.column(1), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "h", "node", "size", "chunk", "counts"])
        cut = counts.astype("<u2").reshape(-1, SKETCH_CHUNK)
        some = [i for i, x in enumerate(cut) if x.any()]
        cols = [pa.nulls(len(some), pa.int64())] * 4 + [pa.array(some, pa.int32()), pa.array([zlib.compress(cut[i].tobytes(), 1) for i in some], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "h", "node", "size", "chunk", "counts"])

    return step


def _add(rows: pa.Table) -> pa.Table:
    total = np.zeros(SKETCH_CHUNK, np.uint32)
    for x in rows["counts"].to_pylist():
        total += np.frombuffer(zlib.decompress(x), "<u2")
    data = zlib.compress(np.minimum(total, 65535).astype("<u2").tobytes(), 1)
    return pa.table({"chunk": pa.array([rows["chunk"][0].as_py()], pa.int32()), "counts": pa.array([data], pa.binary())})


def _sketch(rows: DataFrame):
    """A broadcast array: how many sets have a token with these low bits, up to 65535. Every document is counted."""
    out = np.zeros(1 << SKETCH_BITS, np.uint16).reshape(-1, SKETCH_CHUNK)
    for chunk, counts in rows.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(_add, "chunk int, counts binary").collect():
        out[chunk] = np.frombuffer(zlib.decompress(counts), "<u2")
    return rows.sparkSession.sparkContext.broadcast(out.ravel())


def _least(percent: int) -> int:
    """LEAST: sets that can be similar without being equal have so many tokens, and as many in common; the least o with 100 * o >= percent * (o + 1)."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent has to lie in 1 to 100: {percent}")
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 30


def _need(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def _tokens(counts, n: int, percent: int, buckets: int):
    """By bucket, the first tokens of the sets of each batch, every set once, with the sets' nodes and sizes and the tokens' places in them."""

    least = _least(percent)

    def step(batches):
        hashes, mask = WordHashes(), np.uint64((1 << SKETCH_BITS) - 1)
        for batch in batches:
            texts, seen = utf8(batch.column(0)), set()
            tokens, nodes, sizes = [], [], []
            for s in text_slices(texts):
                flat, own = _flat_sets(texts[s], n, hashes)
                key = counts.value[(flat & mask).astype(np.int64)].astype(np.uint64) << np.uint64(48) | flat >> np.uint64(16)
                ends = np.cumsum(own)
                for node, size, end in zip(_nodes(flat, own).tolist(), own.tolist(), ends.tolist()):
                    if size >= least and node not in seen:
                        seen.add(node)
                        first, k = size - _need(size, percent) + least, key[end - size : end]
                        tokens.append(np.sort(np.partition(k, first - 1)[:first] if first < size else k))
                        nodes.append(node)
                        sizes.append(size)
            if not tokens:
                continue
            lens = [len(x) for x in tokens]
            token, owner, size = np.concatenate(tokens), np.repeat(np.array(nodes, np.int64), lens), np.repeat(np.array(sizes, np.int32), lens)
            place = np.concatenate([np.minimum(np.arange(m), 65535).astype(np.uint16) for m in lens])
            bucket = (mixed(token) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            token, owner, size, place, bucket = token[order], owner[order], size[order], place[order], bucket[order]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            cut = list(zip(starts.tolist(), np.r_[starts[1:], len(bucket)].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts], pa.int32()), *(pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (token, owner, size, place))],
                names=["bucket", "tokens", "nodes", "sizes", "places"],
            )

    return step


def _joined(rows: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(rows[name].to_pylist()), kind)


def _shared_runs(rows: pa.Table) -> pa.Table:
    """The (token, node, size, place) rows of tokens that more than one node has."""
    token, node, size, place = _joined(rows, "tokens", np.uint64), _joined(rows, "nodes", np.int64), _joined(rows, "sizes", np.int32), _joined(rows, "places", np.uint16)
    order = np.lexsort((node, token))
    token, node, size, place = token[order], node[order], size[order], place[order]
    fresh = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])][: len(token)]
    token, node, size, place = token[fresh], node[fresh], size[fresh], place[fresh]
    run = np.cumsum(np.r_[True, token[1:] != token[:-1]][: len(token)]) - 1
    many = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
    token = (token ^ np.uint64(1 << 63)).view(np.int64)  # in the same order as signed numbers
    return pa.table({"token": token[many], "node": node[many], "size": size[many].astype(np.int64), "place": place[many].astype(np.int64)})


def _hubs(percent: int):
    """For each node of a bucket the hubs that its tokens there lead to, with the hubs' scores and the number of tokens.

    Only sizes that can be similar are compared: nodes are cut into size classes in two ways, so that any two fitting
    sizes near each other share a class in one of them."""

    def step(rows: pa.Table) -> pa.Table:
        token, node, score, size = (rows[c].to_numpy() for c in ("token", "node", "score", "size"))
        out = []
        for way in (0.0, 0.5):
            cls = np.floor(np.log(size) / np.log(100 / percent) + way).astype(np.int64)
            order = np.lexsort((node, -score, cls, token))
            t, c, a, b = token[order], cls[order], node[order], score[order]
            first = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (c[1:] != c[:-1])][: len(t)])
            run = np.repeat(first, np.diff(np.r_[first, len(t)]))
            hub, best = a[run], b[run]
            order = np.lexsort((hub, a))
            a, hub, best = a[order], hub[order], best[order]
            at = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (hub[1:] != hub[:-1])][: len(a)])
            out.append((a[at], hub[at], best[at], np.diff(np.r_[at, len(a)]), np.full(len(at), int(2 * way))))
        a, hub, best, n, way = (np.concatenate(x) for x in zip(*out))
        return pa.table({"node": a, "hub": hub, "score": best, "n": n.astype(np.int64), "way": way.astype(np.int32)})

    return step


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Of two sorted sets, at the threshold, in integers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _with_hub(n: int, percent: int):
    """The members of a part against their hub; role 1 is the hub."""

    def step(rows: pa.Table) -> pa.Table:
        nodes, hub = [], rows["grp"][0].as_py()
        is_hub, texts, names = rows["role"].to_numpy() == 1, utf8(rows["text"].combine_chunks()), rows["node"].to_pylist()
        if is_hub.any():
            hashes = WordHashes()
            own = _sets([texts[int(np.argmax(is_hub))]], n, hashes)[0]
            for s in text_slices(texts):
                nodes += [names[s.start + i] for i, x in enumerate(_sets(texts[s], n, hashes)) if not is_hub[s.start + i] and _similar(own, x, percent)]
        return pa.table({"node": pa.array(nodes, pa.int64()), "hub": pa.array([hub] * len(nodes), pa.int64())})

    return step


def _open(n: int, percent: int):
    """Queries (role 0) against a part of a group (role 1): the bound first, then the members until one is similar."""

    def step(rows: pa.Table) -> pa.Table:
        a, b, group = [], [], rows["grp"][0].as_py()
        member, texts, own_groups = rows["role"].to_numpy() == 1, utf8(rows["text"].combine_chunks()), rows["own"].to_pylist()
        if member.any() and not member.all():
            hashes = WordHashes()
            sets = _sets([t for t, m in zip(texts, member) if m], n, hashes)
            union = np.unique(np.concatenate(sets))
            asking = np.flatnonzero(~member).tolist()
            asked = [texts[i] for i in asking]
            for s in text_slices(asked):
                for i, x in enumerate(_sets(asked[s], n, hashes)):
                    at = np.minimum(np.searchsorted(union, x), len(union) - 1)
                    if (union[at] == x).sum() >= _need(len(x), percent) and any(_similar(x, m, percent) for m in sets):
                        a.append(own_groups[asking[s.start + i]])
                        b.append(group)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return step


def _counted(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of the last column's counts summed, from arrays of five columns."""
    x = np.concatenate(rows)
    order = np.lexsort(x[:, 3::-1].T)
    x = x[order]
    first = np.flatnonzero(np.r_[True, (x[1:, :4] != x[:-1, :4]).any(axis=1)][: len(x)])
    return x[first, :4], np.add.reduceat(x[:, 4], first) if len(x) else x[:, 4]


def _meetings(percent: int):
    """(query, its group, other group, its part, tokens) where groups meet within their sizes, caps and places; the node of the group of the larger number asks.

    Places: two similar sets have o tokens in common at least, o following from their sizes, so LEAST of them are among
    the first size - o + LEAST tokens of both; what lies further back in either set is no meeting.

    A token's entries are ordered by size, so that a query sees only those whose sizes fit; entries are seen MEETINGS at a time and counted at once."""

    few = _least(percent)

    def step(rows: pa.Table) -> pa.Table:
        token, node, size, cap, place, grp, part = (rows[c].to_numpy() for c in ("token", "node", "size", "cap", "place", "grp", "part"))
        order = np.lexsort((part, grp, token))
        token, node, size, cap, place, grp, part = (x[order] for x in (token, node, size, cap, place, grp, part))
        back = size - place  # tokens from this one on
        # the matrix: one entry for each token and part of a group, with its members' least and greatest size, greatest cap and most tokens from this one on
        entry = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (grp[1:] != grp[:-1]) | (part[1:] != part[:-1])][: len(token)])
        found, held, n_held = [np.zeros((0, 5), np.int64)], [], 0
        if len(entry):
            run = np.cumsum(np.r_[True, token[1:] != token[:-1]]) - 1
            e_run, e_grp, e_part = run[entry], grp[entry], part[entry]
            e_min, (e_max, e_cap, e_back) = np.minimum.reduceat(size, entry), (np.maximum.reduceat(x, entry) for x in (size, cap, back))
            order = np.lexsort((e_min, e_run))
            e_run, e_grp, e_part, e_min, e_max, e_cap, e_back = (x[order] for x in (e_run, e_grp, e_part, e_min, e_max, e_cap, e_back))
            upto, most = (e_run << 32) | e_min, np.maximum.accumulate((e_run << 32) | e_max)
            last = np.searchsorted(upto, (run << 32) | (100 * size // percent), side="right")
            first = np.searchsorted(most, (run << 32) | -(-percent * size // 100), side="left")
            many = np.maximum(last - first, 0)
            ends = np.cumsum(many)
            start = 0
            while start < len(token):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + MEETINGS, side="right")))
                own = many[start:stop]
                q = np.repeat(np.arange(start, stop), own)
                e = np.arange(len(q)) + np.repeat(first[start:stop] - (np.cumsum(own) - own), own)
                least = -(-percent * (size[q] + e_min[e]) // (100 + percent))  # of two sets that are similar: their overlap
                fits = (e_grp[e] < grp[q]) & (100 * e_max[e] >= percent * size[q]) & (np.minimum(cap[q], e_cap[e]) >= least) & (np.minimum(back[q], e_back[e]) > least - few)
                q, e, start = q[fits], e[fits], stop
                held.append(np.stack([node[q], grp[q], e_grp[e], e_part[e], np.ones(len(q), np.int64)], axis=1))
                n_held += len(q)
                if n_held > MEETINGS:
                    x, n = _counted(held)
                    held, n_held = [np.column_stack([x, n])], 0
            found = held or found
        x, n = _counted(found)
        return pa.table({"node": x[:, 0], "own": x[:, 1], "other": x[:, 2], "part": x[:, 3], "n": n})

    return step


def _bits(batches):
    """A task's part of the filter: which low bits of the hashes occur, in chunks."""
    seen = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        seen[(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    cut = np.packbits(seen).reshape(256, -1)
    some = [i for i, x in enumerate(cut) if x.any()]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(cut[i].tobytes(), 1) for i in some], pa.binary())], names=["chunk", "bits"])


def _or(rows: pa.Table) -> pa.Table:
    total = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(x), np.uint8) for x in rows["bits"].to_pylist()])
    return pa.table({"chunk": pa.array([rows["chunk"][0].as_py()], pa.int32()), "bits": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _passing(shared, at: int):
    def step(batches):
        seen = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            h = batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
            yield batch.filter(pa.array(seen[h.astype(np.int64)]))

    return step


def _with_texts(own: DataFrame, nodes: DataFrame, roles: DataFrame) -> DataFrame:
    """roles (node, grp, part, role, own) with a text of each node. Documents pass a filter of fixed size before the exact join, so that few are shuffled."""
    wanted = nodes.join(roles.select("node").distinct(), "node", "left_semi")
    wanted = written(wanted.select("node", F.col("k.doc_id").alias("k_id"), F.col("k.h").alias("k_h")), "wanted")
    bits = np.zeros((256, (1 << FILTER_BITS) // 8 // 256), np.uint8)
    for chunk, x in wanted.select("k_h").mapInArrow(_bits, "chunk int, bits binary").groupBy("chunk").applyInArrow(_or, "chunk int, bits binary").collect():
        bits[chunk] = np.frombuffer(zlib.decompress(x), np.uint8)
    shared = own.sparkSession.sparkContext.broadcast(bits.ravel())
    few = own.mapInArrow(_passing(shared, own.columns.index("h")), own.schema)
    keys = roles.join(wanted, "node")
    return keys.join(few, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h"))).select(*(c for c in ("grp", "part", "share") if c in roles.columns), "role", "node", "own", "text")


@operator
def components(edges: DataFrame) -> DataFrame:
    """edges: two columns of longs. Returns id, label: for every end of an edge the least id that its edges reach."""
    edges = edges.toDF("a", "b")
    tree = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = tree.select("a", "b").union(tree.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "edges")
        old = tree
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        tree = written(small.where("a <> b").distinct(), "edges")
        let_go(old, large)
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return tree.select(F.col("a").alias("id"), F.col("b").alias("label")).union(tree.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())


class Found(NamedTuple):
    """What classes() finds. rows: doc_id, h (hash of the text), node, size of every row; nodes: node, n (its rows), k (the first of them: that of the least id, nulls last); labels: node, label (the component's, a node) of those that share tokens; temporary: tables that can go when both are used up."""

    rows: DataFrame
    nodes: DataFrame
    labels: DataFrame
    temporary: list


@operator
def classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> Found:
    least = _least(percent)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    blocks = n_blocks(docs)
    bucket = F.pmod(F.xxhash64("token"), F.lit(blocks)).cast("int")
    first = written(own.mapInArrow(_first_pass(n), FIRST), "first")
    rows = first.where("chunk is null").select("doc_id", "h", "node", "size")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    nodes = written(rows.where("size > 0").groupBy("node").agg(F.count("*").alias("n"), F.min(row).alias("k")), "nodes")  # combined in each task first, so exact copies are a row a task
    tokens = own.select("text").mapInArrow(_tokens(_sketch(first), n, percent, blocks), "bucket int, tokens binary, nodes binary, sizes binary, places binary")
    shared = written(tokens.groupBy("bucket").applyInArrow(_shared_runs, "token long, node long, size long, place long"), "shared")
    mine = Window.partitionBy("node")
    lost = F.col("place") - (F.row_number().over(mine.orderBy("token")) - 1)  # tokens before this one that the node shares with nobody
    runs = shared.withColumn("cap", F.col("size") - lost).withColumn("m", F.count("*").over(mine)).where(F.col("m") >= least)
    runs = written(runs.select("token", "node", "size", "cap", "place", (F.col("m") / F.col("size")).alias("score"), bucket.alias("bucket")), "runs")
    let_go(shared)

    # groups: every node and its hub
    led = runs.drop("cap", "place").groupBy("bucket").applyInArrow(_hubs(percent), "node long, hub long, score double, n long, way int").where("node <> hub")
    led = led.groupBy("node", "way", "hub").agg(F.max("score").alias("score"), F.sum("n").alias("n")).where(F.col("n") >= least)
    led = led.groupBy("node", "way").agg(F.max(F.struct("score", F.bitwise_not("hub").alias("minus"))).alias("m")).select("node", F.bitwise_not("m.minus").alias("hub")).distinct()
    led = written(led, "hubs")
    parts = led.groupBy("hub").agg(F.count("*").alias("n")).select("hub", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    none = F.lit(None).cast("long").alias("own")
    members = led.join(parts, "hub").select("node", F.col("hub").alias("grp"), F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), F.lit(0).alias("role"), none)
    hubs = parts.select(F.col("hub").alias("node"), F.col("hub").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("role"), none)
    roles = written(members.unionByName(hubs), "roles")
    stars = written(_with_texts(own, nodes, roles).groupBy("grp", "part").applyInArrow(_with_hub(n, percent), "node long, hub long"), "stars")
    let_go(led, roles)
    led = components(stars)
    groups = runs.select("node").distinct().join(led.withColumnRenamed("id", "node"), "node", "left").select("node", F.coalesce("label", "node").alias("grp"))
    whole = groups = written(groups, "groups")
    sizes = groups.groupBy("grp").agg(F.count("*").alias("n"))
    large = written(sizes.where(F.col("n") > PART).select("grp", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "large")
    groups = written(groups.join(large, "grp", "left").select("node", "grp", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")), "parts")
    let_go(large, stars, whole)

    # the matrix, and the meetings of queries with parts of other groups
    matrix = runs.select("token", "node", "size", "cap", "place", "bucket").join(groups, "node")
    met = matrix.groupBy("bucket").applyInArrow(_meetings(percent), "node long, own long, other long, part long, n long")
    met = met.groupBy("node", "own", "other", "part").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    met = written(met.select("node", F.col("other").alias("grp"), F.col("part").cast("int").alias("part"), F.lit(0).alias("role"), "own"), "meetings")
    opened = groups.join(met.select("grp", "part").distinct(), ["grp", "part"], "left_semi").select("node", "grp", "part", F.lit(1).alias("role"), none)
    # a part's queries come in shares of QUERIES, each with the part's members
    shares = met.groupBy("grp", "part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("shares"))
    opened = opened.join(shares, ["grp", "part"]).select("node", "grp", "part", "role", "own", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    asking = met.join(shares, ["grp", "part"]).select("node", "grp", "part", "role", "own", F.pmod(F.xxhash64("node"), "shares").cast("int").alias("share"))
    roles = written(opened.unionByName(asking), "roles")
    links = written(_with_texts(own, nodes, roles).groupBy("grp", "part", "share").applyInArrow(_open(n, percent), "a long, b long"), "links")
    # the groups' own components, then each node's through its group
    merged = components(links).withColumnRenamed("id", "grp")
    labels = written(groups.join(merged, "grp", "left").select("node", F.coalesce("label", "grp").alias("label")), "labels")
    let_go(runs, met, roles, links, groups)
    return Found(rows, nodes, labels, [first, nodes, labels])


def _nodes_of(found: Found) -> DataFrame:
    """found.nodes with the label of every node."""
    return found.nodes.join(found.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


@operator
def digest(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    found = classes(docs, n, percent)
    nodes = written(_nodes_of(found).select("node", "label", "n", F.col("k.doc_id").alias("id")), "nodes")
    ids = written(nodes.groupBy("label").agg(F.min("id").alias("component_id"), F.count("*").alias("n")), "components")
    by_node = written(join_facts(nodes.select("node", "label", F.col("n").alias("m")), ids, "label").select("node", "component_id", F.col("m").alias("n")), "component-ids")
    real = join_facts(found.rows.where("size > 0").select("doc_id", "node", "size"), by_node, "node").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    out = real.unionByName(found.rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    let_go(nodes, ids)
    return out


@operator
def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component, with all columns: that of the smallest id; of rows with equal ids and texts, the first by their other columns, written as JSON. Rows with an empty set stay."""
    found = classes(docs, n, percent)
    kept = written(_nodes_of(found).groupBy("label").agg(F.min("k").alias("k")).select("k.doc_id", "k.h"), "kept")
    let_go(*found.temporary)
    k_id, k_h, h, at = (free_name(x, docs.columns) for x in ("k_id", "k_h", "h", "at"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    mark = docs.withColumn(h, F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_h))
    chosen = mark.join(kept.toDF(k_id, k_h), same, "left_semi")
    order = F.to_json(F.struct(*(F.col(f"`{c}`") for c in others))) if others else F.lit(0)
    chosen = chosen.withColumn(at, F.row_number().over(Window.partitionBy("doc_id", h).orderBy(order))).where(F.col(at) == 1).drop(h, at)
    real = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return chosen.where(real).unionByName(docs.where(~real))
