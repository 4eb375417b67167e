"""Benchmark decontamination by Wu-Manber search over words.

A pattern is a window of benchmark words. Tables are built per pattern length m: the block shift table says how far a
window of m words can move when its last block (two words; one if m is 1) is seen, and where the shift is zero the
block's bucket holds the patterns that end in it, which are compared word by word.

Defined results: null has no words; an item without words is no pattern; items that share a window all count;
repeated rows are judged one by one; other columns are kept or ignored, whatever they are called; an empty table of
documents gives none, an empty benchmark no hits. A benchmark larger than block_bytes is cut into blocks. A task
searches its documents for one block, builds that block's tables once, at its start, and reports the texts with hits by
their SHA-256; reports of all blocks are put together by text. A block's tables take about 120 times its text's size
(measured: 487 MB for 4 MiB), which bounds a worker's memory whatever the benchmark's size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, hot_keys, join_facts, operator, utf8, written

WINDOW = 10
BLOCK_BYTES = 1 << 20
#: Bytes outside words become a space, A-Z become a-z; bytes from 0x80 belong to words.
_FOLD = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WuManber:
    """Patterns of one length, as tuples of words, each with the ids of its items."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[int]]):
        self.m = len(next(iter(patterns)))
        self.b = min(2, self.m)
        self.far = self.m - self.b + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.b, self.m + 1):
                block = self._block(pattern, end - 1)
                self.shift[block] = min(self.shift.get(block, self.far), self.m - end)
            self.bucket[self._block(pattern, self.m - 1)].append((list(pattern), items))

    def _block(self, words, last: int):
        return (words[last - 1], words[last]) if self.b == 2 else words[last]

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Starts of occurrences, with the items."""
        m, far, shift, bucket, n = self.m, self.far, self.shift, self.bucket, len(words)
        i, get, two = m - 1, self.shift.get, self.b == 2
        while i < n:
            block = (words[i - 1], words[i]) if two else words[i]
            step = get(block, far)
            if step:
                i += step
                continue
            start = i - m + 1
            own = words[start : i + 1]
            for pattern, items in bucket[block]:
                if pattern == own:
                    yield start, items
            i += 1


def tables(items: Iterable[tuple[int, bytes]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            pattern = tuple(words[i : i + window])
            own = by_length[len(pattern)][pattern]
            if item_id not in own:
                own.append(item_id)
    return [WuManber(dict(p)) for _, p in sorted(by_length.items())]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's rows in blocks of bounded size; rows come to the driver partition by partition, and a block goes before the next one comes."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        text = (row[1] or "").encode()
        if size + len(text) > block_bytes and block:
            yield block
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    yield block


def search(words: list[bytes], matchers: list[WuManber], hit: np.ndarray, items: set) -> None:
    for matcher in matchers:
        for start, own in matcher.find(words):
            hit[start : start + matcher.m] = True
            items.update(own)


def _scan(block, at: int, window: int, found: str | None):
    """One pass over a task's documents with the tables of one block, which are built once. found: None filters, "report" reports every row, "hits" those with hits."""

    def step(batches):
        matchers = tables(block.value, window)
        block.__dict__.pop("_value", None)  # the tables are all that this worker needs
        for batch in batches:
            texts, hits, items = utf8(batch.column(at)), [], []
            for text in texts:
                words = words_of(text)
                hits.append(np.zeros(len(words), bool))
                items.append(set())
                search(words, matchers, hits[-1], items[-1])
            if found is None:
                yield batch.filter(pa.array([not h.any() for h in hits], pa.bool_()))
                continue
            spots = [np.flatnonzero(np.diff(h.astype(np.int8), prepend=0, append=0)) if found == "hits" else h[:0] for h in hits]
            ids = [sorted(x for x in own if x is not None) for own in items]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(h) for h in hits], pa.int64()), pa.array([int(h.sum()) for h in hits], pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array([None in x for x in items]), pa.array([x.tolist() for x in spots], pa.list_(pa.int64()))],
                names=["key", "n_words", "n_hit", "ids", "null_id", "edges"],
            )
            yield out.filter(pa.array([bool(h.any()) for h in hits], pa.bool_())) if found == "hits" else out

    return step


def _shared(docs: DataFrame, benchmark: DataFrame, block_bytes: int):
    return [docs.sparkSession.sparkContext.broadcast(b) for b in benchmark_blocks(benchmark, block_bytes)]


FOUND = "n_words long, n_hit long, ids array<long>, null_id boolean, edges array<long>"


def _hits_by_text(docs: DataFrame, blocks: list, window: int) -> DataFrame:
    """key, n_words, n_hit, ids, null_id of each distinct text with hits, over all blocks; one pass over docs a block, one row a hit text and block is shuffled."""
    own = docs.select(_text_key().alias("key"), "text")
    found = reduce(DataFrame.union, [own.mapInArrow(_scan(b, 1, window, "hits"), f"key string, {FOUND}") for b in blocks])
    return found.groupBy("key").agg(F.collect_set("edges").alias("edges"), F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("ids"), F.max("null_id").alias("null_id"), F.count("*").alias("n")).mapInArrow(_combined, "key string, n_words long, n_hit long, ids array<long>, null_id boolean, n long")


def _combined(batches):
    """Of each text: the words that any block has hit."""
    for batch in batches:
        n_hit = []
        for lists, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            step = np.zeros(n + 1, np.int64)
            for edges in lists:
                np.add.at(step, edges[::2], 1)
                np.add.at(step, edges[1::2], -1)
            n_hit.append(int((np.cumsum(step[:n]) > 0).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n_hit, pa.int64()), *(batch.column(i) for i in (3, 4, 5))], names=["key", "n_words", "n_hit", "ids", "null_id", "n"]
        )


def _text_key():
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def _count_words(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(words_of(t)) for t in utf8(batch.column(2))], pa.int64())], names=["doc_id", "key", "n_words"])


@operator
def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, words inside occurrences, the items that occur. Without a shuffle if the benchmark is one block."""
    blocks = _shared(docs, benchmark, block_bytes)
    own = docs.select(F.col("doc_id").cast("long"), "text")
    if len(blocks) == 1:
        found = own.mapInArrow(_scan(blocks[0], 1, window, "report"), f"doc_id long, {FOUND}")
    else:
        hits = written(_hits_by_text(docs, blocks, window), "hits")
        words = own.select("doc_id", _text_key().alias("key"), "text").mapInArrow(_count_words, "doc_id long, key string, n_words long")
        none = words.join(hits.select("key"), "key", "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<long>").alias("ids"), F.lit(False).alias("null_id"))
        found = join_facts(words.drop("n_words"), hits, "key").select("doc_id", "n_words", "n_hit", "ids", "null_id").unionByName(none)
    names = F.array_sort(F.transform("ids", lambda x: x.cast("string")))
    names = F.when(F.col("null_id"), F.array_sort(F.concat(names, F.array(F.lit("None"))))).otherwise(names)
    return found.select(
        "doc_id", "n_words", "n_hit", (F.size("ids") + F.col("null_id").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.col("ids").alias("item_ids"),
    )


@operator
def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs in which no window occurs, with all their columns."""
    blocks = _shared(docs, benchmark, block_bytes)
    if len(blocks) == 1:
        return docs.mapInArrow(_scan(blocks[0], docs.columns.index("text"), window, None), docs.schema)
    hits, mark = written(_hits_by_text(docs, blocks, window), "hits"), free_name("text", docs.columns)
    marked = docs.withColumn(mark, _text_key()).join(F.broadcast(hot_keys(hits).select(F.col("key").alias(mark))), mark, "left_anti")
    return marked.join(hits.select(F.col("key").alias(mark)), mark, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark).drop("item_ids")
