r"""Source divergence audit: how far the term frequencies of a language's sources lie apart, and which terms stand out.

Tokens. A numpy table over the concatenated UTF-8 bytes of a batch says which bytes belong to terms; boundaries are where
that changes or a document ends. Slices are grouped by xxhash, and every slice is compared byte by byte with the one that
stands for its group; a batch with unequal ones is grouped by the bytes themselves.

Counts. (lang, term, source) rows are added up in each task before the shuffle, so that a term of every document is one row
a task. Terms of too few documents go; the rest are written once, with N and V by a second small aggregation.

Divergences. Terms are dealt by (lang, term), never by lang or source, so a hot source or language is spread over all
tasks. A task reads whole terms in order, builds CSR matrices (sources x terms) of about CELLS / 8 entries, and for each
source sums over all others at once: np.add.reduceat over the rows of what both or the other one has, and for what is
absent a source's constant share. It adds its parts up and gives one row a pair, and the first TOP terms of each source.
Where a language's sources are so many that their matrix of pairs would exceed CELLS, its rows are cut into bands, and each task
has one band. Everything is in whole numbers; a share is a long division in steps that 64 bits hold.

The table of groups (lang, source, N: about 100 bytes each) goes to all tasks; its size is checked, and more than MOST_GROUPS
are refused: their pairs alone would be 10^11 rows or so.

Defined results: null text, lang and source are ''; a repeated row is another document; a group without terms has pairs
but no terms; a language without kept terms has pairs of value 0; a language's only source has no pairs; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, let_go, only, operator, written

#: Of each byte: what it becomes in a term, 0 where it is not part of one; A-Z become a-z.
_FOLD = np.array([b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 0 for b in range(256)], np.uint8)
BATCH = 8 << 20
CELLS = 1 << 22
MOST_GROUPS = 1_000_000
SCALE_STEPS, STEP = 3, 1000


class Tokens(NamedTuple):
    """terms: the distinct ones; of: the number of each token's term; doc: of each token's document."""

    terms: list[bytes]
    of: np.ndarray
    doc: np.ndarray


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


def tokens_of(data: np.ndarray, offsets: np.ndarray, hash_of: Callable[[bytes], int] = xxhash.xxh3_64_intdigest) -> Tokens:
    """Terms of documents that lie one behind the other in data; offsets: their bounds."""
    folded = _FOLD[data]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = folded != 0
    before = np.r_[False, inside[:-1]]
    before[offsets[(offsets < len(data))]] = False  # a term ends where its document does
    starts = np.flatnonzero(inside & ~before)
    last = np.r_[inside[1:] & ~_marks(offsets, len(data))[1:], False]
    ends = np.flatnonzero(inside & ~last) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    flat = folded.tobytes()
    h = np.fromiter((hash_of(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    _, first, of = np.unique(h, return_index=True, return_inverse=True)
    lens = ends - starts
    same = np.array_equal(lens, lens[first][of]) and np.array_equal(folded[_spread(starts, lens)], folded[_spread(starts[first][of], lens)])
    if same:
        return Tokens([flat[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], of, doc)
    number: dict[bytes, int] = {}
    exact = np.fromiter((number.setdefault(flat[a:b], len(number)) for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))
    return Tokens(list(number), exact, doc)


def _marks(offsets: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n + 1, bool)
    out[offsets[offsets <= n]] = True
    return out


ROWS = "lang string, source string, term binary, n long, docs long"


def _count(batches):
    """A batch's documents and occurrences of each (lang, source, term); a null term for each group."""
    only()
    for batch in gathered(batches, BATCH):
        lang, source = batch.column(1).dictionary_encode(), batch.column(2).dictionary_encode()
        wide = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
        text = batch.column(0)
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        terms, of, doc = tokens_of(data, offsets - offsets[0])
        many = max(1, len(terms))
        seen, n = np.unique(doc * many + of, return_counts=True)
        both, place = np.unique(group[seen // many] * many + seen % many, return_inverse=True)
        groups = np.unique(group)
        at = np.r_[both // many, groups]
        term = pa.array([*terms, None], pa.binary()).take(pa.array(np.r_[both % many, np.full(len(groups), len(terms))]))
        zero = np.zeros(len(groups), np.int64)
        count = lambda w=None: np.r_[np.bincount(place, w, len(both)).astype(np.int64), zero]
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(at // wide)), source.dictionary.take(pa.array(at % wide)), term, pa.array(count(n)), pa.array(count())], names=["lang", "source", "term", "n", "docs"]
        )


def shares(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / total), exactly; total below 9 * 10^15."""
    total = np.broadcast_to(np.asarray(total, np.int64), np.shape(count))
    rest, out = np.asarray(count, np.int64) + 2, np.zeros(np.shape(count), np.int64)
    for _ in range(SCALE_STEPS):
        q, rest = np.divmod(rest, np.maximum(total, 1))
        out = (out + q) * STEP
        rest = rest * STEP
    return out + rest // np.maximum(total, 1) + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


class Groups:
    """Of each language: its sources in UTF-8 order, their totals (N + 2 V), the language's own, and the number of kept terms."""

    def __init__(self, rows: list[tuple[str, str, int, int]], cells: int = CELLS):
        self.cells = cells
        self.langs: dict[str, tuple[list[str], np.ndarray, int, int]] = {}
        by: dict[str, list[tuple[bytes, int, int]]] = {}
        for lang, source, n, v in rows:
            by.setdefault(lang, []).append((source.encode(), n, v))
        for lang, own in by.items():
            own.sort()
            v = own[0][2]
            totals = np.array([n + 2 * v for _, n, _ in own], np.int64)
            self.langs[lang] = ([s.decode() for s, _, _ in own], totals, int(sum(n for _, n, _ in own)) + 2 * v, v)
        self.number = {lang: {s: i for i, s in enumerate(x[0])} for lang, x in self.langs.items()}

    def bands(self, lang: str) -> int:
        """Into how many bands of sources a language's pairs are cut."""
        s = len(self.langs[lang][0])
        return -(-s * s // self.cells)


class Matrix(NamedTuple):
    """CSR, a row a source: bounds, columns (in order within a row), counts."""

    bounds: np.ndarray
    columns: np.ndarray
    counts: np.ndarray
    width: int


def matrix(source: np.ndarray, column: np.ndarray, counts: np.ndarray, height: int, width: int) -> Matrix:
    order = np.lexsort((column, source))
    bounds = np.zeros(height + 1, np.int64)
    np.cumsum(np.bincount(source, minlength=height), out=bounds[1:])
    return Matrix(bounds, column[order], counts[order], width)


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows of a CSR matrix; reduceat gives an empty row its neighbour's first value, so these are left out."""
    out = np.zeros(len(bounds) - 1, np.int64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full])
    return out


def divergences(m: Matrix, totals: np.ndarray, mine: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """For the sources `mine`, against all: the sum over the matrix's terms of f, less f of two absent shares for each term (the caller adds that for all kept terms)."""
    none = shares(np.zeros(len(totals), np.int64), totals)
    p = shares(m.counts, np.repeat(totals, np.diff(m.bounds)))
    of = np.repeat(np.arange(len(totals)), np.diff(m.bounds))
    out = np.zeros((len(mine), len(totals)), np.int64)
    dense = np.empty(m.width, np.int64)
    for k, g in enumerate(mine.tolist()):
        a, b = m.bounds[g], m.bounds[g + 1]
        own, shared = m.columns[a:b], np.zeros(m.width, bool)
        dense[:] = none[g]
        dense[own], shared[own] = p[a:b], True
        bare = apart(none[g], none)
        # terms that the other source has
        out[k] = _row_sums(apart(p, dense[m.columns]) - bare[of], m.bounds)
        if b > a:
            # terms that only this one has: all of its own against an absent share, less those that both have
            for c in range(0, len(totals), max(1, cells // (b - a))):
                s = slice(c, c + max(1, cells // (b - a)))
                out[k, s] += (apart(p[a:b][None, :], none[s, None]) - bare[s, None]).sum(axis=1)
            out[k] -= _row_sums(np.where(shared[m.columns], apart(dense[m.columns], none[of]) - bare[of], 0), m.bounds)
    return out


FOUND = "lang string, source string, part string, item binary, value long"


def _first(values: np.ndarray, terms: np.ndarray, top: int) -> np.ndarray:
    """Places of the first `top` by value, largest first, then term."""
    if len(values) > top:
        least = np.partition(values, len(values) - top)[len(values) - top]
        at = np.flatnonzero(values >= least)  # ties at the end are all here
    else:
        at = np.arange(len(values))
    return np.array(sorted(at.tolist(), key=lambda i: (-values[i], terms[i]))[:top], np.int64)


def _measure(shared, top: int):
    def step(batches):
        only()
        groups: Groups = shared.value
        sums: dict[tuple[str, int], np.ndarray] = {}
        best: dict[tuple[str, str], list[tuple[int, bytes]]] = {}

        def done(lang: str, band: int):
            sources, _, _, v = groups.langs[lang]
            total = sums.pop((lang, band))
            mine = np.arange(band, len(sources), groups.bands(lang))
            g, h = (x.ravel() for x in np.meshgrid(mine, np.arange(len(sources)), indexing="ij"))
            some = (g != h) & (total.ravel() != 0)
            names = pa.array(sources)
            yield _rows(lang, names.take(pa.array(g[some])), "pair", names.take(pa.array(h[some])).cast(pa.binary()), total.ravel()[some])
            for s in [s for l, s in best if l == lang]:
                own = best.pop((lang, s))
                yield _rows(lang, pa.array([s] * len(own)), "term", pa.array([t for _, t in own], pa.binary()), np.array([x for x, _ in own], np.int64))

        def add(lang: str, band: int, rows: pa.Table):
            sources, totals, whole, _ = groups.langs[lang]
            number = groups.number[lang]
            source = np.fromiter((number[s] for s in rows["source"].to_pylist()), np.int64, len(rows))
            terms = rows["term"].combine_chunks().dictionary_encode()
            column, words = terms.indices.to_numpy().astype(np.int64), terms.dictionary.to_pylist()
            counts = rows["n"].to_numpy()
            mine = np.arange(band, len(sources), groups.bands(lang))
            m = matrix(source, column, counts, len(sources), len(words))
            if (lang, band) not in sums:
                sums[lang, band] = np.zeros((len(mine), len(sources)), np.int64)
            sums[lang, band] += divergences(m, totals, mine, groups.cells)
            q = shares(np.bincount(column, counts, len(words)).astype(np.int64), np.full(len(words), whole))
            for g in mine.tolist():
                a, b = m.bounds[g], m.bounds[g + 1]
                p = shares(m.counts[a:b], np.full(b - a, totals[g]))
                over = np.flatnonzero(p > q[m.columns[a:b]])
                at = m.columns[a:b][over]
                values, own = apart(p[over], q[at]), [words[i] for i in at.tolist()] if len(over) <= top else None
                own = own or np.array(words, object)[at]
                new = [(int(values[i]), own[i]) for i in _first(values, own, top).tolist()]
                if new:
                    old = best.get((lang, sources[g]), [])
                    best[lang, sources[g]] = sorted(old + new, key=lambda x: (-x[0], x[1]))[:top]

        last = None
        for rows in _whole_terms(batches, groups.cells):
            for lang, band, own in _runs(rows):
                if last is not None and last != (lang, band):
                    yield from done(*last)
                last = (lang, band)
                add(lang, band, own)
        if last is not None:
            yield from done(*last)

    return step


def _rows(lang: str, source, part: str, item, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), source.cast(pa.string()), pa.array([part] * n, pa.string()), item, pa.array(value)], names=["lang", "source", "part", "item", "value"])


def _whole_terms(batches, cells: int):
    """Rows in the order of (lang, band, term), in tables of whole terms of about cells / 8 rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size < cells // 8:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        end = len(rows)
        key = [rows[c][end - 1] for c in ("lang", "band", "term")]
        while end and all(rows[c][end - 1] == k for c, k in zip(("lang", "band", "term"), key)):
            end -= 1
        if end:
            yield rows.slice(0, end)
        held, size = rows.slice(end).to_batches(), len(rows) - end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _runs(rows: pa.Table):
    """The rows of each (lang, band), which stand together."""
    lang = rows["lang"].combine_chunks().dictionary_encode()
    band = rows["band"].to_numpy()
    code = lang.indices.to_numpy()
    cuts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (band[1:] != band[:-1])]).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(rows)]):
        yield lang.dictionary[int(code[a])].as_py(), int(band[a]), rows.slice(a, b - a)


@operator
def counted(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Rows (lang, source, term, n) of terms in at least min_docs documents of their language, and (lang, source) with N and V; both written."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = docs.select(text("text"), text("lang"), text("source"))
    rows = own.mapInArrow(_wide(_count), ROWS).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    all_rows = written(rows, "terms")
    groups = all_rows.where("term is null").select("lang", "source")
    mine = Window.partitionBy("lang", "term")
    kept = all_rows.where("term is not null").withColumn("in_docs", F.sum("docs").over(mine)).where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n")
    kept = written(kept, "kept")
    sizes = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    let_go(all_rows)
    return kept, groups


def _wide(f):
    """f over batches whose strings have 64-bit offsets."""

    def step(batches):
        return f(pa.RecordBatch.from_arrays([b.column(0).cast(pa.large_string()), b.column(1), b.column(2)], names=["text", "lang", "source"]) for b in batches)

    return step


@operator
def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, cells: int = CELLS) -> DataFrame:
    """For each group (lang, source): part `pair`, the divergence from each other source of the language; part `term`, the first `top` terms that it uses more than its language."""
    kept, groups = counted(docs, min_docs)
    if groups.count() > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups of lang and source")
    known = Groups([tuple(r) for r in groups.toLocalIterator()], cells)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    cut = [lang for lang in known.langs if known.bands(lang) > 1]  # languages of more than 2048 sources
    rows = kept.withColumn("band", F.lit(0))
    if cut:
        bands = docs.sparkSession.createDataFrame([(lang, known.bands(lang)) for lang in known.langs], "lang string, bands int")
        rows = kept.join(F.broadcast(bands), "lang").withColumn("band", F.explode(F.sequence(F.lit(0), F.col("bands") - 1))).drop("bands")
    dealt = rows.repartition("lang", "band", "term").sortWithinPartitions("lang", "band", "term")
    found = written(dealt.mapInArrow(_measure(shared, top), FOUND), "found")
    # every pair of a language, with what all of its kept terms would give if both shares were absent
    bare = groups.select("lang", "source", "v", (F.col("total") + 2 * F.col("v")).alias("all"))
    one = F.when(F.col("v") > 0, _absent("all")).otherwise(F.lit(0)).cast("long")
    one = bare.select("lang", "source", "v", one.alias("p"))
    pairs = one.join(one.select("lang", F.col("source").alias("item"), F.col("p").alias("q")), "lang").where("source <> item")
    base = F.when(F.col("v") > 0, F.col("v") * F.expr("(p - q) * (p - q) div (p + q)")).otherwise(F.lit(0)).cast("long")
    sums = found.where("part = 'pair'").groupBy("lang", "source", F.col("item").cast("string").alias("item")).agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", base.alias("value")).unionByName(sums.withColumn("part", F.lit("pair")))
    pairs = pairs.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))


def _absent(total: str):
    """The share of a term that a source lacks."""
    return F.lit(1) + F.expr(f"2000000000L div {total}")


def digest(docs: DataFrame) -> DataFrame:
    return audit(docs)
