"""Byte-level BPE in DuckDB, one in-memory database per Python worker.

Encoding: a text is cut into units (white space followed by other characters; a point or comma after a letter a-z is
one of its own), a unit into the pattern's matches. Words that are a token are taken from the vocabulary. The others become token-position rows; a
recursive query joins adjacent rows with the merge table and contracts each word's leftmost pair of the lowest rank
until no word has a pair. Decoding: id rows join the vocabulary and an ordered aggregation concatenates their bytes.

Long words. A word of n bytes would take up to n steps over n rows. So a word of more than LONG bytes is encoded by
overlapping segments, all in the same recursion. Two neighbours are joined at a place where both have a token's end and
where the two tokens that meet there are just what their bytes together encode to; a sequence in which all neighbours
are so is the word's encoding. Where there is no such place, the two segments become one and are encoded again.

Defined results: null and empty texts have no ids and decode to no bytes; repeated rows are encoded one by one; an
empty table gives none; other columns are ignored or kept, whatever they are called. Only white space of the pattern
separates units, so a unit's ids don't depend on what surrounds it. A worker remembers UNITS units at most, its
database holds MEMORY at most and has no folder to spill to; a query holds ROWS rows of all its steps, about.
"""

from __future__ import annotations

import base64
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PieceTable, keeps, only, operator

#: White space of the pattern: Unicode's White_Space.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Units that a worker remembers; beyond, it forgets all of them.
UNITS = 500_000
#: Characters of text that are encoded and decoded together.
CHUNK = 4 << 20
MEMORY, ROWS = "192MB", 5_000_000
LONG, SEGMENT, OVERLAP = 192, 64, 24
_MARK = "\x00"
_NEXT_TO_SPACE = re.compile(f"[{SPACE}] | [{SPACE}]")
_UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_BEFORE_POINT = r"([a-z])([.,])"

_MERGE = """
WITH RECURSIVE t AS (
  SELECT place, tok, 0 AS step, false AS done FROM start
  UNION ALL
  (WITH n AS (SELECT place, tok, step, lead(tok) OVER w AS nxt, lead(place) OVER w AS nxt_place, lag(place) OVER w AS prv
     FROM t WHERE NOT done AND step < $steps WINDOW w AS (ORDER BY place)),
   best AS (SELECT place >> 32 AS word, min((rank << 32) | (place & 4294967295)) AS least FROM n JOIN merges ON pair = ((tok::BIGINT << 20) | nxt)
     WHERE nxt_place >> 32 = place >> 32 GROUP BY place >> 32)
   SELECT n.place, CASE WHEN n.place & 4294967295 = least & 4294967295 THEN (least >> 32)::INTEGER ELSE n.tok END, step + 1, least IS NULL
   FROM n LEFT JOIN best ON n.place >> 32 = word WHERE least IS NULL OR prv IS NULL OR prv <> ((word << 32) | (least & 4294967295))))
SELECT place >> 32 AS word, tok, done FROM t WHERE done OR step = $steps ORDER BY place
"""
_DECODE = "SELECT doc, array_to_string(list(piece ORDER BY pos), '') AS text FROM ids JOIN vocabulary USING (id) GROUP BY doc"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """pattern: what splits texts; ranks: bytes of a token -> id, which is also its merge's rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.points_apart = self.pattern.findall("the., a") == ["the", ".,", " a"]  # asked of the pattern itself
        self.bytes_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.lens = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lens[list(ranks.values())] = [len(t) for t in ranks]
        self.units = PieceTable(self._new, "<u4", UNITS)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        pairs = [
            (a << 20 | b, r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None
        ]
        given = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "rank": pa.array([r for _, r in pairs], pa.int64())})
        self.db.register("given", given)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        # a byte b stands as the character 256 + b, since text aggregates can't hold arbitrary bytes
        given = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "piece": pa.array(["".join(chr(256 + b) for b in t) for t in ranks], pa.string())})
        self.db.register("given", given)
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by contraction until fixpoint. A query takes as many steps as make ROWS rows; what isn't done then goes on from its last step."""
        out: list = [self.bytes_id[np.frombuffer(w, np.uint8)] for w in words]
        todo = np.arange(len(words))
        while len(todo):
            lens = np.array([len(out[i]) for i in todo])
            steps = max(1, ROWS // max(1, int(lens.sum())))
            pos = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            start = pa.table({"place": np.repeat(todo, lens) << 32 | pos, "tok": np.concatenate([out[i] for i in todo])})
            self.db.register("start", start)
            got = self.db.sql(_MERGE.replace("$steps", str(steps))).to_arrow_table()
            self.db.unregister("start")
            word, tokens = got["word"].to_numpy(), got["tok"].to_numpy()
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            for i, a, b in zip(word[first].tolist(), first.tolist(), [*first[1:].tolist(), len(word)]):
                out[i] = tokens[a:b]
            todo = word[first][~got["done"].to_numpy()[first]]
        return out

    def _short(self, words: list[bytes]) -> list[np.ndarray]:
        """_contract() in calls that make about ROWS rows in all their steps."""
        out, start, rows = [], 0, 0
        for i, w in enumerate(words):
            rows += len(w) * (len(w) + 1) // 2
            if rows > ROWS:
                out += self._contract(words[start : i + 1])
                start, rows = i + 1, 0
        return out + self._contract(words[start:]) if start < len(words) else out

    def _long(self, word: bytes) -> np.ndarray:
        """Segments are [first, last) with some bytes more on each side: OVERLAP, or SEGMENT for those that have grown, so that runs of one byte are cut alike."""
        ends = list(range(SEGMENT, len(word) - SEGMENT // 2, SEGMENT)) + [len(word)]
        segments = list(zip([0, *ends[:-1]], ends))
        more = dict.fromkeys(segments, OVERLAP)
        known: dict = {}
        while len(segments) > 1:
            new = [x for x in segments if x not in known]
            for x, ids in zip(new, self._short([word[max(0, x[0] - more[x]) : x[1] + more[x]] for x in new])):
                known[x] = ids, np.concatenate([[0], np.cumsum(self.lens[ids])]) + max(0, x[0] - more[x])
            joints, pairs = [], []
            for x, y in zip(segments, segments[1:]):
                (_, at), (_, bt), border, side = known[x], known[y], x[1], min(more[x], more[y])
                common = np.intersect1d(at[np.abs(at - border) < side], bt[np.abs(bt - border) < side])
                joint = int(common[np.argmin(np.abs(common - border))]) if len(common) else -1
                joints.append(joint)
                pairs.append(word[at[np.searchsorted(at, joint) - 1] : bt[np.searchsorted(bt, joint) + 1]] if joint >= 0 else b"")
            distinct = list({p for p in pairs if p})
            whole = dict(zip(distinct, self._short(distinct)))
            good = []
            for joint, p, x in zip(joints, pairs, segments):
                ids, at = whole.get(p, ()), known[x][1]
                good.append(len(ids) == 2 and joint - self.lens[ids[0]] == at[np.searchsorted(at, joint) - 1])
            if all(good):
                cuts = [0, *joints, len(word)]
                return np.concatenate([ids[np.searchsorted(at, a) : np.searchsorted(at, b)] for (ids, at), a, b in zip(map(known.get, segments), cuts, cuts[1:])])
            merged = [segments[0]]
            for x, ok in zip(segments[1:], good):
                if ok or merged[-1] not in known:  # one that has just grown is judged again before it grows on
                    merged.append(x)
                else:
                    merged[-1] = (merged[-1][0], x[1])
                    more[merged[-1]] = SEGMENT
            segments = merged
        return self._contract([word])[0]

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        short = iter(self._short([w for w in words if len(w) <= LONG]))
        return [next(short) if len(w) <= LONG else self._long(w) for w in words]

    def _new(self, units: list[str]) -> list[np.ndarray]:
        find, ranks = self.pattern.findall, self.ranks
        cut = [[w.encode() for w in find(u)] for u in units]
        new = list({w for ws in cut for w in ws if w not in ranks})
        known = dict(zip(new, self.merge(new)))
        none = np.zeros(0, np.int32)
        one = lambda w: known[w] if w in known else np.array([ranks[w]], np.int32)
        return [one(ws[0]) if len(ws) == 1 else np.concatenate([none, *map(one, ws)]) for ws in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Where spaces stand next to no other white space, a text is cut before each space by Arrow; else by the pattern of units."""
        plain = [_MARK not in t and not _NEXT_TO_SPACE.search(t) for t in texts]
        out: list = [b""] * len(texts)
        easy = pc.replace_substring(pa.array([t for t, p in zip(texts, plain) if p], pa.string()), " ", _MARK + " ")
        if self.points_apart:
            easy = pc.replace_substring_regex(easy, _BEFORE_POINT, "\\1" + _MARK + "\\2")
        cut = pc.split_pattern(easy, _MARK)
        other = pa.array([_UNIT.findall(t) for t, p in zip(texts, plain) if not p], pa.list_(pa.string()))
        for places, lists in (([i for i, p in enumerate(plain) if p], cut), ([i for i, p in enumerate(plain) if not p], other)):
            for i, x in zip(places, self.units.ids(lists), strict=True):
                out[i] = x.tobytes()
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        out = [b""] * len(ids)
        lens = np.array([len(x) // 4 for x in ids], np.int64)
        if not lens.sum():
            return out
        pos = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
        rows = pa.table({"doc": np.repeat(np.arange(len(ids), dtype=np.int32), lens), "pos": pos, "id": np.frombuffer(b"".join(ids), "<u4").astype(np.int32)})
        self.db.register("ids", rows)
        got = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("ids")
        for doc, text in zip(got["doc"].to_numpy().tolist(), got["text"].to_pylist()):
            out[doc] = np.frombuffer(text.encode("utf-16-le"), "<u2").astype(np.uint8).tobytes()
        return out


_CODECS: dict[tuple[str, str], Codec] = {}


keeps("bpe", _CODECS.clear)


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def chunks(texts: list[str], most: int = CHUNK):
    """Slices of about `most` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def _batches(path: str, pattern: str, at: int, what: str):
    def step(batches):
        only("bpe")
        c = codec(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for s in chunks(texts):
                ids = c.encode(texts[s])
                own = batch.slice(s.start, s.stop - s.start)
                n = pa.array([len(x) // 4 for x in ids], pa.int64())
                sha = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                back = c.decode(ids)
                back_sha = pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string())
                if what == "digest":
                    yield pa.RecordBatch.from_arrays([own.column(0), n, sha, back_sha], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32), pa.int32())
                    )
                    yield pa.RecordBatch.from_arrays([own.column(0), n, lists, sha, back_sha], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    return step


@operator
def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of what they decode to. No shuffle."""
    schema = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_batches(path, pattern, 1, "ids"), schema)


def _decoded(path: str, pattern: str):
    def step(batches):
        only("bpe")
        c = codec(path, pattern)
        for batch in batches:
            ids = [np.array(x or [], "<u4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(c.decode(ids), pa.binary())], names=["doc_id", "bytes"])

    return step


@operator
def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded: doc_id, ids. Returns doc_id and the decoded bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path, pattern), "doc_id long, bytes binary")


@operator
def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_batches(path, pattern, 1, "digest"), schema)
