"""Language-model scores: a causal self-attention model trained in numpy on subword ids, and a word unigram base.

Model. Every subword of every word is read, learnt and scored. One attention layer with learned relative biases reads the
ids in windows of 2 * STEP inputs: a window scores its last STEP subwords and sees the STEP before them, so windows
overlap and each subword is scored once, with masked attention in batches. It gives the probability of the next id's class:
the most frequent ids have one each, the others share TAIL classes, in which an id has its share of the training
documents' tokens, of those that begin a word or of those that don't. The layer adds to the logarithms of how often classes
follow each other. A word's probability is that of its first subword times that of the rest given the first: a mixture of
the rest as the model spells it (the product of its subwords' probabilities, the last of which ends the word), with half of
what words that stand once leave, and of the words with that first subword by their counts; a word that the training
documents lack has the other half, shared by as many as stand once, and one. The base is no part of it.

Training. All training documents, every subword's loss, each document once: first a quarter of them, by a hash, in every
task from the same start, the weights averaged by subwords; then the rest in the same way from that average. A task's
documents are learnt from in their order, so the weights depend on how the input is split into tasks, as averages do.

Counts. A block's distinct words go to shards by hash, with their training counts; a shard adds them up, finds each
distinct word's subwords once, and answers in the same order. A frequent word is one entry a block. No text is shuffled.

Defined results: null and empty texts are one end token; a null id counts as the empty string in crc32; repeated rows
are documents of their own; extra columns are ignored; an empty table gives no rows. A word that the tokenizer gives no
subwords is one unit of its own kind.
"""

from __future__ import annotations

import ctypes
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, hash64, let_go, mixed, n_blocks, only, operator, strings, written
from .token_files import encoder

STEP, WIDTH = 8, 16
#: Classes are GROUPS x MEMBERS; TAIL of them are shared by all ids but the most frequent.
GROUPS, MEMBERS, TAIL = 16, 16, 64
CLASSES = GROUPS * MEMBERS
BEGIN, PAD = CLASSES, CLASSES + 1
BLOCK_BYTES, SHARD_BYTES = 12 << 20, 6 << 20
ROUNDS, FIRST_ROUND = 8, 2
#: Windows in a step and in a scored slice; tokens whose windows are shuffled together.
BATCH, WINDOWS, TOKENS = 768, 384, 1 << 17
RATE = 0.1
#: Occurrences that a class's share among all counts for in its shares after another.
PRIOR = 50.0
#: Tokens that an id's share among all counts for in its share of a class.
SHARED = 100.0
#: Weights that one task of the averaging adds up.
FAN_IN = 64
# Numbers of the C library's options.
_MMAP_THRESHOLD, _TRIM_THRESHOLD = -3, -1
CAP = np.float32(20)
#: As far from zero, exponentials and their sums are plain numbers of 4 bytes without a row's maximum being taken off.
SAFE = 80
_APART = STEP + np.arange(STEP)[:, None] - np.arange(2 * STEP)[None, :]
_SEEN, _NEAR = _APART >= 0, np.maximum(_APART, 0)


def _keep_temporaries() -> None:
    """Asks the C library to give arrays of a few MB back to this process, not to the system, which would clear them at each use; where it has no such call, nothing happens."""
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)
    if set_option is not None:
        for option in (_MMAP_THRESHOLD, _TRIM_THRESHOLD):
            set_option(option, 1 << 25)


def _give_back() -> None:
    """What this worker's earlier tasks have freed goes back to the system, which doesn't get it from Arrow and the C library of their own accord."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents' classes: inputs (n, 2 * STEP), targets (n, STEP; PAD where none) and the document of each window."""
    sizes = np.array([len(x) for x in docs], np.int64)
    blocks = -(-sizes // STEP) + 1
    starts = (np.cumsum(blocks) - blocks) * STEP
    total = int(blocks.sum()) * STEP
    given, wanted = np.full(total + 1, PAD, np.int64), np.full(total, PAD, np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *docs]).astype(np.int64)
    at = np.repeat(starts + STEP - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(flat))
    wanted[at] = flat
    given[at + 1] = flat
    given[(starts + STEP)[sizes > 0]] = BEGIN
    g, t = given[:total].reshape(-1, STEP), wanted.reshape(-1, STEP)
    # a document's last token is no input; where it fills its block, it would be the next document's first, unseen block's
    after = (starts + STEP + sizes)[sizes > 0]
    g.ravel()[after[after < total]] = PAD
    scored = np.ones(len(g), bool)
    scored[starts // STEP] = False
    at = np.flatnonzero(scored)
    return np.concatenate([g[at - 1], g[at]], axis=1), t[at], np.repeat(np.arange(len(docs)), blocks)[at]


class Model:
    """Weights as named arrays. A class is a group and a member of it, so that a token costs two small softmaxes.

    pairs: how often each class follows each other (or the beginning) in the training documents; the layer learns what is to be added to the logarithms of these shares."""

    def __init__(self, pairs: np.ndarray | None = None, seed: int = 1):
        pairs = np.zeros((CLASSES + 2, CLASSES)) if pairs is None else pairs
        alone = pairs.sum(axis=0) + 1.0
        smooth = (pairs + PRIOR * alone / alone.sum()).reshape(-1, GROUPS, MEMBERS)
        total = smooth.sum(axis=2)
        self.groups = np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32)
        self.members = np.log(smooth / total[:, :, None]).astype(np.float32)
        r = np.random.default_rng(seed)
        small = lambda *shape: (r.standard_normal(shape) * 0.25).astype(np.float32)
        self.w = {
            "embed": small(CLASSES + 2, WIDTH), "q": small(WIDTH, WIDTH), "k": small(WIDTH, WIDTH), "v": small(WIDTH, WIDTH), "near": np.zeros(2 * STEP, np.float32),
            "group": np.zeros((WIDTH, GROUPS), np.float32), "group_bias": np.zeros(GROUPS, np.float32), "member": np.zeros((GROUPS, WIDTH, MEMBERS), np.float32), "member_bias": np.zeros((GROUPS, MEMBERS), np.float32),
        }

    def to_bytes(self) -> bytes:
        return b"".join(x.astype("<f4").tobytes() for x in self.w.values())

    def load(self, data: bytes) -> Model:
        at, flat = 0, np.frombuffer(data, "<f4")
        for name, x in self.w.items():
            self.w[name] = flat[at : at + x.size].reshape(x.shape).copy()
            at += x.size
        return self

    def _tables(self):
        """What two classes' query and key make of each other (from -CAP to CAP) and its exponential, the exponentials of distances, what a class's value adds, and what a class before adds to groups and members: all there is, as inputs are classes."""
        w = self.w
        q, k = w["embed"] @ w["q"] * np.float32(WIDTH**-0.5), w["embed"] @ w["k"]
        pair = q @ k.T
        np.clip(pair, -CAP, CAP, out=pair)
        weight = np.exp(pair)
        weight[:, PAD] = 0
        near = np.where(_SEEN, np.exp(np.clip(w["near"], -CAP, CAP))[_NEAR], np.float32(0))
        return q, k, pair, weight, near, w["embed"] @ w["v"], self.groups + w["group_bias"], (self.members + w["member_bias"]).reshape(-1, MEMBERS)

    def _attend(self, given: np.ndarray, tables):
        """The layer's output at the last STEP places of each window, and what the backward pass needs: the places in the table of pairs, weights, values and their means."""
        *_, weight, near, value, _, _ = tables
        own = given[:, STEP:]
        at = own[:, :, None] * (CLASSES + 2) + given[:, None, :]
        s = np.take(weight, at)
        s *= near  # scores are capped, so that no product is infinite or subnormal, which is slow, and no row's maximum is needed
        rows = s.reshape(-1, 2 * STEP)
        rows *= 1 / (_row_sums(rows)[:, None] + np.float32(1e-30))  # padding sees nothing
        v = np.take(value, given, axis=0)
        mean = s @ v
        return np.take(self.w["embed"], own, axis=0) + mean, (at, s, v, mean)

    def _soft(self, h: np.ndarray, last: np.ndarray, t: np.ndarray, tables, scored: bool = True):
        """Of rows of h, the classes before theirs and their own: the rows' order by group and its bounds, and in that order for both levels the own one's places, the exponentials and their sums, with, if scored, the natural log-probability of each class."""
        groups, members = tables[-2:]
        group = t // MEMBERS
        order = np.argsort(group.astype(np.uint8), kind="stable")
        h, last, group, t = np.take(h, order, axis=0), last[order], group[order], t[order]
        member = t - group * MEMBERS
        bounds = np.searchsorted(group, np.arange(GROUPS + 1)).tolist()
        first = h @ self.w["group"]
        first += np.take(groups, last, axis=0)
        second = np.empty((len(t), MEMBERS), h.dtype)
        for g, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                np.matmul(h[a:b], self.w["member"][g], out=second[a:b])
        last *= GROUPS
        last += group
        second += np.take(members, last, axis=0)
        logs, sums, rows = np.zeros(len(t), h.dtype), [], np.arange(len(t)) * MEMBERS
        for z, own in ((first, group), (second, member)):
            if len(z) and (z.max() > SAFE or z.min() < -SAFE):
                z -= z.max(axis=1, keepdims=True)
            own += rows
            if scored:
                logs += np.take(z, own)
            np.exp(z, out=z)
            sums.append(_row_sums(z))
            if scored:
                logs -= np.log(sums[-1])
        return order, bounds, h, (group, member), (first, second), sums, logs

    def token_logs(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of every class of the documents, in order."""
        given, wanted, _ = windows(docs)
        tables, out = self._tables(), [np.zeros(0, np.float32)]
        for a in range(0, len(given), WINDOWS):
            t = wanted[a : a + WINDOWS].ravel()
            real = np.flatnonzero(t != PAD)
            h, _ = self._attend(given[a : a + WINDOWS], tables)
            order, *_, logs = self._soft(np.take(h.reshape(-1, WIDTH), real, axis=0), given[a : a + WINDOWS, STEP:].ravel()[real], t[real], tables)
            out.append(np.empty_like(logs))
            out[-1][order] = logs
        return np.concatenate(out)

    def gradients(self, given: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss of all tokens of the windows."""
        w, tables = self.w, self._tables()
        q, k, pair, *_ = tables
        h, (at, s, v, mean) = self._attend(given, tables)
        t = wanted.ravel()
        real = np.flatnonzero(t != PAD)
        order, bounds, own, owns, levels, sums, _ = self._soft(np.take(h.reshape(-1, WIDTH), real, axis=0), given[:, STEP:].ravel()[real], t[real], tables, scored=False)
        part = np.float32(1 / max(1, len(real)))
        for d, right, z in zip(levels, owns, sums):
            d *= (part / z)[:, None]
            d.ravel()[right] -= part
        first, second = levels
        ones = np.ones(len(real), first.dtype)
        g = {"group": own.T @ first, "group_bias": ones @ first, "member": np.zeros_like(w["member"]), "member_bias": np.zeros_like(w["member_bias"])}
        back = np.zeros((len(real) + 1, WIDTH), first.dtype)  # the last row is that of places without a target
        np.matmul(first, w["group"].T, out=back[:-1])
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                g["member"][i], g["member_bias"][i] = own[a:b].T @ second[a:b], ones[a:b] @ second[a:b]
                back[a:b] += second[a:b] @ w["member"][i].T
        place = np.full(t.shape, len(real))
        place[real[order]] = np.arange(len(real))
        dh = np.take(back, place, axis=0).reshape(h.shape)
        # a weight's slope is what its value has of dh beyond the mean of all values
        ds = dh @ v.transpose(0, 2, 1)
        ds -= _row_sums((dh * mean).reshape(-1, WIDTH)).reshape(-1, STEP, 1)
        ds *= s
        g["near"] = np.where(np.abs(w["near"]) < CAP, np.bincount(_NEAR.ravel(), weights=np.ones(len(ds), ds.dtype) @ ds.reshape(len(ds), -1), minlength=2 * STEP), 0).astype(np.float32)
        n = CLASSES + 2
        dpair = np.zeros((n, n), np.float32)
        np.add.at(dpair.ravel(), at.ravel(), ds.ravel().astype(np.float32, copy=False))
        dpair[:, PAD] = 0
        capped = np.abs(pair) >= CAP
        if capped.any():
            dpair[capped] = 0
        dq, dk = dpair @ k * np.float32(WIDTH**-0.5), dpair.T @ q
        dvalue = _by_class(given.ravel(), (s.transpose(0, 2, 1) @ dh).reshape(-1, WIDTH), n)
        g["q"], g["k"], g["v"] = w["embed"].T @ dq, w["embed"].T @ dk, w["embed"].T @ dvalue
        g["embed"] = dq @ w["q"].T + dk @ w["k"].T + dvalue @ w["v"].T + _by_class(given[:, STEP:].ravel(), dh.reshape(-1, WIDTH), n)
        return g

    def step(self, given: np.ndarray, wanted: np.ndarray, past: dict) -> None:
        """One Adagrad step."""
        for name, grad in self.gradients(given, wanted).items():
            past[name] += grad * grad
            self.w[name] -= RATE * grad / np.sqrt(past[name] + 1e-8)


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums of short rows, as a product, which takes a tenth of the time."""
    return x @ np.ones(x.shape[1], x.dtype)


def _by_class(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by id."""
    order, sizes = np.argsort(ids.astype(np.uint16), kind="stable"), np.bincount(ids, minlength=n)
    some = np.flatnonzero(sizes)
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[some] = np.add.reduceat(np.take(rows, order, axis=0), (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


def classes_of(counts: np.ndarray) -> np.ndarray:
    """A class for each id: the most frequent ones alone, the others by their id."""
    out = (CLASSES - TAIL + np.arange(len(counts)) % TAIL).astype(np.int64)
    top = np.argsort(-counts, kind="stable")[: CLASSES - TAIL]
    out[top] = np.arange(len(top))
    return out


class Subwords:
    """What counts say. By id (subwords, then one for words without any, then the end): training tokens that are a word's first, and its other ones; first tokens of words that stand once, and how many there are."""

    def __init__(self, first: np.ndarray, inner: np.ndarray, once: np.ndarray):
        self.class_of = classes_of(first + inner)
        alone = (first + inner + 0.5) / (first + inner + 0.5).sum()
        self.shares = np.empty((2, len(first)))
        for k, tokens in enumerate((first, inner)):
            own = tokens + SHARED * alone
            self.shares[k] = np.log(own / np.bincount(self.class_of, weights=own, minlength=CLASSES)[self.class_of])
        self.left = (once + 0.5) / (first + 1)
        self.first, self.once = first, once

    def parts(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words, by their first ids: what the probability of the rest has of the spelled one, and what counts add to it."""
        left = self.left[ids]
        known = (1 - left) * counts / np.maximum(self.first[ids], 1)
        return left / 2, np.where(counts > 0, known, left / 2 / (self.once[ids] + 1))

    def rest(self, ids: np.ndarray, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Natural log of the probability of words given their first ids. spelled: that by the model, as a log."""
        part, known = self.parts(ids, counts)
        return np.log(part * np.exp(spelled) + known)


ASKED = "block long, shard int, words string, counts binary, doc_ids array<long>, held_out binary, chosen binary, lens binary, sequence binary"


def tokens_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, an empty one last for the end; the numbers of all tokens, and of each text's tokens."""
    plain = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), r"[\t\n\x0b\x0c\r]", " ")
    cut = pc.split_pattern(plain, " ")
    flat = cut.flatten().dictionary_encode()
    words, at = strings(flat.dictionary), flat.indices.to_numpy().astype(np.int64)
    hole = words.index("") if "" in words else -1
    real = at != hole
    bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py() if len(cut) else np.zeros(1, np.int64)
    lens = np.diff(np.concatenate([[0], np.cumsum(real)])[bounds])
    at = at[real]
    if hole >= 0:
        at -= at > hole
        words.pop(hole)
    words.append("")
    return words, np.insert(at, np.cumsum(lens), len(words) - 1), lens + 1


def _ask(shards: int):
    def step(batches):
        only()
        _keep_temporaries()
        part, number = TaskContext.get().partitionId(), 0
        for batch in gathered(batches, BLOCK_BYTES):
            words, at, lens = tokens_of(batch.column(1))
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            # a word goes where it goes without a point or comma at its end, as both have the same subwords
            h = np.fromiter((hash64(w[:-1] if w.endswith((".", ",")) else w) for w in words), np.uint64, len(words))
            shard = (mixed(h, 3) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            at, shard = place[at], shard[order]
            counts = np.bincount(at[np.repeat(~held, lens)], minlength=len(words)).astype("<i8")
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]).tolist()
            pairs = list(zip(cuts, [*cuts[1:], len(words)]))
            words = [words[i] for i in order.tolist()]
            n, none = len(pairs), [None] * len(pairs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | number] * (n + 1), pa.int64()), pa.array([*shard[cuts].tolist(), None], pa.int32()),
                    pa.array([*(" ".join(words[a:b]) for a, b in pairs), None], pa.string()), pa.array([*(counts[a:b].tobytes() for a, b in pairs), None], pa.binary()),
                    pa.array([*none, batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    *(pa.array([*none, x.tobytes()], pa.binary()) for x in (held, batch.column(3).to_numpy().astype(np.uint8), lens.astype("<i8"), at.astype("<i4"))),
                ],
                names=["block", "shard", "words", "counts", "doc_ids", "held_out", "chosen", "lens", "sequence"],
            )
            number += 1

    return step


ANSWER = "shard int, block long, counts binary, spell binary, ids binary, id int, first long, inner long, once long, types long"


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


def _total(path: str):
    def step(asked: pa.Table) -> pa.Table:
        only("tokens")  # the encoder stays for the next shard
        _give_back()
        encode = encoder(path)
        vocabulary = encode.tokenizer.get_vocab_size()
        cut = pc.split_pattern(asked["words"].combine_chunks(), " ")
        flat = cut.flatten().dictionary_encode()
        bounds = (cut.offsets.to_numpy() - cut.offsets[0].as_py()).tolist()
        at, words = flat.indices.to_numpy(), flat.dictionary
        given = np.frombuffer(b"".join(asked["counts"].to_pylist()), "<i8")
        totals = np.bincount(at, weights=given, minlength=len(words)).astype("<i8")
        ids, lens = encode.spell(words)
        bare = np.flatnonzero(lens == 0)
        ids = np.insert(ids.astype(np.int64), (np.cumsum(lens) - lens)[bare], [vocabulary if words[i].as_py() else vocabulary + 1 for i in bare.tolist()]).astype("<u2")
        lens[bare] = 1
        starts = np.cumsum(lens) - lens
        out: dict = {"counts": [], "spell": [], "ids": []}
        for a, b in zip(bounds, bounds[1:]):
            own = at[a:b]
            out["counts"].append(totals[own].tobytes())
            out["spell"].append(lens[own].astype("<u2").tobytes())
            out["ids"].append(ids[_spread(starts[own], lens[own])].tobytes())
        size, heads = vocabulary + 2, ids[starts]
        every = np.bincount(ids, weights=np.repeat(totals, lens), minlength=size).astype(np.int64)
        count = lambda rows, weights=None: np.bincount(heads[rows], weights=weights, minlength=size).astype(np.int64)
        first, once, types = count(slice(None), totals), count(totals == 1), count(totals > 0)
        some = np.flatnonzero(every)
        n, m, shard = asked.num_rows, len(some), asked["shard"][0].as_py()
        blobs = {k: pa.array([*v, *[None] * m], pa.binary()) for k, v in out.items()}
        return pa.table({
            "shard": pa.array([shard] * (n + m), pa.int32()), "block": pa.array([*asked["block"].to_pylist(), *[None] * m], pa.int64()), **blobs,
            "id": pa.array([*[None] * n, *some.tolist()], pa.int32()), **{k: pa.array([*[None] * n, *x[some].tolist()], pa.int64()) for k, x in (("first", first), ("inner", every - first), ("once", once), ("types", types))},
        })

    return step


PREPARED = "doc_ids array<long>, held_out binary, chosen binary, lens binary, sequence binary, counts binary, spell binary, ids binary"


def _prepare(own: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with the counts and subwords of its distinct words."""
    order = np.argsort(answers["shard"].to_numpy(), kind="stable").tolist()
    joined = {k: pa.array([b"".join(x[i] for x in [answers[k].to_pylist()] for i in order)], pa.binary()) for k in ("counts", "spell", "ids")}
    return pa.table({k: own[k] for k in ("doc_ids", "held_out", "chosen", "lens", "sequence")} | joined)


class Block:
    """A block's documents as subwords. tokens: documents' numbers of words (their ends with them); at: each word's place among the distinct ones; counts, heads: these ones' counts and first ids; words, sizes: subwords of each word and of each document."""

    def __init__(self, batch, i: int):
        read = lambda name, kind: np.frombuffer(batch[name][i].as_py(), kind)
        self.doc_ids = batch["doc_ids"][i]
        self.held_out, self.chosen, self.tokens = read("held_out", bool), read("chosen", np.uint8), read("lens", "<i8")
        self.at, spell, self.flat = read("sequence", "<i4"), read("spell", "<u2"), read("ids", "<u2")
        self.starts = np.cumsum(spell, dtype=np.int64) - spell
        self.counts, self.heads, self.words = read("counts", "<i8"), self.flat[self.starts], spell[self.at]
        self.ends = np.cumsum(self.tokens)
        self.sizes = np.add.reduceat(self.words, self.ends - self.tokens, dtype=np.int64)

    def ids_of(self, a: int, b: int) -> np.ndarray:
        """The subwords of documents a to b; all of a block's at once would be places of 8 bytes for ids of 2."""
        own = slice(self.ends[a] - self.tokens[a], self.ends[b - 1])
        return self.flat[_spread(self.starts[self.at[own]], self.words[own].astype(np.int64))]

    @property
    def ids(self) -> np.ndarray:
        return self.ids_of(0, len(self.tokens))

    def runs(self) -> list[tuple[int, int]]:
        """Documents in runs of about TOKENS subwords, as _slices() has them."""
        cuts, size = [0], 0
        for d, n in enumerate(self.sizes.tolist()):
            if size > TOKENS:
                cuts.append(d)
                size = 0
            size += n
        return list(zip(cuts, [*cuts[1:], len(self.sizes)]))

    def documents(self, class_of: np.ndarray, mine: np.ndarray) -> list[np.ndarray]:
        """The classes of some of the documents."""
        out = []
        for a, b in self.runs():
            classes, ends = class_of[self.ids_of(a, b)].astype(np.uint8), np.cumsum(self.sizes[a:b])
            out += [classes[ends[d] - self.sizes[a + d] : ends[d]].copy() for d in np.flatnonzero(mine[a:b]).tolist()]
        return out


def _blocks(batches):
    for batch in batches:
        for i in range(len(batch)):
            yield Block(batch, i)


SUMS = "part long, tokens double, weights binary"


def _slices(docs: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Documents in runs of about TOKENS."""
    out, size = [[]], 0
    for x in docs:
        if size > TOKENS:
            out.append([])
            size = 0
        out[-1].append(x)
        size += len(x)
    return out


def _given(tokens: int, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(tokens)]), pa.array([weights.astype("<f8").tobytes()], pa.binary())], names=["part", "tokens", "weights"])


def _pairs(shared):
    """How often a task's classes follow each other in training documents."""

    def step(batches):
        only()
        _give_back()
        _keep_temporaries()
        total, tokens = np.zeros((CLASSES + 2) * CLASSES, np.int64), 0
        for block in _blocks(batches):
            for docs in _slices(block.documents(shared.value.class_of, ~block.held_out)):
                if not docs:
                    continue
                flat = np.concatenate(docs).astype(np.int64)
                before = np.r_[BEGIN, flat[:-1]]
                before[np.cumsum([0, *map(len, docs[:-1])])] = BEGIN
                total += np.bincount(before * CLASSES + flat, minlength=len(total))
                tokens += len(flat)
        if tokens:
            yield _given(tokens, total)

    return step


def _train(start: bytes, pairs, shared, turn: range):
    def step(batches):
        only()
        _give_back()
        _keep_temporaries()
        model = Model(pairs.value).load(start)
        past = {k: np.zeros_like(x) for k, x in model.w.items()}
        tokens = 0
        for block in _blocks(batches):
            mine = ~block.held_out & (block.chosen % ROUNDS >= turn.start) & (block.chosen % ROUNDS < turn.stop)
            for docs in _slices(block.documents(shared.value.class_of, mine)):
                if not docs:
                    continue
                given, wanted, _ = windows(docs)
                order = np.random.default_rng(tokens).permutation(len(given))
                tokens += sum(map(len, docs))
                for b in range(0, len(order), BATCH):
                    own = order[b : b + BATCH]
                    model.step(given[own], wanted[own], past)
        if tokens:
            yield _given(tokens, np.frombuffer(model.to_bytes(), "<f4") * np.float64(tokens))

    return step


def _sum(rows: pa.Table) -> pa.Table:
    weights = sum(np.frombuffer(w, "<f8") for w in rows["weights"].to_pylist())
    return pa.table({"part": pa.array([rows["part"][0].as_py()], pa.int64()), "tokens": pa.array([float(sum(rows["tokens"].to_pylist()))]), "weights": pa.array([weights.tobytes()], pa.binary())})


def _summed(rows: DataFrame, step) -> tuple[np.ndarray, float] | None:
    """The sum of what tasks give, in as many levels as bound what a task adds up; None if none gave anything."""
    left, sums = rows.rdd.getNumPartitions(), rows.mapInArrow(step, SUMS)
    while True:
        left = -(-left // FAN_IN)
        sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(_sum, SUMS)
        if left <= 1:
            break
    total = sums.first()
    return None if total is None else (np.frombuffer(total["weights"], "<f8"), total["tokens"])


class Prepared(NamedTuple):
    """rows: PREPARED; shared: the broadcast Subwords; tokens, types: of the training documents' words, ends with them."""

    rows: DataFrame
    shared: object
    tokens: int
    types: int


@operator
def train_on(rows: DataFrame, shared) -> tuple[np.ndarray, bytes]:
    """Pairs of classes and the weights, from all training documents of PREPARED rows."""
    found = _summed(rows, _pairs(shared))
    pairs = np.zeros((CLASSES + 2, CLASSES)) if found is None else found[0].reshape(-1, CLASSES)
    given = rows.sparkSession.sparkContext.broadcast(pairs)
    weights = Model().to_bytes()
    for turn in (range(FIRST_ROUND), range(FIRST_ROUND, ROUNDS)):
        total = _summed(rows, _train(weights, given, shared, turn))
        if total is not None:
            weights = (total[0] / total[1]).astype("<f4").tobytes()
    return pairs, weights


def _score(pairs, weights: bytes, shared, n_all: int, v: int):
    def step(batches):
        only()
        _give_back()
        _keep_temporaries()
        model, subwords = Model(pairs.value).load(weights), shared.value
        for block in _blocks(batches):
            of_docs = lambda x: np.add.reduceat(x, block.ends - block.tokens)  # noqa: B023, E731
            part, known = subwords.parts(block.heads, block.counts)
            scores = np.empty(len(block.tokens))
            for a, b in block.runs():
                ids, words = block.ids_of(a, b), slice(block.ends[a] - block.tokens[a], block.ends[b - 1])
                classes, ends, sizes = subwords.class_of[ids].astype(np.uint8), np.cumsum(block.sizes[a:b]), block.sizes[a:b]
                logs = model.token_logs([classes[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]).astype(np.float64)
                lens = block.words[words].astype(np.int64)
                at, own = np.cumsum(lens) - lens, block.at[words]
                shares = np.take(subwords.shares[1], ids)
                shares[at] = np.take(subwords.shares[0], ids[at])
                logs += shares
                first = logs[at]
                rest = np.log(part[own] * np.exp(np.minimum(np.add.reduceat(logs, at) - first, 0.0)) + known[own])
                scores[a:b] = np.add.reduceat(first + rest, block.ends[a:b] - block.tokens[a:b] - words.start)
            base = np.log10((block.counts + 0.5) / (n_all + 0.5 * (v + 1)))[block.at]
            m = len(block.tokens)
            yield pa.RecordBatch.from_arrays(
                [block.doc_ids.values, pa.array(block.held_out), pa.array(block.tokens), pa.array(of_docs((block.counts > 0).astype(np.int64)[block.at])), pa.array([n_all] * m, pa.int64()), pa.array(of_docs(base)), pa.array(scores / np.log(10))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return step


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@operator
def prepare(docs: DataFrame, path: str) -> Prepared:
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc % 5 == 1).alias("held_out"), F.pmod(F.floor(crc / 5), F.lit(ROUNDS)).cast("int").alias("chosen"))
    asked = written(own.mapInArrow(_ask(n_blocks(docs, SHARD_BYTES, 32)), ASKED), "asked")
    answers = written(asked.where("shard is not null").select("block", "shard", "words", "counts").groupBy("shard").applyInArrow(_total(path), ANSWER), "answers")
    vocabulary = encoder(path).tokenizer.get_vocab_size() + 2
    if vocabulary > 1 << 16:
        raise ValueError("ids must fit 16 bits")
    facts = np.zeros((4, vocabulary), np.int64)
    for r in answers.where("id is not null").groupBy("id").agg(F.sum("first"), F.sum("inner"), F.sum("once"), F.sum("types")).collect():  # a row an id at most
        facts[:, r[0]] = r[1:]
    first, inner, once, types = facts
    shared = docs.sparkSession.sparkContext.broadcast(Subwords(first, inner, once))
    rows = asked.where("shard is null").select("block", "doc_ids", "held_out", "chosen", "lens", "sequence").groupBy("block")
    out = rows.cogroup(answers.where("block is not null").select("shard", "block", "counts", "spell", "ids").groupBy("block")).applyInArrow(_prepare, PREPARED)
    out = written(out, "prepared")
    let_go(asked, answers)
    return Prepared(out, shared, int(first.sum()), int(types.sum()))


def score(docs: DataFrame, path: str) -> DataFrame:
    """Scores of every row of docs, learnt from those whose crc32 of the id modulo 5 isn't 1."""
    own = prepare(docs, path)
    pairs, weights = train_on(own.rows, own.shared)
    given = docs.sparkSession.sparkContext.broadcast(pairs)
    return own.rows.mapInArrow(_score(given, weights, own.shared, own.tokens, own.types), SCHEMA)
