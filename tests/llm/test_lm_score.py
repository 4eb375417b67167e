"""Language-model scores: base against brute force, the model's gradients, normalisation and held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from skyloom.llm import lm_score

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_base(docs):
    own = [(d, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]) for d, t in docs]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in own]
    c = Counter(w for (_, ws), h in zip(own, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted(((d, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for (d, ws), h in zip(own, held)), key=str)


def test_scores_of_odd_documents(odd, odd_docs, empty):
    rows = lm_score.score(odd, PATH).collect()
    assert sorted(((*r[:5], round(r[5], 6)) for r in rows), key=str) == brute_base(odd_docs)
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm_score.score(empty, PATH).collect() == []


def test_model_beats_the_base_on_held_out_documents(spark):
    """The model alone: the base is no part of its score."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in lm_score.score(rows, PATH).collect() if r.held_out]
    assert len(held) > 100
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.fixture()
def model():
    return lm_score.Model()


def test_every_token_is_scored_once():
    docs = [np.arange(n) % 50 for n in (1, 2, 15, 16, 17, 32, 100)]
    given, wanted, own = lm_score.windows(docs)
    for i, d in enumerate(docs):
        t, g = wanted[own == i], given[own == i]
        assert t[t != lm_score.PAD].tolist() == d.tolist()
        # a window's inputs: the tokens before its targets, no other document's
        flat = [lm_score.BEGIN, *d[:-1].tolist()]
        for k, row in enumerate(g):
            want = ([lm_score.PAD] * lm_score.STEP + flat + [lm_score.PAD] * 64)[k * lm_score.STEP :][: 2 * lm_score.STEP]
            assert row.tolist() == want


def test_no_look_ahead(model):
    a, b = np.arange(30) % 50, np.r_[np.arange(25) % 50, [1, 1, 1, 1, 1]]
    assert np.allclose(model.token_logs([a])[:25], model.token_logs([b])[:25], atol=1e-5)


def _logs(model, given, wanted):
    """Natural log-probability of every target."""
    h, _ = model._attend(given, model._tables())
    real = np.flatnonzero(wanted.ravel() != lm_score.PAD)
    order, *_, logs = model._soft(h.reshape(-1, lm_score.WIDTH)[real], given[:, lm_score.STEP :].ravel()[real], wanted.ravel()[real], model._tables())
    out = np.empty(len(real))
    out[order] = logs
    return out


@pytest.fixture()
def busy():
    """A model whose weights are none of them zero."""
    r = np.random.default_rng(7)
    model = lm_score.Model(r.integers(0, 9, (lm_score.CLASSES + 2, lm_score.CLASSES)).astype(float))
    model.w = {k: (r.standard_normal(x.shape) * 0.3).astype(np.float32) for k, x in model.w.items()}
    return model


def test_gradients(busy):
    r = np.random.default_rng(0)
    given, wanted, _ = lm_score.windows([r.integers(0, 50, 40), r.integers(0, 9, 3)])
    before = {k: x.astype(np.float64) for k, x in busy.w.items()}
    busy.w = {k: x.copy() for k, x in before.items()}
    found = busy.gradients(given, wanted)
    for name in busy.w:
        places = [(int(given[2, lm_score.STEP + i]), i) for i in range(4)] if name == "embed" else [tuple(int(r.integers(0, min(4, n) if name.startswith("member") and i == 0 else n)) for i, n in enumerate(before[name].shape)) for _ in range(4)]
        for at in places:
            sides = []
            for move in (1e-4, -1e-4):
                busy.w = {k: x.copy() for k, x in before.items()}
                busy.w[name][at] += move
                sides.append(-_logs(busy, given, wanted).mean())
            slope = (sides[0] - sides[1]) / 2e-4
            assert abs(found[name][at] - slope) < 1e-3 + 0.02 * abs(slope), name


def test_probabilities_sum_to_one(busy):
    given, wanted, _ = lm_score.windows([np.arange(9)])
    total = sum(np.exp(_logs(busy, given, np.where(wanted == lm_score.PAD, lm_score.PAD, c))) for c in range(lm_score.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)
    r = np.random.default_rng(1)
    counts, ids = r.integers(1, 5, 3000), r.integers(0, 900, 3000)
    first, once = np.bincount(ids, weights=counts, minlength=900), np.bincount(ids[counts == 1], minlength=900)
    words = lm_score.Subwords(first, r.integers(0, 50, 900), once)
    for k in range(2):
        assert np.allclose(np.bincount(words.class_of, weights=np.exp(words.shares[k]), minlength=lm_score.CLASSES)[np.bincount(words.class_of, minlength=lm_score.CLASSES) > 0], 1)
    never = np.full(3000, -1e9)  # what the model spells is a distribution of its own: half of what is left
    known = np.bincount(ids, weights=np.exp(words.rest(ids, counts, never)), minlength=900)
    new = np.exp(words.rest(np.arange(900), np.zeros(900, int), np.full(900, -1e9))) * (once + 1)
    assert np.allclose((known + new + words.left / 2)[first > 0], 1)


def test_every_subword_of_every_training_document_is_a_target(spark):
    """The encoder's own ids of the documents, counted, against what the model is given to predict."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = lm_score.prepare(rows, PATH)
    tokenizer, size = lm_score.encoder(PATH).tokenizer, lm_score.encoder(PATH).tokenizer.get_vocab_size()
    want, learnt, scored = Counter(), Counter(), Counter()
    texts = {r.doc_id: (r.text or "").translate({c: c + 32 for c in range(65, 91)}).split() for r in rows.collect()}
    ids_of = {w: tokenizer.encode(w, add_special_tokens=False).ids or [size] for ws in texts.values() for w in ws}
    for d, ws in texts.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            want.update([size + 1, *(i for w in ws for i in ids_of[w])])
    got: dict = {}
    for batch in own.rows.toArrow().to_batches():
        for block in lm_score._blocks([batch]):
            ends = np.cumsum(block.sizes)
            for d, a, b in zip(block.doc_ids.values.to_pylist(), ends - block.sizes, ends):
                got[d] = block.ids[a:b].tolist()
            classes = own.shared.value.class_of
            for turn in (range(lm_score.FIRST_ROUND), range(lm_score.FIRST_ROUND, lm_score.ROUNDS)):
                mine = ~block.held_out & np.isin(block.chosen % lm_score.ROUNDS, list(turn))
                for docs in lm_score._slices(block.documents(classes, mine)):
                    if docs:
                        targets = lm_score.windows(docs)[1]
                        learnt.update(targets[targets != lm_score.PAD].tolist())
            for docs in lm_score._slices(block.documents(classes, np.ones(len(block.tokens), bool))):
                targets = lm_score.windows(docs)[1]
                scored.update(targets[targets != lm_score.PAD].tolist())
    assert got == {d: [*(i for w in ws for i in ids_of[w]), size + 1] for d, ws in texts.items()}
    assert learnt == Counter(own.shared.value.class_of[i] for i in want.elements()) and learnt.total() > 1.5 * own.tokens
    assert scored.total() == sum(map(len, got.values()))


def test_a_block_is_read_in_runs(monkeypatch):
    """A block of 400,000 words holds their ids, not places of 8 bytes for each; runs are those that documents are trained in."""
    import tracemalloc

    monkeypatch.setattr(lm_score, "TOKENS", 1 << 14)
    r = np.random.default_rng(3)
    spell, lens = r.integers(1, 6, 5_000), r.integers(1, 2_000, 400)
    ids, at = r.integers(0, 900, spell.sum()).astype("<u2"), r.integers(0, 5_000, lens.sum())
    blobs = {"held_out": np.zeros(400, bool), "chosen": np.zeros(400, np.uint8), "lens": lens.astype("<i8"), "sequence": at.astype("<i4"), "counts": np.ones(5_000, "<i8"), "spell": spell.astype("<u2"), "ids": ids}
    batch = pa.RecordBatch.from_pylist([{"doc_ids": list(range(400))} | {k: v.tobytes() for k, v in blobs.items()}])
    starts, ends, bounds = np.cumsum(spell) - spell, np.cumsum(spell), np.cumsum([0, *lens])
    class_of = (np.arange(900) * 7 % lm_score.CLASSES).astype(np.int64)
    want = [np.concatenate([class_of[ids[starts[w] : ends[w]]] for w in at[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]
    tracemalloc.start()
    block = next(lm_score._blocks([batch]))
    got = block.documents(class_of, np.ones(400, bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert peak < 8 * block.sizes.sum()
    assert [len(x) for x in lm_score._slices(got)] == [b - a for a, b in block.runs()] and len(block.runs()) > 50


def test_every_training_token_gives_a_loss(monkeypatch):
    learnt = []
    monkeypatch.setattr(lm_score.Model, "step", lambda self, given, wanted, past: learnt.append(wanted))
    monkeypatch.setattr(lm_score, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 3})())}))
    docs = [(np.arange(n) * 7 % lm_score.CLASSES).astype(np.uint8) for n in range(1, 90)]
    blocks = [type("B", (), {"held_out": np.zeros(30, bool), "chosen": np.arange(30), "documents": lambda self, c, mine, own=docs[a : a + 30]: [d for d, m in zip(own, mine) if m]})() for a in (0, 30, 60)]
    blocks[-1].held_out, blocks[-1].chosen = np.zeros(29, bool), np.arange(29)
    monkeypatch.setattr(lm_score, "_blocks", lambda batches: batches)
    holder = lambda v: type("V", (), {"value": v})()
    model = lm_score.Model().to_bytes()
    outs = [next(lm_score._train(model, holder(None), holder(type("S", (), {"class_of": None})), turn)(iter(blocks))) for turn in (range(2), range(2, lm_score.ROUNDS))]
    got = np.concatenate([x.ravel() for x in learnt])
    assert sorted(got[got != lm_score.PAD].tolist()) == sorted(np.concatenate(docs).tolist())
    assert outs[0].column(0).to_pylist() == [3] and sum(o.column(1)[0].as_py() for o in outs) == sum(map(len, docs))


def test_scores_do_not_depend_on_the_slice(model):
    model.w["q"] = model.w["k"] = np.eye(lm_score.WIDTH, dtype=np.float32)
    model.w["embed"][1] = 30  # attends to itself with a score of thousands
    plain, strong = np.arange(2, 32), np.ones(30, np.int64)
    alone = model.token_logs([plain])
    assert np.allclose(model.token_logs([plain, strong])[: len(alone)], alone, atol=1e-4)


def brute_class_logs(model, pairs, classes):
    """One subword at a time, in plain loops over what it may see."""
    w = {k: x.astype(np.float64) for k, x in model.w.items()}
    alone = pairs.sum(axis=0) + 1.0
    given, step, out = [lm_score.BEGIN, *classes[:-1]], lm_score.STEP, []
    for t, target in enumerate(classes):
        seen = range(max(0, (t // step - 1) * step), t + 1)
        x = w["embed"][given[t]]
        q = x @ w["q"] / np.sqrt(lm_score.WIDTH)
        s = np.array([np.clip(q @ (w["embed"][given[j]] @ w["k"]), -20, 20) + np.clip(w["near"][t - j], -20, 20) for j in seen])
        a = np.exp(s - s.max()) / np.exp(s - s.max()).sum()
        h = x + sum(p * (w["embed"][given[j]] @ w["v"]) for p, j in zip(a, seen))
        prior = (pairs[given[t]] + lm_score.PRIOR * alone / alone.sum()).reshape(lm_score.GROUPS, lm_score.MEMBERS)
        g, m = divmod(target, lm_score.MEMBERS)
        total = 0.0
        for own, z in ((g, h @ w["group"] + w["group_bias"] + np.log(prior.sum(axis=1) / prior.sum())), (m, h @ w["member"][g] + w["member_bias"][g] + np.log(prior[g] / prior[g].sum()))):
            total += z[own] - z.max() - np.log(np.exp(z - z.max()).sum())
        out.append(total)
    return out


def test_scores_against_brute_force(spark):
    r = np.random.default_rng(4)
    docs = [(i, " ".join(r.choice(["the", "of", "Thing", "ingsheb", "unseen%d" % i, "a,b", "né", "ingshebly"], int(r.integers(0, 60))))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = lm_score.prepare(df, PATH)
    pairs, weights = lm_score.train_on(found.rows, found.shared)
    model = lm_score.Model(pairs).load(weights)
    own = [(d, [*t.translate({c: c + 32 for c in range(65, 91)}).split(), ""]) for d, t in docs]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in own}
    counts = Counter(w for d, ws in own if not held[d] for w in ws)
    tokenizer = lm_score.encoder(PATH).tokenizer
    size = tokenizer.get_vocab_size()
    ids_of = {w: (tokenizer.encode(w, add_special_tokens=False).ids or [size]) if w else [size + 1] for _, ws in own for w in ws}
    assert any(len(x) > 2 for x in ids_of.values())
    tokens, once, types = np.zeros((2, size + 2)), np.zeros(size + 2), 0
    want_pairs = np.zeros_like(pairs)
    for w, c in counts.items():
        tokens[0][ids_of[w][0]] += c
        once[ids_of[w][0]] += c == 1
        for i in ids_of[w][1:]:
            tokens[1][i] += c
    both = tokens.sum(axis=0)
    order = sorted(range(size + 2), key=lambda i: (-both[i], i))[: lm_score.CLASSES - lm_score.TAIL]
    alone = {i: k for k, i in enumerate(order)}
    cls = [alone.get(i, lm_score.CLASSES - lm_score.TAIL + i % lm_score.TAIL) for i in range(size + 2)]
    smooth = tokens + lm_score.SHARED * (both + 0.5) / (both + 0.5).sum()
    totals = [np.bincount(cls, weights=x, minlength=lm_score.CLASSES) for x in smooth]
    for d, ws in own:
        if not held[d]:
            flat = [cls[i] for w in ws for i in ids_of[w]]
            for a, b in zip([lm_score.BEGIN, *flat], flat):
                want_pairs[a, b] += 1
    assert np.array_equal(pairs, want_pairs)
    got = {x.doc_id: x.score for x in lm_score.score(df, PATH).collect()}
    for d, ws in own:
        logs, want = iter(brute_class_logs(model, pairs, [cls[i] for w in ws for i in ids_of[w]])), 0.0
        for w in ws:
            p = [next(logs) + math.log(smooth[int(k > 0)][i] / totals[int(k > 0)][cls[i]]) for k, i in enumerate(ids_of[w])]
            f, c = ids_of[w][0], counts[w]
            left = (once[f] + 0.5) / (tokens[0][f] + 1)
            rest = left / 2 * math.exp(sum(p[1:])) + ((1 - left) * c / tokens[0][f] if c else left / 2 / (once[f] + 1))
            want += p[0] + math.log(rest)
        assert abs(got[d] - want / math.log(10)) < 1e-3 * len(ws), d


def test_a_step_takes_few_exponentials(busy, monkeypatch):
    """Of a training step: two softmaxes a subword and one table of pairs of classes, none for each place that a subword sees."""
    seen, exp = [], np.exp
    given, wanted, _ = lm_score.windows([np.arange(40_000) * 7 % lm_score.CLASSES])
    monkeypatch.setattr(lm_score.np, "exp", lambda x, **to: (seen.append(np.size(x)), exp(x, **to))[1])
    busy.gradients(given, wanted)
    assert sum(seen) <= 40_000 * (lm_score.GROUPS + lm_score.MEMBERS) + (lm_score.CLASSES + 2) ** 2 + 2 * lm_score.STEP


@pytest.mark.parametrize("far", [1.0, 300.0, 3000.0])
def test_far_scores_stay_plain_numbers(busy, far):
    """Softmaxes of scores whose exponentials are too large or small for 4 bytes."""
    busy.w["group_bias"][3] += far
    busy.w["member_bias"][5] -= far
    docs = [np.arange(40) * 7 % lm_score.CLASSES]
    exact = brute_class_logs(busy, np.random.default_rng(7).integers(0, 9, (lm_score.CLASSES + 2, lm_score.CLASSES)).astype(float), docs[0].tolist())
    assert np.allclose(busy.token_logs(docs), exact, rtol=1e-4, atol=1e-3)
    given, wanted, _ = lm_score.windows(docs)
    assert all(np.isfinite(g).all() for g in busy.gradients(given, wanted).values())


def test_a_piece_that_words_share_is_spelled_once(monkeypatch):
    encode, words = lm_score.encoder(PATH), ["", "ant", "bee.", "ant,", "ant.", "bee,", "né", "né.", "x..y", "\x00", "ant"]
    asked, new = [], type(encode)._new
    monkeypatch.setattr(type(encode), "_new", lambda self, pieces: (asked.extend(pieces), new(self, pieces))[1])
    ids, lens = encode.spell(pa.array(words))
    assert len(asked) == len(set(asked))
    want = [encode.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert ids.tolist() == sum(want, []) and lens.tolist() == [len(x) for x in want]


def test_words_that_differ_by_a_point_meet_in_a_shard(spark):
    words = [a + b for a in ("ant", "bee", "cow", "né", "x") for b in ("", ".", ",")]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string").selectExpr("doc_id", "text", "false", "0")
    rows = df.mapInArrow(lm_score._ask(1 << 20), lm_score.ASKED).where("shard is not null").collect()
    assert sorted(w for r in rows for w in r.words.split(" ") if w) == sorted(words)
    assert len(rows) == 6 and all(len({w.rstrip(".,") for w in r.words.split(" ")}) == 1 for r in rows)  # the end is alone
