"""Repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import repeats


def brute(docs):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((d, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus(seed):
    r = random.Random(seed)
    noise = lambda n: "".join(r.choice("abcdé fgh ij") for _ in range(n))
    shared = [noise(n) for n in (199, 200, 201, 420, 900)]
    docs = []
    for i in range(60):
        parts = [noise(r.randrange(5, 400))]
        for _ in range(r.randrange(0, 3)):
            s = r.choice(shared)
            a = r.randrange(0, max(1, len(s) - 150))
            parts += [s[a:] if r.random() < 0.4 else s, noise(r.randrange(0, 300))]
        docs.append((i, "".join(parts)))
    docs += [(100, "ab" * 400), (101, "a" * 650), (102, "xyz" * 66), (103, docs[3][1]), (104, docs[3][1]), (105, docs[5][1][:150])]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    docs = corpus(seed)
    got = Counter(map(tuple, repeats.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    want = brute(docs)
    assert got - want == Counter() and want - got == Counter()


def test_hot_anchors_are_split(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SPLIT", 3)
    docs = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    _, own = repeats.bucketed(df.where("text is not null").dropDuplicates(["text"]).selectExpr("doc_id as key", "text"))
    assert own.where("shift > 0").count() > 0
    got, want = Counter(map(tuple, repeats.digest(df).collect())), brute(docs)
    assert got - want == Counter() and want - got == Counter()


def test_most_buckets_merge_several_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null").dropDuplicates(["text"])
    _, own = repeats.bucketed(docs.selectExpr("doc_id as key", "text"))
    shards = [r.size / repeats.SHARD for r in own.groupBy("bucket").agg(F.sum(F.length("bytes")).alias("size")).collect()]
    assert len(shards) >= 8 and sum(x > 1 for x in shards) > 0.9 * len(shards)


def test_odd_documents(odd, odd_docs, empty):
    assert Counter(map(tuple, repeats.digest(odd).collect())) == brute(odd_docs)
    assert repeats.digest(empty).collect() == []


@pytest.mark.parametrize("shard", [300, 2000, 1 << 20])
def test_merged_shards(shard):
    r = random.Random(shard)
    core = bytes(r.randrange(97, 100) for _ in range(230))
    snippets = [bytes(r.randrange(97, 100) for _ in range(r.randrange(0, 60))) + core[r.randrange(0, 10) :] + bytes(r.randrange(97, 100) for _ in range(r.randrange(0, 60))) for _ in range(25)]
    snippets = [s for s in dict.fromkeys(snippets) if len(s) >= 200]
    weights = np.array([1 + (i % 5 == 0) for i in range(len(snippets))])
    seen = Counter()
    for s, w in zip(snippets, weights):
        for i in range(len(s) - 199):
            seen[s[i : i + 200]] += int(w)
    want = {i: [p for p in range(len(s) - 199) if seen[s[p : p + 200]] > 1] for i, s in enumerate(snippets)}
    got = {i: p.tolist() for i, p in repeats.repeated_places(snippets, weights, shard)}
    assert got == {i: p for i, p in want.items() if p}


def test_common_prefixes_of_merged_transforms():
    snippets = [b"x" * 50 + b"y" * 150, b"x" * 50 + b"y" * 100 + b"z" * 50, b"q" * 200]
    shards = [repeats.Shard([s]) for s in snippets]
    owner, row, common = repeats.merge(shards)
    suffixes = []
    for o, r in zip(owner.tolist(), row.tolist()):
        p = int(shards[o].place[shards[o].order[r]])
        suffixes.append((o, p, [snippets[o][a : a + 50] for a in range(p, 151, 50)]))
    assert len({(o, p) for o, p, _ in suffixes}) == 3 * 201
    for (_, _, a), (_, _, b), c in zip(suffixes, suffixes[1:], common[1:].tolist()):
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert min(same, 4) == c


def test_anchors_of_long_and_repeating_texts():
    data = np.frombuffer(bytes(range(256)) * 5000, np.uint8)
    at, h = repeats.anchors(data)
    assert len(at) == len(data) - 199 and (at >= np.arange(len(at))).all() and (at <= np.arange(len(at)) + 150).all()
    short, _ = repeats.anchors(data[:5000])
    assert (short == at[: len(short)]).all() or len(set(np.diff(short).tolist())) < 300
