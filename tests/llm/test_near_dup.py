"""The n-gram Jaccard join against all pairs."""

import random
import re

import pytest

from skyloom.llm import near_dup


def sets(docs):
    out = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute(docs):
    own = sets(docs)
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 75 * len(own[i] | own[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(own[i]), least.get(find(i)) if own[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def answer(df):
    return sorted(map(tuple, near_dup.digest(df).collect()), key=str)


def corpus(seed, families=12):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    passage = [word() for _ in range(60)]
    docs = []
    for f in range(families):
        base = [word() for _ in range(r.choice([3, 12, 40, 90, 200]))]
        for k in range(r.choice([1, 2, 5, 25])):
            own = list(base)
            for _ in range(r.randrange(0, max(1, len(own) // 12) + 1)):
                at = r.randrange(len(own))
                own[at : at + 1] = r.choice([[word()], [], [own[at], word()]])
            base = own if r.random() < 0.3 else base  # chains of edits
            if r.random() < 0.4:
                own = own + passage
            docs.append((len(docs) * 3 % 1000, " ".join(own).title() if r.random() < 0.2 else " ".join(own)))
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed, monkeypatch):
    monkeypatch.setattr(near_dup, "PART", 7)
    docs = corpus(seed)
    assert answer(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_parts_and_shares(spark, monkeypatch):
    for name, n in (("PART", 3), ("QUERIES", 2), ("MEETINGS", 5)):
        monkeypatch.setattr(near_dup, name, n)
    docs = corpus(4)
    assert answer(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_all_pairs_of_documents(spark):
    """Every pair of sf0.01 that shares a shingle; pairs without one can't be similar."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()]
    own, at, both = sets(docs), {}, {}
    for i, x in enumerate(own):
        for t in x:
            at.setdefault(t, []).append(i)
    for found in at.values():
        for k, i in enumerate(found):
            for j in found[:k]:
                both[i, j] = both.get((i, j), 0) + 1
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    links = [(i, j) for (i, j), n in both.items() if 100 * n >= 75 * (len(own[i]) + len(own[j]) - n)]
    for i, j in links:
        label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    assert len(links) > 50
    assert answer(rows) == sorted(((d, len(own[i]), least[find(i)] if own[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def test_keep_one_of_equal_rows_is_defined(spark):
    rows = [(5, "one two three", "b"), (5, "one two three", "a"), (7, "one two three", "A"), (None, None, "x"), (None, None, "x")]
    got = near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, __k_id string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, "one two three", "a"), (None, None, "x"), (None, None, "x")], key=str)


def test_odd_documents(odd, odd_docs, empty):
    assert answer(odd) == brute(odd_docs)
    assert answer(empty) == []


def test_keep_one(spark, odd, odd_docs):
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns
    want = brute(odd_docs)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([c for c in {c for _, n, c in want if n}] + [d for d, n, _ in want if not n], key=str)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 80), (80, 80)], "a long, b long")
    got = {r.id: r.label for r in near_dup.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {80: 80, 90: 80}


@pytest.mark.parametrize("percent", [33, 50, 60, 66, 75, 100])
def test_small_sets_at_any_percent(spark, percent):
    r = random.Random(percent)
    docs = [(3 * f + k, " ".join(f"w{f}x{i}" for i in r.sample(range(5), r.randint(1, 4)))) for f in range(40) for k in range(3)]
    own = [set(t.split()) for _, t in docs]
    label = list(range(len(docs)))
    for _ in range(3):
        for i in range(len(docs)):
            for j in range(len(docs)):
                if 100 * len(own[i] & own[j]) >= percent * len(own[i] | own[j]):
                    label[i] = min(label[i], label[j])
    got = near_dup.digest(spark.createDataFrame(docs, "doc_id long, text string"), 1, percent).collect()
    assert {x.doc_id: x.component_id for x in got} == dict(enumerate(label))


def test_percent_is_checked(spark):
    with pytest.raises(ValueError, match="percent"):
        near_dup.digest(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 1, 0)
