"""Operators that judge or encode each document alone, against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyloom.llm import bpe, decontaminate, quality, token_files

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference_bpe():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


def test_bpe_of_documents(spark, odd, odd_docs, reference_bpe):
    got = sorted(map(tuple, bpe.digest(odd, RANKS, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for d, t in odd_docs:
        ids = reference_bpe.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t  \x1c'sdtaeé1")), max_size=60))
def test_bpe_of_any_text(codec, reference_bpe, text):
    ids = codec.encode([text])
    assert np.frombuffer(ids[0], "<u4").tolist() == reference_bpe.encode_ordinary(text)
    assert codec.decode(ids) == [text.encode()]


def test_bpe_round_trip_of_id_lists(odd, odd_docs):
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    got = Counter(bytes(r[1]) for r in bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect())
    assert got == Counter((t or "").encode() for _, t in odd_docs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "ab", "the", "qu", "-", "--", "=", "é", "日", "zx"]), st.integers(1, 70)), min_size=3, max_size=30))
def test_bpe_of_long_words(codec, reference_bpe, parts):
    text = "".join(x * n for x, n in parts)
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == reference_bpe.encode_ordinary(text)


def test_bpe_of_a_hundred_thousand_letters(codec, reference_bpe):
    import random
    import time

    r = random.Random(3)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH") for _ in range(100_000)) + "-" * 5001
    began = time.time()
    got = codec.encode([text])[0]
    assert time.time() - began < 30
    assert np.frombuffer(got, "<u4").tolist() == reference_bpe.encode_ordinary(text)


def test_bpe_of_a_word_that_takes_several_queries(codec, reference_bpe, monkeypatch):
    monkeypatch.setattr(bpe, "ROWS", 300)
    words = [b"thequickbrownfox" * n for n in (1, 2, 9)] + [b"x"]
    assert [x.tolist() for x in codec.merge(words)] == [reference_bpe.encode_ordinary(w.decode()) for w in words]


def test_bpe_of_no_documents(empty):
    assert bpe.digest(empty, RANKS, public_tokenizers.PATTERN).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t  'sdtAeÉ1<|>")), max_size=60))
def test_token_file_pieces_are_the_whole_texts_ids(text):
    whole = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_files.encoder(WORDS)([text], end=None)[0], "<u2").tolist() == whole


def test_token_files(odd, odd_docs):
    import zlib

    t = Tokenizer.from_file(WORDS)
    files = token_files.write_files(odd, WORDS)
    got = sorted((tuple(r) for r in token_files.read_files(files).collect()), key=lambda r: r[1])
    want = sorted((d is not None, d or 0, zlib.crc32(np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for d, x in odd_docs)
    assert sorted((r[0] is not None, r[0] or 0, r[3]) for r in got) == want
    assert [r[0] is not None and r[0] for r in got] == [w[0] and w[1] for w in want]
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]


def test_token_files_of_no_documents(empty):
    assert token_files.digest(empty, WORDS).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=900))
def test_elias_fano(values):
    values = np.cumsum(values)
    f, _ = token_files.EliasFano.from_bytes(token_files.EliasFano.build(values).to_bytes(), 0)
    assert f.all().tolist() == f.take(np.arange(len(values))).tolist() == values.tolist()
    assert f.take(np.arange(len(values))[::-3]).tolist() == values[::-3].tolist()
    assert [f[i] for i in range(0, len(values), 7)] == values[::7].tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 500))
    f = token_files.EliasFano.build(values)
    assert 8 * len(f.to_bytes()) < 12.5 * len(values)


def brute_quality(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {p for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_quality(odd, odd_docs):
    rows = quality.digest(odd).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == Counter((d, *brute_quality(t)) for d, t in odd_docs)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_policies_and_ablations(odd, empty):
    led = quality.ledger(odd)
    bits = [r.fail_bits for r in led.collect()]
    for row in quality.ablation(led, "v2").collect():
        bit = quality.BIT[row.rule]
        assert (row.failed, row.only_this) == (sum(b & bit > 0 for b in bits), sum(b == bit for b in bits))
    assert quality.keep(odd).columns == odd.columns
    assert quality.keep(odd).count() == sum(b == 0 for b in bits)
    assert quality.digest(empty).collect() == []


def brute_contamination(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item_id, item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        m = min(10, len(own))
        for i in range(len(own) - m + 1) if own else ():
            for j in range(len(words) - m + 1):
                if words[j : j + m] == own[i : i + m]:
                    hit |= set(range(j, j + m))
                    found.add(item_id)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)


def test_contamination(spark, odd, odd_docs, empty):
    items = [(1, "quick BROWN fox"), (2, None), (3, ""), (22, "same"), (10, " ".join(f"w{i % 97}{'é' * (i % 3)}" for i in range(40, 55))), (10, "line"), (5, "quick brown fox!"), (6, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter((d, *brute_contamination(t, items)) for d, t in odd_docs)
    assert Counter(map(tuple, decontaminate.digest(odd, bench).collect())) == want
    clean = decontaminate.drop_contaminated(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(n for k, n in want.items() if not k[-1])
    assert decontaminate.digest(empty, bench).collect() == []
    assert all(not r.contaminated for r in decontaminate.digest(odd, bench.where("false")).collect())
    blocks = list(decontaminate.benchmark_blocks(bench, 20))
    assert len(blocks) > 2 and Counter(x for b in blocks for x in b) == Counter((i, (t or "").encode()) for i, t in items)
    got = decontaminate.contamination(odd, bench, block_bytes=20).drop("item_ids")
    assert got.columns == decontaminate.digest(odd, bench).columns and Counter(map(tuple, got.collect())) == want
    some = decontaminate.drop_contaminated(odd, bench, block_bytes=20)
    assert some.columns == odd.columns and Counter(map(tuple, some.collect())) == Counter(map(tuple, clean.collect()))


def test_tables_are_built_once_a_task_and_block(monkeypatch):
    import pyarrow as pa

    built, make = [], decontaminate.tables
    monkeypatch.setattr(decontaminate, "tables", lambda *a: built.append(1) or make(*a))

    class Block:
        value = [(1, b"some words of an item")]

    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array(["here some words of an item stand"])], names=["doc_id", "text"]) for i in range(5)]
    out = list(decontaminate._scan(Block(), 1, 10, "report")(iter(batches)))
    assert len(built) == 1 and [b.column(2).to_pylist() for b in out] == [[5]] * 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=40), st.lists(st.lists(st.sampled_from("ab"), min_size=1, max_size=14), min_size=1, max_size=4))
def test_wu_manber_on_small_alphabets(words, items):
    text, rows = " ".join(words), [(i, " ".join(x)) for i, x in enumerate(items)]
    hit, found = np.zeros(len(words), bool), set()
    decontaminate.search([w.encode() for w in words], decontaminate.tables([(i, x.encode()) for i, x in rows]), hit, found)
    want = brute_contamination(text, rows)
    assert (int(hit.sum()), len(found)) == want[1:3]
