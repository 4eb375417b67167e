"""The pipeline against brute force over its stages."""

import hashlib
import os
import random
import re
import sys

import numpy as np
import public_tokenizers
import tiktoken

from skyloom.llm import bpe

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

from .test_grouped_operators import WHITE, lower  # noqa: E402
from .test_near_dup import brute as brute_components  # noqa: E402
from .test_row_operators import brute_contamination, brute_quality  # noqa: E402


def corpus():
    r = random.Random(5)
    word = lambda: f"w{r.randrange(900)}"
    docs, bench = [], [(1, " ".join(word() for _ in range(14)))]
    for i in range(60):
        own = [word() for _ in range(r.choice([5, 30, 60, 120]))]
        lines = [" ".join(own[a : a + 12]) for a in range(0, len(own), 12)]
        if i % 3 == 0:
            lines.insert(1, "Licensed under the same terms")
        if i % 10 == 4:
            lines.append(bench[0][1])
        docs.append((i, "\n".join(lines), "en", f"s{i % 4}", 0))
        if i % 6 == 0:
            docs.append((1000 + i, "\n".join([*lines, "one more"]), "en", "s0", 0))
    docs += [(2000, None, None, None, None), (2001, "x " * 200, "en", "s", 400), (2002, "### $$$ " * 40, "en", "s", 1)]
    return docs, bench


def good(text):
    """The rules, written out: enough words, few repeated windows, symbols, repeated lines and capitals, words of usual length."""
    n, chars, symbols, dup_lines, repeated = brute_quality(text)
    lines = sum(bool(x.strip(WHITE)) for x in text.split("\n"))
    upper, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
    return n >= 20 and repeated <= 0.3 * n and symbols <= 0.5 * n and 2 <= chars / n <= 15 and dup_lines <= 0.5 * lines and upper <= 0.5 * letters


def expected(docs, bench):
    kept = [(d, t) for d, t, *_ in docs if good(t or "")]
    seen = {}
    for d, t in kept:
        for k in {lower(x.strip(WHITE)) for x in (t or "").split("\n")} - {""}:
            seen[k] = seen.get(k, 0) + 1
    kept = [(d, "\n".join(x for x in (t or "").split("\n") if seen.get(lower(x.strip(WHITE)), 0) < 10)) for d, t in kept]
    parts = brute_components(kept)
    first = {(d, n): c for d, n, c in parts}
    kept = [(d, t) for d, t in kept if any(k[0] == d and (c == d or k[1] == 0) for k, c in first.items())]
    kept = [(d, t) for d, t in kept if not brute_contamination(t, bench)[-1]]
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    return sorted((d, hashlib.sha256(np.array(e.encode_ordinary(t), "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t in kept)


def test_pipeline(spark, tmp_path):
    docs, bench = corpus()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = expected(docs, bench)
    assert got == want and 10 < len(got) < 60


def test_stages_keep_the_columns(spark, tmp_path):
    docs, bench = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.schema.simpleString() == df.schema.simpleString()
        assert stage(spark, df.where("false"), str(tmp_path)).collect() == []
