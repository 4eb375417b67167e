"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the failure bits and the measurements, so that a
policy (a versioned choice of rules) and its ablations are bitwise work on the ledger, without the texts.

Defined results: a null or empty text has no words and fails `few_words`; a null id stays null; repeated rows are
judged one by one; other columns are ignored or kept, whatever they are called; an empty table gives an empty ledger,
and ablations of zeros for no rule. Texts are judged whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import WHITE, WordHashes, free_name, only, operator, shingles, utf8, written

#: Rules in bit order.
RULES = ("few_words", "repeated_windows", "symbols", "word_length", "repeated_lines", "capitals")
BIT = {name: 1 << i for i, name in enumerate(RULES)}
#: A policy is a set of rules; a document is kept if it fails none of them.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "word_length"),
    "v2": RULES,
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")
SCHEMA = "doc_id long, fail_bits long, " + ", ".join(f"{m} long" for m in MEASURES)
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_WHITE = np.frombuffer(WHITE, np.uint8)


def measures(text: bytes, hashes: WordHashes) -> tuple[int, ...]:
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    word_chars = int(counts.sum() - counts[0x80:0xC0].sum() - counts[_WHITE].sum())
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n > 8:
        h = shingles(hashes(words), 8)
        _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        if len(times) < len(h):
            at = np.flatnonzero(times[inverse] > 1)
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + 8, -1)
            repeated = int((np.cumsum(edges[:n]) > 0).sum())
    return n, word_chars, int(counts[SYMBOLS].sum()), len(lines), len(lines) - len(set(lines)), repeated, upper, upper + lower


def failures(m: tuple[int, ...]) -> int:
    n, chars, symbols, lines, dup_lines, repeated, upper, letters = m
    failed = (
        n < 20,
        100 * repeated > 30 * n,
        100 * symbols > 50 * n,
        n > 0 and not 2 * n <= chars <= 15 * n,
        100 * dup_lines > 50 * lines,
        100 * upper > 50 * letters,
    )
    return sum(1 << i for i, bad in enumerate(failed) if bad)


def _ledger(batches):
    only()
    hashes = WordHashes()
    for batch in batches:
        found = [measures(t, hashes) for t in utf8(batch.column(1))]
        cols = list(zip(*found)) if found else [[]] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([failures(m) for m in found], pa.int64()), *(pa.array(c, pa.int64()) for c in cols)],
            names=["doc_id", "fail_bits", *MEASURES],
        )


@operator
def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, fail_bits and the measurements of every row of docs. No shuffle."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_ledger, SCHEMA)


def policy_bits(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def verdict(policy: str = "v2", bits: str = "fail_bits"):
    """A column for a ledger: does the policy keep the document?"""
    return F.col(bits).bitwiseAND(F.lit(policy_bits(policy))) == 0


def ablation(led: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of the policy: documents that fail it, and those that would be kept without it alone.

    The ledger is first counted by its bits, of which there are at most 2 ** len(RULES)."""
    bits = policy_bits(policy)
    counted = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(bits)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy])))
    return (
        counted.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this"),
        )
    )


@operator
def ablations(docs: DataFrame) -> DataFrame:
    """policy, rule, failed, only_this: for every policy and each of its rules, from one ledger of docs."""
    led = written(ledger(docs).select("fail_bits"), "ledger")
    every = [ablation(led, p).select(F.lit(p).alias("policy"), "rule", "failed", "only_this") for p in POLICIES]
    return reduce(DataFrame.unionByName, every)


def digest(docs: DataFrame, policy: str = "v2") -> DataFrame:
    base = verdict("base")
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), (base & verdict(policy)).alias("kept"), "fail_bits", "n_lines", "n_upper", "n_letters",
        F.lit(policy).alias("policy"), *(verdict(p).alias(f"kept_{p}") for p in POLICIES),
    )


def _with_bits(at: int, name: str):
    def step(batches):
        only()
        hashes = WordHashes()
        for batch in batches:
            yield batch.append_column(name, pa.array([failures(measures(t, hashes)) for t in utf8(batch.column(at))], pa.int64()))

    return step


@operator
def keep(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The rows of docs that the policy and the base keep, with all their columns: a filter on the ledger's bits, which ride with the rows."""
    bits = free_name("fail_bits", docs.columns)
    schema = StructType([*docs.schema.fields, StructField(bits, LongType())])
    led = docs.mapInArrow(_with_bits(docs.columns.index("text"), bits), schema)
    return led.where(verdict(policy, bits) & verdict("base", bits)).drop(bits)
