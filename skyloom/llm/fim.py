r"""Fill-in-middle: texts are cut into units, two ranked cuts give prefix, middle and suffix, and marks reorder them.

The cuts of a text are the offsets of the tokenizers library's Split pre-tokenizer with isolated matches: code points,
no training, no vocabulary. Their number is the number of units; the two chosen ranks are looked up in them, and the
parts are slices of the text. Each row is done alone, so nothing is shuffled and a lost task is done again from its rows.

Ranks and form come from the SHA-256 of `seed:doc_id`, so that they don't depend on the order or place of rows. A text
that holds a mark stays plain: then every mark of an output is one that was put there, and restore() gives the text back.

Defined results: a null or empty text is plain, with no units; a null id counts as the empty string; repeated rows are
cut alike; a pattern's matches and what lies between them are units, so units always add up to the text; other columns are
ignored by fill_in_middle; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from .common import only, operator

#: A unit is a line with its end.
LINES = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")


class Rates(NamedTuple):
    """Out of 100: texts that are cut, and those of them that begin with the suffix."""

    cut: int = 100
    suffix_first: int = 50


def units_of(pattern: str) -> Callable[[str], list[int]]:
    """Gives the ends of a text's units, in code points."""
    split = Split(Regex(pattern), behavior="isolated")
    return lambda text: [span[1] for _, span in split.pre_tokenize_str(text)] if text else []


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four 32-bit numbers of a document's digest."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[i : i + 4], "big") for i in range(0, 16, 4)]


class Cut(NamedTuple):
    n: int
    form: str
    prefix: int | None
    middle: int | None
    output: str


def cut(text: str, h: list[int], ends: list[int], rates: Rates = Rates(), marks: tuple[str, str, str] = MARKS) -> Cut:
    n = len(ends)
    if not text or any(m in text for m in marks) or h[2] % 100 >= rates.cut:
        return Cut(n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m = (ends[i - 1] if i else 0 for i in (a, b))
    prefix, middle, suffix = text[:p], text[p:m], text[m:]
    begin, end, mid = marks
    if h[3] % 100 < rates.suffix_first:
        return Cut(n, "spm", p, m - p, f"{end}{suffix}{begin}{prefix}{mid}{middle}")
    return Cut(n, "psm", p, m - p, f"{begin}{prefix}{end}{suffix}{mid}{middle}")


def restore(output: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    """The text of an output."""
    if form == "plain":
        return output
    begin, end, mid = marks
    first, second = (begin, end) if form == "psm" else (end, begin)
    head, _, middle = output.removeprefix(first).partition(mid)
    one, _, two = head.partition(second)
    return one + middle + two if form == "psm" else two + middle + one


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _cut(pattern: str, seed: int, rates: Rates, marks: tuple[str, str, str]):
    def step(batches):
        only()
        ends = units_of(pattern)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            done = [cut(t or "", draws(seed, i), ends(t or ""), rates, marks) for i, t in zip(ids, batch.column(1).to_pylist())]
            n, form, prefix, middle, output = zip(*done) if done else ([],) * 5
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), long(n), pa.array(form, pa.string()), long(prefix), long(middle), pa.array(output, pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return step


@operator
def fill_in_middle(docs: DataFrame, pattern: str = LINES, seed: int = 7, rates: Rates = Rates(), marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Per document: its number of units, its form, the lengths of prefix and middle (null if plain), and the output.

    Marks must begin with a character that they don't hold again, so that none arises where a text meets a mark."""
    if any(a and (a[0] in b[1:] or a != b and a.startswith(b)) for a in marks for b in marks) or not all(marks):
        raise ValueError("a mark is empty, begins with another, or holds the first character of one after its own first")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(pattern, seed, rates, marks), SCHEMA)


def _restore(marks: tuple[str, str, str]):
    def step(batches):
        only()
        for batch in batches:
            texts = [restore(o, f, marks) for o, f in zip(batch.column(batch.schema.get_field_index("output")).to_pylist(), batch.column(batch.schema.get_field_index("form")).to_pylist())]
            yield batch.append_column("restored", pa.array(texts, pa.string()))

    return step


@operator
def restored(cuts: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """cuts (form, output and any others) with the text of each, rebuilt from these two alone."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cuts.schema.fields)
    return cuts.mapInArrow(_restore(marks), f"{fields}, restored string")


def digest(docs: DataFrame) -> DataFrame:
    return restored(fill_in_middle(docs)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
