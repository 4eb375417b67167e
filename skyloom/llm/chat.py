r"""Chat formatting checked by a grammar round trip.

    conversation := turn*
    turn := "<|im_start|>" role "\n" body "<|im_end|>" "\n"

A turn is first rendered as it is, parsed again and compared with its source; only if it doesn't come back identical
are its role and text escaped. The parser always unescapes, so it needs no mark for that: `<`, backslashes and `|`
lose one backslash, and in roles `\n` and `\\` stand for a line feed and a backslash.

Defined results: null texts and roles are empty; turns are ordered by turn (nulls first), then role and text, and
repeated rows are turns of their own; rows with a null conv_id form one conversation; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import operator

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([n\\])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def parse(text: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, body's start, body's end) of each turn; None if the text isn't of the grammar."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            return None
        line = text.find("\n", at + len(START))
        end = text.find(END + "\n", line + 1) if line >= 0 else -1
        if end < 0:
            return None
        turns.append((unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : end]), line + 1, end))
        at = end + len(END) + 1
    return turns


def render_turn(role: str, text: str) -> str:
    for own_role, own_text in ((role, text), (role, escape(text)), (escape_role(role), text), (escape_role(role), escape(text))):
        out = f"{START}{own_role}\n{own_text}{END}\n"
        back = parse(out)
        if back is not None and [x[:2] for x in back] == [(role, text)]:
            return out
    raise ValueError("a turn doesn't survive its round trip")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans under the loss mask, checked as a whole."""
    out = "".join(render_turn(*t) for t in turns)
    back = parse(out)
    if back is None or [x[:2] for x in back] != turns:
        raise ValueError("a conversation doesn't survive its round trip")
    return out, [x[2:] for x in back if x[0] == LOSS_ROLE]


def _format(batches):
    for batch in batches:
        texts, masks = [], []
        for turns in batch.column(1).to_pylist():
            text, mask = render([(t["role"] or "", t["text"] or "") for t in turns])
            texts.append(text)
            masks.append([{"start": a, "stop": b} for a, b in mask])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(masks, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            names=["conv_id", "formatted", "loss_mask"],
        )


@operator
def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, the formatted text, and the loss mask as spans of code points."""
    turns = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return turns.mapInArrow(_format, "conv_id long, formatted string, loss_mask array<struct<start:long,stop:long>>")


def _read(batches):
    for batch in batches:
        found = []
        for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            turns = parse(text)
            said = "".join(f"{role}\n{own}\n" for role, own, _, _ in turns)
            loss = "".join(unescape(text[m["start"] : m["stop"]]) for m in mask)
            found.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        cols = list(zip(*found)) if found else [[]] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def digest(rows: DataFrame) -> DataFrame:
    formatted = format_conversations(rows)
    return formatted.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(rows: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts are control strings."""
    said = END + START + "assistant ok"
    probe = rows.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
