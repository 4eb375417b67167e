"""Line dedup, chat formatting and archives, against brute force."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import chat, line_dedup, warc

WHITE = " \t\n\x0b\x0c\r"


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def brute_lines(docs, least):
    seen = Counter(k for _, t in docs for k in {lower(x.strip(WHITE)) for x in (t or "").split("\n")} if k)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[lower(x.strip(WHITE))] < least]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(spark, odd, odd_docs, empty):
    assert Counter(map(tuple, line_dedup.digest(odd, 2).collect())) == brute_lines(odd_docs, 2)
    assert line_dedup.drop_frequent_lines(odd, 2).columns == odd.columns
    assert line_dedup.digest(empty).collect() == []
    docs = [(i, "\n".join(f"line {j}" if (i * j) % 7 else " Shared\t" for j in range(i % 5 + 1))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter(map(tuple, line_dedup.digest(df).collect())) == brute_lines(docs, 10)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.uint64)
    mph = line_dedup.PerfectHash.from_bytes(line_dedup.PerfectHash.build(keys).to_bytes())
    assert sorted(mph(keys).tolist()) == list(range(len(keys)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(*[st.text(alphabet=st.sampled_from("<|\\>n\nxim_endstart é"), max_size=20) | st.sampled_from([chat.END + "\n", chat.START, "<\\|", "\\n"])] * 2), max_size=4))
def test_chat_round_trip(turns):
    text, mask = chat.render(turns)
    assert [x[:2] for x in chat.parse(text)] == turns
    assert [chat.unescape(text[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_chat_digest(spark):
    rows = [(1, 0, "user", None, 5), (1, 1, "assistant", "x<\\|y\n", 5), (1, 1, "assistant", "x<\\|y\n", 5), (None, 0, None, "", 5), (2, None, "assistant", "é" * 5000, 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat.digest(chat.with_probe(df)).collect()}
    by = defaultdict(list)
    said = chat.END + chat.START + "assistant ok"
    for c, _, r, t, *_ in sorted([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)], key=lambda x: (x[1] is not None, x[1] or 0)):
        by[c].append((r or "", t or ""))
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert len(got) == len(by)
    assert chat.digest(df.where("false")).collect() == []


def test_archives(spark, tmp_path):
    rows = [(1, "http://a b/\n", "x\r\n\r\ny", 1), (2, None, "x\r\n\r\ny", 1), (3, "u", None, 1), (4, "u", "", 1), (5, "v", "é" * 9000, 1), (5, "v", "é" * 9000, 1), (None, "w", "é" * 9000, 1), (None, "w", "lone", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, keeper int")
    for least in (0, 3):
        got = Counter(map(tuple, warc.digest(df, least).collect()))
        want = []
        for i, _, h, _ in rows:
            p = (h or "").encode()
            keeper = max((j for j, _, g, _ in rows if (g or "").encode() == p and j is not None), default=None)
            again = len(p) >= least and keeper != i
            want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", keeper if again else None))
        assert got == Counter(want)
    archives = warc.write_archives(df)
    assert warc.export(archives, str(tmp_path)) == archives.count()
    headers = [h for f in tmp_path.iterdir() for h, _ in warc.parse_warc(f.read_bytes())]
    assert {h["warc-date"] for h in headers} == {"2026-01-01T00:00:00Z"}
    kinds = Counter(h["warc-type"] for h in headers)
    assert kinds["warcinfo"] == archives.count() and kinds["response"] + kinds["revisit"] == len(rows)
    ids = Counter(h["warc-record-id"] for h in headers)
    assert sorted(ids.values()) == [1] * (len(ids) - 1) + [2]  # the two equal responses of page 5 alone share theirs
    assert all(ids[h["warc-refers-to"]] for h in headers if h["warc-type"] == "revisit")
    assert warc.digest(df.where("false")).collect() == []


def test_arc_versions():
    for version in (1, 2):
        data = warc.arc_version_block(version, "n.arc", "20260101000000") + warc.arc_record(version, "u", b"a\nb", "20260101000000", "n.arc", 9) + warc.arc_record(version, "v", b"", "20260101000000", "n.arc", 9)
        assert [(r["url"], r["content"], r["version"]) for r in warc.parse_arc(data)] == [("u", b"a\nb", version), ("v", b"", version)]
