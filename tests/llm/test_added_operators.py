"""URL filters, source divergence and fill-in-middle against brute force, with odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import divergence, fim, url_filter

# ---- URL filters ----

LINK = '<html><head><LINK href="{}" rel=canonical></head></html>'
PAGES = [
    (1, "http://a.net/de/1", LINK.format("http://b.net/es/1?q=1&amp;r=2#x")),  # its canonical page is blocked
    (2, "https://b.net/es/1?q=1&r=2", ""),
    (3, "http://c.org/x/", '<link rel="stylesheet" href="/s.css"><link rel="canonical" href="../a">'),
    (4, "http://c.org/x/../a", '<meta http-equiv="refresh" content="0; url=http://a.net/de/1">'),  # two steps from a blocked one, by another page
    (5, "http://www.example.com/en/7", LINK.format("http://x.example.com/en/7")),  # allowed by its rule, its canonical page blocked
    (6, "http://x.example.com/en/7", None),
    (7, "http://d.org/1", LINK.format("mailto:me@d.org")),
    (8, "http://e.org", LINK.format("/up")),
    (8, "http://e.org", LINK.format("/up")),
    (9, "HTTP://E.ORG/up#frag", LINK.format("")),
    (10, None, LINK.format("http://a.net/es/")),
    (11, "no scheme/es/", LINK.format("http://a.net/es/")),
    (None, "http://f.org:80/p?u=http://g.net/es/", LINK.format("//H.net/fr/2")),
    (12, "://h.net/fr/2", "<link rel=canonical>"),
    (13, "http://xnet/es/", ""),
    (14, "http://example.com", "x" * 300_000),
    (15, "http://i.org/", LINK.format("http://i.org/")),
]


def _address(url):
    m = re.search(r"://([^/?#]*)([^?#]*)(\?[^#]*)?", url or "")
    return m and (m[1].lower() + (m[2] or "/") + (m[3] or ""))


def _verdicts(pages, edges, rules):
    def own(url):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if m and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fit)[2:] if fit else (None, None))

    near = defaultdict(set)
    bad = set()
    for a, b in edges:
        near[_address(a)].add(_address(b))
        near[_address(b)].add(_address(a))
        bad |= {_address(u) for u in (a, b) if own(u)[3] == "block"}
    todo = list(bad)
    while todo:
        new = near[todo.pop()] - bad
        bad |= new
        todo += new
    out = []
    for page_id, url, _ in pages:
        host, path, rule, verdict = own(url)
        out.append((page_id, host, path, rule, verdict or ("block" if _address(url) in bad else "allow")))
    return sorted(map(repr, out))


EDGES = [("http://a.net/de/1", "http://b.net/es/1?q=1&r=2"), ("http://c.org/x/", "http://c.org/x/../a"), ("http://c.org/x/../a", "http://a.net/de/1"), ("http://www.example.com/en/7", "http://x.example.com/en/7"), ("http://e.org", "http://e.org/up"), ("http://f.org:80/p", "http://h.net/fr/2"), ("://f.org:80/p?u=http://g.net/es/", "http://h.net/fr/2")]


def _judged(df):
    return sorted(repr(tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict"))) for r in df.collect())


def test_url_verdicts_reach_aliases(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, host string")
    got = url_filter.digest(pages)
    assert _judged(got) == _verdicts(PAGES, EDGES[:5] + EDGES[6:], url_filter.RULES)
    by_id = {r.page_id: r for r in got.collect()}
    assert [by_id[i].verdict for i in (1, 3, 4, 5, None)] == ["block", "block", "block", "allow", "block"] and by_id[3].by_alias and not by_id[5].by_alias


def test_url_redirects_and_a_hot_address(spark):
    pages = [(i, "http://hub.org/" if i % 3 else f"http://a{i}.org/", None) for i in range(600)]
    moved = [(f"http://a{i}.org/", "/in") for i in range(0, 600, 3)] + [(f"http://a{i}.org/in", "http://hub.org/") for i in range(0, 600, 6)] + [("http://hub.org/", "http://sink.net/es/"), (None, "http://a.org"), ("http://a.org", None)]
    edges = [(a, "http://" + a.split("/")[2] + b if b.startswith("/") else b) for a, b in moved if a and b]
    got = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), url_filter.RULES, spark.createDataFrame(moved, "source string, target string"))
    assert _judged(got) == _verdicts(pages, edges, url_filter.RULES)
    assert Counter(r.verdict for r in got.collect())["block"] > 400


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b.a", "c.b.a", "", "xa"]), st.sampled_from(["", "/", "/x", "/x/y", "y"]), st.sampled_from(["allow", "block"])), max_size=6), st.sampled_from(["a", "b.a", "c.b.a", ".a", "xa", "", "a."]), st.sampled_from(["", "/", "/x/y/z", "/xy"]))
def test_longest_rule(rules, host, path):
    rules = [r for r in rules if r[0]]
    fit = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    got = url_filter.Rules(rules).of(host, path)
    assert (got is None) == (not fit)
    if fit:
        assert (len(got[0]), got[1] == "allow") == max(fit)[:2]


def test_url_tables_without_rows_or_rules(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert url_filter.digest(pages.where("false")).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}


# ---- source divergence ----


def _audit(rows, min_docs, top):
    words = lambda t: re.findall(rb"[A-Za-z\x80-\xff]+", (t or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    out = []
    for lang in {r[1] or "" for r in rows}:
        own = [(words(t), s or "") for t, la, s in rows if (la or "") == lang]
        in_docs = Counter(w for ws, _ in own for w in set(ws))
        kept = sorted(w for w, n in in_docs.items() if n >= min_docs)
        groups = {s: Counter(w for ws, x in own if x == s for w in ws if in_docs[w] >= min_docs) for _, s in own}
        share = lambda c, w: 1 + 1_000_000_000 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        whole = sum(groups.values(), Counter())
        for s, c in groups.items():
            pairs = [(sum(f(share(c, w), share(d, w)) for w in kept), x) for x, d in groups.items() if x != s]
            terms = [(f(share(c, w), share(whole, w)), w.decode()) for w in kept if c[w] and share(c, w) > share(whole, w)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, x, v, i + 1) for i, (v, x) in enumerate(items[:most])]
    return sorted(out)


def _documents():
    r = np.random.default_rng(5)
    vocabulary = [a + b for a in ("the", "é", "Zug", "日本", "x") for b in ("", "a", "Ö", "ly")] + ["rare%d" % i for i in range(30)]
    out = []
    for i in range(300):
        lang, source = ("en", "de", None)[i % 7 % 3], ("s1", None, "s2", "é", "z")[int(r.integers(0, 5)) if i % 2 else 0]
        words = r.choice(vocabulary, int(r.integers(0, 25)))
        out.append(("".join(f"{w}{'. -1@['[int(r.integers(0, 6))]}" for w in words), lang, source))
    return out + [(None, "en", "only null"), ("", "xx", "s1"), ("one", "xx", "s2"), (out[0][0], *out[0][1:]), ("the " * 50_000, "en", "long"), ("x", "alone", "s")]


@pytest.mark.parametrize("cells", [divergence.CELLS, 8])
def test_divergence_against_brute_force(spark, cells):
    # 8: several bands a language, and columns in pieces
    rows = _documents()
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, n int, term string").repartition(5)
    got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(docs, cells=cells).collect())
    assert got == _audit(rows, 10, 10)
    assert divergence.audit(docs.where("false")).count() == 0


def test_terms_with_equal_hashes_are_told_apart():
    texts = [b"Ab cd", b"ab", b"", b"cdx\xc3\x89y AB1ab"]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(rb"[a-z\x80-\xff]+", t.lower())]
    for h in (lambda b: 1, len, divergence.xxhash.xxh3_64_intdigest):
        got = divergence.tokens_of(data, offsets, h)
        assert [(d, got.terms[o]) for d, o in zip(got.doc.tolist(), got.of.tolist())] == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**15)), min_size=1, max_size=5))
def test_shares_are_exact(pairs):
    c, n = (np.array(x, np.int64) for x in zip(*((min(a, b), b + 2) for a, b in pairs)))
    assert divergence.shares(c, n).tolist() == [1 + 10**9 * (int(a) + 2) // int(b) for a, b in zip(c, n)]


# ---- fill-in-middle ----


def _cut(doc_id, text):
    text = text or ""
    h = [int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < 50 else "psm"
    return doc_id, n, form, len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"), sha(text)


def test_fill_in_middle_of_documents(spark, odd, odd_docs):
    assert sorted(map(repr, map(tuple, fim.digest(odd).collect()))) == sorted(repr(_cut(*d)) for d in odd_docs)
    rows = [(i, "ä\n" * (i % 9) + "<P" * (i % 2) + "\n\n日<" * (i % 5) + "<M>" * (i % 11 == 0)) for i in range(200)] + [(200, "line é\n" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert sorted(map(tuple, fim.digest(docs).collect())) == sorted(_cut(*d) for d in rows)
    assert fim.digest(docs.where("false")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a\n<PSM>é日\r\x85 ", max_size=40), st.integers(-(10**18), 10**18), st.sampled_from([0, 50, 100]))
def test_fill_in_middle_round_trip(text, doc_id, first):
    ends = fim.units_of(fim.LINES)(text)
    done = fim.cut(text, fim.draws(7, doc_id), ends, fim.Rates(100, first))
    assert [text[a:b] for a, b in zip([0, *ends], ends)] == re.findall(r"[^\n]*\n|[^\n]+", text)
    assert fim.restore(done.output, done.form) == text


def test_fill_in_middle_with_other_marks(spark, odd, odd_docs):
    for marks in (("<|a|>", "<|b|>", "<|c|>"), ("", "", "")):
        cuts = fim.fill_in_middle(odd, r"\s+", 3, fim.Rates(60, 10), marks)
        assert Counter((r.doc_id, r.restored) for r in fim.restored(cuts, marks).collect()) == Counter((d, t or "") for d, t in odd_docs)
        assert {"plain", "psm"} <= {r.form for r in cuts.collect()}
    for marks in (("", "b", "c"), ("aba", "c", "d"), ("ab", "abc", "d")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(odd, marks=marks)
