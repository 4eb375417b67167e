r"""URL filters whose block decisions reach a page's aliases.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with its own; the longest rule
that fits decides, an allow rule among equally long ones. Redirects and canonical links tie addresses together: the
classes of their graph are found by distributed connected components (large and small stars), and a block decision of any
address of a class reaches all others that no rule speaks of. A url's own rule comes first, so an allow rule keeps its page
whatever the class says. Without rule and blocked class a page is allowed.

An address is host, path and query of a url; its scheme and fragment make no difference. Edges are a page's canonical link
(the first `<link rel=canonical>`), its refresh (the first `<meta http-equiv=refresh>`) and rows of `redirects`; a relative target
is taken from the page's host and folder, other schemes and pages without `://` give no edge. Only the ends of edges are
shuffled, as 64-bit hashes, and pages meet blocked addresses in a left join whose hot addresses Spark splits.

Defined results: a null url, or one without `://`, has an empty host and path, no rule and is allowed; null html has no
links; repeated rows are judged one by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let_go, only, operator, written
from .near_dup import components

Rule = tuple[str, str, str]
#: What a list of rules may hold; about 300 bytes each in a worker.
MOST_RULES = 1_000_000

_PARTS = r"://([^/?#]*)([^?#]*)(\?[^#]*)?"
_TAG = r"(?i)<{}\b[^>]*>"
_CANONICAL = r"""(?i)\brel\s*=\s*["']?canonical\b"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
_HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TARGET = r"""(?i)\bcontent\s*=\s*(?:"[^"]*?url\s*=\s*'?([^"']*)|'[^']*?url\s*=\s*([^']*))"""


class Rules:
    """Rules by host, then by path."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, dict[str, str]] = defaultdict(dict)
        for host, path, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"a verdict is allow or block, not {verdict}")
            own = self.by_host[host.translate(_LOWER)]
            own[path] = min(verdict, own.get(path, verdict))  # allow comes first
        self.lengths = {h: sorted({len(p) for p in paths}, reverse=True) for h, paths in self.by_host.items()}

    def of(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits, and its verdict."""
        best = None
        at = 0
        while host and at >= 0:
            own = host[at:]
            for n in self.lengths.get(own, ()):
                if verdict := self.by_host[own].get(path[:n]) if n <= len(path) else None:
                    found = (len(own) + n, verdict == "allow", own + path[:n], verdict)
                    best = found if best is None or found[:2] > best[:2] else best
                    break
            at = host.find(".", at) + 1 or -1
        return best and best[2:]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def address_of(url: Column) -> Column:
    """Host, path and query, a missing path being /; null without `://`."""
    path = path_of(url)
    whole = F.concat(host_of(url), F.when(path == "", "/").otherwise(path), F.regexp_extract(url, _PARTS, 3))
    return F.when(url.contains("://"), whole)


def _first(html: Column, tag: str, kind: str, value: str, groups: int) -> Column:
    """The value of the first tag of a kind; null if there is none."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(_TAG.format(tag)), F.lit(0)), lambda t: t.rlike(kind))
    own = F.try_element_at(tags, F.lit(1))
    found = F.concat(*(F.regexp_extract(own, value, i) for i in range(1, groups + 1)))
    return F.nullif(F.trim(F.replace(found, F.lit("&amp;"), F.lit("&"))), F.lit(""))


def canonical_link(html: Column) -> Column:
    return _first(html, "link", _CANONICAL, _HREF, 3)


def refresh_target(html: Column) -> Column:
    return _first(html, "meta", _REFRESH, _TARGET, 2)


def absolute(url: Column, link: Column) -> Column:
    """link as seen from url; null if it has another scheme."""
    top = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)[^/]*$", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(top, link))
        .when(link.startswith("#") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when(link.startswith("?"), F.concat(top, path_of(url), link))
        .otherwise(F.concat(top, F.when(folder == "", "/").otherwise(folder), link))
    )


def _judge(shared, at: int):
    """Appends rule and own verdict to rows that have host and path at two places."""

    def step(batches):
        only()
        rules = shared.value
        for batch in batches:
            found = [rules.of(h, p) or (None, None) for h, p in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist())]
            yield batch.append_column("rule", pa.array([x[0] for x in found], pa.string())).append_column("own", pa.array([x[1] for x in found], pa.string()))

    return step


def links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(source, target) urls of all edges; redirects: source, target."""
    here = F.col("url").contains("://")
    found = pages.where(here).select("url", F.explode(F.array(canonical_link(F.col("html")), refresh_target(F.col("html")))).alias("link")).where("link is not null")
    out = found.select(F.col("url").alias("source"), absolute(F.col("url"), F.col("link")).alias("target"))
    if redirects is not None:
        out = out.unionByName(redirects.select("source", absolute(F.col("source"), F.col("target")).alias("target")))
    return out.where(F.col("source").contains("://") & F.col("target").contains("://"))


def _key(url: Column) -> Column:
    return F.xxhash64(address_of(url))


def blocked_addresses(edges: DataFrame, shared) -> tuple[DataFrame, list]:
    """Keys of the addresses of classes with a blocked one; and the tables that can go afterwards."""
    one = edges.select(F.posexplode(F.array("source", "target")).alias("side", "url"), _key(F.col("source")).alias("a"), _key(F.col("target")).alias("b"))
    ends = one.select("a", "b", "side", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ends = ends.mapInArrow(_judge(shared, 3), "a long, b long, side int, host string, path string, rule string, own string")
    ends = written(ends.select("a", "b", F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")).alias("key"), (F.col("own") == "block").alias("bad"), "side"), "ends")
    labels = written(components(ends.where("side = 0 and a <> b").select("a", "b")), "classes")
    bad = ends.where("bad").select("key").distinct().join(labels.withColumnRenamed("id", "key"), "key").select("label").distinct()
    return labels.join(bad, "label", "left_semi").select(F.col("id").alias("key")), [ends, labels]


@operator
def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page (page_id, url, html), and whether its class decided."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    shared = pages.sparkSession.sparkContext.broadcast(Rules(rules))
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.when(url.contains("://"), _key(url)).alias("key"))
    rows = rows.mapInArrow(_judge(shared, 1), "page_id long, host string, path string, key long, rule string, own string")
    edges = written(links(pages, redirects).distinct(), "links")
    if edges.isEmpty():
        let_go(edges)
        return rows.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"), F.lit(False).alias("by_alias"))
    keys, temporary = blocked_addresses(edges, shared)
    blocked = written(keys.distinct(), "blocked")
    let_go(edges, *temporary)
    silent = F.col("own").isNull()
    met = rows.join(blocked.select(F.col("key").alias("bad")), silent & (F.col("key") == F.col("bad")), "left")
    return met.select("page_id", "host", "path", "rule", F.coalesce("own", F.when(F.col("bad").isNotNull(), "block").otherwise("allow")).alias("verdict"), (silent & F.col("bad").isNotNull()).alias("by_alias"))


#: The rules of the registered query.
RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def digest(pages: DataFrame) -> DataFrame:
    return judge(pages, RULES)
