"""Block and allow rules for addresses, carried over to aliases.

A rule is a host and the beginning of a path. It fits that host and every subdomain, where the
path starts with the rule's; of several the longest (host and path together) wins. Addresses
are judged once each: the ends of the host and the beginnings of the path that rules can
have are looked up by equality, so the work does not grow with the number of rules.

Redirects and canonical links say that two addresses show one page. They are edges of a graph
whose connected components are the sets of aliases. A component with a blocked address, be it a
page of the table or only the target of a link, blocks all its addresses that no rule names. An
explicit allow rule has precedence: the address it fits stays allowed. It does not unblock its
aliases. What neither a rule nor an alias blocks is allowed.

Results for unusual input: a null address, or one without ``://``, has an empty host and path, no
rule and no aliases and is allowed; null html has no links, malformed html those that a tolerant
parser finds in it; a rule with a null host or path fits nothing, an empty path is the beginning of
every path; of equal rules with two verdicts the allow counts; repeated pages are judged as
often as they occur; empty tables of pages, rules or links are no special case; columns named
like a result column are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeep.llm.components import components
from goldkeep.operators.joins import attach
from goldkeep.shared import settle

ADDED = ("host", "path", "rule", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case."""
    host = F.regexp_extract(_behind_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Half of the SHA-256 of an address without its fragment, scheme and host in lower case.
    Null without ``://``."""
    head = F.regexp_extract(url, "^.*?://[^/?#]*", 0)
    rest = F.regexp_extract(F.substring(url, F.length(head) + 1, F.length(url)), "^[^#]*", 0)
    whole = F.concat(F.translate(head, UPPER, LOWER), rest)
    half = F.substring(F.sha2(whole.cast("binary"), 256), F.lit(1), F.lit(32))
    return F.when(F.instr(url, "://") > 0, F.unhex(half))


class _Links(HTMLParser):
    """Canonical links and refreshing redirects of one page, resolved against its address."""

    def __init__(self, url: str):
        super().__init__()
        self.base, self.found = url, []

    def handle_starttag(self, tag, attrs):
        if tag not in ("link", "meta", "base"):
            return
        of = {name: value or "" for name, value in reversed(attrs)}  # the first of a name counts
        if tag == "base" and of.get("href"):
            self.base = self.resolved(of["href"]) or self.base
        elif tag == "link" and "canonical" in of.get("rel", "").lower().split():
            self.found.append(self.resolved(of.get("href", "").strip()))
        elif tag == "meta" and of.get("http-equiv", "").strip().lower() == "refresh":
            to = of.get("content", "").partition(";")[2].strip()
            if to[:3].lower() == "url":
                to = to[3:].lstrip().removeprefix("=")
            self.found.append(self.resolved(to.strip().strip("'\"")))

    def resolved(self, link: str) -> str | None:
        try:
            return urljoin(self.base, link) if link else None
        except ValueError:  # no address at all
            return None


def _page_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sources, targets = [], []
        for row in range(batch.num_rows):  # one page at a time is held as text
            url = batch.column(0)[row].as_py()
            links = _Links(url)
            links.feed(batch.column(1)[row].as_py())
            links.close()
            found = [t.encode("utf-8", "replace").decode() for t in links.found if t and "://" in t]
            sources += [url] * len(found)
            targets += found
        yield pa.RecordBatch.from_pydict(
            {"source": pa.array(sources, pa.string()), "target": pa.array(targets, pa.string())}
        )


def page_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``source``, ``target``: the canonical links and refreshing redirects of all pages.

    Only pages that hold one of the two words at all are parsed.
    """
    rows = pages.select(F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    held = rows.where(F.col("html").rlike("(?i)canonical|refresh") & (F.instr("url", "://") > 0))
    return held.mapInArrow(_page_links, "source string, target string")


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url``, ``rule``, ``verdict`` of the distinct addresses ``urls`` that a rule fits.

    ``rules`` has ``host``, ``path`` and ``verdict``. Which numbers of host labels and path
    lengths occur in rules is bounded by the shape of addresses, not by the number of rules.
    """
    table = settle(
        rules.groupBy(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.min("verdict").alias("verdict"))  # allow comes before block
        .where("rule_host is not null and rule_path is not null")
    )
    labels = F.size(F.split("rule_host", "\\."))
    shapes = table.select(labels.alias("l"), F.length("rule_path").alias("p")).distinct().collect()
    if not shapes:
        none = F.lit(None).cast("string")
        return urls.select("url", none.alias("rule"), none.alias("verdict")).limit(0)
    parts = urls.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    cuts = [
        F.when(
            (F.size(F.split("h", "\\.")) >= s.l) & (F.length("p") >= s.p),
            F.struct(
                F.substring_index("h", ".", -s.l).alias("cut_host"),
                F.substring("p", 1, s.p).alias("cut_path"),
            ),
        )
        for s in shapes
    ]
    tried = parts.select("url", F.inline(F.array_compact(F.array(*cuts))))
    fits = attach(tried, table, {"cut_host": "rule_host", "cut_path": "rule_path"}, how="inner")
    rule = F.concat("cut_host", "cut_path")
    # of two of one length, one host more is the more exact one
    rank = F.struct(F.length(rule), F.length("cut_host"))
    return fits.groupBy("url").agg(
        F.max_by(F.struct(rule.alias("rule"), "verdict"), rank).alias("best")
    ).select("url", "best.*")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    links: DataFrame | None = None,
    url_column: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``links`` has ``source`` and ``target``, two addresses that show one page: what
    :func:`page_links` finds, a crawler's table of redirects, or both.
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c not in ADDED]
    if links is None:
        links = spark.createDataFrame([], "source string, target string")
    rows = pages.select(F.struct(*kept).alias("row"), F.col(url_column).alias("url"))
    nodes = links.select(node_of(F.col("source")).alias("u"), node_of(F.col("target")).alias("v"))
    linked = settle(links.select("source", "target"))
    alias = settle(components(nodes.where("u is not null and v is not null")))
    urls = (
        rows.select("url")
        .unionByName(linked.select(F.col("source").alias("url")))
        .unionByName(linked.select(F.col("target").alias("url")))
        .where("instr(url, '://') > 0")
        .distinct()
    )
    ruled = settle(fitting_rules(urls, rules))
    blocked = ruled.where("verdict = 'block'").select(node_of(F.col("url")).alias("node")).distinct()
    hit = attach(blocked, alias, {"node": "node"}, how="inner").select("component").distinct()
    aliases = settle(attach(alias, settle(hit), {"component": "component"}, how="inner").select("node"))
    found = attach(rows, ruled, {"url": "url"}).withColumn("at", node_of(F.col("url")))
    found = attach(found, aliases.withColumn("blocked", F.lit(True)), {"at": "node"})
    other = F.when(F.col("blocked"), "block").otherwise("allow")
    return found.select(
        "row.*",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", other).alias("verdict"),
    )
