"""URL filters with redirect equivalence.

Rules allow or block a host, its subdomains and a path prefix; the longest that fits decides. Pages without a rule take
what their aliases say: redirect and canonical-link edges between URLs are joined into components, and a block decision
anywhere in a component reaches every alias in it that no rule allows explicitly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected_components

#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_AFTER = r"^[\s\S]*?://"
#: A tag that may lead elsewhere; quoted values may hold `<` and `>`. What is not quoted ends at the next `<`, so that no part
#: of a page is read once more for each tag that is never closed.
_TAG = r"""(?is)<(?:link|meta|base)\b(?:(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>|[^<>]*>)"""
_REFRESH = re.compile(r"""\s*[\d.]*\s*[;,]?\s*url\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'].*))""", re.I | re.S)


def lower_ascii(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty for null or without `://`."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, _AFTER + r"([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, _AFTER + r"[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """Names a URL among its aliases: host, path and query, without scheme and fragment; null without a host."""
    query = F.regexp_extract(url, _AFTER + r"[^/?#]*[^?#]*(\?[^#]*)?", 1)
    return F.when(host(url) != "", F.concat(host(url), path(url), query))


def rule_columns(host_: Column, path_: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (its text; ties: the first by code point) and its verdict; null if none."""
    name = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host_ == rule_host) | host_.endswith("." + rule_host)) & path_.startswith(rule_path)
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


class _Links(HTMLParser):
    """Targets of canonical links and refreshes, and the page's base, as they stand in its tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.base: str | None = None
        self.found: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own = {k: v or "" for k, v in reversed(attrs)}  # of repeated attributes the first counts
        if tag == "base" and "href" in own and self.base is None:
            self.base = own["href"].strip()
        elif tag == "link" and "canonical" in own.get("rel", "").lower().split() and own.get("href", "").strip():
            self.found.append(own["href"].strip())
        elif tag == "meta" and own.get("http-equiv", "").strip().lower() == "refresh" and (to := _REFRESH.match(own.get("content", ""))):
            self.found.append((to[1] or to[2] or to[3] or "").strip())

    handle_startendtag = handle_starttag


def link_targets(url: str, tags: Sequence[str]) -> list[str]:
    """Absolute targets of a page's tags; a target that cannot be resolved is no link."""
    links = _Links()
    for tag in tags:
        links.feed(tag)
        links.reset()
    out = []
    for to in links.found:
        try:
            # names leave the scheme out, and only known schemes resolve relative targets
            here = urljoin("http://" + url.split("://", 1)[1], links.base or "")
            out.append(to if "://" in to.split("?")[0] else urljoin(here, to))
        except (ValueError, IndexError):
            continue
    return out


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b) nodes: a page and where its canonical link or meta refresh leads. Relative targets are resolved against the
    page's base or url, entities are decoded, and `rel` may hold other words too."""

    def resolve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pairs = [(u, to) for u, tags in zip(pdf["u"], pdf["tags"], strict=True) for to in link_targets(u, tags)]
            yield pd.DataFrame(pairs, columns=["u", "to"])

    linked = pages.select(F.col(url).alias("u"), F.col(html).alias("h")).where(F.col("u").contains("://") & F.col("h").rlike(r"(?i)canonical|refresh"))
    # only the few short tags go to Python, never the page
    tags = linked.select("u", F.filter(F.regexp_extract_all("h", F.lit(_TAG), F.lit(0)), lambda t: t.rlike(r"(?i)canonical|refresh|^<base")).alias("tags"))
    goal = tags.where(F.exists("tags", lambda t: t.rlike("(?i)canonical|refresh"))).mapInPandas(resolve, "u string, to string")
    return goal.select(node(F.col("u")).alias("a"), node(F.col("to")).alias("b")).where("a is not null and b is not null and a <> b").distinct()


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", default: str = "allow") -> DataFrame:
    """A row for each page: page_id, host, path, rule, verdict, alias_of (its component's first node, or null).

    `redirects`: more edges, (from_url, to_url). A page no rule fits is blocked if an alias is, else `default`. Null URLs
    and those without `://` have empty host and path, fit no rule and have no alias. Null html has no links. Repeated rows
    are judged alike; an empty table gives no rows. Aliases that are no page themselves count too.
    """
    u = F.col("__url")
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("__url"))
    base = base.select("page_id", host(u).alias("host"), path(u).alias("path"), node(u).alias("__node"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "__own": verdict})
    edges = page_edges(pages, url, html)
    if redirects is not None:
        more = redirects.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b"))
        edges = edges.union(more.where("a is not null and b is not null and a <> b")).distinct()
    groups = connected_components(common.cut(edges))
    # nodes carry host and path themselves, so aliases outside of `pages` are judged by their names
    as_url = F.concat(F.lit("x://"), "node")
    _, said = rule_columns(host(as_url), path(as_url), rules)
    blocked = groups.groupBy("root").agg(F.max(F.when(said == "block", 1).otherwise(0)).alias("__block"))
    marks = common.cut(groups.join(blocked, "root").select(F.col("node").alias("__node"), F.col("root").alias("alias_of"), "__block"))
    out = base.join(common.broadcast_if_small(marks), "__node", "left")
    method = F.when(F.col("__block") == 1, F.lit("block")).otherwise(F.lit(default))
    return out.select("page_id", "host", "path", "rule", F.coalesce("__own", method).alias("verdict"), "alias_of")
