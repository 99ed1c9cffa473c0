"""URL filter: block and allow rules, carried to the aliases of a page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import any_names, ascii_lower
from playlens.llm.components import connected_components

#: (verdict, host, path): fixed values of the query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_HREF = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def page_key(url: Column) -> Column:
    """What names a page: scheme, fragment, tracking parameters, a last slash and an ending ``.html`` or ``.htm`` don't."""
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)(=|$)"))), "&")
    return F.concat(host_of(url), F.regexp_replace(path_of(url), r"(?i)(/|\.html?)+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def absolute(link: Column, url: Column) -> Column:
    """``link`` as it is meant on the page ``url``."""
    scheme, base = F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(base, link))
        .when(folder.endswith("/"), F.concat(folder, link))
        .otherwise(F.concat(folder, F.lit("/"), link))
    )


def rule_at(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(verdict, rule) of the longest rule that fits the host or a domain above it and starts the path; else null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):  # the longest is asked first
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(domain + start).alias("rule"))).otherwise(out)
    return out


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): page keys joined by a canonical link or an immediate redirect in the page."""
    found = pages.where(F.col(html).rlike("(?i)canonical|refresh")).select(
        F.col(url).alias("u"), F.explode(F.array(F.regexp_extract(html, _HREF, 1), F.regexp_extract(html, _REFRESH, 1))).alias("l")
    )
    return found.where("l <> '' and u is not null").select(page_key(F.col("u")).alias("a"), page_key(absolute(F.col("l"), F.col("u"))).alias("b")).where("a <> b")


@any_names
def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url", html: str | None = "html") -> DataFrame:
    """``pages`` with host, path, rule and verdict (added or replaced).

    Pages are aliases of each other if they have one page key, or if canonical links and redirects lead from one key
    to the other, in any number of steps (distributed connected components). A page with a rule of its own has that
    rule's verdict. Any other is allowed if an alias is explicitly allowed, else blocked if an alias is blocked, else
    allowed. A link may lead to a page that isn't in the table; its own URL then still counts with its rule.

    Null or scheme-less urls have an empty host and path, no alias and no rule, and are allowed. Repeated rows are
    judged alike; null html holds no links. ``rules`` is a small list in the plan; a page costs one comparison a rule.
    """
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    u = F.col(url)
    work = pages.select(*keep, host_of(u).alias("host"), path_of(u).alias("path"), F.when(u.contains("://"), page_key(u)).alias("__key"))
    work = work.withColumn("__own", rule_at(F.col("host"), F.col("path"), rules))
    named = pages.where(u.contains("://")).select(page_key(u).alias("node"), rule_at(host_of(u), path_of(u), rules)["verdict"].alias("v"))
    if html is not None and html in pages.columns:
        edges = link_edges(pages, url, html)
        roots = connected_components(edges)
        # a link's target takes part by its key, whether or not it is a row
        at = F.concat(F.lit("http://"), F.col("node"))
        named = named.unionAll(roots.select("node", rule_at(host_of(at), path_of(at), rules)["verdict"].alias("v")))
        named = _by_key(named).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        verdicts = _spread(named)
    else:
        verdicts = _by_key(named)
    verdicts = verdicts.select(F.col("node").alias("__node"), F.when(F.col("allow"), "allow").when(F.col("block"), "block").otherwise("allow").alias("__alias"))
    out = work.join(verdicts, F.col("__key") == F.col("__node"), "left")
    return out.select(*keep, "host", "path", F.col("__own.rule").alias("rule"), F.coalesce("__own.verdict", "__alias", F.lit("allow")).alias("verdict"))


def _by_key(named: DataFrame) -> DataFrame:
    return named.groupBy("node").agg(F.coalesce(F.max(F.col("v") == "allow"), F.lit(False)).alias("allow"), F.coalesce(F.max(F.col("v") == "block"), F.lit(False)).alias("block"))


def _spread(named: DataFrame) -> DataFrame:
    """Each component's verdicts on all its keys. Components of one key are their own sum."""
    total = named.groupBy("root").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    return named.select("node", "root").join(total, "root").select("node", "allow", "block")
