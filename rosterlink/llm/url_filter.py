"""URL block and allow rules, carried over redirects and canonical links by connected components.

A rule is a host and a path: it fits that host and all its subdomains where the url's path starts with the rule's; the
longest fitting rule decides. A page that no rule fits takes the block of any page it is equivalent to: redirects and
canonical links are edges between urls, and a component of them is one place. An explicit allow of a page's own rule
always stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlink.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VALUE = r"\s*=\s*[\"']?"
#: A canonical link or a refresh redirect, its attributes in either order; the first group is the address.
PATTERNS = (
    rf"(?is)<link\b[^>]*\brel{_VALUE}canonical\b[^>]*\bhref{_VALUE}([^\"'\s>]+)",
    rf"(?is)<link\b[^>]*\bhref{_VALUE}([^\"'\s>]+)[^>]*\brel{_VALUE}canonical\b",
    rf"(?is)<meta\b[^>]*\bhttp-equiv{_VALUE}refresh\b[^>]*\bcontent{_VALUE}[^\"'>]*?url\s*=\s*([^\"'\s>]+)",
    rf"(?is)<meta\b[^>]*\bcontent{_VALUE}[^\"'>]*?url\s*=\s*([^\"'\s>]+)[^>]*\bhttp-equiv{_VALUE}refresh\b",
)
#: What a page doesn't show, and how an address spells '&'.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>"
AMPERSANDS = ("&amp;", "&#38;", "&#x26;")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """The key of a url among aliases: lower-cased host, path and query, without scheme and fragment; null without a host."""
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^#]*?(\?[^#]*)", 1), F.lit(""))
    return F.when(url_host(url) != "", F.sha1(F.concat(url_host(url), url_path(url), query)))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest fitting rule (ties: the first in text order), null without one.

    ``rules`` are (verdict, host, path); a small list of a policy, built into the expression.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):
        at = h.translate(str.maketrans(UPPER, LOWER))
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def declared_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges ``(src, dst)`` between urls that pages declare: canonical links and refresh redirects, also relative ones.

    Comments, scripts, styles and templates declare nothing; '&' in an address may be spelled as an entity.
    """
    html, url = F.coalesce(html_col, F.lit("")), F.col(url_col)
    shown = F.regexp_replace(html, HIDDEN, " ")
    none = F.array().cast("array<string>")
    all_of = F.concat(*(F.regexp_extract_all(shown, F.lit(p), F.lit(1)) for p in PATTERNS))
    found = F.when(html.rlike("(?i)canonical|http-equiv"), F.array_distinct(all_of)).otherwise(none)
    to = pages.select(url.alias("src"), F.explode(found).alias("to")).where("to <> ''")
    for a in AMPERSANDS:
        to = to.withColumn("to", F.replace("to", F.lit(a), F.lit("&")))
    root = F.regexp_extract("src", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("src", r"(?s)^(.*?://[^?#]*/)[^/]*$", 1)
    scheme = F.regexp_extract("src", r"(?s)^(.*?:)//", 1)
    full = (
        F.when(F.col("to").contains("://"), F.col("to")).when(F.col("to").startswith("//"), F.concat(scheme, "to"))
        .when(F.col("to").startswith("/"), F.concat(root, "to")).otherwise(F.concat(F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder), "to"))
    )
    return to.select("src", full.alias("dst"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", default: str = "allow") -> DataFrame:
    """Rows ``(id_col, host, path, rule, verdict, component_blocked)``, one for each row of ``pages``.

    ``redirects`` (src, dst) adds edges to those that the pages declare. A page with a rule has that rule's verdict. One
    without has ``block`` if its component holds a page with a block rule, else ``default``. Urls without ``://`` and
    null urls have an empty host and path, no rule and no aliases. Repeated rows give repeated results; an empty table
    gives none; other columns are not read. A very long page is searched whole; only its few addresses move. A component
    of any size is one row a url, in the rounds of ``connected_components``.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.select("id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), url_node(F.col("url")).alias("node"))
    rows = rows.withColumn("hit", fitting_rule(F.col("host"), F.col("path"), rules))
    edges = [redirects.select("src", "dst")] if redirects is not None else []
    if html_col:
        edges.append(declared_edges(pages, url_col, html_col))
    if not edges:
        edges.append(pages.sparkSession.createDataFrame([], "src string, dst string"))
    links = edges[0] if len(edges) == 1 else edges[0].unionByName(edges[1])
    links = links.select(url_node(F.col("src")).alias("a"), url_node(F.col("dst")).alias("b"), F.struct(url_host(F.col("dst")).alias("host"), url_path(F.col("dst")).alias("path")).alias("d"))
    comp = connected_components(links, "a", "b")
    # rules also fit redirect targets that are not pages themselves
    targets = links.where("b is not null").select(F.col("b").alias("node"), fitting_rule(F.col("d.host"), F.col("d.path"), rules)["verdict"].alias("verdict"))
    judged = rows.where("node is not null").select("node", F.col("hit.verdict").alias("verdict")).unionByName(targets).where("verdict = 'block'").select("node").distinct()
    blocked = comp.join(judged, "node", "left_semi").select("component").distinct()
    aliases = comp.join(blocked, "component", "left_semi").select("node", F.lit(True).alias("blocked"))
    out = rows.join(aliases, "node", "left")
    verdict = F.when(F.col("hit").isNotNull(), F.col("hit.verdict")).when(F.col("blocked"), F.lit("block")).otherwise(F.lit(default))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), F.coalesce("blocked", F.lit(False)).alias("component_blocked"))


#: The rules of the registered query.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
