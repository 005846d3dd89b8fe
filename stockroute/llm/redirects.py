"""URL filters with redirect equivalence.

A rule is (action, "host/path"): it fits its host and all subdomains if the
path starts with the rule's; the longest fitting rule decides.  Urls that
redirect to each other or name each other as canonical are aliases: connected
components over those edges carry a block to every alias that no rule of its
own allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroute.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
META_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
META_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as struct(rule, action), or null.

    Longest: by host, then by path; of rules with one host and path the first in the
    list decides (others of equal length can't fit the same url).  The rules travel in the plan, so a list of
    thousands is meant, not of millions.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1].split("/", 1)[0]), -len(r[1])))
    fits = []
    for action, rule in ordered:
        rhost, rpath = rule.split("/", 1)
        fits.append(F.when(((host == rhost) | host.endswith("." + rhost)) & path.startswith("/" + rpath),
                           F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,action:string>")


def _absolute(base_host: Column, base_path: Column, target: Column) -> tuple[Column, Column]:
    full = (F.when(target.contains("://"), target)
            .when(target.startswith("//"), F.concat(F.lit("x:"), target)))
    host = F.when(full.isNotNull(), host_of(full)).otherwise(base_host)
    here = F.regexp_extract(base_path, r"(?s)^(.*/)", 1)
    bare = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    path = (F.when(full.isNotNull(), path_of(full)).when(target.startswith("/"), bare)
            .when(bare == "", base_path).otherwise(F.concat(here, bare)))
    return host, path


def page_links(pages: DataFrame) -> DataFrame:
    """(u, v): each page's host and path with those its canonical link or refresh names.

    Queries and fragments are no part of a node, as they are none of a rule: pages that
    differ only after ``?`` are one node.
    """
    p = pages.select(host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"), pages["html"])
    p = p.where((F.col("host") != "") & F.col("html").rlike("(?i)canonical|refresh"))
    named = F.filter(F.array(
        F.regexp_extract(F.regexp_extract("html", LINK_TAG, 0), HREF, 1),
        F.regexp_extract(F.regexp_extract("html", META_TAG, 0), META_URL, 1)), lambda t: t != "")
    p = p.select("host", "path", F.explode(named).alias("target"))
    host, path = _absolute(F.col("host"), F.col("path"), F.col("target"))
    return (p.select(F.concat("host", F.lit("\n"), "path").alias("u"),
                     F.concat(host, F.lit("\n"), path).alias("v"))
            .where((F.col("u") != F.col("v")) & ~F.col("v").startswith("\n")))


def judge(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, via for every page.

    ``redirects`` may add edges (u, v) of "host\\npath" nodes, as from a crawl
    log.  A page with a fitting rule gets the rule's action; any other is
    blocked if a url of its component is blocked by a rule, and allowed
    otherwise.  Null urls and urls without ``://`` have an empty host and path,
    fit no rule, alias nothing and are allowed; repeated rows are judged alike;
    null html names no link.
    """
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("u", "v"))
    alias = components(edges, "redirects")
    at = F.split("node", "\n")
    banned = (alias.select("node", "component", matched_rule(at[0], at[1], rules).alias("m"))
              .where(F.col("m.action") == "block").select("component").distinct())
    banned = alias.join(banned, "component").select(F.col("node").alias("b_node"))
    p = pages.select(pages["page_id"], host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    p = p.withColumn("m", matched_rule(F.col("host"), F.col("path"), rules))
    p = p.join(banned, F.concat("host", F.lit("\n"), "path") == F.col("b_node"), "left")
    return p.select(
        "page_id", "host", "path", F.col("m.rule").alias("rule"),
        F.when(F.col("m").isNotNull(), F.col("m.action"))
        .when(F.col("b_node").isNotNull(), "block").otherwise("allow").alias("verdict"),
        F.when(F.col("m").isNotNull(), "rule")
        .when(F.col("b_node").isNotNull(), "alias").otherwise("none").alias("via"))
