"""URL filtering by rules, carried over redirects and canonical links.

A rule names a host and the start of a path and blocks or allows; the longest
rule that fits a URL decides. URLs that lead to one another form one class:
redirects and canonical links named in the pages, and spellings that differ
only in scheme, default port, fragment, tracking parameters or a closing
slash. The classes are the connected components of those edges. A block of one
member holds for the members that no rule names, unless a member is explicitly
allowed: allow goes before block, and a page's own rule before both.
DataFrame functions only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower
from .components import connected_components


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: list[Rule], host: Column, path: Column) -> Column:
    """Struct (name, allow) of the longest rule that fits, or null. ``rules``
    is a list that the caller writes down, so it is part of the expression."""
    found = F.lit(None).cast("struct<name:string,allow:boolean>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.allow).alias("allow"))).otherwise(found)
    return found


def node_of(url: Column) -> Column:
    """One spelling for URLs that servers take for the same page; null without ``://``."""
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    query = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^(utm_[a-z]+|gclid|fbclid)(=|$)") & (p != "")), "&")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


#: In attributes a name without its semicolon counts only if no ``=``, letter or digit follows.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;|[A-Za-z][A-Za-z0-9]*(?![=A-Za-z0-9;]))"


def unescaped(value: Column) -> Column:
    """An attribute's value with its character references decoded, each once."""
    names = F.from_json(F.lit(json.dumps({k.encode().hex().upper(): v for k, v in html5.items()})), "map<string,string>")

    def decoded(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"([0-9a-fA-F]+);?$", 1)
        code = F.when(ref.rlike("^&#[xX]"), F.conv(F.substring(digits, -7, 7), 16, 10)).otherwise(digits).try_cast("long")
        fits = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fits, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
        return F.when(ref.startswith("&#"), char).otherwise(F.coalesce(F.try_element_at(names, F.hex(F.substring(ref, 2, 64))), ref))

    return F.when(F.instr(value, "&") == 0, value).otherwise(F.array_join(F.zip_with(
        F.split(value, REFERENCE), F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0)),
        lambda text, ref: F.concat(text, F.when(ref.isNull(), F.lit("")).otherwise(decoded(ref)))), ""))


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, its ``.`` and ``..`` segments carried out."""
    parts = F.aggregate(
        F.split(F.substr(path, F.lit(2)), "/"), F.array().cast("array<string>"),
        lambda kept, x: F.when(x == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(x == ".", kept).otherwise(F.concat(kept, F.array(x))))
    last = F.when(path.rlike(r"/\.\.?$") & (F.size(parts) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(parts, "/"), last)


def resolved(target: Column, url: Column) -> Column:
    """``target`` as a whole URL, seen from the page at ``url``."""
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_replace(F.when(path_of(url) == "", "/").otherwise(path_of(url)), r"[^/]*$", "")
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (site == ""), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.startswith("/"), F.concat(site, without_dots(path), rest))
            .when(target.startswith("?"), F.concat(site, path_of(url), target))
            .when(target.startswith("#"), F.concat(F.regexp_extract(url, r"(?s)^([^#]*)", 1), target))
            .otherwise(F.concat(site, without_dots(F.concat(folder, path)), rest)))


def declared_links(pages: DataFrame) -> DataFrame:
    """(``url``, ``target``) of every canonical link and refresh redirect in
    ``html``; targets that aren't whole URLs are resolved against the page's
    ``base`` element, if it has one, and its own URL."""
    tags = lambda name, kind: F.regexp_extract_all(F.col("html"), F.lit(rf"(?i)<{name}\b[^>]*\b{kind}\b[^>]*>"), F.lit(0))
    link, meta = tags("link", r"rel\s*=\s*[\"']?canonical"), tags("meta", r"http-equiv\s*=\s*[\"']?refresh")
    href = lambda tag: F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    goal = lambda tag: F.regexp_extract(tag, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    base = F.regexp_extract(F.col("html"), r"(?i)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    # each step in a transform of its own: its result is named, not written out at every use
    said = F.transform(F.filter(F.concat(F.transform(link, href), F.transform(meta, goal)), lambda t: t != ""), unescaped)
    bases = F.transform(F.transform(F.array(base), unescaped), lambda b: F.when(b == "", F.col("url")).otherwise(resolved(b, F.col("url"))))
    targets = F.flatten(F.transform(bases, lambda b: F.transform(said, lambda t: resolved(t, b))))
    return pages.where("html is not null and url is not null").select("url", F.explode(targets).alias("target"))


def judge_urls(pages: DataFrame, rules: list[Rule], links: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``; ``html`` if links
    are to be read from it): page_id, host, path, rule, verdict.

    ``links`` (``url``, ``target``) are the redirect and canonical edges; by
    default those that the pages declare. Null URLs and URLs without ``://``
    have empty host and path, fit no rule and are allowed. Repeated rows get
    equal verdicts; an empty table gives no rows."""
    links = declared_links(pages) if links is None else links
    own = rule_for(rules, F.col("host"), F.col("path"))
    judged = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).select(
        "page_id", "host", "path", own.alias("own"), node_of(F.col("url")).alias("node"))

    classes = connected_components(links.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b")))
    ends = links.select(F.col("target").alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).select(
        node_of(F.col("url")).alias("node"), own.alias("own"))
    said = (judged.select("node", "own").union(ends).where("own is not null and node is not null")
            .groupBy("node").agg(F.max("own.allow").alias("allow"))
            .join(classes, "node", "left").groupBy(F.coalesce("component", "node").alias("class"))
            .agg(F.max("allow").alias("allow")).where("not allow").select("class", F.lit(True).alias("blocked")))

    ruled = judged.where("own is not null").select(
        "page_id", "host", "path", F.col("own.name").alias("rule"),
        F.when(F.col("own.allow"), "allow").otherwise("block").alias("verdict"))
    rest = judged.where("own is null").join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    aliases = rest.join(said, "class", "left").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("blocked"), "block").otherwise("allow").alias("verdict"))
    return ruled.union(aliases)
