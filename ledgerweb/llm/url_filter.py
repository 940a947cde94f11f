"""Allow and block rules for urls, with block decisions carried to aliases.

Two urls are aliases if a redirect or a canonical link leads from one to the other, directly or over others: they lie
in one component of the graph of those links. A url that a rule fits is judged by the rule, an explicit allow
included. A url without a rule is blocked if any alias of it is blocked by a rule, and allowed otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm.common import ROW, keyed, stored
from ledgerweb.llm.connected import roots

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`text` is a host and the start of a path, as `example.org/es/`; the host's subdomains are meant too."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
         Rule("allow", "com/fr/"), Rule("block", "com/de/"))


def host_of(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end, A-Z lowered; empty without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls. Rules are configuration: a few hundred at most.

    Of rules with equally long texts the one that sorts first is taken.
    """
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict), reverse=True):
        # Later ones are asked first.
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def without_dots(url: Column) -> Column:
    """A whole url whose path has lost its segments `.` and `..` (RFC 3986, 5.2.4); any other text stays as it is."""
    def removed(whole: Column) -> Column:
        head, path = F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1), path_of(whole)
        segments = F.split(path, "/", -1)
        open_end = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        kept = F.aggregate(
            F.slice(segments, 2, F.size(segments)), F.array().cast("array<string>"),
            lambda before, segment: F.when(segment == ".", before)
            .when(segment == "..", F.slice(before, 1, F.greatest(F.size(before) - 1, F.lit(0))))
            .otherwise(F.concat(before, F.array(segment))))
        rest = F.substr(whole, F.char_length(head) + F.char_length(path) + 1)
        return F.when(path.rlike(r"/\.\.?(?:/|\z)"), F.concat(head, F.lit("/"), F.array_join(F.concat(kept, open_end), "/"), rest)).otherwise(whole)

    # The one-element array names the url, which would otherwise be worked out again at each place it is used.
    return F.when(F.contains(url, F.lit("/.")), F.transform(F.array(url), removed)[0]).otherwise(url)


def node_of(url: Column) -> Column:
    """A url's name in the graph: without fragment and dot segments, scheme and host lowered."""
    plain = without_dots(F.regexp_replace(url, r"(?s)#.*$", ""))
    head = F.regexp_extract(plain, r"(?s)^(.*?://[^/?#]*)", 1)
    return F.concat(F.translate(head, UPPER, LOWER), F.substr(plain, F.char_length(head) + 1))


def resolved(base: Column, target: Column) -> Column:
    """A link's target as a whole url without dot segments, seen from the page it stands on."""
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return without_dots(
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), target))
        .when(F.startswith(target, F.lit("/")), F.concat(origin, target))
        .when(F.startswith(target, F.lit("?")), F.concat(F.regexp_extract(base, r"(?s)^(.*?://[^?#]*)", 1), target))
        .otherwise(F.concat(F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/"))), target))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """`url, target`: canonical links and redirects (`http-equiv="refresh"`) that the pages of `pages(url, html)` declare."""
    def value(name: str) -> Column:
        pattern = rf"""(?is)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
        return F.concat(*[F.regexp_extract("tag", pattern, i) for i in (1, 2, 3)])

    tag = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)(<link\s[^>]*canonical[^>]*>|<meta\s[^>]*refresh[^>]*>)"), 1)).alias("tag")
    # Stored between the steps: few rows, and expressions that would be repeated many times in one.
    tags = stored(pages.filter(F.col("url").contains("://")).select("url", tag), "tags")
    refresh = F.regexp_extract(value("content"), r"""(?is)^[\s0-9.]*[;,]?\s*url\s*=\s*["']?([^"']*)""", 1)
    target = (
        F.when(F.lower(value("rel")).rlike(r"(^|\s)canonical(\s|$)"), value("href"))
        .when(F.lower(F.trim(value("http-equiv"))) == "refresh", refresh))
    found = stored(
        tags.select("url", F.trim(F.regexp_replace(target, "&amp;", "&")).alias("target")).filter(F.length("target") > 0), "targets")
    return found.select("url", resolved(F.col("url"), F.col("target")).alias("target"))


def aliases(links: DataFrame) -> DataFrame:
    """`node, group` for all urls of `links(url, target)`; equal groups are aliases. Nodes are urls without fragment and dot segments."""
    edges = stored(
        links.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))
        .filter("a is not null and b is not null and a != b").distinct(), "edges")
    names = stored(
        edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("id", F.monotonically_increasing_id()), "names")
    numbered = (
        edges.join(names.select(F.col("node").alias("a"), F.col("id").alias("ia")), "a")
        .join(names.select(F.col("node").alias("b"), F.col("id").alias("ib")), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    )
    root = roots(numbered).withColumnRenamed("node", "id")
    return stored(names.join(root, "id", "left").select("node", F.coalesce("root", "id").alias("group")), "aliases")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """The row's key, `page_id, host, path, rule, verdict` for every row of `pages(page_id, url, html)`.

    Links are those the pages declare, and `redirects(url, target)` if given. Block decisions of rules reach all aliases that no rule
    fits, also over urls that are no page; an explicit allow stands, and isn't carried on. A null url, or one without `://`,
    has empty host and path, no aliases and the verdict allow, unless a rule fits. Repeated rows and urls are judged
    each. Null html declares no links. Other columns are ignored; no pages give no rows.
    """
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    known = aliases(links)
    node = F.col("node")
    _, verdict = judged(host_of(node), path_of(node), rules)
    # One row for each group that a rule blocks somewhere.
    blocked = known.filter(verdict == "block").select("group").distinct()
    carried = stored(known.join(blocked, "group", "left_semi").select("node"), "carried")
    url = F.col("url")
    rule, verdict = judged(host_of(url), path_of(url), rules)
    rows = keyed(pages, F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                 rule.alias("rule"), verdict.alias("own"), node_of(url).alias("node"))
    return rows.join(carried.withColumn("reached", F.lit(True)), "node", "left").select(
        *ROW, "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(F.col("reached"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
