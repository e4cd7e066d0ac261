"""URL filter with redirect equivalence.

Rules judge a URL by host suffix and path prefix.  Pages without a rule of their own take
the decision of their aliases: redirects and canonical links are edges between URLs, the
connected components of that graph are the aliases of one resource, and a block of any
member reaches the others unless a member is explicitly allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import connected_components, given_back, kept, stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# -- fixed values: the markup of canonical links and of client-side redirects, and the entities that stand in URLs.
LINK_TAG = r"(?is)<link\b[^>]*>"
META_TAG = r"(?is)<meta\b[^>]*>"
IS_CANONICAL = r"(?is)\brel\s*=\s*(?:\"[^\"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"
IS_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
CONTENT = r"(?is)\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
TARGET = r"(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*[\"']?([^\"']*)"
ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"),
            ("&#x26;", "&"), ("&amp;", "&"))


@dataclass(frozen=True)
class Rule:
    """``target`` is host and path in one, like ``example.org/en/``; the host is lower case."""

    verdict: str  # allow or block
    target: str

    @property
    def host(self) -> str:
        return self.target.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.target[len(self.host):]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(target, verdict) of the longest fitting rule, both null when none fits."""
    target, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.target), r.target)):  # later, longer rules go outside
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        target = F.when(fits, F.lit(r.target)).otherwise(target)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return target, verdict


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments carried out; what does not begin with ``/`` gets one in front."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    last = F.element_at(parts, -1)
    none = F.array().cast("array<string>")
    kept = F.aggregate(parts, none, lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
                       .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    tail = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), tail)


def normal_url(url: Column) -> Column:
    """Scheme and host lower-cased, dot segments carried out, fragment dropped: the node of a URL; null without ``://``."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host_of(url), without_dots(path_of(url)), query))


def resolve(base: Column, link: Column) -> Column:
    """A link as an absolute URL: whole, scheme-relative, host-relative, a query of the base, or beside the base."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(site, link))
            .when(F.startswith(link, F.lit("?")), F.concat(site, path_of(base), link))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def _value(tag: Column, pattern: str) -> Column:
    """Value of an attribute, whichever way it is quoted; empty without it."""
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def page_edges(pages: DataFrame) -> DataFrame:
    """(source, target): all client-side redirects and canonical links found in the html.  Links to a fragment of
    the page itself, and schemes without ``://`` (like mailto), are none."""
    canonical = F.transform(F.filter(F.regexp_extract_all("html", F.lit(LINK_TAG), F.lit(0)), lambda t: t.rlike(IS_CANONICAL)),
                            lambda t: _value(t, HREF))
    refresh = F.transform(F.filter(F.regexp_extract_all("html", F.lit(META_TAG), F.lit(0)), lambda t: t.rlike(IS_REFRESH)),
                          lambda t: F.regexp_extract(_value(t, CONTENT), TARGET, 1))
    link = F.col("link")
    for entity, char in ENTITIES:
        link = F.replace(link, F.lit(entity), F.lit(char))
    found = (pages.where(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)<(link|meta)\b"))
             .select(F.col("url").alias("source"), F.explode(F.concat(canonical, refresh)).alias("link"))
             .select("source", F.btrim(link).alias("link")))
    own = F.startswith(F.col("link"), F.lit("#")) | F.col("link").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:(?!//)")
    return found.where((F.col("link") != "") & ~own).select("source", resolve(F.col("source"), F.col("link")).alias("target"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` (url, html) plus host, path, rule, verdict and reason (rule, alias or default).

    ``redirects`` (source, target) adds recorded server redirects to the links in the html.
    A page's own rule always stands.  Without one, its component decides: allow when a
    member is explicitly allowed, else block when a member is blocked, else allow.
    Rules are a bounded list compiled into one expression.  Null urls, and urls without
    ``://``, have empty host and path, fit no rule, have no aliases and are allowed; null
    html has no links; repeated pages are judged alike; columns of ``pages`` with a result's
    name are replaced, others pass through; no pages give no rows.
    """
    results = ("host", "path", "rule", "verdict", "reason")
    target, own = fitting_rule(rules, F.col("host"), F.col("path"))
    judged = (pages.select(kept(pages, *results).alias("row"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                           F.xxhash64(normal_url(F.col("url"))).alias("node"))
              .withColumn("rule", target).withColumn("own", own))
    links = page_edges(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    edges = stage(links.select(normal_url(F.col("source")).alias("source"), normal_url(F.col("target")).alias("target"))
                  .where("source is not null and target is not null and source != target").distinct(), "url-edges")
    keyed = edges.select(F.xxhash64("source").alias("a"), F.xxhash64("target").alias("b"))
    component = connected_components(keyed, "a", "b")
    urls = (edges.select(F.col("source").alias("url")).unionByName(edges.select(F.col("target").alias("url")))
            .distinct())
    decisions = urls.select(F.xxhash64("url").alias("node"),
                            fitting_rule(rules, host_of(F.col("url")), path_of(F.col("url")))[1].alias("own"))
    groups = (component.join(decisions, "node").groupBy("component")
              .agg(F.max((F.col("own") == "allow").cast("int")).alias("allow"),
                   F.max((F.col("own") == "block").cast("int")).alias("block")))
    alias = component.join(groups, "component").select("node", "allow", "block")
    by_alias = F.when(F.col("allow") == 1, F.lit("allow")).when(F.col("block") == 1, F.lit("block"))
    told = (judged.join(alias, "node", "left")
            .withColumn("verdict", F.coalesce("own", by_alias, F.lit("allow")))
            .withColumn("reason", F.when(F.col("own").isNotNull(), F.lit("rule"))
                        .when(by_alias.isNotNull(), F.lit("alias")).otherwise(F.lit("default"))))
    return told.select(*given_back(pages, "row", *results), *results)
