"""Url rules, and block decisions carried over to the aliases of a url."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.llm.components import connected_components
from narrakin.llm.html import host_of
from narrakin.session import settle

#: (verdict, host, path) of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Rules are part of the plan, so a list has at most so many.
MOST_RULES = 10_000


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _query(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^[^#]*?://[^?#]*(\?[^#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    A rule fits its host and the host's subdomains if the path starts with its path; it is looked up
    by every suffix of the host at a dot with every prefix of the path of a length that rules have.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    known = F.create_map(*[F.lit(x) for verdict, h, p in rules for x in (h.lower() + p, verdict)])
    lengths = F.array(*[F.lit(n) for n in sorted({len(p) for _, _, p in rules}, reverse=True)])
    labels = F.split(host, r"\.")
    depth = max(h.count(".") + 1 for _, h, _ in rules)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth))),
                           lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    tried = F.flatten(F.transform(suffixes, lambda h: F.transform(
        F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.concat(h, F.substring(path, F.lit(1), n)))))
    found = F.transform(F.filter(tried, lambda t: F.map_contains_key(known, t)),
                        lambda t: F.struct(F.length(t).alias("n"), t.alias("rule"), F.element_at(known, t).alias("verdict")))
    return F.when(F.size(found) > 0, F.transform(F.slice(F.array_sort(found), -1, 1), lambda x: F.struct(
        x["rule"].alias("rule"), x["verdict"].alias("verdict")))[0])


def url_key(url: Column) -> Column:
    """Name of a url as a node: host, path and query, without scheme and fragment; null without host."""
    path = path_of(url)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path == "", "/").otherwise(path), _query(url)))


def aliases(html: Column) -> Column:
    """Targets of the canonical links and refresh redirects of a page, as they stand there."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = F.filter(tags, lambda t: t.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"))
    refresh = F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"))
    quoted = lambda t, name: F.regexp_extract(t, rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", 0)
    value = lambda t, name: F.regexp_replace(F.regexp_replace(quoted(t, name), r"(?is)^\w+\s*=\s*[\"']?", ""), r"[\"']$", "")
    target = lambda t: F.regexp_extract(value(t, "content"), r"(?is)^\s*[\d.]*\s*[;,]\s*url\s*=\s*[\"']?([^\"']*)", 1)
    found = F.concat(F.transform(canonical, lambda t: value(t, "href")), F.transform(refresh, target))
    return F.filter(F.transform(found, lambda u: F.replace(F.trim(u), F.lit("&amp;"), F.lit("&"))), lambda u: u != "")


def absolute(base: Column, link: Column) -> Column:
    """A link made absolute against the url of its page; null for one that leads to no host."""
    root = F.concat(F.lit("http://"), host_of(base))
    folder = F.regexp_extract(F.concat(path_of(base), F.lit("")), r"(?s)^(.*/)", 1)
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link).when(link.startswith("//"), F.concat(F.lit("http:"), link)).when(
        link.rlike(r"^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None)).when(host_of(base) == "", F.lit(None)).when(
        link.startswith("/"), F.concat(root, link)).when(link.startswith("?"), F.concat(root, path_of(base), link)).otherwise(
        F.concat(root, F.when(folder == "", "/").otherwise(folder), link))


def judge(spark: SparkSession, pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url, html).

    The page's own rule decides. Without one, the page follows its aliases, the urls it is joined to
    by canonical links and refresh redirects, in either direction and through others: it is allowed
    if a rule allows one of them, else blocked if a rule blocks one, else allowed. A null url, or one
    without `://`, has an empty host and path and no aliases. Urls are nodes by the 64-bit hash of
    host, path and query. Repeated rows are judged each; other columns are ignored.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    named = url_key(F.col("url")).isNotNull()
    node = F.when(named, F.xxhash64(url_key(F.col("url")))).otherwise(F.xxhash64("page_id", "url", F.lit("no node")))  # not all in one task
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"), node.alias("node"), named.alias("named"))
    judged = own.withColumn("own", longest_rule(F.col("host"), F.col("path"), rules))
    linked = pages.select("url", F.explode(aliases(F.col("html"))).alias("link")).select("url", absolute(F.col("url"), F.col("link")).alias("to"))
    linked = linked.where(url_key(F.col("url")).isNotNull() & url_key(F.col("to")).isNotNull())
    end = lambda u: F.struct(F.xxhash64(url_key(F.col(u))).alias("node"), longest_rule(host_of(F.col(u)), path_of(F.col(u)), rules)["verdict"].alias("verdict"))
    edges = settle(linked.select(end("url").alias("a"), end("to").alias("b")), "alias-edges")
    groups = connected_components(spark, edges.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))
    groups = settle(groups, "alias-groups")
    ends = edges.select(F.explode(F.array("a", "b")).alias("x")).select("x.*").where("verdict IS NOT NULL").distinct()
    decided = ends.join(groups, "node").groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allowed"))
    blocked = settle(groups.join(decided.where("NOT allowed").select("component"), "component").select("node").distinct(), "alias-blocked")
    marked = judged.join(blocked.withColumn("by_alias", F.lit(True)), "node", "left")
    verdict = F.coalesce(F.col("own.verdict"), F.when(F.col("by_alias") & F.col("named"), "block").otherwise("allow"))
    return marked.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"))
