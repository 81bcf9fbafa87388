"""URL filter with redirect equivalence.

A url is judged by the longest rule that fits it. Urls that lead to the same page
share decisions: each url stands for its canonical form (host without ``www.``, no scheme,
fragment, trailing slash or ``utm_`` parameters), and pages name further aliases by canonical
links and refresh redirects in their HTML, in full or relative to their own url. The connected components of these edges are the
equivalence classes. A url without a rule of its own is allowed if any url of its class is
allowed explicitly, else blocked if any is blocked, else allowed.

DataFrame operations only. Rules are an equi-join: a url is looked up by as many keys as the rules
have shapes (labels of the host, length of the path), never compared with every rule.
Distinct urls are judged once, however many pages repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast
from .components import connected_components

#: Rules up to this number are broadcast (about 10 MB); beyond, the join shuffles.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_form(url: Column) -> Column:
    """The key that a url shares with its plain variants; null without a host."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), "^&", "")
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    key = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", key)


#: A ``rel`` value that holds the word canonical, a refresh, and the values of attributes.
CANONICAL = r"""(?i)[\s"']rel\s*=\s*("([^"]*\s)?canonical(\s[^"]*)?"|'([^']*\s)?canonical(\s[^']*)?'|canonical[\s/>])"""
REFRESH = r"""(?i)[\s"']http-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?i)[\s"']href\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH_URL = r"""(?i)[\s"';,]url\s*=\s*["']?\s*([^"'\s>]+)"""


def without_dots(path: Column) -> Column:
    """A path that starts with ``/`` without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), lambda done, part:
                       F.when(part == ".", done).when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
                       .otherwise(F.array_append(done, part)))
    # a dot segment at the end names the folder
    return F.concat(F.array_join(kept, "/"), F.when(path.rlike(r"/[.][.]?$"), F.lit("/")).otherwise(F.lit("")))


def resolved(target: Column, url: Column) -> Column:
    """The url that a target on the page ``url`` names; null for other schemes, and for places on the page itself."""
    host, path = host_of(url), path_of(url)
    file, rest = F.regexp_extract(target, r"^([^?#]*)", 1), F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    folder = F.regexp_replace(path, "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    place = (F.when(target.startswith("/"), without_dots(file)).when(file != "", without_dots(F.concat(folder, file)))
             .when(rest.startswith("?"), F.when(path == "", "/").otherwise(path)))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & (host != ""), F.concat(F.lit("http://"), host, place, rest)))


def declared_aliases(pages: DataFrame) -> DataFrame:
    """(url, target): the canonical links and refresh redirects that pages declare.

    Relative targets are resolved against the page's url; ``<base>`` is not read.
    """
    def targets(tag: str, kind: str, value: str) -> Column:
        tags = F.filter(F.regexp_extract_all(F.col("html"), F.lit(rf"(?i)<{tag}\b[^>]*>"), F.lit(0)), lambda t: t.rlike(kind))
        return F.transform(tags, lambda t: F.regexp_extract(t, value, 1))

    found = F.concat(targets("link", CANONICAL, HREF), targets("meta", REFRESH, REFRESH_URL))
    rows = pages.filter(F.col("url").isNotNull() & F.col("html").isNotNull()).select("url", F.explode(found).alias("target"))
    target = F.replace("target", F.lit("&amp;"), F.lit("&"))
    rows = rows.select("url", target.alias("target")).filter("target <> ''").distinct()
    return rows.select("url", resolved(F.col("target"), F.col("url")).alias("target")).filter("target is not null").distinct()


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, allow): the longest rule that fits each url, where there is one.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of equally long ones the longer host wins, then an allow.
    """
    rules = rules.select("host", "path", "allow").filter("host <> ''").distinct()
    shapes = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct().collect()
    if not shapes:
        return urls.select("url", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("boolean").alias("allow")).limit(0)
    keys = F.array(*[F.struct(F.substring_index("host", ".", -s["labels"]).alias("host"), F.substring("path", 1, s["chars"]).alias("path"))
                     for s in shapes])
    keyed = urls.select("url", F.explode(F.array_distinct(keys)).alias("k")).select("url", "k.host", "k.path")
    hits = keyed.join(bounded_broadcast(rules, BROADCAST_RULES), ["host", "path"])
    rule = F.concat("host", "path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("host").alias("h"), "allow", rule.alias("rule"))).alias("best")
    return hits.groupBy("url").agg(best).select("url", "best.rule", "best.allow")


def judge_urls(pages: DataFrame, rules: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict (``allow`` or ``block``) for every page.

    ``rules``: host, path, allow. ``aliases``: further (url, target) redirects. A null url, or one
    without ``://``, has empty host and path, no rule and no alias, and is allowed. A null or empty
    html declares nothing. Repeated rows each give a row; other columns are not read.
    """
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    edges = declared_aliases(pages)
    if aliases is not None:
        edges = edges.union(aliases.select("url", "target").filter("url is not null and target is not null"))
    urls = pages.select("url").union(edges.select("url")).union(edges.select("target")).filter("url is not null").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                       canonical_form(F.col("url")).alias("key"))
    judged = urls.join(fitting_rules(urls, rules), "url", "left")
    links = edges.select(canonical_form(F.col("url")).alias("a"), canonical_form(F.col("target")).alias("b")).filter("a <> b")
    classes = connected_components(links).withColumnRenamed("node", "key")
    judged = judged.join(classes, "key", "left").withColumn("component", F.coalesce("component", "key"))
    shared = judged.groupBy("component").agg(F.bool_or("allow").alias("any_allow"), (~F.bool_and("allow")).alias("any_block"))
    verdict = (F.when(F.col("allow").isNotNull(), F.when(F.col("allow"), "allow").otherwise("block"))
               .when(F.col("any_block") & ~F.col("any_allow"), "block").otherwise("allow"))
    by_url = judged.join(shared, "component", "left").select("url", "host", "path", "rule", verdict.alias("verdict"))
    return pages.select("page_id", "url").join(by_url, "url", "left").select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"))
