"""URL filters that follow redirects and canonical links: DataFrame operations only.

A page's own rule is the longest one that fits its host (or a parent domain) and the begin of its path. Pages
without a rule take the decision of their equivalents: urls joined by redirects, by canonical links
and by the forms of one url that servers redirect to each other (scheme, fragment, tracking parameters, trailing
slash). If any equivalent is explicitly allowed, the page is allowed; else, if any is blocked, it is
blocked; else it is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import run_folder, saved
from cdcmart.llm.components import components

# Parameters that never change the page.
_TRACKING = r"(?<=[?&])(?:utm_[a-z]+|gclid|fbclid)=[^&]*(?:&|$)"

# A canonical link, its attributes in either order, and a refresh to another url.
_CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"

# How an ampersand is written in an attribute.
_AMPERSAND = "(?i)&(?:amp|#38|#x26);"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_form(url: str | Column) -> Column:
    """One form for urls that servers redirect to each other; null for a url without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(F.concat(F.lit("?"), query), _TRACKING, ""), "[?&]+$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.when(url.contains("://"), F.concat(F.lit("//"), host_of(url), path, kept))


def links_of(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) of urls in canonical form: canonical links and refreshes of the pages, each completed by the page's
    own url (see :func:`whole_url`). Links that name no page are left out."""
    own = canonical_form(url)
    target = F.explode(
        F.concat(
            F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(1))
        )
    )
    linked = pages.where(F.col(html).isNotNull() & F.col(url).contains("://")).select(
        own.alias("a"), host_of(url).alias("host"), path_of(url).alias("path"), target.alias("to")
    )
    whole = whole_url(F.regexp_replace("to", _AMPERSAND, "&"), F.col("host"), F.col("path"))
    return linked.select("a", canonical_form(whole).alias("b")).where("b is not null")


def whole_url(to: Column, host: Column, path: Column) -> Column:
    """The url that a link leads to from the page at ``host`` and ``path``: whole ones as they are, others by their host,
    by the page's folder, or by its path if they are a query only; ``.`` and ``..`` are resolved. Null for a
    mere fragment and for schemes without a host."""
    site, scheme = F.concat(F.lit("http://"), host), r"^[A-Za-z][A-Za-z0-9+.-]*:"
    folder = F.regexp_replace(path, "[^/]*$", "")
    below = F.when(to.startswith("/"), to).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), to))
    relative = F.concat(
        site, _without_dots(F.regexp_extract(below, r"(?s)^[^?#]*", 0)), F.regexp_extract(below, r"(?s)^[^?#]*(.*)$", 1)
    )
    return (
        F.when(to.rlike(scheme + "//"), to)
        .when(to.rlike(scheme) | to.startswith("#"), F.lit(None))
        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.startswith("?"), F.concat(site, path, to))
        .otherwise(relative)
    )


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its steps ``.`` and ``..`` taken."""
    steps = F.split(path, "/", -1)
    taken = F.aggregate(
        F.slice(steps, F.lit(2), F.size(steps)),
        F.slice(steps, 1, 1),
        lambda a, s: F.when(s == ".", a)
        .when((s == "..") & (F.size(a) > 1), F.slice(a, F.lit(1), F.size(a) - 1))
        .when(s == "..", a)
        .otherwise(F.concat(a, F.array(s))),
        lambda a: F.array_join(a, "/"),
    )
    return F.when(path.rlike(r"/\.\.?(/|$)"), taken).otherwise(path)


def with_rules(pages: DataFrame, rules: DataFrame, folder: str) -> DataFrame:
    """Add rule and action to every row of ``pages`` (host, path and others); both null without a rule.

    Rules (host, path, action) are looked up once per distinct host: all parent domains of a host meet the rules by an
    equal join, and the fitting rules of a host, longest first, come back to its pages. Of two rules
    equal in length ``allow`` wins.
    """
    hosts = pages.select("host").distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    named = rules.select(
        F.translate("host", _UPPER, _LOWER).alias("parent"),
        F.coalesce("path", F.lit("/")).alias("rule_path"),
        "action",
        F.concat("host", F.coalesce("path", F.lit("/"))).alias("rule"),
    ).where("parent is not null and action in ('allow', 'block')")
    fitting = (
        hosts.select("host", F.explode(parents).alias("parent"))
        .join(named, "parent")
        .groupBy("host")
        .agg(
            F.sort_array(
                F.collect_set(
                    F.struct(
                        F.length("rule").alias("size"),
                        (F.col("action") == "allow").alias("allow"),
                        "rule",
                        "rule_path",
                        "action",
                    )
                ),
                asc=False,
            ).alias("rules")
        )
    )
    # Written, so that its size is known to the join and a host with many pages can be split.
    fitting = saved(fitting, folder, "fitting")
    best = F.try_element_at(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(1))
    return (
        pages.join(fitting, "host", "left")
        .withColumn("best", best)
        .select(*pages.columns, F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
    )


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, redirects: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    ``rules`` are (host, path, action) with action ``allow`` or ``block``; ``redirects`` are more edges (a, b) of
    urls. A null url, or one without ``://``, has an empty host and path, no rule and no equivalents:
    it is allowed. Null html has no links. Repeated rows and ids each get their row; other columns are not looked at.
    """
    spark = pages.sparkSession
    folder = run_folder(spark, "urls")
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, action string")
    split = pages.select(
        "page_id",
        host_of("url").alias("host"),
        path_of("url").alias("path"),
        canonical_form("url").alias("form"),
    )
    ruled = saved(with_rules(split, rules, folder), folder, "ruled")
    edges = links_of(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(canonical_form("a").alias("a"), canonical_form("b").alias("b")))
    # Pages of one form are one node: only links between forms are left to be followed.
    groups = components(edges, folder)
    decided = (
        ruled.where("action is not null and form is not null")
        .groupBy("form")
        .agg(F.max(F.when(F.col("action") == "allow", 2).otherwise(1)).alias("rank"))
    )
    reached = (
        decided.join(groups, decided["form"] == groups["node"], "left")
        .groupBy(F.coalesce("component", "form").alias("group"))
        .agg(F.max("rank").alias("rank"))
    )
    spread = groups.join(reached, groups["component"] == reached["group"]).select(F.col("node").alias("form"), "rank")
    alone = decided.join(groups, decided["form"] == groups["node"], "left_anti").select("form", "rank")
    ranks = saved(spread.unionByName(alone), folder, "ranks")
    return (
        ruled.join(ranks, "form", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("action", F.when(F.col("rank") == 1, "block").otherwise("allow")).alias("verdict"),
        )
    )
