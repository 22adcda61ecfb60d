"""URL filter: rules by host and path, and block decisions carried over to aliases of a page.

Pages that redirect to one another or name one another as canonical are aliases: the connected components
of those links. A page that a rule fits gets the rule's decision, so an explicit allow always stands. A page
without a rule is blocked if any alias of it, fetched or only linked to, is blocked by a rule, and allowed
otherwise. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.components import connected_components
from siltstone.session import written

_LINK_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"""(?i)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH_URL = r"""(?is)\bcontent\s*=\s*["']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*['"]?([^"'>\s]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What a URL names, whatever its scheme and fragment: host, path and query. NULL without a host."""
    rest = F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^#]*)", 1)
    rest = F.when(rest == "", "/").when(F.startswith(rest, F.lit("?")), F.concat(F.lit("/"), rest)).otherwise(rest)
    host = host_of(url)
    return F.when(host != "", F.concat(host, rest))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules (action, host, path) as a table; ``allow`` stands before ``block`` for one host and path."""
    best: dict[tuple[str, str], str] = {}
    for action, host, path in rules:
        if action not in ("allow", "block"):
            raise ValueError(f"neither allow nor block: {action}")
        best[host, path] = min(action, best.get((host, path), action))
    rows = [F.struct(F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path"), F.lit(a).alias("action"))
            for (h, p), a in sorted(best.items())]
    empty = "cast(array() as array<struct<rule_host:string,rule_path:string,action:string>>)"
    return spark.range(1).select(F.inline(F.array(*rows) if rows else F.expr(empty)))


def with_rule(rows: DataFrame, rules: DataFrame, key: str, host: str = "host", path: str = "path") -> DataFrame:
    """``rows`` with the rule that fits and its action, both NULL if none does. ``key`` is unique.

    Only as many endings of a host are looked up as the longest rule host has labels. Spark joins by the
    true size of the rules: broadcast if small, shuffled by host ending if not. The longest rule wins, of
    equally long ones that of the longer host.
    """
    rules = written(rules.where("rule_host is not null and rule_path is not null"), "url-rules")
    labels = rules.agg(F.coalesce(F.max(F.size(F.split("rule_host", "\\."))), F.lit(0))).first()[0]
    ending = F.call_function("substring_index", F.col(host), F.lit("."), -F.col("_labels"))
    known = F.size(F.split(F.col(host), "\\."))
    asked = (
        rows.where((F.col(host) != "") & F.lit(labels > 0))
        .select(
            F.col(key), F.col(host), F.col(path),
            F.explode(F.sequence(F.lit(1), F.least(F.lit(max(labels, 1)), known))).alias("_labels"),
        )
        .select(F.col(key), F.col(path), ending.alias("_ending"))
    )
    fits = asked.join(rules, (asked["_ending"] == rules["rule_host"]) & F.startswith(asked[path], rules["rule_path"]))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("l"), F.length("rule_host").alias("h"), rule.alias("rule"), "action"))
    won = fits.groupBy(key).agg(best.alias("_won")).select(key, "_won.rule", "_won.action")
    return rows.join(won, key, "left")


def alias_links(pages: DataFrame) -> DataFrame:
    """(node, target) of every canonical link and refresh in a page, targets resolved against the page."""
    tags = F.explode(F.regexp_extract_all("html", F.lit(_LINK_TAG), F.lit(0)))
    href = F.concat(*(F.regexp_extract("tag", _HREF, i) for i in (1, 2, 3)))
    target = F.when(F.col("tag").rlike(_CANONICAL) & F.col("tag").rlike("(?i)^<link"), href).when(
        F.col("tag").rlike(_REFRESH) & F.col("tag").rlike("(?i)^<meta"), F.regexp_extract("tag", _REFRESH_URL, 1)
    )
    found = (
        pages.where("html is not null and html rlike '(?i)canonical|refresh'")
        .select("node", "host", "path", tags.alias("tag"))
        .select("node", "host", "path", F.trim(F.replace(target, F.lit("&amp;"), F.lit("&"))).alias("to"))
        .where("to <> ''")
    )
    # Links are few beside the pages; written, so that pages are searched once.
    found = written(found, "url-links")
    folder = F.regexp_extract("path", r"(?s)^.*/", 0)
    base = F.concat(F.lit("x://"), F.col("host"))
    absolute = (
        F.when(F.col("to").rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(F.lit("x:"), F.col("to")))
        .when(F.startswith("to", F.lit("/")), F.concat(base, F.col("to")))
        .when(F.startswith("to", F.lit("?")), F.concat(base, F.col("path"), F.col("to")))
        .when(F.startswith("to", F.lit("#")), F.concat(base, F.col("path")))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), F.col("to")))
    )
    # A generator keeps the address from being worked out anew wherever it is used.
    resolved = found.select("node", F.explode(F.array(absolute)).alias("url"))
    return resolved.select("node", F.explode(F.array(node_of(F.col("url")))).alias("target")).where("node <> target")


def filter_urls(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, reason.

    ``rules`` is what ``rule_table`` makes; ``links`` may add (url, target_url) redirects known from a crawl.
    verdict is allow or block, reason says whether a ``rule``, an ``alias`` or nothing (``default``) decided.
    A NULL url or one without ``://`` has empty host and path, fits no rule and has no alias, so it is
    allowed. NULL html has no links. Rows that repeat a page_id are judged each by its own url.
    """
    named = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        node_of(F.col("url")).alias("node"),
        F.col("html").cast("string").alias("html"),
    )
    found = alias_links(named)
    if links is not None:
        found = found.union(links.select(node_of(F.col("url")), node_of(F.col("target_url"))))
    components = connected_components(found, "node", "target")

    # Every alias is judged by the rules, also one that was never fetched.
    aliases = with_rule(
        components.select(
            "node",
            "component",
            host_of(F.concat(F.lit("x://"), "node")).alias("host"),
            path_of(F.concat(F.lit("x://"), "node")).alias("path"),
        ),
        rules,
        "node",
    )
    blocked = aliases.where("action = 'block'").select("component").distinct()
    carried = components.join(blocked, "component").select("node", F.lit(True).alias("by_alias"))

    # A rule depends on host and path alone.
    sites = with_rule(
        named.select("host", "path").distinct().withColumn("site", F.concat("host", F.lit("\n"), "path")),
        rules,
        "site",
    ).select(F.col("site"), "rule", "action")
    sites = sites.where("rule is not null")
    judged = (
        named.select("page_id", "host", "path", "node")
        .withColumn("site", F.concat("host", F.lit("\n"), "path"))
        .join(sites, "site", "left")
        .join(written(carried, "url-carried"), "node", "left")
    )
    verdict = F.when(F.col("rule").isNotNull(), F.col("action")).when(F.col("by_alias"), "block").otherwise("allow")
    reason = F.when(F.col("rule").isNotNull(), "rule").when(F.col("by_alias"), "alias").otherwise("default")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), reason.alias("reason"))
