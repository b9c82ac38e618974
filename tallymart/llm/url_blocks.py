"""URL filters: allow and block rules, and block decisions that follow redirects and canonical links to aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymart.llm.common import ascii_lower
from tallymart.llm.components import components
from tallymart.session import checkpointed

# (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# In a page: <link rel="canonical" href="..."> with the attributes in either order, and <meta http-equiv="refresh" content="0; url=...">.
CANONICAL = (
    r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical["']?[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<link\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)["']?[^>]*\brel\s*=\s*["']?canonical\b""",
)
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh["']?[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it and the start of the path; else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, begin in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "allow")):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(begin)
        name, verdict = F.when(fits, of + begin).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def page_links(pages: DataFrame) -> DataFrame:
    """url and target for every canonical link and refresh in the html of a page; relative targets are resolved."""
    html = F.coalesce(F.col("html"), F.lit(""))
    found = [F.when(html.rlike("(?i)" + word), F.regexp_extract(html, pattern, 1)).otherwise("")
             for word, pattern in [("canonical", p) for p in CANONICAL] + [("http-equiv", REFRESH)]]
    rows = pages.select("url", F.explode(F.array(*found)).alias("target")).where("url IS NOT NULL AND target <> ''")
    target, url = F.col("target"), F.col("url")
    scheme = F.regexp_extract(url, r"^([^:]*)://", 1)
    return rows.select("url", F.when(target.contains("://"), target)
                       .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
                       .when(target.startswith("/"), F.concat(scheme, F.lit("://"), host(url), target))
                       .otherwise(F.concat(scheme, F.lit("://"), host(url), F.regexp_replace(path(url), r"[^/]*$", ""),
                                           F.when(path(url) == "", "/").otherwise(""), target)).alias("target"))


def judged_pages(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict.

    A rule that fits decides. Otherwise the page takes the decision of its aliases: urls with the same host and path,
    and all that are connected with them by redirects (``redirects``: url, target), refreshes or canonical links, whether they are
    pages or only targets. It is blocked if a rule blocks one of them and none is explicitly allowed. A null or malformed url has an empty host
    and path, fits no rule and is allowed; null html has no links; repeated rows are judged each; other columns are ignored.
    """
    url = F.col("url")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", verdict)
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.union(redirects.select("url", "target"))
    node = lambda c: F.struct(host(c).alias("host"), path(c).alias("path"))
    # Urls without a host are no place: they neither link nor inherit.
    links = links.where((host(F.col("url")) != "") & (host(F.col("target")) != ""))
    found = components(links.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b")))
    _, verdict = rule_of(F.col("node.host"), F.col("node.path"), rules)
    members = found.withColumn("ruled", verdict)
    blocked = members.groupBy("component").agg(
        (F.coalesce(F.bool_or(F.col("ruled") == "block"), F.lit(False)) & ~F.coalesce(F.bool_or(F.col("ruled") == "allow"), F.lit(False)))
        .alias("blocked")).where("blocked")
    blocked = members.join(blocked, "component").select("node.host", "node.path", F.lit("block").alias("alias_verdict"))
    blocked = checkpointed(blocked.distinct())
    return rows.join(blocked, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "alias_verdict", F.lit("allow")).alias("verdict"))
