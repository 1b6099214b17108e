"""URL filters with redirect equivalence.

Addresses joined by redirects and canonical links are aliases: connected components over
those edges, found by distributed union-find. A rule decides for every address it fits; an
address that no rule fits is blocked where a rule blocks one of its aliases. An explicit
allow takes precedence: it is never overruled by a block that reaches it from an alias.

Everything is DataFrame work. Rules are a table of any size, joined on the host's suffixes;
an address is judged once however many pages or edges name it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .linking import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (action, host, path) of the registered query.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'>\s]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def address_of(url: Column) -> Column:
    """What makes two urls one address: host, path and query; scheme and fragment don't count. Null without a host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url), F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))))


def page_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) urls of canonical links and refresh redirects in ``pages`` (url, html).

    Targets relative to the host or the folder are completed; other schemes are left out.
    """
    canonical = F.regexp_extract(F.regexp_extract("html", _CANONICAL, 0), _HREF, 0)
    refresh = F.regexp_extract(F.regexp_extract("html", _REFRESH, 0), _REFRESH_URL, 1)
    raw = F.explode(F.array(F.regexp_replace(canonical, r"""(?is)^href\s*=\s*|["']""", ""), refresh))
    found = pages.filter("url IS NOT NULL AND (html ILIKE '%canonical%' OR html ILIKE '%refresh%')").select("url", raw.alias("raw")).filter("raw <> ''")
    found = found.select("url", F.replace(F.trim("raw"), F.lit("&amp;"), F.lit("&")).alias("raw"))
    folder = F.regexp_extract(path_of(F.col("url")), "(?s)^(.*/)", 1)
    target = F.when(F.col("raw").contains("://"), F.col("raw")).when(F.col("raw").startswith("//"), F.concat(F.lit("x:"), "raw"))
    target = target.when(F.col("raw").startswith("/"), F.concat(F.lit("x://"), host_of(F.col("url")), "raw"))
    target = target.when(~F.col("raw").rlike("^[A-Za-z][A-Za-z0-9+.-]*:|^#"), F.concat(F.lit("x://"), host_of(F.col("url")), F.when(folder == "", "/").otherwise(folder), "raw"))
    return found.select(F.col("url").alias("src"), target.alias("dst")).filter("dst IS NOT NULL")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")


def by_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``addresses`` (address, host, path; each once) with rule and action of the longest rule that fits, else null.

    Of rules of one length the one with the longer host wins, then an allow.
    """
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")
    hosts = addresses.select("host").distinct().select("host", F.explode(suffixes).alias("rule_host"))
    near = hosts.join(rules, "rule_host")
    fits = addresses.join(near, "host").filter(F.expr("startswith(path, rule_path)"))
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule), F.length("rule_host"), F.col("action") == "allow", rule)
    best = fits.groupBy("address").agg(F.max_by(F.struct(rule.alias("rule"), "action"), rank).alias("best"))
    return addresses.join(best, "address", "left").select("address", "host", "path", "best.rule", "best.action")


def verdicts(spark: SparkSession, pages: DataFrame, edges: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, component: one row per row of ``pages`` (page_id, url).

    ``edges`` (src, dst) are urls, whether pages name them or not: a target that no page has
    may be what a rule blocks. Urls that are null or have no host fit no rule, have no alias
    and are allowed, as is an address without rule whose aliases are not blocked. Edges with
    a null, loops and repeated edges change nothing. ``component`` is the smallest address
    of the page's aliases. Other columns are ignored.
    """
    scratch = Scratch(spark, "url-filter")
    pages = scratch.cut(pages.select(F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address_of(F.col("url")).alias("address")), "pages")
    pairs = scratch.cut(edges.select(address_of(F.col("src")).alias("a"), address_of(F.col("dst")).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    aliases = components(scratch, pairs)
    named = pages.filter("address IS NOT NULL").select("address", "host", "path")
    ends = aliases.select("id").select(F.col("id").alias("address"), host_of(F.concat(F.lit("x://"), "id")).alias("host"), path_of(F.concat(F.lit("x://"), "id")).alias("path"))
    judged = scratch.cut(by_rules(named.unionByName(ends).distinct(), rules), "judged")
    whole = judged.join(aliases.withColumnRenamed("id", "address"), "address", "left")
    blocked = whole.filter("component IS NOT NULL").groupBy("component").agg(F.max(F.col("action").eqNullSafe("block")).alias("reached")).filter("reached")
    whole = whole.join(blocked, "component", "left").select("address", "rule", F.coalesce("action", F.when(F.col("reached"), "block"), F.lit("allow")).alias("verdict"), F.coalesce("component", "address").alias("component"))
    return pages.join(whole, "address", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"), "component")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return verdicts(spark, pages, page_edges(pages), rule_table(spark, RULES))


OP1_SQL = r"""
WITH RECURSIVE p AS (SELECT page_id, url, html, translate(regexp_extract(coalesce(url, ''), '^(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '^(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 2) AS path, regexp_extract(coalesce(url, ''), '^(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3) AS query FROM pages),
a AS (SELECT *, CASE WHEN host <> '' THEN host || path || query END AS address FROM p),
l AS (SELECT address AS src, regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0) AS tag FROM a),
t AS (SELECT src, regexp_extract(tag, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS dst FROM l WHERE tag <> ''),
e AS (SELECT src, translate(regexp_extract(dst, '^(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(dst, '^(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 2) || regexp_extract(dst, '^(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3) AS dst FROM t WHERE dst LIKE '%://%' AND src IS NOT NULL),
both_ways AS (SELECT src AS x, dst AS y FROM e UNION SELECT dst, src FROM e),
walk AS (SELECT x AS id, x AS root FROM both_ways UNION SELECT b.y, w.root FROM walk w JOIN both_ways b ON b.x = w.id),
c AS (SELECT id, min(root) AS component FROM walk GROUP BY id),
n AS (SELECT DISTINCT address FROM a WHERE address IS NOT NULL UNION SELECT id FROM c),
parts AS (SELECT address, regexp_extract(address, '^([^/?#]*)', 1) AS host, regexp_extract(address, '^[^/?#]*([^?#]*)', 1) AS path FROM n),
r(action, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (SELECT address, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(action, length(rh || rp)) AS action FROM parts JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY address),
j AS (SELECT n.address, rule, action, component FROM n LEFT JOIN f ON f.address = n.address LEFT JOIN c ON c.id = n.address),
b AS (SELECT component FROM j WHERE action = 'block' AND component IS NOT NULL GROUP BY component)
SELECT page_id, a.host, a.path, rule, coalesce(action, CASE WHEN b.component IS NOT NULL THEN 'block' END, 'allow') AS verdict, coalesce(j.component, a.address) AS component
FROM a LEFT JOIN j ON j.address = a.address LEFT JOIN b ON b.component = j.component
"""
