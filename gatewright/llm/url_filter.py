"""URL filters that hold for all aliases of a page.

A rule judges the URLs of its host and path. Pages that redirect to each other
or name the same canonical page are one page under several URLs, so a decision
about one holds for its aliases: connected components over redirect and
canonical-link edges carry it, and an explicit allow comes before any block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import ascii_lower
from gatewright.llm.graph import components
from gatewright.session import stored

# The rules of the registered query.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)

TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?is)^<link\b.*\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
REFRESH = r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
CONTENT_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Names a page: host, path and query. Scheme and fragment don't matter."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.concat(host_of(url), path_of(url), F.coalesce(query, F.lit("")))


def page_edges(pages: DataFrame) -> DataFrame:
    """``(a, b)``, nodes that are one page: every page with the targets of its
    canonical links and immediate refreshes. Relative targets are resolved;
    pages without a host have no edges."""
    tags = F.regexp_extract_all("html", F.lit(TAGS), 0)
    targets = F.transform(F.filter(tags, lambda t: t.rlike(CANONICAL)), lambda t: F.regexp_extract(t, HREF, 1))
    moved = F.transform(F.filter(tags, lambda t: t.rlike(REFRESH)), lambda t: F.regexp_extract(t, CONTENT_URL, 1))
    rows = pages.select("url", F.explode(F.concat(targets, moved)).alias("t"))
    rows = rows.select("url", F.replace(F.col("t"), F.lit("&amp;"), F.lit("&")).alias("t"))
    t, host, path = F.col("t"), host_of(F.col("url")), path_of(F.col("url"))
    absolute = (F.when(F.instr(t, "://") > 0, t)
                .when(t.startswith("//"), F.concat(F.lit("x:"), t))
                .when(t.startswith("/"), F.concat(F.lit("x://"), host, t))
                .when(t.startswith("?"), F.concat(F.lit("x://"), host, path, t))
                .otherwise(F.concat(F.lit("x://"), host, F.regexp_replace(path, r"[^/]*$", ""), t)))
    rows = rows.where((t != "") & (host != "")).select(node_of(F.col("url")).alias("a"), node_of(absolute).alias("b"))
    return rows.where("a <> b")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, action)`` for each distinct host and path of ``urls``
    that a rule fits; the longest rule wins, of equally long ones an allow.

    Hosts are looked up by each of their suffixes, so the work does not grow
    with the number of rules. ``rules``: ``action, rule`` (host, then path).
    """
    at = F.instr("rule", "/")
    rules = rules.select("action", "rule", F.expr("substring(rule, 1, instr(rule, '/') - 1)").alias("of"),
                         F.when(at > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise("").alias("under"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("of"))
    fits = each.join(rules, "of").where(F.expr("startswith(path, under)"))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule").alias("n"), F.length("of").alias("h"), (F.col("action") == "allow").alias("a"),
        "rule", "action")).alias("best"))
    return best.select("host", "path", "best.rule", "best.action")


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url, html)``.

    A page with a rule gets its verdict. Else the aliases decide: an allow of
    any of them, else a block of any of them, else allow. ``edges(src, dst)``
    adds redirects that were seen elsewhere, as URLs.

    Null and broken URLs have an empty host and path and no aliases; null html
    has no links; repeated rows come out as often as they went in; no rules
    allow everything. Further columns are not looked at.
    """
    rows = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    pairs = page_edges(rows)
    if edges is not None:
        pairs = pairs.unionByName(edges.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")))
    groups = stored(components(pairs), "aliases")
    named = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                        node_of(F.col("url")).alias("node"))
    url = F.concat(F.lit("x://"), F.col("node"))
    members = groups.select("node", "root", host_of(url).alias("host"), path_of(url).alias("path"))
    rule = stored(ruled(named.select("host", "path").unionByName(members.select("host", "path")), rules), "ruled")
    verdicts = members.join(rule, ["host", "path"]).groupBy("root").agg(
        F.max((F.col("action") == "allow").cast("int")).alias("allowed"))
    shared = stored(groups.join(verdicts, "root").select(
        "node", F.when(F.col("allowed") == 1, "allow").otherwise("block").alias("of_alias")), "verdicts")
    out = named.join(rule, ["host", "path"], "left").join(shared, "node", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("action", "of_alias", F.lit("allow")).alias("verdict"))


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([*RULES], "action string, rule string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


# Pages that are one page by their links: recursion over the edges, then the same precedence.
OP1_SQL = r"""
WITH RECURSIVE rules(action, rule) AS (
  VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
         ('block', 'net/es/'), ('block', 'net/fr/')),
after AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(coalesce(rest, ''), '^[^?#]*(\?[^#]*)?', 1) AS query
  FROM after),
links AS (
  SELECT host, path, query, replace(t, '&amp;', '&') AS t FROM (
    SELECT host, path, query, unnest(list_concat(
      list_transform(list_filter(tags, lambda x: regexp_matches(x, '(?is)^<link\b.*\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')),
                     lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)),
      list_transform(list_filter(tags, lambda x: regexp_matches(x, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
                     lambda x: regexp_extract(x, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)))) AS t
    FROM (SELECT *, regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>') AS tags FROM p))
  WHERE t <> '' AND host <> ''),
targets AS (
  SELECT host || path || query AS a,
         CASE WHEN contains(t, '://') THEN substr(t, strpos(t, '://') + 3)
              WHEN starts_with(t, '//') THEN substr(t, 3)
              WHEN starts_with(t, '/') THEN host || t
              WHEN starts_with(t, '?') THEN host || path || t
              ELSE host || regexp_replace(path, '[^/]*$', '') || t END AS rest
  FROM links),
pairs AS (
  SELECT a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS b
  FROM targets),
edges AS (SELECT a, b FROM pairs WHERE a <> b UNION SELECT b, a FROM pairs WHERE a <> b),
reach(node, other) AS (
  SELECT a, a FROM edges UNION SELECT node, b FROM reach JOIN edges ON other = a),
places AS (
  SELECT host, path, host || path || query AS node FROM p
  UNION SELECT regexp_extract(a, '^[^/?#]*'), regexp_extract(a, '^[^/?#]*([^?#]*)', 1), a FROM edges),
judged AS (
  SELECT host, path, node, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM places JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY ALL),
aliases AS (
  SELECT reach.node, max(action = 'allow') AS allowed
  FROM reach JOIN judged ON judged.node = reach.other GROUP BY reach.node)
SELECT page_id, p.host, p.path, judged.rule,
       coalesce(judged.action, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN judged ON judged.node = p.host || p.path || p.query
LEFT JOIN aliases ON aliases.node = p.host || p.path || p.query
"""
