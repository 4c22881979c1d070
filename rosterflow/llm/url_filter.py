"""Allow and block decisions on page urls, spread over redirects and canonical links.

A rule has a host and a path. It fits the urls of its host and all its subdomains whose
path starts with its own; of the rules that fit, the longest wins (at equal length allow
before block, then the later text). A page without a fitting rule takes the decision of
its aliases: urls are joined by redirects, canonical links and spelling (scheme, fragment,
tracking parameters and closing slashes say nothing), and the connected components of that
graph are the aliases of one resource. In a component with an explicitly allowed page its
undecided pages are allowed; else, with a blocked one, they are blocked; else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import work
from rosterflow.llm.components import connected_components

#: Query parameters that do not name a resource.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|ref)(=|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the registered query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
_TAGS = {"canonical": (r"(?is)<link\b[^>]*>", r"(?is)\brel\s*=\s*[\"']?canonical\b", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"), "refresh": (r"(?is)<meta\b[^>]*>", r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)")}


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """The host with A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """Host, path and telling parameters; null for null or without ``://``."""
    query = F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.filter(query, lambda p: ~p.rlike(TRACKING) & (p != "")), "&")
    place = F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(F.instr(url, "://") > 0, F.concat(place, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def link_target(url: Column, html: Column, kind: str) -> Column:
    """The absolute url that the first such tag of ``html`` names, or null. Dot segments stay."""
    tags, which, attribute = _TAGS[kind]
    tag = F.get(F.filter(F.regexp_extract_all(html, F.lit(tags), F.lit(0)), lambda t: t.rlike(which)), F.lit(0))
    target = F.replace(F.regexp_extract(tag, attribute, 1), F.lit("&amp;"), F.lit("&"))
    site = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_extract(path_of(url), "(?s)^(.*/)", 1)
    return (
        F.when(target == "", F.lit(None))
        .when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(F.instr(url, "://") == 0, F.lit(None))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def with_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages (host, path)`` with ``rule`` (host and path as one text) and ``action`` of the rule that wins."""
    fitting = rules.where("host is not null and path is not null and action in ('allow', 'block')")
    of_host = fitting.groupBy("host").agg(F.collect_set(F.struct(F.length(F.concat("host", "path")).alias("size"), (F.col("action") == "allow").alias("allow"), F.concat("host", "path").alias("rule"), F.col("path").alias("start"))).alias("own"))
    # a host meets the rules of each of its endings once, however many pages it has
    hosts = pages.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.")
    endings = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("ending"))
    known = endings.join(of_host.withColumnRenamed("host", "ending"), "ending").groupBy("host").agg(F.flatten(F.collect_list("own")).alias("known"))
    known = work.written(known, "host-rules")  # a plain side, so that Spark can split a host that has most pages
    best = F.array_max(F.filter("known", lambda r: F.col("path").startswith(r["start"])))
    judged = pages.join(known, "host", "left").withColumn("best", best)
    return judged.withColumn("rule", F.col("best.rule")).withColumn("action", F.when(F.col("best.allow"), "allow").when(~F.col("best.allow"), "block")).drop("known", "best")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, alias`` of each row of ``pages (page_id, url, html)``.

    ``rules (host, path, action)`` are judged as written; ``redirects (src, dst)`` are
    further edges between urls. A null url, or one without ``://``, has empty host and
    path, no rule and no alias, and is allowed. A null or broken html has no links.
    Repeated rows are judged each; other columns are ignored; no pages give no rows.
    """
    url, html = F.col("url"), F.col("html")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), alias_key(url).alias("key"))
    told = with_rule(base, rules)
    edges = None
    for kind in _TAGS:
        more = pages.where(html.isNotNull()).select(alias_key(url).alias("a"), alias_key(link_target(url, html, kind)).alias("b"))
        edges = more if edges is None else edges.unionByName(more)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(alias_key(F.col("src")).alias("a"), alias_key(F.col("dst")).alias("b")))
    component = work.written(connected_components(edges.where("a is not null and b is not null")), "url-components")
    named = told.join(component.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("alias", F.coalesce("component", "key"))
    decided = named.where("alias is not null and action is not null").groupBy("alias").agg(F.min("action").alias("spread"))  # allow comes first
    verdict = F.coalesce("action", "spread", F.lit("allow"))
    return named.join(decided, "alias", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "alias")


def op3_redirect_equivalence(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, action string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules).drop("alias")


def _sql() -> str:
    def rest(u):
        return f"CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) END"

    def host(u):
        return f"coalesce(translate(regexp_extract({rest(u)}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')"

    def path(u):
        return f"coalesce(regexp_extract({rest(u)}, '^[^/?#]*([^?#]*)', 1), '')"

    def key(u):
        kept = f"array_to_string(list_filter(string_split(regexp_extract({rest(u)}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: NOT regexp_matches(p, '{TRACKING}') AND p <> ''), '&')"
        return f"CASE WHEN contains({u}, '://') THEN {host(u)} || regexp_replace({path(u)}, '/+$', '') || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END END"

    def target(kind):
        tags, which, attribute = (p.replace("'", "''") for p in _TAGS[kind])
        return f"replace(regexp_extract(list_filter(regexp_extract_all(html, '{tags}'), lambda t: regexp_matches(t, '{which}'))[1], '{attribute}', 1), '&amp;', '&')"

    full = f"CASE WHEN t = '' THEN NULL WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t WHEN NOT contains(url, '://') THEN NULL WHEN starts_with(t, '/') THEN 'http://' || {host('url')} || t ELSE 'http://' || {host('url')} || coalesce(nullif(regexp_extract({path('url')}, '(?s)^(.*/)', 1), ''), '/') || t END"
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    tags = " UNION ALL ".join(f"SELECT url, {target(k)} AS t FROM pages WHERE html IS NOT NULL" for k in _TAGS)
    return f"""
WITH RECURSIVE rules(rh, rp, action) AS (VALUES {rules}),
base AS (SELECT row_number() OVER () AS id, page_id, {host("url")} AS host, {path("url")} AS path, {key("url")} AS k FROM pages),
best AS (SELECT id, arg_max(struct_pack(rule := rh || rp, action := action), (length(rh || rp), action = 'allow', rh || rp)) AS b
  FROM base JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY id),
told AS (SELECT base.*, b.rule AS rule, b.action AS action FROM base LEFT JOIN best USING (id)),
links AS (SELECT {key("url")} AS a, {key("u")} AS b FROM (SELECT url, {full} AS u FROM ({tags}))),
both_ways AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
walk(node, c) AS (SELECT a, a FROM both_ways UNION SELECT e.b, w.c FROM walk w JOIN both_ways e ON e.a = w.node WHERE w.c < e.b),
comp AS (SELECT node, min(c) AS c FROM walk GROUP BY node),
named AS (SELECT told.*, coalesce(c, k) AS alias FROM told LEFT JOIN comp ON node = k),
decided AS (SELECT alias, min(action) AS spread FROM named WHERE alias IS NOT NULL AND action IS NOT NULL GROUP BY alias)
SELECT page_id, host, path, rule, coalesce(action, spread, 'allow') AS verdict FROM named LEFT JOIN decided USING (alias)
"""


SQL = _sql()
