"""URL filter with redirect equivalence.

Rules (host, path) decide a URL directly: a rule fits its host and all subdomains when the
URL's path starts with the rule's path, and the longest rule wins. URLs that lead to the
same place share a decision: edges come from redirects (meta refresh) and canonical links, and
only with ``spellings`` also from the usual redirects between spellings of a URL (scheme, www.
and m. hosts, closing slash, index page, fragment, tracking parameters), which are guesses.
Connected components of these edges are aliases; a URL without a rule of its own is blocked if
an alias is blocked and none is allowed.

Defined results: a null URL or one without ``://`` has empty host and path, no rule, and is
allowed; a page without html has no edges of its own; repeated pages give repeated rows; an
empty table gives no rows. Columns other than id, url and html are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_of
from tillroll.llm.components import components
from tillroll.operators.joins import pinned

# Fixed values: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>;]+)"""


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; of rules as long, allow comes first."""
    out = None
    for verdict, at, under in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0])):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(under))
        value = F.struct(F.lit(at + under).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def canonical(url: Column) -> Column:
    """The spelling that the usual redirects of a site lead to. Null without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^(www|m)\.(?=[^.]+\.)", "")
    path = F.regexp_replace(path_of(url), r"/(index\.[a-z]+)?$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda q: (q != "") & ~F.regexp_like(q, F.lit(r"^(utm_[a-z]+|gclid|fbclid|ref)(=|$)")))
    )
    full = F.concat(F.lit("https://"), host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(F.locate("://", url) > 0, full)


def links(pages: DataFrame, url: str = "url", html: str = "html", spellings: bool = False) -> DataFrame:
    """Edges ``a``, ``b`` between URLs that lead to the same place."""
    p = pages.select(pages[url].alias("url"), text_of(pages[html]).alias("html")).where(F.locate("://", F.col("url")) > 0)

    def target(pattern: str) -> Column:
        raw = F.regexp_extract("html", pattern, 1)
        scheme = F.regexp_extract("url", r"^([^:]*)://", 1)
        site = F.concat(scheme, F.lit("://"), host_of(F.col("url")))
        return (
            F.when(raw == "", None)
            .when(F.locate("://", raw) > 0, raw)
            .when(F.startswith(raw, F.lit("//")), F.concat(scheme, F.lit(":"), raw))
            .when(F.startswith(raw, F.lit("/")), F.concat(site, raw))
            .otherwise(F.concat(site, F.regexp_replace(path_of(F.col("url")), "[^/]*$", ""), raw))
        )

    told = p.select(
        "url", F.when(F.locate("<", F.col("html")) > 0, F.array(target(CANONICAL), target(REFRESH))).alias("to")
    ).select("url", F.explode("to").alias("to")).where("to is not null")
    edges = told.select(F.col("url").alias("a"), F.col("to").alias("b"))
    if spellings:
        every = p.select("url").union(told.select("to"))
        edges = edges.union(every.select(F.col("url").alias("a"), canonical(F.col("url")).alias("b")))
    return edges.where("a <> b")


def judge(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url", html: str = "html",
          default: str = "allow", spellings: bool = False) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``component`` (the least
    URL of the aliases; null if there is none) of every page."""
    edges = pinned(links(pages, url, html, spellings).distinct())
    group = pinned(components(edges))
    rule = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    verdicts = group.select("component", rule["verdict"].alias("v")).groupBy("component").agg(
        F.bool_or(F.col("v") == "block").alias("blocked"), F.bool_or(F.col("v") == "allow").alias("allowed")
    )
    passed = group.join(verdicts, "component").select(
        F.col("node").alias("url"),
        "component",
        F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("alias_verdict"),
    )
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"))
    rows = rows.select("page_id", "url", host_of(text_of("url")).alias("host"), path_of(text_of("url")).alias("path"))
    rows = rows.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    return rows.join(passed, "url", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.col("alias_verdict"), F.lit(default)).alias("verdict"),
        "component",
    )


def report(pages: DataFrame, **options) -> DataFrame:
    return judge(pages, **options)


def _rules_sql(host: str, path: str, result: str, rules=RULES) -> str:
    cases = " ".join(
        f"WHEN ({host} = '{at}' OR ends_with({host}, '.{at}')) AND starts_with({path}, '{under}') "
        f"THEN '{at + under if result == 'rule' else verdict}'"
        for verdict, at, under in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0]))
    )
    return f"CASE {cases} END"


def _tag_sql(tag: str, has: str, value: str) -> str:
    """The attribute ``value`` of the first ``tag`` that matches ``has`` and has a value."""
    return (
        f"list_filter(list_transform(list_filter(regexp_extract_all(html, '(?is)<{tag}\\b[^>]*'), "
        f"lambda x: regexp_matches(x, '(?is){has}')), lambda x: regexp_extract(x, '(?is){value}', 1)), lambda x: x <> '')[1]"
    )


_HOST = "translate(regexp_extract({r}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({r}, '^[^/?#]*([^?#]*)', 1)"
_REST = "CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"
_Q = "[\"'']?"


def _host_sql(url: str) -> str:
    return _HOST.format(r=f"({_REST.format(u=url)})")


def _path_sql(url: str) -> str:
    return _PATH.format(r=f"({_REST.format(u=url)})")


ORACLE = f"""
WITH RECURSIVE p AS (
  SELECT url, coalesce(html, '') AS html, regexp_extract(url, '^([^:]*)://', 1) AS scheme,
    {_host_sql("url")} AS host, {_path_sql("url")} AS path
  FROM pages WHERE strpos(url, '://') > 0
), raw AS (
  SELECT *, {_tag_sql("link", "\\brel\\s*=\\s*" + _Q + "canonical\\b", "\\bhref\\s*=\\s*" + _Q + "([^\"''\\s>]+)")} AS target FROM p
  UNION ALL
  SELECT *, {_tag_sql("meta", "\\bhttp-equiv\\s*=\\s*" + _Q + "refresh\\b", "\\burl\\s*=\\s*" + _Q + "([^\"''\\s>;]+)")} AS target FROM p
), told AS (
  SELECT DISTINCT url AS a, CASE WHEN strpos(target, '://') > 0 THEN target
    WHEN starts_with(target, '//') THEN scheme || ':' || target
    WHEN starts_with(target, '/') THEN scheme || '://' || host || target
    ELSE scheme || '://' || host || regexp_replace(path, '[^/]*$', '') || target END AS b
  FROM raw WHERE target IS NOT NULL
), edges AS (SELECT a, b FROM told WHERE a <> b UNION SELECT b, a FROM told WHERE a <> b),
reach AS (
  SELECT a AS node, a AS other FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
), alias AS (
  SELECT node, min(other) AS component, bool_or(coalesce(v = 'block', false)) AS blocked,
    bool_or(coalesce(v = 'allow', false)) AS allowed
  FROM (SELECT *, {_rules_sql(_host_sql("other"), _path_sql("other"), "verdict")} AS v FROM reach) GROUP BY node
), own AS (
  SELECT page_id, url, {_host_sql("coalesce(url, '')")} AS host, {_path_sql("coalesce(url, '')")} AS path FROM pages
)
SELECT page_id, host, path, {_rules_sql("host", "path", "rule")} AS "rule",
  coalesce({_rules_sql("host", "path", "verdict")}, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict,
  component
FROM own LEFT JOIN alias ON url = node
"""
