"""URL filter with redirect equivalence.

Addresses that redirect to each other, or name each other as their canonical
link, are one document under several names.  Edges come from the pages' own html
(``<link rel=canonical>``, ``<meta http-equiv=refresh>``) and, where a crawl has
them, from a table of redirects (src, dst).  Connected components over the edges
carry the rules' decisions from one name to all others:

* an address that a rule fits has that rule's verdict;
* any other address is blocked if its component holds a blocked address and no
  explicitly allowed one, and allowed otherwise.

A node is an address without its fragment, scheme and A-Z of the host in lower case,
an empty path read as ``/``.  Edges, not pages, go through the components; a node
is carried as its md5, so long addresses cost no more than short ones.

Rules are a table (host, path, verdict).  A rule fits its host and all subdomains
where the address's path starts with the rule's; the longest (host and path
together; then the longer host) wins.  Every address is held against the rules by
an equi-join on its host's suffixes and the prefixes of its path of those lengths
that occur among the rules, so lists of any size work; the planner broadcasts short ones.

Null addresses and those without ``://`` have an empty host and path, no rule and no
edges, and are allowed.  Null, empty and very long html is searched whole, in linear time.
Repeated rows come back as often as they stand there; ties among rules of equal
text go to allow.  An empty table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import html as _html
import re
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import connected_components, map_rows, materialise

#: The contract's policy: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
RULES_SCHEMA = "host string, path string, verdict string"


# ------------------------------------------------------------------ addresses
def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """md5 of the address as a node; null where there is no ``://``."""
    scheme = _ascii_lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    whole = F.concat(scheme, F.lit("://"), host_of(url), path, query)
    return F.when(F.contains(url, F.lit("://")), F.md5(whole.cast("binary")))


# ------------------------------------------------------------------ edges
_OPENING = re.compile(r"<(?:(!--)|(script|style|textarea|title|template|link|meta|base)(?=[\s/>]))", re.I)
_RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style", "textarea", "title", "template")}
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)?))?|(=))""")
_REFRESH = re.compile(r"\s*[\d.]+\s*[;,\s]\s*(?:url\s*=\s*)?(.*)", re.I | re.S)


def _attributes(html: str, at: int) -> tuple[dict, int]:
    """Attributes of the tag whose name ends at ``at``, and the place after it
    (-1: the tag is never closed)."""
    found: dict = {}
    while True:
        m = _ATTRIBUTE.match(html, at)
        if not m or m.end() == at:
            return found, -1
        at = m.end()
        if m[1]:
            return found, at
        if m[2]:
            value = next((v for v in m.group(3, 4, 5) if v is not None), "")
            found.setdefault(m[2].lower(), _html.unescape(value))


def targets(url: str | None, html: str | None) -> list[str]:
    """Absolute addresses that a page names as canonical or sends its reader to."""
    out, base, at, html = [], url or "", 0, html or ""
    while m := _OPENING.search(html, at):
        if m[1]:
            end = html.find("-->", m.end())
            if end < 0:
                break
            at = end + 3
            continue
        name = m[2].lower()
        attributes, at = _attributes(html, m.end())
        if at < 0:
            break
        if name in _RAW:
            close = _RAW[name].search(html, at)
            if not close:
                break
            at = close.end()
        elif name == "base":
            base = _join(base, attributes.get("href", ""))
        elif name == "link" and "canonical" in attributes.get("rel", "").lower().split():
            out.append(_join(base, attributes.get("href", "")))
        elif name == "meta" and attributes.get("http-equiv", "").strip().lower() == "refresh":
            to = _REFRESH.match(attributes.get("content", ""))
            out.append(_join(base, to[1].strip().strip("\"'")) if to and to[1].strip() else "")
    return [x for x in dict.fromkeys(out) if "://" in x and x != url]


def _join(base: str, href: str) -> str:
    try:
        return urljoin(base, href.strip()) if href.strip() else base
    except ValueError:  # not an address at all
        return base


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) addresses of the canonical links and redirects in ``pages``.  Only
    pages that hold one of the two words leave the JVM."""
    told = pages.select(F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")).where(
        F.contains("url", F.lit("://")) & F.col("html").rlike("(?i)canonical|refresh"))

    def run(batches):
        for b in batches:
            found = [(u, t) for u, h in zip(b["url"], b["html"]) for t in targets(u, h)]
            yield {"src": [u for u, _ in found], "dst": [t for _, t in found]}

    return map_rows(told, run, "src string, dst string")


# ------------------------------------------------------------------ rules
def fit_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) for the distinct ``urls`` (url) that a rule fits."""
    known = (rules.select(_ascii_lower(F.coalesce("host", F.lit(""))).alias("host"),
                          F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))  # allow before block
             .select(F.concat("host", "path").alias("rule"), "verdict",
                     F.struct("host", "path").alias("key"), F.length("host").alias("host_length")))
    lengths = sorted(r[0] for r in known.select(F.length("key.path")).distinct().collect())  # one per length
    split = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]),
                        lambda p: p.isNotNull())
    asked = (split.where(F.col("host") != "").distinct()
             .select("url", "path", F.explode(F.array_distinct(suffixes)).alias("host"))
             .select("url", F.explode(F.transform(
                 prefixes, lambda p: F.struct(F.col("host").alias("host"), p.alias("path")))).alias("key")))
    best = F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict")
    return (asked.join(known, "key").groupBy("url").agg(F.max(best).alias("best"))
            .select("url", "best.rule", "best.verdict"))


# ------------------------------------------------------------------ verdicts
def blocked_aliases(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """(node) of every address in a component that holds a blocked and no allowed one."""
    ends = edges.select(F.col("src").alias("url")).unionByName(edges.select(F.col("dst").alias("url"))).distinct()
    named = ends.join(fit_rules(ends, rules), "url").select(node_of(F.col("url")).alias("node"), "verdict")
    pairs = edges.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")).dropna()
    groups = connected_components(pairs, "redirects")
    verdicts = (groups.join(named, "node").groupBy("component")
                .agg(F.bool_or(F.col("verdict") == "allow").alias("allowed")))  # named ones only
    return groups.join(verdicts.where("NOT allowed"), "component", "left_semi").select("node")


def judge(pages: DataFrame, rules: DataFrame | None = None, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``."""
    spark = pages.sparkSession
    rules = default_rules(spark) if rules is None else rules
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("src", "dst"))
    edges = materialise(edges.distinct(), "redirect-edges")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    ruled = fit_rules(rows.select("url"), rules)
    blocked = blocked_aliases(edges, rules).withColumn("blocked", F.lit(True))
    return (rows.join(ruled, "url", "left").withColumn("node", node_of(F.col("url")))
            .join(blocked, "node", "left")
            .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
                    F.coalesce("verdict", F.when(F.col("blocked"), F.lit("block")), F.lit("allow")).alias("verdict")))


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULES_SCHEMA)


#: The same verdicts in SQL, for links written as the test tables write attributes:
#: double quotes, rel before href, absolute addresses.
ORACLE_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
         regexp_replace(url, '#.*', '', 's') AS node
  FROM pages),
policy(rule_host, rule_path, decision) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
ruled AS (
  SELECT p.page_id, rule_host || rule_path AS rule, decision,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM p JOIN policy ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
judged AS (
  SELECT p.*, r.rule, r.decision FROM p LEFT JOIN ruled r ON r.page_id = p.page_id AND r.place = 1),
link AS (
  SELECT node AS a, regexp_replace(unnest(regexp_extract_all(html, '<link rel="canonical" href="([^"]*)"', 1)),
                                   '#.*', '', 's') AS b FROM p),
near AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b),
alias AS (
  SELECT r.a AS node, bool_or(j.decision = 'block') AND NOT bool_or(j.decision = 'allow') AS blocked
  FROM reach r JOIN judged j ON j.node = r.b WHERE j.decision IS NOT NULL GROUP BY r.a)
SELECT page_id, host, path, rule,
       coalesce(decision, CASE WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM judged LEFT JOIN alias USING (node)
"""
