"""URL filters: rules first, then link-graph propagation for what no rule decides.

Rules have a host, a path and a verdict; one fits its host and all subdomains if the url's path starts with the rule's.
The longest fitting rule (host + path) decides; of equally long ones that with the longer host, then the smaller one.

Pages that no rule decides get the verdict of their host, from the host graph (a link from host a to host b for each
absolute href of a page of a; links within a host do not count):

* trust starts at the hosts with pages that a rule allows and follows the links, distrust starts at those with pages
  that a rule blocks and follows the links backwards (who links to bad hosts is suspect). Both are personalised PageRank
  sums: each round passes ``DAMPING`` of what a host received on to its neighbours, in proportion to the links, and what
  a host receives over all rounds, its own seed included, is its trust T or distrust D. The seeds are numbers of pages.
* a host is blocked if D >= ``THRESHOLD`` * (T + D + U), where U is the number of its undecided pages: unless distrust
  makes up half of what is known, it is allowed. Both sides are rounded to 9 decimals, so the order of sums is no matter.

Rounds end when what is left to pass on is below ``TOLERANCE`` of the seeds (by the damping alone: a fixed number), or
when nobody receives anything. Everything is DataFrame functions: no Python touches a row.

Hot keys: links are added up per pair of hosts with partial aggregation. Each host's links are dealt into chunks of
about ``CHUNK`` by a hash of the neighbour, and the round's join is on (host, chunk), so a host with links to a third
of all hosts fills many tasks; what a host receives is a partially aggregated sum. Pages meet the hosts' verdicts by
``skew.left_join``, so a host with a third of all pages is not moved. The rules are a short list of the program, part of
the plan.

A url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed; such pages and targets
without a host are not in the graph. Null html has no links. Rows that repeat a page_id, or have none, are judged each.
An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import stored, table
from .skew import left_join

DAMPING, TOLERANCE, THRESHOLD, CHUNK = 0.7, 0.01, 0.5, 10_000
ROUNDS = math.ceil(math.log(TOLERANCE * (1 - DAMPING)) / math.log(DAMPING))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An absolute link, with or without a scheme; its host as in a url.
_S = r"[\x20\x09-\x0D]"
LINK = rf"""{_S}[hH][rR][eE][fF]{_S}*+={_S}*+["']?+{_S}*+(?:[A-Za-z][A-Za-z0-9+.-]*+:)?//([^/?#"'<>\x20\x09-\x0D]++)"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: Fixed values of the contract.
RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def located(pages: DataFrame, url: str = "url") -> DataFrame:
    """Replace ``url`` by ``host`` and ``path``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substr({url}, length(substring_index({url}, '://', 1)) + 4)")).otherwise("")
    pages = pages.withColumn(url, F.coalesce(rest, F.lit("")))
    return (pages.withColumn("host", F.translate(F.regexp_extract(url, "^[^/?#]*", 0), UPPER, LOWER))
            .withColumn("path", F.regexp_extract(url, "^[^/?#]*([^?#]*)", 1)).drop(url))


def decided(rules: list[Rule], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The deciding rule (as host + path) and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), tuple(-ord(c) for c in r.host + r.path))):
        fits = (((F.col(host) == r.host) | F.endswith(F.col(host), F.lit("." + r.host))) & F.startswith(F.col(path), F.lit(r.path))
                & (F.col(host) != ""))
        name, verdict = F.when(fits, F.lit(r.host + r.path)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts; ``pages`` has host, html."""
    targets = F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda x: F.translate(x, UPPER, LOWER))
    return (pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(targets).alias("dst")).where("src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, chunk: int = CHUNK) -> DataFrame:
    """host, trust, distrust of all hosts that receive any. ``edges``: src, dst, n; ``seeds``: host, trust, distrust."""
    node = lambda kind, host: F.concat(F.lit(kind + ":"), F.col(host)).alias("node")
    ways = stored(edges.select(node("t", "src"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(node("d", "dst"), F.col("src").alias("to"), "n")), "url-ways")
    nodes = stored(ways.groupBy("node").agg(F.sum("n").alias("out"), F.ceil(F.count("*") / chunk).cast("int").alias("chunks")), "url-nodes")
    ways = stored(left_join(ways, nodes.where("chunks > 1").select("node", "chunks"), "node")
                  .withColumn("chunk", F.pmod(F.xxhash64("to"), F.coalesce("chunks", F.lit(1))).cast("int")).drop("chunks"), "url-chunks")
    seed = lambda kind, c: seeds.select(node(kind, "host"), F.col(c).cast("double").alias("mass")).where("mass > 0")
    now = stored(seed("t", "trust").unionByName(seed("d", "distrust")), "url-mass")
    received = [now]
    for _ in range(rounds):
        sent = now.join(nodes, "node").select("node", (F.col("mass") * damping / F.col("out")).alias("share"),
                                              F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
        now = stored(sent.join(ways, ["node", "chunk"]).groupBy(F.substring("node", 1, 2).alias("kind"), "to")
                     .agg(F.sum(F.col("share") * F.col("n")).alias("mass")).select(F.concat("kind", "to").alias("node"), "mass"), "url-mass")
        if now.isEmpty():
            break
        received.append(now)
    total = received[0]
    for x in received[1:]:
        total = total.unionByName(x)
    mass = lambda kind, name: F.sum(F.when(F.startswith("node", F.lit(kind)), F.col("mass")).otherwise(0.0)).alias(name)
    return total.groupBy(F.expr("substr(node, 3)").alias("host")).agg(mass("t:", "trust"), mass("d:", "distrust"))


def host_verdicts(pages: DataFrame, html: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """host, host_verdict of every host of ``pages`` (host, verdict of a rule or null); ``html`` has host, html."""
    count = lambda c, name: F.count_if(c).alias(name)
    hosts = stored(pages.where("host <> ''").groupBy("host").agg(
        count(F.col("verdict") == "allow", "trust"), count(F.col("verdict") == "block", "distrust"),
        count(F.col("verdict").isNull(), "undecided")), "url-hosts")
    mass = propagate(links(html), hosts).withColumnRenamed("trust", "t").withColumnRenamed("distrust", "d")
    known = hosts.join(mass, "host", "left").select("host", "undecided", F.coalesce("t", F.lit(0.0)).alias("t"), F.coalesce("d", F.lit(0.0)).alias("d"))
    bad = (F.col("d") > 0) & (F.round("d", 9) >= F.round((F.col("t") + F.col("d") + F.col("undecided")) * threshold, 9))
    return known.select("host", F.when(bad, "block").otherwise("allow").alias("host_verdict"))


def judge(pages: DataFrame, rules: list[Rule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict and by (rule or links) of ``pages`` (page_id, url, html)."""
    name, verdict = decided(rules)
    judged = stored(located(pages.select("page_id", "url")).withColumn("rule", name).withColumn("verdict", verdict), "url-pages")
    hosts = host_verdicts(judged, located(pages.select("url", "html")), threshold)
    open_ = judged.where("verdict is null")
    done = judged.where("verdict is not null").withColumn("by", F.lit("rule"))
    rest = left_join(open_, hosts, "host").withColumn("verdict", F.coalesce("host_verdict", F.lit("allow"))).drop("host_verdict")
    return done.unionByName(rest.withColumn("by", F.lit("links")))


def op13_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, the deciding rule and the verdict of the rule or else of the host's links."""
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


_FITS = [(f"{r.host}{r.path}", r.verdict, f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')")
         for r in sorted(RULES, key=lambda r: -len(r.host + r.path))]

#: The same in SQL.
SQL = f"""
WITH RECURSIVE u AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
 v AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
 w AS (SELECT *, CASE {' '.join(f"WHEN {c} THEN '{n}'" for n, _, c in _FITS)} END AS rule,
              CASE {' '.join(f"WHEN {c} THEN '{x}'" for _, x, c in _FITS)} END AS ruled FROM v),
 h AS (SELECT host, COUNT(*) FILTER (WHERE ruled = 'allow') AS t, COUNT(*) FILTER (WHERE ruled = 'block') AS d,
              COUNT(*) FILTER (WHERE ruled IS NULL) AS u FROM w WHERE host <> '' GROUP BY host),
 l AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{LINK.replace("*+", "*").replace("++", "+").replace("?+", "?").replace("'", "''")}', 1)), '{UPPER}', '{LOWER}') AS dst
       FROM w WHERE host <> ''),
 e AS (SELECT src, dst, COUNT(*) AS n FROM l WHERE src <> dst GROUP BY src, dst),
 k AS (SELECT 'trust' AS kind, src, dst, n / SUM(n) OVER (PARTITION BY src) AS share FROM e UNION ALL
       SELECT 'distrust', dst, src, n / SUM(n) OVER (PARTITION BY dst) FROM e),
 m AS (SELECT 0 AS round, 'trust' AS kind, host, CAST(t AS DOUBLE) AS mass FROM h WHERE t > 0 UNION ALL
       SELECT 0, 'distrust', host, CAST(d AS DOUBLE) FROM h WHERE d > 0),
 r AS (SELECT * FROM m UNION ALL
       SELECT r.round + 1, r.kind, k.dst, SUM(r.mass * {DAMPING} * k.share) FROM r JOIN k ON k.kind = r.kind AND k.src = r.host
       WHERE r.round < {ROUNDS} GROUP BY r.round, r.kind, k.dst),
 s AS (SELECT host, coalesce(SUM(mass) FILTER (WHERE kind = 'trust'), 0) AS t, coalesce(SUM(mass) FILTER (WHERE kind = 'distrust'), 0) AS d
       FROM r GROUP BY host),
 b AS (SELECT h.host, s.d > 0 AND round(s.d, 9) >= round((s.t + s.d + h.u) * {THRESHOLD}, 9) AS bad FROM h JOIN s USING (host))
SELECT w.page_id, w.host, w.path, w.rule, coalesce(w.ruled, CASE WHEN b.bad THEN 'block' ELSE 'allow' END) AS verdict
FROM w LEFT JOIN b USING (host)
"""
