"""URL filtering: host and path rules first, then trust and distrust propagated over the link graph of hosts.

Only DataFrame functions. Rules are configuration: a list of up to MAX_RULES becomes one CASE expression, a longer one a
table that meets the distinct hosts and paths by each suffix of a host. Hosts
that no rule decides get a verdict from personalised PageRank: trust flows along links from trusted seeds, distrust
flows against links from blocked seeds, and a host is blocked when its distrust exceeds its trust by a threshold. A host
takes distrust by the share of its own links, so the verdict doesn't depend on how many others link to a blocked host.

Defined cases: a url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed; a null html
has no links; repeated pages count as often as they occur; two rules of equal length that both fit: block wins.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, workspace

#: (verdict, rule); a rule is a host and a path prefix.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
MAX_RULES = 500
#: Share of a host's score that comes straight from its own seed weight, the rest from links.
RESTART = 0.15
ITERATIONS = 10
#: A host is blocked if distrust - trust is above this: without links, if over half of its pages are blocked by rules.
THRESHOLD = 0.5 * RESTART

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, most: int = MAX_RULES) -> DataFrame:
    """Pages (host, path, ...) with rule and verdict, by an expression or, for more than `most` rules, by a join."""
    if len(rules) <= most:
        return pages.withColumns(dict(zip(("rule", "verdict"), rule_of(F.col("host"), F.col("path"), rules))))
    table = pages.sparkSession.createDataFrame([(t.partition("/")[0], f"/{t.partition('/')[2]}", t, k) for k, t in rules], "rule_host string, prefix string, text string, kind string")
    places = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = places.withColumn("rule_host", F.explode(suffixes)).join(table, "rule_host").where(F.startswith("path", "prefix"))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("text").alias("n"), (F.col("kind") == "block").alias("block"), F.col("text").alias("rule"), F.col("kind").alias("verdict"))).alias("best"))
    return pages.join(best, ["host", "path"], "left").select(*pages.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): n links of src's pages to dst, from absolute and scheme-relative href and src attributes; src <> dst."""
    found = F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)), lambda h: F.translate(h, _UPPER, _LOWER))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    return links.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, iterations: int = ITERATIONS, restart: float = RESTART, by_linker: bool = False) -> DataFrame:
    """(host, trust, distrust) of the hosts in seeds (host, good, bad) and edges (src, dst, n).

    A step is trust(v) = restart * good(v) + (1 - restart) * sum over links u -> v of trust(u) * share of u's links, and
    the same against the links for distrust with each host's share of the links into v, or by_linker with v's share of
    the links out of each host. Hosts outside the graph keep restart * seed. Every fifth step is written to the shared folder, which bounds the plan and what a loss costs.
    """
    out = edges.groupBy(F.col("src").alias("s_")).agg(F.sum("n").alias("out"))
    into = edges.groupBy(F.col("dst").alias("d_")).agg(F.sum("n").alias("into"))
    shares = edges.join(out, F.col("src") == F.col("s_")).join(into, F.col("dst") == F.col("d_"))
    shares = materialize(shares.select("src", "dst", (F.col("n") / F.col("out")).alias("forth"), (F.col("n") / F.col("out" if by_linker else "into")).alias("back")), "host-edges")
    nodes = shares.select(F.col("src").alias("host")).union(shares.select("dst")).union(seeds.select("host")).distinct()
    base = nodes.join(seeds, "host", "left").select("host", (restart * F.coalesce("good", F.lit(0.0))).alias("trust"), (restart * F.coalesce("bad", F.lit(0.0))).alias("distrust"))
    if shares.isEmpty():  # every sum over links is empty, so each step gives the first one again
        return base
    base = score = materialize(base, "host-seeds")
    for step in range(1, iterations + 1):
        forth = shares.join(score, F.col("src") == F.col("host")).select(F.col("dst").alias("host"), (F.col("trust") * F.col("forth")).alias("t"), F.lit(0.0).alias("d"))
        back = shares.join(score, F.col("dst") == F.col("host")).select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d"))
        flow = forth.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        score = base.join(flow, "host", "left").select("host", *((F.col(c) + (1 - restart) * F.coalesce(c[0], F.lit(0.0))).alias(c) for c in ("trust", "distrust")))
        if step % 5 == 0 and step < iterations:
            score = materialize(score, "host-scores")
    return score


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, iterations: int = ITERATIONS) -> DataFrame:
    """Pages with host, path, rule, verdict, trust and distrust in place of columns of those names."""
    with workspace() as w:
        host, path = host_and_path(F.col("url"))
        named = pages.drop("host", "path", "rule", "verdict", "trust", "distrust").withColumns({"host": host, "path": path})
        named = with_rules(named, rules)
        seeds = named.where("host <> ''").groupBy("host").agg(*(F.avg((F.coalesce("verdict", F.lit("")) == k).cast("double")).alias(c) for k, c in (("allow", "good"), ("block", "bad"))))
        seeds = materialize(seeds, "host-shares")
        score = propagate(host_edges(named), seeds, iterations, by_linker=True)
        score = score.select("host", F.round("trust", 12).alias("trust"), F.round("distrust", 12).alias("distrust"))
        judged = named.drop("html").join(score, "host", "left")
        by_method = F.when(F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) > THRESHOLD, "block").otherwise("allow")
        return w.result(judged.withColumn("verdict", F.coalesce("verdict", by_method)), "verdicts")


def oracle() -> str:
    """The same in DuckDB's SQL, each step of the propagation a common table expression.

    It shares distrust out over a host's in-links, which judge() no longer does: both agree where hosts don't link to others.
    """
    link = LINK.replace("'", "''")
    cases = lambda pick: " ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{pick(k, t)}'" for k, t in sorted(RULES, key=lambda r: -len(r[1])) for h, p in [re.match(r"([^/]*)/(.*)", t).groups()])
    steps = ["s0 AS MATERIALIZED (SELECT * FROM base)"]
    for i in range(1, ITERATIONS + 1):
        steps.append(
            f"s{i} AS MATERIALIZED (SELECT b.host, b.trust + {1 - RESTART} * coalesce(t, 0) AS trust, b.distrust + {1 - RESTART} * coalesce(d, 0) AS distrust FROM base b"
            f" LEFT JOIN (SELECT dst AS host, sum(s.trust * forth) AS t FROM shares JOIN s{i - 1} s ON src = s.host GROUP BY 1) f ON f.host = b.host"
            f" LEFT JOIN (SELECT src AS host, sum(s.distrust * back) AS d FROM shares JOIN s{i - 1} s ON dst = s.host GROUP BY 1) g ON g.host = b.host)"
        )
    return f"""
WITH cut AS (SELECT page_id, html, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
named AS (SELECT page_id, html, translate(coalesce(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2), '') AS path FROM cut),
ruled AS (SELECT *, CASE {cases(lambda k, t: t)} END AS rule, CASE {cases(lambda k, t: k)} END AS said FROM named),
edges AS (SELECT src, dst, count(*) AS n FROM (SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), '{_UPPER}', '{_LOWER}') AS dst FROM ruled WHERE host <> '') WHERE src <> dst GROUP BY 1, 2),
shares AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS forth, n / sum(n) OVER (PARTITION BY dst) AS back FROM edges),
seeds AS (SELECT host, avg(CASE WHEN said = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS good, avg(CASE WHEN said = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS bad FROM ruled WHERE host <> '' GROUP BY 1),
nodes AS (SELECT src AS host FROM shares UNION SELECT dst FROM shares UNION SELECT host FROM seeds),
base AS MATERIALIZED (SELECT nodes.host, {RESTART} * coalesce(good, 0) AS trust, {RESTART} * coalesce(bad, 0) AS distrust FROM nodes LEFT JOIN seeds USING (host)),
{", ".join(steps)}
SELECT page_id, ruled.host, path, rule, coalesce(said, CASE WHEN coalesce(round(distrust, 12) - round(trust, 12), 0) > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN s{ITERATIONS} s ON s.host = ruled.host
"""
