"""URL filters: host and path rules, and trust and distrust propagated over the host graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href[ \t\r\n]*=[ \t\r\n]*["']?(?:https?:)?//([^/?#"'> \t\r\n]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``; A-Z lower-cased) and path (up to ``?``, ``#`` or the end) of a URL, else empty."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(length, rule, verdict) of the longest fitting (host, path, verdict) rule, else null; ties: the greater string."""
    known = F.array(*[F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("h"), F.lit(p).alias("p")) for h, p, v in rules])
    fits = F.filter(known, lambda r: ((host == r.h) | host.endswith(F.concat(F.lit("."), r.h))) & path.startswith(r.p))
    return F.array_max(fits)


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, from absolute ``href`` values of pages with column ``host``."""
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), 1)).alias("dst"))
    links = links.withColumn("dst", F.translate("dst", UPPER, LOWER)).where("src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = 20, tolerance: float = 1e-9) -> DataFrame:
    """(host, trust, distrust): personalised PageRank from seeds (host, trust, distrust).

    Trust follows links, distrust goes back along them; a host passes ``damping`` of what it gets on, in proportion to
    link counts, and keeps the rest. Mass that reaches a host without links ends there: sending it back to the seeds
    would scale all scores of a kind alike. Each round passes on only what the last one brought, up to ``rounds`` (what
    is left then is under damping^rounds of the seeds). With null ``rounds`` they end when a round reaches no host of
    its kind for the first time and what it brought is at most ``tolerance`` of the seeds. Rounds are written to the
    shared folder.
    """
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    total = both.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    both = materialize(both.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("share")), "host-edges")
    now = seeds.select("host", F.expr("stack(2, 'trust', cast(trust as double), 'distrust', cast(distrust as double)) as (kind, mass)")).where("mass > 0")
    parts, now = [], materialize(now, "seeds")
    any_edges = not both.isEmpty()
    parts.append(now)
    seen = now.select("host", "kind")
    least = tolerance * (now.agg(F.sum("mass")).first()[0] or 0.0) if rounds is None and any_edges else 0.0
    at = 0
    while any_edges and (rounds is None or at < rounds):
        at += 1
        now = now.join(both, ["kind", "host"]).groupBy(F.col("to").alias("host"), "kind").agg((damping * F.sum(F.col("mass") * F.col("share"))).alias("mass"))
        now = materialize(now.select("host", "kind", "mass"), "host-mass")
        if now.isEmpty():
            break
        parts.append(now)
        if rounds is None:
            new = now.join(seen, ["host", "kind"], "left_anti").select("host", "kind")
            if new.isEmpty():
                if now.agg(F.sum("mass")).first()[0] <= least:
                    break
            else:
                seen = materialize(seen.unionByName(new), "hosts-seen")
            if len(parts) > 16:  # keeps the plan short
                every = parts[0]
                for p in parts[1:]:
                    every = every.unionByName(p)
                parts = [materialize(every.groupBy("host", "kind").agg(F.sum("mass").alias("mass")), "host-sums")]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    mass = lambda k: (F.lit(1 - damping) * F.sum(F.when(F.col("kind") == k, F.col("mass")).otherwise(0.0))).alias(k)
    return every.groupBy("host").agg(mass("trust"), mass("distrust"))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], *, key: str = "page_id", url: str = "url", html: str = "html",
    damping: float = 0.85, rounds: int | None = 20, block_share: float = 0.75,
) -> DataFrame:
    """key, host, path, rule and verdict of every page, and its host's trust and distrust.

    ``rules`` (host, path, allow or block) decide where one fits: the longest. Their pages are the seeds: a host starts
    with as much trust as it has allowed pages and as much distrust as it has blocked ones, and both are propagated over
    the links between hosts. Other pages are blocked if distrust is at least ``block_share`` of their host's trust and
    distrust together, else allowed; hosts that nothing reaches are allowed.
    With null ``rounds`` propagation goes on until it has converged; ``sql`` stops after a number of rounds.

    ``rules`` are configuration, held in the plan. Null urls and ones without ``://`` have empty host and path, fit no
    rule and are allowed; null html has no links, long pages are read whole; repeated rows and null keys are judged like any other; an empty table
    gives an empty result; extra columns are ignored.
    """
    pages = tidy(pages, [key, url, html])
    host, path = host_path(F.col(url))
    named = pages.select(key, F.col(html).alias("html"), host.alias("host"), path.alias("path")).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    seeds = named.where("best is not null").groupBy("host").agg(
        F.count_if(F.col("best.verdict") == "allow").alias("trust"), F.count_if(F.col("best.verdict") == "block").alias("distrust"))
    scores = propagate(host_edges(named), seeds, damping, rounds)
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    blocked = (F.col("distrust") > 0) & (share >= block_share)
    out = named.drop("html").join(scores, "host", "left")
    verdict = F.when(F.col("best").isNotNull(), F.col("best.verdict")).when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow")
    return out.select(
        key, "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"),
        F.round(F.coalesce("trust", F.lit(0.0)), 6).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), 6).alias("distrust"),
    )


def sql(rules: list[tuple[str, str, str]], damping: float = 0.85, rounds: int = 20, block_share: float = 0.75) -> str:
    """DuckDB SQL for ``judge_urls`` over table ``pages``."""
    known = ", ".join(f"({len(h + p)}, '{h + p}', '{v}', '{h}', '{p}')" for h, p, v in rules)
    link = LINK.replace("'", "''")
    return f"""
WITH RECURSIVE rules(size, rule, verdict, h, p) AS (VALUES {known}),
rest AS (SELECT page_id, html, row_number() OVER () AS rid,
                CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
named AS (SELECT page_id, html, rid, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (SELECT rid, max({{'size': size, 'rule': rule, 'verdict': verdict}}) AS best FROM named, rules
         WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY rid),
seeds AS (SELECT host, count(*) FILTER (best.verdict = 'allow') AS trust, count(*) FILTER (best.verdict = 'block') AS distrust
          FROM named JOIN best USING (rid) GROUP BY host),
links AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM named WHERE host <> ''),
counted AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> dst GROUP BY src, dst),
both_ways AS (SELECT 'trust' AS kind, src AS host, dst AS dest, n FROM counted UNION ALL SELECT 'distrust', dst, src, n FROM counted),
edges AS (SELECT kind, host, dest, n / sum(n) OVER (PARTITION BY kind, host) AS share FROM both_ways),
mass(round, host, kind, mass) AS (
  SELECT 0, host, 'trust', CAST(trust AS DOUBLE) FROM seeds WHERE trust > 0
  UNION ALL SELECT 0, host, 'distrust', CAST(distrust AS DOUBLE) FROM seeds WHERE distrust > 0
  UNION ALL (SELECT m.round + 1, e.dest, m.kind, {damping} * sum(m.mass * e.share) FROM mass m JOIN edges e USING (kind, host)
             WHERE m.round < {rounds} GROUP BY m.round + 1, e.dest, m.kind)),
scores AS (SELECT host, {1 - damping} * sum(CASE WHEN kind = 'trust' THEN mass ELSE 0 END) AS trust,
                  {1 - damping} * sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END) AS distrust FROM mass GROUP BY host)
SELECT page_id, host, path, best.rule AS rule,
       CASE WHEN best IS NOT NULL THEN best.verdict
            WHEN distrust > 0 AND round(distrust / (trust + distrust), 9) >= {block_share} THEN 'block' ELSE 'allow' END AS verdict,
       round(coalesce(trust, 0), 6) AS trust, round(coalesce(distrust, 0), 6) AS distrust
FROM named LEFT JOIN best USING (rid) LEFT JOIN scores USING (host)"""
