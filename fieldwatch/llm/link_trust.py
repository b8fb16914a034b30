"""Verdicts on urls: rules first, then trust and distrust that spread along the links between hosts.

A rule names a host, with all its subdomains, and the beginning of a path; the longest that fits a url judges it. Urls that no rule fits are judged by
their host. Every page that a rule allows makes its host a trusted seed, every page that a rule blocks a distrusted one, with equal weight a page.
Trust is a personalised PageRank from the trusted seeds along the links; distrust is one from the distrusted seeds along the reversed links, so
hosts that link to blocked pages share their blame. A host is blocked if its distrust is above ``threshold_percent`` of its trust, and
allowed otherwise; one that neither reaches is allowed.

Scores are whole numbers of millionths of a page and shares are rounded down, so results don't depend on the order of sums, and the rounds end early once
nothing changes. What a host without links receives goes nowhere. A round is one join of host scores with edges, both far smaller than the pages (edges
are counted before the shuffle), and a grouped sum; each is checkpointed, so a lost executor repeats one round at most. Html is
never shuffled. Pages meet the blocked hosts in ``SALTS`` parts of each host.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, and is allowed; empty hosts have no links. Null html has no links. Links are the
``href`` of ``a`` elements with a host of their own (``scheme://host`` or ``//host``); a host's links to itself don't count. Rows that repeat count
again and are judged alike; an empty table has no verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host and path), as the contract gives them.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: The host of an ``a`` element's link. No repeated part can run past the next angle bracket, so the scan is linear.
LINK = r"""(?i)<a[ \t\r\n\f](?:[^<>]*?[ \t\r\n\f])?href[ \t\r\n\f]*=[ \t\r\n\f]*["']?[ \t\r\n\f]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<> \t\r\n\f]+)"""
UNIT, DAMPING_PERCENT, ROUNDS, SALTS = 1_000_000, 85, 20, 16


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits columns host and path, as a struct of rule and verdict; null if none fits. Of equal rules the first counts."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, w): how many links pages of one host have to another."""
    to = F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1)))
    rows = pages.select(host(F.col("url")).alias("src"), to.alias("dst")).withColumn("dst", F.translate("dst", UPPER, LOWER))
    return rows.filter("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("w"))


def spread(links: DataFrame, seeds: DataFrame, damping_percent: int = DAMPING_PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, score) from seeds of the same form: along links for the kind trust, against them for distrust."""
    flows = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "w").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "w"))
    whole = flows.groupBy("kind", "host").agg(F.sum("w").alias("whole"))
    flows = checkpointed(flows.join(whole, ["kind", "host"]))
    start = checkpointed(seeds)
    base = start.select("kind", "host", F.expr(f"{100 - damping_percent} * score div 100").alias("score"))
    now, before = start, None
    for _ in range(rounds):
        moved = flows.join(now, ["kind", "host"]).select("kind", F.col("to").alias("host"), F.expr("cast(score AS decimal(20,0)) * cast(w AS decimal(18,0)) div whole").alias("score"))
        moved = moved.groupBy("kind", "host").agg(F.sum("score").alias("score")).select("kind", "host", F.expr(f"{damping_percent} * score div 100").alias("score"))
        now = checkpointed(moved.unionByName(base).groupBy("kind", "host").agg(F.sum("score").alias("score")).filter("score > 0"))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("kind", "host", "score").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    return now


def host_scores(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, damping_percent: int = DAMPING_PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """Every host that trust or distrust reaches: host, trust, distrust."""
    judged = pages.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).select("host", fitting_rule(rules)["verdict"].alias("verdict")).filter("verdict IS NOT NULL")
    kind = F.when(F.col("verdict") == "allow", "trust").otherwise("distrust")
    seeds = judged.groupBy(kind.alias("kind"), "host").agg((F.count("*") * UNIT).alias("score"))
    scores = spread(host_links(pages), seeds, damping_percent, rounds)
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0)).alias(k)
    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def verdicts(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, threshold_percent: int = 100, damping_percent: int = DAMPING_PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    blocked = host_scores(pages, rules, damping_percent, rounds).filter(F.col("distrust").cast("decimal(20,0)") * 100 > F.col("trust").cast("decimal(20,0)") * threshold_percent)
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).withColumn("__fits", fitting_rule(rules))
    rows = rows.select("page_id", "host", "path", F.col("__fits.rule").alias("rule"), F.col("__fits.verdict").alias("verdict"))
    spared = rows.filter("rule IS NULL").withColumn("__part", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)))
    parts = blocked.select("host", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("__part"), F.lit(True).alias("__blocked"))
    by_host = spared.join(parts, ["host", "__part"], "left").withColumn("verdict", F.when(F.col("__blocked"), "block").otherwise("allow"))
    return rows.filter("rule IS NOT NULL").unionByName(by_host.select(*rows.columns))


def _sql() -> str:
    """DuckDB SQL for verdicts(pages), a CTE a round."""
    rules = sorted(RULES, key=lambda r: -len(r[1]))
    cases = lambda value: " ".join(f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{value(v, r)}'" for v, r in rules)
    lower = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
    link, round_sql = LINK.replace("'", "''"), (
        "SELECT kind, host, sum(score)::HUGEINT AS score FROM (SELECT f.kind, f.dst AS host, {d} * sum(s.score * f.w // f.whole) // 100 AS score FROM flows f JOIN r{k} s ON s.kind = f.kind AND s.host = f.src "
        "GROUP BY f.kind, f.dst UNION ALL SELECT kind, host, {rest} * score // 100 FROM r0) GROUP BY kind, host HAVING sum(score) > 0"
    )
    steps = [f"r{k + 1} AS MATERIALIZED ({round_sql.format(k=k, d=DAMPING_PERCENT, rest=100 - DAMPING_PERCENT)})" for k in range(ROUNDS)]
    return f"""
WITH parsed AS MATERIALIZED (
    SELECT page_id, html, {lower("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
judged AS MATERIALIZED (SELECT page_id, host, path, CASE {cases(lambda v, r: r)} END AS rule, CASE {cases(lambda v, r: v)} END AS verdict FROM parsed),
links AS (SELECT src, dst, count(*) AS w FROM (SELECT host AS src, {lower(f"unnest(regexp_extract_all(html, '{link}', 1))")} AS dst FROM parsed) WHERE src <> '' AND src <> dst GROUP BY ALL),
both_ways AS (SELECT 'trust' AS kind, src, dst, w FROM links UNION ALL SELECT 'distrust', dst, src, w FROM links),
flows AS MATERIALIZED (SELECT *, sum(w) OVER (PARTITION BY kind, src)::HUGEINT AS whole FROM both_ways),
r0 AS MATERIALIZED (SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, (count(*) * {UNIT})::HUGEINT AS score FROM judged WHERE verdict IS NOT NULL GROUP BY ALL),
{", ".join(steps)},
hosts AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN score ELSE 0 END) AS trust, sum(CASE WHEN kind = 'distrust' THEN score ELSE 0 END) AS distrust FROM r{ROUNDS} GROUP BY host)
SELECT page_id, j.host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict WHEN h.distrust > h.trust THEN 'block' ELSE 'allow' END AS verdict FROM judged j LEFT JOIN hosts h ON h.host = j.host
"""


VERDICTS_SQL = _sql()
