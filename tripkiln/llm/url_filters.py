"""URL rules indexed by their rarest literal token.

A rule is ``host/path-prefix`` (``*`` stands for any run of characters of
the path); it fits its host and all subdomains of it. The rule's complete
alphanumeric runs are its literal tokens; it is indexed under the one that
the fewest URLs contain, counted over all URLs. A URL's tokens fetch the
candidate rules, and only those run their regular expressions. Everything is
DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkiln.llm.common import table

SEPARATORS = "[^A-Za-z0-9]+"
#: Larger rule lists are joined by Spark's own choice instead of a broadcast.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class UrlRule:
    rule: str
    verdict: str

    @property
    def pattern(self) -> str:
        host, slash, path = self.rule.partition("/")
        tail = ".*".join(re.escape(part) for part in (slash + path).split("*"))
        return rf"(?s)^(?:[^/]*\.)?{re.escape(host)}{tail}"

    @property
    def tokens(self) -> list[str]:
        """Alphanumeric runs that stand complete in every URL that fits: a run
        beside a ``*`` or at the rule's open end may go on there."""
        runs = re.finditer("[A-Za-z0-9]+", self.rule)
        open_ends = {len(self.rule)} | {i for i, c in enumerate(self.rule) if c == "*"}
        return sorted({m[0] for m in runs if m.end() not in open_ends and self.rule[m.start() - 1 : m.start()] != "*"})


def _a_to_z(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return _a_to_z(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    """(rule, verdict, pattern, tokens) as a DataFrame made of literals."""
    if not rules:
        return spark.range(0).select(
            *(F.lit("").alias(c) for c in ("rule", "verdict", "pattern")), F.array(F.lit("")).alias("tokens")
        )
    rows = [
        F.struct(
            F.lit(r.rule).alias("rule"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(r.pattern).alias("pattern"),
            (F.array(*map(F.lit, r.tokens)) if r.tokens else F.array().cast("array<string>")).alias("tokens"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(pages: DataFrame, rules: list[UrlRule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting rule wins (equal length: the smaller rule text); a
    URL that no rule fits gets a null rule and the ``default`` verdict. A null
    or malformed URL has an empty host and path, which fit no rule with a
    host. Every row is kept, repeated ones too; columns of these names that
    ``pages`` already has are replaced."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    keep = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    hot = (lambda df: F.broadcast(df)) if len(rules) <= BROADCAST_RULES else (lambda df: df)
    # work on distinct addresses: a page repeated a million times is judged once
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    urls = rows.select("host", "path").distinct()
    tokens = F.array_distinct(F.concat(F.split(F.concat("host", "path"), SEPARATORS), F.array(F.lit(""))))
    url_tokens = urls.select("host", "path", F.explode(tokens).alias("token"))

    listed = rule_table(spark, rules)
    # '' stands for "no literal": every URL carries it, so such rules always run
    rule_tokens = listed.select(
        "rule", "verdict", "pattern",
        F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"),
    )
    wanted = rule_tokens.select("token").distinct()
    counts = url_tokens.join(hot(wanted), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n_urls"))
    index = (
        rule_tokens.join(counts, "token", "left")
        .groupBy("rule", "verdict", "pattern")
        .agg(F.min_by("token", F.struct(F.coalesce("n_urls", F.lit(0)), F.col("token"))).alias("token"))
    )
    best = (
        url_tokens.join(hot(index), "token")
        .where(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.min(F.struct((-F.length("rule")).alias("order"), "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return rows.join(best, ["host", "path"], "left").select(
        *keep, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


RULES = [
    UrlRule("net/", "block"),
    UrlRule("example.net/en/", "allow"),
    UrlRule("example.com/de/", "block"),
    UrlRule("org/fr/", "allow"),
]


def query(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


ORACLE = """
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(rule, rhost, rpath, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fits AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (n)
"""
