"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path``. ``*`` stands for any text, ``^`` for a
character that is no ASCII letter or digit, or for either end; a leading ``||``
ties the rest to the host or one of its subdomains and the pattern to the start.
A literal token is a run of letters and digits in a pattern with a border on
both sides, so that each URL the rule fits has it as a whole token. Tokens are
counted over all URLs; every rule is filed under its rarest one. The tokens of a
URL fetch the rules filed under them, and only these run their regular
expression. Rules without a token are candidates of every URL.

The rules are a parameter: a list, whose size is known. Their index is a local
table, which Spark broadcasts only below its own limit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TOKEN = "[A-Za-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``first`` rules are decided before the others; the longest name wins."""

    name: str
    pattern: str
    verdict: str
    first: bool = False

    def regex(self) -> str:
        body, start = self.pattern, ""
        if body.startswith("||"):
            body, start = body[2:], r"^(?:[^/]*\.)?"
        parts = {"*": "(?s:.)*", "^": "(?:[^A-Za-z0-9]|^|$)"}
        return start + "".join(parts.get(c) or re.escape(c) for c in body)

    def tokens(self) -> list[str]:
        body = self.pattern
        body = body[1:] if body.startswith("||") else "*" + body
        return re.findall(rf"(?<![A-Za-z0-9*]){TOKEN}(?![A-Za-z0-9*])", body + "*")


def host_rule(verdict: str, place: str) -> Rule:
    """A rule like ``example.com/en/``: a host with its subdomains, and the start of a path."""
    return Rule(place, f"||{place}", verdict, first=True)


# The rules that decide first.
HOST_RULES = [
    host_rule("allow", "com/"),
    host_rule("block", "example.com/en/"),
    host_rule("allow", "www.example.com/en/"),
    host_rule("block", "net/es/"),
    host_rule("block", "net/fr/"),
]

PATTERN_RULES = [Rule(p, p, "block") for p in (
    "^casino^", "^gambling^", "^bets^", "^poker^", "^adult^", "^porn^", "^xxx^", "^pills^", "^viagra^",
    "^spam^", "^malware^", "^phishing^", "^warez^", "^ads^track^", "^ad^click^*redirect^")] + [
    Rule(p, p, "allow") for p in ("^adult^education^", "^malware^analysis^", "^spam^filter^")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null URL or one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _tokens(subjects: DataFrame) -> DataFrame:
    found = F.array_distinct(F.regexp_extract_all("subject", F.lit(f"({TOKEN})"), 1))
    return subjects.select("subject", F.explode(found).alias("token"))


def rarest_tokens(subjects: DataFrame, rules: list[Rule]) -> dict[Rule, str | None]:
    """The literal token of each rule that fewest URLs have; None without any."""
    spark = subjects.sparkSession
    wanted = sorted({token for rule in rules for token in rule.tokens()})
    if not wanted:
        return dict.fromkeys(rules)
    words = spark.createDataFrame([(w,) for w in wanted], "token string")
    # At most one row per token of the rules.
    counts = {r["token"]: r["n"] for r in _tokens(subjects).join(words, "token")
              .groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {rule: min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default=None) for rule in rules}


def _index(spark: SparkSession, rarest: dict[Rule, str | None]) -> DataFrame:
    rows = [(token, r.name, r.verdict, r.first, r.regex()) for r, token in rarest.items()]
    return spark.createDataFrame(rows, "token string, name string, verdict string, first boolean, regex string")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          host_rules: list[Rule] = HOST_RULES, pattern_rules: list[Rule] = PATTERN_RULES,
          default: str = "allow") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, pattern.

    ``rule`` is the longest host rule that fits, else null; ``pattern`` the
    longest pattern rule, looked for only where no host rule fits, equal lengths
    by name. Without either the verdict is ``default``, also for null URLs.
    Repeated rows are judged each; other columns are not looked at. Each distinct
    host and path is judged once, so a URL that many rows share costs one row.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("subject", F.concat("host", "path"))
    subjects = urls.select("subject").distinct()
    index = _index(spark, rarest_tokens(subjects, [*host_rules, *pattern_rules]))
    candidates = _tokens(subjects).join(index, "token").drop("token")
    anywhere = index.filter(F.col("token").isNull()).drop("token")
    if any(not r.tokens() for r in [*host_rules, *pattern_rules]):
        # A bounded list of rules, carried by each URL as an array.
        listed = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, anywhere.columns)])
                  for row in anywhere.collect()]
        candidates = candidates.unionByName(
            subjects.select("subject", F.inline(F.array(*listed))))
    fits = candidates.filter(F.expr("subject rlike regex"))
    # Hash aggregation over sortable text: first rules, then length, then name from a to z.
    best = fits.groupBy("subject").agg(F.max(F.struct(
        "first", F.length("name").alias("length"), "name", "verdict")).alias("best"))
    return urls.join(best, "subject", "left").select(
        "page_id", "host", "path",
        F.when(F.col("best.first"), F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("best.first"), F.col("best.name")).alias("pattern"))


def judge_sql(host_rules: list[Rule] = HOST_RULES, pattern_rules: list[Rule] = PATTERN_RULES,
              default: str = "allow") -> str:
    """The same verdicts for DuckDB, every rule against every URL."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    values = ", ".join(f"({r.first}, {quoted(r.name)}, {quoted(r.verdict)}, {quoted(r.regex())})"
                       for r in [*host_rules, *pattern_rules])
    return f"""
        WITH rests AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT row_number() OVER () AS row_id, page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
        rules(is_first, name, verdict, regex) AS (VALUES {values}),
        fits AS (
            SELECT row_id, is_first, name, r.verdict,
                   row_number() OVER (PARTITION BY row_id ORDER BY is_first DESC, length(name) DESC, name DESC) AS k
            FROM parts, rules r WHERE regexp_matches(host || path, regex))
        SELECT page_id, host, path, CASE WHEN is_first THEN name END AS rule,
               coalesce(verdict, {quoted(default)}) AS verdict, CASE WHEN NOT is_first THEN name END AS pattern
        FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (row_id)"""
