"""URL verdicts from pattern rules that are indexed by their rarest literal token.

A rule is a pattern over a url's host and what follows it: ``||`` starts at a label of the
host, ``*`` stands for anything, ``^`` for a separator or the end, a closing ``|`` for the
end; all else is literal. Tokens are runs of ``a-z0-9``. A token of a rule counts only if
literal characters bound it, so it is a whole token of any url the rule fits. Each rule is
filed under the one of its tokens that fewest distinct urls hold; a url fetches the rules
filed under its tokens, and only these run their regular expressions. Rules without a
token are filed under the empty token, which every url has.

Of the rules that fit, the highest ``rank`` wins, then the longest name, then the last
name in order. Null urls and urls without ``://`` have an empty host and path and fit no
rule. Repeated rows get a row each; other columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendframe.session import cut_lineage

RULES = "name string, pattern string, verdict string, rank int"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    name: str
    pattern: str
    verdict: str
    rank: int = 0


#: Host and path rules come before pattern rules.
HOST_RULES = [
    Rule(host + path, f"||{host}{path}", verdict, 1)
    for host, path, verdict in [
        ("com", "/", "allow"),
        ("example.com", "/en/", "block"),
        ("www.example.com", "/en/", "allow"),
        ("net", "/es/", "block"),
        ("net", "/fr/", "block"),
    ]
]
#: Names of link farms and of adult, betting and drug advertising, at the start of a host label or as a path step.
PATTERN_RULES = [
    Rule(pattern, pattern, "block")
    for pattern in (
        "||spam-farm.",
        "||link-farm.",
        "||cheap-pills.",
        "||online-pharmacy.",
        "||free-bets.",
        "||online-casino.",
        "||porn-*.",
        "/casino/",
        "/porn/",
        "/viagra/",
    )
]


def rule_regex(pattern: str) -> str:
    """The regular expression of a pattern, to be found in host and rest."""
    body, lead, tail = pattern, "(?s)", ""
    if body.startswith("||"):
        body, lead = body[2:], r"(?s)^(?:[^/?#]*\.)?"
    if body.endswith("|"):
        body, tail = body[:-1], r"\z"
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|\z)"}
    return lead + "".join(parts.get(c) or re.escape(c) for c in body) + tail


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULES)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a filter list, one a line: ``@@`` before a pattern makes an exception, which wins over all blocks.

    Empty lines, comments (``!``) and headers (``[...]``) are left out, and so are lines that
    are no pattern over urls alone (see ``other_lines``). A pattern that occurs twice is one rule.
    """
    found = _lines(spark, path).filter("not other")
    allowed = F.startswith("line", F.lit("@@"))
    pattern = F.when(allowed, F.substring("line", 3, 2**31 - 1)).otherwise(F.col("line"))
    rules = found.select(F.col("line").alias("name"), pattern.alias("pattern"), F.when(allowed, "allow").otherwise("block").alias("verdict"), allowed.cast("int").alias("rank"))
    return rules.filter("pattern <> ''").distinct()


def other_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` of what ``read_rules`` can't use: options after ``$``, rules for page elements, regular expressions."""
    return _lines(spark, path).filter("other").select("line")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.btrim("value", F.lit(" \t\r")).alias("line"))
    plain = lines.filter("line <> '' and not startswith(line, '!') and not (startswith(line, '[') and endswith(line, ']'))")
    return plain.withColumn("other", F.col("line").rlike(r"#@?\??#|\$[a-z~]|^(?:@@)?/.*/$"))


def pattern_regex(pattern: Column) -> Column:
    """``rule_regex`` as an expression."""
    anchored, ended = F.startswith(pattern, F.lit("||")), F.endswith(pattern, F.lit("|"))
    body = F.when(anchored, F.substring(pattern, 3, 2**31 - 1)).otherwise(pattern)
    body = F.when(ended & (body != ""), F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    literal = F.regexp_replace(body, r"([^\p{L}\p{N}_*^])", r"\\$1")
    spelled = F.replace(F.replace(literal, F.lit("^"), F.lit(r"(?:[^A-Za-z0-9_.%-]|\z)")), F.lit("*"), F.lit(".*"))
    lead = F.when(anchored, F.lit(r"(?s)^(?:[^/?#]*\.)?")).otherwise(F.lit("(?s)"))
    return F.concat(lead, spelled, F.when(ended, F.lit(r"\z")).otherwise(F.lit("")))


def rule_tokens(pattern: Column) -> Column:
    """Tokens that any url the pattern fits holds whole: literal characters bound them."""
    low = F.translate(pattern, UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(low, F.lit("(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), 0))


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and all that follows the host."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = F.substring(after, F.length(raw) + F.lit(1), F.length(url))
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(rest, "^[^?#]*", 0), rest


def url_tokens(target: Column) -> Column:
    """Distinct tokens of a url, the empty one among them."""
    return F.array_union(F.array(F.lit("")), F.split(F.translate(target, UPPER, LOWER), "[^a-z0-9]+"))


def index_rules(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """``token, rank, size, name, verdict, regex``: each rule under its rarest token.

    How often the rules' tokens occur is counted over all urls.
    """
    own = rules.withColumn("tokens", rule_tokens(F.col("pattern")))
    wanted = cut_lineage(own.select("name", "pattern", F.explode("tokens").alias("token")))
    asked = wanted.select("token").distinct()
    counts = targets.select(F.explode(url_tokens(F.col("target"))).alias("token")).join(asked, "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rarity = F.struct(F.coalesce("urls", F.lit(0)), F.col("token"))
    rarest = wanted.join(cut_lineage(counts), "token", "left").groupBy("name", "pattern").agg(F.min_by("token", rarity).alias("token"))
    filed = rules.join(rarest, ["name", "pattern"], "left")
    return filed.select(F.coalesce("token", F.lit("")).alias("token"), "rank", F.length("name").alias("size"), "name", "verdict", pattern_regex(F.col("pattern")).alias("regex"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, matched`` (name of the winning rule)``, rank, verdict`` for every row.

    Rules (``name, pattern, verdict, rank``) may be few or millions: their index is written, so
    Spark knows its size when it plans the join.
    """
    host, path, rest = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), F.concat(host, rest).alias("target"))
    targets = parsed.select("target").distinct()
    index = cut_lineage(index_rules(targets, rules))
    won = F.max_by(F.struct("name", "rank", "verdict"), F.struct("rank", "size", F.col("name")))
    verdicts = (
        targets.select("target", F.explode(url_tokens(F.col("target"))).alias("token"))
        .join(index, "token")
        .filter(F.expr("target rlike regex"))
        .groupBy("target")
        .agg(won.alias("won"))
    )
    # written once, so that the join sees its size and can split a url that many rows share
    return parsed.join(cut_lineage(verdicts), "target", "left").select(
        "page_id",
        "host",
        "path",
        F.col("won.name").alias("matched"),
        F.col("won.rank").alias("rank"),
        F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
    )


def judge_pages(pages: DataFrame) -> DataFrame:
    """The dealt rules before the pattern rules; ``rule`` names a dealt rule only."""
    return filter_urls(pages, rule_table(pages.sparkSession, HOST_RULES + PATTERN_RULES)).select(
        "page_id",
        "host",
        "path",
        F.when(F.col("rank") == 1, F.col("matched")).alias("rule"),
        "verdict",
        F.when(F.col("rank") == 0, F.col("matched")).alias("pattern"),
    )


def _sql_regex(pattern: str) -> str:
    return rule_regex(pattern).replace("'", "''")


ORACLE_URLS = f"""
WITH base AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS after FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(after, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         substr(after, length(regexp_extract(after, '^[^/?#]*')) + 1) AS rest FROM base
), keyed AS (
  SELECT row_number() OVER () AS k, page_id, host, regexp_extract(rest, '^[^?#]*') AS path, host || rest AS target FROM parts
), rules(name, rank, verdict, regex) AS (
  VALUES {", ".join(f"('{r.name}', {r.rank}, '{r.verdict}', '{_sql_regex(r.pattern)}')" for r in HOST_RULES + PATTERN_RULES)}
), fits AS (
  SELECT k, name, rank, verdict, row_number() OVER (PARTITION BY k ORDER BY rank DESC, length(name) DESC, name DESC) AS place
  FROM keyed JOIN rules ON regexp_matches(target, regex)
)
SELECT page_id, host, path, CASE WHEN rank = 1 THEN name END AS rule, coalesce(verdict, 'allow') AS verdict,
       CASE WHEN rank = 0 THEN name END AS pattern
FROM keyed LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (k)
"""
