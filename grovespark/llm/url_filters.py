"""URL filters: rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with its literal tokens (letter and digit runs that any url it
fits must hold whole). Of each rule the token that the fewest urls hold is its index token; the tokens of a url fetch
the rules that are indexed under them, and only those rules' regular expressions run. Rules without a literal token
stand under the empty token, which every url has.

Host and path: the host follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path
follows up to ``?``, ``#`` or the end. A url that is null or has no ``://`` has an empty host and path and no rule fits it.

Two kinds of rules: *site* rules (a host with all its subdomains and the start of a path; the longest that fits wins,
ties to the longer host, then to block) decide first; then *pattern* rules (block if one fits); else allow.
Repeated rows and ids keep a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace, ascii_lower, spread_join, table

SITE_RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Words that block a host with them as a whole label or part between hyphens.
SPAM_WORDS = ("casino", "bets", "pills", "porn", "viagra", "warez")
#: Pattern rules of the query: mirrors and printed copies of some sections.
PATTERNS = ("|m.*.example.org/fr/*.html|", "|blog.*.example.net/es/", "||example.com/fr/*/|", "|www.*.example.org/de/*.html|", "||example.net/fr/9*.html|")

RULE_SCHEMA = "rule string, action string, kind string, length int, host_length int, regex string, tokens array<string>"


def pattern_rule(pattern: str) -> tuple:
    """A rule over host and path: ``|`` at the ends is the start of the host and the end of the path, ``||`` the start of any of
    the host's labels, ``*`` any characters, ``^`` a character other than letters, digits, ``_-.%`` or the end.

    A run of letters and digits is a token of the rule if on both sides it meets a literal other than those, a separator or an anchor.
    """
    body, regex = pattern, ""
    if body.startswith("||"):
        body, regex = body[2:], r"^([^/]*\.)?"
    elif body.startswith("|"):
        body, regex = body[1:], "^"
    end = body.endswith("|")
    body = body.removesuffix("|")
    inner = "".join({"*": ".*", "^": r"([^A-Za-z0-9_.%-]|$)"}.get(c, re.escape(c)) for c in body)
    closed = ("/" if regex else "*") + body.replace("^", "/") + ("/" if end else "*")
    tokens = [m.group(1) for m in re.finditer(r"(?<=[^A-Za-z0-9*])([A-Za-z0-9]+)(?=[^A-Za-z0-9*])", closed)]
    return pattern, "block", "pattern", len(pattern), 0, f"{regex}{inner}{'$' if end else ''}", tokens


def site_rule(action: str, rule: str) -> tuple:
    """A host and the start of a path, such as ``example.com/en/``. Its last path token counts as literal only if it is closed."""
    host, slash, path = rule.partition("/")
    path = slash + path
    tokens = re.findall("[a-z0-9]+", host) + re.findall("[A-Za-z0-9]+(?=[^A-Za-z0-9])", path)
    return rule, action, "site", len(rule), len(host), rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}", tokens


def word_rule(word: str) -> tuple:
    """Blocks hosts that hold ``word`` as a whole token."""
    return f"host:{word}", "block", "pattern", len(word), 0, rf"^[^/]*(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])[^/]*(/|$)", [word]


def rules(spark: SparkSession, sites: Sequence[tuple[str, str]] = SITE_RULES, words: Sequence[str] = SPAM_WORDS, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    return spark.createDataFrame([site_rule(*r) for r in sites] + [word_rule(w) for w in words] + [pattern_rule(x) for x in patterns], RULE_SCHEMA)


def parts(url):
    """(host, path) columns of a url column."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(urls: DataFrame, rule_table: DataFrame) -> DataFrame:
    """Distinct (host, path) of ``urls`` with ``rule`` and ``verdict``."""
    host, path = parts(F.col("url"))
    # The parts alone decide; urls that differ in query or fragment are judged once.
    sites = urls.select(host.alias("host"), path.alias("path")).distinct()
    tokens = F.array_distinct(F.array_union(F.split("host", "[^a-z0-9]+"), F.array_union(F.split("path", "[^A-Za-z0-9]+"), F.array(F.lit("")))))
    held = sites.select("host", "path", F.explode(tokens).alias("token"))
    literal = rule_table.select("rule", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    # How many urls hold each token that some rule names; a rule's tokens no url holds count 0 and so are rarest.
    frequency = held.join(literal.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    index = literal.join(frequency, "token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).getField("token").alias("token"))
    fetched = held.join(rule_table.join(index, "rule").drop("tokens"), "token").where(F.expr("concat(host, path) rlike regex"))
    order = F.struct(F.col("kind") == "site", "length", "host_length", F.col("action") == "block", "rule")
    best = fetched.groupBy("host", "path").agg(F.max(F.struct(order.alias("o"), F.when(F.col("kind") == "site", F.col("rule")).alias("rule"), F.col("action").alias("verdict"))).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rule_table: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict of every row."""
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    # Only parts that some rule fits are joined back; one that many pages share is dealt to many tasks.
    found = Workspace(pages.sparkSession, "urls").save(judge(pages, rule_table), "judged")
    return spread_join(rows, found, ["host", "path"], "left", by=["page_id"]).select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rules(spark))


ORACLE = r"""
WITH r(action, rule) AS (VALUES ('block','com/en/'), ('allow','example.com/en/7'), ('allow','net/de/'), ('block','example.net/de/8'), ('block','org/es/')),
p AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM q JOIN r ON (host = split_part(rule, '/', 1) OR suffix(host, '.' || split_part(rule, '/', 1)))
                   AND starts_with(path, substr(rule, strpos(rule, '/')))
      GROUP BY page_id, host, path)
SELECT q.page_id, q.host, q.path, m.rule,
       coalesce(m.action, CASE WHEN regexp_matches(q.host, '(^|[^a-z0-9])(casino|bets|pills|porn|viagra|warez)([^a-z0-9]|$)') OR {patterns}
                           THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN m USING (page_id, host, path)
""".replace("{patterns}", " OR ".join(f"regexp_matches(q.host || q.path, '{pattern_rule(x)[5]}')" for x in PATTERNS))
