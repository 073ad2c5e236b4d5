"""URL filter: pattern rules found through their rarest literal token.

A rule is a pattern text with an action and a priority. Its literal tokens are the letter-digit
runs that a match must show as whole tokens. Over all given URLs the tokens of the rules are
counted, and each rule is indexed under its least frequent one, so a URL looks up few rules. The
tokens of a URL fetch its candidates, and only their regular expressions run.

Patterns: `*` any text, `^` a separator or the end, `||` a host or any of its subdomains,
other characters themselves. A path rule `host/path` is the pattern `||host/path`.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The index travels inside the plan up to so many rules; more are joined as a table.
INLINE_RULES = 2000


@dataclass(frozen=True)
class Rule:
    """`name` is what the result shows; a greater `priority` wins, then the smaller name.

    `part` is what the pattern is matched against: "path" is host and path, "url" all after
    `://`, its host in lower case.
    """

    name: str
    pattern: str
    action: str
    priority: int
    part: str = "url"


def path_rule(action: str, text: str) -> Rule:
    """`host/path`: fits the host and its subdomains when the path starts with the rule's."""
    return Rule(text, f"||{text}", action, 1_000_000 + len(text), "path")


# Fixed values of the query: host and path rules, the longest wins.
PATH_RULES = (
    path_rule("block", "net/"),
    path_rule("allow", "example.net/en/"),
    path_rule("block", "example.com/de/"),
    path_rule("allow", "org/fr/"),
)
# Pages without prose of their own, by the address alone.
PATTERN_RULES = (
    Rule("^login^", "^login^", "block", 10),
    Rule("^signin^", "^signin^", "block", 10),
    Rule("^cart^", "^cart^", "block", 10),
    Rule("^checkout^", "^checkout^", "block", 10),
    Rule("/tag/*page=", "/tag/*page=", "block", 10),
    Rule("||ads.*/click^", "||ads.*/click^", "block", 10),
    Rule("||doubleclick.example^", "||doubleclick.example^", "block", 10),
    Rule("^help^login^", "^help^login^", "allow", 20),
)


def regex_of(pattern: str) -> str:
    """The Java regular expression of a pattern, to be searched for."""
    body, out = pattern, ""
    if body.startswith("||"):
        out, body = r"\A(?:[^/?#]*\.)?", body[2:]
    for char in body:
        if char == "*":
            out += r"[\s\S]*"
        elif char == "^":
            out += r"(?:[^A-Za-z0-9_.%-]|\z)"
        else:
            out += char if char.isalnum() and char.isascii() else "\\" + char
    return out


def literal_tokens(pattern: str) -> list[str]:
    """Tokens every match shows whole: letter-digit runs with a fixed character or end around.

    The token after `||` counts: what stands before it there is the start or a dot.
    """
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    found = []
    for match in re.finditer(r"[A-Za-z0-9]+", body):
        before, after = body[: match.start()], body[match.end() :]
        starts = before[-1] != "*" if before else anchored
        if starts and after and after[0] != "*":
            found.append(match[0].translate(str.maketrans(UPPER, LOWER)))
    return found


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def parts(url: Column) -> dict[str, Column]:
    """host: after the first `://` to `/`, `?`, `#` or the end, A-Z lowered; path: to `?` or `#`.

    A null URL or one without `://` has an empty host and path.
    """
    after = F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1), F.lit(""))
    host = F.regexp_extract(after, r"\A[^/?#]*", 0)
    return {
        "host": _lower(host),
        "path": F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1),
        "rest": F.regexp_extract(after, r"(?s)\A[^/?#]*(.*)\z", 1),
    }


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.split(_lower(text), "[^a-z0-9]+"))


def token_counts(urls: DataFrame, wanted: list[str]) -> dict[str, int]:
    """How many URLs show each wanted token; collects at most one row per wanted token."""
    listed = F.array(*[F.lit(t) for t in wanted])
    seen = urls.select(F.explode(F.array_intersect(_tokens(F.concat("host", "rest")), listed)).alias("token"))
    return {r["token"]: r["n"] for r in seen.groupBy("token").agg(F.count("*").alias("n")).collect()}


def index_rules(rules, counts: dict[str, int]) -> list[tuple[str, Rule]]:
    """Each rule under its rarest token; rules without one under the empty token, always fetched."""
    out = []
    for rule in rules:
        tokens = literal_tokens(rule.pattern)
        out.append((min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default=""), rule))
    return out


def _rule_struct(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.priority).alias("priority"),
        F.lit(rule.name).alias("name"),
        F.lit(rule.action).alias("action"),
        F.lit(rule.part).alias("part"),
        F.lit(regex_of(rule.pattern)).alias("regex"),
    )


def _fits(rule: Column) -> Column:
    subject = F.when(rule["part"] == "path", F.col("__host_path")).otherwise(F.col("__host_rest"))
    return F.call_function("rlike", subject, rule["regex"])


def _best(rules: Column) -> Column:
    """The fitting rule of greatest priority, then of smallest name."""
    first = F.array_sort(
        rules,
        lambda a, b: F.when(a["priority"] != b["priority"], b["priority"] - a["priority"])
        .when(a["name"] < b["name"], -1)
        .when(a["name"] > b["name"], 1)
        .otherwise(0),
    )
    return F.try_element_at(first, F.lit(1))


def _inline(urls: DataFrame, index: list[tuple[str, Rule]]) -> DataFrame:
    """The index as a map inside the projection: no shuffle, and no URL is more work than another."""
    by_token: dict[str, list[Rule]] = {}
    for token, rule in index:
        by_token.setdefault(token, []).append(rule)
    always = by_token.pop("", [])
    empty = F.array_remove(F.array(_rule_struct(Rule("", "", "", 0))), _rule_struct(Rule("", "", "", 0)))
    found = F.array(*[_rule_struct(r) for r in always]) if always else empty
    if by_token:
        pairs = [c for t, rs in by_token.items() for c in (F.lit(t), F.array(*[_rule_struct(r) for r in rs]))]
        table, keys = F.create_map(*pairs), F.array(*[F.lit(t) for t in by_token])
        known = F.array_intersect(F.col("__tokens"), keys)
        found = F.concat(found, F.flatten(F.transform(known, lambda t: F.element_at(table, t))))
    return urls.withColumn("__rule", _best(F.filter(found, _fits)))


def _joined(urls: DataFrame, index: list[tuple[str, Rule]]) -> DataFrame:
    """The index as a table, joined on the token; the verdict of a URL is found once per address.

    Spark chooses the join by size and splits hot tokens; fitting rules are combined map-side.
    """
    spark = urls.sparkSession
    rows = [(t, r.priority, r.name, r.action, r.part, regex_of(r.pattern)) for t, r in index]
    schema = "token string, priority int, name string, action string, part string, regex string"
    table = spark.createDataFrame(rows, schema)
    rule = F.struct("priority", "name", "action", "part", "regex")
    always = [r for t, r in index if not t]
    tokens = F.concat(F.col("__tokens"), F.array(F.lit(""))) if always else F.col("__tokens")
    addresses = urls.select("__host_path", "__host_rest", "__tokens").distinct()
    pairs = addresses.withColumn("token", F.explode(F.array_distinct(tokens))).join(table, "token")
    fitting = pairs.withColumn("__found", rule).where(_fits(F.col("__found")))
    top = fitting.groupBy("__host_path", "__host_rest").agg(F.max("priority").alias("__top"))
    best = (
        fitting.join(top, ["__host_path", "__host_rest"])
        .where(F.col("priority") == F.col("__top"))
        .groupBy("__host_path", "__host_rest")
        .agg(F.min_by("__found", "name").alias("__rule"))
    )
    return urls.join(best, ["__host_path", "__host_rest"], "left")


def judge_urls(
    pages: DataFrame, rules=PATH_RULES + PATTERN_RULES, url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """Every row of `pages` with host, path, rule and verdict.

    The fitting rule of greatest priority gives `rule` and `verdict`; without one, rule is null and
    verdict is `default`. Host and path are as in `parts`; a null URL or one without `://` fits no
    host rule. Repeated rows are judged alike; input columns of the four names are replaced, all
    others pass through. An empty table gives an empty result, an empty rule list the default.
    """
    made = parts(F.col(f"`{url_column}`"))
    named = [value.alias(f"__{name}") for name, value in made.items()]
    # Input columns stand in one of their own, so that none has a name that is made here.
    urls = pages.select(F.struct("*").alias("__page"), *named).withColumns(
        {
            "__host_path": F.concat("__host", "__path"),
            "__host_rest": F.concat("__host", "__rest"),
        }
    ).withColumn("__tokens", _tokens(F.col("__host_rest")))
    wanted = sorted({t for rule in rules for t in literal_tokens(rule.pattern)})
    counts = {}
    if wanted:
        counts = token_counts(pages.select(made["host"].alias("host"), made["rest"].alias("rest")), wanted)
    index = index_rules(rules, counts)
    judged = (_inline if len(index) <= INLINE_RULES else _joined)(urls, index)
    answers = {
        "host": F.col("__host"),
        "path": F.col("__path"),
        "rule": F.col("__rule.name"),
        "verdict": F.coalesce(F.col("__rule.action"), F.lit(default)),
    }
    rest = [c for c in pages.columns if c not in answers]
    return judged.select(*[F.col("__page").getField(c).alias(c) for c in rest], *[v.alias(k) for k, v in answers.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rule shows the four path rules only; a verdict of the pattern rules has no rule there."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = judge_urls(pages)
    shown = F.when(F.col("rule").isin(*[r.name for r in PATH_RULES]), F.col("rule"))
    return judged.select("page_id", "host", "path", shown.alias("rule"), "verdict")


SQL = r"""
WITH split AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
              ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
),
parts AS (
  SELECT page_id, rest,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail
  FROM split
),
rules(rule, rule_host, rule_path, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
),
hits AS (
  SELECT p.host, p.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p
  JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
              AND starts_with(p.path, r.rule_path)
  GROUP BY p.host, p.path
),
patterned AS (
  SELECT page_id, host, path, host || tail AS whole FROM parts
)
SELECT p.page_id, p.host, p.path, h.rule,
       CASE WHEN h.rule IS NOT NULL THEN h.verdict
            WHEN regexp_matches(whole, '[^A-Za-z0-9_.%-]help[^A-Za-z0-9_.%-]login([^A-Za-z0-9_.%-]|$)') THEN 'allow'
            WHEN regexp_matches(whole, '[^A-Za-z0-9_.%-](login|signin|cart|checkout)([^A-Za-z0-9_.%-]|$)') THEN 'block'
            WHEN regexp_matches(whole, '/tag/(.|\n)*page=') THEN 'block'
            WHEN regexp_matches(whole, '^([^/?#]*\.)?ads\.(.|\n)*/click([^A-Za-z0-9_.%-]|$)') THEN 'block'
            WHEN regexp_matches(whole, '^([^/?#]*\.)?doubleclick\.example([^A-Za-z0-9_.%-]|$)') THEN 'block'
            ELSE 'allow' END AS verdict
FROM patterned p LEFT JOIN hits h ON p.host = h.host AND p.path = h.path
"""
