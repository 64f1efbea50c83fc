"""Operator 6: URL rules indexed by their rarest literal token. Column work only: no Python on the executors."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_or_shuffled

#: Rule tables of up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_RULES = 200_000

#: Rules without a literal token cannot be indexed; more of them are refused.
MAX_OPEN_RULES = 100

#: Pattern rules (fixed values): ``*`` any text, ``^`` a separator or an end, the rest literal. ``@@`` allows.
PATTERN_RULES = (
    "^spam-farm.", "^link-farm.", "^doorway.", "^casino^", "^casino-bonus^", "^poker^bonus^", "^viagra^", "^cialis^", "^payday-loan^",
    "^porn^", "^xxx^", "^escort^", "^warez^", "^torrent^download^", "^keygen^", "^phishing^", "^malware^", "^adserver.", "^ads^click^",
    "^doubleclick^", "^tracker^pixel^", "^popunder^", "^affiliate^redirect^", "^wp-login^php", "^cgi-bin^", "^session^id=", "^cart^add^",
    "^checkout^", "^unsubscribe^", "^calendar^ical^", "@@^help^unsubscribe^", "@@^docs^cgi-bin^",
)

#: Host and path rules (fixed values): verdict, host, path.
PREFIX_RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


def parse_pattern(rule: str) -> tuple[str, str, str, list[str]]:
    """``(rule, verdict, regular expression, literal tokens)`` of a pattern rule.

    A literal token is a run of letters and digits that has a separator on both sides in the rule: every matching URL
    has it as a whole token.
    """
    body = rule.removeprefix("@@").lower()
    parts = {"*": ".*", "^": r"(?:[^a-z0-9%-]|\A|\z)"}
    expression = "(?s)" + "".join(parts.get(c, re.escape(c)) for c in body)
    tokens = [m.group() for m in re.finditer(r"[a-z0-9]+", body) if m.start() and body[m.start() - 1] != "*" and m.end() < len(body) and body[m.end()] != "*"]
    return rule, "allow" if rule.startswith("@@") else "block", expression, list(dict.fromkeys(tokens))


def _literal_rows(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """A small fixed table of structs as column literals: no Python worker reads it."""
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pattern_rules(spark: SparkSession, rules: tuple[str, ...] = PATTERN_RULES) -> DataFrame:
    """The rules as a table ``(pattern, action, expression, tokens)``."""
    row = lambda p, a, e, t: F.struct(F.lit(p).alias("pattern"), F.lit(a).alias("action"), F.lit(e).alias("expression"), F.array(*map(F.lit, t)).cast("array<string>").alias("tokens"))
    return _literal_rows(spark, [row(*parse_pattern(r)) for r in rules])


def prefix_rules(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = PREFIX_RULES) -> DataFrame:
    """The rules as a table ``(action, rule_host, rule_path)``."""
    return _literal_rows(spark, [F.struct(F.lit(a).alias("action"), F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path")) for a, h, p in rules])


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of an address; both empty for a null and where ``://`` is missing."""
    part = lambda p: F.coalesce(F.regexp_extract(url, p, 1), F.lit(""))
    return F.translate(part("(?s)^.*?://([^/?#]*)"), string.ascii_uppercase, string.ascii_lowercase), part("(?s)^.*?://[^/?#]*([^?#]*)")


def judge_urls(pages: DataFrame, prefixes: DataFrame, patterns: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``pattern`` and ``verdict`` to every row of ``pages``.

    A prefix rule fits its host and all subdomains if the path starts with the rule's path; the longest (host and path
    together, then the last in text order) decides and is ``rule``. Addresses without one are judged by the pattern
    rules: a rule is filed under that one of its literal tokens which is rarest among the addresses (ties: text order),
    an address' tokens fetch the rules filed under them, and only those run their regular expression. Any allowing
    pattern outweighs blocking ones; ``pattern`` is the least in text order of those that decided. Rules without a
    literal token run on every address. No rule at all: ``allow``.

    Work is done once for each distinct address. Null or relative addresses have empty parts and no prefix rule.
    Repeated rows are kept; other columns stay; input columns that bear a result's name are replaced. Empty rule tables
    allow everything.
    """
    names = ("host", "path", "rule", "pattern", "verdict")
    pages = pages.select(*[c for c in pages.columns if c not in names])
    host, path = url_parts(F.col(url_col))
    address = pages.where(F.col(url_col).isNotNull()).select(F.col(url_col).alias("url")).distinct()
    n_rules = prefixes.count() + patterns.count()
    # prefix rules: a host's endings with as many labels as rules have
    depth = prefixes.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    labels = F.split(host, r"\.")
    count = F.least(F.size(labels), F.lit(depth))
    endings = F.transform(F.sequence(F.lit(1), count), lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    by_host = address.select("url", path.alias("own_path"), F.explode(F.when(count > 0, endings)).alias("rule_host"))
    fits = by_host.join(bounded_or_shuffled(prefixes, n_rules, BROADCAST_RULES), "rule_host").where(F.expr("startswith(own_path, rule_path)"))
    text = F.concat(F.col("rule_host"), F.col("rule_path"))
    best = fits.groupBy("url").agg(F.max(F.struct(F.length(text).alias("n"), text.alias("rule"), "action")).alias("best"))
    # pattern rules: the index by the rarest token
    tokens = address.select("url", F.explode(F.array_distinct(F.split(F.lower("url"), "[^a-z0-9]+"))).alias("token"))
    wanted = patterns.select("pattern", "action", "expression", F.explode("tokens").alias("token"))
    used = wanted.select("token").distinct()
    seen = tokens.join(bounded_or_shuffled(used, n_rules, BROADCAST_RULES), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = wanted.join(seen, "token", "left").groupBy("pattern", "action", "expression").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("token"))
    open_rules = patterns.where(F.size("tokens") == 0).select("pattern", "action", "expression")
    fetched = tokens.join(bounded_or_shuffled(rarest, n_rules, BROADCAST_RULES), "token").select("url", "pattern", "action", "expression")
    everywhere = open_rules.limit(MAX_OPEN_RULES + 1).collect()
    if len(everywhere) > MAX_OPEN_RULES:
        raise ValueError(f"more than {MAX_OPEN_RULES} rules have no literal token and would run on every address")
    if everywhere:
        rules = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in r.asDict().items()]) for r in everywhere])
        fetched = fetched.unionByName(address.select("url", F.explode(rules).alias("r")).select("url", "r.*"))
    matches = fetched.where(F.expr("rlike(lower(url), expression)"))
    told = matches.groupBy("url").agg(F.min(F.struct((F.col("action") == "block").alias("blocks"), "pattern", "action")).alias("told"))
    judged = best.join(told, "url", "full_outer").withColumnRenamed("url", "judged_url")
    out = pages.join(judged, pages[url_col] == judged["judged_url"], "left")
    return out.select(
        *[pages[c] for c in pages.columns],
        host.alias("host"),
        path.alias("path"),
        F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), F.col("told.pattern")).alias("pattern"),
        F.coalesce(F.col("best.action"), F.col("told.action"), F.lit("allow")).alias("verdict"),
    )


def judge_urls_sql(patterns: tuple[str, ...] = PATTERN_RULES, prefixes: tuple[tuple[str, str, str], ...] = PREFIX_RULES) -> str:
    """The same verdicts by trying every rule on every address (DuckDB SQL over ``pages``)."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(r)}, {quote(a)}, {quote(e)})" for r, a, e, _ in map(parse_pattern, patterns))
    known = ", ".join(f"({quote(a)}, {quote(h)}, {quote(p)})" for a, h, p in prefixes)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
with patterns(pattern, action, expression) as (values {rows}), prefixes(action, rule_host, rule_path) as (values {known}),
parts as (select page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{upper}', '{lower}') as host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
best as (select p.page_id, max({{'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'action': action}}) as best
  from parts p join prefixes r on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
  group by p.page_id),
told as (select p.page_id, min({{'blocks': action = 'block', 'pattern': pattern, 'action': action}}) as told
  from parts p join patterns r on regexp_matches(lower(p.url), r.expression) group by p.page_id)
select p.page_id, p.host, p.path, b.best.rule as rule, case when b.best is null then t.told.pattern end as pattern,
  coalesce(b.best.action, t.told.action, 'allow') as verdict
from parts p left join best b on b.page_id = p.page_id left join told t on t.page_id = p.page_id"""
