"""URL filters: pattern rules found through their rarest literal token (operator 4, DataFrame functions only).

A rule has a regular expression over ``host + path`` and the literal tokens that every matching url
holds.  Tokens are runs of letters and runs of digits.  How often each token occurs is counted over
all urls; a rule is indexed by its rarest one.  A url's tokens fetch the rules indexed by them, and
only those rules' regular expressions run.  A rule without a literal token runs on every url.

Counting needs no rows of urls moved: counts are combined before the shuffle, and only counts of
tokens that rules name are gathered, at most one for each.  The index is as small as the rule list,
which the caller gives; it is broadcast only below BROADCAST_RULES rules and joined by a shuffle of
distinct url tokens beyond.  A hot host or token is met by a rule or not, row by row: nothing is
grouped by it.

Defined results: host and path are empty for a null url or one without ``://``; such urls fit no rule;
equal urls are judged alike; an empty table gives no rows.  The longest fitting rule wins (ties: the
smaller rule text); without one the verdict is ``default``.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BROADCAST_RULES = 50_000
TOKEN = r"[A-Za-z]+|[0-9]+"


@dataclass(frozen=True)
class Rule:
    """``rule``: its text; ``verdict``: allow or block; ``pattern``: over host + path; ``literals``: tokens of every match; ``listed``: whether results name it."""

    rule: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    listed: bool = True


def site_rule(rule: str, verdict: str) -> Rule:
    """A rule ``host/path``: fits the host and its subdomains where the path starts with the rule's.

    The last token of the rule may go on in a url, so it is a literal only if something ends it.
    """
    host, slash, path = rule.partition("/")
    pattern = rf"^([^/]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    whole = [m.group() for m in re.finditer(TOKEN, host + slash + path) if m.end() < len(rule)]
    return Rule(rule, verdict, pattern, tuple(dict.fromkeys(whole)))


#: Fixed by the query's contract.
SITE_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Whole words of a host's labels, beside other words, digits or hyphens, that mark a site as junk; the query's own choice.
UNWANTED = ("adult", "ads", "bet", "bets", "bingo", "casino", "casinos", "escort", "escorts", "pills", "poker", "porn", "slots", "spam", "viagra", "warez", "xxx")


def word_pattern(words: str) -> str:
    """Over a host: one of the words, with no letter beside it, in any label but the last."""
    return rf"^([^/]*[^a-z/])?({words})([^a-z./][^./]*)?\."


def standard_rules() -> list[Rule]:
    """The contract's rules, and unlisted ones that block hosts whose labels hold a word of junk sites."""
    words = [Rule(f"word:{x}", "block", word_pattern(x), (x,), listed=False) for x in UNWANTED]
    return [*[site_rule(*x) for x in SITE_RULES], *words]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After that host from ``/`` up to ``?``, ``#`` or the end; empty where no ``/`` follows the host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*((?:/[^?#]*)?)", 1)


def index_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rules with the token that fetches each: of its literals the one that the fewest urls hold."""
    spark = urls.sparkSession
    flat = spark.createDataFrame([(r.rule, r.verdict, r.pattern, r.listed, t) for r in rules for t in (r.literals or ("",))], "rule string, verdict string, pattern string, listed boolean, token string")
    wanted = sorted({t for r in rules for t in r.literals})
    tokens = F.explode(F.array_intersect(tokens_of(F.col("_host"), F.col("_path")), F.lit(wanted)))
    counts = urls.select(tokens.alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    ranked = flat.join(counts, "token", "left").groupBy("rule", "verdict", "pattern", "listed")
    return ranked.agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens of a url, and the empty one, which fetches rules without literals."""
    return F.array_distinct(F.concat(F.regexp_extract_all(F.concat(host, path), F.lit(f"({TOKEN})"), F.lit(1)), F.array(F.lit(""))))


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null if none of the listed fits) and ``verdict``.

    An unlisted rule decides only where no listed one fits.  Columns of the input with those names
    are replaced.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    urls = pages.select(*kept, host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"))
    index = index_rules(urls.select("_host", "_path"), rules)
    if len(rules) > BROADCAST_RULES:
        return _judge_joined(urls, index, kept, default)
    # no more rows than rules, which the driver holds already: the index becomes a constant, token -> its rules
    by_token: dict[str, list] = {}
    for r in index.collect():
        by_token.setdefault(r["token"], []).append({k: r[k] for k in ("rule", "verdict", "pattern", "listed")})
    held = urls.withColumn("_index", F.from_json(F.lit(json.dumps(by_token)), "map<string, array<struct<rule: string, verdict: string, pattern: string, listed: boolean>>>"))
    known = F.array_intersect(tokens_of(F.col("_host"), F.col("_path")), F.lit(sorted(by_token)))
    fetched = F.filter(F.flatten(F.transform(known, lambda t: F.element_at("_index", t))), lambda r: (F.col("_host") != "") & F.rlike(F.concat("_host", "_path"), r["pattern"]))
    best = F.element_at(F.array_sort(F.transform(fetched, lambda r: F.struct((~r["listed"]).alias("last"), (-F.length(r["rule"])).alias("order"), r["rule"].alias("rule"), r["verdict"].alias("verdict"), r["listed"].alias("listed")))), 1)
    with_best = held.withColumn("_best", F.when(F.size(fetched) > 0, best))
    return with_best.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.when(F.col("_best.listed"), F.col("_best.rule")).alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def _judge_joined(urls: DataFrame, index: DataFrame, kept: list[str], default: str) -> DataFrame:
    """The same by a shuffle, for rule lists too long to broadcast.

    Each distinct url is judged once; a token that very many urls hold is dealt over SALTS copies of
    its rules.
    """
    salts = 64
    distinct = urls.select("_host", "_path").distinct()
    tokens = distinct.select("_host", "_path", F.explode(tokens_of(F.col("_host"), F.col("_path"))).alias("token"), F.pmod(F.xxhash64("_host", "_path"), F.lit(salts)).alias("salt"))
    dealt = index.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    hit = tokens.join(dealt, ["token", "salt"]).where((F.col("_host") != "") & F.rlike(F.concat("_host", "_path"), F.col("pattern")))
    best = hit.groupBy("_host", "_path").agg(F.min_by(F.struct("rule", "verdict", "listed"), F.struct(~F.col("listed"), -F.length("rule"), "rule")).alias("_best"))
    joined = urls.join(best, ["_host", "_path"], "left")
    return joined.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.when(F.col("_best.listed"), F.col("_best.rule")).alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every url of ``pages``."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), standard_rules()).select("page_id", "host", "path", "rule", "verdict")


def op4_sql() -> str:
    """The query in DuckDB's SQL: every rule tried on every url."""
    longest = sorted(SITE_RULES, key=lambda x: -len(x[0]))
    fits = [(r, v, f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '/{p}')") for r, v in longest for h, _, p in [r.partition("/")]]
    rule = "case " + " ".join(f"when {c} then '{r}'" for r, _, c in fits) + " end"
    verdict = "case " + " ".join(f"when {c} then '{v}'" for _, v, c in fits)
    junk = word_pattern("|".join(UNWANTED))
    return f"""
    with p as (select page_id, coalesce(url, '') u from pages),
    q as (select page_id, case when contains(u, '://') then substr(u, strpos(u, '://') + 3) else '' end rest from p),
    h as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                 regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) path from q)
    select page_id, host, path, {rule} as rule,
           {verdict} when regexp_matches(host, '{junk}') then 'block' else 'allow' end as verdict
    from h"""
