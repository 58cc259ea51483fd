"""URL rules indexed by their rarest literal token.

A rule is a pattern over ``host + path``. Its literal tokens (runs of ASCII letters and
digits that are bounded on both sides in every url the pattern fits) must all occur in a
url it fits, so it is enough to look for the one that is rarest over the corpus. Url
tokens fetch candidate rules through a join on that token; only candidates run their
regular expression, or compare host and path if they are host rules. Rules without a bounded token are candidates of every url.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.llm.common import LOWER, UPPER

#: Every url and every rule without a bounded token carry this token.
ALWAYS = ""


@dataclass(frozen=True)
class UrlRule:
    """``name`` with a pattern over ``host + path``; ``tokens`` are its bounded literals, lower-cased."""

    name: str
    regex: str
    verdict: str
    tokens: tuple[str, ...]
    #: 1: a host rule, the longest wins and beats patterns; 0: a pattern rule, block beats allow.
    rank: int = 0
    #: A host rule's host and what the path starts with; they decide, the pattern also fits hosts inside paths.
    host: str = ""
    path: str = ""


def host_rule(rule: str, verdict: str) -> UrlRule:
    """``example.org/es/``: the host and all its subdomains, paths that start with ``/es/``."""
    host, slash, path = rule.partition("/")
    host = host.translate(str.maketrans(UPPER, LOWER))
    tail = slash + path
    parts = re.findall("[A-Za-z0-9]+", host + tail)
    if parts and re.search("[A-Za-z0-9]$", tail or "."):
        parts = parts[:-1]  # the path may go on inside the last token
    regex = f"(?s)^(.*\\.)?{_quoted(host)}{_quoted(tail) if tail else '(/|\\z)'}"
    return UrlRule(rule, regex, verdict, tuple(p.lower() for p in parts), 1, host, tail)


def pattern_rule(pattern: str, verdict: str) -> UrlRule:
    """A glob over ``host + path``: ``*`` is any run of characters, the rest is literal."""
    regex = "(?s)^" + ".*".join(_quoted(p) for p in pattern.split("*")) + "\\z"
    tokens = []
    for found in re.finditer("[A-Za-z0-9]+", pattern):
        before, after = pattern[: found.start()][-1:], pattern[found.end() :][:1]
        if before != "*" and after != "*":
            tokens.append(found.group().lower())
    return UrlRule(pattern, regex, verdict, tuple(tokens))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", text)


HOST_RULES = (
    host_rule("org/", "allow"),
    host_rule("example.org/es/", "block"),
    host_rule("example.org/en/1", "block"),
    host_rule("com/fr/", "allow"),
    host_rule("com/de/", "block"),
)
#: Pages that hold no prose: shop and account pages, link lists, feeds, trackers, binaries.
PATTERN_RULES = tuple(
    pattern_rule(p, "block")
    for p in (
        "*/login/*",
        "*/signup/*",
        "*/cart/*",
        "*/checkout/*",
        "*/tag/*",
        "*/feed/",
        "*/ads/*",
        "ads.*",
        "tracker.*",
        "*.doubleclick.net/*",
        "*.jpg",
        "*.png",
        "*.zip",
    )
)
RULES = (*HOST_RULES, *PATTERN_RULES)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    Host rules come first, the longest wins (ties by name); ``rule`` names it. Without one
    the pattern rules decide: ``block`` beats ``allow``, and ``rule`` is null; a url that
    nothing fits is judged ``otherwise``. Null urls and urls without ``://`` have an empty
    host and path. Rows with the same id and url are judged once and all returned. An empty
    table gives an empty result, without rules every url is judged ``otherwise``.

    One aggregation row per distinct (id, url) is shuffled; token rows are combined in the
    task that made them. The rule table is the caller's list; Spark broadcasts it if it is
    small and joins by token otherwise.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    urls = urls.groupBy("id", "url").agg(F.count("*").alias("n"))
    urls = urls.select("id", "url", "n", url_host("url").alias("host"), url_path("url").alias("path"))
    tokens = F.array_remove(F.split(F.translate("target", UPPER, LOWER), "[^a-z0-9]+"), ALWAYS)
    exploded = urls.withColumn("target", F.concat("host", "path")).withColumn(
        "token", F.explode(F.array_union(F.array(F.lit(ALWAYS)), tokens))
    )

    listed = spark.createDataFrame(
        [(i, r.name, r.regex, r.verdict, r.rank, r.host, r.path, list(r.tokens)) for i, r in enumerate(rules)],
        "number long, name string, regex string, rule_verdict string, rank int, rule_host string, rule_path string, tokens array<string>",
    )
    literals = listed.select("number", F.explode("tokens").alias("token")).distinct()
    # How many urls hold each rule token, over the whole table.
    frequency = (
        exploded.join(literals.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.sum("n").alias("urls"))
    )
    rarest = (
        literals.join(frequency, "token", "left")
        .groupBy("number")
        .agg(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), F.col("token"))).alias("token"))
    )
    index = listed.join(rarest, "number", "left").select(
        F.coalesce("token", F.lit(ALWAYS)).alias("token"), "name", "regex", "rule_verdict", "rank", "rule_host", "rule_path"
    )

    weight = F.when(F.col("rank") == 1, F.length("name")).otherwise((F.col("rule_verdict") == "block").cast("int"))
    under = (F.col("host") == F.col("rule_host")) | F.endswith("host", F.concat(F.lit("."), "rule_host"))
    fits = F.when(F.col("rank") == 1, under & F.startswith("path", "rule_path")).otherwise(F.expr("target rlike regex"))
    candidate = F.when(
        fits, F.struct("rank", weight.alias("weight"), "name", "rule_verdict")
    )
    judged = (
        exploded.join(index, "token", "left")
        .groupBy("id", "url")
        .agg(F.first("host").alias("host"), F.first("path").alias("path"), F.first("n").alias("n"), F.max(candidate).alias("best"))
    )
    repeated = judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return repeated.select(
        "id",
        "host",
        "path",
        F.when(F.col("best.rank") == 1, F.col("best.name")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(otherwise)).alias("verdict"),
    )
