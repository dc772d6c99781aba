"""URL filter rules, found by their rarest literal token (DataFrame functions only).

A rule is a regular expression with the literal tokens that every match must hold. The corpus says
which of a rule's tokens is rarest among the URLs; the rule is filed under that token. A URL's tokens
fetch the rules filed under them, and only those rules run their expressions.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets the default
verdict unless a rule without tokens matches; an empty table gives an empty result; repeated rows are
judged each; other columns of the input are kept out of the result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = "[^A-Za-z0-9]+"
#: Rules for sites rank from here on, so they come before patterns for any URL.
SITE_RANK = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path (host in lower case); the highest ``rank`` wins, then the name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains, for paths that begin with ``path``; longer rules rank higher."""
    # The last piece of a path may end inside a token of the URL, so it is no literal token.
    tokens = [x for x in re.split(TOKEN, host) + re.split(TOKEN, path)[:-1] if x]
    return Rule(host + path, verdict, rf"^([^/]*\.)?{quoted(host)}{quoted(path)}", tuple(tokens), SITE_RANK + len(host + path))


def pattern_rule(verdict: str, name: str, pattern: str, *tokens: str) -> Rule:
    """A rule for any URL that ``pattern`` matches; ``tokens`` are whole tokens of every match. Ranks below sites."""
    return Rule(name, verdict, pattern, tokens, 0)


def quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


#: The method's own rules for URLs that no site rule fits, over host and path.
PATTERNS = (
    pattern_rule("block", "tag pages", r"/tag/[^/]+/?\z", "tag"),
    pattern_rule("block", "login pages", r"/login(/|\.|\z)", "login"),
    pattern_rule("block", "blog archives", r"^([^/]*\.)?blog\.[^/]*/[a-z]{2}/[0-9]*0\z", "blog"),
    pattern_rule("block", "mobile copies", r"^m\.[^/]*/", "m"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``; A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def token_table(spark: SparkSession, tokens: Iterable[str]) -> DataFrame:
    """A row for each token; tokens hold no blanks, so one string holds them all."""
    return spark.range(1).select(F.explode(F.split(F.lit(" ".join(sorted(tokens))), " ")).alias("token"))


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs hold each token of the rules: one row a token, so no more than the rules have.

    The tokens of the rules come as a small table, which Spark broadcasts by its size; a URL's other tokens go no further.
    """
    wanted = token_table(urls.sparkSession, {t for rule in rules for t in rule.tokens})
    found = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi")
    return {row["token"]: row["count"] for row in found.groupBy("token").count().collect()}


def rule_index(rules: list[Rule], counts: dict[str, int]) -> list[tuple[str, Rule]]:
    """Each rule under its rarest token; equally rare tokens go by name, rules without tokens under the empty one."""
    return sorted(
        ((min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=""), rule) for rule in rules),
        key=lambda x: (x[0], x[1].name),
    )


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", key: str = "page_id") -> DataFrame:
    """``key, url, host, path, n_candidates, rule, rule_rank, verdict`` of every row of ``pages``.

    The rules are configuration on the driver; they travel with the plan as one array of slots, in
    which a token's hash says where its rules lie. So URLs are judged where they are read.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select(key, "url").withColumn("host", host).withColumn("path", path)
    urls = urls.withColumn("target", F.concat("host", "path"))
    urls = urls.withColumn("tokens", F.array_distinct(F.concat(F.split("target", TOKEN), F.array(F.lit("")))))
    index = rule_index(rules, token_counts(urls, rules))
    n_slots = 2 * len(index) + 1
    slots = slot_table(pages.sparkSession, index, n_slots)

    def fetch(token: Column) -> Column:
        slot = F.element_at(slots, (F.pmod(F.xxhash64(token), F.lit(n_slots)) + 1).cast("int"))
        return F.filter(slot, lambda rule: rule["token"] == token)

    candidates = F.flatten(F.transform("tokens", fetch))
    matched = F.filter("candidates", lambda rule: F.regexp_like(F.col("target"), rule["pattern"]))
    # max() takes the highest rank, then the greatest name, so ties are settled.
    best = F.array_max(F.transform(matched, lambda r: F.struct(r["rank"].alias("rank"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    return (
        urls.withColumn("candidates", candidates)
        .withColumn("best", best)
        .select(
            key, "url", "host", "path", F.size("candidates").alias("n_candidates"),
            F.col("best.name").alias("rule"), F.col("best.rank").alias("rule_rank"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def slot_table(spark: SparkSession, index: list[tuple[str, Rule]], n_slots: int) -> Column:
    """The index as a constant: slot ``hash(token) % n_slots`` holds the rules of its tokens.

    It is written as one string, which the optimizer reads once, so that planning takes no time for each rule.
    """
    table = token_table(spark, {token for token, _ in index})
    slot_of = {r["token"]: r["slot"] for r in table.select("token", F.pmod(F.xxhash64("token"), F.lit(n_slots)).alias("slot")).collect()}
    slots: list[list[dict]] = [[] for _ in range(n_slots)]
    for token, rule in index:
        slots[slot_of[token]].append({"token": token, "name": rule.name, "verdict": rule.verdict, "pattern": rule.pattern, "rank": rule.rank})
    kind = "array<array<struct<token:string,name:string,verdict:string,pattern:string,rank:int>>>"
    return F.from_json(F.lit(json.dumps(slots)), kind)


#: The sites of the registered query (fixed values).
SITES = (
    site_rule("allow", "org", "/"),
    site_rule("block", "example.org", "/es/"),
    site_rule("block", "example.org", "/en/1"),
    site_rule("allow", "com", "/fr/"),
    site_rule("block", "com", "/de/"),
)
