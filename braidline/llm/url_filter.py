r"""URL filters: pattern rules indexed by their rarest literal token.

A URL's subject is its host, A-Z lower-cased, and its path. A rule is a regular
expression over the subject with the literal tokens that every subject it fits
must contain, a verdict and a rank. Each rule is filed under the one of its
tokens that the fewest URLs contain; a URL's tokens fetch the rules filed under
them, and only those run their expressions. Of the rules that fit, the one with
the highest rank decides, then the longest.

Tokens are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.
Rules without a literal token are tried on every URL.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits only rules that fit an empty subject; equal rows give equal rows; without
rules, or an empty table, nothing is decided; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline.llm import common

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RULE = "rule string, pattern string, verdict string, rank int, size int, tokens array<string>"


@dataclass(frozen=True)
class Rule:
    """``rule`` is the name that results carry; None for rules without a name."""

    rule: str | None
    pattern: str
    verdict: str
    rank: int
    size: int
    tokens: tuple[str, ...]


def _tokens(text: str) -> list[str]:
    return [t for t in re.split(GAP, text.lower()) if t]


def host_rule(host: str, path: str, verdict: str, rank: int = 1) -> Rule:
    """A host with all its subdomains, and paths that start with ``path``."""
    # a token at the open end of the path may go on in the URL
    closed = re.sub(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+$", "", path)
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    if not path:
        pattern += "(?:/|$)"
    name = host + path
    return Rule(name, pattern, verdict, rank, len(name), (*_tokens(host), *_tokens(closed)))


def word_rule(word: str, verdict: str, rank: int = 0) -> Rule:
    """A word anywhere in the host, between its dots and hyphens."""
    pattern = rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)"
    return Rule(None, pattern, verdict, rank, len(word), (word,))


# the words that are blocked where no named rule fits
BLOCKED_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam")
DEFAULT_RULES = [word_rule(w, "block") for w in BLOCKED_WORDS]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return common.ascii_lower(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _index(spark: SparkSession, rules: list[Rule], tokens: DataFrame) -> DataFrame:
    """The rules by their rarest token; "" for rules without one."""
    rows = [(r.rule, r.pattern, r.verdict, r.rank, r.size, list(r.tokens)) for r in rules]
    table = spark.createDataFrame(rows, RULE).withColumn("id", F.monotonically_increasing_id())
    named = table.select("*", F.explode_outer("tokens").alias("token")).drop("tokens")
    counts = (
        tokens.join(named.select("token").distinct(), "token")
        .groupBy("token")
        .agg(F.count("*").alias("urls"))
    )
    rare = Window.partitionBy("id").orderBy(F.coalesce("urls", F.lit(0)), "token")
    return (
        named.join(counts, "token", "left")
        .withColumn("nth", F.row_number().over(rare))
        .where("nth = 1")
        .select(F.coalesce("token", F.lit("")).alias("token"), "rule", "pattern", "verdict", "rank", "size")
    )


def judge(spark: SparkSession, pages: DataFrame, rules: list[Rule], otherwise: str = "allow") -> DataFrame:
    """Per page: page_id, url, host, path, rule (its name or null), verdict."""
    url = F.col("url").cast("string")
    urls = pages.select("page_id", url.alias("url")).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    subject = F.concat("host", "path")
    tokens = urls.select(
        "page_id",
        "url",
        subject.alias("subject"),
        # the empty token fetches the rules without a literal token
        F.explode(F.array_distinct(F.concat(
            F.split(common.ascii_lower(subject), GAP), F.array(F.lit(""))
        ))).alias("token"),
    )
    fits = tokens.join(_index(spark, rules, tokens.select("token")), "token").where(
        F.regexp("subject", F.col("pattern"))
    )
    best = fits.groupBy("page_id", "url").agg(
        F.max_by(F.struct("rule", "verdict"), F.struct("rank", "size", "pattern")).alias("best")
    )
    same = F.col("u.page_id").eqNullSafe(F.col("b.page_id")) & F.col("u.url").eqNullSafe(F.col("b.url"))
    return (
        urls.alias("u")
        .join(best.alias("b"), same, "left")
        .select(
            "u.page_id",
            "u.url",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
        )
    )
