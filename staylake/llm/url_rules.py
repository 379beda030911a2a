"""URL filter rules by host suffix and path prefix.

Every distinct URL is expanded into its host suffixes (the host and all its
parent domains) times its path prefixes that end in a slash; a rule is filed
under its host and its path up to the last slash. Both sides meet on a short
prefix of the SHA-256 of that expression; the full digest is then compared,
and the rest of the rule's path must follow in the URL's path. Of the rules
that fit, the one with the longest text (host and path) decides; at equal
length the one with the longer host, then a block rule.

Expansions stop at the number of host labels and slashes that the longest rule
has, since nothing longer can match. URLs are made distinct first, with a
pre-combined aggregate, so a frequent URL is judged once; the verdicts come
back to the rows by an ordinary join, which the skew rule splits.

A NULL URL or one without ``://`` has an empty host and path and fits no rule.
Repeated rows each get their verdict. Extra columns are ignored, an empty
table gives an empty result.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH_PREFIX = 8  # hex digits of the join key


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table from (verdict, host, path)."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``id``, ``host``, ``path``, ``rule``, ``verdict``."""
    digest = F.sha2("expression", 256)
    filed = (rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
             .withColumn("expression", F.concat("rule_host", F.regexp_extract("rule_path", "^(?s:.*)/|^", 0)))
             .withColumns({"rule_digest": digest, "short": F.substring(digest, 1, HASH_PREFIX)}).drop("expression"))
    # two numbers reach the driver: how deep the rules go
    labels, depth = rules.agg(F.max(F.size(F.split("host", "\\."))), F.max(_slashes(F.col("path")))).first()
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host, path = host_path(F.col("url"))
    urls = pages.select(url.alias("url")).distinct().withColumns({"host": host, "path": path})

    names, parts = F.split("host", "\\."), F.split("path", "/")
    most, deep = F.least(F.size(names), F.lit(labels or 0)), F.least(F.size(parts) - 1, F.lit(depth or 0))
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda k: F.array_join(F.slice(names, F.size(names) - k + 1, k), "."))
    prefixes = F.transform(F.sequence(F.lit(0), deep), lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.when(k > 0, "/").otherwise("")))
    expanded = (urls.filter((F.length("host") > 0) & F.lit(bool(labels)))
                .select("url", "host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
                .select("url", "host", "path", "suffix", F.explode("prefixes").alias("prefix"))
                .select("url", "host", "path", F.concat("suffix", "prefix").alias("expression"))
                .withColumn("digest", digest).withColumn("short", F.substring("digest", 1, HASH_PREFIX)))
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")
    text = F.concat("rule_host", "rule_path")
    best = (expanded.join(filed, "short").filter(fits)
            .groupBy("url").agg(F.max(F.struct(F.length(text).alias("n"), F.length("rule_host").alias("h"), (F.col("rule_verdict") == "block").alias("b"),
                                               text.alias("rule"), F.col("rule_verdict").alias("verdict"))).alias("best")))
    host, path = host_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"))
    return (rows.join(best, "url", "left")
            .select("id", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
