"""URL filters: allow and block rules on host suffixes and path prefixes.

Each URL is expanded into its (host suffix, path prefix) expressions, those
are equi-joined with the rules on a short prefix of their SHA-256, and a match
counts only if the full digests agree.  Of the rules that fit, the longest
(host and path together, then host) decides; of equal rules, block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the join is on (32 bits).
SHORT = 8
#: Rules up to this number are broadcast (about 200 bytes each); more are shuffled.
BROADCAST_RULES = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or a text without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0,
                  F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as for the host."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path) of ``rules`` (action, host, path).  Rows with a
    null, an unknown action, or a path that no URL can have are left out; of
    equal rules with both actions, block stays."""
    return (rules.select("action", F.translate("host", UPPER, LOWER).alias("host"), "path")
            .filter("action in ('allow', 'block') and host > '' and (path = '' or path like '/%')")
            .groupBy("host", "path").agg(F.max("action").alias("action"))
            .withColumn("rule", F.concat("host", "path"))
            .withColumn("digest", F.sha2("rule", 256))
            .withColumn("short", F.substring("digest", 1, SHORT)))


def filter_urls(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Per row of ``df``: id, host, path, rule (null if none fits), verdict.

    A rule fits its host and all subdomains of it if the path starts with the
    rule's; ``default`` is the verdict where no rule fits.  Null URLs and texts
    without ``://`` have an empty host and path and no rule.  Repeated rows stay; other columns of ``df`` take no part; an empty
    table gives an empty result; without rules every verdict is the default.

    Verdicts are found once per distinct URL, so a URL that many rows share is
    expanded once.
    """
    rules = prepare_rules(rules)
    # Which expressions can match at all: number of host labels and length of the path.
    shapes = (rules.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("chars"))
              .distinct().collect())
    urls = df.select(F.col(url_col).cast("string").alias("_url")).filter("_url is not null").distinct()
    urls = (urls.withColumn("_host", url_host(F.col("_url"))).withColumn("_path", url_path(F.col("_url")))
            .withColumn("_labels", F.split("_host", r"\.", -1)))
    if not shapes:
        found = urls.select("_url", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))
    else:
        n = F.size("_labels")
        expression = [F.when((n >= s.labels) & (F.length("_path") >= s.chars),
                             F.concat(F.array_join(F.slice("_labels", n - s.labels + 1, s.labels), "."),
                                      F.substring("_path", 1, s.chars))) for s in shapes]
        expanded = (urls.select("_url", F.explode(F.array_distinct(F.array_compact(F.array(*expression)))).alias("_expression"))
                    .withColumn("_digest", F.sha2("_expression", 256))
                    .select("_url", "_digest", F.substring("_digest", 1, SHORT).alias("short")))
        few = rules.count() <= BROADCAST_RULES
        found = (expanded.join(F.broadcast(rules) if few else rules, "short").filter("_digest = digest")
                 .groupBy("_url")
                 .agg(F.max(F.struct(F.length("rule").alias("a"), F.length("host").alias("b"), "action", "rule")).alias("_best"))
                 .select("_url", "_best.rule", "_best.action"))
    rows = df.select(F.col(id_col), F.col(url_col).cast("string").alias("_url"))
    judged = rows.filter("_url is not null").join(found.select("_url", "rule", "action"), "_url", "left")
    # Null URLs have no key to join on; kept apart they cannot pile up in one task.
    null = rows.filter("_url is null").select("_url", id_col, F.lit(None).cast("string").alias("rule"),
                                              F.lit(None).cast("string").alias("action"))
    return (judged.unionByName(null)
            .select(id_col, F.coalesce(url_host(F.col("_url")), F.lit("")).alias("host"),
                    F.coalesce(url_path(F.col("_url")), F.lit("")).alias("path"), "rule",
                    F.coalesce("action", F.lit(default)).alias("verdict")))
