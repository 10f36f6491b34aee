"""URL filters: host-suffix and path-prefix expressions against hashed rules.

Each URL is expanded into all pairs of a host suffix and a path prefix. Rules
are stored under the first bytes of the SHA-256 of their expression. An equi
join on that short prefix finds candidates, the full digest confirms them, and
of the confirmed rules the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8  # hexadecimal digits of the short hash: 32 bits
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered. Path: from there up to ``?`` or ``#``.

    Both are empty for a null URL or one without ``://``.
    """
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``rule, verdict, digest, prefix`` from ``(verdict, host/path)`` rows; the first of equal rules counts."""
    rows = list({rule: verdict for verdict, rule in reversed(rules)}.items())
    table = spark.createDataFrame(rows, "rule string, verdict string")
    return table.withColumn("digest", F.sha2("rule", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))


def expressions(host: Column, path: Column, lengths: list[int], labels: int) -> Column:
    """All ``suffix/prefix`` texts: suffixes of the host of at most ``labels`` labels, prefixes of the path in ``lengths``.

    Rules fit any leading part of a path, not whole segments only, so prefixes are
    taken at the lengths that rules have. A suffix of more labels than any rule has
    fits none, however long a host is.
    """
    parts = F.slice(F.reverse(F.split(host, r"\.")), 1, labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.reverse(F.slice(parts, 1, i)), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: path.substr(F.lit(1), n))
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``, repeated rows included.

    ``rules`` comes from ``rule_table``. A rule fits its host and all subdomains if
    the path starts with the rule's; the longest (host and path together) wins,
    ties by text. Without a fitting rule ``rule`` is null and ``verdict`` is
    ``default``. Distinct (host, path) pairs are judged once; a popular one is
    reduced before the shuffle.
    """
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    size = F.length("rule") - F.instr("rule", "/") + 1, F.size(F.split(F.split_part("rule", F.lit("/"), F.lit(1)), r"\."))
    # at most as many lines as rules have different path lengths
    found = rules.groupBy(size[0].alias("n")).agg(F.max(size[1]).alias("labels")).collect()
    lengths, labels = sorted({r["n"] for r in found}), max((r["labels"] for r in found), default=0)
    if not lengths:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    candidates = (
        urls.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), lengths, labels)).alias("_text"))
        .withColumn("_digest", F.sha2("_text", 256))
        .withColumn("prefix", F.substring("_digest", 1, PREFIX_DIGITS))
        .drop("_text")
    )
    judged = (
        candidates.join(rules, "prefix")
        .where(F.col("_digest") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("_best"))
    )
    return urls.join(judged, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
