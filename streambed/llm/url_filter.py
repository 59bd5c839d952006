"""URL rules by hashed host-suffix and path-prefix expressions.

A rule (host, path, verdict) is the expression host + path. A URL is expanded into the expressions
that could be a rule: the last k labels of its host with the first n characters of its path, for the
pairs (k, n) that occur among the rules. Expressions meet rules in an equi-join on the first bytes of
their SHA-256 digests; the whole digest confirms, and the longest rule decides. All of it is built-in
expressions, joins and aggregates.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hexadecimal digits of the digest that the join compares: four bytes.
PREFIX_DIGITS = 8


def _lower(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    return _lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _hashed(df: DataFrame) -> DataFrame:
    digest = F.sha2(F.concat("host", "path"), 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """The rules with hosts lower-cased, their digests, and one verdict each: block beats allow."""
    own = rules.select(
        _lower(F.coalesce(F.col("host").cast("string"), F.lit(""))).alias("host"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        F.lower(F.col("verdict").cast("string")).alias("verdict"),
    )
    once = own.where("host <> '' and verdict in ('allow', 'block')").groupBy("host", "path")
    return _hashed(once.agg(F.max("verdict").alias("verdict")))


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """(host labels, path characters) that occur among prepared rules.

    As many as rules differ in shape: at most 127 labels times the longest path, however many rules.
    """
    shape = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("n")).distinct()
    return sorted((row.labels, row.n) for row in shape.collect())


def expand(urls: DataFrame, wanted: list[tuple[int, int]]) -> DataFrame:
    """(own_host, own_path, host, path): each (host, path) of ``urls`` with its expressions."""
    suffixes = F.array(
        *[
            F.when(
                (F.size(F.split("own_host", r"\.")) >= labels) & (F.length("own_path") >= n),
                F.struct(
                    F.substring_index("own_host", ".", -labels).alias("host"),
                    F.substring("own_path", 1, n).alias("path"),
                ),
            )
            for labels, n in wanted
        ]
    )
    found = urls.select("own_host", "own_path", F.explode(F.filter(suffixes, lambda x: x.isNotNull())).alias("x"))
    return found.select("own_host", "own_path", "x.host", "x.path")


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule
    (host and path together) wins, on a tie the longer host; of equal rules block wins. ``rule`` is its
    host and path, null where none fits and the verdict is ``default``. Rules without a host or with
    another verdict than allow or block are left out; without rules every URL gets the default.

    A null url, or one without ``://``, has an empty host and path and fits no rule. Null and repeated
    ids are returned as they come; other columns are left out. Equal hosts and paths are judged once,
    and the verdicts joined back, so that Spark can split a frequent one.
    """
    ready = prepare_rules(rules)
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    wanted = shapes(ready)
    if not wanted:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    distinct = rows.select(F.col("host").alias("own_host"), F.col("path").alias("own_path")).distinct()
    own, rule = _hashed(expand(distinct, wanted)).alias("own"), ready.alias("rule")
    same = (F.col("own.short") == F.col("rule.short")) & (F.col("own.digest") == F.col("rule.digest"))
    fits = own.join(rule, same).select(
        "own.own_host",
        "own.own_path",
        F.struct(
            (F.length("rule.host") + F.length("rule.path")).alias("total"),
            F.length("rule.host").alias("labels"),
            F.concat("rule.host", "rule.path").alias("rule"),
            F.col("rule.verdict").alias("verdict"),
        ).alias("fit"),
    )
    best = fits.groupBy("own_host", "own_path").agg(F.max("fit").alias("fit"))
    joined = rows.join(best, (F.col("host") == F.col("own_host")) & (F.col("path") == F.col("own_path")), "left")
    return joined.select(
        "page_id", "host", "path", "fit.rule", F.coalesce("fit.verdict", F.lit(default)).alias("verdict")
    )
