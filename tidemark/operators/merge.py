"""Merges of the records of a group, in a stated order, by one rule per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import salts as S
from tidemark.functions.common import present


def _ordered(c: str) -> Column:
    """The values of ``c`` that are there, in the group's order."""
    rows = F.array_sort(F.collect_list(F.struct(F.col("_ord"), F.col(c).alias("v"))))
    return F.transform(rows, lambda r: r["v"])


def longest(c: str) -> Column:
    """The longest text; the earliest of equals, as only a strictly longer one replaces it."""
    return F.max_by(F.when(present(F.col(c)), F.col(c)), F.struct(F.coalesce(F.char_length(c), F.lit(-1)), -F.col("_ord")))


def first_of(c: str) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_ord")))


def last_of(c: str) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_ord")))


def best_salt(c: str) -> Column:
    """The composition of the best quality, then the longest, then the earliest."""
    return F.max_by(F.col(c), F.struct(S.quality(F.col(c)), F.coalesce(F.char_length(c), F.lit(0)), -F.col("_ord")))


def union_of(c: str) -> Column:
    """Distinct items of the lists, in order of first appearance."""
    return F.array_distinct(F.flatten(F.transform(_ordered(c), lambda x: F.coalesce(x, F.array().cast("array<string>")))))


def merged(rows: DataFrame, key: str, order: str, long: list[str] = [], salts: list[str] = [], first: list[str] = [], last: list[str] = [], lists: list[str] = [], product: str | None = None) -> DataFrame:  # noqa: B006
    """One record per ``key``; ``order`` is a number that is unique within a group."""
    aggs = [longest(c).alias(c) for c in long] + [best_salt(c).alias(c) for c in salts] + [first_of(c).alias(c) for c in first] + [last_of(c).alias(c) for c in last] + [union_of(c).alias(c) for c in lists]
    if product:
        aggs.append(F.when(F.bool_or(F.coalesce(F.col(product) == "product", F.lit(False))), "product").otherwise(F.min_by(product, "_ord")).alias(product))
    return rows.withColumn("_ord", F.col(order)).groupBy(key).agg(*aggs)


def cluster_salt(stored: Column, raw: Column, others: Column) -> Column:
    """The composition for a cluster: the canonical's own where clean, else the most complete clean one of the others."""
    s, derived = F.trim(F.coalesce(stored, F.lit(""))), S.salt_key(raw)
    s_ok, d_ok = (s != "") & ~S.is_garbage(s), (derived != "") & ~S.is_garbage(derived)
    best = F.aggregate(others, F.lit(""), lambda a, x: F.when((x != "") & ~S.is_garbage(x) & (F.size(S.words(x)) > F.size(S.words(a))), x).otherwise(a))
    return F.when(s_ok & d_ok, F.when(F.arrays_overlap(S.words(s), S.words(derived)), s).otherwise(derived)).when(d_ok, derived).when(s_ok, s).otherwise(best)


def validated(query: Column, name: Column, platform: Column, is_new: Column, truth: Column, candidate: Column) -> Column:
    """Whether a match stands: the query's words, the first source, no truth, no candidate salt, or salts that agree."""
    q, n = S.words(S.sync_salt(query)), S.words(S.sync_salt(F.lower(name)))
    bypass = (F.size(q) > 0) & (F.size(n) > 0) & (F.size(F.array_intersect(q, n)) >= 0.75 * F.size(F.array_distinct(q)))
    cand, t = S.sync_salt(candidate), S.sync_salt(truth)
    return bypass | (is_new & (platform == "1mg")) | (F.coalesce(truth, F.lit("")) == "") | (cand == "") | S.overlap(cand, t, empty=False)


def cheapest_of_salt(queries: DataFrame, listings: DataFrame, tie: str) -> DataFrame:
    """Per (query, platform) the cheapest of the ``listings`` (query, platform, sale, found) whose composition is that of the query.

    Compositions are equal without doses and order; a query or listing without one matches nothing. Ties go to the smallest ``tie``.
    """
    wanted = queries.select("query", S.sync_salt(F.col("salt")).alias("__salt")).where("__salt <> ''")
    same = listings.withColumn("__salt", S.sync_salt(F.col("found"))).join(wanted, ["query", "__salt"])
    kept = [c for c in listings.columns if c not in ("query", "platform")]
    best = same.groupBy("query", "platform").agg(F.min_by(F.struct(*kept), F.struct(F.col("sale").isNull(), "sale", tie)).alias("__best"))
    return best.select("query", "platform", *[F.col(f"__best.{c}").alias(c) for c in kept])
