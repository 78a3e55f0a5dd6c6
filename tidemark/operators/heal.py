"""Repairs that touch nothing that is good: makers, compositions, empty fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import salts as S
from tidemark.functions.common import present

FALSE_MAKERS = sorted(["1mg", "amazon", "amazon pharmacy", "amazon seller", "apollo", "apollo partner", "apollo pharmacy", "information not available", "medplus", "n/a", "na", "netmeds", "pharmeasy", "platinum rx", "platinumrx", "tata 1mg", "truemeds", "unknown"])


def is_false_maker(c: Column, labels: list[str] = FALSE_MAKERS) -> Column:
    """The whole trimmed text is a shop's own name or a placeholder."""
    return F.coalesce(F.lower(F.trim(c)).isin(labels), F.lit(False))


def blank_false_makers(rows: DataFrame, labels: list[str] = FALSE_MAKERS) -> DataFrame:
    return rows.withColumn("manufacturer", F.when(is_false_maker(F.col("manufacturer"), labels), "").otherwise(F.col("manufacturer")))


def heal_report(rows: DataFrame, stored: str, raw: str) -> DataFrame:
    """Number of rows by verdict; each distinct pair of values is judged once."""
    pairs = rows.select(F.col(stored).alias("stored"), F.col(raw).alias("raw")).groupBy("stored", "raw").agg(F.count("*").alias("n"))
    return pairs.select(S.heal(F.col("stored"), F.col("raw"))["verdict"].alias("verdict"), "n").groupBy("verdict").agg(F.sum("n").alias("n"))


def filled_in(old: Column, new: Column) -> Column:
    """A value for an empty field; what is there stays."""
    return F.when(present(old), old).otherwise(new)


def enrich(rows: DataFrame, found: DataFrame, key: str, fields: list[str], force: bool = False) -> DataFrame:
    """``rows`` with empty ``fields`` from ``found`` (all that it has, if ``force``)."""
    f = found.select(key, *[F.col(c).alias(f"_{c}") for c in fields])
    out = rows.join(f, key, "left")
    for c in fields:
        new, old = F.col(f"_{c}"), F.col(c)
        out = out.withColumn(c, F.when(present(new), new).otherwise(old) if force else filled_in(old, new))
    return out.drop(*[f"_{c}" for c in fields])


BAD_KEYS = ("undefined undefinedundefined", "a", "")


def without_bad_keys(rows: DataFrame, key: str, done: str) -> DataFrame:
    """``rows`` with the known bad values of ``key`` as null; there ``done`` is null too, so that the record is enriched again."""
    bad = F.coalesce(F.col(key).isin(*BAD_KEYS), F.lit(False))
    return rows.withColumn(done, F.when(~bad, F.col(done))).withColumn(key, F.when(~bad, F.col(key)))
