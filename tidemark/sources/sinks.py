"""Sinks as pure transformations of tables, and writers around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put in by key; columns that are null in ``new`` stay as they are."""
    a, b = old.alias("a"), new.alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, on, "full").select(*[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in old.columns])


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of each group in ``new`` take the place of the group's rows in ``old``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def snapshot(df: DataFrame, path: str) -> bool:
    """Write a copy and say whether it has as many rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count() == df.count()


def worklist(df: DataFrame, path: str, kind: str = "tsv") -> None:
    """Tab-separated or JSON lines, for people and for scripts."""
    out = df.write.mode("overwrite")
    if kind == "tsv":
        out.option("sep", "\t").option("header", True).csv(path)
    else:
        out.json(path)
