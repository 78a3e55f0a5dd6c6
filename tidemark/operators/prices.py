"""Price grids: sanitising, outliers, change history, yields and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.common import cents, filled


def sanitized(prices: DataFrame, factor: int = 25) -> DataFrame:
    """Rows with a positive ``sale``; ``mrp`` lifted to it where lower or absent; ``discount`` in percent.

    Of three or more offers of a medicine, those above ``factor`` times the upper median go.
    """
    ok = prices.withColumns({"sale": F.expr("try_cast(sale AS double)"), "mrp": F.expr("try_cast(mrp AS double)")}).where("sale > 0")
    ok = ok.withColumn("mrp", F.greatest(F.coalesce("mrp", F.lit(0.0)), "sale"))
    return without_outliers(ok, factor).withColumn("discount", cents((F.col("mrp") - F.col("sale")) / F.col("mrp") * 100))


def without_outliers(prices: DataFrame, factor: int = 25) -> DataFrame:
    """Upper median of n sorted offers is number n // 2, counted from 0; offers per medicine are bounded by the platforms."""
    all_ = F.array_sort(F.collect_list("sale").over(Window.partitionBy("medicine_id")))
    marked = prices.withColumn("_all", all_).withColumn("_median", F.element_at("_all", (F.floor(F.size("_all") / 2) + 1).cast("int")))
    return marked.where((F.size("_all") < 3) | (F.col("sale") <= factor * F.col("_median"))).drop("_all", "_median")


def changes(rows: DataFrame) -> DataFrame:
    """Observations that differ from the one before of the same medicine and platform, and each first one."""
    w = Window.partitionBy("medicine_id", "platform").orderBy("scraped_at", "tie")
    marked = rows.select("*", F.lag("sale").over(w).alias("old_sale"), F.lag("mrp").over(w).alias("old_mrp"), F.row_number().over(w).alias("_rn"))
    return marked.where((F.col("_rn") == 1) | ~F.col("sale").eqNullSafe(F.col("old_sale")) | ~F.col("mrp").eqNullSafe(F.col("old_mrp"))).drop("_rn")


def diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """(medicine_id, platform, verdict): insert, change or unchanged against the grid in place."""
    o = old.select("medicine_id", "platform", F.col("sale").alias("_sale"), F.col("mrp").alias("_mrp"), F.lit(True).alias("_old"))
    same = F.col("sale").eqNullSafe(F.col("_sale")) & F.col("mrp").eqNullSafe(F.col("_mrp"))
    return new.join(o, ["medicine_id", "platform"], "left").select("medicine_id", "platform", F.when(F.col("_old").isNull(), "insert").when(same, "unchanged").otherwise("change").alias("verdict"))


def platform_yield(crawl: DataFrame) -> DataFrame:
    found = F.count_if("found")
    return crawl.groupBy("platform").agg(F.count("*").alias("searched"), found.alias("found"), cents(found / F.count("*")).alias("hit_rate"))


def drift_alarms(yields: DataFrame, least: int = 20, low: float = 0.10) -> DataFrame:
    """DEAD: searched often and nothing found; LOW: found in less than ``low`` of the searches."""
    share = F.col("found") / F.col("searched")
    return yields.where((F.col("searched") >= least) & (share < low)).select("platform", "searched", "found", F.when(F.col("found") == 0, "DEAD").otherwise("LOW").alias("alarm"))


def richness(texts: list[str], lists: list[str], others: list[str]) -> Column:
    """Length of texts and lists, and 1 for any other value that is there."""
    total = F.lit(0)
    for c in texts:
        total = total + F.coalesce(F.char_length(c), F.lit(0))
    for c in lists:
        total = total + F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    for c in others:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def completeness_score(columns: list[str]) -> Column:
    """Points for what a record has; columns that it lacks give none."""
    has = lambda c: filled(F.col(c)) if c in columns else F.lit(0)
    some = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) if c in columns else F.lit(0)
    total = has("name") + has("salt") + has("dosage") + has("manufacturer") + has("image_url")
    if "description" in columns:
        total = total + F.when(F.char_length("description") > 20, 2).otherwise(0)
    total = total + F.when(some("faq") > 0, 1).otherwise(0) + F.when(some("side_effects") > 0, 1).otherwise(0) + some("source_platforms")
    return total + (F.when(F.col("llm_enriched"), 3).otherwise(0) if "llm_enriched" in columns else F.lit(0))


def standard_discount(sale: Column, mrp: Column) -> Column:
    return F.when(mrp > sale, (mrp - sale) / mrp * 100).otherwise(0.0)


def hot_score(d7: Column, prior: Column, stale_hours: Column) -> Column:
    """Demand of the last week, weighted by its trend, and half a point for each stale hour."""
    trend = F.when(d7 < 10, 1.0).otherwise(F.least(F.lit(2.5), F.greatest(F.lit(0.5), (d7 + 10.0) / (prior + 10.0))))
    return d7 * trend + F.lit(0.5) * stale_hours
