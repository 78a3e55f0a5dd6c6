"""Flagship plan and the dashboard aggregates: grids, distributions, completeness, recency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.common import cents, filled, rounded
from tidemark.operators import prices as P
from tidemark.plans import views as V
from tidemark.plans.views import duck
from tidemark.registry import op
from tidemark.sources.tables import table

_R2 = "floor(({}) * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE)"


@op("st1_n1_j1_price_grid", duck("""
m AS (SELECT medicine_id, count(*) AS n, list_sort(list(sale))[count(*) // 2 + 1] AS median FROM price WHERE sale > 0 GROUP BY 1)
SELECT medicine_id, min(sale) AS lowest_price, count(*) AS n_platforms FROM price JOIN m USING (medicine_id) WHERE sale > 0 AND (n < 3 OR sale <= 25 * median) GROUP BY medicine_id""", "price"))  # fmt: skip
def price_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest current price and number of platforms per medicine: sanitised, latest per platform."""
    return P.sanitized(V.price(spark, sf_dir)).groupBy("medicine_id").agg(F.min("sale").alias("lowest_price"), F.count("*").alias("n_platforms"))


@op("a1_platform_distribution", duck("SELECT platform, count(*) AS n FROM price GROUP BY platform", "price"))
def a1(spark, d):
    return V.price(spark, d).groupBy("platform").agg(F.count("*").alias("n"))


@op("a2_prices_per_medicine", duck(f"SELECT count(*) AS with_prices, {_R2.format('CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE)')} AS avg_prices FROM (SELECT medicine_id, count(*) AS n FROM price GROUP BY 1)", "price"))
def a2(spark, d):
    per = V.price(spark, d).groupBy("medicine_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("with_prices"), cents(F.sum("n") / F.count("*")).alias("avg_prices"))


@op("a3_price_count_histogram", duck("""
per AS (SELECT medicine_id, least(count(*), 5) AS b FROM price GROUP BY 1), t AS (SELECT count(*) AS total FROM med), dim AS (SELECT unnest([1, 2, 3, 4, 5]) AS b)
SELECT CASE WHEN dim.b = 5 THEN '5+' ELSE CAST(dim.b AS VARCHAR) END AS bucket, count(per.b) AS n, floor(CAST(count(per.b) AS DOUBLE) * 100 / any_value(total) * CAST(10 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(10 AS DOUBLE) AS pct
FROM dim CROSS JOIN t LEFT JOIN per ON per.b = dim.b GROUP BY dim.b""", "med", "price"))  # fmt: skip
def a3(spark, d):
    """Buckets without rows are kept; shares are of all medicines."""
    per = V.price(spark, d).groupBy("medicine_id").agg(F.least(F.count("*"), F.lit(5)).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    total = V.med(spark, d).agg(F.count("*").alias("total")).scalar()
    dim = spark.range(1, 6).select(F.col("id").alias("b"))
    n = F.coalesce("n", F.lit(0))
    return dim.join(per, "b", "left").select(F.when(F.col("b") == 5, "5+").otherwise(F.col("b").cast("string")).alias("bucket"), n.alias("n"), rounded(n.cast("double") * 100 / total, 1).alias("pct"))


@op("a4_unique_salts", duck("SELECT count(DISTINCT salt_key) AS unique_salts, count(DISTINCT lower(trim(name))) AS unique_names FROM med", "med"))
def a4(spark, d):
    return V.med(spark, d).agg(F.countDistinct("salt_key").alias("unique_salts"), F.countDistinct(F.lower(F.trim("name"))).alias("unique_names"))


@op("a5_top_salts", duck("SELECT salt_key, count(*) AS n FROM med WHERE salt_key IS NOT NULL AND trim(salt_key) <> '' GROUP BY 1 ORDER BY n DESC, salt_key LIMIT 15", "med"))
def a5(spark, d):
    return V.med(spark, d).where(filled(F.col("salt_key")) == 1).groupBy("salt_key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "salt_key").limit(15)


@op("a6_field_completeness", duck("""
one AS (SELECT count(*) AS t, sum(CASE WHEN trim(coalesce(description, '')) <> '' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN trim(coalesce(lang, '')) <> '' THEN 1 ELSE 0 END) AS b, sum(CASE WHEN llm_enriched IS NOT NULL THEN 1 ELSE 0 END) AS c FROM doc)
SELECT field, CAST(n AS BIGINT) AS n, CAST(floor(CAST(n AS DOUBLE) / t * 100 + CAST(0.5 AS DOUBLE)) AS BIGINT) AS pct FROM (SELECT t, unnest(['description', 'lang', 'llm_enriched']) AS field, unnest([a, b, c]) AS n FROM one)""", "doc"))  # fmt: skip
def a6(spark, d):
    """One scan, then unpivoted."""
    one = V.doc(spark, d).agg(F.count("*").alias("t"), F.sum(filled(F.col("description"))).alias("a"), F.sum(filled(F.col("lang"))).alias("b"), F.sum(F.col("llm_enriched").isNotNull().cast("int")).alias("c"))
    flat = one.select("t", F.expr("stack(3, 'description', a, 'lang', b, 'llm_enriched', c) AS (field, n)"))
    return flat.select("field", "n", F.floor(F.col("n") / F.col("t") * 100 + 0.5).alias("pct"))


@op("a7_price_ranges", duck("""
per AS (SELECT medicine_id, count(*) AS n, min(sale) AS lo, max(sale) AS hi FROM price GROUP BY 1 ORDER BY n DESC, medicine_id LIMIT 20)
SELECT medicine_id, coalesce(name, 'Unknown') AS name, n, lo, hi FROM per LEFT JOIN med USING (medicine_id)""", "med", "price"))  # fmt: skip
def a7(spark, d):
    """The top 20 are cut before names are joined."""
    per = V.price(spark, d).groupBy("medicine_id").agg(F.count("*").alias("n"), F.min("sale").alias("lo"), F.max("sale").alias("hi")).orderBy(F.desc("n"), "medicine_id").limit(20)
    return per.join(V.med(spark, d).select("medicine_id", "name"), "medicine_id", "left").select("medicine_id", F.coalesce("name", F.lit("Unknown")).alias("name"), "n", "lo", "hi")


@op("a9_duplicate_keys", duck("SELECT lower(title) AS key, count(*) AS n, array_to_string(list_transform(list_sort(list(medicine_id)), lambda x: CAST(x AS VARCHAR)), ',') AS ids FROM med GROUP BY 1 HAVING count(*) > 1", "med"))
def a9(spark, d):
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("medicine_id")), lambda x: x.cast("string")), ",")
    return V.med(spark, d).groupBy(F.lower("title").alias("key")).agg(F.count("*").alias("n"), ids.alias("ids")).where("n > 1")


@op("a14_outlier_guard", duck(f"""
m AS (SELECT medicine_id, count(*) AS n, list_sort(list(sale))[count(*) // 2 + 1] AS median FROM price WHERE sale > 0 GROUP BY 1)
SELECT medicine_id, platform, sale FROM price JOIN m USING (medicine_id) WHERE sale > 0 AND (n < 3 OR sale <= 25 * median)""", "price"))  # fmt: skip
def a14(spark, d):
    return P.without_outliers(V.price(spark, d).where("sale > 0")).select("medicine_id", "platform", "sale")


@op("a15_platform_yield", duck(f"SELECT platform, count(*) AS searched, count(*) FILTER (found) AS found, {_R2.format('CAST(count(*) FILTER (found) AS DOUBLE) / CAST(count(*) AS DOUBLE)')} AS hit_rate FROM crawl GROUP BY 1", "crawl"))
def a15(spark, d):
    return P.platform_yield(V.crawl(spark, d))


@op("a16_drift_alarms", duck("""
y AS (SELECT platform || '-' || CAST(date_part('day', ts) AS BIGINT) AS platform, count(*) AS searched, count(*) FILTER (found) AS found FROM crawl GROUP BY 1)
SELECT platform, searched, found, CASE WHEN found = 0 THEN 'DEAD' ELSE 'LOW' END AS alarm FROM y WHERE searched >= 20 AND CAST(found AS DOUBLE) / searched < 0.3""", "crawl"))  # fmt: skip
def a16(spark, d):
    days = V.crawl(spark, d).withColumn("platform", F.concat_ws("-", "platform", F.dayofmonth("ts").cast("string")))
    return P.drift_alarms(P.platform_yield(days), low=0.3)


@op("a18_coverage", duck("SELECT platform, count(DISTINCT medicine_id) AS n_medicines, (SELECT count(DISTINCT medicine_id) FROM price) AS covered FROM price GROUP BY platform", "price"))
def a18(spark, d):
    prices = V.price(spark, d).select("medicine_id", "platform")
    any_ = prices.agg(F.countDistinct("medicine_id").alias("covered")).scalar()
    return prices.groupBy("platform").agg(F.countDistinct("medicine_id").alias("n_medicines")).select("platform", "n_medicines", any_.alias("covered"))


@op("a19_run_summary", duck("SELECT count(*) AS extracted, count(*) FILTER (sale > 0) AS transformed, count(*) FILTER (NOT coalesce(sale > 0, false)) AS rejected FROM listing", "listing"))
def a19(spark, d):
    ok = F.coalesce(F.col("sale") > 0, F.lit(False))
    return V.listing(spark, d).agg(F.count("*").alias("extracted"), F.count_if(ok).alias("transformed"), F.count_if(~ok).alias("rejected"))


@op("a20_call_groups", duck(f"""
g AS (SELECT coalesce(nullif(trim(salt_key), ''), 'doc:' || medicine_id) AS key, count(*) AS n FROM med GROUP BY 1)
SELECT count(*) AS calls, CAST(sum(n) AS BIGINT) AS rows_served, {_R2.format('CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE)')} AS ratio FROM g""", "med"))  # fmt: skip
def a20(spark, d):
    key = F.coalesce(F.nullif(F.trim("salt_key"), F.lit("")), F.concat(F.lit("doc:"), F.col("medicine_id").cast("string")))
    return V.med(spark, d).groupBy(key.alias("key")).agg(F.count("*").alias("n")).agg(F.count("*").alias("calls"), F.sum("n").alias("rows_served"), cents(F.sum("n") / F.count("*")).alias("ratio"))


@op("a21_richness", duck("SELECT doc_id, coalesce(length(description), 0) + coalesce(length(lang), 0) + coalesce(length(source), 0) + CASE WHEN llm_enriched IS NOT NULL THEN 1 ELSE 0 END AS richness FROM doc", "doc"))
def a21(spark, d):
    return V.doc(spark, d).select("doc_id", P.richness(["description", "lang", "source"], [], ["llm_enriched"]).cast("long").alias("richness"))


@op("a22_completeness_score", duck("""
p AS (SELECT medicine_id, count(DISTINCT platform) AS k FROM price GROUP BY 1)
SELECT medicine_id, 1 + CASE WHEN trim(salt_key) <> '' THEN 1 ELSE 0 END + 1 + 1 + CASE WHEN length(title) > 20 THEN 2 ELSE 0 END + coalesce(k, 0) AS score FROM med LEFT JOIN p USING (medicine_id)""", "med", "price"))  # fmt: skip
def a22(spark, d):
    p = V.price(spark, d).groupBy("medicine_id").agg(F.collect_set("platform").alias("source_platforms"))
    m = V.med(spark, d).join(p, "medicine_id", "left").select("medicine_id", "name", F.col("salt_key").alias("salt"), F.col("strength").alias("dosage"), "manufacturer", F.col("title").alias("description"), "source_platforms")
    return m.select("medicine_id", P.completeness_score(m.columns).cast("long").alias("score"))


@op("a23_enrichment_status", duck("SELECT source, count(*) AS n, count(*) FILTER (llm_enriched) AS enriched, CAST(floor(CAST(count(*) FILTER (llm_enriched) AS DOUBLE) / count(*) * 1000 + CAST(0.5 AS DOUBLE)) AS DOUBLE) / 10 AS pct FROM doc GROUP BY 1", "doc"))
def a23(spark, d):
    n = F.count_if("llm_enriched")
    return V.doc(spark, d).groupBy("source").agg(F.count("*").alias("n"), n.alias("enriched"), rounded(n / F.count("*") * 100, 1).alias("pct"))


@op("a24_recency", "SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-30') AS last_day, count(*) FILTER (ts >= TIMESTAMP '2024-01-24') AS last_week FROM events")
def a24(spark, d):
    since = lambda days: F.count_if(F.col("ts") >= F.lit(V.AS_OF).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))
    return table(spark, d, "events").agg(since(1).alias("last_day"), since(7).alias("last_week"))


@op("w18_price_changes", duck("""
h AS (SELECT medicine_id, platform, sale, mrp, scraped_at, t1, t2, t3, lag(sale) OVER w AS old_sale, lag(mrp) OVER w AS old_mrp, row_number() OVER w AS rn FROM listing WINDOW w AS (PARTITION BY medicine_id, platform ORDER BY scraped_at, t1, t2, t3))
SELECT medicine_id, platform, scraped_at, sale, old_sale FROM h WHERE rn = 1 OR sale <> old_sale OR mrp <> old_mrp""", "listing"))  # fmt: skip
def w18(spark, d):
    return P.changes(V.listing(spark, d)).select("medicine_id", "platform", "scraped_at", "sale", "old_sale")
