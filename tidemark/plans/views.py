"""Catalogue views over the benchmark tables, as DataFrames and as DuckDB common table expressions.

Parts stand for medicines, line items for price listings, events for demand, orders for the work
queue, documents for descriptions, conversations for questions and answers, pages for crawled html.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.common import cents
from tidemark.sources.tables import table

PLATFORMS = ("1mg", "apollo", "pharmeasy", "netmeds", "truemeds", "medplus", "platinumrx", "amazon")
FORMS = {"ECONOMY": "tablet", "STANDARD": "capsule", "SMALL": "drops", "MEDIUM": "syrup", "LARGE": "injection", "PROMO": "cream"}
LISTING_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
AS_OF = "2024-01-31"


def med(spark: SparkSession, d: str) -> DataFrame:
    form = F.element_at(F.create_map(*[F.lit(x) for kv in FORMS.items() for x in kv]), F.col("p_type"))
    base = table(spark, d, "part").select(F.col("p_partkey").alias("medicine_id"), F.col("p_name").alias("name"), form.alias("form"), F.concat(F.col("p_size").cast("string"), F.lit("mg")).alias("strength"), F.col("p_size").alias("size"), F.col("p_brand").alias("manufacturer"), F.col("p_retailprice").alias("mrp"), F.element_at(F.split("p_name", " "), 2).alias("salt_key"))
    return base.withColumn("title", F.concat_ws(" ", "name", "strength", "form"))


def listing(spark: SparkSession, d: str) -> DataFrame:
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    platform = F.element_at(F.array(*[F.lit(p) for p in PLATFORMS]), (F.col("l_suppkey") % 8 + 1).cast("int"))
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("medicine_id"), platform.alias("platform"), cents(unit).alias("mrp"), cents(F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")).alias("sale"), F.col("l_shipdate").alias("scraped_at"), F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("tie"))


def latest(rows: DataFrame) -> DataFrame:
    """The newest row per (medicine, platform): late observations never replace newer ones."""
    rest = [c for c in rows.columns if c not in ("medicine_id", "platform")]
    newest = F.max_by(F.struct(*rest), F.struct("scraped_at", *[f"tie.{c}" for c in ("l_orderkey", "l_linenumber", "l_suppkey")]))
    best = rows.groupBy("medicine_id", "platform").agg(newest.alias("_r"))  # one row a key and task is shuffled
    return best.select(*[F.col(c) if c not in rest else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def price(spark: SparkSession, d: str) -> DataFrame:
    return latest(listing(spark, d)).drop("tie")


def demand(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.col("user_id").alias("medicine_id"), F.to_date("ts").alias("date")).agg(F.count("*").alias("search_hits"))


def state(spark: SparkSession, d: str) -> DataFrame:
    status = F.element_at(F.create_map(*[F.lit(x) for kv in {"F": "SUCCESS", "O": "READY", "P": "IN_PROGRESS"}.items() for x in kv]), F.col("o_orderstatus"))
    return table(spark, d, "orders").select(F.lpad(F.lower(F.hex("o_orderkey")), 24, "0").alias("id"), status.alias("status"), F.col("o_orderdate").alias("last_synced_at"), F.col("o_custkey").alias("run_id"), (F.col("o_orderkey") % 7).alias("failures"))


def doc(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.col("text").alias("description"), "lang", "source")
    marks = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("llm_enriched"))
    return rows.join(marks, "doc_id", "left")


def faq(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("text").over(w).alias("answer"), F.lead("role").over(w).alias("next_role"))
    return rows.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select("conv_id", "turn", "question", "answer")


def crawl(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_type").alias("platform"), (F.col("value") > 10).alias("found"), "ts")


_FORM_CASE = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FORMS.items()) + " END"
_CENTS = "floor(({}) * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE)"
_PLATFORM_LIST = "[" + ", ".join(f"'{p}'" for p in PLATFORMS) + "]"

#: DuckDB definitions, by name, in an order in which each uses earlier ones alone.
SQL = {
    "med": f"SELECT p_partkey AS medicine_id, p_name AS name, {_FORM_CASE} AS form, p_size || 'mg' AS strength, p_size AS size, p_brand AS manufacturer, p_retailprice AS mrp, split_part(p_name, ' ', 2) AS salt_key, p_name || ' ' || p_size || 'mg ' || {_FORM_CASE} AS title FROM part",
    "listing": f"SELECT l_partkey AS medicine_id, ({_PLATFORM_LIST})[l_suppkey % 8 + 1] AS platform, {_CENTS.format('l_extendedprice / l_quantity')} AS mrp, {_CENTS.format('l_extendedprice * (1 - l_discount) / l_quantity')} AS sale, l_shipdate AS scraped_at, l_orderkey AS t1, l_linenumber AS t2, l_suppkey AS t3 FROM lineitem",
    "price": "SELECT medicine_id, platform, mrp, sale, scraped_at FROM listing QUALIFY row_number() OVER (PARTITION BY medicine_id, platform ORDER BY scraped_at DESC, t1 DESC, t2 DESC, t3 DESC) = 1",
    "demand": "SELECT user_id AS medicine_id, CAST(ts AS DATE) AS date, count(*) AS search_hits FROM events GROUP BY 1, 2",
    "state": "SELECT lpad(lower(to_hex(o_orderkey)), 24, '0') AS id, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'READY' WHEN 'P' THEN 'IN_PROGRESS' END AS status, o_orderdate AS last_synced_at, o_custkey AS run_id, o_orderkey % 7 AS failures FROM orders",
    "doc": "SELECT doc_id, text AS description, lang, source, quality = 1 AS llm_enriched FROM documents LEFT JOIN labels USING (doc_id)",
    "faq": "SELECT conv_id, turn, question, answer FROM (SELECT conv_id, turn, role, text AS question, lead(text) OVER w AS answer, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant'",
    "crawl": "SELECT event_type AS platform, value > 10 AS found, ts FROM events",
}


def duck(body: str, *names: str) -> str:
    """A DuckDB query over the named views (``price`` brings ``listing``)."""
    wanted = {*names, *({"listing"} if "price" in names else ())}
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in SQL if n in wanted) + ("\n" if body.lstrip().upper().startswith("SELECT") else ",\n") + body
