"""Merges, gates, searches, leases, imports and streams over views and known cases."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import dosage as D
from tidemark.functions import records as C
from tidemark.functions import salts as S
from tidemark.functions import text as T
from tidemark.operators import gate as G
from tidemark.operators import heal as H
from tidemark.operators import identity as I
from tidemark.operators import merge as M
from tidemark.operators import queue as Q
from tidemark.operators import ranking as R
from tidemark.operators import search as SE
from tidemark.plans import views as V
from tidemark.plans.goldens import golden
from tidemark.plans.views import duck
from tidemark.registry import op
from tidemark.sources.tables import table


@op("a10_a11_merge", duck("""
x AS (SELECT name AS key, medicine_id AS ord, title, manufacturer, CASE WHEN size % 3 = 0 THEN strength END AS dosage, CASE WHEN size % 2 = 0 THEN form END AS image FROM med)
SELECT key, arg_max(title, (length(title), -ord)) AS title, arg_max(manufacturer, (length(manufacturer), -ord)) AS manufacturer, arg_min(dosage, ord) FILTER (dosage IS NOT NULL) AS dosage, arg_max(image, ord) FILTER (image IS NOT NULL) AS image FROM x GROUP BY key""", "med"))  # fmt: skip
def a10(spark, d):
    x = V.med(spark, d).select(F.col("name").alias("key"), F.col("medicine_id").alias("ord"), "title", "manufacturer", F.when(F.col("size") % 3 == 0, F.col("strength")).alias("dosage"), F.when(F.col("size") % 2 == 0, F.col("form")).alias("image"))
    return M.merged(x, "key", "ord", long=["title", "manufacturer"], first=["dosage"], last=["image"])


@op("a12_a13_set_union", duck("SELECT name AS key, array_to_string(list_sort(list(DISTINCT form)), ',') AS forms, array_to_string(list_sort(list(DISTINCT manufacturer)), ',') AS makers FROM med GROUP BY 1", "med"))
def a12(spark, d):
    x = V.med(spark, d).select(F.col("name").alias("key"), F.col("medicine_id").alias("ord"), F.array("form").alias("forms"), F.array("manufacturer").alias("makers"))
    m = M.merged(x, "key", "ord", lists=["forms", "makers"])
    return m.select("key", F.array_join(F.array_sort("forms"), ",").alias("forms"), F.array_join(F.array_sort("makers"), ",").alias("makers"))


@op("a17_heal_verdicts", duck("SELECT 'OK' AS verdict, count(*) AS n FROM med WHERE length(salt_key) >= 4 UNION ALL SELECT 'UNFIXABLE', count(*) FROM med WHERE length(salt_key) < 4 HAVING count(*) > 0", "med"))
def a17(spark, d):
    return H.heal_report(V.med(spark, d), "salt_key", "salt_key")


@op("w1_best_listing", duck("""
q AS (SELECT name AS query_name, min(size) AS qs, any_value(split_part(name, ' ', 1)) AS adj, any_value(salt_key) AS noun FROM med GROUP BY 1),
c AS (SELECT query_name || ' ' || qs || 'mg' AS query, platform, medicine_id, (CASE WHEN contains(title, adj) THEN 0.5::DOUBLE ELSE -1.0::DOUBLE END + 0.2::DOUBLE) + CASE WHEN size = qs THEN 0.4::DOUBLE ELSE -0.5::DOUBLE END
  + CASE WHEN form = 'injection' THEN -0.6::DOUBLE WHEN form IN ('cream', 'drops', 'syrup') THEN -0.3::DOUBLE ELSE 0::DOUBLE END AS s FROM price JOIN med USING (medicine_id) JOIN q ON q.noun = med.salt_key),
k AS (SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, s)) AS score FROM c)
SELECT query, platform, medicine_id, CAST(round_even(score * 100, 0) AS INTEGER) AS match_percentage FROM k QUALIFY row_number() OVER (PARTITION BY query, platform ORDER BY score DESC, medicine_id) = 1 AND score >= 0.2""", "med", "price"))  # fmt: skip
def w1(spark, d):
    """Queries by name and dose against all listings of their second word, scored by relevance."""
    m = V.med(spark, d)
    q = m.groupBy("name").agg(F.min("size").alias("qs"), F.first("salt_key").alias("salt_key")).select("salt_key", F.concat("name", F.lit(" "), F.col("qs").cast("string"), F.lit("mg")).alias("query"))
    # Scores are of titles, so each title is scored once for a query, and of its listings on a platform the first stands for all.
    scored = m.select("title", "salt_key").distinct().join(q, "salt_key").select("title", "salt_key", "query", I.relevance(F.col("query"), F.col("title")).alias("score"))
    first = V.price(spark, d).select("medicine_id", "platform").join(m.select("medicine_id", "title", "salt_key"), "medicine_id").groupBy("title", "salt_key", "platform").agg(F.min("medicine_id").alias("medicine_id"))
    c = first.join(scored, ["title", "salt_key"]).withColumn("ord", F.col("medicine_id"))
    return R.best_listing(c).select("query", "platform", "medicine_id", "match_percentage")


@op("search_cascade", duck("""
q AS (SELECT unnest(['widget', 'small', 'ge', 'nothing']) AS query),
e AS (SELECT query, 1 AS branch, medicine_id, title FROM q JOIN med ON salt_key = query UNION ALL SELECT query, 2, medicine_id, title FROM q JOIN med ON list_contains(string_split(title, ' '), query) UNION ALL SELECT query, 3, medicine_id, title FROM q JOIN med ON starts_with(salt_key, query)),
b AS (SELECT *, min(branch) OVER (PARTITION BY query) AS first FROM e)
SELECT query, branch, medicine_id FROM b WHERE branch = first QUALIFY row_number() OVER (PARTITION BY query ORDER BY title, medicine_id) <= CASE branch WHEN 2 THEN 25 ELSE 50 END""", "med"))  # fmt: skip
def search(spark, d):
    return SE.cascade(spark.createDataFrame([("widget",), ("small",), ("ge",), ("nothing",)], "query string"), V.med(spark, d))


@op("st1_latest_wins", duck("SELECT medicine_id, platform, sale FROM price", "price"))
def st1(spark, d):
    return V.latest(V.listing(spark, d)).select("medicine_id", "platform", "sale")


@op("st1_st4_stream_changes", duck("""
x AS (SELECT medicine_id, platform, scraped_at, sale, row_number() OVER (ORDER BY scraped_at, t1, t2, medicine_id, t3) AS seq FROM listing),
h AS (SELECT *, lag(sale) OVER (PARTITION BY medicine_id, platform ORDER BY scraped_at, seq) AS old_sale FROM x)
SELECT medicine_id, platform, scraped_at, sale, old_sale FROM h WHERE old_sale IS NULL OR sale <> old_sale""", "listing"))  # fmt: skip
def st14(spark, d):
    """The streaming form over files, run to their end, must give the batch answer; the sequence numbers count within a key, so no task sorts the whole table."""
    from pyspark.sql.window import Window

    from tidemark.sources.folders import shared
    from tidemark.streaming.prices import drained, monotone

    base = shared(spark)
    rows = V.listing(spark, d).withColumn("seq", F.row_number().over(Window.partitionBy("medicine_id", "platform").orderBy("scraped_at", "tie.l_orderkey", "tie.l_linenumber", "tie.l_suppkey")).cast("long"))
    src = f"{base}/in-{uuid.uuid4().hex}"
    rows.select("medicine_id", "platform", "scraped_at", "seq", "sale").write.parquet(src)
    stream = spark.readStream.schema("medicine_id long, platform string, scraped_at timestamp, seq long, sale double").parquet(src)
    return drained(monotone(stream), f"{src}-out", f"{src}-ck").select("medicine_id", "platform", "scraped_at", "sale", "old_sale")


_NOW = "2024-01-01"
_STATE = [("a", "READY", None, 0), ("b", "IN_PROGRESS", "r1", 0), ("c", "IN_PROGRESS", "r1", 4), ("d", "IN_PROGRESS", "r1", 1), ("e", "IN_PROGRESS", "r1", 2), ("f", "SUCCESS", None, 0)]
_EVENTS = [("a", "r9", "claim"), ("b", "r1", "success"), ("c", "r1", "failure"), ("d", "r2", "success"), ("e", "r1", "heartbeat")]


@op("st2_st9_leases", "SELECT * FROM (VALUES ('a', 'IN_PROGRESS', 'r9', 0, 'CLAIMED'), ('b', 'SUCCESS', CAST(NULL AS VARCHAR), 0, 'DONE'), ('c', 'FAILED', NULL, 5, 'RETRY'), ('d', 'IN_PROGRESS', 'r1', 1, 'OWNERSHIP_LOST_ABORTED'), ('e', 'IN_PROGRESS', 'r1', 2, 'TOUCHED'), ('f', 'SUCCESS', NULL, 0, 'NONE')) t(id, status, run_id, failures, outcome)")
def st2(spark, d):
    return Q.transition(spark.createDataFrame(_STATE, "id string, status string, run_id string, failures int"), spark.createDataFrame(_EVENTS, "id string, run_id string, event string"))


_STAGING = [
    (1, "Dolo 650 Tablet", "Paracetamol", "Micro Labs", "", [(30.0, 28.0)]), (2, "Dolo 650 Tablet 10s", "Paracetamol", "Micro Labs", "", [(30.0, 29.0)]), (3, "Crocin 500 Tablet", "Paracetamol", "", "", [(10.0, 9.0)]),
    (4, "Zen 5mg Tablet", "active composition consists", "Zen", "", [(10.0, 9.0)]), (5, "Buy 2 Zed 5mg Tablet", "Ibuprofen", "Zed", "", [(1.0, 2.0)]), (6, "Known 10mg Capsule", "Cefixime", "Kn", "", [(5.0, 5.0)]), (7, None, None, None, None, None),
]


@op("p4_e27_promotion", """SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'PROMOTED_NEW', 'new:1', ''), (2, 'MERGED_EXISTING', 'new:1', ''), (3, 'VALIDATION_FAILED', NULL, 'MANUFACTURER_MISSING'), (4, 'VALIDATION_FAILED', NULL, 'INVALID_MOLECULAR_SALT'),
 (5, 'VALIDATION_FAILED', NULL, 'MARKETING_IN_NAME|PRICE_INVALID'), (6, 'MERGED_EXISTING', '77', ''), (7, 'VALIDATION_FAILED', NULL, 'NAME_MISSING|SALT_MISSING|MANUFACTURER_MISSING|FORM_MISSING|STRENGTH_MISSING|PRICE_INVALID')) t(id, outcome, canonical_id, reasons)""")  # fmt: skip
def e27(spark, d):
    staging = spark.createDataFrame(_STAGING, f"id long, raw_name string, raw_salt string, raw_manufacturer string, raw_form string, raw_prices {G.PRICES}")
    known = spark.createDataFrame([("Known 10mg Capsule", "Cefixime")], "n string, s string").select(F.lit(77).alias("medicine_id"), F.lit("x").alias("resolution_signature"), F.array(I.signature(F.col("n"), F.col("s"), F.lit(""))).alias("known_signatures"))
    return G.promote(staging, known)


@op("e28_m1_m13_enrich", duck("SELECT medicine_id, CASE WHEN size % 2 = 0 THEN title ELSE coalesce(nullif(manufacturer, 'Brand#1'), 'none') END AS note FROM med WHERE manufacturer IS NOT NULL", "med"))
def e28(spark, d):
    m = V.med(spark, d)
    rows = m.select("medicine_id", F.when(F.col("size") % 2 == 0, F.col("title")).otherwise(F.lit(" ")).alias("note"))
    found = m.select("medicine_id", F.when(F.col("manufacturer") == "Brand#1", "none").otherwise(F.col("manufacturer")).alias("note"))
    return H.enrich(rows, found, "medicine_id", ["note"])


@op("src9_m17_aggregator", "SELECT * FROM (VALUES ('Dolo 650', '1mg', CAST(30.5 AS DOUBLE), 'SAVE10'), ('Dolo 650', 'apollo', 31, NULL)) t(name, store, price, coupon)")
def src9(spark, d):
    """A nested payload, exploded; coupons by store."""
    payload = '{"medicines":[{"brand_name":"Dolo 650","store_prices":[{"store":"1mg","price":30.5},{"store":"apollo","price":31}],"coupons":{"1mg":[{"code":"SAVE10"}]}}],"total":1}'
    shape = "medicines array<struct<brand_name:string,store_prices:array<struct<store:string,price:double>>,coupons:map<string,array<struct<code:string>>>>>, total int"
    flat = spark.createDataFrame([(payload,)], "j string").select(F.explode(F.from_json("j", shape)["medicines"]).alias("m")).select("m.brand_name", "m.coupons", F.explode("m.store_prices").alias("s"))
    return flat.select(F.col("brand_name").alias("name"), F.col("s.store").alias("store"), F.col("s.price").alias("price"), F.try_element_at("coupons", F.col("s.store"))[0]["code"].alias("coupon"))


@op("m11_bookkeeping", duck("SELECT medicine_id, array_to_string(list_sort(list_distinct(['dosage', CASE WHEN size % 2 = 0 THEN 'uses' ELSE 'dosage' END])), ',') AS fields FROM med", "med"))
def m11(spark, d):
    old, new = F.array(F.lit("dosage")), F.array(F.when(F.col("size") % 2 == 0, "uses").otherwise("dosage"))
    return V.med(spark, d).select("medicine_id", F.array_join(F.array_sort(F.array_union(old, new)), ",").alias("fields"))


@op("m15_dosage_backfill", duck("SELECT medicine_id, 'name:' || name || '|dose:' || strength AS canonical_key, strength AS dosage FROM med", "med"))
def m15(spark, d):
    dose = D.best_dose(F.col("title"))
    return V.med(spark, d).select("medicine_id", F.concat(F.lit("name:"), F.col("name"), F.lit("|dose:"), dose).alias("canonical_key"), dose.alias("dosage"))


@op("t15_transform", duck("SELECT medicine_id, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS cleaned, strength AS dosage, 'name:' || name || '|dose:' || strength AS key FROM med", "med"))
def t15(spark, d):
    """Raw title to record in one projection."""
    dose = D.best_dose(F.col("title"))
    return V.med(spark, d).select("medicine_id", T.plain(F.col("title")).alias("cleaned"), dose.alias("dosage"), F.concat(F.lit("name:"), F.trim(F.regexp_replace(T.without_words(T.plain(F.col("name")), ["strip"]), r"\s+", " ")), F.lit("|dose:"), dose).alias("key"))


@op("m3_default_filler", duck("SELECT doc_id, coalesce(CASE WHEN llm_enriched THEN lang END, 'not known') AS note FROM doc", "doc"))
def m3(spark, d):
    return V.doc(spark, d).select("doc_id", F.coalesce(F.when(F.col("llm_enriched"), F.col("lang")), F.lit("not known")).alias("note"))


@op("m9_key_overlap", duck("SELECT a.medicine_id, b.medicine_id AS other_id FROM med a JOIN med b ON a.title = b.title AND a.medicine_id < b.medicine_id AND b.medicine_id = (SELECT min(medicine_id) FROM med c WHERE c.title = a.title AND c.medicine_id > a.medicine_id)", "med"))
def m9(spark, d):
    """Each record with the next one under its match key."""
    from pyspark.sql.window import Window

    nxt = F.lead("medicine_id").over(Window.partitionBy("title").orderBy("medicine_id"))
    return V.med(spark, d).select("medicine_id", nxt.alias("other_id")).where("other_id IS NOT NULL")


golden("e21_validated", ["q", "n", "p", "t", "c"], [("Dolo 650", "Dolo 650", "apollo", "Paracetamol", "Ibuprofen", True), ("Dolo 650", "Calpol 650", "apollo", "Paracetamol", "Paracetamol 500mg", True), ("Dolo 650", "Brufen", "apollo", "Paracetamol", "Ibuprofen", False), ("Dolo 650", "Brufen", "apollo", "", "Ibuprofen", True), ("Dolo 650", "Brufen", "apollo", "Paracetamol", "", True)], lambda q, n, p, t, c: M.validated(q, n, p, F.lit(False), t, c))
golden("e23_cluster_salt", ["s", "r", "o"], [("brucare", "Ibuprofen 600mg", "", "ibuprofen"), ("cefixime", "a", "", "cefixime"), ("", "", "x;ibuprofen;ibuprofen paracetamol", "ibuprofen paracetamol"), ("ibuprofen", "Ibuprofen + Paracetamol", "", "ibuprofen")], lambda s, r, o: M.cluster_salt(s, r, F.split(o, ";")))
golden("t23_list", ["s"], [("a\nb\n\n a ", ["a", "b"])], lambda s: F.array_distinct(F.filter(F.transform(F.split(s, r"\n+"), lambda x: F.trim(x)), lambda x: x != "")))
golden("t25_clean_salt", ["s"], [("Paracetamol (500mg) + Caffeine (32mg) view all", "Paracetamol (500mg) + Caffeine (32mg)"), ("PARACETAMOL-500MG+CAFFEINE-32MG order", "PARACETAMOL-500MG+CAFFEINE-32MG"), ("Ibuprofen tablets. Take daily", "Ibuprofen tablets"), ("view company page", None), ("Zinc " * 30, None), ("", None), (None, None)], C.salvaged_salt)
golden("t28_query_variations", ["brand", "dose", "form", "salt"], [("dolo", "650mg", "tablet", "paracetamol", ["dolo 650mg tablet", "dolo 650mg", "dolo 650 mg tablet", "dolo", "paracetamol 650mg", "paracetamol"])], lambda b, d, f, s: F.array_distinct(F.array(F.concat_ws(" ", b, d, f), F.concat_ws(" ", b, d), F.concat_ws(" ", b, F.regexp_replace(d, r"(\d)([a-z])", "$1 $2"), f), b, F.concat_ws(" ", s, d), s)))
golden("t31_composition", ["s"], [("a combination of Paracetamol and Caffeine", "Paracetamol and Caffeine"), ("works by active uses", "")], lambda s: F.when(S.is_molecular(S.salt_key(F.regexp_replace(s, r"(?i)^(?:a\s+)?combination of\s+", ""))), F.regexp_replace(s, r"(?i)^(?:a\s+)?combination of\s+", "")).otherwise(""))
golden("t33_strip_maker", ["n", "m"], [("cipla dolo 650", "Cipla Ltd", "dolo 650"), ("Sun Sunscreen lotion", "Sun Pharma", "sunscreen lotion"), ("Micro Labs Dolo", "Micro Labs Limited", "dolo"), ("A.B Zed", "a.b of", "zed"), ("Dolo", None, "dolo"), (None, "Cipla", "")], T.without_maker)
golden("t35_slugs", ["q"], [("Dolo 650", ["dolo-650", "dolo-650-tablets", "dolo-650-tablet", "dolo-650-capsules", "dolo-650mg-tablet", "dolo-650mg-tablets", "dolo-650mg"]), ("pyrigesic 1000 tablet", ["pyrigesic-1000-tablet", "pyrigesic-1000-tablet-tablets", "pyrigesic-1000-tablet-tablet", "pyrigesic-1000-tablet-capsules", "pyrigesic-1000mg-tablet", "pyrigesic-1000mg-tablets", "pyrigesic-1000mg", "pyrigesic-1gm-tablet"]), ("Calpol 500 mg Syrup", ["calpol-500-mg-syrup", "calpol-500-mg-syrup-tablets", "calpol-500-mg-syrup-tablet", "calpol-500-mg-syrup-capsules", "calpol-500mg-syrup", "calpol-500mg-syrups", "calpol-500mg"]), ("Zed", ["zed", "zed-tablets", "zed-tablet", "zed-capsules"])], C.candidate_slugs)
golden("t37_units", ["n", "u"], [("2.50", "gm", "2.5:g"), ("600", "mg", "600:mg"), ("5", "lakh", "5:lac"), ("650.0", "", "650")], lambda n, u: I._dose(n, u))
golden("n5_card_prices", ["t"], [("MRP ₹120 Save 20%", 96.0, 120.0), ("Mrp: Rs 1,050.50", 1050.5, 1050.5), ("Best price: 99.5 today", 99.5, 99.5), ("₹50 then ₹40", 40.0, 50.0), ("12.50 and 10.00 and 900.00", 10.0, 12.5), ("no price", None, None), ("MRP 100 Save upto 15% Offer 10", 85.0, 100.0)], lambda t: {"sale": C.card_prices(t)["sale"], "mrp": C.card_prices(t)["mrp"]}, ["sale", "mrp"])
