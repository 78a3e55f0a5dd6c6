"""Record functions on known cases, and joins and sinks around them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import extract as X
from tidemark.functions import records as C
from tidemark.functions import salts as S
from tidemark.functions import text as T
from tidemark.operators import identity as I
from tidemark.operators import ranking as R
from tidemark.plans import views as V
from tidemark.plans.goldens import golden
from tidemark.plans.views import duck
from tidemark.registry import op

golden("t5_trimmed_salt", ["s"], [("Paracetamol (500mg) Storage Store below 30", "Paracetamol (500mg)"), ("Cefixime; extra", "Cefixime"), ("", None)], C.trimmed_salt)
golden("t6_salt_tokens", ["s"], [("Amoxicillin (500mg) + Clavulanic Acid 125mg", ["amoxicillin", "clavulanic acid"]), ("Iron and Folic Acid, Iron", ["iron", "folic acid"]), (None, [])], C.salt_tokens)
golden("t8_normal_salt", ["s"], [("Paracetamol (500mg)", "paracetamol"), ("Cefixime-IP 200 mg", "cefixime"), (None, None)], C.normal_salt)
golden("t24_rebuilt", ["s"], [("Paracetamol;caffeine;Paracetamol", "paracetamol caffeine", "caffeine+paracetamol", "Paracetamol + Caffeine")], lambda s: {k: C.rebuilt(F.split(s, ";"))[k] for k in ("normalized_salt", "primary_salt_key", "salt")}, ["normalized_salt", "primary_salt_key", "salt"])
golden("t16_clean_name", ["s"], [("Dolo 650 Tablet 15's - Buy online", "dolo 650 tablet"), ("Crocin &amp; Cold Strip of 10: Uses, Side effects", "crocin cold"), ("12", None), (None, None)], C.clean_name)
golden("t26_doses", ["n", "k"], [("Dolo 650 mg", "name:dolo|dose:650mg", "650 mg", "650mg", "650mg"), ("Zed 100 Syrup 10's", "name:zed", None, None, "100ml"), ("Abc 5", "x", None, None, None)], lambda n, k: {"named": C.first_dose(n), "keyed": C.key_dose(k), "guessed": C.guessed_dose(n)}, ["named", "keyed", "guessed"])
golden("t27_valid_salt", ["s", "n"], [("Paracetamol", "Dolo", True), ("dolo", "Dolo", False), ("view company", "Dolo", False), ("ab", "x", False)], C.valid_salt)
golden("t29_query_terms", ["q", "t"], [("Buy Dolo 650 tablet", "DOLO pack", ["dolo", "650"], True), ("zed", "dolo", ["zed"], False)], lambda q, t: {"terms": C.query_terms(q), "hit": C.mentions(t, q)}, ["terms", "hit"])
golden("t36_titles", ["t", "u"], [("DOLO 650MG TABLET 15's | Shop", "https://a.b/product/dolo-650mg-tablet-15s-lui1wb-8231049", "DOLO 650MG TABLET 15", "https://s.t/prescriptions/dolo-650mg-tablet-15s"), ("Zed", "https://a.b/product/zed-syrup", "Zed", "https://s.t/prescriptions/zed-syrup"), (" A 's |B|C", "https://a.b/product/x/y", "A", "https://a.b/prescriptions/x/y"), ("", "https://a.b/other", "", "https://a.b/other")], lambda t, u: {"name": C.title_name(t), "url": C.prescription_url(u, F.lit("https://s.t"))}, ["name", "url"])
golden("p17_error_page", ["s"], [("Site returned error 404", True), ("Returned Error 404", False), ("We Can't Seem To Find it", True), ("404 Page Not Found", True), ("Oops! this link is BROKEN", True), ("oops", False), ("access denied, not found", False), (None, False)], C.error_page)
golden("t9_normal_name", ["n", "d", "p"], [("Dolo 650mg Tablet", "650 mg", None, "dolo 650mg"), ("Dolo 650 Strip of 15 tablets", "650mg", "15-tablets", "dolo 650mg"), ("Augmentin 625 Duo 500mg + 125mg New", None, None, "augmentin 625 duo 500mg 125mg"), ("Crocin 10 caps Advance 500", "500", "10-capsules", "crocin advance 500"), ("Zed 5 MG 10's syrup", None, "10-tablets", "zed 5mg"), ("Abc 60 ml Lotion", None, "60-ml", "abc lotion"), ("Abc 60 ml Lotion", None, None, "abc 60ml lotion"), (None, "5mg", None, "")], C.normal_name)
golden("t14_query_hint", ["n", "h"], [("Paracetamol 500mg Tablet", "paracetamol", True), ("Dolo-650 (Paracetamol)", "650 paracetamol", True), ("Dolo", "paracetamol", False), (None, "x", False), ("Dolo", None, False), ("Dolo", "", False)], C.hint_is_salt)
golden("t38_stray_normal_form", ["s"], [("paracetamol caffeine", False), ("see https://x.y", True), ("www.shop", True), ("a <b> c", True), ("know  more", True), ("border", False), ("online pharmacy", True), ("a|b", False), ("a|b|c", True), ("x [1]", True), ("", False), (None, False)], C.stray_normal_form)
golden("x16_repaired_url", ["u", "b"], [("https:\\/\\/a.b\\/x?y=1&amp;z=2#top", "https://c.d/p/q", "https://a.b/x?y=1&z=2"), ("\\u002Fimg\\u002F1.png", "https://c.d/p/q", "https://c.d/img/1.png"), ("//e.f/g", "https://c.d", "https://e.f/g"), ("r.html", "https://c.d/p/q", "https://c.d/p/r.html"), ("mailto:a@b", "https://c.d", None), ("https://a.b", "https://c.d", "https://a.b/"), (None, "https://c.d", None)], C.repaired_url)
golden("p19_dose_overlap", ["a", "b"], [("Paracetamol 500mg", "Paracetamol 650mg", False), ("Paracetamol", "Paracetamol 650mg", True), ("A 5mg + B 10mg", "B 10.0", True)], C.dose_overlap)
golden("w17_best_image", ["s"], [("a/logo.png;a/product/large.jpg;a/x.svg", "a/product/large.jpg"), ("b.png;c.png", "b.png")], lambda s: C.best_image(F.split(s, ";")))
_SHOWN = lambda pairs: F.transform(pairs, lambda x: F.concat(x["question"], F.lit("="), x["answer"]))
golden("x9_faq_lines", ["s"], [("What?\nThis.\nWhy?\nThat.", ["What?=This.", "Why?=That."]), ("What?\n \nWhy?\nThat.\nOdd?", ["Why?=That."]), ("\n".join(f"q{i}\na{i}" for i in range(80)), [f"q{i}=a{i}" for i in range(80)]), ("", [])], lambda s: _SHOWN(X.faq_lines(F.split(s, "\n"))))
_FAQ = '<script type="application/ld+json">{"@graph":[{"@type":"Product","name":"L"},{"@type":["WebPage","FAQPage"],"mainEntity":[{"name":"What  is it?","acceptedAnswer":{"text":"A drug."}},{"question":"Safe?","text":"Yes"},{"name":"No answer"}]}]}</script>'
golden("x9_faq_page", ["h"], [(_FAQ, ["What is it?=A drug.", "Safe?=Yes"]), ('<script type="application/ld+json">{"@type":"FAQPage","mainEntity":[{"name":"Q","acceptedAnswer":{"name":"A"}}]}</script>', ["Q=A"]), ('<script type="application/ld+json">{broken</script>', []), ("<p>none</p>", [])], lambda h: _SHOWN(X.faq_page(h)))
golden("x10_salt_in_text", ["s"], [("It contains Paracetamol as its active", "Paracetamol"), ("none", None)], lambda s: F.nullif(F.regexp_extract(s, r"(?i)contains\s+([A-Za-z]+)", 1), F.lit("")))
golden("x3_cascade", ["h"], [('<script type="application/ld+json">{"@type":"Product","name":"L","offers":{"price":5}}</script><title>T</title>', "L"), ('{"productName":"N"}<title>T</title>', "N"), ("<title>T</title>", "T")], lambda h: F.coalesce(X.ld_product(h)["name"], X.state_key(h, "productName"), F.nullif(F.regexp_extract(h, "<title>([^<]*)", 1), F.lit(""))))
golden("t32_promo", ["s"], [("Good medicine for pain relief. Order now from us", "Good medicine for pain relief."), ("short", None)], lambda s: F.when((F.trim(F.regexp_replace(s, "(?i)(?:order|buy) (?:now|online).*$", "")) != s) & (F.char_length(F.trim(F.regexp_replace(s, "(?i)(?:order|buy) (?:now|online).*$", ""))) > 20), F.trim(F.regexp_replace(s, "(?i)(?:order|buy) (?:now|online).*$", ""))))


@op("p8_platform_urls", "SELECT page_id, kind FROM pages JOIN (VALUES ('.com/', 'shop'), ('.org/', 'org')) t(mark, kind) ON contains(url, mark) WHERE contains(lower(url), 'th')")
def p8(spark, d):
    """A small fixed table of patterns, as one expression rather than a join."""
    from tidemark.sources.tables import table

    kind = F.when(F.col("url").contains(".com/"), "shop").when(F.col("url").contains(".org/"), "org")
    return table(spark, d, "pages").where(C.mentions(F.col("url"), F.lit("th"))).select("page_id", kind.alias("kind")).where("kind IS NOT NULL")


@op("j9_prefix_lookup", duck("SELECT medicine_id, min(medicine_id) OVER (PARTITION BY name, strength, form) AS match_id FROM med", "med"))
def j9(spark, d):
    """Candidates by brand prefix, confirmed by identity, the smallest id first: equal names meet once, under their smallest id."""
    x = V.med(spark, d).groupBy("title").agg(F.min("medicine_id").alias("id")).select("title", "id", I.identity(F.col("title"), F.lit("")).alias("x")).withColumn("p", I.brand_prefix(F.col("x")))
    a, b = x.select("title", F.col("x").alias("a"), "p"), x.select("id", F.col("x").alias("b"), "p")
    found = a.join(b, "p").where(I.same_medicine(F.col("a"), F.col("b"))).groupBy("title").agg(F.min("id").alias("match_id"))
    return V.med(spark, d).select("medicine_id", "title").join(found, "title").select("medicine_id", "match_id")


@op("j14_m16_scored_seeds", "SELECT * FROM (VALUES ('Dolo 650', 'Dolo 650 Tablet', CAST(0.9 AS DOUBLE)), ('Crocin 500', 'Crocin 500', 0.9)) t(query, name, score)")
def j14(spark, d):
    """Listings of each query by query key, scored, those under 0.2 out."""
    q = spark.createDataFrame([(1, "Dolo 650"), (2, "Crocin 500")], "qid int, query string")
    rows = spark.createDataFrame([(1, "Dolo 650 Tablet"), (1, "Other 10"), (2, "Crocin 500")], "qid int, name string")
    scored = q.join(rows, "qid").select("query", "name", (F.floor(I.relevance(F.col("query"), F.col("name")) * 1000 + 0.5) / 1000).alias("score"))
    return scored.where("score >= 0.2")


_PAIRS = """p AS (SELECT key, a, b FROM (SELECT key, unnest(ns) AS a, ns FROM g), unnest(ns) AS u(b) WHERE a < b),
s AS (SELECT key, min(CAST(len(list_intersect(string_split(a, ' '), string_split(b, ' '))) AS DOUBLE) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' '))))) AS least FROM p GROUP BY 1)
SELECT key, n FROM g LEFT JOIN s USING (key) WHERE coalesce(least, 1) >= 0.6"""


@op("e14_interlink_integers", duck(f"""
x AS (SELECT regexp_replace(name, '^new ', '') || '|' || size || '|' || CASE WHEN medicine_id % 2 = 0 THEN 'NOSALT' ELSE regexp_replace(lower(manufacturer), '[^a-z0-9]', '', 'g') END AS key, regexp_replace(name, '^new ', '') AS nm, medicine_id % 3 AS part FROM med),
g AS (SELECT key, count(*) AS n, list(DISTINCT nm) AS ns FROM x GROUP BY key HAVING count(*) > 1 AND count(DISTINCT part) > 1),
{_PAIRS}""", "med"))  # fmt: skip
def e14(spark, d):
    """Pass 3 over the whole catalogue: doses of one whole part, half of the rows without a salt."""
    from tidemark.operators.interlink import integer_dose_groups

    dose = F.concat(F.col("size").cast("string"), F.element_at(F.array(F.lit(""), F.lit(".5"), F.lit(".25")), (F.col("medicine_id") % 3 + 1).cast("int")), F.lit("mg"))
    return integer_dose_groups(V.med(spark, d).select(F.concat_ws(" ", "name", "form").alias("name"), F.lit(None).cast("string").alias("normalized_name"), dose.alias("dosage"), F.when(F.col("medicine_id") % 2 == 1, F.col("manufacturer")).alias("salt")))


@op("e13_interlink_fuzzy_key", duck(f"""
x AS (SELECT CASE WHEN medicine_id % 5 = 0 THEN salt_key ELSE regexp_replace(name, '^new ', '') END || '|' || strength AS key, regexp_replace(name, '^new ', '') AS nm, title FROM med),
g AS (SELECT key, count(*) AS n, list(DISTINCT nm) AS ns FROM x GROUP BY key HAVING count(*) > 1 AND count(DISTINCT title) > 1),
{_PAIRS}""", "med"))  # fmt: skip
def e13(spark, d):
    """Pass 2 over the whole catalogue: titles are the canonical keys, and a fifth of the rows have a shorter normalized name; "new" is no part of a name."""
    from tidemark.operators.interlink import fuzzy_key_groups

    short = F.when(F.col("medicine_id") % 5 == 0, F.col("salt_key"))
    return fuzzy_key_groups(V.med(spark, d).select(F.col("title").alias("name"), short.alias("normalized_name"), F.col("strength").alias("dosage"), F.col("title").alias("canonical_key")))


_SHARE = "CAST(len(list_intersect(string_split({a}, ' '), string_split({b}, ' '))) AS DOUBLE) / greatest(len(string_split({a}, ' ')), len(string_split({b}, ' '))) >= 0.8"


@op("e19_overlap_groups", duck(f"""
x AS (SELECT medicine_id AS id, strength AS dose, regexp_replace(name, '^new ', '') || ' plus forte max' || CASE WHEN medicine_id % 4 = 0 THEN ' extra' ELSE '' END AS name FROM med),
l AS (SELECT dose, list_reduce(list([name] ORDER BY id), lambda a, y: CASE WHEN len(list_filter(a, lambda z: {_SHARE.format(a="z", b="y[1]")})) > 0 THEN a ELSE list_concat(a, y) END) AS leaders FROM x GROUP BY dose),
u AS (SELECT dose, unnest(leaders) AS leader, unnest(range(len(leaders))) AS k FROM l),
m AS (SELECT x.dose, x.id, arg_min(u.leader, u.k) AS leader FROM x JOIN u ON x.dose = u.dose AND {_SHARE.format(a="u.leader", b="x.name")} GROUP BY 1, 2),
f AS (SELECT dose, name, min(id) AS first FROM x GROUP BY 1, 2)
SELECT m.dose, f.first AS leader, m.id FROM m JOIN f ON f.dose = m.dose AND f.name = m.leader QUALIFY count(*) OVER (PARTITION BY m.dose, f.first) > 1""", "med"))  # fmt: skip
def e19(spark, d):
    """Greedy groups over the whole catalogue, a dose at a time; names have words in common, so the order of ids decides."""
    from tidemark.operators.interlink import overlap_groups

    name = F.concat(F.col("name"), F.lit(" plus forte max"), F.when(F.col("medicine_id") % 4 == 0, " extra").otherwise(""))
    return overlap_groups(V.med(spark, d).select(F.col("medicine_id").alias("id"), name.alias("name"), F.col("strength").alias("dosage"), "manufacturer"))


@op("m6_bad_keys_reset", duck("""
x AS (SELECT medicine_id, CASE medicine_id % 10 WHEN 0 THEN 'a' WHEN 1 THEN '' WHEN 2 THEN 'undefined undefinedundefined' WHEN 3 THEN left(salt_key, 2) ELSE salt_key END AS k, medicine_id % 4 < 3 AS done FROM med)
SELECT medicine_id, CASE WHEN k IN ('a', '', 'undefined undefinedundefined') THEN NULL ELSE k END AS salt_key, CASE WHEN k NOT IN ('a', '', 'undefined undefinedundefined') THEN done END AS llm_enriched FROM x""", "med"))  # fmt: skip
def m6(spark, d):
    """Three known bad keys go, and with them the mark that the record is done; short keys stay."""
    from tidemark.operators.heal import without_bad_keys

    r = F.col("medicine_id") % 10
    key = F.when(r == 0, "a").when(r == 1, "").when(r == 2, "undefined undefinedundefined").when(r == 3, F.left("salt_key", F.lit(2))).otherwise(F.col("salt_key"))
    return without_bad_keys(V.med(spark, d).select("medicine_id", key.alias("salt_key"), (F.col("medicine_id") % 4 < 3).alias("llm_enriched")), "salt_key", "llm_enriched")


@op("e22_strict_salt", duck("""
q AS (SELECT manufacturer AS query, arg_min(salt_key, medicine_id) AS salt FROM med WHERE size <> 7 GROUP BY 1),
c AS (SELECT m.manufacturer AS query, platform, sale, medicine_id FROM price JOIN med m USING (medicine_id) JOIN q ON q.query = m.manufacturer WHERE CASE WHEN medicine_id % 6 = 0 THEN '' ELSE m.salt_key END = q.salt AND length(q.salt) > 3)
SELECT query, platform, sale, medicine_id FROM c QUALIFY row_number() OVER (PARTITION BY query, platform ORDER BY sale, medicine_id) = 1""", "med", "price"))  # fmt: skip
def e22(spark, d):
    """Listings of a maker whose composition equals that of its first product, the cheapest per platform; no composition, no listing."""
    from tidemark.operators.merge import cheapest_of_salt

    m = V.med(spark, d)
    q = m.where("size <> 7").groupBy(F.col("manufacturer").alias("query")).agg(F.min_by(F.concat("salt_key", F.lit(" (5 mg)")), "medicine_id").alias("salt"))
    salt = F.when(F.col("medicine_id") % 6 == 0, "").otherwise(F.concat(F.lit("("), F.initcap("salt_key"), F.lit(") "), "strength"))
    listings = V.price(spark, d).join(m.select("medicine_id", F.col("manufacturer").alias("query"), salt.alias("found")), "medicine_id").select("query", "platform", "sale", "medicine_id", "found")
    return cheapest_of_salt(q, listings, "medicine_id").select("query", "platform", "sale", "medicine_id")


@op("m8_complete_candidates", duck("SELECT medicine_id FROM med LEFT JOIN (SELECT DISTINCT medicine_id AS priced FROM price) ON priced = medicine_id WHERE priced IS NOT NULL OR mrp > 950", "med", "price"))
def m8(spark, d):
    """A stored price counts as a price."""
    priced = V.price(spark, d).select("medicine_id").distinct().withColumn("priced", F.lit(True))
    return V.med(spark, d).join(priced, "medicine_id", "left").where(F.coalesce("priced", F.lit(False)) | (F.col("mrp") > 950)).select("medicine_id")


@op("m10_longest_first", duck("SELECT manufacturer, arg_max(title, (length(title), -medicine_id)) AS title FROM med GROUP BY 1", "med"))
def m10(spark, d):
    return R.first_per(V.med(spark, d), ["manufacturer"], [F.desc(F.char_length("title")), F.asc("medicine_id")]).select("manufacturer", "title")


@op("snk3_snk4_append_and_copy", duck("SELECT count(*) AS n, count(DISTINCT medicine_id) AS ids, true AS same FROM (SELECT medicine_id FROM med UNION ALL SELECT medicine_id FROM med WHERE size < 5)", "med"))
def snk34(spark, d):
    """Rows appended to a table in the shared folder, then copied and counted."""
    from tidemark.sources.folders import shared
    from tidemark.sources.sinks import snapshot

    path = f"{shared(spark)}/append-{uuid.uuid4().hex}"
    m = V.med(spark, d).select("medicine_id", "size")
    m.write.parquet(path)
    m.where("size < 5").write.mode("append").parquet(path)
    back = spark.read.schema(m.schema).parquet(path)
    same = snapshot(back, f"{path}-copy")
    return back.agg(F.count("*").alias("n"), F.countDistinct("medicine_id").alias("ids")).withColumn("same", F.lit(same))


golden(
    "m4_m5_clean_pass", ["d", "s", "e"],
    [("<p>Good drug for pain.</p>Read more", "view company", "Nausea, vomiting", "Good drug for pain.", None, ["nausea", "vomiting"]), ("x", "Paracetamol 500mg", "", None, "paracetamol", [])],
    lambda d, s, e: {"description": F.when(F.char_length(T.description(d)) >= 3, T.description(d)), "salt_key": F.when(S.usable(S.salt_key(s)) & ~s.rlike(S.NOISE), S.salt_key(s)), "effects": T.side_effects(F.array(e))},
    ["description", "salt_key", "effects"],
)
golden("m7_set_builder", ["a", "b", "sa", "sb"], [("Dolo", "Dolo 650", "view company", "Paracetamol (650mg)", "Dolo 650", "Paracetamol (650mg)"), ("Dolo 650", "", "Paracetamol", None, "Dolo 650", "Paracetamol")], lambda a, b, sa, sb: {"name": T.longer(a, b), "salt": S.better(sa, sb)}, ["name", "salt"])
golden("x6_headings", ["h"], [("<h2>Uses</h2><p>Pain</p><h3>How <b>it</b> works</h3><div>Well</div>", ["Uses", "How it works"], ["Pain", "Well"]), ("<p>none</p>", [], [])], lambda h: {"heads": F.transform(X.headed(h), lambda s: s["heading"]), "bodies": F.transform(X.headed(h), lambda s: s["body"])}, ["heads", "bodies"])


@op("snk5_m20_worklist", duck("SELECT CAST(medicine_id AS VARCHAR) AS medicine_id, manufacturer FROM med WHERE size = 3", "med"))
def snk5(spark, d):
    """A worklist as tab-separated text in the shared folder, read back."""
    from tidemark.sources.folders import shared
    from tidemark.sources.sinks import worklist

    path = f"{shared(spark)}/work-{uuid.uuid4().hex}"
    worklist(V.med(spark, d).where("size = 3").select("medicine_id", "manufacturer"), path)
    return spark.read.schema("medicine_id string, manufacturer string").option("sep", "\t").option("header", True).csv(path)


@op("st5_st6_stream_demand", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS hits FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) FROM events) GROUP BY 1, 2")
def st56(spark, d):
    """Daily demand as a stream, drained exactly once; days that the watermark has passed are closed."""
    from tidemark.sources.folders import shared
    from tidemark.sources.tables import table
    from tidemark.streaming.prices import daily_demand, drained

    base = f"{shared(spark)}/demand-{uuid.uuid4().hex}"
    events = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(f"{base}/in")
    return drained(daily_demand(spark.readStream.schema(events.schema).parquet(f"{base}/in")), f"{base}/out", f"{base}/ck")
