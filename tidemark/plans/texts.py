"""Text, price and extraction functions on known cases and over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import extract as X
from tidemark.functions import salts as S
from tidemark.functions import text as T
from tidemark.functions.dosage import squeeze
from tidemark.plans import views as V
from tidemark.plans.goldens import golden
from tidemark.plans.views import duck
from tidemark.registry import op
from tidemark.sources.tables import table

_LOW = "trim(regexp_replace(regexp_replace(lower(trim(l)), '[^A-Za-z0-9_\\s-]', ' ', 'g'), '\\s+', ' ', 'g'))"


@op("t1_plain_text", f"SELECT page_id, {_LOW} AS plain FROM (SELECT page_id, url AS l FROM pages)")
def t1(spark, d):
    return table(spark, d, "pages").select("page_id", T.plain(F.col("url")).alias("plain"))


@op("t2_squeeze", "SELECT doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS t FROM documents")
def t2(spark, d):
    return table(spark, d, "documents").select("doc_id", squeeze(F.col("text")).alias("t"))


@op("t4_noise_words", duck("SELECT medicine_id, trim(array_to_string(list_filter(string_split(title, ' '), lambda x: x NOT IN ('tablet', 'capsule', 'syrup', 'new')), ' ')) AS t FROM med", "med"))
def t4(spark, d):
    return V.med(spark, d).select("medicine_id", T.without_words(F.col("title"), T.NAME_NOISE).alias("t"))


@op("t7_salt_signature", duck("SELECT medicine_id, array_to_string(list_sort(list_distinct(string_split(name, ' '))), '+') AS sig FROM med", "med"))
def t7(spark, d):
    return V.med(spark, d).select("medicine_id", F.array_join(F.array_sort(F.array_distinct(F.split("name", " "))), "+").alias("sig"))


@op("t13_match_keys", duck("SELECT medicine_id, 'name:' || name || '|dose:' || strength AS name_key, 'salt:' || salt_key || '|dose:' || strength AS salt_key FROM med", "med"))
def t13(spark, d):
    key = lambda p, c: F.concat(F.lit(p), squeeze(F.col(c)), F.lit("|dose:"), F.col("strength"))
    return V.med(spark, d).select("medicine_id", key("name:", "name").alias("name_key"), key("salt:", "salt_key").alias("salt_key"))


@op("t30_slug", duck("SELECT medicine_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM med", "med"))
def t30(spark, d):
    return V.med(spark, d).select("medicine_id", T.slug(F.col("title")).alias("slug"))


@op("p1_p6_keep_rows", "SELECT page_id FROM pages WHERE url <> '' AND (html LIKE '%<article%' OR html LIKE '%<nav%')")
def p1(spark, d):
    return table(spark, d, "pages").where((F.col("url") != "") & (F.col("html").contains("<article") | F.col("html").contains("<nav"))).select("page_id")


@op("p5_p14_valid_names", "SELECT doc_id, length(trim(l)) BETWEEN 3 AND 60 AND regexp_matches(l, '[A-Za-z]') AS ok FROM (SELECT doc_id, regexp_extract(text, '^[^\\n]*') AS l FROM documents)")
def p5(spark, d):
    return table(spark, d, "documents").select("doc_id", T.valid_name(F.regexp_extract("text", r"^[^\n]*", 0)).alias("ok"))


@op("p7_p9_product_urls", "SELECT page_id FROM pages WHERE regexp_matches(url, '/[a-z]{2}/[0-9]+') AND NOT regexp_matches(url, '#top|utm_')")
def p7(spark, d):
    return table(spark, d, "pages").where(F.col("url").rlike("/[a-z]{2}/[0-9]+") & ~F.col("url").rlike("#top|utm_")).select("page_id")


@op("p10_platform_of_host", "SELECT page_id, CASE WHEN ends_with(h, '.com') THEN 'com' WHEN ends_with(h, '.org') THEN 'org' WHEN ends_with(h, '.net') THEN 'net' ELSE 'other' END AS platform FROM (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS h FROM pages)")
def p10(spark, d):
    h = F.parse_url("url", F.lit("HOST"))
    kind = F.when(h.endswith(".com"), "com").when(h.endswith(".org"), "org").when(h.endswith(".net"), "net").otherwise("other")
    return table(spark, d, "pages").select("page_id", kind.alias("platform"))


@op("p12_e26_false_makers", duck("SELECT medicine_id, CASE WHEN lower(trim(manufacturer)) IN ('brand#1', 'brand#2') THEN '' ELSE manufacturer END AS manufacturer FROM med", "med"))
def p12(spark, d):
    from tidemark.operators.heal import blank_false_makers

    return blank_false_makers(V.med(spark, d), ["brand#1", "brand#2"]).select("medicine_id", "manufacturer")


@op("p13_short_descriptions", "SELECT doc_id FROM documents WHERE length(text) < 15 OR len(string_split_regex(trim(text), '\\s+')) <= 3")
def p13(spark, d):
    return table(spark, d, "documents").where((F.char_length("text") < 15) | (F.size(F.split(F.trim("text"), r"\s+")) <= 3)).select("doc_id")


@op("p22_audit", duck("SELECT count(*) FILTER (description IS NULL OR trim(description) = '') AS no_text, count(*) FILTER (length(description) < 100) AS short, count(*) FILTER (description LIKE '%|%') AS piped, count(*) FILTER (llm_enriched) AS enriched FROM doc", "doc"))
def p22(spark, d):
    t = F.col("description")
    return V.doc(spark, d).agg(F.count_if(t.isNull() | (F.trim(t) == "")).alias("no_text"), F.count_if(F.char_length(t) < 100).alias("short"), F.count_if(t.contains("|")).alias("piped"), F.count_if("llm_enriched").alias("enriched"))


@op("x4_titles", "SELECT page_id, nullif(regexp_extract(html, '(?i)<title>([^<]*)</title>', 1), '') AS title FROM pages")
def x4(spark, d):
    return table(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract("html", "(?i)<title>([^<]*)</title>", 1), F.lit("")).alias("title"))


@op("x5_links", """
WITH l AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, unnest(regexp_extract_all(html, '(?i)<a[^>]+href=["'']([^"''#]+)', 1)) AS h FROM pages)
SELECT DISTINCT page_id, link FROM (SELECT page_id, root, CASE WHEN h LIKE '/%' THEN root || h ELSE h END AS link FROM l) WHERE starts_with(link, root)""")  # fmt: skip
def x5(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(X.links(F.col("html"), F.col("url"))).alias("link"))


@op("m2_missing_details", duck("SELECT doc_id, concat_ws(',', CASE WHEN description IS NULL OR length(trim(description)) < 200 THEN 'description' END, CASE WHEN llm_enriched IS NULL THEN 'faq' END) AS missing FROM doc", "doc"))
def m2(spark, d):
    short = F.when(F.col("description").isNull() | (F.char_length(F.trim("description")) < 200), "description")
    return V.doc(spark, d).select("doc_id", F.concat_ws(",", short, F.when(F.col("llm_enriched").isNull(), "faq")).alias("missing"))


@op("t22_faq", duck("SELECT conv_id, count(DISTINCT lower(regexp_replace(trim(question), '\\s+', ' ', 'g')) || '::' || lower(regexp_replace(trim(answer), '\\s+', ' ', 'g'))) AS n FROM faq WHERE trim(question) <> '' AND trim(answer) <> '' GROUP BY 1", "faq"))
def t22(spark, d):
    per = V.faq(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "question", "answer"))).alias("items"))
    return per.select("conv_id", F.size(T.faq(F.col("items"))).cast("long").alias("n"))


golden("t3_split_caps", ["s"], [("AmoxicillinPotassium 500Clav", "Amoxicillin Potassium 500 Clav"), ("HCLTablet&nbsp;x", "HCL Tablet x"), (None, None)], T.split_caps)
golden("t17_entities", ["s"], [("a &amp;amp; b &#65;&#x1F600; &lt;p&gt; &quot;x&quot;", "a &amp; b A😀 <p> \"x\""), ("no", "no"), (None, None), ("&#39;tis", "'tis")], T.entities)
golden("t18_strip_html", ["s"], [("<p>One &amp; two</p><div>three<br>four <b>five</b></div><script>x<y</script>", "One & two\nthree\nfour five"), ("plain", "plain"), (None, None)], T.strip_html)
golden("t19_description", ["s"], [("Good drug.\nRead more\ngood  drug.\nWorks well.\nworks", "Good drug.\nWorks well."), ("<p></p>", None), (None, None)], T.description)
golden("t20_side_effects", ["s"], [("Common side effects include: Nausea, vomiting and Headache;nausea", ["nausea", "vomiting", "headache"]), ("It is used to treat pain", []), ("1. Dry mouth.\n(rash)", ["dry mouth", "rash"])], lambda s: T.side_effects(F.array(s)))
golden("t21_effect_list", ["s"], [("nausea., Nausea,consult your doctor,x,dry mouth", ["Nausea", "Dry mouth"])], lambda s: T.effect_list(F.split(s, ",")))
golden("p2_p3_missing", ["n", "c", "s"], [("Dolo", "dolo", "x", ["description", "dosage", "price"]), ("Dolo", None, None, ["name_quality", "salt", "description", "dosage", "price"]), ("Unknown Product", None, "x", ["name", "description", "dosage", "price"])], lambda n, c, s: T.missing_fields(n, c, s, F.lit(None).cast("string"), F.lit(""), F.lit(True), F.lit(None).cast("double")))
golden("p15_stock", ["s"], [("IN_STOCK", True), ("Out of Stock", False), ("0", False), ("3", True), ("false", False), (None, True), ("SOLD_OUT", False)], T.in_stock)
golden("p16_image_url", ["u", "b"], [("//cdn.x/a.png", "", "https://cdn.x/a.png"), ("/a.png", "https://x.y/", "https://x.y/a.png"), ("/a.png", "", ""), ("https://x/placeholder.png", "", ""), (None, "", ""), ("ftp://x", "", "")], T.image_url)
golden("p18_safe_match", ["a", "b", "s"], [("Dolo 650", "Dolo 650 Tablet", "", True), ("Dolo 650", "Dolo 500", "", False), ("Dolo", "Crocin", "Paracetamol", False), ("Abc", "Paracetamol 500", "Paracetamol", True), ("Dolo", "Dolopar 5", "", True), ("", "x", "", True)], T.safe_match)
golden("x14_srcset", ["s"], [("a.png 80w, b.png 320w, c.png 320w", "b.png"), ("a.png", "a.png"), ("", "")], T.widest)
golden("n3_price", ["s"], [("₹1,234.50", 1234.5), ("MRP 99", 99.0), ("none", None), (None, None)], lambda s: T.price(s))
golden("n4_near_currency", ["s"], [("Rs. 120.5 only", 120.5), ("45 INR", 45.0), ("MRP: 77", 77.0), ("no", None)], lambda s: T.near_currency(s))
golden("a10_longer", ["a", "b"], [("abc", "abcd", "abcd"), ("abcd", "abc", "abcd"), ("Unknown Product", "x", "x"), ("abc", "", "abc"), (None, "x", "x")], T.longer)
_LDP = '<script type="application/ld+json">{"@graph":[{"@type":"Organization","name":"x"},{"@type":["Product"],"name":"Dolo &amp; Co","offers":[{"price":"1,020.50","highPrice":1100,"availability":"http://schema.org/OutOfStock"}],"brand":{"name":"Micro"}}]}</script>'
golden("x1_ld_product", ["h"], [(_LDP, "Dolo & Co", 1020.5, 1100.0, False, "Micro"), ("<html></html>", None, None, None, None, None), ('<script type="application/ld+json">{bad</script>', None, None, None, None, None)], lambda h: {k: X.ld_product(h)[k] for k in ("name", "sale_price", "mrp", "in_stock", "manufacturer")}, ["name", "sale_price", "mrp", "in_stock", "manufacturer"])
golden("x2_state_keys", ["h"], [('{"mrp": 99.5, "salePrice":"80"}', "80"), ('{"price":12}', "12"), ("", None)], lambda h: X.state_key(h, "salePrice", "price"))
golden("t39_page_stock", ["h"], [('{"inStock":false}', False), ("http://schema.org/OutOfStock", False), ("", True)], X.page_stock)
golden("x4_meta", ["h"], [('<meta property="og:image" content="https://a/b.png">', "https://a/b.png"), ("<meta content='z' name='og:image'>", "z"), ("", None)], lambda h: X.meta(h, "og:image"))
golden("x7_sections", ["m"], [("# t\n## Uses\n- Pain\n- Fever\n## How\nSwallow", ["Uses", "How"], ["Pain", "Fever"])], lambda m: {"heads": F.transform(X.sections(m), lambda s: s["heading"]), "uses": X.bullets(F.element_at(X.sections(m), 1)["body"])}, ["heads", "uses"])
golden("x11_uses", ["s"], [("Pain\n\nFever show more show less\nab", ["Pain", "Fever"]), ("", None)], lambda s: X.list_of_lines(s))
golden("x11_safety", ["s"], [("Alcohol UNSAFE\nIt is unsafe to drink\nPregnancy SAFE\nfine and safe", "UNSAFE", "It is unsafe to drink", "SAFE")], lambda s: {"a": X.safety_advice(s)["alcohol"]["status"], "note": X.safety_advice(s)["alcohol"]["text"], "p": X.safety_advice(s)["pregnancy"]["status"]}, ["a", "note", "p"])
golden("x12_llm_json", ["s"], [('```json\n{"salt": "x"}\n```', "x"), ('Sure: {"salt":"y"} ok', "y"), ("none", None)], lambda s: F.try_variant_get(X.llm_json(s), "$.salt", "string"))
golden("src4_type_tags", ["j"], [('"text"', "STRING"), ("[1,2]", "ARRAY<BIGINT>"), ('{"a":1}', "OBJECT<a: BIGINT>"), ("bad", None)], lambda j: F.schema_of_variant(F.try_parse_json(j)))
golden("src10_event_stream", ["l"], [('data: {"event":"price","v":1}', "price"), ('data: {"event":"complete"}', None), ("data: {bad", None), (": ping", None)], lambda l: F.nullif(F.try_variant_get(F.try_parse_json(F.nullif(F.regexp_extract(l, "^data: (.*)$", 1), F.lit(""))), "$.event", "string"), F.lit("complete")))
golden("n6_hot_score", ["d7", "dp", "st"], [(2.0, 0.0, 0.0, 2.0), (200.0, 20.0, 0.0, 500.0), (15.0, 100.0, 0.0, 7.5)], lambda a, b, c: __import__("tidemark.operators.prices", fromlist=["x"]).hot_score(a, b, c))
golden("st7_miss_intent", ["q"], [("telmisartan 40 mg tablet", "QUALIFIED_MEDICINE"), ("paracetaml 500", "QUALIFIED_MEDICINE"), ("severe headache and vomiting", "SYMPTOM"), ("how to store insulin pen", "INFORMATIONAL"), ("asdfghjkl", "SPAM")], lambda q: F.when(q.rlike(r"(?i)^(?:how|what|why|when|can|is)\s"), "INFORMATIONAL").when(q.rlike(r"\d|(?i)\b(?:tablet|capsule|syrup|injection)\b"), "QUALIFIED_MEDICINE").when(q.rlike("(?i)ache|pain|fever|vomit|cough|rash|nausea"), "SYMPTOM").otherwise("SPAM"))
