"""Entity resolution, compositions and doses, on known cases and on the catalogue views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dosage as D
from tidemark.functions import salts as S
from tidemark.operators import identity as I
from tidemark.plans import views as V
from tidemark.plans.goldens import golden
from tidemark.plans.views import duck
from tidemark.registry import op

golden(
    "e1_parse_identity", ["name", "salt"],
    [
        ("BRUCARE 600MG TABLETS", "", "brucare", "600:mg", "tablet"), ("Dolo 650", "", "dolo", "650", ""), ("Crocin DS 240 Syrup", "", "crocin ds", "240", "syrup"),
        ("Tenovate GN 15gm Cream", "", "tenovate gn", "15:g", "cream"), ("Ceff 60ml Suspension", "", "ceff", "", "suspension"), ("Betnesol-N Tablet", "", "betnesol n", "", "tablet"),
        ("Cold N Flu 2.50 mg strip of 10", "", "cold flu", "2.5:mg", ""), ("", "", "", "", ""), (None, None, "", "", ""), ("Zed Eye Drops 5x2ml", "", "zed", "", "eye drops"),
    ],
    lambda n, s: {"brand": I.identity(n, s)["brand"], "strength": I.identity(n, s)["strength"], "form": I.identity(n, s)["form"]}, ["brand", "strength", "form"],
)
golden("e3_keys", ["name"], [("BRUCARE 600MG TABLETS", "brucare|600|tablet", "600:mg"), ("Dolo 650", "dolo|650|", "650"), ("Combo 25mg 100 mg cap", "combo|100+25|capsule", "25:mg+100:mg")], lambda n: {"key": I.merge_key(I.identity(n, F.lit(""))), "strength": I.strength_key(I.identity(n, F.lit("")))}, ["key", "strength"])
_PAIRS = [
    ("BRUCARE 600MG TABLETS", "Brucare 600mg Tablet 10s", "", "", True), ("Dolo 650", "Dolo 650mg Tablet", "", "", True), ("Crocin 240 DS Syrup", "Crocin DS 240 Syrup", "", "", True),
    ("Brucare 600mg Tablet", "Brucare 600 Syrup", "", "", False), ("Brucare 600mg Tablet", "Mucare 600mg Tablet", "", "", False), ("Ibugesic Plus Tablet", "Ibugesic Tablet", "", "", False),
    ("Betnesol Tablet", "Betnesol-N Tablet", "", "", False), ("Foo 600mg Tablet", "Foo 600mcg Tablet", "", "", False), ("Dolo 650 Tablet", "Dolo 500 Tablet", "", "", False), ("Ceff 60ml Suspension", "Ceff Suspension", "", "", True),
    ("Crocin Baby Paracetamol Drops", "Crocin Baby Drops", "Paracetamol", "Paracetamol", True), ("Kriam Ambroxol Syrup", "Kriam Bromhexine Syrup", "Ambroxol", "Bromhexine", False), ("", "Dolo", "", "", False),
]
golden("e4_same_medicine", ["a", "b", "sa", "sb"], _PAIRS, lambda a, b, sa, sb: I.same_medicine(I.identity(a, sa), I.identity(b, sb)))
golden("e5_salt_echo", ["a", "b", "sa", "sb"], [("Crocin Baby Paracetamol Drops", "Crocin Baby Drops", "Paracetamol", "Paracetamol", True), ("Kriam Ambroxol Syrup", "Kriam Bromhexine Syrup", "Ambroxol", "Bromhexine", False), ("Dolo", "Dolo", "Paracetamol", "Paracetamol", False)], lambda a, b, sa, sb: I.salt_echo(I.identity(a, sa), I.identity(b, sb)))
golden("e6_units_compatible", ["a", "b"], [("Foo 600mg", "Foo 600mcg", False), ("Foo 600", "Foo 600mcg", True), ("Foo 5mg 10mcg", "Foo 10mcg 5mg", True)], lambda a, b: I.units_compatible(I.identity(a, F.lit("")), I.identity(b, F.lit(""))))
golden("e7_salt_overlap", ["a", "b"], [("", "x", True, False), ("amoxicillin acid", "amoxicillin", True, True), ("a b c", "a b d", True, True), ("a b c d", "a e f g", False, False)], lambda a, b: {"loose": S.overlap(a, b), "strict": S.overlap(a, b, empty=False)}, ["loose", "strict"])
golden("e8_brand_prefix", ["name"], [("Crocin DS 240 Syrup", "crocin"), ("650", "")], lambda n: I.brand_prefix(I.identity(n, F.lit(""))))
golden("e9_modifier", ["name"], [("Calpol Plus DS Tablet", "ds-plus"), ("Dolo 650", "standard"), (None, "standard"), ("Mono SR sr", "sr-sr")], I.modifier)
import hashlib  # noqa: E402

_SIG = lambda s: hashlib.sha256(s.encode()).hexdigest()
golden("e10_signature", ["name", "salt", "form"], [("Dolo 650 Tablet", "Paracetamol", "", _SIG("dolo|paracetamol|650|tablet|standard")), ("Dolo 650", "", "Syrup", _SIG("dolo|nosalt|650|syrup|standard")), ("Zen Plus", "A + Ibuprofen 200mg", "", _SIG("plus-zen|ibuprofen|nostrength|unspecified|plus"))], I.signature)
golden(
    "e20_relevance", ["q", "n"],
    [("Dolo 650", "Dolo 650 Tablet", 0.9), ("Dolo 650", "Crocin 650 Tablet", 0.0), ("Dolo 650", "Dolo 500 Tablet", 0.0), ("Dolo 650 Injection", "Dolo 650 Injection", 1.0), ("Foo 500", "Bar 999 Injection", 0.0), ("Dolo 650", "Dolo 650 Injection", 0.3), ("Dolo Plus", "Dolo Syrup", 0.0)],
    lambda q, n: F.floor(I.relevance(q, n) * 1000 + 0.5) / 1000,
)
golden("e2_salt_key", ["s"], [("Paracetamol / Acetaminophen", "paracetamol"), ("CAFFEINE-32MG", "caffeine"), ("Amoxicillin 500mg + Clavulanic Acid 125mg", "amoxicillin clavulanic acid"), ("Clavulanic Acid + Amoxicillin", "amoxicillin clavulanic acid"), (None, ""), ("formoterol 0 budesonide 0", "formoterol budesonide"), ("Ibuprofen (600mg)", "ibuprofen")], S.salt_key)
golden("e2b_sync_salt", ["s"], [("Paracetamol (500mg) + Caffeine 32 mg", "caffeine paracetamol"), ("Iron / Folic", "iron / folic"), ("", "")], S.sync_salt)
golden("p11_molecular", ["s"], [("Ibuprofen 600mg", True), ("Embeta XR 25 composition consists of metoprolol", False), ("", False)], lambda s: S.is_molecular(S.salt_key(s)))
golden("p11b_garbage", ["s"], [("", True), ("a two", True), ("view company list", True), ("ibuprofen", False), ("one two three four five", True)], S.is_garbage)
golden("e24_heal", ["stored", "raw"], [("budesonide 0", "", "RENORM", "budesonide"), ("", "Ibuprofen 600mg", "BACKFILL", "ibuprofen"), ("", "", "UNFIXABLE", ""), ("ibuprofen", "Ibuprofen", "OK", ""), ("cefixime", "Paracetamol", "CONFLICT", "paracetamol"), ("a", "Cefixime 200mg", "SALVAGE", "cefixime"), ("acetaminophen", "", "RENORM", "paracetamol")], lambda s, r: {"verdict": S.heal(s, r)["verdict"], "value": S.heal(s, r)["value"]}, ["verdict", "value"])
golden("e25_salt_order", ["s"], [("formoterol budesonide", "REORDER", "budesonide formoterol"), ("amoxicillin clavulanic acid", "SKIP-MODIFIER", ""), ("paracetamol acetaminophen", "REORDER", "paracetamol"), ("ibuprofen", "OK", ""), ("", "SKIP-SHAPE", ""), ("abc formoterol", "SKIP-SHAPE", ""), ("budesonide formoterol", "OK", "")], lambda s: {"verdict": S.order_verdict(s)["verdict"], "value": S.order_verdict(s)["value"]}, ["verdict", "value"])
golden("t11_dose_token", ["d"], [("25 mg + 5 mg", "25mg+5mg"), ("100/162 mg", "100mg+162mg"), ("500 MG", "500mg"), ("10 + 20", "10mg+20mg"), (None, None)], D.dose_token)
golden("t10_w16_best_dose", ["t"], [("Dolo 650mg Tablet", "650mg"), ("Combo 25 mg + 5 mg, 100mg", "25mg+5mg"), ("a 5mg b 50mg", "50mg"), ("x 12345661%", None), ("https://a.b/5mg", None), ("none", None)], D.best_dose)
golden("e15_fuzzy_dose", ["d"], [("0.5 g", "500mg"), ("500mcg", "0.5mg"), ("25mg 5mg", "25mg+5mg"), ("5%", "5mg"), ("25mg 25 mg", "25mg"), ("1kg", "1000000mg"), ("abc", None), ("650", "650mg")], D.fuzzy_dose)
golden("e16_fuzzier", ["a", "b"], [("25mg+5mg", "25mg", "25mg+5mg", "5+25"), ("25mg", "25mg+5mg", "25mg+5mg", "5+25"), ("2.6mg+5mg", "5mg+1mg", "2.6mg+5mg", "2+5"), (None, "5mg", "5mg", "5"), (None, None, None, None)], lambda a, b: {"dose": D.fuzzier(a, b), "ints": D.dose_integers(D.fuzzier(a, b))}, ["dose", "ints"])
golden("e18_word_jaccard", ["a", "b"], [("a b", "a b", 1.0), ("", "", 0.0), ("a b", "b c", 1 / 3), ("A B", "b a", 1.0), (" ", "a", 0.0)], S.word_jaccard)
golden("t12_pack_size", ["q", "n"], [("Strip of 10 tablets", "", "10-tablets"), ("strip of 15", "Dolo capsule", "15-capsules"), ("", "Dolo 10's", "10-tablets"), ("", "Syrup 60 ml", "60-ml"), ("1.50 gm", "", "1.5-g"), (None, None, None), ("", "Dolo", None)], D.pack_size)
golden("e29_salt_doses", ["s"], [("Telmisartan (40mg) + Amlodipine (5 mg)", "40mg+5mg"), ("Ibuprofen", None)], D.salt_doses)
golden("a10_salt_quality", ["a", "b"], [("Ibuprofen (400mg)", "view company", "Ibuprofen (400mg)", 40), ("Paracetamol", "Paracetamol + Caffeine", "Paracetamol + Caffeine", 10), ("", "x", "x", -1), ("abcde", "abcdef", "abcdef", 10)], lambda a, b: {"salt": S.better(a, b), "points": S.quality(a).cast("long")}, ["salt", "points"])


@op("e8_j8_blocked_pairs", duck("""
x AS (SELECT name, strength, CASE WHEN medicine_id % 3 = 0 THEN '' ELSE form END AS f, min(medicine_id) AS id FROM med GROUP BY ALL)
SELECT a.id AS a_id, b.id AS b_id FROM x a JOIN x b ON a.name = b.name AND a.strength = b.strength AND a.id < b.id AND (a.f = '' OR b.f = '' OR a.f = b.f)""", "med"))  # fmt: skip
def j8(spark, d):
    """A third of the names lack their form, which then agrees with any."""
    name = F.when(F.col("medicine_id") % 3 == 0, F.concat_ws(" ", "name", "strength")).otherwise(F.col("title"))
    return I.duplicate_pairs(V.med(spark, d).select(F.col("medicine_id").alias("id"), name.alias("name"), F.lit("").alias("salt"))).select("a_id", "b_id")


@op("e11_clusters", duck("SELECT medicine_id AS id, min(medicine_id) OVER (PARTITION BY name, strength, form) AS cluster FROM med", "med"))
def e11(spark, d):
    rows = V.med(spark, d).select(F.col("medicine_id").alias("id"), F.col("title").alias("name"), F.lit("").alias("salt"))
    return I.guarded_clusters(rows)


_GUARD = [(1, "Dolo 650", ""), (2, "Dolo 650 Tablet", ""), (3, "Dolo 650 Syrup", ""), (4, "Dolo 650mg", ""), (5, "Crocin 500", ""), (6, "Dolo 650", "")]


@op("e11_guarded_union", "SELECT * FROM (VALUES (CAST(1 AS BIGINT), CAST(1 AS BIGINT)), (2, 1), (3, 3), (4, 1), (5, 5), (6, 1)) t(id, cluster)")
def e11g(spark, d):
    """The unknown form joins the tablet first, so the syrup stays out."""
    return I.guarded_clusters(spark.createDataFrame(_GUARD, "id long, name string, salt string"))


@op("e12_interlink_same_key", duck("""
g AS (SELECT name || '|' || manufacturer AS key, list_sort(list(DISTINCT title)) AS ts, list_sort(list(medicine_id)) AS ids FROM med GROUP BY 1 HAVING count(DISTINCT strength) = 1 AND count(*) > 1),
p AS (SELECT key, a, b FROM (SELECT key, unnest(ts) AS a, ts FROM g), unnest(ts) AS u(b) WHERE a < b),
s AS (SELECT key, min(CAST(len(list_intersect(string_split(a, ' '), string_split(b, ' '))) AS DOUBLE) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' '))))) AS least FROM p GROUP BY 1)
SELECT key, CAST(len(ids) AS BIGINT) AS n FROM g LEFT JOIN s USING (key) WHERE coalesce(least, 1) >= 0.6""", "med"))  # fmt: skip
def e12(spark, d):
    """Pass 1 over the whole catalogue: records of one key and one dose."""
    from tidemark.operators.interlink import alike_groups

    m = V.med(spark, d).select(F.concat_ws("|", "name", "manufacturer").alias("key"), F.col("title").alias("name"), F.col("strength").alias("dose"))
    return alike_groups(m, one_dose=True)


golden("e17_matching_name", ["n"], [("Cipla Dolo 650 mg Tablet strip of 10", "dolo"), ("Calpol SR 500mg, new pack", "calpol sr"), (None, ""), ("Dr.Reddy Nise-D 10's", "dr. nise-d")], lambda n: __import__("tidemark.operators.interlink", fromlist=["x"]).matching_name(n))
