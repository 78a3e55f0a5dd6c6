"""Entity resolution: product identities out of names, and the tests that join them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import salts as S
from tidemark.functions.common import let
from tidemark.operators.copies import once

_FORMS = {
    "capsule": "cap caps capsule capsules", "cream": "cream", "drops": "drop drops", "gel": "gel", "inhaler": "inhaler", "injection": "ampoule ampule inj injection vial", "lotion": "lotion",
    "ointment": "ointment", "powder": "granules powder sachet", "respule": "respule respules", "rotacap": "rotacap rotacaps", "solution": "soln solution", "spray": "spray", "suspension": "susp suspension",
    "syrup": "syp syrup", "tablet": "caplet caplets tab tablet tablets tabs",
}
#: (phrase, form), the longest first.
FORMS = sorted([*((p, f) for f, ps in _FORMS.items() for p in ps.split()), ("ear drops", "ear drops"), ("eye drops", "eye drops")], key=lambda x: (-len(x[0]), x[0]))
NOISE = sorted("& and bottle box bp flavor flavored flavour flavoured for ip jar nf of oral pack paed paediatric pediatric sterile strip the tube usp with".split())
MODIFIERS = sorted("cr ds dsr dt er forte la mr od plus pr sr tr xr".split())
_NUM, _VOLUME = "[0-9]+[.]?[0-9]*", "(?:ml|ltr|litres?)"
#: Longer units stand before those that they start with.
DOSE = rf"({_NUM})\s*(%|gm|g|iu|lac|lakh|mcg|mg|units?)?"
#: Counts by volume, "strip of 10", volumes, "10's" and "x 10".
PACK = "|".join(
    f"(?:{p})"
    for p in (
        rf"\b[0-9]+\s*[×x]\s*{_NUM}\s*(?:g|gm|{_VOLUME})\b",
        r"\b(?:bottle|box|pack|strip)\s+of\s+[0-9]+\b",
        rf"\b{_NUM}\s*{_VOLUME}\b",
        r"\b[0-9]+\s*'?s\b",
        r"\bx\s*[0-9]+\b",
    )
)


def _dose(num: Column, unit: Column) -> Column:
    n = F.when(num.contains("."), F.regexp_replace(F.regexp_replace(num, "0+$", ""), r"\.$", "")).otherwise(num)
    u = F.when(unit == "gm", "g").when(unit == "lakh", "lac").when(unit == "unit", "units").otherwise(unit)
    return F.concat(F.when(n == "", "0").otherwise(n), F.when(u == "", "").otherwise(F.concat(F.lit(":"), u)))


def identity(name: Column, salt: Column) -> Column:
    """{brand, strength, form, salt_key} of a product name, by native expressions alone.

    Pack sizes go first, then the form (longest phrase), then the doses; what words are left, less
    noise and an "n" between others, are the brand.
    """
    text = F.regexp_replace(F.concat(F.lit(" "), F.lower(F.trim(F.coalesce(name, F.lit("")))), F.lit(" ")), PACK, " ")

    def rest(t: Column) -> Column:
        # One pass finds all phrases, longer ones before those within them; then the longest counts.
        found = F.regexp_extract_all(t, F.lit(rf"\b({'|'.join(p for p, _ in FORMS)})\b"), F.lit(1))
        ranked = F.array_sort(F.transform(found, lambda p: F.struct((-F.char_length(p)).alias("n"), p.alias("p"))))
        phrase = F.try_element_at(ranked, F.lit(1))["p"]
        form = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in FORMS for x in kv]), phrase), F.lit(""))
        left = F.when(phrase.isNull(), t).otherwise(F.regexp_replace(t, F.concat(F.lit(r"\b"), phrase, F.lit(r"\b")), F.lit(" ")))
        return let(F.struct(left.alias("t"), form.alias("form")), made)

    def made(x: Column) -> Column:
        doses = F.zip_with(F.regexp_extract_all(x["t"], F.lit(DOSE), F.lit(1)), F.regexp_extract_all(x["t"], F.lit(DOSE), F.lit(2)), _dose)
        tokens = F.filter(F.split(F.regexp_replace(x["t"], DOSE, " "), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(NOISE) & ~w.rlike("^[0-9]+$"))
        brand = let(tokens, lambda ts: F.array_join(F.filter(ts, lambda w, i: ~((w == "n") & (i < F.size(ts) - 1))), " "))
        return F.struct(brand.alias("brand"), doses.alias("strength"), x["form"].alias("form"), S.salt_key(salt).alias("salt_key"))

    return let(text, rest)


def strength_nums(ident: Column) -> Column:
    """Numbers of the doses in the order of their strings."""
    return F.array_sort(F.transform(ident["strength"], lambda s: F.element_at(F.split(s, ":"), 1)))


def strength_key(ident: Column) -> Column:
    """Doses in the order of their numbers."""
    keyed = F.array_sort(F.transform(ident["strength"], lambda s: F.struct(F.element_at(F.split(s, ":"), 1).try_cast("double").alias("v"), s.alias("s"))))
    return F.array_join(F.transform(keyed, lambda x: x["s"]), "+")


def merge_key(ident: Column) -> Column:
    return F.concat_ws("|", ident["brand"], F.array_join(strength_nums(ident), "+"), ident["form"])


def brand_prefix(ident: Column) -> Column:
    return F.element_at(F.split(ident["brand"], " "), 1)


def modifier(name: Column) -> Column:
    found = F.filter(F.split(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+"), lambda w: w.isin(MODIFIERS))
    return F.when(F.size(found) > 0, F.array_join(F.array_sort(found), "-")).otherwise("standard")


def signature(name: Column, salt: Column, form: Column) -> Column:
    """SHA-256 over brand, salt, strength, form and modifier, with names for what is missing."""
    ident = identity(name, salt)
    some = lambda a, other: F.when(F.size(a) > 0, F.array_join(a, "-")).otherwise(other)
    brand = some(F.array_sort(F.array_distinct(S.words(ident["brand"]))), "nobrand")
    salt_part = F.when(F.coalesce(salt, F.lit("")) == "", "nosalt").otherwise(F.array_join(F.array_sort(S.words(S.salt_key(salt))), "-"))
    raw = F.coalesce(form, F.lit(""))
    form_part = F.when(ident["form"] != "", ident["form"]).when(raw != "", F.lower(F.trim(raw))).otherwise("unspecified")
    return F.sha2(F.concat_ws("|", brand, salt_part, some(strength_nums(ident), "nostrength"), form_part, modifier(name)), 256)


def _tokens(ident: Column) -> Column:
    return F.array_sort(F.array_distinct(S.words(ident["brand"])))


def salt_echo(a: Column, b: Column) -> Column:
    """The brands differ by words alone that are molecules of both."""
    x, y = _tokens(a), _tokens(b)
    shared = F.array_intersect(S.words(a["salt_key"]), S.words(b["salt_key"]))
    diff = F.array_union(F.array_except(x, y), F.array_except(y, x))
    core = F.array_sort(F.array_except(x, shared)) == F.array_sort(F.array_except(y, shared))
    return S.is_molecular(a["salt_key"]) & S.is_molecular(b["salt_key"]) & (F.size(diff) > 0) & (F.size(F.array_except(diff, shared)) == 0) & core


def units_compatible(a: Column, b: Column) -> Column:
    """No number has units on both sides of which none is shared."""
    num, unit = lambda s: F.element_at(F.split(s, ":"), 1), lambda s: F.try_element_at(F.split(s, ":"), F.lit(2))
    of = lambda c, n: F.filter(F.transform(F.filter(c["strength"], lambda s: num(s) == n), unit), lambda u: u.isNotNull())
    clash = lambda s: (F.size(of(a, num(s))) > 0) & (F.size(of(b, num(s))) > 0) & ~F.arrays_overlap(of(a, num(s)), of(b, num(s)))
    return ~F.exists(a["strength"], clash)


def same_medicine(a: Column, b: Column) -> Column:
    """Brand and doses agree, units and salts do not clash, and the form is the same or unknown."""
    brand = (_tokens(a) == _tokens(b)) | salt_echo(a, b)
    form = (a["form"] == "") | (b["form"] == "") | (a["form"] == b["form"])
    return (a["brand"] != "") & (b["brand"] != "") & brand & (strength_nums(a) == strength_nums(b)) & units_compatible(a, b) & form & S.overlap(a["salt_key"], b["salt_key"])


_QUERY_FORMS = sorted("tablet tab capsule cap syrup injection inj drops cream gel ointment suspension solution powder spray".split())
_LIQUID = ("cream", "drops", "gel", "ointment", "powder", "solution", "spray", "suspension", "syrup")


def relevance(query: Column, name: Column) -> Column:
    """How well a result fits a query, 0 to 1.  Of several forms in a text the last in the alphabet counts."""
    q, n = F.lower(F.trim(query)), F.lower(F.trim(name))
    num = rf"(?i)({_NUM})\s*(?:gm|g|mcg|mg|ml)?"
    brand = F.filter(S.words(q), lambda w: ~w.rlike(rf"(?i)^{_NUM}(?:gm|g|mcg|mg|ml)?$"))
    first = F.when(F.size(brand) == 0, 0.0).when(n.contains(F.element_at(brand, 1)), 0.5).otherwise(-1.0)
    others = F.aggregate(F.slice(brand, 2, F.greatest(F.size(brand) - 1, F.lit(0))), F.lit(0.0), lambda a, w: a + F.when(n.contains(w), 0.2).otherwise(-0.2))
    doses = F.regexp_extract_all(q, F.lit(num), F.lit(1))
    dose = F.when(F.size(doses) == 0, 0.0).when(F.array_contains(F.regexp_extract_all(n, F.lit(num), F.lit(1)), F.element_at(doses, 1)), 0.4).otherwise(-0.5)

    def form(t: Column) -> Column:
        out = F.lit("")
        for f in _QUERY_FORMS:
            out = F.when(t.contains(f), f).otherwise(out)
        return out

    fq, fn = form(q), form(n)
    shots = ("injection", "inj", "vial")
    off = F.when(fn.isin(*shots) & ~fq.isin(*shots), -0.6).otherwise(0.0) + F.when(fn.isin(*_LIQUID) & (fq != fn), -0.3).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(F.size(brand) == 0, 0.0).otherwise(first + others) + dose + off))


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with "" for a missing name or salt, which have the same identity."""
    return rows.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "salt")])


def _identities(rows: DataFrame) -> DataFrame:
    """(name, salt, id, x): each distinct name and salt, parsed once, under its smallest id."""
    return once(_named(rows), ["name", "salt"], F.min("id").alias("id")).withColumn("x", identity(F.col("name"), F.col("salt")))


def duplicate_pairs(rows: DataFrame) -> DataFrame:
    """(a_id, b_id, p, s, a_form, b_form): same products among (id, name, salt), by blocks of brand prefix and doses.

    Rows of one identity take part as one, under the smallest id: a block pairs its distinct identities alone.
    """
    base = _identities(rows).groupBy("x").agg(F.min("id").alias("id"))
    base = base.select("id", "x", brand_prefix(F.col("x")).alias("p"), F.array_join(strength_nums(F.col("x")), "+").alias("s")).where("p <> ''")
    a, b = base.alias("a"), base.alias("b")
    on = (F.col("a.p") == F.col("b.p")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.id") < F.col("b.id"))
    return a.join(b, on).where(same_medicine(F.col("a.x"), F.col("b.x"))).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("a.p").alias("p"), F.col("a.s").alias("s"), F.col("a.x.form").alias("a_form"), F.col("b.x.form").alias("b_form"))


def guarded_clusters(rows: DataFrame) -> DataFrame:
    """(id, cluster) of every row: pairs joined in order of ids, unless that would put two known forms into one cluster.

    The result depends on the order, so a block (prefix and doses) is worked in one go; pairs never leave their block.
    """
    pairs = duplicate_pairs(rows)

    def join(pdf):
        import pandas as pd

        parent, forms = {}, {}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for r in pdf.sort_values(["a_id", "b_id"]).itertuples():
            for i, f in ((r.a_id, r.a_form), (r.b_id, r.b_form)):
                if i not in parent:
                    parent[i], forms[i] = i, {f} - {""}
            x, y = find(r.a_id), find(r.b_id)
            if x != y and len(forms[x] | forms[y]) <= 1:
                x, y = min(x, y), max(x, y)
                parent[y] = x
                forms[x] |= forms[y]
        return pd.DataFrame([(i, find(i)) for i in sorted(parent)], columns=["rep", "cluster"])

    of = pairs.groupBy("p", "s").applyInPandas(join, "rep long, cluster long")
    names = _identities(rows)
    reps = names.groupBy("x").agg(F.min("id").alias("rep"))
    clusters = names.join(reps, "x").join(of, "rep", "left").select("name", "salt", F.coalesce("cluster", "rep").alias("cluster"))
    return _named(rows).join(clusters, ["name", "salt"]).select("id", "cluster")
