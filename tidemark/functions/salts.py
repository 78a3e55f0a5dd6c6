"""Compositions: four normal forms, molecular and garbage tests, orders, qualities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.common import let

SYNONYMS = dict(pair.split(" > ") for pair in "rifampin > rifampicin; acetaminophen > paracetamol; cetirizine hydrochloride > cetirizine; albuterol > salbutamol; amoxycillin > amoxicillin".split("; "))
_NUM, _NAME = "[0-9]+[.]?[0-9]*", r"[A-Za-z][\sA-Za-z-]+"
#: Words of prose and of forms, none of which a composition has.
PROSE = sorted("about active benefits capsule capsules combination company component components composition consists contains cream drops gel includes including injection lotion manufactured marketed ointment order packaging packing powder sachet solution spray suspension syrup tablet tablets uses vial works".split())
GARBAGE = ("active", "careers blog", "combination", "composition", "effective", "includes", "making it", "order", "our services", "partner with", "proven ingredients", "sufficient", "view company")
#: Ions, esters and hydrates: next to one of these a space may stand inside a name.
MODIFIERS = sorted(
    "acetate acetonide acid aluminium aluminum anhydrous aspartate axetil besylate bicarbonate bitartrate bromide calcium camsylate carbonate chloride cilexetil citrate decanoate dihydrate dihydrochloride dipropionate disodium edisylate embonate enanthate ferric ferrous fosamil fumarate furoate gluconate glycinate hcl hemihydrate hydrobromide hydrochloride hydroxide iodide isethionate lactate lithium magnesium malate maleate medoxomil mesylate mofetil monohydrate napadisylate nitrate orotate oxalate oxide palmitate pamoate phosphate picosulfate potassium propionate proxetil sesquihydrate sodium stearate succinate sulfate sulphate tartrate teoclate tosylate trihydrate valerate xinafoate zinc".split()
)
STOP = sorted("a an and as each for is its of one product that the their this two with".split())


def lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def words(c: Column) -> Column:
    """Words between white space; none of a null or blank text."""
    return F.filter(F.split(F.trim(F.coalesce(c, F.lit(""))), r"\s+"), lambda w: w != "")


def folded(w: Column) -> Column:
    out = w
    for k, v in SYNONYMS.items():
        out = F.when(w == k, v).otherwise(out)
    return out


def salt_key(salt: Column) -> Column:
    """The key of a composition: no doses, one name for each molecule, in order."""
    c = F.lower(F.coalesce(salt, F.lit("")))
    c = F.regexp_replace(c, rf"{_NUM}\s*(?:%|g|gm|iu|mcg|mg|ml)\b", " ")
    c = F.regexp_replace(c, _NUM, " ")
    c = F.replace(F.translate(c, "()+/", "  ,,"), F.lit(" and "), F.lit(","))
    parts = F.transform(F.split(c, ","), lambda x: F.regexp_replace(F.regexp_extract(x, "(?s)[a-z](?:.*[a-z])?", 0), r"\s+", " "))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter(parts, lambda x: F.char_length(x) > 3), folded))), " ")


def sync_salt(salt: Column) -> Column:
    """The second normal form: doses out, parts in order; neither synonyms nor bare numbers."""
    c = F.regexp_replace(F.coalesce(salt, F.lit("")), rf"(?i){_NUM}\s*(?:%|gm|g|mcg|mg|ml)", "")
    c = F.replace(F.replace(F.translate(c, "()", ""), F.lit("+"), F.lit(",")), F.lit(" and "), F.lit(","))
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.lower(F.trim(x))), lambda x: F.char_length(x) > 3)
    return F.array_join(F.array_sort(parts), " ")


def is_molecular(key: Column) -> Column:
    w = words(key)
    return F.size(w).between(1, 5) & ~F.arrays_overlap(w, lits(PROSE))


def is_garbage(key: Column) -> Column:
    w = words(key)
    bad = F.size(w) > 4
    bad = bad | ~F.exists(w, lambda x: F.char_length(x) >= 4)
    for g in GARBAGE:
        bad = bad | F.coalesce(key, F.lit("")).contains(g)
    return bad


def overlap(a: Column, b: Column, empty: bool = True) -> Column:
    """One within the other, or half of all words shared; ``empty`` is the answer where a side is blank."""
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    both = F.size(F.array_intersect(x, y))
    some = (both == F.size(x)) | (both == F.size(y)) | (both >= 0.5 * F.size(F.array_union(x, y)))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), empty).otherwise(some)


def word_jaccard(a: Column, b: Column) -> Column:
    """Shared words by all words; 1 for equal texts, 0 where a side is empty."""
    x, y = F.array_distinct(words(F.lower(a))), F.array_distinct(words(F.lower(b)))
    blank = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "") | (F.size(x) == 0) | (F.size(y) == 0)
    return F.when(blank, 0.0).when(a == b, 1.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def molecule(salt: Column) -> Column:
    """The key without filler words and placeholders."""
    kept = F.filter(words(salt_key(salt)), lambda w: ~w.isin(STOP) & ~w.contains("undefined"))
    return F.array_join(kept, " ")


def usable(key: Column) -> Column:
    return (F.coalesce(key, F.lit("")) != "") & is_molecular(key) & ~is_garbage(key)


def heal(stored: Column, raw: Column) -> Column:
    """{verdict, value} for a stored composition, given the raw one; what is clean is never replaced by the raw."""
    said = lambda v, x: F.struct(F.lit(v).alias("verdict"), x.alias("value"))
    none = F.lit("")
    keys = F.struct(F.trim(F.coalesce(stored, F.lit(""))).alias("s"), molecule(raw).alias("derived"), molecule(F.trim(F.coalesce(stored, F.lit("")))).alias("again"))
    judged = lambda k: F.struct(k["s"].alias("s"), k["derived"].alias("derived"), k["again"].alias("again"), *[usable(k[c]).alias(f"{c}_usable") for c in ("s", "derived", "again")])

    def verdict(k: Column) -> Column:
        s, derived, again = k["s"], k["derived"], k["again"]
        good, good_derived, good_again = k["s_usable"], k["derived_usable"], k["again_usable"]
        return (
            F.when((s == "") & good_derived, said("BACKFILL", derived))
            .when(s == "", said("UNFIXABLE", none))
            .when(good & good_again & (again != s), said("RENORM", again))
            .when(good & good_derived & ~F.arrays_overlap(words(s), words(derived)), said("CONFLICT", derived))
            .when(good, said("OK", none))
            .when(good_again, said("RENORM", again))
            .when(good_derived, said("SALVAGE", derived))
            .otherwise(said("UNFIXABLE", none))
        )

    return let(keys, lambda k: let(judged(k), verdict))


def order_verdict(key: Column) -> Column:
    """{verdict, value}: whether the words of a composition may be put in order."""
    s = F.trim(F.coalesce(key, F.lit("")))
    w = words(s)
    ordered = F.array_join(F.array_sort(F.array_distinct(F.transform(w, folded))), " ")
    said = lambda v, x=None: F.struct(F.lit(v).alias("verdict"), (F.lit("") if x is None else x).alias("value"))
    return (
        F.when(F.size(w) == 1, said("OK"))
        .when(~F.size(w).between(2, 5) | ~F.forall(w, lambda x: x.rlike(r"^\p{L}{4,}$")) | ~is_molecular(s) | is_garbage(s), said("SKIP-SHAPE"))
        .when(F.arrays_overlap(w, lits(MODIFIERS)), said("SKIP-MODIFIER"))
        .when(ordered != s, said("REORDER", ordered))
        .otherwise(said("OK"))
    )


NOISE = r"(?i)(?<![A-Za-z0-9_])(about\s+us|blog|capsules?|careers|company|delivery|feedback|fulfillment|information|licensed|nearest|order|our\s+services|partner|pharmacy|retail|strip\s+of|tablets?|view)(?![A-Za-z0-9_])"


def quality(salt: Column) -> Column:
    """Points for what looks like a composition, less for what looks like page text; -1 for nothing."""
    n = F.char_length(salt)
    score = F.when(n > 200, -50).when(n > 120, -20).otherwise(0) + F.when(salt.rlike(NOISE), -40).otherwise(0)
    score = score + F.when(salt.rlike(rf"^{_NAME}\s*[(]\s*[0-9]"), 30).otherwise(0)
    score = score + F.when(salt.rlike(rf"^{_NAME}(?:\s*[+]\s*{_NAME})+"), 20).otherwise(0) + F.when(n.between(5, 120), 10).otherwise(0)
    return F.when(F.coalesce(salt, F.lit("")) == "", -1).otherwise(score)


def better(old: Column, new: Column) -> Column:
    """The composition of the higher quality; of equals the longer one, the old one before that."""
    a, b = quality(old), quality(new)
    take = (b > a) | ((b == a) & (F.char_length(new) > F.char_length(old)))
    return F.when(F.coalesce(new, F.lit("")) == "", old).when(F.coalesce(old, F.lit("")) == "", new).when(take, new).otherwise(old)
