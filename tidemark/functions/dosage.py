"""Doses and pack sizes in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS, N = "%|g|gm|kg|mcg|mg|ml", "[0-9]+(?:[.][0-9]+)?"
_END = "(?![A-Za-z0-9_])"
#: One dose, or several joined by +, /, &, - or "and", not followed by a word character.
SPAN = rf"(?i)((?:{N}\s*(?:{_UNITS})?\s*(?:[&+/-]|and)\s*)*{N}\s*(?:{_UNITS}|-?(?:gm?|l|mcg|mg|ml))){_END}"
_PART = rf"(?i)({N})\s*({_UNITS})?"


def squeeze(c: Column) -> Column:
    """White space as one blank, none at the ends; blank texts are null."""
    return F.nullif(F.trim(F.regexp_replace(F.replace(c, F.lit(" "), F.lit(" ")), r"\s+", " ")), F.lit(""))


def dose_token(dose: Column) -> Column:
    """``25 mg + 5 mg`` as ``25mg+5mg``; a part without a unit has that of the next part, mg at the end."""
    low = F.lower(squeeze(dose))
    nums, units = F.regexp_extract_all(low, F.lit(_PART), F.lit(1)), F.regexp_extract_all(low, F.lit(_PART), F.lit(2))
    parts = F.reverse(F.arrays_zip(nums.alias("n"), units.alias("u")))
    start = F.struct(F.lit("mg").alias("unit"), F.lit("").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        unit = F.when(p["u"] != "", p["u"]).otherwise(acc["unit"])
        return F.struct(unit.alias("unit"), F.concat(p["n"], unit, F.when(acc["out"] == "", "").otherwise(F.concat(F.lit("+"), acc["out"]))).alias("out"))

    return F.when(F.size(nums) <= 1, F.regexp_replace(low, r"\s+", "")).otherwise(F.aggregate(parts, start, step, lambda a: a["out"]))


def best_dose(text: Column) -> Column:
    """The dose with most parts in a text, the larger first number of equals; null for urls and implausible numbers."""
    clean = F.regexp_replace(text, r"(?i)(tata\s*)?(?<![0-9.])1\s*mg(?=\.com|\s+(platform|pharmacy|store))", " ")
    found = F.filter(F.transform(F.regexp_extract_all(clean, F.lit(SPAN), F.lit(1)), dose_token), lambda x: x.isNotNull())
    keyed = F.transform(found, lambda x, i: F.struct((F.size(F.split(x, r"\+"))).alias("k"), F.coalesce(F.regexp_extract(x, f"^{N}", 0).try_cast("double"), F.lit(0.0)).alias("m"), (-i).alias("i"), x.alias("x")))
    top = F.array_max(keyed)["x"]
    nums = F.transform(F.split(top, r"\+"), lambda p: F.struct(F.regexp_extract(p, N, 0).try_cast("double").alias("v"), p.contains("%").alias("pct")))
    silly = F.exists(nums, lambda n: (n["v"] > 10000) | (n["pct"] & (n["v"] > 100)))
    return F.when(text.rlike("(?i)^https?://|^/[a-z0-9-]+/") | silly, None).otherwise(top)


def fuzzy_dose(text: Column) -> Column:
    """All doses in milligrams, distinct, in text order of their strings."""
    low = F.lower(text)
    parts = F.regexp_extract_all(low, F.lit(rf"{N}\s*(?:(?:{_UNITS}|iu|units?){_END}|{_END})"), F.lit(0))

    def base(p: Column) -> Column:
        p = F.regexp_replace(F.regexp_replace(p, r"\s+", ""), rf"[.]0(?={_UNITS}|iu|unit)", "")
        value = F.regexp_extract(p, f"^{N}", 0).try_cast("double")
        factor = F.when(p.rlike(f"^{N}gm?$"), 1000.0).when(p.rlike(f"^{N}mcg$"), 0.001).when(p.rlike(f"^{N}kg$"), 1e6)
        mg = value * factor
        shown = F.when(mg == F.floor(mg), F.floor(mg).cast("string")).otherwise(F.regexp_replace(F.format_string("%.6f", mg), r"0+$", ""))
        # The unit % is dropped, as it ends no word: 5% reads as 5mg.
        return F.when(factor.isNotNull(), F.concat(shown, F.lit("mg"))).when(p.rlike(f"^{N}%?$"), F.concat(F.regexp_replace(p, "%", ""), F.lit("mg"))).otherwise(p)

    return F.nullif(F.array_join(F.array_sort(F.array_distinct(F.transform(parts, base))), "+"), F.lit(""))


def fuzzier(a: Column, b: Column) -> Column:
    """The dose of more parts, the first of equals."""
    n = lambda c: F.size(F.split(c, r"\+"))
    return F.when(a.isNull(), b).when(b.isNull() | (n(a) >= n(b)), a).otherwise(b)


def dose_integers(dose: Column) -> Column:
    ints = F.transform(F.split(dose, r"\+"), lambda p: F.regexp_extract(p, r"\d+", 0).try_cast("bigint"))
    kept = F.array_sort(F.array_distinct(F.filter(ints, lambda x: x.isNotNull())))
    return F.nullif(F.array_join(F.transform(kept, lambda x: x.cast("string")), "+"), F.lit(""))


_PACKS = {"ampoules": "ampoule ampoules", "bottles": "bottle bottles", "capsules": "cap caps capsule capsules", "drops": "drop drops", "g": "g gm", "kg": "kg", "l": "l", "ml": "ml", "sachets": "sachet sachets", "softgels": "softgel softgels", "tablets": "tab tablet tablets tabs", "vials": "vial vials"}
_COUNTED = "(?:ampoule|bottle|capsule|cap|drop|sachet|softgel|tablet|tab|vial)s?"


def pack_size(quantity: Column, name: Column) -> Column:
    """``value-unit`` from a quantity, else "strip of n", else "10's" or a volume in the name; null if none."""
    unit_of = F.create_map(*[F.lit(x) for unit, names in _PACKS.items() for n in names.split() for x in (n, unit)])
    q, n = squeeze(quantity), squeeze(name)
    both = F.concat_ws(" ", q, n)
    get = lambda c, p, i: F.nullif(F.regexp_extract(c, p, i), F.lit(""))
    number = lambda v: F.regexp_replace(F.regexp_replace(v, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    made = lambda v, u: F.concat(number(v), F.lit("-"), F.try_element_at(unit_of, F.lower(u)))
    counted = lambda c: F.coalesce(get(c, rf"(?i)(?<![a-z0-9_])({_COUNTED})(?![a-z0-9_])", 1), F.lit("tablets"))
    amount = rf"(?i)({N})\s*({_COUNTED}|g|gm|kg|l|ml){_END}"
    liquid = rf"(?i)({N})\s*(g|gm|kg|l|ml){_END}"
    strip, short = rf"(?i)strip of ({N})", rf"(?i)(?<![a-z0-9_])({N})\s*'?s{_END}"
    return F.coalesce(made(get(q, amount, 1), get(q, amount, 2)), made(get(both, strip, 1), counted(both)), made(get(n, short, 1), counted(n)), made(get(n, liquid, 1), get(n, liquid, 2)))


def salt_doses(salt: Column) -> Column:
    """Doses in parentheses, joined by +."""
    found = F.regexp_extract_all(salt, F.lit(rf"(?i)\(\s*({N}\s*(?:{_UNITS}|iu))"), F.lit(1))
    return F.nullif(F.array_join(F.transform(found, lambda x: F.lower(F.regexp_replace(x, r"\s+", ""))), "+"), F.lit(""))
