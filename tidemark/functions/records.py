"""Records out of raw listings: compositions as tokens, names without sales talk, doses by guess, scored images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import dosage as D
from tidemark.functions import salts as S
from tidemark.functions import text as T

_B, _E = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
_TALE = "|".join(sorted("active ingredient;also known as;author details?;belongs to;click here;how to use;introduction;manufacturer;marketed by;prescribed for;salt synonyms?;side effects of;storage;store below;substitutes?;therapeutic;uses of;used to;view all;which belongs to;works by".split(";")))
_FILLER = "as|bp|composition|eq|equivalent|for|group|ip|of|salts?|strength|synonyms|the|to|usp"


def trimmed_salt(c: Column) -> Column:
    """A composition up to the first phrase of page text, without what follows a bar, semicolon or colon."""
    head = F.element_at(F.split(T.split_caps(c), f"(?i){_B}(?:{_TALE}){_E}"), 1)
    cut = F.regexp_replace(F.regexp_replace(head, "[:;|].*$", ""), rf"(?i),\s*(?:an?){_E}.*$", "")
    return F.nullif(F.trim(F.regexp_replace(cut, r"\s+", " ")), F.lit(""))


def salt_tokens(c: Column) -> Column:
    """Distinct molecules of a composition, in order, without doses and filler."""
    parts = F.split(F.translate(trimmed_salt(c), "()", "  "), r"(?i)\s*(?:[&+,/]|\salong with\s|\swith\s|\sand\s)\s*")

    def bare(x: Column) -> Column:
        y = F.regexp_replace(T.plain(T.split_caps(x)), D.SPAN, " ")
        return F.trim(F.regexp_replace(F.regexp_replace(y, f"{_B}(?:{_FILLER}){_E}", " "), r"\s+", " "))

    return F.coalesce(F.array_distinct(F.filter(F.transform(parts, bare), lambda x: x != "")), F.array().cast("array<string>"))


def normal_salt(c: Column) -> Column:
    """The third normal form: plain text of a composition, doses and filler out, molecules in place."""
    y = F.regexp_replace(F.regexp_replace(T.plain(trimmed_salt(c)), "-+", " "), D.SPAN, " ")
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(T.without_words(y, T.NAME_NOISE), f"{_B}(?:{_FILLER}){_E}", " "), r"\s+", " ")), F.lit(""))


def rebuilt(tokens: Column) -> Column:
    """{normalized_salt, primary_salt_key, salt} of a list of molecules."""
    clean = F.array_distinct(F.filter(F.transform(tokens, lambda x: F.trim(F.lower(x))), lambda x: x != ""))
    shown = F.array_join(F.transform(clean, F.initcap), " + ")
    return F.struct(F.array_join(clean, " ").alias("normalized_salt"), F.array_join(F.array_sort(clean), "+").alias("primary_salt_key"), shown.alias("salt"))


_SALES = "best price|buy|online|order|price|side effects|substitutes|uses|view"


def clean_name(c: Column) -> Column:
    """A name in lower case up to the first sales phrase, without packs; null if no good name is left."""
    low = F.lower(T.entities(F.coalesce(c, F.lit(""))))
    head = F.regexp_replace(low, rf"(?s)\s*[-:|,]?\s*{_B}(?:{_SALES}){_E}.*$", "")
    packs = rf"{_B}(?:(?:bottle|pack|strip)\s+of\s+[0-9]+\s*(?:ml|l)?|{D.N}\s*'s|(?:[1-9]|1[0245]|20|30|[56]0|100)\s+(?:capsule|strip|tablet)s?){_E}"
    out = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(head, packs, " "), r"[^a-z0-9\s.+%/-]", " "), r"\s+", " "))
    return F.when(T.valid_name(out), out)


def first_dose(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(c, D.SPAN, 1)), F.lit(""))


def key_dose(canonical_key: Column) -> Column:
    return F.nullif(F.regexp_extract(canonical_key, r"[|]dose:(.+)$", 1), F.lit(""))


def guessed_dose(name: Column) -> Column:
    """A bare number of 25 to 10,000 that is no pack size; ml for liquids, else mg."""
    bare = F.regexp_replace(F.lower(name), rf"(?:strip|pack)\s+of\s+[0-9]+|[0-9]+\s*'?s{_E}", " ")
    n = F.regexp_extract(bare, rf"{_B}([0-9]+){_E}", 1).try_cast("long")
    return F.when(n.between(25, 10000), F.concat(n.cast("string"), F.when(bare.rlike("syrup|suspension|solution|drops"), "ml").otherwise("mg")))


def valid_salt(salt: Column, name: Column) -> Column:
    """Three to 200 characters, letters, not the name itself, no page text."""
    return F.char_length(F.trim(salt)).between(3, 200) & salt.rlike("[A-Za-z]{3}") & (F.lower(F.trim(salt)) != F.lower(F.trim(name))) & ~salt.rlike(S.NOISE)


def image_points(url: Column) -> Column:
    """Points for what looks like a product photo."""
    low = F.lower(url)
    return F.when(low.rlike("[.](?:jpe?g|png|webp)"), 2).otherwise(0) + F.when(low.contains(".svg"), -6).otherwise(0) + F.when(low.rlike("catalog|large|medicine|product|zoom"), 4).otherwise(0) + F.when(low.rlike("banner|brand|icon|logo|placeholder|sprite"), -5).otherwise(0)


def best_image(urls: Column) -> Column:
    """The url of most points, the first of equals."""
    return F.array_max(F.transform(urls, lambda u, i: F.struct(image_points(u).alias("p"), (-i).alias("i"), u.alias("u"))))["u"]


def dose_overlap(a: Column, b: Column) -> Column:
    """Whether two compositions share a number; true where one has none."""
    nums = lambda c: F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(D.N), F.lit(0)), lambda x: x.cast("double"))
    return (F.size(nums(a)) == 0) | (F.size(nums(b)) == 0) | F.arrays_overlap(nums(a), nums(b))


def query_terms(q: Column) -> Column:
    """Terms of two or more characters of a query, sales words out."""
    return F.array_distinct(F.filter(F.split(T.plain(q), " "), lambda w: (F.char_length(w) >= 2) & ~w.isin(T.NAME_NOISE)))


def mentions(text: Column, q: Column) -> Column:
    return F.exists(query_terms(q), lambda w: F.lower(text).contains(w))


def _tokens_in_place(title: Column) -> Column:
    """Each dose of a title in its one form, with blanks around."""
    gaps, found = F.split(title, D.SPAN, -1), F.regexp_extract_all(title, F.lit(D.SPAN), F.lit(1))
    shown = F.transform(found, lambda m: F.coalesce(F.concat(F.lit(" "), D.dose_token(m), F.lit(" ")), F.lit(" ")))
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(shown, i), F.lit("")))), "")


def without_pack(title: Column, pack: Column) -> Column:
    """A title without its pack, given as ``value-unit``: "strip of 10", "10 tablets" and "10 s"."""
    parts = F.split(pack, "-")
    value, unit = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    quoted = lambda c: F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))
    kinds = F.when(unit == "tablets", r"tablets?|tabs?").when(unit == "capsules", r"capsules?|caps?").otherwise(quoted(unit))
    out = title
    for pattern in (F.concat(F.lit(rf"(?i){_B}strip\s+of\s+"), quoted(value), F.lit(_E)), F.concat(F.lit(f"(?i){_B}"), quoted(value), F.lit(r"\s*(?:"), kinds, F.lit(f"){_E}")), F.concat(F.lit(f"(?i){_B}"), quoted(value), F.lit(rf"\s*s{_E}"))):
        out = F.regexp_replace(out, pattern, F.lit(" "))
    return F.when((F.coalesce(value, F.lit("")) != "") & (F.coalesce(unit, F.lit("")) != ""), out).otherwise(title)


def normal_name(name: Column, dosage: Column, pack: Column) -> Column:
    """A record's name: plain, doses in one form (that of the record where it has one), without pack and noise words; empty for none."""
    title, token = T.plain(name), D.dose_token(dosage)
    put = F.concat(F.lit(" "), token, F.lit(" "))
    number = F.regexp_extract(token, D.N, 0)
    own = F.regexp_replace(title, F.lit(D.SPAN), put)
    own = F.when(number != "", F.regexp_replace(own, F.concat(F.lit(rf"{_B}\Q"), number, F.lit(rf"\E{_E}")), put)).otherwise(own)
    out = without_pack(F.when(token.isNotNull(), own).otherwise(_tokens_in_place(title)), pack)
    return F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(T.without_words(out, T.NAME_NOISE), f"{_B}new{_E}", " "), r"\s+", " ")), F.lit(""))


def hint_is_salt(raw_name: Column, hint: Column) -> Column:
    """Whether the query that found a record names its composition: the plain name holds it."""
    return F.coalesce((hint != "") & (raw_name != "") & T.plain(raw_name).contains(hint), F.lit(False))


_STRAY = (r"(?i)https?://", r"(?i)www[.][A-Za-z0-9_]+", "(?i)<[a-z][^>]*>", rf"(?i){_B}(?:buy|cart|click|delivery|know\s+more|order|read\s+more|shipping|shop){_E}", rf"(?i){_B}(?:copyright|fulfillment|licensed|pharmacy|retail){_E}", r"(?:\|.*){2}", r"[{}\[\]]")


def stray_normal_form(c: Column) -> Column:
    """Whether a normalised name or composition holds page text: urls, tags, sales words, bars or brackets."""
    bad = F.lit(False)
    for pattern in _STRAY:
        bad = bad | c.rlike(pattern)
    return F.coalesce(bad, F.lit(False))


def error_page(md: Column) -> Column:
    low = F.lower(md)
    return F.coalesce(md.contains("returned error 404") | low.contains("can't seem to find") | low.contains("page not found") | (low.contains("oops") & low.contains("broken")), F.lit(False))


def title_name(title: Column) -> Column:
    """A page title up to the first bar, without the 's of a pack count."""
    return F.trim(F.regexp_replace(F.trim(F.element_at(F.split(title, r"\|"), 1)), r"'\s*s$", ""))


def prescription_url(url: Column, base: Column) -> Column:
    """The prescription page of a product url, whose item code and number are dropped."""
    slug = F.regexp_extract(url, "/product/([^/]+?)(?:-[a-z0-9]{6,}-[0-9]+)?$", 1)
    return F.when(slug != "", F.concat(base, F.lit("/prescriptions/"), slug)).otherwise(F.replace(url, F.lit("/product/"), F.lit("/prescriptions/")))


_PAGE_WORDS = rf"(?i){_B}(?:about\s+us|blog|careers|company|delivery|feedback|fulfillment|information|licensed|nearest|order|our\s+services|partner|pharmacy|retail|strip\s+of|view){_E}"


def salvaged_salt(c: Column) -> Column:
    """What can be kept of a spoilt composition: a structured one at its start, one in capitals with doses, else a first sentence without page words."""
    part, caps = r"[A-Za-z][A-Za-z\s-]+\s*\(\s*[0-9]+[^)]*\)", r"[A-Z][A-Z\s]+-[0-9]+[A-Za-z0-9_]+"
    one, two = F.regexp_extract(c, rf"^({part}(?:\s*\+\s*{part})*)", 1), F.regexp_extract(c, rf"^({caps}(?:\+{caps})*)", 1)
    first = F.element_at(F.split(c, r"\.\s+[A-Z]"), 1)
    return F.when(F.char_length(one) >= 10, F.trim(one)).when(F.char_length(two) >= 8, F.trim(two)).when((first != "") & (F.char_length(first) <= 120) & ~first.rlike(_PAGE_WORDS), F.trim(first))


def card_prices(text: Column) -> Column:
    """{sale, mrp} of a listing card, by the first of: an MRP label (less a discount), an offer label, rupee amounts, plain decimals; nulls for none."""
    number = lambda p: F.coalesce(F.replace(F.regexp_extract(text, p, 1), F.lit(",")).try_cast("double"), F.lit(0.0))
    every = lambda p: F.filter(F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(1)), lambda x: F.replace(x, F.lit(",")).try_cast("double")), lambda x: x.isNotNull())
    amount = r"\s*[^0-9\n]*\s*([0-9,]+\.?[0-9]*)"
    label, off, offer = number(f"(?i)MRP{amount}"), number(r"(?i)Save(?:\s+upto)?\s*[^0-9\n]*\s*([0-9]+)\s*%"), number(f"(?i)(?:Price|Offer|Best){amount}")
    rupees, decimals = every(r"₹\s*([0-9,]+\.?[0-9]*)"), F.filter(every(r"(?<![0-9])([0-9]+\.[0-9]{2})(?![0-9])"), lambda x: x < 500)
    by_label = F.struct(F.when(off > 0, F.round(label * (1 - off / 100), 2)).otherwise(label).alias("sale"), label.alias("mrp"))
    span = lambda a: F.struct(F.array_min(a).alias("sale"), F.array_max(a).alias("mrp"))
    got = F.when((label > 0) & (by_label["sale"] > 0), by_label).when(label > 0, F.struct(offer.alias("sale"), label.alias("mrp"))).when(offer > 0, F.struct(offer.alias("sale"), offer.alias("mrp"))).when(F.size(rupees) > 0, span(rupees)).when(F.size(decimals) > 0, span(decimals))
    return F.when(got["sale"] > 0, F.struct(got["sale"].alias("sale"), F.greatest(got["sale"], got["mrp"]).alias("mrp")))


_FORM_WORDS = "capsule|cream|drop|gel|inhaler|injection|ointment|spray|suspension|syrup|tablet"


def candidate_slugs(query: Column) -> Column:
    """Url slugs to try for a query, in order: as it is, with usual endings, and as brand, dose and form."""
    dashed = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9\s-]", ""), r"\s+", "-"), "-+", "-")
    low = F.lower(query)
    slug = F.trim(dashed(low))
    dose = rf"({D.N})\s*(mg|ml|mcg|gm?|kg|%)"
    number, unit, bare = F.regexp_extract(low, dose, 1), F.regexp_extract(low, dose, 2), F.regexp_extract(low, "([0-9]{2,5})", 1)
    form = F.coalesce(F.nullif(F.regexp_extract(low, f"{_B}({_FORM_WORDS})s?{_E}", 1), F.lit("")), F.lit("tablet"))
    brand = lambda gone: F.regexp_replace(dashed(F.regexp_replace(F.regexp_replace(low, gone, ""), f"{_B}(?:{_FORM_WORDS})s?{_E}", "")), "^-|-$", "")
    dosed, plain = brand(rf"{D.N}\s*(?:mg|ml|mcg|gm?|kg|%)"), brand(f"{_B}[0-9]{{2,5}}{_E}")
    join = lambda *p: F.concat_ws("-", *p)
    made = lambda b, d: F.array(join(b, d, form), F.concat(join(b, d, form), F.lit("s")), join(b, d))
    grams = bare.try_cast("int")
    gram = F.when((grams >= 1000) & (grams % 1000 == 0), F.array(join(plain, F.concat((grams / 1000).cast("int").cast("string"), F.lit("gm")), form))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    more = F.when((number != "") & (dosed != ""), made(dosed, F.concat(number, unit))).when((number == "") & (bare != "") & (plain != ""), F.concat(made(plain, F.concat(bare, F.lit("mg"))), gram)).otherwise(none)
    return F.array_distinct(F.concat(F.array(slug, *[F.concat(slug, F.lit(x)) for x in ("-tablets", "-tablet", "-capsules")]), more))


def repaired_url(url: Column, base: Column) -> Column:
    """An absolute http(s) url out of page source: escaped slashes and ampersands repaired, resolved against ``base``, no fragment; else null.

    Dots in relative paths are kept as they stand.
    """
    u = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(url), r"(?i)\\u002F", "/"), r"\\/", "/"), "(?i)&amp;", "&")
    origin, folder = F.regexp_extract(base, "^(https?://[^/?#]+)", 1), F.regexp_extract(base, "^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    beside = F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), u)
    full = F.when(u.rlike("(?i)^https?://"), u).when(u.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), u)).when((u == "") | u.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None).when(u.startswith("/"), F.concat(origin, u)).otherwise(beside)
    bare = F.regexp_replace(full, "#.*$", "")
    return F.when(bare.rlike("(?i)^https?://[^/?]+$"), F.concat(bare, F.lit("/"))).otherwise(bare)
