"""Names, descriptions, side effects, lists and html, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.common import present
from tidemark.functions.dosage import squeeze

_B, _E, _N = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])", "[0-9]+(?:[.][0-9]+)?"
NAME_NOISE = sorted("best bottle buy capsule capsules cheap discount for new of offer online order pack price strip syrup tab tablet tablets the".split())


def plain(c: Column) -> Column:
    """Lower case, words and hyphens alone, one blank between."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"[^A-Za-z0-9_\s-]", " "), r"\s+", " "))


def split_caps(c: Column) -> Column:
    """Words that were glued together by case or digits, apart again."""
    out = squeeze(c)
    out = F.regexp_replace(out, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z0-9])(?=[A-Z][a-z])", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(out, "(?i)&nbsp;", " "), "&#39;", "'"), r"\s+", " "))


def without_words(c: Column, words: list[str]) -> Column:
    return F.trim(F.array_join(F.filter(F.split(c, " "), lambda w: ~w.isin(words)), " "))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def valid_name(c: Column) -> Column:
    """3 to 60 characters, a letter, and no sales talk."""
    return F.char_length(F.trim(c)).between(3, 60) & c.rlike("[A-Za-z]") & ~c.rlike("(?i)buy online|best price|lowest price|uses and side|view all|order now")


_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def entities(c: Column) -> Column:
    """Named and numeric entities; the ampersand last, so that nothing is decoded twice."""
    out = c
    for name, ch in _ENTITIES[:-1]:
        out = F.regexp_replace(out, f"(?i){name}", ch)
    # Numbers: each piece after "&#" starts with one, if it is an entity.
    parts = F.split(out, "&#(?=[0-9]{1,6};|[xX][0-9A-Fa-f]{1,5};)", -1)

    def decode(p: Column, i: Column) -> Column:
        code = F.when(p.rlike("^[xX]"), F.conv(F.regexp_extract(p, "^[xX]([0-9A-Fa-f]+);", 1), 16, 10).try_cast("int")).otherwise(F.regexp_extract(p, "^([0-9]+);", 1).try_cast("int"))
        # The character of a code point, by its four bytes of UTF-32.
        char = F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")
        return F.when(i == 0, p).otherwise(F.concat(char, F.regexp_replace(p, "^[xX]?[0-9A-Fa-f]+;", "")))

    return F.regexp_replace(F.array_join(F.transform(parts, decode), ""), "(?i)&amp;", "&")


def strip_html(c: Column) -> Column:
    """Block tags become line ends, others blanks; named entities decoded; blanks and empty lines squeezed."""
    out = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?i)<\s*(?:br|/?(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article))\b[^>]*>", "\n")
    out = entities(F.regexp_replace(out, "<[^>]+>", " "))
    out = F.regexp_replace(F.regexp_replace(out, "[ \\t\\x0b\\f\\r]+", " "), " ?\\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(out, "\\n+", "\n"), r"^\s+|\s+$", "")


_LINE_NOISE = "(?im)" + "|".join(
    ["^buy (?:now|online|today).*$", "^cash on delivery.*$", r"^click here\s*\.?\s*$", "^consult your (?:doctor|healthcare|physician).*$", r"^directions?\s+for\s+use\s*$", r"disclaimer\s*:.*$", r"^free (?:delivery|shipping).*$",
     r"^interactions?\s*$", r"^know more\s*\.?\s*$", r"^order (?:now|online|today).*$", r"^quick\s+links?.*$", r"^read more\s*\.?\s*$", r"^view all\s*\.?\s*$", r"^(?:summary|synopsis|introduction)\s*$"]
)


def description(c: Column) -> Column:
    """Html and page noise out; lines that repeat or contain one another once, in order; null if nothing is left."""
    clean = F.regexp_replace(strip_html(c), _LINE_NOISE, "")
    lines = F.filter(F.transform(F.split(clean, r"\n+"), F.trim), lambda x: x != "")
    lines = F.flatten(F.transform(lines, lambda p: F.when(F.char_length(p) > 500, F.split(p, r"(?<=[!.?])[\s]+(?=[A-Z])")).otherwise(F.array(p))))
    key = lambda x: F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))

    def step(acc: Column, x: Column) -> Column:
        k = key(x)
        dup = (F.char_length(k) < 3) | F.exists(acc, lambda y: key(y).contains(k) | k.contains(key(y)))
        return F.when(dup, acc).otherwise(F.array_append(acc, x))

    return F.nullif(F.array_join(F.aggregate(lines, F.array().cast("array<string>"), step), "\n"), F.lit(""))


_FRAGMENT = rf"(?i){_B}(?:belongs to|called|consisting|contains|it is|known as|marketed by|prescribed|refers to|that is|used to|which|works by){_E}"


def side_effects(items: Column) -> Column:
    """Single effects in lower case: lines split at marks and "and", short, few words, no sentences, each once."""
    lines = F.filter(F.flatten(F.transform(items, lambda x: F.split(x, r"\n+"))), lambda x: x != "")
    heads = lambda x: F.regexp_replace(F.regexp_replace(strip_html(x), r"(?i)^(?:common|rare|serious|some(?: common)?)\s+side\s+effects?\s*(?:include|are|of)?:?\s*", ""), r"^(?:\d+\s*\.\s*|[-*•]\s*)", "")
    parts = F.flatten(F.transform(lines, lambda x: F.split(heads(x), rf"[,;•·]|{_B}and{_E}")))
    edge = r"[•*,.;:\[\]()\s-]+"
    parts = F.transform(parts, lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), f"^{edge}", ""), f"{edge}$", "")))
    good = lambda x: F.char_length(x).between(3, 50) & (F.size(F.split(x, r"\s+")) <= 6) & ~x.rlike(r"^(?:common|include|may|can|rare|serious|some|the|these|this)|^side\s*effects?") & ~x.rlike(_FRAGMENT)
    return F.array_distinct(F.filter(parts, good))


def effect_list(items: Column) -> Column:
    """At most 40 characters, no notices, capitalised, each once whatever its case."""
    drop = "(?i)consult your doctor|no common side effects|precautions|warnings|directions for use|storage|antipyretics|do not require|as your body adjusts"
    clean = F.transform(items, lambda x: F.trim(F.regexp_replace(F.trim(x), r"^\.+|\.+$", "")))
    clean = F.filter(clean, lambda x: F.char_length(x).between(3, 40) & ~x.rlike(drop))
    clean = F.transform(clean, lambda x: F.replace(F.replace(x, F.lit("'")), F.lit("’"), F.lit("'")))
    clean = F.transform(clean, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substr(x, F.lit(2))))
    return distinct_by(clean, F.lower)


def distinct_by(items: Column, key) -> Column:
    """The first of all items with the same key, in order."""
    return F.filter(items, lambda x, i: ~F.exists(F.slice(items, 1, F.greatest(i, F.lit(0))), lambda y: key(y) == key(x)))


def faq(items: Column) -> Column:
    """Questions and answers that are there, each pair once whatever its case."""
    clean = F.transform(items, lambda x: F.struct(squeeze(x["question"]).alias("question"), squeeze(x["answer"]).alias("answer")))
    clean = F.filter(clean, lambda x: x["question"].isNotNull() & x["answer"].isNotNull())
    return distinct_by(clean, lambda x: F.concat(F.lower(x["question"]), F.lit("::"), F.lower(x["answer"])))


def missing_fields(raw_name: Column, cleaned: Column, salt: Column, desc: Column, dosage: Column, product: Column, price: Column) -> Column:
    named = present(raw_name) & (raw_name != "Unknown Product")
    tag = lambda cond, t: F.when(cond, t)
    return F.array_compact(F.array(tag(~F.coalesce(named, F.lit(False)), "name"), tag(F.coalesce(named, F.lit(False)) & cleaned.isNull(), "name_quality"), tag(~present(salt), "salt"), tag(~present(desc), "description"), tag(~present(dosage), "dosage"), tag(F.coalesce(product, F.lit(False)) & (price.isNull() | F.isnan(price)), "price")))


OUT_OF_STOCK = r"(?i)currently unavailable|not available|notify me|out of stock|sold\s*out|temporarily out|unavailable"


def in_stock(text: Column) -> Column:
    """Stock from any shape: flag, number or text; what is not known counts as there."""
    low = F.replace(F.coalesce(text, F.lit("")), F.lit("_"), F.lit(" "))
    number = low.try_cast("double")
    return F.when(low.isin("true", "false"), low == "true").when(number.isNotNull(), number > 0).otherwise(~low.rlike(OUT_OF_STOCK))


def image_url(url: Column, base: Column) -> Column:
    """An absolute http(s) url that is no placeholder, else ''."""
    u = F.trim(F.coalesce(url, F.lit("")))
    b = F.regexp_replace(F.coalesce(base, F.lit("")), "/+$", "")
    full = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/") & (b != ""), F.concat(b, u)).otherwise(u)
    bad = r"(?i)data:image|placeholder[./]|/placeholder|(?:blank|spacer)[.](?:gif|png)|loading[.](?:gif|svg)|(?:default[_-]?(?:image|product)|no[_-]?image)"
    return F.when(full.rlike("(?i)^https?://") & ~full.rlike(bad), full).otherwise("")


def widest(srcset: Column) -> Column:
    """The url of the largest declared width, the first of equals."""
    parts = F.filter(F.transform(F.split(srcset, ","), lambda x: F.split(F.trim(x), r"\s+")), lambda x: F.element_at(x, 1) != "")
    keyed = F.transform(parts, lambda x, i: F.struct(F.coalesce(F.regexp_replace(F.try_element_at(x, F.lit(2)), r"[^\d.]", "").try_cast("double"), F.lit(0.0)).alias("w"), (-i).alias("i"), F.element_at(x, 1).alias("u")))
    return F.coalesce(F.array_max(keyed)["u"], F.lit(""))


def clean_match_name(c: Column) -> Column:
    noise = rf"(?i){_B}(?:capsules?|cream|drops?|gel|gm|injection|mcg|mg|ml|of|ointment|strip|syrup|tablet|tablets){_E}"
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), noise, " "), "[^a-z0-9]", " "), r"\s+", " "))


def safe_match(name: Column, fetched: Column, salt: Column) -> Column:
    """A number in common where both have some; then the brand, or else a word of the salt, in the fetched name."""
    a, b = clean_match_name(name), clean_match_name(fetched)
    nums = lambda c: F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0))
    alpha = lambda c: F.filter(F.split(F.regexp_replace(c, r"\d+", " "), r"\s+"), lambda w: F.char_length(w) > 1)
    within = lambda w: F.exists(alpha(b), lambda x: x.contains(w) | w.contains(x))
    clash = (F.size(nums(a)) > 0) & (F.size(nums(b)) > 0) & ~F.arrays_overlap(nums(a), nums(b))
    brand = (F.size(alpha(a)) > 0) & (F.size(alpha(b)) > 0) & F.coalesce(within(F.try_element_at(alpha(a), F.lit(1))), F.lit(False))
    molecules = F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(salt, F.lit(""))), "[^a-z0-9]", " "), r"\s+"), lambda w: F.char_length(w) > 3)
    return F.when(clash, False).when(brand | (F.size(alpha(a)) == 0), True).otherwise(F.exists(molecules, within))


def longer(old: Column, new: Column) -> Column:
    """The strictly longer text; "Unknown Product" loses to any other."""
    unknown = F.coalesce(old, F.lit("")).isin("", "Unknown Product")
    return F.when(F.coalesce(new, F.lit("")).isin("", "Unknown Product"), F.coalesce(old, new)).when(unknown | (F.char_length(new) > F.char_length(old)), new).otherwise(old)


def price(text: Column) -> Column:
    """The first number of a price text, thousands marks out."""
    return F.regexp_extract(F.replace(F.coalesce(text, F.lit("")), F.lit(",")), r"\d+(?:\.\d+)?", 0).try_cast("double")


def near_currency(text: Column) -> Column:
    get = lambda p: F.nullif(F.regexp_extract(F.replace(text, F.lit(",")), p, 1), F.lit(""))
    return F.coalesce(*[get(p) for p in (rf"(?i)(?:₹|inr|rs\.?)\s*({_N})", rf"(?i)({_N})\s*(?:₹|inr|rs)", rf"(?i)mrp\s*:?\s*({_N})", rf"(?i)price\s*:?\s*({_N})")]).try_cast("double")


LEGAL_WORDS = ("limited", "ltd", "pharma", "pharmaceuticals", "private", "pvt")


def without_maker(name: Column, maker: Column) -> Column:
    """A name in lower case without the whole words of its maker; short and legal words of the maker do not count."""
    words = F.filter(F.split(F.lower(F.coalesce(maker, F.lit(""))), r"\s+"), lambda w: (F.char_length(w) > 2) & ~w.isin(*LEGAL_WORDS))
    n = F.aggregate(words, F.lower(F.coalesce(name, F.lit(""))), lambda a, w: F.regexp_replace(a, F.concat(F.lit(_B + r"\Q"), w, F.lit(r"\E" + _E)), F.lit("")))
    return F.trim(F.regexp_replace(n, r"\s+", " "))
