"""Extraction from JSON, html and markdown, without a parser where the shape allows it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import entities, price

_Q, _NQ = "[\"']", "[^\"']+"
LD = rf"(?is)<script\b[^>]*\btype={_Q}application/ld[+]json{_Q}[^>]*>(.*?)</script"


def _first(*cs: Column) -> Column:
    return F.coalesce(*cs)


def ld_product(html: Column) -> Column:
    """{name, sale_price, mrp, in_stock, manufacturer} of the first Product or Drug in JSON-LD; null if there is none.

    Blocks may hold one object, an array, or a ``@graph``; offers may be one or several.
    """
    def get(v: Column, path: str, kind: str = "string") -> Column:
        return F.try_variant_get(v, path, kind)

    blocks = F.filter(F.transform(F.regexp_extract_all(html, F.lit(LD), F.lit(1)), lambda b: F.try_parse_json(F.trim(b))), lambda v: v.isNotNull())
    many = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    nodes = F.flatten(F.transform(blocks, lambda v: F.concat(F.array(v), many(v, "$"), many(v, "$['@graph']"))))
    kind = lambda v: F.lower(F.coalesce(get(v, "$['@type']"), F.array_join(F.try_variant_get(v, "$['@type']", "array<string>"), " "), F.lit("")))

    def product(v: Column) -> Column:
        offer = lambda k: _first(get(v, f"$.offers.{k}"), get(v, f"$.offers[0].{k}"))
        sale = price(_first(offer("price"), offer("lowPrice")))
        high = price(offer("highPrice"))
        stock = F.regexp_replace(F.lower(F.coalesce(offer("availability"), F.lit(""))), "_", "")
        maker = _first(get(v, "$.manufacturer.name"), get(v, "$.brand.name"), get(v, "$.manufacturer"), get(v, "$.brand"), F.lit(""))
        return F.struct(F.trim(entities(F.coalesce(get(v, "$.name"), F.lit("")))).alias("name"), sale.alias("sale_price"), F.greatest(sale, high).alias("mrp"), (~stock.rlike("outofstock|soldout|discontinued")).alias("in_stock"), F.trim(entities(maker)).alias("manufacturer"))

    found = F.transform(F.filter(nodes, lambda v: kind(v).rlike("product|drug")), product)
    return F.try_element_at(F.filter(found, lambda p: (p["name"] != "") & (p["sale_price"] > 0)), F.lit(1))


def state_key(html: Column, *keys: str) -> Column:
    """The first of ``keys`` that a state blob gives a number or a text for."""
    return F.coalesce(*[F.nullif(F.regexp_extract(html, rf'"{k}"\s*:\s*"?([^",}}]+)', 1), F.lit("")) for k in keys])


def page_stock(html: Column) -> Column:
    """An explicit flag, else the schema.org mark, else true."""
    flag = state_key(html, "inStock", "in_stock", "available")
    return F.when(flag.isin("true", "false"), flag == "true").otherwise(~F.lower(html).rlike("schema.org/(?:outofstock|soldout)"))


def meta(html: Column, name: str) -> Column:
    named, value = f"(?:name|property)={_Q}{name}{_Q}", f"content={_Q}({_NQ}){_Q}"
    a, b = f"(?i)<meta[^>]+{named}[^>]*{value}", f"(?i)<meta[^>]+{value}[^>]*{named}"
    return F.coalesce(F.nullif(F.regexp_extract(html, a, 1), F.lit("")), F.nullif(F.regexp_extract(html, b, 1), F.lit("")))


def links(html: Column, base: Column) -> Column:
    """Distinct absolute links of the same host, fragments off, in order."""
    root = F.regexp_extract(base, "^(https?://[^/?#]+)", 1)
    hrefs = F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)<a[^>]+href=["']([^"'#]+)"""), F.lit(1)), lambda x: F.when(x.startswith("/"), F.concat(root, x)).otherwise(x))
    return F.array_distinct(F.filter(hrefs, lambda x: x.startswith(root)))


def sections(markdown: Column) -> Column:
    """(heading, body) of every ## section."""
    parts = F.filter(F.split(F.concat(F.lit("\n"), markdown), r"\n##\s+"), lambda p, i: i > 0)
    return F.transform(parts, lambda p: F.struct(F.trim(F.regexp_extract(p, r"^([^\n]*)", 1)).alias("heading"), F.trim(F.regexp_replace(p, r"^[^\n]*\n?", "")).alias("body")))


def bullets(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(r"(?m)^\s*[-*•]\s+(.+)$"), F.lit(1)), F.trim)


def list_of_lines(text: Column) -> Column:
    """Lines of a text that should have been a list; null if none is left."""
    items = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(F.trim(x), r"(?i)show\s*more\s*show\s*less", "")))
    kept = F.filter(items, lambda x: F.char_length(x) > 2)
    return F.when(F.size(kept) > 0, kept)


_ADVICE = ("alcohol", "breastfeeding", "driving", "kidney", "liver", "pregnancy")


def safety_advice(text: Column) -> Column:
    """category -> {status, text} from lines that start with a category; a fold over the lines."""
    low = lambda x: F.lower(F.trim(x))

    def category(x: Column) -> Column:
        c = F.when(low(x).rlike("^breast[ -]?feeding"), "breastfeeding").when(low(x).startswith("pregnan"), "pregnancy")
        for k in _ADVICE:
            c = c.when(low(x).startswith(k), k)
        return c

    strip = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.trim(x), r"(?i)^(?:breast[ -]?feeding|pregnancy|pregnant|alcohol|driving|kidney|liver)\s*", ""), r"(?i)^(?:unsafe|safe|caution|consult your doctor)\s*", ""))
    start = F.struct(F.lit(None).cast("string").alias("c"), F.create_map().cast("map<string,string>").alias("m"))

    def step(acc: Column, x: Column) -> Column:
        c = F.coalesce(category(x), acc["c"])
        piece = F.when(category(x).isNotNull(), strip(x)).otherwise(F.trim(x))
        old = F.try_element_at(acc["m"], c)
        fresh = F.when(category(x).isNotNull() | old.isNull() | (old == ""), piece).otherwise(F.concat_ws(" ", old, piece))
        grown = F.map_concat(F.map_filter(acc["m"], lambda k, v: k != c), F.create_map(c, fresh))
        return F.when(c.isNull() | (F.trim(x) == ""), acc).otherwise(F.struct(c.alias("c"), grown.alias("m")))

    said = F.aggregate(F.split(text, "\n"), start, step, lambda a: a["m"])
    status = lambda t: F.when(F.lower(t).contains("unsafe"), "UNSAFE").when(F.lower(t).contains("safe"), "SAFE").when(F.lower(t).rlike("caution|consult"), "CAUTION").otherwise("UNKNOWN")
    return F.transform_values(F.map_filter(said, lambda k, v: v != ""), lambda k, v: F.struct(status(v).alias("status"), v.alias("text")))


def llm_json(text: Column) -> Column:
    """The object in an answer, fences off; else what stands in the outer braces; null if neither parses."""
    bare = F.trim(F.regexp_replace(text, "(?i)```(?:json)?", ""))
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))))


def headed(html: Column) -> Column:
    """(heading, body) of h1 to h6 and what stands before the next one, tags off."""
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    parts = F.filter(F.split(html, r"(?i)<h[1-6]\b[^>]*>"), lambda p, i: i > 0)
    return F.transform(parts, lambda p: F.struct(bare(F.element_at(F.split(p, "(?i)</h[1-6]>"), 1)).alias("heading"), bare(F.coalesce(F.try_element_at(F.split(p, "(?i)</h[1-6]>"), F.lit(2)), F.lit(""))).alias("body")))


def faq_page(html: Column) -> Column:
    """{question, answer} pairs of the FAQPage blocks in JSON-LD, in order, those with both."""
    get = lambda v, *paths: F.coalesce(*[F.nullif(F.trim(F.regexp_replace(F.try_variant_get(v, p, "string"), r"\s+", " ")), F.lit("")) for p in paths])
    many = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    blocks = F.filter(F.transform(F.regexp_extract_all(html, F.lit(LD), F.lit(1)), lambda b: F.try_parse_json(F.trim(b))), lambda v: v.isNotNull())
    nodes = F.flatten(F.transform(blocks, lambda v: F.concat(F.array(v), many(v, "$"), many(v, "$['@graph']"))))
    pages = F.filter(nodes, lambda v: F.coalesce(F.try_variant_get(v, "$['@type']", "string") == "FAQPage", F.lit(False)) | F.coalesce(F.array_contains(F.try_variant_get(v, "$['@type']", "array<string>"), "FAQPage"), F.lit(False)))
    pairs = F.transform(F.flatten(F.transform(pages, lambda v: many(v, "$.mainEntity"))), lambda e: F.struct(get(e, "$.name", "$.question").alias("question"), get(e, "$.acceptedAnswer.text", "$.acceptedAnswer.name", "$.text").alias("answer")))
    return F.filter(pairs, lambda x: x["question"].isNotNull() & x["answer"].isNotNull())


def faq_lines(lines: Column) -> Column:
    """{question, answer} pairs of lines that take turns, those with both."""
    clean = lambda c: F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(lines) - 1), F.lit(2)), lambda i: F.struct(clean(F.get(lines, i)).alias("question"), clean(F.get(lines, i + 1)).alias("answer")))
    return F.filter(pairs, lambda x: x["question"].isNotNull() & x["answer"].isNotNull())
