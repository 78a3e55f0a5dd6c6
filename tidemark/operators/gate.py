"""Staging gate: what a candidate lacks, its signature, and where it goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import salts as S
from tidemark.operators import identity as I


def reasons(name: Column, salt: Column, maker: Column, form: Column, prices: Column) -> Column:
    """Reason codes of a rejection, none for a valid candidate; ``prices`` is an array of {mrp, sale_price}."""
    n, s, m, f = (F.trim(F.coalesce(c, F.lit(""))) for c in (name, salt, maker, form))
    ident, key = I.identity(n, s), S.salt_key(s)
    tag = lambda cond, t: F.when(cond, t)
    sold = F.exists(F.coalesce(prices, F.array().cast(PRICES)), lambda p: F.coalesce((p["sale_price"] > 0) & (p["sale_price"] <= p["mrp"]), F.lit(False)))
    dosage_form = F.when(ident["form"] != "", ident["form"]).otherwise(F.lower(f))
    return F.array_compact(
        F.array(
            F.when(F.char_length(n) < 3, "NAME_MISSING").when(n.rlike(r"(?i)\b(?:off|pack\s*of|buy\s*[0-9]+|best\s*seller|flat\s*[0-9]+%)\b"), "MARKETING_IN_NAME"),
            F.when((s == "") | (key == ""), "SALT_MISSING").when(~S.is_molecular(key), "INVALID_MOLECULAR_SALT"),
            tag(F.char_length(m) < 2, "MANUFACTURER_MISSING"),
            tag(dosage_form.isin("", "unspecified"), "FORM_MISSING"),
            tag(F.size(ident["strength"]) == 0, "STRENGTH_MISSING"),
            tag(~sold, "PRICE_INVALID"),
        )
    )


PRICES = "array<struct<mrp:double,sale_price:double>>"


def promote(staging: DataFrame, canonical: DataFrame) -> DataFrame:
    """(id, outcome, canonical_id) for staging (id, raw_name, raw_salt, raw_manufacturer, raw_form, raw_prices).

    ``canonical``: (medicine_id, resolution_signature, known_signatures).  Of several new candidates of one
    signature the smallest id is promoted and the others merge into it, so a second run promotes nothing.
    """
    why = reasons(*[F.col(c) for c in ("raw_name", "raw_salt", "raw_manufacturer", "raw_form", "raw_prices")])
    rows = staging.select("id", why.alias("reasons"), I.signature(F.col("raw_name"), F.col("raw_salt"), F.col("raw_form")).alias("sig"))
    known = F.coalesce("known_signatures", F.array().cast("array<string>"))
    sigs = canonical.select("medicine_id", F.explode(F.array_union(F.array("resolution_signature"), known)).alias("sig")).groupBy("sig").agg(F.min("medicine_id").alias("medicine_id"))
    valid = rows.where(F.size("reasons") == 0)
    heads = valid.groupBy("sig").agg(F.min("id").alias("head"))
    both = rows.join(sigs, "sig", "left").join(heads, "sig", "left")
    bad = F.size("reasons") > 0
    outcome = F.when(bad, "VALIDATION_FAILED").when(F.col("medicine_id").isNotNull() | (F.col("id") != F.col("head")), "MERGED_EXISTING").otherwise("PROMOTED_NEW")
    return both.select("id", outcome.alias("outcome"), F.when(~bad, F.coalesce(F.col("medicine_id").cast("string"), F.concat(F.lit("new:"), F.col("head").cast("string")))).alias("canonical_id"), F.array_join("reasons", "|").alias("reasons"))
