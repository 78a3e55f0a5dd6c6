"""Interlinking of records that went in under one key or under keys that only look different."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dosage as D
from tidemark.functions import salts as S
from tidemark.operators.copies import once

_MAKERS = sorted(
    "abbott alkem amp aurobindo bayer biocon boehringer cadila cipla co corp corporation davaindia genericart glenmark gmbh gsk healthcare heteo inc india ingelheim intas limited llc ltd lupin mankind micro novartis pfizer pharm pharma pharmaceuticals private pvt reddy reddys sanofi serum stayhappi sun torrent wockhardt zydus".split()
)
_PARTS = sorted("bottle box cap capsule capsules caps cream drop drops gel injection new of ointment pack sachet spray strip strips suspension syrup tab tablet tablets tabs".split())
_B, _E = "(?<![a-z0-9_])", "(?![a-z0-9_])"
NUMBER, AMOUNT = "[0-9]+(?:[.][0-9]+)?", r"\s*(?:%|g|gm|iu|kg|mcg|mg|ml|units?)"


def matching_name(name: Column) -> Column:
    """A name without makers, forms, packs, doses and numbers; release marks such as SR stay."""
    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    for pattern in (
        f"{_B}({'|'.join(_MAKERS)}){_E}", f"{_B}({'|'.join(_PARTS)}){_E}", rf"{_B}\d+\s*'s{_E}", r"[^a-z0-9\s\-.]",
        f"{NUMBER}{AMOUNT}{_E}", "[0-9]+", r"\s+",
    ):
        n = F.regexp_replace(n, pattern, " ")
    return F.trim(F.regexp_replace(F.trim(n), r"[\s\-,.|:;+*]+$", ""))


def alike_groups(rows: DataFrame, one_dose: bool = False, least: float = 0.6, several: str | None = None) -> DataFrame:
    """(key, n): groups of several rows (key, name, dose) whose names are alike, pair by pair of distinct names.

    ``rows`` may be counted already, in a column ``n``. With ``several``, groups have more than one value of that column.
    Groups are keys of one product, so their distinct names are few; copies of a name are counted, not paired, and
    names of groups that are out by their counts or doses are not paired either.
    """
    total = F.sum("n") if "n" in rows.columns else F.count("*")
    differ = several or "dose"
    groups = rows.groupBy("key").agg(total.alias("n"), F.min("dose").alias("lo"), F.max("dose").alias("hi"), F.min(differ).alias("first"), F.max(differ).alias("last")).where("n > 1")
    if one_dose:
        groups = groups.where("lo = hi")
    if several:
        groups = groups.where("first < last")
    groups = groups.select("key", "n")
    names = rows.select("key", "name").distinct().join(groups.select("key"), "key")
    a, b = names.alias("a"), names.alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.name") < F.col("b.name"))).groupBy(F.col("a.key").alias("key")).agg(F.min(S.word_jaccard(F.col("a.name"), F.col("b.name"))).alias("least"))
    return groups.join(pairs, "key", "left").where(F.coalesce("least", F.lit(1.0)) >= least).select("key", "n")


def _core() -> Column:
    return matching_name(F.coalesce(F.nullif("normalized_name", F.lit("")), "name"))


def _dose() -> Column:
    return D.fuzzier(D.fuzzy_dose(F.col("name")), D.fuzzy_dose(F.col("dosage")))


def fuzzy_key_groups(rows: DataFrame, least: float = 0.6) -> DataFrame:
    """(key, n): pass 2, groups of one core and dose that went in under several canonical keys.

    ``rows`` have name, normalized_name, dosage and canonical_key; those without core or dose take no part.
    """
    keyed = once(rows, ["name", "normalized_name", "dosage", "canonical_key"], F.count("*").alias("n")).select(_core().alias("core"), _dose().alias("dose"), matching_name(F.col("name")).alias("name"), F.nullif("canonical_key", F.lit("")).alias("canonical"), "n")
    keyed = keyed.where("core <> '' AND dose IS NOT NULL").withColumn("key", F.concat_ws("|", "core", "dose"))
    return alike_groups(keyed, one_dose=True, least=least, several="canonical")


def integer_dose_groups(rows: DataFrame, least: float = 0.6) -> DataFrame:
    """(key, n): pass 3, groups of one core, salt and whole part of the dose whose doses differ.

    ``rows`` have name, normalized_name, dosage and salt; those without core or whole part take no part.
    """
    salt = F.coalesce(F.nullif(F.regexp_replace(F.lower("salt"), "[^a-z0-9]", ""), F.lit("")), F.lit("NOSALT"))
    keyed = once(rows, ["name", "normalized_name", "dosage", "salt"], F.count("*").alias("n")).select(_core().alias("core"), _dose().alias("dose"), matching_name(F.col("name")).alias("name"), salt.alias("salt"), "n").withColumn("ints", D.dose_integers(F.col("dose")))
    keyed = keyed.where("core <> '' AND ints IS NOT NULL").withColumn("key", F.concat_ws("|", "core", "ints", "salt"))
    return alike_groups(keyed, least=least, several="dose")


_OVERLAP_PARTS = "tablet tablets tab tabs capsule capsules cap caps strip strips pack bottle syrup suspension injection drop drops ointment cream gel spray sachet box of new".split()


def overlap_name(name: Column, maker: Column) -> Column:
    """A name without the words of its own maker, forms, packs and doses; bare numbers stay."""
    words = F.filter(F.split(F.lower(F.coalesce(maker, F.lit(""))), r"\s+"), lambda w: (F.char_length(w) > 2) & ~w.isin("ltd", "pvt", "limited", "private", "pharma", "pharmaceuticals"))
    n = F.aggregate(words, F.lower(F.coalesce(name, F.lit(""))), lambda a, w: F.regexp_replace(a, F.concat(F.lit(_B + r"\Q"), w, F.lit(r"\E" + _E)), F.lit("")))
    for pattern, put in ((rf"{_B}(?:{'|'.join(_OVERLAP_PARTS)}){_E}", " "), (rf"{_B}\d+\s*'s{_E}", " "), (r"[^a-z0-9\s\-.]", " "), (rf"{_B}{NUMBER}\s*(?:(?:mg|ml|mcg|gm|g|kg){_E}|%(?=[a-z0-9_]))", ""), (r"\s+", " ")):
        n = F.regexp_replace(n, pattern, put)
    return F.trim(F.regexp_replace(F.trim(n), r"[\s\-,.|:]+$", ""))


def overlap_groups(rows: DataFrame, least: float = 0.8) -> DataFrame:
    """(dose, leader, id): each name joins the first leader (by id) of its dose with which it shares ``least`` of the longer's words.

    ``rows`` have id, name, dosage and manufacturer. A name that joins none leads; leaders that none joins are left out.
    Greedy groups depend on the order, so a dose is one unit of work; words lead to the leaders, and no pairs are made.
    """
    dose = F.regexp_replace(F.regexp_replace(F.lower("dosage"), r"\s+", ""), r"^(.*?)[.]0(?=mg|ml|mcg|g|kg|%)", "$1")
    named = rows.select("id", dose.alias("dose"), overlap_name(F.col("name"), F.col("manufacturer")).alias("name")).where("dose <> '' AND name <> ''")

    def group(t: pa.Table) -> pa.Table:
        leaders: list[tuple[int, int]] = []  # id and number of words
        by_word: dict[str, list[int]] = {}
        of: dict[frozenset, int] = {}
        members: dict[int, list[int]] = {}
        for i, name in sorted(zip(t["id"].to_pylist(), t["name"].to_pylist(), strict=True)):
            words = frozenset(name.split(" "))
            if words not in of:
                shared: dict[int, int] = {}
                for w in words:
                    for k in by_word.get(w, ()):
                        shared[k] = shared.get(k, 0) + 1
                first = min((k for k, c in shared.items() if c / max(len(words), leaders[k][1]) >= least), default=None)
                if first is None:
                    first = len(leaders)
                    leaders.append((i, len(words)))
                    for w in words:
                        by_word.setdefault(w, []).append(first)
                of[words] = first
            members.setdefault(of[words], []).append(i)
        found = [(leaders[k][0], i) for k, ids in members.items() if len(ids) > 1 for i in ids]
        return pa.table({"dose": pa.array([t["dose"][0].as_py()] * len(found), pa.string()), "leader": pa.array([x for x, _ in found], pa.int64()), "id": pa.array([i for _, i in found], pa.int64())})

    return named.groupBy("dose").applyInArrow(group, "dose string, leader long, id long")
