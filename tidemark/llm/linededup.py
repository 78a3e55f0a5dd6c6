"""Line dedup: lines that spread over many sites, counted by HyperLogLog sketches.

A line's key is 128 bits of hash of its words (A-Z lower-cased, white space between them as one space);
lines without words are left alone.  A sketch of the sites is built per key
by partial aggregation, so a line in a third of all documents reaches its reducer as one sketch a
task.  Lines whose estimate stands clear of the threshold are decided by it (joins to hot lines are split by ``spread_join``); those within
``MARGIN`` of it get an exact distinct count.  Lines on ``sites`` or more sites are boilerplate and
go, but for their first occurrence (smallest doc_id, then line), so that nothing that is said only in copies
of one document is lost from the corpus.

Null texts count as empty, null sites name no site.  Repeated rows are occurrences of their
own; of occurrences that tie for the first, all stay.  A null doc_id comes after all others.
Line ends are ``\\n``; kept lines are unchanged and stay joined by it.  Extra columns are
carried or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut, spread_join, stored

SITES, LOG2_BUCKETS, MARGIN = 8, 10, 0.15


KEY = ["k1", "k2"]


def line_keys(line: Column) -> tuple[Column, Column]:
    """128 bits for a line in lower case, in two halves; nulls where the line has no word."""
    odd = line.contains("  ")
    for c in "\t\x0b\x0c\r":
        odd = odd | line.contains(c)
    words = F.trim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))
    return F.when(words != "", F.xxhash64(words)), F.when(words != "", F.xxhash64(F.concat(F.lit("~"), words)))


def lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc, th, site, n, k1, k2): the lines with words; th, with the id, finds the row again."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("t"), F.col(site).cast("string").alias("site"))
    flat = base.select("doc", F.xxhash64("t").alias("th"), "site", F.posexplode(F.split(ascii_lower(F.col("t")), "\n", -1)).alias("n", "line"))
    k1, k2 = line_keys(F.col("line"))
    return flat.select("doc", "th", "site", "n", k1.alias("k1"), k2.alias("k2")).where(F.col("k1").isNotNull())


def _place() -> Column:
    return F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("n"))


def boilerplate(at: DataFrame, sites: int = SITES) -> tuple[DataFrame, DataFrame]:
    """The occurrences of lines that come often enough, and (k1, k2, first, rows) of those on ``sites`` or more sites."""
    # Few lines do: a count in front, by key alone, keeps sketches from being made for the others.
    often = at.groupBy(*KEY).agg(F.count("site").alias("c"), F.count("*").alias("rows")).where(F.col("c") >= sites).drop("c")
    common = stored(spread_join(at, often, KEY, "rows", at.count()))
    spread = common.groupBy(*KEY).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG2_BUCKETS))).alias("about"), F.min(_place()).alias("first"), F.count("*").alias("rows"))
    spread = cut(spread.where(F.col("about") >= sites * (1 - MARGIN)))
    near = spread.where(F.col("about") <= sites * (1 + MARGIN)).select(*KEY, "rows")
    exact = spread_join(common, near, KEY, "rows", common.count()).select(*KEY, "site").distinct().groupBy(*KEY).agg(F.count("site").alias("c")).where(F.col("c") >= sites).select(*KEY)
    sure = spread.where(F.col("about") > sites * (1 + MARGIN)).select(*KEY, "first", "rows")
    return common, sure.unionByName(spread.join(exact, KEY).select(*KEY, "first", "rows"))


def removals(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """(doc, th, gone): the numbers of the lines to remove, for rows that have some."""
    common, bad = boilerplate(stored(lines(docs, site)), sites)
    out = spread_join(common, bad, KEY, "rows", common.count()).where(_place() != F.col("first"))
    return out.groupBy("doc", "th").agg(F.collect_set("n").alias("gone"))


def with_removals(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``docs`` with ``__tm_gone``: the numbers of the lines to remove (null: none)."""
    gone = removals(docs, site, sites).select(F.col("doc").alias("__tm_doc"), F.col("th").alias("__tm_th"), F.col("gone").alias("__tm_gone"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__tm_doc")) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col("__tm_th"))
    return docs.join(gone, same, "left").drop("__tm_doc", "__tm_th")


KEPT_TEXT = r"array_join(filter(split(text, '\n', -1), (x, i) -> not array_contains(__tm_gone, i)), '\n')"


def line_dedup(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_sha256 of the text that is left."""
    marked = with_removals(docs.select("doc_id", "text", site), site, sites)
    text = F.when(F.col("__tm_gone").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.expr(KEPT_TEXT))
    n = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1))
    return marked.select(F.col("doc_id").cast("long").alias("doc_id"), n.cast("long").alias("n_lines"), F.coalesce(F.size("__tm_gone"), F.lit(0)).cast("long").alias("n_removed"), F.sha2(text, 256).alias("kept_sha256"))


def without_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """``docs`` without boilerplate lines; rows of which no word is left go, all others keep their columns."""
    columns = docs.columns
    text = F.when(F.col("__tm_gone").isNull(), F.col("text")).otherwise(F.expr(KEPT_TEXT)).alias("text")
    marked = with_removals(docs, site, sites)
    out = marked.select(*[text if c == "text" else F.col(f"`{c}`") for c in columns], F.col("__tm_gone").isNull().alias("__tm_whole"))
    return out.where(F.col("__tm_whole") | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*[F.col(f"`{c}`") for c in columns])
