"""URL filters: host rules, and the ratio of two smoothed variable-order Markov models of characters.

A url's host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; its path then goes up to ``?``, ``#`` or the end.  A rule fits its host and all
subdomains where the path starts with the rule's; the longest that fits gives the verdict.

All other urls are judged by the method.  Urls with a verdict by rule are its labelled rows: four
fifths of them (by a hash of the url) train a model of accepted and one of rejected urls, the last
fifth calibrates.  Urls are mapped to 32 symbols (letters, one for digits, five marks, one for the
rest) and read in grams of four.  The probability of a symbol is interpolated over contexts of
three, two, one and no symbols, each order weighing ``MASS`` against its own counts, so a context
that was never seen leaves the word to the shorter ones.  The score is the mean of the log2 ratio
over the url; the limit is the one that errs least on the calibration rows, by the sum of the two classes' error
rates.

The table of grams has at most 32 ** 4 rows, whatever the corpus: that is the size bound on which
it is broadcast to score the urls.  Counts are taken over all labelled urls.  Log ratios are whole
numbers of 2 ** -16 bits, so sums do not depend on their order.

A null url, or one without ``://``, has an empty host and path, no rule, and is scored as its text
stands (null: the empty text, score 0).  Without rows of both classes the score is 0 and the limit
0: allow.  Rows are handled one by one, so repeated ids give a row each.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, cut

#: (rule, verdict); a rule is host + path.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Symbols: what is not among them becomes the last.
KEPT, OTHER = "abcdefghijklmnopqrstuvwxyz0/.-?", "~"
MASS, SCALE, BINS = 2.0, 65536, 1024
#: Urls whose MD5 starts with less than this calibrate: a fifth.
HELD = "33"


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(u, shape, 1), UPPER, LOWER), F.regexp_extract(u, shape, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; nulls where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, said in sorted(rules, key=lambda r: len(r[0])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def symbols(url: Column) -> Column:
    """The url in the 32 symbols, after three of the last one."""
    u = F.translate(F.coalesce(url, F.lit("")), UPPER + "123456789", LOWER + "0" * 9)
    return F.concat(F.lit(OTHER * 3), F.regexp_replace(u, f"[^{KEPT}]".replace("-", r"\-"), OTHER))


def _grams(df: DataFrame) -> DataFrame:
    return df.withColumn("g", F.explode(F.expr("if(char_length(sym) > 3, transform(sequence(1, char_length(sym) - 3), i -> substring(sym, i, 4)), array())")))


def model(labelled: DataFrame, urls: DataFrame) -> DataFrame:
    """(g, r): the log2 ratio of every gram in ``urls``, from ``labelled`` (sym, ok) urls."""
    c4 = _grams(labelled).groupBy("g").agg(F.sum(F.when(F.col("ok"), 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("b"))
    c4 = cut(c4)  # at most 32 ** 4 rows
    part = lambda start, n, name: c4.groupBy(F.substring("g", start, n).alias(name)).agg(F.sum("a").alias(f"{name}a"), F.sum("b").alias(f"{name}b"))
    grams = _grams(urls).select("g").distinct()
    total = c4.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("ta"), F.coalesce(F.sum("b"), F.lit(0)).alias("tb")).collect()[0]  # one row
    out = grams.join(c4.select("g", F.col("a").alias("g4a"), F.col("b").alias("g4b")), "g", "left")
    for start, n, at in ((1, 3, "x3"), (2, 3, "g3"), (2, 2, "x2"), (3, 2, "g2"), (3, 1, "x1"), (4, 1, "g1")):
        out = out.withColumn(at, F.substring("g", start, n)).join(part(start, n, at), at, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")

    def chance(k: str, t: int) -> Column:
        p = F.lit(1 / 32)
        for seen, context in ((f"g1{k}", F.lit(float(t))), (f"g2{k}", n(f"x1{k}")), (f"g3{k}", n(f"x2{k}")), (f"g4{k}", n(f"x3{k}"))):
            p = (n(seen) + F.lit(MASS) * p) / (context + F.lit(MASS))
        return p

    ratio = F.floor(F.log(chance("a", total.ta) / chance("b", total.tb)) / F.log(F.lit(2.0)) * SCALE + 0.5) if total.ta and total.tb else F.lit(0)
    return out.select("g", ratio.cast("long").alias("r"))


def scored(pages: DataFrame, ratios: DataFrame) -> DataFrame:
    """``pages`` (page_id, sym and more) with ``score``, the mean ratio in units of 1 / SCALE bits, as a whole number."""
    rid = pages.withColumn("rid", F.monotonically_increasing_id())
    long = rid.withColumn("g", F.explode_outer(F.expr("if(char_length(sym) > 3, transform(sequence(1, char_length(sym) - 3), i -> substring(sym, i, 4)), array())")))
    keep = [c for c in pages.columns if c != "sym"]
    out = long.drop("sym").join(F.broadcast(ratios), "g", "left").groupBy("rid").agg(*[F.first(c).alias(c) for c in keep], F.sum("r").alias("total"), F.count("g").alias("n"))
    return out.select(*keep, F.when(F.col("n") > 0, F.floor(F.coalesce(F.col("total"), F.lit(0)) / F.col("n"))).otherwise(0).cast("long").alias("score"))


def calibrated(held: DataFrame) -> int:
    """The least limit, in steps of 1/64 bit from -8 to 8, that errs least on (score, ok) rows; of several in a row the middle one."""
    step = SCALE // 64
    bins = held.groupBy(F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2), F.floor(F.col("score") / step))).cast("int").alias("q")).agg(F.sum(F.col("ok").cast("int")).alias("a"), F.sum((~F.col("ok")).cast("int")).alias("b"))
    rows = {r["q"]: (r["a"], r["b"]) for r in bins.collect()}  # at most BINS + 1 rows
    na, nb = sum(a for a, _ in rows.values()), sum(b for _, b in rows.values())
    if not na or not nb:
        return 0
    cost, lost, let = [], 0, nb
    for q in range(-BINS // 2, BINS // 2 + 1):  # limit q: scores of q and more pass
        cost.append(lost * nb + let * na)
        a, b = rows.get(q, (0, 0))
        lost, let = lost + a, let - b
    first = last = cost.index(min(cost))
    while last + 1 < len(cost) and cost[last + 1] == cost[first]:
        last += 1
    return ((first + last) // 2 - BINS // 2) * step


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict, score (bits a symbol)."""
    host, path = host_and_path(F.col("url"))
    base = pages.select(F.col("page_id"), F.col("url")).select("page_id", host.alias("host"), path.alias("path"), symbols(F.col("url")).alias("sym"), (F.substring(F.md5(F.coalesce(F.col("url"), F.lit(""))), 1, 2) < HELD).alias("held"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("rule", rule).withColumn("said", said)
    known = base.where(F.col("said").isNotNull()).select("sym", "held", (F.col("said") == "allow").alias("ok"))
    ratios = cut(model(known.where("not held").select("sym", "ok"), base.select("sym")))
    limit = calibrated(scored(known.where("held").select("sym", "ok"), ratios))
    out = scored(base.select("page_id", "host", "path", "sym", "rule", "said"), ratios)
    return out.select("page_id", "host", "path", "rule", F.coalesce(F.col("said"), F.when(F.col("score") >= limit, "allow").otherwise("block")).alias("verdict"), (F.col("score") / F.lit(float(SCALE))).alias("score"))
