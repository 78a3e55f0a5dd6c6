"""Benchmark decontamination: hash sets of test n-grams, verified hits, removed spans or documents.

The windows of the benchmark (``n`` consecutive words of an item; all its words where it has
fewer) are counted first.  Up to ``max_set`` of them travel inside the plan as a hash set, and
each document is scanned in one pass without any shuffle of text: window hashes probe the set,
and hits are verified word for word.  Of a larger benchmark the hashes of the windows (up to ``MAX_HASHES``) are broadcast as a table that the
windows probe, beyond that they are joined with the strategy that Spark picks; hits alone are shuffled, and are verified in the same way.

Nulls: a null text has no words; a null ``item_id`` contaminates but is not among the items.
Empty texts and items have no windows.  Rows are handled one by one, so repeated rows and repeated
or null ``doc_id`` each give a row of their own.  Repeated ``item_id`` count as one item.  An
empty benchmark leaves all documents clean.  Extra columns are carried or ignored, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

#: Runs of what is not part of a word, in lower-cased and in unchanged text.
GAP, GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Most windows that go into the plan as a set: about 10 MB of text.
MAX_SET = 50_000
#: Most hashes that are broadcast as a table, about 100 MB; beyond that Spark joins by its own choice.
MAX_HASHES = 2_000_000
SEEN, WORDS, TEXT = "__tm_seen", "__tm_words", "__tm_text"
HIT_TYPE = "array<struct<p:int,l:int,g:string>>"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), lambda w: w != "")


def windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(item_id, l, g): the distinct windows of each item, ``l`` words joined by spaces."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("l", F.least(F.lit(n), F.size("w")))
    g = F.expr("explode(array_distinct(transform(sequence(1, size(w) - l + 1), i -> array_join(slice(w, i, l), ' '))))")
    return w.select("item_id", "l", g.alias("g")).distinct()


def _in_plan(sets: dict[int, list[tuple[str, int]]]) -> str:
    """Verified hits among the words ``w``, for windows given by length; hashes first, then the words."""
    parts = [f"cast(array() as {HIT_TYPE})"]
    for l, grams in sorted(sets.items()):
        hashes, texts = ", ".join(f"{h}L" for h in sorted({h for _, h in grams})), ", ".join(f"'{g}'" for g, _ in grams)
        found = f"filter(sequence(1, size(w) - {l - 1}), i -> xxhash64(slice(w, i, {l})) IN ({hashes}))"
        shown = f"transform({found}, i -> named_struct('p', i, 'l', {l}, 'g', array_join(slice(w, i, {l}), ' ')))"
        parts.append(f"if(size(w) >= {l}, filter({shown}, x -> x.g IN ({texts})), cast(array() as {HIT_TYPE}))")
    return f"array_sort(concat({', '.join(parts)}))"


def with_hits(docs: DataFrame, grams: DataFrame, max_set: int = MAX_SET) -> DataFrame:
    """``docs`` with a column SEEN: the number of words and the verified hits (first word, words, window) of each row."""
    distinct = grams.select("l", "g", F.expr("xxhash64(split(g, ' '))").alias("h")).distinct()
    few = distinct.limit(max_set + 1).collect()
    seen = f"transform({{ws}}, w -> named_struct('n', size(w), 'h', {{hits}}))[0]"
    if len(few) <= max_set:
        sets: dict[int, list[tuple[str, int]]] = {}
        for r in few:
            sets.setdefault(r["l"], []).append((r["g"], r["h"]))
        return docs.withColumn(WORDS, F.array(words(F.col("text")))).withColumn(SEEN, F.expr(seen.format(ws=WORDS, hits=_in_plan(sets)))).drop(WORDS)
    # The hash set alone is broadcast, where its size allows, and probed by the windows in place; only hits are shuffled.
    hashes = stored(distinct.select("l", "h").distinct())
    if hashes.count() <= MAX_HASHES:
        hashes = F.broadcast(hashes)
    lengths = [r["l"] for r in distinct.select("l").distinct().collect()]  # at most n values
    key = [F.xxhash64(F.col("text"), F.lit(7)).alias("__tm_k1"), F.xxhash64(F.lit("~"), F.col("text")).alias("__tm_k2")]
    every = "transform(__tm_words, w -> concat(" + ", ".join(f"if(size(w) >= {l}, transform(sequence(1, size(w) - {l - 1}), i -> named_struct('p', i, 'l', {l}, 'h', xxhash64(slice(w, i, {l})))), array())" for l in lengths) + "))[0]"
    at = docs.select(*key, F.array(words(F.col("text"))).alias(WORDS)).select("__tm_k1", "__tm_k2", F.explode(F.expr(every)).alias("x")).select("__tm_k1", "__tm_k2", "x.*")
    # Equal texts have equal hits, which the set makes one.
    found = at.join(hashes, ["l", "h"]).distinct().join(distinct, ["l", "h"]).groupBy("__tm_k1", "__tm_k2").agg(F.array_sort(F.collect_set(F.struct(F.col("p"), F.col("l"), F.col("g")))).alias("__tm_c"))
    joined = docs.select("*", *key).join(found, ["__tm_k1", "__tm_k2"], "left").drop("__tm_k1", "__tm_k2").withColumn(WORDS, F.array(words(F.col("text"))))
    checked = f"cast(coalesce(filter(__tm_c, x -> array_join(slice(w, x.p, x.l), ' ') = x.g), array()) as {HIT_TYPE})"
    return joined.withColumn(SEEN, F.expr(seen.format(ws=WORDS, hits=checked))).drop(WORDS, "__tm_c")


#: Hits ``h`` merged to disjoint runs [s, e) of words, in order.
RUNS = """aggregate(h, cast(array() as array<struct<s:int,e:int>>), (a, x) ->
    if(size(a) > 0 and element_at(a, -1).e >= x.p,
       concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.p + x.l)))),
       concat(a, array(named_struct('s', x.p, 'e', x.p + x.l)))))"""
N_HIT = "aggregate({h}, named_struct('e', 0, 'c', 0), (a, x) -> named_struct('e', greatest(a.e, x.p + x.l), 'c', a.c + greatest(0, x.p + x.l - greatest(a.e, x.p))), a -> a.c)"


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_set: int = MAX_SET) -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    grams = windows(benchmark.select("item_id", "text"), n)
    hits = with_hits(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), grams, max_set=max_set)
    n_hit, gs = F.expr(N_HIT.format(h=f"{SEEN}.h")).cast("long"), F.expr(f"array_distinct(transform({SEEN}.h, x -> x.g))")
    rows = hits.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col(f"{SEEN}.n").cast("long").alias("n_words"), n_hit.alias("n_hit"), gs.alias("gs"))
    # Rows with hits alone meet the items; the windows' table takes part by the size that it is found to have.
    flat = rows.select("rid", "doc_id", "n_words", "n_hit", F.explode_outer("gs").alias("g"))
    named = flat.join(grams.select("g", "item_id"), "g", "left")
    out = named.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("n_hit").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, drop_share: float = 0.5, max_set: int = MAX_SET) -> DataFrame:
    """``docs`` without the words inside benchmark windows.

    A document of which more than ``drop_share`` of the words are hit goes altogether; of any other
    the hit runs are cut out, with what stands between their words.  Clean rows stay as they are.
    """
    columns = docs.columns
    hits = with_hits(docs, windows(benchmark.select("item_id", "text"), n), max_set=max_set)
    # In t[0] g[0] t[1] g[1] ..., word i is t[i - 1 + lead].
    parts = f"named_struct('t', split(text, r'{GAP_ANY_CASE}', -1), 'g', regexp_extract_all(text, r'{GAP_ANY_CASE}', 0))"
    gone = "exists(r, y -> {a} >= y.s and {b} < y.e)"
    body = f"""array_join(transform(sequence(0, size(x.t) - 1), i -> concat(
        if({gone.format(a="i + 1 - if(x.t[0] = '', 1, 0)", b="i + 1 - if(x.t[0] = '', 1, 0)")}, '', x.t[i]),
        if(i < size(x.g) and not {gone.format(a="i + 1 - if(x.t[0] = '', 1, 0)", b="i + 2 - if(x.t[0] = '', 1, 0)")}, x.g[i], ''))), '')"""
    left = f"transform(array({RUNS.replace('aggregate(h,', f'aggregate({SEEN}.h,')}), r -> transform(array({parts}), x -> {body})[0])[0]"
    # A row for each text that stays; the generator keeps the scan from being repeated by a pushed filter.
    kept = F.expr(f"if(size({SEEN}.h) = 0, array(text), if({N_HIT.format(h=f'{SEEN}.h')} > {drop_share} * {SEEN}.n, cast(array() as array<string>), array({left})))")
    return hits.select(*[F.col(f"`{c}`") for c in columns if c != "text"], F.explode(kept).alias(TEXT)).select(*[F.col(TEXT).alias(c) if c == "text" else F.col(f"`{c}`") for c in columns])
