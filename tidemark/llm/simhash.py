"""SimHash near-dedup: pivot distance tables over 64-bit fingerprints.

A fingerprint's bit is 1 where more than half of the XXH64 values (seed 42) of the text's word
shingles have it.  Distinct fingerprints, not documents, take part in the search.  Each carries a
table of its Hamming distances to ``PIVOTS`` reference fingerprints, one byte each.  By the
triangle inequality two fingerprints within ``radius`` differ by at most ``radius`` in every
coordinate, so pairs beyond that are discarded before the distance itself is verified.

Pairs come from blocks: five blocks of bits, of which at least three agree where at most two
bits differ, so every link shares one of ten keys.  Buckets of up to ``BUCKET`` fingerprints are
joined with themselves.  For larger ones there is an exact way that makes no pairs: fingerprints
within two bits share a neighbour within one bit of both, so each member names its 64 neighbours and
itself, and all who name the same one are links of its smallest.  Components are
found by star contraction.

``near_groups`` is the stage for documents that are alike by their shingles (Jaccard similarity of
0.8 or more over five words).  Their fingerprints differ by some ten bits, where no block of bits
is selective, so pairs there come from shared least shingle hashes, are discarded by
the same tables, and are verified on the whole shingle sets of the documents that are left in a pair.
Crowded buckets of least hashes are searched breadth first on the whole sets instead: each set
that is reached meets all those not reached yet, so a large group costs few passes over it.

Null texts count as empty; texts without words have fingerprint zero and are linked like any
other; with fewer words than a shingle has, the whole sequence is the one shingle.  Repeated rows
and ids give a row each; a null id keeps its row and does not name a component unless no member
has an id (null then).  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, documents, spread_join
from tidemark.llm.graph import components

SEED, PIVOTS, BUCKET, STEP = 42, 16, 64, 100_000
WIDTHS = (13, 13, 13, 13, 12)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots() -> list[int]:
    """Reference fingerprints: fixed, and far from each other."""
    import xxhash

    return [xxhash.xxh64_intdigest(b"pivot %d" % i, seed=SEED) for i in range(PIVOTS)]


def masks() -> list[int]:
    starts = [sum(WIDTHS[:i]) for i in range(len(WIDTHS))]
    return [sum(((1 << WIDTHS[b]) - 1) << starts[b] for b in some) for some in combinations(range(len(WIDTHS)), 3)]


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    import xxhash

    words = text.encode().lower().split()  # of bytes: A-Z alone are lowered, and \\x09-\\x0d and spaces alone part words
    if not words:
        return np.empty(0, "<u8")
    shingles = [b" ".join(words)] if len(words) < size else map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), "<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint as a signed number."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), STEP):
        ones += np.unpackbits(hashes[at : at + STEP].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array([fingerprint(shingle_hashes(t.as_py(), size)) for t in b.column("text")], pa.int64())], names=["doc_id", "fp"])

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


def pivot_table(fp: Column) -> list[Column]:
    """The distances to the pivots, eight to a long."""
    near = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long") for p in pivots()]
    packed = []
    for at in range(0, PIVOTS, 8):
        word = near[at]
        for i, d in enumerate(near[at + 1 : at + 8], 1):
            word = word.bitwiseOR(F.shiftleft(d, 8 * i))
        packed.append(word.alias(f"t{at // 8}"))
    return packed


def may_link(a: str, b: str, radius: int) -> Column:
    """No coordinate of the two tables differs by more than ``radius``, and then the distance itself does not."""
    ok = F.lit(True)
    for w in range(PIVOTS // 8):
        for i in range(8):
            get = lambda s: F.shiftright(F.col(f"{s}.t{w}"), 8 * i).bitwiseAND(F.lit(255))  # noqa: B023, E731
            ok = ok & (F.abs(get(a) - get(b)) <= radius)
    return ok & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= radius)


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links that join all distinct fingerprints (fp) within two bits, directly or by way of each other."""
    table = distinct.select("fp", *pivot_table(F.col("fp")))
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("m")) for i, m in enumerate(masks())])
    keyed = table.select("fp", "t0", "t1", F.explode(keys).alias("k")).select("fp", "t0", "t1", "k.c", "k.m")
    sizes = keyed.groupBy("c", "m").agg(F.count("*").alias("n")).where("n > 1").withColumn("rows", F.col("n"))
    shared = cut(spread_join(keyed, sizes, ["c", "m"], "rows", 10 * distinct.count()))
    small = shared.where(F.col("n") <= bucket).drop("n")
    pairs = small.alias("a").join(small.alias("b"), (F.col("a.c") == F.col("b.c")) & (F.col("a.m") == F.col("b.m")) & (F.col("a.fp") < F.col("b.fp")) & may_link("a", "b", 2))
    near = F.concat(F.array("fp"), *[F.array(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i)))) for i in range(64)])
    named = shared.where(F.col("n") > bucket).select("fp").distinct().select("fp", F.explode(near).alias("z"))
    least = named.groupBy("z").agg(F.min("fp").alias("v"))
    stars = named.join(least, "z").where("fp <> v")
    return pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).unionByName(stars.select(F.col("fp").alias("u"), "v")).distinct()


def simhash_components(docs: DataFrame, size: int = 3, bucket: int = BUCKET) -> DataFrame:
    """A row per document: doc_id, fingerprint, component_id."""
    fps = cut(fingerprints(docs, size))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    roots = components(links(distinct.select("fp"), bucket))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("fps"))
    per_fp = spread_join(rooted, named, ["root"], "fps", fps.count()).select("fp", "component_id", "rows")
    return spread_join(fps, per_fp, ["fp"], "rows", fps.count()).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Sets that are alike share at least 8/9 of their shingles on (geometric) average, so a bit of the fingerprints differs with a chance of acos(8/9)/pi = 0.151 or less
#: and over REACH of the 64 bits do with one below 1e-7: that is the share of links the tables may lose.  16 bands of three lose 1e-5.
BANDS, ROWS, REACH = 16, 3, 28
#: Sets of fewer shingles skip the tables: the chance above is that of many shingles.
FEW = 40
#: Buckets of up to ``CROWD`` sets are joined with themselves; larger ones are searched in blocks of about ``BLOCK``, two at a time.
CROWD, BLOCK = 16, 1024


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, digest, fp, n, bands) of each row's shingle set: a digest of 128 bits, the fingerprint, the size, and band keys of the least hashes.

    Repeats count once here, as in the similarity: a phrase said often must not move the fingerprint.
    """
    rng = np.random.default_rng(SEED)
    mul = rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(s: np.ndarray) -> list[int]:
        with np.errstate(over="ignore"):
            least = np.array([((x := s * m) ^ (x >> np.uint64(31))).min() for m in mul]).reshape(BANDS, ROWS)
            key = least[:, 0]
            for r in range(1, ROWS):
                key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + least[:, r]
        return key.view("<i8").tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        for b in batches:
            rows = []
            for t in b.column("text"):
                s = np.unique(shingle_hashes(t.as_py(), size))
                rows.append((xxhash.xxh3_128_digest(s.tobytes()), fingerprint(s), len(s), bands(s) if len(s) else []))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch([b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "digest", "fp", "n", "bands"])

    return documents(docs).mapInArrow(run, "doc_id long, digest binary, fp long, n long, bands array<long>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, set) of every row: the distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), pa.array([np.unique(shingle_hashes(t.as_py(), size)).view("<i8") for t in b.column("text")], pa.list_(pa.int64()))], names=["doc_id", "set"])

    return documents(docs).mapInArrow(run, "doc_id long, set array<long>")


def spanning_links(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """(x, y): links that join all sets (sorted, not empty) that are alike, directly or by way of each other.

    A breadth-first search: each set that is reached meets all that no set has reached yet, so only pairs
    that are in one component by other links go untested.
    """
    n = np.array([len(s) for s in sets])
    fp = np.array([fingerprint(s) for s in sets], "<i8").view("<u8")
    left, out = np.arange(len(sets)), []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            least, most = np.minimum(n[x], n[left]), np.maximum(n[x], n[left])
            may = (most * similarity <= least) & ((np.bitwise_count(fp[x] ^ fp[left]) <= REACH) | (least < FEW))
            met = left[may]
            if not len(met):
                continue
            flat = np.concatenate([sets[y] for y in met])
            at = np.minimum(np.searchsorted(sets[x], flat), n[x] - 1)
            shared = np.add.reduceat((sets[x][at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(n[met])[:-1]]))
            near = met[shared >= similarity * (n[x] + n[met] - shared)]
            out += [(int(x), int(y)) for y in near]
            reached += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    return out


def superseded(docs: DataFrame, size: int = 5, similarity: float = 0.8, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(doc_id): documents alike, directly or in a chain, to one of a smaller doc_id."""
    named = docs.where(F.col("doc_id").isNotNull())
    each = cut(sketches(named, size))
    # Copies meet here: from now on there is a row per distinct set, named by its smallest document.
    reps = each.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("rows"))
    keyed = reps.select(F.struct("doc", "fp", "n", *pivot_table(F.col("fp"))).alias("a"), F.posexplode("bands").alias("c", "m"))
    sizes = keyed.groupBy("c", "m").agg(F.count("*").alias("members")).where("members > 1").withColumn("rows", F.col("members"))
    shared = cut(spread_join(keyed, sizes, ["c", "m"], "rows", BANDS * each.count()))
    small = shared.where(F.col("members") <= crowd).select("c", "m", "a")
    met = small.join(small.select("c", "m", F.col("a").alias("b")), ["c", "m"]).where("a.doc > b.doc")
    close = may_link("a", "b", REACH) | (F.least("a.n", "b.n") < FEW)
    pairs = cut(met.where((F.greatest("a.n", "b.n") * F.lit(similarity) <= F.least("a.n", "b.n")) & close).select(F.col("a.doc").alias("u"), F.col("b.doc").alias("v")).distinct())
    # A crowded bucket's blocks meet two at a time (one alone meets itself), so every two members are in some unit together.
    blocks = F.ceil(F.col("members") / F.lit(block))
    mine = F.pmod(F.xxhash64("a.doc"), blocks)
    units = F.expr("transform(filter(sequence(0L, blocks - 1), i -> blocks = 1 or i <> mine), i -> struct(least(i, mine) as i, greatest(i, mine) as j))")
    crowded = cut(shared.where(F.col("members") > crowd).select("c", "m", F.col("a.doc").alias("doc_id"), blocks.alias("blocks"), mine.alias("mine")).select("c", "m", "doc_id", F.explode(units).alias("unit")).select("c", "m", "unit.i", "unit.j", "doc_id"))
    wanted = pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).unionByName(crowded.select("doc_id")).distinct()
    sets = cut(shingle_sets(named.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), size).where(F.size("set") > 0))
    both = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("set").alias("su")), "u").join(sets.select(F.col("doc_id").alias("v"), F.col("set").alias("sv")), "v")
    common = F.size(F.array_intersect("su", "sv"))
    alike = both.where(common >= F.lit(similarity) * (F.size("su") + F.size("sv") - common)).select("u", "v")

    def search(unit: pa.Table) -> pa.Table:
        found = spanning_links([np.asarray(s.values).view("<u8") for s in unit["set"]], similarity)
        doc = unit["doc_id"].to_numpy()
        return pa.table({"u": pa.array([doc[x] for x, _ in found], pa.int64()), "v": pa.array([doc[y] for _, y in found], pa.int64())})

    alike = alike.unionByName(crowded.join(sets, "doc_id").groupBy("c", "m", "i", "j").applyInArrow(search, "u long, v long"))
    roots = components(alike)
    firsts = reps.select("digest", "doc", "rows").join(roots, F.col("doc") == F.col("node"), "left").select("digest", "rows", F.coalesce("root", "doc").alias("root"))
    return spread_join(each.select("doc_id", "digest"), firsts, ["digest"], "rows", each.count()).groupBy("doc_id").agg(F.min("root").alias("root")).where("doc_id <> root").select("doc_id")


def deduplicate(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one of the smallest doc_id.

    Kept rows are unchanged.  Rows that share an id are one document, and stay or go together; rows
    without an id are kept, as nothing names them.  All documents without words are one group.
    """
    columns = docs.columns
    gone = superseded(docs, size, similarity).withColumnRenamed("doc_id", "__tm_gone")
    return docs.join(gone, docs["doc_id"] == F.col("__tm_gone"), "left_anti").select(*[F.col(f"`{c}`") for c in columns])
