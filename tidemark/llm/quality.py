"""Quality rules: base counts, and compression bands of zstandard ratios.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  A document fails the base rules with under 50 words, or
if more than half its words stand in three-word windows that occur twice or more in it.

The method compresses the whole text and each fixed chunk of it (zstandard, level 3) and compares
raw / compressed size with limits that depend on the length compressed, as frames of short texts
carry more overhead and short texts repeat less.  Above the band a text is repetitive, below it
incompressible.  A document is rejected if its whole ratio leaves the band or if chunks of more than
a quarter of its bytes leave theirs; the last chunk is judged by the band of its own length.

``calibrated`` draws the bands from documents labelled as good: the mean ratio plus and minus ``SPREAD`` standard
deviations in each half octave of length, from all of them that pass the base rules (a repeated id counts once, with its shortest text).  Ratios are
summed in whole millionths, so the bands do not depend on the order of rows.  Lengths with fewer than ``LEAST`` of them keep the general bands.  A document with two labels is good if both say so; null labels and ids count for nothing.

A null text has no words.  Rows are handled one by one, so repeated rows and ids, or null ids, give
a row each.  Whole texts are counted and compressed.  Extra columns are ignored by
``quality`` and carried by ``kept_documents``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents

SYMBOLS = re.compile(r"[#*$%&|<>]")
MIN_WORDS, LEVEL, CHUNK, BAD_SHARE = 50, 3, 4096, 0.25
#: (bytes from, least ratio, most ratio); shorter texts are not judged by ratio.
BANDS = ((256, 1.05, 3.2), (1024, 1.15, 3.6), (4096, 1.2, 4.2), (16384, 1.25, 5.0), (65536, 1.25, 6.0))


#: The least labelled documents in a half octave; half the width of a band in standard deviations; the unit that ratios are summed in.
LEAST, SPREAD, UNIT = 30, 4.0, 10**6
#: Bytes from which each half octave is judged.
STARTS = sorted({math.ceil(BANDS[0][0] * 2 ** (k / 2)) for k in range(20)} | {b[0] for b in BANDS})
Bands = tuple[tuple[int, float, float], ...]


def outside(raw: int, packed: int, bands: Bands = BANDS) -> bool:
    """Whether the ratio leaves the band of its length."""
    at = bisect_right(bands, raw, key=lambda b: b[0]) - 1
    return at >= 0 and not bands[at][1] * packed <= raw <= bands[at][2] * packed


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL)


def compressed_badly(data: bytes, bands: Bands = BANDS) -> bool:
    z = _compressor().compress
    if outside(len(data), len(z(data)), bands):
        return True
    if len(data) <= CHUNK:
        return False
    chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
    return sum(len(c) for c in chunks if outside(len(c), len(z(c)), bands)) > BAD_SHARE * len(data)


def fitted(sums: Iterable[tuple[int, int, int, int]]) -> Bands:
    """Bands from (half octave, good texts, sum of their ratios, sum of the squares), ratios in whole parts of ``UNIT``."""
    seen = {at: x for at, *x in sums}
    out = []
    for i, start in enumerate(STARTS):
        _, low, high = BANDS[bisect_right(BANDS, start, key=lambda b: b[0]) - 1]
        n, total, squares = seen.get(i, (0, 0, 0))
        if n >= LEAST:
            mean = total / (n * UNIT)
            width = SPREAD * math.sqrt((n * squares - total * total) / (n * UNIT) ** 2) + 1 / UNIT  # as much as a ratio loses as a whole number
            low, high = max(1.0, mean - width), mean + width
        out.append((start, low, high))
    return tuple(out)


def calibrated(docs: DataFrame, labels: DataFrame) -> Bands:
    """Bands by the labelled documents (doc_id, quality 0 or 1) that are good and pass the base rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = _compressor().compress
        for b in batches:
            texts = [t.as_py() for t in b.column("text")]
            rows = [(i.as_py(), len(x), UNIT * len(x) // len(z(x)), bisect_right(STARTS, len(x)) - 1) for i, x in zip(b.column("doc_id"), (t.encode() if not counts(t)[5] else b"" for t in texts), strict=True) if x]
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["id", "n", "r", "at"])

    # All documents are measured where they lie and meet their labels as a few numbers each: no text is shuffled, nothing is broadcast.
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("q")).where("id is not null and q is not null")
    sizes = documents(docs).where("doc_id is not null").mapInArrow(run, "id long, n long, r long, at long").select("id", F.struct("n", "r", "at").alias("x"))
    each = sizes.unionByName(known, allowMissingColumns=True).groupBy("id").agg(F.min("x").alias("x"), F.min("q").alias("q")).where("q = 1 and x.at >= 0").select("x.*")
    r = F.col("r").cast("decimal(19,0)")
    return fitted((x["at"], x["n"], int(x["s"]), int(x["ss"])) for x in each.groupBy("at").agg(F.count("*").alias("n"), F.sum(r).alias("s"), F.sum(r * r).alias("ss")).collect())  # a row a half octave


#: str.split() also cuts at other white space; these stand in for what is not to be cut at.
_SPACES = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_WORD = re.compile("[^\x20\x09-\x0d]+")


def split_words(text: str) -> list[str]:
    return _WORD.findall(text) if _SPACES.search(text) else text.split()


def counts(text: str) -> tuple[int, int, int, int, int, bool]:
    words = split_words(text)
    n, chars = len(words), sum(map(len, words))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif _WORD.search(line):
            seen.add(line)
    repeat = 0
    if n > 2:
        grams = list(zip(words, words[1:], words[2:], strict=False))
        counts = Counter(grams)
        if len(counts) < len(grams):
            end = 0  # words before it are counted
            for i, g in enumerate(grams):
                if counts[g] > 1:
                    repeat += i + 3 - max(i, end)
                    end = i + 3
    failed = n < MIN_WORDS or 100 * repeat > 50 * n
    return n, chars, len(SYMBOLS.findall(text)), dup, repeat, failed


def rules(text: str, bands: Bands = BANDS) -> tuple[int, int, int, int, int, bool, bool]:
    base = counts(text)
    return *base, not base[5] and not compressed_badly(text.encode(), bands)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality(docs: DataFrame, bands: Bands = BANDS) -> DataFrame:
    """Per document: doc_id, the five counts, base_failed, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*[rules(x.as_py(), bands) for x in b.column("text")], strict=True)) or [[]] * 7
            yield pa.record_batch([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:5]], *[pa.array(c, pa.bool_()) for c in cols[5:]]], names=["doc_id", *FIELDS, "base_failed", "kept"])

    return documents(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{x} long" for x in FIELDS) + ", base_failed boolean, kept boolean")


def kept_documents(docs: DataFrame, bands: Bands = BANDS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged and with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([rules(x.as_py() or "", bands)[6] for x in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
