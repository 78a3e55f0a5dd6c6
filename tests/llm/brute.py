"""Brute-force twins of the corpus operators, and rows that hold every edge."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = str.maketrans(UP, LOW)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(seed: int = 5, n: int = 300) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghié") for _ in range(r.randrange(2, 8))) for _ in range(n)]


def edge_rows(seed: int = 3) -> list[tuple]:
    """Nulls, empties, a very long text, ties, repeated rows, copies, near copies and shared passages."""
    r, w = random.Random(seed), vocabulary()
    prose = lambda n: " ".join(r.choice(w) + r.choice(["", "", "", ".", "\n"]) for _ in range(n))
    a, b, passage = prose(120), prose(90), prose(60)
    texts = [a, a, a + " extra", b, b.replace(" ", "  ", 1), passage, prose(30) + passage + prose(40), prose(10) + passage, "", None, " \n\t ", "x", "one two", "For " * 500, "y" * 250, prose(30_000), "Ümläut ÀÉ 数字 " * 40, a.upper()]
    rows = [(i, t, "en", f"src{i % 3}", 1) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, a, None, None, None), (None, None, None, None, None), (3, prose(70), "fr", None, 2)]


def edge_frame(spark, rows=None):
    """With columns whose names operators use within themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows if rows is not None else edge_rows(), SCHEMA).repartition(3)
    for c in ("h", "n", "key", "rid", "route", "kept", "spans", "th", "fp", "words", "site", "__tm_x"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def sha(b: str | bytes) -> str:
    return hashlib.sha256(b.encode() if isinstance(b, str) else b).hexdigest()


def as_counter(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def quality(text: str | None) -> tuple:
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed


def kept(text: str | None, bands: tuple) -> bool:
    """The whole verdict of the quality rules, said once more: the base rules, then the ratio of the text and of its chunks of 4096 bytes."""
    import zstandard

    def bad(data: bytes) -> bool:
        fits = [(low, high) for least, low, high in bands if least <= len(data)]
        ratio = len(data) / len(zstandard.compress(data, 3)) if data else 1
        return bool(fits) and not fits[-1][0] - 1e-12 <= ratio <= fits[-1][1] + 1e-12

    data = (text or "").encode()
    chunks = [data[i : i + 4096] for i in range(0, len(data), 4096)]
    worst = sum(len(c) for c in chunks if bad(c)) if len(data) > 4096 else 0
    return not quality(text)[5] and not bad(data) and 4 * worst <= len(data)


def repeats(texts: list[str | None], span: int = 200) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(b[i : i + span]) for b in data for i in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[hash(b[i : i + span])] > 1:
                gone[i : i + span] = b"\1" * span
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


WORD10 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(items: list[tuple], n: int = 10) -> dict[tuple, set[str]]:
    out: dict[tuple, set[str]] = {}
    for i, t in items:
        w = WORD10.findall((t or "").translate(LOWER))
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            out.setdefault(tuple(w[k : k + size]), set()).add(str(i) if i is not None else "")
    return out


def contamination(text: str | None, g: dict) -> tuple:
    w = WORD10.findall((text or "").translate(LOWER))
    hit, items = set(), set()
    for size in {len(x) for x in g}:
        for k in range(len(w) - size + 1):
            if (x := tuple(w[k : k + size])) in g:
                items |= g[x] - {""}
                hit |= set(range(k, k + size))
    return len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)


def components(links: list[tuple[int, int]], n: int) -> list[int]:
    p = list(range(n))

    def find(x: int) -> int:
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
