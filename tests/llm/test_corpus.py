"""Counts, rules, line dedup, long repeats, packing, near-duplicates, against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import brute
from brute import as_counter, components, edge_frame, edge_rows, quality as brute_quality, repeats as brute_repeats, sha, vocabulary

from tidemark.llm import graph, linededup, packing, quality, repeats, simhash, tokencount

P = pytest.importorskip("public_tokenizers")


def test_token_counts(spark):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(1)
    odd = ["".join(r.choice(" ▁ab\n\tthe é<s>　\xa0x0\x00ñ") for _ in range(r.randrange(30))) for _ in range(300)]
    rows = [*edge_rows(), *[(i, t, None, None, None) for i, t in enumerate([*odd, " ", "     ", "▁", "a" + " " * 40, "<s></s>"])]]
    got = tokencount.token_counts(edge_frame(spark, rows), path).collect()
    want = Counter((x[0], len((x[1] or "").encode()), n := len(sp.encode(x[1] or "")), n > 4096) for x in rows)
    assert as_counter(got) == want
    assert tokencount.token_counts(edge_frame(spark, []), path).count() == 0


def test_quality_counts(spark):
    rows = edge_rows()
    got = quality.quality(edge_frame(spark)).collect()
    assert as_counter(r[:7] for r in got) == Counter((r[0], *brute_quality(r[1])) for r in rows)
    assert all(not r.kept for r in got if r.base_failed)
    assert as_counter((r.doc_id, r.kept) for r in got) == Counter((r[0], brute.kept(r[1], quality.BANDS)) for r in rows)
    kept = quality.kept_documents(edge_frame(spark)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((r[0], r[1]) for r in rows if brute.kept(r[1], quality.BANDS))


def test_calibrated_bands_decide(spark):
    """Bands drawn from good documents: junk that passes the base rules goes, held-out good documents stay."""
    r, words = random.Random(31), vocabulary(n=4000)
    good = lambda: " ".join(r.choice(words) for _ in range(r.randrange(300, 600)))
    junk = lambda: " ".join(r.choice(words) + "###" for _ in range(r.randrange(180, 310)))
    rows = [(i, good() if i % 4 else junk(), "en", "s", 1) for i in range(800)]
    labels = [(i, int(i % 4 > 0)) for i in range(400)] + [(1, 1), (2, 0), (None, 1), (5, None), (9999, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "'clash' as text", "'clash' as id")
    bands = quality.calibrated(edge_frame(spark, rows), known)
    got = {x.doc_id: x.kept for x in quality.quality(edge_frame(spark, rows), bands).collect()}
    assert got == {i: brute.kept(t, bands) for i, t, *_ in rows}
    held = range(400, 800)
    assert all(got[i] for i in held if i % 4) and sum(got[i] for i in held if i % 4 == 0) <= 5 and all(brute.kept(x[1], quality.BANDS) for x in rows)
    assert quality.calibrated(edge_frame(spark, []), known) == quality.fitted([]) and quality.calibrated(edge_frame(spark, rows), known.limit(0)) == quality.fitted([])


def test_bands_come_from_all_labelled_documents(spark):
    """More good documents than a sample of 20,000 would take: the bands are those of all of them, by brute force."""
    import zstandard

    r, words, z = random.Random(33), vocabulary(n=3000), zstandard.ZstdCompressor(level=3).compress
    texts = [" ".join(r.choices(words, k=r.randrange(55, 90))) for _ in range(21_000)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3] + " more", "en", "s", 1), (None, texts[0], "en", "s", 1), (21_000, "few words", "en", "s", 1)]
    labels = [(i, int(i % 50 > 0)) for i in range(21_001)] + [(1, 0), (2, 1), (None, 1), (50, 1), (5, None)]
    bands = quality.calibrated(edge_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    starts, ratios = [b[0] for b in bands], defaultdict(list)
    for i, t in enumerate(texts):
        n = len(t.encode())
        if i % 50 and i != 1 and n >= starts[0] and not brute_quality(t)[5]:
            ratios[max(s for s in starts if s <= n)].append(n / len(z(t.encode())))
    assert sum(map(len, ratios.values())) > 20_000
    general = {b[0]: b[1:] for b in quality.fitted([])}
    for start, *band in bands:
        x = np.array(ratios[start])
        want = (max(1.0, x.mean() - 4 * x.std()), x.mean() + 4 * x.std()) if len(x) >= 30 else general[start]
        assert band == pytest.approx(want, abs=5e-6)


def test_bands_of_copies_keep_them(spark):
    """All good documents of a length are the same text: the band has no width, and they stay."""
    r = random.Random(35)
    rows = [(i, t, "en", "s", 1) for k in range(12) for t in [" ".join(r.choices(vocabulary(), k=60 + 9 * k))] for i in range(40 * k, 40 * k + 40)]
    bands = quality.calibrated(edge_frame(spark, rows), spark.createDataFrame([(x[0], 1) for x in rows], "doc_id long, quality int"))
    assert bands != quality.fitted([]) and quality.kept_documents(edge_frame(spark, rows), bands).count() == len(rows)


def test_compression_bands():
    r = random.Random(2)
    prose = " ".join(r.choice(vocabulary()) for _ in range(3000))
    noise = "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(3000))
    assert not quality.compressed_badly(prose.encode())
    assert quality.compressed_badly(("lorem ipsum dolor sit amet " * 200).encode()) and quality.compressed_badly(random.Random(3).randbytes(8192))
    mixed = prose[:4096] + ("same line again\n" * 1024)
    assert quality.compressed_badly(mixed.encode()) and noise


def test_compression_of_the_last_chunk():
    r = random.Random(6)
    prose = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(1200)).encode()
    line = b"the very same line comes again and again\n"
    assert quality.compressed_badly(prose[:4300] + (line * 100)[:3850])
    assert not quality.outside(8150, len(quality._compressor().compress(prose[:4300] + (line * 100)[:3850])))
    assert not quality.compressed_badly(prose[:5000]) and not quality.compressed_badly(prose[:4096] + line * 3)


@pytest.mark.parametrize("group", [256, 2], ids=["index", "windows"])
def test_repeats(spark, group):
    rows = edge_rows()
    rows = [x for x in rows if len(x[1] or "") < 50_000] + [(900, "ab" * 100, None, None, None), (901, "y" * 199, None, None, None)]
    got = repeats.repeats(edge_frame(spark, rows), group).collect()
    assert as_counter(got) == Counter((x[0], *b) for x, b in zip(rows, brute_repeats([x[1] for x in rows]), strict=True))
    assert repeats.repeats(edge_frame(spark, []), group).count() == 0


def test_repeats_across_the_border_of_pieces(spark):
    """A text of several pieces; passages that lie on a border of pieces come again in another text and in the same."""
    r, words = random.Random(17), vocabulary(n=5000)
    long = " ".join(r.choice(words) for _ in range(250_000)).encode().decode()
    data = long.encode()
    assert len(data) > 2 * repeats.PIECE
    border = repeats.PIECE
    cut = lambda a, b: data[a:b].decode(errors="ignore")
    texts = [long + cut(2 * border - 350, 2 * border + 10), "x " + cut(border - 150, border + 220), cut(border + 199, border + 450), cut(5000, 5199)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    got = repeats.repeats(edge_frame(spark, rows)).collect()
    assert as_counter(got) == Counter((x[0], *b) for x, b in zip(rows, brute_repeats([x[1] for x in rows]), strict=True))
    assert {x.doc_id for x in got if x.n_removed} == {0, 1, 2}


@pytest.mark.parametrize("small", [False, True], ids=["usual", "other way"])
def test_both_ways_agree_on_the_tables(spark, small):
    """Long repeats and fingerprints over the given documents: small and large groups have a way each, and both equal brute force."""
    from oracle import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    rows = docs.select("doc_id", "text").collect()
    got = simhash.simhash_components(docs, bucket=2 if small else simhash.BUCKET).collect()
    fps = [simhash.fingerprint(simhash.shingle_hashes(x.text or "", 3)) for x in rows]
    bits = np.array(fps, "<i8").view("<u8")
    near = [(i, int(j)) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(bits[:i] ^ bits[i]) <= 2)]
    roots = components(near, len(rows))
    least = {k: min(x.doc_id for x, q in zip(rows, roots, strict=True) if q == k) for k in set(roots)}
    assert as_counter(got) == Counter((x.doc_id, f"{f & (2**64 - 1):016x}", least[k]) for x, f, k in zip(rows, fps, roots, strict=True))
    got = repeats.repeats(docs, 2 if small else repeats.GROUP).collect()
    assert as_counter(got) == Counter((x.doc_id, *b) for x, b in zip(rows, brute_repeats([x.text for x in rows]), strict=True))


def test_run_length_index():
    r = random.Random(7)
    for _ in range(20):
        letters = r.choice([b"ab", b"abcd\0"])
        texts = [bytes(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(r.randrange(1, 10))]
        texts += [texts[0], texts[-1][3:]]
        index = repeats.RunLengthIndex(texts)
        for k in (1, 5, 12):
            seen = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
            long = index.matching(k) >= k
            for t, at in zip(texts, index.starts, strict=True):
                assert [bool(x) for x in long[at : at + max(0, len(t) - k + 1)]] == [seen[t[i : i + k]] > 1 for i in range(len(t) - k + 1)]


def test_packing(spark):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    texts = ["", "a b  c\n\nd", None, "x" * 3000, "the <|endoftext|>foo it's ÉÀ \u0301 \u3000\x85 don't 12 é. IT'S, <|EndOfText|>. " * 300, "Σας ΟΔΟΣ\tq", *[" ".join(random.Random(i).choices(vocabulary(), k=i * 7)) for i in range(60)]]
    rows = [(i if i != 2 else None, t, None, None, None) for i, t in enumerate(texts)]
    got = packing.pack(edge_frame(spark, rows), path).collect()
    ids = {x[0]: np.array([*lib.encode(x[1] or "", add_special_tokens=False).ids, 1], "<u4") for x in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in got:
        assert p.length > 0 and p.doc_tokens == len(ids[p.doc_id]) and zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32
        pieces[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for d, v in pieces.items():
        assert sum(n for _, n in v) == len(ids[d]) and all(a + n == b for (a, n), (b, _) in zip(sorted(v), sorted(v)[1:], strict=False))
    total = pad = 0
    for v in sequences.values():
        v.sort()
        size = sum(n for _, n in v)
        assert v[0][0] == 0 and size <= 2048 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:], strict=False))
        total, pad = total + size, pad + (0 if size & (size - 1) == 0 else 2048 - size)
    assert len(pieces) == len(rows) and pad <= 0.02 * total
    assert packing.pack(edge_frame(spark, []), path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    from array import array

    from tokenizers import Tokenizer

    path = P.path(name)
    enc, lib = packing.encoder(path, 1, packing.unmade_tokens(path)), Tokenizer.from_file(path)
    r = random.Random(5)
    odd = "İı ſŉß.ÀÉéèµªº²½'sStTdDlLmMvVrReE\t|<>.,;:!?-_#0123456789あ中Σςσ̸́ \x85​ÅÅĲĳŊŽžÖÿŸ"
    texts = ["", "İ.", "aİ,", "x İ; y", "<|endoftext|>.", "a<|startoftext|>b <|ENDOFTEXT|>", "it'll'd IT'S", "x" * 5000]
    texts += ["".join(r.choice(odd) if r.random() < 0.6 else r.choice("abcdefghijklmnopqrstuvwxyz  'é") for _ in range(r.randrange(1, 14))) for _ in range(30_000)]
    texts += [x for c in map(chr, range(0x250)) for x in (c, "a" + c, c + "b", "7" + c + ".", c + "'s")]
    assert [t for t in texts if array("I", [*lib.encode(t, add_special_tokens=False).ids, 1]).tobytes() != enc.encode(t)] == []


def test_tables_of_a_worker_stay_small():
    """A million chunks, none twice: what the tables of a worker take, in a process of its own."""
    import subprocess
    import sys

    code = """
import resource, sys
from tidemark.llm import packing
enc = packing.encoder(sys.argv[1], 1, packing.unmade_tokens(sys.argv[1]))
enc.encode("some text")
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
before = peak()
for i in range(0, 1_000_000, 100):
    enc.encode(" ".join("w" + f"{k:06d}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(i, i + 100)))
print((peak() - before) / 1024)
"""
    out = subprocess.run([sys.executable, "-c", code, P.path("word_bpe_49k.json")], capture_output=True, text=True, check=True, timeout=300)
    assert float(out.stdout) < 100


def test_simhash_components(spark):
    r, rows = random.Random(4), edge_rows()
    words = vocabulary()
    base = [r.choice(words) for _ in range(400)]
    rows += [(1000 + i, " ".join(base[: 396 + i % 5]), None, None, None) for i in range(40)]
    fps = [simhash.fingerprint(simhash.shingle_hashes(x[1] or "", 3)) for x in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 2]
    roots = components(near, len(fps))
    least = {k: min((rows[i][0] for i in range(len(rows)) if roots[i] == k and rows[i][0] is not None), default=None) for k in set(roots)}
    want = Counter((x[0], f"{f & (2**64 - 1):016x}", least[k]) for x, f, k in zip(rows, fps, roots, strict=True))
    for bucket in (64, 2):
        assert as_counter(simhash.simhash_components(edge_frame(spark, rows), bucket=bucket).collect()) == want
    assert simhash.simhash_components(edge_frame(spark, [])).count() == 0


def test_near_duplicates_leave_one(spark):
    r, words = random.Random(9), vocabulary(n=2000)
    base = [[r.choice(words) for _ in range(200)] for _ in range(6)]
    rows = []
    for g, b in enumerate(base):
        for k in range(5):
            copy = list(b)
            for _ in range(k):
                copy[r.randrange(200)] = "changed"
            rows.append((g * 10 + k, " ".join(copy), "en", "s", 1))
    rows += [(500, None, None, None, None), (501, "", None, None, None), (None, " ".join(base[0]), None, None, None), rows[0]]
    sets = [frozenset(simhash.shingle_hashes(x[1] or "", 5).tolist()) for x in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] | sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    roots = components(near, len(rows))
    want = {min(rows[i][0] for i in range(len(rows)) if roots[i] == k and rows[i][0] is not None) for k in set(roots)} - {501}
    got = simhash.deduplicate(edge_frame(spark, rows)).collect()
    assert {x.doc_id for x in got if x.doc_id is not None} == want and sum(x.doc_id is None for x in got) == 1 and got[0].key == "clash"


@pytest.mark.parametrize("limits", [{}, {"block": 40}, {"crowd": 500}], ids=["crowd", "blocks", "pairs"])
def test_near_duplicates_of_a_middle_document(spark, limits):
    r, words = random.Random(12), vocabulary(n=2000)
    base = [r.choice(words) for _ in range(400)]
    rows = []
    for k in range(121):
        copy = list(base)
        for at in r.sample(range(400), 0 if k == 60 else 8):
            copy[at] = f"changed{k}x{at}"
        rows.append((k, " ".join(copy), "en", "s", 1))
    sets = [frozenset(simhash.shingle_hashes(x[1], 5).tolist()) for x in rows]
    near = [(i, j) for i in range(121) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    gone = simhash.superseded(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), **limits).collect()
    assert {x.doc_id for x in gone} == {i for i, root in enumerate(components(near, 121)) if root != i} and len(gone) > 100


def test_near_duplicates_with_a_repeated_line(spark):
    r, words = random.Random(21), vocabulary(n=2000)
    rows = []
    for k in range(10):
        base = " ".join(r.choice(words) for _ in range(404))
        line = " ".join(f"menu{k}x{i}" for i in range(5))
        rows += [(2 * k, base, "en", "s", 1), (2 * k + 1, f"{base} {' '.join([line] * 40)}", "en", "s", 1)]
    sets = [set(simhash.shingle_hashes(x[1], 5).tolist()) for x in rows]
    assert all(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True))
    gone = simhash.superseded(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert {x.doc_id for x in gone} == {2 * k + 1 for k in range(10)}


def test_recall_near_the_limit(spark):
    """600 pairs of texts with a similarity between 0.8 and 0.86, none of them equal, short and long: recall against brute force."""
    r, words = random.Random(41), vocabulary(n=6000)
    rows, sets = [], []
    while len(rows) < 1200:
        n = r.choice([40, 60, 120, 250, 500])
        base = [r.choice(words) for _ in range(n)]
        copy = list(base)
        for at in r.sample(range(n), max(1, int(n * r.uniform(0.018, 0.026)))):
            copy[at] = f"other{len(rows)}"
        if r.random() < 0.3:
            copy += [f"tail{len(rows)}x{i}" for i in range(r.randrange(1, 1 + n // 40 + 1))]
        a, b = (set(simhash.shingle_hashes(" ".join(x), 5).tolist()) for x in (base, copy))
        if 0.8 <= len(a & b) / len(a | b) < 0.86:
            rows += [(len(rows), " ".join(base), "en", "s", 1), (len(rows) + 1, " ".join(copy), "en", "s", 1)]
            sets += [a, b]
    gone = {x.doc_id for x in simhash.superseded(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert gone <= {2 * k + 1 for k in range(600)} and len(gone) >= 0.99 * 600


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_line_dedup(spark):
    rows = [(1, "a b\nX\tY\n\n zz", None, "s1", 1), (2, "A  b\nq", None, "s2", 1), (3, "a b", None, "s3", 1), (None, "a b\nx y", None, "s4", 1), (3, "a b", None, "s3", 1), (5, None, None, "s1", 1), (6, "", None, None, 1), (7, "x  y", None, None, 1), (8, "a b", None, None, 1)]
    got = linededup.line_dedup(edge_frame(spark, rows), sites=2).collect()
    keep = {1: "a b\nX\tY\n\n zz", 2: "q", 3: "", None: "", 5: "", 6: "", 7: "", 8: ""}
    assert all(r.kept_sha256 == sha(keep[r.doc_id]) for r in got) and len(got) == len(rows)
    left = linededup.without_boilerplate(edge_frame(spark, rows), sites=2).collect()
    assert {(r.doc_id, r.text) for r in left} == {(1, "a b\nX\tY\n\n zz"), (2, "q"), (5, None), (6, "")}
    assert linededup.line_dedup(edge_frame(spark, [])).count() == 0
