"""Packing: bounded-space online best-fit of token runs into windows of a fixed length.

Each partition keeps ``OPEN`` windows.  A document's ids (and the id that ends it) are first cut
into full windows; what is left over goes into the open window with the least room that holds it
(best fit).  Where none fits and all windows are open, the fullest is emitted; if that would leave more than
``SLACK`` tokens of padding, the head of the waiting piece fills it first.  The windows still open
at a partition's end are leftovers: they travel, with their ids, to a task for each ``GROUP`` partitions, which
merges them in the same way and cuts its last window at powers of two, where no padding is
needed.  So a task never holds more than OPEN * GROUP windows, however large the corpus, and full
windows pass through untouched.

Ids are those of the tokenizer's library.  Chunks between spaces and line ends are encoded once and kept
in a bounded table: neither the normaliser nor the pre-tokenizer of a model that splits on white
space lets a token cross them.  Chunks of plain Latin letters and marks are merged by a faster library, which is proved to
agree on the vocabulary (``Pairs``).

A null text counts as empty: its document is the end id alone.  Rows are handled one by one, so
repeated rows and ids, or null ids, are packed once each.  A document of any length is cut as
often as needed.  Extra columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents

OPEN, GROUP, SLACK = 64, 8, 16
#: Chunks and pre-tokens that a worker keeps; the most characters of a chunk that is kept.  An executor can have more workers than cores for a while,
#: each with tables of its own, so they are to stay within 100 MB; a pre-token that its chunk's entry does not save is rarely met again.
KEPT, PRE_KEPT, LONGEST = 450_000, 20_000, 48
#: What the chunks' own way through the model relies on; other models are left to the library.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
SPECIAL = ["<|endoftext|>", "<|startoftext|>"]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def merges(path: str) -> tuple[dict, list[tuple[str, str]]]:
    """The model of a tokenizer's file, and its merges in order."""
    model = json.loads(Path(path).read_text())["model"]
    return model, [tuple(p.split(" ") if isinstance(p, str) else p) for p in model.get("merges", [])]


@lru_cache(maxsize=2)
def unmade_tokens(path: str, end: str = "</w>") -> tuple[int, ...]:
    """Numbers of the merges whose token the merges do not make from its own bytes."""
    _, pairs = merges(path)
    rank, never = {p: i for i, p in enumerate(pairs)}, len(pairs)

    def made(token: str) -> bool:
        parts = list(token.removesuffix(end))
        parts[-1] += token[len(token.removesuffix(end)) :]
        while len(parts) > 1:
            ranks = [rank.get(p, never) for p in zip(parts, parts[1:], strict=False)]
            at = ranks.index(min(ranks))
            if ranks[at] == never:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    return tuple(i for i, (a, b) in enumerate(pairs) if not made(a + b))


class Pairs:
    """Ids of a single pre-token by the merges of a byte-level BPE model with word ends, through a faster library.

    That library joins two neighbours if their bytes together are a token, lowest rank first; the model's own joins
    two neighbours if that very pair is listed.  The two agree if no token can come up in a second way.
    What happens inside a token's bytes, up to the moment it stands, is the same in all surroundings.  So a token that the pairs do not make
    from its own bytes is never made at all, and is left out; and for any other token no second pair can come to
    stand side by side, as then its own bytes would have gone that way too.  ``unmade_tokens`` settles this for all tokens, once for a job.
    ``exact`` says whether the model is of this kind: 256 bytes, the same as word ends, then a token for each pair, in order.
    """

    END = "</w>"

    def __init__(self, path: str, unmade: tuple[int, ...]):
        import tiktoken

        model, pairs, end, skip = *merges(path), self.END, set(unmade)
        vocab = model["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others are counted up from 256
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.exact = (
            model["type"] == "BPE" and model.get("end_of_word_suffix") == end and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
            and all(vocab.get(c, 256) < 256 <= vocab.get(c + end, 0) < 512 for c in byte)
            and all(vocab.get(a + b) == 512 + i and not a.endswith(end) for i, (a, b) in enumerate(pairs))
        )
        if not self.exact:
            return
        # A word's end is the byte 0xFF, which no text has; joining it to the byte before it ranks before all pairs.
        data = lambda t: bytes(map(byte.__getitem__, t.removesuffix(end))) + (b"\xff" if t.endswith(end) else b"")
        tokens = [c + e for c in byte for e in ("", end)] + [a + b for i, (a, b) in enumerate(pairs) if i not in skip]
        self.ids = tiktoken.Encoding("pairs", pat_str=".", mergeable_ranks={data(t): vocab[t] for t in tokens}, special_tokens={})._core_bpe.encode_single_piece

    def encode(self, pre_token: str) -> bytes:
        return array("I", self.ids(pre_token.encode() + b"\xff")).tobytes()


#: Letters that are their own normal form and have a lower case of one letter, beside those of ASCII.
LATIN = "À-ÖØ-öø-įĲ-ňŊ-ž"
PLAIN, PRE_TOKEN = re.compile(f"[!-~{LATIN}]+"), re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^a-z0-9{LATIN}]+")


class Encoder(dict):
    """Ids of whole texts, as little-endian unsigned 32-bit numbers; itself the table of chunks and their ids.

    Chunks of plain letters and marks are cut into pre-tokens here and go to ``Pairs``; all others, and long ones, go to the
    tokenizer's library.  For a model with other rules for white space whole texts do.
    """

    def __init__(self, path: str, end: int, unmade: tuple[int, ...]):
        from tokenizers import Tokenizer

        self.library, self.end, self.pairs = Tokenizer.from_file(path), np.uint32(end).tobytes(), Pairs(path, unmade)
        spec = json.loads(Path(path).read_text())
        known = (spec["normalizer"], spec["pre_tokenizer"], sorted(t["content"] for t in spec["added_tokens"])) == (NORMALIZER, PRE_TOKENIZER, SPECIAL)
        self.known, self.short = known, LONGEST if known and self.pairs.exact else -1
        self.pre_token = lru_cache(maxsize=PRE_KEPT)(self.pairs.encode)

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) <= self.short and PLAIN.fullmatch(chunk) and "<|" not in chunk:
            ids = b"".join(map(self.pre_token, PRE_TOKEN.findall(chunk.lower())))
        else:
            ids = self._whole(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[chunk] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.known:
            return self._whole(text) + self.end
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) + self.end


@lru_cache(maxsize=2)
def encoder(path: str, end: int, unmade: tuple[int, ...]) -> Encoder:
    return Encoder(path, end, unmade)


class Packer:
    """Windows of ``size`` tokens, filled online; ``emit`` gets the finished ones."""

    def __init__(self, size: int, keep: int, first: int, emit):
        self.size, self.keep, self.next, self.emit = size, keep, first, emit
        self.open: list[tuple[int, int]] = []  # (fill, number), sorted
        self.rows: dict[int, list] = {}

    def whole(self, piece: tuple) -> None:
        """A piece of a full window's length."""
        self.emit(self.next, [piece])
        self.next += 1

    def _put(self, at: int, piece: tuple) -> None:
        fill, number = self.open.pop(at)
        self.rows[number].append(piece)
        fill += piece[2]
        if fill == self.size:
            self.emit(number, self.rows.pop(number))
        else:
            insort(self.open, (fill, number))

    def add(self, piece: tuple) -> None:
        """piece: (doc, start, length, ids, tokens of the document), shorter than a window."""
        while True:
            # The fullest window in which it fits: the last with fill <= size - length.
            at = bisect_left(self.open, (self.size - piece[2] + 1, -1)) - 1
            if at >= 0:
                return self._put(at, piece)
            if len(self.open) < self.keep:
                self.rows[self.next] = []
                insort(self.open, (0, self.next))
                self.next += 1
                continue
            room = self.size - self.open[-1][0]
            if room <= SLACK:
                number = self.open.pop()[1]
                self.emit(number, self.rows.pop(number))
                continue
            doc, start, length, ids, total = piece
            self._put(len(self.open) - 1, (doc, start, room, ids[: 4 * room], total))
            piece = (doc, start + room, length - room, ids[4 * room :], total)


class _Out:
    """Columns of pieces, flushed as record batches."""

    def __init__(self, ids: bool):
        self.ids, self.cols = ids, [[] for _ in range(10 if ids else 7)]

    def piece(self, p: tuple, number: int, offset: int, route: int = 0, left: bool = False) -> None:
        doc, start, length, ids, total = p
        row = [doc, start, length, zlib.crc32(ids), total, number, offset]
        if self.ids:
            row += [route, left, ids if left else None]
        for c, v in zip(self.cols, row, strict=True):
            c.append(v)

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.cols[0]:
            kinds = [pa.int64()] * 7 + ([pa.int64(), pa.bool_(), pa.binary()] if self.ids else [])
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "route", "left", "ids"][: len(kinds)]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(self.cols, kinds, strict=True)], names=names)
            self.cols = [[] for _ in self.cols]


def pack(docs: DataFrame, path: str, end: int = 1, size: int = 2048) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    unmade = unmade_tokens(path)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, enc = TaskContext.get().partitionId(), _Out(True), encoder(path, end, unmade)

        def emit(number: int, pieces: list) -> None:
            offset = 0
            for p in pieces:
                out.piece(p, number, offset, -1 - number % 8191)
                offset += p[2]

        packer = Packer(size, OPEN, part << 33, emit)
        for b in batches:
            for doc, text in zip(b.column("doc_id"), b.column("text"), strict=True):
                doc, ids = doc.as_py(), enc.encode(text.as_py())
                n = len(ids) // 4
                for s in range(0, n - size + 1, size):
                    packer.whole((doc, s, size, ids[4 * s : 4 * (s + size)], n))
                if n % size:
                    s = n - n % size
                    packer.add((doc, s, n - s, ids[4 * s :], n))
                if len(out.cols[0]) >= 20_000:
                    yield from out.take()
        for _, number in packer.open:
            offset = 0
            for p in packer.rows[number]:
                out.piece(p, number, offset, part // GROUP, True)
                offset += p[2]
        yield from out.take()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by route, then whether left, window and offset: each group's leftovers are together."""
        final = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        held: list[tuple] = []

        def merged() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            out = _Out(False)

            def emit(number: int, pieces: list) -> None:
                offset = 0
                for p in pieces:
                    out.piece(p, number, offset)
                    offset += p[2]

            # Numbers of merged windows: those of the group's first partition, from the upper half on.
            packer = Packer(size, OPEN, (held[0][0] * GROUP << 33) + (1 << 32), emit)
            for _, p in sorted(held, key=lambda x: -x[1][2]):
                packer.add(p)
            # The last open windows are joined end to end; what then ends early is cut at powers of two.
            rest = [p for _, number in packer.open for p in packer.rows[number]]
            total, todo = sum(p[2] for p in rest), []
            sizes = [size] * (total // size) + [1 << k for k in reversed(range(size.bit_length())) if total % size >> k & 1]
            for want in sizes:
                pieces, have = [], 0
                while have < want:
                    doc, start, length, ids, n = todo.pop() if todo else rest.pop()
                    take = min(length, want - have)
                    pieces.append((doc, start, take, ids[: 4 * take], n))
                    have += take
                    if take < length:
                        todo.append((doc, start + take, length - take, ids[4 * take :], n))
                emit(packer.next, pieces)
                packer.next += 1
            held.clear()
            yield from out.take()

        for b in batches:
            left = b.column("left").to_pylist()
            if not all(left):
                yield b.filter(pa.array([not x for x in left])).select(final)
            if any(left):
                for r in b.filter(b.column("left")).to_pylist():
                    if held and held[0][0] != r["route"]:
                        yield from merged()
                    held.append((r["route"], (r["doc_id"], r["start"], r["length"], r["ids"], r["doc_tokens"])))
        yield from merged()

    placed = documents(docs).mapInArrow(fill, SCHEMA + ", route long, left boolean, ids binary")
    order = ["route", "left", "sequence_id", "offset"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, F.col("route")).sortWithinPartitions(*order).mapInArrow(merge, SCHEMA)
