"""Token counts: whole-token shortcut in front of a SentencePiece BPE model.

Offline, once for a worker: every vocabulary string that can stand as a pre-token is encoded alone
by the library, and those that come back as one token form the shortcut.  A text is cut into
pre-tokens where a space (the model's word mark) follows another character.  That is exact for
models none of whose pieces has a word mark after another character, which is proved on the
vocabulary when the model is loaded: no merge can then cross such a place.  Other models
are encoded whole.  Pre-tokens in the shortcut count 1; the rest are merged by the library, each
distinct one once as long as it stays in a bounded table.

A null text counts as empty: no bytes, no tokens.  Rows are handled one by one, so repeated rows
and ids, or null ids, give a row each.  Texts are never cut short.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from tidemark.llm.common import documents

MARK = "▁"
#: Merged pre-tokens that a worker keeps, each of at most so many characters.
KEPT, LONGEST = 800_000, 64


class Counter:
    """Counts the tokens of texts as ``encode`` of the library does."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.exact = not any(MARK in p.lstrip(MARK) for p in pieces) and self.sp.encode("  a  b", out_type=str) == [MARK * 2, MARK + "a", MARK, MARK + "b"]
        # ' w' inside a text is what 'w' is at its start, where the library adds a space of its own.
        words = [p[1:] for p in pieces if p.startswith(MARK) and p[1:] and MARK not in p[1:]]
        self.one = {" " + w for w, ids in zip(words, self.sp.encode(words, num_threads=1), strict=True) if len(ids) == 1 and self.exact}
        self.merged: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if not self.exact:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        one, merged, out, cuts = self.one, self.merged, [], []
        fresh: dict[str, int] = {}
        for text in texts:
            if not text:
                cuts.append(())
                continue
            parts = (" " + text.replace(MARK, " ")).split(" ")
            n, rest, blank = 0, [], 0
            # parts[1:] are the words after each space; empty ones are spaces before the next.
            for w in parts[1:]:
                if not w:
                    blank += 1
                    continue
                w = " " * blank + " " + w if blank else " " + w
                blank = 0
                if w in one:
                    n += 1
                elif (k := merged.get(w)) is not None:
                    n += k
                else:
                    rest.append(w)
                    fresh[w] = 0
            if blank:
                rest.append(" " * blank)
                fresh[" " * blank] = 0
            cuts.append((n, rest))
        if fresh:
            todo = list(fresh)
            for w, ids in zip(todo, self.sp.encode([w[1:] if w[1:] else "" for w in todo], num_threads=1), strict=True):
                fresh[w] = len(ids) if w != " " else 1
            if len(merged) + len(fresh) > KEPT:
                merged.clear()
            merged.update((w, k) for w, k in fresh.items() if len(w) <= LONGEST)
        for c in cuts:
            out.append(c[0] + sum(map(fresh.__getitem__, c[1])) if c else 0)
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            n_bytes, n_tokens, texts = [], [], b.column("text")
            for at in range(0, b.num_rows, 256):
                part = texts.slice(at, 256)
                n_bytes += pa.compute.binary_length(part).to_pylist()
                n_tokens += c.counts(part.to_pylist())
            yield pa.record_batch([b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
