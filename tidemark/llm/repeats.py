"""Suffix-array dedup by a run-length index: every byte inside a string of 200 bytes that starts elsewhere too.

Texts are UTF-8 bytes.  Matching 200-byte windows are brought together without comparing documents:

1. Each window elects an anchor, the 64-byte string in it of the least hash; equal windows elect equal
   anchors.  The windows that share an anchor's place form a run; a run's context is all bytes
   of its windows.  Runs are hashed by anchor and by context.
2. Runs with equal contexts are repeats as a whole; that settles copies and the inside of long
   passages.  Anchors seen once settle themselves.  What is left are anchors with several contexts:
   the edges of repeats.
3. The contexts of such an anchor are indexed: a suffix array gives the Burrows-Wheeler
   transform, which is kept as runs with the suffixes sampled at run heads and run ends.  Match lengths
   are computed at the samples alone and streamed to all other places, as a place that is not sampled
   matches its neighbour by one byte less than the place before it.  Places that match 200
   bytes or more are marked.
4. An anchor with more than ``GROUP`` contexts is not gathered: its windows are hashed to 128 bits one by one
   and counted.  That is the exact way for groups of any size.

In front of both shuffles each task settles what repeats within itself, and sends one row for each distinct key, so
a passage in a third of all documents reaches its reducer once per task.  Reducers stream over sorted rows.
Equality is that of 128 bits of hash (64 of the anchor and 64 of the context; or 128 of the window), and of bytes in
the index.

Null texts count as empty: nothing is removed.  Texts under 200 bytes are never touched.  Rows with the same id and text
repeat each other and are both removed; null ids are an id like any other.  Very long texts are cut
into pieces that overlap by 199 bytes.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, documents

SPAN, ANCHOR = 200, 64
WIDE = SPAN - ANCHOR + 1
#: Window starts in a piece of a text; bytes that a task settles at once; contexts of an anchor that are indexed together; bytes of an index.
PIECE, FLUSH, GROUP, INDEX, HELD = 1 << 19, 16 << 20, 256, 1 << 19, 100_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _C)) * _B
    return x ^ (x >> np.uint64(32))


def window_hashes(data: bytes, length: int) -> np.ndarray:
    """Hashes of all strings of ``length`` bytes (eight times a power of two), by doubling."""
    h = _mix(np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)) * _A)
    at = 8
    while at < length:
        h = _mix(h[:-at] * _A + h[at:])
        at *= 2
    return h


def runs_of(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor hash, context hash, first and end of the window starts of each run, piece by piece."""
    low, mask = np.uint64((1 << 20) - 1), np.uint64(~((1 << 20) - 1) & (2**64 - 1))
    for c in range(0, len(data) - SPAN + 1, PIECE):
        part = data[c : c + PIECE + SPAN - 1]
        h = window_hashes(part, ANCHOR)
        m = len(part) - SPAN + 1
        key = (h & mask) | np.arange(len(h), dtype=np.uint64)  # leftmost of equals
        pad = -len(key) % WIDE
        blocks = np.concatenate([key, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, WIDE)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:m], ahead[WIDE - 1 : WIDE - 1 + m]) & low).astype(np.int64)
        s = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        e = np.append(s[1:], m)
        # A context is told by the place of the anchor in it, its length, and window hashes at both ends and between.
        h128 = _mix(h[:-ANCHOR] * _A + h[ANCHOR:])
        at = at[s]
        first, last, mid = h128[s], h128[e - 1 + SPAN - 128], h128[np.minimum(s + 100, e - 1 + SPAN - 128)]
        ctx = _mix(_mix(_mix(first * _A + mid) * _A + last) + ((at - s) * 4096 + (e - s)).astype(np.uint64) * _B)
        yield h[at], ctx, s + c, e + c


def _merged(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted intervals, those that touch joined."""
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]


ROW = "route long, kind int, x long, y long, doc long, th long, s int, e int, known boolean, ctx binary"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
_NAMES = ["route", "kind", "x", "y", "doc", "th", "s", "e", "known", "ctx"]
SETTLED, RUN, CONTEXT, WINDOW = 0, 1, 2, 3


def _batch(n: int, **cols) -> pa.RecordBatch:
    made = [cols[k] if isinstance(cols.get(k), pa.Array) else pa.array(cols[k], t) if k in cols else pa.nulls(n, t) for k, t in zip(_NAMES, _KINDS, strict=True)]
    return pa.record_batch(made, names=_NAMES)


def _settle(kind: int, docs: list, owner: np.ndarray, x: np.ndarray, y: np.ndarray, s: np.ndarray, e: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What repeats within a task is settled there; of each distinct key one row goes on."""
    order = np.lexsort((y, x))
    x, y, s, e, owner = x[order], y[order], s[order], e[order], owner[order]
    same = np.concatenate([[False], (x[1:] == x[:-1]) & (y[1:] == y[:-1])])
    dup = same | np.append(same[1:], False)
    if dup.any():
        o, ds, de = owner[dup], s[dup].astype(np.int64), e[dup].astype(np.int64)
        base = o.astype(np.int64) << 40
        ms, me = _merged(base + ds, base + de)
        o = (ms >> 40).astype(np.int64)
        low = (1 << 40) - 1
        th = pa.array([docs[i][1] for i in o], pa.int64())
        yield _batch(len(o), route=th, kind=np.full(len(o), SETTLED, np.int32), doc=pa.array([docs[i][0] for i in o], pa.int64()), th=th, s=(ms & low).astype(np.int32), e=(me - (o << 40)).astype(np.int32))
    one = ~same
    o = owner[one]
    if len(o):
        xi = x[one].view("<i8")
        yield _batch(len(o), route=xi, kind=np.full(len(o), kind, np.int32), x=xi, y=y[one].view("<i8"), doc=pa.array([docs[i][0] for i in o], pa.int64()), th=pa.array([docs[i][1] for i in o], pa.int64()), s=s[one].astype(np.int32), e=e[one].astype(np.int32), known=dup[one])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        rest = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] not in ("doc_id", "th", "text")]
        data = b.column("text").cast(pa.binary())
        for i, (doc, th) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), strict=True)):
            yield (doc, th, data[i].as_py(), *[c[i] for c in rest])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1: runs of all texts."""
    docs, got, size = [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if got:
            cols = [np.concatenate([g[i] for g in got]) for i in range(5)]
            yield from _settle(RUN, docs, *cols)
        docs.clear(), got.clear()

    for doc, th, data in _texts(batches):
        if len(data) < SPAN:
            continue
        docs.append((doc, th))
        for x, y, s, e in runs_of(data):
            got.append((np.full(len(x), len(docs) - 1, np.int32), x, y, s, e))
        size += len(data)
        if size >= FLUSH:
            yield from flush()
            size = 0
    yield from flush()


FOUND = "doc long, th long, kind int, x long, s int, e int"


def _found(t: pa.Table, keep: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
    if keep.any():
        p = t.filter(pa.array(keep))
        out = pa.table([p["doc"], p["th"], pa.array(kind[keep].astype(np.int32)), p["x"], p["s"], p["e"]], names=["doc", "th", "kind", "x", "s", "e"])
        yield from out.to_batches()


class _Adjacent:
    """Streams over rows sorted by (x, y): equal neighbours repeat; an x with several y is left open."""

    def __init__(self, group: int):
        self.group = group  # most contexts to be indexed together; 0: what is open is of no use
        self.last = False
        self.held: pa.Table | None = None
        self.prev: tuple | None = None
        self.big: int | None = None

    def add(self, t: pa.Table | None) -> Iterator[pa.RecordBatch]:
        """t: the next rows; None at the end."""
        if t is not None:
            t = pa.concat_tables([self.held, t]) if self.held is not None else t
        else:
            t = self.held
        self.held = None
        if t is None or not t.num_rows:
            return
        x, y = t["x"].to_numpy(), t["y"].to_numpy()
        done = len(x)
        forced = False
        if not self.last:
            done = int(np.searchsorted(x, x[-1]))  # rows before the last x
            if len(x) - done > HELD:  # an x too large to hold goes on in parts, but for the row that may have an equal next
                done, forced = len(x) - 1, True
        new_x = np.concatenate([[self.prev is None or self.prev[0] != x[0]], x[1:] != x[:-1]])
        new = new_x | np.concatenate([[self.prev is None or self.prev != (x[0], y[0])], y[1:] != y[:-1]])
        dup = ~new | np.append(~new[1:], False)
        group = np.cumsum(new_x) - 1 + (0 if new_x[0] else 1)
        many = np.bincount(group, weights=new)[group]
        if self.big is not None:
            many[x == self.big] = np.inf
        if forced:
            self.big = int(x[-1])
            many[x == x[-1]] = np.inf
        head = np.arange(len(x)) < done
        known = t["known"].to_numpy(zero_copy_only=False)
        yield from _found(t, head & dup & ~known, np.full(len(x), SETTLED))
        if self.group:
            yield from _found(t, head & new & (many > 1), np.where(many > self.group, WINDOW, CONTEXT))
        if done:
            self.prev = (x[done - 1], y[done - 1])
        self.held = t.slice(done) if done < len(x) else None

    def end(self) -> Iterator[pa.RecordBatch]:
        self.last = True
        yield from self.add(None)


def _kinds(b: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    kind = b.column("kind").to_numpy()
    for k in np.unique(kind):
        yield int(k), pa.Table.from_batches([b.filter(pa.array(kind == k))])


def _compare(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """Step 2: rows by kind, anchor and context."""
    near = _Adjacent(group)
    for b in batches:
        for k, t in _kinds(b):
            if k == SETTLED:
                yield from _found(t, np.ones(t.num_rows, bool), np.zeros(t.num_rows))
            else:
                yield from near.add(t)
    yield from near.end()


class RunLengthIndex:
    """Burrows-Wheeler transform of a collection of texts as runs, with suffixes sampled at run heads and ends."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts])
        starts = np.cumsum(sizes) - sizes
        self.text = np.frombuffer(b"\0".join(texts) + b"\0" * 9, np.uint8)
        n = self.n = int(sizes.sum())
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        self.left = np.repeat(starts + sizes - 1, sizes) - np.arange(n)  # bytes up to the text's end
        self.starts = starts
        # Suffixes are ranked by 8 bytes, then by twice as many each time.  A text's end is told from all others by the text's number.
        word = np.ndarray((n,), ">u8", self.text.tobytes(), strides=(1,)).astype(np.uint64)
        short = np.minimum(self.left, 8)
        word &= np.uint64(2**64 - 1) << (np.uint64(8) * (8 - np.maximum(short, 1)).astype(np.uint64))
        word[short == 0] = 0
        rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
        rank = np.unique(rank * 16 + short, return_inverse=True)[1].astype(np.int64)
        at, m = 8, len(texts)
        while True:
            over = self.left < at
            nxt = np.where(over, self.owner, m + np.concatenate([rank[at:], np.zeros(min(at, n), np.int64)])[:n])
            values, rank = np.unique(rank * (n + m + 1) + nxt, return_inverse=True)
            rank = rank.astype(np.int64)
            if len(values) == n:
                break
            at *= 2
        sa = np.empty(n, np.int64)
        sa[rank] = np.arange(n)
        bwt = self.text[sa - 1].astype(np.int64)
        first = np.isin(sa, starts)
        bwt[first] = -1 - self.owner[sa[first]]  # what stands before a text is its own symbol
        change = bwt[1:] != bwt[:-1]
        self.heads = np.concatenate([[True], change])
        self.ends = np.append(change, True)
        self.head_at, self.end_at = sa[self.heads], sa[self.ends]  # the samples
        self.before = np.concatenate([[-1], sa[:-1]])[self.heads]
        self.after = np.append(sa[1:], -1)[self.ends]

    def _common(self, p: np.ndarray, q: np.ndarray, most: int) -> np.ndarray:
        """Length of the common prefix, up to ``most`` or a text's end; q < 0: none."""
        out = np.zeros(len(p), np.int64)
        live = np.flatnonzero(q >= 0)
        text = self.text
        limit = np.minimum(np.minimum(self.left[p], self.left[q]), most)
        words = np.ndarray((len(text) - 7,), "<u8", text.tobytes(), strides=(1,))
        done = 0
        while len(live):
            a, b = p[live] + done, q[live] + done
            diff = words[np.minimum(a, len(words) - 1)] ^ words[np.minimum(b, len(words) - 1)]
            low = diff & (~diff + np.uint64(1))
            same = np.where(diff == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3)
            out[live] += same
            live = live[(diff == 0) & (done + 8 < limit[live])]
            done += 8
        return np.minimum(out, limit)

    def matching(self, most: int) -> np.ndarray:
        """For every place, the longest string that starts there and at another place, up to ``most`` bytes."""
        best = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for at, other in ((self.head_at, self.before), (self.end_at, self.after)):
            reach = np.zeros(self.n, np.int64)
            reach[at] = self._common(at, other, 1 << 30) + at
            best = np.maximum(best, np.maximum.accumulate(reach) - place)
        return np.minimum(np.minimum(best, self.left), most)


def _residue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of small groups, and windows of large ones, out of the texts."""
    docs, got, ctx, size = [], [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if ctx:
            cols = list(zip(*ctx, strict=True))
            x = pa.array(cols[0], pa.int64())
            yield _batch(len(x), route=x, kind=np.full(len(x), CONTEXT, np.int32), x=x, y=pa.array([(hash(d) ^ s) & 0x7FFFFFFF for d, s in zip(cols[2], cols[3], strict=True)], pa.int64()), doc=pa.array(cols[1], pa.int64()), th=pa.array(cols[2], pa.int64()), s=pa.array(cols[3], pa.int32()), e=pa.array(cols[4], pa.int32()), ctx=pa.array(cols[5], pa.binary()))
        if got:
            yield from _settle(WINDOW, docs, *[np.concatenate([g[i] for g in got]) for i in range(5)])
        docs.clear(), got.clear(), ctx.clear()

    for doc, th, data, spots in _texts(batches):
        docs.append((doc, th))
        for r in spots.as_py():
            if r["kind"] == CONTEXT:
                part = data[r["s"] : r["e"] + SPAN - 1]
                ctx.append((r["x"], doc, th, r["s"], r["e"], part))
                size += len(part)
            elif r["kind"] == WINDOW:
                h = window_hashes(data[r["s"] : r["e"] + SPAN - 1], 128)
                n = r["e"] - r["s"]
                p = np.arange(r["s"], r["e"])
                got.append((np.full(n, len(docs) - 1, np.int32), h[:n], h[SPAN - 128 : SPAN - 128 + n], p, p + 1))
                size += 40 * n
        if size >= FLUSH:
            yield from flush()
            size = 0
    yield from flush()


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps 3 and 4: contexts by anchor, windows by hash."""
    near, group, ready, size = _Adjacent(0), [], [], 0

    def marks(rows: list) -> Iterator[pa.RecordBatch]:
        index = RunLengthIndex([r[5] for r in rows])
        long = index.matching(SPAN) >= SPAN
        out = []
        for r, at in zip(rows, index.starts, strict=True):
            hit = np.flatnonzero(long[at : at + r[4] - r[3]])
            if len(hit):
                s, e = _merged(hit, hit + 1)
                out += [(r[1], r[2], SETTLED, None, int(r[3] + a), int(r[3] + b)) for a, b in zip(s, e, strict=True)]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()], strict=True)], names=["doc", "th", "kind", "x", "s", "e"])

    for b in batches:
        for k, t in _kinds(b):
            if k == SETTLED:
                yield from _found(t, np.ones(t.num_rows, bool), np.zeros(t.num_rows))
            elif k == WINDOW:
                yield from near.add(t)
            else:
                for r in zip(*[t[c].to_pylist() for c in ("x", "doc", "th", "s", "e", "ctx")], strict=True):
                    if group and group[-1][0] != r[0]:
                        ready += group
                        size += sum(len(g[5]) for g in group)
                        group = []
                        if size >= INDEX:
                            yield from marks(ready)
                            ready, size = [], 0
                    group.append(r)
    if ready or group:
        yield from marks(ready + group)
    yield from near.end()


def _dealt(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "route").sortWithinPartitions("kind", "x", "y")


def marked(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, th, text, spots): every row, with the starts [s, e) of its repeated windows (null: none)."""
    texts = documents(docs).withColumn("th", F.xxhash64("text"))
    spots = _dealt(texts.mapInArrow(_spread, ROW)).mapInArrow(partial(_compare, group=group), FOUND)
    spots = cut(spots.groupBy("doc", "th").agg(F.collect_list(F.struct("kind", "x", "s", "e")).alias("spots")))
    same = lambda o: texts["doc_id"].eqNullSafe(o["doc"]) & (texts["th"] == o["th"])
    open_ = spots.select("doc", "th", F.expr("filter(spots, r -> r.kind > 0)").alias("open")).where(F.size("open") > 0)
    rest = texts.join(open_, same(open_)).select("doc_id", texts["th"], "text", "open")
    more = _dealt(rest.mapInArrow(_residue, ROW)).mapInArrow(_index, FOUND).select("doc", "th", F.struct("s", "e").alias("r"))
    both = more.groupBy("doc", "th").agg(F.collect_list("r").alias("rs")).unionByName(spots.select("doc", "th", F.expr("transform(filter(spots, r -> r.kind = 0), r -> struct(r.s, r.e))").alias("rs")))
    both = both.groupBy("doc", "th").agg(F.flatten(F.collect_list("rs")).alias("spots"))
    return texts.join(both, same(both), "left").select("doc_id", texts["th"], "text", "spots")


def repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, _, data, spots in _texts(iter([b])):
                removed = n = 0
                kept = hashlib.sha256()
                if spots.is_valid and len(spots):
                    flat = spots.values.flatten()
                    s, e = _merged(flat[0].to_numpy().astype(np.int64), flat[1].to_numpy().astype(np.int64) + SPAN - 1)
                    at = 0
                    for a, z in zip(s.tolist(), e.tolist(), strict=True):
                        kept.update(data[at:a])
                        at, removed, n = z, removed + z - a, n + 1
                    kept.update(data[at:])
                else:
                    kept.update(data)
                rows.append((doc, len(data), removed, n, kept.hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()], strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return marked(docs, group).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
