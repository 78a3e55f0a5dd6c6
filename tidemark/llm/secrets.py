"""Secret scans: named patterns, and sliding-window Shannon entropy over candidate strings.

Base kinds (``assign``, ``access``, ``hex``) are leftmost non-overlapping matches of three
patterns, those too short dropped.  The method adds ``entropy`` spans.  Candidates are runs of 20
or more characters of ``[A-Za-z0-9+/_=-]``; each belongs to a class (hex digits, letters alone,
mixed).  A window of 20 characters moves over the candidate; the counts of its characters are
kept in a packed string, and the sum of c * log2(c) is updated by the one character that comes and
the one that goes.  Windows at or above the class's entropy limit are joined to spans.  An
allow list (UUIDs, alphabets and counters, words joined by - _ /, placeholders, image data)
silences candidates, and entropy spans inside a base span are not repeated.

Positions are code points, ends exclusive.  A null text counts as empty; an empty one has no spans.
Rows are handled one by one: repeated rows and ids, or null ids, give a row each.  A candidate of
any length is scanned in time linear in its length; many matches in one text cost the power 1.5 of their number, of array copies only.
Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents

KINDS = ("assign", "access", "hex", "entropy")
_KEY = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A greedy run that passes is a run that is long enough, so the lengths stand in the patterns.
ACCESS, HEX, CANDIDATE = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9+/_=-]{20,}"
WIDTH = 20
#: Least bits a character in a window, by class of candidate.
LIMITS = {"hex": 2.8, "mixed": 3.5, "alpha": 4.1}
UNIT = 1_000_000
#: c * log2(c) in units of 1e-6, for the counts 0 to WIDTH: whole numbers make the sums exact.
STEP = [0, *(round(c * math.log2(c) * UNIT) for c in range(1, WIDTH + 1))]
#: A window passes if its sum is at most this.
MOST = {k: math.floor((math.log2(WIDTH) - v) * WIDTH * UNIT) for k, v in LIMITS.items()}
ALLOW = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"abcdefghij|ABCDEFGHIJ|0123456789|EXAMPLE|PLACEHOLDER|[Xx]{8}|^iVBORw0KGgo|^R0lGOD|^/9j/",
    r"^[/_=+-]*([A-Za-z][a-z]{0,14}|[0-9]{1,4})([/_=+-]+([A-Za-z][a-z]{0,14}|[0-9]{1,4}))+[/_=+-]*$",
)


def _scan(items: str, start: str, step: str, made: str, kind: str) -> str:
    """``made`` of each element x and of m, the fold by ``step`` from ``start`` over all elements before it.

    Appending to an array copies it, so the scan goes by blocks of the square root of the array's length: the folds of the blocks
    first, then the elements of each block.
    """
    width = "greatest(1, cast(sqrt(size(z)) as int))"
    tops = f"aggregate(ps, named_struct('t', cast(array() as array<int>), 'm', {start}), (a, p) -> named_struct('t', array_append(a.t, a.m), 'm', aggregate(p, a.m, (m, x) -> {step})), a -> a.t)"
    rows = f"aggregate(p, named_struct('r', cast(array() as array<{kind}>), 'm', top), (a, x) -> transform(array(a.m), m -> named_struct('r', array_append(a.r, {made}), 'm', {step}))[0], a -> a.r)"
    blocks = f"transform(array(transform(sequence(0, size(z) - 1, {width}), i -> slice(z, i + 1, {width}))), ps -> flatten(zip_with(ps, {tops}, (p, top) -> {rows})))[0]"
    return f"transform(array({items}), z -> if(size(z) = 0, cast(array() as array<{kind}>), {blocks}))[0]"


def _pieces(text: str, pattern: str, wanted: str) -> str:
    """Spans [s, e) with text ``m`` of all matches of which ``wanted`` holds: a condition on y, with y.v the text of group 2 for ASSIGN."""
    group = 2 if pattern == ASSIGN else 0
    quoted = pattern.replace("'", "\\'") if pattern == ASSIGN else pattern
    lit = f"'{quoted}'".replace("\\x20", "\\\\x20")
    parts = f"named_struct('m', regexp_extract_all({text}, {lit}, 0), 'v', regexp_extract_all({text}, {lit}, {group}), 'g', split({text}, {lit}, -1))"
    items = "transform(q.m, (m, i) -> named_struct('m', m, 'v', q.v[i], 'n', char_length(q.g[i]), 'l', char_length(m)))"
    kind, made = "struct<s:int,e:int,m:string,v:string>", "named_struct('s', m + x.n, 'e', m + x.n + x.l, 'm', x.m, 'v', x.v)"
    found = f"filter({_scan(items, '0', 'm + x.n + x.l', made, kind)}, y -> {wanted})"
    return f"if({text} rlike {lit}, transform(array({parts}), q -> {found})[0], cast(array() as array<{kind}>))"


#: Windows that are folded at once; the windows before and behind that may belong to a span of theirs.
BLOCK, AROUND = 512, WIDTH


def _windows(c: str) -> str:
    """Joined windows [s, e) of high entropy in the candidate ``c.m``, in code points from its start.

    Each block of windows is folded together with the ``AROUND`` windows on either side, which show whether a span
    starts or ends in the block itself.
    """
    kind = f"case when {c} rlike '^[0-9A-Fa-f]+$' then {MOST['hex']} when {c} rlike '[0-9]' then {MOST['mixed']} else {MOST['alpha']} end"
    steps = f"array({', '.join(f'{v}L' for v in STEP)})"
    # k: packed counts, one character a symbol; h: the sum; r: spans so far, the last of which may still grow.
    at = lambda i: f"(ascii(y.c[{i}]) - 42)"  # noqa: E731  symbols are + to z
    count = lambda k, i: f"(ascii(substring({k}, {at(i)}, 1)) - 48)"
    zero = f"named_struct('k', repeat('0', 82), 'h', 0L, 'r', cast(array() as array<struct<s:int,e:int>>))"
    put = lambda k, i, d: f"overlay({k} placing char(48 + {count(k, i)} + {d}) from {at(i)} for 1)"
    gone = f"if(i < g.lo + {WIDTH}, a, named_struct('k', {put('a.k', f'i - {WIDTH}', -1)}, 'h', a.h - y.f[{count('a.k', f'i - {WIDTH}')}] + y.f[{count('a.k', f'i - {WIDTH}')} - 1], 'r', a.r))"
    come = f"transform(array({gone}), b -> named_struct('k', {put('b.k', 'i', 1)}, 'h', b.h - y.f[{count('b.k', 'i')}] + y.f[{count('b.k', 'i')} + 1], 'r', b.r))[0]"
    grow = f"""case when i < g.lo + {WIDTH - 1} or d.h > y.t then d.r
        when size(d.r) > 0 and element_at(d.r, -1).e >= i - {WIDTH - 1} then concat(slice(d.r, 1, size(d.r) - 1), array(named_struct('s', element_at(d.r, -1).s, 'e', i + 1)))
        else array_append(d.r, named_struct('s', i - {WIDTH - 1}, 'e', i + 1)) end"""
    step = f"transform(array({come}), d -> named_struct('k', d.k, 'h', d.h, 'r', {grow}))[0]"
    spans_of = f"aggregate(sequence(g.lo, g.hi + {WIDTH - 1}), {zero}, (a, i) -> {step}, a -> a.r)"
    # o: the block's first window and the next block's; starts and ends are those of windows between.
    block = f"named_struct('o', o, 'lo', greatest(0, o - {AROUND}), 'hi', least(size(y.c) - {WIDTH}, o + {BLOCK - 1 + AROUND}))"
    own = lambda p: f"({p} >= g.o and {p} < g.o + {BLOCK})"
    ends = f"transform({spans_of}, z -> named_struct('s', if({own('z.s')}, z.s, null), 'e', if({own(f'z.e - {WIDTH}')}, z.e, null)))"
    every = f"flatten(transform(transform(sequence(0, size(y.c) - {WIDTH}, {BLOCK}), o -> {block}), g -> {ends}))"
    joined = "transform(array(filter(transform(w, z -> z.e), e -> e is not null)), es -> transform(filter(transform(w, z -> z.s), s -> s is not null), (s, i) -> named_struct('s', s, 'e', es[i])))[0]"
    return f"transform(array(named_struct('c', split({c}, ''), 'f', {steps}, 't', {kind})), y -> transform(array({every}), w -> {joined})[0])[0]"


def spans(text: str = "text") -> Column:
    """All spans of a text: array of (s, kind number, e), by start, kind, end."""
    base = [(k, _pieces(text, p, wanted)) for k, p, wanted in ((0, ASSIGN, "char_length(y.v) >= 6"), (1, ACCESS, "true"), (2, HEX, "true"))]
    found = ", ".join(f"transform({x}, z -> named_struct('s', z.s, 'k', {k}, 'e', z.e))" for k, x in base)
    # A group that is taken without giving back is matched in a loop, not by a call for each time.
    allowed = " or ".join(f"y.m rlike '{p.replace(')+[', ')++[')}'" for p in ALLOW)
    wanted = _pieces(text, CANDIDATE, f"not ({allowed})")
    added = f"flatten(transform({wanted}, c -> transform({_windows('c.m')}, z -> named_struct('s', c.s + z.s, 'k', 3, 'e', c.s + z.e))))"
    # m: the furthest end of a base span that starts no later.
    seen = _scan(f"array_sort(concat({found}, {added}))", "0", "if(x.k < 3, greatest(m, x.e), m)", "named_struct('x', x, 'new', x.k < 3 or m < x.e)", "struct<x:struct<s:int,k:int,e:int>,new:boolean>")
    return F.expr(f"transform(filter({seen}, y -> y.new), y -> y.x)")


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy."""
    found = documents(docs).withColumn("found", spans())
    count = lambda k: F.expr(f"cast(size(filter(found, x -> x.k = {k})) as bigint)")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    shown = lambda rows: F.expr(f"array_join(transform({rows}, x -> concat_ws(':', {names}[x.k], x.s, x.e)), ',')")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(shown("filter(found, x -> x.k < 3)"), 256).alias("base_sha256"), shown("found").alias("spans"), count(3).alias("n_entropy"),
    )
