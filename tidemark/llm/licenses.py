"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

A header is a line with a licence cue; a licence file is one named like one, or a text of which
header words are at least ``FILE_SHARE`` of all words.  Headers, and the whole text of files named like licences,
are vectors of term counts times a weight (the smoothed inverse frequency among the templates, in
thousandths, as a whole number).  The best cosine to a template of at least ``LEAST`` names the licence; ties go to the
smallest name.  Where the whole line is below that, its windows that hold a cue and are as long as a template (or as
one of the SPDX tags of ``TAGS``) are scored each, so words around a licence do not hide it; there at least
``WINDOW_LEAST`` names it, as shorter windows agree by chance more easily.  All sums are of whole numbers, so they do not depend on their order.

A file without a licence of its own takes that of its nearest ancestor directory that has a licence file.
Directories are made distinct before they are joined to their ancestors, so a directory
with a third of all files is joined once and reaches its files by one equi-join, in which hot directories are split.  Of several licence
files in a directory the best score counts, then the smallest path.

Null texts and paths count as empty (the empty path lies in the root directory).  Rows are handled one by one: repeated
rows give a row each.  Whole texts are read.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, spread_join, stored

TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "proprietary": ["All rights reserved", "Confidential and proprietary. All rights reserved"],
}
CUE = "licen[cs]e|copyright|spdx|permission is hereby|redistribution|rights reserved|free software|creative commons|mozilla public|released under"
NAMED = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
TERM = "[a-z0-9]+"
LEAST, WINDOW_LEAST, FILE_SHARE = 600_000, 900_000, 0.1
#: Tags that stand for a licence, matched by windows alone.
TAGS = {
    "Apache-2.0": "Apache-2.0", "BSD-3-Clause": "BSD-3-Clause", "CC-BY-4.0": "CC-BY-4.0", "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "GPL-2.0": "GPL-2.0", "GPL-3.0": "GPL-3.0", "MIT": "MIT", "MPL-2.0": "MPL-2.0",
}


def vectors() -> tuple[dict[str, int], int, list[tuple[str, dict[str, int], int]]]:
    """Weights of the terms, that of all others, and the templates as (name, weighted counts, square of the norm)."""
    docs = [(name, re.findall(TERM, text.lower())) for name, texts in sorted(TEMPLATES.items()) for text in texts]
    n = len(docs)
    seen = {t: sum(t in d for _, d in docs) for t in sorted({t for _, d in docs for t in d})}
    weigh = lambda df: round(1000 * (math.log((1 + n) / (1 + df)) + 1))
    weights = {t: weigh(df) for t, df in seen.items()}
    out = []
    for name, d in docs:
        v = {t: d.count(t) * weights[t] for t in sorted(set(d))}
        out.append((name, v, sum(x * x for x in v.values())))
    return weights, weigh(0), out


def _map(v: dict[str, int]) -> str:
    return "map(" + ", ".join(f"'{t}', {x}L" for t, x in v.items()) + ")"


def _vector(terms: str, body: str) -> str:
    """``body`` with v: the known terms among ``terms`` with weighted counts, and q: the square of the whole norm.

    Known terms are few and are counted each; all others weigh the same, so their squares are summed over the sorted terms in one pass.
    ``w`` is the map of weights.
    """
    other = vectors()[1]
    known = "transform(array_distinct(kn), t -> named_struct('t', t, 'x', cast(size(filter(kn, u -> u = t)) as bigint) * try_element_at(w, t)))"
    rest = """aggregate(array_sort(un), named_struct('p', '', 'c', 0L, 'q', 0L),
        (a, t) -> if(t = a.p, named_struct('p', a.p, 'c', a.c + 1, 'q', a.q), named_struct('p', t, 'c', 1L, 'q', a.q + a.c * a.c)), a -> a.q + a.c * a.c)"""
    square = f"aggregate(v, cast({rest} as decimal(38,0)) * {other * other}, (a, y) -> cast(a + cast(y.x as decimal(18,0)) * y.x as decimal(38,0)))"
    split = f"named_struct('kn', filter({terms}, t -> try_element_at(w, t) is not null), 'un', filter({terms}, t -> try_element_at(w, t) is null))"
    return f"transform(array({split}), s -> transform(array({known.replace('kn', 's.kn')}), v -> transform(array(cast({square.replace('un)', 's.un)')} as double)), q -> {body})[0])[0])[0]"


def _best(terms: str) -> str:
    """{score, name} of the best template for an array of terms; the name with its sign turned, so that the greatest is the smallest."""
    weights, _, templates = vectors()
    scores = ", ".join(
        f"named_struct('score', cast(floor(cast(aggregate(v, 0L, (a, y) -> a + y.x * coalesce(try_element_at({_map(v)}, y.t), 0L)) as double) / sqrt(q * {float(n2)!r}D) * 1000000D + 0.5D) as bigint), 'no', {-i})"
        for i, (_, v, n2) in enumerate(templates)
    )
    return f"if(size({terms}) = 0, named_struct('score', 0L, 'no', 0), transform(array({_map(weights)}), w -> {_vector(terms, f'array_max(array({scores}))')})[0])"


def tagged() -> list[tuple[str, dict[str, int], int]]:
    """The templates and behind them the SPDX tags, as ``vectors`` gives them."""
    weights, other, out = vectors()
    for name, tag in sorted(TAGS.items()):
        terms = re.findall(TERM, f"SPDX-License-Identifier: {tag}".lower())
        v = {t: terms.count(t) * weights.get(t, other) for t in sorted(set(terms))}
        out.append((name, v, sum(x * x for x in v.values())))
    return out


#: Most words that a cue stands in, and windows that a line may need are looked at once for each different text.
CUE_WORDS = max(c.count(" ") for c in CUE.split("|")) + 1


def _window(terms: str) -> str:
    """{score, name} of the best window, as ``_best`` gives them.

    Places of cues are found first, by at most ``CUE_WORDS`` words, so windows without one are never cut out.
    """
    weights, other, _ = vectors()
    sizes = [len(re.findall(TERM, text.lower())) for _, texts in sorted(TEMPLATES.items()) for text in texts]
    sizes += [len(re.findall(TERM, f"SPDX-License-Identifier: {tag}".lower())) for _, tag in sorted(TAGS.items())]
    all_of = ", ".join(f"named_struct('no', {-i}, 'len', {size}, 'n2', {float(n2)!r}D, 'm', {_map(v)})" for i, ((_, v, n2), size) in enumerate(zip(tagged(), sizes, strict=True)))
    vec = f"transform(array_distinct(u), t -> named_struct('t', t, 'x', cast(size(filter(u, z -> z = t)) as bigint) * coalesce(try_element_at(w, t), {other}L)))"
    dot = "aggregate(v, 0L, (a, y) -> a + y.x * coalesce(try_element_at(p.m, y.t), 0L))"
    square = "aggregate(v, 0L, (a, y) -> a + y.x * y.x)"
    score = f"transform(array({vec}), v -> cast(floor(cast({dot} as double) / sqrt(cast({square} as double) * p.n2) * 1000000D + 0.5D) as bigint))[0]"
    # A cue of k words from i on lies in the windows that start from i + k - len to i.
    found = ", ".join(f"if(i + {k - 1} <= size({terms}) and array_join(slice({terms}, i, {k}), ' ') rlike '{CUE}', {k}, null)" for k in range(1, CUE_WORDS + 1))
    spots = f"filter(transform(sequence(1, size({terms})), i -> named_struct('i', i, 'k', coalesce({found}))), c -> c.k is not null)"
    starts = f"array_distinct(flatten(transform(filter(cs, c -> c.k <= p.len), c -> sequence(greatest(1, c.i + c.k - p.len), least(c.i, size({terms}) - p.len + 1)))))"
    cut = f"transform(array_distinct(transform({starts}, i -> array_join(slice({terms}, i, p.len), ' '))), u -> split(u, ' '))"
    each = f"transform(filter(array({all_of}), p -> p.len <= size({terms})), p -> named_struct('score', coalesce(array_max(transform({cut}, u -> {score})), 0L), 'no', p.no))"
    return f"transform(array({_map(weights)}), w -> transform(array({spots}), cs -> coalesce(array_max({each}), named_struct('score', 0L, 'no', 0)))[0])[0]"


def own_license() -> str:
    """SQL for {score, license, is_file} of ``__tm_low``: what a file's headers (and, by its name, whole text) say."""
    names = [name for name, _, _ in tagged()]
    terms = f"regexp_extract_all(line, '{TERM}', 0)"
    heads = f"filter(split(x.t, '\\n', -1), line -> line rlike '{CUE}')"
    parts = "concat(h, if(x.named, array(x.t), array()))"
    # A window counts only from its own limit on, so lines that name no licence keep the score of the whole.
    best = f"transform(array({_best('ts')}), b -> if(b.score >= {LEAST}, b, transform(array({_window('ts')}), o -> if(o.score >= {WINDOW_LEAST}, o, b))[0]))[0]"
    per = f"transform({parts}, line -> transform(array({terms}), ts -> {best})[0])"
    top = f"coalesce(array_max({per}), named_struct('score', 0L, 'no', 0))"
    share = f"aggregate(h, 0, (a, line) -> a + size({terms})) >= {FILE_SHARE} * size(regexp_extract_all(x.t, '{TERM}', 0))"
    array = "array(" + ", ".join(f"'{n}'" for n in names) + ")"
    made = f"transform(array({top}), b -> named_struct('score', b.score, 'license', if(b.score >= {LEAST}, {array}[-b.no], null), 'is_file', b.score >= {LEAST} and (x.named or {share})))[0]"
    none = "named_struct('score', 0L, 'license', cast(null as string), 'is_file', false)"
    return f"transform(__tm_low, x -> if(not x.named and not x.t rlike '{CUE}', {none}, transform(array({heads}), h -> {made})[0]))[0]"


def scan(files: DataFrame) -> DataFrame:
    """``files`` (doc_id, path, text) as doc_id, path, own_license, score, is_file, license, license_dir."""
    path = F.coalesce("path", F.lit(""))
    low = F.array(F.struct(ascii_lower(F.coalesce("text", F.lit(""))).alias("t"), path.rlike(NAMED).alias("named")))
    base = files.select("doc_id", path.alias("path"), low.alias("__tm_low")).select("doc_id", "path", F.expr(own_license()).alias("own"))
    base = base.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", ""))
    # Three steps read this: the texts are scanned once, and a few columns without them are stored.
    rows = stored(base.select("doc_id", "path", "dir", "own.score", F.col("own.license").alias("own_license"), "own.is_file"))
    # The best score, and of those the smallest path.
    best = rows.where("is_file").groupBy("dir").agg(F.min_by("own_license", F.struct(-F.col("score"), F.col("path"), F.col("own_license"))).alias("license"))
    chain = F.expr("transform(sequence(0, size(split(dir, '/'))), i -> named_struct('depth', i, 'up', array_join(slice(split(dir, '/'), 1, i), '/')))")
    sizes = rows.groupBy("dir").agg(F.count("*").alias("rows"))
    dirs = sizes.select("dir", "rows", F.explode(F.when(F.col("dir") == "", F.expr("array(named_struct('depth', 0, 'up', ''))")).otherwise(chain)).alias("a")).select("dir", "rows", "a.depth", "a.up")
    near = dirs.join(best.select(F.col("dir").alias("up"), "license"), "up").groupBy("dir").agg(F.max_by(F.struct("license", "up"), "depth").alias("near"), F.first("rows").alias("rows"))
    out = spread_join(rows, near, ["dir"], "rows", rows.count(), "left")
    return out.select("doc_id", "path", "own_license", "score", "is_file", F.coalesce("own_license", "near.license").alias("license"), F.when(F.col("own_license").isNull(), F.col("near.up")).alias("license_dir"))


def document_licenses(docs: DataFrame) -> DataFrame:
    """``scan`` over documents, filed as source/lang/doc_id."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), "text"))
