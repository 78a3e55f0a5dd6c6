"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLES["op10_decontamination"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l,
         unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i : i + least(10, len(w)) - 1], ' '))) AS g
  FROM items WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
spots AS (
  SELECT rid, ls.l AS l, unnest(range(1, len(w) - ls.l + 2)) AS p, unnest(list_transform(range(1, len(w) - ls.l + 2), lambda i: array_to_string(w[i : i + ls.l - 1], ' '))) AS g
  FROM docs, (SELECT DISTINCT l FROM grams) AS ls WHERE len(w) >= ls.l),
hits AS (SELECT spots.rid, spots.p, spots.l, grams.item_id FROM spots JOIN grams USING (g, l)),
covered AS (SELECT rid, count(DISTINCT i) AS n FROM (SELECT rid, unnest(range(p, p + l)) AS i FROM hits) GROUP BY rid),
named AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM hits WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""


def _secrets_sql() -> str:
    from tidemark.llm import secrets as S

    assign = S.ASSIGN.replace("'", "''")
    split = lambda k, p, g, test: f"SELECT rid, {k} AS k, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {g}) AS vs, string_split_regex(t, '{p}') AS gs FROM d"
    kinds = " UNION ALL ".join(split(k, p, g, None) for k, p, g in ((0, assign, 2), (1, S.ACCESS, 0), (2, S.HEX, 0), (3, S.CANDIDATE, 0)))
    allowed = " OR ".join(f"regexp_matches(m, '{p}')" for p in S.ALLOW)
    names = "[" + ", ".join(f"'{k}'" for k in S.KINDS) + "]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
k AS ({kinds}),
u AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM k WHERE len(ms) > 0),
at AS (SELECT rid, k, ms[i] AS m, vs[i] AS v, CAST(list_sum(list_transform(gs[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM u),
base AS (SELECT rid, k, s, s + length(m) AS e FROM at WHERE k < 3 AND (k > 0 OR length(v) >= 6)),
c AS (SELECT rid, s, m, CASE WHEN regexp_matches(m, '^[0-9A-Fa-f]+$') THEN {S.MOST["hex"]} WHEN regexp_matches(m, '[0-9]') THEN {S.MOST["mixed"]} ELSE {S.MOST["alpha"]} END AS most
      FROM at WHERE k = 3 AND NOT ({allowed})),
w AS (SELECT rid, s, most, p, string_split(substring(m, p + 1, {S.WIDTH}), '') AS x FROM (SELECT *, unnest(range(0, length(m) - {S.WIDTH - 1})) AS p FROM c)),
hit AS (SELECT rid, s, p FROM w WHERE list_sum(list_transform(list_distinct(x), lambda y: {S.STEP}[len(list_filter(x, lambda z: z = y)) + 1])) <= most),
cutp AS (SELECT *, CASE WHEN lag(p) OVER (PARTITION BY rid, s ORDER BY p) >= p - {S.WIDTH} THEN 0 ELSE 1 END AS new FROM hit),
isle AS (SELECT *, sum(new) OVER (PARTITION BY rid, s ORDER BY p) AS g FROM cutp),
added AS (SELECT rid, 3 AS k, s + min(p) AS s, s + max(p) + {S.WIDTH} AS e FROM isle GROUP BY rid, isle.s, g),
ent AS (SELECT * FROM added a WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = a.rid AND b.s <= a.s AND b.e >= a.e)),
every AS (SELECT rid, k, s, e FROM base UNION ALL SELECT rid, k, s, e FROM ent),
per AS (SELECT rid, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3,
  string_agg(({names})[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER (k < 3) AS b, string_agg(({names})[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS sp FROM every GROUP BY rid)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(sp, '') AS spans, coalesce(n3, 0) AS n_entropy
FROM d LEFT JOIN per USING (rid)
""".replace("\nat AS", "\nspot AS").replace("FROM at ", "FROM spot ")


ORACLES["op1_secret_scan"] = _secrets_sql()


def _urls_sql() -> str:
    from tidemark.llm import urlfilter as U

    shape, pad, letters = r"(?s)^.*?://([^/?#]*)([^?#]*)", U.OTHER * 3, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fits = lambda rule: f"((host = '{rule[: rule.index('/')]}' OR ends_with(host, '.{rule[: rule.index('/')]}')) AND starts_with(path, '{rule[rule.index('/') :]}'))"
    longest = sorted(U.RULES, key=lambda r: -len(r[0]))
    case = lambda i: "CASE " + " ".join(f"WHEN {fits(r[0])} THEN '{r[i]}'" for r in longest) + " END"
    n = lambda c: f"CAST(coalesce({c}, 0) AS DOUBLE)"

    def chance(k: str) -> str:
        p = "CAST(0.03125 AS DOUBLE)"
        for seen, context in ((f"g1{k}", f"CAST(t{k} AS DOUBLE)"), (f"g2{k}", n(f"x1{k}")), (f"g3{k}", n(f"x2{k}")), (f"g4{k}", n(f"x3{k}"))):
            p = f"(({n(seen)} + CAST(2.0 AS DOUBLE) * {p}) / ({context} + CAST(2.0 AS DOUBLE)))"
        return p

    parts = ((1, 3, "x3"), (2, 3, "g3"), (2, 2, "x2"), (3, 2, "g2"), (3, 1, "x1"), (4, 1, "g1"))
    tables = ",\n".join(f"{x} AS (SELECT substring(g, {s}, {l}) AS {x}, sum(a) AS {x}a, sum(b) AS {x}b FROM c4 GROUP BY 1)" for s, l, x in parts)
    joins = " ".join(f"LEFT JOIN {x} ON {x}.{x} = substring(grams.g, {s}, {l})" for s, l, x in parts)
    step, half = U.SCALE // 64, U.BINS // 2
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(coalesce(url, ''), '{shape}', 1), '{letters}', '{letters.lower()}') AS host, regexp_extract(coalesce(url, ''), '{shape}', 2) AS path,
    '{pad}' || regexp_replace(translate(coalesce(url, ''), '{letters}123456789', '{letters.lower()}000000000'), '[^a-z0/.\\-?]', '~', 'g') AS sym, substring(md5(coalesce(url, '')), 1, 2) < '{U.HELD}' AS held FROM pages),
ruled AS (SELECT *, {case(0)} AS rule, {case(1)} AS said FROM base),
pos AS (SELECT rid, said, held, unnest(list_transform(range(1, length(sym) - 2), lambda i: substring(sym, i, 4))) AS g FROM ruled),
c4 AS (SELECT g, count(*) FILTER (said = 'allow') AS a, count(*) FILTER (said = 'block') AS b FROM pos WHERE said IS NOT NULL AND NOT held GROUP BY g),
{tables},
tot AS (SELECT coalesce(sum(a), 0) AS ta, coalesce(sum(b), 0) AS tb FROM c4),
grams AS (SELECT DISTINCT g FROM pos),
ratios AS (SELECT grams.g, CASE WHEN ta > 0 AND tb > 0 THEN CAST(floor(ln({chance("a")} / {chance("b")}) / ln(CAST(2.0 AS DOUBLE)) * {U.SCALE} + 0.5) AS BIGINT) ELSE 0 END AS r
  FROM (SELECT grams.g, c4.a AS g4a, c4.b AS g4b FROM grams LEFT JOIN c4 USING (g)) AS grams {joins} CROSS JOIN tot),
per AS (SELECT rid, CAST(floor(CAST(sum(r) AS DOUBLE) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS score FROM pos JOIN ratios USING (g) GROUP BY rid),
done AS (SELECT ruled.*, coalesce(score, 0) AS score FROM ruled LEFT JOIN per USING (rid)),
h AS (SELECT greatest(-{half}, least({half}, CAST(floor(CAST(score AS DOUBLE) / {step}) AS BIGINT))) AS q, said FROM done WHERE held AND said IS NOT NULL),
hn AS (SELECT count(*) FILTER (said = 'allow') AS na, count(*) FILTER (said = 'block') AS nb FROM h),
lim AS (SELECT q, (SELECT count(*) FROM h WHERE h.said = 'allow' AND h.q < s.q) * nb + (SELECT count(*) FROM h WHERE h.said = 'block' AND h.q >= s.q) * na AS cost, na, nb FROM (SELECT unnest(range(-{half}, {half + 1})) AS q) AS s CROSS JOIN hn),
low AS (SELECT min(q) AS q1, any_value(cost) AS c FROM lim WHERE na > 0 AND nb > 0 AND cost = (SELECT min(cost) FROM lim)),
high AS (SELECT q1, coalesce((SELECT min(q) - 1 FROM lim WHERE q > q1 AND cost > c), {half}) AS q2 FROM low),
best AS (SELECT coalesce((SELECT CAST(floor(CAST(q1 + q2 AS DOUBLE) / 2) AS BIGINT) * {step} FROM high), 0) AS at)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN score >= best.at THEN 'allow' ELSE 'block' END) AS verdict, CAST(score AS DOUBLE) / {float(U.SCALE)} AS score
FROM done CROSS JOIN best
"""


ORACLES["op3_url_filter"] = _urls_sql()

_LINE = r"trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'))"
ORACLES["op5_line_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, source, ls[i] AS line, i FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
k AS (SELECT *, CASE WHEN {_LINE} <> '' THEN {_LINE} END AS key FROM l),
bad AS (SELECT key, min((doc_id IS NULL, doc_id, i)) AS first FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT source) >= 8),
m AS (SELECT rid, i, line, bad.key IS NOT NULL AND (doc_id IS NULL, doc_id, i) IS DISTINCT FROM first AS gone FROM k LEFT JOIN bad USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (rid) GROUP BY rid
"""


def _licenses_sql() -> str:
    from tidemark.llm import licenses as L

    weights, other, templates = L.vectors()
    tw = ", ".join(f"('{t}', {x})" for t, x in weights.items())
    tv = ", ".join(f"({i}, '{name}', '{t}', {x}, {float(n2)!r})" for i, (name, v, n2) in enumerate(templates) for t, x in v.items())
    return rf"""
WITH tw(term, w) AS (VALUES {tw}), tv(no, name, term, x, n2) AS (VALUES {tv}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') || '/' || coalesce(lang, '') || '/' || coalesce(CAST(doc_id AS VARCHAR), '') AS path,
  coalesce(source, '') || '/' || coalesce(lang, '') AS dir, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
h AS (SELECT rid, line, i FROM (SELECT rid, ls[i] AS line, i FROM (SELECT rid, string_split(t, chr(10)) AS ls, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i FROM d)) WHERE regexp_matches(line, '{L.CUE}')),
tm AS (SELECT rid, i, term, count(*) AS tf FROM (SELECT rid, i, unnest(regexp_extract_all(line, '{L.TERM}')) AS term FROM h) GROUP BY ALL),
v AS (SELECT rid, i, term, tf * coalesce(w, {other}) AS x FROM tm LEFT JOIN tw USING (term)),
q AS (SELECT rid, i, sum(x * x) AS q FROM v GROUP BY ALL),
s AS (SELECT v.rid, v.i, no, any_value(name) AS name, CAST(floor(CAST(sum(v.x * tv.x) AS DOUBLE) / sqrt(CAST(any_value(q.q) AS DOUBLE) * CAST(any_value(n2) AS DOUBLE)) * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS score
  FROM v JOIN tv USING (term) JOIN q ON q.rid = v.rid AND q.i = v.i GROUP BY v.rid, v.i, no),
top AS (SELECT rid, score, name FROM s QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, no) = 1),
n AS (SELECT rid, sum(len(regexp_extract_all(line, '{L.TERM}'))) AS n FROM h GROUP BY rid),
o AS (SELECT d.rid, doc_id, path, dir, CASE WHEN score >= {L.LEAST} THEN name END AS own_license, coalesce(score, 0) AS score,
  coalesce(score, 0) >= {L.LEAST} AND n >= {L.FILE_SHARE} * len(regexp_extract_all(t, '{L.TERM}')) AS is_file FROM d LEFT JOIN top USING (rid) LEFT JOIN n USING (rid)),
b AS (SELECT dir, own_license AS license FROM o WHERE is_file QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, own_license) = 1),
up AS (SELECT DISTINCT dir, dir AS up, 2 AS depth FROM o UNION SELECT DISTINCT dir, string_split(dir, '/')[1], 1 FROM o UNION SELECT DISTINCT dir, '', 0 FROM o),
near AS (SELECT up.dir, up.up, b.license FROM up JOIN b ON b.dir = up.up QUALIFY row_number() OVER (PARTITION BY up.dir ORDER BY depth DESC) = 1)
SELECT doc_id, path, own_license, score, coalesce(is_file, false) AS is_file, coalesce(own_license, near.license) AS license, CASE WHEN own_license IS NULL THEN near.up END AS license_dir
FROM o LEFT JOIN near USING (dir)
"""


ORACLES["op6_license_scan"] = _licenses_sql()
