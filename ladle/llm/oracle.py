"""DuckDB twins of the queries that SQL can express, written from the contracts and without the Spark code's filters.

Where a trained model, an ordered heap or a packing decides the rows there is no twin; tests hold
those queries against brute force, exact round trips or held-out rows.
"""

from __future__ import annotations

from ladle.llm.license_scan import BASE_PHRASES, TEMPLATES, THRESHOLD, WINDOWS, classes, need, supersets
from ladle.llm.mixing import CHUNK
from ladle.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS
from ladle.llm.url_filter import BINS, CALIBRATION, MAX_BIN, MILLION, ORDER, RULES

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE_WORD = r"[^\x20\x09-\x0D]+"


def _lowered(text: str) -> str:
    return f"translate({text}, {_A_TO_Z})"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def license_scan() -> str:
    """Every window against every template of its class, with no prefix, length or positional filter."""
    places = []
    for phrase, _ in BASE_PHRASES:
        here = " AND ".join(f"coalesce(w[i + {k}], '') = '{p}'" for k, p in enumerate(phrase.split()))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {here})")
    templates = ", ".join(f"({tid}, '{label}', {_list(sorted(set(text.split())))}, {need(len(set(text.split())), THRESHOLD)}, {window}, {above or '[]'}::INT[])"
                          for tid, ((label, text), window, above) in enumerate(zip(TEMPLATES, classes(TEMPLATES), supersets(TEMPLATES))))
    held = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(BASE_PHRASES))
    all_places = "list_concat(list_concat(p0, p1), list_concat(p2, p3))"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_lowered("coalesce(text, '')")} AS lower FROM documents),
ww AS (SELECT r, doc_id, regexp_extract_all(lower, '{_LICENSE_WORD}') AS w FROM t),
p AS (SELECT *, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM ww),
m AS (SELECT r, doc_id, len(w) AS n_words, {all_places} AS places, list_filter([{held}], lambda x: x IS NOT NULL) AS held FROM p),
templates(tid, label, tokens, least, size, above) AS (VALUES {templates}),
starts AS (SELECT r, w, size, unnest(range(0, greatest(CAST(ceil(len(w) / CAST(size // 4 AS DOUBLE)) AS BIGINT), 0))) AS k
           FROM ww, (SELECT unnest([{", ".join(map(str, WINDOWS))}]) AS size)),
windows AS (SELECT r, size, k, list_distinct(w[k * (size // 4) + 1:k * (size // 4) + size]) AS tokens FROM starts),
met AS (SELECT b.r, b.size, b.k, tid, label, above, len(list_intersect(b.tokens, t.tokens)) / CAST(len(t.tokens) AS DOUBLE) AS share
        FROM windows b JOIN templates t ON t.size = b.size AND len(list_intersect(b.tokens, t.tokens)) >= t.least),
own AS (SELECT * FROM met a WHERE NOT EXISTS (SELECT 1 FROM met o WHERE o.r = a.r AND o.size = a.size AND o.k = a.k AND list_contains(a.above, o.tid))),
g AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share, count(DISTINCT (size, k)) AS n_blocks FROM own GROUP BY r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(held)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(held, coalesce(g.labels, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(g.share, 0.0) END::DOUBLE AS score,
  CAST(coalesce(g.n_blocks, 0) AS BIGINT) AS n_blocks FROM m LEFT JOIN g ON g.r = m.r"""


def near_duplicates() -> str:
    """All pairs that share a shingle are counted; components are the closure of the links."""
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_A_TO_Z}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM t),
n AS MATERIALIZED (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
x AS MATERIALIZED (SELECT doc_id, hash(unnest(sh)) AS h FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
        WHERE 100 * c >= 85 * (na.n_shingles + nb.n_shingles - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
SELECT n.doc_id, n.n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id,
  n.doc_id = least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS kept
FROM n LEFT JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n_shingles"""


def poisson_mix(seed: int = 42) -> str:
    """The counts by a running sum of Poisson terms, a row per draw and term."""
    key = "coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))"
    return f"""
WITH c AS (SELECT source, count(*) AS n, sqrt(count(*)) AS weight FROM documents GROUP BY source),
r AS (SELECT source, weight / (SELECT sum(weight) FROM c) * CAST((SELECT sum(n) FROM c) AS DOUBLE) / n AS rate FROM c),
d AS (SELECT source, rate, greatest(1, CAST(ceil(rate / {CHUNK}) AS INTEGER)) AS draws FROM r),
k AS (SELECT *, rate / draws AS mean, CAST(ceil(rate / draws + 10.0 * sqrt(rate / draws) + 20.0) AS INTEGER) AS last FROM d),
p AS (SELECT *, list_transform(range(0, last + 1), lambda i: exp(i * ln(mean) - mean - lgamma(i + 1))) AS pmf FROM k),
f AS (SELECT *, list_transform(range(1, last + 2), lambda i: list_sum(pmf[1:i])) AS cdf FROM p),
j AS (SELECT documents.*, f.rate, f.cdf, f.draws, {key} AS key FROM documents JOIN f ON documents.source IS NOT DISTINCT FROM f.source),
m AS (SELECT *, list_sum(list_transform(range(1, draws + 1), lambda i: len(list_filter(cdf, lambda x:
        x <= CAST(('0x' || md5('{seed}:' || key || ':' || i)[1:13]) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))))) AS copies FROM j),
e AS (SELECT *, CAST(unnest(range(1, CAST(copies AS BIGINT) + 1)) AS INTEGER) AS copy FROM m)
SELECT doc_id, text, lang, source, n_chars, copy, CAST(('0x' || md5('shuffle-{seed}:' || key || ':' || copy)[1:15]) AS BIGINT) AS shuffle_key, rate FROM e"""


def quality_rules() -> str:
    """Counts by grouping windows; the rules as one condition, in no particular order."""
    letters = r"\p{L}"
    return f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, i, w[i:i + 2] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
rep AS (SELECT r, unnest([i, i + 1, i + 2]) AS pos FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT pos) AS n_repeat_words FROM rep GROUP BY r),
l AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_SPACE_WORD}')) AS lines FROM t),
b AS (SELECT t.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM t JOIN l USING (r) LEFT JOIN cov USING (r)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
        n_symbols > 0.25 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
        OR 2 * n_dup_lines > len(string_split(text, chr(10)))
        OR 2 * length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) > word_chars
        OR 3 * length(regexp_replace(text, '[^0-9]+', '', 'g')) > word_chars
        OR 2 * length(regexp_replace(text, '[^{letters}]+', '', 'g')) < word_chars
        OR (5 * len(list_distinct(w)) < n_words AND n_words < 400)
        OR 3 * len(regexp_extract_all(text, '(\\.\\.\\.|…)[ \\t]*(\\n|$)')) > len(string_split(text, chr(10)))
        OR 10 * len(regexp_extract_all(text, '(?m)^[ \\t]*[-•][ \\t]')) > 9 * len(string_split(text, chr(10))) AS rejected FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM v"""


def nearest(k: int = 5, every: int = 50) -> str:
    """Every query against every vector."""
    return f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
       WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) / (q.norm * c.norm) AS score
      FROM ok q JOIN ok c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % {every} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, byte by byte over a table of 256 (in ``crc_table``)."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            f"lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)")


def _edited(state: str, cost: str, letter: str) -> str:
    """A path (ten digits of cost, then its edits) with one more edit."""
    return f"(lpad(CAST(CAST(left({state}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({state}, 11) || {letter})"


def conversation_repair() -> str:
    """Row by row, the least (cost, edits) of each state as one text, in a recursive query."""
    u1 = f"least(u, {_edited('e', '2', chr(39) + 'I' + chr(39))}, {_edited('s', '2', chr(39) + 'I' + chr(39))}, {_edited('a', '2', chr(39) + 'I' + chr(39))})"
    kept = lambda c: f"CASE WHEN f.initial = '{c}' THEN 0 ELSE 2 END + f.cut"
    letter = lambda c: f"CASE WHEN f.initial = '{c}' THEN 'K' ELSE 'R' END"
    into_u = ", ".join(_edited("x." + s, kept("u"), letter("u")) for s in ("e", "s", "a1"))
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
ids AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
hit AS (SELECT i.k, c.turn, coalesce(c.role, ' ') AS role, coalesce(c.text, ' ') AS text,
         {_crc32("coalesce(CAST(c.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(c.turn AS VARCHAR), ' ')")} % 20 AS kind
       FROM conversations c JOIN ids i ON c.conv_id IS NOT DISTINCT FROM i.conv_id CROSS JOIN crc),
damaged AS (SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE kind <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS printed FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY n) > 1 AS again FROM numbered),
faults AS (SELECT k, n, turn, role, text, left(role, 1) AS initial, printed = '' AS blank, printed <> '' AND again AS duplicate,
         CASE WHEN printed <> '' AND NOT again AND right(printed, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut,
         lag(left(role, 1)) OVER (PARTITION BY k ORDER BY n) AS earlier FROM seen),
counts AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (WHERE earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS last
       FROM faults GROUP BY k),
walk AS (
  SELECT k, CAST(0 AS BIGINT) AS n, '0000000000' AS e, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM counts
  UNION ALL
  SELECT f.k, f.n, {_edited('x.e', '3', "'D'")},
    least({_edited('x.s', '3', "'D'")}, CASE WHEN NOT f.blank AND NOT f.duplicate AND f.initial = 's' THEN {_edited('x.e', 'f.cut', "'K'")} END),
    least({_edited('x.u1', '3', "'D'")}, CASE WHEN NOT f.blank AND NOT f.duplicate THEN least({into_u}) END),
    least({_edited('x.a1', '3', "'D'")}, CASE WHEN NOT f.blank AND NOT f.duplicate THEN {_edited('x.u1', kept('a'), letter('a'))} END)
  FROM (SELECT *, least(a, {_edited('u1', '2', "'I'")}) AS a1 FROM (SELECT *, {u1} AS u1 FROM walk)) x
  JOIN faults f ON f.k = x.k AND f.n = x.n + 1),
best AS (SELECT w.k, least(w.e, w.a1) AS path FROM (SELECT *, least(a, {_edited('u1', '2', "'I'")}) AS a1 FROM (SELECT *, {u1} AS u1 FROM walk)) w
         JOIN counts c ON c.k = w.k AND c.last = w.n),
edits AS (SELECT k, pos, substr(path, 10 + pos, 1) AS edit, length(replace(substr(path, 11), 'D', '')) AS made FROM
         (SELECT k, path, unnest(range(1, length(path) - 9)) AS pos FROM best)),
placed AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS n, count(*) FILTER (WHERE edit <> 'D') OVER w AS at FROM edits
         WINDOW w AS (PARTITION BY k ORDER BY pos)),
repaired AS (SELECT p.k, string_agg(CASE WHEN p.edit = 'K' THEN f.role WHEN (p.at + p.made) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
           CASE WHEN p.edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY p.pos) AS text
         FROM placed p LEFT JOIN faults f ON f.k = p.k AND f.n = p.n WHERE p.edit <> 'D' GROUP BY p.k)
SELECT i.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(CAST(c.truncated AS BIGINT), 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(CAST(left(b.path, 10) AS BIGINT), 0) AS cost,
  coalesce(substr(b.path, 11), '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM ids i LEFT JOIN counts c ON c.k = i.k LEFT JOIN best b ON b.k = i.k LEFT JOIN repaired r ON r.k = i.k"""


def url_filter() -> str:
    """Both models by plain grouping of every gram's contexts."""
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    whens = []
    for text, says in sorted(RULES, key=lambda r: -len(r[0])):
        name, slash, tail = text.partition("/")
        whens.append((f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + tail}')", text, says))
    case = lambda k: "CASE " + " ".join(f"WHEN {w[0]} THEN '{w[k]}'" for w in whens) + " END"
    levels = [f"""
p0 AS (SELECT s, (a + 1) / CAST(sum(a) OVER () + count(*) OVER () AS DOUBLE) AS pa, (r + 1) / CAST(sum(r) OVER () + count(*) OVER () AS DOUBLE) AS pr
       FROM (SELECT substr(gram, {ORDER + 1}, 1) AS s, sum(a) AS a, sum(r) AS r FROM counted GROUP BY ALL))"""]
    for k in range(1, ORDER + 1):
        p = lambda x: f"CASE WHEN all_{x} > 0 THEN ({x} + seen_{x} * p{x}) / CAST(all_{x} + seen_{x} AS DOUBLE) ELSE p{x} END AS p{x}"
        levels.append(f"""
p{k} AS (SELECT t AS s, {p('a')}, {p('r')} FROM (
         SELECT *, sum(a) OVER w AS all_a, sum(r) OVER w AS all_r, count(*) FILTER (WHERE a > 0) OVER w AS seen_a, count(*) FILTER (WHERE r > 0) OVER w AS seen_r
         FROM (SELECT substr(gram, {ORDER + 1 - k}, {k + 1}) AS t, sum(a) AS a, sum(r) AS r FROM counted GROUP BY ALL)
         WINDOW w AS (PARTITION BY substr(t, 1, {k}))) g JOIN p{k - 1} q ON q.s = substr(g.t, 2, {k}))""")
    return f"""
WITH urls AS (SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url FROM pages),
parts AS (SELECT row, page_id, url, {_lowered(f"regexp_extract({rest}, '^[^/?#]*')")} AS host,
           regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
ruled AS (SELECT *, {case(1)} AS rule, {case(2)} AS ruled, CAST('0x' || substr(md5(url), 1, 4) AS INT) % {CALIBRATION} = 0 AS held FROM parts),
padded AS (SELECT *, repeat(chr(2), {ORDER}) || {_lowered('url')} || chr(3) AS text FROM ruled),
grams AS (SELECT row, ruled, held, substr(text, CAST(place AS INT), {ORDER + 1}) AS gram FROM
           (SELECT row, ruled, held, text, unnest(range(1, length(text) - {ORDER - 1})) AS place FROM padded)),
counted AS (SELECT gram, count(*) FILTER (WHERE ruled = 'allow' AND NOT held) AS a, count(*) FILTER (WHERE ruled = 'block' AND NOT held) AS r
            FROM grams GROUP BY gram),
{",".join(levels)},
terms AS (SELECT s AS gram, CAST(round((ln(pa) - ln(pr)) * {MILLION}) AS BIGINT) AS term FROM p{ORDER}),
summed AS (SELECT row, CAST(sum(term) AS BIGINT) AS total, count(*) AS n_grams FROM grams JOIN terms USING (gram) GROUP BY row),
scored AS (SELECT r.*, n_grams, total / CAST(n_grams * {MILLION} AS DOUBLE) AS score FROM ruled r JOIN summed s ON s.row = r.row),
binned AS (SELECT *, greatest(least(CAST(floor(score * {BINS}) AS BIGINT), {MAX_BIN}), -{MAX_BIN}) AS bin FROM scored),
bins AS (SELECT bin, sum(good) AS good, sum(bad) AS bad FROM (
           SELECT bin, CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END AS good, CASE WHEN ruled = 'block' THEN 1 ELSE 0 END AS bad
           FROM binned WHERE held AND ruled IS NOT NULL UNION ALL SELECT 0, 0, 0) GROUP BY bin),
margins AS (SELECT bin, sum(good) OVER u * sum(bad) OVER () - sum(bad) OVER u * sum(good) OVER () AS margin FROM bins
            WINDOW u AS (ORDER BY bin DESC)),
chosen AS (SELECT bin AS least FROM margins ORDER BY margin DESC, abs(bin), bin LIMIT 1)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bin >= least THEN 'allow' ELSE 'block' END) AS verdict, score, n_grams
FROM binned CROSS JOIN chosen"""
