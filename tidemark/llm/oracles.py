"""DuckDB SQL of queries whose operators work another way: windows, strings, sets and places are compared as they are."""

from __future__ import annotations

from . import decontamination, licenses, near_dedup, substring_dedup, suffix_dedup

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_W = substring_dedup.WINDOW

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + {_W - 1}], ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - {_W - 1})) AS i FROM d)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {_W})) AS i FROM twice),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

_B = suffix_dedup.WINDOW
_BLOCK = 1000
#: Texts as hexadecimal digits, cut into overlapping blocks so that no window is looked for in a whole text.
SUFFIX_DEDUP = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
block AS (SELECT doc_id, b * {_BLOCK} AS pos, substr(h, b * {2 * _BLOCK} + 1, {2 * (_BLOCK + _B - 1)}) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // {2 * _BLOCK} + 1)) AS b FROM d)),
win AS (SELECT doc_id, pos + i AS p, substr(s, 2 * i + 1, {2 * _B}) AS x FROM (SELECT *, unnest(range(0, length(s) // 2 - {_B - 1})) AS i FROM block)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, md5_number(x) AS k FROM win) QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
run AS (SELECT doc_id, p, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (SELECT *, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {_B}, true) AS new FROM later)),
span AS (SELECT doc_id, g, min(p) AS a, max(p) + {_B} AS e FROM run GROUP BY ALL),
piece AS (
  SELECT doc_id, coalesce(lag(e) OVER w, 0) AS a, a AS e FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, coalesce(max(span.e), 0), any_value(length(h)) // 2 FROM d LEFT JOIN span USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (e - a)), '' ORDER BY a) AS k FROM piece JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(e - a) AS gone, count(*) AS spans FROM span GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_G = 4
NEAR_DEDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {_G - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) >= {_G} THEN generate_series(1, len(w) - {_G - 1}) WHEN len(w) > 0 THEN [1] ELSE [] END) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= {near_dedup.PERCENT} * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT DISTINCT a, a AS b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, doc_id)::BIGINT AS component_id, doc_id = coalesce(c, doc_id) AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


LICENSES = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_ALNUM.format(text=_LOWER)} AS w FROM documents),
word AS (SELECT r, unnest(w) AS x, unnest(range(0, len(w))) AS j FROM d),
phrase(x, label) AS (VALUES {_values(licenses.PHRASES.items())}),
base AS (SELECT r, j, label FROM (SELECT word.r, j, label, array_to_string(w[j + 1:j + len(string_split(phrase.x, ' '))], ' ') = phrase.x AS same FROM word JOIN phrase ON word.x = string_split(phrase.x, ' ')[1] JOIN d USING (r)) WHERE same),
b AS (SELECT r, count(*) AS n_base, min(j) AS first_word, max(j) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r),
template(t, label, notice, key) AS (VALUES {_values((k, *row) for k, row in enumerate(licenses.TEMPLATES))}),
place AS (SELECT t, unnest(string_split(notice, ' ')) AS x, unnest(range(0, len(string_split(notice, ' ')))) AS i FROM template),
voted AS (SELECT r, t, j - i AS start, count(*) AS c FROM word JOIN place USING (x) GROUP BY ALL),
shared AS (SELECT r, t, start, c / len(string_split(notice, ' ')) AS share, len(string_split(notice, ' ')) AS m, len(string_split(key, ' ')) AS k, label, key FROM voted JOIN template USING (t)),
found AS (
  SELECT r, label, share FROM (SELECT shared.*, w, greatest(start, 0) AS lo, least(start + m, len(w)) AS hi FROM shared JOIN d USING (r) WHERE share >= {licenses.SCORE})
  WHERE contains(' ' || array_to_string(w[greatest(lo - k, 0) + 1:least(hi + k, len(w))], ' ') || ' ', ' ' || key || ' ')),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM found) GROUP BY r),
f AS (SELECT r, max(share) AS share FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(share, CASE WHEN n_base > 0 THEN {licenses.BASE_SCORE} ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN f USING (r)
"""

_LEAST, _SHARE = decontamination.MIN_WORDS, decontamination.MIN_SHARE
#: A stretch that verification accepts has three words in a row that agree (two, in items of two and five words): four
#: words in five agree, so the agreeing ones can't all be apart. Diagonals are found by these, and then compared word by word.
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_ALNUM.format(text=_LOWER)} AS w FROM documents),
b AS (SELECT * FROM (SELECT item_id, row_number() OVER () AS k, {_ALNUM.format(text=_LOWER)} AS v FROM benchmark) WHERE len(v) > 0),
g AS (SELECT *, CASE len(v) WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 5 THEN 2 ELSE 3 END AS g FROM b),
seed AS (SELECT k, g, i, array_to_string(v[i + 1:i + g], ' ') AS s FROM (SELECT *, unnest(range(0, len(v) - g + 1)) AS i FROM g)),
part AS (SELECT r, g, j, array_to_string(w[j + 1:j + g], ' ') AS s FROM (SELECT r, w, g, unnest(range(0, len(w) - g + 1)) AS j FROM d, (SELECT DISTINCT g FROM g))),
diagonal AS (SELECT DISTINCT r, k, j - i AS dg FROM part JOIN seed USING (g, s)),
cmp AS (SELECT r, k, dg, len(v) AS m, len(w) AS n, least(len(v), {_LEAST}) AS least, list_filter(range(greatest(0, -dg), least(len(v), len(w) - dg)), lambda x: v[x + 1] = w[dg + x + 1]) AS same FROM diagonal JOIN d USING (r) JOIN b USING (k)),
ok AS (SELECT *, list_distinct(same || CASE WHEN dg >= 0 THEN [0] ELSE [] END) AS begins, list_distinct(same || CASE WHEN dg + m <= n THEN [m - 1] ELSE [] END) AS ends FROM cmp WHERE len(same) >= {_SHARE} * least - 1e-9),
pair AS (SELECT *, unnest(ends) AS e FROM (SELECT *, unnest(begins) AS a FROM ok)),
long AS (SELECT r, k, dg, a, e - a + 1 AS overlap, len(list_filter(same, lambda x: x >= a AND x <= e)) AS matched FROM pair WHERE e - a + 1 >= least),
best AS (SELECT * FROM long WHERE matched >= {_SHARE} * overlap - 1e-9 QUALIFY row_number() OVER (PARTITION BY r, k ORDER BY overlap DESC, matched DESC, dg + a, a) = 1)
SELECT doc_id, item_id, overlap::BIGINT AS overlap, matched::BIGINT AS matched, (dg + a)::BIGINT AS doc_word, a::BIGINT AS item_word FROM best JOIN d USING (r) JOIN b USING (k)
"""
