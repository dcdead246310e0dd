"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ledgerloom.llm import licenses

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

_DECONTAMINATE = rf"""
WITH d AS (
  SELECT doc_id, rn, coalesce({_WORDS.format('text')}, []) AS w
  FROM (SELECT doc_id, text, row_number() OVER () AS rn FROM documents)
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win),
shown AS (
  SELECT rn, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT rn, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), hit AS (SELECT s.rn, s.i, s.n, win.item FROM shown s JOIN win USING (n, t)),
words AS (SELECT rn, count(*) AS n_hit FROM (SELECT DISTINCT rn, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rn),
items AS (
  SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rn, item FROM hit) GROUP BY rn
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN items USING (rn)
"""

_EXACT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

_MIX = """
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (
  SELECT source, n, CASE WHEN source IN ('src0', 'src3', 'src6', 'src9') THEN 2.0::DOUBLE
                         WHEN source = 'src17' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS w FROM n
),
r AS (SELECT source, w * (sum(n) OVER () / sum(w) OVER ()) / n AS rate FROM w),
d AS (
  SELECT documents.*, rate,
    ('0x' || substr(md5(concat_ws('|', '20240', '1', doc_id::VARCHAR, text)), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM documents JOIN r USING (source)
),
p AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM r
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM p WHERE k < 60
),
drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.rate, (SELECT count(*) FROM p WHERE p.source = d.source AND p.c <= d.u)::INTEGER AS copies FROM d
),
x AS (SELECT *, unnest(range(1, copies + 1))::INTEGER AS copy_no FROM drawn WHERE copies > 0)
SELECT *, ('0x' || substr(md5(concat_ws('|', '20240 place', copy_no::VARCHAR, doc_id::VARCHAR, text)), 1, 13))::BIGINT::DOUBLE
          / 4503599627370496 AS position FROM x
"""

_DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT rn, lang, source,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM d
),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT rn) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
every AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n, 1 + CAST(1000000000 * (n + 1) // (CAST(sum(n) OVER (PARTITION BY lang, source) AS BIGINT) + v) AS BIGINT) AS p
  FROM every JOIN v USING (lang)
),
whole AS (
  SELECT lang, term, 1 + CAST(1000000000 * (CAST(n AS BIGINT) + 1) // (CAST(sum(n) OVER (PARTITION BY lang) AS BIGINT) + v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM every GROUP BY lang, term) JOIN v USING (lang)
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(apart.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
) WHERE part = 'pair' OR rank <= 200
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    text = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    text = f"regexp_replace({text}, {_quoted(licenses.DROPPED)}, '', 'g')"
    for other, one in licenses.EQUIVALENT:
        text = f"replace({text}, '{other}', '{one}')"
    lines = f"string_split(regexp_replace({text}, {_quoted(licenses.PUNCTUATION)}, ' ', 'g'), chr(10))"
    return f"list_filter(list_transform({lines}, lambda x: trim(x)), lambda x: x <> '')"


_LICENSES = f"""
WITH texts (license_id, text) AS (VALUES {', '.join(f'({_quoted(i)}, {_quoted(t)})' for i, t in (*licenses.LICENSES, *licenses.NOTICES))}),
known AS (SELECT license_id, sha256(array_to_string({_canonical('text')}, ' ')) AS digest FROM texts),
d AS (SELECT row_number() OVER () AS rn, doc_id, {_canonical('text')} AS lines FROM documents),
u AS (SELECT rn, doc_id, sha256(array_to_string(lines, ' ')) AS digest, unnest(lines) AS line FROM d),
n AS (
  SELECT rn, string_agg(license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT DISTINCT rn, license_id FROM u JOIN known ON sha256(line) = known.digest) GROUP BY rn
),
w AS (SELECT rn, doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM d)
SELECT doc_id, w.digest, known.license_id, coalesce(notices, '') AS notices
FROM w LEFT JOIN n USING (rn) LEFT JOIN (SELECT digest, min(license_id) AS license_id FROM known GROUP BY digest) known ON known.digest = w.digest
"""

ORACLES: dict[str, str] = {
    "op1_decontaminate": _DECONTAMINATE,
    "op6_mix": _MIX,
    "op9_licenses": _LICENSES,
    "op10_exact_dedup": _EXACT,
    "op11_divergence": _DIVERGENCE,
}
