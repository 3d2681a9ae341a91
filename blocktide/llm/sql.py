"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from blocktide.llm.decontamination import BETWEEN
from blocktide.llm.licences import GAP, OVERRIDES, RULES, SENTENCES, SENTENCE_END, rule_pattern

PREFERENCE = """
WITH t AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations),
last AS (SELECT pair_id, max(turn) AS last FROM t WHERE role = 'assistant' GROUP BY pair_id),
chosen AS (SELECT t.*, last.last FROM t JOIN last USING (pair_id) WHERE turn <= last.last),
rejected AS (
  SELECT pair_id, turn, role, last,
    CASE WHEN turn = last AND role = 'assistant' THEN left(text, length(text) // 2) ELSE text END AS text
  FROM chosen),
c AS (SELECT DISTINCT pair_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
      FROM chosen WHERE pair_id IS NOT NULL AND turn IS NOT NULL),
r AS (SELECT DISTINCT pair_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
      FROM rejected WHERE pair_id IS NOT NULL AND turn IS NOT NULL),
odd AS ((SELECT * FROM c EXCEPT SELECT * FROM r) UNION ALL (SELECT * FROM r EXCEPT SELECT * FROM c)),
cut AS (SELECT pair_id, min(turn) AS cut FROM odd GROUP BY pair_id),
parts AS (
  SELECT CASE WHEN cut IS NULL OR turn < cut THEN 'prompt' ELSE 'chosen' END AS part, c.*
  FROM c LEFT JOIN cut USING (pair_id)
  UNION ALL
  SELECT 'rejected', r.* FROM r JOIN cut USING (pair_id) WHERE turn >= cut)
SELECT pair_id, part, turn::BIGINT AS turn,
  row_number() OVER (PARTITION BY pair_id, part, turn ORDER BY role, text) - 1 AS ord,
  role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 ELSE 0 END::BIGINT AS loss_start,
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + length(text) + 12 ELSE 0 END::BIGINT
    AS loss_end
FROM parts
"""


def _licences() -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    names = sorted({r[0] for r in RULES})
    hits = {
        n: " OR ".join(
            f"regexp_matches(tags, '{rule_pattern(ids, slack)}')" for m, ids, slack in RULES if m == n
        )
        for n in names
    }
    meant = {n: f"({hits[n]})" for n in names}
    for stronger, weaker in OVERRIDES:
        meant[weaker] += f" AND NOT ({hits[stronger]})"
    cases = ", ".join(f"CASE WHEN {meant[n]} THEN '{n}' END" for n in names)
    return f"""
WITH known(said, id) AS (VALUES {known}),
lines AS (
  SELECT rowid AS r, doc_id,
    list_filter(list_transform(
      string_split(regexp_replace(lower(coalesce(text, '')), '{SENTENCE_END}', '\\1' || chr(10), 'g'), chr(10)),
      lambda s: trim(regexp_replace(s, '{GAP}', ' ', 'g'))), lambda s: s <> '') AS said
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
places AS (SELECT r, unnest(said) AS said, generate_subscripts(said, 1) AS pos FROM lines),
ids AS (SELECT r, list(id ORDER BY pos) AS ids FROM places JOIN known USING (said) GROUP BY r),
tagged AS (
  SELECT doc_id, said, coalesce(ids, []) AS ids,
    array_to_string(list_transform(coalesce(ids, []), lambda i: '<' || i || '>'), '') AS tags
  FROM lines LEFT JOIN ids USING (r))
SELECT doc_id, array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ',') AS licences,
  array_to_string(ids, ',') AS sentence_ids, len(said)::BIGINT AS n_sentences, len(ids)::BIGINT AS n_known
FROM tagged
"""


def _words(column: str) -> str:
    """ASCII letters in lower case, cut at ASCII that is no letter or digit."""
    lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(regexp_split_to_array({lower}, '{BETWEEN}'), lambda w: w <> '')"


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_words("text")} AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, array_to_string(w[s:s + 9], ' ') AS said, len(w[s:s + 9]) AS n FROM starts),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
grams AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS said FROM places),
hits AS (SELECT DISTINCT r, grams.n, s, item FROM grams JOIN wins ON grams.said = wins.said AND grams.n = wins.n),
covered AS (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM hits),
n_hit AS (SELECT r, count(*) AS n_hit FROM covered GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r)
"""

_SPACED = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
)

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
u AS (SELECT DISTINCT doc_id, g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM u AS a JOIN u AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
      WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)
"""

COLLOCATIONS = """
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, list_filter(regexp_split_to_array(said, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\\n\\x0B\\f\\r]')) AS said FROM documents)),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM p),
grams AS (SELECT lang, size, array_to_string(w[s:s + size - 1], ' ') AS phrase
          FROM starts, (VALUES (1), (2), (3), (4), (5)) AS sizes(size) WHERE s + size - 1 <= len(w)),
f AS (SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
         FROM f WHERE size > 1),
priced AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts AS c JOIN total AS t USING (lang)
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
least AS (SELECT * FROM priced QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ones AS (SELECT DISTINCT o.lang, array_to_string(o.w[i:j], ' ') AS phrase, o.a AS outer_f
  FROM (SELECT DISTINCT lang, size, a, w, unnest(range(1, size + 1)) AS i FROM cuts) AS o,
    LATERAL (SELECT unnest(range(o.i + 1, o.size + 1)) AS j) WHERE j - i + 1 < o.size),
kept AS (SELECT * FROM least AS a WHERE NOT EXISTS (
  SELECT 1 FROM inner_ones AS b WHERE b.lang = a.lang AND b.phrase = a.phrase AND 100 * b.outer_f >= 100 * a.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
  score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLE = {
    "op2_preference": PREFERENCE,
    "op6_licences": _licences(),
    "op8_jaccard": JACCARD,
    "op9_decontamination": DECONTAMINATION,
    "op11_collocations": COLLOCATIONS,
}
