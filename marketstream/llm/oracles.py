"""DuckDB twins of the corpus queries that SQL can express."""

from .source_mixing import LEAST_PARTS, PART_ROWS, Mixture

_MIXTURE = Mixture()
_WORD = r"[^\x20\x09-\x0D]+"

_MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS size,
         md5(concat_ws(':', '{_MIXTURE.seed}', CAST(doc_id AS VARCHAR))) AS ord
  FROM documents
),
parts AS (SELECT greatest({LEAST_PARTS}, CAST(ceil(count(*) / {PART_ROWS}) AS BIGINT)) AS n FROM sized),
sources AS (
  SELECT source, sum(size) AS words,
         {list(_MIXTURE.weights)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_MIXTURE.weights)} + 1] AS w
  FROM sized GROUP BY source
),
wanted AS (SELECT CAST({_MIXTURE.share} AS DOUBLE) * sum(words) AS words FROM sources),
-- Sources by how soon they are full; the first k full ones leave this level for the others.
filled AS (
  SELECT source, words, w, {_MIXTURE.most_copies} * words / w AS full_at,
         ((SELECT words FROM wanted)
          - coalesce(sum({_MIXTURE.most_copies} * words) OVER before, 0)) / sum(w) OVER rest AS level
  FROM sources
  WINDOW before AS (ORDER BY {_MIXTURE.most_copies} * words / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY {_MIXTURE.most_copies} * words / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
final AS (SELECT min_by(level, full_at) AS level FROM filled WHERE full_at >= level),
targets AS (
  SELECT source, words, least(CAST({_MIXTURE.most_copies} * words AS DOUBLE), w * final.level) AS target
  FROM sources, final
),
placed AS (
  SELECT s.doc_id, s.size, t.words, t.target,
         row_number() OVER (
           PARTITION BY s.source
           ORDER BY length(CAST(s.size AS VARCHAR)) * 100 + CAST(substr(CAST(s.size AS VARCHAR), 1, 2) AS INTEGER),
                    CAST('0x' || substr(s.ord, 1, 8) AS BIGINT) % parts.n, s.ord, s.size) AS place,
         CASE WHEN t.words > 0 THEN t.target / t.words ELSE 0 END AS expected
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, parts
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(words AS BIGINT) AS source_size, target,
       CAST(size * least(floor(place * expected + {_MIXTURE.offset!r})
                         - floor((place - 1) * expected + {_MIXTURE.offset!r}), {_MIXTURE.most_copies}) AS BIGINT) AS taken
FROM placed"""

# crc32 of a text, byte by byte with the usual table; unsigned.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i)))"""


def _crc32(text: str) -> str:
    """SQL for crc32 of a text column; needs ``crc_table`` beside it."""
    code = f"CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT)"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: {code})"
    step = "lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {step}))"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_EXACT = f"""
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256,
         translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS norm
  FROM documents
),
groups AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY norm)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256
FROM texts JOIN groups USING (norm)"""

# A word and its near words: equal lengths with one place that differs, or one letter more or less.
_SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
  FROM documents
),
counted AS (SELECT id || ':' || run AS named, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY id, run),
coded AS (SELECT run, k, {_crc32("named")} AS h FROM counted, crc_table),
results AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, k
  FROM coded
),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM results GROUP BY word HAVING sum(k) >= 5 AND length(word) >= 6),
-- Near words share what is left after some letter is taken out of the one, the other or both.
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n AS b_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
),
near AS (
  SELECT a AS word, CAST(count(*) AS BIGINT) AS n_near, max(b_n) AS best_n FROM pairs GROUP BY a
),
best AS (SELECT a AS word, min(b) AS best FROM pairs JOIN near ON a = near.word AND b_n = best_n GROUP BY a),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near ON w.word = near.word LEFT JOIN best ON w.word = best.word
),
steps AS (
  SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM forms
  UNION ALL
  SELECT s.word, coalesce(f.form, f.word), f.form IS NULL FROM steps s JOIN forms f ON s.root = f.word WHERE NOT s.done
)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON f.word = s.word WHERE s.done"""

_TRIE = f"""
WITH RECURSIVE {_CRC_TABLE},
own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
shared AS (
  SELECT conv_id, turns, CAST({_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM own, crc_table
),
whole AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 100
),
prefixes AS (
  SELECT conv_id, d, turns[1:d] AS node, turns[1:d - 1] AS above, len(turns) = d AS ends,
         CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS size
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM whole)
),
nodes AS (
  SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved, min(above) AS above,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM prefixes GROUP BY d, node
),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.above = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.above
),
-- Every node goes to all its ancestors: a node is named by its depth and its smallest member.
up AS (
  SELECT conv_id, d, parent_conv_id AS p, d AS at_d, conv_id AS at_conv, saved, CAST(n_children = 0 AS BIGINT) AS leaf FROM linked
  UNION ALL
  SELECT l.conv_id, l.d, l.parent_conv_id, l.d, l.conv_id, u.saved, u.leaf
  FROM up u JOIN linked l ON l.d = u.at_d - 1 AND l.conv_id = u.p
),
sums AS (SELECT at_d AS d, at_conv AS conv_id, sum(saved) AS saved, sum(leaf) AS leaves FROM up GROUP BY 1, 2)
SELECT l.conv_id, CAST(l.d AS BIGINT) AS depth, l.parent_conv_id, CAST(l.n_convs AS BIGINT) AS n_convs,
       CAST(l.n_children AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN sums s ON l.d = s.d AND l.conv_id = s.conv_id"""

ORACLES: dict[str, str] = {
    "op4_source_mixing": _MIXING,
    "op11_exact_dedup": _EXACT,
    "op12_spelling_variants": _SPELLING,
    "op13_conversation_trie": _TRIE,
}
