"""SQL for the queries whose results SQL can express (DuckDB)."""

from __future__ import annotations

from edops.llm.quality import FEWEST_WORDS, REPEAT_PERCENT, REPEATED_LINE_CHAR_SHARE, REPEATED_NGRAM_SHARE, TOP_NGRAM_SHARE

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _components(nodes: str, links: str, key: str) -> str:
    """CTEs ``reach`` and ``found`` (key, component) over symmetric links (i, j)."""
    return f"""
reach AS (SELECT i, j FROM {links} UNION SELECT r.i, l.j FROM reach r JOIN {links} l ON r.j = l.i),
found AS (SELECT n.{key}, least(n.{key}, coalesce(min(r.j), n.{key})) AS component_id FROM {nodes} n LEFT JOIN reach r ON r.i = n.{key} GROUP BY n.{key})"""


def _gram(n: int, join: str = "' '") -> str:
    """The ``n`` words from a row of ``words`` on; null where the text ends before."""
    return f" || {join} || ".join(["x", *(f"lead(x, {k}) OVER o" for k in range(1, n))])


def _words(text: str) -> str:
    """CTEs ``docs`` (doc_id, text, w) and ``words`` (doc_id, x, p)."""
    return f"""
docs AS (SELECT doc_id, {text} AS text, {_WORDS.format(text)} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM docs)"""


_ORDER = "WINDOW o AS (PARTITION BY doc_id ORDER BY p)"


def _quality() -> str:
    parts, tests = [], []
    for n, limit in TOP_NGRAM_SHARE.items():
        parts.append(f"""
top_{n} AS (SELECT doc_id, max(c) AS c FROM (SELECT doc_id, count(*) * any_value(length(g) - {n - 1}) AS c FROM (
  SELECT doc_id, {_gram(n)} AS g FROM words {_ORDER}) WHERE g IS NOT NULL GROUP BY doc_id, g HAVING count(*) > 1) GROUP BY doc_id)""")
        tests.append(f"least(coalesce(top_{n}.c, 0) / greatest(word_chars, 1)::DOUBLE, 1) > {limit}")
    for n, limit in REPEATED_NGRAM_SHARE.items():
        parts.append(f"""
again_{n} AS (SELECT doc_id, sum(length(x)) AS c FROM words JOIN (SELECT DISTINCT doc_id, unnest(range(p, p + {n})) AS p FROM (
  SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id, g ORDER BY p) AS k FROM (SELECT doc_id, p, {_gram(n)} AS g FROM words {_ORDER}) WHERE g IS NOT NULL)
  WHERE k > 1) USING (doc_id, p) GROUP BY doc_id)""")
        tests.append(f"coalesce(again_{n}.c, 0) / greatest(word_chars, 1)::DOUBLE > {limit}")
    tests.append(f"coalesce(dup_line_chars, 0) / greatest(word_chars, 1)::DOUBLE > {REPEATED_LINE_CHAR_SHARE}")
    names = [f"top_{n}" for n in TOP_NGRAM_SHARE] + [f"again_{n}" for n in REPEATED_NGRAM_SHARE]
    joins = " ".join(f"LEFT JOIN {name} USING (doc_id)" for name in names)
    return f"""
WITH {_words("coalesce(text, '')").strip()},
triples AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS times FROM (SELECT doc_id, p, {_gram(3)} AS g FROM words {_ORDER}) WHERE g IS NOT NULL),
repeats AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM triples WHERE times > 1) GROUP BY doc_id),
split AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k, unnest(string_split(text, chr(10))) AS line FROM docs),
held AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) AS nth FROM split WHERE len({_WORDS.format('line')}) > 0),
lines AS (SELECT doc_id, count(*) AS n, sum(length(array_to_string({_WORDS.format('line')}, ''))) AS c FROM held WHERE nth > 1 GROUP BY doc_id),
{",".join(parts).strip()},
s AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, l.c AS dup_line_chars
  FROM docs d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
b AS (SELECT s.*, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed, {" OR ".join(tests)} AS repetitive FROM s {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT repetitive AS kept FROM b"""


def _finite(vec: str) -> str:
    return f"{vec} IS NOT NULL AND len(list_filter({vec}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


# The table of the checksum's 256 one-byte steps, from its polynomial.
_CRC_TABLE = """SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t"""


def _crc(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes; ``t`` is the table."""
    each = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {each}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLES = {
    "op5_repetition": _quality(),
    "op6_min_max_hash": f"""
WITH RECURSIVE {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')").strip()},
grams AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, {_gram(3)} AS g FROM words {_ORDER}) WHERE g IS NOT NULL
  UNION SELECT doc_id, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND 2),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT i, j FROM common JOIN sizes a ON a.doc_id = i JOIN sizes b ON b.doc_id = j WHERE 100 * c >= 85 * (a.n + b.n - c)),
{_components("docs", "links", "doc_id").strip()}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM found LEFT JOIN sizes USING (doc_id)""",
    "op7_nn_descent": f"""
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
sound AS (SELECT * FROM vectors WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS i, b.vec_id AS j FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
degree AS (SELECT i AS vec_id, count(*) AS n FROM links GROUP BY i),
{_components("vectors", "links", "vec_id").strip()}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM found LEFT JOIN degree USING (vec_id)""",
    "op10_repeats": f"""
WITH {_words("coalesce(text, '')").strip()},
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k
  FROM (SELECT doc_id, p, {_gram(20)} AS g FROM words {_ORDER}) WHERE g IS NOT NULL) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later),
lists AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_hard_negatives": f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL AND {_finite("embedding")}),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 10""",
    "op12_kmeans_tree": f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_finite("embedding")} AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT a.vec_id AS query_id, (row_number() OVER w)::INT AS rank, b.vec_id, list_inner_product(a.e, b.e) AS score
FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 20 = 0
WINDOW w AS (PARTITION BY a.vec_id ORDER BY list_inner_product(a.e, b.e) DESC, b.vec_id) QUALIFY row_number() OVER w <= 20""",
    "op13_variants": f"""
WITH RECURSIVE tab AS ({_CRC_TABLE}),
runs AS (SELECT id, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
  translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
crcs AS (SELECT run, n, {_crc("(id || ':' || run)")} AS h FROM runs, tab),
cut AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crcs),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
  UNION SELECT h.word, h.n, v.word, v.n FROM holes h JOIN vocab v ON v.word = h.hole
  UNION SELECT v.word, v.n, h.word, h.n FROM holes h JOIN vocab v ON v.word = h.hole),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
best AS (SELECT word, n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM ranked WHERE k = 1),
chain AS (SELECT word, form AS onto FROM best WHERE form IS NOT NULL UNION SELECT c.word, b.form FROM chain c JOIN best b ON b.word = c.onto WHERE b.form IS NOT NULL),
ends AS (SELECT c.word, c.onto AS root FROM chain c JOIN best b ON b.word = c.onto WHERE b.form IS NULL)
SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, b.form, b.form_n, coalesce(e.root, v.word) AS root
FROM vocab v LEFT JOIN best b USING (word) LEFT JOIN ends e USING (word)""",
}
