"""The registered queries as DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

from spark_triage.llm import quality

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RATES = " ".join(
    f"""
{r}_fit AS (SELECT sum(k) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts, sum(k * k / n) AS kk, sum(n * n) AS nn
  FROM (SELECT {r}::DOUBLE AS k, n::DOUBLE AS n FROM hosts)),
{r}_prior AS (SELECT mean, CASE WHEN mean * (1 - mean) > 0 AND n - nn / n - (hosts - 1) > 0
    THEN 1 / least(greatest((kk - n * mean * mean - mean * (1 - mean) * (hosts - 1)) / (mean * (1 - mean) * (n - nn / n - (hosts - 1))), 1e-6), 0.999) - 1
    ELSE 10 END AS strength FROM {r}_fit),"""
    for r in ("few_words", "repeats"))

QUALITY = f"""WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
split AS (SELECT doc_id, source, r, t, {WORDS.format('t')} AS w FROM docs),
grams AS (SELECT r, i, md5(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM split) WHERE i + 4 <= len(w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM again, (SELECT unnest([0, 1, 2, 3, 4]) AS j) GROUP BY r),
lines AS (SELECT r, l, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r, l),
dups AS (SELECT r, sum(n - 1) AS n FROM lines GROUP BY r),
measured AS (SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^{quality.SYMBOLS.decode()}]', '', 'g')) AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM split LEFT JOIN dups USING (r) LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 10 AS few_words, 100 * n_repeat_words > 20 * n_words AS repeats FROM measured),
hosts AS (SELECT source, count(*) AS n, sum(few_words::INT) AS few_words, sum(repeats::INT) AS repeats
  FROM judged WHERE source IS NOT NULL GROUP BY source),{_RATES}
rejected AS (SELECT source FROM hosts, few_words_prior f, repeats_prior p
  WHERE round((few_words + f.mean * f.strength) / (n + f.strength), 9) > {quality.HOST_LIMIT}
     OR round((repeats + p.mean * p.strength) / (n + p.strength), 9) > {quality.HOST_LIMIT})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed,
  NOT (few_words OR repeats) AND (source IS NULL OR source NOT IN (FROM rejected)) AS kept FROM judged"""

NEAR_DUPLICATES = f"""WITH RECURSIVE split AS (SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (na + nb - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT edges.b, c FROM reached JOIN edges ON edges.a = reached.doc_id)
SELECT doc_id, any_value(len(s)) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id"""

SUBSTRING = f"""WITH split AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
seen AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM split) WHERE i + 34 <= len(w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM seen) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM again, (SELECT unnest(range(35)) AS j)),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM split),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

MAX_SKETCH = f"""WITH asked AS (SELECT r, item_id, unnest(list_distinct({TERMS.format(LOWER.format('text'))})) AS term
  FROM (SELECT *, row_number() OVER () AS r FROM benchmark)),
cut AS (SELECT row_number() OVER () AS d, doc_id, {TERMS.format(LOWER.format('text'))} AS t FROM documents),
lengths AS (SELECT d, doc_id, len(t)::BIGINT AS n FROM cut WHERE len(t) > 0),
sums AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM cut) SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, sums GROUP BY term),
scored AS (SELECT r, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, d,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (d), sums GROUP BY r, d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

#: The repair as a recursion over rows: for each state of the lattice the cheapest way (cost, audit, repaired text).
_WAY = "{{'c': {x}.c + {c}, 'a': {x}.a || '{l}', 'r': {r}}}"


def _way(x: str, cost: str, letter: str, line: str | None = None, when: str = "true") -> str:
    text = f"{x}.r" if line is None else f"{x}.r || CASE WHEN {x}.r = '' THEN '' ELSE chr(10) END || {line}"
    return f"CASE WHEN {x} IS NOT NULL AND {when} THEN {_WAY.format(x=x, c=cost, l=letter, r=text)} END"


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


def _repair_sql() -> str:
    kept = lambda x, c: _way(x, "e", "K", "role || ':' || text", f"stays AND c = '{c}'")
    moved = lambda x, role: _way(x, "3 + e", "R", f"'{role}:' || text", "stays")
    gone = lambda x: _way(x, "4", "D")
    filled = lambda x, role: _way(x, "3", "I", f"'{role}:'")
    before = [w for x in ("s0", "s1", "s3") for w in (kept(x, "u"), moved(x, "user"))]
    label = "{'c': 0, 'a': '', 'r': ''}"
    return f"""WITH RECURSIVE crc AS (SELECT list(list_reduce([i] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
keyed AS (SELECT *, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS b FROM conversations),
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS k FROM keyed, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE k <> 0),
named AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
rows AS (SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, md5(text)) AS i
  FROM damaged JOIN named ON named.conv_id IS NOT DISTINCT FROM damaged.conv_id),
told AS (SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS p,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault FROM rows),
counts AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank')::BIGINT AS blank,
    count_if(fault = 'duplicate')::BIGINT AS duplicate, count_if(fault = 'truncated')::BIGINT AS truncated,
    count_if(p IS NOT NULL AND p || c NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, count(*) AS n FROM told GROUP BY g),
steps AS (SELECT g, i, role, text, c, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS e FROM told),
ways AS (
  SELECT g, 0::BIGINT AS i, {label} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, r VARCHAR) AS s1,
    {{'c': 3, 'a': 'I', 'r': 'user:'}} AS s2, {{'c': 6, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS s3 FROM counts
  UNION ALL
  SELECT g, i, s0, s1, s2, {_least('s3', filled('s2', 'assistant'))} FROM (
    SELECT g, i, s0, s1, {_least('s2', filled('s0', 'user'), filled('s1', 'user'), filled('s3', 'user'))} AS s2, s3 FROM (
      SELECT ways.g, steps.i, {gone('s0')} AS s0, {_least(gone('s1'), kept('s0', 's'))} AS s1, {_least(gone('s2'), *before)} AS s2,
        {_least(gone('s3'), kept('s2', 'a'), moved('s2', 'assistant'))} AS s3
      FROM ways JOIN steps ON steps.g = ways.g AND steps.i = ways.i + 1))),
ends AS (SELECT g, {_least('s0', 's3')} AS w FROM ways JOIN counts USING (g) WHERE i = n)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(w.c, 0)::BIGINT AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(w.r, '')) AS repaired_sha256
FROM named LEFT JOIN counts USING (g) LEFT JOIN ends USING (g)"""


REPAIR = _repair_sql()

SQL = {
    "op1_quality_rules": QUALITY,
    "op2_near_duplicates": NEAR_DUPLICATES,
    "op3_substring_dedup": SUBSTRING,
    "op10_exact_top_k": TOP_K,
    "op11_max_sketch_search": MAX_SKETCH,
    "op12_conversation_repair": REPAIR,
}
