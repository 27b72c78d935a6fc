"""The license scan, the vector codes and the periodic runs in SQL."""

from __future__ import annotations

from partylens.llm import licenses

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _templates() -> str:
    return ", ".join(
        "({}, '{}', {}, {}, [{}])".format(i, t.label, str(t.phrase).lower(), t.drift(), ", ".join(f"'{w.decode()}'" for w in t.words()))
        for i, t in enumerate(licenses.PHRASES + licenses.NOTICES))


LICENSE_SCAN = rf"""
WITH tpl AS (SELECT * FROM (VALUES {_templates()}) v(t, label, phrase, drift, w)),
tg AS (SELECT t, unnest(range(len(w) - 2)) AS j, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM tpl),
said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (
  SELECT doc_id, unnest(range(len(w) - 2)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g
  FROM said WHERE len(w) > 2),
hit AS (SELECT doc_id, t, i - j AS d, j FROM dg JOIN tg USING (g)),
diagonal AS (SELECT DISTINCT doc_id, t, d FROM hit),
cut AS (
  SELECT doc_id, t, d, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, t ORDER BY d) <= drift THEN 0 ELSE 1 END AS new FROM diagonal JOIN tpl USING (t)),
chain AS (SELECT doc_id, t, d, sum(new) OVER (PARTITION BY doc_id, t ORDER BY d) AS c FROM cut),
word AS (SELECT doc_id, t, c, d, unnest([j, j + 1, j + 2]) AS j FROM hit JOIN chain USING (doc_id, t, d)),
span AS (
  SELECT doc_id, label, phrase, min(d + word.j) AS first,
    count(DISTINCT word.j)::DOUBLE / greatest(len(any_value(w)), max(d + word.j) + 1 - min(d + word.j)) AS score
  FROM word JOIN tpl USING (t) GROUP BY doc_id, t, label, phrase, c),
shown AS (SELECT * FROM span WHERE CASE WHEN phrase THEN score >= 1 ELSE score >= {licenses.SHOWN} END),
found AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase OR score >= {licenses.LEAST}) AS labels, max(score) AS score
  FROM shown GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM said LEFT JOIN found USING (doc_id)"""

_ROUNDS, _PARTS, _ENTRIES = 4, 4, 256


def _codes() -> str:
    steps = [f"""
kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS (
  SELECT r, p, list_slice(v, 1 + p * len(v) // {_PARTS}, (p + 1) * len(v) // {_PARTS}) AS v FROM kept, range({_PARTS}) s(p)),
cell AS MATERIALIZED (SELECT r, p, unnest(range(len(v))) AS i, unnest(v) AS x FROM piece),
book0 AS (SELECT p, r - 1 AS e, i, x FROM cell WHERE r <= {_ENTRIES})"""]
    for n in range(_ROUNDS + 1):
        steps.append(f"""
away{n} AS (SELECT c.r, c.p, b.e, sum((c.x - b.x) * (c.x - b.x)) AS d FROM cell c JOIN book{n} b USING (p, i) GROUP BY ALL),
near{n} AS MATERIALIZED (SELECT r, p, e, d FROM away{n} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if n < _ROUNDS:
            steps.append(f"""
mean{n} AS (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM cell JOIN near{n} USING (r, p) GROUP BY ALL),
book{n + 1} AS MATERIALIZED (SELECT p, e, i, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM book{n} LEFT JOIN mean{n} USING (p, e, i))""")
    return "WITH " + ",".join(steps) + f""",
coded AS (
  SELECT r, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{_ROUNDS} GROUP BY 1),
spelled AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM book{_ROUNDS})
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), spelled"""


VECTOR_CODES = _codes()

PERIODIC_RUNS = r"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    4294967295 - list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda e, k: xor(e >> 1, 3988292384 * (e & 1)))) AS h
  FROM documents),
drawn AS (SELECT doc_id, w, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS g FROM said),
text AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
    THEN list_transform(range(len(w)), lambda i: w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // g) END)]) ELSE w END AS w
  FROM drawn),
word AS MATERIALIZED (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS s FROM text),
pair AS (SELECT doc_id, z.i - a.i AS q, z.i AS i FROM word a JOIN word z USING (doc_id, s) WHERE a.i < z.i),
chain AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS c FROM pair),
diagonal AS (SELECT doc_id, q, min(i) AS f, count(*) AS n FROM chain GROUP BY doc_id, q, c HAVING count(*) >= greatest(12 - q, q)),
run AS MATERIALIZED (SELECT doc_id, f - q AS start, n + q AS length, min(q) AS period FROM diagonal GROUP BY 1, 2, 3),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY 1),
again AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
left_over AS (SELECT doc_id, string_agg(s, ' ' ORDER BY i) AS collapsed FROM word ANTI JOIN again USING (doc_id, i) GROUP BY 1)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN left_over USING (doc_id)"""
