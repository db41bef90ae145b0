"""SQL beside the registered queries, where SQL can say it."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(digest: str) -> str:
    """Upper-case base32 of 40 hexadecimal digits: five digits are four letters."""
    fives = [f"('0x' || substr({digest}, {5 * i + 1}, 5))::BIGINT" for i in range(8)]
    letters = [f"substr('{ALPHABET}', (({five} >> {shift}) & 31)::INT + 1, 1)" for five in fives for shift in (15, 10, 5, 0)]
    return " || ".join(letters)


ARCHIVE = f"""
WITH filled AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
latest AS (SELECT payload, max(page_id) AS keeper FROM filled GROUP BY payload),
digested AS (SELECT payload, keeper, sha1(payload) AS hex FROM latest)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_base32('hex')} AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM filled JOIN digested USING (payload)"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_COPIES = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
      THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM cut),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (shingle)
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 90 * (p.n + q.n - common)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a"""

PASSAGES = rf"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS place,
    unnest(list_transform(range(1, len(w) - 33), lambda i: array_to_string(w[i:i + 34], ' '))) AS passage
  FROM cut WHERE len(w) >= 35),
repeated AS (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1),
starts AS (SELECT doc_id, place FROM windows SEMI JOIN repeated USING (passage)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM cut),
marked AS (
  SELECT doc_id, word, words.place,
    coalesce(max(starts.place) OVER (PARTITION BY doc_id ORDER BY words.place) >= words.place - 34, false) AS gone
  FROM words LEFT JOIN starts USING (doc_id, place))
SELECT doc_id, count(word)::BIGINT AS n_words, count(*) FILTER (gone)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM cut LEFT JOIN marked USING (doc_id) GROUP BY doc_id"""



def _clusters(k: int = 16, rounds: int = 3) -> str:
    """Assignments and centroids of every round as tables of their own."""
    steps = [
        """WITH whole AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS number, v AS c FROM whole
  QUALIFY number < {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT id, vec_id, v, number, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS apart
  FROM whole, c{i} QUALIFY row_number() OVER (PARTITION BY id ORDER BY apart, number) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  WITH sums AS (SELECT number, place, sum(x)::BIGINT AS total, count(*) AS n
    FROM (SELECT number, unnest(v) AS x, unnest(range(64)) AS place FROM a{i}) GROUP BY number, place),
  means AS (SELECT number, list((total - ((total % n) + n) % n) // n ORDER BY place) AS c FROM sums GROUP BY number)
  SELECT number, coalesce(means.c, c{i}.c) AS c FROM c{i} LEFT JOIN means USING (number))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, number::INT AS cluster, apart AS distance, sum(apart) OVER (PARTITION BY number)::BIGINT AS cluster_inertia,
  sum(apart) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (number)"""


SQL: dict[str, str] = {"op12_centroids": _clusters(), "op5_warc": ARCHIVE, "op6_jaccard": NEAR_COPIES, "op7_substrings": PASSAGES}
