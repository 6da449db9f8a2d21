"""DuckDB SQL for the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_SPACE = r"[^\x20\x09-\x0D]+"


def _words(table: str, key: str, text: str, pattern: str) -> str:
    return f"SELECT {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}"


NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS ({_words("documents", "doc_id", _LOWER, _NO_SPACE)}),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM docs, unnest(range(1, greatest(len(w) - 2, 2))) t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH docs AS ({_words("documents", "doc_id", "coalesce(text, '')", _NO_SPACE)}),
windows AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i:i + 12], ' ')) AS earliest
  FROM docs, unnest(range(1, len(w) - 11)) t(i)),
gone AS (
  SELECT DISTINCT doc_id, i + j AS place FROM windows, unnest(range(13)) u(j) WHERE earliest < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs) p
  ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(removed.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

DECONTAMINATION = f"""
WITH docs AS ({_words("documents", "doc_id", _LOWER, _ALNUM)}),
items AS ({_words("benchmark", "item_id", _LOWER, _ALNUM)}),
grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM items, unnest(range(1, greatest(len(w) - 8, 2))) t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT k FROM grams),
windows AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT * FROM docs, lengths) s, unnest(range(1, len(w) - k + 2)) t(i)),
hits AS (SELECT doc_id, i, k, item_id FROM windows JOIN grams USING (k, g)),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM hits, unnest(range(k)) u(j) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(found.items, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


LEXICAL_SEARCH = f"""
WITH docs AS ({_words("documents", "doc_id", _LOWER, _ALNUM)}),
items AS ({_words("benchmark", "item_id", _LOWER, _ALNUM)}),
whole AS (SELECT count(*) AS n, sum(len(w)) AS l FROM docs WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item_id, unnest(w) AS term FROM items),
postings AS (
  SELECT doc_id, term, len, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM postings, whole GROUP BY term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len * n) // l)))) AS BIGINT) AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term), whole GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10"""


def _clustering(dims: int = 64, k: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other, each a pair of statements."""
    distance = "list_sum(list_transform(list_zip(v.v, c.c), lambda p : (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"""vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x : CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x : x IS NOT NULL AND isfinite(x))) = {dims}),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS k, v AS c FROM vectors
  QUALIFY k < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""assigned{i} AS MATERIALIZED (
  SELECT n, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT v.n, c.k, {distance} AS d FROM vectors v, centroids{i} c) GROUP BY n)""")
        if i < rounds:
            steps.append(f"""centroids{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m.c, o.c) AS c FROM centroids{i} o LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM (
      SELECT k, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT a.k, unnest(v) AS x, unnest(range(len(v))) AS place FROM assigned{i} a JOIN vectors USING (n))
      GROUP BY k, place) GROUP BY k) m USING (k))""")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM assigned{rounds} JOIN vectors USING (n) JOIN centroids{rounds} USING (k)"""
    )


def statements() -> dict[str, str]:
    return {
        "op5_near_duplicates": NEAR_DUPLICATES,
        "op7_substring_dedup": SUBSTRING_DEDUP,
        "op8_decontamination": DECONTAMINATION,
        "op12_clustering": _clustering(),
        "op13_lexical_search": LEXICAL_SEARCH,
    }
