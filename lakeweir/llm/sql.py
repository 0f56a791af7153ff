"""The same results as SQL, for the operators that SQL can express."""

#: Components of 4-word shingle sets at a Jaccard similarity of 0.85.
NGRAM_JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(2, len(w) - 2)), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) AS s
  FROM words WHERE len(w) > 0
), one AS (SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets GROUP BY list_sort(s)),
grams AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM one),
links AS (
  SELECT a.rep AS u, b.rep AS v FROM grams a JOIN grams b ON a.g = b.g AND a.rep <> b.rep
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT u AS node, u AS root FROM links
  UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, coalesce(r.root, o.rep, d.doc_id) AS component_id
FROM documents d LEFT JOIN sets s ON s.doc_id = d.doc_id
LEFT JOIN one o ON o.s = list_sort(s.s) LEFT JOIN roots r ON r.node = o.rep
"""

#: Words of documents inside runs of ten consecutive benchmark words.
DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS g FROM starts
), lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n
), hits AS (
  SELECT p.doc_id, p.i, p.n, s.item_id FROM places p JOIN windows s ON s.n = p.n AND s.g = array_to_string(list_slice(p.w, p.i, p.i + p.n - 1), ' ')
), words_hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words_hit h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""


def _clusters(size: int, k: int, rounds: int, scale: int) -> str:
    """Plain k-means in integers, one round after another."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size}
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1)::INTEGER AS c, v FROM kept ORDER BY c LIMIT {k}
)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT r, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i}
  ) GROUP BY r, vec_id
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS v FROM (
      SELECT best.c AS c, place, sum(x) AS s, count(*) AS n FROM (SELECT best, unnest(v) AS x, unnest(range({size})) AS place FROM a{i}) GROUP BY 1, 2
    ) GROUP BY c
  ) m ON m.c = c{i}.c
)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, best.c AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} f ON f.c = best.c"""


#: Five rounds over vectors of 64 components.
CLUSTERS = _clusters(size=64, k=40, rounds=5, scale=256)

#: Runs of at least 12 words in texts of which a tenth is made to repeat: diagonals of equal 6-grams, and islands among them.
RUNS = r"""
WITH ids AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, text,
    xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda h, x: xor(xor(h, x) >> 1, (xor(h, x) & 1) * 3988292384))) AS h
  FROM documents
), source AS MATERIALIZED (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i
  FROM (SELECT r, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM ids)
), sizes AS (SELECT r, count(*) AS n FROM source GROUP BY r),
plan AS (
  SELECT r, n, CASE WHEN h % 10 = 0 THEN (h // 10) % n END AS a, h // 10 AS g FROM sizes JOIN ids USING (r)
), places AS (
  SELECT r, s.i, CASE WHEN a IS NULL OR s.i < a THEN s.i ELSE a + (s.i - a) % (1 + (n - a) // (3 + g % 8)) END AS j
  FROM source s JOIN plan USING (r)
), words AS MATERIALIZED (SELECT p.r, p.i, s.word FROM places p JOIN source s ON s.r = p.r AND s.i = p.j),
six AS (
  SELECT r, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d, lead(word, 4) OVER o AS e, lead(word, 5) OVER o AS f
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), grams AS MATERIALIZED (SELECT r, i, concat_ws(' ', word, b, c, d, e, f) AS g FROM six WHERE f IS NOT NULL),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.g = y.g AND x.i < y.i),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + 5 + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + 5 + q >= greatest(12, 2 * q)
), runs AS MATERIALIZED (SELECT r, start, length, min(q) AS q FROM stretches GROUP BY r, start, length),
per_doc AS (
  SELECT r, count(*) AS n_runs, max(struct_pack(length := length, start := -start, q := -q)) AS longest,
    string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
  FROM runs GROUP BY r
), gone AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-longest.start)::BIGINT AS start, longest.length::BIGINT AS length, (-longest.q)::BIGINT AS period,
       ((1000 * longest.length) // -longest.q)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM ids LEFT JOIN per_doc USING (r) LEFT JOIN kept USING (r)
"""
