"""DuckDB twins of the registered queries, where SQL can state them.

The others hold trained models, approximate search or tokenizer ids; tests compare them
with plain versions, library results or held-out labels.
"""

#: pieces that cover a unit when a window starting up to width - 1 units before it starts earlier elsewhere
_COVERED = """
marks AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again FROM win
),
units AS (
  SELECT u.doc_id, u.i, u.x, coalesce(bool_or(m.again) OVER (PARTITION BY u.doc_id ORDER BY u.i ROWS BETWEEN {before} PRECEDING AND CURRENT ROW), FALSE) AS gone
  FROM unit u LEFT JOIN marks m ON m.doc_id = u.doc_id AND m.i = u.i
)"""

WORDS = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)
),
unit AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS i FROM d),""" + _COVERED.format(before=19) + """
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM units GROUP BY doc_id
) s ON s.doc_id = d.doc_id"""

BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
win AS (
  SELECT doc_id, i, md5(substring(t, CAST(2 * i - 1 AS BIGINT), 200)) AS h
  FROM (SELECT doc_id, t, unnest(generate_series(1, len(t) // 2 - 99)) AS i FROM d)
),
unit AS (
  SELECT doc_id, unnest(regexp_extract_all(t, '..')) AS x, unnest(generate_series(1, len(t) // 2)) AS i FROM d
),""" + _COVERED.format(before=99) + """,
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens FROM units)
SELECT d.doc_id, CAST(len(d.t) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(s.kept, ''))) AS kept_sha256
FROM d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
         string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM edges GROUP BY doc_id
) s ON s.doc_id = d.doc_id"""

JACCARD = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * met >= 90 * (x.n + y.n - met)
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)"""

METRIC = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, min(b) AS low FROM reach GROUP BY a) USING (vec_id)"""

EXACT = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""

#: a value as a leaf reads it
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
#: a tree's next level from its last
_NEXT = "list_transform(generate_series(1, len(l), 2), lambda i: sha256(l[i] || coalesce(l[i + 1], '')))"

#: crc32 by shift and exclusive or over the bits of the decimal id, lowest first; levels of each tree as lists;
#: one recursion of each leaf up its language's levels and those of the subroots
MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256({_FIELD.format("doc_id")} || {_FIELD.format("source")} || {_FIELD.format("lang")} || {_FIELD.format("n_chars")} || {_FIELD.format("text")}) AS leaf,
         sha256({_FIELD.format("doc_id")} || {_FIELD.format("source")} || {_FIELD.format("lang")} || {_FIELD.format("(n_chars + 1)")} || {_FIELD.format("text")}) AS more,
         list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda c: list_transform(generate_series(0, 7), lambda b: CAST((ascii(c) >> b) & 1 AS BIGINT))))),
           lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)) AS crc
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         CASE WHEN doc_id IS NOT NULL AND xor(crc, CAST(4294967295 AS BIGINT)) % 7 = 0 THEN more ELSE leaf END AS shown
  FROM d
),
lower(lang, k, l) AS (
  SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
  UNION ALL SELECT lang, k + 1, {_NEXT} FROM lower WHERE len(l) > 1
),
subroots AS (SELECT lang, k AS height, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM lower WHERE len(l) = 1),
upper(k, l) AS (
  SELECT 0, list(subroot ORDER BY pos) FROM subroots
  UNION ALL SELECT k + 1, {_NEXT} FROM upper WHERE len(l) > 1
),
levels AS (
  SELECT s.pos AS tree, k, l FROM lower JOIN subroots s ON lower.lang IS NOT DISTINCT FROM s.lang WHERE len(l) > 1
  UNION ALL SELECT s.pos, s.height + upper.k, l FROM upper, subroots s WHERE len(l) > 1
),
start AS (
  SELECT row_number() OVER () AS leaf_no, doc_id, leaf, shown, subroot, s.pos AS tree, height, CASE WHEN height = 0 THEN s.pos ELSE p.pos END AS pos
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
),
climb(leaf_no, tree, height, pos, k, h, proof) AS (
  SELECT leaf_no, tree, height, pos, 0, shown, '' FROM start
  UNION ALL
  SELECT leaf_no, tree, height, CASE WHEN c.k + 1 = height THEN tree ELSE pos >> 1 END, c.k + 1,
         sha256(CASE WHEN other IS NULL THEN h WHEN pos % 2 = 0 THEN h || other ELSE other || h END), proof || coalesce(other, '')
  FROM (SELECT c.*, v.l[xor(c.pos, 1) + 1] AS other FROM climb c JOIN levels v ON v.tree = c.tree AND v.k = c.k) c
),
ends AS (SELECT leaf_no, arg_max(h, k) AS h, arg_max(proof, k) AS proof FROM climb GROUP BY leaf_no)
SELECT doc_id, leaf, subroot, (SELECT l[1] FROM upper WHERE len(l) = 1) AS root, sha256(proof) AS proof_sha256, h AS folded_root,
       h = (SELECT l[1] FROM upper WHERE len(l) = 1) AS verified
FROM start JOIN ends USING (leaf_no)"""

AUDIT = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, list_filter([
           CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * list_unique(w) < 50 * len(w) THEN 'B' END,
           CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
           CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda x: x IS NOT NULL) AS f
  FROM d LEFT JOIN marks USING (doc_id)
),
orders(o) AS (
  SELECT '' UNION ALL SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)
),
steps AS (SELECT o, i, o[i : i] AS x, string_split(o[1 : i - 1], '') AS earlier FROM orders, (SELECT unnest(generate_series(1, 5)) AS i) WHERE length(o) = 5),
kinds AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM fails GROUP BY part, f),
found AS (
  SELECT part, o, i, x,
         coalesce(sum(n) FILTER (WHERE NOT list_contains(f, x) AND NOT list_has_any(f, earlier)), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE list_contains(f, x) AND NOT list_has_any(f, earlier)), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE list_contains(f, x) AND list_has_any(f, earlier)), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE f = [x]), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE list_contains(f, x) AND NOT list_has_any(f, earlier)), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE list_contains(f, x) AND NOT list_has_any(f, earlier)), 0) AS toxic_lost
  FROM kinds, steps GROUP BY ALL
)
SELECT part, o AS filter_order, CAST(i AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM found"""

SQL: dict[str, str] = {
    "op5_ngram_jaccard": JACCARD,
    "op6_substring_fm_index": WORDS,
    "op7_metric_range_join": METRIC,
    "op9_suffix_buckets": BYTES,
    "op11_exact_dedup": EXACT,
    "op12_merkle_manifest": MERKLE,
    "op13_filter_audit": AUDIT,
}
