"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

Each string recomputes its query from the base tables without the engine:
the same inputs (F4 user actions, F5 embeddings, F6 customer × brand), the
same fixed centres, the same rules. Doubles are rounded to 6 places, as the
Spark side does. A seeded fit can't be replayed in SQL: the fit queries return facts
about their model, which SQL derives from the tables.
"""

from __future__ import annotations

DIGITS = 6

_D2 = (
    "list_reduce(list_transform(generate_series(1, len({x})), "
    "lambda i: ({x}[i] - {c}[i]) * ({x}[i] - {c}[i])), lambda s, t: s + t)"
)


def d2(x: str, c: str) -> str:
    return _D2.format(x=x, c=c)


# ---- F4 user actions with the fixed 4-centre model ------------------------------------------------

UA = """
ua_counts AS (
  SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type
),
ua_dims AS (
  SELECT CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS dim,
         event_type AS dimension_id, event_type AS dimension_name
  FROM (SELECT DISTINCT event_type FROM events)
),
ua AS (
  SELECT u.user_id, list(CAST(coalesce(c.n, 0) AS DOUBLE) ORDER BY d.dim) AS features
  FROM (SELECT DISTINCT user_id FROM events) u
  CROSS JOIN ua_dims d
  LEFT JOIN ua_counts c ON c.user_id = u.user_id AND c.event_type = d.dimension_id
  GROUP BY u.user_id
)"""

UA_MODEL = (
    UA
    + """,
ua_cent AS (
  SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS cluster, features AS c
  FROM ua QUALIFY row_number() OVER (ORDER BY user_id) <= 4
),
ua_pairs AS (
  SELECT p.user_id, p.features, ct.cluster, """
    + d2("p.features", "ct.c")
    + """ AS d2
  FROM ua p CROSS JOIN ua_cent ct
),
ua_asg AS (
  SELECT user_id, features, cluster, d2, sqrt(d2) AS dist
  FROM ua_pairs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY d2, cluster) = 1
),
ua_sum AS (
  SELECT cluster, count(*) AS n, max(dist) AS max_dist, sum(dist) AS dist_sum, sum(d2) AS sse
  FROM ua_asg GROUP BY cluster
),
ua_long AS (
  SELECT cluster, unnest(generate_series(0, len(features) - 1)) AS dim, unnest(features) AS x FROM ua_asg
),
ua_dimstats AS (
  SELECT cluster, CAST(dim AS INTEGER) AS dim, min(x) AS mn, max(x) AS mx, sum(x) AS sm,
         count(*) FILTER (WHERE x > 0) AS ps
  FROM ua_long GROUP BY cluster, dim
),
ua_cent_long AS (
  SELECT cluster, CAST(unnest(generate_series(0, len(c) - 1)) AS INTEGER) AS dim, unnest(c) AS center FROM ua_cent
),
ua_dimrows AS (
  SELECT s.cluster, s.dim, cl.center, s.mn AS min, s.mx AS max, s.sm / u.n AS avg, s.sm AS sum,
         s.ps AS member_count, d.dimension_id, d.dimension_name
  FROM ua_dimstats s
  JOIN ua_sum u ON u.cluster = s.cluster
  JOIN ua_cent_long cl ON cl.cluster = s.cluster AND cl.dim = s.dim
  JOIN ua_dims d ON d.dim = s.dim
)"""
)

# ---- F5 embeddings: fixed-centre models per label for k = 2, 4, 8, 16 ----------------------------

EMB = """
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings),
emb_cent AS (
  SELECT label, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS cluster,
         features AS c
  FROM emb QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 16
),
ks AS (SELECT CAST(unnest([2, 4, 8, 16]) AS INTEGER) AS k),
emb_pairs AS (
  SELECT e.label, ks.k, e.vec_id, ct.cluster, """ + d2("e.features", "ct.c") + """ AS d2
  FROM emb e JOIN emb_cent ct ON ct.label = e.label JOIN ks ON ct.cluster < ks.k
),
emb_asg AS (
  SELECT label AS run_id, k, vec_id, cluster, d2, sqrt(d2) AS dist
  FROM emb_pairs QUALIFY row_number() OVER (PARTITION BY label, k, vec_id ORDER BY d2, cluster) = 1
),
emb_sum AS (
  SELECT run_id, k, cluster, count(*) AS n, max(dist) AS max_dist, sum(d2) AS sse
  FROM emb_asg GROUP BY run_id, k, cluster
),
curve0 AS (
  SELECT run_id, k, CAST(sum(n) AS BIGINT) AS n, sum(sse) AS wssse, avg(2 * max_dist) AS avg_diameter
  FROM emb_sum GROUP BY run_id, k
),
curve1 AS (
  SELECT *, wssse / n AS variance,
         CASE WHEN wssse / n > 0 THEN -CAST(n AS DOUBLE) / 2.0 * (ln(2 * pi() * (wssse / n)) + 1) END AS ln_l
  FROM curve0
),
curve AS (
  SELECT *, ln_l - CAST(k * 64 + 1 AS DOUBLE) AS aic,
         ln_l - CAST(k * 64 + 1 AS DOUBLE) / 2.0 * ln(CAST(n AS DOUBLE)) AS bic
  FROM curve1
),
diams AS (SELECT run_id, k, cluster, 2 * max_dist AS diameter FROM emb_sum WHERE n > 0)"""

# ---- F6 customer × brand, category = brands of manufacturer 1 -------------------------------------

BRANDS = """
cb AS (
  SELECT o.o_custkey, p.p_brand, count(*) AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY o.o_custkey, p.p_brand
),
cats AS (SELECT DISTINCT CAST(substr(p_brand, 7, 1) AS BIGINT) AS category_id, p_brand AS page_id FROM part),
fc AS (
  SELECT c.category_id, cb.o_custkey, cb.p_brand, cb.n FROM cb JOIN cats c ON c.page_id = cb.p_brand WHERE cb.n > 0
)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _round(body: str, cols: list[str]) -> str:
    rep = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({body.strip()})"


def _pairs(value: str) -> str:
    return f"""
SELECT run_id, k1, v1, k2, v2 FROM (
  SELECT run_id, k AS k1, {value} AS v1,
         lead(k) OVER (PARTITION BY run_id ORDER BY k) AS k2,
         lead({value}) OVER (PARTITION BY run_id ORDER BY k) AS v2
  FROM curve
) WHERE k2 IS NOT NULL"""


def _slopes(value: str) -> str:
    return f"""
SELECT run_id, k1 AS k, CASE WHEN k2 - k1 = 0 THEN 0.0 ELSE (v2 - v1) / CAST(k2 - k1 AS DOUBLE) END AS slope,
       v1 AS value
FROM ({_pairs(value)})"""


def _obs() -> str:
    return "SELECT run_id, k, sum(diameter) / k AS mean_diameter, count(*) AS n_clusters FROM diams GROUP BY run_id, k"


SQL: dict[str, str] = {}

# sources
SQL["read_points"] = _with(
    UA,
    """
SELECT CAST(row_id AS BIGINT) AS row_id, CAST(dim AS INTEGER) AS dim, value FROM (
  SELECT row_id, unnest(generate_series(0, len(features) - 1)) AS dim, unnest(features) AS value
  FROM (SELECT row_number() OVER (ORDER BY user_id) - 1 AS row_id, features FROM ua)
) WHERE value <> 0""",
)
SQL["read_points_counted"] = _with(
    UA,
    """
, judged AS (
  SELECT row_number() OVER (ORDER BY user_id) - 1 AS row_id, features,
    CASE WHEN features[1] = features[2] THEN 'token' WHEN features[3] > features[4] THEN 'index twice' END AS reason FROM ua),
cells AS (
  SELECT row_id, reason, CAST(unnest(generate_series(0, len(features) - 1)) AS INTEGER) AS dim, unnest(features) AS value
  FROM judged WHERE reason IS NULL),
rows AS (
  SELECT * FROM cells WHERE value <> 0 UNION ALL
  SELECT row_id, reason, CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE) FROM judged WHERE reason IS NOT NULL)
SELECT CAST(row_id AS BIGINT) AS row_id, reason, dim, value,
  (SELECT count(*) FROM judged) AS lines, (SELECT count(reason) FROM judged) AS broken,
  (SELECT count(*) FROM cells WHERE value <> 0) AS entries, (SELECT CAST(max(dim) AS BIGINT) FROM cells WHERE value <> 0) AS top_index
FROM rows""",
)
SQL["read_lookup"] = _with(
    UA, "SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS row_id, CAST(user_id AS VARCHAR) AS user_id FROM ua"
)
SQL["read_category"] = (
    "SELECT DISTINCT CAST(substr(p_brand, 7, 1) AS BIGINT) AS category_id, p_brand AS page_id, p_brand AS name FROM part"
)
SQL["read_user_activity"] = (
    "SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS gender, event_type AS page, count(*) AS n "
    "FROM events GROUP BY user_id, event_type"
)

# features
SQL["group_by_user"] = "SELECT user_id, event_type AS page, count(*) AS n FROM events GROUP BY user_id, event_type"
SQL["filter_to_category"] = _with(
    BRANDS,
    "SELECT category_id, o_custkey, p_brand, n FROM fc WHERE substr(p_brand, 8, 1) <= '3' "
    "UNION ALL SELECT -1, o_custkey, p_brand, n FROM fc WHERE substr(p_brand, 8, 1) <= '3' AND category_id = 2",
)
SQL["scale_actions"] = _with(
    BRANDS,
    _round(
        "SELECT category_id, o_custkey, p_brand, "
        "CAST(n AS DOUBLE) * (1.0::DOUBLE / (1.0::DOUBLE + CAST(max(n) OVER (PARTITION BY category_id) AS DOUBLE))) AS n "
        "FROM fc",
        ["n"],
    ),
)
SQL["assemble_vectors"] = _with(
    BRANDS
    + """,
bd AS (SELECT CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS dim, p_brand FROM (SELECT DISTINCT p_brand FROM cb))""",
    _round(
        """
SELECT u.o_custkey, bd.dim, CAST(coalesce(cb.n, 0) AS DOUBLE) AS value
FROM (SELECT DISTINCT o_custkey FROM cb) u CROSS JOIN bd
LEFT JOIN cb ON cb.o_custkey = u.o_custkey AND cb.p_brand = bd.p_brand""",
        ["value"],
    ),
)

# training with fixed centres
SQL["cluster_centers"] = _with(UA_MODEL, _round("SELECT cluster, dim, center FROM ua_cent_long", ["center"]))

# assignment
SQL["assign"] = _with(UA_MODEL, _round("SELECT user_id, cluster, d2 FROM ua_asg", ["d2"]))
SQL["distance_to_center"] = _with(UA_MODEL, _round("SELECT user_id, cluster, dist FROM ua_asg", ["dist"]))
SQL["attach_users"] = _with(UA_MODEL, "SELECT CAST(user_id AS VARCHAR) AS user_id, cluster FROM ua_asg")

# profile
SQL["cluster_counts"] = _with(
    UA_MODEL,
    # the model has its first centre once more, as an empty fifth cluster
    "SELECT ct.cluster, CAST(coalesce(s.n, 0) AS BIGINT) AS member_count FROM ua_cent ct LEFT JOIN ua_sum s ON s.cluster = ct.cluster "
    "UNION ALL SELECT CAST(count(*) AS INTEGER), CAST(0 AS BIGINT) FROM ua_cent",
)
SQL["cluster_diameters"] = _with(UA_MODEL, _round("SELECT cluster, 2 * max_dist AS diameter FROM ua_sum", ["diameter"]))
SQL["cluster_max_distance"] = _with(UA_MODEL, _round("SELECT cluster, max_dist FROM ua_sum", ["max_dist"]))
SQL["cluster_distance_sum"] = _with(UA_MODEL, _round("SELECT cluster, dist_sum FROM ua_sum", ["dist_sum"]))
SQL["cluster_reduce"] = _with(
    UA_MODEL,
    _round("SELECT cluster, min(dist) AS min_dist, max(d2) AS max_d2 FROM ua_asg GROUP BY cluster", ["min_dist", "max_d2"]),
)
SQL["cluster_reduce_function"] = _with(UA_MODEL, _round("SELECT cluster, dim, min AS low, max AS high FROM ua_dimrows", ["low", "high"]))
SQL["cluster_mins"] = _with(UA_MODEL, _round("SELECT cluster, dim, min FROM ua_dimrows", ["min"]))
SQL["cluster_maxes"] = _with(UA_MODEL, _round("SELECT cluster, dim, max FROM ua_dimrows", ["max"]))
SQL["cluster_sums"] = _with(UA_MODEL, _round("SELECT cluster, dim, sum FROM ua_dimrows", ["sum"]))
SQL["cluster_averages"] = _with(UA_MODEL, _round("SELECT cluster, dim, avg FROM ua_dimrows", ["avg"]))
SQL["cluster_dim_users"] = _with(UA_MODEL, "SELECT cluster, dim, member_count FROM ua_dimrows")
SQL["attach_dimensions"] = _with(
    UA_MODEL, _round("SELECT cluster, dimension_id, dimension_name, center FROM ua_dimrows", ["center"])
)
SQL["wssse"] = _with(UA_MODEL, _round("SELECT sum(d2) AS wssse FROM ua_asg", ["wssse"]))
SQL["cluster_profile"] = _with(
    UA_MODEL,
    _round(
        """
SELECT 'run-' || CAST(s.cluster AS VARCHAR) AS cluster_id, s.n AS cluster_member_count, false AS private,
       2 * s.max_dist AS cluster_diameter, (SELECT sum(sse) FROM ua_sum) AS cluster_wssse,
       r.dim, r.dimension_id, r.dimension_name, r.member_count, r.center, r.min, r.max, r.avg
FROM ua_sum s JOIN ua_dimrows r ON r.cluster = s.cluster""",
        ["cluster_diameter", "cluster_wssse", "center", "min", "max", "avg"],
    ),
)
SQL["cluster_profile_wide"] = """
WITH cnt AS (
  SELECT o_custkey AS u, CAST(l_partkey AS VARCHAR) AS page, CAST(count(*) AS DOUBLE) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
),
pages AS (SELECT page, row_number() OVER (ORDER BY page) - 1 AS dim FROM (SELECT DISTINCT page FROM cnt)),
cent AS (
  SELECT cluster, page, n FROM cnt JOIN (SELECT u, CAST(row_number() OVER (ORDER BY u) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT u FROM cnt) QUALIFY cluster < 4) USING (u)
),
norms AS (SELECT cluster, sum(n * n) AS cc FROM cent GROUP BY cluster),
dots AS (SELECT c.u, m.cluster, sum(c.n * m.n) AS xc FROM cnt c JOIN cent m USING (page) GROUP BY ALL),
users AS (SELECT u, sum(n * n) AS xx FROM cnt GROUP BY u),
asg AS (
  SELECT u, cluster, xx + cc - 2 * coalesce(xc, 0) AS d2 FROM users CROSS JOIN norms LEFT JOIN dots USING (u, cluster)
  QUALIFY row_number() OVER (PARTITION BY u ORDER BY d2, cluster) = 1
),
heads AS (SELECT cluster, count(*) AS members, 2 * sqrt(max(d2)) AS diameter, sum(d2) AS sse FROM asg GROUP BY cluster),
cells AS (SELECT cluster, page, count(*) AS entries, min(n) AS low, max(n) AS high, sum(n) AS total FROM cnt JOIN asg USING (u) GROUP BY ALL)
SELECT 'run-' || h.cluster AS cluster_id, members AS cluster_member_count, round(diameter, 6) AS cluster_diameter, round((SELECT sum(sse) FROM heads), 6) AS cluster_wssse,
       CAST(dim // 100 AS INTEGER) AS part, p.page AS dimension_id, p.page AS dimension_name, coalesce(entries, 0) AS member_count, round(coalesce(m.n, 0), 6) AS center,
       round(CASE WHEN entries = members THEN low ELSE 0 END, 6) AS min, round(coalesce(high, 0), 6) AS max, round(coalesce(total, 0) / members, 6) AS avg
FROM heads h CROSS JOIN pages p LEFT JOIN cent m ON m.cluster = h.cluster AND m.page = p.page LEFT JOIN cells c ON c.cluster = h.cluster AND c.page = p.page"""
SQL["drop_empty_clusters"] = _with(
    UA_MODEL,
    _round(
        "SELECT 'run-' || CAST(cluster AS VARCHAR) AS cluster_id, n AS cluster_member_count, "
        "2 * max_dist AS cluster_diameter FROM ua_sum WHERE n > 0",
        ["cluster_diameter"],
    ),
)

# sinks and ids
SQL["membership_rows"] = _with(
    UA_MODEL, "SELECT 'run-' || CAST(cluster AS VARCHAR) AS cluster_id, CAST(user_id AS VARCHAR) AS user_id FROM ua_asg"
)
SQL["write_membership"] = _with(
    UA_MODEL
    + """,
m AS (SELECT 'run-' || CAST(cluster AS VARCHAR) AS cluster_id, CAST(user_id AS VARCHAR) AS user_id FROM ua_asg),
sz AS (SELECT cluster_id, count(*) AS n FROM m GROUP BY cluster_id),
tagged AS (
  SELECT m.cluster_id, m.user_id,
         greatest(1, CAST(ceil(sz.n / 100000.0) AS BIGINT)) AS parts,
         ('0x' || substr(md5(m.user_id), 1, 8))::BIGINT % greatest(1, CAST(ceil(sz.n / 100000.0) AS BIGINT)) AS part
  FROM m JOIN sz ON sz.cluster_id = m.cluster_id
)""",
    """
SELECT CAST(to_json({'cluster_id': cluster_id, 'part': part, 'parts': parts, 'user_ids': list_sort(list(user_id))}) AS VARCHAR) AS value
FROM tagged GROUP BY cluster_id, part, parts""",
)
SQL["write_profile"] = _with(
    UA_MODEL,
    """
SELECT CAST(to_json({
  'cluster_id': 'run-' || CAST(s.cluster AS VARCHAR),
  'cluster_member_count': s.n,
  'private': false,
  'cluster_diameter': round(2 * s.max_dist, 6),
  'cluster_wssse': round((SELECT sum(sse) FROM ua_sum), 6),
  'dimensions': list({'dimension_id': r.dimension_id, 'dimension_name': r.dimension_name,
                      'member_count': r.member_count, 'center': round(r.center, 6), 'min': round(r.min, 6),
                      'max': round(r.max, 6), 'avg': round(r.avg, 6)} ORDER BY r.dim)
}) AS VARCHAR) AS value
FROM ua_sum s JOIN ua_dimrows r ON r.cluster = s.cluster
GROUP BY s.cluster, s.n, s.max_dist""",
)
SQL["consistent_hash"] = (
    "SELECT c_custkey, ('0x' || substr(md5(c_name), 1, 8))::BIGINT % 16 AS bucket FROM customer"
)
# Murmur3 over UTF-16 code units: wide integers, taken modulo 2^32 after each product
_UNITS = """flatten(list_transform(string_split({x}, ''), lambda c: CASE WHEN unicode(c) >= 65536
  THEN [55296 + (unicode(c) - 65536) // 1024, 56320 + (unicode(c) - 65536) % 1024] ELSE [unicode(c)] END))"""
_M = "4294967296::HUGEINT"
_MURMUR = f"""
units AS (SELECT *, {{units}} AS u FROM {{src}}),
blocks AS (
  SELECT *, list_transform(generate_series(1, len(u), 2), lambda i: (u[i]::HUGEINT + coalesce(u[i + 1], 0)::HUGEINT * 65536)) AS b1 FROM units
),
mixed AS (
  SELECT *, list_transform(list_transform(list_transform(b1, lambda k: (k * 3432918353) % {_M}), lambda k: (k * 32768) % {_M} + k // 131072),
                           lambda k: (k * 461845907) % {_M}) AS b FROM blocks
),
folded AS (
  SELECT *, xor(xor(list_reduce(list_prepend(0::HUGEINT, b[1 : len(u) // 2]), lambda h, k: (((xor(h, k) * 8192) % {_M} + xor(h, k) // 524288) * 5 + 3864292196) % {_M}),
                    CASE WHEN len(u) % 2 = 1 THEN b[len(b)] ELSE 0::HUGEINT END), (2 * len(u))::HUGEINT) AS f0
  FROM mixed
),
f1 AS (SELECT *, (xor(f0, f0 // 65536) * 2246822507) % {_M} AS g1 FROM folded),
f2 AS (SELECT *, (xor(g1, g1 // 8192) * 3266489909) % {_M} AS g2 FROM f1),
hashed AS (SELECT *, CAST(CASE WHEN xor(g2, g2 // 65536) >= 2147483648 THEN xor(g2, g2 // 65536) - {_M} ELSE xor(g2, g2 // 65536) END AS BIGINT) AS h FROM f2)"""
SQL["consistent_hash_utf16"] = (
    "WITH names AS (SELECT c_custkey, 'name' AS kind, c_name AS x FROM customer\n"
    "  UNION ALL SELECT c_custkey, 'moved', translate(c_name, 'Custome', 'Çü\u4e16\u2028\U0001f600\uffffé') FROM customer),"
    + _MURMUR.format(units=_UNITS.format(x="x"), src="names")
    + "\nSELECT c_custkey, ((max(h) FILTER (WHERE kind = 'name')) % 16 + 16) % 16 AS bucket, max(h) FILTER (WHERE kind = 'moved') AS moved_hash FROM hashed GROUP BY c_custkey"
)
SQL["run_cluster_id"] = _with(UA_MODEL, "SELECT user_id, 'run-' || CAST(cluster AS VARCHAR) AS cluster_id FROM ua_asg")

# vector functions
_ANCHOR = """
emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings),
anchor AS (SELECT label, features AS anchor FROM emb QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
ea AS (SELECT e.vec_id, e.features, a.anchor FROM emb e JOIN anchor a ON a.label = e.label)"""
SQL["square"] = _round(
    "SELECT vec_id, CAST(dim AS INTEGER) AS dim, x * x AS sq FROM ("
    "SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS dim, unnest(CAST(embedding AS DOUBLE[])) AS x "
    "FROM embeddings)",
    ["sq"],
)
SQL["vector_diff"] = _with(
    _ANCHOR,
    _round(
        "SELECT vec_id, CAST(unnest(generate_series(0, len(features) - 1)) AS INTEGER) AS dim, "
        "unnest(list_transform(generate_series(1, len(features)), lambda i: features[i] - anchor[i])) AS diff FROM ea",
        ["diff"],
    ),
)
SQL["vector_norm"] = _round(
    "SELECT vec_id, sqrt(list_reduce(list_transform(CAST(embedding AS DOUBLE[]), lambda v: v * v), "
    "lambda s, t: s + t)) AS norm FROM embeddings",
    ["norm"],
)
SQL["euclidean_distance"] = _with(
    _ANCHOR, _round(f"SELECT vec_id, sqrt({d2('features', 'anchor')}) AS distance FROM ea", ["distance"])
)

# scoring
SQL["avg_cluster_diameter"] = _with(
    EMB, _round("SELECT run_id, k, avg(diameter) AS avg_diameter FROM diams GROUP BY run_id, k", ["avg_diameter"])
)
SQL["model_diameters"] = _with(EMB, _round("SELECT run_id, k, avg_diameter FROM curve", ["avg_diameter"]))
SQL["model_errors"] = _with(EMB, _round("SELECT run_id, k, wssse FROM curve", ["wssse"]))
SQL["cluster_sq_distance"] = _with(EMB, _round("SELECT run_id, k, cluster, sse FROM emb_sum WHERE n > 0", ["sse"]))
SQL["model_variance"] = _with(EMB, _round("SELECT run_id, k, variance FROM curve", ["variance"]))
SQL["point_density"] = _with(
    EMB,
    _round(
        """
SELECT a.run_id, a.k, a.vec_id,
       1.0 / sqrt(2 * pi() * c.variance) * exp(-0.5 * a.d2 / c.variance) AS density
FROM emb_asg a JOIN curve c ON c.run_id = a.run_id AND c.k = a.k""",
        ["density"],
    ),
)
# Checked the long way: the sum of the log of every point's density.
SQL["ln_likelihood"] = _with(
    EMB,
    _round(
        """
SELECT a.run_id, a.k, sum(ln(1.0 / sqrt(2 * pi() * c.variance)) - 0.5 * a.d2 / c.variance) AS ln_l
FROM emb_asg a JOIN curve c ON c.run_id = a.run_id AND c.k = a.k
GROUP BY a.run_id, a.k""",
        ["ln_l"],
    ),
)
SQL["aic"] = _with(EMB, _round("SELECT run_id, k, aic FROM curve", ["aic"]))
SQL["bic"] = _with(EMB, _round("SELECT run_id, k, bic FROM curve", ["bic"]))
SQL["bics"] = _with(EMB, _round("SELECT run_id, k, bic FROM curve", ["bic"]))

# curve
SQL["successive_pairs"] = _with(EMB, _round(_pairs("avg_diameter"), ["v1", "v2"]))
SQL["slope"] = _with(
    EMB,
    _round(
        f"SELECT run_id, k1, k2, CASE WHEN k2 - k1 = 0 THEN 0.0 ELSE (v2 - v1) / CAST(k2 - k1 AS DOUBLE) END AS slope "
        f"FROM ({_pairs('wssse')})",
        ["slope"],
    ),
)
SQL["k_slopes"] = _with(EMB, _round(_slopes("avg_diameter"), ["slope", "value"]))
SQL["filter_slopes"] = _with(EMB, _round(f"SELECT * FROM ({_slopes('(avg_diameter * 20)')}) WHERE slope <= -1", ["slope", "value"]))
_GAP = f"""
SELECT run_id, k1, v1, k2, v2, gap FROM (
  SELECT *, abs(v2 - v1) AS gap FROM ({_pairs('bic')})
) QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY gap DESC, k1) = 1"""
SQL["max_bic_gap"] = _with(EMB, _round(_GAP, ["v1", "v2", "gap"]))
SQL["best_k_range_bic"] = _with(
    EMB, _round(f"SELECT run_id, k1, v1 AS b1, k2, v2 AS b2 FROM ({_GAP})", ["b1", "b2"])
)
SQL["best_k_range_slope"] = _with(
    EMB
    + f""",
sl AS ({_slopes('(avg_diameter * 20)')}),
sp AS (
  SELECT run_id, k AS k1, value AS d1, slope AS s1,
         lead(k) OVER (PARTITION BY run_id ORDER BY k) AS k2,
         lead(value) OVER (PARTITION BY run_id ORDER BY k) AS d2,
         lead(slope) OVER (PARTITION BY run_id ORDER BY k) AS s2,
         count(*) OVER (PARTITION BY run_id) AS n_slopes
  FROM sl
),
single AS (SELECT run_id, k1, d1, s1, k1 AS k2, d1 AS d2, s1 AS s2 FROM sp WHERE n_slopes = 1),
multi AS (
  SELECT run_id, k1, d1, s1, k2, d2, s2 FROM sp WHERE n_slopes > 1 AND k2 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_id
                             ORDER BY CASE WHEN s1 <= -1 AND s2 >= -1 THEN 0 ELSE 1 END, k1) = 1
),
found AS (SELECT * FROM single UNION ALL SELECT * FROM multi)""",
    _round(
        "SELECT r.run_id, f.k1, f.d1, f.s1, f.k2, f.d2, f.s2 FROM (SELECT DISTINCT run_id FROM curve) r "
        "LEFT JOIN found f ON f.run_id = r.run_id",
        ["d1", "s1", "d2", "s2"],
    ),
)
SQL["best_k_diameter_drop"] = _with(
    EMB
    + f""",
dr AS (
  SELECT run_id, k2, v1 - v2 AS drop FROM ({_pairs('avg_diameter')})
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY v1 - v2 DESC, k2) = 1
)""",
    _round(
        """
SELECT r.run_id, CAST(CASE WHEN dr.drop > 0 THEN dr.k2 ELSE 0 END AS INTEGER) AS k,
       CASE WHEN dr.drop > 0 THEN dr.drop ELSE 0.0 END AS drop
FROM (SELECT DISTINCT run_id FROM curve) r LEFT JOIN dr ON dr.run_id = r.run_id""",
        ["drop"],
    ),
)
SQL["best_k_error_ratio"] = _with(
    EMB,
    _round(
        f"""
SELECT run_id, k2 AS k, ratio FROM (
  SELECT run_id, k2, CASE WHEN v2 <> 0 THEN v1 / v2 END AS ratio FROM ({_pairs('wssse')})
) QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ratio ASC NULLS LAST, k2) = 1""",
        ["ratio"],
    ),
)
_MID = """
SELECT run_id, x1 + abs(x2 - x1) / 2.0 AS mid_k, y1 + abs(y2 - y1) / 2.0 AS mid_value FROM (
  SELECT run_id, arg_min(k, k) AS x1, arg_min(avg_diameter, k) AS y1, arg_max(k, k) AS x2, arg_max(avg_diameter, k) AS y2
  FROM curve GROUP BY run_id
)"""
SQL["midpoint"] = _with(EMB, _round(_MID, ["mid_k", "mid_value"]))
SQL["elbow_point"] = _with(
    EMB
    + f""",
mids AS ({_MID}),
ranked AS (
  SELECT run_id, k, avg_diameter, row_number() OVER (PARTITION BY run_id ORDER BY k) AS pos,
         count(*) OVER (PARTITION BY run_id) AS n
  FROM curve
)""",
    _round(
        """
SELECT r.run_id, r.k, r.avg_diameter FROM ranked r JOIN mids m ON m.run_id = r.run_id
WHERE r.pos = 2 OR (r.pos > 2 AND r.pos < r.n)
QUALIFY row_number() OVER (
  PARTITION BY r.run_id
  ORDER BY sqrt((r.k - m.mid_k) * (r.k - m.mid_k) + (r.avg_diameter - m.mid_value) * (r.avg_diameter - m.mid_value)),
           CASE WHEN r.pos = 2 THEN 0 ELSE 1 END, r.k DESC) = 1""",
        ["avg_diameter"],
    ),
)
SQL["scale_points"] = _with(
    EMB,
    _round(
        """
SELECT run_id, k,
       CASE WHEN (max_y - min_y) > (max_x - min_x) THEN k * CASE WHEN max_x <> 0 THEN max_y / max_x END
            ELSE CAST(k AS DOUBLE) END AS x,
       CASE WHEN (max_y - min_y) > (max_x - min_x) THEN y
            ELSE y * CASE WHEN max_y <> 0 THEN max_x / max_y END END AS y
FROM (
  SELECT run_id, k, wssse AS y,
         min(CAST(k AS DOUBLE)) OVER w AS min_x, max(CAST(k AS DOUBLE)) OVER w AS max_x,
         min(wssse) OVER w AS min_y, max(wssse) OVER w AS max_y
  FROM curve WINDOW w AS (PARTITION BY run_id)
)""",
        ["x", "y"],
    ),
)
SQL["first_k"] = _with(EMB, "SELECT run_id, min(k) AS k FROM curve GROUP BY run_id")
SQL["diameter_observations"] = _with(EMB, _round(_obs(), ["mean_diameter"]))
SQL["overall_mean"] = _with(
    EMB, _round(f"SELECT run_id, avg(mean_diameter) AS overall_mean FROM ({_obs()}) GROUP BY run_id", ["overall_mean"])
)
SQL["between_group_ssd"] = _with(
    EMB,
    _round(
        f"""
SELECT run_id, sum(n_clusters * (mean_diameter - y) * (mean_diameter - y)) AS between_group_ssd FROM (
  SELECT *, avg(mean_diameter) OVER (PARTITION BY run_id) AS y FROM ({_obs()})
) GROUP BY run_id""",
        ["between_group_ssd"],
    ),
)
SQL["msb"] = _with(
    EMB,
    _round(
        f"SELECT run_id, CASE WHEN count(*) > 1 THEN avg(mean_diameter) / (count(*) - 1) END AS msb "
        f"FROM ({_obs()}) GROUP BY run_id",
        ["msb"],
    ),
)
SQL["center_data"] = _with(
    EMB,
    _round(
        "SELECT run_id, k, cluster, diameter - avg(diameter) OVER (PARTITION BY run_id, k) AS centered FROM diams",
        ["centered"],
    ),
)

# k selection: the candidate rule is plain arithmetic on the point count
SQL["candidate_ks"] = _with(
    UA,
    """
SELECT CAST(pow(2, e) AS INTEGER) AS k, 'small' AS branch
FROM (SELECT count(*) AS n FROM ua) c, range(1, 31) r(e)
WHERE CASE WHEN n > 100000 THEN e >= 4 AND pow(2, e) <= 1000 ELSE pow(2, e) <= n END
UNION ALL
SELECT CAST(pow(2, e) AS INTEGER) AS k, 'large' AS branch
FROM (SELECT count(*) AS n FROM ua) c, range(1, 31) r(e)
WHERE CASE WHEN n > 5 THEN e >= 3 AND pow(2, e) <= 100 ELSE pow(2, e) <= n END""",
)

# k search with the fixed-centre model (first k users by id) as the scorer: the
# BIC and diameter of every k in 2..32, then the search replayed step by step.
UA_ALL_K = (
    UA
    + """,
ua_c AS (
  SELECT CAST(row_number() OVER (ORDER BY user_id) AS INTEGER) AS rn, features AS c
  FROM ua QUALIFY row_number() OVER (ORDER BY user_id) <= 32
),
kk AS (SELECT CAST(k AS INTEGER) AS k FROM range(2, 33) t(k)),
pr AS (
  SELECT kk.k, p.user_id, c.rn - 1 AS cluster, """
    + d2("p.features", "c.c")
    + """ AS d2
  FROM ua p CROSS JOIN ua_c c JOIN kk ON c.rn <= kk.k
),
best AS (
  SELECT k, user_id, cluster, d2, sqrt(d2) AS dist
  FROM pr QUALIFY row_number() OVER (PARTITION BY k, user_id ORDER BY d2, cluster) = 1
),
cs AS (SELECT k, cluster, count(*) AS n, max(dist) AS md, sum(d2) AS sse FROM best GROUP BY k, cluster),
sc AS (SELECT k, CAST(sum(n) AS BIGINT) AS n, sum(sse) AS w, avg(2 * md) AS avg_d FROM cs GROUP BY k),
lnl AS (
  SELECT k, n, avg_d, CASE WHEN w / n > 0 THEN -CAST(n AS DOUBLE) / 2.0 * (ln(2 * pi() * (w / n)) + 1) END AS ln_l
  FROM sc
),
scores AS (
  SELECT k, avg_d, ln_l - CAST(k * (SELECT count(*) FROM ua_dims) + 1 AS DOUBLE) / 2.0 * ln(CAST(n AS DOUBLE)) AS bic
  FROM lnl
),
sweep_pairs AS (
  SELECT k AS k1, bic AS b1, lead(k) OVER (ORDER BY k) AS k2, lead(bic) OVER (ORDER BY k) AS b2
  FROM scores WHERE k IN (2, 4, 8, 16, 32)
),
gap AS (
  SELECT k1, b1, k2, b2 FROM sweep_pairs WHERE k2 IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY abs(b2 - b1) DESC, k1) = 1
)"""
)

SQL["binsearch_bic"] = (
    "WITH RECURSIVE "
    + UA_ALL_K.strip()
    + """,
search(k1, b1, k2, b2) AS (
  SELECT k1, b1, k2, b2 FROM gap
  UNION ALL
  SELECT CASE WHEN abs(s.b1 - m.bic) > abs(m.bic - s.b2) THEN s.k1 ELSE m.k END,
         CASE WHEN abs(s.b1 - m.bic) > abs(m.bic - s.b2) THEN s.b1 ELSE m.bic END,
         CASE WHEN abs(s.b1 - m.bic) > abs(m.bic - s.b2) THEN m.k ELSE s.k2 END,
         CASE WHEN abs(s.b1 - m.bic) > abs(m.bic - s.b2) THEN m.bic ELSE s.b2 END
  FROM search s JOIN scores m ON m.k = s.k1 + (s.k2 - s.k1 + 1) // 2
  WHERE s.k2 - s.k1 > 1
)
"""
    + _round(
        """
SELECT CAST(CASE WHEN k2 <= k1 OR b1 < b2 THEN k1 ELSE k2 END AS INTEGER) AS k,
       CASE WHEN k2 <= k1 OR b1 < b2 THEN b1 ELSE b2 END AS bic
FROM search WHERE k2 - k1 <= 1""",
        ["bic"],
    )
)
SQL["linear_bic"] = _with(
    UA_ALL_K,
    _round(
        """
SELECT k, bic FROM scores
WHERE list_contains((SELECT list_append(range(k1, k2, 2), k2) FROM gap), k)
QUALIFY row_number() OVER (ORDER BY bic DESC, k) = 1""",
        ["bic"],
    ),
)
SQL["binsearch_diameter"] = (
    "WITH RECURSIVE "
    + UA_ALL_K.strip()
    + """,
search(k1, d1, k2, d2) AS (
  SELECT 2, (SELECT avg_d FROM scores WHERE k = 2), 32, (SELECT avg_d FROM scores WHERE k = 32)
  UNION ALL
  SELECT CASE WHEN (s.d1 - m.avg_d) > (m.avg_d - s.d2) THEN s.k1 ELSE m.k END,
         CASE WHEN (s.d1 - m.avg_d) > (m.avg_d - s.d2) THEN s.d1 ELSE m.avg_d END,
         CASE WHEN (s.d1 - m.avg_d) > (m.avg_d - s.d2) THEN m.k ELSE s.k2 END,
         CASE WHEN (s.d1 - m.avg_d) > (m.avg_d - s.d2) THEN m.avg_d ELSE s.d2 END
  FROM search s JOIN scores m ON m.k = s.k1 + (s.k2 - s.k1 + 1) // 2
  WHERE s.k2 - s.k1 > 1
)
"""
    + _round(
        """
SELECT CAST(CASE WHEN k2 <= k1 THEN k1 ELSE k2 END AS INTEGER) AS k,
       CASE WHEN k2 <= k1 THEN d1 ELSE d2 END AS avg_diameter
FROM search WHERE k2 - k1 <= 1""",
        ["avg_diameter"],
    )
)


# ---- real fits: points around four far places, whose best models of one to four clusters are known ----
# A and B lie 12 apart, C and D 120, the two pairs 1000: k = 2 parts the pairs, k = 3 also C from D.

_TOWNS = """
towns AS (
  SELECT vec_id % 4 AS g, [
    CASE WHEN vec_id % 4 >= 2 THEN 1000.0::DOUBLE ELSE 0 END,
    CASE WHEN vec_id % 2 = 1 THEN CASE WHEN vec_id % 4 >= 2 THEN 120.0::DOUBLE ELSE 12 END ELSE 0 END,
    embedding[1]::DOUBLE * 0.5, embedding[2]::DOUBLE * 0.5, embedding[3]::DOUBLE * 0.5, embedding[4]::DOUBLE * 0.5] AS x
  FROM embeddings
),
parts AS (
  SELECT k, x, CASE k WHEN 1 THEN 0 WHEN 2 THEN g // 2 WHEN 3 THEN greatest(g - 1, 0) ELSE g END AS cluster
  FROM towns, (SELECT unnest([1, 2, 3, 4]) AS k)
),
means AS (
  SELECT k, cluster, count(*) AS members, [avg(x[1]), avg(x[2]), avg(x[3]), avg(x[4]), avg(x[5]), avg(x[6])] AS c FROM parts GROUP BY k, cluster
),
per AS (
  SELECT k, cluster, count(*) AS n, sum(d2) AS sse, 2 * sqrt(max(d2)) AS diameter
  FROM (SELECT p.k, p.cluster, """ + d2("p.x", "m.c") + """ AS d2 FROM parts p JOIN means m USING (k, cluster)) GROUP BY k, cluster
),
sums AS (SELECT k, sum(n) AS n, sum(sse) AS wssse, avg(diameter) AS avg_diameter FROM per GROUP BY k),
scores AS (
  SELECT CAST(k AS INTEGER) AS k, CAST(n AS BIGINT) AS n, wssse, avg_diameter, ln_l - (k * 6 + 1) AS aic, ln_l - (k * 6 + 1) / 2.0 * ln(n) AS bic
  FROM (SELECT *, -n / 2.0 * (ln(2 * pi() * wssse / n) + 1) AS ln_l FROM sums)
),
gaps AS (
  SELECT kind, k AS k1, bic AS b1, lead(k) OVER w AS k2, lead(bic) OVER w AS b2
  FROM scores, (SELECT unnest(['list', 'all']) AS kind) WHERE k IN (1, 2, 4) AND (kind = 'list' OR k > 1) WINDOW w AS (PARTITION BY kind ORDER BY k)
),
widest AS (
  SELECT * FROM gaps WHERE k2 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY kind ORDER BY abs(b2 - b1) DESC, k1) = 1
),
halves AS (
  SELECT kind, CASE WHEN k2 - k1 = 1 THEN k1 WHEN abs(b1 - b) > abs(b - b2) THEN k1 ELSE k1 + 1 END AS k1, CASE WHEN k2 - k1 = 1 THEN k2 WHEN abs(b1 - b) > abs(b - b2) THEN k1 + 1 ELSE k2 END AS k2
  FROM (SELECT w.*, s.bic AS b FROM widest w LEFT JOIN scores s ON s.k = w.k1 + 1)
),
chosen AS (
  SELECT h.kind, CASE WHEN a.bic < b.bic THEN h.k1 ELSE h.k2 END AS k FROM halves h JOIN scores a ON a.k = h.k1 JOIN scores b ON b.k = h.k2
  UNION ALL SELECT 'one', 2
)"""


def _scores(body: str) -> str:
    return _with(_TOWNS, _round(body, ["wssse", "avg_diameter", "aic", "bic"]))


SQL["train_kmeans"] = _with(_TOWNS, """
SELECT CAST(cluster AS INTEGER) AS cluster, members, CAST(unnest(generate_series(0, 5)) AS INTEGER) AS dim, round(unnest(c), 6) AS center FROM means WHERE k = 4""")
SQL["train_kmeans_default"] = _scores("SELECT * FROM scores WHERE k = 4")
SQL["compute_next_model"] = _scores("SELECT * FROM scores WHERE k IN (2, 4)")
SQL["next_model_diameter"] = _with(_TOWNS, _round("SELECT k, avg_diameter FROM scores WHERE k = 4", ["avg_diameter"]))
SQL["sweep"] = _scores("SELECT * FROM scores WHERE k IN (1, 2, 4)")
SQL["select_k"] = _scores("SELECT scores.* FROM scores JOIN chosen USING (k) WHERE kind = 'list'")
SQL["run_kmeans"] = _scores("SELECT scores.*, kind FROM scores JOIN chosen USING (k)")
SQL["write_once"] = """
SELECT 'all' AS month, 'all' AS category, CAST(attempt AS INTEGER) AS attempt, attempt = 1 AS ran,
       (SELECT count(DISTINCT o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey) AS members
FROM (SELECT unnest([1, 2]) AS attempt)"""
