"""Independent SQL (DuckDB dialect) for every exactly-checkable query.

Each text reads only the driver's tables (pre-registered views) and
recomputes the result from scratch, without any of the engine's code.
Column names equal those of the Spark query.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fragments
_REVIEWS = """
reviews AS (
  SELECT 'U' || CAST(o.o_custkey AS VARCHAR) || '-' || l.l_returnflag || l.l_linestatus AS UserId,
         'P' || CAST(l.l_partkey AS VARCHAR) || '-' || l.l_returnflag || l.l_linestatus AS ProductId,
         CAST(least(5, 1 + (o.o_custkey % 3) * (l.l_partkey % 3) + CASE WHEN CAST(l.l_quantity AS INTEGER) % 5 = 0 THEN 1 ELSE 0 END) AS FLOAT) AS Score,
         CAST(epoch(l.l_shipdate) AS BIGINT) AS Time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_NON_NULL = """
non_null AS (
  SELECT * FROM reviews
  WHERE UserId IS NOT NULL AND ProductId IS NOT NULL
    AND Score IS NOT NULL AND NOT isnan(Score))"""

_DEDUP = """
dedup AS (
  SELECT UserId, ProductId, Score, Time FROM (
    SELECT *, row_number() OVER (PARTITION BY UserId, ProductId
                                 ORDER BY Time DESC NULLS LAST, Score DESC) AS rn
    FROM non_null) d
  WHERE rn = 1)"""

_ACTIVE = """
active_u AS (
  SELECT * FROM dedup WHERE UserId IN (
    SELECT UserId FROM dedup GROUP BY UserId HAVING count(*) >= 5)),
active_p AS (
  SELECT * FROM active_u WHERE ProductId IN (
    SELECT ProductId FROM active_u GROUP BY ProductId
    HAVING count(*) >= 5))"""

_INDEX = """
uidx AS (
  SELECT UserId, CAST(row_number() OVER (ORDER BY count(*) DESC, UserId) - 1 AS INTEGER) AS user_idx
  FROM active_p GROUP BY UserId),
pidx AS (
  SELECT ProductId, CAST(row_number() OVER (ORDER BY count(*) DESC, ProductId) - 1 AS INTEGER) AS product_idx
  FROM active_p GROUP BY ProductId),
ratings AS (
  SELECT user_idx, product_idx, Score
  FROM active_p JOIN uidx USING (UserId) JOIN pidx USING (ProductId))"""


def _with(*frags: str) -> str:
    return "WITH " + ",".join(frags) + "\n"


CLEAN_CHAIN = _with(_REVIEWS, _NON_NULL, _DEDUP, _ACTIVE, _INDEX)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["reviews_scan"] = _with(_REVIEWS) + "SELECT UserId, ProductId, Score, Time FROM reviews"
    q["dedup_latest"] = _with(_REVIEWS, _NON_NULL, _DEDUP) + \
        "SELECT UserId, ProductId, Score, Time FROM dedup"
    q["user_counts"] = _with(_REVIEWS, _NON_NULL, _DEDUP) + \
        "SELECT UserId, count(*) AS nb_avis FROM dedup GROUP BY UserId"
    q["product_counts"] = _with(_REVIEWS, _NON_NULL, _DEDUP, _ACTIVE) + \
        "SELECT ProductId, count(*) AS nb_avis FROM active_u GROUP BY ProductId"
    q["active_users"] = _with(_REVIEWS, _NON_NULL, _DEDUP, _ACTIVE) + \
        "SELECT UserId, ProductId, Score, Time FROM active_u"
    q["active_products"] = _with(_REVIEWS, _NON_NULL, _DEDUP, _ACTIVE) + \
        "SELECT UserId, ProductId, Score, Time FROM active_p"
    q["user_index"] = CLEAN_CHAIN + "SELECT UserId, user_idx FROM uidx"
    q["product_index"] = CLEAN_CHAIN + "SELECT ProductId, product_idx FROM pidx"
    q["cleaned_ratings"] = CLEAN_CHAIN + "SELECT user_idx, product_idx, Score FROM ratings"
    q["cleaning_funnel"] = CLEAN_CHAIN + """
SELECT CAST(0 AS INTEGER) AS stage_no, 'raw' AS stage, count(*) AS n_rows FROM reviews
UNION ALL SELECT 1, 'non_null', count(*) FROM non_null
UNION ALL SELECT 2, 'dedup', count(*) FROM dedup
UNION ALL SELECT 3, 'active_users', count(*) FROM active_u
UNION ALL SELECT 4, 'active_products', count(*) FROM active_p
UNION ALL SELECT 5, 'final', count(*) FROM ratings"""
    q.update(oracle_sql_more())
    return q


_GAPS = """
gaps AS (
  SELECT CASE WHEN l.l_linenumber <> 1 THEN 'U' || CAST(o.o_custkey AS VARCHAR) || '-' || l.l_returnflag || l.l_linestatus END AS UserId,
         CASE WHEN l.l_linenumber <> 3 THEN 'P' || CAST(l.l_partkey AS VARCHAR) || '-' || l.l_returnflag || l.l_linestatus END AS ProductId,
         CASE WHEN l.l_linenumber = 2 THEN CAST('NaN' AS FLOAT)
              WHEN l.l_linenumber = 4 THEN CAST(NULL AS FLOAT)
              ELSE CAST(least(5, 1 + (o.o_custkey % 3) * (l.l_partkey % 3) + CASE WHEN CAST(l.l_quantity AS INTEGER) % 5 = 0 THEN 1 ELSE 0 END) AS FLOAT) END AS Score,
         CAST(epoch(l.l_shipdate) AS BIGINT) AS Time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_SPLIT = """
labelled AS (
  SELECT user_idx, product_idx, Score,
         CASE WHEN b < 8000 THEN 'train' WHEN b < 9000 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', CAST(user_idx AS VARCHAR),
                   CAST(product_idx AS VARCHAR))), 1, 8)) AS BIGINT) % 10000 AS b
        FROM ratings) h),
train AS (SELECT * FROM labelled WHERE split = 'train'),
mu AS (SELECT avg(CAST(Score AS DOUBLE)) AS mu FROM train)"""


def _damped(d: int, name: str) -> str:
    return f"""
{name} AS (
  SELECT product_idx, (sum(CAST(Score AS DOUBLE)) + {d} * (SELECT mu FROM mu))
                      / (count(*) + {d}) AS prediction
  FROM train GROUP BY product_idx)"""


def _rmse_of(split_name: str, table: str) -> str:
    return f"""SELECT sqrt(avg(power(CAST(Score AS DOUBLE) - prediction, 2)))
  FROM labelled LEFT JOIN {table} USING (product_idx) WHERE split = '{split_name}'"""


_FACTORS = """
fu AS (SELECT vec_id // 20 AS uid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0),
fi AS (SELECT vec_id AS iid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 <> 0)"""


def _topk(name: str, users: str, items: str, k: int = 5) -> str:
    return f"""
{name} AS (
  SELECT uid, iid, score, CAST(rk AS INTEGER) AS rk FROM (
    SELECT uid, iid, score,
           row_number() OVER (PARTITION BY uid ORDER BY score DESC, iid) AS rk
    FROM (SELECT uid, iid, list_dot_product(fu.v, fi.v) AS score
          FROM (SELECT * FROM fu WHERE {users}) fu, (SELECT * FROM fi WHERE {items}) fi) s) r
  WHERE rk <= {k})"""


_STORE = _FACTORS + "," + _topk("b0", "true", "true", 20) + "," + \
    _topk("b1", "uid IN (SELECT user_id FROM events)",
          "iid IN (SELECT CAST(json_extract(props, '$.k') AS INTEGER) + 50 FROM events)", 20) + """,
store AS (
  SELECT CAST(uid AS INTEGER) AS user_idx, rk, CAST(iid AS INTEGER) AS product_idx,
         CAST(score AS FLOAT) AS rating, CAST(0 AS BIGINT) AS batch_id FROM b0
  UNION ALL
  SELECT CAST(uid AS INTEGER), rk, CAST(iid AS INTEGER), CAST(score AS FLOAT), CAST(1 AS BIGINT) FROM b1),
latest AS (
  SELECT s.* FROM store s
  JOIN (SELECT user_idx, max(batch_id) AS batch_id FROM store GROUP BY user_idx) m
    USING (user_idx, batch_id)),
requests AS (
  SELECT user_id, CASE WHEN user_id % 25 = 0 THEN NULL ELSE user_id % 25 - 2 END AS n
  FROM (SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id FROM events) e),
sized AS (
  SELECT user_idx, batch_id, CAST(count(*) AS INTEGER) AS n_items FROM latest GROUP BY user_idx, batch_id)"""

_MESSAGES = """
messages AS (
  SELECT event_id,
         'U' || CAST(user_id AS VARCHAR) || '-' || flags AS UserId,
         'P' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) || '-' || flags AS ProductId,
         CAST(event_id % 5 + 1 AS FLOAT) AS Score,
         CAST(floor(epoch(ts)) AS BIGINT) AS Time
  FROM (SELECT *, (['AF', 'AO', 'NF', 'NO', 'RF', 'RO'])[event_id % 6 + 1] AS flags FROM events))"""


def oracle_sql_more() -> dict[str, str]:
    q: dict[str, str] = {}
    q["drop_nulls"] = _with(_GAPS) + """SELECT UserId, ProductId, Score, Time FROM gaps
WHERE UserId IS NOT NULL AND ProductId IS NOT NULL AND Score IS NOT NULL AND NOT isnan(Score)"""
    q["typed_casts"] = """
SELECT event_id,
       TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'x' || CAST(event_id AS VARCHAR)
                     ELSE CAST(event_id % 5 + 1 AS VARCHAR) END AS FLOAT) AS Score,
       TRY_CAST(CASE WHEN event_id % 11 = 0 THEN 'n/a'
                     ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS BIGINT) AS Time,
       props AS props_text
FROM events"""
    chain_split = CLEAN_CHAIN.rstrip() + "," + _SPLIT + "\n"
    q["hash_split"] = chain_split + "SELECT user_idx, product_idx, Score, split FROM labelled"
    q["split_counts"] = chain_split + "SELECT split, count(*) AS n_rows FROM labelled GROUP BY split"
    q["rmse_item_mean"] = chain_split.rstrip() + "," + _damped(0, "im") + """
SELECT split, count(*) AS n_rows, count(prediction) AS n_scored,
       count(*) - count(prediction) AS n_dropped,
       round(sqrt(avg(power(CAST(Score AS DOUBLE) - prediction, 2))), 6) AS rmse
FROM labelled LEFT JOIN im USING (product_idx) WHERE split <> 'train' GROUP BY split"""
    cands = ",".join(_damped(d, f"c{i}") for i, d in enumerate((0, 5, 20)))
    metrics = f""",
metrics AS (
  SELECT CAST(0 AS INTEGER) AS candidate, CAST(0 AS INTEGER) AS damping, ({_rmse_of('validation', 'c0')}) AS rmse_validation
  UNION ALL SELECT 1, 5, ({_rmse_of('validation', 'c1')})
  UNION ALL SELECT 2, 20, ({_rmse_of('validation', 'c2')})),
tests AS (
  SELECT 0 AS candidate, ({_rmse_of('test', 'c0')}) AS rmse_test
  UNION ALL SELECT 1, ({_rmse_of('test', 'c1')})
  UNION ALL SELECT 2, ({_rmse_of('test', 'c2')}))
"""
    q["candidate_rmse"] = chain_split.rstrip() + "," + cands + metrics + \
        "SELECT candidate, damping, round(rmse_validation, 6) AS rmse_validation FROM metrics"
    q["best_candidate"] = chain_split.rstrip() + "," + cands + metrics + """
SELECT m.candidate, m.damping, round(m.rmse_validation, 6) AS rmse_validation, round(t.rmse_test, 6) AS rmse_test
FROM (SELECT * FROM metrics ORDER BY rmse_validation, candidate LIMIT 1) m
JOIN tests t USING (candidate)"""
    q["events_json"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
    q["json_roundtrip"] = _with(_MESSAGES) + \
        "SELECT event_id, UserId, ProductId, Score, Time FROM messages"
    q["known_event_users"] = CLEAN_CHAIN.rstrip() + "," + _MESSAGES + """
SELECT DISTINCT m.UserId, u.user_idx FROM messages m JOIN uidx u USING (UserId)"""
    q["topk_all"] = _with(_FACTORS, _topk("t", "true", "true")) + """
SELECT uid AS user_id, rk AS rank, iid AS item_id, round(score, 4) AS score FROM t"""
    q["topk_subset"] = _with(_FACTORS, _topk(
        "t", "uid IN (SELECT user_id FROM events)", "true")) + """
SELECT uid AS user_id, rk AS rank, iid AS item_id, round(score, 4) AS score FROM t"""
    store = _with(_STORE)
    q["latest_lists"] = store + "SELECT user_idx, batch_id, n_items FROM sized"
    q["serve_user"] = store + """,
used AS (SELECT user_id, least(greatest(coalesce(n, 5), 1), 20) AS n_used FROM requests)
SELECT u.user_id, l.rk AS pos, 'Product_' || CAST(l.product_idx AS VARCHAR) AS product_id,
       l.product_idx, round(CAST(l.rating AS DOUBLE), 4) AS score,
       CAST(least(u.n_used, s.n_items) AS INTEGER) AS total
FROM used u JOIN latest l ON l.user_idx = u.user_id AND l.rk <= u.n_used
JOIN sized s ON s.user_idx = u.user_id""".replace("store +", "")
    q["compacted_lists"] = store + """
SELECT user_idx, CAST(CASE WHEN batch_id = 1 AND user_idx % 2 = 1 THEN 2 ELSE batch_id END AS BIGINT) AS batch_id, n_items
FROM sized"""
    q["indexed_lookup"] = q["serve_user"]
    q["serve_products"] = CLEAN_CHAIN.rstrip() + "," + q["serve_user"].strip().removeprefix("WITH").replace(
        "SELECT u.user_id, l.rk AS pos,", "served AS (\nSELECT u.user_id, l.rk AS pos,", 1).replace(
        "served AS", ",\nserved AS", 1) + """)
SELECT user_id, pos, s.product_idx, coalesce(p.ProductId, s.product_id) AS ProductId, score
FROM served s LEFT JOIN pidx p ON p.product_idx = s.product_idx"""
    q["store_encodings"] = """
WITH e AS (
  SELECT event_id, user_id, event_id % 7 AS kind, event_id // 1000 AS batch_id,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k, (event_id % 50) / 10 AS score
  FROM events),
items AS (
  SELECT user_id, batch_id, 0 AS pos, k AS product_idx, score FROM e WHERE kind IN (0, 1, 2)
  UNION ALL SELECT user_id, batch_id, 1, 7, score FROM e WHERE kind = 0
  UNION ALL SELECT user_id, batch_id, 1, 8, 1.5 FROM e WHERE kind = 2
  UNION ALL SELECT user_id, batch_id, 0, NULL, 0.0 FROM e WHERE kind = 3
  UNION ALL SELECT user_id, batch_id, 1, k, score FROM e WHERE kind = 3
  UNION ALL SELECT user_id, batch_id, 2, k, 0.0 FROM e WHERE kind = 3)
SELECT CAST(user_id AS INTEGER) AS user_idx, CAST(batch_id AS BIGINT) AS batch_id, CAST(pos AS INTEGER) AS pos,
       CAST(product_idx AS INTEGER) AS product_idx, round(CAST(CAST(score AS FLOAT) AS DOUBLE), 4) AS score, count(*) AS n
FROM items GROUP BY ALL"""
    q["readiness_rows"] = CLEAN_CHAIN + """
SELECT 'lineitem' AS name, true AS present, (SELECT count(*) FROM lineitem) AS n_rows
UNION ALL SELECT 'orders', true, (SELECT count(*) FROM orders)
UNION ALL SELECT 'events', true, (SELECT count(*) FROM events)
UNION ALL SELECT 'model', true, NULL
UNION ALL SELECT 'cleaned_ratings', true, (SELECT count(*) FROM ratings)
UNION ALL SELECT 'user_mapping', true, (SELECT count(*) FROM uidx)
UNION ALL SELECT 'metrics', true, NULL"""
    q["record_rows"] = store + """,
whole AS (
  SELECT (SELECT count(*) FROM sized) AS total,
         (SELECT string_agg(CAST(user_idx AS VARCHAR) || ':' || CAST(n_items AS VARCHAR), ',' ORDER BY user_idx)
          FROM (SELECT user_idx, n_items FROM sized ORDER BY user_idx LIMIT 5) f) AS sample)
SELECT source, total, true AS has_metrics, 'SUCCES' AS statut, 'Kafka -> Spark ALS -> Recommandations' AS pipeline,
       'ALS (Alternating Least Squares)' AS algorithme, CAST(10 AS INTEGER) AS rank, CAST(10 AS INTEGER) AS max_iter,
       true AS dated, sample AS echantillon, 'ok' AS status, total AS users, true AS has_files
FROM whole, (VALUES ('store'), ('compacted')) AS s(source)
UNION ALL
SELECT 'none', 0, false, 'AVERTISSEMENT', 'Kafka -> Spark ALS -> Recommandations', NULL, NULL, NULL, true, '', 'ok', 0, false"""
    q["point_lookup"] = store + """
SELECT user_idx, rk AS rank, product_idx, round(CAST(rating AS DOUBLE), 4) AS score
FROM latest WHERE user_idx = (SELECT max(user_idx) FROM sized)"""
    q["serve_unknown"] = store + """
SELECT r.user_id, 'unknown' AS status,
       (SELECT string_agg(CAST(user_idx AS VARCHAR), ', ' ORDER BY user_idx)
        FROM (SELECT user_idx FROM sized ORDER BY user_idx LIMIT 10) h) AS hint,
       (SELECT count(*) FROM sized) AS total_users,
       'Utilisateur ' || CAST(r.user_id AS VARCHAR) || ' non trouvé dans les recommandations.' AS error,
       'Essayez un de ces user_idx disponibles : [' ||
         (SELECT string_agg(chr(39) || CAST(user_idx AS VARCHAR) || chr(39), ', ' ORDER BY user_idx)
          FROM (SELECT user_idx FROM sized ORDER BY user_idx LIMIT 10) h) || ']' AS hint_text
FROM requests r WHERE r.user_id NOT IN (SELECT user_idx FROM sized)"""
    q["serve_overview"] = store + """
SELECT l.user_idx, l.rk AS pos, 'Product_' || CAST(l.product_idx AS VARCHAR) AS product_id,
       (SELECT count(*) FROM sized) AS total_users
FROM latest l JOIN (SELECT user_idx FROM sized ORDER BY user_idx LIMIT 20) f USING (user_idx)
WHERE l.rk <= 5"""
    q["serve_users"] = store + "SELECT user_idx, (SELECT count(*) FROM sized) AS total FROM sized ORDER BY user_idx LIMIT 200"
    q["serve_random"] = store + """
SELECT user_idx FROM sized ORDER BY md5(CAST(user_idx AS VARCHAR) || '|42'), user_idx LIMIT 1"""
    q["display_table"] = store + """
SELECT user_idx, rk AS rank, 'Product_' || CAST(product_idx AS VARCHAR) AS product_id,
       round(CAST(rating AS DOUBLE), 4) AS score,
       CAST(floor(CAST(rating AS DOUBLE)
            / (max(CAST(rating AS DOUBLE)) OVER (PARTITION BY user_idx) * 1.2) * 100 + 0.5) AS INTEGER)
         AS bar_pct
FROM latest"""
    q["user_total"] = store + "SELECT count(DISTINCT user_idx) AS total_users FROM sized"
    q["status_row"] = store + """
SELECT fichiers_generes, CASE WHEN fichiers_generes = 0 THEN 'AVERTISSEMENT' ELSE 'SUCCES' END AS statut
FROM (SELECT count(DISTINCT batch_id) AS fichiers_generes FROM store) f"""
    q["list_sizes_sample"] = store + """
SELECT user_idx, n_items FROM sized ORDER BY user_idx LIMIT 5"""
    q["stream_batches"] = CLEAN_CHAIN.rstrip() + "," + _MESSAGES + """,
sliced AS (
  SELECT m.*, (m.event_id * 4) // (SELECT max(event_id) + 1 FROM events) AS batch_id
  FROM messages m)
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS received, CAST(0 AS BIGINT) AS malformed,
       count(DISTINCT u.user_idx) AS known_users
FROM sliced LEFT JOIN uidx u USING (UserId) GROUP BY batch_id"""
    q["stream_odd_batches"] = chain_split.rstrip() + "," + _MESSAGES + """,
sliced AS (
  SELECT m.*, (m.event_id * 4) // (SELECT max(event_id) + 1 FROM events) AS batch_id
  FROM messages m),
known AS (
  SELECT s.batch_id, s.event_id, u.user_idx
  FROM sliced s JOIN uidx u USING (UserId) WHERE s.event_id % 9 <> 0 AND s.batch_id < 3)
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS received, count(*) FILTER (WHERE event_id % 9 = 0) AS malformed,
       (SELECT count(DISTINCT user_idx) FROM known k WHERE k.batch_id = s.batch_id) AS known_users,
       EXISTS (SELECT 1 FROM known k JOIN train t USING (user_idx) WHERE k.batch_id = s.batch_id) AS stored
FROM sliced s GROUP BY batch_id"""
    q["model_roundtrip"] = chain_split + """
SELECT DISTINCT user_idx, CAST(10 AS INTEGER) AS rank, true AS same FROM train"""
    q["als_scored_keys"] = chain_split + """
SELECT user_idx, product_idx, Score FROM labelled
WHERE split = 'validation' AND user_idx IN (SELECT user_idx FROM train)
  AND product_idx IN (SELECT product_idx FROM train)"""
    q["als_list_shape"] = chain_split + """
SELECT user_idx, CAST(least(5, n) AS INTEGER) AS n_items, CAST(least(5, n) AS INTEGER) AS n_distinct, true AS ordered
FROM (SELECT DISTINCT user_idx FROM train) u, (SELECT count(DISTINCT product_idx) AS n FROM train) i"""
    q["als_residuals"] = chain_split + """
SELECT user_idx, count(*) AS n_ratings, true AS solved FROM train GROUP BY user_idx"""
    q["stream_list_sizes"] = chain_split.rstrip() + "," + _MESSAGES + """,
sliced AS (
  SELECT m.*, (m.event_id * 4) // (SELECT max(event_id) + 1 FROM events) AS batch_id
  FROM messages m)
SELECT user_idx, CAST(max(batch_id) AS BIGINT) AS batch_id,
       CAST(least(20, (SELECT count(DISTINCT product_idx) FROM train)) AS INTEGER) AS n_items
FROM sliced JOIN uidx USING (UserId)
WHERE user_idx IN (SELECT user_idx FROM train) GROUP BY user_idx"""
    q["csv_scan"] = \
        _with(_REVIEWS) + "SELECT UserId, ProductId, Score, Time FROM reviews"
    q["ratings_roundtrip"] = CLEAN_CHAIN + "SELECT user_idx, product_idx, Score FROM ratings"
    q["dictionary_roundtrip"] = CLEAN_CHAIN + "SELECT UserId, user_idx FROM uidx"
    q["message_replay"] = _with(_REVIEWS) + "SELECT UserId, ProductId, Score, Time FROM reviews"
    q["pair_scores"] = _with(_FACTORS) + """
SELECT e.event_id, CAST(e.user_id AS INTEGER) AS user_id, CAST(e.item_id AS INTEGER) AS item_id,
       round(list_dot_product(fu.v, fi.v), 4) AS score
FROM (SELECT event_id, user_id,
             CAST(json_extract(props, '$.k') AS INTEGER) + 50 AS item_id FROM events) e
JOIN fu ON fu.uid = e.user_id JOIN fi ON fi.iid = e.item_id"""
    return q
