"""DuckDB SQL equivalents of the registered Spark queries.

Each string runs against the pre-registered views (``events``, ``orders``,
``lineitem``, ``documents``, ``labels`` …).  The stand-in mappings of
``payrisk.sources.fixtures`` are restated here as CTEs so both sides start
from the same rows.  Every computed column is aliased to the Spark name and
doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from payrisk import schemas as _S


def _sql_list(i: int) -> str:
    vals = [g[i] for g in _S.GEO_POOL]
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in vals) + "]"


GEO_COUNTRY, GEO_CITY, GEO_LAT, GEO_LON = (_sql_list(i) for i in range(4))

PAYMENTS = f"""payments AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'card_' || CAST(user_id AS VARCHAR) AS card_id,
         'm_' || CAST(event_id % 50 AS VARCHAR) AS merchant_id,
         ts AS event_timestamp,
         value AS amount,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'pos' ELSE 'ecom' END AS channel,
         {GEO_COUNTRY}[event_id % 6 + 1] AS country,
         {GEO_CITY}[event_id % 6 + 1] AS city,
         CAST({GEO_LAT}[event_id % 6 + 1] AS DOUBLE) AS lat,
         CAST({GEO_LON}[event_id % 6 + 1] AS DOUBLE) AS lon,
         CAST(event_type = 'error' AS INTEGER) AS is_fraud
  FROM events)"""

PAYMENTS_LARGE = f"""payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
         'card_' || CAST(o_custkey AS VARCHAR) AS card_id,
         'm_' || CAST(l_suppkey AS VARCHAR) AS merchant_id,
         o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 61) % 86400) AS event_timestamp,
         l_extendedprice AS amount,
         CASE WHEN l_linestatus = 'O' THEN 'pos' ELSE 'ecom' END AS channel,
         {GEO_COUNTRY}[l_orderkey % 6 + 1] AS country,
         {GEO_CITY}[l_orderkey % 6 + 1] AS city,
         CAST({GEO_LAT}[l_orderkey % 6 + 1] AS DOUBLE) AS lat,
         CAST({GEO_LON}[l_orderkey % 6 + 1] AS DOUBLE) AS lon,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_fraud
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def vel(name: str, width: str, cols: str, src: str = "payments", key: str = "card_id") -> str:
    """Tumbling-window aggregate CTE stamped with the window end."""
    return f"""{name} AS (
  SELECT {key}, time_bucket(INTERVAL '{width}', event_timestamp) + INTERVAL '{width}' AS event_timestamp, {cols}
  FROM {src}
  WHERE {key} IS NOT NULL AND event_timestamp IS NOT NULL AND amount IS NOT NULL
  GROUP BY ALL)"""


V1M = vel("f1", "1 minute", "count(amount) AS txn_count_1m, sum(amount) AS amount_sum_1m")
V5M = vel("f5", "5 minutes", "count(amount) AS txn_count_5m, avg(amount) AS avg_transaction_amount_5m")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def pit_two_views(entity_ts: str) -> str:
    """CTE ``pit``: entities (event_id, card_id, event_timestamp, amount, is_fraud)
    as-of joined to f1 (TTL 120 min) and f5 (TTL 240 min), missing → 0."""
    return f"""ent AS (
  SELECT event_id, card_id, {entity_ts} AS event_timestamp, amount, is_fraud FROM payments
  WHERE card_id IS NOT NULL AND event_timestamp IS NOT NULL AND amount IS NOT NULL AND is_fraud IS NOT NULL),
j1 AS (
  SELECT ent.*,
         CASE WHEN f1.event_timestamp >= ent.event_timestamp - INTERVAL '120 minutes' THEN f1.txn_count_1m END AS txn_count_1m,
         CASE WHEN f1.event_timestamp >= ent.event_timestamp - INTERVAL '120 minutes' THEN f1.amount_sum_1m END AS amount_sum_1m
  FROM ent ASOF LEFT JOIN f1 ON ent.card_id = f1.card_id AND ent.event_timestamp >= f1.event_timestamp),
j2 AS (
  SELECT j1.*,
         CASE WHEN f5.event_timestamp >= j1.event_timestamp - INTERVAL '240 minutes' THEN f5.txn_count_5m END AS txn_count_5m,
         CASE WHEN f5.event_timestamp >= j1.event_timestamp - INTERVAL '240 minutes' THEN f5.avg_transaction_amount_5m END AS avg_transaction_amount_5m
  FROM j1 ASOF LEFT JOIN f5 ON j1.card_id = f5.card_id AND j1.event_timestamp >= f5.event_timestamp),
pit AS (
  SELECT event_id, card_id, event_timestamp, amount, is_fraud,
         coalesce(txn_count_1m, 0) AS txn_count_1m, coalesce(amount_sum_1m, 0.0) AS amount_sum_1m,
         coalesce(txn_count_5m, 0) AS txn_count_5m, coalesce(avg_transaction_amount_5m, 0.0) AS avg_transaction_amount_5m
  FROM j2)"""


ALIGN_5M = "time_bucket(INTERVAL '5 minutes', event_timestamp) + INTERVAL '5 minutes'"


def _v(width: str, suffix: str, stats: str) -> str:
    return vel("v", width, stats)


SQL: dict[str, str] = {}

SQL["card_velocity_1m"] = with_(PAYMENTS, V1M) + """
SELECT card_id, event_timestamp, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m FROM f1"""

SQL["card_velocity_5m"] = with_(PAYMENTS, V5M) + """
SELECT card_id, event_timestamp, txn_count_5m, round(avg_transaction_amount_5m, 6) AS avg_transaction_amount_5m FROM f5"""

for _w, _s in (("1 hour", "1h"), ("1 day", "1d")):
    SQL[f"card_velocity_{_s}"] = with_(PAYMENTS, vel(
        "v", _w, f"count(amount) AS txn_count_{_s}, sum(amount) AS amount_sum_{_s}, "
                 f"avg(amount) AS avg_transaction_amount_{_s}")) + f"""
SELECT card_id, event_timestamp, txn_count_{_s}, round(amount_sum_{_s}, 6) AS amount_sum_{_s},
       round(avg_transaction_amount_{_s}, 6) AS avg_transaction_amount_{_s} FROM v"""

SQL["card_velocity_1m_large"] = with_(PAYMENTS_LARGE, V1M) + """
SELECT card_id, event_timestamp, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m FROM f1"""

SQL["merchant_count_5m"] = with_(PAYMENTS, vel("v", "5 minutes", "count(amount) AS merchant_txn_count_5m",
                                               key="merchant_id")) + """
SELECT merchant_id, event_timestamp, merchant_txn_count_5m FROM v"""

SQL["card_amount_sum_5m"] = with_(PAYMENTS, vel("v", "5 minutes", "sum(amount) AS card_amount_sum_5m")) + """
SELECT card_id, event_timestamp, round(card_amount_sum_5m, 6) AS card_amount_sum_5m FROM v"""

SQL["geo_change"] = with_(PAYMENTS) + """
SELECT p.event_id, p.card_id, p.event_timestamp, p.country,
       CASE WHEN EXISTS (
         SELECT 1 FROM payments q
         WHERE q.card_id = p.card_id
           AND (q.event_timestamp < p.event_timestamp OR (q.event_timestamp = p.event_timestamp AND q.event_id < p.event_id))
           AND q.event_timestamp >= p.event_timestamp - INTERVAL '300 seconds'
           AND q.country IS DISTINCT FROM p.country) THEN 1 ELSE 0 END AS geo_change_flag_5m
FROM payments p WHERE p.card_id IS NOT NULL AND p.event_timestamp IS NOT NULL"""

SQL["pit_1m_strict"] = with_(PAYMENTS, V1M) + """, ent AS (
  SELECT event_id, card_id, event_timestamp, amount, is_fraud FROM payments
  WHERE card_id IS NOT NULL AND event_timestamp IS NOT NULL AND amount IS NOT NULL AND is_fraud IS NOT NULL)
SELECT ent.event_id, ent.card_id, ent.event_timestamp, ent.amount, ent.is_fraud,
       CASE WHEN f1.event_timestamp >= ent.event_timestamp - INTERVAL '120 minutes' THEN f1.txn_count_1m END AS txn_count_1m,
       round(CASE WHEN f1.event_timestamp >= ent.event_timestamp - INTERVAL '120 minutes' THEN f1.amount_sum_1m END, 6) AS amount_sum_1m
FROM ent ASOF LEFT JOIN f1 ON ent.card_id = f1.card_id AND ent.event_timestamp >= f1.event_timestamp"""

_PIT_SELECT = """
SELECT event_id, card_id, event_timestamp, amount, is_fraud, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m,
       txn_count_5m, round(avg_transaction_amount_5m, 6) AS avg_transaction_amount_5m FROM pit"""

SQL["pit_1m_5m_aligned"] = with_(PAYMENTS, V1M, V5M, pit_two_views(ALIGN_5M)) + _PIT_SELECT
SQL["pit_1m_5m_aligned_large"] = with_(PAYMENTS_LARGE, V1M, V5M, pit_two_views(ALIGN_5M)) + _PIT_SELECT

SQL["pit_1m_5m_stored"] = SQL["pit_1m_5m_aligned"]
SQL["card_velocity_1m_deliveries"] = SQL["card_velocity_1m"]
SQL["card_velocity_5m_deliveries"] = SQL["card_velocity_5m"]

SQL["latest_features"] = with_(PAYMENTS, V1M) + """
SELECT card_id, event_timestamp, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m
FROM f1 QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY event_timestamp DESC) = 1"""

SQL["online_lookup"] = with_(PAYMENTS, V1M, V5M) + """,
l1 AS (SELECT * FROM f1 QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY event_timestamp DESC) = 1),
l5 AS (SELECT * FROM f5 QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY event_timestamp DESC) = 1)
SELECT p.event_id, p.card_id, l1.txn_count_1m, round(l1.amount_sum_1m, 6) AS amount_sum_1m,
       l5.txn_count_5m, round(l5.avg_transaction_amount_5m, 6) AS avg_transaction_amount_5m
FROM payments p LEFT JOIN l1 ON p.card_id = l1.card_id LEFT JOIN l5 ON p.card_id = l5.card_id"""


# ---------------------------------------------------------------- scoring / prediction log
def _pit_no_fill(name: str = "s2") -> str:
    return f"""ent AS (SELECT event_id, card_id, event_timestamp, amount FROM payments),
s1 AS (
  SELECT ent.*,
         CASE WHEN f1.event_timestamp >= ent.event_timestamp - INTERVAL '120 minutes' THEN f1.txn_count_1m END AS txn_count_1m,
         CASE WHEN f1.event_timestamp >= ent.event_timestamp - INTERVAL '120 minutes' THEN f1.amount_sum_1m END AS amount_sum_1m
  FROM ent ASOF LEFT JOIN f1 ON ent.card_id = f1.card_id AND ent.event_timestamp >= f1.event_timestamp),
{name} AS (
  SELECT s1.*,
         CASE WHEN f5.event_timestamp >= s1.event_timestamp - INTERVAL '240 minutes' THEN f5.txn_count_5m END AS txn_count_5m,
         CASE WHEN f5.event_timestamp >= s1.event_timestamp - INTERVAL '240 minutes' THEN f5.avg_transaction_amount_5m END AS avg_transaction_amount_5m
  FROM s1 ASOF LEFT JOIN f5 ON s1.card_id = f5.card_id AND s1.event_timestamp >= f5.event_timestamp)"""


def heuristic(amount: str, t1: str, t5: str) -> str:
    logit = f"(((-6.0 + CAST({amount} AS DOUBLE) / 250.0) + CAST({t1} AS DOUBLE) * 0.35) + CAST({t5} AS DOUBLE) * 0.08)"
    return f"least(greatest(1.0 / (1.0 + exp(-{logit})), 0.001), 0.999)"


SCORED = _pit_no_fill() + f""",
scored AS (
  SELECT event_id, card_id, event_timestamp, amount,
         coalesce(txn_count_1m, 0) AS txn_count_1m, coalesce(amount_sum_1m, 0.0) AS amount_sum_1m,
         coalesce(txn_count_5m, 0) AS txn_count_5m, coalesce(avg_transaction_amount_5m, 0.0) AS avg_transaction_amount_5m,
         list_filter([CASE WHEN txn_count_1m IS NULL THEN 'txn_count_1m' END,
                      CASE WHEN amount_sum_1m IS NULL THEN 'amount_sum_1m' END,
                      CASE WHEN txn_count_5m IS NULL THEN 'txn_count_5m' END,
                      CASE WHEN avg_transaction_amount_5m IS NULL THEN 'avg_transaction_amount_5m' END],
                     lambda x: x IS NOT NULL) AS missing_features,
         {heuristic('amount', 'coalesce(txn_count_1m, 0)', 'coalesce(txn_count_5m, 0)')} AS fraud_probability
  FROM s2),
scored2 AS (
  SELECT *, CASE WHEN fraud_probability >= 0.5 THEN 'fraud' ELSE 'approve' END AS decision, 'fallback' AS model_version
  FROM scored)"""

PLOG = SCORED + """,
plog AS (
  SELECT event_timestamp AS ts, event_id, card_id, amount, event_timestamp AS event_ts, event_timestamp AS ingest_ts,
         txn_count_1m, amount_sum_1m, txn_count_5m, avg_transaction_amount_5m,
         CASE WHEN (CAST(event_id AS BIGINT) * 31) % 50 <> 0 THEN fraud_probability END AS fraud_probability,
         CASE WHEN (CAST(event_id AS BIGINT) * 31) % 50 <> 0 THEN decision END AS decision,
         model_version,
         ((CAST(event_id AS BIGINT) * 7919) % 4000) / 10.0 AS latency_ms,
         missing_features,
         false AS event_id_missing,
         CASE WHEN (CAST(event_id AS BIGINT) * 31) % 50 = 0 THEN 'error' ELSE 'ok' END AS status
  FROM scored2)"""

LABLOG = """lablog AS (
  SELECT event_id, is_fraud,
         event_timestamp + to_seconds(1800 + (CAST(event_id AS BIGINT) * 37) % 3600) AS label_timestamp
  FROM payments WHERE CAST(event_id AS BIGINT) % 10 <> 0
  UNION ALL
  SELECT event_id, 1 - is_fraud AS is_fraud,
         event_timestamp + to_seconds(5400 + (CAST(event_id AS BIGINT) * 37) % 3600) AS label_timestamp
  FROM payments WHERE CAST(event_id AS BIGINT) % 25 = 0)"""


def dedup(preds: str = "plog", labels: str = "lablog", grace: int = 5) -> str:
    return f"""pl AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(fraud_probability AS DOUBLE) AS fraud_probability FROM {preds}
  WHERE event_id IS NOT NULL AND fraud_probability IS NOT NULL AND ts IS NOT NULL AND NOT isnan(fraud_probability)),
pd AS (SELECT * FROM pl QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, fraud_probability DESC) = 1),
ll AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, label_timestamp, CAST(is_fraud AS INTEGER) AS is_fraud FROM {labels}
  WHERE event_id IS NOT NULL AND is_fraud IS NOT NULL AND label_timestamp IS NOT NULL),
ld AS (SELECT * FROM ll QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY label_timestamp DESC, is_fraud DESC) = 1),
el AS (
  SELECT * FROM pd WHERE ts <= (SELECT max(label_timestamp) FROM ld) - INTERVAL '{grace} minutes'),
j AS (SELECT el.event_id, el.ts, el.fraud_probability, ld.is_fraud, ld.label_timestamp FROM el LEFT JOIN ld ON el.event_id = ld.event_id),
m AS (SELECT * FROM j WHERE is_fraud IS NOT NULL)"""


def ap_sql(src: str = "m", name: str = "ap", label: str = "is_fraud", score: str = "fraud_probability") -> str:
    return f"""{name}_s AS (SELECT {score} AS sc, count(*) AS n, sum({label}) AS tp FROM {src}
  WHERE {score} IS NOT NULL AND {label} IS NOT NULL GROUP BY 1),
{name}_c AS (SELECT tp, n, sum(n) OVER (ORDER BY sc DESC) AS cn, sum(tp) OVER (ORDER BY sc DESC) AS ctp FROM {name}_s),
{name} AS (SELECT CASE WHEN sum(tp) > 0 AND sum(tp) < sum(n) THEN CAST(sum(tp * ctp / cn) / sum(tp) AS DOUBLE)
                      ELSE CAST('nan' AS DOUBLE) END AS pr_auc FROM {name}_c)"""


def _cls(src: str, thr: float = 0.5) -> str:
    p = f"(fraud_probability >= {thr})"
    return f"""CAST(sum(CASE WHEN is_fraud = 0 AND NOT {p} THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(sum(CASE WHEN is_fraud = 0 AND {p} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN is_fraud = 1 AND NOT {p} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN is_fraud = 1 AND {p} THEN 1 ELSE 0 END) AS BIGINT) AS tp"""


def psi_sql(p: str, expected: str, actual: str, bins: int = 10, eps: float = 1e-6) -> str:
    """CTEs ending in ``{p}`` with one row (psi, n_bins, n_expected, n_actual);
    ``expected`` / ``actual`` are queries with one column ``x``."""
    qs = ", ".join(f"{i / bins!r}" for i in range(1, bins))
    return f"""{p}e AS (SELECT CAST(x AS DOUBLE) AS x FROM ({expected}) WHERE x IS NOT NULL AND NOT isnan(CAST(x AS DOUBLE))),
{p}a AS (SELECT CAST(x AS DOUBLE) AS x FROM ({actual}) WHERE x IS NOT NULL AND NOT isnan(CAST(x AS DOUBLE))),
{p}q AS (SELECT list_sort(list_distinct(quantile_cont(x, [{qs}]))) AS edges FROM {p}e),
{p}b AS (SELECT len(list_filter({p}q.edges, lambda z: z < u.x)) AS bin, u.side
         FROM (SELECT x, 0 AS side FROM {p}e UNION ALL SELECT x, 1 AS side FROM {p}a) u, {p}q),
{p}sp AS (SELECT unnest(range(0, len(edges) + 1)) AS bin FROM {p}q WHERE edges IS NOT NULL),
{p}c AS (SELECT sp.bin, count(b.side) FILTER (WHERE b.side = 0) AS ne, count(b.side) FILTER (WHERE b.side = 1) AS na
         FROM {p}sp sp LEFT JOIN {p}b b ON sp.bin = b.bin GROUP BY sp.bin),
{p}t AS (SELECT bin, ne, na, sum(ne) OVER () AS tne, sum(na) OVER () AS tna, count(*) OVER () AS k FROM {p}c),
{p}r AS (SELECT bin, ne, na, k, tne, tna,
                (ne / greatest(tne, 1) + {eps}) / (1.0 + k * {eps}) AS es,
                (na / greatest(tna, 1) + {eps}) / (1.0 + k * {eps}) AS ac FROM {p}t),
{p} AS (SELECT CASE WHEN (SELECT count(*) FROM {p}e) = 0 OR (SELECT count(*) FROM {p}a) = 0 THEN CAST('nan' AS DOUBLE)
                    WHEN coalesce(max(k), 0) < 2 THEN 0.0
                    ELSE sum((ac - es) * ln(ac / es)) END AS psi,
               CAST(coalesce(max(k), 0) AS INTEGER) AS n_bins,
               (SELECT count(*) FROM {p}e) AS n_expected, (SELECT count(*) FROM {p}a) AS n_actual
        FROM {p}r)"""


BASE_PLOG = with_(PAYMENTS, V1M, V5M, PLOG)

SQL["heuristic_scores"] = with_(PAYMENTS, V1M, V5M, SCORED) + """
SELECT event_id, card_id, event_timestamp, round(amount, 6) AS amount, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m,
       txn_count_5m, round(avg_transaction_amount_5m, 6) AS avg_transaction_amount_5m,
       array_to_string(missing_features, ',') AS missing_features, round(fraud_probability, 6) AS fraud_probability,
       decision, model_version
FROM scored2"""

SQL["decision_counts"] = BASE_PLOG + "SELECT decision, count(*) AS n FROM plog GROUP BY decision"

SQL["missing_feature_counts"] = BASE_PLOG + """
SELECT feature, count(*) AS n FROM (SELECT unnest(missing_features) AS feature FROM plog) GROUP BY feature"""

_EVAL = with_(PAYMENTS, V1M, V5M, PLOG, LABLOG, dedup())

SQL["labels_latest"] = with_(PAYMENTS, LABLOG) + """, ll AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, label_timestamp, CAST(is_fraud AS INTEGER) AS is_fraud FROM lablog
  WHERE event_id IS NOT NULL AND is_fraud IS NOT NULL AND label_timestamp IS NOT NULL)
SELECT * FROM ll QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY label_timestamp DESC, is_fraud DESC) = 1"""

SQL["predictions_latest"] = _EVAL + "SELECT event_id, ts, round(fraud_probability, 6) AS fraud_probability FROM pd"

SQL["prediction_label_join"] = _EVAL + """
SELECT event_id, ts, round(fraud_probability, 6) AS fraud_probability, is_fraud, label_timestamp FROM j"""

SQL["unlabeled_predictions"] = _EVAL + """
SELECT event_id, ts, round(fraud_probability, 6) AS fraud_probability FROM el
WHERE event_id NOT IN (SELECT event_id FROM ld)"""

SQL["confusion"] = _EVAL + f"SELECT {_cls('m')} FROM m"

SQL["precision_recall"] = _EVAL + f""", cm AS (SELECT count(*) AS n, {_cls('m')}, min(is_fraud) AS ymin, max(is_fraud) AS ymax FROM m)
SELECT n, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       CASE WHEN ymin <> ymax THEN 2 WHEN ymin IS NOT NULL THEN 1 ELSE 0 END AS n_classes
FROM cm"""

SQL["average_precision"] = _EVAL + ", " + ap_sql() + "\nSELECT round(pr_auc, 6) AS pr_auc FROM ap"

SQL["label_lag_quantiles"] = _EVAL + """, q AS (
  SELECT quantile_cont(date_diff('microsecond', ts, label_timestamp) / 1e6, [0.5, 0.95]) AS q FROM m)
SELECT round(q[1], 6) AS label_lag_p50_s, round(q[2], 6) AS label_lag_p95_s FROM q"""


def _summary(body: str) -> str:
    return body + ", " + ap_sql() + """,
agg AS (
  SELECT count(*) AS nj, count(is_fraud) AS n_eval,
         CAST(sum(CASE WHEN is_fraud = 1 AND fraud_probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN is_fraud = 0 AND fraud_probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN is_fraud = 1 AND fraud_probability < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         quantile_cont(CASE WHEN is_fraud IS NOT NULL THEN date_diff('microsecond', ts, label_timestamp) / 1e6 END,
                       [0.5, 0.95]) AS lag
  FROM j),
summary AS (
  SELECT (SELECT count(*) FROM pd) AS n_predictions_total, (SELECT count(*) FROM ld) AS n_labels_total,
         n_eval, round(1.0 - (nj - n_eval) / greatest(nj, 1), 6) AS join_rate, nj - n_eval AS missing_joins,
         round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
         round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
         round((SELECT pr_auc FROM ap), 6) AS pr_auc,
         round(lag[1], 6) AS label_lag_p50_s, round(lag[2], 6) AS label_lag_p95_s,
         CASE WHEN nj = 0 THEN 'no_eligible_predictions' ELSE 'ok' END AS status
  FROM agg)"""


SQL["eval_event_id"] = _summary(_EVAL) + "\nSELECT * FROM summary"

_DOCS = """dpred AS (SELECT CAST(doc_id AS VARCHAR) AS event_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS ts,
                        least(n_chars / 20000.0, 1.0) AS fraud_probability FROM documents),
dlab AS (SELECT CAST(doc_id AS VARCHAR) AS event_id, quality AS is_fraud,
                TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id + 3600) AS label_timestamp FROM labels)"""
SQL["eval_event_id_docs"] = _summary(with_(_DOCS, dedup("dpred", "dlab"))) + "\nSELECT * FROM summary"


def _gate(col: str, t: float, nan_ok: bool = False) -> str:
    cond = f"{col} < {t}" + (f" AND NOT isnan({col})" if nan_ok else "")
    return f"CASE WHEN {cond} THEN printf('{col} %.6f < %.6f', {col}, {float(t)}) END"


SQL["quality_gate"] = _summary(_EVAL).replace(
    "round((SELECT pr_auc FROM ap), 6) AS pr_auc", "(SELECT pr_auc FROM ap) AS pr_auc").replace(
    "round(1.0 - (nj - n_eval) / greatest(nj, 1), 6) AS join_rate", "1.0 - (nj - n_eval) / greatest(nj, 1) AS join_rate").replace(
    "round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision",
    "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision").replace(
    "round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall",
    "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall") + f""",
g AS (SELECT *, list_filter([{_gate('join_rate', 0.99)}, {_gate('precision', 0.003)}, {_gate('recall', 0.2)},
                             {_gate('pr_auc', 0.004, True)}], lambda x: x IS NOT NULL) AS f FROM summary)
SELECT round(join_rate, 6) AS join_rate, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(pr_auc, 6) AS pr_auc, array_to_string(f, '; ') AS gate_failures, len(f) = 0 AS gate_passed FROM g"""

SQL["recent_top_n"] = BASE_PLOG + """
SELECT ts, event_id, card_id, round(amount, 6) AS amount, round(fraud_probability, 6) AS fraud_probability
FROM plog ORDER BY ts DESC, event_id DESC LIMIT 5000"""

SQL["label_delay_cutoff"] = with_(PAYMENTS) + """
SELECT event_id, card_id, event_timestamp, amount FROM payments
WHERE event_timestamp <= (SELECT max(event_timestamp) FROM payments) - INTERVAL '60 minutes'"""

_RECENT = "SELECT * FROM plog ORDER BY ts DESC, event_id DESC LIMIT 5000"

SQL["psi_bins_amount"] = with_(PAYMENTS, V1M, V5M, PLOG, psi_sql(
    "pa", "SELECT amount AS x FROM payments", f"SELECT amount AS x FROM ({_RECENT})")) + """
SELECT bin::INTEGER AS bin, ne AS n_expected_bin, na AS n_actual_bin, round(es, 6) AS e_share, round(ac, 6) AS a_share FROM par"""

SQL["psi_report"] = with_(
    PAYMENTS, V1M, V5M, PLOG,
    psi_sql("pa", "SELECT amount AS x FROM payments", f"SELECT amount AS x FROM ({_RECENT})"),
    psi_sql("pt", "SELECT txn_count_1m AS x FROM f1", f"SELECT txn_count_1m AS x FROM ({_RECENT})"),
    psi_sql("ps", "SELECT amount_sum_1m AS x FROM f1", f"SELECT amount_sum_1m AS x FROM ({_RECENT})"),
) + f"""
, rec AS ({_RECENT})
SELECT 'psi_amount' AS feature, round(psi, 6) AS psi, n_bins, n_expected, n_actual, (SELECT count(*) FROM rec) AS n_recent FROM pa
UNION ALL SELECT 'psi_txn_count_1m', round(psi, 6), n_bins, n_expected, n_actual, (SELECT count(*) FROM rec) FROM pt
UNION ALL SELECT 'psi_amount_sum_1m', round(psi, 6), n_bins, n_expected, n_actual, (SELECT count(*) FROM rec) FROM ps"""

SQL["newest_n"] = _EVAL + """
SELECT event_id, ts, round(fraud_probability, 6) AS fraud_probability FROM pd ORDER BY ts DESC, event_id DESC LIMIT 500"""

SQL["psi_bins_amount_all"] = SQL["psi_bins_amount"].replace(_RECENT, "SELECT * FROM plog")
SQL["psi_report_all"] = SQL["psi_report"].replace(_RECENT, "SELECT * FROM plog")

SQL["psi_amount_halves"] = with_(PAYMENTS, psi_sql(
    "ph", "SELECT amount AS x FROM payments WHERE event_timestamp < TIMESTAMP '2024-01-16 00:00:00'",
    "SELECT amount AS x FROM payments WHERE event_timestamp >= TIMESTAMP '2024-01-16 00:00:00'")) + """
SELECT 'amount' AS feature, round(psi, 6) AS psi, n_bins, n_expected, n_actual FROM ph"""

_DELAYED = with_(PAYMENTS, V1M, V5M) + """, pe AS (
  SELECT * FROM payments WHERE card_id IS NOT NULL AND event_timestamp IS NOT NULL AND amount IS NOT NULL AND is_fraud IS NOT NULL),
elig AS (
  SELECT * FROM pe WHERE event_timestamp <= (SELECT max(event_timestamp) FROM pe) - INTERVAL '60 minutes'),
""" + pit_two_views(ALIGN_5M).replace("FROM payments\n  WHERE card_id", "FROM elig\n  WHERE card_id") + f""",
js AS (SELECT *, {heuristic('amount', 'txn_count_1m', 'txn_count_5m')} AS fraud_probability FROM pit),
cm AS (SELECT count(*) AS n, {_cls('js')} FROM js),
""" + ap_sql("js", "ap") + ",\n" + psi_sql("pa", "SELECT amount AS x FROM pe", "SELECT amount AS x FROM js") + ",\n" + \
    psi_sql("pt", "SELECT txn_count_1m AS x FROM f1", "SELECT txn_count_1m AS x FROM js")
SQL["eval_delayed"] = _DELAYED + """
SELECT n AS n_eval, tn, fp, fn, tp,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round((SELECT pr_auc FROM ap), 6) AS pr_auc,
       round((SELECT psi FROM pa), 6) AS psi_amount, round((SELECT psi FROM pt), 6) AS psi_txn_count_1m,
       CASE WHEN n = 0 THEN 'no_eligible_rows' ELSE 'ok' END AS status
FROM cm"""


# ---------------------------------------------------------------- validation / ingest
# The raw messages as text (digits of doubles left out where texts are compared); errors are read from that text.  Only bytes that
# are no UTF-8 can't stand in a VARCHAR: ``bad`` marks them.
_STR = {"event_id": "event_id", "card_id": "card_id", "user_id": "regexp_replace(card_id, '^card_', 'u_')", "merchant_id": "merchant_id",
        "device_id": "'d_' || card_id", "ip": "'10.0.0.1'", "account_id": "'a_' || card_id", "amount": None, "currency": "'USD'", "mcc": "'5411'",
        "channel": "channel", "is_card_present": None, "country": "country", "city": "city", "lat": None, "lon": None,
        "event_ts": "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')", "ingest_ts": "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')",
        "is_fraud": None}
_BARE = {"amount": "CAST(amount AS VARCHAR)", "is_card_present": "CASE WHEN channel = 'pos' THEN 'true' ELSE 'false' END",
         "lat": "CAST(lat AS VARCHAR)", "lon": "CAST(lon AS VARCHAR)", "is_fraud": "CAST(is_fraud AS VARCHAR)"}
_DOC = "'{' || " + " || ',' || ".join(
    f"""'"{f}":"' || {x} || '"'""" if x else f"""'"{f}":' || {_BARE[f]}""" for f, x in _STR.items()) + " || '}'"
_EDITS = [(0, '"amount":([^,}]+)', '"amount":"\\1"'), (1, '"is_fraud":([01])', '"is_fraud":\\1.0'), (2, '"is_fraud":[01]', '"is_fraud":2'),
          (3, '"is_fraud":[01]', '"is_fraud":true'), (4, '"channel":"[a-z]*"', '"channel":"atm"'), (5, '"amount":[^,}]+', '"amount":null'),
          (6, '"amount":[^,}]+,', ''), (10, '\\}$', ',"extra_note":"ok"}'), (11, '"is_card_present":(true|false)', '"is_card_present":"yes"')]
MESSAGES = f"""doc AS (SELECT *, CAST(event_id AS BIGINT) % 97 AS k, {_DOC} AS good FROM payments),
msg AS (SELECT *, k = 9 AS bad, CASE k WHEN 7 THEN '[]' WHEN 8 THEN 'not json ' || event_id WHEN 9 THEN chr(65533) || good
  {' '.join(f"WHEN {k} THEN regexp_replace(good, '{pat}', '{rep}')" for k, pat, rep in _EDITS)} ELSE good END AS raw FROM doc)"""
_TYPES = {"amount": "number", "lat": "number", "lon": "number", "is_card_present": "boolean", "is_fraud": "integer"}


def _type_error(f: str) -> str:
    t, v = f"json_type(raw, '$.{f}')", f"json_extract_string(raw, '$.{f}')"
    number = f"{t} IN ('DOUBLE', 'BIGINT', 'UBIGINT')"
    ok = {"number": number, "boolean": f"{t} = 'BOOLEAN'", "string": f"{t} = 'VARCHAR'",
          "integer": f"({number} AND TRY_CAST({v} AS DOUBLE) = floor(TRY_CAST({v} AS DOUBLE)))"}[_TYPES.get(f, "string")]
    enum = {"channel": f"{v} NOT IN ('pos', 'ecom')", "is_fraud": f"TRY_CAST({v} AS DOUBLE) NOT IN (0, 1)"}.get(f)
    return f"WHEN NOT ({ok}) THEN 'type:{f}'" + (f" WHEN {enum} THEN 'enum:{f}'" if enum else "")


_OUTCOME = "CASE WHEN bad THEN 'invalid_utf8' WHEN NOT json_valid(raw) THEN 'not_json' WHEN json_type(raw) <> 'OBJECT' THEN 'not_object' " + " ".join(
    [f"WHEN json_type(raw, '$.{f}') IS NULL THEN 'missing_required:{f}'" for f in _STR] + [_type_error(f) for f in _STR]) + " ELSE 'ok' END"
CHECKED = f"checked AS (SELECT *, {_OUTCOME} AS outcome FROM msg)"
_MASKED = """regexp_replace(raw, '("(amount|lat|lon)":"?)-?[0-9.eE+]+', '\\1#', 'g') AS raw"""

SQL["dlq_reasons"] = with_(PAYMENTS, MESSAGES, CHECKED) + "SELECT outcome, count(*) AS n FROM checked GROUP BY 1"

SQL["valid_payments"] = with_(PAYMENTS, MESSAGES, CHECKED) + """
SELECT event_id, card_id, round(amount, 6) AS amount, channel, channel = 'pos' AS is_card_present, is_fraud,
       date_trunc('second', event_timestamp) AS event_time
FROM checked WHERE outcome = 'ok'"""

SQL["dlq_records"] = with_(PAYMENTS, MESSAGES, CHECKED) + f"""
SELECT CAST(event_id AS BIGINT) AS offset, outcome AS error, 'payments.v1' AS topic, {_MASKED}, true AS in_topic FROM checked
WHERE outcome <> 'ok'"""

SQL["stream_errors"] = with_(PAYMENTS, MESSAGES) + f""", r AS (
  SELECT CASE WHEN bad THEN 'invalid_utf8' WHEN NOT json_valid(raw) THEN 'not_json' WHEN json_type(raw) <> 'OBJECT' THEN 'not_object'
              WHEN coalesce(json_extract_string(raw, '$.card_id'), '') = '' THEN 'card_id_empty'
              WHEN coalesce(TRY_CAST(json_extract_string(raw, '$.amount') AS DOUBLE), -1) < 0 THEN 'amount_invalid' END AS reason, raw FROM msg)
SELECT CASE WHEN reason = 'amount_invalid' THEN json_extract_string(raw, '$.event_id') END AS event_id,
       CASE WHEN reason = 'amount_invalid' THEN json_extract_string(raw, '$.card_id') END AS card_id, reason, {_MASKED}
FROM r WHERE reason IS NOT NULL"""

_CSV_SRC = """src AS (
  SELECT event_id AS eid,
         date_diff('microsecond', (SELECT min(ts) FROM events), ts) / 1e6 AS t,
         CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN -value ELSE value END AS amount,
         CASE WHEN event_id % 107 = 0 THEN NULL ELSE CAST(event_type = 'error' AS INTEGER) END AS cls
  FROM events)"""


def _uuid5(idx: str) -> str:
    h = f"sha1(unhex('00000000000000000000000000000001') || encode('creditcard:' || CAST({idx} AS VARCHAR)))"
    return (f"(SELECT substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' || "
            f"lower(printf('%x', ((('0x' || substr(h,17,1))::INTEGER) & 3) | 8)) || substr(h,18,3) || '-' || "
            f"substr(h,21,12) FROM (SELECT {h} AS h))")


_ING = with_(_CSV_SRC) + f""", kept AS (
  SELECT eid, t, amount, coalesce(cls, 0) AS is_fraud, row_number() OVER (ORDER BY eid) - 1 AS idx
  FROM src WHERE t IS NOT NULL AND amount IS NOT NULL AND amount >= 0),
ids AS (SELECT *, {_uuid5('idx')} AS event_id FROM kept),
ing AS (
  SELECT idx, event_id, 'card_' || CAST(idx % 50000 AS VARCHAR) AS card_id, 'm_' || CAST(idx % 10000 AS VARCHAR) AS merchant_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(CAST(round(t * 1e6) AS BIGINT)) AS event_timestamp,
         amount,
         CASE WHEN ('0x' || substr(md5('7:channel:' || event_id), 1, 8))::BIGINT % 10 < 7 THEN 'pos' ELSE 'ecom' END AS channel,
         ('0x' || substr(md5('7:geo:' || event_id), 1, 8))::BIGINT % 6 + 1 AS g,
         is_fraud
  FROM ids)"""

SQL["ingest_payments"] = _ING + f"""
SELECT idx, event_id, card_id, merchant_id, event_timestamp, amount, channel,
       {GEO_COUNTRY}[g] AS country, {GEO_CITY}[g] AS city,
       CAST({GEO_LAT}[g] AS DOUBLE) AS lat, CAST({GEO_LON}[g] AS DOUBLE) AS lon, is_fraud
FROM ing"""

SQL["ingest_report"] = _ING + """
SELECT count(*) AS rows, round(coalesce(avg(is_fraud), 0.0), 6) AS fraud_rate, min(amount) AS amount_min,
       max(amount) AS amount_max, '2024-01-01T00:00:00Z' AS start_time_utc, 50000 AS n_cards, 10000 AS n_merchants,
       '' AS validation_errors
FROM ing"""

SQL["quality_rules"] = with_(_CSV_SRC) + """, r AS (
  SELECT sum(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS a_null, sum(CASE WHEN amount < 0 THEN 1 ELSE 0 END) AS a_neg,
         sum(CASE WHEN cls IS NULL OR cls NOT IN (0, 1) THEN 1 ELSE 0 END) AS bad_y,
         sum(CASE WHEN t IS NULL THEN 1 ELSE 0 END) AS ts_null, quantile_cont(amount, 0.999) AS p999 FROM src)
SELECT array_to_string(list_filter([
         'missing_required_columns=[''card_id'', ''merchant_id'']',
         CASE WHEN a_null > 0 THEN 'amount_has_nulls' END,
         CASE WHEN a_neg > 0 THEN 'amount_has_negative_values' END,
         CASE WHEN p999 > 100000 THEN 'amount_p999_too_high' END,
         CASE WHEN bad_y > 0 THEN 'is_fraud_has_invalid_values count=' || CAST(bad_y AS VARCHAR) END,
         CASE WHEN ts_null > 0 THEN 'event_timestamp_has_nulls' END,
         'event_timestamp_not_utc'], lambda x: x IS NOT NULL), '; ') AS validation_errors
FROM r"""


# ---------------------------------------------------------------- monitoring
_BOUNDS = list(_S.LATENCY_BUCKETS)
_LE = [repr(b) for b in _BOUNDS] + ["+Inf"]


def _slide(src: str, cols: str) -> str:
    """Rows of ``src`` twice, once per 2-minute window (slide 1 minute) they fall in."""
    return (f"SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, {cols} FROM {src} UNION ALL "
            f"SELECT time_bucket(INTERVAL '1 minute', ts) - INTERVAL '1 minute' AS window_start, {cols} FROM {src}")


def _cums(lat: str) -> str:
    return ", ".join([f"CAST(sum(CASE WHEN {lat} <= {b!r} THEN 1 ELSE 0 END) AS BIGINT) AS c{i}"
                      for i, b in enumerate(_BOUNDS)] + [f"count(*) AS c{len(_BOUNDS)}"])


def _hq(q: float) -> str:
    n = f"c{len(_BOUNDS)}"
    out = f"{_BOUNDS[-1]!r}"
    for i in range(len(_BOUNDS) - 1, -1, -1):
        lo = "0.0" if i == 0 else repr(_BOUNDS[i - 1])
        prev = "0" if i == 0 else f"c{i - 1}"
        val = f"({lo} + ({_BOUNDS[i]!r} - {lo}) * (({q} * {n} - {prev}) / (c{i} - {prev})))"
        out = f"CASE WHEN c{i} >= {q} * {n} THEN {val} ELSE {out} END"
    return f"CASE WHEN {n} = 0 THEN CAST('nan' AS DOUBLE) ELSE {out} END"


SQL["decisions_per_minute"] = BASE_PLOG + """
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, decision, count(*) AS n, round(count(*) / 60.0, 6) AS rate_per_s
FROM plog WHERE decision IS NOT NULL GROUP BY 1, 2"""

SQL["requests_per_minute"] = BASE_PLOG + """
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, status, count(*) AS n, round(count(*) / 60.0, 6) AS rate_per_s
FROM plog GROUP BY 1, 2"""

SQL["error_ratio_2m"] = BASE_PLOG + f""", sl AS ({_slide('plog', 'status')}),
a AS (SELECT window_start, CAST(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS n_ok,
             CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_error FROM sl GROUP BY 1),
r AS (SELECT *, (n_error / 120.0) / greatest(n_error / 120.0 + n_ok / 120.0, 0.001) AS error_ratio FROM a)
, res AS (SELECT window_start, n_ok, n_error, round(error_ratio, 6) AS error_ratio, error_ratio > 0.05 AS alert FROM r),
sp AS (SELECT unnest(range(min(window_start), max(window_start) + INTERVAL '1 minute', INTERVAL '1 minute')) AS window_start FROM res),
fl AS (SELECT sp.window_start, coalesce(res.alert, false) AS a FROM sp LEFT JOIN res ON sp.window_start = res.window_start),
hf AS (SELECT window_start,
              min(CAST(a AS INTEGER)) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 1
              AND count(*) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS firing FROM fl)
SELECT res.*, hf.firing FROM res LEFT JOIN hf ON res.window_start = hf.window_start"""

SQL["latency_histogram"] = BASE_PLOG + f""", h AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, {_cums('latency_ms / 1000.0')}
  FROM plog WHERE status = 'ok' GROUP BY 1)
""" + " UNION ALL ".join(f"SELECT window_start, '{_LE[i]}' AS le, c{i} AS cum_count FROM h" for i in range(len(_LE)))

SQL["latency_quantiles"] = BASE_PLOG + f""", sl AS ({_slide("(SELECT * FROM plog WHERE status = 'ok')", 'latency_ms')}),
h AS (SELECT window_start, {_cums('latency_ms / 1000.0')} FROM sl GROUP BY 1),
q AS (SELECT window_start, c{len(_BOUNDS)} AS n, {_hq(0.5)} AS p50_s, {_hq(0.95)} AS p95_s FROM h)
, res AS (SELECT window_start, n, round(p50_s, 6) AS p50_s, round(p95_s, 6) AS p95_s, p95_s > 0.25 AS alert FROM q),
sp AS (SELECT unnest(range(min(window_start), max(window_start) + INTERVAL '1 minute', INTERVAL '1 minute')) AS window_start FROM res),
fl AS (SELECT sp.window_start, coalesce(res.alert, false) AS a FROM sp LEFT JOIN res ON sp.window_start = res.window_start),
hf AS (SELECT window_start,
              min(CAST(a AS INTEGER)) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 1
              AND count(*) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS firing FROM fl)
SELECT res.*, hf.firing FROM res LEFT JOIN hf ON res.window_start = hf.window_start"""

SQL["missing_rate"] = BASE_PLOG + """
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, feature, count(*) AS n, round(count(*) / 60.0, 6) AS rate_per_s
FROM (SELECT ts, unnest(missing_features) AS feature FROM plog) GROUP BY 1, 2"""

SQL["missing_alert"] = BASE_PLOG + f""", sl AS ({_slide('plog', 'len(missing_features) AS k')}),
a AS (SELECT window_start, CAST(sum(k) AS BIGINT) AS n_missing FROM sl GROUP BY 1)
, res AS (SELECT window_start, n_missing, round(n_missing / 120.0, 6) AS rate_per_s, n_missing / 120.0 > 1.0 AS alert FROM a),
sp AS (SELECT unnest(range(min(window_start), max(window_start) + INTERVAL '1 minute', INTERVAL '1 minute')) AS window_start FROM res),
fl AS (SELECT sp.window_start, coalesce(res.alert, false) AS a FROM sp LEFT JOIN res ON sp.window_start = res.window_start),
hf AS (SELECT window_start,
              min(CAST(a AS INTEGER)) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 1
              AND count(*) OVER (ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS firing FROM fl)
SELECT res.*, hf.firing FROM res LEFT JOIN hf ON res.window_start = hf.window_start"""

_IDLE = BASE_PLOG + """, olog AS (
  SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN ts + INTERVAL '5 days' ELSE ts END AS ts) FROM plog),
cnt AS (
  SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM olog WHERE decision IS NOT NULL GROUP BY 1),
sp AS (SELECT unnest(range(min(date_trunc('minute', ts)), max(date_trunc('minute', ts)) + INTERVAL '1 minute',
                           INTERVAL '1 minute')) AS minute FROM olog),
s AS (SELECT sp.minute, coalesce(cnt.n, 0) AS n FROM sp LEFT JOIN cnt ON sp.minute = cnt.minute),
w AS (SELECT minute, n, CAST(sum(n) OVER (ORDER BY minute ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS n_last,
             count(*) OVER (ORDER BY minute ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS k FROM s),
i AS (SELECT minute, n, n_last, n_last = 0 AND k = 5 AS idle FROM w),
f AS (SELECT *, min(CAST(idle AS INTEGER)) OVER (ORDER BY minute ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) = 1
                AND count(*) OVER (ORDER BY minute ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) = 11 AS firing FROM i)"""

SQL["idle_gaps"] = _IDLE + "\nSELECT minute, n, n_last, idle, firing FROM f"

SQL["idle_times"] = _IDLE + """,
e AS (SELECT *, idle AND NOT coalesce(lag(idle) OVER (ORDER BY minute), false) AS st FROM f),
g AS (SELECT *, sum(CAST(st AS INTEGER)) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep FROM e)
SELECT min(minute) AS first_idle, max(minute) AS last_idle, count(*) AS idle_minutes, min(CASE WHEN firing THEN minute END) AS firing_from,
       count(CASE WHEN firing THEN 1 END) AS firing_minutes FROM g WHERE idle GROUP BY ep"""

SQL["alert_hold"] = _IDLE + """,
e AS (SELECT *, firing AND NOT coalesce(lag(firing) OVER (ORDER BY minute), false) AS st FROM f),
g AS (SELECT *, sum(CAST(st AS INTEGER)) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep FROM e)
SELECT min(minute) AS first_minute, max(minute) AS last_minute, count(*) AS minutes FROM g WHERE firing GROUP BY ep"""

SQL["missing_event_ids"] = with_(PAYMENTS) + """
SELECT time_bucket(INTERVAL '1 minute', event_timestamp) AS window_start,
       CAST(sum(CASE WHEN CAST(event_id AS BIGINT) % 199 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, count(*) AS n
FROM payments GROUP BY 1"""


# ---------------------------------------------------------------- streams
SQL["stream_card_velocity_1m"] = with_(PAYMENTS) + """, p AS (
  SELECT card_id, date_trunc('second', event_timestamp) AS et, amount FROM payments
  WHERE card_id IS NOT NULL AND event_timestamp IS NOT NULL),
v AS (SELECT card_id, time_bucket(INTERVAL '1 minute', et) + INTERVAL '1 minute' AS event_timestamp,
             count(*) AS txn_count_1m, sum(amount) AS amount_sum_1m FROM p GROUP BY 1, 2)
SELECT card_id, event_timestamp, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m FROM v
WHERE event_timestamp <= (SELECT max(et) FROM p) - INTERVAL '5 seconds'"""

SQL["stream_validation"] = SQL["dlq_reasons"]

SQL["stream_latest_features"] = SQL["latest_features"]

SQL["stream_scores"] = with_(PAYMENTS, V1M, V5M) + f""",
l1 AS (SELECT * FROM f1 QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY event_timestamp DESC) = 1),
l5 AS (SELECT * FROM f5 QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY event_timestamp DESC) = 1),
j AS (SELECT p.event_id, p.card_id, p.amount, coalesce(l1.txn_count_1m, 0) AS t1, coalesce(l5.txn_count_5m, 0) AS t5
      FROM payments p LEFT JOIN l1 ON p.card_id = l1.card_id LEFT JOIN l5 ON p.card_id = l5.card_id
      WHERE p.card_id IS NOT NULL AND p.card_id <> '' AND p.amount IS NOT NULL AND p.amount >= 0),
s AS (SELECT *, {heuristic('amount', 't1', 't5')} AS fraud_probability FROM j)
SELECT event_id, card_id, round(amount, 6) AS amount, round(fraud_probability, 6) AS fraud_probability,
       CASE WHEN fraud_probability >= 0.5 THEN 'fraud' ELSE 'approve' END AS decision, 'fallback' AS model_version FROM s"""

SQL["decision_records"] = SQL["stream_scores"].replace("SELECT event_id, card_id, round", "SELECT card_id AS key, event_id, card_id, round")

SQL["stream_label_outcomes"] = with_(PAYMENTS, V1M, V5M, PLOG, LABLOG) + """,
w AS (SELECT least((SELECT max(ts) FROM plog), (SELECT max(label_timestamp) FROM lablog)) - INTERVAL '10 minutes' AS mark)
SELECT p.event_id, p.ts, round(p.fraud_probability, 6) AS fraud_probability, l.is_fraud, l.label_timestamp
FROM plog p CROSS JOIN w LEFT JOIN lablog l ON p.event_id = l.event_id
 AND l.label_timestamp >= p.ts AND l.label_timestamp <= p.ts + INTERVAL '60 minutes'
WHERE l.event_id IS NOT NULL OR p.ts + INTERVAL '60 minutes' < w.mark"""

SQL["stream_label_join"] = SQL["stream_label_outcomes"].replace("60 minutes", "150 minutes")


# ---------------------------------------------------------------- training
_TRAIN = with_(PAYMENTS, V1M, V5M, pit_two_views(ALIGN_5M)) + """, sp AS (
  SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42:' || event_id), event_id)
            <= round(count(*) OVER (PARTITION BY is_fraud) * 0.2) AS is_test FROM pit)"""

SQL["stratified_split"] = _TRAIN + "\nSELECT event_id, is_fraud, is_test FROM sp"

SQL["class_weight"] = _TRAIN + """, c AS (
  SELECT CAST(sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg,
         CAST(sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos FROM sp WHERE NOT is_test)
SELECT neg, pos, round(neg / greatest(pos, 1), 6) AS scale_pos_weight FROM c"""

_FEATURES = ["amount", "txn_count_1m", "amount_sum_1m", "txn_count_5m", "avg_transaction_amount_5m"]
_LONG = "\n  UNION ALL ".join(f"SELECT '{f}' AS f, CAST({f} AS DOUBLE) AS x, is_fraud FROM tr" for f in _FEATURES)

SQL["boost_first_gains"] = _TRAIN + f""", tr AS (SELECT * FROM sp WHERE NOT is_test),
wt AS (SELECT count(*) FILTER (is_fraud = 0) / greatest(count(*) FILTER (is_fraud = 1), 1) AS w FROM tr),
lg AS ({_LONG}),
q AS (SELECT f, unnest(quantile_cont(x, [i / 32.0 FOR i IN range(32)])) AS cut FROM lg GROUP BY f),
c AS (SELECT f, cut FROM (SELECT DISTINCT f, cut FROM q) QUALIFY cut > min(cut) OVER (PARTITION BY f)),
cl AS (SELECT f, list(cut) AS cuts FROM c GROUP BY f),
b AS (SELECT lg.f, len(list_filter(coalesce(cuts, []), lambda v: v <= x)) AS bin, is_fraud FROM lg LEFT JOIN cl ON lg.f = cl.f),
d AS (SELECT f, bin, CASE WHEN is_fraud = 1 THEN (SELECT w FROM wt) ELSE 1.0 END AS w, is_fraud FROM b),
h AS (SELECT f, bin, sum(CAST(round(w * (0.5 - is_fraud) * 16777216) AS BIGINT)) AS g,
             sum(CAST(round(w * 0.25 * 16777216) AS BIGINT)) AS h FROM d GROUP BY 1, 2),
s AS (SELECT f, bin, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(g) OVER p AS gt, sum(h) OVER p AS ht FROM h
      WINDOW u AS (PARTITION BY f ORDER BY bin), p AS (PARTITION BY f))
SELECT f AS feature_name, CAST(bin AS BIGINT) AS bin, CAST(gl AS BIGINT) AS gl, CAST(hl AS BIGINT) AS hl, CAST(gt AS BIGINT) AS gt,
       CAST(ht AS BIGINT) AS ht, round(((gl / 16777216.0) ** 2 / (hl / 16777216.0 + 1.0)
       + ((gt - gl) / 16777216.0) ** 2 / ((ht - hl) / 16777216.0 + 1.0) - (gt / 16777216.0) ** 2 / (ht / 16777216.0 + 1.0)) / 2, 6) AS gain
FROM s"""

SQL["training_frame"] = with_(PAYMENTS, V1M, V5M, pit_two_views(ALIGN_5M)) + """
SELECT event_id, card_id, event_timestamp, round(amount, 6) AS amount, is_fraud, txn_count_1m,
       round(amount_sum_1m, 6) AS amount_sum_1m, txn_count_5m, round(avg_transaction_amount_5m, 6) AS avg_transaction_amount_5m
FROM pit"""


# ---------------------------------------------------------------- snapshots, logs, enrichment
SQL["snapshot_payments"] = with_(PAYMENTS) + """
SELECT card_id, event_timestamp, round(amount, 6) AS amount, channel, country, city, is_fraud FROM payments"""

SQL["snapshot_features"] = with_(PAYMENTS, V1M) + """
SELECT card_id, event_timestamp, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m FROM f1"""

SQL["eval_event_id_jsonl"] = SQL["eval_event_id"]

SQL["enriched_events"] = with_(PAYMENTS, V1M, V5M, _pit_no_fill()) + """
SELECT event_id, card_id, event_timestamp, round(amount, 6) AS amount, txn_count_1m, round(amount_sum_1m, 6) AS amount_sum_1m,
       txn_count_5m, round(avg_transaction_amount_5m, 6) AS avg_transaction_amount_5m FROM s2"""

SQL["stream_dedupe"] = with_(PAYMENTS) + "SELECT event_id, card_id, round(amount, 6) AS amount FROM payments"

SQL["decisions_large"] = with_(PAYMENTS_LARGE, V1M, V5M, SCORED) + """
SELECT decision, count(*) AS n, round(avg(fraud_probability), 6) AS avg_probability,
       CAST(sum(CASE WHEN len(missing_features) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_with_missing
FROM scored2 GROUP BY decision"""

SQL["stream_geo_change_5m"] = with_(PAYMENTS) + """, p AS (
  SELECT card_id, date_trunc('second', event_timestamp) AS et, country FROM payments
  WHERE card_id IS NOT NULL AND event_timestamp IS NOT NULL),
v AS (SELECT card_id, time_bucket(INTERVAL '5 minutes', et) + INTERVAL '5 minutes' AS event_timestamp,
             CASE WHEN count(DISTINCT country) > 1 THEN 1 ELSE 0 END AS geo_change_flag_5m FROM p GROUP BY 1, 2)
SELECT * FROM v WHERE event_timestamp <= (SELECT max(et) FROM p) - INTERVAL '5 seconds'"""

# what the final watermark (5 s behind the newest event) less the longest look back has closed
SQL["stream_geo_change"] = f"""SELECT * FROM ({SQL['geo_change']}) WHERE event_timestamp < (SELECT max(ts) FROM events WHERE user_id IS NOT NULL) - INTERVAL '305 seconds'"""
SQL["stream_enriched"] = f"""SELECT * FROM ({SQL['enriched_events']}) WHERE card_id IS NOT NULL
  AND event_timestamp < (SELECT max(ts) FROM events WHERE user_id IS NOT NULL) - INTERVAL '14405 seconds'"""
