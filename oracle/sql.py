"""SQL twins of the named queries, written for DuckDB over the same Parquet tables.

They state each result directly (ranks over whole groups, joins on the raw rows), not the way the Spark
plans compute it, so that agreement means something.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# The feature lists.
NUMERIC = [
    "age",
    "gender_ix",
    "income",
    "num_purchases_last_month",
    "purchase_amount_last_month",
    "avg_purchase_value",
    "browsing_minutes_last_week",
    "is_high_spender",
]
CATEGORICAL = ["region", "top_category", "age_bucket"]
EXPLORED = [
    "age",
    "income",
    "num_purchases_last_month",
    "purchase_amount_last_month",
    "browsing_minutes_last_week",
]


def snaps(n: int) -> str:
    """CTEs ending in snaps(snapshot, as_of, raw columns) and feats (features with snapshot, best_action)."""
    return f"""
clock AS (
  SELECT CAST(k AS INTEGER) AS snapshot,
         (SELECT max(o_orderdate) FROM orders) - to_days(CAST(180 * k AS INTEGER)) AS as_of,
         (SELECT max(ts) FROM events) - to_days(CAST(7 * k AS INTEGER)) AS browse_as_of
  FROM range(0, {n}) t(k)),
bought AS (
  SELECT o_custkey AS customer_id, snapshot, count(*) AS n_orders,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
  FROM orders JOIN clock ON o_orderdate <= as_of AND o_orderdate > as_of - INTERVAL 540 DAY
  GROUP BY ALL),
by_type AS (
  SELECT o_custkey AS customer_id, snapshot, p_type, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN clock ON o_orderdate <= as_of AND o_orderdate > as_of - INTERVAL 540 DAY
  GROUP BY ALL),
top AS (
  SELECT customer_id, snapshot, p_type FROM by_type
  QUALIFY row_number() OVER (PARTITION BY customer_id, snapshot ORDER BY spend DESC, p_type) = 1),
browsed AS (
  SELECT user_id AS customer_id, snapshot, sum(CAST(value AS DECIMAL(18,2))) AS minutes
  FROM events JOIN clock ON ts <= browse_as_of AND ts > browse_as_of - INTERVAL 7 DAY
  WHERE event_type IN ('view', 'click') GROUP BY ALL),
base AS (
  SELECT clock.snapshot, as_of, c_custkey AS customer_id, 18 + (c_custkey * 37) % 53 AS age,
         CASE WHEN (c_custkey * 7) % 25 < 13 THEN 'F' ELSE 'M' END AS gender, r_name AS region,
         20000 + (c_acctbal + 1000) * 10 AS income,
         coalesce(n_orders, 0) AS num_purchases_last_month,
         floor(coalesce(CAST(spend AS DOUBLE), 0) / 1800 * 100) / 100 AS purchase_amount_last_month,
         floor(coalesce(CAST(minutes AS DOUBLE), 0) / 5 * 100) / 100 AS browsing_minutes_last_week,
         coalesce(p_type, 'NONE') AS top_category
  FROM customer CROSS JOIN clock
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN bought ON bought.customer_id = c_custkey AND bought.snapshot = clock.snapshot
  LEFT JOIN top ON top.customer_id = c_custkey AND top.snapshot = clock.snapshot
  LEFT JOIN browsed ON browsed.customer_id = c_custkey AND browsed.snapshot = clock.snapshot),
snaps AS (
  SELECT *, CASE WHEN purchase_amount_last_month > 600 OR num_purchases_last_month >= 6 THEN 'Email'
                 WHEN browsing_minutes_last_week > 200 OR age < 28 THEN 'Push'
                 WHEN age >= 28 AND age <= 50 THEN 'SMS' ELSE 'Email' END AS best_action
  FROM base),
feats AS (
  SELECT snapshot, best_action, customer_id, age, CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_ix, income,
         num_purchases_last_month, purchase_amount_last_month,
         CASE WHEN num_purchases_last_month > 0
              THEN purchase_amount_last_month / num_purchases_last_month ELSE 0.0 END::DOUBLE AS avg_purchase_value,
         browsing_minutes_last_week, CAST(purchase_amount_last_month > 600 AS INTEGER) AS is_high_spender,
         region, top_category,
         CASE WHEN age < 28 THEN 'young' WHEN age <= 50 THEN 'mid' ELSE 'senior' END AS age_bucket,
         as_of AS updated_at,
         CASE best_action WHEN 'Email' THEN 0 WHEN 'SMS' THEN 1 ELSE 2 END AS action_label,
         CASE WHEN num_purchases_last_month >= 5 THEN 0 WHEN age < 28 THEN 2 WHEN age <= 50 THEN 1 ELSE 0 END
           AS predicted_label
  FROM snaps)"""


FEATURE_LIST = (
    "customer_id, age, gender_ix, income, num_purchases_last_month, purchase_amount_last_month, "
    "avg_purchase_value, browsing_minutes_last_week, is_high_spender, region, top_category, age_bucket"
)
RAW_LIST = (
    "customer_id, age, gender, region, income, num_purchases_last_month, purchase_amount_last_month, "
    "browsing_minutes_last_week, top_category, best_action"
)
ACTION_NAME = "CASE predicted_label WHEN 0 THEN 'Email' WHEN 1 THEN 'SMS' ELSE 'Push' END"
ACTIVE = "(num_purchases_last_month > 0 OR browsing_minutes_last_week > 0)"

LOG = (
    snaps(4)
    + f""",
recs AS (
  SELECT customer_id, snapshot, {ACTION_NAME} AS recommended_action, updated_at AS scored_at_ts,
         'v' || (snapshot % 2 + 1) AS model_version FROM feats),
log AS (
  SELECT r.customer_id, r.recommended_action, r.scored_at_ts, r.model_version,
         {", ".join("f." + c for c in NUMERIC + CATEGORICAL)},
         CAST(r.scored_at_ts AS DATE) AS log_date, r.scored_at_ts AS inference_timestamp
  FROM recs r LEFT JOIN (SELECT * FROM feats WHERE {ACTIVE}) f
    ON r.customer_id = f.customer_id AND r.snapshot = f.snapshot)"""
)


def add(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = f"WITH {ctes}\n{body}" if ctes else body


def long_rows(source: str, columns: list[str], extra: str = "", kind: str = "DOUBLE") -> str:
    """UNION ALL of (extra columns, feature, value)."""
    lead = f"{extra}, " if extra else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, CAST({c} AS {kind}) AS value FROM {source}" for c in columns
    )


# ---- sources, features, labels

add("customer360", snaps(1), f"SELECT {RAW_LIST} FROM snaps")
add("customer360_snapshots", snaps(4), f"SELECT snapshot, as_of, {RAW_LIST} FROM snaps")
add("features", snaps(1), f"SELECT {FEATURE_LIST}, updated_at FROM feats")
add("labels", snaps(1), "SELECT customer_id, action_label, best_action FROM feats")
add("label_encoding", snaps(1), "SELECT customer_id, action_label, best_action AS decoded FROM feats")
add(
    "stamped_features",
    snaps(1),
    f"""SELECT {FEATURE_LIST}, updated_at, CAST(updated_at AS DATE) AS log_date, 'v1' AS model_version,
       updated_at AS inference_timestamp FROM feats""",
)
add(
    "trailing_orders",
    "",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - 7 FROM orders)""",
)
add(
    "log_on_latest_date",
    LOG,
    "SELECT customer_id, recommended_action, log_date FROM log WHERE log_date = (SELECT max(log_date) FROM log)",
)
add(
    "log_rows_with_features",
    LOG,
    "SELECT customer_id, log_date, income, region FROM log WHERE income IS NOT NULL",
)

# ---- keys and quality

add(
    "duplicate_keys",
    "",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
add(
    "key_check",
    snaps(1)
    + """,
both_keys AS (
  SELECT 'lineitem' AS table_name, l_orderkey AS a, l_linenumber AS b FROM lineitem
  UNION ALL SELECT 'features', customer_id, 0 FROM feats),
dup AS (SELECT table_name, count(*) AS c FROM (
          SELECT table_name, a, b FROM both_keys GROUP BY ALL HAVING count(*) > 1) GROUP BY table_name)""",
    """SELECT b.table_name, count(*) AS n_rows, coalesce(any_value(dup.c), 0) AS duplicate_groups,
       count(*) FILTER (WHERE a IS NULL OR b IS NULL) AS null_key_rows,
       coalesce(any_value(dup.c), 0) = 0 AND count(*) FILTER (WHERE a IS NULL OR b IS NULL) = 0 AS key_ok
FROM both_keys b LEFT JOIN dup ON b.table_name = dup.table_name GROUP BY b.table_name""",
)
add(
    "dedupe_latest",
    "",
    """SELECT * FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id
ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST,
props DESC NULLS LAST) = 1""",
)
add(
    "dedupe_features",
    snaps(4),
    f"""SELECT snapshot, {FEATURE_LIST}, updated_at FROM feats
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1""",
)
add(
    "null_rates",
    LOG,
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null,
  round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6)::DOUBLE AS null_rate_pct,
  100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) > 5 AS flagged FROM log"""
        for c in NUMERIC
    ),
)
add(
    "duplicate_rate",
    "",
    """SELECT n_rows, n_distinct, round(100.0 * (n_rows - n_distinct) / n_rows, 6)::DOUBLE AS duplicate_rate_pct,
       n_rows > n_distinct AS flagged
FROM (SELECT count(*) AS n_rows,
             (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders)) AS n_distinct FROM orders)""",
)
add(
    "readiness",
    LOG,
    """SELECT 'features' AS table_name, true AS table_exists, 'updated_at' AS missing_columns, count(*) AS n_rows,
       count(*) > 0 AS non_empty, false AS ready,
       'rewrite the table with the missing columns' AS recommendation FROM feats
UNION ALL SELECT 'inference_log', true, '', count(*), count(*) > 0, true, 'ready to be profiled' FROM log""",
)

# ---- exploration

add("class_balance", snaps(1), "SELECT best_action, count(*) AS n_rows FROM snaps GROUP BY best_action")
CATEGORY_COUNTS = (
    snaps(1)
    + f""", cats AS ({long_rows("feats", CATEGORICAL, kind="VARCHAR")}),
cc AS (SELECT feature, value AS category, count(*) AS n_rows FROM cats GROUP BY ALL)"""
)
add("category_counts", CATEGORY_COUNTS, "SELECT * FROM cc")
add(
    "category_shares",
    CATEGORY_COUNTS,
    """SELECT feature, category, n_rows,
       round(100.0 * n_rows / sum(n_rows) OVER (PARTITION BY feature), 6)::DOUBLE AS share_pct FROM cc""",
)


def summary_body(source: str) -> str:
    return f"""SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
       round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
       round(max(value), 6) AS max FROM ({source}) GROUP BY feature"""


add("numeric_summary", snaps(1), summary_body(long_rows("snaps", EXPLORED)))
add(
    "lineitem_summary",
    "",
    summary_body(long_rows("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])),
)
FLAGS = "true AS q25_ok, true AS q50_ok, true AS q75_ok"
add(
    "lineitem_summary_sketched",
    "",
    f"""SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev,
  round(min(value), 6) AS min, round(max(value), 6) AS max, {FLAGS}
FROM ({long_rows("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])}) GROUP BY feature""",
)
add(
    "event_value_boxplot_sketched",
    "",
    f"SELECT event_type, count(value) AS n, {FLAGS} FROM events GROUP BY event_type",
)
_WEEK = f"""count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_null, round(avg(value), 6) AS mean,
  round(min(value), 6) AS min, round(max(value), 6) AS max, count(value) AS n, {FLAGS}
FROM events GROUP BY"""
add(
    "event_profile_sketched",
    "",
    f"""SELECT CAST(date_trunc('week', ts) AS DATE) AS window_start, 'all' AS slice_key, 'all' AS slice_value, {_WEEK} 1
UNION ALL SELECT CAST(date_trunc('week', ts) AS DATE), 'event_type', coalesce(event_type, 'unknown'), {_WEEK} 1, 3""",
)
add(
    "label_correlation",
    snaps(1),
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(action_label AS DOUBLE)), 6) AS corr_with_label FROM feats"
        for c in EXPLORED
    ),
)


def histogram_sql(source: str, column: str) -> str:
    return f"""SELECT bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper,
  (SELECT count(*) FROM {source}
   WHERE least(floor((CAST({column} AS DOUBLE) - lo) / w), 24) = bin) AS n_rows, 0::BIGINT AS n_nan
FROM (SELECT CAST(b AS INTEGER) AS bin FROM range(0, 25) t(b)),
     (SELECT min({column})::DOUBLE AS lo, (max({column})::DOUBLE - min({column})::DOUBLE) / 25 AS w FROM {source})"""


add("histogram", snaps(1), histogram_sql("snaps", "age"))
add("order_value_histogram", "", histogram_sql("orders", "o_totalprice"))


def boxplot_sql(source: str, column: str, by: str) -> str:
    return f"""SELECT b.{by}, count(*) AS n, round(any_value(q25), 6) AS q25, round(any_value(q50), 6) AS q50,
  round(any_value(q75), 6) AS q75,
  round(min(v) FILTER (WHERE v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)), 6) AS whisker_low,
  round(max(v) FILTER (WHERE v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)), 6) AS whisker_high,
  count(*) FILTER (WHERE v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS n_outliers
FROM (SELECT {by}, CAST({column} AS DOUBLE) AS v FROM {source}) a
JOIN (SELECT {by}, quantile_cont({column}::DOUBLE, 0.25) AS q25, quantile_cont({column}::DOUBLE, 0.5) AS q50,
             quantile_cont({column}::DOUBLE, 0.75) AS q75 FROM {source} GROUP BY {by}) b ON a.{by} = b.{by}
GROUP BY b.{by}"""


add("boxplot_stats", snaps(1), boxplot_sql("snaps", "browsing_minutes_last_week", "best_action"))
add("event_value_boxplot", "", boxplot_sql("events", "value", "event_type"))

# ---- encoding, training set, split

add(
    "vocabulary",
    snaps(1) + f""", cats AS ({long_rows("feats", CATEGORICAL, kind="VARCHAR")})""",
    """SELECT feature, CASE feature WHEN 'region' THEN 0 WHEN 'top_category' THEN 1 ELSE 2 END AS feature_ordinal,
       value AS category, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS ordinal,
       row_number() OVER (PARTITION BY feature ORDER BY value) = 1 AS is_base
FROM (SELECT DISTINCT feature, value FROM cats WHERE value IS NOT NULL)""",
)
LEVELS = {
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "top_category": ["ECONOMY", "LARGE", "MEDIUM", "NONE", "PROMO", "SMALL", "STANDARD"],
    "age_bucket": ["mid", "senior", "young"],
}
HOT = ", ".join(
    f"CAST({f} = '{v}' AS INTEGER) AS \"{f}_{v}\"" for f in CATEGORICAL for v in LEVELS[f][1:]
)
add("one_hot", snaps(1), f"SELECT customer_id, {', '.join(NUMERIC)}, {HOT} FROM feats")
FEATURES_F = ", ".join("f." + c for c in NUMERIC + CATEGORICAL)
for name, join in (("training_set_inner", "JOIN"), ("training_set_lookup", "LEFT JOIN")):
    add(
        name,
        snaps(1),
        f"""SELECT l.customer_id, l.action_label, {FEATURES_F} FROM feats l
{join} (SELECT * FROM feats WHERE {ACTIVE}) f ON l.customer_id = f.customer_id""",
    )


def hash32(key: str) -> str:
    return f"CAST(('0x' || substr(md5({key} || ':42'), 1, 8)) AS BIGINT)"


add(
    "hash_split",
    snaps(1),
    f"""SELECT customer_id, action_label, best_action,
       CASE WHEN {hash32("customer_id")} < 1073741824 THEN 'test' ELSE 'train' END AS split FROM feats""",
)


def quotas(source: str, label: str) -> str:
    """CTE quota(label, n, test_quota): train rows by largest remainder, the rest is test."""
    return f"""cls AS (SELECT {label} AS label, count(*) AS n FROM {source} GROUP BY {label}),
tot AS (SELECT sum(n) AS n_all, sum(n) - ceil(sum(n) * 0.25) AS n_train FROM cls),
ideal AS (SELECT label, n, n_train * n::DOUBLE / n_all AS want, n_train FROM cls, tot),
ranked AS (SELECT *, row_number() OVER (ORDER BY want - floor(want) DESC, label) AS r,
                  n_train - (SELECT sum(floor(want)) FROM ideal) AS spare FROM ideal),
quota AS (SELECT label, n, CAST(n - floor(want) - CASE WHEN r <= spare THEN 1 ELSE 0 END AS BIGINT) AS test_quota
          FROM ranked)"""


add(
    "split_quotas",
    snaps(1) + ", " + quotas("feats", "action_label"),
    "SELECT label AS action_label, n, test_quota FROM quota",
)
add(
    "exact_split",
    snaps(1) + ", " + quotas("feats", "action_label"),
    f"""SELECT customer_id, action_label, best_action,
       CASE WHEN row_number() OVER (PARTITION BY action_label ORDER BY {hash32("customer_id")}, customer_id)
                 <= test_quota THEN 'test' ELSE 'train' END AS split
FROM feats JOIN quota ON action_label = label""",
)
add(
    "order_exact_split",
    quotas("orders", "o_orderpriority"),
    f"""SELECT o_orderkey, o_orderpriority,
       CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY {hash32("o_orderkey")}, o_orderkey)
                 <= test_quota THEN 'test' ELSE 'train' END AS split
FROM orders JOIN quota ON o_orderpriority = label""",
)

# ---- scoring and evaluation

RULE_SCORES = f"""SELECT customer_id, {ACTION_NAME} AS recommended_action, updated_at AS scored_at_ts,
       'rule' AS model_version FROM feats"""
add("rule_scores", snaps(1), RULE_SCORES)
add("stream_rule_scores", snaps(1), RULE_SCORES)
add(
    "request_scores",
    snaps(1),
    RULE_SCORES + " WHERE customer_id IN (SELECT user_id FROM events WHERE event_type = 'error')",
)
FOREST_SCORES = RULE_SCORES.replace("'rule'", "'1'")
add("rf_scores", snaps(1), FOREST_SCORES)
add("stream_scores", snaps(1), FOREST_SCORES)
add(
    "rf_held_out",
    snaps(1),
    f"""SELECT CAST(action_label AS INTEGER) AS action_label, count(*) AS n_test, true AS accurate, true AS recalled
FROM feats WHERE {hash32("customer_id")} < 1073741824 GROUP BY action_label""",
)
add(
    "rf_requests",
    "",
    """SELECT count(*) AS n_rows, 0::BIGINT AS n_differences FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')""",
)
add("stream_against_batch", "", "SELECT count(*) AS n_rows, 0::BIGINT AS n_differences FROM customer")
ACCURACY = """count(*) AS n_rows, count(*) FILTER (WHERE action_label = predicted_label) AS n_correct,
       round(count(*) FILTER (WHERE action_label = predicted_label)::DOUBLE / count(*), 6) AS accuracy"""
add("accuracy", snaps(4), f"SELECT {ACCURACY} FROM feats")
add("accuracy_by_snapshot", snaps(4), f"SELECT snapshot, {ACCURACY} FROM feats GROUP BY snapshot")
add(
    "classification_report",
    snaps(4)
    + """,
classes AS (SELECT action_label AS c FROM feats UNION SELECT predicted_label FROM feats),
hits AS (SELECT c, (SELECT count(*) FROM feats WHERE action_label = c) AS support,
                (SELECT count(*) FROM feats WHERE predicted_label = c) AS predicted,
                (SELECT count(*) FROM feats WHERE action_label = c AND predicted_label = c) AS tp FROM classes),
m AS (SELECT c, support, tp, coalesce(tp::DOUBLE / nullif(predicted, 0), 0) AS p,
             coalesce(tp::DOUBLE / nullif(support, 0), 0) AS r FROM hits),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM m)""",
    """SELECT CAST(c AS VARCHAR) AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
       support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp)::DOUBLE / sum(support), 6), sum(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f""",
)
add(
    "confusion_matrix",
    snaps(4),
    """SELECT CAST(a AS INTEGER) AS action_label, CAST(p AS INTEGER) AS predicted_label,
       (SELECT count(*) FROM feats WHERE action_label = a AND predicted_label = p) AS n_rows
FROM range(0, 3) x(a), range(0, 3) y(p)""",
)
add(
    "confusion_pivot",
    snaps(4),
    """SELECT CAST(a AS INTEGER) AS action_label,
       (SELECT count(*) FROM feats WHERE action_label = a AND predicted_label = 0) AS pred_0,
       (SELECT count(*) FROM feats WHERE action_label = a AND predicted_label = 1) AS pred_1,
       (SELECT count(*) FROM feats WHERE action_label = a AND predicted_label = 2) AS pred_2
FROM range(0, 3) x(a)""",
)
# the replay itself is a fold over the versions: state = champion version and accuracy
REPLAY = """ordered AS (SELECT model, version, accuracy,
    CASE WHEN accuracy IS NULL OR accuracy = 0 THEN '-infinity'::DOUBLE ELSE accuracy END AS s,
    row_number() OVER (PARTITION BY model ORDER BY version) AS i FROM versions),
fold AS (
  SELECT model, version, accuracy, i, true AS promoted, CAST(NULL AS INTEGER) AS champion_before,
         version AS champ, s AS champ_s FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.model, o.version, o.accuracy, o.i, o.s >= f.champ_s, f.champ,
         CASE WHEN o.s >= f.champ_s THEN o.version ELSE f.champ END,
         CASE WHEN o.s >= f.champ_s THEN o.s ELSE f.champ_s END
  FROM fold f JOIN ordered o ON o.model = f.model AND o.i = f.i + 1)"""
MONTHLY = """versions AS (
  SELECT o_orderpriority AS model,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS version,
         count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE / count(*) AS accuracy
  FROM orders GROUP BY ALL)"""
REGIONAL = (
    snaps(4)
    + """,
versions AS (SELECT region AS model, 4 - snapshot AS version,
    count(*) FILTER (WHERE action_label = predicted_label)::DOUBLE / count(*) AS accuracy
  FROM feats GROUP BY region, snapshot)"""
)
ALIASES = """SELECT model, max(version) FILTER (WHERE promoted) AS champion,
       arg_max(champion_before, version) FILTER (WHERE promoted) AS prev_champion,
       max(version) FILTER (WHERE NOT promoted) AS challenger, max(version) AS staging FROM fold GROUP BY model"""
add(
    "promotion_replay",
    "RECURSIVE " + MONTHLY + ", " + REPLAY,
    """SELECT model, version, round(accuracy, 6) AS accuracy, promoted, champion_before,
       CASE WHEN champion_before IS NULL THEN 'initial_champion' WHEN promoted THEN 'champion'
            ELSE 'challenger' END AS decision FROM fold""",
)
add("promotion_aliases", "RECURSIVE " + MONTHLY + ", " + REPLAY, ALIASES)
add("region_model_aliases", "RECURSIVE " + REGIONAL + ", " + REPLAY, ALIASES)

# ---- log, profiles, drift, reports

add("inference_log", LOG, "SELECT * FROM log")
add(
    "appended_log",
    LOG,
    """SELECT customer_id, recommended_action, income, log_date, model_version, CAST(customer_id % 2 AS VARCHAR) AS batch_id,
       CASE WHEN log_date = (SELECT max(log_date) FROM log) AND customer_id % 2 = 1 THEN lower(recommended_action) END AS channel
FROM log""",
)
add(
    "overwritten_table",
    snaps(1),
    "SELECT customer_id, age_bucket, best_action, CAST(action_label AS INTEGER) AS action_label FROM feats",
)
add("baseline_snapshot", snaps(1), f"SELECT {FEATURE_LIST}, updated_at FROM feats")
add("failed_overwrite", snaps(2), f"SELECT {FEATURE_LIST}, updated_at FROM feats WHERE snapshot = 1")
add(
    "baseline_sample",
    snaps(1),
    f"SELECT {FEATURE_LIST}, updated_at FROM feats ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id LIMIT 1000",
)
add(
    "action_distribution",
    LOG,
    "SELECT log_date, recommended_action, count(*) AS n_rows FROM log GROUP BY ALL",
)
add(
    "log_extent",
    LOG,
    """SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_keys, count(DISTINCT log_date) AS n_dates,
       min(log_date) AS baseline_date, max(log_date) AS current_date FROM log""",
)
add(
    "mean_drift",
    LOG + f""", v AS ({long_rows("log", NUMERIC, "log_date")}),
b AS (SELECT feature, coalesce(avg(value), 0) AS m FROM v WHERE log_date = (SELECT min(log_date) FROM log) GROUP BY feature),
c AS (SELECT feature, coalesce(avg(value), 0) AS m FROM v WHERE log_date = (SELECT max(log_date) FROM log) GROUP BY feature)""",
    """SELECT b.feature, round(b.m, 6) AS baseline_mean, round(c.m, 6) AS current_mean, round(c.m - b.m, 6) AS delta
FROM b JOIN c ON b.feature = c.feature""",
)


def profile_body(source: str, ts: str, granularity: str, columns: list[str], slice_col: str | None) -> str:
    per = long_rows(
        source,
        columns,
        f"CAST(date_trunc('{granularity}', {ts}) AS DATE) AS window_start"
        + (f", CAST({slice_col} AS VARCHAR) AS s" if slice_col else ""),
    )
    shape = """count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_null, count(DISTINCT value) AS n_distinct,
  round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev, round(min(value), 6) AS min,
  round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
  round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max"""
    out = f"""SELECT '{granularity}' AS granularity, window_start, 'all' AS slice_key, 'all' AS slice_value,
  feature AS column_name, {shape} FROM ({per}) GROUP BY window_start, feature"""
    if slice_col:
        out += f""" UNION ALL SELECT '{granularity}', window_start, '{slice_col}', coalesce(s, 'unknown'), feature, {shape}
FROM ({per}) GROUP BY window_start, coalesce(s, 'unknown'), feature"""
    return out


add("profile_daily", snaps(4), profile_body("feats", "updated_at", "day", NUMERIC, None))
add("profile_weekly", snaps(4), profile_body("feats", "updated_at", "week", NUMERIC, None))
EVENT_WEEKLY = profile_body("events", "ts", "week", ["value"], "event_type")
add("event_profile_weekly", "", EVENT_WEEKLY)
add("event_profile_refreshed", "", EVENT_WEEKLY)
add(
    "inference_profile_numeric",
    LOG,
    profile_body("log", "inference_timestamp", "day", NUMERIC, "model_version"),
)
add(
    "inference_profile",
    LOG,
    """SELECT 'day' AS granularity, log_date AS window_start, 'all' AS slice_key, 'all' AS slice_value,
  recommended_action, count(*) AS n_rows,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY log_date), 6)::DOUBLE AS share_pct
FROM log GROUP BY log_date, recommended_action
UNION ALL SELECT 'day', log_date, 'model_version', model_version, recommended_action, count(*),
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY log_date, model_version), 6)::DOUBLE
FROM log GROUP BY log_date, model_version, recommended_action""",
)


def two_sides(columns: list[str], kind: str) -> str:
    return (
        snaps(4)
        + f""",
cur AS ({long_rows("(SELECT * FROM feats WHERE snapshot = 0)", columns, kind=kind)}),
bas AS ({long_rows("(SELECT * FROM feats WHERE snapshot = 3)", columns, kind=kind)})"""
    )


CATEGORICAL_DRIFT = """,
cells AS (SELECT coalesce(c.feature, b.feature) AS feature, coalesce(b.n, 0) AS nb, coalesce(c.n, 0) AS nc
  FROM (SELECT feature, value, count(*) AS n FROM cur GROUP BY ALL) c
  FULL JOIN (SELECT feature, value, count(*) AS n FROM bas GROUP BY ALL) b
    ON c.feature = b.feature AND c.value IS NOT DISTINCT FROM b.value),
t AS (SELECT *, sum(nb) OVER w AS tb, sum(nc) OVER w AS tc, count(*) OVER w AS k FROM cells
      WINDOW w AS (PARTITION BY feature)),
x AS (SELECT *, nb::DOUBLE / tb AS q, nc::DOUBLE / tc AS p, (nb::DOUBLE / tb + nc::DOUBLE / tc) / 2 AS m,
             (nb + 0.5::DOUBLE) / (tb + 0.5::DOUBLE * k) AS sq, (nc + 0.5::DOUBLE) / (tc + 0.5::DOUBLE * k) AS sp,
             (nb + nc)::DOUBLE * tb / (tb + tc) AS eb, (nb + nc)::DOUBLE * tc / (tb + tc) AS ec FROM t)"""
CATEGORICAL_DRIFT_BODY = """SELECT feature, any_value(tb)::BIGINT AS total_baseline, any_value(tc)::BIGINT AS total_current,
  count(*) AS n_categories, round(sum(abs(p - q)) / 2, 6) AS total_variation,
  round(sum((sp - sq) * ln(sp / sq)), 6) AS psi,
  round(sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END
                     + CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END))), 6) AS js_distance,
  round(sum((nb - eb) * (nb - eb) / eb + (nc - ec) * (nc - ec) / ec), 6) AS chi2
FROM x GROUP BY feature"""
add("drift_categorical", two_sides(CATEGORICAL, "VARCHAR") + CATEGORICAL_DRIFT, CATEGORICAL_DRIFT_BODY)
add(
    "drift_prediction",
    snaps(4)
    + f""",
recs AS (SELECT snapshot, {ACTION_NAME} AS recommended_action FROM feats),
cur AS (SELECT 'recommended_action' AS feature, recommended_action AS value FROM recs WHERE snapshot = 0),
bas AS (SELECT 'recommended_action' AS feature, recommended_action AS value FROM recs WHERE snapshot = 3)"""
    + CATEGORICAL_DRIFT,
    CATEGORICAL_DRIFT_BODY,
)
add(
    "drift_numeric",
    two_sides(NUMERIC, "DOUBLE")
    + """,
edges AS (SELECT feature, min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 10 AS w FROM bas GROUP BY feature),
binned AS (SELECT s.feature, side, value,
    CASE WHEN value < lo THEN 0 WHEN value > hi THEN 11
         ELSE 1 + least(coalesce(floor((value - lo) / nullif(w, 0)), 0), 9) END AS bin
  FROM (SELECT 'b' AS side, * FROM bas UNION ALL SELECT 'c', * FROM cur) s JOIN edges e ON s.feature = e.feature
  WHERE value IS NOT NULL),
grid AS (SELECT feature, b AS bin FROM edges, range(0, 12) t(b)),
cells AS (SELECT g.feature, g.bin, count(*) FILTER (WHERE side = 'b') AS nb, count(*) FILTER (WHERE side = 'c') AS nc
  FROM grid g LEFT JOIN binned n ON g.feature = n.feature AND g.bin = n.bin GROUP BY ALL),
t AS (SELECT *, sum(nb) OVER w AS tb, sum(nc) OVER w AS tc, sum(nb) OVER o AS cb, sum(nc) OVER o AS cc FROM cells
      WINDOW w AS (PARTITION BY feature), o AS (PARTITION BY feature ORDER BY bin)),
x AS (SELECT *, (nb + 0.5::DOUBLE) / (tb + 6) AS sq, (nc + 0.5::DOUBLE) / (tc + 6) AS sp,
             abs(cc::DOUBLE / tc - cb::DOUBLE / tb) AS gap FROM t),
means AS (SELECT feature, avg(value) FILTER (WHERE side = 'b') AS mb, avg(value) FILTER (WHERE side = 'c') AS mc
          FROM binned GROUP BY feature)""",
    """SELECT x.feature, any_value(tb)::BIGINT AS total_baseline, any_value(tc)::BIGINT AS total_current,
  round(any_value(mb), 6) AS baseline_mean, round(any_value(mc), 6) AS current_mean,
  round(any_value(mc) - any_value(mb), 6) AS delta_mean, round(max(gap), 6) AS ks,
  round(sum((sp - sq) * ln(sp / sq)), 6) AS psi
FROM x JOIN means ON x.feature = means.feature GROUP BY x.feature""",
)
add(
    "drift_ks_exact",
    two_sides(NUMERIC, "DOUBLE")
    + """,
n AS (SELECT feature, value, sum(b) AS b, sum(c) AS c
      FROM (SELECT feature, value, 1 AS b, 0 AS c FROM bas UNION ALL SELECT feature, value, 0, 1 FROM cur)
      WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT feature, sum(b) OVER w AS cb, sum(c) OVER w AS cc, sum(b) OVER a AS tb, sum(c) OVER a AS tc FROM n
      WINDOW a AS (PARTITION BY feature), w AS (PARTITION BY feature ORDER BY value))""",
    """SELECT feature, any_value(tb)::BIGINT AS n_baseline, any_value(tc)::BIGINT AS n_current,
       round(max(abs(cc::DOUBLE / tc - cb::DOUBLE / tb)), 6) AS ks FROM r GROUP BY feature""",
)
add(
    "drift_consecutive",
    """pf AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS window_start, sk AS slice_key,
         CASE WHEN sk = 'all' THEN 'all' ELSE coalesce(event_type, 'unknown') END AS slice_value,
         count(*) AS n, avg(value) AS m, stddev_samp(value) AS sd,
         100.0::DOUBLE * count(*) FILTER (WHERE value IS NULL) / count(*) AS np
  FROM events, (VALUES ('all'), ('event_type')) t(sk) GROUP BY ALL)""",
    """SELECT 'week' AS granularity, window_start, slice_key, slice_value, 'value' AS column_name,
  lag(window_start) OVER w AS previous_window, n - lag(n) OVER w AS delta_rows,
  round(m - lag(m) OVER w, 6) AS delta_mean, round(sd - lag(sd) OVER w, 6) AS delta_stddev,
  round(np - lag(np) OVER w, 6) AS delta_null_pct,
  round((m - lag(m) OVER w) / nullif(lag(sd) OVER w, 0), 6) AS shift_in_stddev
FROM pf WINDOW w AS (PARTITION BY slice_key, slice_value ORDER BY window_start)
QUALIFY lag(window_start) OVER w IS NOT NULL""",
)
add(
    "performance_report",
    LOG,
    """SELECT 'totals' AS section, 'total_predictions' AS key, count(*) AS value FROM log
UNION ALL SELECT 'totals', 'unique_customers', count(*) FROM (SELECT DISTINCT customer_id FROM log)
UNION ALL SELECT 'totals', 'recent_predictions', count(*) FROM log WHERE log_date >= (SELECT max(log_date) - 7 FROM log)
UNION ALL SELECT 'action', recommended_action, count(*) FROM log GROUP BY recommended_action
UNION ALL SELECT 'version', model_version, count(*) FROM log GROUP BY model_version""",
)
add(
    "health_summary",
    LOG,
    """SELECT 'totals' AS section, 'predictions' AS key, count(*) AS n, CAST(NULL AS DOUBLE) AS share_pct FROM log
UNION ALL SELECT 'totals', 'dates', count(DISTINCT log_date), NULL FROM log
UNION ALL SELECT 'totals', 'recent', count(*), NULL FROM log WHERE log_date >= (SELECT max(log_date) - 7 FROM log)
UNION ALL SELECT 'status', 'good', count(*), NULL FROM log
UNION ALL SELECT 'action', recommended_action, count(*), round(100.0 * count(*) / (SELECT count(*) FROM log), 6)::DOUBLE
  FROM log GROUP BY recommended_action
UNION ALL SELECT 'version', model_version, count(*), round(100.0 * count(*) / (SELECT count(*) FROM log), 6)::DOUBLE
  FROM log GROUP BY model_version""",
)
add(
    "monitor_status",
    LOG,
    """SELECT 'features' AS table_name, true AS monitored, count(DISTINCT updated_at) AS n_windows,
       CAST(max(updated_at) AS DATE) AS newest_window, 8 * count(DISTINCT updated_at) AS profile_rows
FROM feats WHERE snapshot = 0
UNION ALL SELECT 'inference_log', true, count(DISTINCT log_date), max(log_date),
  (SELECT count(*) FROM (SELECT DISTINCT log_date, recommended_action FROM log))
  + (SELECT count(*) FROM (SELECT DISTINCT log_date, model_version, recommended_action FROM log)) FROM log""",
)
# ---- the same figures by another way: stored files, sketches, bitmaps, partitions

add(
    "event_profile_from_files",
    "kept AS (SELECT * FROM events WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM events))",
    profile_body("kept", "ts", "week", ["value"], "event_type"),
)
_SKETCHED_WEEK = _WEEK.replace("round(min(value)", "round(stddev_samp(value), 6) AS stddev, round(min(value)")
add(
    "event_profile_from_sketches",
    "",
    f"""SELECT CAST(date_trunc('week', ts) AS DATE) AS window_start, 'all' AS slice_key, 'all' AS slice_value, {_SKETCHED_WEEK} 1
UNION ALL SELECT CAST(date_trunc('week', ts) AS DATE), 'event_type', coalesce(event_type, 'unknown'), {_SKETCHED_WEEK} 1, 3""",
)
add(
    "ks_from_sketches",
    "cut AS (SELECT max(CAST(ts AS DATE)) - 6 AS day FROM events)",
    """SELECT 'value' AS column_name, count(*) FILTER (CAST(ts AS DATE) < day) AS n_baseline,
  count(*) FILTER (CAST(ts AS DATE) >= day) AS n_current, true AS near_exact FROM events, cut WHERE value IS NOT NULL""",
)
add(
    "training_set_as_of",
    snaps(4)
    + """,
hist AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day, count(*) AS n_orders,
         max(CAST(round(o_totalprice * 100) AS BIGINT)) AS top_cents
  FROM orders GROUP BY ALL)""",
    """SELECT customer_id, snapshot, CAST(action_label AS INTEGER) AS action_label, order_day, n_orders, top_cents
FROM feats ASOF LEFT JOIN hist ON customer_id = o_custkey AND updated_at >= order_day""",
)
add(
    "features_upserted",
    snaps(4),
    f"""SELECT {FEATURE_LIST}, updated_at FROM feats
WHERE snapshot IN (1, 2) AND (snapshot = 1) = (customer_id % 3 = 0) AND customer_id % 40 <> 0
   OR snapshot = 0 AND customer_id % 40 = 0""",
)
add(
    "stream_into_log",
    LOG.replace("'v' || (snapshot % 2 + 1)", "CASE WHEN snapshot >= 2 THEN 'v1' ELSE 'v2' END").replace(f"WHERE {ACTIVE}", ""),
    "SELECT * EXCLUDE (inference_timestamp) FROM log",
)
add(
    "stream_profile",
    "",
    """SELECT CAST(ts AS DATE) AS window_start, count(*) AS n_rows, count(value) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM events GROUP BY 1""",
)
_PAIRS = " UNION ALL ".join(f"SELECT customer_id, '{c}' AS feature, {i} AS place, {c} AS category FROM feats" for i, c in enumerate(CATEGORICAL))
add(
    "one_hot_sparse",
    snaps(1)
    + f""",
pairs AS ({_PAIRS}),
levels AS (
  SELECT feature, place, category, row_number() OVER (PARTITION BY feature ORDER BY category) AS level
  FROM (SELECT DISTINCT feature, place, category FROM pairs WHERE category IS NOT NULL)),
hot AS (SELECT feature, category, row_number() OVER (ORDER BY place, category) - 1 AS position FROM levels WHERE level > 1)""",
    "SELECT customer_id, feature, category, position FROM pairs JOIN hot USING (feature, category)",
)
for _name, _of in (
    ("pinned_baseline", "drift_categorical"),
    ("performance_report_from_bitmaps", "performance_report"),
    ("mean_drift_from_partitions", "mean_drift"),
    ("health_summary_from_partitions", "health_summary"),
):
    ORACLE[_name] = ORACLE[_of]
