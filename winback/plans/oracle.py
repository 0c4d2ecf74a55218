"""The registered queries as SQL for another engine, written branch by branch.

Nothing here is shared with the Spark side but constants: payments, reviews and orders are
joined and grouped separately, quantiles and running sums use the other engine's functions.
"""

from __future__ import annotations

from winback.plans import registry
from winback.plans.registry import (
    BASELINE_DATE,
    FIXED_INTERCEPT,
    FIXED_WEIGHTS,
    LEAD_THRESHOLD,
    SECOND_INTERCEPT,
    SECOND_WEIGHTS,
)

FEATURES = ["frequency", "avg_delivery_days", "monetary_value", "avg_installments", "avg_review_score", "has_review"]
DAY = "86400000000.0"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


ALL_ORDERS = """
all_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL
              WHEN o_orderkey % 97 = 0 THEN o_orderdate - INTERVAL 6 HOUR
              ELSE o_orderdate + to_hours(24 + (o_orderkey * 37) % 600) END AS order_delivered_customer_date
  FROM orders)
"""


def _shop(as_of: str | None = None) -> str:
    cut = f"AND order_purchase_timestamp <= TIMESTAMP '{as_of}'" if as_of else ""
    return f"""{ALL_ORDERS.strip()},
shop_orders AS (
  SELECT *, CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / {DAY}) AS INTEGER)
            AS delivery_days
  FROM all_orders WHERE order_status = 'delivered' {cut}),
customers AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS customer_unique_id,
         n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
payments AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS payment_installments, l_extendedprice AS payment_value
  FROM lineitem),
reviews AS (SELECT event_id AS order_id, 1 + (event_id * 7) % 5 AS review_score FROM events),
bought AS (SELECT o.*, c.customer_unique_id, c.customer_state FROM shop_orders o JOIN customers c USING (customer_id))"""


def _labels(name: str = "labelled") -> str:
    return f"""
last_orders AS (
  SELECT customer_unique_id, max(order_purchase_timestamp) AS last_order_date FROM bought GROUP BY 1),
{name} AS (
  SELECT customer_unique_id, last_order_date, recency, CAST(recency > 280 AS INTEGER) AS is_churn
  FROM (SELECT *, CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) FROM bought)) - epoch_us(last_order_date)) / {DAY})
                       AS INTEGER) AS recency
        FROM last_orders))"""


BRANCHES = """
first_states AS (
  SELECT customer_unique_id, customer_state FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, customer_id) AS nth
    FROM bought WHERE customer_state IS NOT NULL)
  WHERE nth = 1),
logistics AS (
  SELECT b.customer_unique_id, count(order_id) AS frequency, avg(delivery_days) AS avg_delivery_days,
         any_value(s.customer_state) AS customer_state
  FROM bought b LEFT JOIN first_states s USING (customer_unique_id) GROUP BY 1),
monetary AS (
  SELECT customer_unique_id, coalesce(sum(payment_value), 0) AS monetary_value, avg(payment_installments) AS avg_installments
  FROM payments JOIN bought USING (order_id) GROUP BY 1),
satisfaction AS (
  SELECT customer_unique_id, avg(review_score) AS avg_review_score
  FROM reviews JOIN bought USING (order_id) GROUP BY 1)
"""

FEATURE_TABLE = """
joined AS (
  SELECT * FROM logistics LEFT JOIN monetary USING (customer_unique_id)
  LEFT JOIN satisfaction USING (customer_unique_id)
  JOIN (SELECT customer_unique_id, is_churn, recency FROM labelled) USING (customer_unique_id)),
state_filled AS (
  SELECT * REPLACE (coalesce(avg_delivery_days,
                             CASE WHEN customer_state IS NOT NULL
                                  THEN avg(avg_delivery_days) OVER (PARTITION BY customer_state) END) AS avg_delivery_days)
  FROM joined),
features AS MATERIALIZED (
  SELECT customer_unique_id, frequency,
         coalesce(avg_delivery_days, (SELECT avg(avg_delivery_days) FROM state_filled)) AS avg_delivery_days,
         coalesce(monetary_value, 0) AS monetary_value, coalesce(avg_installments, 0) AS avg_installments,
         coalesce(avg_review_score, 3.0) AS avg_review_score, is_churn, recency,
         CAST(avg_review_score IS NOT NULL AS INTEGER) AS has_review
  FROM state_filled)
"""


def _feature_parts(as_of: str | None = None) -> list[str]:
    return [_shop(as_of), _labels(), BRANCHES, FEATURE_TABLE]


SPLIT = """
hashed AS (
  SELECT *, CAST(concat('0x', substr(md5(concat('42:', CAST(customer_unique_id AS VARCHAR))), 1, 8)) AS BIGINT) AS h
  FROM features WHERE frequency >= 2),
split AS MATERIALIZED (
  SELECT hashed.* EXCLUDE (h), CASE WHEN h <= cut AND n > 1 THEN 'test' ELSE 'train' END AS split
  FROM hashed JOIN (SELECT is_churn, count(*) AS n, quantile_cont(CAST(h AS DOUBLE), 0.2) AS cut FROM hashed GROUP BY 1) USING (is_churn))
"""

PARAMETERS = (
    "parameters AS MATERIALIZED (\n"
    + "\n  UNION ALL\n".join(
        f"  SELECT '{name}' AS feature, quantile_cont(CAST({name} AS DOUBLE), 0.5) AS median,"
        f" quantile_cont(CAST({name} AS DOUBLE), 0.75) - quantile_cont(CAST({name} AS DOUBLE), 0.25) AS iqr"
        " FROM split WHERE split = 'train'"
        for name in FEATURES
    )
    + "),\nscales AS (SELECT *, CASE WHEN iqr = 0 THEN 1.0 ELSE iqr END AS scale FROM parameters)"
)
SCALED = (
    "scaled AS (\n  SELECT *"
    + "".join(
        f",\n    ({name} - (SELECT median FROM scales WHERE feature = '{name}'))"
        f" / (SELECT scale FROM scales WHERE feature = '{name}') AS scaled_{name}"
        for name in FEATURES
    )
    + "\n  FROM split)"
)


def _sigmoid(weights: dict[str, float], intercept: float) -> str:
    linear = " + ".join([f"{intercept}", *[f"({weight}) * scaled_{name}" for name, weight in weights.items()]])
    return f"round(1.0 / (1.0 + exp(-(CAST({linear} AS DOUBLE)))), 6)"


SCORED = f"""
scored AS MATERIALIZED (
  SELECT *, {_sigmoid(FIXED_WEIGHTS, FIXED_INTERCEPT)} AS churn_probability,
         {_sigmoid(SECOND_WEIGHTS, SECOND_INTERCEPT)} AS second_probability
  FROM scaled),
tested AS (SELECT * FROM scored WHERE split = 'test')
"""
PREDICTIONS = """
predictions AS MATERIALIZED (
  SELECT model, is_churn, p, CAST(p > 0.5 AS INTEGER) AS predicted
  FROM (SELECT 'fixed' AS model, is_churn, churn_probability AS p FROM tested
        UNION ALL SELECT 'frequency only', is_churn, second_probability FROM tested))
"""
AREAS = """
by_score AS (
  SELECT model, p, sum(is_churn) AS pos, sum(1 - is_churn) AS neg FROM predictions GROUP BY 1, 2),
ordered AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
         sum(pos) OVER (PARTITION BY model ORDER BY p DESC) AS tp, sum(neg) OVER (PARTITION BY model ORDER BY p DESC) AS fp,
         sum(pos) OVER (PARTITION BY model) AS all_pos, sum(neg) OVER (PARTITION BY model) AS all_neg
  FROM by_score),
areas AS (
  SELECT model, CAST(sum(pos * (neg_before + neg / 2.0)) AS DOUBLE) / (CAST(any_value(all_pos) AS DOUBLE) * any_value(all_neg)) AS roc_auc
  FROM ordered GROUP BY 1)
"""
RATES = """
rates AS (
  SELECT model, count(*) FILTER (is_churn = 1 AND predicted = 1) AS tp, count(*) FILTER (predicted = 1) AS flagged,
         count(*) FILTER (is_churn = 1) AS churned, avg(CAST(is_churn = predicted AS DOUBLE)) AS accuracy
  FROM predictions GROUP BY 1)
"""


def _bins(source: str, bins: int) -> str:
    return f"""
bounds AS (SELECT min(churn_probability) AS low, max(churn_probability) AS high, count(*) AS n,
                  stddev_samp(churn_probability) * power(count(*), -0.2) AS bandwidth FROM {source}),
binned AS (
  SELECT CASE WHEN high = low THEN 0
              ELSE least(CAST(floor((churn_probability - low) / (high - low) * {bins}) AS INTEGER), {bins - 1}) END AS bin,
         count(*) AS people, avg(churn_probability) AS mean_value
  FROM {source}, bounds GROUP BY 1)"""


HISTOGRAM = """
histogram AS (
  SELECT CAST(g.bin AS INTEGER) AS bin, low + g.bin * ((high - low) / 50) AS bin_start,
         low + (g.bin + 1) * ((high - low) / 50) AS bin_end, coalesce(people, 0) AS people
  FROM generate_series(0, 49) AS g(bin) CROSS JOIN bounds LEFT JOIN binned ON binned.bin = g.bin)
"""
DENSITY = """
density AS (
  SELECT CAST(g.point AS INTEGER) AS point, low + g.point * (high - low) / 199 AS x, n, low, high,
         sum(people * exp(-0.5 * power((low + g.point * (high - low) / 199 - mean_value) / bandwidth, 2)))
           / (n * bandwidth * sqrt(2 * pi())) AS density
  FROM generate_series(0, 199) AS g(point), bounds, binned
  GROUP BY g.point, low, high, n, bandwidth)
"""

DESCENT_STEPS = 1500


def _fitted() -> str:
    """Class-balanced, L2-penalised logistic regression by accelerated descent on every row.

    Each coefficient moves by its gradient over a bound of its curvature; the intercept is not
    penalised. The problem is convex, so any method ends at the same coefficients.
    """
    size = len(FEATURES) + 1
    penalty = [0, *[1] * len(FEATURES)]
    paces = ", ".join(
        f"1.0 / ({penalty[j]} + 0.25 * sum(w * abs(x[{j + 1}]) * list_sum(list_transform(x, lambda v: abs(v)))))"
        for j in range(size)
    )
    moves = ", ".join(
        f"a[{j + 1}] - s[{j + 1}] * (sum(r * x[{j + 1}]) + {penalty[j]} * a[{j + 1}])" for j in range(size)
    )
    zeros = ", ".join(["CAST(0 AS DOUBLE)"] * size)
    return f"""
observed AS MATERIALIZED (
  SELECT *, [1.0, {", ".join(f"scaled_{name}" for name in FEATURES)}] AS x FROM scaled),
train AS MATERIALIZED (
  SELECT x, is_churn AS y, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY is_churn)) AS w
  FROM observed WHERE split = 'train'),
paces AS MATERIALIZED (SELECT [{paces}] AS s FROM train),
descent(k, b, a) AS (
  SELECT 0, [{zeros}], [{zeros}]
  UNION ALL
  SELECT k + 1, nb, list_transform(list_zip(nb, b), lambda z: z[1] + 0.9 * (z[1] - z[2]))
  FROM (SELECT k, b, [{moves}] AS nb
        FROM (SELECT k, b, a, s, x, w * (1.0 / (1.0 + exp(-list_dot_product(a, x))) - y) AS r
              FROM descent, paces, train WHERE k < {DESCENT_STEPS})
        GROUP BY k, b, a, s)),
fitted AS MATERIALIZED (SELECT b FROM descent WHERE k = {DESCENT_STEPS}),
coefficients AS (
  SELECT unnest([{", ".join(f"'{name}'" for name in FEATURES)}]) AS feature, unnest(b[2:]) AS c FROM fitted),
tested AS MATERIALIZED (
  SELECT observed.*, 1.0 / (1.0 + exp(-list_dot_product(b, x))) AS churn_probability
  FROM observed, fitted WHERE split = 'test'),
predictions AS MATERIALIZED (
  SELECT 'Logistic Regression' AS model, is_churn, churn_probability AS p,
         CAST(churn_probability > 0.5 AS INTEGER) AS predicted FROM tested)"""


def _cuts(positive: str, negative: str) -> str:
    """Class weights on both sides of every cut of every scaled feature of the training part."""
    tall = "\n UNION ALL ".join(
        f"SELECT 'scaled_{name}' AS feature, scaled_{name} AS v, is_churn FROM scaled WHERE split = 'train'" for name in FEATURES
    )
    return f"""
tall AS ({tall}),
shares AS (SELECT {positive} AS up, {negative} AS down FROM (
  SELECT count(*) AS n, sum(is_churn) AS p, sum(1 - is_churn) AS q FROM scaled WHERE split = 'train')),
by_value AS (SELECT feature, v, sum(is_churn) AS p, sum(1 - is_churn) AS q FROM tall GROUP BY 1, 2),
passed AS (
  SELECT feature, v, lead(v) OVER (PARTITION BY feature ORDER BY v) AS next_v,
         sum(p) OVER w * up AS lp, sum(q) OVER w * down AS lq,
         (sum(p) OVER (PARTITION BY feature) - sum(p) OVER w) * up AS rp,
         (sum(q) OVER (PARTITION BY feature) - sum(q) OVER w) * down AS rq
  FROM by_value, shares WINDOW w AS (PARTITION BY feature ORDER BY v)),
cuts AS (SELECT * FROM passed WHERE next_v IS NOT NULL)"""


TIERED = """
tiered AS (
  SELECT customer_unique_id, churn_probability,
         CASE WHEN churn_probability > 0.75 THEN 'Critical' WHEN churn_probability >= 0.5 THEN 'At Risk' ELSE 'Safe' END AS risk_tier
  FROM tested),
advice(risk_tier, strategy, action) AS (VALUES
  ('Critical', 'Immediate Intervention', 'Apology and free shipping e-mail if delivery took more than 7 days'),
  ('At Risk', 'Nudge Campaign', 'Personalised product recommendations'),
  ('Safe', 'Do Not Disturb', 'No marketing; save budget'))
"""

ROUNDED_FEATURES = """SELECT customer_unique_id, frequency, round(avg_delivery_days, 6) AS avg_delivery_days,
  round(monetary_value, 4) AS monetary_value, round(avg_installments, 6) AS avg_installments,
  round(avg_review_score, 6) AS avg_review_score, is_churn, recency, has_review FROM """
LEAD_COLUMNS = """customer_unique_id, churn_probability, frequency, round(monetary_value, 4) AS monetary_value,
  round(avg_delivery_days, 6) AS avg_delivery_days, round(avg_review_score, 6) AS avg_review_score"""
SCALED_COLUMNS = ", ".join(f"round(scaled_{name}, 6) AS scaled_{name}" for name in FEATURES)
CHURN_RATE = "count(*) AS people, CAST(sum(is_churn) AS BIGINT) AS churned, round(avg(is_churn), 6) AS churn_rate"
BEYOND = "round(avg_delivery_days - (SELECT avg(avg_delivery_days) FROM rounded), 6)"


def _drift() -> str:
    baseline = ",\n".join(_feature_parts(f"{BASELINE_DATE:%Y-%m-%d %H:%M:%S}"))
    current = ",\n".join(_feature_parts())
    names = [name for name in FEATURES if name != "has_review"]
    tall = "\n UNION ALL ".join(
        f"SELECT '{side}' AS side, '{name}' AS feature, CAST({name} AS DOUBLE) AS v FROM {side}"
        for side in ("old_people", "new_people")
        for name in names
    )
    return f"""
WITH old_people AS MATERIALIZED ({ROUNDED_FEATURES} (WITH {baseline} SELECT * FROM features)),
new_people AS MATERIALIZED ({ROUNDED_FEATURES} (WITH {current} SELECT * FROM features)),
tall AS ({tall}),
cuts AS (
  SELECT DISTINCT feature, round(cut, 9) AS cut
  FROM (SELECT feature, unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS cut
        FROM tall WHERE side = 'old_people' GROUP BY feature)),
placed AS (
  SELECT side, feature, (SELECT count(*) FROM cuts WHERE cuts.feature = tall.feature AND tall.v > cuts.cut) AS bin FROM tall),
bins AS (
  SELECT feature, unnest(generate_series(0, count(*))) AS bin FROM cuts GROUP BY feature),
shares AS (
  SELECT feature, bin,
         greatest(count(*) FILTER (side = 'old_people') / (SELECT CAST(count(*) AS DOUBLE) FROM old_people), 1e-4) AS p,
         greatest(count(*) FILTER (side = 'new_people') / (SELECT CAST(count(*) AS DOUBLE) FROM new_people), 1e-4) AS q
  FROM bins LEFT JOIN placed USING (feature, bin) GROUP BY 1, 2)
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi FROM shares GROUP BY 1"""


def oracle_queries() -> dict[str, str]:
    shop, features = [_shop()], _feature_parts()
    split = [*features, SPLIT]
    scored = [*split, PARAMETERS, SCALED, SCORED]
    predicted = [*scored, PREDICTIONS]
    trained = [*split, PARAMETERS, SCALED, _fitted()]
    rounded = [*features, f"rounded AS MATERIALIZED ({ROUNDED_FEATURES} features)"]
    windows = """
spans AS (
  SELECT time_bucket(INTERVAL 30 DAY, order_purchase_timestamp, TIMESTAMP '1970-01-01') AS window_start,
         count(*) AS deliveries, avg(delivery_days) AS mean_delivery_days
  FROM shop_orders WHERE delivery_days IS NOT NULL GROUP BY 1)"""
    leads = f"SELECT {LEAD_COLUMNS} FROM tested WHERE churn_probability > {LEAD_THRESHOLD}"
    comparison = """SELECT model AS "Model", round(roc_auc, 6) AS "ROC-AUC",
  coalesce(round(tp / CAST(churned AS DOUBLE), 6), 0) AS "Recall",
  CASE WHEN flagged = 0 THEN 0.0 ELSE round(tp / CAST(flagged AS DOUBLE), 6) END AS "Precision",
  round(2 * tp / CAST(flagged + churned AS DOUBLE), 6) AS "F1-Score", round(accuracy, 6) AS "Accuracy"
FROM rates JOIN areas USING (model)"""
    sql = {
        "customers_scan": _with(*shop) + "SELECT * FROM customers",
        "payments_scan": _with(*shop) + "SELECT * FROM payments",
        "reviews_scan": _with(*shop) + "SELECT * FROM reviews",
        "delivered_orders": _with(*shop) + "SELECT * FROM shop_orders",
        "safe_timestamps": """
SELECT o_orderkey AS order_id,
  CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0
       THEN NULL ELSE o_orderdate END AS purchased_at,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 2.5 WHEN o_orderkey % 11 = 0 THEN 1000.0
       WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey AS DOUBLE) END AS number
FROM orders""",
        "churn_labels": _with(*shop, _labels()) + "SELECT * FROM labelled",
        "churn_rate_report": _with(*shop, _labels())
        + "SELECT CAST(max(last_order_date) AS DATE) AS snapshot_date, count(*) AS people,"
        " round(avg(is_churn), 6) AS churn_rate FROM labelled",
        "logistics_features": _with(*shop, BRANCHES)
        + "SELECT customer_unique_id, frequency, round(avg_delivery_days, 6) AS avg_delivery_days, customer_state FROM logistics",
        "monetary_features": _with(*shop, BRANCHES)
        + "SELECT customer_unique_id, round(monetary_value, 4) AS monetary_value,"
        " round(avg_installments, 6) AS avg_installments FROM monetary",
        "review_features": _with(*shop, BRANCHES)
        + "SELECT customer_unique_id, round(avg_review_score, 6) AS avg_review_score FROM satisfaction",
        "order_ledger": _with(
            *shop,
            """
paid AS (SELECT order_id, count(*) AS payment_rows, sum(payment_value) AS paid, sum(payment_installments) AS installment_sum,
                count(payment_installments) AS installment_rows FROM payments GROUP BY 1),
rated AS (SELECT order_id, count(*) AS review_rows, sum(review_score) AS score_sum, count(review_score) AS score_rows
          FROM reviews GROUP BY 1)""",
        )
        + """SELECT order_id, coalesce(payment_rows, 0) AS payment_rows, round(paid, 6) AS paid,
  CAST(installment_sum AS DOUBLE) AS installment_sum, coalesce(installment_rows, 0) AS installment_rows,
  coalesce(review_rows, 0) AS review_rows, CAST(score_sum AS DOUBLE) AS score_sum, coalesce(score_rows, 0) AS score_rows
FROM paid FULL JOIN rated USING (order_id)""",
        "state_delivery_means": _with(*shop, BRANCHES)
        + "SELECT customer_state, count(*) AS people, round(avg(avg_delivery_days), 6) AS state_delivery_days"
        " FROM logistics WHERE customer_state IS NOT NULL GROUP BY 1",
        "customer_features": _with(*features) + ROUNDED_FEATURES + "features",
        "customer_features_joined_labels": _with(*features) + ROUNDED_FEATURES + "features",
        "features_as_of": _with(*_feature_parts(f"{BASELINE_DATE:%Y-%m-%d %H:%M:%S}")) + ROUNDED_FEATURES + "features",
        "repeat_buyers": _with(*features) + ROUNDED_FEATURES + "features WHERE frequency >= 2",
        "row_counts": _with(*features)
        + "SELECT count(*) AS people, count(*) FILTER (frequency >= 2) AS repeat_buyers FROM features",
        "stratified_split": _with(*split) + "SELECT customer_unique_id, is_churn, split FROM split",
        "split_counts": _with(*split) + "SELECT split, is_churn, count(*) AS people FROM split GROUP BY 1, 2",
        "class_weights": _with(*split, "train AS (SELECT * FROM split WHERE split = 'train')")
        + """SELECT is_churn AS class, count(*) AS people,
  round((SELECT count(*) FROM train) / (2.0 * count(*)), 6) AS balanced_weight,
  (SELECT round(sum(1 - is_churn) / CAST(sum(is_churn) AS DOUBLE), 6) FROM train) AS scale_pos_weight
FROM train GROUP BY 1""",
        "scaler_params": _with(*split, PARAMETERS)
        + """SELECT feature, round(median, 6) AS median, round(iqr, 6) AS iqr, round(scale, 6) AS scale FROM scales""",
        "scaled_features": _with(*split, PARAMETERS, SCALED)
        + f"SELECT customer_unique_id, is_churn, split, {SCALED_COLUMNS} FROM scaled",
        "training_preview": _with(*split, PARAMETERS, SCALED)
        + f"SELECT customer_unique_id, {SCALED_COLUMNS} FROM scaled WHERE split = 'train' ORDER BY customer_unique_id LIMIT 3",
        "scored_fixed": _with(*scored)
        + "SELECT customer_unique_id, split, is_churn, churn_probability, second_probability FROM scored",
        "metrics_fixed": _with(*predicted, AREAS, RATES) + comparison,
        "roc_auc_fixed": _with(*predicted, AREAS) + "SELECT model, round(roc_auc, 6) AS roc_auc FROM areas",
        "roc_points_fixed": _with(*predicted, AREAS)
        + """SELECT model, p AS threshold, round(fp / CAST(all_neg AS DOUBLE), 6) AS fpr,
  round(tp / CAST(all_pos AS DOUBLE), 6) AS tpr
FROM (SELECT *, lag(pos) OVER o = pos AND lag(neg) OVER o = neg AND lead(pos) OVER o IS NOT NULL AS between_equals
      FROM ordered WINDOW o AS (PARTITION BY model ORDER BY p))
WHERE between_equals IS NOT TRUE
UNION ALL SELECT DISTINCT model, CAST('Infinity' AS DOUBLE), 0.0, 0.0 FROM ordered""",
        "roc_chart_fixed": _with(
            *predicted,
            AREAS,
            """
stepped AS (SELECT model, is_churn, ceil(p * 100) / 100.0 AS p FROM predictions),
steps AS (SELECT model, p, sum(is_churn) AS pos, sum(1 - is_churn) AS neg FROM stepped GROUP BY 1, 2),
curve AS (
  SELECT model, fpr, tpr FROM (
    SELECT model, sum(neg) OVER (PARTITION BY model ORDER BY p DESC) / CAST(sum(neg) OVER (PARTITION BY model) AS DOUBLE) AS fpr,
           sum(pos) OVER (PARTITION BY model ORDER BY p DESC) / CAST(sum(pos) OVER (PARTITION BY model) AS DOUBLE) AS tpr,
           lag(pos) OVER o = pos AND lag(neg) OVER o = neg AND lead(pos) OVER o IS NOT NULL AS between_equals
    FROM steps WINDOW o AS (PARTITION BY model ORDER BY p)) WHERE between_equals IS NOT TRUE
  UNION ALL SELECT DISTINCT model, 0.0, 0.0 FROM predictions)""",
        )
        + """SELECT printf('%s (AUC = %.2f)', model, roc_auc) AS series, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr
FROM curve JOIN areas USING (model)
UNION ALL SELECT * FROM (VALUES ('chance', 0.0, 0.0), ('chance', 1.0, 1.0))""",
        "confusion_fixed": _with(*predicted)
        + """SELECT m.model, a.actual, count(*) FILTER (p.predicted = 0) AS predicted_0, count(*) FILTER (p.predicted = 1) AS predicted_1
FROM (SELECT DISTINCT model FROM predictions) m CROSS JOIN (VALUES (0), (1)) a(actual)
LEFT JOIN predictions p ON p.model = m.model AND p.is_churn = a.actual GROUP BY 1, 2""",
        "confusion_counts_fixed": _with(*predicted)
        + """SELECT m.model, a.actual, b.predicted, count(p.p) AS people
FROM (SELECT DISTINCT model FROM predictions) m CROSS JOIN (VALUES (0), (1)) a(actual) CROSS JOIN (VALUES (0), (1)) b(predicted)
LEFT JOIN predictions p ON p.model = m.model AND p.is_churn = a.actual AND p.predicted = b.predicted GROUP BY 1, 2, 3""",
        "prob_stats": _with(*scored)
        + """SELECT count(*) AS people, max(churn_probability) AS max_probability,
  round(avg(churn_probability), 6) AS mean_probability FROM tested""",
        "prob_histogram": _with(*scored, _bins("tested", 50), HISTOGRAM)
        + "SELECT bin, round(bin_start, 9) AS bin_start, round(bin_end, 9) AS bin_end, people FROM histogram",
        "prob_density": _with(*scored, _bins("tested", 2048), DENSITY)
        + """SELECT point, round(x, 6) AS x, round(density, 6) AS density,
  round(density * n * (high - low) / 50, 6) AS curve FROM density""",
        "prob_chart": _with(
            *scored,
            _bins("tested", 50),
            HISTOGRAM,
            _bins("tested", 2048).replace("bounds AS", "bounds2 AS").replace("binned AS", "fine AS").replace(", bounds GROUP", ", bounds2 GROUP"),
            DENSITY.replace("bounds, binned", "bounds2, fine"),
        )
        + f"""SELECT 'histogram' AS series, round(bin_start, 9) AS x, CAST(people AS DOUBLE) AS y FROM histogram
UNION ALL SELECT 'density', round(x, 9), round(density * n * (high - low) / 50, 9) FROM density
UNION ALL SELECT 'threshold', 0.75, NULL""",
        "high_risk_leads": _with(*scored) + leads,
        "top10_leads": _with(*scored) + leads + " ORDER BY churn_probability DESC, customer_unique_id LIMIT 10",
        "exported_leads": _with(*scored)
        + leads.replace("SELECT", "SELECT row_number() OVER (ORDER BY churn_probability DESC, customer_unique_id) AS position,", 1),
        "ordered_reports": f"""
SELECT 'comparison' AS report, CAST(position AS INTEGER) AS position, name FROM (
  {_with(*predicted, RATES)} SELECT row_number() OVER (ORDER BY tp / CAST(churned AS DOUBLE) DESC, model) AS position, model AS name FROM rates)
UNION ALL SELECT 'coefficients', CAST(position AS INTEGER), name FROM (
  {_with(*trained).replace("WITH", "WITH RECURSIVE", 1)} SELECT row_number() OVER (ORDER BY abs(c) DESC) AS position, feature AS name FROM coefficients)
UNION ALL SELECT 'top leads', CAST(position AS INTEGER), name FROM (
  {_with(*scored)} SELECT row_number() OVER (ORDER BY churn_probability DESC, customer_unique_id) AS position,
    CAST(customer_unique_id AS VARCHAR) AS name FROM tested WHERE churn_probability > {LEAD_THRESHOLD}) WHERE position <= 10""",
        "risk_tiers": _with(*scored, TIERED)
        + "SELECT customer_unique_id, churn_probability, risk_tier, strategy, action FROM tiered JOIN advice USING (risk_tier)",
        "risk_tier_counts": _with(*scored, TIERED)
        + """SELECT risk_tier, strategy, action, count(*) AS people, round(avg(churn_probability), 6) AS mean_probability
FROM tiered JOIN advice USING (risk_tier) GROUP BY 1, 2, 3""",
        "lr_coefficients": _with(*trained).replace("WITH", "WITH RECURSIVE", 1)
        + """SELECT feature AS "Feature", round(c, 4) AS "Coefficient", round(abs(c), 4) AS "Abs_Impact",
  CASE WHEN c > 0 THEN 'Increases Churn Risk' ELSE 'Increases Loyalty' END AS direction
FROM coefficients ORDER BY abs(c) DESC LIMIT 10""",
        "lr_risk_factors": _with(*trained).replace("WITH", "WITH RECURSIVE", 1)
        + """SELECT feature AS "Feature", round(c, 4) AS "Coefficient", round(abs(c), 4) AS "Abs_Impact"
FROM coefficients WHERE c > 0 ORDER BY abs(c) DESC LIMIT 5""",
        "lr_leads": _with(*trained).replace("WITH", "WITH RECURSIVE", 1)
        + f"""SELECT customer_unique_id, round(churn_probability, 4) AS churn_probability, frequency,
  round(monetary_value, 4) AS monetary_value, round(avg_delivery_days, 4) AS avg_delivery_days,
  round(avg_review_score, 4) AS avg_review_score FROM tested WHERE churn_probability > {LEAD_THRESHOLD}""",
        "lr_prob_stats": _with(*trained).replace("WITH", "WITH RECURSIVE", 1)
        + """SELECT count(*) AS people, round(max(churn_probability), 4) AS max_probability,
  round(avg(churn_probability), 4) AS mean_probability FROM tested""",
        "lr_metrics": _with(*trained, AREAS, RATES).replace("WITH", "WITH RECURSIVE", 1) + comparison.replace(", 6)", ", 4)"),
        "tree_stumps": _with(
            *split,
            PARAMETERS,
            SCALED,
            _cuts("n / (2.0 * p)", "n / (2.0 * q)"),
            """
gains AS (
  SELECT feature, (v + next_v) / 2 AS threshold, lp + lq AS left_weight, rp + rq AS right_weight,
         (2 * (lp + rp) * (lq + rq) / (lp + rp + lq + rq) - 2 * lp * lq / (lp + lq) - 2 * rp * rq / (rp + rq)) / (lp + rp + lq + rq) AS gain
  FROM cuts),
best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) = 1)""",
        )
        + """SELECT feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain, round(left_weight, 6) AS left_weight,
  round(right_weight, 6) AS right_weight, gain = max(gain) OVER () AS taken FROM best""",
        "boosting_first_round": _with(
            *split,
            PARAMETERS,
            SCALED,
            _cuts("q / CAST(p AS DOUBLE)", "1.0"),
            """
sides AS (
  SELECT feature, v, 0.5 * (lq - lp) AS lg, 0.25 * (lq + lp) AS lh, 0.5 * (rq - rp) AS rg, 0.25 * (rq + rp) AS rh FROM cuts),
gains AS (
  SELECT *, lg * lg / (lh + 1) + rg * rg / (rh + 1) AS gain FROM sides WHERE lh >= 1 AND rh >= 1),
best AS (SELECT * FROM gains ORDER BY round(gain, 9) DESC, list_position(["""
            + ", ".join(f"'scaled_{name}'" for name in FEATURES)
            + """], feature), v LIMIT 1)""",
        )
        + """SELECT replace(feature, 'scaled_', '') AS feature, round(v, 6) AS cut, round(-lg / (lh + 1), 6) AS left_leaf,
  round(-rg / (rh + 1), 6) AS right_leaf FROM best""",
        "model_scorecard": _with(*split, "tested AS (SELECT * FROM split WHERE split = 'test')")
        + """SELECT model, count(*) AS people, CAST(sum(is_churn) AS BIGINT) AS churned, true AS sound, true AS beats_chance
FROM tested CROSS JOIN (VALUES ('Logistic Regression'), ('Random Forest'), ('Boosted Trees')) AS m(model) GROUP BY 1""",
        "churn_by_delay": _with(*rounded, f"banded AS (SELECT *, {BEYOND} AS beyond FROM rounded)")
        + f"""SELECT CASE WHEN beyond > 3 THEN 'late by more than the step' WHEN beyond > 0 THEN 'late within the step'
  WHEN beyond >= -3 THEN 'early within the step' ELSE 'early by more than the step' END AS delay_band,
  {CHURN_RATE} FROM banded GROUP BY 1""",
        "churn_by_review": _with(*rounded)
        + f"SELECT CAST(round(avg_review_score) AS INTEGER) AS stars, {CHURN_RATE} FROM rounded WHERE has_review = 1 GROUP BY 1",
        "churn_by_spend_service": _with(
            *rounded,
            "edges AS (SELECT list_transform(quantile_cont(monetary_value, [0.25, 0.5, 0.75]), lambda e: round(e, 9)) AS e FROM rounded)",
        )
        + f"""SELECT 1 + CAST(monetary_value > e[1] AS INTEGER) + CAST(monetary_value > e[2] AS INTEGER)
  + CAST(monetary_value > e[3] AS INTEGER) AS spend_quartile, CAST({BEYOND} > 0 AS INTEGER) AS late,
  {CHURN_RATE} FROM rounded, edges GROUP BY 1, 2""",
        "feature_drift_psi": _drift(),
        "delivery_windows": _with(*shop, windows)
        + """SELECT window_start, deliveries, round(mean_delivery_days, 6) AS mean_delivery_days,
  round(mean_delivery_days / (SELECT avg(delivery_days) FROM shop_orders), 6) AS over_average FROM spans""",
        "stream_delivery_windows": _with(*shop, windows)
        + "SELECT window_start, deliveries, round(mean_delivery_days, 6) AS mean_delivery_days FROM spans",
        "stream_scoring": _with(*scored)
        + """SELECT customer_unique_id, frequency, churn_probability,
  CASE WHEN churn_probability > 0.75 THEN 'Critical' WHEN churn_probability >= 0.5 THEN 'At Risk' ELSE 'Safe' END AS risk_tier
FROM scored""",
        "ab_uplift": _with(
            *scored,
            """
arms AS (
  SELECT 1 - is_churn AS converted,
         CAST(concat('0x', substr(md5(concat('winback:', CAST(customer_unique_id AS VARCHAR))), 1, 8)) AS BIGINT) < 2147483648 AS treated
  FROM scored WHERE churn_probability > 0.5),
totals AS (
  SELECT count(*) FILTER (treated) AS n_t, count(*) FILTER (NOT treated) AS n_c,
         avg(converted) FILTER (treated) AS r_t, avg(converted) FILTER (NOT treated) AS r_c, avg(converted) AS pooled
  FROM arms)""",
        )
        + """SELECT n_t AS treated, n_c AS controls, round(r_t, 6) AS treatment_rate, round(r_c, 6) AS control_rate,
  round(r_t - r_c, 6) AS uplift, round((r_t - r_c) / sqrt(pooled * (1 - pooled) * (1.0 / n_t + 1.0 / n_c)), 6) AS z_score
FROM totals""",
    }
    sql["features_from_csv"] = sql["customer_features"]
    sql["csv_reject_counts"] = _with(
        ALL_ORDERS,
        """
cells AS (
  SELECT 'orders' AS "table", printf('shop%d_orders_dataset.csv', order_id % 2) AS file, 'no date: order_estimated_delivery_date' AS reason FROM all_orders
  UNION ALL
  SELECT 'orders', printf('shop%d_orders_dataset.csv', order_id % 2), 'no date: order_delivered_customer_date'
  FROM all_orders WHERE order_delivered_customer_date IS NULL
  UNION ALL
  SELECT 'payments', printf('shop%d_order_payments_dataset.csv', 2 + event_id % 2),
         CASE WHEN event_id % 3 = 0 THEN 'no number: payment_value' ELSE 'malformed line' END
  FROM events WHERE event_id % 3 < 2)""",
    ) + 'SELECT "table", file, reason, count(*) AS rejects FROM cells GROUP BY 1, 2, 3'
    sql["churn_run_leads"] = sql["lr_leads"]
    sql["stream_drift_psi"] = sql["feature_drift_psi"]
    unknown = sql.keys() - registry.QUERIES.keys()
    if unknown:
        raise KeyError(f"oracle without a query: {sorted(unknown)}")
    return sql
