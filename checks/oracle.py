"""SQL twins of the registered queries, for any engine that has the test tables as views.

Rounding goes through the shortest decimal text of a double, which gives half-up results on
the printed value. Money is summed in whole ten-thousandths.
"""

from __future__ import annotations

import re

from .inputs import AS_OF, EVENT_OF_PRIORITY, INTERVALS, RFM_LABEL, RUN_ID, STATUS
from .queries import REPORT_DAY, SINCE


def r(x: str, n: int) -> str:
    return f"CAST(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,{n})) AS DOUBLE)"


def half_even(x: str, n: int) -> str:
    """Half-even rounding of the printed value."""
    d = f"CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))"
    scaled = f"({d} * {10**n})"
    low = f"CAST(floor({scaled}) AS BIGINT)"
    up = f"CASE WHEN {scaled} - {low} > 0.5 THEN 1 WHEN {scaled} - {low} = 0.5 THEN {low} % 2 ELSE 0 END"
    return f"(({low} + {up}) / {10**n}::DOUBLE)"


def u(x: str) -> str:
    return f"CAST(round_even(({x}) * 10000, 0) AS HUGEINT)"


def tot(x: str, over: str = "") -> str:
    return f"(CAST(sum({u(x)}) {over} AS DOUBLE) / 10000::DOUBLE)"


def avg(x: str, over: str = "") -> str:
    return f"({tot(x, over)} / nullif(count({u(x)}) {over}, 0))"


def rate_avg(x: str) -> str:
    """Average of a rate with six decimals, exact before the division."""
    return f"(CAST(sum(CAST(round_even({x} * 1000000, 0) AS HUGEINT)) AS DOUBLE) / 1000000::DOUBLE / nullif(count({x}), 0))"


def ratio(num: str, den: str, n: int) -> str:
    return f"CASE WHEN {den} > 0 THEN {r(f'({num}) / ({den})', n)} END"


def pct_of_base(part: str, base: str) -> str:
    return f"({part}) / (CASE WHEN {base} <> 0 THEN {base} ELSE 1.0::DOUBLE END) * 100.0::DOUBLE"


def usd(cents: str) -> str:
    return r(f"{cents} / 100.0::DOUBLE", 2)


def period(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def month_number(p: str) -> str:
    return f"(CAST(substr({p}, 1, 4) AS INTEGER) * 12 + CAST(substr({p}, 6, 2) AS INTEGER) - 1)"


def period_of_number(n: str) -> str:
    return f"(lpad(CAST(({n}) // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST(({n}) % 12 + 1 AS VARCHAR), 2, '0'))"


def lookup(mapping: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def trailing(n: int, unit: str = "ROWS", seg: str = "segment_id") -> str:
    if unit == "ROWS":
        return f"OVER (PARTITION BY {seg} ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"OVER (PARTITION BY {seg} ORDER BY date RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING"
        " AND CURRENT ROW)"
    )


def rolling(unit: str) -> str:
    w7, w30 = trailing(7, unit), trailing(30, unit)
    return f"""
      SELECT *, {avg('revenue_daily', w7)} AS revenue_7d_avg,
        stddev_samp(revenue_daily) {w7} AS revenue_7d_std,
        {avg('revenue_daily', w30)} AS revenue_30d_avg,
        stddev_samp(revenue_daily) {w30} AS revenue_30d_std
      FROM daily"""


W7, W30 = trailing(7, seg="segment"), trailing(30, seg="segment")
SERIES = "OVER (PARTITION BY segment ORDER BY date)"
YEAR = (
    "OVER (PARTITION BY cohort_month, geo_region ORDER BY cohort_index"
    " ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
)
NRR = "total_beginning_arr_dollars + expansion_arr_dollars + contraction_arr_dollars + churn_arr_dollars"
GRR = "total_beginning_arr_dollars + contraction_arr_dollars + churn_arr_dollars"
HASH = (
    "CAST(('0x' || substr(md5(coalesce(CAST(event_id AS VARCHAR), '\\N') || '|' ||"
    " coalesce(CAST(user_id AS VARCHAR), '\\N') || '|' || coalesce(event_type, '\\N')), 1, 8)) AS BIGINT)"
)


def moved(label: str, amount: str = "arr_delta_dollars") -> str:
    return tot(f"CASE WHEN arr_movement_label = '{label}' THEN {amount} ELSE 0.0::DOUBLE END")


def movement_arr(kind: str) -> str:
    inner = tot(f"CASE WHEN movement_type = '{kind}' THEN net_new_mrr_dollars END")
    return inner


STEMS = {
    "new_business": "new_business", "expansion": "expansion", "contraction": "contraction",
    "churned": "churn", "reactivated": "reactivation", "neutral": "neutral",
}

CTES = {
    # customer segmentation
    "rfm_orders": f"""
      SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CAST(o_orderdate AS DATE) AS order_date, {lookup(STATUS, 'o_orderstatus')} AS status,
        o_totalprice AS total_amount
      FROM orders""",
    "paid": "SELECT * FROM rfm_orders WHERE status IN ('COMPLETED', 'SHIPPED', 'DELIVERED')",
    "rfm_totals": f"""
      SELECT customer_id, count(DISTINCT order_id) AS order_count,
        {tot('total_amount')} AS monetary_value, min(order_date) AS first_order_date,
        max(order_date) AS last_order_date, {avg('total_amount')} AS avg_order_value,
        stddev_samp(total_amount) AS stddev_order_value,
        CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM paid)) AS INTEGER)
          AS recency_days
      FROM paid GROUP BY customer_id""",
    "rfm_gaps": """
      SELECT *, CASE WHEN order_count > 1 THEN
        date_diff('day', first_order_date, last_order_date) // (order_count - 1) END AS gap
      FROM rfm_totals""",
    "rfm_speed": f"""
      SELECT * EXCLUDE (gap), CASE WHEN first_order_date IS NULL OR last_order_date IS NULL THEN NULL
        WHEN gap > 0 THEN {half_even('1.0::DOUBLE / gap', 6)} ELSE 0.0::DOUBLE END
        AS purchase_velocity
      FROM rfm_gaps""",
    "rfm_tiles": """
      SELECT *,
        CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS FIRST, customer_id) AS INTEGER) AS r_score,
        CAST(ntile(5) OVER (ORDER BY order_count NULLS FIRST, customer_id) AS INTEGER) AS f_score,
        CAST(ntile(5) OVER (ORDER BY monetary_value NULLS FIRST, customer_id) AS INTEGER) AS m_score
      FROM rfm_speed""",
    "rfm_composed": f"""
      SELECT *, {r('r_score * 0.3::DOUBLE + f_score * 0.35::DOUBLE + m_score * 0.35::DOUBLE', 4)}
          AS rfm_composite,
        r_score || '-' || f_score || '-' || m_score AS rfm_cell
      FROM rfm_tiles""",
    "rfm_labelled": """
      SELECT *, CASE WHEN rfm_composite >= 4.5 THEN 'Champions' WHEN rfm_composite >= 3.5 THEN 'Loyal'
        WHEN rfm_composite >= 2.5 THEN 'At-Risk' WHEN rfm_composite >= 1.5 THEN 'Lost' ELSE 'New' END
        AS rfm_segment
      FROM rfm_composed""",
    "rfm_known": """
      SELECT c_custkey AS customer_id, c_name AS first_name, n_name AS country, c_mktsegment AS segment,
        coalesce(order_count, 0) AS order_count, coalesce(monetary_value, 0.0) AS monetary_value,
        first_order_date, last_order_date, coalesce(avg_order_value, 0.0) AS avg_order_value,
        stddev_order_value, coalesce(recency_days, 999) AS recency_days,
        coalesce(purchase_velocity, 0.0) AS purchase_velocity, coalesce(r_score, 1) AS r_score,
        coalesce(f_score, 1) AS f_score, coalesce(m_score, 1) AS m_score,
        coalesce(rfm_composite, 1.0) AS rfm_composite, coalesce(rfm_cell, '1-1-1') AS rfm_cell,
        coalesce(rfm_segment, 'New') AS rfm_segment
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN rfm_labelled ON customer_id = c_custkey""",
    "rfm_full": f"""
      SELECT *, coalesce(rfm_composite >= 4.0, FALSE) AS is_high_value,
        {r('5.0::DOUBLE - rfm_composite + recency_days / 365.0::DOUBLE * 0.5::DOUBLE', 4)}
          AS churn_risk_score,
        {r('monetary_value * (rfm_composite / 5.0::DOUBLE) * 1.2::DOUBLE', 2)} AS ltv_estimate
      FROM rfm_known""",
    # segment revenue
    "segment_orders": """
      SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS segment_id,
        o_totalprice AS revenue_daily
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "daily": f"""
      SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS segment_id,
        {tot('o_totalprice')} AS revenue_daily, count(DISTINCT o_custkey) AS customer_count,
        {r(tot('o_totalprice') + ' / count(*)', 2)} AS avg_order_value,
        CAST(count(*) AS INTEGER) AS transaction_count
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "rolled": rolling("ROWS"),
    "rolled_calendar": rolling("RANGE"),
    "zscored": """
      SELECT *, CASE WHEN revenue_30d_std > 0 THEN (revenue_daily - revenue_30d_avg) / revenue_30d_std
        ELSE 0.0::DOUBLE END AS revenue_zscore FROM rolled""",
    "lagged": """
      SELECT *, lag(revenue_daily, 7) OVER (PARTITION BY segment_id ORDER BY date) AS revenue_lag_7d
      FROM daily""",
    "week": f"""
      SELECT *, {avg('revenue_daily', trailing(7))} AS revenue_7d_avg,
        {tot('revenue_daily', trailing(7))} AS revenue_7d_total FROM daily""",
    "spiked": """
      SELECT *, coalesce(revenue_daily > revenue_7d_avg * 2.5::DOUBLE, FALSE) AS is_spike,
        revenue_daily / nullif(revenue_7d_avg, 0) AS spike_ratio FROM week""",
    "segment_days": f"""
      SELECT segment_id, date, {tot('revenue_daily')} AS segment_revenue_total,
        {avg('revenue_daily')} AS segment_revenue_avg, max(revenue_daily) AS segment_revenue_peak,
        count(*) AS transaction_count
      FROM segment_orders GROUP BY segment_id, date""",
    "ratioed": """
      SELECT *, CASE WHEN revenue_7d_avg > 0 THEN revenue_daily / revenue_7d_avg ELSE 1.0::DOUBLE END
        AS spike_ratio FROM zscored""",
    "graded": """
      SELECT *, CASE WHEN abs(revenue_zscore) >= 3.5 THEN 'P1_CRITICAL'
        WHEN abs(revenue_zscore) >= 2.0 OR spike_ratio >= 2.5 THEN 'P2_WARNING' ELSE 'NORMAL' END
        AS anomaly_severity FROM ratioed""",
    "described": f"""
      SELECT *, CASE WHEN anomaly_severity <> 'NORMAL' THEN
        'Segment ' || segment_id || ' recorded revenue=' || CAST(revenue_daily AS VARCHAR)
        || ' vs 7d_avg=' || CAST({r('revenue_7d_avg', 2)} AS VARCHAR)
        || ' (z=' || CAST({r('revenue_zscore', 2)} AS VARCHAR) || ')' END AS anomaly_description
      FROM graded""",
    # anomaly detection
    "series": f"""
      SELECT date, {lookup(RFM_LABEL, 'segment_id')} AS segment, revenue_daily AS revenue_amount,
        transaction_count, avg_order_value AS avg_basket_size
      FROM daily WHERE date IS NOT NULL AND revenue_daily >= 0""",
    "windowed_base": f"""
      SELECT *, CAST(row_number() {SERIES} AS INTEGER) AS row_num,
        {r(avg('revenue_amount', W7), 4)} AS ma_7d,
        {r(f'stddev_samp(revenue_amount) {W7}', 4)} AS std_7d,
        min(revenue_amount) {W7} AS min_7d, max(revenue_amount) {W7} AS max_7d,
        {r(avg('revenue_amount', W30), 4)} AS ma_30d,
        {r(f'stddev_samp(revenue_amount) {W30}', 4)} AS std_30d,
        min(revenue_amount) {W30} AS min_30d, max(revenue_amount) {W30} AS max_30d,
        lag(revenue_amount) {SERIES} AS prev_day_revenue,
        {r(f'avg(transaction_count) {W7}', 2)} AS tx_count_7d_avg,
        {r(f'avg(avg_basket_size) {W7}', 4)} AS basket_7d_avg
      FROM series""",
    "windowed": f"""
      SELECT *, {r(pct_of_base('revenue_amount - prev_day_revenue', 'prev_day_revenue'), 4)}
        AS pct_change_1d FROM windowed_base""",
    "measured": f"""
      SELECT *, {r('CASE WHEN std_30d > 0 THEN (revenue_amount - ma_30d) / std_30d ELSE 0.0::DOUBLE END', 4)}
          AS zscore_30d,
        {r('ma_30d + 2.0::DOUBLE * std_30d', 4)} AS bollinger_upper,
        {r('ma_30d - 2.0::DOUBLE * std_30d', 4)} AS bollinger_lower
      FROM windowed""",
    "scored": """
      SELECT *, abs(zscore_30d) > 2.5 AS is_zscore_anomaly,
        (revenue_amount > bollinger_upper) OR (revenue_amount < bollinger_lower) AS is_bollinger_breach,
        (abs(zscore_30d) > 2.5) OR (revenue_amount > bollinger_upper) OR (revenue_amount < bollinger_lower)
          AS is_anomaly
      FROM measured""",
    "raw_severity": """
      SELECT *, least(
          least(abs(zscore_30d) / 2.5::DOUBLE * 4.0::DOUBLE, 6.0::DOUBLE)
          + CASE WHEN abs(pct_change_1d) - 20.0::DOUBLE > 0
              THEN least((abs(pct_change_1d) - 20.0::DOUBLE) / 10.0::DOUBLE, 2.0::DOUBLE)
              ELSE 0.0::DOUBLE END
          + CASE WHEN is_zscore_anomaly AND is_bollinger_breach THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END,
          10.0::DOUBLE) AS raw_score
      FROM scored""",
    "severe": f"""
      SELECT * EXCLUDE (raw_score), CASE WHEN zscore_30d IS NULL THEN 0.0::DOUBLE
        ELSE {half_even('raw_score', 4)} END AS severity_score
      FROM raw_severity""",
    "alerted": f"""
      SELECT *, CASE WHEN severity_score >= 8 THEN 'CRITICAL' WHEN severity_score >= 5 THEN 'HIGH'
          WHEN severity_score >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS severity_band,
        CASE WHEN zscore_30d > 0 THEN 'SPIKE' ELSE 'DIP' END AS anomaly_direction,
        {r('revenue_amount - ma_30d', 4)} AS revenue_deviation_abs,
        {r(pct_of_base('revenue_amount - ma_30d', 'ma_30d'), 4)} AS revenue_deviation_pct,
        revenue_amount AS reference_revenue_usd,
        TIMESTAMP '{AS_OF} 00:00:00' AS alert_generated_at
      FROM severe WHERE is_anomaly""",
    "metrics_of_segment": f"""
      SELECT rfm_segment AS segment, count(customer_id) AS segment_customer_count,
        {r(avg('monetary_value'), 2)} AS segment_avg_monetary,
        {r(avg('rfm_composite'), 3)} AS segment_avg_rfm,
        {r(avg('churn_risk_score'), 3)} AS segment_avg_churn_risk,
        {tot('monetary_value')} AS segment_total_monetary
      FROM rfm_full GROUP BY rfm_segment""",
    # MRR ledger
    "billing_typed": f"""
      SELECT o_orderkey AS event_id, o_custkey * 10 + o_orderkey % 2 AS subscription_id,
        o_custkey AS account_id,
        CASE WHEN o_orderkey % 17 = 0 THEN 'usage_report' WHEN o_orderkey % 13 = 0 THEN 'pause'
          WHEN o_orderkey % 11 = 0 THEN 'reactivation'
          ELSE {lookup(EVENT_OF_PRIORITY, 'o_orderpriority')} END AS event_type,
        CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS event_ts,
        CAST(floor(o_totalprice) AS BIGINT) AS list_cents,
        'plan_' || (o_orderkey % 3) AS plan_id,
        CASE o_custkey % 5 {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(INTERVALS))} END
          AS billing_interval,
        'N' || (o_custkey % 25) AS country_code,
        CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey % 20 = 0 END AS is_trial
      FROM orders""",
    "billing_priced": """
      SELECT * EXCLUDE (list_cents), event_ts AS created_at,
        CASE WHEN event_type = 'cancellation' THEN 0 ELSE list_cents END AS mrr_after_cents
      FROM billing_typed""",
    "day_ends": """
      SELECT subscription_id, CAST(event_ts AS DATE) AS day, mrr_after_cents AS day_end
      FROM billing_priced QUALIFY row_number() OVER (PARTITION BY subscription_id,
        CAST(event_ts AS DATE) ORDER BY event_ts DESC, event_id DESC) = 1""",
    "day_starts": """
      SELECT subscription_id, day, lag(day_end) OVER (PARTITION BY subscription_id ORDER BY day)
        AS day_start FROM day_ends""",
    "billing": """
      SELECT p.*, coalesce(day_start, 0) AS mrr_before_cents
      FROM billing_priced p JOIN day_starts d
        ON p.subscription_id = d.subscription_id AND CAST(p.event_ts AS DATE) = d.day""",
    "valid": """
      SELECT * FROM billing WHERE event_type IN ('new_subscription', 'upgrade', 'downgrade',
        'reactivation', 'cancellation', 'pause', 'plan_change')
        AND subscription_id IS NOT NULL AND event_ts IS NOT NULL AND NOT is_trial""",
    "day_first": """
      SELECT *, CAST(event_ts AS DATE) AS event_date FROM valid
      QUALIFY row_number() OVER (PARTITION BY subscription_id, CAST(event_ts AS DATE)
        ORDER BY created_at, event_id) = 1""",
    "deltas": f"""
      SELECT *, coalesce(mrr_before_cents, 0) AS mrr_before_safe,
        coalesce(mrr_after_cents, 0) AS mrr_after_safe,
        coalesce(mrr_after_cents, 0) - coalesce(mrr_before_cents, 0) AS mrr_delta_cents,
        {period('event_ts')} AS billing_period
      FROM day_first""",
    "net": """
      SELECT *, CAST(sum(mrr_delta_cents) OVER (PARTITION BY subscription_id, billing_period) AS BIGINT)
        AS net_new_mrr_cents
      FROM deltas
      QUALIFY row_number() OVER (PARTITION BY subscription_id, billing_period
        ORDER BY event_ts DESC, event_id DESC) = 1""",
    "net_usd": f"""
      SELECT *, {usd('net_new_mrr_cents')} AS net_new_mrr_dollars,
        {usd('mrr_after_safe')} AS closing_mrr_dollars FROM net""",
    "moves": """
      SELECT *, CASE WHEN event_type = 'new_subscription' THEN 'new_business'
        WHEN event_type = 'reactivation' THEN 'reactivated'
        WHEN event_type IN ('upgrade', 'plan_change') AND net_new_mrr_cents > 0 THEN 'expansion'
        WHEN event_type IN ('downgrade', 'plan_change') AND net_new_mrr_cents < 0 THEN 'contraction'
        WHEN event_type = 'cancellation' THEN 'churned' ELSE 'neutral' END AS movement_type
      FROM net_usd""",
    "metadata": """
      SELECT c_custkey AS account_id,
        CASE WHEN c_acctbal < 0 THEN 'basic' WHEN c_acctbal < 5000 THEN 'standard' ELSE 'premium' END
          AS account_tier,
        'csm_' || (c_custkey % 7) AS csm_owner, c_mktsegment AS industry_vertical,
        r_name AS geo_region,
        CASE WHEN c_custkey % 5 <> 0 THEN strftime(first_order, '%Y-%m-%d') END AS first_paid_date
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey)
        ON o_custkey = c_custkey""",
    "led": """
      SELECT m.* EXCLUDE (created_at, is_trial), account_tier, csm_owner, industry_vertical, geo_region,
        first_paid_date,
        coalesce(substr(first_paid_date, 1, 7),
          min(billing_period) OVER (PARTITION BY account_id)) AS cohort_month
      FROM moves m LEFT JOIN metadata USING (account_id)""",
    # cohorts
    "indexed": f"""
      SELECT *, {month_number('billing_period')} - {month_number('cohort_month')} AS cohort_index
      FROM led WHERE billing_period >= cohort_month""",
    "account_months": """
      SELECT account_id, cohort_month, geo_region, billing_period, cohort_index,
        CAST(sum(net_new_mrr_cents) AS BIGINT) AS net
      FROM indexed GROUP BY ALL""",
    "account_running": f"""
      SELECT *, CAST(sum(net) OVER w AS BIGINT) AS running,
        {month_number('billing_period')} AS m,
        coalesce(lead({month_number('billing_period')}) OVER w,
          (SELECT max({month_number('billing_period')}) FROM indexed) + 1) AS m_next
      FROM account_months
      WINDOW w AS (PARTITION BY account_id ORDER BY billing_period)""",
    "account_dense": f"""
      SELECT account_id, cohort_month, geo_region, {period_of_number('m + step')} AS billing_period,
        CAST(cohort_index + step AS INTEGER) AS cohort_index,
        CASE WHEN step = 0 THEN net ELSE 0 END AS net_new_mrr_cents,
        running AS cumulative_net_new_mrr_cents
      FROM (SELECT *, unnest(range(0, m_next - m)) AS step FROM account_running)""",
    "snapshots": f"""
      SELECT *, cumulative_net_new_mrr_cents * 12 AS closing_arr_cents,
        {usd('(cumulative_net_new_mrr_cents * 12)')} AS closing_arr_dollars,
        {usd('((cumulative_net_new_mrr_cents - net_new_mrr_cents) * 12)')} AS beginning_arr_dollars
      FROM account_dense
      WHERE cumulative_net_new_mrr_cents <> 0 OR cumulative_net_new_mrr_cents <> net_new_mrr_cents""",
    "labelled": f"""
      SELECT *, {r('closing_arr_dollars - beginning_arr_dollars', 2)} AS arr_delta_dollars,
        CASE WHEN beginning_arr_dollars = 0 THEN 'new_arr' WHEN closing_arr_dollars = 0 THEN 'churned_arr'
          WHEN closing_arr_dollars > beginning_arr_dollars THEN 'expansion_arr'
          WHEN closing_arr_dollars < beginning_arr_dollars THEN 'contraction_arr'
          ELSE 'retained_arr' END AS arr_movement_label
      FROM snapshots""",
    "matrix": f"""
      SELECT cohort_month, cohort_index, billing_period, geo_region, count(account_id) AS account_count,
        count(*) FILTER (arr_movement_label = 'churned_arr') AS churned_account_count,
        {moved('new_arr')} AS new_arr_dollars, {moved('expansion_arr')} AS expansion_arr_dollars,
        {moved('contraction_arr')} AS contraction_arr_dollars,
        {moved('churned_arr')} AS churn_arr_dollars,
        {moved('retained_arr', 'closing_arr_dollars')} AS retained_arr_dollars,
        {tot('closing_arr_dollars')} AS total_closing_arr_dollars,
        {tot('beginning_arr_dollars')} AS total_beginning_arr_dollars
      FROM labelled GROUP BY ALL""",
    # allocation
    "schedule": """
      SELECT o_custkey * 10 + o_orderkey % 2 AS subscription_id,
        CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 24 MONTH AS DATE) AS contract_end,
        CAST(max(floor(o_totalprice)) AS BIGINT) * 12 AS contract_arr_cents,
        CASE WHEN (o_custkey * 10 + o_orderkey % 2) % 3 = 0 THEN 'Y' ELSE 'N' END AS auto_renew
      FROM orders GROUP BY o_custkey, o_orderkey % 2""",
    "termed": """
      SELECT *, CAST(coalesce(CASE lower(billing_interval) WHEN 'monthly' THEN 1 WHEN 'quarterly' THEN 3
        WHEN 'annual' THEN 12 WHEN 'biennial' THEN 24 END, 1) AS INTEGER) AS contract_duration_months
      FROM led LEFT JOIN schedule USING (subscription_id)""",
    "shared": f"""
      SELECT *, CAST(CAST(CAST(closing_mrr_dollars * 100.0::DOUBLE / contract_duration_months AS VARCHAR)
          AS DECIMAL(38,0)) AS BIGINT) AS allocated_mrr_cents_per_month
      FROM termed""",
    "allocated": f"""
      SELECT *, {usd('allocated_mrr_cents_per_month')} AS allocated_mrr_dollars_per_month FROM shared""",
    "monthly": f"""
      SELECT *, {period_of_number(month_number('billing_period') + ' + step')} AS allocated_period
      FROM (SELECT *, unnest(range(0, contract_duration_months)) AS step FROM allocated)""",
    "balances": """
      SELECT *, CAST(step AS INTEGER) AS months_elapsed,
        allocated_mrr_dollars_per_month * (step + 1) AS recognised_revenue_dollars,
        allocated_mrr_dollars_per_month AS recognised_in_period_dollars,
        greatest(0.0::DOUBLE, closing_mrr_dollars * contract_duration_months
          - allocated_mrr_dollars_per_month * (step + 1)) AS deferred_revenue_balance_dollars
      FROM monthly""",
    "statuses": f"""
      SELECT *, CASE WHEN allocated_period > {period('contract_end')} THEN 'beyond_contract'
        WHEN allocated_period > '{AS_OF[:7]}' THEN 'future'
        WHEN allocated_period = '{AS_OF[:7]}' THEN 'current' ELSE 'recognised' END AS recognition_status
      FROM balances""",
    # retention
    "pit": f"""
      SELECT *, {ratio(NRR, 'total_beginning_arr_dollars', 6)} AS nrr_point_in_time,
        CASE WHEN total_beginning_arr_dollars > 0 THEN
          least(1.0::DOUBLE, {r(f'({GRR}) / total_beginning_arr_dollars', 6)}) END AS grr_point_in_time
      FROM matrix""",
    "yearly": f"""
      SELECT *, {tot('total_beginning_arr_dollars', YEAR)} AS rolling_12m_beginning_arr,
        {tot('expansion_arr_dollars', YEAR)} AS rolling_12m_expansion,
        {tot('contraction_arr_dollars', YEAR)} AS rolling_12m_contraction,
        {tot('churn_arr_dollars', YEAR)} AS rolling_12m_churn
      FROM pit""",
    "yearly_nrr": f"""
      SELECT *, CASE WHEN cohort_index >= 11 THEN {ratio(
        'rolling_12m_beginning_arr + rolling_12m_expansion + rolling_12m_contraction + rolling_12m_churn',
        'rolling_12m_beginning_arr', 6)} END AS nrr_rolling_12m
      FROM yearly""",
    "logos": f"""
      SELECT *, churned_account_count AS churned_accounts,
        CASE WHEN account_count > 0 THEN
          {r('1.0::DOUBLE - CAST(churned_account_count AS DOUBLE) / account_count', 4)} END
          AS logo_retention_rate
      FROM yearly_nrr""",
    "earned": f"""
      SELECT cohort_month, allocated_period AS billing_period,
        {tot('recognised_in_period_dollars')} AS total_recognised_revenue
      FROM statuses WHERE recognition_status IN ('recognised', 'current') GROUP BY 1, 2""",
    "bridged": "SELECT * FROM logos LEFT JOIN earned USING (cohort_month, billing_period)",
    "reported": "SELECT * FROM bridged WHERE account_count >= 3 AND total_beginning_arr_dollars > 0",
    # waterfall
    "changes": """
      SELECT billing_period, CAST(round_even(closing_mrr_dollars * 100, 0) AS BIGINT)
        - coalesce(lag(CAST(round_even(closing_mrr_dollars * 100, 0) AS BIGINT)) OVER (
            PARTITION BY subscription_id ORDER BY billing_period), 0) AS cents
      FROM led""",
    "levels": """
      SELECT billing_period, CAST(sum(sum(cents)) OVER (ORDER BY billing_period) AS DOUBLE)
        / 100::DOUBLE AS total_closing_mrr
      FROM changes GROUP BY billing_period""",
    "openings": """
      SELECT *, total_closing_mrr * 12 AS total_closing_arr,
        lag(total_closing_mrr * 12) OVER (ORDER BY billing_period) AS opening_arr
      FROM levels""",
    "component_mrr": "SELECT billing_period, "
    + ", ".join(f"{movement_arr(k)} AS {s}_mrr" for k, s in STEMS.items())
    + " FROM led GROUP BY billing_period",
    "component_arr": "SELECT *, "
    + ", ".join(f"coalesce({s}_mrr, 0.0) * 12 AS {s}_arr" for s in STEMS.values())
    + " FROM component_mrr",
    "blended": f"""
      SELECT billing_period, {ratio('w', 'total_beginning_arr', 4)} AS blended_nrr, avg_grr,
        avg_nrr_rolling_12m, total_beginning_arr
      FROM (SELECT billing_period, {tot('nrr_point_in_time * total_beginning_arr_dollars')} AS w,
          {tot('total_beginning_arr_dollars')} AS total_beginning_arr,
          {rate_avg('grr_point_in_time')} AS avg_grr,
          {rate_avg('nrr_rolling_12m')} AS avg_nrr_rolling_12m
        FROM reported GROUP BY billing_period)""",
    "built": """
      SELECT *, opening_arr + new_business_arr + expansion_arr + reactivation_arr + contraction_arr
          + churn_arr AS waterfall_closing_arr,
        lag(total_closing_arr) OVER (ORDER BY billing_period) AS prior_period_closing_arr
      FROM openings FULL JOIN component_arr USING (billing_period)""",
    "grown": f"""
      SELECT *, {ratio('total_closing_arr - prior_period_closing_arr', 'prior_period_closing_arr', 4)}
        AS arr_growth_rate FROM built""",
    "missed": """
      SELECT *, abs(waterfall_closing_arr - total_closing_arr) AS abs_delta,
        CASE WHEN total_closing_arr <> 0
          THEN abs(waterfall_closing_arr - total_closing_arr) / abs(total_closing_arr)
          WHEN abs(waterfall_closing_arr - total_closing_arr) > 0 THEN 1.0::DOUBLE
          ELSE 0.0::DOUBLE END AS pct_delta
      FROM built WHERE opening_arr IS NOT NULL""",
    # data quality
    "landed": """
      SELECT CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
        CASE WHEN event_id % 77 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS event_ts,
        CASE WHEN event_id % 91 = 0 THEN 'n/a' ELSE CAST(event_id % 1000 AS VARCHAR) END AS value,
        event_type
      FROM events""",
    "listed": f"""
      SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum({HASH}) AS BIGINT) AS h FROM events
      GROUP BY 1""",
    "there": f"""
      SELECT day, count(*) AS n, CAST(sum({HASH}) AS BIGINT) AS h
      FROM (SELECT * REPLACE (CASE WHEN dayofweek(ts) = 0 AND event_type = 'error' THEN 'fault' ELSE event_type END
            AS event_type),
          CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN DATE '2023-12-31' ELSE CAST(ts AS DATE) END AS day
        FROM events)
      GROUP BY 1""",
}


def statement(final: str) -> str:
    """``final`` with the CTEs it needs, directly or through others, in front."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in (words & CTES.keys()) - needed:
            needed.add(name)
            todo.append(CTES[name])
    head = ",\n".join(f"{n} AS ({sql})" for n, sql in CTES.items() if n in needed)
    return f"WITH {head}\n{final}" if head else final


def rr(n: int, *columns: str) -> str:
    return ", ".join(f"{r(c, n)} AS {c}" for c in columns)


CUSTOMER = "customer_id, order_count, monetary_value, recency_days"
STATS = "revenue_7d_avg", "revenue_7d_std", "revenue_30d_avg", "revenue_30d_std"
TERMS = "subscription_id, billing_period, billing_interval, closing_mrr_dollars"
KEYS = "cohort_month, billing_period, cohort_index, geo_region"
LEDGER = (
    "event_id, subscription_id, account_id, billing_period, event_date, event_type, movement_type,"
    " mrr_before_safe, mrr_after_safe, mrr_delta_cents, net_new_mrr_cents, net_new_mrr_dollars,"
    " closing_mrr_dollars, plan_id, billing_interval, country_code, account_tier, csm_owner,"
    " industry_vertical, geo_region, first_paid_date, cohort_month"
)
CALENDAR_STATS = f"SELECT date, segment_id, revenue_daily, {rr(4, *STATS)} FROM "

FINALS = {
    "rfm_raw": f"SELECT {CUSTOMER}, first_order_date, last_order_date, {rr(6, 'avg_order_value')},"
    f" {rr(4, 'stddev_order_value')} FROM rfm_totals",
    "rfm_velocity": "SELECT customer_id, order_count, first_order_date, last_order_date,"
    " purchase_velocity FROM rfm_speed",
    "rfm_quintiles": f"SELECT {CUSTOMER}, r_score, f_score, m_score FROM rfm_tiles",
    "rfm_segments": f"SELECT {CUSTOMER}, r_score, f_score, m_score, rfm_composite, rfm_cell,"
    " rfm_segment FROM rfm_labelled",
    "rfm_enriched": "SELECT * REPLACE ("
    f"{rr(6, 'avg_order_value')}, {rr(4, 'stddev_order_value')}) FROM rfm_full",
    "rfm_distribution": f"""
      SELECT rfm_segment, count(*) AS customer_count, {r(avg('monetary_value'), 2)} AS avg_monetary,
        {r(avg('rfm_composite'), 3)} AS avg_rfm_score, {r(avg('churn_risk_score'), 3)} AS avg_churn_risk
      FROM rfm_full GROUP BY rfm_segment""",
    "rfm_gate": """
      SELECT count(*) AS total_rows, count(*) FILTER (rfm_segment IS NULL) AS null_segment_rows,
        count(*) FILTER (ltv_estimate < 0) AS negative_ltv_rows FROM rfm_full""",
    "rolling_7_30": CALENDAR_STATS + "rolled",
    "rolling_calendar": CALENDAR_STATS + "rolled_calendar",
    "bollinger": f"""
      SELECT date, segment_id, {r('revenue_30d_avg + 2 * revenue_30d_std', 4)} AS revenue_bollinger_upper,
        {r('revenue_30d_avg - 2 * revenue_30d_std', 4)} AS revenue_bollinger_lower FROM rolled""",
    "revenue_zscore": f"SELECT date, segment_id, revenue_daily, {rr(6, 'revenue_zscore')} FROM zscored",
    "wow_change": f"""
      SELECT date, segment_id, revenue_daily, revenue_lag_7d, CASE WHEN revenue_lag_7d <> 0 THEN
        {r('(revenue_daily - revenue_lag_7d) / revenue_lag_7d * 100', 2)} END AS revenue_wow_pct_change
      FROM lagged""",
    "rolling_7_total": f"SELECT date, segment_id, {rr(6, 'revenue_7d_avg', 'revenue_7d_total')} FROM week",
    "revenue_spikes": f"SELECT date, segment_id, revenue_daily, is_spike, {rr(6, 'spike_ratio')} FROM spiked",
    "segment_totals": f"""
      SELECT segment_id, {r(tot('revenue_daily'), 6)} AS total_revenue,
        {r(avg('revenue_daily'), 6)} AS avg_daily_revenue, count(*) AS record_count,
        count(*) FILTER (is_spike) AS spike_count FROM spiked GROUP BY segment_id""",
    "segment_daily_join": f"""
      SELECT d.segment_id, date, {rr(6, 'segment_revenue_total', 'segment_revenue_avg',
        'segment_revenue_peak')}, transaction_count, segment_balance, segment_accounts
      FROM segment_days d LEFT JOIN (SELECT c_mktsegment AS segment_id,
        {r(tot('c_acctbal'), 6)} AS segment_balance, count(*) AS segment_accounts
        FROM customer GROUP BY 1) m ON d.segment_id = m.segment_id
      WHERE date >= DATE '{SINCE}'""",
    "revenue_rank": """
      SELECT segment_id, date, segment_revenue_total, CAST(dense_rank() OVER (PARTITION BY date
        ORDER BY segment_revenue_total DESC) AS INTEGER) AS revenue_rank FROM segment_days""",
    "contribution_pct": f"""
      SELECT segment_id, date, segment_revenue_total, {r('segment_revenue_total / nullif('
        + tot('segment_revenue_total', 'OVER (PARTITION BY date)') + ', 0) * 100', 2)}
        AS revenue_contribution_pct FROM segment_days""",
    "threshold_scores": f"SELECT date, segment_id, revenue_daily, {rr(6, 'spike_ratio')},"
    " anomaly_severity, anomaly_description FROM described",
    "anomalies_only": f"SELECT date, segment_id, {rr(6, 'revenue_daily', 'revenue_7d_avg',
        'revenue_30d_avg', 'revenue_zscore', 'spike_ratio')}, anomaly_severity, anomaly_description"
    " FROM described WHERE anomaly_severity <> 'NORMAL'",
    "anomaly_rate": f"""
      SELECT segment_id, count(*) AS total_days,
        count(*) FILTER (anomaly_severity <> 'NORMAL') AS anomaly_days,
        {r(avg('revenue_daily'), 4)} AS avg_revenue,
        {r('stddev_samp(revenue_daily)', 4)} AS stddev_revenue,
        {r("CAST(count(*) FILTER (anomaly_severity <> 'NORMAL') AS DOUBLE) / count(*) * 100", 2)}
          AS anomaly_rate_pct
      FROM graded GROUP BY segment_id""",
    "summary_stats": f"""
      SELECT {r(tot('revenue_daily'), 6)} AS total_revenue,
        {r(avg('revenue_daily'), 6)} AS avg_daily_revenue,
        max(revenue_daily) AS peak_daily_revenue, min(revenue_daily) AS min_daily_revenue,
        count(DISTINCT segment_id) AS active_segments,
        count(*) FILTER (anomaly_severity <> 'NORMAL') AS total_anomalies FROM graded""",
    "performance_report": f"""
      SELECT DATE '{AS_OF}' AS report_date, date, segment_id, {rr(6, 'revenue_daily', 'revenue_7d_avg',
        'revenue_30d_avg', 'revenue_zscore', 'spike_ratio')}, anomaly_severity, customer_count,
        avg_order_value FROM described WHERE date = DATE '{REPORT_DAY}'""",
    "segment_metrics": "SELECT * FROM metrics_of_segment",
    "anomaly_windows": "SELECT * FROM windowed",
    "anomaly_scored": "SELECT date, segment, revenue_amount, zscore_30d, bollinger_upper, bollinger_lower,"
    " is_zscore_anomaly, is_bollinger_breach, is_anomaly FROM scored",
    "anomaly_severity": "SELECT date, segment, zscore_30d, pct_change_1d, severity_score FROM severe",
    "anomaly_alerts": """
      SELECT date, a.segment, revenue_amount, transaction_count, avg_basket_size, ma_7d, std_7d, ma_30d,
        std_30d, zscore_30d, bollinger_upper, bollinger_lower, pct_change_1d, is_zscore_anomaly,
        is_bollinger_breach, is_anomaly, severity_score, severity_band, anomaly_direction,
        revenue_deviation_abs, revenue_deviation_pct, reference_revenue_usd, segment_customer_count,
        segment_avg_monetary, segment_avg_rfm, segment_total_monetary, alert_generated_at
      FROM alerted a LEFT JOIN metrics_of_segment m ON a.segment = m.segment""",
    "alert_summary": f"""
      SELECT severity_band, anomaly_direction, count(*) AS alert_count,
        {r(avg('severity_score'), 3)} AS avg_severity,
        {r(avg('revenue_deviation_pct'), 2)} AS avg_deviation_pct
      FROM alerted GROUP BY 1, 2""",
    "alert_volume_gate": f"""
      SELECT count(*) AS total_rows, count(*) FILTER (is_anomaly) AS anomaly_rows,
        {r('CAST(count(*) FILTER (is_anomaly) AS DOUBLE) / count(*)', 6)} AS anomaly_rate,
        CAST(count(*) FILTER (is_anomaly) AS DOUBLE) / count(*) > 0.4 AS exceeds_limit FROM scored""",
    "escalation_route": """
      SELECT count(*) AS anomaly_count, count(*) FILTER (severity_band = 'CRITICAL') AS critical_count,
        CASE WHEN count(*) FILTER (severity_band = 'CRITICAL') > 0 THEN 'CRITICAL_REVENUE_ANOMALY'
          WHEN count(*) > 5 THEN 'HIGH_VOLUME_ANOMALY' ELSE 'NONE' END AS alert_type FROM alerted""",
    "alert_payload": f"""
      SELECT segment_id, count(*) FILTER (anomaly_severity <> 'NORMAL') AS anomaly_count,
        CAST(to_json({{'pipeline': 'segment_revenue', 'report_date': '{AS_OF}',
          'segment_id': segment_id,
          'metrics': {{'revenue_daily': CAST({r(avg('revenue_daily'), 2)} AS DECIMAL(18,2)),
            'total_revenue': CAST({r(tot('revenue_daily'), 2)} AS DECIMAL(18,2)),
            'anomaly_count': count(*) FILTER (anomaly_severity <> 'NORMAL')}},
          'anomalies': coalesce(list({{'segment_id': segment_id, 'date': date,
            'revenue_actual': CAST({r('revenue_daily', 2)} AS DECIMAL(18,2)),
            'revenue_expected': CAST({r('revenue_7d_avg', 2)} AS DECIMAL(18,2)),
            'zscore': CAST({r('revenue_zscore', 2)} AS DECIMAL(18,2)),
            'severity': anomaly_severity, 'description': anomaly_description}} ORDER BY date)
            FILTER (anomaly_severity <> 'NORMAL'), []),
          'schema_version': 'v2'}}) AS VARCHAR) AS payload
      FROM described GROUP BY segment_id""",
    "valid_events": """
      SELECT event_id, subscription_id, account_id, event_type, event_ts, plan_id, billing_interval,
        country_code, created_at, is_trial, mrr_after_cents, mrr_before_cents FROM valid""",
    "intraday_dedup": """
      SELECT event_id, user_id AS subscription_id, ts AS event_ts, ts AS created_at, event_type,
        CAST(ts AS DATE) AS event_date FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
    "mrr_delta": "SELECT event_id, subscription_id, billing_period, mrr_before_safe, mrr_after_safe,"
    " mrr_delta_cents FROM deltas",
    "period_net_mrr": "SELECT subscription_id, billing_period, event_id, event_type, event_date,"
    " mrr_after_safe, net_new_mrr_cents, net_new_mrr_dollars, closing_mrr_dollars FROM net_usd",
    "movement_type": "SELECT subscription_id, billing_period, event_type, net_new_mrr_cents,"
    " movement_type FROM moves",
    "mrr_ledger": f"SELECT {LEDGER} FROM led",
    "cohort_key": "SELECT subscription_id, account_id, billing_period, first_paid_date, cohort_month"
    " FROM led",
    "cohort_index": "SELECT subscription_id, account_id, billing_period, cohort_month, cohort_index"
    " FROM indexed",
    "arr_snapshots": "SELECT * FROM snapshots",
    "arr_movement": f"SELECT account_id, {KEYS}, beginning_arr_dollars, closing_arr_dollars,"
    " arr_delta_dollars, arr_movement_label FROM labelled",
    "cohort_matrix": "SELECT * FROM matrix",
    "cohort_nrr": f"SELECT {KEYS}, {ratio(NRR, 'total_beginning_arr_dollars', 4)}"
    " AS net_revenue_retention_rate FROM matrix",
    "contract_duration": f"SELECT {TERMS}, contract_duration_months FROM termed",
    "monthly_allocation": f"SELECT {TERMS}, contract_duration_months, allocated_mrr_cents_per_month,"
    " allocated_mrr_dollars_per_month FROM allocated",
    "contract_expand": "SELECT subscription_id, billing_period, allocated_period,"
    " contract_duration_months FROM monthly",
    "deferred_balance": f"SELECT subscription_id, billing_period, allocated_period, months_elapsed,"
    f" {rr(4, 'recognised_revenue_dollars', 'recognised_in_period_dollars',
           'deferred_revenue_balance_dollars')} FROM balances",
    "recognition_status": "SELECT subscription_id, billing_period, allocated_period, contract_end,"
    " recognition_status FROM statuses",
    "allocation_recon": f"""
      SELECT subscription_id, billing_period, allocated_period, closing_mrr_dollars, sum_allocated_mrr,
        {r('sum_allocated_mrr - closing_mrr_dollars', 4)} AS allocation_rounding_diff
      FROM (SELECT *, CAST(sum(allocated_mrr_cents_per_month) OVER (PARTITION BY subscription_id,
        billing_period) AS DOUBLE) / 100::DOUBLE AS sum_allocated_mrr FROM monthly)""",
    "contract_join": "SELECT subscription_id, billing_period, contract_arr_cents, auto_renew,"
    " contract_end FROM termed",
    "nrr_grr": f"SELECT {KEYS}, nrr_point_in_time, grr_point_in_time FROM pit",
    "rolling_nrr": f"SELECT {KEYS}, rolling_12m_beginning_arr, rolling_12m_expansion,"
    " rolling_12m_contraction, rolling_12m_churn, nrr_rolling_12m FROM yearly_nrr",
    "logo_retention": f"SELECT {KEYS}, account_count, churned_accounts, logo_retention_rate FROM logos",
    "recognised_join": f"SELECT {KEYS}, total_closing_arr_dollars, total_recognised_revenue FROM bridged",
    "nrr_quality": f"SELECT {KEYS}, account_count, total_beginning_arr_dollars, nrr_point_in_time,"
    " grr_point_in_time, nrr_rolling_12m, logo_retention_rate, total_recognised_revenue FROM reported",
    "nrr_implausible": f"SELECT {KEYS}, nrr_point_in_time, total_beginning_arr_dollars,"
    " expansion_arr_dollars, contraction_arr_dollars, churn_arr_dollars FROM pit"
    " WHERE nrr_point_in_time > 3 OR nrr_point_in_time < 0",
    "opening_arr": "SELECT * FROM openings",
    "waterfall_components": "SELECT * FROM component_arr",
    "blended_nrr": f"SELECT billing_period, {rr(9, 'blended_nrr', 'avg_grr', 'avg_nrr_rolling_12m',
        'total_beginning_arr')} FROM blended",
    "arr_waterfall": f"""
      SELECT billing_period, {rr(4, 'opening_arr', 'total_closing_arr', 'waterfall_closing_arr',
        'new_business_arr', 'expansion_arr', 'reactivation_arr', 'contraction_arr', 'churn_arr',
        'neutral_arr', 'blended_nrr', 'arr_growth_rate', 'total_beginning_arr')},
        {rr(9, 'avg_grr', 'avg_nrr_rolling_12m')} FROM grown LEFT JOIN blended USING (billing_period)""",
    "waterfall_recon": f"""
      SELECT billing_period, {rr(6, 'opening_arr', 'waterfall_closing_arr', 'total_closing_arr',
        'abs_delta', 'pct_delta')} FROM missed WHERE pct_delta > 0.01
      ORDER BY missed.pct_delta DESC, billing_period""",
    "arr_growth": "SELECT billing_period, total_closing_arr, prior_period_closing_arr, arr_growth_rate"
    " FROM grown",
    "schema_conform": """
      SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(event_ts AS DATE) AS event_date,
        TRY_CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS source FROM landed""",
    "ingest_quality": """
      SELECT count(*) AS bronze, count(*) FILTER (id IS NOT NULL AND event_ts IS NOT NULL) AS silver,
        count(*) FILTER (id IS NULL OR event_ts IS NULL) AS bad FROM landed""",
    "quarantine": """
      SELECT id, event_ts, value, event_type, concat_ws(',',
        CASE WHEN id IS NULL THEN 'id_present' END,
        CASE WHEN event_ts IS NULL THEN 'event_ts_present' END,
        CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN 'value_readable' END) AS failed_rules
      FROM landed WHERE id IS NULL OR event_ts IS NULL OR TRY_CAST(value AS DOUBLE) IS NULL""",
    "quality_metrics": f"""
      SELECT '{RUN_ID}' AS run_id, 'quality' AS job, unnest(['total_rows', 'null_key_rows']) AS metric,
        unnest([CAST(count(*) AS DOUBLE), CAST(count(*) FILTER (id IS NULL) AS DOUBLE)]) AS value
      FROM landed""",
    "canary": f"""
      SELECT s.n AS source_row_count, s.h AS source_checksum, o.n AS output_row_count,
        o.h AS output_checksum, s.n = o.n AND s.h = o.h AS matches
      FROM (SELECT count(*) AS n, CAST(sum({HASH}) AS BIGINT) AS h FROM events) s,
        (SELECT count(*) AS n, CAST(sum({HASH}) AS BIGINT) AS h
          FROM (SELECT * REPLACE (CASE event_type WHEN 'error' THEN 'fault' ELSE event_type END AS event_type)
            FROM events)) o""",
    "manifest_check": """
      SELECT day, listed.n AS expected_rows, listed.h AS expected_checksum, there.n AS actual_rows,
        there.h AS actual_checksum, CASE WHEN there.n IS NULL THEN 'missing'
          WHEN listed.n IS NULL THEN 'unlisted' ELSE 'changed' END AS status
      FROM listed FULL JOIN there USING (day)
      WHERE there.n IS NULL OR listed.n IS NULL OR there.n <> listed.n OR there.h <> listed.h""",
    "skew_report": f"""
      SELECT event_type, count(*) AS row_count,
        {r('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events)', 6)} AS share,
        {r('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events)', 6)} > 0.2 AS is_skewed
      FROM events GROUP BY event_type """,
    "salted_aggregate": f"""
      SELECT l_returnflag, count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_count,
        {tot('l_extendedprice')} AS total_amount FROM lineitem GROUP BY l_returnflag""",
    "failure_signals": """
      SELECT *, '{"platform":"aws","job_id":"' || job_id || '","run_id":"' || run_id
          || '","timestamp":"' || timestamp || '","error_signature":"' || error_signature
          || '","log_excerpt":"' || replace(log_excerpt, '"', '\\"') || '","artifacts":' || artifacts
          || ',"code_paths":' || code_paths || ',"config":' || config || '}' AS payload
      FROM (SELECT 'aws' AS platform, 'job_' || (user_id % 10) AS job_id, 'run_' || event_id AS run_id,
          strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
          'signature_' || (event_id % 7) AS error_signature, props AS log_excerpt,
          CASE WHEN event_id % 2 = 0 THEN '["log_' || event_id || '"]' ELSE '[]' END AS artifacts,
          CASE WHEN event_id % 3 = 0 THEN '["main.py"]' ELSE '[]' END AS code_paths,
          CASE WHEN event_id % 5 = 0 THEN '{"retries":"' || (event_id % 4) || '"}' ELSE '{}' END AS config
        FROM events)""",
}

CTES |= {
    "renewals": f"""
      SELECT o_custkey * 10 + o_orderkey % 2 AS subscription_id,
        {period('min(o_orderdate)')} AS start_period,
        CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 8 MONTH AS DATE) AS contract_end,
        CAST(max(floor(o_totalprice)) AS BIGINT) * 12 AS contract_arr_cents,
        CASE WHEN year(o_orderdate) % 2 = 0 THEN 'Y' ELSE 'N' END AS auto_renew
      FROM orders GROUP BY o_custkey, o_orderkey % 2, year(o_orderdate)""",
    "placed": """
      SELECT *, row_number() OVER (PARTITION BY segment_id, anomaly_severity <> 'NORMAL' ORDER BY date) AS place,
        count(*) FILTER (anomaly_severity <> 'NORMAL') OVER (PARTITION BY segment_id) AS flags
      FROM described""",
    "chunk_metrics": f"""
      SELECT segment_id, {r(avg('revenue_daily'), 2)} AS mean_revenue, {r(tot('revenue_daily'), 2)} AS whole_revenue,
        count(*) FILTER (anomaly_severity <> 'NORMAL') AS n
      FROM described GROUP BY segment_id""",
    "chunked": f"""
      SELECT segment_id, (place - 1) // 5 + 1 AS chunk,
        list({{'segment_id': segment_id, 'date': date,
          'revenue_actual': CAST({r('revenue_daily', 2)} AS DECIMAL(18,2)),
          'revenue_expected': CAST({r('revenue_7d_avg', 2)} AS DECIMAL(18,2)),
          'zscore': CAST({r('revenue_zscore', 2)} AS DECIMAL(18,2)),
          'severity': anomaly_severity, 'description': anomaly_description}} ORDER BY place) AS entries
      FROM placed WHERE anomaly_severity <> 'NORMAL' GROUP BY 1, 2""",
    "chunks_of": """
      SELECT m.*, CAST(greatest(ceil(n / 5), 1) AS INTEGER) AS chunks, CAST(coalesce(chunk, 1) AS INTEGER) AS chunk,
        coalesce(entries, []) AS entries
      FROM chunk_metrics m LEFT JOIN chunked c ON m.segment_id = c.segment_id""",
}
DIMENSIONS = "industry_vertical, geo_region, account_tier"


def changed(sql: str, *pairs: tuple[str, str]) -> str:
    """``sql`` with parts replaced, each of which must be there."""
    for old, new in pairs:
        if old not in sql:
            raise ValueError(f"not in the statement: {old}")
        sql = sql.replace(old, new)
    return sql


FINALS |= {
    "ledger_without_metadata": f"""
      SELECT {LEDGER} FROM (SELECT m.* EXCLUDE (created_at, is_trial), CAST(NULL AS VARCHAR) AS account_tier,
        CAST(NULL AS VARCHAR) AS csm_owner, CAST(NULL AS VARCHAR) AS industry_vertical,
        CAST(NULL AS VARCHAR) AS geo_region, CAST(NULL AS VARCHAR) AS first_paid_date,
        min(billing_period) OVER (PARTITION BY account_id) AS cohort_month FROM moves m)""",
    "recognised_by_slice": f"""
      SELECT l.cohort_month, l.billing_period, l.cohort_index, l.geo_region, l.total_closing_arr_dollars,
        e.total_recognised_revenue
      FROM logos l LEFT JOIN (
        SELECT cohort_month, allocated_period, geo_region,
          {tot('recognised_in_period_dollars')} AS total_recognised_revenue
        FROM statuses WHERE recognition_status IN ('recognised', 'current') GROUP BY 1, 2, 3) e
      ON l.cohort_month = e.cohort_month AND l.billing_period = e.allocated_period
        AND l.geo_region IS NOT DISTINCT FROM e.geo_region""",
    "worst_mismatches": FINALS["waterfall_recon"] + " LIMIT 10",
    "implausible_sample": f"SELECT {KEYS}, nrr_point_in_time, total_beginning_arr_dollars FROM pit"
    " WHERE nrr_point_in_time > 3 OR nrr_point_in_time < 0"
    " ORDER BY nrr_point_in_time DESC, cohort_month, billing_period, geo_region LIMIT 20",
    "contract_in_force": f"""
      SELECT m.subscription_id, billing_period, allocated_period, r.contract_arr_cents, r.auto_renew, r.contract_end,
        CASE WHEN allocated_period > {period('r.contract_end')} THEN 'beyond_contract'
          WHEN allocated_period > '{AS_OF[:7]}' THEN 'future'
          WHEN allocated_period = '{AS_OF[:7]}' THEN 'current' ELSE 'recognised' END AS recognition_status
      FROM (SELECT subscription_id, billing_period, allocated_period FROM monthly) m
      ASOF LEFT JOIN renewals r ON m.subscription_id = r.subscription_id AND m.allocated_period >= r.start_period""",
    "payload_chunks": f"""
      SELECT segment_id, chunk, chunks, n AS anomaly_count, CAST(to_json({{'pipeline': 'segment_revenue',
          'report_date': '{AS_OF}', 'segment_id': segment_id,
          'metrics': {{'revenue_daily': CAST(mean_revenue AS DECIMAL(18,2)),
            'total_revenue': CAST(whole_revenue AS DECIMAL(18,2)), 'anomaly_count': n}},
          'chunk': chunk, 'chunks': chunks, 'anomalies': entries, 'schema_version': 'v2'}}) AS VARCHAR) AS payload
      FROM chunks_of""",
    "segment_report": f"""
      SELECT d.segment_id, d.date, {rr(6, 'segment_revenue_total', 'segment_revenue_avg', 'segment_revenue_peak')},
        d.transaction_count, segment_balance, segment_accounts, revenue_rank, revenue_contribution_pct,
        g.anomaly_severity, a.anomaly_days, a.anomaly_rate_pct
      FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY date ORDER BY segment_revenue_total DESC) AS INTEGER)
          AS revenue_rank, {r('segment_revenue_total / nullif('
            + tot('segment_revenue_total', 'OVER (PARTITION BY date)') + ', 0) * 100', 2)}
          AS revenue_contribution_pct FROM segment_days) d
      LEFT JOIN (SELECT c_mktsegment AS segment_id, {r(tot('c_acctbal'), 6)} AS segment_balance,
        count(*) AS segment_accounts FROM customer GROUP BY 1) m ON d.segment_id = m.segment_id
      LEFT JOIN described g ON d.segment_id = g.segment_id AND d.date = g.date
      LEFT JOIN (SELECT segment_id, count(*) FILTER (anomaly_severity <> 'NORMAL') AS anomaly_days,
        {r("CAST(count(*) FILTER (anomaly_severity <> 'NORMAL') AS DOUBLE) / count(*) * 100", 2)}
          AS anomaly_rate_pct FROM described GROUP BY 1) a ON d.segment_id = a.segment_id""",
    "heavy_hitters": f"""
      SELECT l_suppkey, count(*) AS row_count,
        {r('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem)', 6)} AS share
      FROM lineitem GROUP BY l_suppkey
      HAVING count(*) >= 0.0102::DOUBLE * (SELECT count(*) FROM lineitem)""",
    "skew_join": f"""
      SELECT s_nationkey, count(*) AS row_count, {tot('l_extendedprice')} AS amount
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""",
    "salted_repartition": """
      SELECT l_returnflag, CAST(count(*) AS BIGINT) AS row_count, TRUE AS is_balanced
      FROM lineitem GROUP BY l_returnflag""",
    "schema_merge": f"""
      SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
        CASE WHEN o_orderkey % 3 <> 1 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
        CAST(o_orderdate AS DATE) AS order_date, {lookup(STATUS, 'o_orderstatus')} AS status,
        o_totalprice AS total_amount FROM orders""",
    "source_customers": """
      SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS first_name, n_name AS country,
        c_mktsegment AS segment, DATE '2021-03-15' AS signup_date
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "source_revenue": "SELECT date, segment, revenue_amount, transaction_count, avg_basket_size FROM series",
    "stored_segments": f"SELECT * EXCLUDE (segment) FROM ({FINALS['rfm_enriched']})",
    "stored_alerts": FINALS["anomaly_alerts"],
    "stored_totals": FINALS["segment_totals"],
    "stored_report": FINALS["performance_report"],
    "stored_ledger": FINALS["mrr_ledger"],
    "stored_matrix": FINALS["cohort_matrix"],
    "stored_allocation": "SELECT subscription_id, billing_period, allocated_period,"
    " allocated_mrr_cents_per_month, recognition_status, contract_arr_cents, auto_renew FROM statuses",
    "stored_metrics": FINALS["nrr_quality"],
    "stored_waterfall": FINALS["arr_waterfall"],
    "ledger_batches": FINALS["mrr_ledger"],
    "run_history": f"""
      SELECT run_id, job, metric, value, previous, change, coalesce(abs(change) > 0.1, FALSE) AS breach
      FROM (SELECT *, CASE WHEN previous <> 0 THEN {r('(value - previous) / abs(previous)', 6)} END AS change
        FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY run_id) AS previous
          FROM (SELECT strftime(ts, '%Y-%m-%d') AS run_id, 'load' AS job, event_type AS metric,
            CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY ALL)))""",
}

ORACLE = {name: statement(final.strip()) for name, final in FINALS.items()}
ORACLE |= {
    "ledger_keep_last": changed(
        ORACLE["mrr_ledger"], ("ORDER BY created_at, event_id) = 1", "ORDER BY created_at DESC, event_id DESC) = 1")
    ),
    "cohort_matrix_dimensions": changed(
        ORACLE["cohort_matrix"],
        ("cohort_month, geo_region,", f"cohort_month, {DIMENSIONS},"),
        ("billing_period, geo_region, count(", f"billing_period, {DIMENSIONS}, count("),
    ),
    "deferred_upfront": changed(
        ORACLE["deferred_balance"],
        ("greatest(0.0::DOUBLE, closing_mrr_dollars * contract_duration_months", "greatest(0.0::DOUBLE, closing_mrr_dollars"),
    ),
    "logo_as_written": changed(
        ORACLE["logo_retention"],
        ("churned_account_count AS churned_accounts", "CASE WHEN churn_arr_dollars < 0 THEN account_count ELSE 0 END AS churned_accounts"),
        ("CAST(churned_account_count AS DOUBLE)", "CAST(CASE WHEN churn_arr_dollars < 0 THEN account_count ELSE 0 END AS DOUBLE)"),
    ),
}
