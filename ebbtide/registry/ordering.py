"""Windows, ranks and the bounded running sum."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.functions.risk import risk_level
from ebbtide.operators import fold, ordered, value
from ebbtide.operators.clean import keep_last
from ebbtide.registry.base import money, query


@query(
    "i01_ntile",
    """SELECT customerID, CAST(NTILE(5) OVER (ORDER BY MonthlyCharges DESC, customerID) AS INTEGER) AS quintile,
              CAST(NTILE(7) OVER (ORDER BY MonthlyCharges DESC, customerID) AS INTEGER) AS seventh FROM raw""",
)
def _(x):
    order = [F.desc("MonthlyCharges"), F.asc("customerID")]
    ranked = ordered.with_rank(x.raw.select("customerID", "MonthlyCharges"), order, "_rank", total="_rows")
    return ranked.select(
        "customerID",
        ordered.tile_of(F.col("_rank"), F.col("_rows"), 5).alias("quintile"),
        ordered.tile_of(F.col("_rank"), F.col("_rows"), 7).alias("seventh"),
    )


@query(
    "i02_share_of_total",
    f"""SELECT Contract, COUNT(*) AS n, {money('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()')} AS share_pct
        FROM raw GROUP BY Contract""",
)
def _(x):
    counts = x.raw.groupBy("Contract").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.round((F.col("n") * 100.0 / total).cast("decimal(38,6)"), 2).cast("double"))


@query(
    "i03_global_rank",
    """SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank FROM orders""",
)
def _(x):
    slim = x.table("orders").select("o_orderkey", "o_totalprice")
    return ordered.with_rank(slim, [F.desc("o_totalprice"), F.asc("o_orderkey")], "price_rank").drop("o_totalprice")


@query(
    "i04_keep_last",
    """SELECT customer_id, event_id, event_type FROM ev
       QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY event_id DESC) = 1""",
)
def _(x):
    return keep_last(x.events.select("customer_id", "event_id", "event_type"), "customer_id", "event_id")


_DELTAS = """, deltas(event_type, delta) AS (VALUES ('payment_failed', 0.15), ('complaint', 0.12), ('support_ticket', 0.05),
  ('cancellation_attempt', 0.30), ('inactivity', 0.08), ('plan_downgrade', 0.06), ('login', -0.03), ('purchase', -0.05),
  ('plan_upgrade', -0.10)),
steps AS (
  SELECT ev.*, v.estimated_clv, CAST(v.churn_probability AS DECIMAL(18,6)) AS p0,
         LIST(CAST(COALESCE(delta, 0) AS DECIMAL(18,6))) OVER (PARTITION BY customer_id ORDER BY timestamp, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM ev JOIN valued v ON v.customerID = ev.customer_id LEFT JOIN deltas USING (event_type)),
path AS (
  SELECT *, LIST_REDUCE(upto, lambda a, d: LEAST(CAST(1 AS DECIMAL(18,6)), GREATEST(CAST(0 AS DECIMAL(18,6)), CAST(a + d AS DECIMAL(18,6)))), p0) AS p_after
  FROM steps),
risk_path AS (
  SELECT *, LAG(p_after, 1, p0) OVER (PARTITION BY customer_id ORDER BY timestamp, event_id) AS p_before FROM path)
"""


@query(
    "i05_current_risk",
    _DELTAS
    + """, latest AS (SELECT customer_id, COUNT(*) AS n, MAX_BY(p_after, event_id) AS p FROM path GROUP BY customer_id)
      SELECT customerID AS customer_id, COALESCE(n, 0) AS n_events,
             CAST(ROUND(COALESCE(p, CAST(churn_probability AS DECIMAL(18,6))), 4) AS DOUBLE) AS current_probability
      FROM valued LEFT JOIN latest ON customer_id = customerID""",
)
def _(x):
    start = x.valued.select(F.col("customerID").alias("customer_id"), "churn_probability")
    return fold.final_risk(x.events, start).select(
        "customer_id", "n_events", F.round("current_probability", 4).cast("double").alias("current_probability")
    )


@query(
    "i06_risk_path",
    _DELTAS
    + """SELECT event_id, customer_id, event_type, CAST(ROUND(p_before, 4) AS DOUBLE) AS previous_probability,
             CAST(ROUND(p_after, 4) AS DOUBLE) AS new_probability,
             CAST(ROUND(p_after - p_before, 4) AS DOUBLE) AS risk_change,
             CASE WHEN p_after < 0.5 THEN 'LOW' WHEN p_after < 0.7 THEN 'MEDIUM' WHEN p_after < 0.85 THEN 'HIGH' ELSE 'CRITICAL' END AS new_risk_level
      FROM risk_path""",
)
def _(x):
    start = x.valued.select(F.col("customerID").alias("customer_id"), "churn_probability")
    path = fold.risk_path(x.events, start)
    before, after = F.col("previous_probability"), F.col("new_probability")
    return path.select(
        "event_id", "customer_id", "event_type",
        F.round(before, 4).cast("double").alias("previous_probability"),
        F.round(after, 4).cast("double").alias("new_probability"),
        F.round(after - before, 4).cast("double").alias("risk_change"),
        risk_level(after.cast("double")).alias("new_risk_level"),
    )


@query(
    "j04_largest_increases",
    _DELTAS
    + """SELECT event_id, customer_id, event_type, CAST(ROUND(p_after - p_before, 4) AS DOUBLE) AS risk_change
      FROM risk_path ORDER BY risk_change DESC, event_id LIMIT 3""",
)
def _(x):
    start = x.valued.select(F.col("customerID").alias("customer_id"), "churn_probability")
    moved = fold.risk_path(x.events, start).select(
        "event_id", "customer_id", "event_type",
        F.round(F.col("new_probability") - F.col("previous_probability"), 4).cast("double").alias("risk_change"),
    )
    return value.top_rows(moved, [F.desc("risk_change"), F.asc("event_id")], 3)


@query(
    "m04_unknown_customers",
    """SELECT event_id, customer_id, event_type FROM ev
       WHERE customer_id NOT IN (SELECT customerID FROM valued WHERE risk_level <> 'LOW')""",
)
def _(x):
    """Only customers above LOW are scored here, so that rejects exist."""
    scored = x.valued.filter("risk_level <> 'LOW'").select(F.col("customerID").alias("customer_id"))
    return fold.unknown_customer_events(x.events, scored).select("event_id", "customer_id", "event_type")
