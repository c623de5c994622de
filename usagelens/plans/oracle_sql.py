"""DuckDB SQL building blocks: the activity adapters and fact columns, written
once so every oracle query shapes the supplied tables exactly as Spark does."""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_F = f"({_K} % 20)"

ACT_EVENTS = f"""
SELECT CAST(user_id AS VARCHAR) AS user_id,
       ts AS "timestamp",
       CASE WHEN {_F} < 18 THEN 'category_' || CAST({_F} % 7 AS VARCHAR) ELSE 'Unknown' END AS category_used,
       'feature_' || lpad(CAST({_F} AS VARCHAR), 2, '0') AS feature_used,
       CAST(least(greatest(CAST(round(value * 40) AS BIGINT), 5), 3600) AS BIGINT) AS session_length,
       event_type AS platform
FROM events
"""

ACT_ORDERS = """
SELECT CAST(o_custkey AS VARCHAR) AS user_id,
       o_orderdate AS "timestamp",
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'expedited' ELSE 'standard' END AS category_used,
       o_orderpriority AS feature_used,
       CAST(floor(o_totalprice / 100) AS BIGINT) AS session_length,
       o_orderstatus AS platform
FROM orders
"""

ACT = {"events": ACT_EVENTS, "orders": ACT_ORDERS}
PLATFORMS = {"events": ["click", "error", "purchase", "signup", "view"], "orders": ["F", "O", "P"]}


def facts_cte(source: str, name: str = "facts") -> str:
    """``act`` (activity rows) and ``facts`` (+ date, ISO week, calendar year) CTEs."""
    return f"""act AS ({ACT[source]}),
{name} AS (
  SELECT *, CAST("timestamp" AS DATE) AS "date",
         CAST(week("timestamp") AS INTEGER) AS week,
         CAST(year("timestamp") AS INTEGER) AS "year"
  FROM act)"""


def platform_aggs(source: str) -> str:
    return ",\n  ".join(
        f"CAST(count_if(platform = '{p}') AS BIGINT) AS platform_{p}_count" for p in PLATFORMS[source]
    )


def user_features_select(source: str, extra: str = "") -> str:
    """Aggregate list of the per-user feature table (grouped by user_id)."""
    return f"""user_id,
  CAST(coalesce(sum(session_length), 0) AS BIGINT) AS total_session_length_minutes,
  coalesce(avg(session_length), 0.0) AS average_session_length_minutes,
  count(DISTINCT "date") AS login_frequency,
  count(DISTINCT feature_used) AS unique_features_used,
  count(DISTINCT category_used) AS unique_categories_used,
  count(*) AS total_events,
  {platform_aggs(source)}{extra}"""


def churn_users_cte(source: str, threshold: int, name: str = "users", facts: str = "facts") -> str:
    return f"""{name} AS (
  SELECT u.*, CAST(date_diff('day', u.last_login_date, s.snap) AS INTEGER) AS days_since_last_login,
         CAST(date_diff('day', u.last_login_date, s.snap) > {threshold} AS INTEGER) AS churn_status
  FROM (SELECT {user_features_select(source, ', max("date") AS last_login_date')}
        FROM {facts} WHERE user_id IS NOT NULL GROUP BY user_id) u,
       (SELECT max("date") AS snap FROM {facts}) s)"""
