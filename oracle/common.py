"""Common table expressions shared by the check statements."""

TICKETS = """tickets AS (SELECT
  o_orderkey AS ticket_id,
  o_orderdate AS created_at,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR * CAST(1 + o_orderkey % 72 AS INT) END AS resolved_at,
  CASE o_orderstatus WHEN 'F' THEN 'solved' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
  CASE o_orderkey % 4 WHEN 0 THEN 'email' WHEN 1 THEN 'chat' WHEN 2 THEN 'phone' ELSE 'webform' END AS channel,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'normal' ELSE 'low' END AS priority,
  lower(c_mktsegment) AS contact_driver,
  CAST(1 + o_orderkey % 60 AS DOUBLE) AS first_response_time_minutes,
  5.0E0 + o_totalprice / 5000.0E0 AS total_handle_time_minutes,
  CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS reopens_count,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(1 + (o_orderkey * 7 + o_custkey) % 5 AS INT) END AS csat_score,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('M', o_orderkey % 97, ',M', o_orderkey % 89) END AS macro_sequence,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('M', o_orderkey % 89) END AS final_macro_id,
  o_custkey % 50 AS agent_id
FROM orders JOIN customer ON o_custkey = c_custkey)"""

MACROS = """macros AS (SELECT
  p_partkey AS macro_id,
  p_name AS macro_name,
  lower(p_type) AS category,
  concat(p_name, ' ', p_type, ' ', p_brand, ' size ', p_size) AS macro_body,
  p_size > 5 AS is_active,
  p_size % 7 = 0 AS is_internal_only,
  lower(p_brand) AS owner_team,
  DATE '1995-01-01' + CAST(p_partkey % 300 AS INT) AS created_at,
  DATE '1996-01-01' + CAST(p_partkey % 60 AS INT) AS updated_at
FROM part)"""

USAGE = """macro_usage AS (SELECT
  l_orderkey AS ticket_id,
  CASE WHEN l_partkey % 20 = 0 THEN abs(l_partkey - 1) WHEN l_partkey % 20 = 1 AND l_orderkey % 10 <> 0 THEN l_partkey + 1 ELSE l_partkey END AS macro_id,
  l_shipdate AS applied_at,
  l_linenumber AS position_in_thread,
  o_custkey % 50 AS agent_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FACT_TICKETS = """fact_tickets AS (SELECT ticket_id, created_at, resolved_at, csat_score,
  total_handle_time_minutes * 60.0E0 AS handle_time_seconds, contact_driver, priority, channel,
  agent_id, reopens_count > 0 AS was_reopened
FROM tickets)"""

REPLY_TEXTS = """reply_texts AS (SELECT doc_id AS macro_id, p_name AS macro_name,
  lower(p_type) AS category, text AS macro_body, source
FROM documents LEFT JOIN part ON doc_id = p_partkey)"""

USED = """used AS (SELECT ticket_id, count(macro_id) AS num_macros_used,
  count(DISTINCT macro_id) AS macro_count_unique FROM macro_usage GROUP BY ticket_id)"""

TICKET_FEATURES = """ticket_features AS (SELECT t.*, coalesce(u.num_macros_used, 0) AS num_macros_used,
  coalesce(u.macro_count_unique, 0) AS macro_count_unique,
  coalesce(u.num_macros_used, 0) > 0 AS is_macro_used
FROM tickets t LEFT JOIN used u USING (ticket_id))"""

MACRO_FEATURES = """macro_agg AS (SELECT u.macro_id, count(*) AS usage_count, avg(t.csat_score) AS avg_csat,
  quantile_cont(CAST(t.csat_score AS DOUBLE), 0.5) AS median_csat,
  avg(t.total_handle_time_minutes) AS avg_handle_time,
  quantile_cont(t.total_handle_time_minutes, 0.5) AS median_handle_time,
  avg(CASE WHEN t.reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate,
  count(DISTINCT t.agent_id) AS unique_agents, count(DISTINCT t.contact_driver) AS unique_drivers
 FROM macro_usage u LEFT JOIN tickets t ON u.ticket_id = t.ticket_id GROUP BY u.macro_id),
macro_features AS (SELECT m.*, coalesce(a.usage_count, 0) AS usage_count,
  coalesce(a.avg_csat, 0) AS avg_csat, coalesce(a.median_csat, 0) AS median_csat,
  coalesce(a.avg_handle_time, 0) AS avg_handle_time,
  coalesce(a.median_handle_time, 0) AS median_handle_time,
  coalesce(a.reopen_rate, 0) AS reopen_rate, coalesce(a.unique_agents, 0) AS unique_agents,
  coalesce(a.unique_drivers, 0) AS unique_drivers
 FROM macros m LEFT JOIN macro_agg a ON m.macro_id = a.macro_id)"""

SCORES = """overall AS (SELECT avg(csat_score) AS b_csat, avg(total_handle_time_minutes) AS b_time,
  avg(CASE WHEN reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS b_reopen FROM tickets),
lim AS (SELECT min(avg_csat) AS c0, max(avg_csat) AS c1, min(avg_handle_time) AS h0,
  max(avg_handle_time) AS h1, min(reopen_rate) AS r0, max(reopen_rate) AS r1 FROM macro_features),
parts AS (SELECT f.*, f.usage_count >= 5 AS has_sufficient_usage, f.avg_csat - b_csat AS csat_lift,
  b_time - f.avg_handle_time AS handle_time_delta, b_reopen - f.reopen_rate AS reopen_rate_delta,
  CASE WHEN f.usage_count < 5 OR c0 = c1 THEN 50.0E0
    ELSE 100.0E0 * greatest(0.0E0, least(1.0E0, (avg_csat - c0) / (c1 - c0))) END AS csat_component,
  CASE WHEN f.usage_count < 5 OR h0 = h1 THEN 50.0E0
    ELSE 100.0E0 * (1.0E0 - greatest(0.0E0, least(1.0E0, (avg_handle_time - h0) / (h1 - h0)))) END
    AS handle_time_component,
  CASE WHEN f.usage_count < 5 OR r0 = r1 THEN 50.0E0
    ELSE 100.0E0 * (1.0E0 - greatest(0.0E0, least(1.0E0, (reopen_rate - r0) / (r1 - r0)))) END
    AS reopen_component
 FROM macro_features f, overall, lim),
indexed AS (SELECT *, CASE WHEN NOT has_sufficient_usage THEN 0.0E0 ELSE
  floor((0.4E0 * csat_component + 0.3E0 * handle_time_component + 0.3E0 * reopen_component)
   * 1.0E9 + 0.5E0) / 1.0E9 END AS macro_effectiveness_index FROM parts),
scores AS (SELECT *, 100.0E0 * (rank() OVER (ORDER BY macro_effectiveness_index)
   + (count(*) OVER (PARTITION BY macro_effectiveness_index) - 1) / 2.0E0) / count(*) OVER ()
   AS effectiveness_percentile,
  CASE WHEN macro_effectiveness_index BETWEEN 0 AND 33 THEN 'Low'
    WHEN macro_effectiveness_index <= 66 THEN 'Medium'
    WHEN macro_effectiveness_index <= 100 THEN 'High' END AS effectiveness_level
 FROM indexed),
categorized AS (SELECT *, CASE WHEN NOT has_sufficient_usage THEN 'Unused/Low Usage'
  WHEN effectiveness_percentile >= 75 THEN CASE WHEN usage_count >=
     (SELECT quantile_cont(CAST(usage_count AS DOUBLE), 0.75) FROM scores)
     THEN 'High Impact (Popular)' ELSE 'Underused Gem' END
  WHEN effectiveness_percentile >= 50 THEN 'Moderate Effectiveness'
  WHEN effectiveness_percentile >= 25 THEN 'Below Average'
  ELSE 'Low Effectiveness' END AS macro_category FROM scores)"""

BASE = [TICKETS, MACROS, USAGE, FACT_TICKETS, USED, TICKET_FEATURES]
SCORED = BASE + [MACRO_FEATURES, SCORES]
TEXTS = [REPLY_TEXTS]


def r(expression: str, places: int = 6) -> str:
    """Rounding by scaled floor; at six places the border is a little off the half."""
    half = "0.500137E0" if places == 6 else "0.5E0"
    return f"floor(({expression}) * 1.0E{places} + {half}) / 1.0E{places}"


def statement(body: str, parts: list[str] = BASE, extra: list[str] | None = None) -> str:
    return "WITH " + ",\n".join([*parts, *(extra or [])]) + "\n" + body
