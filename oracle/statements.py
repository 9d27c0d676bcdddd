"""One check statement per registered query that SQL can express."""

from oracle.common import BASE, MACROS, SCORED, TICKETS, USAGE, r, statement
from replyscope.plans.spoiled import SPOILED

STATEMENTS: dict[str, str] = {}


def rr(names: str, places: int = 6) -> str:
    """Rounded columns under their own names."""
    return ", ".join(f"{r(n, places)} AS {n}" for n in names.split())


def text(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


RATES = """avg(csat_score) AS avg_csat, avg(total_handle_time_minutes) AS avg_handle_time,
 avg(CASE WHEN reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate"""

SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{SPACE}+|{SPACE}+$', '', 'g')"


# --- cleaning and checks -----------------------------------------------------------

RAW_TICKETS = """raw_tickets AS (SELECT * EXCLUDE (ticket_id, csat_score, total_handle_time_minutes, status),
 CASE WHEN ticket_id % 101 = 0 THEN 9 ELSE csat_score END AS csat_score,
 CASE WHEN ticket_id % 103 = 0 THEN -1.0E0 ELSE total_handle_time_minutes END AS total_handle_time_minutes,
 CASE WHEN ticket_id % 107 = 0 THEN 'lost' ELSE upper(status) END AS status,
 CASE WHEN ticket_id % 109 = 0 THEN ticket_id + 1 ELSE ticket_id END AS ticket_id FROM tickets)"""
RAW_MACROS = """raw_macros AS (SELECT * EXCLUDE (macro_id, macro_body, category),
 CASE WHEN macro_id % 41 = 0 THEN '' WHEN macro_id % 43 = 0 THEN NULL
   ELSE concat('  ', macro_body, chr(9)) END AS macro_body, upper(category) AS category,
 CASE WHEN macro_id % 47 = 0 THEN macro_id + 1 ELSE macro_id END AS macro_id FROM macros)"""
RAW_USAGE = """raw_usage AS (SELECT applied_at,
 CASE WHEN (ticket_id + macro_id) % 53 = 0 THEN 0 ELSE position_in_thread END AS position_in_thread,
 CASE WHEN (ticket_id + position_in_thread) % 59 = 0 THEN -macro_id ELSE macro_id END AS macro_id,
 CASE WHEN (macro_id + position_in_thread) % 61 = 0 THEN -1 - ticket_id ELSE ticket_id END AS ticket_id
 FROM macro_usage)"""
RAW = [RAW_TICKETS, RAW_MACROS, RAW_USAGE]

STATEMENTS["clean_tickets"] = statement(f"""SELECT ticket_id, {text('created_at', 'resolved_at')},
 {r("epoch(resolved_at - created_at) / 60.0E0")} AS resolution_time_minutes,
 coalesce(reopens_count > 0, false) AS is_reopened, priority IN ('high', 'urgent') AS is_high_priority,
 coalesce(CAST(created_at AS DATE) = CAST(resolved_at AS DATE), false) AS resolved_same_day,
 coalesce(macro_sequence, '') AS macro_sequence, coalesce(final_macro_id, '') AS final_macro_id,
 macro_sequence IS NOT NULL AS has_macro FROM tickets""")

STATEMENTS["clean_macros"] = statement(f"""SELECT macro_id, {strip('macro_name')} AS macro_name,
 {strip('macro_body')} AS macro_body, strftime(created_at, '%Y-%m-%d 00:00:00') AS created_at,
 strftime(updated_at, '%Y-%m-%d 00:00:00') AS updated_at, is_active, is_internal_only FROM raw_macros""",
    BASE, RAW)

STATEMENTS["clean_usage"] = statement(f"""SELECT ticket_id, macro_id, {text('applied_at')},
 CAST(position_in_thread AS BIGINT) AS position_in_thread FROM raw_usage""", BASE, RAW)

VALID = """valid AS (SELECT * FROM raw_usage u WHERE EXISTS (SELECT 1 FROM tickets t WHERE t.ticket_id = u.ticket_id)
 AND EXISTS (SELECT 1 FROM macros m WHERE m.macro_id = u.macro_id))"""

STATEMENTS["referential_filter"] = statement(f"""SELECT ticket_id, macro_id, {text('applied_at')},
 CAST(position_in_thread AS BIGINT) AS position_in_thread FROM valid""", BASE, [*RAW, VALID])

STATEMENTS["stage_counts"] = statement("""SELECT 'tickets' AS table_name, count(*) AS n_rows FROM tickets
 UNION ALL SELECT 'macros', count(*) FROM macros UNION ALL SELECT 'macro_usage', count(*) FROM raw_usage
 UNION ALL SELECT 'macro_usage_valid', count(*) FROM valid
 UNION ALL SELECT 'macro_usage_removed', (SELECT count(*) FROM raw_usage) - (SELECT count(*) FROM valid)""",
    BASE, [*RAW, VALID])

STATEMENTS["check_tickets"] = statement("""SELECT 'missing_columns' AS "check", CAST(0 AS BIGINT) AS n_bad
 UNION ALL SELECT 'duplicate_ticket_id', count(*) - count(DISTINCT ticket_id) FROM raw_tickets
 UNION ALL SELECT 'csat_out_of_range', count(*) FROM raw_tickets WHERE csat_score < 1 OR csat_score > 5
 UNION ALL SELECT 'negative_handle_time', count(*) FROM raw_tickets WHERE total_handle_time_minutes < 0""",
    BASE, RAW)

STATEMENTS["check_macros"] = statement("""SELECT 'missing_columns' AS "check", CAST(0 AS BIGINT) AS n_bad
 UNION ALL SELECT 'duplicate_macro_id', count(*) - count(DISTINCT macro_id) FROM raw_macros
 UNION ALL SELECT 'empty_macro_body', count(*) FROM raw_macros WHERE coalesce(macro_body, '') = ''""",
    BASE, RAW)

STATEMENTS["check_usage"] = statement("""SELECT 'missing_columns' AS "check", CAST(0 AS BIGINT) AS n_bad
 UNION ALL SELECT 'position_below_one', count(*) FROM raw_usage WHERE position_in_thread < 1""", BASE, RAW)


def violations(rules: list[tuple[str, str]], select: str, source: str, parts, extra) -> str:
    cases = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in rules)
    inner = f"SELECT {select}, concat_ws(',', {cases}) AS violations FROM {source}"
    return statement(f"SELECT *, violations = '' AS is_valid FROM ({inner})", parts, extra)


STATEMENTS["check_ticket_rows"] = violations(
    [
        ("status_not_allowed", "lower(status) NOT IN ('open', 'solved', 'closed', 'pending')"),
        ("total_handle_time_minutes_below_0", "total_handle_time_minutes < 0"),
        ("csat_score_out_of_range", "csat_score < 1 OR csat_score > 5"),
    ],
    "ticket_id, lower(status) AS status, lower(priority) AS priority, lower(channel) AS channel, 'en' AS language",
    "raw_tickets", BASE, RAW,
)
STATEMENTS["check_macro_rows"] = violations(
    [
        ("macro_body_missing", "macro_body IS NULL"),
        ("category_not_allowed", "lower(category) NOT IN ('economy', 'large', 'medium', 'promo', 'small')"),
        ("macro_body_empty", "macro_body = ''"),
    ],
    "macro_id, macro_name, lower(category) AS category, is_active", "raw_macros", BASE, RAW,
)
STATEMENTS["check_usage_rows"] = violations(
    [("position_in_thread_below_1", "position_in_thread < 1")],
    "ticket_id, macro_id, CAST(position_in_thread AS BIGINT) AS position_in_thread", "raw_usage", BASE, RAW,
)
STATEMENTS["check_score_rows"] = violations(
    [("macro_effectiveness_index_out_of_range", "x > 100")],
    f"macro_id, {r('x')} AS macro_effectiveness_index",
    "(SELECT *, macro_effectiveness_index * CASE WHEN is_internal_only THEN 2.0E0 ELSE 1.0E0 END AS x FROM scores)",
    SCORED, None,
)
STATEMENTS["check_cluster_rows"] = statement("""SELECT DISTINCT
 CAST(regexp_extract(owner_team, '[0-9]+') AS BIGINT) AS cluster_id, owner_team AS cluster_label,
 '' AS violations, true AS is_valid FROM macros""")

def rule_counts(table: str, key: str, source: str, rules: dict[str, str], parts=BASE) -> str:
    """Rows of a spoiled table that break each rule, and rows that break none."""
    columns = dict.fromkeys(c for c, _, _ in SPOILED[table])
    spoiled = ", ".join(
        "CASE " + " ".join(f"WHEN k % {m} = 0 THEN {bad}" for c, m, bad in SPOILED[table] if c == column) + f" ELSE {column} END AS {column}"
        for column in columns
    )
    names = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in rules.items())
    return statement(f"""SELECT rule, count(*) AS n FROM (SELECT unnest(CASE WHEN len(broken) = 0 THEN [''] ELSE broken END) AS rule FROM
 (SELECT list_filter([{names}], lambda x: x IS NOT NULL) AS broken FROM spoiled)) GROUP BY 1""",
        parts, [f"keyed AS (SELECT *, {key} AS k FROM {source})", f"spoiled AS (SELECT {spoiled} FROM keyed)"])


def missing(*columns: str) -> dict[str, str]:
    return {f"{c}_missing": f"{c} IS NULL" for c in columns}


def below(bound: int, *columns: str) -> dict[str, str]:
    return {f"{c}_below_{bound}": f"{c} < {bound}" for c in columns}


def outside(low: int, high: int, *columns: str) -> dict[str, str]:
    return {f"{c}_out_of_range": f"{c} < {low} OR {c} > {high}" for c in columns}


STATEMENTS["check_ticket_rules"] = rule_counts(
    "tickets", "ticket_id", "(SELECT *, ticket_id % 9 AS replies_count FROM tickets)",
    missing("ticket_id", "created_at", "status", "channel", "priority", "contact_driver", "agent_id", "first_response_time_minutes",
            "total_handle_time_minutes", "replies_count", "reopens_count")
    | {"status_not_allowed": "lower(status) NOT IN ('open', 'solved', 'closed', 'pending')",
       "priority_not_allowed": "lower(priority) NOT IN ('low', 'normal', 'high', 'urgent')",
       "channel_not_allowed": "lower(channel) NOT IN ('email', 'chat', 'phone', 'webform')"}
    | below(0, "first_response_time_minutes", "total_handle_time_minutes", "replies_count", "reopens_count")
    | outside(1, 5, "csat_score"))
STATEMENTS["check_macro_rules"] = rule_counts(
    "macros", "macro_id", "macros",
    missing("macro_id", "macro_name", "category", "macro_body", "created_at", "updated_at", "owner_team")
    | {"category_not_allowed": "lower(category) NOT IN ('economy', 'large', 'medium', 'promo', 'small')",
       "macro_name_empty": "macro_name = ''", "macro_body_empty": "macro_body = ''"})
STATEMENTS["check_usage_rules"] = rule_counts(
    "macro_usage", "ticket_id", "(SELECT *, 'email' AS channel FROM macro_usage)",
    missing("ticket_id", "macro_id", "applied_at", "position_in_thread", "agent_id", "channel") | below(1, "position_in_thread"))
VALID_SCORE = """(SELECT macro_id, 'x' AS macro_name, 'x' AS category, 1 AS usage_count, 4.0E0 AS avg_csat, 9.0E0 AS avg_handle_time,
 0.1E0 AS reopen_rate, 50.0E0 AS csat_component, 50.0E0 AS handle_time_component, 50.0E0 AS reopen_component,
 50.0E0 AS macro_effectiveness_index, 50.0E0 AS effectiveness_percentile, 'x' AS macro_category, true AS has_sufficient_usage FROM macros)"""
STATEMENTS["check_score_rules"] = rule_counts(
    "scores", "macro_id", VALID_SCORE,
    missing("macro_id", "macro_name", "category", "usage_count", "avg_csat", "avg_handle_time", "reopen_rate", "csat_component",
            "reopen_component", "macro_effectiveness_index", "macro_category", "has_sufficient_usage")
    | below(0, "usage_count", "avg_handle_time") | outside(0, 5, "avg_csat") | outside(0, 1, "reopen_rate")
    | outside(0, 100, "csat_component", "handle_time_component", "macro_effectiveness_index", "effectiveness_percentile"))
VALID_CLUSTER = """(SELECT DISTINCT CAST(regexp_extract(owner_team, '[0-9]+') AS BIGINT) AS cluster_id, owner_team AS cluster_label, 9 AS num_macros,
 9 AS total_usage, 1 AS num_underused_gems, 1 AS num_low_effectiveness, 50.0E0 AS avg_effectiveness, 50.0E0 AS median_effectiveness,
 5.0E0 AS avg_usage, true AS consolidation_candidate FROM macros)"""
STATEMENTS["check_cluster_rules"] = rule_counts(
    "clusters", "cluster_id", VALID_CLUSTER,
    missing("cluster_label", "num_macros", "num_underused_gems", "median_effectiveness", "consolidation_candidate")
    | below(0, "num_macros", "total_usage", "num_low_effectiveness", "avg_usage") | outside(0, 100, "avg_effectiveness"))

STATEMENTS["data_audit"] = statement("""SELECT count(*) AS n_tickets,
 count(*) FILTER (csat_score IS NULL) AS null_csat,
 count(ticket_id) = count(DISTINCT ticket_id) AS unique_ticket_ids,
 count(*) FILTER (total_handle_time_minutes < 0) AS negative_times,
 (SELECT count(*) FROM part) AS n_macros, (SELECT count(*) FROM lineitem) AS n_uses FROM raw_tickets""",
    BASE, RAW)

STATEMENTS["check_keys"] = statement("""SELECT 'ticket_primary_key' AS "constraint",
  count(*) - count(DISTINCT ticket_id) AS n_bad FROM raw_tickets
 UNION ALL SELECT 'macro_primary_key', count(*) - count(DISTINCT macro_id) FROM raw_macros
 UNION ALL SELECT 'usage_ticket_foreign_key', count(*) FROM raw_usage
   WHERE ticket_id NOT IN (SELECT ticket_id FROM raw_tickets)
 UNION ALL SELECT 'usage_macro_foreign_key', count(*) FROM raw_usage
   WHERE macro_id NOT IN (SELECT macro_id FROM raw_macros)
 UNION ALL SELECT 'ticket_csat_range', count(*) FROM raw_tickets WHERE csat_score NOT BETWEEN 1 AND 5
 UNION ALL SELECT 'ticket_created_at_not_null', count(*) FROM raw_tickets WHERE created_at IS NULL
 UNION ALL SELECT 'macro_name_not_null', count(*) FROM raw_macros WHERE macro_name IS NULL
 UNION ALL SELECT 'macro_category_not_null', count(*) FROM raw_macros WHERE category IS NULL
 UNION ALL SELECT 'usage_ticket_not_null', count(*) FROM raw_usage WHERE ticket_id IS NULL
 UNION ALL SELECT 'usage_macro_not_null', count(*) FROM raw_usage WHERE macro_id IS NULL""", BASE, RAW)

# --- joins and features --------------------------------------------------------------

STATEMENTS["join_ticket_macro_detail"] = statement(f"""SELECT t.ticket_id,
 CAST(t.created_at AS VARCHAR) AS created_at, CAST(t.csat_score AS DOUBLE) AS csat_score,
 {rr('handle_time_seconds')}, contact_driver, was_reopened, m.macro_id, macro_name, category
 FROM fact_tickets t JOIN macro_usage u ON t.ticket_id = u.ticket_id JOIN macros m ON u.macro_id = m.macro_id""")

STATEMENTS["ticket_features"] = statement("""SELECT t.ticket_id,
 count(u.macro_id) AS num_macros_used, count(DISTINCT u.macro_id) AS macro_count_unique,
 coalesce(CAST(min(u.macro_id) FILTER (position_in_thread = 1) AS VARCHAR), '') AS first_macro_id,
 coalesce(CAST(arg_max(u.macro_id, position_in_thread * 100000000 + u.macro_id) AS VARCHAR), '') AS last_macro_id,
 count(u.macro_id) > 0 AS is_macro_used
 FROM tickets t LEFT JOIN macro_usage u ON t.ticket_id = u.ticket_id GROUP BY t.ticket_id""")

STATEMENTS["macro_features"] = statement(f"""SELECT macro_id, macro_name, category, usage_count,
 {rr('avg_csat median_csat avg_handle_time median_handle_time reopen_rate')}, unique_agents, unique_drivers
 FROM macro_features""", SCORED)

STATEMENTS["macro_usage_stats"] = statement(f"""SELECT m.macro_id, macro_name, category,
 count(DISTINCT u.ticket_id) AS total_uses, count(DISTINCT t.agent_id) AS unique_agents,
 CAST(min(applied_at) AS VARCHAR) AS first_used, CAST(max(applied_at) AS VARCHAR) AS last_used
 FROM macros m LEFT JOIN macro_usage u ON m.macro_id = u.macro_id
 LEFT JOIN fact_tickets t ON u.ticket_id = t.ticket_id GROUP BY ALL""")

STATEMENTS["first_macro_per_ticket"] = statement(f"""SELECT ticket_id, {text('applied_at')},
 CAST(position_in_thread AS BIGINT) AS position_in_thread, macro_id FROM macro_usage
 QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY applied_at, position_in_thread, macro_id) = 1""")

PAIR_COLUMNS = f"""a.macro_id AS macro_a, b.macro_id AS macro_b, a.category AS category_a,
 {r('a.macro_effectiveness_index')} AS index_a, {r('b.macro_effectiveness_index')} AS index_b"""
SAME_CATEGORY = """pairs AS (SELECT a.category, a.macro_id AS macro_a, b.macro_id AS macro_b
 FROM scores a JOIN scores b ON a.category = b.category AND a.macro_id < b.macro_id
  AND abs(a.macro_effectiveness_index - b.macro_effectiveness_index) <= 0.3E0
 ORDER BY 1, 2, 3 LIMIT 100)"""
STATEMENTS["join_same_category_pairs"] = statement(f"""SELECT {PAIR_COLUMNS} FROM pairs p
 JOIN scores a ON a.macro_id = p.macro_a JOIN scores b ON b.macro_id = p.macro_b""", SCORED, [SAME_CATEGORY])
STATEMENTS["join_band_pairs"] = statement(f"""SELECT {PAIR_COLUMNS}, b.category AS category_b
 FROM scores a JOIN scores b ON a.macro_id < b.macro_id
  AND abs(a.macro_effectiveness_index - b.macro_effectiveness_index) <= 0.3E0
 ORDER BY macro_a, macro_b LIMIT 100""", SCORED)
STATEMENTS["join_name_similarity"] = statement("""SELECT a.macro_id AS macro_1_id, a.macro_name AS macro_1_name,
 b.macro_id AS macro_2_id, b.macro_name AS macro_2_name, a.category AS category,
 'Potential duplicate - review for consolidation' AS recommendation
 FROM macros a JOIN macros b ON a.category = b.category AND a.macro_id < b.macro_id
 AND (lower(a.macro_name) LIKE '%' || lower(split_part(b.macro_name, ' ', 1)) || '%'
  OR lower(b.macro_name) LIKE '%' || lower(split_part(a.macro_name, ' ', 1)) || '%')
 WHERE a.is_active AND b.is_active ORDER BY 1, 3 LIMIT 50""", [MACROS])

# --- baselines and scores --------------------------------------------------------------

STATEMENTS["baseline_overall"] = statement(
    f"SELECT {rr('avg_csat avg_handle_time reopen_rate')} FROM (SELECT {RATES} FROM tickets)", [TICKETS])
STATEMENTS["baseline_by_driver"] = statement(f"""SELECT contact_driver, {rr('avg_csat avg_handle_time reopen_rate')}
 FROM (SELECT contact_driver, {RATES} FROM tickets GROUP BY 1)""", [TICKETS])
STATEMENTS["macro_scores"] = statement(f"""SELECT macro_id, macro_name, category, usage_count, has_sufficient_usage,
 {rr('csat_lift handle_time_delta reopen_rate_delta csat_component handle_time_component reopen_component')},
 {rr('macro_effectiveness_index effectiveness_percentile')} FROM scores""", SCORED)
STATEMENTS["categorize_macros"] = statement(f"""SELECT macro_id, usage_count,
 {rr('macro_effectiveness_index effectiveness_percentile')}, macro_category FROM categorized""", SCORED)
STATEMENTS["normalize_score"] = f"""SELECT p_partkey AS macro_id,
 {r('100.0E0 * greatest(0.0E0, least(1.0E0, (p_size - 10) / 30.0E0))')} AS forward,
 {r('100.0E0 * (1.0E0 - greatest(0.0E0, least(1.0E0, (p_size - 10) / 30.0E0)))')} AS reverse,
 50.0E0 AS flat FROM part"""
STATEMENTS["effectiveness_level"] = statement(
    f"SELECT macro_id, {rr('macro_effectiveness_index')}, effectiveness_level FROM scores", SCORED)
STATEMENTS["percentile_label"] = statement("""SELECT macro_id, CASE WHEN effectiveness_percentile >= 90 THEN 'Top 10%'
 WHEN effectiveness_percentile >= 75 THEN 'Top 25%' WHEN effectiveness_percentile >= 50 THEN 'Above Average'
 WHEN effectiveness_percentile >= 25 THEN 'Below Average' ELSE 'Bottom 25%' END AS label FROM scores""", SCORED)
STATEMENTS["safe_divide"] = statement(f"""SELECT ticket_id,
 {r('CASE WHEN num_macros_used = 0 THEN 0.0E0 ELSE total_handle_time_minutes / num_macros_used END')} AS minutes_per_macro,
 {r('CASE WHEN coalesce(csat_score, 0) = 0 THEN 1.0E0 ELSE total_handle_time_minutes / csat_score END')} AS minutes_per_point
 FROM ticket_features""")
STATEMENTS["format_percentage"] = statement("""SELECT macro_id,
 format('{:.1f}%', floor(reopen_rate * 100.0E0 * 10.0E0 + 0.5E0) / 10.0E0) AS one_decimal,
 format('{:.0f}%', floor(reopen_rate * 100.0E0 + 0.5E0)) AS no_decimal,
 CASE WHEN usage_count = 0 THEN 'N/A'
  ELSE format('{:.1f}%', floor(reopen_rate * 100.0E0 * 10.0E0 + 0.5E0) / 10.0E0) END AS missing
 FROM macro_features""", SCORED)


def minutes_text(e: str) -> str:
    hours = f"CAST(floor({e} / 60.0E0) AS BIGINT)"
    rest = f"CAST(floor({e} - 60.0E0 * floor({e} / 60.0E0)) AS BIGINT)"
    return (f"CASE WHEN {e} IS NULL THEN 'N/A' WHEN {hours} > 0 THEN concat({hours}, 'h ', {rest}, 'm') "
            f"ELSE concat({rest}, 'm') END")


STATEMENTS["format_minutes"] = statement(f"""SELECT ticket_id,
 {minutes_text('(epoch(resolved_at - created_at) / 60.0E0)')} AS resolution,
 {minutes_text('total_handle_time_minutes')} AS handling FROM tickets""", [TICKETS])


def average_rank(c: str, direction: str, over: str = "") -> str:
    return (f"rank() OVER (ORDER BY {c} {direction}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0E0")


STATEMENTS["rank_avg"] = statement("SELECT macro_id, " + ", ".join(
    f"{r(average_rank(c, d))} AS {c}_rank_{d}" for c in ("usage_count", "avg_csat") for d in ("asc", "desc")
) + " FROM macro_features", SCORED)
STATEMENTS["rank_pct"] = statement(f"""SELECT t.ticket_id, {r('p')} AS csat_score_rank_pct, {r('q')} AS total_handle_time_minutes_rank_pct
 FROM tickets t LEFT JOIN
 (SELECT ticket_id, ({average_rank('csat_score', 'asc')}) / count(*) OVER () AS p FROM tickets
  WHERE csat_score IS NOT NULL) k ON t.ticket_id = k.ticket_id LEFT JOIN
 (SELECT ticket_id, ({average_rank('total_handle_time_minutes', 'asc')}) / count(*) OVER () AS q FROM tickets
  WHERE total_handle_time_minutes IS NOT NULL) h ON t.ticket_id = h.ticket_id""", [TICKETS])
STATEMENTS["category_counts"] = statement(
    "SELECT macro_category, count(*) AS n_macros FROM categorized GROUP BY 1", SCORED)
STATEMENTS["top_macros"] = statement(f"""SELECT macro_id, macro_name, category, {rr('macro_effectiveness_index')},
 usage_count, {rr('avg_csat')} FROM (SELECT * FROM indexed ORDER BY macro_effectiveness_index DESC, macro_id LIMIT 20)""",
    SCORED)
LOWEST = "CASE WHEN usage_count < 10 THEN 'Low usage' ELSE 'Poor performance' END AS issue"
STATEMENTS["bottom_macros"] = statement(f"""SELECT listing, macro_id, macro_name, {rr('macro_effectiveness_index')},
 usage_count, {LOWEST} FROM ((SELECT 'scored' AS listing, * FROM indexed WHERE has_sufficient_usage
  ORDER BY macro_effectiveness_index, macro_id LIMIT 10)
 UNION ALL (SELECT 'all' AS listing, * FROM indexed ORDER BY macro_effectiveness_index, macro_id LIMIT 20))""", SCORED)
STATEMENTS["underused_gems"] = statement(f"""SELECT macro_id, macro_name, {rr('macro_effectiveness_index')}, usage_count
 FROM (SELECT * FROM categorized WHERE macro_category = 'Underused Gem'
  ORDER BY macro_effectiveness_index DESC, macro_id LIMIT 10)""", SCORED)
STATEMENTS["low_effectiveness"] = statement(f"""SELECT macro_id, {rr('macro_effectiveness_index')}, usage_count FROM indexed
 WHERE has_sufficient_usage AND macro_effectiveness_index < 55""", SCORED)
STATEMENTS["unused_macros_py"] = statement(
    "SELECT macro_id, macro_name, category FROM macros WHERE macro_id NOT IN (SELECT macro_id FROM macro_usage)")

# --- warehouse formulation ---------------------------------------------------------------

SQL_BASE = """base AS (SELECT contact_driver, avg(csat_score) AS baseline_csat,
 avg(handle_time_seconds) AS baseline_handle_time,
 avg(CASE WHEN was_reopened THEN 1.0E0 ELSE 0.0E0 END) AS baseline_reopen_rate
 FROM fact_tickets WHERE csat_score IS NOT NULL GROUP BY 1)"""
SQL_RAW = """raw AS (SELECT m.macro_id, m.macro_name, m.category, t.contact_driver, count(*) AS usage_count,
 avg(t.csat_score) AS avg_csat, avg(t.handle_time_seconds) AS avg_handle_time,
 avg(CASE WHEN t.was_reopened THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate
 FROM macros m JOIN macro_usage u ON m.macro_id = u.macro_id JOIN fact_tickets t ON u.ticket_id = t.ticket_id
 WHERE t.csat_score IS NOT NULL GROUP BY ALL HAVING count(*) >= 5)"""
SQL_INDEX = """eff AS (SELECT raw.*, floor((0.4E0 * ((avg_csat - 1.0E0) / 4.0E0 * 100.0E0)
 + 0.3E0 * greatest(0.0E0, least(100.0E0, 100.0E0 * (1.0E0 - avg_handle_time / nullif(baseline_handle_time, 0))))
 + 0.3E0 * ((1.0E0 - reopen_rate) * 100.0E0)) * 1.0E9 + 0.5E0) / 1.0E9 AS effectiveness_index
 FROM raw JOIN base USING (contact_driver))"""
WAREHOUSE = [SQL_BASE, SQL_RAW, SQL_INDEX]
STATEMENTS["sql_baseline"] = statement(
    f"SELECT contact_driver, {rr('baseline_csat baseline_handle_time baseline_reopen_rate')} FROM base", BASE, WAREHOUSE)
STATEMENTS["sql_macro_raw"] = statement(f"""SELECT macro_id, macro_name, category, contact_driver, usage_count,
 {rr('avg_csat avg_handle_time reopen_rate')} FROM raw""", BASE, WAREHOUSE)
STATEMENTS["sql_effectiveness"] = statement(f"""SELECT macro_id, macro_name, category, contact_driver, usage_count,
 {r(r('avg_csat', 2))} AS avg_csat, {r('avg_handle_time', 0)} AS avg_handle_time_sec,
 {r(r('reopen_rate * 100.0E0', 1))} AS reopen_rate_pct, {r(r('effectiveness_index', 1))} AS effectiveness_score,
 CASE WHEN effectiveness_index >= 75 THEN 'High Performer' WHEN effectiveness_index >= 50 THEN 'Moderate'
  WHEN effectiveness_index >= 25 THEN 'Needs Review' ELSE 'Low Performer' END AS effectiveness_tier FROM eff""",
    BASE, WAREHOUSE)
STATEMENTS["sql_gems"] = statement(f"""SELECT macro_id, macro_name, category, contact_driver, usage_count,
 {r(r('effectiveness_index', 1))} AS effectiveness_score, 'Underused Gem - Promote!' AS recommendation
 FROM eff WHERE effectiveness_index >= 60 AND usage_count < 50""", BASE, WAREHOUSE)

ACTIVE = """active AS (SELECT m.macro_id, m.macro_name, m.category, m.created_at, count(u.ticket_id) AS total_uses
 FROM macros m LEFT JOIN macro_usage u ON m.macro_id = u.macro_id WHERE m.is_active GROUP BY ALL)"""
STATEMENTS["sql_unused"] = statement("""SELECT macro_id, macro_name, category, CAST(CAST(created_at AS DATE) AS VARCHAR) AS created_at,
 total_uses, 'Archive - No usage in analysis period' AS recommendation FROM active WHERE total_uses = 0""",
    BASE, [ACTIVE])
STATEMENTS["sql_low_usage"] = statement("""SELECT macro_id, macro_name, category, total_uses,
 'Review - Insufficient data for scoring' AS recommendation FROM active WHERE total_uses BETWEEN 1 AND 4""",
    BASE, [ACTIVE])
STATEMENTS["sql_category_stats"] = statement(f"""SELECT category, macro_count, total_tickets,
 {r(r('csat', 2))} AS avg_csat, {r('seconds', 0)} AS avg_handle_time_sec,
 CASE WHEN macro_count > 10 AND csat < 3.5 THEN 'Consolidate - Too many low-performing macros'
  WHEN macro_count > 15 THEN 'Review - High macro count may indicate redundancy' ELSE 'OK' END AS recommendation
 FROM (SELECT m.category, count(DISTINCT m.macro_id) AS macro_count, count(DISTINCT u.ticket_id) AS total_tickets,
  avg(t.csat_score) AS csat, avg(t.handle_time_seconds) AS seconds
  FROM macros m LEFT JOIN macro_usage u ON m.macro_id = u.macro_id
  LEFT JOIN fact_tickets t ON u.ticket_id = t.ticket_id WHERE m.is_active GROUP BY 1) WHERE macro_count > 5""")
STATEMENTS["sql_exec_summary"] = statement(f"""SELECT count(*) AS total_active_macros,
 count(*) FILTER (total_uses = 0) AS unused_macros, count(*) FILTER (total_uses BETWEEN 1 AND 4) AS low_usage_macros,
 count(*) FILTER (total_uses >= 5) AS scoreable_macros,
 {r(r('100.0E0 * count(*) FILTER (total_uses = 0) / count(*)', 1))} AS unused_pct,
 {r(r('avg(total_uses)', 1))} AS avg_usage_per_macro FROM active""", BASE, [ACTIVE])
BIG = """SELECT 'Categories for Consolidation Review' AS action_type, count(*) AS n
 FROM (SELECT category FROM macros WHERE is_active GROUP BY category HAVING count(*) > 10)"""
STATEMENTS["sql_action_items"] = statement(f"""SELECT 'Macros to Archive (unused)' AS action_type, count(*) AS n
 FROM macros m LEFT JOIN macro_usage u ON m.macro_id = u.macro_id WHERE m.is_active
 GROUP BY m.macro_id HAVING count(u.ticket_id) = 0
 UNION ALL SELECT 'Macros Needing Review (low usage)', count(*)
 FROM macros m LEFT JOIN macro_usage u ON m.macro_id = u.macro_id WHERE m.is_active
 GROUP BY m.macro_id HAVING count(u.ticket_id) BETWEEN 1 AND 4 UNION ALL {BIG}""")
STATEMENTS["action_items_summary"] = statement(f"""SELECT 'Macros to Archive (unused)' AS action_type,
 count(*) AS n FROM active WHERE total_uses = 0
 UNION ALL SELECT 'Macros Needing Review (low usage)', count(*) FROM active WHERE total_uses BETWEEN 1 AND 4
 UNION ALL {BIG}""", BASE, [ACTIVE])

# --- agents -------------------------------------------------------------------------------

AGENTS = """agent_base AS (SELECT agent_id, count(ticket_id) AS total_tickets, avg(csat_score) AS avg_csat,
 avg(total_handle_time_minutes) AS avg_handle_time,
 avg(CASE WHEN reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate,
 avg(first_response_time_minutes) AS avg_first_response_time,
 avg(CASE WHEN status = 'solved' THEN 1.0E0 ELSE 0.0E0 END) AS resolution_rate,
 count(*) FILTER (num_macros_used > 0) AS tickets_with_macros, avg(num_macros_used) AS avg_macros_per_ticket,
 quantile_cont(total_handle_time_minutes, 0.5) AS median_handle_time FROM ticket_features GROUP BY 1),
agent_metrics AS (SELECT *, CAST(tickets_with_macros AS DOUBLE) / total_tickets AS macro_adoption_rate,
 rank() OVER (ORDER BY avg_csat DESC) + (count(*) OVER (PARTITION BY avg_csat) - 1) / 2.0E0 AS csat_rank,
 rank() OVER (ORDER BY avg_handle_time) + (count(*) OVER (PARTITION BY avg_handle_time) - 1) / 2.0E0 AS handle_time_rank,
 100.0E0 * (0.4E0 * (rank() OVER (ORDER BY avg_csat) + (count(*) OVER (PARTITION BY avg_csat) - 1) / 2.0E0) / count(*) OVER ()
 + 0.3E0 * (1 - (rank() OVER (ORDER BY avg_handle_time) + (count(*) OVER (PARTITION BY avg_handle_time) - 1) / 2.0E0) / count(*) OVER ())
 + 0.2E0 * (1 - (rank() OVER (ORDER BY reopen_rate) + (count(*) OVER (PARTITION BY reopen_rate) - 1) / 2.0E0) / count(*) OVER ())
 + 0.1E0 * (rank() OVER (ORDER BY resolution_rate) + (count(*) OVER (PARTITION BY resolution_rate) - 1) / 2.0E0) / count(*) OVER ())
 AS agent_effectiveness_score FROM agent_base)"""
AGENT_MACROS = """agent_macros AS (SELECT g.*, macro_name, category, macro_effectiveness_index FROM
 (SELECT t.agent_id, u.macro_id, count(*) AS usage_count, avg(csat_score) AS avg_csat_with_macro,
  avg(total_handle_time_minutes) AS avg_handle_time_with_macro,
  avg(CASE WHEN reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate_with_macro
  FROM macro_usage u JOIN tickets t ON u.ticket_id = t.ticket_id GROUP BY 1, 2) g
 LEFT JOIN indexed i ON g.macro_id = i.macro_id)"""
SELECTION = """selection AS (SELECT m.*, avg_macro_effectiveness, unique_macros_used, total_macro_uses
 FROM agent_metrics m LEFT JOIN (SELECT agent_id, avg(macro_effectiveness_index) AS avg_macro_effectiveness,
  count(DISTINCT macro_id) AS unique_macros_used, CAST(sum(usage_count) AS BIGINT) AS total_macro_uses
  FROM agent_macros GROUP BY 1) s ON m.agent_id = s.agent_id)"""
AGENT = [AGENTS, AGENT_MACROS, SELECTION]
STATEMENTS["agent_metrics"] = statement(f"""SELECT agent_id, total_tickets, tickets_with_macros,
 {rr('avg_csat avg_handle_time reopen_rate avg_first_response_time resolution_rate avg_macros_per_ticket')},
 {rr('median_handle_time macro_adoption_rate csat_rank handle_time_rank agent_effectiveness_score')}
 FROM agent_metrics""", BASE, [AGENTS])
STATEMENTS["agent_macro_usage"] = statement(f"""SELECT agent_id, macro_id, usage_count,
 {rr('avg_csat_with_macro avg_handle_time_with_macro reopen_rate_with_macro')}, macro_name, category,
 {rr('macro_effectiveness_index')} FROM agent_macros""", SCORED, AGENT)
USAGE_AGENTS = """usage_agents AS (SELECT u.agent_id, count(DISTINCT u.ticket_id) AS total_tickets,
 count(u.macro_id) AS total_macro_uses, count(DISTINCT u.macro_id) AS unique_macros_used, avg(csat_score) AS avg_csat,
 avg(total_handle_time_minutes) AS avg_handle_time,
 avg(CASE WHEN reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate
 FROM macro_usage u LEFT JOIN tickets t ON u.ticket_id = t.ticket_id GROUP BY 1)"""
STATEMENTS["agent_usage_metrics"] = statement(f"""SELECT agent_id, total_tickets, total_macro_uses, unique_macros_used,
 {rr('avg_csat avg_handle_time reopen_rate')},
 {r('CAST(total_macro_uses AS DOUBLE) / total_tickets')} AS macros_per_ticket,
 {r('CAST(unique_macros_used AS DOUBLE) / total_macro_uses')} AS macro_diversity FROM usage_agents""",
    BASE, [USAGE_AGENTS])
STATEMENTS["agent_selection"] = statement(f"""SELECT agent_id, {rr('agent_effectiveness_score avg_macro_effectiveness')},
 unique_macros_used, total_macro_uses FROM selection""", SCORED, AGENT)
STATEMENTS["agent_correlation"] = statement(f"""SELECT
 {r('corr(avg_macro_effectiveness, agent_effectiveness_score)')} AS macro_selection_correlation FROM selection""",
    SCORED, AGENT)
STATEMENTS["agent_top_insight"] = statement(f"""SELECT {r('cut')} AS csat_cut,
 {r('a')} AS top_avg_unique_macros, {r('b')} AS all_avg_unique_macros, {r('a - b')} AS difference
 FROM (SELECT any_value(cut) AS cut, avg(unique_macros_used) FILTER (avg_csat > cut) AS a, avg(unique_macros_used) AS b
  FROM usage_agents, (SELECT quantile_cont(avg_csat, 0.8) AS cut FROM usage_agents))""", BASE, [USAGE_AGENTS])
STATEMENTS["top_agents"] = statement("""(SELECT 'score' AS listing, agent_id FROM selection
  ORDER BY agent_effectiveness_score DESC, agent_id LIMIT 10)
 UNION ALL (SELECT 'macro choice', agent_id FROM selection WHERE avg_macro_effectiveness IS NOT NULL
  ORDER BY avg_macro_effectiveness DESC, agent_id LIMIT 10)
 UNION ALL (SELECT 'csat', agent_id FROM selection WHERE avg_csat IS NOT NULL ORDER BY avg_csat DESC, agent_id LIMIT 15)""",
    SCORED, AGENT)
STATEMENTS["agent_recommendations"] = statement(f"""SELECT agent_id, rank, macro_id, macro_name, category,
 {rr('macro_effectiveness_index')}, usage_count FROM (SELECT a.agent_id, g.*, row_number() OVER
  (PARTITION BY a.agent_id ORDER BY macro_effectiveness_index DESC, g.macro_id) AS rank
 FROM (SELECT DISTINCT agent_id FROM tickets) a,
  (SELECT * FROM indexed WHERE has_sufficient_usage AND macro_effectiveness_index >= 60) g
 WHERE NOT EXISTS (SELECT 1 FROM agent_macros x WHERE x.agent_id = a.agent_id AND x.macro_id = g.macro_id))
 WHERE rank <= 5""", SCORED, AGENT)

# --- trends ---------------------------------------------------------------------------------

DAILY = """daily AS (SELECT CAST(created_at AS DATE) AS date, count(*) AS total_tickets, avg(csat_score) AS avg_csat,
 avg(total_handle_time_minutes) AS avg_handle_time, count(*) FILTER (num_macros_used > 0) AS tickets_with_macros,
 CAST(sum(num_macros_used) AS BIGINT) AS total_macros_used,
 avg(CASE WHEN reopens_count > 0 THEN 1.0E0 ELSE 0.0E0 END) AS reopen_rate,
 count(*) FILTER (num_macros_used > 0) / CAST(count(*) AS DOUBLE) AS macro_adoption_rate,
 CAST(sum(num_macros_used) AS DOUBLE) / count(*) AS macros_per_ticket FROM ticket_features GROUP BY 1)"""
STATEMENTS["daily_metrics"] = statement(f"""SELECT {text('date')}, total_tickets, tickets_with_macros, total_macros_used,
 {rr('avg_csat avg_handle_time reopen_rate macro_adoption_rate macros_per_ticket')} FROM daily""", BASE, [DAILY])
LAST7 = "OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
STATEMENTS["rolling_7"] = statement(f"""SELECT {text('date')}, {r(f'avg(avg_csat) {LAST7}')} AS csat_7d_avg,
 {r(f'avg(avg_handle_time) {LAST7}')} AS handle_time_7d_avg,
 {r(f'avg(macro_adoption_rate) {LAST7}')} AS macro_adoption_7d_avg FROM daily""", BASE, [DAILY])


def outside(c: str) -> str:
    return f"coalesce(abs({c} - avg({c}) OVER ()) > 2.0E0 * stddev_samp({c}) OVER (), false)"


STATEMENTS["anomaly_flags"] = statement(f"""SELECT *, avg_csat_anomaly OR avg_handle_time_anomaly
  OR macro_adoption_rate_anomaly AS any_anomaly FROM (SELECT {text('date')}, {outside('avg_csat')} AS avg_csat_anomaly,
 {outside('avg_handle_time')} AS avg_handle_time_anomaly,
 {outside('macro_adoption_rate')} AS macro_adoption_rate_anomaly FROM daily)""", BASE, [DAILY])
WEEK = """concat(strftime(date_trunc('week', applied_at), '%Y-%m-%d'), '/',
 strftime(date_trunc('week', applied_at) + INTERVAL '6' DAY, '%Y-%m-%d'))"""
WEEKLY = f"weekly AS (SELECT {WEEK} AS week, macro_id, count(*) AS usage_count FROM macro_usage GROUP BY 1, 2)"
STATEMENTS["weekly_macro_usage"] = statement("SELECT * FROM weekly", [TICKETS, MACROS, USAGE, WEEKLY])
STATEMENTS["category_trends"] = statement(f"""SELECT {WEEK} AS week, category, count(*) AS usage_count,
 count(DISTINCT u.macro_id) AS unique_macros FROM macro_usage u JOIN macros m ON u.macro_id = m.macro_id GROUP BY 1, 2""")
STATEMENTS["usage_trend"] = statement(f"""SELECT t.macro_id, total_uses, recent_uses, previous_uses,
 "1998-01-05/1998-01-11", "1998-01-12/1998-01-18", {r('trend')} AS trend,
 CASE WHEN trend > 0.1 THEN 'Rising' WHEN trend < -0.1 THEN 'Declining' ELSE 'Stable' END AS trend_direction,
 macro_name, category, {rr('macro_effectiveness_index')}
 FROM (SELECT *, (recent_uses - previous_uses) / (previous_uses + 1.0E0) AS trend FROM
  (SELECT macro_id, CAST(sum(usage_count) AS BIGINT) AS total_uses,
   CAST(coalesce(sum(usage_count) FILTER (n <= 2), 0) AS BIGINT) AS recent_uses,
   CAST(coalesce(sum(usage_count) FILTER (n IN (3, 4)), 0) AS BIGINT) AS previous_uses,
   CAST(coalesce(sum(usage_count) FILTER (week = '1998-01-05/1998-01-11'), 0) AS BIGINT) AS "1998-01-05/1998-01-11",
   CAST(coalesce(sum(usage_count) FILTER (week = '1998-01-12/1998-01-18'), 0) AS BIGINT) AS "1998-01-12/1998-01-18"
   FROM (SELECT *, dense_rank() OVER (ORDER BY week DESC) AS n FROM weekly) GROUP BY 1)) t
 LEFT JOIN indexed i ON t.macro_id = i.macro_id""", SCORED, [WEEKLY])

# --- recommendations, reports, exports ----------------------------------------------------------

AFFINITY = """affinity AS (SELECT t.contact_driver AS ticket_type, m.category, avg(t.csat_score) AS avg_csat,
 count(*) AS usage_count FROM macro_usage u JOIN macros m ON u.macro_id = m.macro_id
 JOIN tickets t ON u.ticket_id = t.ticket_id GROUP BY 1, 2)"""
STATEMENTS["category_affinity"] = statement(
    f"SELECT ticket_type, category, {rr('avg_csat')}, usage_count FROM affinity", BASE, [AFFINITY])
STATEMENTS["category_affinity_matrix"] = statement("SELECT ticket_type, " + ", ".join(
    f"coalesce({r(f'''max(avg_csat) FILTER (category = '{c}')''')}, 0.0E0) AS {c}"
    for c in ("economy", "large", "medium", "promo", "small", "standard")
) + " FROM affinity GROUP BY 1", BASE, [AFFINITY])
TOP2 = """top2 AS (SELECT *, row_number() OVER (PARTITION BY category
 ORDER BY macro_effectiveness_index DESC, macro_id) AS r FROM indexed QUALIFY r <= 2)"""
STATEMENTS["topk_per_category"] = statement(
    f"SELECT category, r AS rank, macro_id, {rr('macro_effectiveness_index')} FROM top2", SCORED, [TOP2])
STATEMENTS["rule_recommendations"] = statement(f"""SELECT ticket_type, row_number() OVER
 (PARTITION BY ticket_type ORDER BY c, r) AS rank, macro_id, macro_name, p.category, {r('macro_effectiveness_index')} AS effectiveness,
 'High-performing macro in recommended category ''' || p.category || '''' AS reason
 FROM (SELECT ticket_type, category, row_number() OVER (PARTITION BY ticket_type ORDER BY avg_csat DESC, category) AS c
   FROM affinity QUALIFY c <= 2
  UNION ALL SELECT lower(r_name), category, row_number() OVER (PARTITION BY r_name ORDER BY category) AS c
   FROM region, (SELECT DISTINCT category FROM macros) QUALIFY c <= 2) p JOIN top2 ON p.category = top2.category
 QUALIFY rank <= 3""", SCORED, [AFFINITY, TOP2])
STATEMENTS["quick_wins"] = statement(f"""SELECT macro_id, {rr('macro_effectiveness_index')}, usage_count FROM indexed
 WHERE macro_effectiveness_index > 60
 AND usage_count < (SELECT quantile_cont(CAST(usage_count AS DOUBLE), 0.5) FROM indexed)""", SCORED)
STATEMENTS["low_usage"] = statement("SELECT macro_id, macro_name, usage_count FROM indexed WHERE usage_count < 5", SCORED)
STATEMENTS["macro_sequence_steps"] = statement("""SELECT ticket_id, u.i AS position, u.m AS macro_id
 FROM tickets, unnest(string_split(macro_sequence, ',')) WITH ORDINALITY AS u(m, i) WHERE macro_sequence <> ''""", BASE)
STATEMENTS["short_names"] = statement("""SELECT macro_id, left(macro_name || ' ' || category || ' ' || macro_name, 30) AS short_name,
 left(macro_name || ' ' || category || ' ' || macro_name, 50) AS export_name FROM macros""", BASE)
STATEMENTS["action_items_export"] = statement(f"""SELECT macro_id, macro_name, category, {rr('macro_effectiveness_index')},
 usage_count FROM scores WHERE effectiveness_level = 'Low' OR usage_count < 5""", SCORED)
STATEMENTS["eval_landscape"] = statement(f"""SELECT count(*) AS total_macros, count(*) FILTER (is_active) AS active_macros,
 count(*) FILTER (usage_count = 0) AS unused_macros,
 {r('count(*) FILTER (usage_count = 0) / CAST(count(*) AS DOUBLE)')} AS unused_share,
 count(*) FILTER (usage_count BETWEEN 1 AND 4) AS low_usage_macros,
 {r('avg(macro_effectiveness_index)')} AS avg_effectiveness,
 count(*) FILTER (macro_effectiveness_index >= 75) AS high_impact_macros,
 count(*) FILTER (macro_effectiveness_index < 25) AS low_effectiveness_macros FROM indexed""", SCORED)
CLUSTERS = """clusters AS (SELECT CAST(regexp_extract(owner_team, '[0-9]+') AS BIGINT) AS cluster_id,
 owner_team AS cluster_label, count(*) AS num_macros, avg(macro_effectiveness_index) AS avg_effectiveness,
 quantile_cont(macro_effectiveness_index, 0.5) AS median_effectiveness, CAST(sum(usage_count) AS BIGINT) AS total_usage,
 avg(usage_count) AS avg_usage, count(*) FILTER (macro_category = 'Underused Gem') AS num_underused_gems,
 count(*) FILTER (macro_category = 'Low Effectiveness') AS num_low_effectiveness,
 count(*) >= 5 AND avg(macro_effectiveness_index) < 50 AS consolidation_candidate
 FROM categorized GROUP BY 1, 2)"""
STATEMENTS["eval_recommendations"] = statement("""SELECT * FROM (
 SELECT CAST(1 AS BIGINT) AS priority, 'Archive unused macros' AS action, count(*) AS n FROM scores WHERE usage_count = 0
 UNION ALL SELECT 2, 'Promote underused gems', least(10, count(*)) FROM categorized WHERE macro_category = 'Underused Gem'
 UNION ALL SELECT 3, 'Rewrite low-effectiveness macros', count(*) FROM scores WHERE macro_effectiveness_index < 25
 UNION ALL SELECT 4, 'Consolidate topic clusters', count(*) FROM clusters WHERE consolidation_candidate) WHERE n > 0""",
    SCORED, [CLUSTERS])
STATEMENTS["explorer_filter"] = statement(f"""SELECT macro_id, macro_name, {rr('macro_effectiveness_index')}, usage_count
 FROM scores WHERE category = 'promo' AND effectiveness_level = 'Medium' AND usage_count >= 10""", SCORED)
STATEMENTS["explorer_compare"] = statement("SELECT " + ", ".join(
    f"a.{c} AS {c}_a, b.{c} AS {c}_b" for c in ("macro_name", "category", "usage_count")
) + f""", {r('a.macro_effectiveness_index')} AS macro_effectiveness_index_a,
 {r('b.macro_effectiveness_index')} AS macro_effectiveness_index_b, {r('a.avg_csat')} AS avg_csat_a,
 {r('b.avg_csat')} AS avg_csat_b, {r('a.macro_effectiveness_index - b.macro_effectiveness_index')} AS index_delta,
 a.usage_count - b.usage_count AS usage_delta, {r('a.avg_csat - b.avg_csat')} AS csat_delta
 FROM indexed a, indexed b WHERE a.macro_id = 3 AND b.macro_id = 18""", SCORED)
STATEMENTS["scatter_usage"] = statement(f"""SELECT macro_id, macro_name, usage_count, {rr('macro_effectiveness_index')},
 category FROM indexed WHERE has_sufficient_usage""", SCORED)
STATEMENTS["macro_impact"] = statement(f"""SELECT is_macro_used, tickets, {', '.join(
    f"{r(r(c, 2))} AS {c}" for c in ('avg_csat', 'avg_handle_time', 'reopen_rate'))}, {', '.join(
    f"{r(r(f'max({c}) FILTER (is_macro_used) OVER () - max({c}) FILTER (NOT is_macro_used) OVER ()', 2))} AS {c}_delta"
    for c in ('avg_csat', 'avg_handle_time', 'reopen_rate'))}
 FROM (SELECT is_macro_used, count(*) AS tickets, {RATES} FROM ticket_features GROUP BY 1)""")
STATEMENTS["driver_volume"] = statement(
    "SELECT contact_driver, count(*) AS n_tickets FROM tickets GROUP BY 1", [TICKETS])
STATEMENTS["category_perf"] = statement(f"""SELECT category, {r(r('avg(macro_effectiveness_index)', 1))} AS avg_effectiveness,
 CAST(sum(usage_count) AS BIGINT) AS total_usage, count(*) AS macro_count FROM indexed WHERE has_sufficient_usage
 GROUP BY 1""", SCORED)
STATEMENTS["exp_category_stats"] = statement(f"""SELECT category, count(*) AS macro_count,
 {r('avg(macro_effectiveness_index)')} AS avg_effectiveness, CAST(sum(usage_count) AS BIGINT) AS total_usage
 FROM indexed GROUP BY 1""", SCORED)
STATEMENTS["exp_ticket_summary"] = statement(f"""SELECT contact_driver AS ticket_type, count(*) AS n_tickets,
 {r('avg(csat_score)')} AS avg_csat, {r('avg(total_handle_time_minutes)')} AS avg_handle_time,
 {r('avg(num_macros_used)')} AS avg_macros_used FROM ticket_features GROUP BY 1""")
STATEMENTS["kpi_overview"] = statement(f"""SELECT count(*) AS total_macros,
 {r('100.0E0 * count(*) FILTER (usage_count = 0) / count(*)')} AS unused_pct,
 {r('avg(macro_effectiveness_index)')} AS avg_effectiveness, {r('max(macro_effectiveness_index)')} AS max_effectiveness,
 CAST(sum(usage_count) AS BIGINT) AS total_uses, count(DISTINCT category) AS categories,
 (SELECT count(*) FROM tickets) AS total_tickets, (SELECT {r('avg(csat_score)')} FROM tickets) AS avg_csat
 FROM indexed""", SCORED)
STATEMENTS["report_totals"] = statement(f"""SELECT count(*) AS total_macros,
 {r('avg(macro_effectiveness_index)')} AS avg_effectiveness, CAST(sum(usage_count) AS BIGINT) AS total_uses,
 (SELECT count(*) FROM tickets) AS total_tickets FROM indexed""", SCORED)
STATEMENTS["report_tier_counts"] = statement(f"""SELECT effectiveness_level, count(*) AS n_macros,
 {r('100.0E0 * count(*) / (SELECT count(*) FROM scores)')} AS pct FROM scores
 WHERE effectiveness_level IS NOT NULL GROUP BY 1""", SCORED)
STATEMENTS["crosstab_heatmap"] = statement("SELECT category, " + ", ".join(
    f"count(*) FILTER (effectiveness_level = '{v}') AS {v.lower()}" for v in ("Low", "Medium", "High")
) + " FROM scores GROUP BY 1", SCORED)
WEIGHTED = "CAST(sum(usage_count * macro_effectiveness_index) AS DOUBLE) / sum(usage_count)"
STATEMENTS["rollup_hierarchy"] = statement(f"""SELECT CASE WHEN g >= 7 THEN '(all)' ELSE category END AS category,
 CASE WHEN g >= 3 THEN '(all)' ELSE owner_team END AS cluster_label,
 CASE WHEN g >= 1 THEN '(all)' ELSE effectiveness_level END AS effectiveness_level, g AS grouping_id, total_usage,
 {rr('weighted_effectiveness')} FROM (SELECT category, owner_team, effectiveness_level,
  CAST(grouping(category, owner_team, effectiveness_level) AS BIGINT) AS g,
  CAST(sum(usage_count) AS BIGINT) AS total_usage, {WEIGHTED} AS weighted_effectiveness
  FROM scores WHERE has_sufficient_usage GROUP BY ROLLUP (category, owner_team, effectiveness_level))""", SCORED)
STATEMENTS["treemap_cluster"] = statement(f"""SELECT owner_team AS cluster_label, CAST(sum(usage_count) AS BIGINT) AS total_usage,
 {r(WEIGHTED)} AS weighted_effectiveness FROM scores WHERE has_sufficient_usage GROUP BY 1""", SCORED)
STATEMENTS["histogram_index"] = statement("""SELECT CAST(least(20, 1 + floor((x - lo) / (hi - lo) * 20.0E0)) AS BIGINT) AS bin,
 count(*) AS n_macros FROM (SELECT macro_effectiveness_index AS x, min(macro_effectiveness_index) OVER () AS lo,
  max(macro_effectiveness_index) OVER () AS hi FROM scores WHERE has_sufficient_usage) GROUP BY 1""", SCORED)
STATEMENTS["cluster_summary"] = statement(f"""SELECT cluster_id, cluster_label, num_macros, total_usage,
 {rr('avg_effectiveness median_effectiveness avg_usage')}, num_underused_gems, num_low_effectiveness,
 consolidation_candidate FROM clusters""", SCORED, [CLUSTERS])
STATEMENTS["cluster_display"] = statement(f"""SELECT cluster_id, cluster_label, num_macros, total_usage,
 {rr('avg_effectiveness')}, consolidation_candidate FROM clusters""", SCORED, [CLUSTERS])
STATEMENTS["consolidation_candidates"] = statement(
    "SELECT cluster_id, cluster_label, num_macros FROM clusters WHERE consolidation_candidate", SCORED, [CLUSTERS])
STATEMENTS["consolidation_review"] = statement("""SELECT cluster_id, cluster_label, num_macros FROM clusters
 WHERE num_macros >= 5 AND avg_effectiveness < 75""", SCORED, [CLUSTERS])

# --- experiments -------------------------------------------------------------------------------

STATS = """stats AS (SELECT macro_id, count(*) AS n, avg(csat_score) AS csat_mean,
 coalesce(stddev_samp(csat_score), 0.1E0) AS csat_std, avg(total_handle_time_minutes) AS handle_time_mean,
 coalesce(stddev_samp(total_handle_time_minutes), 1.0E0) AS handle_time_std
 FROM macro_usage u JOIN tickets t ON u.ticket_id = t.ticket_id GROUP BY 1)"""
STATEMENTS["macro_stats_ab"] = statement(f"""SELECT macro_id, n,
 {rr('csat_mean csat_std handle_time_mean handle_time_std')} FROM stats""", BASE, [STATS])


def pooled(m: str) -> str:
    return (f"sqrt(((a.n - 1) * a.{m}_std * a.{m}_std + (b.n - 1) * b.{m}_std * b.{m}_std) / (a.n + b.n - 2))")


def t_exact(m: str) -> str:
    return f"(a.{m}_mean - b.{m}_mean) / nullif({pooled(m)} * sqrt(1.0E0 / a.n + 1.0E0 / b.n), 0)"


def t_columns(m: str) -> str:
    diff = f"(a.{m}_mean - b.{m}_mean)"
    return (f"{r(t_exact(m))} AS {m}_t_stat, "
            f"{r(f'CASE WHEN {pooled(m)} > 0 THEN {diff} / {pooled(m)} ELSE 0 END')} AS {m}_effect_size")


STATEMENTS["ab_batch"] = statement(f"""SELECT macro_a, macro_b, a.n AS n_a, b.n AS n_b, {t_columns('csat')},
 {t_columns('handle_time')} FROM pairs JOIN stats a ON a.macro_id = macro_a JOIN stats b ON b.macro_id = macro_b
 WHERE a.n >= 20 AND b.n >= 20""", SCORED, [SAME_CATEGORY, STATS])
STATEMENTS["sample_size"] = statement(f"""SELECT macro_id, {r('p')} AS good_rate, CAST(ceil(power(
  1.959963984540054E0 * sqrt(2.0E0 * ((p + q) / 2.0E0) * (1.0E0 - (p + q) / 2.0E0))
  + 0.8416212335729143E0 * sqrt(p * (1.0E0 - p) + q * (1.0E0 - q)), 2) / ((p - q) * (p - q))) AS BIGINT) AS n_per_arm
 FROM (SELECT macro_id, p, p * (1.0E0 + 0.1E0) AS q FROM (SELECT macro_id,
  avg(CASE WHEN csat_score >= 4 THEN 1.0E0 ELSE 0.0E0 END) AS p
  FROM macro_usage u JOIN tickets t ON u.ticket_id = t.ticket_id WHERE csat_score IS NOT NULL GROUP BY 1)
  WHERE p > 0 AND p < 1)""")
