"""Tables broken on purpose, once for each rule of the row checks.

A column is spoiled where the row's key leaves no rest by a number. The expressions are plain SQL; the first
that applies to a column counts. The check statements state the rules themselves.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPOILED = {
    "tickets": [
        ("ticket_id", 211, "NULL"), ("created_at", 199, "NULL"), ("status", 197, "NULL"), ("status", 107, "'lost'"),
        ("channel", 193, "NULL"), ("channel", 109, "'Social'"), ("priority", 191, "NULL"), ("priority", 113, "'vital'"),
        ("contact_driver", 181, "NULL"), ("agent_id", 179, "NULL"), ("first_response_time_minutes", 173, "NULL"),
        ("first_response_time_minutes", 127, "-0.5E0"), ("total_handle_time_minutes", 167, "NULL"),
        ("total_handle_time_minutes", 131, "-1.0E0"), ("replies_count", 163, "NULL"), ("replies_count", 137, "-2"),
        ("reopens_count", 157, "NULL"), ("reopens_count", 139, "-1"), ("csat_score", 149, "0"), ("csat_score", 151, "6"),
    ],
    "macros": [
        ("macro_id", 61, "NULL"), ("macro_name", 59, "NULL"), ("macro_name", 31, "''"), ("category", 53, "NULL"),
        ("category", 29, "'general'"), ("macro_body", 47, "NULL"), ("macro_body", 23, "''"), ("created_at", 43, "NULL"),
        ("updated_at", 41, "NULL"), ("owner_team", 37, "NULL"),
    ],
    "macro_usage": [
        ("ticket_id", 211, "NULL"), ("macro_id", 199, "NULL"), ("applied_at", 197, "NULL"), ("position_in_thread", 193, "NULL"),
        ("position_in_thread", 101, "0"), ("agent_id", 191, "NULL"), ("channel", 181, "NULL"),
    ],
    "scores": [
        ("macro_id", 61, "NULL"), ("macro_name", 59, "NULL"), ("category", 53, "NULL"), ("usage_count", 47, "NULL"),
        ("usage_count", 43, "-1"), ("avg_csat", 41, "NULL"), ("avg_csat", 37, "5.5E0"), ("avg_handle_time", 31, "NULL"),
        ("avg_handle_time", 29, "-1.0E0"), ("reopen_rate", 23, "NULL"), ("reopen_rate", 19, "1.5E0"), ("csat_component", 67, "NULL"),
        ("csat_component", 71, "101.0E0"), ("handle_time_component", 73, "-1.0E0"), ("reopen_component", 79, "NULL"),
        ("macro_effectiveness_index", 17, "NULL"), ("macro_effectiveness_index", 83, "100.5E0"),
        ("effectiveness_percentile", 89, "-0.1E0"), ("macro_category", 97, "NULL"), ("has_sufficient_usage", 13, "NULL"),
    ],
    "clusters": [
        ("cluster_label", 5, "NULL"), ("num_macros", 7, "NULL"), ("num_macros", 11, "-1"), ("total_usage", 3, "-5"),
        ("num_underused_gems", 13, "NULL"), ("num_low_effectiveness", 4, "-1"), ("avg_effectiveness", 2, "100.5E0"),
        ("median_effectiveness", 6, "NULL"), ("avg_usage", 17, "-0.5E0"), ("consolidation_candidate", 9, "NULL"),
    ],
}


def spoil(df: DataFrame, table: str, key: str) -> DataFrame:
    """The table with its spoiled columns, of the kinds they had."""
    out = df.withColumn("_key", F.col(key))
    for column in dict.fromkeys(c for c, _, _ in SPOILED[table]):
        cases = " ".join(f"WHEN _key % {m} = 0 THEN {bad}" for c, m, bad in SPOILED[table] if c == column)
        kind = df.schema[column].dataType.simpleString()
        out = out.withColumn(column, F.expr(f"CAST(CASE {cases} ELSE {column} END AS {kind})"))
    return out.drop("_key")


def broken_rules(checked: DataFrame) -> DataFrame:
    """How many rows break each rule, and how many none ('')."""
    rules = F.explode(F.when(F.col("is_valid"), F.array(F.lit(""))).otherwise(F.col("violations")))
    return checked.select(rules.alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
