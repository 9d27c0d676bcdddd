"""Cleaning of the three input tables and the referential filter between them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyscope.functions.columns import col, day, minutes_between
from replyscope.functions.text import strip


def _timestamp(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.expr(f"try_cast(`{name}` AS timestamp_ntz)")
    return F.col(name).cast("timestamp_ntz")


def clean_tickets(tickets: DataFrame) -> DataFrame:
    df = tickets.withColumns({c: _timestamp(tickets, c) for c in ("created_at", "resolved_at")})
    fills = {c: F.coalesce(F.col(c), F.lit("")) for c in ("macro_sequence", "final_macro_id")}
    return df.withColumns(fills).withColumns(
        {
            "resolution_time_minutes": minutes_between("created_at", "resolved_at"),
            "is_reopened": F.coalesce(F.col("reopens_count") > 0, F.lit(False)),
            "is_high_priority": F.coalesce(F.col("priority").isin("high", "urgent"), F.lit(False)),
            "resolved_same_day": F.coalesce(day("created_at") == day("resolved_at"), F.lit(False)),
            "has_macro": F.col("macro_sequence") != "",
        }
    )


def clean_macros(macros: DataFrame) -> DataFrame:
    present = set(macros.columns)
    changes = {c: _timestamp(macros, c) for c in ("created_at", "updated_at") if c in present}
    changes |= {c: F.col(c).cast("boolean") for c in ("is_active", "is_internal_only") if c in present}
    changes |= {c: strip(c) for c in ("macro_name", "macro_body")}
    return macros.withColumns(changes)


def clean_usage(usage: DataFrame) -> DataFrame:
    return usage.withColumns(
        {
            "applied_at": _timestamp(usage, "applied_at"),
            "position_in_thread": col("position_in_thread").cast("int"),
        }
    )


def referential_filter(usage: DataFrame, tickets: DataFrame, macros: DataFrame) -> DataFrame:
    """Uses whose ticket and macro both exist."""
    return usage.join(tickets.select("ticket_id"), "ticket_id", "left_semi").join(
        macros.select("macro_id"), "macro_id", "left_semi"
    )


def stage_counts(tickets: DataFrame, macros: DataFrame, usage: DataFrame) -> DataFrame:
    """Rows per cleaned table, and uses dropped by the referential filter."""
    kept = referential_filter(usage, tickets, macros)

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")

    counted = rows(tickets, "tickets").unionByName(rows(macros, "macros"))
    counted = counted.unionByName(rows(usage, "macro_usage")).unionByName(rows(kept, "macro_usage_valid"))
    before = F.max(F.when(F.col("table_name") == "macro_usage", F.col("n_rows")))
    after = F.max(F.when(F.col("table_name") == "macro_usage_valid", F.col("n_rows")))
    removed = counted.agg((before - after).alias("n_rows")).select(
        F.lit("macro_usage_removed").alias("table_name"), "n_rows"
    )
    return counted.unionByName(removed)
