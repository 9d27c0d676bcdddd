"""Constraint checks: column presence, table rules, row rules, keys and an audit row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.functions.columns import count_where
from replyscope.schemas import (
    CHANNELS,
    CSAT_MAX,
    CSAT_MIN,
    MACRO_CATEGORIES,
    PRIORITIES,
    REQUIRED_MACRO_COLUMNS,
    REQUIRED_TICKET_COLUMNS,
    REQUIRED_USAGE_COLUMNS,
    STATUSES,
)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def check_columns(df: DataFrame, required: list[str], name: str = "DataFrame") -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{name} is missing required columns: {missing}")


def _as_checks(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """One pass over the table, one output row per check."""
    one = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in sums.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n_bad")) for k in sums])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def _duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, unknown keys included."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_bad"))
        .select(F.lit(f"duplicate_{key}").alias("check"), "n_bad")
    )


def _missing(df: DataFrame, required: list[str]) -> DataFrame:
    n = len(missing_columns(df, required))
    one = df.agg(F.lit(n).cast("long").alias("n_bad"))
    return one.select(F.lit("missing_columns").alias("check"), "n_bad")


def _table_check(df: DataFrame, required: list[str], key: str | None, rules: dict[str, tuple[str, Column]]):
    """Rules whose column is absent are skipped; the absence itself is reported."""
    out = _missing(df, required)
    if key and key in df.columns:
        out = out.unionByName(_duplicates(df, key))
    usable = {k: count_where(rule) for k, (column, rule) in rules.items() if column in df.columns}
    return out.unionByName(_as_checks(df, usable)) if usable else out


def check_tickets(tickets: DataFrame) -> DataFrame:
    outside = (F.col("csat_score") < CSAT_MIN) | (F.col("csat_score") > CSAT_MAX)
    return _table_check(
        tickets,
        REQUIRED_TICKET_COLUMNS,
        "ticket_id",
        {
            "csat_out_of_range": ("csat_score", outside),
            "negative_handle_time": (
                "total_handle_time_minutes", F.col("total_handle_time_minutes") < 0,
            ),
        },
    )


def check_macros(macros: DataFrame) -> DataFrame:
    empty = F.col("macro_body").isNull() | (F.col("macro_body") == "")
    return _table_check(
        macros, REQUIRED_MACRO_COLUMNS, "macro_id", {"empty_macro_body": ("macro_body", empty)}
    )


def check_usage(usage: DataFrame) -> DataFrame:
    return _table_check(
        usage,
        REQUIRED_USAGE_COLUMNS,
        None,
        {"position_below_one": ("position_in_thread", F.col("position_in_thread") < 1)},
    )


def row_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations`` (array of broken rule names) and ``is_valid``; unknown breaks no rule."""
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("violations", broken).withColumn("is_valid", F.size("violations") == 0)


def _required(*columns: str) -> dict[str, Column]:
    return {f"{c}_missing": F.col(c).isNull() for c in columns}


def _present(df: DataFrame, *columns: str) -> list[str]:
    """The columns that the table has; absent ones are told by the table checks."""
    return [c for c in columns if c in df.columns]


def _at_least(bound: float, *columns: str) -> dict[str, Column]:
    return {f"{c}_below_{bound:g}": F.col(c) < bound for c in columns}


def _between(low: float, high: float, *columns: str) -> dict[str, Column]:
    return {f"{c}_out_of_range": (F.col(c) < low) | (F.col(c) > high) for c in columns}


def check_ticket_rows(tickets: DataFrame) -> DataFrame:
    """Enumerations are lower-cased before the membership test and returned that way."""
    enums = {"status": STATUSES, "priority": PRIORITIES, "channel": CHANNELS}
    df = tickets.withColumns({c: F.lower(c) for c in enums})
    language = F.coalesce(F.col("language"), F.lit("en")) if "language" in df.columns else F.lit("en")
    df = df.withColumn("language", language)
    numbers = [
        c
        for c in (
            "first_response_time_minutes", "total_handle_time_minutes", "replies_count",
            "reopens_count", "num_macros_used",
        )
        if c in df.columns
    ]
    rules = _required(
        "ticket_id", "created_at", "status", "channel", "priority", "contact_driver", "agent_id"
    )
    rules |= _required(*[c for c in numbers if c != "num_macros_used"])
    rules |= {f"{c}_not_allowed": ~F.col(c).isin(values) for c, values in enums.items()}
    rules |= _at_least(0, *numbers) | _between(CSAT_MIN, CSAT_MAX, "csat_score")
    return row_violations(df, rules)


def check_macro_rows(macros: DataFrame, categories: list[str] | None = None) -> DataFrame:
    allowed = MACRO_CATEGORIES if categories is None else categories
    defaults = {"is_active": True, "is_internal_only": False}
    df = macros.withColumn("category", F.lower("category")).withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v)) if c in macros.columns else F.lit(v)
            for c, v in defaults.items()
        }
    )
    rules = _required("macro_id", "macro_name", "category", "macro_body")
    rules |= _required(*_present(df, "created_at", "updated_at", "owner_team"))
    rules |= {
        "category_not_allowed": ~F.col("category").isin(allowed),
        "macro_name_empty": F.col("macro_name") == "",
        "macro_body_empty": F.col("macro_body") == "",
    }
    return row_violations(df, rules)


def check_usage_rows(usage: DataFrame) -> DataFrame:
    rules = _required("ticket_id", "macro_id", "applied_at", "position_in_thread", *_present(usage, "agent_id", "channel"))
    return row_violations(usage, rules | _at_least(1, "position_in_thread"))


def check_score_rows(scores: DataFrame) -> DataFrame:
    rules = _required("macro_id", "usage_count", "macro_effectiveness_index")
    rules |= _required(*_present(
        scores, "macro_name", "category", "avg_csat", "avg_handle_time", "reopen_rate", "csat_component",
        "handle_time_component", "reopen_component", "macro_category", "has_sufficient_usage",
    ))
    rules |= _at_least(0, "usage_count", "avg_handle_time")
    rules |= _between(0, 5, "avg_csat") | _between(0, 1, "reopen_rate")
    rules |= _between(
        0, 100, "csat_component", "handle_time_component", "reopen_component",
        "macro_effectiveness_index", "effectiveness_percentile",
    )
    return row_violations(scores, rules)


def check_cluster_rows(summary: DataFrame) -> DataFrame:
    numbers = ("num_macros", "total_usage", "num_underused_gems", "num_low_effectiveness")
    effectiveness = ("avg_effectiveness", "median_effectiveness")
    usage = _present(summary, "avg_usage")
    rules = _required("cluster_id", "cluster_label", *numbers, *effectiveness, *usage)
    rules |= _required(*_present(summary, "consolidation_candidate"))
    rules |= _at_least(0, "cluster_id", *numbers, *usage) | _between(0, 100, *effectiveness)
    return row_violations(summary, rules)


def data_audit(tickets: DataFrame, macros: DataFrame, usage: DataFrame) -> DataFrame:
    """One row: table sizes, unknown ratings, identity of ticket keys, negative times."""
    counts = {
        name: df.agg(F.count(F.lit(1)).alias("n")).scalar() for name, df in
        (("n_macros", macros), ("n_uses", usage))
    }
    one = tickets.agg(
        F.count(F.lit(1)).alias("n_tickets"),
        F.count_if(F.col("csat_score").isNull()).alias("null_csat"),
        (F.count("ticket_id") == F.countDistinct("ticket_id")).alias("unique_ticket_ids"),
        count_where(F.col("total_handle_time_minutes") < 0).alias("negative_times"),
    )
    return one.withColumns(counts)


def check_keys(tickets: DataFrame, macros: DataFrame, usage: DataFrame) -> DataFrame:
    """Primary keys, foreign keys, value checks and not-null rules as (constraint, n_bad)."""

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("constraint"), F.col("n_bad"))

    def primary(df: DataFrame, key: str, name: str) -> DataFrame:
        bad = F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1))
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return named(counts.agg(F.coalesce(bad, F.lit(0)).cast("long").alias("n_bad")), name)

    def foreign(parent: DataFrame, key: str, name: str) -> DataFrame:
        orphans = usage.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
        return named(orphans.agg(F.count(F.lit(1)).alias("n_bad")), name)

    rules = {
        "tickets": (tickets, {
            "ticket_csat_range": ~F.col("csat_score").between(CSAT_MIN, CSAT_MAX),
            "ticket_created_at_not_null": F.col("created_at").isNull(),
        }),
        "macros": (macros, {
            "macro_name_not_null": F.col("macro_name").isNull(),
            "macro_category_not_null": F.col("category").isNull(),
        }),
        "usage": (usage, {
            "usage_ticket_not_null": F.col("ticket_id").isNull(),
            "usage_macro_not_null": F.col("macro_id").isNull(),
        }),
    }
    out = primary(tickets, "ticket_id", "ticket_primary_key")
    out = out.unionByName(primary(macros, "macro_id", "macro_primary_key"))
    out = out.unionByName(foreign(tickets, "ticket_id", "usage_ticket_foreign_key"))
    out = out.unionByName(foreign(macros, "macro_id", "usage_macro_foreign_key"))
    for df, checks in rules.values():
        counted = _as_checks(df, {k: count_where(rule) for k, rule in checks.items()})
        out = out.unionByName(counted.withColumnRenamed("check", "constraint"))
    return out
