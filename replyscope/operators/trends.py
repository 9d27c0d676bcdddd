"""Daily and weekly series, trend direction and anomaly flags."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.columns import count_where, day, rate, safe_divide, week_label, with_scalar


def daily_metrics(ticket_features: DataFrame) -> DataFrame:
    """One row per day present, with means over the last seven rows.

    The window runs over the daily aggregate, whose size is the number of days, not of tickets.
    """
    daily = (
        ticket_features.where(F.col("created_at").isNotNull())
        .groupBy(day("created_at").alias("date"))
        .agg(
            F.count("ticket_id").alias("total_tickets"),
            F.avg("csat_score").alias("avg_csat"),
            F.avg("total_handle_time_minutes").alias("avg_handle_time"),
            count_where(F.col("num_macros_used") > 0).alias("tickets_with_macros"),
            F.sum("num_macros_used").alias("total_macros_used"),
            rate(F.col("reopens_count") > 0).alias("reopen_rate"),
        )
        .withColumns(
            {
                "macro_adoption_rate": safe_divide("tickets_with_macros", "total_tickets"),
                "macros_per_ticket": safe_divide("total_macros_used", "total_tickets"),
            }
        )
    )
    return rolling(daily)


def rolling(daily: DataFrame, days: int = 7) -> DataFrame:
    last = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(-(days - 1), 0)
    return daily.withColumns(
        {
            f"csat_{days}d_avg": F.avg("avg_csat").over(last),
            f"handle_time_{days}d_avg": F.avg("avg_handle_time").over(last),
            f"macro_adoption_{days}d_avg": F.avg("macro_adoption_rate").over(last),
        }
    )


def anomaly_flags(daily: DataFrame, std_threshold: float = 2.0) -> DataFrame:
    """Days outside mean +/- k standard deviations in any of three metrics; unknown is no anomaly."""
    columns = ["avg_csat", "avg_handle_time", "macro_adoption_rate"]
    stats = daily.agg(
        *[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_samp(c).alias(f"{c}_s") for c in columns]
    )
    flags = {}
    for c in columns:
        spread = std_threshold * F.col(f"_s.{c}_s")
        mean = F.col(f"_s.{c}_m")
        outside = (F.col(c) < mean - spread) | (F.col(c) > mean + spread)
        flags[f"{c}_anomaly"] = F.coalesce(outside, F.lit(False))
    flagged = with_scalar(daily, stats).withColumns(flags).drop("_s")
    any_flag = F.col(f"{columns[0]}_anomaly") | F.col(f"{columns[1]}_anomaly") | F.col(f"{columns[2]}_anomaly")
    return flagged.withColumn("any_anomaly", any_flag)


def weekly_macro_usage(usage: DataFrame) -> DataFrame:
    """Uses per week and macro, grouped by the Monday; the label is written once per group."""
    monday = F.to_date(F.date_trunc("week", "applied_at"))
    counted = usage.groupBy(monday.alias("_m"), "macro_id").agg(F.count("ticket_id").alias("usage_count"))
    return counted.select(week_label("_m").alias("week"), "macro_id", "usage_count")


def category_trends(usage: DataFrame, macros: DataFrame) -> DataFrame:
    """Uses and distinct macros per week and category.

    Uses are first counted per week and macro, so only that small table meets the macro names, and the
    number of its rows per category is the distinct macro count.
    """
    weekly = weekly_macro_usage(usage).where(F.col("week").isNotNull())
    known = macros.select("macro_id", "category").where(F.col("category").isNotNull())
    return weekly.join(known, "macro_id").groupBy("week", "category").agg(
        F.sum("usage_count").alias("usage_count"), F.count("macro_id").alias("unique_macros")
    )


def usage_trend(usage: DataFrame, scores: DataFrame, weeks: list[str] | None = None) -> DataFrame:
    """Last two observed weeks against the two before, per used macro; optional wide week columns."""
    weekly = weekly_macro_usage(usage).where(F.col("week").isNotNull())
    # Read from the dates alone: the weekly counts need not be computed twice.
    mondays = usage.select(F.to_date(F.date_trunc("week", "applied_at")).alias("_m")).where(F.col("_m").isNotNull())
    observed = mondays.distinct().orderBy(F.desc("_m")).limit(4).select(week_label("_m").alias("week"))
    recent = F.col("_w.weeks")
    four = observed.agg(F.sort_array(F.collect_list("week"), asc=False).alias("weeks"))
    marked = with_scalar(weekly, four, "_w")
    newest = F.array_position(recent, F.col("week"))
    amount = F.col("usage_count")
    aggs = [
        F.sum(amount).alias("total_uses"),
        F.sum(F.when(newest.between(1, 2), amount).otherwise(0)).alias("recent_uses"),
        F.sum(F.when(newest.between(3, 4), amount).otherwise(0)).alias("previous_uses"),
        F.max(F.size(recent)).alias("_n"),
    ]
    aggs += [F.sum(F.when(F.col("week") == w, amount).otherwise(0)).alias(w) for w in weeks or []]
    change = F.when(
        F.col("_n") >= 4,
        (F.col("recent_uses") - F.col("previous_uses")) / (F.col("previous_uses") + 1.0),
    ).otherwise(0.0)
    direction = (
        F.when(F.col("trend") > 0.1, "Rising").when(F.col("trend") < -0.1, "Declining").otherwise("Stable")
    )
    info = scores.select("macro_id", "macro_name", "category", "macro_effectiveness_index")
    return (
        marked.groupBy("macro_id").agg(*aggs)
        .withColumn("trend", change)
        .withColumn("trend_direction", direction)
        .drop("_n")
        .join(info, "macro_id", "left")
    )
