"""Agent metrics, macro choice per agent and recommendations for all agents at once."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.columns import count_where, rate, safe_divide, with_scalar
from replyscope.operators.features import usage_outcomes
from replyscope.operators.ranking import average_ranks, grouped_quantile, number_rows
from replyscope.sources.tables import stage


def agent_metrics(ticket_features: DataFrame, median: bool = True) -> DataFrame:
    known = ticket_features.where(F.col("agent_id").isNotNull())
    metrics = known.groupBy("agent_id").agg(
        F.count("ticket_id").alias("total_tickets"),
        F.avg("csat_score").alias("avg_csat"),
        F.avg("total_handle_time_minutes").alias("avg_handle_time"),
        rate(F.col("reopens_count") > 0).alias("reopen_rate"),
        F.avg("first_response_time_minutes").alias("avg_first_response_time"),
        rate(F.col("status") == "solved").alias("resolution_rate"),
        count_where(F.col("num_macros_used") > 0).alias("tickets_with_macros"),
        F.avg("num_macros_used").alias("avg_macros_per_ticket"),
    )
    if median:
        medians = grouped_quantile(
            known, ["agent_id"], "total_handle_time_minutes", 0.5, "median_handle_time", source=known
        )
        metrics = metrics.join(medians, "agent_id", "left")
    ranked = average_ranks(
        metrics, "agent_id", ["avg_csat", "avg_handle_time", "reopen_rate", "resolution_rate"]
    )
    score = (
        0.4 * F.col("avg_csat_rank_pct")
        + 0.3 * (1 - F.col("avg_handle_time_rank_pct"))
        + 0.2 * (1 - F.col("reopen_rate_rank_pct"))
        + 0.1 * F.col("resolution_rate_rank_pct")
    ) * 100.0
    keep = [
        *metrics.columns,
        safe_divide("tickets_with_macros", "total_tickets").alias("macro_adoption_rate"),
        F.col("avg_csat_rank_desc").alias("csat_rank"),
        F.col("avg_handle_time_rank_asc").alias("handle_time_rank"),
        score.alias("agent_effectiveness_score"),
    ]
    return ranked.select(*keep)


def agent_macro_usage(tickets: DataFrame, usage: DataFrame, scores: DataFrame) -> DataFrame:
    """Uses and outcomes per agent and macro, with the macro's name, category and index."""
    outcomes = usage_outcomes(usage, tickets)
    grouped = (
        outcomes.where(F.col("agent_id").isNotNull())
        .groupBy("agent_id", "macro_id")
        .agg(
            F.count("ticket_id").alias("usage_count"),
            F.avg("csat_score").alias("avg_csat_with_macro"),
            F.avg("total_handle_time_minutes").alias("avg_handle_time_with_macro"),
            rate(F.col("reopens_count") > 0).alias("reopen_rate_with_macro"),
        )
    )
    info = scores.select("macro_id", "macro_name", "category", "macro_effectiveness_index")
    return grouped.join(info, "macro_id", "left")


def agent_usage_metrics(usage: DataFrame, tickets: DataFrame) -> DataFrame:
    """The same agents seen from their uses (agent taken from the use)."""
    outcomes = tickets.select("ticket_id", "csat_score", "total_handle_time_minutes", "reopens_count")
    joined = usage.where(F.col("agent_id").isNotNull()).join(outcomes, "ticket_id", "left")
    return (
        joined.groupBy("agent_id")
        .agg(
            F.countDistinct("ticket_id").alias("total_tickets"),
            F.count("macro_id").alias("total_macro_uses"),
            F.countDistinct("macro_id").alias("unique_macros_used"),
            F.avg("csat_score").alias("avg_csat"),
            F.avg("total_handle_time_minutes").alias("avg_handle_time"),
            rate(F.col("reopens_count") > 0).alias("reopen_rate"),
        )
        .withColumns(
            {
                "macros_per_ticket": safe_divide("total_macro_uses", "total_tickets"),
                "macro_diversity": safe_divide("unique_macros_used", "total_macro_uses"),
            }
        )
    )


def agent_selection(metrics: DataFrame, macro_usage: DataFrame) -> DataFrame:
    """Metrics with the unweighted mean index of the macros each agent uses."""
    choice = macro_usage.groupBy("agent_id").agg(
        F.avg("macro_effectiveness_index").alias("avg_macro_effectiveness"),
        F.count("macro_id").alias("unique_macros_used"),
        F.sum("usage_count").alias("total_macro_uses"),
    )
    return metrics.join(choice, "agent_id", "left")


def agent_correlation(selection: DataFrame) -> DataFrame:
    return selection.agg(
        F.corr("avg_macro_effectiveness", "agent_effectiveness_score").alias("macro_selection_correlation")
    )


def top_agents(selection: DataFrame, by: str = "agent_effectiveness_score", n: int = 10) -> DataFrame:
    return selection.where(F.col(by).isNotNull()).orderBy(F.desc(by), "agent_id").limit(n)


def agent_top_insight(usage_metrics: DataFrame, quantile: float = 0.8) -> DataFrame:
    """Distinct macros of agents above the rating quantile against all agents."""
    cut = grouped_quantile(usage_metrics, [], "avg_csat", quantile, "cut")
    top = F.col("avg_csat") > F.col("_c.cut")
    one = with_scalar(usage_metrics, cut, "_c").agg(
        F.max("_c.cut").alias("csat_cut"),
        F.avg(F.when(top, F.col("unique_macros_used"))).alias("top_avg_unique_macros"),
        F.avg("unique_macros_used").alias("all_avg_unique_macros"),
    )
    return one.withColumn("difference", F.col("top_avg_unique_macros") - F.col("all_avg_unique_macros"))


def agent_recommendations(
    agents: DataFrame, used: DataFrame, scores: DataFrame, n: int = 5, min_index: float = 70.0
) -> DataFrame:
    """Best ``n`` good macros each agent does not use yet.

    Good macros are numbered 1..G by index. An agent's free numbers are the gaps between the numbers
    it uses, and only the first n free ones matter, so each gap contributes at most n numbers: the work
    is (uses of good macros + n per agent), never agents times macros.
    """
    good = scores.where((F.col("macro_effectiveness_index") >= min_index) & F.col("has_sufficient_usage"))
    good = good.select("macro_id", "macro_name", "category", "macro_effectiveness_index", "usage_count")
    numbered = stage(number_rows(good, "macro_effectiveness_index", "macro_id", "_k"))
    known = agents.select("agent_id").where(F.col("agent_id").isNotNull()).distinct()
    taken = (
        used.select("agent_id", "macro_id").distinct().join(numbered.select("macro_id", "_k"), "macro_id")
        .select("agent_id", "_k")
    )
    order = Window.partitionBy("agent_id").orderBy("_k")
    # Before the i-th taken number k lie k - i free ones; a gap starts after the previous taken number.
    gaps = taken.withColumns(
        {"_from": F.coalesce(F.lag("_k").over(order), F.lit(0)) + 1, "_i": F.row_number().over(order)}
    ).select("agent_id", "_from", (F.col("_k") - 1).alias("_to"), (F.col("_from") - F.col("_i")).alias("_free"))
    tail = known.join(
        taken.groupBy("agent_id").agg(F.max("_k").alias("_last"), F.count(F.lit(1)).alias("_c")),
        "agent_id", "left",
    ).select(
        "agent_id",
        (F.coalesce("_last", F.lit(0)) + 1).alias("_from"),
        (F.coalesce("_last", F.lit(0)) + n).alias("_to"),
        (F.coalesce("_last", F.lit(0)) - F.coalesce("_c", F.lit(0))).alias("_free"),
    )
    open_gaps = gaps.unionByName(tail).where((F.col("_free") < n) & (F.col("_from") <= F.col("_to")))
    end = F.least(F.col("_to"), F.col("_from") + F.lit(n) - F.col("_free") - 1)
    wanted = open_gaps.select(
        "agent_id", F.col("_from"), F.col("_free"), F.explode(F.sequence("_from", end)).alias("_k")
    ).select("agent_id", "_k", (F.col("_free") + F.col("_k") - F.col("_from") + 1).alias("rank"))
    return wanted.join(numbered, "_k").drop("_k")
