"""Baselines, macro scores, categories and score listings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.functions.columns import effectiveness_level, fixed, normalize_score, rate, with_scalar
from replyscope.operators.ranking import average_ranks, grouped_quantile
from replyscope.schemas import MIN_USAGE_FOR_SCORING, WEIGHT_CSAT, WEIGHT_HANDLE_TIME, WEIGHT_REOPEN


def _baseline_columns():
    return [
        F.avg("csat_score").alias("avg_csat"),
        F.avg("total_handle_time_minutes").alias("avg_handle_time"),
        rate(F.col("reopens_count") > 0).alias("reopen_rate"),
    ]


def baseline_overall(tickets: DataFrame) -> DataFrame:
    return tickets.agg(*_baseline_columns())


def baseline_by_driver(tickets: DataFrame) -> DataFrame:
    known = tickets.where(F.col("contact_driver").isNotNull())
    return known.groupBy("contact_driver").agg(*_baseline_columns())


def macro_index(features: DataFrame, baseline: DataFrame) -> DataFrame:
    """Lifts against the overall baseline, three 0..100 components and the weighted index.

    Component ranges run over all macros, unused ones included. A macro with too few uses has
    neutral components and index 0. Limits and baseline are scalar subqueries: no join.
    """
    limits = features.agg(
        F.min("avg_csat").alias("c0"), F.max("avg_csat").alias("c1"),
        F.min("avg_handle_time").alias("h0"), F.max("avg_handle_time").alias("h1"),
        F.min("reopen_rate").alias("r0"), F.max("reopen_rate").alias("r1"),
    )
    df = with_scalar(with_scalar(features, limits, "_l"), baseline, "_b")
    enough = F.col("usage_count") >= MIN_USAGE_FOR_SCORING

    def component(value: str, low: str, high: str, reverse: bool):
        return F.when(enough, normalize_score(value, f"_l.{low}", f"_l.{high}", reverse)).otherwise(50.0)

    weighted = (
        WEIGHT_CSAT * F.col("csat_component")
        + WEIGHT_HANDLE_TIME * F.col("handle_time_component")
        + WEIGHT_REOPEN * F.col("reopen_component")
    )
    return (
        df.withColumns(
            {
                "has_sufficient_usage": enough,
                "csat_lift": F.col("avg_csat") - F.col("_b.avg_csat"),
                "handle_time_delta": F.col("_b.avg_handle_time") - F.col("avg_handle_time"),
                "reopen_rate_delta": F.col("_b.reopen_rate") - F.col("reopen_rate"),
                "csat_component": component("avg_csat", "c0", "c1", False),
                "handle_time_component": component("avg_handle_time", "h0", "h1", True),
                "reopen_component": component("reopen_rate", "r0", "r1", True),
            }
        )
        # Nine places: float noise must not break ties of the later rank.
        .withColumn(
            "macro_effectiveness_index",
            F.when(F.col("has_sufficient_usage"), fixed(weighted, 9)).otherwise(0.0),
        )
        .withColumn("effectiveness_level", effectiveness_level("macro_effectiveness_index"))
        .drop("_l", "_b")
    )


def macro_scores(features: DataFrame, baseline: DataFrame) -> DataFrame:
    """Index plus its average-tie percentile over all macros."""
    return add_percentile(macro_index(features, baseline))


def add_percentile(indexed: DataFrame) -> DataFrame:
    c = "macro_effectiveness_index"
    ranked = average_ranks(indexed, "macro_id", [c])
    return ranked.withColumn("effectiveness_percentile", F.col(f"{c}_rank_pct") * 100.0).drop(
        f"{c}_rank_asc", f"{c}_rank_desc", f"{c}_rank_pct"
    )


def categorize_macros(scores: DataFrame) -> DataFrame:
    popular = grouped_quantile(scores, [], "usage_count", 0.75, "q75")
    pct = F.col("effectiveness_percentile")
    top = F.when(F.col("usage_count") >= F.col("_q.q75"), "High Impact (Popular)").otherwise("Underused Gem")
    label = (
        F.when(~F.col("has_sufficient_usage"), "Unused/Low Usage")
        .when(pct >= 75, top)
        .when(pct >= 50, "Moderate Effectiveness")
        .when(pct >= 25, "Below Average")
        .otherwise("Low Effectiveness")
    )
    return with_scalar(scores, popular, "_q").withColumn("macro_category", label).drop("_q")


def category_counts(categorized: DataFrame) -> DataFrame:
    return (
        categorized.groupBy("macro_category")
        .agg(F.count(F.lit(1)).alias("n_macros"))
        .orderBy(F.desc("n_macros"), "macro_category")
    )


def top_macros(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("macro_effectiveness_index"), "macro_id").limit(n)


def bottom_macros(scores: DataFrame, n: int = 10, scored_only: bool = True) -> DataFrame:
    df = scores.where("has_sufficient_usage") if scored_only else scores
    issue = F.when(F.col("usage_count") < 10, "Low usage").otherwise("Poor performance")
    return df.withColumn("issue", issue).orderBy("macro_effectiveness_index", "macro_id").limit(n)


def underused_gems(categorized: DataFrame, n: int = 10) -> DataFrame:
    return top_macros(categorized.where(F.col("macro_category") == "Underused Gem"), n)


def low_effectiveness(scores: DataFrame, threshold: float = 25.0) -> DataFrame:
    low = scores.where((F.col("macro_effectiveness_index") < threshold) & F.col("has_sufficient_usage"))
    return low.orderBy("macro_effectiveness_index", "macro_id")


def unused_macros(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("usage_count") == 0)
