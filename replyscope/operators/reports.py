"""Dashboard, notebook and export summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.functions.columns import clamped_bin, fixed, rate, with_scalar
from replyscope.operators.recommend import action_items_export
from replyscope.operators.scoring import bottom_macros, top_macros


def macro_impact(ticket_features: DataFrame) -> DataFrame:
    """Outcomes with and without macros, rounded, and the used-minus-manual difference on both rows."""
    outcomes = {
        "avg_csat": F.avg("csat_score"),
        "avg_handle_time": F.avg("total_handle_time_minutes"),
        "reopen_rate": rate(F.col("reopens_count") > 0),
    }
    grouped = ticket_features.groupBy("is_macro_used").agg(
        F.count("ticket_id").alias("tickets"), *[e.alias(c) for c, e in outcomes.items()]
    )
    deltas = grouped.agg(
        *[
            (F.max(F.when(F.col("is_macro_used"), F.col(c)))
             - F.max(F.when(~F.col("is_macro_used"), F.col(c)))).alias(f"{c}_delta")
            for c in outcomes
        ]
    )
    both = with_scalar(grouped, deltas, "_d")
    return both.select(
        "is_macro_used", "tickets", *[fixed(c, 2).alias(c) for c in outcomes],
        *[fixed(f"_d.{c}_delta", 2).alias(f"{c}_delta") for c in outcomes],
    )


def driver_volume(tickets: DataFrame) -> DataFrame:
    known = tickets.where(F.col("contact_driver").isNotNull())
    counts = known.groupBy("contact_driver").agg(F.count(F.lit(1)).alias("n_tickets"))
    return counts.orderBy(F.desc("n_tickets"), "contact_driver")


def category_perf(scores: DataFrame) -> DataFrame:
    scored = scores.where(F.col("has_sufficient_usage") & F.col("category").isNotNull())
    return (
        scored.groupBy("category")
        .agg(
            fixed(F.avg("macro_effectiveness_index"), 1).alias("avg_effectiveness"),
            F.sum("usage_count").alias("total_usage"),
            F.count("macro_id").alias("macro_count"),
        )
        .orderBy(F.desc("avg_effectiveness"), "category")
    )


def category_stats(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("category").isNotNull()).groupBy("category").agg(
        F.count("macro_id").alias("macro_count"),
        F.avg("macro_effectiveness_index").alias("avg_effectiveness"),
        F.sum("usage_count").alias("total_usage"),
    )


def ticket_summary(ticket_features: DataFrame) -> DataFrame:
    known = ticket_features.where(F.col("contact_driver").isNotNull())
    return known.groupBy(F.col("contact_driver").alias("ticket_type")).agg(
        F.count("ticket_id").alias("n_tickets"),
        F.avg("csat_score").alias("avg_csat"),
        F.avg("total_handle_time_minutes").alias("avg_handle_time"),
        F.avg("num_macros_used").alias("avg_macros_used"),
    )


def kpi_overview(scores: DataFrame, tickets: DataFrame) -> DataFrame:
    of_tickets = tickets.agg(F.count("ticket_id").alias("n"), F.avg("csat_score").alias("c"))
    one = scores.agg(
        F.count(F.lit(1)).alias("total_macros"),
        F.try_divide(F.count_if(F.col("usage_count") == 0) * 100.0, F.count(F.lit(1))).alias("unused_pct"),
        F.avg("macro_effectiveness_index").alias("avg_effectiveness"),
        F.max("macro_effectiveness_index").alias("max_effectiveness"),
        F.sum("usage_count").alias("total_uses"),
        F.countDistinct("category").alias("categories"),
    )
    return with_scalar(one, of_tickets, "_t").select(
        *one.columns, F.col("_t.n").alias("total_tickets"), F.col("_t.c").alias("avg_csat")
    )


def report_totals(scores: DataFrame, tickets: DataFrame) -> DataFrame:
    n = tickets.agg(F.count(F.lit(1)).alias("n")).scalar()
    return scores.agg(
        F.count(F.lit(1)).alias("total_macros"),
        F.avg("macro_effectiveness_index").alias("avg_effectiveness"),
        F.sum("usage_count").alias("total_uses"),
    ).withColumn("total_tickets", n)


def tier_counts(scores: DataFrame) -> DataFrame:
    """Macros and their share of all macros per effectiveness level."""
    n = scores.agg(F.count(F.lit(1)).alias("n")).scalar()
    known = scores.where(F.col("effectiveness_level").isNotNull())
    counts = known.groupBy("effectiveness_level").agg(F.count(F.lit(1)).alias("n_macros"))
    return counts.withColumn("pct", F.try_divide(F.col("n_macros") * 100.0, n))


def tier_summary(scores: DataFrame, redundant: DataFrame) -> DataFrame:
    pairs = redundant.agg(F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("n")).scalar()
    return scores.agg(
        F.count_if(F.col("effectiveness_level") == "High").alias("high"),
        F.count_if(F.col("effectiveness_level") == "Low").alias("low"),
        F.count_if(F.col("usage_count") == 0).alias("unused"),
    ).withColumn("redundant_pairs", pairs)


def crosstab_heatmap(scores: DataFrame) -> DataFrame:
    known = scores.where(F.col("category").isNotNull())
    levels = ["Low", "Medium", "High"]
    wide = known.groupBy("category").pivot("effectiveness_level", levels).agg(F.count(F.lit(1)))
    return wide.na.fill(0).select("category", *[F.col(v).alias(v.lower()) for v in levels])


def rollup_hierarchy(scores: DataFrame, cluster: str = "cluster_label") -> DataFrame:
    """Uses and use-weighted mean index at each level of category > cluster > level, and overall."""
    scored = scores.where("has_sufficient_usage").select(
        "category", F.col(cluster).alias("cluster_label"), "effectiveness_level", "usage_count",
        (F.col("usage_count") * F.col("macro_effectiveness_index")).alias("_w"),
    )
    depth = F.grouping_id()
    return scored.rollup("category", "cluster_label", "effectiveness_level").agg(
        depth.cast("int").alias("grouping_id"),
        F.sum("usage_count").alias("total_usage"),
        F.try_divide(F.sum("_w"), F.sum("usage_count")).alias("weighted_effectiveness"),
    ).withColumns(
        {
            "category": F.when(F.col("grouping_id") >= 7, "(all)").otherwise(F.col("category")),
            "cluster_label": F.when(F.col("grouping_id") >= 3, "(all)").otherwise(F.col("cluster_label")),
            "effectiveness_level": F.when(F.col("grouping_id") >= 1, "(all)").otherwise(
                F.col("effectiveness_level")
            ),
        }
    )


def treemap_cluster(scores: DataFrame, cluster: str = "cluster_label") -> DataFrame:
    weighted = F.sum(F.col("usage_count") * F.col("macro_effectiveness_index"))
    return scores.where("has_sufficient_usage").groupBy(F.col(cluster).alias("cluster_label")).agg(
        F.sum("usage_count").alias("total_usage"),
        F.try_divide(weighted, F.sum("usage_count")).alias("weighted_effectiveness"),
    )


def histogram_index(scores: DataFrame, bins: int = 20) -> DataFrame:
    scored = scores.where("has_sufficient_usage").select("macro_effectiveness_index")
    span = scored.agg(F.min("macro_effectiveness_index").alias("lo"), F.max("macro_effectiveness_index").alias("hi"))
    bin_no = clamped_bin("macro_effectiveness_index", "_s.lo", "_s.hi", bins)
    return with_scalar(scored, span).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n_macros"))


def cluster_display(cluster_summary: DataFrame) -> DataFrame:
    return cluster_summary.select(
        "cluster_id", "cluster_label", "num_macros", "total_usage", "avg_effectiveness",
        "consolidation_candidate",
    ).orderBy(F.desc("avg_effectiveness"), "cluster_id")


def consolidation_candidates(cluster_summary: DataFrame) -> DataFrame:
    return cluster_summary.where("consolidation_candidate")


def consolidation_review(cluster_summary: DataFrame, min_macros: int, below: float) -> DataFrame:
    """Clusters of enough macros whose mean effectiveness is below a bar of the caller's."""
    return cluster_summary.where((F.col("num_macros") >= min_macros) & (F.col("avg_effectiveness") < below))


def macro_summary(scores: DataFrame) -> DataFrame:
    columns = ["macro_id", "macro_name", "category", "cluster_label", "macro_effectiveness_index",
               "usage_count", "effectiveness_level", "has_sufficient_usage"]
    return scores.select(*[c for c in columns if c in scores.columns])


def export_bundle(
    scores: DataFrame,
    ticket_features: DataFrame,
    daily: DataFrame | None = None,
    comparisons: DataFrame | None = None,
    agents: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The tables of the export workbook, by name."""
    summary = macro_summary(scores)
    tables = {
        "macro_summary": summary.drop("has_sufficient_usage"),
        "top_performers": top_macros(summary, 20).drop("has_sufficient_usage"),
        "needs_improvement": bottom_macros(summary, 20, scored_only=False).drop("has_sufficient_usage", "issue"),
        "ticket_summary": ticket_summary(ticket_features),
        "category_stats": category_stats(scores),
    }
    optional = {"daily_metrics": daily, "comparisons": comparisons, "agent_performance": agents}
    return tables | {k: v for k, v in optional.items() if v is not None}


def csv_exports(scores: DataFrame) -> dict[str, DataFrame]:
    return {
        "full": scores,
        "by_category": category_stats(scores),
        "action_items": action_items_export(scores),
    }
