"""Recommendation rules, affinity tables and report counts over scored macros."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.columns import scalar, with_scalar
from replyscope.operators.features import usage_outcomes
from replyscope.operators.ranking import grouped_quantile
from replyscope.schemas import MIN_USAGE_FOR_SCORING


def quick_wins(scores: DataFrame, min_index: float = 70.0) -> DataFrame:
    """Macros above an index with fewer uses than the median macro."""
    middle = grouped_quantile(scores, [], "usage_count", 0.5, "middle")
    wins = with_scalar(scores, middle, "_m").where(
        (F.col("macro_effectiveness_index") > min_index) & (F.col("usage_count") < F.col("_m.middle"))
    )
    return wins.drop("_m").orderBy(F.desc("macro_effectiveness_index"), "macro_id")


def low_usage(scores: DataFrame, max_uses: int = MIN_USAGE_FOR_SCORING) -> DataFrame:
    return scores.where(F.col("usage_count") < max_uses)


def action_items_export(scores: DataFrame) -> DataFrame:
    weak = (F.col("effectiveness_level") == "Low") | (F.col("usage_count") < MIN_USAGE_FOR_SCORING)
    return scores.where(weak).select(
        "macro_id", "macro_name", "category", "macro_effectiveness_index", "usage_count"
    )


def eval_landscape(scores: DataFrame) -> DataFrame:
    uses, index = F.col("usage_count"), F.col("macro_effectiveness_index")
    return scores.agg(
        F.count(F.lit(1)).alias("total_macros"),
        F.count_if("is_active").alias("active_macros"),
        F.count_if(uses == 0).alias("unused_macros"),
        F.try_divide(F.count_if(uses == 0), F.count(F.lit(1))).alias("unused_share"),
        F.count_if((uses > 0) & (uses < MIN_USAGE_FOR_SCORING)).alias("low_usage_macros"),
        F.avg(index).alias("avg_effectiveness"),
        F.count_if(index >= 75).alias("high_impact_macros"),
        F.count_if(index < 25).alias("low_effectiveness_macros"),
    )


def eval_recommendations(categorized: DataFrame, cluster_summary: DataFrame, gem_limit: int = 10) -> DataFrame:
    """Numbered actions with their counts, only those that apply. Gems count up to the report's limit."""
    flagged = cluster_summary.agg(F.count_if("consolidation_candidate").alias("n"))
    counted = categorized.agg(
        F.count_if(F.col("usage_count") == 0).alias("unused"),
        F.count_if(F.col("macro_category") == "Underused Gem").alias("gems"),
        F.count_if(F.col("macro_effectiveness_index") < 25).alias("weak"),
    ).withColumn("clusters", flagged.scalar())
    actions = [
        (1, "Archive unused macros", F.col("unused")),
        (2, "Promote underused gems", F.least("gems", F.lit(gem_limit))),
        (3, "Rewrite low-effectiveness macros", F.col("weak")),
        (4, "Consolidate topic clusters", F.col("clusters")),
    ]
    rows = F.array(
        *[F.struct(F.lit(i).alias("priority"), F.lit(a).alias("action"), n.cast("long").alias("n"))
          for i, a, n in actions]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*").where(F.col("n") > 0)


def explorer_filter(
    scores: DataFrame,
    category: str | None = None,
    cluster_label: str | None = None,
    level: str | None = None,
    min_usage: int = 0,
) -> DataFrame:
    df = scores
    for name, value in (("category", category), ("cluster_label", cluster_label), ("effectiveness_level", level)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df.where(F.col("usage_count") >= min_usage).orderBy(
        F.desc("macro_effectiveness_index"), "macro_id"
    )


def explorer_compare(scores: DataFrame, macro_a, macro_b) -> DataFrame:
    """Two macros side by side; one filtered pass, no join."""
    columns = ["macro_name", "category", "macro_effectiveness_index", "usage_count", "avg_csat"]
    side = [
        F.max(F.when(F.col("macro_id") == i, F.col(c))).alias(f"{c}_{s}")
        for s, i in (("a", macro_a), ("b", macro_b))
        for c in columns
    ]
    one = scores.where(F.col("macro_id").isin(macro_a, macro_b)).agg(*side)
    deltas = {
        "index_delta": F.col("macro_effectiveness_index_a") - F.col("macro_effectiveness_index_b"),
        "usage_delta": F.col("usage_count_a") - F.col("usage_count_b"),
        "csat_delta": F.col("avg_csat_a") - F.col("avg_csat_b"),
    }
    return one.withColumns(deltas)


def scatter_usage(scores: DataFrame) -> DataFrame:
    return scores.where("has_sufficient_usage").select(
        "macro_id", "macro_name", "usage_count", "macro_effectiveness_index", "category"
    )


def category_affinity(tickets: DataFrame, usage: DataFrame, macros: DataFrame) -> DataFrame:
    """Mean rating and uses per ticket type and macro category, long form.

    Uses are aggregated per ticket type and macro before the macro categories are joined.
    """
    partial = usage_outcomes(usage, tickets, ["ticket_id", "contact_driver", "csat_score"]).groupBy(
        F.col("contact_driver").alias("ticket_type"), "macro_id"
    ).agg(
        F.sum("csat_score").alias("_s"), F.count("csat_score").alias("_n"),
        F.count("ticket_id").alias("usage_count"),
    )
    known = partial.where(F.col("ticket_type").isNotNull())
    categories = macros.select("macro_id", "category").where(F.col("category").isNotNull())
    return known.join(categories, "macro_id").groupBy("ticket_type", "category").agg(
        F.try_divide(F.sum("_s"), F.sum("_n")).alias("avg_csat"), F.sum("usage_count").alias("usage_count")
    )


def affinity_matrix(affinity: DataFrame, categories: list[str]) -> DataFrame:
    wide = affinity.groupBy("ticket_type").pivot("category", categories).agg(F.first("avg_csat"))
    return wide.na.fill(0.0)


def top_per_category(scores: DataFrame, n: int = 2) -> DataFrame:
    """Best ``n`` macros per category; the limit is applied before the shuffle as well."""
    best = Window.partitionBy("category").orderBy(F.desc("macro_effectiveness_index"), "macro_id")
    return scores.where(F.col("category").isNotNull()).withColumn("_r", F.row_number().over(best)).where(
        F.col("_r") <= n
    )


def rule_recommendations(
    affinity: DataFrame, scores: DataFrame, ticket_types: DataFrame, n: int = 3
) -> DataFrame:
    """Best macros of the two best categories of each ticket type; other types get two fixed categories.

    A category a ticket type never met rates 0, as in the filled matrix, so it is chosen only when
    fewer than two categories were met; ties go to the lower category name.
    """
    by_rating = Window.partitionBy("ticket_type").orderBy(F.desc("avg_csat"), "category")
    met = affinity.withColumn("avg_csat", F.coalesce("avg_csat", F.lit(0.0)))
    best = met.withColumn("_c", F.row_number().over(by_rating)).where("_c <= 2").select(
        "ticket_type", "category", "_c"
    )
    # Categories in name order: at most two rows for the fallback.
    names = scores.where(F.col("category").isNotNull()).select("category").distinct().orderBy("category").limit(4)
    all_names = scalar(names.agg(F.sort_array(F.collect_list("category")).alias("c")))["c"]
    types = ticket_types.select("ticket_type").distinct()
    chosen = best.groupBy("ticket_type").agg(F.sort_array(F.collect_list(F.struct("_c", "category"))).alias("b"))
    picked = types.join(chosen, "ticket_type", "left").withColumn("_names", all_names).select(
        "ticket_type",
        F.posexplode(
            F.slice(
                F.concat(
                    F.coalesce(F.transform("b", lambda x: x["category"]), F.array().cast("array<string>")),
                    F.array_except(
                        "_names",
                        F.coalesce(F.transform("b", lambda x: x["category"]), F.array().cast("array<string>")),
                    ),
                ),
                1, 2,
            )
        ).alias("_p", "category"),
    )
    best_macros = top_per_category(scores, 2).select(
        "category", "macro_id", "macro_name", F.col("macro_effectiveness_index").alias("effectiveness"), "_r"
    )
    order = Window.partitionBy("ticket_type").orderBy("_p", "_r")
    reason = F.concat(F.lit("High-performing macro in recommended category '"), F.col("category"), F.lit("'"))
    return (
        picked.join(best_macros, "category")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .select("ticket_type", "rank", "macro_id", "macro_name", "category", "effectiveness",
                reason.alias("reason"))
    )
