"""Statistical comparison of macros."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.functions.columns import rate
from replyscope.functions.stats import cohens_d, sample_size, t_statistic, t_test_p
from replyscope.operators.features import usage_outcomes
from replyscope.operators.pairs import band_pairs
from replyscope.schemas import CSAT_GOOD


def macro_stats(usage: DataFrame, tickets: DataFrame) -> DataFrame:
    outcomes = usage_outcomes(usage, tickets, ["ticket_id", "csat_score", "total_handle_time_minutes"])
    return outcomes.groupBy("macro_id").agg(
        F.count("ticket_id").alias("n"),
        F.avg("csat_score").alias("csat_mean"),
        F.coalesce(F.stddev_samp("csat_score"), F.lit(0.1)).alias("csat_std"),
        F.avg("total_handle_time_minutes").alias("handle_time_mean"),
        F.coalesce(F.stddev_samp("total_handle_time_minutes"), F.lit(1.0)).alias("handle_time_std"),
    )


def compare_macros(pairs: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Pooled t test, winner and effect size for rows holding ``*_a`` and ``*_b`` statistics."""
    df = pairs
    freedom = F.col("n_a") + F.col("n_b") - 2
    for metric, higher_wins in (("csat", True), ("handle_time", False)):
        args = [F.col(f"{metric}_{s}_{side}") if s != "n" else F.col(f"n_{side}")
                for side in ("a", "b") for s in ("mean", "std", "n")]
        a, b = F.col(f"{metric}_mean_a"), F.col(f"{metric}_mean_b")
        a_better, b_better = (a > b, b > a) if higher_wins else (a < b, b < a)
        df = df.withColumn(f"{metric}_t_stat", t_statistic(*args))
        df = df.withColumn(f"{metric}_p_value", t_test_p(f"{metric}_t_stat", freedom))
        significant = F.coalesce(F.col(f"{metric}_p_value") < alpha, F.lit(False))
        winner = F.when(a_better & significant, "A").when(b_better & significant, "B").otherwise("Tie")
        df = df.withColumns(
            {
                f"{metric}_significant": significant,
                f"{metric}_winner": winner,
                f"{metric}_effect_size": cohens_d(*args),
            }
        )
    return df


def ab_batch(
    usage: DataFrame,
    tickets: DataFrame,
    scores: DataFrame,
    min_samples: int = 30,
    threshold: float = 0.3,
    alpha: float = 0.05,
    max_pairs: int = 100,
) -> DataFrame:
    """Comparable pairs of one category with enough uses, compared: the first ``max_pairs`` comparable ones."""
    stats = macro_stats(usage, tickets)
    pairs = band_pairs(scores, True, threshold, max_pairs).select("macro_a", "macro_b")

    def side(s: str) -> DataFrame:
        return stats.select(
            F.col("macro_id").alias(f"macro_{s}"),
            *[F.col(c).alias(f"{c}_{s}") for c in stats.columns if c != "macro_id"],
        )

    joined = side("b").join(F.broadcast(side("a").join(F.broadcast(pairs), "macro_a")), "macro_b")
    enough = (F.col("n_a") >= min_samples) & (F.col("n_b") >= min_samples)
    return compare_macros(joined.where(enough), alpha)


def ab_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total_comparisons"),
        F.count_if("csat_significant").alias("significant_csat"),
        F.count_if("handle_time_significant").alias("significant_handle_time"),
    )


def ab_findings(results: DataFrame, macros: DataFrame, n: int = 10) -> DataFrame:
    """First significant comparisons with macro names; the id stands in for an unknown name."""
    found = results.where(F.col("csat_significant") | F.col("handle_time_significant"))
    found = found.orderBy("macro_a", "macro_b").limit(n)
    for s in ("a", "b"):
        names = macros.select(F.col("macro_id").alias(f"macro_{s}"), F.col("macro_name").alias(f"_n{s}"))
        # At most n rows on the left: the name table is filtered by them, not shuffled.
        found = names.join(F.broadcast(found), f"macro_{s}", "right").withColumn(
            f"name_{s}", F.coalesce(f"_n{s}", F.col(f"macro_{s}").cast("string"))
        ).drop(f"_n{s}")

    def winner(metric: str):
        named = F.when(F.col(f"{metric}_winner") == "A", F.col("name_a")).otherwise(F.col("name_b"))
        return F.when(F.col(f"{metric}_significant"), named).alias(f"{metric}_winner_name")

    return found.select(
        "macro_a", "macro_b", "name_a", "name_b", winner("csat"), winner("handle_time"),
        "csat_p_value", "handle_time_p_value",
    )


def required_samples(
    usage: DataFrame, tickets: DataFrame, effect: float = 0.1, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Rows per arm to detect a relative change of each macro's share of good ratings."""
    rated = usage_outcomes(usage, tickets, ["ticket_id", "csat_score"]).where(F.col("csat_score").isNotNull())
    shares = rated.groupBy("macro_id").agg(rate(F.col("csat_score") >= CSAT_GOOD).alias("good_rate"))
    open_rates = shares.where((F.col("good_rate") > 0) & (F.col("good_rate") < 1))
    return open_rates.withColumn(
        "n_per_arm", sample_size("good_rate", F.lit(effect), alpha, power)
    )
