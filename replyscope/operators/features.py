"""Ticket and macro features, and the detail views over the three tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.columns import rate
from replyscope.operators.ranking import grouped_quantile
from replyscope.sources.tables import stage

OUTCOMES = [
    "ticket_id", "agent_id", "contact_driver", "csat_score", "total_handle_time_minutes", "reopens_count",
]
#: Uses in a part that is joined and counted at a time.
PART_ROWS = 250_000


def ticket_features(tickets: DataFrame, usage: DataFrame, first_last: bool = True) -> DataFrame:
    """Uses per ticket; the first is at position 1, the last at the highest position, ties by id."""
    aggs = [
        F.count("macro_id").alias("num_macros_used"),
        F.countDistinct("macro_id").alias("macro_count_unique"),
    ]
    fills = {
        "num_macros_used": F.coalesce("num_macros_used", F.lit(0)),
        "macro_count_unique": F.coalesce("macro_count_unique", F.lit(0)),
    }
    if first_last:
        at_start = F.when(F.col("position_in_thread") == 1, F.col("macro_id"))
        aggs += [
            F.min(at_start).cast("string").alias("first_macro_id"),
            F.max(F.struct("position_in_thread", "macro_id"))["macro_id"].cast("string").alias("last_macro_id"),
        ]
        fills |= {c: F.coalesce(c, F.lit("")) for c in ("first_macro_id", "last_macro_id")}
    per_ticket = usage.groupBy("ticket_id").agg(*aggs)
    joined = tickets.join(per_ticket, "ticket_id", "left").withColumns(fills)
    return joined.withColumn("is_macro_used", F.col("num_macros_used") > 0)


def usage_outcomes(usage: DataFrame, tickets: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each use with the outcome of its ticket; the agent is the ticket's."""
    keep = [c for c in (columns or OUTCOMES) if c in tickets.columns]
    uses = usage.drop("agent_id") if "agent_id" in keep else usage
    return uses.join(tickets.select(*keep), "ticket_id", "left")


def macro_features(usage: DataFrame, tickets: DataFrame, macros: DataFrame, medians: bool = True) -> DataFrame:
    """All macros with their use counts and mean/median outcomes; unused macros carry zeros.

    With medians, the uses are joined to their tickets once and counted by all values that matter; the counts are kept, and means,
    both medians and the distinct counts are read from them. Scores need neither medians nor distinct
    counts, so ``medians=False`` takes its means straight from the join.
    """
    outcomes = usage_outcomes(usage, tickets)
    if medians:
        features = _counted_features(outcomes)
    else:
        features = outcomes.groupBy("macro_id").agg(
            F.count("ticket_id").alias("usage_count"),
            F.avg("csat_score").alias("avg_csat"),
            F.avg("total_handle_time_minutes").alias("avg_handle_time"),
            rate(F.col("reopens_count") > 0).alias("reopen_rate"),
        )
    numbers = [c for c in features.columns if c != "macro_id"]
    return macros.join(features, "macro_id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in numbers}
    )


def _counted_features(outcomes: DataFrame) -> DataFrame:
    """Per macro, from one counted table: uses, means, reopen rate, exact medians, distinct agents and drivers."""
    reopened = F.coalesce(F.col("reopens_count") > 0, F.lit(False)).alias("reopened")
    counted = stage(
        outcomes.where(F.col("macro_id").isNotNull())
        .groupBy("macro_id", "csat_score", "total_handle_time_minutes", reopened, "agent_id", "contact_driver")
        .agg(F.count(F.lit(1)).alias("n"), F.count("ticket_id").alias("n_tickets"))
    )
    n = F.col("n").cast("double")

    def mean(value: str):
        v = F.col(value).cast("double")
        return F.try_divide(F.sum(v * n), F.sum(F.when(v.isNotNull(), n)))

    sums = counted.groupBy("macro_id").agg(
        F.sum("n_tickets").alias("usage_count"), mean("csat_score").alias("avg_csat"),
        mean("total_handle_time_minutes").alias("avg_handle_time"),
        F.try_divide(F.sum(F.when(F.col("reopened"), n).otherwise(0.0)), F.sum(n)).alias("reopen_rate"),
    )
    # Two distinct counts: values first, then their number, so that a macro with all uses is combined in many tasks.
    kinds = F.explode(F.array(
        F.struct(F.lit("agent").alias("kind"), F.col("agent_id").cast("string").alias("value")),
        F.struct(F.lit("driver").alias("kind"), F.col("contact_driver").cast("string").alias("value")),
    ))
    known = counted.select("macro_id", kinds.alias("k")).select("macro_id", "k.*").where("value is not null").distinct()
    different = known.groupBy("macro_id").agg(
        F.count_if(F.col("kind") == "agent").alias("unique_agents"), F.count_if(F.col("kind") == "driver").alias("unique_drivers")
    )
    medians = [
        grouped_quantile(counted, ["macro_id"], value, 0.5, out, n="n")
        for value, out in (("csat_score", "median_csat"), ("total_handle_time_minutes", "median_handle_time"))
    ]
    joined = sums.join(different, "macro_id", "left")
    for median in medians:
        joined = joined.join(median, "macro_id", "left")
    return joined


def ticket_macro_detail(fact_tickets: DataFrame, usage: DataFrame, macros: DataFrame) -> DataFrame:
    """One row per use with ticket outcome and macro name."""
    facts = fact_tickets.select(
        "ticket_id", "created_at", "csat_score", "handle_time_seconds", "contact_driver", "was_reopened"
    )
    names = macros.select("macro_id", "macro_name", "category")
    return usage.select("ticket_id", "macro_id").join(facts, "ticket_id").join(names, "macro_id")


def macro_usage_stats(macros: DataFrame, usage: DataFrame, fact_tickets: DataFrame) -> DataFrame:
    """Distinct tickets and agents, first and last use per macro; unused macros stay.

    Uses and tickets are cut by ticket into parts of a set number of rows, however many there are, and a part counts a macro's tickets
    once. What leaves it is combined by macro and agent, before the macro names are joined.
    """
    uses = usage.select("ticket_id", "macro_id", "applied_at")
    parts = max(usage.sparkSession.sparkContext.defaultParallelism, -(-uses.count() // PART_ROWS))
    first, last = F.min("applied_at").alias("first_used"), F.max("applied_at").alias("last_used")
    once = uses.repartition(parts, "ticket_id").groupBy("ticket_id", "macro_id").agg(first, last)
    known = fact_tickets.select("ticket_id", "agent_id").where("ticket_id is not null").repartition(parts, "ticket_id").distinct()
    # a ticket listed with several agents meets a use once for each, and counts with the first
    nth = F.row_number().over(Window.partitionBy("ticket_id").orderBy("agent_id"))
    joined = once.join(known.withColumn("nth", nth), "ticket_id", "left")
    counts = F.count(F.when(F.coalesce("nth", F.lit(1)) == 1, F.col("ticket_id"))).alias("n")
    per_agent = joined.groupBy("macro_id", "agent_id").agg(
        counts, F.min("first_used").alias("first_used"), F.max("last_used").alias("last_used")
    )
    per_macro = per_agent.groupBy("macro_id").agg(
        F.sum("n").alias("total_uses"), F.count("agent_id").alias("unique_agents"),
        F.min("first_used").alias("first_used"), F.max("last_used").alias("last_used"),
    )
    names = macros.select("macro_id", "macro_name", "category")
    return names.join(per_macro, "macro_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("total_uses", "unique_agents")}
    )


def first_macro_per_ticket(usage: DataFrame) -> DataFrame:
    """Earliest use per ticket; ties by position, then macro."""
    first = F.min(F.struct("applied_at", "position_in_thread", "macro_id"))
    return usage.groupBy("ticket_id").agg(first.alias("u")).select("ticket_id", "u.*")
