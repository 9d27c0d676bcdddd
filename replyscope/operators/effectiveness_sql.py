"""The warehouse formulation: scores per macro and contact driver, and its recommendation reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.functions.columns import fixed
from replyscope.operators.pairs import first_pairs
from replyscope.schemas import MIN_USAGE_FOR_SCORING, WEIGHT_CSAT, WEIGHT_HANDLE_TIME, WEIGHT_REOPEN
from replyscope.sources.tables import stage


def _reopened():
    return F.avg(F.when(F.col("was_reopened"), 1.0).otherwise(0.0))


def sql_baseline(fact_tickets: DataFrame) -> DataFrame:
    rated = fact_tickets.where(F.col("csat_score").isNotNull())
    return rated.groupBy("contact_driver").agg(
        F.avg("csat_score").alias("baseline_csat"),
        F.avg("handle_time_seconds").alias("baseline_handle_time"),
        _reopened().alias("baseline_reopen_rate"),
    )


def sql_macro_raw(fact_tickets: DataFrame, usage: DataFrame, macros: DataFrame) -> DataFrame:
    """Rated uses per macro and driver, five or more; aggregated before the names are joined."""
    rated = fact_tickets.where(F.col("csat_score").isNotNull()).select(
        "ticket_id", "contact_driver", "csat_score", "handle_time_seconds", "was_reopened"
    )
    grouped = (
        usage.select("ticket_id", "macro_id")
        .join(rated, "ticket_id")
        .groupBy("macro_id", "contact_driver")
        .agg(
            F.count(F.lit(1)).alias("usage_count"),
            F.avg("csat_score").alias("avg_csat"),
            F.avg("handle_time_seconds").alias("avg_handle_time"),
            _reopened().alias("reopen_rate"),
        )
        .where(F.col("usage_count") >= MIN_USAGE_FOR_SCORING)
    )
    return macros.select("macro_id", "macro_name", "category").join(grouped, "macro_id")


def effectiveness_by_driver(fact_tickets: DataFrame, usage: DataFrame, macros: DataFrame) -> DataFrame:
    """Unrounded index per macro and driver against the driver's own baseline."""
    raw = sql_macro_raw(fact_tickets, usage, macros)
    base = sql_baseline(fact_tickets).select("contact_driver", "baseline_handle_time")
    share = F.try_divide(F.col("avg_handle_time"), F.nullif("baseline_handle_time", F.lit(0.0)))
    csat = (F.col("avg_csat") - 1.0) / 4.0 * 100.0
    handle = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 * (1.0 - share)))
    reopen = (1.0 - F.col("reopen_rate")) * 100.0
    index = WEIGHT_CSAT * csat + WEIGHT_HANDLE_TIME * handle + WEIGHT_REOPEN * reopen
    return raw.join(base, "contact_driver").withColumn("effectiveness_index", fixed(index, 9))


def sql_effectiveness(by_driver: DataFrame) -> DataFrame:
    i = F.col("effectiveness_index")
    tier = (
        F.when(i >= 75, "High Performer")
        .when(i >= 50, "Moderate")
        .when(i >= 25, "Needs Review")
        .otherwise("Low Performer")
    )
    return by_driver.select(
        "macro_id", "macro_name", "category", "contact_driver", "usage_count",
        fixed("avg_csat", 2).alias("avg_csat"),
        fixed("avg_handle_time", 0).alias("avg_handle_time_sec"),
        fixed(F.col("reopen_rate") * 100.0, 1).alias("reopen_rate_pct"),
        fixed(i, 1).alias("effectiveness_score"),
        tier.alias("effectiveness_tier"),
    ).orderBy(F.desc("effectiveness_score"), "macro_id", "contact_driver")


def sql_gems(by_driver: DataFrame, min_index: float = 75.0, max_usage: int = 50) -> DataFrame:
    gems = by_driver.where((F.col("effectiveness_index") >= min_index) & (F.col("usage_count") < max_usage))
    return gems.select(
        "macro_id", "macro_name", "category", "contact_driver", "usage_count",
        fixed("effectiveness_index", 1).alias("effectiveness_score"),
        F.lit("Underused Gem - Promote!").alias("recommendation"),
    ).orderBy(F.desc("effectiveness_score"), "macro_id", "contact_driver")


def active_usage(macros: DataFrame, usage: DataFrame) -> DataFrame:
    """Uses per active macro, zero included; uses are counted before the join."""
    uses = usage.groupBy("macro_id").agg(F.count(F.lit(1)).alias("total_uses"))
    active = macros.where("is_active")
    return active.join(uses, "macro_id", "left").withColumn("total_uses", F.coalesce("total_uses", F.lit(0)))


def sql_unused(macros: DataFrame, usage: DataFrame) -> DataFrame:
    idle = macros.where("is_active").join(usage.select("macro_id"), "macro_id", "left_anti")
    return idle.select(
        "macro_id", "macro_name", "category", "created_at", F.lit(0).cast("long").alias("total_uses"),
        F.lit("Archive - No usage in analysis period").alias("recommendation"),
    ).orderBy("created_at", "macro_id")


def sql_low_usage(macros: DataFrame, usage: DataFrame) -> DataFrame:
    low = active_usage(macros, usage).where(F.col("total_uses").between(1, MIN_USAGE_FOR_SCORING - 1))
    return low.select(
        "macro_id", "macro_name", "category", "total_uses",
        F.lit("Review - Insufficient data for scoring").alias("recommendation"),
    ).orderBy(F.desc("total_uses"), "macro_id")


def sql_category_stats(macros: DataFrame, usage: DataFrame, fact_tickets: DataFrame) -> DataFrame:
    """Active macros per category with distinct tickets and mean outcomes over their uses.

    Macro counts come from the macro table alone, so an unused macro still counts and a hot macro
    does not have to meet its category's rows in one place.
    """
    active = macros.where("is_active").select("macro_id", "category")
    counts = active.groupBy("category").agg(F.countDistinct("macro_id").alias("macro_count"))
    outcomes = fact_tickets.select("ticket_id", "csat_score", "handle_time_seconds")
    used = (
        usage.select("ticket_id", "macro_id")
        .join(active, "macro_id")
        .join(outcomes, "ticket_id", "left")
        .groupBy("category")
        .agg(
            F.countDistinct("ticket_id").alias("total_tickets"),
            F.avg("csat_score").alias("csat"),
            F.avg("handle_time_seconds").alias("seconds"),
        )
    )
    advice = (
        F.when((F.col("macro_count") > 10) & (F.col("csat") < 3.5),
               "Consolidate - Too many low-performing macros")
        .when(F.col("macro_count") > 15, "Review - High macro count may indicate redundancy")
        .otherwise("OK")
    )
    return (
        counts.where(F.col("macro_count") > 5)
        .join(used, "category", "left")
        .select(
            "category", "macro_count",
            F.coalesce("total_tickets", F.lit(0)).alias("total_tickets"),
            fixed("csat", 2).alias("avg_csat"),
            fixed("seconds", 0).alias("avg_handle_time_sec"),
            advice.alias("recommendation"),
        )
        .orderBy(F.desc("macro_count"), "category")
    )


def sql_exec_summary(macros: DataFrame, usage: DataFrame) -> DataFrame:
    n = F.col("total_uses")
    unused = F.count_if(n == 0)
    return active_usage(macros, usage).agg(
        F.count(F.lit(1)).alias("total_active_macros"),
        unused.alias("unused_macros"),
        F.count_if(n.between(1, MIN_USAGE_FOR_SCORING - 1)).alias("low_usage_macros"),
        F.count_if(n >= MIN_USAGE_FOR_SCORING).alias("scoreable_macros"),
        fixed(F.try_divide(100.0 * unused, F.count(F.lit(1))), 1).alias("unused_pct"),
        fixed(F.avg(n), 1).alias("avg_usage_per_macro"),
    )


ARCHIVE = "Macros to Archive (unused)"
REVIEW = "Macros Needing Review (low usage)"
CONSOLIDATE = "Categories for Consolidation Review"


def _big_categories(macros: DataFrame) -> DataFrame:
    counts = macros.where("is_active").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 10).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(CONSOLIDATE).alias("action_type"), "n"
    )


def sql_action_items(macros: DataFrame, usage: DataFrame) -> DataFrame:
    """Literal form: one row per macro of the first two kinds, holding its joined row count."""
    per_macro = active_usage(macros, usage).where(F.col("total_uses") < MIN_USAGE_FOR_SCORING)
    kind = F.when(F.col("total_uses") == 0, ARCHIVE).otherwise(REVIEW)
    items = per_macro.select(kind.alias("action_type"), F.greatest("total_uses", F.lit(1)).alias("n"))
    return items.unionByName(_big_categories(macros))


def action_items_summary(macros: DataFrame, usage: DataFrame) -> DataFrame:
    """Intended form: one row per kind with its total."""
    uses = active_usage(macros, usage)
    low = F.col("total_uses").between(1, MIN_USAGE_FOR_SCORING - 1)
    totals = uses.agg(F.count_if(F.col("total_uses") == 0).alias("a"), F.count_if(low).alias("b"))
    rows = F.array(
        F.struct(F.lit(ARCHIVE).alias("action_type"), F.col("a").alias("n")),
        F.struct(F.lit(REVIEW).alias("action_type"), F.col("b").alias("n")),
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*").unionByName(_big_categories(macros))


GRAM = 3


def _grams(text):
    """All pieces of one to three characters of a text, as often as they stand in it."""
    def of(k: int):
        last = F.length(text) - k + 1
        starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(k)))

    return F.flatten(F.array(*[of(k) for k in range(1, GRAM + 1)]))


def held_words(names: DataFrame, words: DataFrame) -> DataFrame:
    """Which names hold which words: (category, name_key, word) for ``names`` (category, name_key, low) and ``words`` (category, word).

    An inverted index of pieces of up to three characters: a word is looked up by one piece of its own, the one that the fewest names of
    its category hold, and the names found so are verified. A name is listed under its pieces, three a letter at most, whatever its length.
    """
    listed = names.select("category", "name_key", F.explode(_grams(F.col("low"))).alias("gram")).distinct()
    known = listed.groupBy("category", "gram").agg(F.count(F.lit(1)).alias("n"))
    size = F.least(F.length("word"), F.lit(GRAM))
    starts = F.sequence(F.lit(1), F.length("word") - size + 1)
    asked = words.where(F.length("word") > 0).select(
        "category", "word", F.explode(F.transform(starts, lambda i: F.substring(F.col("word"), i, size))).alias("gram")
    ).distinct()
    # a piece that no name holds rules the word out
    rated = asked.join(known, ["category", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = rated.groupBy("category", "word").agg(F.min(F.struct("n", "gram")).alias("r")).where("r.n > 0")
    found = rarest.select("category", "word", F.col("r.gram").alias("gram")).join(listed, ["category", "gram"])
    checked = found.join(names, ["category", "name_key"]).where(F.contains("low", F.col("word")))
    return checked.select("category", "name_key", "word")


def similar_names(macros: DataFrame, n: int = 50) -> DataFrame:
    """First ``n`` pairs of active macros of one category where either name holds the other's first word.

    No pair is formed to find them: equal names of a category are taken together, and an index of short pieces tells which first words
    each name holds (see ``held_words``). An empty first word (of a name that starts with a blank) is held by every name of its
    category. From the counts per word follows which macros have a partner at all; the first
    ``2n`` of those suffice (see ``first_pairs``).
    """
    active = macros.where("is_active").select("macro_id", "category", F.col("macro_name").alias("name"))
    named = active.where(F.col("category").isNotNull() & F.col("name").isNotNull()).withColumns(
        {"low": F.lower("name"), "word": F.lower(F.element_at(F.split("name", " "), 1))}
    ).withColumn("name_key", F.sha2("low", 256))
    leading = stage(named.groupBy("category", "word").agg(F.count(F.lit(1)).alias("n_leading")))
    alike = stage(named.groupBy("category", "name_key").agg(F.first("low").alias("low"), F.count(F.lit(1)).alias("n_names")))
    held = stage(held_words(alike.select("category", "name_key", "low"), leading.select("category", "word")))
    totals = alike.groupBy("category").agg(F.sum("n_names").alias("n_all"))
    blank = leading.where("word = ''").select("category", F.col("n_leading").alias("n_blank"))
    # Others whose first word this name holds (it always holds its own), and names holding a word.
    holds = held.join(leading, ["category", "word"]).groupBy("category", "name_key").agg(F.sum("n_leading").alias("n_words"))
    holders = held.join(alike.select("category", "name_key", "n_names"), ["category", "name_key"]).groupBy("category", "word").agg(
        F.sum("n_names").alias("n_holders")
    ).unionByName(blank.join(totals, "category").select("category", F.lit("").alias("word"), F.col("n_all").alias("n_holders")))
    partnered = (
        named.join(holds, ["category", "name_key"], "left").join(blank, "category", "left").join(holders, ["category", "word"])
        .where((F.coalesce("n_words", F.lit(0)) + F.coalesce("n_blank", F.lit(0)) > 1) | (F.col("n_holders") > 1))
        .drop("name_key", "n_words", "n_blank", "n_holders")
    )
    named = named.drop("name_key")
    a, b = F.col("a"), F.col("b")
    matches = (a["category"] == b["category"]) & (
        F.contains(a["low"], b["word"]) | F.contains(b["low"], a["word"])
    )
    pairs = first_pairs(partnered, named, ["macro_id"], "macro_id", matches, n)
    return pairs.select(
        a["macro_id"].alias("macro_1_id"), a["name"].alias("macro_1_name"),
        b["macro_id"].alias("macro_2_id"), b["name"].alias("macro_2_name"),
        a["category"].alias("category"),
        F.lit("Potential duplicate - review for consolidation").alias("recommendation"),
    )
