"""Registered queries: each maps a desk to one result."""

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyscope.functions import columns as C
from replyscope.functions import text as X
from replyscope.operators import (
    agents,
    cleaning,
    effectiveness_sql,
    experiments,
    features,
    pairs,
    predict,
    quality,
    ranking,
    recommend,
    reports,
    scoring,
    similarity,
    texts,
    topics,
    trends,
)
from replyscope.plans.desk import Desk
from replyscope.plans.spoiled import broken_rules, spoil
from replyscope.schemas import TICKETS
from replyscope.sources.tables import (
    ingest_csv,
    read_csv,
    read_parquet,
    spread,
    stage,
    work_folder,
    write_bundle,
    write_table,
)

QUERIES: dict[str, Callable[[Desk], DataFrame]] = {}
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)


def query(fn: Callable[[Desk], DataFrame]) -> Callable[[Desk], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def present(df: DataFrame, *columns) -> DataFrame:
    """Engine-neutral output: rounded doubles, long integers, dates and times as text."""
    picked = df.select(*columns) if columns else df
    out = []
    for field in picked.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = C.steady(c)
        elif isinstance(field.dataType, INTEGERS):
            c = c.cast("double" if field.name == "csat_score" else "long")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return picked.select(*out)


# --- cleaning and checks -----------------------------------------------------------


@query
def clean_tickets(d: Desk) -> DataFrame:
    return present(
        d.clean[0], "ticket_id", "created_at", "resolved_at", "resolution_time_minutes", "is_reopened",
        "is_high_priority", "resolved_same_day", "macro_sequence", "final_macro_id", "has_macro",
    )


@query
def clean_macros(d: Desk) -> DataFrame:
    return present(
        d.clean[1], "macro_id", "macro_name", "macro_body", "created_at", "updated_at", "is_active",
        "is_internal_only",
    )


@query
def clean_usage(d: Desk) -> DataFrame:
    return present(d.clean[2])


@query
def referential_filter(d: Desk) -> DataFrame:
    kept = cleaning.referential_filter(d.raw_usage, d.tickets, d.macros)
    return present(kept, "ticket_id", "macro_id", "applied_at", "position_in_thread")


@query
def stage_counts(d: Desk) -> DataFrame:
    return cleaning.stage_counts(d.tickets, d.macros, d.raw_usage)


@query
def check_tickets(d: Desk) -> DataFrame:
    return quality.check_tickets(d.raw_tickets)


@query
def check_macros(d: Desk) -> DataFrame:
    return quality.check_macros(d.raw_macros)


@query
def check_usage(d: Desk) -> DataFrame:
    return quality.check_usage(d.raw_usage)


def _with_violations(df: DataFrame, *keep: str) -> DataFrame:
    return present(df.withColumn("violations", F.array_join("violations", ",")), *keep, "violations", "is_valid")


@query
def check_ticket_rows(d: Desk) -> DataFrame:
    return _with_violations(
        quality.check_ticket_rows(d.raw_tickets), "ticket_id", "status", "priority", "channel", "language"
    )


PART_CATEGORIES = ["economy", "large", "medium", "promo", "small"]


@query
def check_macro_rows(d: Desk) -> DataFrame:
    return _with_violations(
        quality.check_macro_rows(d.raw_macros, PART_CATEGORIES), "macro_id", "macro_name", "category", "is_active"
    )


@query
def check_usage_rows(d: Desk) -> DataFrame:
    return _with_violations(
        quality.check_usage_rows(d.raw_usage), "ticket_id", "macro_id", "position_in_thread"
    )


@query
def check_score_rows(d: Desk) -> DataFrame:
    spoiled = d.scores.withColumn(
        "macro_effectiveness_index", F.col("macro_effectiveness_index") * F.when(F.col("is_internal_only"), 2.0).otherwise(1.0)
    )
    return _with_violations(quality.check_score_rows(spoiled), "macro_id", "macro_effectiveness_index")


@query
def check_cluster_rows(d: Desk) -> DataFrame:
    return _with_violations(quality.check_cluster_rows(topics.cluster_summary(d.owned)), "cluster_id", "cluster_label")


@query
def check_ticket_rules(d: Desk) -> DataFrame:
    """Rows that break each rule of the ticket check, on tickets spoiled for every rule."""
    tickets = d.tickets.withColumn("replies_count", (F.col("ticket_id") % 9).cast("int"))
    return broken_rules(quality.check_ticket_rows(spoil(tickets, "tickets", "ticket_id")))


@query
def check_macro_rules(d: Desk) -> DataFrame:
    return broken_rules(quality.check_macro_rows(spoil(d.macros, "macros", "macro_id"), PART_CATEGORIES))


@query
def check_usage_rules(d: Desk) -> DataFrame:
    uses = d.usage.withColumn("channel", F.lit("email"))
    return broken_rules(quality.check_usage_rows(spoil(uses, "macro_usage", "ticket_id")))


@query
def check_score_rules(d: Desk) -> DataFrame:
    return broken_rules(quality.check_score_rows(spoil(d.categorized, "scores", "macro_id")))


@query
def check_cluster_rules(d: Desk) -> DataFrame:
    return broken_rules(quality.check_cluster_rows(spoil(topics.cluster_summary(d.owned), "clusters", "cluster_id")))


@query
def data_audit(d: Desk) -> DataFrame:
    return quality.data_audit(d.raw_tickets, d.macros, d.usage_only)


@query
def check_keys(d: Desk) -> DataFrame:
    return quality.check_keys(d.raw_tickets, d.raw_macros, d.raw_usage)


# --- joins and features --------------------------------------------------------------


@query
def join_ticket_macro_detail(d: Desk) -> DataFrame:
    return present(features.ticket_macro_detail(d.fact_tickets, d.usage_only, d.macros))


@query
def ticket_features(d: Desk) -> DataFrame:
    return present(
        features.ticket_features(d.tickets, d.usage_only), "ticket_id", "num_macros_used",
        "macro_count_unique", "first_macro_id", "last_macro_id", "is_macro_used",
    )


@query
def macro_features(d: Desk) -> DataFrame:
    full = features.macro_features(d.usage_only, d.tickets, d.macros)
    return present(
        full, "macro_id", "macro_name", "category", "usage_count", "avg_csat", "median_csat",
        "avg_handle_time", "median_handle_time", "reopen_rate", "unique_agents", "unique_drivers",
    )


@query
def macro_usage_stats(d: Desk) -> DataFrame:
    return present(features.macro_usage_stats(d.macros, d.usage_only, d.fact_tickets))


@query
def first_macro_per_ticket(d: Desk) -> DataFrame:
    return present(features.first_macro_per_ticket(d.usage_only))


@query
def join_same_category_pairs(d: Desk) -> DataFrame:
    return present(pairs.band_pairs(d.indexed, True), "macro_a", "macro_b", "category_a", "index_a", "index_b")


@query
def join_band_pairs(d: Desk) -> DataFrame:
    return present(pairs.band_pairs(d.indexed, False))


@query
def join_name_similarity(d: Desk) -> DataFrame:
    return effectiveness_sql.similar_names(d.macros)


# --- baselines and scores --------------------------------------------------------------


@query
def baseline_overall(d: Desk) -> DataFrame:
    return present(scoring.baseline_overall(d.tickets))


@query
def baseline_by_driver(d: Desk) -> DataFrame:
    return present(scoring.baseline_by_driver(d.tickets))


@query
def macro_scores(d: Desk) -> DataFrame:
    return present(
        d.scores, "macro_id", "macro_name", "category", "usage_count", "has_sufficient_usage", "csat_lift",
        "handle_time_delta", "reopen_rate_delta", "csat_component", "handle_time_component",
        "reopen_component", "macro_effectiveness_index", "effectiveness_percentile",
    )


@query
def categorize_macros(d: Desk) -> DataFrame:
    return present(
        d.categorized, "macro_id", "usage_count", "macro_effectiveness_index", "effectiveness_percentile",
        "macro_category",
    )


@query
def normalize_score(d: Desk) -> DataFrame:
    """Part sizes on a fixed range, both directions."""
    part = d.table("part")
    return present(
        part, F.col("p_partkey").alias("macro_id"),
        C.normalize_score("p_size", F.lit(10), F.lit(40)).alias("forward"),
        C.normalize_score("p_size", F.lit(10), F.lit(40), True).alias("reverse"),
        C.normalize_score("p_size", F.lit(10), F.lit(10)).alias("flat"),
    )


@query
def effectiveness_level(d: Desk) -> DataFrame:
    return present(d.indexed, "macro_id", "macro_effectiveness_index", "effectiveness_level")


@query
def percentile_label(d: Desk) -> DataFrame:
    return d.scores.select("macro_id", C.percentile_label("effectiveness_percentile").alias("label"))


@query
def safe_divide(d: Desk) -> DataFrame:
    f = d.ticket_features
    return present(
        f, "ticket_id", C.safe_divide("total_handle_time_minutes", "num_macros_used").alias("minutes_per_macro"),
        C.safe_divide("total_handle_time_minutes", "csat_score", 1.0).alias("minutes_per_point"),
    )


@query
def format_percentage(d: Desk) -> DataFrame:
    return d.features.select(
        "macro_id", C.format_percentage("reopen_rate").alias("one_decimal"),
        C.format_percentage("reopen_rate", 0).alias("no_decimal"),
        C.format_percentage(F.when(F.col("usage_count") > 0, F.col("reopen_rate"))).alias("missing"),
    )


@query
def format_minutes(d: Desk) -> DataFrame:
    t = cleaning.clean_tickets(d.tickets)
    return t.select(
        "ticket_id", C.format_minutes("resolution_time_minutes").alias("resolution"),
        C.format_minutes("total_handle_time_minutes").alias("handling"),
    )


@query
def rank_avg(d: Desk) -> DataFrame:
    ranked = ranking.average_ranks(d.indexed, "macro_id", ["usage_count", "avg_csat"])
    return present(
        ranked, "macro_id", "usage_count_rank_asc", "usage_count_rank_desc", "avg_csat_rank_asc", "avg_csat_rank_desc"
    )


@query
def rank_pct(d: Desk) -> DataFrame:
    """Ticket ratings (five values) and handle times: a fact-sized ranking with many ties."""
    ranked = ranking.average_ranks(
        d.tickets.select("ticket_id", "csat_score", "total_handle_time_minutes"), "ticket_id",
        ["csat_score", "total_handle_time_minutes"],
    )
    return present(ranked, "ticket_id", "csat_score_rank_pct", "total_handle_time_minutes_rank_pct")


@query
def category_counts(d: Desk) -> DataFrame:
    return scoring.category_counts(d.categorized)


@query
def top_macros(d: Desk) -> DataFrame:
    return present(
        scoring.top_macros(d.indexed, 20), "macro_id", "macro_name", "category", "macro_effectiveness_index",
        "usage_count", "avg_csat",
    )


@query
def bottom_macros(d: Desk) -> DataFrame:
    columns = ["macro_id", "macro_name", "macro_effectiveness_index", "usage_count", "issue"]
    scored = scoring.bottom_macros(d.indexed, 10).select(F.lit("scored").alias("listing"), *columns)
    everyone = scoring.bottom_macros(d.indexed, 20, scored_only=False).select(F.lit("all").alias("listing"), *columns)
    return present(scored.unionByName(everyone))


@query
def underused_gems(d: Desk) -> DataFrame:
    return present(
        scoring.underused_gems(d.categorized), "macro_id", "macro_name", "macro_effectiveness_index", "usage_count"
    )


@query
def low_effectiveness(d: Desk) -> DataFrame:
    return present(scoring.low_effectiveness(d.indexed, 55.0), "macro_id", "macro_effectiveness_index", "usage_count")


@query
def unused_macros_py(d: Desk) -> DataFrame:
    return scoring.unused_macros(d.features).select("macro_id", "macro_name", "category")


# --- warehouse formulation ---------------------------------------------------------------


@query
def sql_baseline(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_baseline(d.fact_tickets))


@query
def sql_macro_raw(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_macro_raw(d.fact_tickets, d.usage_only, d.macros))


def _by_driver(d: Desk) -> DataFrame:
    return effectiveness_sql.effectiveness_by_driver(d.fact_tickets, d.usage_only, d.macros)


@query
def sql_effectiveness(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_effectiveness(_by_driver(d)))


@query
def sql_gems(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_gems(_by_driver(d), min_index=60.0))


@query
def sql_unused(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_unused(d.macros, d.usage_only))


@query
def sql_low_usage(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_low_usage(d.macros, d.usage_only))


@query
def sql_category_stats(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_category_stats(d.macros, d.usage_only, d.fact_tickets))


@query
def sql_exec_summary(d: Desk) -> DataFrame:
    return present(effectiveness_sql.sql_exec_summary(d.macros, d.usage_only))


@query
def sql_action_items(d: Desk) -> DataFrame:
    return effectiveness_sql.sql_action_items(d.macros, d.usage_only)


@query
def action_items_summary(d: Desk) -> DataFrame:
    return effectiveness_sql.action_items_summary(d.macros, d.usage_only)


# --- agents -------------------------------------------------------------------------------


@query
def agent_metrics(d: Desk) -> DataFrame:
    return present(agents.agent_metrics(d.ticket_features))


def _agent_macros(d: Desk) -> DataFrame:
    return agents.agent_macro_usage(d.tickets, d.usage_only, d.indexed)


@query
def agent_macro_usage(d: Desk) -> DataFrame:
    return present(_agent_macros(d))


@query
def agent_usage_metrics(d: Desk) -> DataFrame:
    return present(agents.agent_usage_metrics(d.usage, d.tickets))


def _selection(d: Desk) -> DataFrame:
    return agents.agent_selection(agents.agent_metrics(d.ticket_features, median=False), _agent_macros(d))


@query
def agent_selection(d: Desk) -> DataFrame:
    return present(
        _selection(d), "agent_id", "agent_effectiveness_score", "avg_macro_effectiveness", "unique_macros_used",
        "total_macro_uses",
    )


@query
def agent_correlation(d: Desk) -> DataFrame:
    return present(agents.agent_correlation(_selection(d)))


@query
def agent_top_insight(d: Desk) -> DataFrame:
    return present(agents.agent_top_insight(agents.agent_usage_metrics(d.usage, d.tickets)))


@query
def top_agents(d: Desk) -> DataFrame:
    selection = _selection(d)
    best = agents.top_agents(selection).select(F.lit("score").alias("listing"), "agent_id")
    choosers = agents.top_agents(selection, "avg_macro_effectiveness").select(
        F.lit("macro choice").alias("listing"), "agent_id"
    )
    rated = agents.top_agents(selection, "avg_csat", 15).select(F.lit("csat").alias("listing"), "agent_id")
    return present(best.unionByName(choosers).unionByName(rated))


@query
def agent_recommendations(d: Desk) -> DataFrame:
    used = features.usage_outcomes(d.usage_only, d.tickets, ["ticket_id", "agent_id"])
    return present(agents.agent_recommendations(d.tickets.select("agent_id"), used, d.indexed, min_index=60.0))


# --- trends ---------------------------------------------------------------------------------


@query
def daily_metrics(d: Desk) -> DataFrame:
    daily = trends.daily_metrics(d.ticket_features)
    return present(daily.drop("csat_7d_avg", "handle_time_7d_avg", "macro_adoption_7d_avg"))


@query
def rolling_7(d: Desk) -> DataFrame:
    daily = trends.daily_metrics(d.ticket_features)
    return present(daily, "date", "csat_7d_avg", "handle_time_7d_avg", "macro_adoption_7d_avg")


@query
def anomaly_flags(d: Desk) -> DataFrame:
    flagged = trends.anomaly_flags(trends.daily_metrics(d.ticket_features))
    return present(
        flagged, "date", "avg_csat_anomaly", "avg_handle_time_anomaly", "macro_adoption_rate_anomaly", "any_anomaly"
    )


@query
def weekly_macro_usage(d: Desk) -> DataFrame:
    return trends.weekly_macro_usage(d.usage_only)


@query
def category_trends(d: Desk) -> DataFrame:
    return trends.category_trends(d.usage_only, d.macros)


@query
def usage_trend(d: Desk) -> DataFrame:
    weeks = ["1998-01-05/1998-01-11", "1998-01-12/1998-01-18"]
    return present(trends.usage_trend(d.usage_only, d.indexed, weeks))


# --- recommendations, reports, exports ----------------------------------------------------------


@query
def category_affinity(d: Desk) -> DataFrame:
    return present(recommend.category_affinity(d.tickets, d.usage_only, d.macros))


@query
def category_affinity_matrix(d: Desk) -> DataFrame:
    long = recommend.category_affinity(d.tickets, d.usage_only, d.macros)
    return present(recommend.affinity_matrix(long, [*PART_CATEGORIES, "standard"]))


@query
def topk_per_category(d: Desk) -> DataFrame:
    return present(
        recommend.top_per_category(d.indexed), "category", F.col("_r").alias("rank"), "macro_id",
        "macro_effectiveness_index",
    )


@query
def rule_recommendations(d: Desk) -> DataFrame:
    affinity = recommend.category_affinity(d.tickets, d.usage_only, d.macros)
    types = d.tickets.select(F.col("contact_driver").alias("ticket_type")).distinct()
    unseen = d.table("region").select(F.lower("r_name").alias("ticket_type"))
    return present(recommend.rule_recommendations(affinity, d.indexed, types.unionByName(unseen)))


@query
def quick_wins(d: Desk) -> DataFrame:
    return present(recommend.quick_wins(d.indexed, 60.0), "macro_id", "macro_effectiveness_index", "usage_count")


@query
def low_usage(d: Desk) -> DataFrame:
    """Macros with fewer uses than a score needs: the second list of the quick wins."""
    return present(recommend.low_usage(d.indexed), "macro_id", "macro_name", "usage_count")


@query
def macro_sequence_steps(d: Desk) -> DataFrame:
    """The macros of each ticket's sequence, one row a place."""
    steps = d.tickets.where("macro_sequence <> ''").select(
        "ticket_id", F.posexplode(F.split("macro_sequence", ",")).alias("at", "macro_id")
    )
    return present(steps.select("ticket_id", (F.col("at") + 1).alias("position"), "macro_id"))


@query
def short_names(d: Desk) -> DataFrame:
    """Names cut for lists: 30 characters for the console, 50 for exports."""
    name = F.concat_ws(" ", "macro_name", "category", "macro_name")
    return present(d.macros.select("macro_id", F.substring(name, 1, 30).alias("short_name"), F.substring(name, 1, 50).alias("export_name")))


@query
def action_items_export(d: Desk) -> DataFrame:
    return present(recommend.action_items_export(d.indexed))


@query
def eval_landscape(d: Desk) -> DataFrame:
    return present(recommend.eval_landscape(d.indexed))


@query
def eval_recommendations(d: Desk) -> DataFrame:
    return present(recommend.eval_recommendations(d.categorized, topics.cluster_summary(d.owned)))


@query
def explorer_filter(d: Desk) -> DataFrame:
    found = recommend.explorer_filter(d.indexed, category="promo", level="Medium", min_usage=10)
    return present(found, "macro_id", "macro_name", "macro_effectiveness_index", "usage_count")


@query
def explorer_compare(d: Desk) -> DataFrame:
    return present(recommend.explorer_compare(d.indexed, 3, 18))


@query
def scatter_usage(d: Desk) -> DataFrame:
    return present(recommend.scatter_usage(d.indexed))


@query
def macro_impact(d: Desk) -> DataFrame:
    return present(reports.macro_impact(d.ticket_features))


@query
def driver_volume(d: Desk) -> DataFrame:
    return reports.driver_volume(d.tickets)


@query
def category_perf(d: Desk) -> DataFrame:
    return present(reports.category_perf(d.indexed))


@query
def exp_category_stats(d: Desk) -> DataFrame:
    return present(reports.category_stats(d.indexed))


@query
def exp_ticket_summary(d: Desk) -> DataFrame:
    return present(reports.ticket_summary(d.ticket_features))


@query
def kpi_overview(d: Desk) -> DataFrame:
    return present(reports.kpi_overview(d.indexed, d.tickets))


@query
def report_totals(d: Desk) -> DataFrame:
    return present(reports.report_totals(d.indexed, d.tickets))


@query
def report_tier_counts(d: Desk) -> DataFrame:
    return present(reports.tier_counts(d.indexed))


@query
def crosstab_heatmap(d: Desk) -> DataFrame:
    return reports.crosstab_heatmap(d.indexed)


@query
def rollup_hierarchy(d: Desk) -> DataFrame:
    return present(reports.rollup_hierarchy(d.owned))


@query
def treemap_cluster(d: Desk) -> DataFrame:
    return present(reports.treemap_cluster(d.owned))


@query
def histogram_index(d: Desk) -> DataFrame:
    return present(reports.histogram_index(d.indexed))


@query
def cluster_display(d: Desk) -> DataFrame:
    return present(reports.cluster_display(topics.cluster_summary(d.owned)))


@query
def consolidation_candidates(d: Desk) -> DataFrame:
    return present(reports.consolidation_candidates(topics.cluster_summary(d.owned)), "cluster_id", "cluster_label", "num_macros")


@query
def consolidation_review(d: Desk) -> DataFrame:
    """Clusters to review with a higher bar than the candidates: five macros or more, mean effectiveness below 75."""
    return present(reports.consolidation_review(topics.cluster_summary(d.owned), 5, 75.0), "cluster_id", "cluster_label", "num_macros")


@query
def cluster_summary(d: Desk) -> DataFrame:
    return present(topics.cluster_summary(d.owned))


# --- experiments -------------------------------------------------------------------------------


@query
def macro_stats_ab(d: Desk) -> DataFrame:
    return present(experiments.macro_stats(d.usage_only, d.tickets))


def _batch(d: Desk, alpha: float = 0.05) -> DataFrame:
    return experiments.ab_batch(d.usage_only, d.tickets, d.indexed, min_samples=20, alpha=alpha)


@query
def ab_batch(d: Desk) -> DataFrame:
    return present(
        _batch(d), "macro_a", "macro_b", "n_a", "n_b", "csat_t_stat", "csat_effect_size", "handle_time_t_stat",
        "handle_time_effect_size",
    )


@query
def compare_macros(d: Desk) -> DataFrame:
    """Tests of the comparable pairs with p values, significance and winners."""
    return present(
        _batch(d), "macro_a", "macro_b", "csat_p_value", "csat_significant", "csat_winner",
        "handle_time_p_value", "handle_time_significant", "handle_time_winner",
    )


@query
def ab_summary(d: Desk) -> DataFrame:
    return experiments.ab_summary(_batch(d, alpha=0.3))


@query
def ab_findings(d: Desk) -> DataFrame:
    return present(experiments.ab_findings(_batch(d, alpha=0.3), d.macros))


@query
def sample_size(d: Desk) -> DataFrame:
    return present(experiments.required_samples(d.usage_only, d.tickets))


# --- text -----------------------------------------------------------------------------------------


def _combined(d: Desk) -> DataFrame:
    """Cleaned name, category and body of every reply text."""
    return texts.prepare_texts(d.reply_texts).select("macro_id", "cleaned_text")


def _bodies(d: Desk) -> DataFrame:
    return texts.prepare_bodies(d.reply_texts).select("macro_id", "cleaned_text")


def _topic_model(d: Desk):
    prepared = stage(_combined(d))
    return prepared, texts.fit_macro_tfidf(prepared)


@query
def clean_text(d: Desk) -> DataFrame:
    docs = spread(d.table("documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5(X.clean_text("text")).alias("digest"))


@query
def remove_boilerplate(d: Desk) -> DataFrame:
    """Courtesy phrases put around real texts, then removed; and a caller's own pattern."""
    docs = spread(d.table("documents").select("doc_id", "text"))
    framed = F.concat(F.lit("Dear Customer,  "), "text", F.lit("  THANKS, Best regards"))
    return docs.select(
        "doc_id", F.md5(X.remove_boilerplate(framed)).alias("digest"),
        F.md5(X.remove_boilerplate("text", [r"[0-9]+"])).alias("own_digest"),
    )


@query
def title_case(d: Desk) -> DataFrame:
    docs = spread(d.table("documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5(X.title_case("text")).alias("digest"))


@query
def macro_texts(d: Desk) -> DataFrame:
    return _combined(d).select("macro_id", F.md5("cleaned_text").alias("digest"), F.length("cleaned_text").cast("long").alias("n_chars"))


@query
def tfidf_terms(d: Desk) -> DataFrame:
    prepared, model = _topic_model(d)
    return present(texts.tfidf_terms(model, prepared))


@query
def tfidf_apply(d: Desk) -> DataFrame:
    """Vocabulary and weights of the documents reused on conversation turns."""
    _, model = _topic_model(d)
    turns = d.table("conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("macro_id"), X.clean_text("text").alias("cleaned_text")
    )
    return present(texts.tfidf_terms(model, spread(turns)))


@query
def top_terms(d: Desk) -> DataFrame:
    prepared, model = _topic_model(d)
    return present(texts.top_terms(model, prepared))


@query
def tfidf_vectors(d: Desk) -> DataFrame:
    """Non-zero entries and length of each vector handed to the clustering."""
    prepared, model = _topic_model(d)
    v = vector_to_array("features")
    return present(
        model.transform(prepared).select(
            "macro_id", F.size(F.filter(v, lambda x: x > 0)).alias("n_terms"),
            F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x).alias("length"),
        )
    )


@query
def cosine_pairs(d: Desk) -> DataFrame:
    return present(similarity.cosine_pairs(_bodies(d)))


@query
def cosine_pairs_unigram(d: Desk) -> DataFrame:
    raw = d.reply_texts.select("macro_id", F.lower(F.coalesce("macro_body", F.lit(""))).alias("cleaned_text"))
    return present(similarity.cosine_pairs(raw, 0.5, ngrams=(1, 1)))


def _redundant(d: Desk, threshold: float = 0.8, **form) -> DataFrame:
    return similarity.redundant_pairs(_bodies(d), d.indexed, threshold, **form)


@query
def redundant_pairs(d: Desk) -> DataFrame:
    return present(similarity.sorted_pairs(_redundant(d)))


@query
def pairs_threshold(d: Desk) -> DataFrame:
    return present(similarity.pairs_threshold(_redundant(d, 0.9, form="pairs"), 0.9), "macro_a", "macro_b", "similarity")


@query
def near_dup_approx(d: Desk) -> DataFrame:
    """Candidates from bands of signed projections, verified exactly: the scale form of the redundant pairs."""
    return present(similarity.near_duplicates_approx(_combined(d), 0.95, recall=0.999), "macro_a", "macro_b", "n_pairs")


@query
def similarity_edges(d: Desk) -> DataFrame:
    return present(similarity.similarity_edges(_redundant(d, strongest=30), 30))


@query
def similarity_stats(d: Desk) -> DataFrame:
    return present(similarity.similarity_stats(similarity.similarity_counts(_bodies(d))))


@query
def histogram_sim(d: Desk) -> DataFrame:
    return present(similarity.similarity_histogram(similarity.similarity_counts(_bodies(d))))


@query
def similarity_sample(d: Desk) -> DataFrame:
    return present(similarity.similarity_sample(_bodies(d)))


@query
def tier_summary(d: Desk) -> DataFrame:
    return reports.tier_summary(d.indexed, _redundant(d, form="summed")).withColumn("redundant_pairs", F.col("redundant_pairs").cast("long"))


# --- topics ----------------------------------------------------------------------------------------


def _topics(d: Desk):
    prepared, model = _topic_model(d)
    vectors = stage(model.transform(prepared).select("macro_id", "features"))
    return prepared, model, vectors, topics.fit_kmeans(vectors)


@query
def kmeans_topics(d: Desk) -> DataFrame:
    _, _, vectors, clusters = _topics(d)
    return present(topics.assign_topics(clusters, vectors), "macro_id", "cluster_id")


@query
def cluster_labels(d: Desk) -> DataFrame:
    """Labels of fixed groups: the source of each text stands for its cluster."""
    prepared, model = _topic_model(d)
    members = d.reply_texts.select("macro_id", F.col("source").alias("cluster_id"))
    return topics.cluster_labels(texts.tfidf_terms(model, prepared), members)


@query
def cluster_macros(d: Desk) -> DataFrame:
    """Topic clusters of the reply texts with labels, scores and categories."""
    prepared, model, vectors, clusters = _topics(d)
    weights = texts.tfidf_terms(model, prepared)
    return present(
        topics.cluster_macros(d.categorized, vectors, weights, clusters), "macro_id", "cluster_id", "cluster_label",
        "macro_effectiveness_index", "macro_category",
    )


@query
def sink_model(d: Desk) -> DataFrame:
    """Saved models assign the same topics after loading."""
    prepared, model, vectors, clusters = _topics(d)
    path = topics.save_models(work_folder(d.spark, "models"), model, clusters)
    again = topics.load_models(path).transform(model.with_terms(prepared)).select("macro_id", F.col("cluster_id").alias("c"))
    both = topics.assign_topics(clusters, vectors).join(again, "macro_id")
    return both.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c") == F.col("cluster_id")).alias("n_same")
    ).select(F.col("cluster_id").cast("long").alias("cluster_id"), "n", "n_same")


def _embeddings(d: Desk) -> DataFrame:
    e = d.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    return e.withColumn("features", array_to_vector("v"))


@query
def elbow_sweep(d: Desk) -> DataFrame:
    return present(topics.elbow_sweep(stage(_embeddings(d)), "vec_id"))


@query
def silhouette(d: Desk) -> DataFrame:
    points = _embeddings(d).select("vec_id", "v", F.array("label").alias("l"))
    return present(topics.silhouettes(points, "vec_id", "v", "l"), "vec_id", "cluster", "silhouette")


@query
def silhouette_by_cluster(d: Desk) -> DataFrame:
    points = _embeddings(d).select("vec_id", "v", F.array("label").alias("l"))
    return present(topics.silhouette_by_cluster(stage(topics.silhouettes(points, "vec_id", "v", "l"))))


@query
def pca_2d(d: Desk) -> DataFrame:
    projected, _, _ = topics.pca_2d(stage(_embeddings(d)), "vec_id")
    return present(projected)


@query
def pca_centres(d: Desk) -> DataFrame:
    """Cluster centres on the two components, with each component's share of the variance (the last row, cluster -1)."""
    vectors = stage(_embeddings(d))
    _, centres, shares = topics.pca_2d(vectors, "vec_id", topics.fit_kmeans(vectors.select("vec_id", "features"), 4, restarts=3))
    share = d.spark.createDataFrame([(-1, *shares)], "cluster_id int, pc1 double, pc2 double")
    return present(centres.select(F.col("cluster_id").cast("int").alias("cluster_id"), "pc1", "pc2").unionByName(share))


# --- prediction ---------------------------------------------------------------------------------------


@query
def predictor_training_set(d: Desk) -> DataFrame:
    ticket_texts = d.table("documents").select(F.col("doc_id").alias("ticket_id"), "text")
    chosen = predict.training_set(ticket_texts, d.usage_only, d.indexed)
    return chosen.select("ticket_id", "macro_id", F.md5("text").alias("digest"))


def _ticket_texts(d: Desk) -> DataFrame:
    return spread(d.table("documents").select(F.col("doc_id").alias("ticket_id"), "text"))


def _predictor(d: Desk):
    """Fitted on the predictor's own training set: texts of tickets that a macro of the better half answered first."""
    return predict.fit_predictor(predict.training_set(_ticket_texts(d), d.usage_only, d.indexed))


def _turns(d: Desk) -> DataFrame:
    return d.table("conversations").select(F.concat_ws("-", "conv_id", "turn").alias("ticket_id"), "text")


@query
def predictor_fit(d: Desk) -> DataFrame:
    """Most important terms of the fitted forests."""
    model, _ = _predictor(d)
    rows = [(t, float(w)) for t, w in zip(model.tfidf.terms, model.importances)]
    terms = d.spark.createDataFrame(rows, "term string, importance double")
    return present(terms.orderBy(F.desc("importance"), "term").limit(20))


@query
def predictor_fit_checks(d: Desk) -> DataFrame:
    """What any fit must give: replies and rows of the training set, terms, importances that add up to 1."""
    model, _ = _predictor(d)
    numbers = model.classes.agg(
        F.count(F.lit(1)).alias("n_classes"), F.countDistinct("class").alias("n_numbers"), F.max("class").alias("last_number")
    )
    return present(
        numbers.select(
            "*", F.lit(model.n_samples).alias("n_samples"), F.lit(len(model.tfidf.terms)).alias("n_terms"),
            F.lit(round(sum(model.importances), 6)).alias("importance"),
        )
    )


@query
def predictor_metrics(d: Desk) -> DataFrame:
    model, held_out = _predictor(d)
    return present(model.evaluate(held_out))


@query
def predictor_metrics_checks(d: Desk) -> DataFrame:
    """Shares between 0 and 1, the first place never more often right than the first three."""
    model, held_out = _predictor(d)
    ok = (F.col("accuracy") >= 0) & (F.col("accuracy") <= F.col("top3_accuracy")) & (F.col("top3_accuracy") <= 1)
    return present(model.evaluate(held_out).select(ok.alias("in_order"), "n_classes", "n_samples"))


def _checked(best: DataFrame, model: predict.MacroPredictor) -> DataFrame:
    """Per ticket: how many replies it got, whether ranks and confidences are in order, and how many replies are known ones."""
    known = model.classes.select(F.col("macro_id").alias("recommended_macro"), F.lit(1).alias("known"))
    listed = F.sort_array(F.collect_list(F.struct("rank", "confidence")))
    per = best.join(known, "recommended_macro", "left").groupBy("ticket_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("recommended_macro").alias("n_macros"), F.count("known").alias("n_known"),
        listed.alias("_l"),
    )
    falls = F.forall(
        F.sequence(F.lit(0), F.size("_l") - 1),
        lambda i: (F.get("_l", i)["rank"] == i + 1) & F.get("_l", i)["confidence"].between(0, 1)
        & ((i == 0) | (F.get("_l", i)["confidence"] <= F.coalesce(F.get("_l", i - 1)["confidence"], F.lit(1.0)))),
    )
    return per.select("ticket_id", "n_rows", "n_macros", "n_known", falls.alias("in_order"))


@query
def predict_batch(d: Desk) -> DataFrame:
    model, _ = _predictor(d)
    return present(model.predict_batch(_ticket_texts(d)))


@query
def predict_batch_checks(d: Desk) -> DataFrame:
    model, _ = _predictor(d)
    return present(_checked(model.predict_batch(_ticket_texts(d)), model))


@query
def topn_per_ticket(d: Desk) -> DataFrame:
    """Five best macros per conversation turn."""
    model, _ = _predictor(d)
    return present(model.predict_batch(_turns(d), top_n=5))


@query
def topn_checks(d: Desk) -> DataFrame:
    model, _ = _predictor(d)
    return present(_checked(model.predict_batch(_turns(d), top_n=5), model))


# --- sources, sinks and the batch job --------------------------------------------------------------------


@query
def src_csv(d: Desk) -> DataFrame:
    """Tickets written as CSV and read back with the declared schema."""
    columns = [f.name for f in TICKETS if f.name in d.tickets.columns]
    folder = work_folder(d.spark, "tickets_csv")
    write_table(d.tickets.select(*columns), folder, "csv")
    schema = T.StructType([f for f in TICKETS if f.name in columns])
    return present(read_csv(d.spark, folder, schema))


@query
def src_csv_report(d: Desk) -> DataFrame:
    """Tickets with bad dates, ratings and missing agents written as CSV; what the reader counts and puts aside, and what is left."""
    k = F.col("ticket_id")
    columns = [f.name for f in TICKETS if f.name in d.tickets.columns]
    spoiled = d.tickets.select(*[F.col(c).cast("string").alias(c) for c in columns]).withColumns(
        {
            "created_at": F.when(k % 50 == 0, "no date").otherwise(F.col("created_at")),
            "resolved_at": F.when(k % 41 == 0, "31/12/1997 25:00").otherwise(F.col("resolved_at")),
            "csat_score": F.when(k % 70 == 0, "five").otherwise(F.col("csat_score")),
            "agent_id": F.when(k % 90 == 0, None).otherwise(F.col("agent_id")),
            "csat_response": F.when(k % 3 == 0, F.concat(F.lit('said "fine", '), k.cast("string"))),
        }
    )
    folder = work_folder(d.spark, "tickets_spoiled")
    write_table(spoiled, folder, "csv")
    taken = ingest_csv(d.spark, folder, "tickets", work_folder(d.spark, "tickets_taken"))
    observed = d.spark.createDataFrame([(c, n) for c, n in taken.counts.items() if n], "measure string, n long")
    left = taken.table.agg(
        F.count(F.lit(1)).alias("kept"), F.count("resolved_at").alias("with_resolved_at"), F.count("csat_response").alias("with_response")
    )
    aside = taken.rejected.agg(F.count_if(F.array_contains("_unparsed", "created_at")).alias("aside_for_created_at"))
    rows = [
        df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("n")) for c in df.columns])).alias("m")).select("m.*")
        for df in (left, aside)
    ]
    return present(observed.unionByName(rows[0]).unionByName(rows[1]))


@query
def job_resumed(d: Desk) -> DataFrame:
    """Single steps that start from saved tables: the manifest after a run of two steps and a later run of the third without inputs."""
    from replyscope.plans.job import manifest, run

    out = work_folder(d.spark, "job_resumed")
    run(d.tickets, d.macros, d.usage_only, out, ["clean", "features"])
    run(None, None, None, out, ["score"], spark=d.spark)
    return present(manifest(d.spark, out), "table", "step", "n_rows")


@query
def sink_table(d: Desk) -> DataFrame:
    """Macro uses partitioned by month and read back for one year: other months are pruned."""
    return _month_counts(_uses_by_month(d).where(F.col("month").between("1997-01", "1997-12")))


@query
def sink_table_months(d: Desk) -> DataFrame:
    """Macro uses partitioned by month and all read back: uses of every month, null for uses without a time."""
    return _month_counts(_uses_by_month(d))


def _uses_by_month(d: Desk) -> DataFrame:
    month = F.date_format("applied_at", "yyyy-MM")
    folder = write_table(
        d.usage_only.withColumn("month", month).repartition("month"), work_folder(d.spark, "usage"), partition_by=["month"]
    )
    return read_parquet(d.spark, folder)


def _month_counts(uses: DataFrame) -> DataFrame:
    return uses.groupBy("month").agg(F.count(F.lit(1)).alias("n_uses")).select(F.col("month").cast("string").alias("month"), "n_uses")


@query
def sink_multi(d: Desk) -> DataFrame:
    """Row counts of the export tables after writing and reading them."""
    tables = reports.export_bundle(d.indexed, d.ticket_features, trends.daily_metrics(d.ticket_features))
    return _written(d, tables, "bundle", "parquet")


@query
def sink_csv_exports(d: Desk) -> DataFrame:
    return _written(d, reports.csv_exports(d.indexed), "exports", "csv")


def _written(d: Desk, tables: dict[str, DataFrame], name: str, fmt: str) -> DataFrame:
    paths = write_bundle(tables, work_folder(d.spark, name), fmt)
    read = d.spark.read.option("header", True).option("escape", '"') if fmt == "csv" else d.spark.read
    counts = None
    for table, path in paths.items():
        n = read.format(fmt).load(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(table).alias("table_name"), "n_rows"
        )
        counts = n if counts is None else counts.unionByName(n)
    return counts


@query
def job_all(d: Desk) -> DataFrame:
    """The whole batch on the mapped tables; row counts of what it wrote."""
    from replyscope.plans.job import run

    out = run(d.tickets, d.macros, d.usage_only, work_folder(d.spark, "job"))
    counts = None
    for table, path in out.items():
        n = d.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(table).alias("table_name"), "n_rows"
        )
        counts = n if counts is None else counts.unionByName(n)
    return counts
