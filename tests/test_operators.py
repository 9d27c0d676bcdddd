import pytest
from result_rows import rows
from pyspark.sql import functions as F

from replyscope.operators import (
    agents, cleaning, experiments, features, quality, recommend, reports, scoring, topics, trends,
)


def test_clean_tickets(desk_tables):
    tickets, _, _ = desk_tables
    got = cleaning.clean_tickets(tickets)
    assert rows(got, "ticket_id", "resolution_time_minutes", "is_reopened", "is_high_priority", "resolved_same_day", "has_macro") == [
        ("T1", 150.0, False, True, True, True), ("T2", 1440.0, True, False, False, False),
        ("T3", None, False, True, False, True), ("T4", 30.0, True, False, True, True),
    ]


def test_clean_from_text_columns(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "bad", "x")], "created_at string, resolved_at string, ticket_id string")
    df = df.withColumns({"reopens_count": F.lit(0), "priority": F.lit("low"), "macro_sequence": F.lit(None).cast("string"),
                         "final_macro_id": F.lit(None).cast("string")})
    row = cleaning.clean_tickets(df).first()
    assert row.resolved_at is None and str(row.created_at) == "2024-01-01 00:00:00" and not row.has_macro


def test_referential_filter(desk_tables):
    tickets, macros, usage = desk_tables
    assert cleaning.referential_filter(usage, tickets, macros).count() == 4
    counts = dict(rows(cleaning.stage_counts(tickets, macros, usage)))
    assert counts["macro_usage_removed"] == 1


def test_ticket_features(desk_tables):
    tickets, _, usage = desk_tables
    got = rows(features.ticket_features(tickets, usage), "ticket_id", "num_macros_used", "first_macro_id", "last_macro_id", "is_macro_used")
    assert got == [("T1", 2, "M1", "M2", True), ("T2", 0, "", "", False), ("T3", 1, "M1", "M1", True), ("T4", 1, "M3", "M3", True)]


def test_macro_features(desk_tables):
    tickets, macros, usage = desk_tables
    got = rows(features.macro_features(usage, tickets, macros), "macro_id", "usage_count", "avg_csat", "median_handle_time", "reopen_rate")
    assert got == [("M1", 3, 4.0, 15.0, 0.0), ("M2", 1, 4.0, 20.0, 0.0), ("M3", 1, 5.0, 30.0, 1.0), ("M4", 0, 0.0, 0.0, 0.0)]


def test_baseline(spark):
    df = spark.createDataFrame([(4, 10.0, 0), (3, 10.0, 1), (5, 10.0, 0), (2, 10.0, 0), (4, 10.0, 0)],
                               "csat_score int, total_handle_time_minutes double, reopens_count int")
    row = scoring.baseline_overall(df).first()
    assert row.avg_csat == pytest.approx(3.6) and row.reopen_rate == pytest.approx(0.2)


@pytest.fixture()
def scored(spark):
    data = [("M1", 100, 4.5, 10.0, 0.1), ("M2", 50, 3.0, 30.0, 0.3), ("M3", 3, 5.0, 5.0, 0.0), ("M4", 0, 0.0, 0.0, 0.0), ("M5", 8, 4.0, 20.0, 0.2)]
    df = spark.createDataFrame(data, "macro_id string, usage_count long, avg_csat double, avg_handle_time double, reopen_rate double")
    df = df.withColumns({"category": F.lit("billing"), "macro_name": F.col("macro_id"), "is_active": F.lit(True)})
    base = spark.createDataFrame([(4.0, 15.0, 0.1)], "avg_csat double, avg_handle_time double, reopen_rate double")
    return scoring.categorize_macros(scoring.macro_scores(df, base))


def test_macro_scores(scored):
    got = {r.macro_id: r for r in scored.collect()}
    m1 = 0.4 * 90 + 0.3 * 100 * (1 - 10 / 30) + 0.3 * 100 * (1 - 0.1 / 0.3)
    assert got["M1"].macro_effectiveness_index == pytest.approx(m1)
    assert got["M3"].macro_effectiveness_index == 0 and got["M3"].csat_component == 50
    assert got["M4"].effectiveness_percentile == pytest.approx(30.0)  # two zeros share ranks 1 and 2
    assert got["M3"].macro_category == got["M4"].macro_category == "Unused/Low Usage"
    assert got["M1"].macro_category == "High Impact (Popular)"
    assert got["M1"].csat_lift == pytest.approx(0.5)


def test_listings(scored):
    assert [r.macro_id for r in scoring.top_macros(scored, 2).collect()] == ["M1", "M5"]
    assert [(r.macro_id, r.issue) for r in scoring.bottom_macros(scored, 2).collect()] == [("M2", "Poor performance"), ("M5", "Low usage")]
    assert rows(recommend.action_items_export(scored), "macro_id") == [("M2",), ("M3",), ("M4",)]
    assert reports.report_totals(scored, scored).first().total_uses == 161


def test_agent_recommendations(spark):
    scores = spark.createDataFrame(
        [("M1", 95.0, True), ("M2", 90.0, True), ("M3", 75.0, True), ("M4", 85.0, True), ("M5", 99.0, False), ("M6", 60.0, True)],
        "macro_id string, macro_effectiveness_index double, has_sufficient_usage boolean",
    ).withColumns({"macro_name": F.col("macro_id"), "category": F.lit("c"), "usage_count": F.lit(9)})
    used = spark.createDataFrame([("A1", "M1"), ("A1", "M2"), ("A1", "M1"), ("A3", "M4"), ("A3", "M6")], "agent_id string, macro_id string")
    people = spark.createDataFrame([("A1",), ("A2",), ("A3",)], "agent_id string")
    got = agents.agent_recommendations(people, used, scores, 2)
    assert rows(got, "agent_id", "rank", "macro_id") == [
        ("A1", 1, "M4"), ("A1", 2, "M3"), ("A2", 1, "M1"), ("A2", 2, "M2"), ("A3", 1, "M1"), ("A3", 2, "M2")
    ]


def test_agent_metrics(desk_tables):
    tickets, _, usage = desk_tables
    got = {r.agent_id: r for r in agents.agent_metrics(features.ticket_features(tickets, usage)).collect()}
    assert got["A1"].avg_csat == 3.0 and got["A1"].median_handle_time == 30.0 and got["A1"].macro_adoption_rate == 0.5
    assert got["A2"].csat_rank == 1.0 and got["A1"].handle_time_rank == 2.0


def test_anomaly_on_day_eight(spark):
    days = [(i, 1.0 if i == 8 else 4.0, 20.0, 0.5) for i in range(1, 11)]
    daily = spark.createDataFrame(days, "date int, avg_csat double, avg_handle_time double, macro_adoption_rate double")
    assert rows(trends.anomaly_flags(daily).where("any_anomaly"), "date", "avg_csat_anomaly") == [(8, True)]


def test_daily_and_trend(desk_tables):
    tickets, macros, usage = desk_tables
    daily = trends.daily_metrics(features.ticket_features(tickets, usage))
    assert [(str(r.date), r.total_tickets, r.csat_7d_avg) for r in daily.orderBy("date").collect()] == [
        ("2024-01-01", 1, 4.0), ("2024-01-02", 2, 3.0), ("2024-01-05", 1, pytest.approx(11 / 3))
    ]
    info = macros.withColumn("macro_effectiveness_index", F.lit(1.0))
    assert set(rows(trends.usage_trend(usage, info), "trend_direction")) == {("Stable",)}  # under four weeks


def test_category_counts_ignore_unknown_categories(spark, desk_tables):
    _, macros, usage = desk_tables
    got = trends.category_trends(usage, macros.where("macro_id <> 'M3'"))
    assert rows(got) == [("2024-01-01/2024-01-07", "billing", 4, 2)]


def test_compare_macros(spark):
    df = spark.createDataFrame([("a", "b", 100, 100, 4.5, 0.5, 3.5, 0.5, 10.0, 1.0, 20.0, 1.0)],
                               "macro_a string, macro_b string, n_a int, n_b int, csat_mean_a double, csat_std_a double, csat_mean_b double,"
                               "csat_std_b double, handle_time_mean_a double, handle_time_std_a double, handle_time_mean_b double, handle_time_std_b double")
    row = experiments.compare_macros(df).first()
    assert row.csat_winner == "A" and row.handle_time_winner == "A" and row.csat_significant
    assert row.csat_effect_size == pytest.approx(2.0) and row.csat_t_stat == pytest.approx(14.1421356)
    same = experiments.compare_macros(df.withColumn("csat_mean_b", F.col("csat_mean_a"))).first()
    assert same.csat_winner == "Tie" and same.csat_effect_size == 0 and same.csat_p_value == 1.0


def test_quality(spark, desk_tables):
    tickets, macros, usage = desk_tables
    bad = tickets.unionByName(tickets.where("ticket_id = 'T1'").withColumns({"csat_score": F.lit(10), "status": F.lit("LOST")}))
    assert dict(rows(quality.check_tickets(bad))) == {
        "missing_columns": 0, "duplicate_ticket_id": 1, "csat_out_of_range": 1, "negative_handle_time": 0,
    }
    broken = quality.check_ticket_rows(bad).where("not is_valid").first()
    assert broken.violations == ["status_not_allowed", "csat_score_out_of_range"]
    assert dict(rows(quality.check_macros(macros.withColumn("macro_body", F.lit("")))))["empty_macro_body"] == 4
    assert dict(rows(quality.check_usage(usage.withColumn("position_in_thread", F.lit(0)))))["position_below_one"] == 5
    assert dict(rows(quality.check_usage(usage.drop("position_in_thread")))) == {"missing_columns": 1}
    with pytest.raises(ValueError):
        quality.check_columns(usage, ["nope"])


def test_empty_inputs(spark, desk_tables):
    tickets, macros, usage = desk_tables
    none_t, none_u = tickets.where("false"), usage.where("false")
    f = features.macro_features(none_u, none_t, macros)
    assert {r.usage_count for r in f.collect()} == {0}
    scores = scoring.categorize_macros(scoring.macro_scores(f, scoring.baseline_overall(none_t)))
    assert {r.macro_effectiveness_index for r in scores.collect()} == {0.0}
    assert trends.daily_metrics(features.ticket_features(none_t, none_u)).count() == 0
    assert agents.agent_metrics(features.ticket_features(none_t, none_u)).count() == 0


def test_rollup_and_crosstab(scored):
    df = scored.withColumn("cluster_label", F.lit("x"))
    total = reports.rollup_hierarchy(df).where("grouping_id = 7").first()
    assert total.total_usage == 158
    assert rows(reports.crosstab_heatmap(df)) == [("billing", 3, 1, 1)]


def test_cluster_summary_flag(spark):
    df = spark.createDataFrame([(1, "a", i, 10.0, 1, "Low Effectiveness") for i in range(5)] + [(2, "b", 9, 90.0, 1, "Underused Gem")],
                               "cluster_id int, cluster_label string, macro_id int, macro_effectiveness_index double, usage_count int, macro_category string")
    got = rows(topics.cluster_summary(df), "cluster_id", "num_macros", "median_effectiveness", "num_low_effectiveness", "consolidation_candidate")
    assert got == [(1, 5, 10.0, 5, True), (2, 1, 90.0, 0, False)]
