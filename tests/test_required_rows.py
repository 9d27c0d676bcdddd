"""Row checks report nulls in every column that the schemas require."""

import pytest
from pyspark.sql import functions as F

from replyscope.operators import quality


def _one(spark, columns):
    return spark.sql("SELECT " + ", ".join(f"{v} AS {k}" for k, v in columns.items()))


TICKET = {
    "ticket_id": "'T'", "created_at": "timestamp_ntz'2024-01-01 10:00:00'", "status": "'open'", "channel": "'chat'",
    "priority": "'low'", "contact_driver": "'x'", "first_response_time_minutes": "1D", "total_handle_time_minutes": "1D",
    "replies_count": "1", "reopens_count": "0", "csat_score": "CAST(NULL AS INT)", "agent_id": "'A'",
}
MACRO = {
    "macro_id": "'M'", "macro_name": "'n'", "category": "'billing'", "macro_body": "'b'",
    "created_at": "timestamp_ntz'2024-01-01 10:00:00'", "updated_at": "timestamp_ntz'2024-01-01 10:00:00'", "owner_team": "'t'",
}
USAGE = {
    "ticket_id": "'T'", "macro_id": "'M'", "applied_at": "timestamp_ntz'2024-01-01 10:00:00'", "position_in_thread": "1",
    "agent_id": "'A'", "channel": "'chat'",
}
SCORE = {
    "macro_id": "'M'", "macro_name": "'n'", "category": "'c'", "usage_count": "1", "avg_csat": "4D", "avg_handle_time": "1D",
    "reopen_rate": "0D", "csat_component": "1D", "handle_time_component": "1D", "reopen_component": "1D",
    "macro_effectiveness_index": "1D", "macro_category": "'c'", "has_sufficient_usage": "true", "effectiveness_percentile": "1D",
}
CLUSTER = {
    "cluster_id": "0", "cluster_label": "'l'", "num_macros": "0", "avg_effectiveness": "1D", "median_effectiveness": "1D",
    "total_usage": "0", "avg_usage": "0D", "num_underused_gems": "0", "num_low_effectiveness": "0", "consolidation_candidate": "false",
}


@pytest.mark.parametrize("check, columns, optional", [
    (quality.check_ticket_rows, TICKET, {"csat_score"}), (quality.check_macro_rows, MACRO, set()), (quality.check_usage_rows, USAGE, set()),
    (quality.check_score_rows, SCORE, {"effectiveness_percentile"}), (quality.check_cluster_rows, CLUSTER, set()),
])
def test_each_required_column(spark, check, columns, optional):
    whole = _one(spark, columns)
    out = check(whole)
    cases = out.select(F.lit("").alias("spoiled"), "violations")
    for c in columns:
        spoiled = whole.withColumn(c, F.lit(None).cast(whole.schema[c].dataType))
        cases = cases.unionByName(check(spoiled).select(F.lit(c).alias("spoiled"), "violations"))
    got = {r.spoiled: r.violations for r in cases.collect()}
    assert got == {"": []} | {c: [] if c in optional else [f"{c}_missing"] for c in columns}


def test_bounds_of_clusters(spark):
    bad = _one(spark, CLUSTER | {"num_macros": "-1", "avg_usage": "-1D"})
    assert quality.check_cluster_rows(bad).first().violations == ["num_macros_below_0", "avg_usage_below_0"]
