"""One support desk: input tables and the derived tables that several queries read."""

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.operators import cleaning, features, scoring
from replyscope.sources.fixtures import Library
from replyscope.sources.tables import stage


class Desk(Library):
    @cached_property
    def ticket_features(self) -> DataFrame:
        return features.ticket_features(self.tickets, self.usage_only, first_last=False)

    @cached_property
    def features(self) -> DataFrame:
        """Macro features without medians, kept: scores read them for rows, limits and ranks."""
        return stage(features.macro_features(self.usage_only, self.tickets, self.macros, medians=False))

    @cached_property
    def indexed(self) -> DataFrame:
        """Scores without the percentile, kept like the other macro-sized tables."""
        return stage(scoring.macro_index(self.features, scoring.baseline_overall(self.tickets)))

    @cached_property
    def scores(self) -> DataFrame:
        return stage(scoring.add_percentile(self.indexed))

    @cached_property
    def categorized(self) -> DataFrame:
        return stage(scoring.categorize_macros(self.scores))

    @cached_property
    def owned(self) -> DataFrame:
        """Scored macros grouped by a fixed column standing for a topic cluster."""
        return self.categorized.withColumns(
            {"cluster_id": F.regexp_extract("owner_team", "[0-9]+", 0).cast("int"), "cluster_label": F.col("owner_team")}
        )

    @cached_property
    def raw_tickets(self) -> DataFrame:
        """Tickets with some broken fields, to be found by the checks."""
        k = F.col("ticket_id")
        return self.tickets.withColumns(
            {
                "csat_score": F.when(k % 101 == 0, 9).otherwise(F.col("csat_score")),
                "total_handle_time_minutes": F.when(k % 103 == 0, -1.0).otherwise(
                    F.col("total_handle_time_minutes")
                ),
                "status": F.when(k % 107 == 0, "lost").otherwise(F.upper("status")),
                "ticket_id": F.when(k % 109 == 0, k + 1).otherwise(k),
            }
        )

    @cached_property
    def raw_macros(self) -> DataFrame:
        k = F.col("macro_id")
        return self.macros.withColumns(
            {
                "macro_body": F.when(k % 41 == 0, "").when(k % 43 == 0, None).otherwise(
                    F.concat(F.lit("  "), "macro_body", F.lit("\t"))
                ),
                "category": F.upper("category"),
                "macro_id": F.when(k % 47 == 0, k + 1).otherwise(k),
            }
        )

    @cached_property
    def raw_usage(self) -> DataFrame:
        """Uses with missing parents and bad positions."""
        t, m, p = F.col("ticket_id"), F.col("macro_id"), F.col("position_in_thread")
        return self.usage_only.withColumns(
            {
                "position_in_thread": F.when((t + m) % 53 == 0, 0).otherwise(p),
                "macro_id": F.when((t + p) % 59 == 0, -m).otherwise(m),
                "ticket_id": F.when((m + p) % 61 == 0, -1 - t).otherwise(t),
            }
        )

    @cached_property
    def clean(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return (
            cleaning.clean_tickets(self.tickets),
            cleaning.clean_macros(self.raw_macros),
            cleaning.clean_usage(self.raw_usage),
        )
