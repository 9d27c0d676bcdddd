"""The batch run: clean, features, scores, topics, evaluation.

spark-submit replyscope/plans/job.py INPUT_DIR OUTPUT_DIR [step ...]

Every step reads saved tables and saves its own, so a single step resumes from what earlier runs have left. A manifest in the
output folder tells which tables there are.
"""

from __future__ import annotations

import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from replyscope.operators import cleaning, features, quality, recommend, scoring, texts, topics
from replyscope.schemas import (
    NUM_CLUSTERS,
    REQUIRED_MACRO_COLUMNS,
    REQUIRED_TICKET_COLUMNS,
    REQUIRED_USAGE_COLUMNS,
)
from replyscope.sources.tables import ingest_csv, stage, work_folder, write_table

STEPS = ["clean", "features", "score", "cluster", "evaluate"]
#: The tables that a step reads, and the step that saves each table.
READS = {
    "clean": [], "features": ["tickets_clean", "macros_clean", "macro_usage_clean"],
    "score": ["macro_features", "tickets_clean"], "cluster": ["macro_scores"],
    "evaluate": ["macro_clusters", "cluster_summary"],
}
SAVED_BY = {
    "tickets_clean": "clean", "macros_clean": "clean", "macro_usage_clean": "clean", "macro_features": "features",
    "macro_scores": "score", "macro_clusters": "cluster", "cluster_summary": "cluster",
}
MANIFEST = "table string, step string, path string, n_rows long, written_at timestamp"


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The last entry of each table saved below ``out``: table, step, path, n_rows, written_at."""
    try:
        entries = spark.read.schema(MANIFEST).json(f"{out}/manifest")
    except AnalysisException:  # nothing saved yet
        return spark.createDataFrame([], MANIFEST)
    last = F.max_by(F.struct("step", "path", "n_rows", "written_at"), "written_at").alias("e")
    return entries.groupBy("table").agg(last).select("table", "e.*")


def run(
    tickets: DataFrame | None,
    macros: DataFrame | None,
    usage: DataFrame | None,
    out: str,
    steps: list[str] | None = None,
    clusters: int = NUM_CLUSTERS,
    restarts: int = 10,
    spark: SparkSession | None = None,
) -> dict[str, str]:
    """Save the tables of the wanted steps (all by default); returns the paths of the tables saved, by name.

    A table that a step needs is taken from this run, else from the manifest; a step whose tables are nowhere
    runs too. The input tables are read by ``clean`` only and may be None otherwise.
    """
    wanted = list(steps or STEPS)
    unknown = set(wanted) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    spark = spark or (tickets.sparkSession if tickets is not None else SparkSession.active())
    paths = {r["table"]: r["path"] for r in manifest(spark, out).collect()}
    saved: dict[str, str] = {}

    def table(name: str) -> DataFrame:
        return spark.read.parquet(saved.get(name) or paths[name])

    def save(step: str, tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            rows = Observation()
            saved[name] = write_table(df.observe(rows, F.count(F.lit(1)).alias("n")), f"{out}/{name}")
            entry = spark.range(1).select(
                F.lit(name).alias("table"), F.lit(step).alias("step"), F.lit(saved[name]).alias("path"),
                F.lit(rows.get["n"]).cast("long").alias("n_rows"), F.current_timestamp().alias("written_at"),
            )
            entry.write.mode("append").json(f"{out}/manifest")

    done: set[str] = set()

    def perform(step: str) -> None:
        if step in done:
            return
        done.add(step)
        for name in READS[step]:
            if name not in saved and (name not in paths or SAVED_BY[name] in wanted):
                perform(SAVED_BY[name])
        if step == "clean":
            save(step, _cleaned(tickets, macros, usage))
        elif step == "features":
            clean = [table(name) for name in READS["features"]]
            per_macro = features.macro_features(clean[2], clean[0], clean[1])
            save(step, {"ticket_features": features.ticket_features(clean[0], clean[2]), "macro_features": per_macro})
        elif step == "score":
            indexed = stage(scoring.macro_index(table("macro_features"), scoring.baseline_overall(table("tickets_clean"))))
            save(step, {"macro_scores": scoring.categorize_macros(stage(scoring.add_percentile(indexed)))})
        elif step == "cluster":
            save(step, _clustered(table("macro_scores"), out, clusters, restarts))
        else:
            clustered, summary = table("macro_clusters"), table("cluster_summary")
            save(step, {
                "evaluation_landscape": recommend.eval_landscape(clustered),
                "evaluation_recommendations": recommend.eval_recommendations(clustered, summary),
            })

    for step in STEPS:
        if step in wanted:
            perform(step)
    return saved


def _cleaned(tickets: DataFrame | None, macros: DataFrame | None, usage: DataFrame | None) -> dict[str, DataFrame]:
    if tickets is None or macros is None or usage is None:
        raise ValueError("no saved tables to start from: the input tables are needed")
    quality.check_columns(tickets, REQUIRED_TICKET_COLUMNS, "tickets")
    quality.check_columns(macros, REQUIRED_MACRO_COLUMNS, "macros")
    quality.check_columns(usage, REQUIRED_USAGE_COLUMNS, "macro_usage")
    clean_tickets, clean_macros = cleaning.clean_tickets(tickets), cleaning.clean_macros(macros)
    clean_usage = cleaning.referential_filter(cleaning.clean_usage(usage), clean_tickets, clean_macros)
    return {"tickets_clean": clean_tickets, "macros_clean": clean_macros, "macro_usage_clean": clean_usage}


def _clustered(scored: DataFrame, out: str, clusters: int, restarts: int) -> dict[str, DataFrame]:
    prepared = stage(texts.prepare_texts(scored).select("macro_id", "cleaned_text"))
    model = texts.fit_macro_tfidf(prepared)
    vectors = stage(model.transform(prepared).select("macro_id", "features"))
    kmeans = topics.fit_kmeans(vectors, clusters, restarts)
    topics.save_models(f"{out}/models", model, kmeans)
    clustered = stage(topics.cluster_macros(scored, vectors, texts.tfidf_terms(model, prepared), kmeans))
    return {"macro_clusters": clustered, "cluster_summary": topics.cluster_summary(clustered)}


def main(argv: list[str]) -> None:
    source, out, *steps = argv
    spark = SparkSession.builder.appName("replyscope").getOrCreate()
    read: dict[str, DataFrame] = {}
    if not steps or "clean" in steps:
        for name in ("tickets", "macros", "macro_usage"):
            taken = ingest_csv(spark, f"{source}/{name}.csv", name, work_folder(spark, name))
            read[name] = taken.table
            for measure, n in taken.counts.items():
                if n:
                    print(f"{name}: {measure} {n}")
    inputs = (read.get(name) for name in ("tickets", "macros", "macro_usage"))
    for name, path in run(*inputs, out, steps or None, spark=spark).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main(sys.argv[1:])
