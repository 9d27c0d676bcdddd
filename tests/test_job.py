import pytest
from pyspark.sql import functions as F

from replyscope.plans.desk import Desk
from replyscope.plans.job import manifest, run
from replyscope.sources.tables import ingest_csv, read_csv, write_table
from replyscope.schemas import MACROS

DATA = "/root/testdata/sf0.001"


def test_whole_job(spark, tmp_path):
    d = Desk(spark, DATA)
    out = run(d.tickets, d.macros, d.usage_only, str(tmp_path), restarts=1, clusters=4)
    read = {name: spark.read.parquet(path) for name, path in out.items()}
    assert read["macro_clusters"].count() == read["macros_clean"].count() == 200
    assert read["cluster_summary"].agg({"num_macros": "sum"}).first()[0] == 200
    assert read["evaluation_landscape"].first().total_macros == 200
    assert read["macro_usage_clean"].count() == 6000


def test_single_step_and_checks(spark, tmp_path):
    d = Desk(spark, DATA)
    out = run(d.tickets, d.macros, d.usage_only, str(tmp_path), steps=["clean"])
    assert set(out) == {"tickets_clean", "macros_clean", "macro_usage_clean"}
    with pytest.raises(ValueError):
        run(d.tickets, d.macros, d.usage_only, str(tmp_path), steps=["nothing"])
    with pytest.raises(ValueError):
        run(d.tickets.drop("agent_id"), d.macros, d.usage_only, str(tmp_path))


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("M1", 'He said "hi", twice', "line one\nline two", "billing")],
                               "macro_id string, macro_name string, macro_body string, category string")
    path = write_table(df, str(tmp_path / "m"), "csv")
    from pyspark.sql import types as T

    schema = T.StructType([MACROS[c] for c in df.columns])
    row = read_csv(spark, path, schema).first()
    assert row.macro_name == 'He said "hi", twice' and row.macro_body == "line one\nline two"


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "macro_usage.csv"
    path.write_text("macro_id,ticket_id,channel,position_in_thread,applied_at,agent_id\n"
                    "M1,T1,email,2.0,2024-01-02 03:04:05,A1\nM2,T2,chat,,2024-01-03 00:00:00,A2\n")
    rows = read_csv(spark, str(path), "macro_usage").orderBy("ticket_id").collect()
    assert [(r.ticket_id, r.macro_id, r.position_in_thread, r.agent_id) for r in rows] == [
        ("T1", "M1", 2, "A1"), ("T2", "M2", None, "A2")]
    path.write_text("macro_id,ticket_id\nM1,T1\n")
    with pytest.raises(ValueError):
        read_csv(spark, str(path), "macro_usage")


def test_steps_resume_from_saved_tables(spark, tmp_path):
    """A later step reads what earlier runs saved, whatever became of the inputs; the manifest lists the last entry of each table."""
    d = Desk(spark, DATA)
    out = str(tmp_path / "job")
    assert set(run(d.tickets, d.macros, d.usage_only, out, steps=["score"])) == {
        "tickets_clean", "macros_clean", "macro_usage_clean", "ticket_features", "macro_features", "macro_scores"}
    scores = spark.read.parquet(f"{out}/macro_scores")
    few = scores.limit(150).toPandas()
    spark.createDataFrame(few, scores.schema).write.mode("overwrite").parquet(f"{out}/macro_scores")
    assert set(run(None, None, None, out, ["cluster"], clusters=3, restarts=1, spark=spark)) == {"macro_clusters", "cluster_summary"}
    assert spark.read.parquet(f"{out}/macro_clusters").count() == 150  # the saved scores, not new ones
    assert set(run(None, None, None, out, ["evaluate"], spark=spark)) == {"evaluation_landscape", "evaluation_recommendations"}
    entries = {r["table"]: r for r in manifest(spark, out).collect()}
    assert len(entries) == 10 and entries["macro_clusters"].n_rows == 150 and entries["macro_scores"].step == "score"
    run(d.tickets, d.macros, d.usage_only, out, ["clean"])
    again = {r["table"]: r for r in manifest(spark, out).collect()}
    assert again["tickets_clean"].written_at > entries["tickets_clean"].written_at and len(again) == 10
    with pytest.raises(ValueError):
        run(None, None, None, str(tmp_path / "empty"), ["evaluate"], spark=spark)


def test_csv_counts_and_rows_put_aside(spark, tmp_path):
    path = tmp_path / "macro_usage.csv"
    path.write_text("ticket_id,macro_id,applied_at,position_in_thread,agent_id,channel\n"
                    "T1,M1,2024-01-02 03:04:05,1,A1,email\nT2,M2,yesterday,2,A2,chat\nT3,M3,2024-01-02 03:04:05,third,A3,\n"
                    "T4,M4,2024-01-02 03:04:05,9007199254740993,,phone\nT5,,2024-01-02 03:04:05,4.0,A5,email\n")
    taken = ingest_csv(spark, str(path), "macro_usage", str(tmp_path / "taken"))
    assert taken.counts == {
        "rows": 5, "rejected": 4, "unparsed_ticket_id": 0, "unparsed_macro_id": 0, "unparsed_applied_at": 1,
        "unparsed_position_in_thread": 2, "unparsed_agent_id": 0, "unparsed_channel": 0}
    assert [(r.ticket_id, r.channel) for r in taken.table.collect()] == [("T1", "email")]
    aside = {r.ticket_id: (r._unparsed, r._texts) for r in taken.rejected.collect()}
    assert aside["T2"][0] == ["applied_at"] and '"yesterday"' in aside["T2"][1] and aside["T5"][0] == []
    ids = tmp_path / "ids.csv"
    ids.write_text("big,n\n9007199254740993,4.0\n,x\n")
    loose = ingest_csv(spark, str(ids), "big long, n int", str(tmp_path / "ids"))
    assert [tuple(r) for r in loose.table.orderBy(F.col("big").desc()).collect()] == [(9007199254740993, 4), (None, None)]
    assert loose.counts == {"rows": 2, "rejected": 0, "unparsed_big": 0, "unparsed_n": 1}
