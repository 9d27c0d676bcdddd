"""Training-data pipeline: documents pass quality rules, quality classifier, line dedup, near-dedup and packing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm import circulant_minhash, line_windows, packing, quality_classifier, quality_rules
from replyscope.llm.common import keep


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest accept."""
    return quality_rules.keep_good(docs, _labels(spark, sf_dir))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts. It is fitted on all documents with the labels: most bad ones
    have left before this stage, and a classifier without them could judge nothing."""
    every = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = quality_classifier.classify(docs, _labels(spark, sf_dir), fit_docs=every)
    return judged.where("quality_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of three-line passages."""
    return line_windows.drop_repeated_windows(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest doc_id, of equal ids any one. Rows are told
    apart by a number written with them, so ids that are null or repeat take no other row along."""
    rows = keep(docs.withColumn("_near_row", F.monotonically_increasing_id()), "near-rows")
    judged = circulant_minhash.near_duplicates(rows, width=5, percent=80, row_key="_near_row")
    gone = judged.where("not kept").select("_near_row")
    return rows.join(gone, "_near_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of binary length of all documents with a word: line dedup has removed every line of the others, as copies."""
    return packing.pack(docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents; each result is written as Parquet and reread by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Models and tokens are beyond SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None
