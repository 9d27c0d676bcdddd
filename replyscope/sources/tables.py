"""Table readers and writers."""

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyscope.schemas import REQUIRED_COLUMNS, TABLE_SCHEMAS


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV read by the names in its header, in any order. ``schema`` may name a known table.

    Unknown columns are left out and missing ones are null; a known table without a required column raises
    ValueError. Whole numbers may be written as 4.0; values that do not parse become null (``ingest_csv`` counts them). Only quoted fields
    of macros may span lines: such files cannot be split, so tables of facts are read line by line.
    """
    raw, fields, _ = _raw_csv(spark, path, schema)
    return raw.select(*[_value(raw, f).alias(f.name) for f in fields])


def _raw_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, T.StructType, list[str]]:
    """The texts of a CSV, the fields wanted of it and the names of those that a row must have."""
    known = schema if isinstance(schema, str) and schema in TABLE_SCHEMAS else None
    fields = TABLE_SCHEMAS[known] if known else schema
    if isinstance(fields, str):
        fields = spark.createDataFrame([], fields).schema
    spans = known == "macros" or known is None and "macro_body" in fields.fieldNames()
    raw = spark.read.options(header=True, multiLine=spans, quote='"', escape='"').csv(path)
    required = REQUIRED_COLUMNS.get(known, [])
    missing = [c for c in required if c not in raw.columns]
    if missing:
        raise ValueError(f"{known}: missing columns {missing}")
    return raw, fields, required


def _value(raw: DataFrame, field: T.StructField) -> Column:
    if field.name not in raw.columns:
        return F.lit(None).cast(field.dataType)
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):  # 4.0 only where it is no whole number as it stands
        return F.coalesce(text.try_cast(field.dataType), text.try_cast("double").try_cast(field.dataType))
    return text.try_cast(field.dataType)


@dataclass
class Ingested:
    """A CSV taken in: its rows, those put aside (with the names of unparsed columns and the row's texts), and counts."""

    table: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def ingest_csv(spark: SparkSession, path: str, schema: T.StructType | str, folder: str) -> Ingested:
    """Read a CSV as ``read_csv`` does, write it as Parquet, and report in the same pass what did not parse.

    A row is put aside if a required column has no value, or none that parses; other values that do not parse become null in
    a row that stays. ``counts`` holds ``rows``, ``rejected``, and for each column ``unparsed_...`` the values that are neither empty
    nor parsed. They are observed while the rows are written. One directory holds both kinds of rows, as two partitions.
    """
    raw, fields, required = _raw_csv(spark, path, schema)
    values = {f.name: _value(raw, f) for f in fields}
    odd = {
        c: F.trim(f"`{c}`").isNotNull() & (F.trim(f"`{c}`") != "") & v.isNull() for c, v in values.items() if c in raw.columns
    }
    unparsed = F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in odd.items()]), lambda x: x.isNotNull())
    lost = F.lit(False)
    for c in required:
        lost = lost | values[c].isNull()
    texts = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))
    parsed = raw.select(
        *[v.alias(c) for c, v in values.items()], lost.alias("_rejected"), unparsed.alias("_unparsed"),
        F.when(lost, texts).alias("_texts"),
    )
    seen = Observation()
    counted = parsed.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("_rejected").alias("rejected"),
        *[F.count_if(F.array_contains("_unparsed", c)).alias(f"unparsed_{c}") for c in odd],
    )
    counted.write.mode("overwrite").partitionBy("_rejected").parquet(folder)
    written = spark.read.schema(parsed.schema).parquet(folder)
    return Ingested(
        written.where("not _rejected").select(*fields.fieldNames()),
        written.where("_rejected").select(*fields.fieldNames(), "_unparsed", "_texts"),
        {k: int(v) for k, v in seen.get.items()},
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> str:
    """Overwrite one directory with the result; ``partition_by`` prunes later date-range reads."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)
    return path


def _checkpoint_folder(spark: SparkSession) -> None:
    """Use the shared folder the session names; a folder of our own only in local mode without one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="replyscope-")
    context.setCheckpointDir(named)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, so every executor can reach it."""
    _checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def write_bundle(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One directory per table."""
    return {name: write_table(df, f"{folder}/{name}", fmt) for name, df in tables.items()}


def stage(df: DataFrame) -> DataFrame:
    """Compute a result that several later steps read, once, into the session's checkpoint folder.

    The files outlive lost executors, and later plans start from a leaf instead of repeating
    everything before it.
    """
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when a costly step would start from fewer input splits than that."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
