"""Helpers the operators share: kept tables, dense numbering, connected components, batches."""

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replyscope.sources.tables import work_folder

#: Rows in one Arrow batch: texts are a few kB each, the longest some hundred kB.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def map_rows(
    df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str, columns: list[str]
) -> DataFrame:
    """Rows made from ``columns`` of each row. ``make`` runs once a task and gives the row function,
    which yields any number of tuples in the order of ``schema``."""
    small_batches(df.sparkSession)
    out = df.sparkSession.createDataFrame([], schema).schema
    names = out.fieldNames()
    kinds = [_arrow(f.dataType.simpleString()) for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            made = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(columns)))):
                made.extend(fn(*row))
            values = list(zip(*made)) if made else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(values, kinds)], names=names)

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, out)


def _arrow(kind: str) -> pa.DataType:
    plain = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    }
    return pa.list_(_arrow(kind[6:-1])) if kind.startswith("array<") else plain[kind]


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a result that later steps read more than once below the shared work folder, and read it back."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: gapless numbers from 0 in each group, in the given order.

    One range exchange sorts the rows; each task numbers its own, and the counts of (group, task) shift
    them. A group is never gathered: the window runs over one row for each task and group.
    """
    keys = [*group, *order]
    rows = keep(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    parts = rows.groupBy(*group, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    joined = rows.withColumn("_p", part)
    on = F.col("_p") == F.col("_part")
    for s in same:
        on = on & s
    return joined.join(shifts, on).select(*df.columns, (F.col("_at") + F.col("_shift")).cast("long").alias(name))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links ``a``, ``b`` (long): node, component (smallest node).

    Alternating large-star and small-star steps: every step rewires links to smaller nodes by a grouped
    minimum and a join, and is written before the next one starts. The steps end when every node has one link, to
    a node that has none; only the count of nodes against that comes to the driver. Nodes without links are not
    listed; links with a null end are ignored.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    now = keep(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = keep(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        lower = keep(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(links: DataFrame) -> bool:
    """Whether the links ``u`` > ``v`` are stars already: no node has two smaller ones, or a smaller and a larger one."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high"))
    )
    nodes = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return nodes.where("low > 1 or low + high > 1").isEmpty()
