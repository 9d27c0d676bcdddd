"""Rows kept in chunks of bounded bytes, in a table bucketed by chunk: later steps meet a chunk again without a shuffle."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import small_batches
from replyscope.sources.tables import work_folder

CHUNK_BYTES = 8 << 20


class ChunkNumbers:
    """Numbers of chunks, unlike those of other tasks. A chunk ends with the row that reaches the limit."""

    def __init__(self, limit: int):
        self.limit, self.filled, self.number = limit, 0, TaskContext.get().partitionId() << 32

    def of(self, sizes: np.ndarray) -> np.ndarray:
        out = np.empty(len(sizes), dtype=np.int64)
        for i, size in enumerate(sizes.tolist()):
            if self.filled >= self.limit:
                self.filled, self.number = 0, self.number + 1
            out[i] = self.number
            self.filled += size + 64
        return out


def keep_in_buckets(df: DataFrame, by: str, name: str) -> DataFrame:
    """Write ``df`` once below the shared work folder, bucketed by a column, and read it back.

    Nothing is shuffled for the writing: each task adds its rows to one file a bucket. Grouping the result by
    the column, or joining something small to it, moves only the other side. The name in the catalog is
    given back at once; the files stay.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.option("path", path).option("compression", "zstd").bucketBy(buckets, by).saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


def texts_in_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (chunk long, place long, doc_id long, text string, size long) of all documents; ``place`` numbers the rows
    of a task, ``size`` is the text's bytes."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, place = None, 0
        for batch in batches:
            chunks = chunks or ChunkNumbers(chunk_bytes)
            doc_id, text = batch.column(0), batch.column(1)
            size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(text), 0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunks.of(size)), pa.array(np.arange(place, place + len(size), dtype=np.int64)), doc_id, text,
                    pa.array(size),
                ],
                names=["chunk", "place", "doc_id", "text", "size"],
            )
            place += len(size)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(run, "chunk long, place long, doc_id long, text string, size long")
    return keep_in_buckets(made, "chunk", "chunks")
