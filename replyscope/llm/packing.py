"""Packing by powers of two: documents are cut into pieces of binary length, one piece a sequence."""

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import keep, map_rows, numbered
from replyscope.llm.encoding import default_tokenizer, encoder

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def piece_lengths(n: int, longest: int) -> list[int]:
    """Full pieces first, then the binary digits of the rest, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def pieces(docs: DataFrame, tokenizer: str, longest: int, end_id: int, with_ids: bool) -> DataFrame:
    def make():
        encode = encoder(tokenizer).packed
        end = np.array([end_id], dtype="<u4").tobytes()

        def cut(doc_id, text):
            data = encode(text or "") + end
            n, at = len(data) // 4, 0
            for length in piece_lengths(n, longest):
                part = data[4 * at : 4 * (at + length)]
                row = (doc_id, at, length, zlib.crc32(part), n)
                yield (*row, np.frombuffer(part, dtype="<u4").astype("i8").tolist()) if with_ids else row
                at += length

        return cut

    schema = SCHEMA + ", ids array<bigint>" if with_ids else SCHEMA
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(narrow, make, schema, ["doc_id", "text"])


def pack(
    docs: DataFrame, tokenizer: str | None = None, longest: int = 1024, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document is its text's ids and ``end_id``. It is cut into pieces of ``longest`` ids and, for the rest,
    of falling powers of two; ``longest`` must be a power of two. Every piece is a sequence of its own, so
    none crosses documents and none needs padding; sequences of one length are numbered side by side
    (longest first, then by doc_id and start), ready to be batched. A null or empty text gives one piece
    with the end id; a null doc_id stays null; repeated rows are packed each; other columns are ignored; an
    empty table gives no pieces.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")
    cut = keep(pieces(docs, tokenizer or default_tokenizer(), longest, end_id, with_ids), "pieces").withColumn("_down", -F.col("length"))
    rows = numbered(cut, [], ["_down", "doc_id", "start"], "sequence_id")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    return rows.select(*names, F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))
