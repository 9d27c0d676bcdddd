"""Substring dedup: Rabin-Karp hashes of every window of words, counted over all documents, merged into intervals."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.chunks import CHUNK_BYTES, texts_in_chunks

WINDOW = 20
#: Text bytes whose windows meet in one group of the count.
BUCKET_BYTES = 2 << 20
#: Odd multipliers of the hashes, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
LAST_ID = np.iinfo(np.int64).max


SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
WORD_BLOCK = 1 << 18


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of each number: a multiply-and-shift finaliser."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9 ^ salt)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]), 0)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``data`` starts, and a hash of it: a polynomial over its bytes modulo 2**64, with its length, mixed."""
    letters = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(np.concatenate([[0], (~SPACE)[letters].view(np.int8), [0]]).astype(np.int8))
    starts, lengths = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    lengths -= starts
    out = np.empty(len(starts), dtype=np.uint64)
    for k in range(0, len(starts), WORD_BLOCK):
        first, n = starts[k : k + WORD_BLOCK], lengths[k : k + WORD_BLOCK]
        before = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(before, n)
        powers = np.full(int(n.max()), BASES[1], dtype=np.uint64)
        powers[0] = 1
        terms = _BYTES[letters[at + np.repeat(first, n)]] * np.cumprod(powers)[at]
        out[k : k + WORD_BLOCK] = np.add.reduceat(terms, before) + n.astype(np.uint64)
    return starts, _mixed(out, 0)


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive numbers, modulo 2**64: at i the sum of words[i + j] * base**(width - 1 - j).

    Built by doubling: a window of 2k is one of k times base**k plus the next of k.
    """
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    done, made = 0, None
    part, size = words, 1
    while True:
        if width & size:
            if made is None:
                made, done = part, size
            else:  # the longer part stands first
                made = part[: len(words) - size - done + 1] * np.uint64(pow(base, done, 1 << 64)) + made[size : size + len(words) - size - done + 1]
                done += size
        if done == width:
            return made[:n]
        part = part[:-size] * np.uint64(pow(base, size, 1 << 64)) + part[size:]
        size *= 2


class ChunkWindows:
    """The windows of one chunk's documents in order of id, then place, dealt to buckets by their second hash.

    Of windows with equal hashes in the chunk the first is listed (``firsts``), the others are known to repeat (``again``).
    """

    def __init__(self, doc_ids: list[int | None], places: list[int], texts: list[str | None], width: int, buckets: int):
        self.order = sorted(range(len(texts)), key=lambda k: (LAST_ID if doc_ids[k] is None else doc_ids[k], places[k]))
        self.texts = [(texts[k] or "").encode() for k in self.order]
        at, words = word_hashes(b"\n".join(self.texts))
        self.ends = np.searchsorted(at, np.cumsum([len(t) + 1 for t in self.texts]))
        counts, self.n = np.diff(self.ends, prepend=0), len(at)
        own, other = rolling(words, width, BASES[0]), rolling(_mixed(words, BASES[1]), width, BASES[1])
        doc = np.repeat(np.arange(len(counts)), counts)[: len(own)]
        self.starts = np.nonzero(np.arange(len(own)) + width <= self.ends[doc])[0] if len(own) else np.empty(0, dtype=np.int64)
        self.doc = doc[self.starts]
        self.ids = np.array([LAST_ID if doc_ids[k] is None else doc_ids[k] for k in self.order], dtype=np.int64)
        self.hashes = own[self.starts]
        # the upper half of the second hash, scaled to the number of buckets
        bucket = ((other[self.starts] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        self.by_bucket = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[self.by_bucket]
        cuts = np.nonzero(np.diff(sorted_bucket))[0] + 1
        self.slices = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(sorted_bucket)])) if len(sorted_bucket) else []
        self.buckets = [int(sorted_bucket[a]) for a, _ in self.slices]

    def slice(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Firsts and repeated windows (positions in ``starts``) of the k-th bucket met, each in document order."""
        a, b = self.slices[k]
        mine = self.by_bucket[a:b]
        held = self.hashes[mine]
        by_hash = np.argsort(held)
        held = held[by_hash]
        groups = np.nonzero(np.concatenate([[True], held[1:] != held[:-1]]))[0]
        first = np.zeros(len(held), dtype=bool)
        first[np.minimum.reduceat(by_hash, groups)] = True
        return mine[first], mine[~first]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which Spark's compression shrinks where they are alike."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _values(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _chunk(table: pa.Table, width: int, buckets: int) -> ChunkWindows:
    return ChunkWindows(*(table.column(c).to_pylist() for c in ("doc_id", "place", "text")), width, buckets)


def listed_windows(chunks: DataFrame, width: int, buckets: int) -> DataFrame:
    """First windows of every chunk by bucket: hashes, and the ids of the documents with how many each holds."""

    def run(table: pa.Table) -> pa.Table:
        made = _chunk(table, width, buckets)
        rows = []
        for k, bucket in enumerate(made.buckets):
            firsts, _ = made.slice(k)
            doc = made.doc[firsts]
            cut = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1])
            held = np.diff(np.append(cut, len(doc)))
            rows.append((bucket, _planes(made.hashes[firsts]), _planes(made.ids[doc[cut]]), _planes(held)))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        chunk = table.column("chunk")[0].as_py()
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array([chunk] * len(rows), pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=["chunk", "bucket", "hashes", "ids", "held"],
        )

    return chunks.select("chunk", "place", "doc_id", "text").groupBy("chunk").applyInArrow(
        run, "chunk long, bucket long, hashes binary, ids binary, held binary"
    )


def later_windows(listed: DataFrame) -> DataFrame:
    """For each chunk and bucket a bit per listed window: whether an equal one stands earlier, in order of id, then chunk."""

    def run(table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        hashes = [_values(x, "<u8") for x in table.column("hashes").to_pylist()]
        ids = [np.repeat(_values(i, "<i8"), _values(n, "<i8")) for i, n in zip(*(table.column(c).to_pylist() for c in ("ids", "held")))]
        lengths = np.array([len(h) for h in hashes])
        every, doc = np.concatenate(hashes), np.concatenate(ids)
        chunk = np.repeat(np.array(chunks, dtype=np.int64), lengths)
        by_hash = np.argsort(every)
        same = every[by_hash][1:] == every[by_hash][:-1]
        shared = np.zeros(len(every), dtype=bool)
        shared[:-1] |= same
        shared[1:] |= same
        few = by_hash[shared]
        few = few[np.lexsort((chunk[few], doc[few], every[few]))]
        later = np.zeros(len(every), dtype=bool)
        later[few[1:][every[few][1:] == every[few][:-1]]] = True
        ends = np.cumsum(lengths)
        bits = [np.packbits(later[e - n : e]).tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
        return pa.table([pa.array(chunks, pa.int64()), table.column("bucket"), pa.array(bits, pa.binary())], names=["chunk", "bucket", "later"])

    return listed.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, later binary")


def _merged(covered: np.ndarray) -> list[list[int]]:
    """Maximal stretches of covered words: [first, last]."""
    edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
    return np.stack([np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0] - 1], axis=1).tolist()


def drop_repeated_passages(
    docs: DataFrame, width: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Documents without the words of passages that stand somewhere earlier.

    Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return. Every
    ``width`` consecutive words of a document make a window. A window whose words also start earlier (in a smaller
    doc_id, or before in the document) is repeated; all words of repeated windows go. Windows are judged on the
    input. Per row: doc_id, n_words, n_removed, spans (first and last word of each maximal removed interval, from 0),
    kept_text (the other words joined by one blank).

    Null texts have no words; texts of fewer words than ``width`` lose nothing. Rows of one doc_id are separate documents
    in the order in which they are stored, so of a repeated row one keeps its words; a null id counts as the largest.
    Other columns are left out. An empty table gives no rows.

    Windows are equal if 64 bits of one polynomial hash and the bucket, drawn from a second one, agree: with N windows
    the expected number of wrong pairs is N * N * width * bucket_bytes / text bytes / 2**65 at most, about 0.00001 for a
    GB of text. Of the windows of a chunk (``chunk_bytes`` of text) only the first of each kind is sent, so a window in every
    document is one entry a chunk. A chunk and a bucket are held in memory, some 40 bytes a window; texts are written
    once, bucketed by chunk, and never shuffled. At 100 TB raise both sizes to 128 MB (1 GB a worker), so that each chunk
    still has a dozen windows for each bucket.
    """
    chunks = texts_in_chunks(docs, chunk_bytes)
    total = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(16, -(-total // bucket_bytes))
    later = later_windows(listed_windows(chunks, width, buckets))

    def run(texts: pa.Table, masks: pa.Table) -> pa.Table:
        made = _chunk(texts, width, buckets)
        told = dict(zip(masks.column("bucket").to_pylist(), masks.column("later").to_pylist()))
        edge = np.zeros(made.n + 1, dtype=np.int64)
        for k, bucket in enumerate(made.buckets):
            firsts, again = made.slice(k)
            bits = np.unpackbits(np.frombuffer(told[bucket], dtype=np.uint8), count=len(firsts)).astype(bool)
            gone = made.starts[np.concatenate([again, firsts[bits]])]
            edge[gone] += 1
            edge[gone + width] -= 1
        covered = np.cumsum(edge[:-1]) > 0
        ids, rows, before = texts.column("doc_id").to_pylist(), [], 0
        for k, text, end in zip(made.order, made.texts, made.ends.tolist()):
            mine = covered[before:end]
            before = end
            kept = words = text.split()
            spans = _merged(mine) if mine.any() else []
            if spans:
                borders = [0, *[x for a, b in spans for x in (a, b + 1)], len(words)]
                kept = [w for a, b in zip(borders[::2], borders[1::2]) for w in words[a:b]]
            rows.append((ids[k], len(words), len(words) - len(kept), spans, b" ".join(kept).decode()))
        names = ["doc_id", "n_words", "n_removed", "spans", "kept_text"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    texts = chunks.select("chunk", "place", "doc_id", "text").groupBy("chunk")
    return texts.cogroup(later.groupBy("chunk")).applyInArrow(
        run, "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept_text string"
    )


#: The digest rows in DuckDB SQL, for documents with distinct ids.
SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
each AS (SELECT doc_id, u.w AS word, u.i AS i FROM split, unnest(words) WITH ORDINALITY AS u(w, i)),
win AS (
  SELECT doc_id, i AS start, list(word) OVER w AS body, count(*) OVER w AS n
  FROM each WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
placed AS (
  SELECT doc_id, start, row_number() OVER (PARTITION BY array_to_string(body, ' ') ORDER BY doc_id, start) AS place
  FROM win WHERE n = 20),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS i FROM placed WHERE place > 1),
kept AS (
  SELECT e.doc_id, count(*) AS n_kept, string_agg(e.word, ' ' ORDER BY e.i) AS kept
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(len(s.words) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
