"""Shards of near-equal bytes by histogram sort: splitters are refined from exact counts, then one exchange."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.common import keep

PROBES = 256
LOWEST = -(2**63)


def sort_key(text: Column) -> Column:
    """62 bits of the text's hash: equal texts lie side by side, and differences of keys fit a long."""
    return F.shiftright(F.xxhash64(text), 2)


def _ceil_div(a: int, b: int) -> int:
    return -(-a // b)


class _Splitter:
    """A cut that must leave ``target`` bytes below it; its bracket holds all keys it may still fall among.

    A row's key has three parts: the text's hash, the id, and the row's number. ``prefix`` has the parts that are decided.
    """

    def __init__(self, target: float, low: int, high: int):
        self.target, self.below, self.prefix, self.low, self.high, self.cut = target, 0, (), low, high, None

    @property
    def bracket(self) -> tuple:
        return (self.prefix, self.low, self.high)

    def refine(self, bins: list[tuple], tolerance: float) -> None:
        """bins: (number, bytes, then least and greatest value of each part), in order."""
        at, width, level = self.below, _ceil_div(self.high - self.low + 1, PROBES), len(self.prefix)
        for number, size, *ends in bins:
            edge = self.low + number * width
            if self.target - at <= tolerance:
                self.cut = self._cut(edge)
                return
            if at + size >= self.target or abs(at + size - self.target) <= tolerance:
                low, high = ends[2 * level], ends[2 * level + 1]
                if abs(at + size - self.target) <= tolerance:
                    self.cut = self._cut(edge + width)
                elif low < high:
                    self.low, self.high, self.below = low, high, at
                elif level + 1 < PARTS:  # one value: go on with the next part
                    self.prefix, self.low, self.high, self.below = (*self.prefix, low), ends[2 * level + 2], ends[2 * level + 3], at
                else:  # one row
                    self.cut = self._cut(edge if self.target - at <= at + size - self.target else edge + width)
                return
            at += size
        self.cut = self._cut(self.high + 1)

    def _cut(self, at: int) -> tuple[int, ...]:
        return (*self.prefix, at, *[LOWEST] * (PARTS - 1 - len(self.prefix)))


KEYS = ["_h", "_id", "_row"]
PARTS = len(KEYS)


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """Cuts (hash, id, row number) between shards of rows (``_h``, ``_id``, ``_row``, ``_size``); rows at or above a cut lie right of it.

    Each round lays probes into the brackets of the open splitters and counts the bytes between them over
    all rows; at most 256 counts for each splitter reach the driver. A key that alone exceeds the tolerance
    (a text with many copies) is cut by id, a repeated id by the row's number. Rounds end when every splitter has at most ``tolerance`` of a
    shard's bytes too many or too few, or a single row at it.
    """
    total, low, high = rows.agg(F.sum("_size"), F.min("_h"), F.max("_h")).first()
    if not total:
        return []
    share = total / shards
    cuts = [_Splitter(share * i, low, high) for i in range(1, shards)]
    while brackets := sorted({s.bracket for s in cuts if s.cut is None}, key=str):
        number = None
        for k, (prefix, lo, hi) in enumerate(brackets):
            width, part = _ceil_div(hi - lo + 1, PROBES), KEYS[len(prefix)]
            inside = F.col(part).between(lo, hi)
            for name, value in zip(KEYS, prefix):
                inside = (F.col(name) == value) & inside
            at = F.expr(f"cast(floor((cast({part} as decimal(20,0)) - ({lo})) / cast({width} as decimal(20,0))) as long)")
            if part == "_h":  # differences of hashes fit a long
                at = F.expr(f"(_h - ({lo}L)) div {width}L")
            number = (number if number is not None else F).when(inside, F.lit(k * PROBES) + at)
        ends = [f(k) for k in KEYS for f in (F.min, F.max)]
        counted = (
            rows.select(number.alias("_bin"), "_size", *KEYS).where("_bin is not null").groupBy("_bin").agg(F.sum("_size"), *ends).collect()
        )
        by = {b: [] for b in brackets}
        for bin_, *rest in sorted(map(tuple, counted)):
            by[brackets[bin_ // PROBES]].append((bin_ % PROBES, *rest))
        for s in cuts:
            if s.cut is None:
                s.refine(by[s.bracket], tolerance * share)
    return sorted(s.cut for s in cuts)


def _cuts_below(cuts: list[tuple[int, ...]]) -> Column:
    """How many cuts a row's key has reached, as a balanced tree of comparisons."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    reached = F.lit(True)
    for name, value in reversed(list(zip(KEYS, cuts[middle]))):
        reached = (F.col(name) > value) | ((F.col(name) == value) & reached)
    return F.when(reached, _cuts_below(cuts[middle + 1 :]) + (middle + 1)).otherwise(_cuts_below(cuts[:middle]))


#: Rows of a shard that one task sorts, and the most pieces a shard is cut into for that.
PIECE_ROWS, MOST_PIECES = 1_000_000, 32


def shard_by_bytes(
    df: DataFrame, size: Column, key: Column, id_column: str = "doc_id", shards: int = 40, tolerance: float = 0.001
) -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (gapless from 0 in a shard, in key order) to the rows of ``df``.

    Rows are ordered by ``key`` (a long of 62 bits), then id, then a number stored with the row, and cut into shards of near-equal ``size``;
    only native functions run. Columns of the input named shard or slot are replaced. A null id sorts first;
    repeated rows stay separate rows and may fall into different shards; an empty table gives no rows. Sizes and keys must not be null.

    The splitters also cut each shard into pieces of about a million rows (32 at most); the one exchange sends every row to its
    piece's task, which sorts and numbers it.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = keep(
        df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], key.alias("_h"), size.cast("long").alias("_size"),
                  F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(LOWEST)).alias("_id"),
                  F.monotonically_increasing_id().alias("_row")),
        "sharding",
    )
    pieces = min(MOST_PIECES, max(1, _ceil_div(rows.count(), shards * PIECE_ROWS)))
    cuts = splitters(rows, shards * pieces, tolerance / pieces)
    sent = rows.withColumn("_piece", _cuts_below(cuts).cast("int")).repartitionById(shards * pieces, F.col("_piece"))
    placed = keep(sent.sortWithinPartitions("_piece", *KEYS).withColumn("_at", F.monotonically_increasing_id()), "shards")
    counts = placed.groupBy("_piece").agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    shard = F.expr(f"_piece div {pieces}").cast("int")
    before = Window.partitionBy(shard).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("_piece", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"))
    # a row a piece: at most 32 a shard
    return placed.join(F.broadcast(shifts), "_piece").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], shard.alias("shard"), (F.col("_at") + F.col("_shift")).cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = 0.001) -> DataFrame:
    """All documents with size (UTF-8 bytes of the text plus 16), text_crc32, law, shard and slot.

    A null text counts no bytes. Only ids and digests travel; join the result to the texts to write shards.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), sort_key(text).alias("key"),
    )
    placed = shard_by_bytes(narrow, F.col("size"), F.col("key"), shards=shards, tolerance=tolerance)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
