"""Self-join pairs without forming all pairs of a group."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_pairs(
    partnered: DataFrame,
    rows: DataFrame,
    order: list[str],
    key: str,
    matches: Column,
    n: int,
    probe: Column | None = None,
) -> DataFrame:
    """First ``n`` matching pairs (struct columns ``a``, ``b`` with a.key < b.key) in ``order`` of a, then b.

    ``partnered`` holds the rows that match at least one other row (a symmetric relation; matching
    rows share every ordering column but the key). Each of the first 2n of them belongs to a pair whose
    smaller member is among them too, and one pair covers at most two rows, so their pairs number at
    least n and no later row can start one of the first n. Hence 2n rows are broadcast and the table is
    scanned once: work grows with the rows, not with the pairs. ``probe`` may give the few values
    (column ``q``) that the partners of a row share with it, so that the condition holds an equality.
    """
    first = partnered.orderBy(*order).limit(2 * n).select(F.struct(*rows.columns).alias("a"))
    if probe is not None:
        first = first.withColumn("q", F.explode(probe))
    candidates = rows.select(F.struct(*rows.columns).alias("b")).join(
        F.broadcast(first), matches & (F.col("a")[key] < F.col("b")[key])
    )
    ordering = [F.col("a")[c] for c in order] + [F.col("b")[key]]
    return candidates.orderBy(*ordering).limit(n)


def _band_ranges(rows: DataFrame, group: list[str], value: str, width: float) -> DataFrame:
    """Rows with a partner within ``width`` in their group, from range summaries only."""
    if width <= 0:
        shared = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return rows.join(shared.drop("_n"), [*group, value], "left_semi")
    # Slightly narrower ranges: two rows of one range are surely within the width.
    ranged = rows.withColumn("_r", F.floor(F.col(value) / F.lit(width * (1 - 1e-9))))
    summary = ranged.groupBy(*group, "_r").agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max")
    )
    # At most (value span / width) summary rows per group.
    w = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_r")
    summary = summary.withColumns({"_below": F.lag("_max").over(w), "_above": F.lead("_min").over(w)})
    near = (
        (F.col("_n") > 1)
        | (F.abs(F.col(value) - F.col("_below")) <= width)
        | (F.abs(F.col("_above") - F.col(value)) <= width)
    )
    return ranged.join(summary, [*group, "_r"]).where(near).select(*rows.columns)


def band_pairs(
    scores: DataFrame,
    same_category: bool = True,
    threshold: float = 0.3,
    limit: int = 100,
    index: str = "macro_effectiveness_index",
) -> DataFrame:
    """First pairs of macros whose index differs by at most ``threshold``, in one category or overall."""
    # A partner lies in the same or a neighbouring range; ranges are a trifle wider than the threshold.
    width = threshold * (1 + 1e-9)
    band = F.floor(F.col(index) / F.lit(width)) if threshold > 0 else F.col(index)
    rows = scores.select("macro_id", "category", index, band.alias("band")).where(F.col(index).isNotNull())
    group = ["category"] if same_category else []
    if same_category:
        rows = rows.where(F.col("category").isNotNull())
    partnered = _band_ranges(rows, group, index, threshold)
    a, b = F.col("a"), F.col("b")
    near = F.array(a["band"] - 1, a["band"], a["band"] + 1) if threshold > 0 else F.array(a["band"])
    matches = (F.col("q") == b["band"]) & (F.abs(a[index] - b[index]) <= threshold)
    if same_category:
        matches = (a["category"] == b["category"]) & matches
    pairs = first_pairs(partnered, rows, [*group, "macro_id"], "macro_id", matches, limit, near)
    return pairs.select(
        a["macro_id"].alias("macro_a"), b["macro_id"].alias("macro_b"),
        a["category"].alias("category_a"), b["category"].alias("category_b"),
        a[index].alias("index_a"), b[index].alias("index_b"),
    )
