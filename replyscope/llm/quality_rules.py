"""Quality rules: an isolation forest over rule statistics, its threshold set from labelled rows."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import keep, map_rows
from replyscope.operators.ranking import grouped_quantile

#: Trees, and rows a tree isolates.
TREES, TREE_ROWS = 100, 256
#: Share of good labelled rows that the threshold must keep.
KEEP_GOOD = 0.998
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
#: Rule statistics and the range in which ordinary prose lies; the forest sees how far a document lies outside.
RULES = {
    "symbols_per_word": (0.0, 0.1), "dup_line_share": (0.0, 0.4), "upper_share": (0.0, 0.3), "word_length": (3.0, 10.0),
    "marks_per_word": (0.0, 0.2), "same_neighbour_share": (0.0, 0.1),
}
LOW, HIGH = np.array(list(RULES.values())).T


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of 8 words that stand twice or more in the text; windows are compared exactly, by
    numbering runs of 1, 2, 4 and 8 words in turn."""
    if len(ids) <= window:
        return 0
    runs, width = ids, 1
    while width < window:
        kinds = int(runs.max()) + 1
        pairs = runs[:-width].astype("i8") * kinds + runs[width:]
        values, runs, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        width *= 2
        if len(values) == len(pairs):
            return 0
    again = counts[runs] > 1
    edges = np.zeros(len(ids) + 1, dtype="i8")
    edges[:-window][again] += 1
    np.subtract.at(edges, np.flatnonzero(again) + window, 1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def rule_counts(text: str | None) -> tuple[list[int], list[float]]:
    """Counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and rule statistics of a whole text."""
    data = (text or "").encode("utf-8")
    words = data.split()  # bytes split at 0x20 and 0x09 to 0x0D only
    n = len(words)
    letters = np.bincount(np.frombuffer(data, dtype="u1"), minlength=256)
    continued = int(letters[0x80:0xC0].sum())
    word_chars = sum(map(len, words)) - continued
    symbols = int(letters[list(SYMBOLS)].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype="i8", count=n)
    repeats = repeat_words(ids) if len(known) < n else 0
    upper, lower = int(letters[65:91].sum()), int(letters[97:123].sum())
    m = max(n, 1)
    values = np.array([
        symbols / m, dup_lines / max(len(lines), 1), upper / max(upper + lower, 1), word_chars / m if n else LOW[3],
        int(letters[33] + letters[63]) / m, float((ids[1:] == ids[:-1]).sum()) / m,
    ])
    outside = np.maximum(np.maximum(LOW - values, values - HIGH), 0)
    return [n, word_chars, symbols, dup_lines, repeats], np.log1p(outside).tolist()


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 20 or 100 * n_repeat_words > 30 * n_words


class IsolationForest:
    """Random splits isolate a row early if it lies apart; the score falls from 1 with the mean path length."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7):
        random = np.random.default_rng(seed)
        self.size = min(tree_rows, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        width = 2 ** (self.depth + 1) - 1
        self.feature = np.full((trees, width), -1, dtype="i4")
        self.cut = np.zeros((trees, width))
        self.path = np.zeros((trees, width))
        for t in range(trees):
            self._grow(t, 0, 0, rows[random.choice(len(rows), self.size, replace=False)], random)

    @staticmethod
    def usual(n: int) -> float:
        """Mean path length of n rows in a random search tree."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, t: int, node: int, depth: int, rows: np.ndarray, random: np.random.Generator) -> None:
        self.path[t, node] = depth + self.usual(len(rows))
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth == self.depth or not len(spread):
            return
        f = random.choice(spread)
        cut = random.uniform(rows[:, f].min(), rows[:, f].max())
        left = rows[:, f] <= cut
        self.feature[t, node], self.cut[t, node] = f, cut
        self._grow(t, 2 * node + 1, depth + 1, rows[left], random)
        self._grow(t, 2 * node + 2, depth + 1, rows[~left], random)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, path in zip(self.feature, self.cut, self.path):
            node = np.zeros(len(rows), dtype="i8")
            for _ in range(self.depth):
                f = feature[node]
                down = 2 * node + 1 + (rows[each, np.maximum(f, 0)] > cut[node])
                node = np.where(f >= 0, down, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / max(self.usual(self.size), 1e-9))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Texts of at most ``most`` labelled ids, chosen by a hash of the id, one row each: doc_id, text, quality. Of rows
    that repeat an id the one with the least hash of its text counts."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    one = F.min_by(F.struct("text"), F.xxhash64("text")).alias("row")
    return found.groupBy("doc_id", "quality").agg(one).select("doc_id", "row.text", "quality")


def counted_rows(docs: DataFrame) -> DataFrame:
    """Counts and rule statistics of each document, and a hash of its text; kept, as the fit and the verdict read them."""

    def make():
        def row(doc_id, text, text_hash):
            counts, values = rule_counts(text)
            yield doc_id, text_hash, *counts, base_failed(counts[0], counts[4]), values

        return row

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash")
    )
    schema = f"doc_id bigint, text_hash bigint, {COUNTS}, base_failed boolean, stats array<double>"
    return keep(map_rows(narrow, make, schema, ["doc_id", "text", "text_hash"]), "rule-counts")


def fit(counted: DataFrame, labels: DataFrame) -> tuple[IsolationForest, float] | None:
    """Forest and threshold from all labelled rows of ``counted``; None without any.

    A tree isolates 256 rows, as the method has it; those of all trees are drawn from all labelled rows by a hash of the id. The threshold
    comes from exact quantiles of the scores of all labelled rows. No text is shuffled, and only the drawn statistics reach the driver.
    """
    quality = (
        labels.where("doc_id is not null and quality is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    one = F.min_by(F.struct("base_failed", "stats"), "text_hash").alias("row")
    labelled = keep(
        counted.select("doc_id", "text_hash", "base_failed", "stats").join(quality, "doc_id").groupBy("doc_id", "quality").agg(one)
        .select("doc_id", "quality", "row.base_failed", "row.stats"),
        "labelled",
    )
    drawn = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TREES * TREE_ROWS).collect()
    if len(drawn) < 2:
        return None
    drawn = sorted((r.quality, r.base_failed, tuple(r.stats)) for r in drawn)
    forest = IsolationForest(np.array([r[2] for r in drawn]))
    scored = keep(with_scores(labelled.where("not base_failed"), forest).select("quality", "score"), "labelled-scores")
    limit = grouped_quantile(scored.where("quality = 1"), [], "score", KEEP_GOOD, "limit").first()
    if limit is None or limit["limit"] is None:
        return None
    limit = limit["limit"] + 1e-9
    beyond = scored.where(~F.col("quality").eqNullSafe(1) & (F.col("score") > limit))
    beyond = grouped_quantile(beyond, [], "score", 0.02, "least").first()  # half way to the bad rows beyond it
    return forest, limit if beyond is None or beyond["least"] is None else (limit + beyond["least"]) / 2


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    Base rules reject documents of fewer than 20 words or with over 30 % of words in repeated 8-word windows.
    Of the others, those are rejected whose isolation score exceeds the threshold: it lies above 99.8 % of the
    good labelled rows, half way to the bad ones beyond. Without labelled rows the base rules decide alone and the score is 0. A null or
    empty text has no words and fails; a null doc_id stays null; repeated rows get a row each; other columns
    are ignored; an empty table gives no rows.
    """
    counted = counted_rows(docs)
    fitted = fit(counted, labels)
    scored = with_scores(counted.drop("text_hash"), fitted[0] if fitted else None)
    limit = fitted[1] if fitted else 1.0
    return scored.drop("stats").withColumn("kept", ~F.col("base_failed") & (F.col("score") <= limit))


def with_scores(counted: DataFrame, forest: IsolationForest | None) -> DataFrame:
    if forest is None:
        return counted.withColumn("score", F.lit(0.0))
    score = F.pandas_udf(
        lambda stats: __import__("pandas").Series(forest.score(np.array(stats.tolist()).reshape(-1, len(RULES)))), "double"
    )
    return counted.withColumn("score", score("stats"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    fitted = fit(counted_rows(docs), labels)

    def verdict(texts):
        import pandas as pd

        counted = [rule_counts(t) for t in texts]
        ok = np.array([not base_failed(c[0], c[4]) for c, _ in counted], dtype=bool)
        if fitted and len(counted):
            ok &= fitted[0].score(np.array([s for _, s in counted])) <= fitted[1]
        return pd.Series(ok)

    from replyscope.llm.common import small_batches

    small_batches(docs.sparkSession)
    return docs.where(F.pandas_udf(verdict, "boolean")(F.col("text")))
