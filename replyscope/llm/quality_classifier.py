"""Quality classifier by co-training: a text view and a metadata view teach each other on unlabelled rows."""

import copy
import logging
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import keep, map_rows, small_batches

#: The labelled rows of the fit (a bounded sample), rounds of exchange, Newton steps in each.
MAX_LABELLED, ROUNDS, STEPS = 16_000, 3, 6
#: Log odds from which a view is sure of a row, and the weight of all rows taught for a class against its labelled ones.
SURE, TAUGHT = 3.0, 0.5
#: Share of good held-out rows that the threshold must keep.
KEEP_GOOD = 0.998
#: The most frequent languages and sources have a level each; the others share one, and null has its own.
MAX_LANGS, MAX_SOURCES = 64, 192
#: Sums over tasks are added as whole numbers of 2**-SUM_BITS, in any order the same.
SUM_BITS, SUM_PARTS = 20, 16


def text_view(text: str | None) -> np.ndarray:
    """Content alone: shares of byte values, word lengths and repetition."""
    data = (text or "").encode("utf-8")
    shares = np.bincount(np.frombuffer(data, dtype="u1"), minlength=256) / max(len(data), 1)
    words = data.split()
    n = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    known = set(words)
    return np.concatenate([
        np.sqrt(shares),
        [len(known) / n, same / n, min(sum(map(len, words)) / n, 40) / 10, 1 - len(set(lines)) / max(len(lines), 1),
         np.log1p(n) / 10, len(known) / n * np.log1p(n) / 10],
    ])


@dataclass(frozen=True)
class Levels:
    """Numbers of the languages and sources with a level of their own."""

    langs: dict[str, int]
    sources: dict[str, int]

    @staticmethod
    def _at(value: str | None, known: dict[str, int]) -> int:
        return 0 if value is None else known.get(value, 1)

    def view(self, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
        """What is known about a page without its words: language, source and length."""
        out = np.zeros(len(self.langs) + len(self.sources) + 7)
        out[self._at(lang, self.langs)] = 1
        out[len(self.langs) + 2 + self._at(source, self.sources)] = 1
        size = np.log1p(max(n_chars or 0, 0)) / 10
        out[-3:] = size, size * size, n_chars is None
        return out


def levels(docs: DataFrame, max_langs: int = MAX_LANGS, max_sources: int = MAX_SOURCES) -> Levels:
    """Levels by grouped counts over all documents, of equally frequent values the smaller ones first."""
    rows = docs.select(*_columns(docs))

    def most(column: str, n: int) -> dict[str, int]:
        counts = rows.where(F.col(column).isNotNull()).groupBy(column).count()
        top = counts.orderBy(F.desc("count"), column).limit(n).collect()
        return {r[column]: i + 2 for i, r in enumerate(top)}

    return Levels(most("lang", max_langs), most("source", max_sources))


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class Logistic:
    """Ridge logistic regression by Newton steps, and Platt scaling of its scores."""

    def __init__(self, x: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.w = np.zeros(x.shape[1] + 1)
        self.penalty = np.full(len(self.w), ridge)
        self.penalty[-1] = 1e-6
        self.a, self.b = 1.0, 0.0

    def wide(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def sums(self, x: np.ndarray, y: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """Slope and bend of the likelihood over rows."""
        z = self.wide(x)
        p = _chance(z @ self.w)
        return z.T @ (y - p), (z * (p * (1 - p))[:, None]).T @ z

    def step(self, slope: np.ndarray, bend: np.ndarray) -> float:
        moved = np.linalg.solve(bend + np.diag(self.penalty + 1e-9), slope - self.penalty * self.w)
        self.w = self.w + moved
        return float(np.abs(moved).max())

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        raw = self.wide(x) @ self.w
        two = np.stack([raw, np.ones(len(raw))], axis=1)
        ab = np.array([1.0, 0.0])
        for _ in range(20):
            p = _chance(two @ ab)
            bend = (two * (p * (1 - p))[:, None]).T @ two + np.eye(2)
            ab = ab + np.linalg.solve(bend, two.T @ (y - p) - (ab - [1.0, 0.0]))
        self.a, self.b = max(ab[0], 0.0), ab[1]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.a * (self.wide(x) @ self.w) + self.b, -30, 30)


class CoTrained:
    """Two calibrated views; the combined log odds count the shared prior once."""

    def __init__(self, views: list[Logistic], prior: float, limit: float, levels: Levels | None = None):
        self.views, self.prior, self.limit, self.levels = views, prior, limit, levels

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        odds = self.views[0].logit(text) + self.views[1].logit(meta) - self.prior
        return 1 / (1 + np.exp(-odds))


def taught_sums(views: list[np.ndarray], judges: list[Logistic], pupils: list[Logistic]) -> list[list[np.ndarray]]:
    """For each pupil and class (0, 1): rows of which the other view's judge is sure, as one matrix of the pupil's bend, slope
    (last but one row) and count (last row, first entry)."""
    out = []
    for v in range(2):
        odds = judges[1 - v].logit(views[1 - v])
        per_class = []
        for label, sure in ((0, odds < -SURE), (1, odds > SURE)):
            slope, bend = pupils[v].sums(views[v][sure], float(label))
            per_class.append(np.vstack([bend, slope, np.full(len(slope), float(sure.sum()))]))
        out.append(per_class)
    return out


class ArrayPool:
    """Unlabelled rows in memory."""

    def __init__(self, views: list[np.ndarray]):
        self.views = views

    def sums(self, judges: list[Logistic], pupils: list[Logistic]) -> list[list[np.ndarray]]:
        return taught_sums(self.views, judges, pupils)


class TablePool:
    """All unlabelled rows of a kept table (doc_id, a, b): each pass adds up slopes and bends in the tasks, as whole numbers, and
    only sums of the size of the models come to the driver."""

    def __init__(self, features: DataFrame, labelled_ids: np.ndarray):
        self.features, self.labelled = features, np.sort(labelled_ids)

    def sums(self, judges: list[Logistic], pupils: list[Logistic]) -> list[list[np.ndarray]]:
        labelled, sizes = self.labelled, [len(p.w) for p in pupils]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                ids = batch.column(0)
                free = np.asarray(ids.is_null()) | ~np.isin(np.asarray(ids.fill_null(0)), labelled)
                views = [_stacked(batch.column(1 + v))[free] for v in range(2)]
                new = taught_sums(views, judges, pupils)
                total = new if total is None else [[x + y for x, y in zip(t, n)] for t, n in zip(total, new)]
            rows = []
            for v, per_class in enumerate(total or []):
                for label, matrix in enumerate(per_class):
                    whole = np.rint(matrix * (1 << SUM_BITS)).astype(np.int64)
                    rows += [(2 * v + label, k, part.tobytes()) for k, part in enumerate(np.array_split(whole, SUM_PARTS))]
            at, part, values = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(part, pa.int32()), pa.array(values, pa.binary())], names=["at", "part", "values"]
            )

        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, dtype=np.int64) for x in table.column("values").to_pylist())
            return pa.table({"at": table.column("at")[:1], "part": table.column("part")[:1], "values": [total.tobytes()]})

        schema = "at int, part int, values binary"
        parts = self.features.mapInArrow(run, schema).groupBy("at", "part").applyInArrow(added, schema).collect()
        found = {(r["at"], r["part"]): np.frombuffer(r["values"], dtype=np.int64) for r in parts}
        out = []
        for v, size in enumerate(sizes):
            per_class = []
            for label in range(2):
                pieces = [found.get((2 * v + label, k)) for k in range(SUM_PARTS)]
                whole = np.zeros((size + 2) * size) if pieces[0] is None else np.concatenate(pieces) / (1 << SUM_BITS)
                per_class.append(whole.reshape(size + 2, size))
            out.append(per_class)
        return out


def _stacked(column: pa.Array) -> np.ndarray:
    """Rows of equally long float32 bytes."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<f4").reshape(len(rows), -1).astype("f8") if rows else np.zeros((0, 0))


def co_train(
    views: list[np.ndarray], y: np.ndarray, pool: "list[np.ndarray] | ArrayPool | TablePool", rounds: int = ROUNDS, steps: int = STEPS
) -> CoTrained | None:
    """Fit on three of four labelled rows, calibrate on the fourth. In each round each view labels all pool rows of which it is sure, for the
    other view's Newton steps; together they weigh half as much as the labelled rows of their class, at most one each.
    None if a class is missing."""
    held = np.arange(len(y)) % 4 == 3
    if len(y) < 8 or min(y[~held].mean(), 1 - y[~held].mean()) == 0 or min(y[held].mean(), 1 - y[held].mean()) == 0:
        return None
    pool = ArrayPool(pool) if isinstance(pool, list) else pool
    known, labels = [v[~held] for v in views], y[~held]
    models = [Logistic(x) for x in known]
    for v in range(2):
        for _ in range(12):
            if models[v].step(*models[v].sums(known[v], labels)) < 1e-6:
                break
        models[v].calibrate(views[v][held], y[held])
    for _ in range(rounds):
        judges = copy.deepcopy(models)
        for model in models:  # from 0, as a step from a sure fit overshoots on rows that contradict it
            model.w = np.zeros(len(model.w))
        for _ in range(steps):
            taught = pool.sums(judges, models)
            for v in range(2):
                slope, bend = models[v].sums(known[v], labels)
                for label, part in enumerate(taught[v]):
                    if n := part[-1, 0]:
                        weight = min(1.0, TAUGHT * float((labels == label).sum()) / n)
                        slope, bend = slope + weight * part[-2], bend + weight * part[:-2]
                models[v].step(slope, bend)
        for v in range(2):
            models[v].calibrate(views[v][held], y[held])
    prior = float(np.log(y.mean() / (1 - y.mean())))
    out = CoTrained(models, prior, 0.0)
    good = out.score(views[0][held], views[1][held])[y[held] == 1]
    out.limit = min(0.5, float(np.quantile(good, 1 - KEEP_GOOD)) - 1e-9)
    return out


def _columns(docs: DataFrame) -> list:
    have = set(docs.columns)
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    return [(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]


def fit_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_others: int = 0) -> DataFrame:
    """At most ``max_labelled`` labelled rows, one an id, and if wanted ``max_others`` others (quality -1): doc_id,
    quality, text, lang, source, n_chars. Of rows that repeat an id the one with the least hash counts."""
    marks = (
        labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    wanted = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    if max_others:
        ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
        free = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_others).withColumn("quality", F.lit(-1))
        wanted = wanted.unionByName(free).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_columns(docs)).join(F.broadcast(wanted), "doc_id")
    parts = ["text", "lang", "source", "n_chars"]
    one = F.min_by(F.struct(*parts), F.xxhash64(*parts)).alias("row")
    return found.groupBy("doc_id", "quality").agg(one).select("doc_id", "quality", *[f"row.{c}" for c in parts])


def with_views(rows: DataFrame, known: Levels) -> DataFrame:
    """Rows (doc_id, quality, a, b): both views as bytes of float32 numbers; quality null if ``rows`` has none."""

    def make():
        def views(doc_id, quality, text, lang, source, n_chars):
            yield doc_id, quality, text_view(text).astype("<f4").tobytes(), known.view(lang, source, n_chars).astype("<f4").tobytes()

        return views

    quality = F.col("quality") if "quality" in rows.columns else F.lit(None)
    picked = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), quality.cast("int").alias("quality"), F.col("text").cast("string").alias("text"),
        *_columns(rows),
    )
    return map_rows(
        picked, make, "doc_id bigint, quality int, a binary, b binary", ["doc_id", "quality", "text", "lang", "source", "n_chars"]
    )


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> CoTrained | None:
    """Both views from at most ``max_labelled`` labelled rows, chosen by hash, and from all other rows of ``docs``, whose views are
    kept and read again by each step. None without labelled rows of both classes."""
    known = levels(docs)
    rows = with_views(fit_rows(docs, labels, max_labelled), known).toArrow()
    ids = rows.column("doc_id").to_numpy()
    order = np.lexsort((ids, [zlib.crc32(str(i).encode()) for i in ids.tolist()]))
    y = (rows.column("quality").to_numpy()[order] > 0).astype("f8")
    if not 0 < y.sum() < len(y):
        return None
    views = [_stacked(rows.column(c).combine_chunks())[order] for c in "ab"]
    features = keep(with_views(docs.drop("quality"), known).select("doc_id", "a", "b"), "views")
    model = co_train(views, y, TablePool(features, ids))
    if model:
        model.levels = known
    return model


def _scores(model: CoTrained | None, texts, langs, sources, sizes) -> np.ndarray:
    if model is None or not len(texts):
        return np.ones(len(texts))
    a = np.array([text_view(t if isinstance(t, str) else None) for t in texts])
    b = np.array([
        model.levels.view(
            x if isinstance(x, str) else None, s if isinstance(s, str) else None, None if n != n or n is None else int(n)
        )
        for x, s, n in zip(langs, sources, sizes)
    ])
    return model.score(a, b)


def classify(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, fit_docs: DataFrame | None = None
) -> DataFrame:
    """The documents with ``quality_score`` (0 to 1) and ``quality_kept`` added, replacing columns of those names.

    A document is kept if its score reaches the threshold: at most 0.5, and so low that 99.8 % of held-out good
    rows are kept. The views are fitted on ``fit_docs``, by default the documents themselves; a later stage of a pipeline, whose input has
    lost most bad rows, names the pipeline's input. A null text counts as empty; null or missing metadata is a value of its own; repeated rows get
    the same score; without labels of both classes, which is logged, every document scores 1 and stays; an empty table stays empty.
    """
    model = fit(docs if fit_docs is None else fit_docs, labels, max_labelled)
    if model is None:
        logging.getLogger(__name__).warning("no labelled rows of both classes: every document is kept")
    limit = model.limit if model else 0.0

    def score(text, lang, source, n_chars):
        import pandas as pd

        return pd.Series(_scores(model, text, lang, source, n_chars))

    small_batches(docs.sparkSession)
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("quality_score", "quality_kept")]
    out = docs.select(*columns, F.pandas_udf(score, "double")(F.col("text").cast("string"), *_columns(docs)).alias("quality_score"))
    return out.withColumn("quality_kept", F.col("quality_score") >= limit)
