"""Topic clusters of macros: k-means, labels, summaries and cluster quality."""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.text import title_case
from replyscope.operators.blocks import BLOCK, PART_BLOCKS, matrix
from replyscope.operators.ranking import grouped_quantile
from replyscope.operators.texts import TfidfModel
from replyscope.schemas import NUM_CLUSTERS, SEED
from replyscope.sources.tables import stage

FEW = 64  # clusters met at a time that are summed by a product
MOST_SIZES = 10_000  # sizes of clusters that go to every task; more are joined by a shuffle


def fit_kmeans(
    vectors: DataFrame,
    k: int = NUM_CLUSTERS,
    restarts: int = 10,
    seed: int = SEED,
    parallelism: int = 4,
    features: str = "features",
) -> KMeansModel:
    """Best of several seeded starts by training cost. Fits run side by side; each is distributed."""

    def fit(s: int) -> KMeansModel:
        return KMeans(k=k, seed=s, maxIter=300, tol=1e-4, featuresCol=features, predictionCol="cluster_id").fit(vectors)

    with ThreadPoolExecutor(max(1, min(parallelism, restarts))) as pool:
        fitted = list(pool.map(fit, range(seed, seed + restarts)))
    # Starts often end in the same optimum under other numbers: sums that differ only by their order
    # must not choose between them, so nine digits decide and then the earlier seed.
    return min(fitted, key=lambda m: float(f"{m.summary.trainingCost:.8e}"))


def assign_topics(model: KMeansModel, vectors: DataFrame) -> DataFrame:
    return model.transform(vectors)


def save_models(path: str, tfidf: TfidfModel, clusters: KMeansModel) -> str:
    """Text weighting and clustering as one reloadable pipeline over a ``_terms`` column."""
    PipelineModel([*tfidf.stages().stages, clusters]).write().overwrite().save(path)
    return path


def load_models(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cluster_labels(weights: DataFrame, members: DataFrame, n: int = 3) -> DataFrame:
    """Highest mean term weights of each cluster as a label.

    ``weights`` is (macro_id, term, weight), ``members`` (macro_id, cluster_id). The term table per
    cluster is bounded by the vocabulary.
    """
    sizes = members.where(F.col("cluster_id").isNotNull()).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_members")
    )
    summed = weights.join(members, "macro_id").groupBy("cluster_id", "term").agg(F.sum("weight").alias("_w"))
    mean = summed.join(sizes, "cluster_id").withColumn(
        "_m", F.floor(F.col("_w") / F.col("n_members") * 1e9 + 0.5)
    )
    best = Window.partitionBy("cluster_id").orderBy(F.desc("_m"), "term")
    top = mean.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= n)
    words = F.sort_array(F.collect_list(F.struct("_r", "term")))
    return top.groupBy("cluster_id").agg(
        title_case(F.array_join(F.transform(words, lambda x: x["term"]), " / ")).alias("cluster_label")
    )


def cluster_macros(
    scores: DataFrame, vectors: DataFrame, weights: DataFrame, model: KMeansModel
) -> DataFrame:
    """Scores with ``cluster_id`` and ``cluster_label``."""
    members = model.transform(vectors).select("macro_id", "cluster_id")
    labels = cluster_labels(weights, members)
    return scores.join(members, "macro_id").join(labels, "cluster_id", "left").withColumn(
        "cluster_label", F.coalesce("cluster_label", F.lit(""))
    )


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Size, index, use and category counts per cluster; large weak clusters are flagged."""
    keys = ["cluster_id", "cluster_label"]
    known = clustered.where(F.col("cluster_id").isNotNull() & F.col("cluster_label").isNotNull())
    summary = known.groupBy(*keys).agg(
        F.count("macro_id").alias("num_macros"),
        F.avg("macro_effectiveness_index").alias("avg_effectiveness"),
        F.sum("usage_count").alias("total_usage"),
        F.avg("usage_count").alias("avg_usage"),
        F.count_if(F.col("macro_category") == "Underused Gem").alias("num_underused_gems"),
        F.count_if(F.col("macro_category") == "Low Effectiveness").alias("num_low_effectiveness"),
    )
    median = grouped_quantile(known, keys, "macro_effectiveness_index", 0.5, "median_effectiveness")
    flag = (F.col("num_macros") >= 5) & (F.col("avg_effectiveness") < 50)
    return summary.join(median, keys, "left").withColumn("consolidation_candidate", F.coalesce(flag, F.lit(False)))


def silhouettes(
    points: DataFrame, id_col: str, v: str, labels: str, block: int = BLOCK, squared: bool = False
) -> DataFrame:
    """Euclidean silhouette of every point under each of several labelings: (id, labeling, cluster, silhouette).

    ``labels`` is an array of cluster numbers, one per labeling. A point alone in its cluster scores 0. The exact form
    compares all pairs: a block of points stays in its task while all others stream by, and one row a point and cluster
    leaves it. ``squared`` uses squared distances instead, which follow from the clusters' sizes, sums and square sums,
    so that the work is linear in the points.
    """
    rows = points.select(F.col(id_col).alias("id"), F.col(v).cast("array<double>").alias("v"),
                         F.col(labels).cast("array<int>").alias("l"))
    sizes = rows.select(F.posexplode("l").alias("labeling", "cluster")).groupBy("labeling", "cluster").agg(
        F.count(F.lit(1)).alias("size")
    )
    sizes = stage(sizes)
    if squared:
        own = rows.select("id", F.posexplode("l").alias("labeling", "own"))
        totals = _squared_totals(rows, sizes).join(own, ["id", "labeling"])
    else:
        totals = _distance_totals(rows, block)
    placed = totals.join(F.broadcast(sizes) if sizes.count() <= MOST_SIZES else sizes, ["labeling", "cluster"])
    mine = F.col("cluster") == F.col("own")
    means = placed.where("id is not null").groupBy("id", "labeling").agg(
        F.max("own").alias("cluster"),
        F.max(F.when(mine, F.col("size"))).alias("_n"),
        F.max(F.when(mine, F.try_divide(F.col("d"), F.col("size") - 1))).alias("_a"),
        F.min(F.when(~mine, F.col("d") / F.col("size"))).alias("_b"),
    )
    score = F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b"))
    return means.select(
        F.col("id").alias(id_col), "labeling", "cluster",
        F.when((F.col("_n") == 1) | F.col("_b").isNull(), 0.0).otherwise(F.coalesce(score, F.lit(0.0))).alias("silhouette"),
    )


def _distance_totals(rows: DataFrame, block: int) -> DataFrame:
    """Sums of distances from each point to each cluster of each labeling: id, labeling, cluster, own (the point's cluster), d.

    Points are packed to blocks of at most ``block``, a row each. A task holds a part of the blocks; all blocks pass it one after the other, read
    where they lie, so that the comparisons grow with the square of the points but what is written grows with the points.
    """
    kind, spark = rows.schema["id"].dataType.simpleString(), rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n = rows.count()
    size = max(1, min(block, max(64, math.ceil(n / cores))))  # few points still make a block for each core

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, size) for whole in batches for k in range(0, len(whole), size)):
            flat = [batch.column(0), pa.array(matrix(pa.chunked_array([batch.column(1)])).ravel())]
            flat.append(pa.array(matrix(pa.chunked_array([batch.column(2)]), np.int32).ravel()))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in flat]
            yield pa.RecordBatch.from_arrays(lists, names=["id", "v", "l"])

    blocks = rows.mapInArrow(pack, f"id array<{kind}>, v array<double>, l array<int>")
    blocks = stage(blocks.withColumn("no", F.monotonically_increasing_id()))
    count = blocks.count()
    parts = max(1, min(count, max(2 * cores, math.ceil(count / PART_BLOCKS))))
    own = blocks.repartition(parts).select(*[F.col(c).alias(f"own_{c}") for c in ("id", "v", "l", "no")])
    met = blocks.coalesce(1).hint("shuffle_replicate_nl").crossJoin(own)  # the left side passes, a part of the right one is held

    def table(batch: pa.RecordBatch, row: int, side: str) -> pa.Table:
        id, v, l = (batch.column(side + c)[row].values for c in ("id", "v", "l"))
        return pa.table({"id": id, **{c: pa.FixedSizeListArray.from_arrays(x, len(x) // len(id)) for c, x in (("v", v), ("l", l))}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, at, passing = {}, None, None
        for batch in batches:
            for row in range(len(batch)):
                no, mine = batch.column("no")[row].as_py(), batch.column("own_no")[row].as_py()
                if no != at:
                    at, passing = no, table(batch, row, "")
                if mine not in sums:
                    sums[mine] = _BlockSums(table(batch, row, "own_"))
                sums[mine].add(passing)
        for block_sums in sums.values():
            yield from block_sums.rows(kind)

    return met.mapInArrow(run, f"id {kind}, labeling int, cluster int, own int, d double")


class _BlockSums:
    """Distance sums of a block's points, growing with each cluster met."""

    def __init__(self, block: pa.Table):
        self.ids, self.x = block.column("id").combine_chunks(), matrix(block.column("v"))
        self.own = matrix(block.column("l"), np.int32)
        self.square = (self.x * self.x).sum(1)[:, None]
        self.sums: dict[tuple[int, int], np.ndarray] = {}

    def add(self, stream: pa.Table) -> None:
        for k in range(0, len(stream), BLOCK):
            self._add(stream.slice(k, BLOCK))

    def _add(self, stream: pa.Table) -> None:
        y, labels = matrix(stream.column("v")), matrix(stream.column("l")).astype(np.int64)
        distance = np.sqrt(np.maximum(self.square + (y * y).sum(1)[None, :] - 2 * self.x @ y.T, 0))
        at = pc.index_in(stream.column("id").combine_chunks(), value_set=self.ids)
        own = np.nonzero(np.asarray(at.is_valid()))[0]
        distance[np.asarray(at.fill_null(0))[own], own] = 0  # whatever rounding leaves of a point's distance to itself
        for g in range(labels.shape[1]):
            present, where = np.unique(labels[:, g], return_inverse=True)
            if len(present) <= FEW:
                total = distance @ np.eye(len(present))[where]
            else:  # no matrix of points and clusters
                order = np.argsort(where, kind="stable")
                total = np.add.reduceat(distance[:, order], np.searchsorted(where[order], np.arange(len(present))), axis=1)
            for c, cluster in enumerate(present.tolist()):
                self.sums[g, cluster] = self.sums.get((g, cluster), 0) + total[:, c]

    def rows(self, kind: str) -> Iterator[pa.RecordBatch]:
        n = len(self.ids)
        for (labeling, cluster), d in self.sums.items():
            yield pa.RecordBatch.from_arrays(
                [self.ids, pa.array(np.full(n, labeling, dtype=np.int32)), pa.array(np.full(n, cluster, dtype=np.int32)), pa.array(self.own[:, labeling]), pa.array(d)],
                names=["id", "labeling", "cluster", "own", "d"],
            )


def _squared_totals(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sums of squared distances from each point to each cluster: n |x|^2 - 2 x.sum + sum of squares; id, labeling, cluster, d.

    The clusters' sums are of the size of labelings times clusters times dimensions and travel to every row in one array.
    """
    labelled = rows.select("v", F.posexplode("l").alias("labeling", "cluster"))
    each = labelled.select("labeling", "cluster", F.posexplode("v").alias("at", "x"))
    per = each.groupBy("labeling", "cluster", "at").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    facts = per.groupBy("labeling", "cluster").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "s"))), lambda e: e["s"]).alias("s"), F.sum("q").alias("q")
    ).join(sizes, ["labeling", "cluster"])
    every = facts.agg(F.collect_list(F.struct("labeling", "cluster", "s", "q", "size")).alias("f"))
    described = rows.withColumn("_f", every.scalar()).select("id", "v", F.explode("_f").alias("f"))
    zero = F.lit(0.0)
    square = F.aggregate("v", zero, lambda acc, x: acc + x * x)
    product = F.aggregate(F.zip_with("v", "f.s", lambda x, y: x * y), zero, lambda acc, x: acc + x)
    total = F.col("f.size") * square - 2.0 * product + F.col("f.q")
    return described.select("id", "f.labeling", "f.cluster", F.greatest(total, zero).alias("d"))


def silhouette_by_cluster(points: DataFrame) -> DataFrame:
    """Mean silhouette and size per cluster, and the overall mean under cluster -1."""
    per = points.groupBy("cluster").agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("size"))
    overall = points.agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("size"))
    return per.unionByName(overall.select(F.lit(-1).alias("cluster"), "silhouette", "size"))


def elbow_sweep(
    vectors: DataFrame, id_col: str, ks: range = range(4, 20), restarts: int = 10, seed: int = SEED,
    features: str = "features", parallelism: int = 8,
) -> DataFrame:
    """Inertia and mean silhouette per number of clusters; all fits share their passes, and one distance pass serves all of them."""
    points = stage(vectors.select(F.col(id_col).alias("id"), vector_to_array(features).alias("v")))
    starts = _first_centres(vectors, [(k, s) for k in ks for s in range(seed, seed + restarts)], features, parallelism)
    fits = _fit_together(points, starts)
    best = []  # as in fit_kmeans: nine digits decide, then the earlier seed
    for i in range(len(ks)):
        best.append(min(fits[i * restarts : (i + 1) * restarts], key=lambda fit: float(f"{fit[1]:.8e}")))
    inertia = vectors.sparkSession.createDataFrame(
        [(i, k, float(cost)) for i, (k, (_, cost)) in enumerate(zip(ks, best))], "labeling int, k int, inertia double"
    )
    labelled = _nearest(points, [centres for centres, _ in best])
    means = silhouettes(labelled, "id", "v", "l").groupBy("labeling").agg(F.avg("silhouette").alias("silhouette"))
    return F.broadcast(inertia).join(means, "labeling").drop("labeling")


def _first_centres(vectors: DataFrame, wanted: list[tuple[int, int]], features: str, parallelism: int) -> list[np.ndarray]:
    """The centres from which a fit of each (k, seed) starts."""

    def start(k: int, s: int) -> np.ndarray:
        return np.array(KMeans(k=k, seed=s, maxIter=0, featuresCol=features, predictionCol="cluster_id").fit(vectors).clusterCenters())

    with ThreadPoolExecutor(max(1, min(parallelism, len(wanted)))) as pool:
        return list(pool.map(lambda each: start(*each), wanted))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres."""
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * x @ centres.T, 0)


def _fit_together(
    points: DataFrame, starts: list[np.ndarray], max_iter: int = 300, tol: float = 1e-4
) -> list[tuple[np.ndarray, float]]:
    """Centres and cost of many k-means fits of the same points: one pass moves the centres of all fits that still move.

    As in a fit of its own, the cost is that of the last pass, a centre without points stays, and a fit ends once no centre moves
    by more than ``tol``. A task holds a batch of points and a sum a centre; the driver gets the centres' sums, added up per fit.
    """
    centres, costs, moving = [c.copy() for c in starts], [0.0] * len(starts), list(range(len(starts)))
    for _ in range(max_iter):
        if not moving:
            break
        now = {f: centres[f] for f in moving}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # a row per centre: number of points, cost, sum
            sums = {f: np.zeros((len(c), c.shape[1] + 2)) for f, c in now.items()}
            for batch in (whole.slice(k, BLOCK) for whole in batches for k in range(0, len(whole), BLOCK)):
                x = matrix(pa.chunked_array([batch.column(0)]))
                distance = _distances(x, np.concatenate(list(now.values())))
                facts = np.concatenate([np.ones((len(x), 1)), np.zeros((len(x), 1)), x], axis=1)
                first = 0
                for f, c in now.items():
                    mine = distance[:, first : first + len(c)]
                    nearest = mine.argmin(1)
                    facts[:, 1] = mine[np.arange(len(x)), nearest]
                    sums[f] += np.eye(len(c))[nearest].T @ facts
                    first += len(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fit", "sums"]
            )

        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, fit = 0, None
            for part in parts:
                fit = fit or part.column(0).slice(0, 1)
                for s in part.column(1).to_pylist():
                    total = total + np.frombuffer(s)
            yield pa.RecordBatch.from_arrays([fit, pa.array([total.tobytes()], pa.binary())], names=["fit", "sums"])

        kind = "fit int, sums binary"
        for row in points.select("v").mapInArrow(run, kind).groupBy("fit").applyInArrow(add, kind).collect():
            old = centres[row["fit"]]
            facts = np.frombuffer(row["sums"]).reshape(len(old), -1)
            met = facts[:, 0] > 0
            new = old.copy()
            new[met] = facts[met, 2:] / facts[met, :1]
            centres[row["fit"]], costs[row["fit"]] = new, facts[:, 1].sum()
            if (((new - old) ** 2).sum(1) <= tol * tol).all():
                moving.remove(row["fit"])
    return list(zip(centres, costs))


def _nearest(points: DataFrame, models: list[np.ndarray]) -> DataFrame:
    """Points with ``l``, the number of the nearest centre in each of several sets of centres."""
    kind = points.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, BLOCK) for whole in batches for k in range(0, len(whole), BLOCK)):
            x = matrix(pa.chunked_array([batch.column(1)]))
            found = np.stack([_distances(x, c).argmin(1) for c in models], axis=1).astype(np.int32)
            ends = pa.array(np.arange(0, found.size + 1, len(models), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], names=["id", "v", "l"]
            )

    return points.mapInArrow(run, f"id {kind}, v array<double>, l array<int>")


def pca_2d(vectors: DataFrame, id_col: str, model: KMeansModel | None = None, features: str = "features"):
    """Two centred principal components per row; also projected cluster centres and variance shares."""
    centred = StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol="_centred").fit(vectors)
    pca = PCA(k=2, inputCol="_centred", outputCol="_pc").fit(centred.transform(vectors))

    def project(df: DataFrame, *keep: str) -> DataFrame:
        axes = vector_to_array("_pc")
        out = pca.transform(centred.transform(df))
        return out.select(*keep, axes[0].alias("pc1"), axes[1].alias("pc2"))

    centres = None
    if model is not None:
        from pyspark.ml.linalg import Vectors

        rows = [(i, Vectors.dense(c)) for i, c in enumerate(model.clusterCenters())]
        centres = project(vectors.sparkSession.createDataFrame(rows, ["cluster_id", features]), "cluster_id")
    return project(vectors, id_col), centres, [float(x) for x in pca.explainedVariance.toArray()]
