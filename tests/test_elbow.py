"""The elbow sweep: all fits share their passes and give what fits of their own give."""

import numpy as np
from pyspark.ml.functions import array_to_vector

from replyscope.operators import topics


def test_fits_share_passes_and_keep_their_results(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) + 3 * (i % 5)).tolist()) for i in range(120)] + [(200 + i, [0.0] * 4) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").coalesce(2).select("vec_id", array_to_vector("v").alias("features"))
    alone = {k: topics.fit_kmeans(df, k, restarts=2) for k in (3, 5)}
    fitted = []

    class Starts(topics.KMeans):
        def fit(self, data):
            fitted.append(self.getMaxIter())
            return super().fit(data)

    monkeypatch.setattr(topics, "KMeans", Starts)
    sweep = {r.k: r for r in topics.elbow_sweep(df, "vec_id", range(3, 6), restarts=2).collect()}
    assert fitted == [0] * 6 and sorted(sweep) == [3, 4, 5]
    for k, model in alone.items():
        assert abs(sweep[k].inertia - model.summary.trainingCost) < 1e-6 and -1 <= sweep[k].silhouette <= 1


def test_a_centre_without_points_stays(spark):
    points = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(10)], "id long, v array<double>")
    ((centres, cost),) = topics._fit_together(points, [np.array([[0.2, 0.0], [0.9, 0.0], [50.0, 50.0]])])
    assert np.allclose(centres, [[0, 0], [1, 0], [50, 50]]) and abs(cost) < 1e-9
    assert {tuple(r.l) for r in topics._nearest(points, [centres]).collect()} == {(0,), (1,)}
