"""Both silhouette forms against brute force, with a hot cluster, equal points and several labelings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.operators import topics


def brute(x, label, squared):
    dist = np.linalg.norm(x[:, None] - x[None], axis=2) ** (2 if squared else 1)
    out = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1 or len(set(label)) == 1:
            out.append(0.0)
            continue
        a, b = dist[i, own].sum() / (own.sum() - 1), min(dist[i, label == c].mean() for c in set(label) - {label[i]})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 5)) + 1000.0
    x[100:] = x[100]
    labels = np.stack([np.where(np.arange(150) % 3 == 0, 0, np.arange(150) % 5), np.zeros(150, int), np.arange(150) // 149], axis=1)
    rows = [(f"p{i:03}", p.tolist(), q.tolist()) for i, (p, q) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "id string, v array<double>, l array<int>"), x, labels


@pytest.mark.parametrize("squared, block", [(False, 1024), (False, 20), (True, 1024)])
def test_forms_equal_brute_force(data, squared, block):
    df, x, labels = data
    got = {(r.id, r.labeling): r.silhouette for r in topics.silhouettes(df, "id", "v", "l", block, squared).collect()}
    assert len(got) == 450
    for g in range(3):
        for i, want in enumerate(brute(x, labels[:, g], squared)):
            # squared distances come from sums over points far from the origin
            assert got[f"p{i:03}", g] == pytest.approx(want, abs=1e-5 if squared else 1e-6)


def test_one_row_a_point_and_cluster_leaves(data):
    df, _, labels = data
    for block in (20, 1024):
        totals = topics._distance_totals(df, block)
        assert totals.count() == totals.dropDuplicates(["id", "labeling", "cluster"]).count() == 150 * sum(len(set(c)) for c in labels.T)


def test_no_points(spark):
    none = spark.createDataFrame([], "id long, v array<double>, l array<int>")
    assert topics.silhouettes(none, "id", "v", "l").count() == 0 and topics.silhouettes(none, "id", "v", "l", squared=True).count() == 0
    one = spark.createDataFrame([(1, [2.0], [0])], "id long, v array<double>, l array<int>")
    assert [r.silhouette for r in topics.silhouettes(one, "id", "v", "l").collect()] == [0.0]
    assert topics.silhouettes(one, "id", "v", "l").groupBy().agg(F.max("cluster")).first()[0] == 0


def test_many_clusters_are_summed_in_little_memory():
    """A batch of 8,000 points of 8,000 clusters: the matrix of points and clusters would be 512 MB."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)

    def table(ids, label):
        x = rng.random((len(ids), 4))
        return x, pa.table({"id": ids, "v": x.tolist(), "l": pa.array([[int(c)] for c in label], pa.list_(pa.int32()))})

    x, block = table(list(range(16)), range(16))
    label = rng.permutation(8_000) % 7_500
    y, stream = table(list(range(100, 8_100)), label)
    tracemalloc.start()
    sums = topics._BlockSums(block)
    sums.add(stream)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000 and len(sums.sums) == 7_500
    far = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))
    for c in (0, 499, 7_000):
        assert np.allclose(sums.sums[0, c], far[:, label == c].sum(axis=1))


def test_points_are_not_copied_for_each_block(spark):
    """All points pass the blocks where they lie: no exchange of points grows with the number of blocks; points without id are met but not listed."""
    rng = np.random.default_rng(8)
    x, label = rng.normal(size=(300, 3)), np.arange(300) % 4
    rows = [(i if i else None, p.tolist(), [int(c)]) for i, (p, c) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "id long, v array<double>, l array<int>")
    plan = topics._distance_totals(df, 20)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "Sort" not in plan
    got = {r.id: r.silhouette for r in topics.silhouettes(df, "id", "v", "l", 20).collect()}
    want = brute(x, label, False)
    assert set(got) == set(range(1, 300)) and all(got[i] == pytest.approx(want[i], abs=1e-6) for i in got)
