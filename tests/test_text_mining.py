import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from replyscope.functions.text import STOP_WORDS
from replyscope.operators import predict, similarity, texts, topics

BODIES = [
    "reset your password now", "reset your password now", "reset your password today", "refund is on its way",
    "refund was sent, way to go", "", "billing cycle explained here", "reset your password now", "refund is on its way",
]


@pytest.fixture(scope="module")
def library(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "macro_id long, macro_body string")
    return texts.prepare_bodies(df).select("macro_id", "cleaned_text")


def brute_force(bodies):
    import re

    docs = []
    for b in bodies:
        words = [w for w in re.findall(r"\w{2,}", b.lower()) if w not in STOP_WORDS]
        docs.append(words + [" ".join(p) for p in zip(words, words[1:])])
    terms = sorted({t for d in docs for t in d})
    df = {t: sum(t in d for d in docs) for t in terms}
    m = np.array([[d.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in terms] for d in docs])
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    m = m / np.where(norms == 0, 1, norms)
    return m @ m.T


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


@pytest.mark.parametrize("block", [2, 1024])
def test_all_pairs_equal_brute_force(spark, library, block):
    sims = brute_force(BODIES)
    want = {(i, j): sims[i, j] for i in range(len(BODIES)) for j in range(i + 1, len(BODIES)) if sims[i, j] > 1e-9}
    pairs = similarity.cosine_pairs(library, block=block)
    assert sum(r.n_pairs for r in pairs.collect()) == len(want)
    groups = similarity.copy_groups(library)
    got = {(r.macro_a, r.macro_b): r.similarity for r in similarity.expand_copies(pairs, groups).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_statistics_equal_brute_force(spark, library):
    upper = brute_force(BODIES)[np.triu_indices(len(BODIES), 1)]
    counts = similarity.similarity_counts(library, block=3)
    row = similarity.similarity_stats(counts).first()
    assert row.mean_similarity == pytest.approx(upper.mean())
    assert row.median_similarity == pytest.approx(np.median(upper), abs=1e-6)
    assert row.std_similarity == pytest.approx(upper.std())
    assert (row.max_similarity, row.min_similarity) == (1.0, 0.0)
    assert row.pairs_above_40 == (upper >= 0.4).sum() and row.pairs_above_80 == (upper >= 0.8).sum()
    assert sum(r.n_pairs for r in similarity.similarity_histogram(counts).collect()) == len(upper)


def test_redundant_advice(spark, library):
    scores = spark.createDataFrame(
        [(i, f"name {i}", "c", 10 - i, 50.0) for i in range(len(BODIES))],
        "macro_id long, macro_name string, category string, usage_count int, macro_effectiveness_index double",
    )
    got = {(r.macro_a, r.macro_b): r for r in similarity.redundant_pairs(library, scores, 0.9).collect()}
    assert set(got) == {(0, 1), (0, 7), (3, 8)}
    assert got[(0, 7)].recommendation == "Keep 0, archive 7"
    assert sum(r.n_pairs for r in got.values()) == 4  # three copies make three pairs, two make one


def test_no_pairs_gives_an_empty_table(spark, library):
    few = library.where("macro_id in (0, 6)")
    assert similarity.cosine_pairs(few, 0.99).count() == 0


def test_vocabulary_limits_and_reuse(spark, library):
    model = texts.fit_tfidf(library, min_df=2, max_df=0.4, max_features=5)
    # "reset", "password" and their pair occur in four of nine texts: above the limit.
    assert model.terms == ["refund way", "refund", "way"] and model.document_frequency == [2, 3, 3]
    assert texts.fit_tfidf(library, max_features=2).terms == ["password", "reset"]
    new = spark.createDataFrame([(1, "refund refund unknown")], "macro_id long, cleaned_text string")
    assert [(r.term, r.weight) for r in texts.tfidf_terms(model, new).collect()] == [("refund", pytest.approx(1.0))]
    unknown = spark.createDataFrame([(1, "nothing known")], "macro_id long, cleaned_text string")
    assert model.transform(unknown).first().features.norm(2) == 0


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    data = [(i, (rng.normal(size=3) + 8 * (i % 3)).tolist(), i % 3) for i in range(60)]
    data.append((60, [99.0, 0.0, 0.0], 3))
    df = spark.createDataFrame(data, "vec_id long, v array<double>, label int")
    return df.withColumn("features", array_to_vector("v")), data


def test_silhouette_equals_brute_force(spark, points):
    df, data = points
    x, label = np.array([d[1] for d in data]), np.array([d[2] for d in data])
    dist = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = {}
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            want[i] = 0.0
            continue
        a = dist[i, own].sum() / (own.sum() - 1)
        b = min(dist[i, label == c].mean() for c in set(label) - {label[i]})
        want[i] = (b - a) / max(a, b)
    got = topics.silhouettes(df.select("vec_id", "v", F.array("label").alias("l")), "vec_id", "v", "l", block=7)
    for r in got.collect():
        assert r.silhouette == pytest.approx(want[r.vec_id], abs=1e-7)
    per = {r.cluster: r for r in topics.silhouette_by_cluster(got).collect()}
    assert per[3].size == 1 and per[-1].silhouette == pytest.approx(np.mean(list(want.values())))


def test_kmeans_is_repeatable_and_complete(spark, points):
    df, _ = points
    first = topics.fit_kmeans(df, 4, restarts=3)
    second = topics.fit_kmeans(df, 4, restarts=3)
    a = {r.vec_id: r.cluster_id for r in topics.assign_topics(first, df).collect()}
    b = {r.vec_id: r.cluster_id for r in topics.assign_topics(second, df).collect()}
    assert a == b and set(a.values()) == {0, 1, 2, 3} and len(a) == 61


def test_elbow_and_pca(spark, points):
    df, data = points
    sweep = topics.elbow_sweep(df, "vec_id", range(2, 5), restarts=2).orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3, 4]
    assert sweep[0].inertia > sweep[2].inertia and all(-1 <= r.silhouette <= 1 for r in sweep)
    projected, centres, shares = topics.pca_2d(df, "vec_id", topics.fit_kmeans(df, 4, restarts=1))
    x = np.array([d[1] for d in data])
    centred = x - x.mean(axis=0)
    singular = np.linalg.svd(centred, full_matrices=False)
    want = np.abs(centred @ singular[2][:2].T)
    got = np.abs(np.array([[r.pc1, r.pc2] for r in projected.orderBy("vec_id").collect()]))
    np.testing.assert_allclose(got, want, atol=1e-8)
    assert centres.count() == 4 and shares[0] >= shares[1]


def test_cluster_labels(spark, library):
    model = texts.fit_tfidf(library)
    members = library.select("macro_id", F.when(F.col("macro_id").isin(0, 1, 7), 0).otherwise(1).alias("cluster_id"))
    got = {r.cluster_id: r.cluster_label for r in topics.cluster_labels(texts.tfidf_terms(model, library), members, 1).collect()}
    assert got[0] in {"Password", "Reset", "Reset Password", "Password Now"}


def test_predictor(spark):
    rows = [(i, f"word{i % 3} other{i % 3} item{i}", f"M{i % 3}") for i in range(150)]
    df = spark.createDataFrame(rows, "ticket_id long, text string, macro_id string")
    model, held_out = predict.fit_predictor(df, n_trees=10, max_depth=4)
    row = model.evaluate(held_out).first()
    assert row.n_classes == 3 and row.n_samples == 150 and row.top3_accuracy == 1.0 and row.accuracy > 0.8
    best = model.predict_batch(df.limit(20), top_n=2)
    assert best.count() == 40 and {r.rank for r in best.collect()} == {1, 2}
    everything = model.predict_batch(df.limit(1), top_n=3).agg(F.sum("confidence")).first()[0]
    assert everything == pytest.approx(1.0)
    with pytest.raises(ValueError):
        predict.fit_predictor(df.limit(50))


def test_vocabulary_counts_few_pairs_of_words(spark, monkeypatch):
    """The same terms as counting every term; pairs of rare words never reach the shuffle."""
    import collections
    import random

    from replyscope.operators import texts as T

    dealer = random.Random(5)
    words = [f"w{dealer.randrange(1, 40) if dealer.random() < 0.7 else dealer.randrange(3_000)}" for _ in range(20_000)]
    rows = [(" ".join(words[k : k + dealer.randrange(0, 40)]), 1 + k % 3) for k in range(0, 20_000, 40)] + [("", 2), ("one", 1), (None, 4)]
    df = spark.createDataFrame(rows, "cleaned_text string, n long")
    total, df_, n = collections.Counter(), collections.Counter(), sum(r[1] for r in rows)
    for x, m in rows:
        t = (x or "").split()
        terms = t + [f"{a} {b}" for a, b in zip(t, t[1:])]
        for w in terms:
            total[w] += m
        for w in set(terms):
            df_[w] += m
    emitted, real = [], T._count_terms
    monkeypatch.setattr(T, "_count_terms", lambda k, common: emitted.append((k, common)) or real(k, common))
    for most, min_df, max_df in ((50, 1, 1.0), (30, 3, 0.3), (9_000, 1, 1.0)):
        model = T.fit_tfidf(df, max_features=most, min_df=min_df, max_df=max_df, copies="n", stop_words=[])
        kept = [w for w in total if min_df <= df_[w] <= max_df * n]
        want = sorted(sorted(kept, key=lambda w: (-total[w], w))[:most], key=lambda w: (df_[w], w))
        assert model.terms == want and model.document_frequency == [df_[w] for w in want] and model.n_documents == n
    assert [k for k, _ in emitted] == [1, 2] * 3 and emitted[1][1] is not None and len(emitted[1][1]) < 100
