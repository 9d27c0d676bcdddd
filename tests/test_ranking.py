import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from replyscope.operators import pairs, ranking


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(7)
    n = 3000
    frame = pd.DataFrame({"id": np.arange(n), "k": rng.integers(0, 4, n), "v": rng.normal(size=n).round(2)})
    frame.loc[: n // 3, ["k", "v"]] = [0, 0.5]  # one key and one value hold a third of the rows
    frame.loc[frame.id % 50 == 49, "v"] = np.nan
    return frame


def load(spark, frame):
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "id long, k long, v double")


def test_average_ranks(spark, values):
    got = ranking.average_ranks(load(spark, values), "id", ["v", "k"]).toPandas().sort_values("id").reset_index(drop=True)
    for c in ("v", "k"):
        for name, want in (
            ("asc", values[c].rank()), ("desc", values[c].rank(ascending=False)), ("pct", values[c].rank(pct=True)),
        ):
            np.testing.assert_allclose(got[f"{c}_rank_{name}"].astype(float), want, atol=1e-12)


def test_single_rank_keeps_unknown(spark, values):
    got = ranking.average_ranks(load(spark, values), "id", ["v"]).toPandas().sort_values("id")
    np.testing.assert_allclose(got["v_rank_pct"].astype(float), values["v"].rank(pct=True), atol=1e-12)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.75, 0.8, 1.0])
def test_grouped_quantile(spark, values, p):
    got = ranking.grouped_quantile(load(spark, values), ["k"], "v", p, "q").toPandas().set_index("k")["q"].sort_index()
    np.testing.assert_allclose(got, values.groupby("k")["v"].quantile(p), atol=1e-12)
    overall = ranking.grouped_quantile(load(spark, values), [], "v", p, "q").first()["q"]
    assert overall == pytest.approx(values["v"].quantile(p))


def test_quantile_of_nothing(spark, values):
    assert ranking.grouped_quantile(load(spark, values).where("false"), [], "v", 0.5, "q").first()["q"] is None


def test_number_rows(spark, values):
    known = load(spark, values).where("v is not null")
    got = ranking.number_rows(known, "v", "id", "n").toPandas().sort_values("n")
    want = values.dropna().sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist()
    assert got["n"].tolist() == list(range(1, len(want) + 1))


@pytest.mark.parametrize("threshold", [0.0, 0.3, 5.0])
@pytest.mark.parametrize("same", [True, False])
def test_band_pairs_equal_brute_force(spark, threshold, same):
    rng = np.random.default_rng(3)
    n = 240
    index = rng.uniform(0, 100, n).round(2)
    index[: n // 3] = 0.0  # a third of the macros share one index
    frame = pd.DataFrame({"macro_id": rng.permutation(n), "category": rng.choice(list("abc"), n), "macro_effectiveness_index": index})
    want = []
    ordered = frame.sort_values("macro_id").to_records(index=False)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if abs(a[2] - b[2]) <= threshold and (a[1] == b[1] or not same):
                want.append((a[1] if same else "", a[0], b[0]))
    want = [(a, b) for _, a, b in sorted(want)[:100]]
    df = spark.createDataFrame(frame)
    got = pairs.band_pairs(df, same, threshold)
    assert [(r.macro_a, r.macro_b) for r in got.select("macro_a", "macro_b").collect()] and sorted(
        (r.macro_a, r.macro_b) for r in got.select("macro_a", "macro_b").collect()
    ) == sorted(want)


def test_similar_macros_of_one_category(spark):
    df = spark.createDataFrame(
        [("A", "x", 70.0), ("B", "x", 72.0), ("C", "y", 71.0)], "macro_id string, category string, macro_effectiveness_index double"
    )
    got = pairs.band_pairs(df, True, 10.0).collect()
    assert [(r.macro_a, r.macro_b) for r in got] == [("A", "B")]


def test_similar_names_equal_brute_force(spark):
    from replyscope.operators.effectiveness_sql import similar_names

    rng = np.random.default_rng(5)
    words = ["refund", "fund", "re", "late", "reset", "set", "password", "pass"]
    rows = [
        (i, str(rng.choice(["a", "b"])), " ".join(rng.choice(words, rng.integers(1, 4))).title(), bool(rng.random() > 0.2))
        for i in range(60)
    ]
    want = [
        (i, j)
        for i, ci, ni, ai in rows
        for j, cj, nj, aj in rows
        if i < j and ci == cj and ai and aj
        and (nj.lower().split(" ")[0] in ni.lower() or ni.lower().split(" ")[0] in nj.lower())
    ]
    df = spark.createDataFrame(rows, "macro_id long, category string, macro_name string, is_active boolean")
    got = [(r.macro_1_id, r.macro_2_id) for r in similar_names(df).collect()]
    assert got == sorted(want)[:50]
    everything = [(r.macro_1_id, r.macro_2_id) for r in similar_names(df, 10_000).collect()]
    assert everything == sorted(want)


def test_hot_value_with_string_ties_is_dealt_out(spark):
    """A third of the rows on one value, ids as text: numbers are right and no part holds over five percent."""
    rows = [(f"id{i:05}", 50.0 if i % 3 == 0 else float(i % 997)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "id string, v double").repartition(8)
    got = [r.id for r in ranking.number_rows(df, "v", "id", "n").orderBy("n").collect()]
    assert got == [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    order = [F.col("v").desc(), F.col("id").asc()]
    parts = df.repartitionByRange(ranking.BUCKETS, *order).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) <= 0.05 * len(rows)
    numbered = ranking.dense_numbers(spark.createDataFrame([("b",), (None,), ("a",)], "s string"), [F.col("s").asc()], "k")
    assert {r.s: r.k for r in numbered.collect()} == {None: 1, "a": 2, "b": 3}
    assert ranking.dense_numbers(df.limit(0), order, "k").count() == 0
