"""A wide group, linked at cosines of 0.90 to 0.95 with nearly no member near the centre, against all pairs."""

import numpy as np

from replyscope.llm import embedding_forest


def test_wide_group_of_thousands(spark):
    rng = np.random.default_rng(3)
    noise = lambda n: rng.standard_normal((n, 64)) / 8
    centre = embedding_forest.unit(rng.standard_normal(64))
    wide, far = centre + noise(4000) * 0.33, rng.standard_normal((1500, 64))
    tight = centre + 0.3 * embedding_forest.unit(noise(1)) + noise(300) * 0.03  # a dense class beside it
    x = np.vstack([wide, far, far[:200] + rng.standard_normal((200, 64)) * 0.2, tight]).astype("f4")
    x = np.vstack([x, x[:50]])  # copies of members
    unit = embedding_forest.unit(x)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_forest.near_duplicate_vectors(df).collect()}
    links = np.array([got[i].n_links for i in range(len(x))])
    print("links found", links.sum(), "of", want.sum(), "group", links[:4000].sum(), want[:4000].sum())
    assert (links <= want).all() and (links[:4000] == want[:4000]).all()
    assert links.sum() >= 0.99 * want.sum()
    assert len({got[i].component_id for i in range(4000) if want[i]}) == 1


def test_double_vectors_keep_their_range(spark):
    """Entries that no float can hold link as their directions do."""
    from replyscope.llm import embedding_forest

    rows = [(1, [1e300, 0.0]), (2, [3e300, 1e299]), (3, [1e-60, 0.0]), (4, [0.0, 5e-320]), (5, [0.0, 2.0]), (6, [0.0, 0.0])]
    got = embedding_forest.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}
