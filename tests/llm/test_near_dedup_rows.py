"""Near-dedup of the pipeline removes rows, not ids."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from replyscope.llm import circulant_minhash


def _text(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def test_rows_not_ids(spark):
    copied, alone, lost, hot, nameless = (_text(x) for x in ("a", "b", "c", "h", "n"))
    rows = [(1, copied), (None, copied), (None, alone)]  # null id beside an id; a null-id text of its own
    rows += [(7, copied), (7, lost)]  # one id, two texts, one of them a duplicate
    rows += [(9, hot)] * 30 + [(None, nameless)] * 3  # exactly repeated rows, null-id copies only
    rows += [(3, None), (3, ""), (None, None)]  # without words: linked with nothing
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, copied), (None, alone), (7, lost), (9, hot), (None, nameless), (3, None), (3, ""), (None, None)]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_a_hot_id_with_many_texts_is_linear(spark):
    """A third of the rows share an id, some the null id, with different texts: each is compared by its own text."""
    rows = [(5 if i % 3 == 0 else None if i % 3 == 1 else i, " ".join(f"w{i // 2}x{j}" for j in range(12))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = circulant_minhash.features(docs, 4)
    wanted = found.selectExpr("uid as node", "digest", "doc_id as home", "mark")
    one_class = wanted.groupBy("digest").agg(F.min_by(F.struct("node", "home", "mark"), "node").alias("w")).select("digest", "w.*")
    assert circulant_minhash.candidate_sets(docs, one_class, 4).count() == 300
    got = circulant_minhash.near_duplicates(docs, width=4).collect()
    assert len(got) == 600 and {r.n_shingles for r in got} == {9}
