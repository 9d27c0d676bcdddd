"""Co-training over all unlabelled rows: sums from the table against numpy, the same fit, and a pipeline stage that judges."""

import numpy as np
import pytest

import corpus_pipeline
from replyscope.llm import quality_classifier as qc

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def arrays(rows):
    table = rows.toArrow()
    return table.column("doc_id").to_numpy(), [qc._stacked(table.column(c).combine_chunks()) for c in "ab"], table


def test_levels(spark):
    rows = [(i, "t", "en" if i % 3 else "de", f"s{i % 5}", 1) for i in range(30)] + [(99, "t", None, "rare", 1)]
    found = qc.levels(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 8, 5)
    assert found.langs == {"en": 2, "de": 3} and sorted(found.sources) == ["s0", "s1", "s2", "s3", "s4"]
    views = [found.view(x, s, 3) for x, s in (("en", "s0"), ("de", "s0"), (None, "s0"), ("xx", "s0"), ("en", "rare"), ("en", None))]
    assert len({v.tobytes() for v in views}) == 6 and found.view("yy", "s0", 3).tobytes() == views[3].tobytes()


def test_table_sums_and_fit_equal_numpy(tables):
    """Every unlabelled row takes part, in any number of tasks; the fit is that of the same rows in memory."""
    docs, labels = tables
    labels = labels.where("doc_id % 4 <> 0")
    known = qc.levels(docs)
    ids, views, table = arrays(qc.with_views(qc.fit_rows(docs, labels), known))
    every_id, every, _ = arrays(qc.with_views(docs, known))
    pool = [v[~np.isin(every_id, ids)] for v in every]
    y = (table.column("quality").to_numpy() > 0).astype("f8")
    model = qc.co_train(views, y, qc.ArrayPool(pool), rounds=1)
    features = qc.with_views(docs.repartition(5), known).select("doc_id", "a", "b")
    got = qc.TablePool(features, ids).sums(model.views, model.views)
    want = qc.taught_sums(pool, model.views, model.views)
    for mine, theirs in zip(got, want):
        for a, b in zip(mine, theirs):
            assert a.shape == b.shape and np.abs(a - b).max() < 1e-4 and a[-1, 0] == b[-1, 0]
    assert sum(b[-1, 0] for part in want for b in part) > 100
    same = qc.co_train(views, y, qc.TablePool(features, ids), rounds=1)
    assert all(np.allclose(a.w, b.w, atol=1e-5) for a, b in zip(model.views, same.views))


def test_null_ids_and_empty_pool(spark, odd_docs, labels):
    ids, views, _ = arrays(qc.with_views(odd_docs, qc.levels(odd_docs)).where("doc_id is not null"))
    y = (np.arange(len(ids)) % 3 == 0).astype("f8")
    model = qc.co_train(views, y, [v[:0] for v in views])
    features = qc.with_views(odd_docs, qc.levels(odd_docs)).select("doc_id", "a", "b")
    none = qc.TablePool(features.limit(0), ids).sums(model.views, model.views)
    assert all(not part.any() for per_class in none for part in per_class)
    some = qc.TablePool(features, ids).sums(model.views, model.views)  # rows of a null id only
    assert sum(part[-1, 0] for per_class in some for part in per_class) <= 2 * odd_docs.where("doc_id is null").count()


def test_stage_judges_what_the_rules_left(spark, tables, tmp_path):
    """Bad documents that a weaker first stage leaves are removed; good ones stay."""
    docs, labels = tables
    steps = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in steps["quality_classifier"](spark, docs, DATA).select("doc_id").collect()}
    marks = {r.doc_id: r.quality for r in labels.collect()}
    good, bad = ([i for i, q in marks.items() if q == k] for k in (1, 0))
    assert len(bad) > 20 and np.mean([i in kept for i in bad]) < 0.1 and np.mean([i in kept for i in good]) > 0.98


def test_emptied_documents_are_not_packed(spark):
    rows = [(1, "a b c d e f g"), (2, " \n\t"), (3, ""), (4, "one two three four five six"), (5, None)]
    left = dict(corpus_pipeline.STAGES)["packing"](spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA)
    assert {r.doc_id for r in left.collect()} == {1, 4}
