"""The rows of a fit are bounded in rows, also where one id repeats over a third of the table."""

from replyscope.llm import quality_classifier, quality_rules


def test_one_row_an_id(spark):
    rows = [(7, f"hot text {i % 5}", "en", "s", i) for i in range(200)] + [(i, f"text {i}", "en", "s", i) for i in range(100, 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    labels = spark.createDataFrame([(7, 1), *((i, i % 2) for i in range(100, 110))], "doc_id long, quality int")
    some = quality_rules.labelled_sample(docs, labels, 11).collect()
    assert sorted(r.doc_id for r in some) == [7, *range(100, 110)]
    assert quality_rules.labelled_sample(docs.repartition(3), labels, 11).where("doc_id = 7").first() in some
    found = quality_classifier.fit_rows(docs, labels, 11, 401).collect()
    assert len(found) == 401 and len({r.doc_id for r in found}) == 401
    assert {r.doc_id for r in found if r.quality >= 0} == {7, *range(100, 110)}
    other = quality_classifier.fit_rows(docs.repartition(3), labels, 11, 401).where("doc_id = 7").first()
    assert other in found


def test_the_threshold_of_the_rules_counts_every_labelled_row(spark, monkeypatch):
    """Odd good rows beyond any bounded sample move the threshold: exact quantiles of the scores of all labelled rows."""
    import numpy as np

    monkeypatch.setattr(quality_rules, "TREES", 4)
    monkeypatch.setattr(quality_rules, "TREE_ROWS", 16)  # 64 rows are drawn for the trees
    prose = " ".join(f"word{k}" for k in range(30))
    texts = [f"{prose} {'# $ ' * (i % 40)}" if i % 5 == 0 else prose for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    forest, limit = quality_rules.fit(quality_rules.counted_rows(docs), labels)
    scores = forest.score(np.array([quality_rules.rule_counts(t)[1] for t in texts]))
    failed = [quality_rules.base_failed(c[0], c[4]) for c, _ in map(quality_rules.rule_counts, texts)]
    good, bad = ([scores[i] for i in range(400) if not failed[i] and (i % 3 > 0) == kind] for kind in (True, False))
    want = np.quantile(good, quality_rules.KEEP_GOOD) + 1e-9
    beyond = [x for x in bad if x > want]
    assert forest.size <= 64 and abs(limit - ((want + np.quantile(beyond, 0.02)) / 2 if beyond else want)) < 1e-9
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert kept == {i: bool(not failed[i] and x <= limit) for i, x in enumerate(scores)}
