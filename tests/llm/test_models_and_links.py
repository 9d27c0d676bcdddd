"""Quality rules, classifier, near-duplicates and the pipeline against brute force and held-out labels."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest

from replyscope.llm import circulant_minhash, common, embedding_forest, quality_classifier, quality_rules

DATA = "/root/testdata/sf0.01"


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 3), (5, None)]
    want = Union()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            want.join(a, b)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: want.find(x) for x in want.up}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_rules(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            again |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again)


def test_rule_counts(spark, odd_docs):
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + [r.text for r in odd_docs.collect()]
    for t in texts:
        assert tuple(quality_rules.rule_counts(t)[0]) == brute_rules(t)


def test_rules_hold_out(spark):
    """Fitted on three of four labelled rows, judged on the rest."""
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = quality_rules.judge(docs, labels.where("doc_id % 4 <> 0")).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)


def test_rules_edges(spark, odd_docs, no_docs, labels):
    judged = quality_rules.judge(odd_docs, labels).collect()
    assert len(judged) == odd_docs.count() and not any(r.kept for r in judged if r.n_words < 20)
    none = quality_rules.judge(odd_docs, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in none)
    kept = quality_rules.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in judged)
    assert quality_rules.judge(no_docs, labels).count() == 0 and quality_rules.keep_good(no_docs, labels).count() == 0


def test_classifier_hold_out(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = quality_classifier.classify(docs, labels.where("doc_id % 4 <> 0")).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    assert np.mean([r.quality_kept == (r.quality == 1) for r in rows]) >= 0.95
    assert np.mean([r.quality_kept for r in rows if r.quality == 1]) >= 0.98


def test_co_training_uses_both_views():
    """A view that starts with few labels learns from the rows the other one is sure of."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 4000).astype("f8")
    a = y[:, None] * 4 + rng.standard_normal((4000, 2))
    b = y[:, None] * 3 + rng.standard_normal((4000, 3))
    few = np.arange(40)
    model = quality_classifier.co_train([a[few], b[few]], y[few], [a[40:2000], b[40:2000]])
    assert (((model.score(a[2000:], b[2000:]) > 0.5) == (y[2000:] > 0)).mean()) > 0.98
    assert quality_classifier.co_train([a[few], b[few]], np.ones(40), [a[40:60], b[40:60]]) is None


def test_classifier_edges(spark, odd_docs, no_docs, labels):
    got = quality_classifier.classify(odd_docs, labels)
    assert got.columns == [*odd_docs.columns, "quality_score", "quality_kept"] and len(got.collect()) == odd_docs.count()
    assert all(r.quality_kept for r in quality_classifier.classify(odd_docs, labels.limit(0)).collect())
    assert quality_classifier.classify(odd_docs.select("doc_id", "text"), labels).count() == odd_docs.count()
    assert quality_classifier.classify(no_docs, labels).count() == 0


def brute_near(rows, width, percent):
    """rows: (doc_id, text); component and size by row number."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    union = Union()
    for i in range(len(rows)):
        union.find(i)
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small and 100 * small >= percent * large:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    union.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = union.find(i)
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return Counter((d, len(sets[i]), least[union.find(i)], d == least[union.find(i)]) for i, (d, _) in enumerate(rows))


def planted():
    """A large group of near copies of one text, edited by different amounts, copies of some, and chains."""
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 3000)}" for _ in range(160)]
    rows = []
    for k in range(150):
        w = list(words)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        rows.append(" ".join(w))
    chain = [f"c{i}" for i in range(120)]
    for k in range(30):
        chain = chain[:]
        chain[(k * 4) % 120] = f"d{k}"
        rows.append(" ".join(chain))
    rows += rows[:20] + ["A B c D", "a b C d", "a b c", "a b c", "a", None, "", "  "]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates(spark, width):
    rows = planted()
    got = circulant_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width)
    assert Counter(tuple(r) for r in got.collect()) == brute_near(rows, width, 80)


def test_block_comparison_alone_is_whole(spark):
    rows = planted()
    got = circulant_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, pivot_rounds=0)
    assert Counter(tuple(r) for r in got.collect()) == brute_near(rows, 4, 80)


def test_near_duplicates_of_documents_and_edges(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (docs, odd_docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert Counter(tuple(r) for r in circulant_minhash.near_duplicates(df, 4).collect()) == brute_near(rows, 4, 80)
    assert circulant_minhash.near_duplicates(no_docs, 4).count() == 0


def brute_vectors(rows, cosine=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    union, links = Union(), [0] * len(rows)
    x = [np.asarray(v, dtype="f4").astype("f8") / np.linalg.norm(np.asarray(v, dtype="f4").astype("f8")) if o else None for (_, v), o in zip(rows, ok)]
    for i in range(len(rows)):
        union.find(i)
        for j in range(i):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= cosine:
                union.join(i, j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (name, _) in enumerate(rows):
        r = union.find(i)
        least[r] = min((y for y in (least.get(r), name) if y is not None), default=None)
    return {i: (name, links[i], least[union.find(i)]) for i, (name, _) in enumerate(rows)}


def test_vectors(spark):
    """Loose pairs, a dense group, wide groups, copies and bad vectors; recall of links against all pairs."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((1500, 32))
    pairs = base[:300] + rng.standard_normal((300, 32)) * 0.3
    dense = base[0] + rng.standard_normal((500, 32)) * 0.05
    wide = base[1] + rng.standard_normal((300, 32)) * 0.33
    made = [v.astype("f4").tolist() for v in np.vstack([base, pairs, dense, wide])]
    made += [made[5]] * 40 + [(2 * np.array(made[7])).tolist()] * 3
    made += [None, [], [0.0] * 32, [float("nan")] * 32, [None] + [1.0] * 31, [1.0, 2.0], [1.0, 2.1]]
    rows = list(enumerate(made))
    want = brute_vectors(rows)
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, kept string")
    got = {r.vec_id: r for r in embedding_forest.near_duplicate_vectors(df).collect()}
    assert len(got) == len(rows)
    found, there = sum(r.n_links for r in got.values()), sum(w[1] for w in want.values())
    assert found >= 0.98 * there
    assert all(got[i].n_links <= want[i][1] for i in got)
    assert np.mean([got[i].component_id == want[i][2] for i in got]) > 0.98
    assert all(got[i].n_links == 0 and got[i].kept for i in range(len(rows) - 7, len(rows) - 2))
    assert got[len(rows) - 1].component_id == len(rows) - 2


def test_vector_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_forest.near_duplicate_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [0.0, 1.0]), (None, [1.0, 0.0]), (1, None)]
    got = Counter(tuple(r) for r in embedding_forest.near_duplicate_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == Counter({(3, 2, 3, True): 2, (3, 0, 3, True): 1, (None, 2, 3, False): 1, (1, 0, 1, True): 1})


def test_pipeline(spark, tmp_path):
    """Every stage keeps columns, its decisions take effect, and the last one packs what is left."""
    data = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert [*steps] == ["quality_rules", "quality_classifier", "line_dedup", "near_dedup", "packing"]
    one = steps["quality_rules"](spark, docs, data)
    kept = {r.doc_id for r in quality_rules.judge(docs, labels).where("kept").collect()}
    assert {r.doc_id for r in one.collect()} == kept and one.columns == docs.columns
    two = steps["quality_classifier"](spark, one, data)
    three = steps["line_dedup"](spark, two, data)
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} and three.columns == docs.columns
    four = steps["near_dedup"](spark, three, data)
    rows = [(r.doc_id, r.text) for r in three.collect()]
    assert {r.doc_id for r in four.collect()} == {d for d, _, _, keep in brute_near(rows, 5, 80) if keep}
    five = steps["packing"](spark, four, data)
    assert five.agg({"length": "sum"}).first()[0] > 0
    assert corpus_pipeline.run(spark, data).count() == five.count()
