"""Operators whose plan must hold for odd shapes: long names, hot macros, tiny t values and large samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.functions import stats
from replyscope.operators import effectiveness_sql, features

NAMES = "macro_id long, category string, macro_name string, is_active boolean"


def test_long_names_have_few_pieces(spark):
    """A name of 10,000 letters is listed under three pieces a letter at most, and its word is found in a longer name."""
    long = "".join(chr(97 + i * i % 26) for i in range(10_000))
    rows = [(1, "a", f"{long} x", True), (2, "a", f"see {long}y", True), (3, "a", "other", True), (4, "b", long, True)]
    rows += [(5, "a", " leading blank", True), (6, "c", None, True), (7, None, "other", True), (8, "c", " ", True), (9, "c", "", True)]
    df = spark.createDataFrame(rows, NAMES)
    got = [(r.macro_1_id, r.macro_2_id) for r in effectiveness_sql.similar_names(df).collect()]
    want = []
    for i, ci, ni, _ in rows:
        for j, cj, nj, _ in rows:
            if i < j and ci and ci == cj and ni is not None and nj is not None:
                a, b = ni.lower(), nj.lower()
                if b.split(" ")[0] in a or a.split(" ")[0] in b:
                    want.append((i, j))
    assert got == want == [(1, 2), (1, 5), (2, 5), (3, 5), (8, 9)]
    pieces = df.select(F.size(effectiveness_sql._grams(F.col("macro_name"))).alias("n")).where("n is not null").agg(F.max("n")).first()[0]
    assert pieces <= 3 * 10_005


def test_words_are_found_by_their_rarest_piece(spark):
    rng = np.random.default_rng(1)
    letters = list("abc")
    names = [(str(rng.choice(["x", "y"])), f"k{i}", "".join(rng.choice(letters + [" "], rng.integers(0, 12)))) for i in range(150)]
    words = sorted({(str(rng.choice(["x", "y"])), "".join(rng.choice(letters, rng.integers(1, 6)))) for _ in range(80)})
    got = effectiveness_sql.held_words(
        spark.createDataFrame(names, "category string, name_key string, low string"), spark.createDataFrame(words, "category string, word string")
    ).collect()
    want = {(c, k, w) for c, k, low in names for cw, w in words if c == cw and w in low}
    assert {(r.category, r.name_key, r.word) for r in got} == want and len(got) == len(want)


def test_features_of_a_hot_macro(spark):
    """One counted table gives the same means, medians and distinct counts as the single uses."""
    rng = np.random.default_rng(2)
    n = 900
    tickets = [(i, f"A{i % 7}" if i % 11 else None, f"d{i % 4}", int(rng.integers(1, 6)) if i % 9 else None,
                float(rng.integers(1, 40)) if i % 13 else None, int(i % 5 == 0) if i % 17 else None) for i in range(n)]
    uses = [(i, "M1" if i % 3 == 0 else f"M{i % 10}", i % 3) for i in range(n + 20)]
    t = spark.createDataFrame(tickets, "ticket_id long, agent_id string, contact_driver string, csat_score int, total_handle_time_minutes double, reopens_count int")
    u = spark.createDataFrame(uses, "ticket_id long, macro_id string, position_in_thread int")
    m = spark.createDataFrame([(f"M{k}",) for k in range(12)], "macro_id string")
    by_ticket = {row[0]: row for row in tickets}
    for r in features.macro_features(u, t, m).collect():
        mine = [by_ticket.get(i, (i, None, None, None, None, None)) for i, k, _ in uses if k == r.macro_id]
        def known(c):
            return [x[c] for x in mine if x[c] is not None]
        assert r.usage_count == len(mine)
        assert r.avg_csat == pytest.approx(np.mean(known(3)) if mine else 0) and r.avg_handle_time == pytest.approx(np.mean(known(4)) if mine else 0)
        assert r.median_csat == (np.median(known(3)) if mine else 0) and r.median_handle_time == (np.median(known(4)) if mine else 0)
        assert r.reopen_rate == pytest.approx(np.mean([bool(x[5]) for x in mine]) if mine else 0)
        assert (r.unique_agents, r.unique_drivers) == (len(set(known(1))), len(set(known(2))))


def test_p_values_at_table_points(spark):
    """Two-sided table points, t near 0, and up to 10**12 degrees of freedom."""
    points = [
        (1e-9, 10.0, 0.9999999992217833), (1e-200, 10.0, 1.0), (0.0, 4.0, 1.0), (-1e-9, 1e12, 0.9999999992021155),
        (12.706204736, 1.0, 0.05), (2.228138852, 10.0, 0.05), (2.001717483, 58.0, 0.05), (1.959966357, 1e6, 0.05),
        (1.959963985, 1e12, 0.05), (3.290526731, 1e12, 0.001), (0.6744897502, 1e12, 0.5),
    ]
    df = spark.createDataFrame(points, "t double, df double, p double")
    for r in df.select("*", stats.t_test_p("t", "df").alias("got")).collect():
        assert r.got == pytest.approx(r.p, abs=2e-9)
    none = spark.createDataFrame([(None, 3.0), (1.0, None), (1.0, 0.0)], "t double, df double")
    assert all(r.p is None for r in none.select(stats.t_test_p("t", "df").alias("p")).collect())
    both = spark.createDataFrame([(t, d) for t in (0.3, 1.0, 2.5, 4.0) for d in (99_999.0, 100_001.0)], "t double, df double")
    got = [r.p for r in both.select(stats.t_test_p("t", "df").alias("p")).collect()]
    assert all(a == pytest.approx(b, rel=1e-4) and a != b for a, b in zip(got[::2], got[1::2]))
