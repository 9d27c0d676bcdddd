import math

import pytest
from result_rows import rows
from pyspark.sql import functions as F

from replyscope.functions import columns as C
from replyscope.functions import stats
from replyscope.functions import text as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "v, low, high, reverse, want",
    [(5, 0, 10, False, 50), (10, 0, 10, False, 100), (0, 0, 10, True, 100), (7, 3, 3, False, 50),
     (None, 0, 10, False, 50), (99, 0, 10, False, 100), (-1, 0, 10, False, 0)],
)
def test_normalize_score(spark, v, low, high, reverse, want):
    lit = F.lit(v).cast("double")
    assert value(spark, C.normalize_score(lit, F.lit(float(low)), F.lit(float(high)), reverse)) == want


@pytest.mark.parametrize("n, d, default, want", [(10, 2, 0.0, 5), (10, 0, 0.0, 0), (10, 0, 1.0, 1), (10, None, 0.0, 0)])
def test_safe_divide(spark, n, d, default, want):
    assert value(spark, C.safe_divide(F.lit(n), F.lit(d).cast("double"), default)) == want


def test_formats(spark):
    assert value(spark, C.format_percentage(F.lit(0.234))) == "23.4%"
    assert value(spark, C.format_percentage(F.lit(0.5), 0)) == "50%"
    assert value(spark, C.format_percentage(F.lit(None).cast("double"))) == "N/A"
    assert value(spark, C.format_minutes(F.lit(83.0))) == "1h 23m"
    assert value(spark, C.format_minutes(F.lit(45.9))) == "45m"
    assert value(spark, C.format_minutes(F.lit(None).cast("double"))) == "N/A"


def test_labels(spark):
    got = [value(spark, C.percentile_label(F.lit(p))) for p in (95, 90, 80, 60, 30, 3)]
    assert got == ["Top 10%", "Top 10%", "Top 25%", "Above Average", "Below Average", "Bottom 25%"]
    levels = [value(spark, C.effectiveness_level(F.lit(i))) for i in (0.0, 33.0, 33.1, 66.0, 100.0, 101.0)]
    assert levels == ["Low", "Low", "Medium", "Medium", "High", None]


def test_week_and_minutes(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-03 10:00:00' a, timestamp_ntz'2024-01-04 10:00:30' b")
    assert rows(df, C.week_label("a"), C.minutes_between("a", "b")) == [("2024-01-01/2024-01-07", 1440.5)]


@pytest.mark.parametrize(
    "text, want",
    [("  Hello   World  ", "hello world"), (None, ""), ("See http://x.y/z now", "see now"),
     ("www.a.b\tc", "c"), ("　A  B\x1c", "a b")],
)
def test_clean_text(spark, text, want):
    assert value(spark, X.clean_text(F.lit(text).cast("string"))) == want


def test_remove_boilerplate(spark):
    assert value(spark, X.remove_boilerplate(F.lit("Dear Customer, hi. Thanks,"))) == "hi."
    assert value(spark, X.remove_boilerplate(F.lit("Dear Customer 12"), [r"\d+"])) == "dear customer"


@pytest.mark.parametrize("text", ["3rd we've o'neil", "ALL caps / mixed Case", "straße ßa x2y", "", "élan vital"])
def test_title_case_equals_python(spark, text):
    assert value(spark, X.title_case(F.lit(text))) == text.title()


def test_terms(spark):
    terms = X.ngram_terms(X.tokens(F.lit("the refund is a late refund x"), ["the", "is"]))
    assert value(spark, terms) == ["refund", "late", "refund", "refund late", "late refund"]
    assert value(spark, X.ngram_terms(X.tokens(F.lit("")))) == []
    assert value(spark, X.ngram_terms(X.tokens(F.lit("one")))) == ["one"]


@pytest.mark.parametrize("df, t", [(1, 12.7062047), (10, 2.2281389), (58, 2.0017175), (1_000_000, 1.9599664)])
def test_t_test_p_at_table_points(spark, df, t):
    assert value(spark, stats.t_test_p(F.lit(t), F.lit(df))) == pytest.approx(0.05, abs=1e-7)


def test_t_test_p_small_statistic(spark):
    # One degree of freedom: the Cauchy distribution.
    for t in (0.0, 0.1, 1.0, 3.0):
        assert value(spark, stats.t_test_p(F.lit(t), F.lit(1))) == pytest.approx(1 - 2 * math.atan(t) / math.pi, abs=1e-9)


def test_sample_size(spark):
    n = value(spark, stats.sample_size(F.lit(0.5), F.lit(0.1)))
    assert 1500 < n < 1600
    assert value(spark, stats.sample_size(F.lit(0.5), F.lit(0.2))) < n


def test_strip_takes_the_spaces_of_the_pattern_and_no_search(spark):
    """The ends are cut as the pattern has it, without looking for it at every space of the text."""
    odd = [" \t a  b \u3000\x85", "\u2003x\u200b ", "", "   ", "\x1c\x1fy\n\n", None, "\u00a0z\u180e", "a\u2028b\u2029"]
    odd += [chr(k) + "m" + chr(k) for k in (*range(1, 256), *range(0x1670, 0x1690), *range(0x1FF0, 0x2070), *range(0x2FF0, 0x3010), 0xFEFF)]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    want = F.regexp_replace("x", f"^{X.SPACE}+|{X.SPACE}+$", "")
    stripped = df.select("x", X.strip("x").alias("got"), want.alias("want"))
    assert stripped.where("not got <=> want").count() == 0
    assert "regexp" not in stripped.select("got")._jdf.queryExecution().optimizedPlan().toString()
