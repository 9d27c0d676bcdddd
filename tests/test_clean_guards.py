"""Cleaning searches a text only for what it may hold, and gives what searching every text gives."""

import itertools

from pyspark.sql import functions as F

from replyscope.functions import text as X

PIECES = [
    " ", "  ", "\n", "\t ", " \n", " ", "   ", "\x1c", "a", "Word", "HTTP://x.y/z", "http", "www", "WWW.q", "wwwhttp",
    "Dear Customer,", "dear  customer", "DEAR customer", "Thanks,", "thankthanks,s", "best regards", "Sincerely", "ſincerely", "K", "İ",
]


def test_same_as_searching_every_text(spark):
    rows = [("".join(p),) for n in (1, 2, 3) for p in itertools.product(PIECES, repeat=n)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t string").repartition(8)
    lowered = F.lower(F.coalesce("t", F.lit("")))
    clean = X.strip(F.regexp_replace(F.regexp_replace(lowered, X.URL, ""), f"{X.SPACE}+", " "))

    def without(c, patterns):
        out = F.lower(c)
        for p in patterns:
            out = F.regexp_replace(out, f"(?i){p}", "")
        return X.strip(out)

    own = ["Word", "x?y", "thanks,?", r"a\b"]
    pairs = [
        (X.clean_text("t"), clean), (X.remove_boilerplate("t"), without(F.col("t"), X.BOILERPLATE)),
        (X.remove_boilerplate(X.clean_text("t")), without(clean, X.BOILERPLATE)), (X.remove_boilerplate("t", own), without(F.col("t"), own)),
        (X.remove_boilerplate("t", []), without(F.col("t"), [])),
    ]
    differing = [F.count_if(~a.eqNullSafe(b)).alias(f"d{k}") for k, (a, b) in enumerate(pairs)]
    assert tuple(df.agg(F.count(F.lit(1)).alias("n"), *differing).first()) == (len(rows), 0, 0, 0, 0, 0)


def test_blanks_between_words_are_left_alone(spark):
    """Nothing is replaced in a text whose words are one blank apart."""
    found = F.regexp_count(F.lit("some words " * 50 + "end"), F.lit(X.WIDE_SPACE))
    assert spark.range(1).select(found).first()[0] == 0
