"""Two-sample t test, effect size and sample size as native Column expressions."""

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope.functions.columns import col


def pooled_variance(std_a, n_a, std_b, n_b) -> Column:
    sa, na, sb, nb = (col(c).cast("double") for c in (std_a, n_a, std_b, n_b))
    return F.try_divide((na - 1) * sa * sa + (nb - 1) * sb * sb, na + nb - 2)


def t_statistic(mean_a, std_a, n_a, mean_b, std_b, n_b) -> Column:
    na, nb = col(n_a).cast("double"), col(n_b).cast("double")
    spread = F.sqrt(pooled_variance(std_a, n_a, std_b, n_b) * (1.0 / na + 1.0 / nb))
    return F.try_divide(col(mean_a) - col(mean_b), spread)


def cohens_d(mean_a, std_a, n_a, mean_b, std_b, n_b) -> Column:
    spread = F.sqrt(pooled_variance(std_a, n_a, std_b, n_b))
    return F.when(spread > 0, F.try_divide(col(mean_a) - col(mean_b), spread)).otherwise(0.0)


def log_gamma(x: Column) -> Column:
    """Stirling series after shifting the argument above 8."""
    shift = 8
    z = x + float(shift)
    product = x
    for k in range(1, shift):
        product = product * (x + float(k))
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    tiny = F.lit(1e-300)

    def guard(v: Column) -> Column:
        return F.when(F.abs(v) < tiny, tiny).otherwise(v)

    d0 = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def advance(state: Column, term: Column) -> Column:
        return F.struct(
            guard(1.0 + term / state["c"]).alias("c"),
            (1.0 / guard(1.0 + term * state["d"])).alias("d"),
            (state["h"] * guard(1.0 + term / state["c"]) / guard(1.0 + term * state["d"])).alias("h"),
        )

    # Each element j = 2..2*steps+1 stands for one partial numerator, even and odd in turn.
    def step(state: Column, j: Column) -> Column:
        m = F.floor(j / 2.0).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        return advance(state, F.when(j % 2 == 0, even).otherwise(odd))

    series = F.sequence(F.lit(2), F.lit(2 * steps + 1))
    return F.aggregate(series, start, step, lambda s: s["h"])


LARGE_DF = 100_000.0


def _gamma_ratio(a: Column) -> Column:
    """log(gamma(a + 1/2) / gamma(a)): as a series for large a, where the two logarithms would cancel."""
    r = 1.0 / a
    series = 0.5 * F.log(a) + r * (-1 / 8 + r * r * (1 / 192 + r * r * (-1 / 640 + r * r * (17 / 14336))))
    return F.when(a > 30.0, series).otherwise(log_gamma(a + 0.5) - log_gamma(a))


def normal_p(z) -> Column:
    """Two-sided p value of a standard normal: by the series of the incomplete gamma function, or its fraction far out."""
    z = F.least(F.abs(col(z)), F.lit(1e150))
    x = z * z / 2.0
    front = F.exp(0.5 * F.log(x) - x - 0.5 * math.log(math.pi))
    near = F.least(x, F.lit(4.0))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)), F.struct(F.lit(2.0).alias("term"), F.lit(2.0).alias("sum")),
        lambda s, k: F.struct(
            (s["term"] * near / (k + 0.5)).alias("term"), (s["sum"] + s["term"] * near / (k + 0.5)).alias("sum")
        ),
        lambda s: s["sum"],
    )
    far = F.greatest(x, F.lit(4.0))
    # from the innermost term outwards: x + 1/2 - (k (k - 1/2)) / (x + 2 k + 1/2 - ...)
    fraction = F.aggregate(
        F.sequence(F.lit(60), F.lit(1), F.lit(-1)), F.lit(0.0),
        lambda s, k: k * (k - 0.5) / (far + 2.0 * k + 0.5 - s), lambda s: 1.0 / (far + 0.5 - s),
    )
    p = F.when(x < 4.0, 1.0 - front * series).otherwise(front * fraction)
    return F.when(x == 0, 1.0).otherwise(F.greatest(p, F.lit(0.0)))


def t_test_p(t, df, steps: int = 100) -> Column:
    """Two-sided p value: regularised incomplete beta at df / (df + t^2).

    What is left to 1 there, t^2 / (df + t^2), is computed directly, so that a t near 0 keeps its digits. From 100,000 degrees
    of freedom on the fraction would converge too slowly; t is turned into the normal deviate of the same p
    by a series whose error falls with the square of df.
    """
    t, df = col(t).cast("double"), col(df).cast("double")
    a, b = df / 2.0, F.lit(0.5)
    square = F.least(t * t, F.lit(1e300))
    x, rest = df / (df + square), square / (df + square)
    front = F.exp(_gamma_ratio(a) - 0.5 * math.log(math.pi) + a * F.log1p(-F.least(rest, F.lit(1.0 - 1e-16))) + 0.5 * F.log(rest))
    # The fraction converges fast only on one side of the mode; use the symmetry otherwise.
    near = x < (a + 1.0) / (a + b + 2.0)
    p = F.when(near, front * _beta_fraction(a, b, x, steps) / a).otherwise(
        1.0 - front * _beta_fraction(b, a, rest, steps) / b
    )
    squared = df * F.log1p(square / df)
    z = F.sqrt(squared) * (1.0 - (1.0 / (4.0 * df)) + (squared + 3.0) / (48.0 * df * df) * 0.5)
    p = F.when(df >= LARGE_DF, normal_p(z)).otherwise(p)
    return F.when(t.isNull() | df.isNull() | (df <= 0), None).when(square == 0, 1.0).otherwise(p)


def sample_size(
    baseline_rate, minimum_detectable_effect, alpha: float = 0.05, power: float = 0.80
) -> Column:
    """Rows needed per arm of a two-proportion test, from a relative effect."""
    z_alpha = NormalDist().inv_cdf(1 - alpha / 2)
    z_beta = NormalDist().inv_cdf(power)
    p1 = col(baseline_rate).cast("double")
    p2 = p1 * (1.0 + col(minimum_detectable_effect).cast("double"))
    p_bar = (p1 + p2) / 2.0
    spread = p1 * (1.0 - p1) + p2 * (1.0 - p2)
    root = z_alpha * F.sqrt(2.0 * p_bar * (1.0 - p_bar)) + z_beta * F.sqrt(spread)
    return F.ceil(F.try_divide(root * root, (p1 - p2) * (p1 - p2)))
