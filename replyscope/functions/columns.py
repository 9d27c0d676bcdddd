"""Native Column helpers for scores, labels, dates and formatted values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c, places: int = 6) -> Column:
    """Half-up rounding by scaled floor: the same arithmetic in every SQL engine."""
    scale = float(10**places)
    return F.floor(col(c) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def steady(c, places: int = 6) -> Column:
    """Rounding for display: a border a little off the half keeps float noise from deciding exact ties."""
    scale = float(10**places)
    return F.floor(col(c) * F.lit(scale) + F.lit(0.500137)).cast("double") / F.lit(scale)


def scalar(aggregated: DataFrame) -> Column:
    """One-row aggregate as a struct-valued scalar subquery (no cross join)."""
    return aggregated.select(F.struct(*aggregated.columns)).scalar()


def with_scalar(df: DataFrame, aggregated: DataFrame, name: str = "_s") -> DataFrame:
    return df.withColumn(name, scalar(aggregated))


def rate(condition: Column) -> Column:
    """Share of rows where the condition holds; unknown counts as no."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def safe_divide(numerator, denominator, default: float = 0.0) -> Column:
    n, d = col(numerator).cast("double"), col(denominator).cast("double")
    return F.when(d.isNull() | F.isnan(d) | (d == 0), F.lit(default)).otherwise(F.try_divide(n, d))


def normalize_score(value, low, high, reverse: bool = False) -> Column:
    """Min-max position on 0..100, clipped; 50 for an unknown value (null or NaN) or an empty range."""
    v, lo, hi = col(value), col(low), col(high)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(v - lo, hi - lo)))
    if reverse:
        share = F.lit(1.0) - share
    unknown = v.isNull() | F.isnan(v.cast("double")) | lo.isNull() | F.isnan(lo.cast("double"))
    return F.when(unknown | (lo == hi), F.lit(50.0)).otherwise(share * 100.0)


def percentile_label(percentile) -> Column:
    p = col(percentile)
    return (
        F.when(p >= 90, "Top 10%")
        .when(p >= 75, "Top 25%")
        .when(p >= 50, "Above Average")
        .when(p >= 25, "Below Average")
        .otherwise("Bottom 25%")
    )


def effectiveness_level(index) -> Column:
    """Low 0..33, Medium to 66, High to 100; null outside."""
    i = col(index)
    return (
        F.when((i >= 0) & (i <= 33), "Low")
        .when((i > 33) & (i <= 66), "Medium")
        .when((i > 66) & (i <= 100), "High")
    )


def format_percentage(value, decimals: int = 1) -> Column:
    v = col(value)
    text = F.format_string(f"%.{decimals}f%%", fixed(v * 100.0, decimals))
    return F.when(v.isNull() | F.isnan(v), "N/A").otherwise(text)


def format_minutes(minutes) -> Column:
    m = col(minutes)
    hours = F.floor(m / 60.0)
    mins = F.floor(m - hours * 60.0)
    text = F.when(
        hours > 0, F.concat(hours.cast("string"), F.lit("h "), mins.cast("string"), F.lit("m"))
    ).otherwise(F.concat(mins.cast("string"), F.lit("m")))
    return F.when(m.isNull() | F.isnan(m), "N/A").otherwise(text)


def minutes_between(start, end) -> Column:
    """Elapsed minutes of two zone-free timestamps."""
    span = (col(end) - col(start)).cast("interval second")
    return span.cast("decimal(20,6)").cast("double") / 60.0


def day(ts) -> Column:
    return F.to_date(col(ts))


def week_label(ts) -> Column:
    """Monday/Sunday pair, ``yyyy-MM-dd/yyyy-MM-dd``."""
    monday = F.to_date(F.date_trunc("week", col(ts)))
    return F.concat(monday.cast("string"), F.lit("/"), F.date_add(monday, 6).cast("string"))


def clamped_bin(value, low, high, bins: int) -> Column:
    """1..bins of an equal-width histogram; the maximum belongs to the last bin."""
    share = F.try_divide(col(value) - col(low), col(high) - col(low)) * float(bins)
    return F.least(F.coalesce(F.floor(share), F.lit(0)) + 1, F.lit(bins)).cast("int")
