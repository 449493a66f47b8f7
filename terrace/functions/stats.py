"""Aggregates and ranks that the built-ins lack or define otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def adjusted_skewness(value: Column) -> Column:
    """Adjusted Fisher-Pearson skewness: null below three values, 0 without spread."""
    n = F.count(value).cast("double")
    plain = F.when(F.stddev_pop(value) > 0, F.skewness(value)).otherwise(0.0)
    return F.when(n >= 3, plain * F.sqrt(n * (n - 1)) / (n - 2))


def average_rank(value: str, by: list[str]) -> Column:
    """Rank within ``by`` where ties share the mean of their ranks."""
    return F.rank().over(Window.partitionBy(*by).orderBy(value)) + (F.count(F.lit(1)).over(Window.partitionBy(*by, value)) - 1) / 2.0


def spearman(rows: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """``by, rho, n``: correlation of average ranks over rows where both values are there."""
    ranked = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, average_rank(a, by).alias("ra"), average_rank(b, by).alias("rb"))
    return ranked.groupBy(*by).agg(F.corr("ra", "rb").alias("rho"), F.count(F.lit(1)).alias("n"))


def relative_difference(a: Column, b: Column, least: float) -> Column:
    """Absolute difference over the larger value; null where both are below ``least``."""
    most = F.greatest(a, b)
    return F.when(most >= least, F.abs(a - b) / most)


def quantiles(value: str, prefix: str = "") -> list[Column]:
    """Count, minimum, 5 %, median, mean, 95 %, maximum, coefficient of variation; null on an empty group but for the count."""
    v = F.col(value)
    named = [F.count(v).alias(f"{prefix}n"), F.min(v).alias(f"{prefix}min"), F.avg(v).alias(f"{prefix}mean"), F.max(v).alias(f"{prefix}max")]
    named += [F.percentile(v, p).alias(f"{prefix}{n}") for n, p in (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))]
    return [*named, F.try_divide(F.stddev_samp(v), F.avg(v)).alias(f"{prefix}cv")]


def entropy_bits(share: Column) -> Column:
    """Shannon entropy of shares that add up to one in a group."""
    return -F.sum(F.when(share > 0, share * F.log2(share)).otherwise(0.0))
