"""Contracts of feature tables, checked in one pass; summaries by feature and area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.stats import adjusted_skewness
from terrace.functions.status import ATOMIC, NORMALISED, OK

#: Parts of column names that an output must not have.
FORBIDDEN = ["customer", "trip", "pickup", "dropoff", "od_flow", "_score", "national_percentile", "segment"]


def violations(features: dict[str, str], low: dict[str, float], high: dict[str, float], vocabulary: list[str] | None = None) -> dict[str, Column]:
    """What each check counts, by name. ``features``: value column to status column; ``low`` and ``high``: ranges."""
    known = vocabulary or ATOMIC
    out: dict[str, Column] = {}
    for value, status in features.items():
        v, s = F.col(value), F.col(status)
        out[f"{value}:status_unknown"] = F.coalesce(~s.isin(known), F.lit(True))
        out[f"{value}:bare_null"] = v.isNull() & (s == OK)
        out[f"{value}:value_despite_failure"] = v.isNotNull() & (s != OK)
        out[f"{value}:not_finite"] = F.coalesce(F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")), F.lit(False))
        if value in low:
            out[f"{value}:below_range"] = F.coalesce(v < low[value], F.lit(False))
        if value in high:
            out[f"{value}:above_range"] = F.coalesce(v > high[value], F.lit(False))
    return out


def report(table: DataFrame, checks: dict[str, Column], key: list[str]) -> DataFrame:
    """``check, violations`` for every check and for repeated keys: one aggregation over the table, and one over its keys."""
    counted = table.agg(*[F.count_if(c).alias(n) for n, c in checks.items()]).unpivot([], list(checks), "check", "violations")
    repeated = table.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("violations")).select(F.lit("key:repeated").alias("check"), "violations")
    return counted.unionByName(repeated)


def forbidden_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if any(part in c.lower() for part in FORBIDDEN)]


def contextual_checks(rows: DataFrame, atomic: DataFrame, key: str, pairs: dict[str, str], statuses: dict[str, str]) -> DataFrame:
    """Keys on one side only, values made up for failed inputs, statuses that weren't carried over. ``pairs``: derived to atomic value; ``statuses`` likewise."""
    side = atomic.select(F.col(key).alias("__key"), *[F.col(c).alias(f"a_{c}") for c in {*pairs.values(), *statuses.values()}])
    both = rows.join(side, F.col(key) == F.col("__key"), "full")
    checks = {"key:missing": F.col(key).isNull(), "key:unknown": F.col("__key").isNull()}
    for derived, source in pairs.items():
        checks[f"{derived}:imputed"] = F.col(derived).isNotNull() & F.col(f"a_{source}").isNull()
    known = [*ATOMIC, *NORMALISED]
    for derived, source in statuses.items():
        failed = F.col(f"a_{source}") != OK
        checks[f"{derived}:not_verbatim"] = F.coalesce(failed & (F.col(derived) != F.col(f"a_{source}")), F.lit(False))
        checks[f"{derived}:unknown"] = F.col("__key").isNotNull() & F.coalesce(~F.col(derived).isin(known), F.lit(True))
    return both.agg(*[F.count_if(c).alias(n) for n, c in checks.items()]).unpivot([], list(checks), "check", "violations")


def long_format(table: DataFrame, keys: list[str], features: dict[str, str]) -> DataFrame:
    """``keys, feature, value, status``: a row for each feature of each unit."""
    packed = F.array(*[F.struct(F.lit(v).alias("feature"), F.col(v).cast("double").alias("value"), F.col(s).alias("status")) for v, s in features.items()])
    return table.select(*keys, F.inline(packed))


def null_and_zero_rates(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows, nulls, zeros and their shares."""
    n = F.count(F.lit(1))
    null, zero = F.count_if(F.col("value").isNull()), F.count_if(F.col("value") == 0)
    return rows.groupBy(*by).agg(n.alias("n"), null.alias("nulls"), zero.alias("zeros"), (null / n).alias("null_rate"), (zero / n).alias("zero_rate"))


def status_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n"))


def area_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """Null share and quantiles of the values that are there."""
    marks = [F.percentile("value", p).alias(n) for n, p in (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))]
    return rows.groupBy(*by).agg(F.avg(F.col("value").isNull().cast("double")).alias("null_rate"), F.avg((F.col("value") == 0).cast("double")).alias("zero_rate"), *marks)


def distributions(rows: DataFrame, area: str) -> DataFrame:
    """By feature, for each area and (area null, ``pooled`` 1) over all: shares, values, skewness before and after log1p; one rollup."""
    shown = F.col("value")
    rolled = rows.groupingSets([[F.col("feature"), F.col(area)], [F.col("feature")]], F.col("feature"), F.col(area))
    return rolled.agg(
        F.grouping(area).cast("int").alias("pooled"), F.avg(shown.isNull().cast("double")).alias("null_rate"), F.avg((shown == 0).cast("double")).alias("zero_share"),
        F.countDistinct(shown).alias("n_values"), F.min(shown).alias("min"), F.percentile(shown, 0.5).alias("p50"), F.percentile(shown, 0.95).alias("p95"), F.max(shown).alias("max"),
        adjusted_skewness(shown).alias("skew"), adjusted_skewness(F.when(shown >= 0, F.log1p(shown))).alias("skew_log1p"),
    )


def selection_bias(rows: DataFrame, by: list[str], radius: str) -> DataFrame:
    """Of a distance: counts of statuses, share that is known, median and largest value, median complete radius, values beyond it."""
    ok = F.col("status") == OK
    return rows.groupBy(*by).agg(
        F.count_if(ok).alias("n_ok"), F.count_if(F.col("status") == "not_found_within_cap").alias("n_not_found"), F.count_if(F.col("status") == "search_truncated_by_extract").alias("n_truncated"),
        F.avg(ok.cast("double")).alias("ok_share"), F.percentile("value", 0.5).alias("p50"), F.max("value").alias("max"), F.percentile(radius, 0.5).alias("radius_p50"), F.count_if(F.col("value") > F.col(radius)).alias("beyond_radius"),
    )


def disposition(rows: DataFrame) -> DataFrame:
    """Per feature whether it is published: all null is dropped, no spread is a constant, much missing is partial."""
    n = F.count(F.lit(1))
    share = F.count("value") / n
    state = F.when(F.count("value") == 0, "all_null").when(F.min("value") == F.max("value"), "constant").when(share < 0.5, "partial").otherwise("published")
    return rows.groupBy("feature").agg(state.alias("disposition"), share.alias("ok_share"))
