"""Normalisation: transforms that keep statuses, percentiles that are fitted first and applied from the table, local ratios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.status import OK, consistent

#: Least rows of a cohort that is fitted, and the ways to rank ties.
MIN_COHORT, METHODS = 30, ("midrank", "min", "max")


@dataclass(frozen=True)
class NeighbourhoodPolicy:
    """Rings around a unit, neighbours that must have a value, and the statistic over them."""

    k: int = 1
    least_valid: int = 4
    statistic: str = "median"

    def __post_init__(self) -> None:
        if self.k < 1 or self.least_valid < 1 or self.statistic not in ("median", "mean"):
            raise ValueError(f"not a neighbourhood policy: {self}")


def guard(value: Column, status: Column, name: str) -> Column:
    """The value; an error where value and status contradict each other."""
    return F.when(consistent(value, status), value).otherwise(F.raise_error(F.lit(f"{name}: value and status contradict each other")).cast("double"))


def log1p(value: Column, status: Column, name: str) -> Column:
    """ln(1 + x) where ``ok``; negative values are an error, and so is a status that contradicts its value."""
    wrong = F.raise_error(F.lit(f"{name}: value and status contradict each other")).cast("double")
    negative = F.raise_error(F.lit(f"{name}: negative value")).cast("double")
    return F.when(~consistent(value, status), wrong).when(value < 0, negative).when(status == OK, F.log1p(value))


def fit_ecdf(rows: DataFrame, cohort: list[str], value: str = "value", status: str = "status", weight: Column | None = None, least: int = MIN_COHORT) -> DataFrame:
    """The fitted table: ``cohort, value, w_equal, w_below, w_total, n_obs, fit_status``.

    A cohort of too few rows, or of one value, has a single row without a value. Weights add up by value before the
    window runs, so it sorts different values only.
    """
    kept = rows.where((F.col(status) == OK) & F.col(value).isNotNull()).withColumn("__w", F.lit(1.0) if weight is None else weight)
    by_value = kept.groupBy(*cohort, F.col(value).alias("value")).agg(F.sum("__w").alias("w_equal"), F.count(F.lit(1)).alias("n"))
    all_of, ordered = Window.partitionBy(*cohort), Window.partitionBy(*cohort).orderBy("value")
    summed = by_value.withColumns({
        "w_below": F.coalesce(F.sum("w_equal").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "w_total": F.sum("w_equal").over(all_of),
        "n_obs": F.sum("n").over(all_of),
        "__first": F.row_number().over(ordered),
        "__values": F.count(F.lit(1)).over(all_of),
    })
    state = F.when(F.col("n_obs") < least, "cohort_too_small").when(F.col("__values") < 2, "cohort_degenerate").otherwise("fitted")
    table = summed.withColumn("fit_status", state).where((F.col("fit_status") == "fitted") | (F.col("__first") == 1))
    fitted = F.col("fit_status") == "fitted"
    return table.select(*cohort, *[F.when(fitted, F.col(c)).alias(c) for c in ("value", "w_equal", "w_below", "w_total")], "n_obs", "fit_status")


def fit_summary(table: DataFrame, cohort: list[str]) -> DataFrame:
    """One row for each cohort of a fitted table: its status, rows, different values and total weight."""
    return table.groupBy(*cohort).agg(F.max("fit_status").alias("fit_status"), F.max("n_obs").alias("n_obs"), F.count("value").alias("n_distinct"), F.max("w_total").alias("weight_total"))


def percentile_of(below: Column, equal: Column, total: Column, method: str) -> Column:
    """Share of the cohort below a value: ties with half, none or all of their weight."""
    part = {"midrank": equal / 2, "min": F.lit(0.0), "max": equal}[method]
    return (below + part) / total


def apply_ecdf(rows: DataFrame, table: DataFrame, cohort: list[str], value: str = "value", status: str = "status", methods: tuple[str, ...] = METHODS) -> DataFrame:
    """Percentiles of values from a fitted table, seen or unseen, with their statuses (``pct_status``).

    Values and the table's steps go through one window in order of value: the last step at or below a value carries the weight
    below it, so no range join is planned. Rows that have no value keep their status.
    """
    keys = [F.col(c) for c in cohort]
    steps = table.where("fit_status = 'fitted'").select(*keys, F.col("value").alias("__v"), F.lit(0).alias("__row"), "w_equal", "w_below", "w_total")
    asked = rows.where(F.col(status) == OK).withColumns({"__v": F.col(value), "__row": F.lit(1)})
    both = steps.unionByName(asked, allowMissingColumns=True)
    upto = Window.partitionBy(*cohort).orderBy("__v", "__row").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(upto)
    total = F.max("w_total").over(Window.partitionBy(*cohort))
    met = both.withColumns({"__lv": last(F.when(F.col("__row") == 0, F.col("__v"))), "__le": last("w_equal"), "__lb": last("w_below"), "__lt": total}).where("__row = 1")
    seen = F.col("__lv") == F.col("__v")
    below = F.when(seen, F.col("__lb")).otherwise(F.coalesce(F.col("__lb") + F.col("__le"), F.lit(0.0)))
    equal = F.when(seen, F.col("__le")).otherwise(0.0)
    states = table.groupBy(*cohort).agg(F.min("fit_status").alias("__fit"))
    done = met.join(states, cohort, "left")
    state = F.when(F.col("__fit").isNull(), "cohort_not_fitted").when(F.col("__fit") != "fitted", F.col("__fit")).otherwise(OK)
    values = [F.when(state == OK, percentile_of(below, equal, F.col("__lt"), m)).alias(f"pct_{m}") for m in methods]
    out = done.select(*rows.columns, *values, state.alias("pct_status"))
    missing = rows.where(F.col(status) != OK).select(*rows.columns, *[F.lit(None).cast("double").alias(f"pct_{m}") for m in methods], F.col(status).alias("pct_status"))
    return out.unionByName(missing)


def equal_weights(group: str, status: str = "status") -> Column:
    """Weights that let every group count alike: one over its number of rows with a value."""
    return 1.0 / F.count(F.when(F.col(status) == OK, 1)).over(Window.partitionBy(group))


def local_ratio(units: DataFrame, pairs: DataFrame, expected: Column, policy: NeighbourhoodPolicy, ident: str = "unit_id", value: str = "value", status: str = "status") -> DataFrame:
    """``unit, ratio, ratio_status``: a unit's value over its neighbours' statistic, the unit itself left out.

    ``pairs``: unit and neighbour; ``expected``: how many neighbours a complete ring has.
    """
    other = units.select(F.col(ident).alias("neighbour"), F.col(value).alias("__nv"), F.col(status).alias("__ns"))
    ok = F.when(F.col("__ns") == OK, F.col("__nv"))
    centre = F.percentile(ok, 0.5) if policy.statistic == "median" else F.avg(ok)
    ring = pairs.join(other, "neighbour").groupBy(ident).agg(F.count(F.lit(1)).alias("__n"), F.count(ok).alias("__valid"), centre.alias("__ref"))
    joined = units.join(ring, ident, "left")
    state = (
        F.when(F.col(status) != OK, F.col(status))
        .when(F.coalesce("__n", F.lit(0)) < expected, "neighborhood_incomplete")
        .when(F.col("__valid") < policy.least_valid, "neighborhood_insufficient_valid")
        .when(F.col("__ref") <= 0, "neighborhood_reference_zero")
        .otherwise(OK)
    )
    return joined.select(ident, F.when(state == OK, F.try_divide(F.col(value), F.col("__ref"))).alias("ratio"), state.alias("ratio_status"))


def peers_are_sufficient(rows: DataFrame, context: str, area: str, least: int) -> DataFrame:
    """``context, areas, sufficient`` by context."""
    return rows.groupBy(context).agg(F.countDistinct(area).alias("areas")).withColumn("sufficient", F.col("areas") >= least)
