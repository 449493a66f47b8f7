"""Statuses: a value exists if and only if its status is ``ok``; zero is a value, missing is not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OK = "ok"
#: The vocabularies of the atomic, the administrative and the normalised columns.
ATOMIC = [
    "ok", "source_unavailable", "source_not_acquired", "coverage_incomplete", "denominator_zero", "denominator_below_minimum",
    "not_found_within_cap", "search_truncated_by_extract", "entity_assembly_failed",
]
NORMALISED = [
    "cohort_too_small", "cohort_degenerate", "cohort_not_fitted", "peer_cohort_insufficient", "neighborhood_incomplete",
    "neighborhood_insufficient_valid", "neighborhood_reference_zero",
]
#: Share of a unit that a raster must cover, share that must be land, tolerance of unit intervals.
COVERAGE_FLOOR, LAND_FLOOR, TOLERANCE = 0.999, 0.01, 1e-9


def denominator_status(precondition: Column, covered: Column, denominator: Column, unit: Column, floor: float = LAND_FLOOR, failure: str = "coverage_incomplete") -> Column:
    """Why a ratio has no value: the later rungs win, as their inputs only make sense once the earlier hold."""
    return (
        F.when(~precondition, failure)
        .when(~covered, "coverage_incomplete")
        .when(denominator <= 0, "denominator_zero")
        .when(denominator / unit < floor, "denominator_below_minimum")
        .otherwise(OK)
    )


def distance_status(distance: Column, cap: Column, radius: Column) -> Column:
    """``ok`` for a distance within the cap and within the radius that is known completely; the cap is never a value."""
    found = distance.isNotNull() & (distance <= cap) & (distance <= radius)
    return F.when(found, OK).when(radius >= cap, "not_found_within_cap").otherwise("search_truncated_by_extract")


def where_ok(value: Column, status: Column) -> Column:
    return F.when(status == OK, value)


def unit_interval(value: Column, tolerance: float = TOLERANCE) -> Column:
    """Snap noise beside 0 and 1; anything further out stays, to be seen by the validator."""
    return F.when((value < 0) & (value >= -tolerance), 0.0).when((value > 1) & (value <= 1 + tolerance), 1.0).otherwise(value)


def consistent(value: Column, status: Column) -> Column:
    """True if the status is given and the value is there exactly when it is ``ok``."""
    return status.isNotNull() & (value.isNotNull() == (status == OK))
