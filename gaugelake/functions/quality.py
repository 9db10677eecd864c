"""Row-level quality checks as plain column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugelake.schema import MAPPED_COLUMNS, RAIN_TRACE, THRESHOLDS


def any_missing(columns: list[str] = MAPPED_COLUMNS) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def without_trace(rain: Column) -> Column:
    """Trace rain (-1) counts as 0."""
    return F.when(rain == RAIN_TRACE, F.lit(0.0)).otherwise(rain)


def out_of_range(column: str, sentinel_first: bool = False) -> Column:
    """Strictly outside the plausible range; a null is never an outlier."""
    low, high = THRESHOLDS[column]
    value = F.col(column)
    if column == "rainfall_mm" and sentinel_first:
        value = without_trace(value)
    return F.coalesce((value < F.lit(float(low))) | (value > F.lit(float(high))), F.lit(False))


def any_outlier(sentinel_first: bool = False) -> Column:
    return reduce(lambda a, b: a | b, [out_of_range(c, sentinel_first) for c in THRESHOLDS])


def flag_text(sentinel_first: bool = False) -> Column:
    """``"<column>_outlier;"`` per outlier, in threshold order; empty if there is none."""
    return F.concat(*[
        F.when(out_of_range(c, sentinel_first), F.lit(f"{c}_outlier;")).otherwise(F.lit(""))
        for c in THRESHOLDS
    ])


def flag_array(sentinel_first: bool = False) -> Column:
    """The outlier columns as an array."""
    return F.array_compact(F.array(*[
        F.when(out_of_range(c, sentinel_first), F.lit(c)) for c in THRESHOLDS
    ]))


def score(sentinel_first: bool = False, missing_columns: list[str] = MAPPED_COLUMNS) -> Column:
    """1.0, less 0.2 if a value is missing and 0.3 per outlier, at least 0; in whole tenths."""
    outliers = reduce(lambda a, b: a + b,
                      [out_of_range(c, sentinel_first).cast("int") for c in THRESHOLDS])
    tenths = F.lit(10) - any_missing(missing_columns).cast("int") * 2 - outliers * 3
    return F.greatest(tenths, F.lit(0)).cast("double") / F.lit(10.0)
