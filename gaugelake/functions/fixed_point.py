"""Sums, means and percentages that do not depend on the order of the rows.

Adding doubles gives other last digits whenever tasks finish in another order, and a mean that
falls on a rounding tie then prints differently from run to run. Every value is therefore added as
a DECIMAL of nine decimals, up to 1e19, and rounded half away from zero: one sum and one count,
with the same arithmetic for all groups. A tenth decimal of a value is rounded, and a mean within
5e-10 of a tie counts as the tie. Under ANSI mode a value or sum out of range is an error, never a
wrong number. NaN is no value, in sums, counts and extremes alike.

Arguments are SQL expressions, mostly column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMALS = 9
_VALUE = f"DECIMAL(28, {DECIMALS})"  # its sum is a DECIMAL(38, 9)


def _quotient(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator of whole numbers, in steps of 10 ** -digits."""
    sign = f"CASE WHEN {numerator} < 0 THEN -1 ELSE 1 END"
    # by way of the remainder, as twice the numerator could leave the bigint range
    carry = f"CASE WHEN abs({numerator}) % {denominator} * 2 >= {denominator} THEN 1 ELSE 0 END"
    return (f"CASE WHEN {denominator} > 0 THEN"
            f" {sign} * (abs({numerator}) div {denominator} + {carry}) / {10 ** digits}D END")


def _present(value: str) -> str:
    """The value, null for NaN; whole numbers and decimals have none, and stay as they are."""
    return f"CASE WHEN NOT isnan({value}) THEN {value} END"


def _aggregates(value: str) -> dict[str, str]:
    return {"sum": f"sum(CAST({_present(value)} AS {_VALUE}))", "count": f"count({_present(value)})"}


def present(value: str) -> Column:
    """The value, null for NaN."""
    return F.expr(_present(value))


def lowest(value: str) -> Column:
    """Aggregate: the least value."""
    return F.expr(f"min({_present(value)})")


def highest(value: str) -> Column:
    """Aggregate: the greatest value; NaN, which Spark sorts above all others, does not count."""
    return F.expr(f"max({_present(value)})")


def _stored(name: str, merged: bool) -> dict[str, str]:
    columns = {part: f"{name}_{part}" for part in ("sum", "count")}
    return {part: f"sum({c})" for part, c in columns.items()} if merged else columns


def _mean(parts: dict[str, str], digits: int) -> Column:
    if not 0 <= digits <= DECIMALS:
        raise ValueError(f"digits must lie in 0..{DECIMALS}")
    return F.expr(f"CAST(round(try_divide({parts['sum']}, {parts['count']}), {digits}) AS DOUBLE)")


def _total(parts: dict[str, str], digits: int) -> Column:
    return F.expr(f"CAST(round({parts['sum']}, {digits}) AS DOUBLE)")


def mean(value: str, digits: int) -> Column:
    """Aggregate: rounded mean of the non-null values, null if there are none."""
    return _mean(_aggregates(value), digits)


def total(value: str, digits: int = DECIMALS) -> Column:
    """Aggregate: rounded sum of the non-null values, null if there are none."""
    return _total(_aggregates(value), digits)


def partial(value: str, name: str) -> list[Column]:
    """Aggregates: the parts of a mean or sum, for groups that are merged later."""
    return [F.expr(f"{sql} AS {name}_{part}") for part, sql in _aggregates(value).items()]


def partial_mean(name: str, digits: int, merged: bool = False) -> Column:
    """Mean from the parts called ``name`` of one group, or of several that are merged."""
    return _mean(_stored(name, merged), digits)


def partial_total(name: str, digits: int = DECIMALS, merged: bool = False) -> Column:
    """Sum from the parts called ``name``."""
    return _total(_stored(name, merged), digits)


def percent(part: str, whole: str, digits: int = 1) -> Column:
    """100 * part / whole of two counts."""
    return F.expr(_quotient(f"(({part}) * {100 * 10 ** digits})", f"({whole})", digits))
