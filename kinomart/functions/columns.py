"""Column expressions shared by the models."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(20,2)"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Elapsed whole days between two timestamps, cut towards zero.

    Differs from ``datediff``, which counts midnights. On timestamps without time zone
    the result does not depend on the session's zone.
    """
    return F.extract(F.lit("DAY"), col(end) - col(start)).cast("bigint")


def holds(condition: Column) -> Column:
    """A condition as a flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def spaced(first: Column | str, last: Column | str, gap: str = " ") -> Column:
    """Two texts joined by a gap; NULL if either is NULL."""
    return F.concat(col(first), F.lit(gap), col(last))


def capitalized(text: Column | str) -> Column:
    """First letter upper, all others lower, inner words included."""
    text = col(text)
    return F.concat(
        F.upper(F.substring(text, 1, 1)),
        F.lower(F.substring(text, F.lit(2), F.length(text))),
    )


def ntz(moment: datetime | date) -> Column:
    """A literal timestamp without time zone, comparable (and pushable) to such columns."""
    return F.lit(moment.isoformat(sep=" ") if isinstance(moment, datetime) else moment.isoformat()).cast(
        "timestamp_ntz"
    )


def money(value: Column | str) -> Column:
    return col(value).cast(MONEY)


def total(value: Column | str) -> Column:
    return F.sum(col(value)).cast(TOTAL)


def last_day(moment: Column | str) -> Column:
    return F.last_day(col(moment))


def decimal_literal(value: Decimal | int | str) -> Column:
    return F.lit(Decimal(value))
