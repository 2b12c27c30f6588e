"""Column expressions shared by the models."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from revloom.vocab import LIFECYCLE_STAGES, STAGE_LOST, STAGE_WON

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(part: Column | str, whole: Column | str) -> Column:
    """DOUBLE quotient, NULL when the divisor is zero (ANSI division would raise)."""
    return col(part).cast("double") / F.nullif(col(whole).cast("double"), F.lit(0.0))


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit ``value`` to [low, high].  ``value`` must not be NULL: least/greatest skip NULLs."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def month_of(moment: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(col(moment), "month")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (may be negative)."""
    return F.datediff(col(end), col(start))


def is_in_state(stage: Column | str, *states: str) -> Column:
    return col(stage).isin(*states)


def is_closed_stage(stage: Column | str) -> Column:
    """NULL for a NULL stage, so neither the closed nor the open flag is true for it."""
    return is_in_state(stage, STAGE_WON, STAGE_LOST)


def stage_ordinal(stage: Column | str) -> Column:
    """Position of a funnel stage, 1-based; NULL for a stage outside the funnel."""
    ordinal = F.array_position(F.array(*[F.lit(s) for s in LIFECYCLE_STAGES]), col(stage))
    return F.nullif(ordinal.cast("int"), F.lit(0))


def stage_at(ordinal: Column | str) -> Column:
    """Inverse of :func:`stage_ordinal`; NULL outside the funnel."""
    names = F.array(*[F.lit(s) for s in LIFECYCLE_STAGES])
    return F.when(col(ordinal).isNotNull(), F.get(names, col(ordinal) - 1))


def monthly(amount: Column | str) -> Column:
    """A twelfth of an annual amount, in whole cents, half up.

    DECIMAL all the way: the quotient keeps six digits, and whole cents over 12 can only
    tie at exactly half a cent, so the second rounding cannot flip a digit.
    """
    return F.round(col(amount) / F.lit(Decimal(12)), 2).cast(MONEY)


def over_term(amount: Column | str, months: Column | str) -> Column:
    """An annual amount over a term of ``months`` months, in whole cents."""
    years = col(months).cast("decimal(10,0)") / F.lit(Decimal(12))
    return F.round(col(amount) * years, 2).cast(MONEY)


def health_score(
    active_arr: Column,
    win_ratio: Column,
    open_value: Column,
    last_activity: Column,
    has_churn: Column,
    as_of: Column,
) -> Column:
    """Whole number 0..100.  All inputs but ``last_activity`` must be free of NULLs.

    Points: 40 for live revenue, up to 20 for the unrounded win ratio, 20 for open deals,
    20 (10) for activity within 90 (180) days, minus 20 for any churn.
    """
    today = F.to_date(as_of)
    recency = (
        F.when(last_activity >= F.date_sub(today, 90), 20)
        .when(last_activity >= F.date_sub(today, 180), 10)
        .otherwise(0)
    )
    points = (
        F.when(active_arr > 0, 40).otherwise(0)
        + win_ratio * 20
        + F.when(open_value > 0, 20).otherwise(0)
        + recency
        - F.when(has_churn, 20).otherwise(0)
    )
    return F.round(clamp(points, 0.0, 100.0)).cast("int")
