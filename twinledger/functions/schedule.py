"""Schedule classes of job definitions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Run times a day and the class they stand for.
TIMES_TO_CLASS = ((24, "hourly"), (12, "2h"), (6, "4h"), (3, "8h"))

# The placeholder written for each class.
CLASS_TOKENS = {
    "daily": "$[ScheduledDaily]",
    "hourly": "$[ScheduledHourly]",
    "2h": "$[Scheduled2Hourly]",
    "4h": "$[Scheduled4Hourly]",
    "8h": "$[Scheduled8Hourly]",
    "not scheduled": "$[NotScheduled]",
}

DAYS_A_WEEK = 7
UNCHANGED = "unchanged"


def schedule_class(kind: Column, times: Column, days: Column) -> Column:
    """Class of a schedule from its type text and its two arrays.

    DAILY on all seven days is ``daily``; INTRADAY is classed by its number of
    times. Another number of days or times is ``unchanged``, an INTRADAY
    without times or any other type is ``not scheduled``.
    """
    by_times = None
    for count, name in TIMES_TO_CLASS:
        hit = F.size(times) == count
        by_times = F.when(hit, name) if by_times is None else by_times.when(hit, name)
    by_days = F.when(F.size(days) == DAYS_A_WEEK, "daily").otherwise(UNCHANGED)
    return (
        F.when(kind.contains("DAILY"), by_days)
        .when(kind.contains("INTRADAY") & times.isNotNull(), by_times.otherwise(UNCHANGED))
        .otherwise("not scheduled")
    )


def schedule_token(name: Column) -> Column:
    """The placeholder of a class; NULL for ``unchanged``."""
    result = None
    for key, token in CLASS_TOKENS.items():
        result = F.when(name == key, token) if result is None else result.when(name == key, token)
    return result
