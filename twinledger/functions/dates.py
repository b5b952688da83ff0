"""Run dates, cutoffs, intervals and date windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The two text formats run parameters come in.
RUN_DATE_FORMAT = "yyyy/MM/dd"
END_OF_DAY_FORMAT = "yyyy/MM/dd HH:mm:ss"

# The time zone each region's day is cut in, by region id.
REGION_ZONES = (
    (1, "America/Los_Angeles"),
    (2, "Europe/Paris"),
    (3, "Asia/Tokyo"),
    (4, "Asia/Kolkata"),
    (5, "America/Sao_Paulo"),
)

WINDOW_DAYS = 10


def parse_run_date(text: Column) -> Column:
    return F.to_date(text, RUN_DATE_FORMAT)


def parse_end_of_day(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(END_OF_DAY_FORMAT))


def in_interval(ts: Column, start: Column, end: Column) -> Column:
    """Half-open: the start belongs to the interval, the end does not."""
    return (ts >= start) & (ts < end)


def day_bounds(start_date: str, end_date: str) -> tuple[Column, Column]:
    """Midnight UTC of both dates, given as ``yyyy-MM-dd``, without a zone."""
    return (
        F.lit(start_date).cast("date").cast("timestamp_ntz"),
        F.lit(end_date).cast("date").cast("timestamp_ntz"),
    )


def date_window(day: Column, days: int = WINDOW_DAYS) -> tuple[Column, Column]:
    return F.date_sub(day, days), F.date_add(day, days)


def region_zones(df: DataFrame) -> DataFrame:
    """The region dimension (five rows), in the session ``df`` belongs to."""
    return df.sparkSession.createDataFrame(
        list(REGION_ZONES), "region_id int, zone string"
    )


def region_cutoff(
    df: DataFrame, end_of_day: str, region: str = "region_id", zones: DataFrame | None = None
) -> DataFrame:
    """Add ``cutoff``: the end of day on each region's own clock, in UTC.

    ``zones`` has ``region_id`` and ``zone``, one row a region; without it the
    fixed zones serve. A row whose region is NULL or has no zone stays, with a
    NULL cutoff.
    """
    local = parse_end_of_day(F.lit(end_of_day))
    known = (region_zones(df) if zones is None else zones).select(
        F.col("region_id").alias(region),
        F.convert_timezone(F.col("zone"), F.lit("UTC"), local).alias("cutoff"),
    )
    return df.join(known, region, "left")
