"""Column expressions on dates and times (naive UTC throughout)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast(NTZ)


def floor_day(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast(NTZ)


def floor_month(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast(NTZ)


def plus_hours(ts: Column, hours) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours) if isinstance(hours, int) else hours)


def plus_days(ts: Column, days) -> Column:
    return ts + F.make_dt_interval(F.lit(days) if isinstance(days, int) else days)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def season(ts: Column, null_season: str | None = "Spring") -> Column:
    """Southern-hemisphere season; an unknown month falls through to ``null_season``."""
    month = F.month(ts)
    return (
        F.when(month.isin(12, 1, 2), "Summer")
        .when(month.isin(3, 4, 5), "Autumn")
        .when(month.isin(6, 7, 8), "Winter")
        .when(month.isNotNull(), "Spring")
        .otherwise(F.lit(null_season))
    )


def hour_id(ts: Column) -> Column:
    """Integer key yyyymmddhh."""
    return (
        F.year(ts).cast("bigint") * 1000000 + F.month(ts) * 10000 + F.dayofmonth(ts) * 100 + F.hour(ts)
    )


def month_id(year: Column, month: Column) -> Column:
    """Monthly key in the same width: yyyymm followed by 0100."""
    return (year.cast("bigint") * 100 + month) * 10000 + 100


def pass_time(acq_date: Column, acq_time: Column) -> Column:
    """Date plus an HHMM text of up to four digits."""
    hhmm = F.lpad(acq_time.cast("string"), 4, "0")
    hours = F.substring(hhmm, 1, 2).cast("int")
    minutes = F.substring(hhmm, 3, 2).cast("int")
    return acq_date.cast(NTZ) + F.make_dt_interval(F.lit(0), hours, minutes)


def half_day(date: Column, daynight: Column) -> Column:
    """00:00 for daynight 0, 12:00 for daynight 1."""
    return date.cast(NTZ) + F.make_dt_interval(F.lit(0), (daynight * 12).cast("int"))


def incident_time(text: Column) -> Column:
    """ISO text with up to seven fractional digits and an offset; unreadable text gives NULL."""
    trimmed = F.regexp_replace(F.trim(text), r"(\.\d{6})\d+", "$1")
    return F.try_to_timestamp(trimmed)


# Centre month of each overlapping three-month season of the climate index.
ENSO_SEASONS = {
    "DJF": 1, "JFM": 2, "FMA": 3, "MAM": 4, "AMJ": 5, "MJJ": 6,
    "JJA": 7, "JAS": 8, "ASO": 9, "SON": 10, "OND": 11, "NDJ": 12,
}


def enso_month(season_code: Column) -> Column:
    pairs = [F.lit(v) for kv in ENSO_SEASONS.items() for v in kv]
    return F.create_map(*pairs)[season_code]


def enso_phase(anomaly: Column) -> Column:
    return F.when(anomaly >= 0.5, "El Nino").when(anomaly <= -0.5, "La Nina").otherwise("Neutral")


def relative_label(minutes: Column) -> Column:
    """'n min ago' below one hour, else 'n hr ago'; halves round up."""
    mins = F.floor(minutes + 0.5)
    return F.when(mins < 60, F.concat(mins.cast("string"), F.lit(" min ago"))).otherwise(
        F.concat(F.floor(mins / 60 + 0.5).cast("string"), F.lit(" hr ago"))
    )
