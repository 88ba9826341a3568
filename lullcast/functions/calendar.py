"""Date parts, cyclic encodings and Fourier terms of a date column."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Encoding periods and the domain of each categorical date part.
CYCLE_PERIODS = {"dow": 7, "week": 52, "month": 12, "quarter": 4}
CALENDAR_CATEGORIES = {
    "dow": range(0, 7),
    "week": range(1, 54),
    "month": range(1, 13),
    "quarter": range(1, 5),
}
WEEKLY_PERIOD = 7.0
YEARLY_PERIOD = 365.25


def date_parts(d: Column) -> dict[str, Column]:
    """Weekday (Monday 0), ISO week, month, quarter and calendar year."""
    return {
        "dow": F.weekday(d),
        "week": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
    }


def cyclic_parts(d: Column) -> dict[str, Column]:
    """Sine and cosine of each date part over its period."""
    parts = date_parts(d)
    out = {}
    for name, period in CYCLE_PERIODS.items():
        angle = F.lit(2 * math.pi) * parts[name] / F.lit(float(period))
        out[f"{name}_sin"], out[f"{name}_cos"] = F.sin(angle), F.cos(angle)
    return out


def month_edges(d: Column) -> dict[str, Column]:
    return {
        "is_month_start": (F.dayofmonth(d) == 1).cast("int"),
        "is_month_end": (d == F.last_day(d)).cast("int"),
    }


def date_flags(d: Column) -> dict[str, Column]:
    return {**month_edges(d), "is_weekend": F.weekday(d).isin(5, 6).cast("int")}


def calendar_parts(d: Column) -> dict[str, Column]:
    """Every calendar feature of the main feature frame."""
    return {**date_parts(d), **cyclic_parts(d), **date_flags(d)}


def report_calendar_parts(d: Column) -> dict[str, Column]:
    """The smaller calendar of the data report, which adds the day of month."""
    parts = date_parts(d)
    return {
        "dow": parts["dow"],
        "dom": F.dayofmonth(d),
        "month": parts["month"],
        "week": parts["week"],
        **month_edges(d),
    }


def fourier_terms(
    d: Column, origin: datetime.date | Column, weekly_k: int = 3, yearly_k: int = 10
) -> dict[str, Column]:
    """Weekly and yearly harmonics of the whole days since ``origin``."""
    start = origin if isinstance(origin, Column) else F.lit(origin)
    t = F.datediff(d, start).cast("double")
    out = {}
    for prefix, period, terms in (("fw", WEEKLY_PERIOD, weekly_k), ("fy", YEARLY_PERIOD, yearly_k)):
        for k in range(1, terms + 1):
            angle = F.lit(2 * math.pi * k) * t / F.lit(period)
            out[f"{prefix}_sin_{k}"], out[f"{prefix}_cos_{k}"] = F.sin(angle), F.cos(angle)
    return out
