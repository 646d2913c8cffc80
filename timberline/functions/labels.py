"""Small scalar expressions shared by searches and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timberline.fixed_values import ALL_LEVELS, GRANULARITIES, LEVELS, UNKNOWN_EVENT


def event_or_unknown(event_id: Column) -> Column:
    return F.coalesce(F.nullif(event_id, F.lit("")), F.lit(UNKNOWN_EVENT))


def template_or_message() -> Column:
    return F.coalesce("event_template", "normalized_message")


def bucket(timestamp: Column, granularity: str) -> Column:
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {', '.join(GRANULARITIES)}")
    # Built from the zone-free date: date_trunc would pass through the session time zone.
    day = timestamp.cast("date").cast("timestamp_ntz")
    if granularity == "day":
        return day
    return day + F.make_dt_interval(hours=F.hour(timestamp))


def rounded(value: Column, decimals: int) -> Column:
    """The nearest number of so many decimals, judged by the exact value of the double.

    Means of rounded scores often lie on a decimal half that no double can hold exactly. Whether the
    double is above or below it decides, as in Python; Spark's own functions round its shortest
    text instead. ``rest`` is what the scaling lost, found by splitting the value in two halves
    whose products are exact.
    """
    scale = F.lit(10.0**decimals)
    scaled = value * scale
    wide = value * F.lit(134217729.0)  # 2^27 + 1
    high = wide - (wide - value)
    rest = (high * scale - scaled) + (value - high) * scale
    below = F.floor(scaled).cast("double")
    part = scaled - below
    odd = F.pmod(below, F.lit(2.0)) == 1
    up = (part > 0.5) | ((part == 0.5) & ((rest > 0) | ((rest == 0) & odd)))
    return F.when(up, below + 1).otherwise(below) / scale


def score(value: Column) -> Column:
    return rounded(value, 4)


def percentage(part: Column, whole: Column) -> Column:
    share = F.when(whole > 0, part / whole * 100)
    return rounded(F.coalesce(share, F.lit(0.0)), 1)


def iso_time(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")


def run_timings(details: Column) -> Column:
    """Step timings out of the JSON details of a run; an empty map when they are absent."""
    parsed = F.from_json(details, "timings map<string, double>")
    return F.coalesce(parsed["timings"], F.create_map().cast("map<string,double>"))


def wanted_level(level: str | None) -> str | None:
    """The level to filter on, or None for no filter; rejects names outside the domain."""
    if level is None or level in ("", ALL_LEVELS):
        return None
    if level not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)} or {ALL_LEVELS}")
    return level
