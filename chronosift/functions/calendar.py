"""Calendar features of timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def marks(ts: Column, minutes: bool = False) -> dict[str, Column]:
    """Whole-number marks: month, day, weekday (Monday 0), hour, and quarter of the hour if asked."""
    out = {"month": F.month(ts), "day": F.dayofmonth(ts), "weekday": F.weekday(ts), "hour": F.hour(ts)}
    if minutes:
        out["minute"] = F.floor(F.minute(ts) / 15).cast("int")
    return out


#: How each feature is moved to [-0.5, 0.5].
_ENCODED = {
    "second_of_minute": (F.second, 0, 59.0),
    "minute_of_hour": (F.minute, 0, 59.0),
    "hour_of_day": (F.hour, 0, 23.0),
    "day_of_week": (F.weekday, 0, 6.0),
    "day_of_month": (F.dayofmonth, 1, 30.0),
    "day_of_year": (F.dayofyear, 1, 365.0),
    "month_of_year": (F.month, 1, 11.0),
    "week_of_year": (F.weekofyear, 1, 52.0),
}

#: The features of each frequency.
FREQUENCIES = {
    "y": [],
    "q": ["month_of_year"],
    "m": ["month_of_year"],
    "w": ["day_of_month", "week_of_year"],
    "d": ["day_of_week", "day_of_month", "day_of_year"],
    "b": ["day_of_week", "day_of_month", "day_of_year"],
    "h": ["hour_of_day", "day_of_week", "day_of_month", "day_of_year"],
    "t": ["minute_of_hour", "hour_of_day", "day_of_week", "day_of_month", "day_of_year"],
    "s": ["second_of_minute", "minute_of_hour", "hour_of_day", "day_of_week", "day_of_month", "day_of_year"],
}


def encoded(ts: Column, freq: str = "h") -> dict[str, Column]:
    """Features in [-0.5, 0.5] for a frequency such as ``h`` or ``15min``."""
    unit = freq.lower().lstrip("0123456789")
    unit = {"min": "t", "a": "y"}.get(unit, unit)
    if unit not in FREQUENCIES:
        raise RuntimeError(f"unsupported frequency {freq!r}, one of {', '.join(FREQUENCIES)}")
    return {name: _encode(ts, name) for name in FREQUENCIES[unit]}


def _encode(ts: Column, name: str) -> Column:
    part, base, span = _ENCODED[name]
    return (part(ts) - base) / F.lit(span) - 0.5


def scaled(ts: Column, weekday: float = 7.0, hour: float = 24.0, month: float = 12.0) -> dict[str, Column]:
    """Weekday, hour and month over a scale each."""
    return {"weekday": F.weekday(ts) / F.lit(weekday), "hour": F.hour(ts) / F.lit(hour), "month": F.month(ts) / F.lit(month)}


def from_hour_index(hour: Column) -> dict[str, Column]:
    """Calendar of a series that counts hours from 0: hour of day, weekday, month of twelve 30-day months."""
    day = F.floor(hour / 24)
    return {"hour": F.pmod(hour, F.lit(24)) / 24.0, "weekday": F.pmod(day, F.lit(7)) / 7.0, "month": F.pmod(F.floor(day / 30), F.lit(12)) / 12.0}


def future(last: Column, n: int, step: str = "INTERVAL 1 HOUR") -> Column:
    """The n timestamps after ``last``."""
    return F.sequence(last + F.expr(step), last + F.expr(step) * n, F.expr(step))


#: The pattern letters of both notations.
_STRPTIME = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "f": "SSSSSS", "y": "yy", "b": "MMM", "B": "MMMM", "j": "DDD", "p": "a", "I": "hh", "z": "xx", "T": "HH:mm:ss", "F": "yyyy-MM-dd", "%": "%"}


def pattern(fmt: str) -> str:
    """A time pattern for Spark from one with % signs; one without is taken as it is."""
    if "%" not in fmt:
        return fmt
    out, at, text = [], 0, ""
    while at < len(fmt):
        if fmt[at] == "%" and at + 1 < len(fmt):
            if fmt[at + 1] not in _STRPTIME:
                raise ValueError(f"unknown directive %{fmt[at + 1]} in {fmt!r}")
            out += ([f"'{text}'"] if text else []) + [_STRPTIME[fmt[at + 1]]]
            text, at = "", at + 2
        else:
            if fmt[at].isalpha():
                text += fmt[at]
            else:
                out += ([f"'{text}'"] if text else []) + ["''" if fmt[at] == "'" else fmt[at]]
                text = ""
            at += 1
    return "".join(out + ([f"'{text}'"] if text else []))


def parse_ts(cell: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch ms of a cell: numbers above 1e12 are ms, other numbers seconds, all else a time in UTC."""
    number = cell.try_cast("double")
    local = F.try_to_timestamp(cell, F.lit(pattern(fmt))).cast("timestamp_ntz")
    return F.when(number > 1e12, number).when(number.isNotNull(), number * 1000).otherwise(F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), local)).cast("long")
