"""Dates and timestamps as ISO text.

All arithmetic is on zone-less timestamps, so results are the same under every
session time zone. Accepted: ISO dates and timestamps with an optional offset,
``September 3, 2026``, ``3 Sep 2026``, ``9/3/2026`` and ``9-3-2026``; numeric
forms are month-first, and day-first only where month-first is impossible.
Anything else is ''.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.staging import literal_map
from recordmill.functions.text import MONTHS, norm_ws

_ISO = (
    r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
    r"(?:[Tt ]([0-9]{2}:[0-9]{2})(?::([0-9]{2})(?:\.[0-9]+)?)? ?(?:[Zz]|([+-])([0-9]{2}):?([0-9]{2})?)?)?$"
)
_NAME_FIRST = r"^([A-Za-z]+)\.? ([0-9]{1,2}),? ([0-9]{4})$"
_DAY_FIRST = r"^([0-9]{1,2}) ([A-Za-z]+)\.?,? ([0-9]{4})$"
_NUMERIC = r"^([0-9]{1,2})([/-])([0-9]{1,2})\2([0-9]{4})$"


_MONTH_NUMBERS = {
    **{name.lower(): str(number) for number, name in enumerate(MONTHS, start=1)},
    **{name[:3].lower(): str(number) for number, name in enumerate(MONTHS, start=1)},
    "sept": "9",
}


def _at_midnight(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("timestamp_ntz")


def _iso_utc(s: Column) -> Column:
    part = lambda n: F.regexp_extract(s, _ISO, n)
    clock = F.when(part(2) == "", F.lit("00:00")).otherwise(part(2))
    second = F.when(part(3) == "", F.lit("00")).otherwise(part(3))
    local = F.concat(part(1), F.lit(" "), clock, F.lit(":"), second).try_cast("timestamp_ntz")
    minutes = F.coalesce(part(5).try_cast("int"), F.lit(0)) * 60 + F.coalesce(part(6).try_cast("int"), F.lit(0))
    offset = F.when(part(4) == "-", -minutes).otherwise(minutes)
    return local - F.make_dt_interval(F.lit(0), F.lit(0), offset, F.lit(0))


def _named(s: Column, pattern: str, month: int, day: int) -> Column:
    number = F.try_element_at(literal_map(_MONTH_NUMBERS), F.lower(F.regexp_extract(s, pattern, month)))
    return _at_midnight(F.regexp_extract(s, pattern, 3), number, F.regexp_extract(s, pattern, day))


def _numeric(s: Column, month: int, day: int) -> Column:
    part = lambda n: F.regexp_extract(s, _NUMERIC, n)
    return _at_midnight(part(4), part(month), part(day))


def utc_time(c: Column) -> Column:
    """The instant in UTC as a zone-less timestamp, null where not understood."""
    s = norm_ws(c)
    return (
        F.when(F.rlike(s, F.lit(_ISO)), _iso_utc(s))
        .when(F.rlike(s, F.lit(_NAME_FIRST)), _named(s, _NAME_FIRST, 1, 2))
        .when(F.rlike(s, F.lit(_DAY_FIRST)), _named(s, _DAY_FIRST, 2, 1))
        .when(F.rlike(s, F.lit(_NUMERIC)), F.coalesce(_numeric(s, 1, 3), _numeric(s, 3, 1)))
    )


def date_iso(c: Column) -> Column:
    return F.coalesce(utc_time(c).cast("date").cast("string"), F.lit(""))


def timestamp_iso(c: Column) -> Column:
    printed = utc_time(c).cast("string")
    stamp = F.concat(F.substring(printed, 1, 10), F.lit("T"), F.substring(printed, 12, 8), F.lit("Z"))
    return F.coalesce(stamp, F.lit(""))


def retrieval_stamp() -> Column:
    """Now in UTC, whole seconds, one value for the whole query."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(now, 1, 10), F.lit("T"), F.substring(now, 12, 8), F.lit("+00:00"))
