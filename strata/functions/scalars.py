"""Scalar Column rules used while cleaning shredded JSON values.

All functions return JVM-side Column expressions (no Python UDFs), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source system's rules.
# Characters removed before a card number is read as an integer: the 26 lower-case
# letters followed by '!' and '?'.
CODE_STRIP_CHARS = "abcdefghijklmnopqrstuvwxyz!?"
# Default text for blank or missing descriptive values.
DEFAULT_TEXT = "n/a"
# Text layout of the source's update timestamps and dates.
SOURCE_TS_FORMAT = "yyyy/MM/dd HH:mm:ss"
SOURCE_DATE_FORMAT = "yyyy/MM/dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower_text(c: Column | str) -> Column:
    """case normalisation."""
    return F.lower(_col(c))


def blank_to_default(c: Column | str, default: str = DEFAULT_TEXT) -> Column:
    """``COALESCE(NULLIF(TRIM(x), ''), default)``."""
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(default))


def null_default(c: Column | str, default) -> Column:
    """``COALESCE(x, default)``."""
    return F.coalesce(_col(c), F.lit(default))


def price_fallback(market: Column | str, high: Column | str, low: Column | str) -> Column:
    """the market price, else the midpoint of high and low (NULL if either is NULL)."""
    return F.coalesce(_col(market), (_col(high) + _col(low)) / F.lit(2.0))


def digits_from_code(c: Column | str, strip: str = CODE_STRIP_CHARS) -> Column:
    """integer from an alphanumeric code.

    Lower-case, turn every character of ``strip`` into a blank, trim; an all-blank result is 0
    (the source database casts blanks to 0), anything still not an integer ("1a2" -> "1 2") is
    NULL so callers can report it with ``cast_rejects``.
    """
    src = _col(c)
    spaced = F.translate(F.lower(src), strip, " " * len(strip))
    stripped = F.trim(spaced)
    return (F.when(src.isNull(), F.lit(None).cast("int"))
            .when(stripped == F.lit(""), F.lit(0))
            .otherwise(stripped.try_cast("int")))


def _parse_ntz(text: Column, fmt: str) -> Column:
    # to_timestamp_ntz keeps the wall-clock value in every session time zone (no daylight-saving
    # gap shifts) but raises on malformed text under ANSI, so it only runs once try_to_timestamp
    # has accepted the text; CASE evaluates the branch lazily.
    ok = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(text, F.lit(fmt)))


def repair_timestamp(c: Column | str, fmt: str = SOURCE_TS_FORMAT, length: int = 19,
                     prefix: str = "2") -> Column:
    """prefix a lost leading character when the trimmed text is not ``length`` long."""
    src = _col(c)
    fixed = F.when(F.length(F.rtrim(src)) != F.lit(length), F.concat(F.lit(prefix), src)).otherwise(src)
    return _parse_ntz(fixed, fmt)


def parse_timestamp(c: Column | str, fmt: str = SOURCE_TS_FORMAT) -> Column:
    """Timestamp text in ``fmt`` to TIMESTAMP_NTZ; malformed text gives NULL."""
    return _parse_ntz(_col(c), fmt)


def parse_date(c: Column | str, fmt: str = SOURCE_DATE_FORMAT) -> Column:
    """slash date text (``2010/11/03``) to DATE; malformed text gives NULL."""
    return F.to_date(_parse_ntz(_col(c), fmt))


def date_key(c: Column | str) -> Column:
    """F8: yyyyMMdd integer key of a date or timestamp (arithmetic, no string formatting)."""
    d = _col(c)
    return (F.year(d) * F.lit(10000) + F.month(d) * F.lit(100) + F.dayofmonth(d)).cast("int")


def first_present_label(pairs: Sequence[tuple[Column | str, str]], default: str = DEFAULT_TEXT) -> Column:
    """label of the first column that is present (not NULL), in the given precedence."""
    expr = None
    for c, label in pairs:
        cond = _col(c).isNotNull()
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def ts_literal(as_of) -> Column:
    """A TIMESTAMP_NTZ literal for a run's fixed clock."""
    if isinstance(as_of, _dt.datetime):
        text = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(as_of, _dt.date):
        text = as_of.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def shift_hours(c: Column | str, hours: int) -> Column:
    """fixed-offset clock (not daylight-saving aware), e.g. ``hours=-5``."""
    return F.timestamp_add("HOUR", F.lit(int(hours)), _col(c))


def local_day(c: Column | str, hours: int = -5) -> Column:
    """calendar day of a timestamp after a fixed hour offset."""
    return F.to_date(shift_hours(c, hours))


def zone_day(c: Column | str, zone: str) -> Column:
    """F10 option: calendar day in a real time zone (daylight-saving aware)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c)))


def days_before(as_of, days: int) -> Column:
    """``as_of - days`` as a TIMESTAMP_NTZ literal."""
    return F.timestamp_add("DAY", F.lit(-int(days)), ts_literal(as_of))


def is_month_end(c: Column | str) -> Column:
    """the day is the last of its month."""
    d = _col(c)
    return F.last_day(d) == F.to_date(d)


def is_weekend(c: Column | str) -> Column:
    """Sunday or Saturday (day-of-week 1 or 7, Sunday first)."""
    return F.dayofweek(_col(c)).isin(1, 7)


def month_name(c: Column | str) -> Column:
    """full English month name."""
    return F.date_format(_col(c), "MMMM")


def weekday_name(c: Column | str) -> Column:
    """full English weekday name."""
    return F.date_format(_col(c), "EEEE")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """F16: whole seconds between two timestamps."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def ci_key(c: Column | str, collation: str | None = None) -> Column:
    """a case-insensitive comparison key.

    Default: lower-case text, so equality, grouping, joins and DISTINCT compare without case.
    With ``collation="UTF8_LCASE"`` the value keeps its text and Spark's collation-aware
    operators compare it case-insensitively.
    """
    if collation:
        return F.collate(_col(c), collation)
    return F.lower(_col(c))


def safe_cast(c: Column | str, dtype: str, strict: bool = False) -> Column:
    """cast that yields NULL on failure (strict: raise, as the source database does)."""
    return _col(c).cast(dtype) if strict else _col(c).try_cast(dtype)
