"""Column -> Column helpers used to conform raw text.

All are built-in expressions, so they stay inside whole-stage codegen.
Every parse of external text uses a ``try_`` form: under ANSI mode a plain
cast or ``to_date`` raises on bad input, here bad input becomes NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def padded_id(prefix: str, c: ColumnOrName, width: int) -> Column:
    """``prefix`` + zero-padded integer, exactly like ``format_string(prefix%0{width}d)``.

    Non-negative values stay in generated code (``lpad``, or the plain text
    when already wider than ``width``); the slower formatter only handles
    negatives.
    """
    c = _col(c)
    text = c.cast("string")
    padded = (
        F.when(c >= F.lit(10 ** width), text)            # already wider: no padding
        .when(c >= 0, F.lpad(text, width, "0"))
        .otherwise(F.format_string(f"%0{width}d", c))    # negatives only
    )
    return F.concat(F.lit(prefix), padded)


def strip_prefix(c: ColumnOrName, prefix: str) -> Column:
    """Drop a literal letter prefix and the zeros after it (``O000042`` -> ``42``).

    Only a prefix at the start is removed; ``O000000`` becomes ``''``,
    other text (lower case, NULL) passes unchanged.
    """
    return F.regexp_replace(_col(c), f"^{re.escape(prefix)}0*", "")


def trim_lower(c: ColumnOrName, all_whitespace: bool = False) -> Column:
    """``lower(trim(c))``; ``all_whitespace`` also strips tabs and newlines."""
    c = _col(c)
    if all_whitespace:
        return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.lower(F.trim(c))


def to_money(c: ColumnOrName, dtype: str = "decimal(10,2)") -> Column:
    """Tolerant decimal: unparsable or over-range text -> NULL, HALF_UP rounding."""
    return _col(c).try_cast(dtype)


def to_int(c: ColumnOrName) -> Column:
    """Tolerant integer: anything that is not an integer literal -> NULL."""
    return _col(c).try_cast("int")


def to_date(c: ColumnOrName) -> Column:
    """Tolerant date (``yyyy-MM-dd`` and the other cast forms); bad text -> NULL."""
    return F.try_to_date(_col(c))


def to_timestamp(c: ColumnOrName) -> Column:
    """Timestamp from text (tolerant) or from any timestamp type (cast)."""
    return _col(c).try_cast("timestamp")


def is_blank(c: ColumnOrName) -> Column:
    """NULL, empty or whitespace-only text."""
    c = _col(c)
    return c.isNull() | (F.regexp_replace(c, r"^\s+|\s+$", "") == F.lit(""))


def default_if_null(c: ColumnOrName, default) -> Column:
    """NULL -> literal ``default``."""
    return F.coalesce(_col(c), F.lit(default))


def default_if_blank(c: ColumnOrName, default) -> Column:
    """NULL, empty or whitespace-only -> literal ``default``."""
    c = _col(c)
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def fill_default(c: ColumnOrName, default, blank_as_missing: bool = False) -> Column:
    """``default_if_null``, or ``default_if_blank`` with ``blank_as_missing``."""
    return default_if_blank(c, default) if blank_as_missing else default_if_null(c, default)


def strip_or_sentinel(c: ColumnOrName, prefix: str, sentinel: str, blank_as_missing: bool = False) -> Column:
    """Missing id -> ``sentinel``, otherwise ``strip_prefix``."""
    c = _col(c)
    missing = is_blank(c) if blank_as_missing else c.isNull()
    return F.when(missing, F.lit(sentinel)).otherwise(strip_prefix(c, prefix))


def utc_to_zone(c: ColumnOrName, zone: str) -> Column:
    """Render a UTC instant as the wall clock of ``zone``.

    Correct only with session time zone UTC (see ``strata.session``).
    """
    return F.from_utc_timestamp(to_timestamp(c), zone)


def now_in_zone(zone: str) -> Column:
    """The query's current instant as ``zone`` wall-clock time."""
    return F.from_utc_timestamp(F.current_timestamp(), zone)
