"""Typed reads of text values with the legacy (non-ANSI) meaning.

Feeds carry numbers and dates as text. The pipelines were defined with the
lenient cast semantics of Spark's non-ANSI mode: malformed values become NULL
instead of failing the job, and integer casts truncate decimals. All helpers
here give the same answer with ``spark.sql.ansi.enabled`` on or off: they use
``try_cast`` and a syntax check, never the session's cast mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters the legacy casts trim from both ends (ASCII control
# characters and space).
TRIMMED = "".join(map(chr, [*range(0x00, 0x21), 0x7F]))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Ranges of the integral types narrower than BIGINT.
_BITS = {"int": 32, "smallint": 16, "tinyint": 8}


# What reads as a whole number (group: the part before the point), and as a
# bare fraction. Trimmed characters may stand around either.
_AROUND = r"[\x00-\x20\x7F]*"
NUMBER = rf"^{_AROUND}[+-]?[0-9]+(\.[0-9]*)?{_AROUND}$"
FRACTION = rf"^{_AROUND}[+-]?\.[0-9]+{_AROUND}$"


def _whole(text: Column) -> Column:
    return F.btrim(F.substring_index(text, ".", 1), F.lit(TRIMMED))


def integral_text(c: Column | str) -> Column:
    """What an integral cast reads of a text: its whole part, ``'0'`` of a bare fraction, NULL of the rest.

    With :func:`int_of_integral_text` in a projection above it the same as
    ``lenient_int``, each step being made once a value.
    """
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER), _whole(text)).when(text.rlike(FRACTION), F.lit("0"))


def int_of_integral_text(c: Column | str) -> Column:
    return _in_range(_col(c), "int")


def _lenient_integral(c: Column | str, target: str) -> Column:
    # The syntax of a value is looked at first, and no value that cannot be
    # read reaches a cast, since a failing one is dear (it throws).
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER), _in_range(_whole(text), target)).when(text.rlike(FRACTION), F.lit(0).cast(target))


def _in_range(whole: Column, target: str) -> Column:
    # Up to 18 digits always fit a BIGINT, whose range is tested here. The text
    # before the point is the result; the fraction is never rounded into it,
    # however long it is.
    number = whole.try_cast("bigint")
    if target in _BITS:
        top = 1 << (_BITS[target] - 1)
        number = F.when(number.between(-top, top - 1), number.try_cast(target))
    return F.when(F.length(whole) <= 18, number).otherwise(whole.try_cast(target))


def lenient_int(c: Column | str) -> Column:
    """Text → INT like the legacy cast: ``'12.5'``→12, ``'-3.9'``→-3, ``'1e3'``/overflow→NULL."""
    return _lenient_integral(c, "int")


def lenient_long(c: Column | str) -> Column:
    return _lenient_integral(c, "bigint")


def lenient_short(c: Column | str) -> Column:
    return _lenient_integral(c, "smallint")


def lenient_byte(c: Column | str) -> Column:
    return _lenient_integral(c, "tinyint")


def lenient_double(c: Column | str) -> Column:
    """Text → DOUBLE; anything unparsable is NULL."""
    return _col(c).cast("string").try_cast("double")


def lenient_float(c: Column | str) -> Column:
    return _col(c).cast("string").try_cast("float")


def lenient_timestamp(c: Column | str) -> Column:
    """Text → wall-clock timestamp (no time zone); unparsable → NULL."""
    return _col(c).cast("string").try_cast("timestamp_ntz")


_LENIENT = {
    "int": lenient_int,
    "integer": lenient_int,
    "bigint": lenient_long,
    "long": lenient_long,
    "smallint": lenient_short,
    "short": lenient_short,
    "tinyint": lenient_byte,
    "byte": lenient_byte,
    "double": lenient_double,
    "float": lenient_float,
    "timestamp": lenient_timestamp,
    "timestamp_ntz": lenient_timestamp,
}


def lenient_cast(c: Column | str, target: str) -> Column:
    """Cast with legacy semantics for the types feeds carry as text.

    Other targets (string, decimal(p,s), date, …) use ``try_cast``.
    """
    fn = _LENIENT.get(target.lower())
    return fn(c) if fn else _col(c).try_cast(target)


def _compact_text(c: Column | str, century: str, time_chars: int) -> Column:
    s = _col(c).cast("string")
    return F.concat_ws(
        "-",
        F.concat(F.lit(century), F.substring(s, 1, 2)),
        F.substring(s, 3, 2),
        F.substring(s, 5, time_chars),
    )


def compact_date(c: Column | str, century: str = "20") -> Column:
    """``yyMMdd`` → timestamp at midnight; century fixed; malformed → NULL."""
    return lenient_timestamp(_compact_text(c, century, 2))


def compact_datetime(c: Column | str, century: str = "20") -> Column:
    """``yyMMdd HH:mm:ss`` → timestamp; empty or malformed → NULL."""
    return lenient_timestamp(_compact_text(c, century, 11))


def compact_datetime_text(c: Column | str, century: str = "20") -> Column:
    """``yyMMdd HH:mm:ss`` → canonical ``yyyy-MM-dd HH:mm:ss`` text.

    An empty value stays ``''`` (a sentinel distinct from NULL), unparsable
    text becomes NULL. Canonical text sorts in time order, and the empty
    sentinel sorts below every time but above NULL.
    """
    col = _col(c)
    return F.when(F.length(col) == 0, F.lit("")).otherwise(compact_datetime(col).cast("string"))


def date_parts(ts: Column | str) -> tuple[Column, Column, Column]:
    """Year, month, day-of-month (INT) of a date or timestamp."""
    t = _col(ts)
    return F.year(t), F.month(t), F.dayofmonth(t)
