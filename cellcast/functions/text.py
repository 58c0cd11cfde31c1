"""Coercion of text columns. Bad input becomes null, never an error."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, StringType, TimestampNTZType, TimestampType

from cellcast import fixed


BLANKS = " \t\n\x0b\x0c\r"
OFFSET = r"(\d:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*(?:Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?)$"


def plain_name(name: str) -> str:
    """Letters and digits of a column name, lower case."""
    return re.sub(r"[\W_]+", "", name).lower()


def pick_column(columns: list[str], names: list[str], substrings: list[str]) -> str | None:
    """First column equal to one of ``names``, else first one containing one of ``substrings``."""
    plain = [(plain_name(c), c) for c in columns]
    exact: dict[str, str] = {}
    for key, column in plain:
        exact.setdefault(key, column)
    hits = [exact[plain_name(n)] for n in names if plain_name(n) in exact]
    hits += [c for s in substrings for key, c in plain if plain_name(s) in key]
    return hits[0] if hits else None


def to_number(column: Column, kind: DataType = StringType()) -> Column:
    """Double, with unreadable values and NaN as null.

    Written so that each value is parsed once: filters on the result are pushed below the projection
    and would repeat every mention of it.
    """
    number = F.nanvl(column.try_cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, StringType):
        # The JVM also reads Java literals such as "1d" and "2.5f"; in data they are bad text.
        return F.when(~column.rlike(r"[0-9.][dDfF]\s*$"), number)
    return number


def to_day(column: Column, kind: DataType = StringType(), formats: list[str] | None = None) -> Column:
    """Date of a text, number, timestamp or date column; unreadable values become null.

    A time with an offset belongs to the day on its own clock. A whole number of seconds, milliseconds,
    microseconds or nanoseconds since 1970 (told apart by its digits) belongs to its UTC day; eight digits are a
    calendar day. Numbers are read like their text.
    """
    if isinstance(kind, DateType):
        return column
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return column.cast("date")
    if isinstance(kind, (DoubleType, FloatType)):
        column = column.try_cast("decimal(20,0)")
    text = F.trim(column.cast("string"), F.lit(BLANKS))
    wall = F.regexp_replace(text, OFFSET, "$1")
    tried = [F.try_to_timestamp(wall, F.lit(f)).cast("date") for f in formats or fixed.DATE_FORMATS]
    number = text.try_cast("bigint")
    days = {unit: F.date_add(F.lit("1970-01-01").cast("date"), F.call_function("div", number, F.lit(86_400 * unit)).cast("int"))
            for unit in fixed.EPOCH_DIGITS}
    epoch = F.coalesce(*[F.when(text.rlike(rf"^\d{{{low},{high}}}$"), days[unit]) for unit, (low, high) in fixed.EPOCH_DIGITS.items()])
    return F.coalesce(epoch, *tried)
