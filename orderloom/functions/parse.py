"""Lenient text-to-value parsing: bad text gives NULL, never an error.

Spark's own casts differ from the wanted rules in both directions: casting
'3.7' to int gives NULL where 4 is wanted, and '1d' is accepted as a double
where NULL is wanted. So each parser first admits only plain decimal notation
and then casts. Left out, as NULL: hexadecimal, a dot after the exponent
('1e2.'), two signs, and a signed NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import ColumnLike, column

_DIGITS = r"\d+(?:_\d+)*"
_PLAIN_NUMBER = rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?\d+)?\s*$"
_NOT_FINITE = r"(?i)^\s*(?:nan|[+-]?inf(?:inity)?)\s*$"
_DASHED_DATE = r"^\d{1,2}-\d{1,2}-\d{1,2}$"
_ASCII_SPACE = " \t\n\x0b\f\r"

# Fixed value: two-digit years from here on belong to the 1900s.
FIRST_YEAR_OF_1900S = 69


def _plain_number(c: ColumnLike) -> Column:
    text = column(c)
    return F.when(text.rlike(_PLAIN_NUMBER), F.replace(text, F.lit("_"), F.lit("")))


def parse_int(c: ColumnLike) -> Column:
    """Whole number, halves rounded away from zero; out of range gives NULL.

    The rounding happens in the cast to a decimal without fraction digits, so
    it is exact where a detour over double would not be.
    """
    return _plain_number(c).try_cast("decimal(11,0)").try_cast("int")


def parse_money(c: ColumnLike) -> Column:
    return _plain_number(c).try_cast("decimal(10,2)")


def parse_double(c: ColumnLike) -> Column:
    text = column(c)
    return F.coalesce(
        _plain_number(c).try_cast("double"),
        F.when(text.rlike(_NOT_FINITE), F.btrim(text, F.lit(_ASCII_SPACE))).try_cast("double"),
    )


def parse_mdy(c: ColumnLike) -> Column:
    """Date from month-day-year text with a two-digit year, such as '04-30-22'."""
    text = F.btrim(column(c), F.lit(_ASCII_SPACE))
    month, day, year = (F.split_part(text, F.lit("-"), F.lit(i)) for i in (1, 2, 3))
    century = F.when(year.try_cast("int") >= FIRST_YEAR_OF_1900S, "19").otherwise("20")
    iso = F.concat(century, F.lpad(year, 2, "0"), F.lit("-"), month, F.lit("-"), day)
    return F.when(text.rlike(_DASHED_DATE), iso).try_cast("date")
