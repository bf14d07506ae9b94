"""Text cleaning. Every function takes a column (or its name) and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators. Tab and newline are kept as data.
SPACE_SEPARATORS = "".join(
    map(chr, [0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000])
)

ColumnLike = Column | str


def column(name: ColumnLike) -> Column:
    """Column by its literal name, which may hold spaces, dots, hyphens or colons."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


def clean(c: ColumnLike) -> Column:
    """Text without the space separators around it.

    In pure ASCII text the only one is the blank, which Spark trims much faster
    than a set of characters.
    """
    text = column(c)
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, F.trim(text)).otherwise(F.btrim(text, F.lit(SPACE_SEPARATORS)))


def clean_upper(c: ColumnLike) -> Column:
    return F.upper(clean(c))


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(clean(c), F.lit(""))


def is_blank(c: ColumnLike) -> Column:
    """True for NULL and for text of spaces only; never NULL itself."""
    return blank_to_null(c).isNull()


def has_text(c: ColumnLike) -> Column:
    return blank_to_null(c).isNotNull()


def is_true_text(c: ColumnLike) -> Column:
    """'True', ' TRUE ' and so on are true, other text false, NULL stays NULL."""
    return F.lower(clean(c)) == "true"


def before_dot(c: ColumnLike) -> Column:
    """Postal code without the '.0' a float export leaves behind."""
    return F.split_part(clean(c), F.lit("."), F.lit(1))


def list_length(c: ColumnLike, separator: str = ",") -> Column:
    """Items in a separated list, counted from its separators; NULL for NULL."""
    text = column(c)
    without = F.replace(text, F.lit(separator), F.lit(""))
    return F.length(text) - F.length(without) + F.lit(1)


def or_default(c: ColumnLike, default: str) -> Column:
    return F.coalesce(column(c), F.lit(default))
