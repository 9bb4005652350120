"""Column expressions on quoted ids and gender codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_ends(c: str) -> Column:
    """Drop the first and the last character, whatever they are."""
    return F.substring(F.col(c), F.lit(2), F.length(c) - 2)


def unquote(c: str) -> Column:
    """Drop one surrounding single quote on either side, if there is one."""
    return F.regexp_replace(F.col(c), "^'|'$", "")


def gender_letter(c: str) -> Column:
    """The letter inside a quoted gender code."""
    return F.substring(F.col(c), 2, 1)


def letter_code(letter: Column) -> Column:
    """Code point of a one-letter text, 0 for the empty one.

    As an integer it can be kept by min and max in a hash aggregate; strings would force the
    aggregate to sort its input.
    """
    return F.ascii(letter)


def letter_of(code: Column) -> Column:
    """Inverse of letter_code."""
    wide = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return F.when(code == 0, F.lit("")).otherwise(F.decode(wide, "UTF-32"))


def is_quoted(c: str) -> Column:
    """True for ids of the regular form: a quote, any text, a quote."""
    return F.startswith(F.col(c), F.lit("'")) & F.endswith(F.col(c), F.lit("'")) & (F.length(c) >= 2)
