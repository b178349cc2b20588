"""Strict text-to-number casts, zero padding and literal maps.

Spark's ``try_cast`` is more forgiving than the layouts allow: it trims padded
text and reads ``5d`` or ``NaN`` as doubles. It is also slow on text that is no
number, because each failure raises an exception inside. The patterns below keep
such text away from the cast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# What counts as a whole or a decimal number, and as white space.
WHOLE_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(name: str) -> Column:
    """A column reference that takes any header, dots and dashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def to_whole(text: Column, kind: str = "bigint") -> Column:
    """Whole-number text to ``kind``; anything else, ``150.0`` included, to null."""
    return F.when(text.rlike(WHOLE_TEXT), text.try_cast(kind))


def is_double(text: Column) -> Column:
    """Whether the text is a decimal number that a double can hold.

    It stands as the condition of one branch. Around the finished value, Spark would push the bound
    into the branches and match the pattern once for the bound and again for the value.
    """
    return text.rlike(FLOAT_TEXT) & (F.abs(text.try_cast("double")) < F.lit(float("inf")))


def to_double(text: Column) -> Column:
    """Decimal text to double; padded, suffixed or non-finite text to null, too large a number as well."""
    return F.when(is_double(text), text.try_cast("double"))


def number(column: Column, data_type: str) -> Column:
    """Lenient double for a column of any type."""
    return to_double(column) if data_type == "string" else column.try_cast("double")


def zero_pad(text: Column, width: int) -> Column:
    """Pad with zeros after any sign; never cuts, unlike plain ``lpad``."""
    digits = F.substring(text, 2, 2**31 - 1)
    signed = F.concat(
        F.substring(text, 1, 1),
        F.lpad(digits, F.greatest(F.length(digits), F.lit(width - 1)), F.lit("0")),
    )
    plain = F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
    return F.when(F.substring(text, 1, 1).isin("-", "+"), signed).otherwise(plain)


def whole_code(text: Column, width: int) -> Column:
    """``7`` -> ``07``: whole-number text to a padded code, other text to null."""
    number = text.try_cast("bigint").cast("string")
    return F.when(text.rlike(f"^[0-9]{{1,{width}}}$"), F.lpad(text, width, "0")).when(
        text.rlike(WHOLE_TEXT), zero_pad(number, width)
    )


def code_text(text: Column, width: int) -> Column:
    """``1001.0`` -> ``01001``: decimal text, cut to a whole number, to a padded code.

    Plain digits that fit the width need no number at all; ``width`` must be below 16.
    """
    short = text.rlike(rf"^[0-9]{{1,{width}}}(\.[0-9]*)?$")
    number = text.try_cast("double").try_cast("bigint").cast("string")
    return F.when(short, F.lpad(F.substring_index(text, ".", 1), width, "0")).when(
        text.rlike(FLOAT_TEXT), zero_pad(number, width)
    )


def round_half_away(value: Column) -> Column:
    """Nearest whole number as bigint, halves away from zero; null beyond its range."""
    nearest = F.when(value < 0, F.ceil(value - 0.5)).otherwise(F.floor(value + 0.5))
    return F.when(F.abs(value) < 9e18, nearest)


def _by_value(pairs: Mapping[str, object]) -> dict[object, list[str]]:
    groups: dict[object, list[str]] = {}
    for old, new in pairs.items():
        groups.setdefault(new, []).append(old)
    return groups


def map_text(text: Column, pairs: Mapping[str, object]) -> Column:
    """Replace listed literals by text, keep everything else."""
    case = F
    for new, olds in _by_value(pairs).items():
        case = case.when(text.isin(*olds), F.lit(None if new is None else str(new)))
    return case.otherwise(text)


def map_number(
    text: Column, pairs: Mapping[str, object], kind: str = "bigint", is_number: Column | None = None
) -> Column:
    """Listed literals to their numbers, other number text to itself, the rest to null."""
    case = F
    for new, olds in _by_value(pairs).items():
        case = case.when(text.isin(*olds), F.lit(new).cast(kind))
    return case.when(text.rlike(WHOLE_TEXT) if is_number is None else is_number, text.try_cast(kind))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))
