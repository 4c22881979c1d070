"""Person identifiers.

The expressions name their input as few times as they can and avoid CASE: repeated
terms bloat the generated code, and branches keep it from computing them once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.text import WHITE_SPACE, strip_decimal

ID_WIDTH = 9

# Identifiers that stand for "no identifier".
INVALID_IDS = ("000000nan", "nan", "", "0", "-", "000000000", "none")


def pad_id(c: Column) -> Column:
    """Zero-pad to nine characters after a leading sign; longer ids are kept whole."""
    c = c.cast("string")
    zeros = F.repeat(F.lit("0"), F.lit(ID_WIDTH) - F.length(c))
    after_sign = F.left(c, F.lit(1)).isin("+", "-").cast("int") + 1
    return F.overlay(c, zeros, after_sign, F.lit(0))


def roster_id(c: Column) -> Column:
    """Student form of an id: no float tail, padded, case kept, null kept null."""
    return pad_id(strip_decimal(c))


def _lower_text(c: Column) -> Column:
    return F.lower(F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(WHITE_SPACE)))


def _padded(text: Column) -> Column:
    """Padded lower-case text without one trailing ``.0``, which a capital marks: the text holds none."""
    marked = F.replace(F.concat(text, F.lit("A")), F.lit(".0A"), F.lit(""))
    return pad_id(F.replace(marked, F.lit("A"), F.lit("")))


def normalise_id(c: Column) -> Column:
    """Teacher, coordinator and directory form: trimmed, lower case, padded; none -> ''."""
    text = _lower_text(c)
    times = (~text.isin("", "nan", "none")).cast("int")
    return F.repeat(_padded(text), times)


def is_invalid_id(c: Column) -> Column:
    """True when the id stands for "no identifier", before or after padding.

    Padding is applied to both sides of the comparison, so a raw and a padded form of
    the same value are judged alike.
    """
    return is_invalid_padded(_padded(_lower_text(c)))


def is_invalid_padded(c: Column) -> Column:
    """The same test for an id that is padded or normalised already."""
    padded = {i.zfill(ID_WIDTH) for i in INVALID_IDS}
    return F.lower(F.coalesce(c, F.lit(""))).isin("", *sorted(padded))
