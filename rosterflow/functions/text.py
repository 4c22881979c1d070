"""Text clean-up expressions. Built-ins only, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the white space that trimming removes.
WHITE_SPACE = "".join(
    chr(n)
    for n in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# Any character without case starts a new word for title_case.
_UNCASED = r"([^\p{Lu}\p{Ll}\p{Lt}ªº])"
_OTHER_THAN_WORDS = r"[^\p{Lu}\p{Ll}\p{Lt} ]"
_MARK = "\u0001 "


def trim_all(c: Column) -> Column:
    """Trim every kind of white space at both ends; null stays null.

    Most texts have none to trim, and looking at both ends is cheaper than trimming.
    """
    blanks = F.lit(WHITE_SPACE)
    ends = blanks.contains(F.left(c, F.lit(1))) | blanks.contains(F.right(c, F.lit(1)))
    return F.when(ends, F.btrim(c, blanks)).otherwise(c)


def clean_text(c: Column) -> Column:
    """Trimmed text with null turned into the empty text."""
    return F.coalesce(trim_all(c.cast("string")), F.lit(""))


def strip_decimal(c: Column) -> Column:
    """Drop one trailing ``.0``, as left by spreadsheets that store ids as floats."""
    c = c.cast("string")
    tail = F.endswith(c, F.lit(".0")).cast("int") * 2
    return F.left(c, F.length(c) - tail)


def title_case(c: Column) -> Column:
    """Trim, then upper-case each letter that follows a character without case.

    ``initcap`` starts words only after a blank. Where a text holds another uncased
    character, a marked blank is put after each of them and taken out afterwards, so
    that apostrophes, dashes and digits start words too.
    """
    text = trim_all(c.cast("string"))
    marked = F.regexp_replace(text, _UNCASED, "$1" + _MARK)
    spread = F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))
    return F.when(text.rlike(_OTHER_THAN_WORDS), spread).otherwise(F.initcap(text))
