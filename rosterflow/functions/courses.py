"""Course links, short names and terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.text import trim_all

TERM_WIDTH = 6
DETAIL_LINK = "https://lms.example.org/course_offering?ou=%s"


def _null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def course_id(link: Column) -> Column:
    """The 4 to 6 digits after the last slash at the end of a link, else null."""
    return _null_if_empty(F.regexp_extract(trim_all(link), r"/([0-9]{4,6})$", 1))


def legacy_course_id(link: Column) -> Column:
    """The last five characters when they are digits, else the last four."""
    tail = F.right(link, F.lit(5))
    return F.when(tail.rlike("^[0-9]+$"), tail).otherwise(F.right(link, F.lit(4)))


def detail_link(course: Column, template: str = DETAIL_LINK) -> Column:
    """Link of the course detail page in the learning system."""
    return F.when(course.isNotNull(), F.format_string(template, course))


def short_name_parts(short_name: Column) -> Column:
    """``struct(nrc, term)`` of a four-part short name, null for any other shape."""
    parts = F.split(short_name, "-", -1)
    return F.when(
        F.size(parts) == 4,
        F.struct(F.element_at(parts, -1).alias("nrc"), F.element_at(parts, -2).alias("term")),
    )


def legacy_number(short_name: Column) -> Column:
    """The 1 to 5 characters after the last dash, else ``N/A``."""
    found = F.regexp_extract(trim_all(short_name), r"-([^-]{1,5})$", 1)
    return F.coalesce(_null_if_empty(found), F.lit("N/A"))


def oldest_number(short_name: Column) -> Column:
    """The last five characters, whatever they are."""
    return F.right(short_name, F.lit(5))


def cut_term(term: Column) -> Column:
    """The term without its version tail."""
    return F.left(term, F.lit(TERM_WIDTH))


def programme_suffix(term: Column) -> Column:
    """The two characters of the cut term that name the kind of programme."""
    return F.right(cut_term(term), F.lit(2))
