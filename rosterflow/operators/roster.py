"""Roster clean-up, deduplication and matching with the course registry.

Cleaning is split in two: keys first, because deduplication and matching need them,
and the person columns late, so that only rows which survive pay for title casing
and document formatting.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from rosterflow.functions import (
    active_since,
    cut_term,
    doc_label,
    normalise_id,
    parse_activity,
    programme_suffix,
    roster_id,
    strip_decimal,
    title_case,
    trim_all,
)
from rosterflow.operators.first import first_rows
from rosterflow.schemas import LINEAGE, STUDENT_ORDER, TEACHER_ORDER


def student_keys(students: DataFrame, since: dt.date | None = None, formats: Sequence[str] = ()) -> DataFrame:
    """Student roster with clean keys, active since the date."""
    keyed = _keys(students, "student_id", roster_id(F.col("student_id")), since, formats)
    return keyed.withColumn("partner", trim_all(F.col("partner")))


def teacher_keys(teachers: DataFrame, since: dt.date | None = None, formats: Sequence[str] = ()) -> DataFrame:
    """Teacher roster with clean keys, active since the date."""
    return _keys(teachers, "teacher_id", normalise_id(F.col("teacher_id")), since, formats)


def _keys(roster: DataFrame, id_column: str, user_id, since: dt.date | None, formats: Sequence[str]) -> DataFrame:
    given = F.col("activity_ts")
    # a landed time is compared as it is, so that the files can be asked
    kind = roster.schema["activity_ts"].dataType
    # a date has no other reading
    time = given.cast("timestamp_ntz") if kind in (TimestampNTZType(), DateType()) else parse_activity(given, formats)
    return roster.withColumns(
        {
            "term": strip_decimal(F.col("term")),
            "section": strip_decimal(F.col("section")),
            "crosslist": strip_decimal(F.col("crosslist")),
            id_column: user_id,
            "activity_ts": time,
        }
    ).where(active_since(F.col("activity_ts"), since))


def person_columns(rows: DataFrame) -> DataFrame:
    """Names in title case."""
    return rows.withColumns(
        {
            "first_name": title_case(F.col("first_name")),
            "last_name": title_case(F.col("last_name")),
        }
    )


def clean_students(students: DataFrame, since: dt.date | None = None, formats: Sequence[str] = ()) -> DataFrame:
    """The whole clean-up of the student roster."""
    rows = person_columns(student_keys(students, since, formats))
    return rows.withColumns(
        {
            "doc_no": strip_decimal(F.col("doc_no")),
            **{c: F.col(c).cast("string") for c in ("enrol_code", "status", "paid")},
        }
    )


def clean_teachers(teachers: DataFrame, since: dt.date | None = None, formats: Sequence[str] = ()) -> DataFrame:
    """The whole clean-up of the teacher roster."""
    rows = person_columns(teacher_keys(teachers, since, formats))
    return rows.withColumn("doc_no", strip_decimal(F.col("doc_no")))


def dedupe_students(students: DataFrame, by_term: bool = True) -> DataFrame:
    """First row per (term, section, person), whatever its status or crosslist.

    The oldest form of the job left the term out of the key.
    """
    keys = ["student_id", "section", "term"] if by_term else ["student_id", "section"]
    return first_rows(students, keys, STUDENT_ORDER if by_term else (*STUDENT_ORDER, "term"))


def dedupe_teachers(teachers: DataFrame) -> DataFrame:
    """First row per (term, section, person)."""
    return first_rows(teachers, ["teacher_id", "section", "term"], TEACHER_ORDER)


def distinct_courses(courses: DataFrame) -> DataFrame:
    """Each course once. A short name listed with two numbers or terms is two courses. Its place stays, where ``courses`` have one."""
    named = courses.where(F.col("short_name").isNotNull())
    return named.select(
        "short_name",
        strip_decimal(F.col("nrc")).alias("nrc"),
        strip_decimal(F.col("term")).alias("term"),
        *place_of(courses),
    ).distinct()


def duplicate_courses(courses: DataFrame) -> DataFrame:
    """Courses listed more than once."""
    return courses.groupBy("short_name", "nrc", "term").agg(F.count("*").alias("n")).where("n > 1")


def conflicting_courses(courses: DataFrame) -> DataFrame:
    """Short names listed with different numbers or terms."""
    return distinct_courses(courses).groupBy("short_name").agg(F.count("*").alias("n")).where("n > 1")


def match_courses(courses: DataFrame, roster: DataFrame, cut: bool) -> DataFrame:
    """Roster rows of each listed course, joined on (term, crosslist).

    Adds ``short_name``, ``nrc`` and the programme ``suffix`` of the course.

    ``cut`` drops the version tail of the course term, as the student job does. No
    broadcast is forced: a course list under the size limit is broadcast, a larger one
    is merge-joined with hot crosslists split at run time.
    """
    term = F.col("term")
    keyed = distinct_courses(courses).select(
        "short_name",
        "nrc",
        (cut_term(term) if cut else term).alias("term"),
        F.col("nrc").alias("crosslist"),
        programme_suffix(term).alias("suffix"),
        *place_of(courses),
    )
    return roster.join(keyed, ["term", "crosslist"])


def listed_sections(courses: DataFrame, roster: DataFrame, cut: bool, by_term: bool = True) -> DataFrame:
    """The (term, section) pairs of which some roster row is of a listed course.

    The first row of a person and section may be of any crosslist, but only these sections
    can match. ``by_term=False`` gives sections of any term, for the oldest key.
    """
    term = F.col("term")
    listed = distinct_courses(courses).select((cut_term(term) if cut else term).alias("term"), F.col("nrc").alias("crosslist"))
    held = roster.join(listed.distinct(), ["term", "crosslist"], "left_semi")
    return held.select(*(["term"] if by_term else []), "section").distinct()


def in_sections(roster: DataFrame, sections: DataFrame) -> DataFrame:
    """Roster rows of the given sections. It goes before the first-row sort, which then moves their rows only."""
    renamed = sections.withColumnsRenamed({c: f"_{c}" for c in sections.columns})
    same = F.lit(True)
    for c in sections.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return roster.join(renamed, same, "left_semi")


def place_of(rows: DataFrame) -> list[str]:
    """The column of the place in the course list, where the rows have it."""
    return [c for c in ("place",) if c in rows.columns]


def placed_courses(courses: DataFrame) -> DataFrame:
    """Distinct courses with their ``place``, so that rows matched with them need no further join to be put in that order."""
    return distinct_courses(courses).join(list_places(courses), ["short_name", "nrc"], "left").select("short_name", "nrc", "term", "place")


def list_places(courses: DataFrame) -> DataFrame:
    """The place of each course in its list: that of its first mention, by file and row."""
    named = courses.where(F.col("short_name").isNotNull())
    place = F.min(F.struct("src_file", "row_no")).alias("place")
    return named.groupBy("short_name", strip_decimal(F.col("nrc")).alias("nrc")).agg(place)


def with_doc_label(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_label", doc_label(F.col("doc_type"), F.col("doc_no")))

