"""Lazy plans: from raw tables to matched rows and commands. No action runs here."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import is_invalid_padded
from rosterflow.operators import commands as cmd
from rosterflow.operators.centres import resolve_coordinators
from rosterflow.operators.programme import (
    eligible,
    names_person,
    partner_or_home,
    skip_reason,
    with_programme_class,
)
from rosterflow.operators.roster import (
    dedupe_students,
    dedupe_teachers,
    in_sections,
    listed_sections,
    match_courses,
    student_keys,
    teacher_keys,
)
from rosterflow.operators.users import clean_users, user_ids, with_known_flag
from rosterflow.params import Process
from rosterflow.rules import DEFAULT_RULES, Rules


def matched_students(
    courses: DataFrame,
    students: DataFrame,
    process: Process = Process.ENROL,
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
    formats: Sequence[str] = (),
    reduce: bool = False,
    by_term: bool = True,
    person: Column | None = None,
) -> DataFrame:
    """First roster row per person and section, matched with courses and classified.

    ``reduce`` reads the keys of the roster first and lets only rows of sections with a
    listed course into the sort: for a roster that is much larger than the course list.
    ``by_term=False`` is the oldest key of a person and section, of any term.
    ``person`` holds where names, documents and e-mail of a row are asked for; elsewhere they
    are null and not carried through the shuffles. It may depend on the status only.
    """
    keyed = student_keys(students, since, formats)
    if person is not None:
        keyed = _without_person(keyed, person, by_term)
    if reduce:
        keyed = in_sections(keyed, listed_sections(courses, keyed, True, by_term))
    roster = dedupe_students(keyed, by_term)
    rows = match_courses(courses, roster, cut=True).withColumnRenamed("student_id", "user_id")
    partner = partner_or_home(F.col("partner"), rules)
    classed = with_programme_class(rows.withColumn("partner", partner), rules)
    return classed.withColumn("skip_reason", skip_reason(process, rules))


def _without_person(keyed: DataFrame, person: Column, by_term: bool) -> DataFrame:
    """Rows with person columns only where ``person`` holds.

    Number and e-mail take part in the choice of the first row, after the status: of rows alike
    up to there all keep them or none does. The oldest key asks for the term after them, so there they stay.
    """
    columns = ("doc_type", "first_name", "last_name", *(("doc_no", "email") if by_term else ()))
    return keyed.withColumns({c: F.when(person, F.col(c)) for c in columns})


def flagged_students(
    rows: DataFrame, users: DataFrame, process: Process = Process.ENROL, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Matched rows that yield commands, with whether the directory knows them if the process asks."""
    kept = rows.where(eligible(process, rules))
    asked = process not in (Process.DROP, Process.CLEAN_UP)
    return with_known_flag(kept, user_ids(users)) if asked else kept


def commands_of_students(
    rows: DataFrame, users: DataFrame, process: Process = Process.ENROL, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Commands of matched rows. Skipped rows leave before the directory is joined."""
    return cmd.student_commands(flagged_students(rows, users, process, rules), process, rules)


def student_commands(
    courses: DataFrame,
    students: DataFrame,
    users: DataFrame,
    process: Process | str | None = None,
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
    formats: Sequence[str] = (),
    by_term: bool = True,
) -> DataFrame:
    """The student job as one plan."""
    process = Process.of(process)
    person = names_person(process, rules)
    rows = matched_students(courses, students, process, rules, since, formats, by_term=by_term, person=person)
    return commands_of_students(rows, users, process, rules)


def legacy_student_commands(
    courses: DataFrame,
    students: DataFrame,
    class_code: Column,
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
    repeat_id: bool = True,
    formats: Sequence[str] = (),
    by_term: bool = True,
) -> DataFrame:
    """The oldest policy: all five commands for each enrolled row, no directory.

    A status that neither enrols nor takes out gives no command.
    """
    roster = dedupe_students(student_keys(students, since, formats), by_term)
    rows = match_courses(courses, roster, cut=True).withColumnRenamed("student_id", "user_id")
    valid = rows.where(~is_invalid_padded(F.col("user_id")) & ~rules.unknown_status(F.col("status")))
    return cmd.legacy_commands(valid, class_code, rules, repeat_id)


def matched_teachers(
    courses: DataFrame,
    teachers: DataFrame,
    since: dt.date | None = None,
    formats: Sequence[str] = (),
    reduce: bool = False,
) -> DataFrame:
    """First roster row per teacher and section, matched with courses; ``reduce`` as for students."""
    keyed = teacher_keys(teachers, since, formats)
    if reduce:
        keyed = in_sections(keyed, listed_sections(courses, keyed, False))
    roster = dedupe_teachers(keyed)
    rows = match_courses(courses, roster, cut=False).withColumnRenamed("teacher_id", "user_id")
    return rows.withColumn("skip_reason", F.when(is_invalid_padded(F.col("user_id")), "invalid_id"))


def flagged_teachers(rows: DataFrame, users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Valid rows with whether the directory knows them; the role held there decides which unit to leave."""
    directory = clean_users(users).select(
        F.col("user_name").alias("user_id"), F.col("org_role_id"), F.lit(True).alias("_known")
    )
    valid = rows.where(~is_invalid_padded(F.col("user_id")))
    return valid.join(directory, "user_id", "left").withColumns(
        {
            "is_known": F.coalesce(F.col("_known"), F.lit(False)),
            "former_unit": rules.former_unit(F.col("org_role_id")),
        }
    )


def commands_of_teachers(rows: DataFrame, users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Commands of matched rows."""
    return cmd.teacher_commands(flagged_teachers(rows, users, rules), rules)


def teacher_commands(
    courses: DataFrame,
    teachers: DataFrame,
    users: DataFrame,
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
    formats: Sequence[str] = (),
    arrange: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The teacher half of the second job as one plan; ``arrange`` as for ``staff_commands``."""
    rows = flagged_teachers(matched_teachers(courses, teachers, since, formats), users, rules)
    phased = rows.withColumn("phase", F.lit(cmd.PEOPLE_PHASE))
    return cmd.teacher_commands(arrange(phased) if arrange else rows, rules)


def coordinator_commands(
    courses: DataFrame,
    students: DataFrame,
    coordinators: DataFrame,
    users: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """The coordinator half of the second job as one plan."""
    resolved = resolve_coordinators(courses, students, coordinators, users)
    return cmd.coordinator_commands(resolved, rules)


def staff_commands(
    courses: DataFrame,
    teachers: DataFrame,
    students: DataFrame,
    coordinators: DataFrame,
    users: DataFrame,
    rules: Rules = DEFAULT_RULES,
    since: dt.date | None = None,
    formats: Sequence[str] = (),
    arrange: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Teachers and coordinators of every course.

    ``arrange`` (of ``sinks.arranged``) deals the rows before their text and commands are made,
    so that dealing by ranges, which looks at its input twice, moves and repeats less.
    """
    if arrange:
        people = flagged_teachers(matched_teachers(courses, teachers, since, formats), users, rules)
        heads = resolve_coordinators(courses, students, coordinators, users)
        return cmd.commands_of_staff(arrange(cmd.staff_rows(people, heads)), rules)
    return teacher_commands(courses, teachers, users, rules, since, formats).unionByName(
        coordinator_commands(courses, students, coordinators, users, rules)
    )
