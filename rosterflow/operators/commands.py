"""Expansion of matched rows into bulk-load commands.

A command stays a structured row until it is written. Each matched row carries a
small array of steps ``(verb, role, org_unit)``, exploded in place without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import clean_text, doc_label, title_case
from rosterflow.operators.first import first_rows
from rosterflow.operators.roster import person_columns, place_of, with_doc_label
from rosterflow.params import Process
from rosterflow.rules import DEFAULT_RULES, Rules
from rosterflow.schemas import COMMAND_COLUMNS, COMMAND_ORDER

# The verbs of the command grammar.
CREATE, UPDATE, ENROLL, UNENROLL = "CREATE", "UPDATE", "ENROLL", "UNENROLL"

PEOPLE_PHASE, COORDINATOR_PHASE = 1, 2


def _step(verb: str, role: Column | str = "", unit: Column | str = "") -> Column:
    role, unit = (F.lit(x) if isinstance(x, str) else x for x in (role, unit))
    return F.struct(F.lit(verb).alias("verb"), role.alias("role"), unit.alias("org_unit"))


def student_steps(process: Process, rules: Rules = DEFAULT_RULES) -> Column:
    """Steps of an eligible student row."""
    course = F.col("short_name")
    leave = F.array(_step(UNENROLL, unit=course))
    if process in (Process.DROP, Process.CLEAN_UP):
        return leave
    role, unit = F.col("role"), F.col("org_unit")
    join = _step(ENROLL, rules.course_role, course)
    enrol = F.when(
        F.col("is_known"), F.array(_step(UPDATE), _step(ENROLL, role, rules.root_unit), join)
    ).otherwise(F.array(_step(CREATE, role), _step(ENROLL, role, unit), join))
    if process is Process.MIXED:
        return F.when(rules.has_left(F.col("status")), leave).otherwise(enrol)
    return enrol


def legacy_steps(rules: Rules = DEFAULT_RULES) -> Column:
    """Five commands for each row without a cancellation, without asking the directory, else one."""
    role, unit, course = F.col("role"), F.col("org_unit"), F.col("short_name")
    enrol = F.array(
        _step(CREATE, role),
        _step(UPDATE),
        _step(ENROLL, role, rules.root_unit),
        _step(ENROLL, role, unit),
        _step(ENROLL, rules.course_role, course),
    )
    leave = F.array(_step(UNENROLL, unit=course))
    return F.when(rules.has_left(F.col("status")), leave).otherwise(enrol)


def teacher_steps(rules: Rules = DEFAULT_RULES) -> Column:
    """Steps of a teacher row; ``former_unit`` is the unit a known user leaves, or null."""
    role, course, former = rules.teacher_role, F.col("short_name"), F.col("former_unit")
    join = _step(ENROLL, role, course)
    root = _step(ENROLL, role, rules.root_unit)
    return (
        F.when(~F.col("is_known"), F.array(_step(CREATE, role), join))
        .when(former.isNotNull(), F.array(_step(UPDATE), _step(UNENROLL, unit=former), root, join))
        .otherwise(F.array(_step(UPDATE), root, join))
    )


def coordinator_steps(rules: Rules = DEFAULT_RULES) -> Column:
    """Steps of the coordinator of a course: created only if unknown, never updated."""
    role = rules.coordinator_role
    join = _step(ENROLL, role, F.col("short_name"))
    return F.when(F.col("is_known"), F.array(join)).otherwise(F.array(_step(CREATE, role), join))


def explode_steps(rows: DataFrame, steps: Column, phase: int | Column, repeat_id: bool = False) -> DataFrame:
    """One row per command. Person columns are filled for CREATE and UPDATE only.

    The place of a list, where the rows have one, stays beside the command.

    ``repeat_id`` puts the id in the document slot of UNENROLL as well, as the oldest
    command form did.
    """
    exploded = rows.select("*", F.posexplode(steps).alias("_pos", "_step"))
    verb = F.col("_step.verb")
    on_person = verb.isin(CREATE, UPDATE)

    def person(c: str) -> Column:
        return F.when(on_person, F.coalesce(F.col(c), F.lit(""))).otherwise(F.lit(""))

    doc = person("doc_label")
    if repeat_id:
        doc = F.when(verb == UNENROLL, F.col("user_id")).otherwise(doc)
    return exploded.select(
        "short_name",
        "nrc",
        (phase if isinstance(phase, Column) else F.lit(phase)).cast("bigint").alias("phase"),
        "src_file",
        "row_no",
        "section",
        F.col("_pos").cast("bigint").alias("step"),
        verb.alias("verb"),
        "user_id",
        doc.alias("doc_label"),
        person("first_name").alias("first_name"),
        person("last_name").alias("last_name"),
        F.col("_step.role").alias("role"),
        F.col("_step.org_unit").alias("org_unit"),
        F.when(on_person, F.lit("1")).otherwise(F.lit("")).alias("active"),
        person("email").alias("email"),
        *place_of(rows),
    )


def student_commands(rows: DataFrame, process: Process, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Commands of eligible student rows."""
    return explode_steps(with_doc_label(person_columns(rows)), student_steps(process, rules), PEOPLE_PHASE)


def legacy_commands(
    rows: DataFrame, class_code: Column, rules: Rules = DEFAULT_RULES, repeat_id: bool = True
) -> DataFrame:
    """Commands of the oldest policy, with the programme class chosen by hand."""
    role, unit = rules.legacy_class(class_code)
    classed = with_doc_label(person_columns(rows)).withColumns({"role": role, "org_unit": unit})
    return explode_steps(classed, legacy_steps(rules), PEOPLE_PHASE, repeat_id)


def teacher_commands(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Commands of valid teacher rows."""
    return explode_steps(with_doc_label(person_columns(rows)), teacher_steps(rules), PEOPLE_PHASE)


def _coordinator_rows(resolved: DataFrame) -> DataFrame:
    return resolved.select(
        "*",
        F.lit("").alias("src_file"),
        F.lit(0).cast("bigint").alias("row_no"),
        F.lit("").alias("section"),
    )


def coordinator_commands(resolved: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Commands of the resolved coordinator of each course."""
    return explode_steps(_coordinator_rows(resolved), coordinator_steps(rules), COORDINATOR_PHASE)


def staff_rows(teachers: DataFrame, resolved: DataFrame) -> DataFrame:
    """Valid teacher rows and coordinators as one table, before names and labels are made; with places where both have them."""
    placed = place_of(teachers) if place_of(resolved) else []
    shared = (*placed, "short_name", "nrc", "src_file", "row_no", "section", "user_id", "is_known", "first_name", "last_name", "email")
    people = teachers.select(*shared, F.lit(PEOPLE_PHASE).alias("phase"), "former_unit", "doc_type", "doc_no")
    heads = _coordinator_rows(resolved).select(*shared, F.lit(COORDINATOR_PHASE).alias("phase"), F.col("doc_label").alias("given_label"))
    return people.unionByName(heads, allowMissingColumns=True)


def commands_of_staff(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Commands of rows of ``staff_rows``, made in place: their deal over partitions stays."""
    of_people = F.col("phase") == PEOPLE_PHASE
    label = F.when(of_people, doc_label(F.col("doc_type"), F.col("doc_no"))).otherwise(F.col("given_label"))
    names = {c: F.when(of_people, title_case(F.col(c))).otherwise(F.col(c)) for c in ("first_name", "last_name")}
    steps = F.when(of_people, teacher_steps(rules)).otherwise(coordinator_steps(rules))
    return explode_steps(rows.withColumns({**names, "doc_label": label}), steps, F.col("phase"))


def dedupe_create(commands: DataFrame) -> DataFrame:
    """Keep the first CREATE of each user over all lists, and every other command."""
    is_create = F.col("verb") == CREATE
    creates = first_rows(commands.where(is_create), ["user_id"], COMMAND_ORDER)
    return commands.where(~is_create).unionByName(creates)


def render_line(quote: str = "none") -> Column:
    """The text of a command: comma joined, empty slots kept.

    ``quote="none"`` writes fields as they are; ``"csv"`` quotes fields that hold a
    comma, a quote or a line break.
    """
    if quote not in ("none", "csv"):
        raise ValueError(f"unknown quoting {quote!r}")

    def field(c: str) -> Column:
        text = F.coalesce(F.col(c), F.lit(""))
        if quote == "none":
            return text
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike('[",\r\n]'), quoted).otherwise(text)

    verb, empty = F.col("verb"), F.lit("")
    person = [field(c) for c in ("user_id", "doc_label", "first_name", "last_name")]
    active, email, role, unit = (field(c) for c in ("active", "email", "role", "org_unit"))
    return (
        F.when(verb == CREATE, F.concat_ws(",", verb, *person, empty, role, active, email))
        .when(verb == UPDATE, F.concat_ws(",", verb, *person, empty, active, email))
        .when(verb == ENROLL, F.concat_ws(",", verb, field("user_id"), empty, role, unit))
        .otherwise(F.concat_ws(",", verb, field("user_id"), field("doc_label"), unit))
    )


def has_comma() -> Column:
    """True for a command whose free text would shift the fields of an unquoted line."""
    free = [F.col(c) for c in ("user_id", "doc_label", "first_name", "last_name", "email", "org_unit")]
    found = clean_text(free[0]).contains(",")
    for c in free[1:]:
        found = found | clean_text(c).contains(",")
    return found
