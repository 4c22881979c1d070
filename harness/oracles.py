"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from harness.views import VIEWS_SQL

# Scalar functions as SQL text.

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
# What stands for no identifier.
_INVALID = "'00000none', '000000nan', 'nan', '', '0', '-', '000000000', 'none'"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '\.0$', '')"


def _trim(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _clean(x: str) -> str:
    return f"coalesce({_trim(x)}, '')"


def _pad(x: str) -> str:
    return (
        f"CASE WHEN length({x}) >= 9 THEN {x} "
        f"WHEN left({x}, 1) IN ('+', '-') THEN left({x}, 1) || lpad(substr({x}, 2), 8, '0') "
        f"ELSE lpad({x}, 9, '0') END"
    )


def _roster_id(x: str) -> str:
    return _pad(_strip(x))


def _norm(x: str) -> str:
    low = f"lower({_clean(x)})"
    return f"CASE WHEN {low} IN ('', 'nan', 'none') THEN '' ELSE {_pad(_strip(low))} END"


def _invalid(x: str) -> str:
    return f"({_strip(f'lower({_clean(x)})')} IN ({_INVALID}) OR {_norm(x)} IN ({_INVALID}, '-00000000', '00000none'))"


def _title(x: str) -> str:
    n = _trim(x)
    return (
        f"array_to_string(list_transform(range(1, length({n}) + 1), lambda i: "
        rf"CASE WHEN i > 1 AND regexp_matches(substr({n}, i - 1, 1), '\p{{L}}') "
        f"THEN lower(substr({n}, i, 1)) ELSE upper(substr({n}, i, 1)) END), '')"
    )


def _number(x: str) -> str:
    n = _strip(x)
    return (
        f"CASE WHEN regexp_full_match(trim({n}), '[+-]?[0-9]{{1,18}}') "
        f"THEN format('{{:t.}}', try_cast(trim({n}) AS BIGINT)) ELSE {n} END"
    )


def _label(kind: str, number: str) -> str:
    return f"CASE WHEN {number} IS NULL THEN '' ELSE concat_ws('. ', {kind}, {_number(number)}) END"


def _stamp(x: str = "activity_ts") -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


# Relations shared by the oracles, in order of use.


def _first(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rk "
        f"FROM {source}) WHERE rk = 1"
    )


_STUDENT_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in ("src_file", "row_no", "crosslist", "activity_ts", "status", "paid", "doc_no", "email")
)
_TEACHER_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in ("src_file", "row_no", "crosslist", "activity_ts", "doc_no", "email", "first_name")
)
_PARTNER = f"CASE WHEN {_trim('partner')} IS NULL OR {_trim('partner')} IN ('', 'nan') THEN 'BS' ELSE {_trim('partner')} END"


def _class(suffix: str, partner: str) -> tuple[str, str]:
    cases = (
        f"CASE WHEN {suffix} IN ('41', '42') AND {partner} = 'AP' THEN '{{}}' WHEN {suffix} IN ('41', '42') THEN '{{}}' "
        f"WHEN {suffix} IN ('10', '11', '20', '21') THEN '{{}}' WHEN {suffix} = '50' THEN '{{}}' "
        f"WHEN {suffix} IN ('17', '27', '37') THEN '{{}}' END"
    )
    return (
        cases.format("Student_ap", "Student_fa", "Student_pr", "Student_ex", "Student_te"),
        cases.format("CVLA", "CVFA", "CVPR", "CVFC", "CVTE"),
    )


_ROLE, _UNIT = _class("right(term, 2)", "partner")

_SHARED = f"""
courses AS (SELECT DISTINCT short_name, nrc, term FROM fx_courses),
students AS (SELECT * REPLACE ({_roster_id("student_id")} AS student_id, {_strip("term")} AS term,
  {_strip("section")} AS section, {_strip("crosslist")} AS crosslist) FROM fx_students),
teachers AS (SELECT * REPLACE ({_norm("teacher_id")} AS teacher_id, {_strip("term")} AS term,
  {_strip("section")} AS section, {_strip("crosslist")} AS crosslist) FROM fx_teachers),
users AS ({_first(f'''(SELECT row_no, {_norm("user_name")} AS user_name, {_clean("first_name")} AS first_name,
  {_clean("last_name")} AS last_name, {_strip(_clean("org_role_id"))} AS org_role_id,
  {_clean("org_defined_id")} AS org_defined_id, {_clean("external_email")} AS external_email FROM fx_users) u''',
  "user_name", "row_no")}),
lean_users AS (SELECT DISTINCT {_roster_id("user_name")} AS user_id FROM fx_users),
student_firsts AS ({_first("students", "term, section, student_id", _STUDENT_ORDER)}),
teacher_firsts AS ({_first("teachers", "term, section, teacher_id", _TEACHER_ORDER)}),
student_rows AS (SELECT s.* REPLACE ({_PARTNER.replace("partner", "s.partner")} AS partner), c.short_name, c.nrc
  FROM student_firsts s JOIN courses c ON s.term = left(c.term, 6) AND s.crosslist = c.nrc),
classed AS (SELECT student_id AS user_id, *, {_ROLE} AS role, {_UNIT} AS unit,
  student_id IN (SELECT user_id FROM lean_users) AS is_known FROM student_rows),
reasoned AS (SELECT *, CASE WHEN {_invalid("user_id")} THEN 'invalid_id' WHEN coalesce(status, '') <> 'Inscrito' THEN 'status'
  WHEN partner NOT IN ('BS', 'AP') THEN 'partner' WHEN partner = 'AP' AND paid <> 'Y' THEN 'unpaid'
  WHEN role IS NULL THEN 'unknown_programme' END AS skip_reason FROM classed),
teacher_rows AS (SELECT t.teacher_id AS user_id, t.*, c.short_name, c.nrc, u.user_name IS NOT NULL AS is_known,
  CASE u.org_role_id WHEN '150' THEN 'CVTE' WHEN '143' THEN 'CVLA' WHEN '138' THEN 'CVPR' WHEN '137' THEN 'CVFC'
    WHEN '136' THEN 'CVFA' WHEN '135' THEN 'CVFA' END AS former_unit
  FROM teacher_firsts t JOIN courses c ON t.term = c.term AND t.crosslist = c.nrc
  LEFT JOIN users u ON u.user_name = t.teacher_id),
bridge AS (SELECT term, crosslist, status, program_code, src_file AS first_file, row_no AS first_row FROM (
  SELECT *, row_number() OVER (PARTITION BY term, crosslist, status, program_code ORDER BY src_file, row_no) AS rk
  FROM fx_students WHERE lower(status) = 'inscrito') WHERE rk = 1),
centre_list AS (SELECT c.short_name, c.nrc, c.term, b.program_code, min((b.first_file, b.first_row)) AS seen
  FROM courses c JOIN bridge b ON b.term = c.term AND b.crosslist = c.nrc GROUP BY ALL),
centres AS (SELECT short_name, nrc, term, program_code, n_centres FROM (
  SELECT *, row_number() OVER (PARTITION BY short_name ORDER BY seen, program_code) AS rk,
    count(*) OVER (PARTITION BY short_name) AS n_centres FROM centre_list) WHERE rk = 1),
coordinators AS ({_first(f'''(SELECT row_no, {_clean("cost_centre")} AS cost_centre, {_norm("coordinator_id")} AS coordinator_id,
  {_clean("coordinator_name")} AS coordinator_name, {_clean("coordinator_email")} AS coordinator_email
  FROM fx_coordinators WHERE NOT {_invalid("coordinator_id")}) k WHERE cost_centre <> \'\'''', "cost_centre, coordinator_id", "row_no")}),
first_coordinators AS ({_first("coordinators", "cost_centre", "row_no")}),
found_coordinators AS (SELECT c.short_name, c.nrc, c.term, c.program_code, c.n_centres, k.coordinator_id,
  k.coordinator_name, k.coordinator_email
  FROM centres c JOIN first_coordinators k ON k.cost_centre = c.program_code),
resolved AS (SELECT f.*, f.coordinator_id AS user_id, u.user_name IS NOT NULL AS is_known,
  coalesce(nullif(u.org_defined_id, ''), f.coordinator_id) AS doc_label,
  coalesce(u.first_name, f.coordinator_name) AS first_name, coalesce(u.last_name, '') AS last_name,
  coalesce(u.external_email, f.coordinator_email) AS email
  FROM found_coordinators f LEFT JOIN users u ON u.user_name = f.coordinator_id),
links AS (SELECT row_no, link, nullif(regexp_extract({_trim("link")}, '/([0-9]{{4,6}})$', 1), '') AS course_id
  FROM fx_course_links WHERE link IS NOT NULL),
catalogue AS (SELECT nrc AS course_id, short_name FROM fx_courses),
registry AS (SELECT * FROM fx_courses WHERE right(left(term, 6), 2) IN ('10', '11', '20', '21')),
new_names AS (SELECT c.short_name, min(l.row_no) AS row_no FROM links l JOIN catalogue c USING (course_id)
  WHERE c.short_name NOT IN (SELECT short_name FROM registry) GROUP BY 1),
new_rows AS (SELECT short_name, string_split(short_name, '-')[-1] AS nrc, string_split(short_name, '-')[-2] AS term, row_no
  FROM new_names WHERE len(string_split(short_name, '-')) = 4)
"""

# Commands: each SELECT yields the person columns plus (step, verb, role, org_unit).

_PERSON = (
    "short_name, nrc, src_file, row_no, section, user_id, doc_no, doc_type, first_name, last_name, email"
)


def _steps(source: str, *steps: tuple[str, str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {_PERSON}, {step} AS step, {verb} AS verb, {role} AS role, {unit} AS org_unit FROM {source} WHERE {where}"
        for step, verb, role, unit, where in steps
    )


def _commands(steps: str, phase: int = 1, label: str | None = None, repeat_id: bool = False) -> str:
    """Turn steps into command rows with their text line."""
    person = "verb IN ('CREATE', 'UPDATE')"
    doc = label or _label("doc_type", "doc_no")
    first, last = (_title("first_name"), _title("last_name")) if label is None else ("first_name", "last_name")
    slot = "CASE WHEN verb = 'UNENROLL' THEN user_id ELSE '' END" if repeat_id else "''"
    return f"""
    SELECT *, CASE verb
        WHEN 'CREATE' THEN concat_ws(',', verb, user_id, doc_label, first_name, last_name, '', role, active, email)
        WHEN 'UPDATE' THEN concat_ws(',', verb, user_id, doc_label, first_name, last_name, '', active, email)
        WHEN 'ENROLL' THEN concat_ws(',', verb, user_id, '', role, org_unit)
        ELSE concat_ws(',', verb, user_id, doc_label, org_unit) END AS line
    FROM (SELECT short_name, nrc, CAST({phase} AS BIGINT) AS phase, src_file, row_no, section, CAST(step AS BIGINT) AS step, verb, user_id,
        CASE WHEN {person} THEN {doc} ELSE {slot} END AS doc_label,
        CASE WHEN {person} THEN coalesce({first}, '') ELSE '' END AS first_name,
        CASE WHEN {person} THEN coalesce({last}, '') ELSE '' END AS last_name,
        role, org_unit, CASE WHEN {person} THEN '1' ELSE '' END AS active,
        CASE WHEN {person} THEN coalesce(email, '') ELSE '' END AS email
      FROM ({steps}))"""


_ENROL_STEPS = (
    ("0", "CASE WHEN is_known THEN 'UPDATE' ELSE 'CREATE' END", "CASE WHEN is_known THEN '' ELSE role END", "''"),
    ("1", "'ENROLL'", "role", "CASE WHEN is_known THEN 'UPBV' ELSE unit END"),
    ("2", "'ENROLL'", "'Student'", "short_name"),
)
_LEAVE = ("0", "'UNENROLL'", "''", "short_name")


def _where(steps: tuple, where: str) -> tuple:
    return tuple((*s, where) for s in steps)


# The statuses that take a student out.
_LEFT = "coalesce(status IN ('Cancelado', 'Eliminado'), false)"
_VALID = f"NOT {_invalid('user_id')}"
_ENROL = _commands(_steps("reasoned", *_where(_ENROL_STEPS, "skip_reason IS NULL")))
_TEACH = _commands(
    _steps(
        "teacher_rows",
        ("0", "CASE WHEN is_known THEN 'UPDATE' ELSE 'CREATE' END", "CASE WHEN is_known THEN '' ELSE 'Moderador' END", "''", _VALID),
        ("1", "'UNENROLL'", "''", "former_unit", f"{_VALID} AND is_known AND former_unit IS NOT NULL"),
        ("CASE WHEN former_unit IS NULL THEN 1 ELSE 2 END", "'ENROLL'", "'Moderador'", "'UPBV'", f"{_VALID} AND is_known"),
        (
            "CASE WHEN NOT is_known THEN 1 WHEN former_unit IS NULL THEN 2 ELSE 3 END",
            "'ENROLL'",
            "'Moderador'",
            "short_name",
            _VALID,
        ),
    )
)
_COORDINATE = _commands(
    _steps(
        "(SELECT *, '' AS src_file, CAST(0 AS BIGINT) AS row_no, '' AS section, '' AS doc_no, '' AS doc_type FROM resolved) r",
        ("0", "'CREATE'", "'Coordinador'", "''", "NOT is_known"),
        ("CASE WHEN is_known THEN 0 ELSE 1 END", "'ENROLL'", "'Coordinador'", "short_name", "true"),
    ),
    phase=2,
    label="user_id",
)
_CODE = "((CAST(nrc AS BIGINT) // 10) % 5)"
_LEGACY_ROLE = f"CASE {_CODE} WHEN 1 THEN 'Student_fa' WHEN 2 THEN 'Student_pr' WHEN 3 THEN 'Student_ex' WHEN 4 THEN 'Student_ap' ELSE 'Student' END"
_LEGACY_UNIT = f"CASE {_CODE} WHEN 1 THEN 'CVFA' WHEN 2 THEN 'CVPR' WHEN 3 THEN 'CVFC' WHEN 4 THEN 'CVLA' ELSE '' END"
_LEGACY = _commands(
    _steps(
        "classed",
        *_where(
            (
                ("0", "'CREATE'", _LEGACY_ROLE, "''"),
                ("1", "'UPDATE'", "''", "''"),
                ("2", "'ENROLL'", _LEGACY_ROLE, "'UPBV'"),
                ("3", "'ENROLL'", _LEGACY_ROLE, _LEGACY_UNIT),
                ("4", "'ENROLL'", "'Student'", "short_name"),
            ),
            f"NOT {_LEFT} AND {_VALID}",
        ),
        (*_LEAVE, f"{_LEFT} AND {_VALID}"),
    ),
    repeat_id=True,
)
_STAFF = f"SELECT * FROM ({_TEACH}) UNION ALL SELECT * FROM ({_COORDINATE})"


def _counts(commands: str) -> str:
    return f"""SELECT c.short_name, c.nrc, coalesce(n, 0) AS n FROM courses c LEFT JOIN
    (SELECT short_name, count(*) AS n FROM ({commands}) WHERE step = 0 AND phase = 1 GROUP BY 1) USING (short_name)"""


_EXTRACT_COLUMNS = f"""term, section, crosslist, {_roster_id("student_id")} AS student_id, doc_type, doc_no, email,
  {_title("first_name")} AS first_name, {_title("last_name")} AS last_name, enrol_code, status, paid,
  {_trim("partner")} AS partner, {_stamp()} AS activity_at"""
_TEACHER_FILES = f"""SELECT term, section, crosslist, teacher_id, doc_type, doc_no, email,
  {_title("first_name")} AS first_name, {_title("last_name")} AS last_name, {_stamp()} AS activity_at FROM teachers"""
_CANDIDATES = """(SELECT unnest([short_name, short_name || '-x', replace(short_name, '-', ''), right(short_name, 14)]) AS candidate
  FROM fx_courses)"""
_MISSING = "doc_no IS NULL OR email IS NULL OR first_name IS NULL OR last_name IS NULL"

_QUERIES = {
    "scan_courses": "SELECT short_name, nrc, term FROM fx_courses",
    "distinct_courses": """SELECT short_name, nrc, term FROM fx_courses UNION ALL
      SELECT short_name, cast(cast(nrc AS BIGINT) + 1 AS VARCHAR), term FROM fx_courses WHERE cast(nrc AS BIGINT) % 13 = 0""",
    "conflicting_courses": """SELECT short_name, CAST(2 AS BIGINT) AS n FROM fx_courses WHERE cast(nrc AS BIGINT) % 13 = 0""",
    "spreadsheet_dates": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_linenumber % 5 < 4 THEN strftime(l_shipdate, '%Y-%m-%d') || CASE WHEN l_linenumber % 5 = 2 THEN ' 12:00:00' ELSE ' 00:00:00' END END AS activity_at
      FROM lineitem""",
    "sink_hot_course_list": f"""SELECT line, CAST(row_number() OVER (ORDER BY phase, src_file, row_no, section, user_id, step) AS BIGINT) AS place FROM ({_TEACH})""",
    "ingest_students": f"SELECT src_file, row_no, {_EXTRACT_COLUMNS} FROM fx_students",
    "ingest_teachers": f"""SELECT src_file, row_no, term, section, crosslist, teacher_id, doc_type, doc_no, email,
      {_title("first_name")} AS first_name, {_title("last_name")} AS last_name, {_stamp()} AS activity_at FROM teachers""",
    "scan_users": "SELECT * EXCLUDE (row_no) FROM users",
    "scan_coordinators": """SELECT cost_centre, coordinator_id, coordinator_name, coordinator_email, row_no
      FROM coordinators""",
    "extract_students": f"SELECT src_file AS extract, {_EXTRACT_COLUMNS} FROM fx_students WHERE src_file <> 'f1'",
    "incremental_students": f"SELECT src_file AS extract, {_EXTRACT_COLUMNS} FROM fx_students",
    "stream_landed_roster": f"SELECT {_EXTRACT_COLUMNS} FROM fx_students WHERE src_file <> 'f1'",
    "landed_since": f"""SELECT src_file, row_no, section, crosslist, student_id, {_stamp()} AS activity_at FROM students
      WHERE activity_ts >= TIMESTAMP '1995-06-17 00:00:00'""",
    "extract_json": _TEACHER_FILES,
    "extract_teachers": _TEACHER_FILES,
    "extract_users": "SELECT * EXCLUDE (row_no) FROM users",
    "extract_coordinators": "SELECT cost_centre, coordinator_id, coordinator_name, coordinator_email FROM fx_coordinators",
    "extract_courses": "SELECT short_name, nrc, term FROM fx_courses",
    "extract_links": "SELECT link, course_id FROM links",
    "reduced_course_match": """SELECT short_name, nrc, term, src_file, row_no, section, crosslist, student_id, status
      FROM student_rows WHERE cast(nrc AS BIGINT) % 10 = 0""",
    "course_list_order": f"""SELECT line, CAST(row_number() OVER (ORDER BY cast(nrc AS BIGINT) DESC, phase, src_file, row_no, section, user_id, step)
      AS BIGINT) AS place FROM ({_STAFF})""",
    "registry_link_order": """SELECT short_name, nrc, term, CAST(row_number() OVER (ORDER BY block, seq, short_name) AS BIGINT) AS place FROM (
      SELECT short_name, nrc, term, 0 AS block, -cast(nrc AS BIGINT) AS seq FROM registry
      UNION ALL SELECT short_name, nrc, term, 1, row_no FROM new_rows)""",
    "job_student": f"SELECT line FROM ({_ENROL})",
    "job_staff": f"SELECT line FROM ({_STAFF})",
    "job_registry": """SELECT short_name, nrc, term FROM registry UNION ALL SELECT short_name, nrc, term FROM new_rows""",
    "rejected_files": """SELECT DISTINCT src_file AS extract, 'missing_columns' AS reason, 'PAGO' AS missing
      FROM fx_students WHERE src_file = 'f1'""",
    "header_normalise": "SELECT src_file, row_no, student_id FROM fx_students",
    "id_pad": f"""SELECT src_file, row_no, section, crosslist, student_id, {_roster_id("student_id")} AS padded
      FROM fx_students""",
    "id_normalise": f"""SELECT src_file, row_no, section, crosslist, email, {_norm("teacher_id")} AS normalised,
      {_norm("(chr(9) || 'X' || teacher_id || ' ')")} AS lettered FROM fx_teachers""",
    "text_clean": f"""SELECT src_file, row_no, section, crosslist,
      {_clean("(chr(9) || first_name || chr(160) || chr(10))")} AS clean_name, {_clean("doc_type")} AS clean_type FROM fx_students""",
    "title_case": f"""SELECT src_file, row_no, section, crosslist, {_title("first_name")} AS first_title,
      {_title("last_name")} AS last_title, {_title("(first_name || '/' || upper(last_name))")} AS both_title FROM fx_students""",
    "doc_label": f"""SELECT src_file, row_no, section, crosslist, {_number("doc_no")} AS number,
      {_label("doc_type", "doc_no")} AS label,
      {_label("doc_type", "(CASE WHEN doc_type = 'TI' THEN doc_no END)")} AS label_or_empty FROM fx_students""",
    "activity_since": f"""SELECT src_file, row_no, section, crosslist, student_id, {_stamp()} AS activity_at FROM fx_students
      WHERE partner IS NOT NULL AND activity_ts >= TIMESTAMP '1995-06-17 00:00:00'""",
    "programme_class": f"""SELECT short_name, term, partner, {_ROLE} AS role, {_UNIT} AS org_unit FROM (
      SELECT short_name, left(term, 6) AS term, unnest(['AP', 'BS', 'ZZ', 'BS', 'BS']) AS partner FROM fx_courses)""",
    "student_eligibility": """SELECT short_name, src_file, row_no, section, crosslist, user_id, status, partner, paid,
      skip_reason FROM reasoned""",
    "invalid_teacher_ids": f"""SELECT src_file, row_no, section, crosslist, teacher_id, doc_no FROM fx_teachers
      WHERE {_invalid("teacher_id")}""",
    "dedupe_students": f"""SELECT term, src_file, row_no, section, crosslist, student_id, status, paid, {_stamp()} AS activity_at
      FROM student_firsts""",
    "dedupe_teachers": f"""SELECT term, src_file, row_no, section, crosslist, teacher_id, doc_no, {_stamp()} AS activity_at
      FROM teacher_firsts""",
    "course_roster_match": """SELECT short_name, nrc, term, src_file, row_no, section, crosslist, student_id, status
      FROM student_rows""",
    "teacher_roster_match": """SELECT short_name, nrc, term, src_file, row_no, section, crosslist, teacher_id, doc_no
      FROM teacher_rows""",
    "known_users": """SELECT DISTINCT student_id AS user_id, email FROM students s
      WHERE EXISTS (SELECT 1 FROM lean_users u WHERE u.user_id = s.student_id)""",
    "new_users": """SELECT DISTINCT student_id AS user_id, email FROM students s
      WHERE NOT EXISTS (SELECT 1 FROM lean_users u WHERE u.user_id = s.student_id)""",
    "student_enrol_commands": _ENROL,
    "student_drop_commands": _commands(_steps("classed", (*_LEAVE, f"status = 'Cancelado' AND {_VALID}"))),
    "student_cleanup_commands": _commands(_steps("classed", (*_LEAVE, f"status = 'Eliminado' AND {_VALID}"))),
    "mixed_commands": _commands(
        _steps(
            "classed",
            *_where(_ENROL_STEPS, f"NOT {_LEFT} AND role IS NOT NULL AND {_VALID}"),
            (*_LEAVE, f"{_LEFT} AND {_VALID}"),
        )
    ),
    "legacy_enrol_commands": _LEGACY,
    "teacher_commands": _TEACH,
    "coordinator_commands": _COORDINATE,
    "consolidated_commands": f"{_STAFF} ORDER BY short_name, phase, src_file, row_no, section, user_id, step",
    "create_once_commands": f"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, verb
      ORDER BY short_name, phase, src_file, row_no, section, step) AS rk FROM ({_ENROL})) WHERE verb <> 'CREATE' OR rk = 1""",
    "cost_centre_bridge": "SELECT * FROM bridge",
    "course_cost_centre": "SELECT * FROM centres",
    "multi_centre_courses": """SELECT l.short_name, l.program_code, c.program_code AS chosen, c.n_centres
      FROM centre_list l JOIN centres c USING (short_name) WHERE c.n_centres > 1""",
    "course_coordinator": "SELECT * FROM found_coordinators",
    "coordinator_details": """SELECT short_name, program_code, user_id, is_known, doc_label, first_name, last_name, email
      FROM resolved""",
    "student_course_counts": _counts(_ENROL),
    "teacher_course_counts": _counts(_TEACH),
    "load_profile": """SELECT 'courses' AS table_name, count(*) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM fx_courses
      UNION ALL SELECT 'students', count(*), 17 FROM fx_students UNION ALL SELECT 'users', count(*), 7 FROM fx_users
      UNION ALL SELECT 'teachers', count(*), 12 FROM fx_teachers
      UNION ALL SELECT 'coordinators', count(*), 5 FROM fx_coordinators
      UNION ALL SELECT 'course_links', count(*), 2 FROM fx_course_links""",
    "audit_events": f"""SELECT job, event, count(*) AS n_events, count(DISTINCT short_name) AS n_courses FROM (
      SELECT 'student' AS job, short_name, skip_reason AS event FROM reasoned WHERE skip_reason <> 'status'
      UNION ALL SELECT 'student', short_name, 'missing_field' FROM reasoned WHERE skip_reason IS NULL AND ({_MISSING})
      UNION ALL SELECT 'student', short_name, 'course_total' FROM courses
      UNION ALL SELECT 'teacher', short_name, 'invalid_id' FROM teacher_rows WHERE NOT ({_VALID})
      UNION ALL SELECT 'teacher', short_name, 'missing_field' FROM teacher_rows WHERE {_VALID} AND ({_MISSING})
      UNION ALL SELECT 'teacher', short_name, 'course_total' FROM courses
      UNION ALL SELECT 'teacher', short_name, 'no_centre' FROM courses WHERE short_name NOT IN (SELECT short_name FROM centres)
      UNION ALL SELECT 'teacher', short_name, 'many_centres' FROM centres WHERE n_centres > 1
      UNION ALL SELECT 'teacher', short_name, 'no_coordinator' FROM centres
        WHERE short_name NOT IN (SELECT short_name FROM resolved)
      UNION ALL SELECT 'teacher', short_name, 'coordinator_ok' FROM resolved) GROUP BY ALL""",
    "course_link_ids": """SELECT row_no, link, course_id,
      'https://lms.example.org/course_offering?ou=' || course_id AS detail FROM links""",
    "course_link_ids_legacy": f"""SELECT row_no,
      CASE WHEN regexp_full_match(right(link, 5), '[0-9]+') THEN right(link, 5) ELSE right(link, 4) END AS of_link,
      CASE WHEN regexp_full_match(right(t, 5), '[0-9]+') THEN right(t, 5) ELSE right(t, 4) END AS of_trimmed
      FROM (SELECT *, {_trim("link")} AS t FROM fx_course_links WHERE link IS NOT NULL)""",
    "link_errors": """SELECT 'N/A' AS course_id, link AS url, 'no_course_id' AS error FROM links WHERE course_id IS NULL
      UNION ALL SELECT course_id, 'https://lms.example.org/course_offering?ou=' || course_id, 'not_in_catalogue' FROM links
      WHERE course_id IS NOT NULL AND course_id NOT IN (SELECT course_id FROM catalogue)""",
    "short_name_parse": f"""SELECT candidate, CASE WHEN len(p) = 4 THEN p[-1] END AS nrc, CASE WHEN len(p) = 4 THEN p[-2] END AS term
      FROM (SELECT candidate, string_split(candidate, '-') AS p FROM {_CANDIDATES})""",
    "short_name_parse_legacy": f"""SELECT candidate,
      coalesce(nullif(regexp_extract({_trim("candidate")}, '-([^-]{{1,5}})$', 1), ''), 'N/A') AS number,
      right(candidate, 5) AS oldest FROM {_CANDIDATES}""",
    "registry_new": "SELECT * FROM new_rows",
    "registry_merged": """SELECT short_name, nrc, term FROM registry UNION ALL SELECT short_name, nrc, term FROM new_rows""",
    "sink_course_lists": f"SELECT line, short_name FROM ({_STAFF})",
    "sink_consolidated": f"SELECT line FROM ({_ENROL})",
    "sink_course_counts": _counts(_TEACH),
    "sink_registry": """SELECT short_name, nrc, term FROM registry UNION ALL SELECT short_name, nrc, term FROM new_rows""",
    "sink_landed_roster": """SELECT term, crosslist, status, count(*) AS n_rows, CAST(sum(row_no) AS BIGINT) AS row_sum
      FROM fx_students GROUP BY ALL""",
}

ORACLES = {name: f"WITH {VIEWS_SQL.strip()},{_SHARED}{sql}" for name, sql in _QUERIES.items()}
