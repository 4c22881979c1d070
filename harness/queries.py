"""One query per operator, over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harness import views as fx
from rosterflow import functions as rf
from rosterflow import schemas, sinks, sources, streaming
from rosterflow.operators import audit, centres, commands, counts, programme, registry, roster, users
from rosterflow.params import JobParams, Process
from rosterflow.plans import enrolment, run_registry_job, run_staff_job, run_student_job
from rosterflow.session import fresh_dir
from rosterflow.sources import ingest_students as ingest_student_files
from rosterflow.sources import normalise_headers as normalise
from rosterflow.sources.tables import PROGRAM_CODE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SINCE = dt.date(1995, 6, 17)
KEYS = ("src_file", "row_no", "section", "crosslist")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _stamp(c: str = "activity_ts") -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("activity_at")


def _listed(cmds: DataFrame) -> DataFrame:
    return cmds.select("*", commands.render_line().alias("line"))


# Sources


@query
def scan_courses(spark, sf):
    return fx.courses(spark, sf).select(*schemas.COURSE_COLUMNS)


def _listed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The course list with every seventh course repeated, and every thirteenth under a second number."""
    listed, nrc = fx.courses(spark, sf), F.col("nrc").cast("bigint")
    again = listed.where(nrc % 7 == 0)
    other = listed.where(nrc % 13 == 0).withColumn("nrc", (nrc + 1).cast("string"))
    return listed.unionByName(again).unionByName(other)


@query
def distinct_courses(spark, sf):
    return roster.distinct_courses(_listed_twice(spark, sf))


@query
def conflicting_courses(spark, sf):
    return roster.conflicting_courses(_listed_twice(spark, sf))


def _roster_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.select(*schemas.LINEAGE, *[c for c in columns if c != "activity_ts"], _stamp())


@query
def ingest_students(spark, sf):
    return _roster_columns(roster.clean_students(fx.students(spark, sf)), schemas.STUDENT_COLUMNS)


@query
def ingest_teachers(spark, sf):
    return _roster_columns(roster.clean_teachers(fx.teachers(spark, sf)), schemas.TEACHER_COLUMNS)


@query
def scan_users(spark, sf):
    return users.clean_users(fx.users(spark, sf))


@query
def scan_coordinators(spark, sf):
    return centres.clean_coordinators(fx.coordinators(spark, sf))


def _student_extracts(spark: SparkSession, sf: str) -> str:
    """Student files as the registrar would send them; those of ``f1`` lack a column."""
    folder = fresh_dir(spark, "extracts")
    headers = {ours: theirs for theirs, ours in schemas.STUDENT_HEADERS.items()}
    rows = fx.students(spark, sf).withColumn("activity_ts", _stamp())
    named = rows.select("src_file", *[F.col(c).alias(h) for c, h in headers.items()])
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    short = F.col("src_file") == "f1"
    named.where(~short).write.options(**options).partitionBy("src_file").csv(f"{folder}/whole")
    named.where(short).drop("PAGO").write.options(**options).partitionBy("src_file").csv(f"{folder}/short")
    return folder


def _extract_name(c: str) -> Column:
    return F.regexp_extract(c, "/src_file=(f[0-9])/[^/]*$", 1)


@query
def extract_students(spark, sf):
    rows = ingest_student_files(spark, _student_extracts(spark, sf)).rows
    columns = [c for c in schemas.STUDENT_COLUMNS if c != "activity_ts"]
    return rows.select(_extract_name("src_file").alias("extract"), *columns, _stamp())


@query
def rejected_files(spark, sf):
    rejected = ingest_student_files(spark, _student_extracts(spark, sf)).rejected
    return rejected.select(
        _extract_name("src_file").alias("extract"), "reason", F.array_join("missing", " ").alias("missing")
    ).distinct()


def _written(df: DataFrame, names: dict[str, str], file_format: str, compression: str = "none") -> str:
    """A folder of extract files of ``df`` under the registrar's headers, in several files; JSON, which repeats each key, is gzipped, CSV if asked."""
    folder = fresh_dir(df.sparkSession, "extracts")
    ours = {ours: theirs for theirs, ours in names.items()}
    named = df.select(*[F.col(c).alias(h) for c, h in ours.items()])
    csv = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": compression}
    options = {"csv": csv, "json": {"compression": "gzip"}}.get(file_format, {})
    named.write.options(**options).format(file_format).save(folder)
    return folder


def _raw(df: DataFrame) -> DataFrame:
    return df.withColumn("activity_ts", _stamp())


@query
def extract_json(spark, sf):
    """Teachers from JSON lines, which leave null keys out."""
    folder = _written(_raw(fx.teachers(spark, sf)), schemas.TEACHER_HEADERS, "json")
    rows = sources.ingest_teachers(spark, folder, file_format="json").rows
    return rows.select(*[c for c in schemas.TEACHER_COLUMNS if c != "activity_ts"], _stamp())


@query
def extract_teachers(spark, sf):
    folder = _written(_raw(fx.teachers(spark, sf)), schemas.TEACHER_HEADERS, "parquet")
    rows = sources.ingest_teachers(spark, folder, file_format="parquet").rows
    return rows.select(*[c for c in schemas.TEACHER_COLUMNS if c != "activity_ts"], _stamp())


@query
def extract_users(spark, sf):
    """The first row of each user is that of the file, so repeated users come from a file of one task."""
    folder = _written(fx.users(spark, sf).orderBy("row_no").coalesce(1), schemas.USER_HEADERS, "csv")
    return users.clean_users(sources.read_users(spark, folder))


@query
def extract_coordinators(spark, sf):
    names = {**schemas.COORDINATOR_HEADERS, **schemas.COORDINATOR_OPTIONAL_HEADERS}
    folder = _written(fx.coordinators(spark, sf), names, "csv")
    return sources.read_coordinators(spark, folder).select(*schemas.COORDINATOR_COLUMNS)


@query
def extract_courses(spark, sf):
    folder = _written(fx.courses(spark, sf), {"Nombre": "short_name", "NRC": "nrc", "Periodo": "term"}, "csv")
    return sources.read_courses(spark, folder).select(*schemas.COURSE_COLUMNS)


@query
def extract_links(spark, sf):
    folder = _written(fx.course_links(spark, sf), {schemas.LINK_HEADER: "link"}, "csv")
    return registry.link_ids(sources.read_links(spark, folder)).select("link", "course_id")


@query
def incremental_students(spark, sf):
    """Student files landed in two runs: files of ``f2`` arrive between them, and a third run finds nothing."""
    folder, base = fresh_dir(spark, "arriving"), fresh_dir(spark, "landed-files")
    headers = {ours: theirs for theirs, ours in schemas.STUDENT_HEADERS.items()}
    rows = fx.students(spark, sf).withColumn("activity_ts", _stamp())
    named = rows.select("src_file", *[F.col(c).alias(h) for c, h in headers.items()])
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for late in (False, True):
        part = named.where((F.col("src_file") == "f2") == F.lit(late))
        part.write.options(**options).mode("append").partitionBy("src_file").csv(folder)
        sources.land_new(spark, folder, base, schemas.STUDENT_HEADERS)
    if sources.land_new(spark, folder, base, schemas.STUDENT_HEADERS).batch:
        raise AssertionError("the third run found new files")
    landed = roster.clean_students(sources.read_rows(spark, base))
    return landed.select(_extract_name("src_file").alias("extract"), *[c for c in schemas.STUDENT_COLUMNS if c != "activity_ts"], _stamp())


@query
def header_normalise(spark, sf):
    spaced = fx.students(spark, sf).select(
        F.col("src_file").alias(" src file"),
        F.col("row_no").alias("row no "),
        F.col("student_id").alias(" student id "),
    )
    return normalise(spaced)


# Scalar functions


@query
def id_pad(spark, sf):
    rows = fx.students(spark, sf)
    return rows.select(*KEYS, "student_id", rf.roster_id(F.col("student_id")).alias("padded"))


@query
def id_normalise(spark, sf):
    rows = fx.teachers(spark, sf)
    teacher = F.col("teacher_id")
    return rows.select(
        *KEYS,
        "email",
        rf.normalise_id(teacher).alias("normalised"),
        rf.normalise_id(F.concat(F.lit("\tX"), teacher, F.lit(" "))).alias("lettered"),
    )


@query
def text_clean(spark, sf):
    rows = fx.students(spark, sf)
    padded = F.concat(F.lit("\t"), F.col("first_name"), F.lit(" \n"))
    return rows.select(
        *KEYS, rf.clean_text(padded).alias("clean_name"), rf.clean_text(F.col("doc_type")).alias("clean_type")
    )


@query
def title_case(spark, sf):
    rows = fx.students(spark, sf)
    both = F.concat(F.col("first_name"), F.lit("/"), F.upper("last_name"))
    return rows.select(
        *KEYS,
        rf.title_case(F.col("first_name")).alias("first_title"),
        rf.title_case(F.col("last_name")).alias("last_title"),
        rf.title_case(both).alias("both_title"),
    )


@query
def doc_label(spark, sf):
    rows = fx.students(spark, sf)
    number, kind = F.col("doc_no"), F.col("doc_type")
    return rows.select(
        *KEYS,
        rf.doc_number(number).alias("number"),
        rf.doc_label(kind, number).alias("label"),
        rf.doc_label(kind, F.when(kind == "TI", number)).alias("label_or_empty"),
    )


@query
def activity_since(spark, sf):
    text = F.when(F.col("partner").isNull(), "sin fecha").otherwise(_stamp())
    rows = fx.students(spark, sf).withColumn("activity_ts", rf.parse_activity(text))
    return rows.where(rf.active_since(F.col("activity_ts"), SINCE)).select(*KEYS, "student_id", _stamp())


@query
def spreadsheet_dates(spark, sf):
    """Ship dates as ISO text, day-first text, day counts with and without a fraction, and rubbish."""
    rows, date = fx.table(spark, sf, "lineitem"), F.col("l_shipdate")
    days = F.datediff(date, F.lit("1899-12-30"))
    texts = [
        F.date_format(date, "yyyy-MM-dd"),
        F.date_format(date, "dd/MM/yyyy"),
        F.concat(days.cast("string"), F.lit(".5")),
        days.cast("string"),
        F.lit("soon"),
    ]
    text = F.element_at(F.array(*texts), (F.col("l_linenumber") % 5 + 1).cast("int"))
    read = rf.parse_activity(text, ("dd/MM/yyyy",))
    stamp = F.date_format(read, "yyyy-MM-dd HH:mm:ss").alias("activity_at")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", stamp)


@query
def programme_class(spark, sf):
    partners = F.array(*[F.lit(p).cast("string") for p in ("AP", "BS", "ZZ", "nan", None)])
    term = F.col("term")
    rows = fx.courses(spark, sf).select(
        "short_name",
        rf.cut_term(term).alias("term"),
        rf.programme_suffix(term).alias("suffix"),
        F.explode(partners).alias("partner"),
    )
    defaulted = rows.withColumn("partner", programme.partner_or_home(F.col("partner")))
    return programme.with_programme_class(defaulted).drop("suffix")


@query
def student_eligibility(spark, sf):
    rows = enrolment.matched_students(fx.courses(spark, sf), fx.students(spark, sf))
    return rows.select("short_name", *KEYS, "user_id", "status", "partner", "paid", "skip_reason")


@query
def invalid_teacher_ids(spark, sf):
    rows = fx.teachers(spark, sf).where(rf.is_invalid_id(F.col("teacher_id")))
    return rows.select(*KEYS, "teacher_id", "doc_no")


# Deduplication and joins


@query
def dedupe_students(spark, sf):
    rows = roster.dedupe_students(roster.student_keys(fx.students(spark, sf)))
    return rows.select("term", *KEYS, "student_id", "status", "paid", _stamp())


@query
def dedupe_teachers(spark, sf):
    rows = roster.dedupe_teachers(roster.teacher_keys(fx.teachers(spark, sf)))
    return rows.select("term", *KEYS, "teacher_id", "doc_no", _stamp())


@query
def course_roster_match(spark, sf):
    deduped = roster.dedupe_students(roster.student_keys(fx.students(spark, sf)))
    rows = roster.match_courses(fx.courses(spark, sf), deduped, cut=True)
    return rows.select("short_name", "nrc", "term", *KEYS, "student_id", "status")


@query
def reduced_course_match(spark, sf):
    """A tenth of the courses: only rows of their sections are sorted."""
    some = fx.courses(spark, sf).where(F.col("nrc").cast("bigint") % 10 == 0)
    rows = enrolment.matched_students(some, fx.students(spark, sf), reduce=True)
    return rows.select("short_name", "nrc", "term", *KEYS, F.col("user_id").alias("student_id"), "status")


@query
def teacher_roster_match(spark, sf):
    deduped = roster.dedupe_teachers(roster.teacher_keys(fx.teachers(spark, sf)))
    rows = roster.match_courses(fx.courses(spark, sf), deduped, cut=False)
    return rows.select("short_name", "nrc", "term", *KEYS, "teacher_id", "doc_no")


def _people(spark: SparkSession, sf: str) -> DataFrame:
    return roster.student_keys(fx.students(spark, sf)).select(F.col("student_id").alias("user_id"), "email").distinct()


@query
def known_users(spark, sf):
    return users.known_users(_people(spark, sf), users.user_ids(fx.users(spark, sf)))


@query
def new_users(spark, sf):
    return users.new_users(_people(spark, sf), users.user_ids(fx.users(spark, sf)))


# Commands


def _student_commands(spark: SparkSession, sf: str, process: Process = Process.ENROL) -> DataFrame:
    return enrolment.student_commands(
        fx.courses(spark, sf), fx.students(spark, sf), fx.users(spark, sf), process
    )


@query
def student_enrol_commands(spark, sf):
    return _listed(_student_commands(spark, sf))


@query
def student_drop_commands(spark, sf):
    return _listed(_student_commands(spark, sf, Process.DROP))


@query
def student_cleanup_commands(spark, sf):
    return _listed(_student_commands(spark, sf, Process.CLEAN_UP))


@query
def mixed_commands(spark, sf):
    return _listed(_student_commands(spark, sf, Process.MIXED))


def _class_code() -> Column:
    """A class chosen per course: the tens digit of its number, modulo five."""
    return ((F.col("nrc").cast("bigint") / 10).cast("bigint") % 5).cast("string")


@query
def legacy_enrol_commands(spark, sf):
    return _listed(
        enrolment.legacy_student_commands(fx.courses(spark, sf), fx.students(spark, sf), _class_code())
    )


@query
def teacher_commands(spark, sf):
    return _listed(
        enrolment.teacher_commands(fx.courses(spark, sf), fx.teachers(spark, sf), fx.users(spark, sf))
    )


@query
def coordinator_commands(spark, sf):
    return _listed(
        enrolment.coordinator_commands(
            fx.courses(spark, sf), fx.students(spark, sf), fx.coordinators(spark, sf), fx.users(spark, sf)
        )
    )


def _staff_commands(
    spark: SparkSession, sf: str, arrange: Callable[[DataFrame], DataFrame] | None = None, courses: DataFrame | None = None
) -> DataFrame:
    return enrolment.staff_commands(
        courses or fx.courses(spark, sf),
        fx.teachers(spark, sf),
        fx.students(spark, sf),
        fx.coordinators(spark, sf),
        fx.users(spark, sf),
        arrange=arrange,
    )


@query
def consolidated_commands(spark, sf):
    return _listed(_staff_commands(spark, sf, sinks.arranged))


@query
def create_once_commands(spark, sf):
    return _listed(commands.dedupe_create(_student_commands(spark, sf)))


# Cost centres and coordinators


@query
def cost_centre_bridge(spark, sf):
    return centres.cost_centre_bridge(fx.students(spark, sf))


def _course_centres(spark: SparkSession, sf: str) -> DataFrame:
    return centres.course_cost_centre(
        fx.courses(spark, sf), centres.cost_centre_bridge(fx.students(spark, sf))
    )


@query
def course_cost_centre(spark, sf):
    return _course_centres(spark, sf)


@query
def multi_centre_courses(spark, sf):
    listed = centres.course_centre_list(
        fx.courses(spark, sf), centres.cost_centre_bridge(fx.students(spark, sf))
    ).select("short_name", "program_code")
    chosen = _course_centres(spark, sf).where("n_centres > 1")
    chosen = chosen.select("short_name", F.col("program_code").alias("chosen"), "n_centres")
    return listed.join(chosen, "short_name")


@query
def course_coordinator(spark, sf):
    return centres.course_coordinator(
        _course_centres(spark, sf), centres.clean_coordinators(fx.coordinators(spark, sf))
    )


@query
def coordinator_details(spark, sf):
    found = centres.resolve_coordinators(
        fx.courses(spark, sf), fx.students(spark, sf), fx.coordinators(spark, sf), fx.users(spark, sf)
    )
    return found.select(
        "short_name", "program_code", "user_id", "is_known", "doc_label", "first_name", "last_name", "email"
    )


# Counts and audit


@query
def student_course_counts(spark, sf):
    return counts.course_counts(fx.courses(spark, sf), _student_commands(spark, sf))


@query
def teacher_course_counts(spark, sf):
    cmds = enrolment.teacher_commands(fx.courses(spark, sf), fx.teachers(spark, sf), fx.users(spark, sf))
    return counts.course_counts(fx.courses(spark, sf), cmds)


@query
def load_profile(spark, sf):
    return counts.load_profile(
        {
            "courses": fx.courses(spark, sf),
            "students": fx.students(spark, sf),
            "users": fx.users(spark, sf),
            "teachers": fx.teachers(spark, sf),
            "coordinators": fx.coordinators(spark, sf),
            "course_links": fx.course_links(spark, sf),
        }
    )


@query
def audit_events(spark, sf):
    """Matched rows, centres and coordinators are landed once, as the jobs do; all events read them."""
    courses, people, folder = fx.courses(spark, sf), fx.users(spark, sf), fresh_dir(spark, "audit")

    def landed(name: str, rows: DataFrame) -> DataFrame:
        return sinks.write_table(rows, f"{folder}/{name}")

    matched = enrolment.matched_students(courses, fx.students(spark, sf), person=programme.may_yield(Process.ENROL))
    student_rows = landed("student_rows", matched.where(programme.logged(Process.ENROL)))
    teacher_rows = landed("teacher_rows", enrolment.matched_teachers(courses, fx.teachers(spark, sf)))
    course_centres = landed("course_centres", _course_centres(spark, sf))
    found = centres.course_coordinator(course_centres, centres.clean_coordinators(fx.coordinators(spark, sf)))
    resolved = landed("resolved", centres.with_user_details(found, users.clean_users(people)))
    of_students = audit.student_audit(
        courses, student_rows, enrolment.commands_of_students(student_rows, people)
    )
    of_teachers = audit.teacher_audit(
        courses,
        teacher_rows,
        enrolment.commands_of_teachers(teacher_rows, people),
        course_centres,
        resolved,
    )
    events = of_students.select(F.lit("student").alias("job"), "*").unionByName(
        of_teachers.select(F.lit("teacher").alias("job"), "*")
    )
    return events.groupBy("job", "event").agg(
        F.count("*").alias("n_events"), F.count_distinct("short_name").alias("n_courses")
    )


# Course registry


@query
def course_link_ids(spark, sf):
    rows = registry.link_ids(fx.course_links(spark, sf))
    return rows.select("row_no", "link", "course_id", rf.detail_link(F.col("course_id")).alias("detail"))


@query
def course_link_ids_legacy(spark, sf):
    rows = fx.course_links(spark, sf).where("link IS NOT NULL")
    link = F.col("link")
    return rows.select(
        "row_no",
        rf.legacy_course_id(link).alias("of_link"),
        rf.legacy_course_id(rf.trim_all(link)).alias("of_trimmed"),
    )


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return fx.courses(spark, sf).select(F.col("nrc").alias("course_id"), "short_name")


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    """The undergraduate courses are those registered already."""
    suffix = rf.programme_suffix(F.col("term"))
    return fx.courses(spark, sf).where(suffix.isin("10", "11", "20", "21"))


@query
def link_errors(spark, sf):
    return registry.link_errors(fx.course_links(spark, sf), _catalogue(spark, sf))


def _candidates() -> Column:
    name = F.col("short_name")
    return F.explode(
        F.array(name, F.concat(name, F.lit("-x")), F.replace(name, F.lit("-"), F.lit("")), F.right(name, F.lit(14)))
    ).alias("candidate")


@query
def short_name_parse(spark, sf):
    rows = fx.courses(spark, sf).select(_candidates())
    parts = rows.withColumn("_p", rf.short_name_parts(F.col("candidate")))
    return parts.select("candidate", F.col("_p.nrc").alias("nrc"), F.col("_p.term").alias("term"))


@query
def short_name_parse_legacy(spark, sf):
    rows = fx.courses(spark, sf).select(_candidates())
    name = F.col("candidate")
    return rows.select(
        "candidate", rf.legacy_number(name).alias("number"), rf.oldest_number(name).alias("oldest")
    )


@query
def registry_new(spark, sf):
    return registry.new_courses(fx.course_links(spark, sf), _catalogue(spark, sf), _registry(spark, sf))


@query
def registry_merged(spark, sf):
    return registry.merged_registry(_registry(spark, sf), registry_new(spark, sf))


# Sinks: written to the shared folder and read back


@query
def sink_course_lists(spark, sf):
    folder = fresh_dir(spark, "lists")
    sinks.write_course_lists(_staff_commands(spark, sf, sinks.arranged), folder, dealt=True, compression="gzip")
    return sinks.read_course_lists(spark, folder)


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a folder with their place when part files are read by name."""
    lines = spark.read.text(folder).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    sizes = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    # a row for each split that a task reads, so that the lines themselves are not shuffled
    starts = F.broadcast(sizes.select("file", "start", "first", before.alias("before")))
    placed = lines.join(starts, ["file", "start"])
    return placed.select("line", (F.col("before") + F.col("at") - F.col("first") + 1).alias("place"))


@query
def sink_hot_course_list(spark, sf):
    """All teachers as the list of one course: the place of each line when part files are read by name."""
    folder = fresh_dir(spark, "lists")
    keys = [c for c in schemas.LIST_ORDER if c != "step"]
    cmds = enrolment.teacher_commands(
        fx.courses(spark, sf),
        fx.teachers(spark, sf),
        fx.users(spark, sf),
        arrange=lambda rows: rows.repartitionByRange(*keys),
    )
    hot = cmds.withColumn("short_name", F.lit("hot")).withColumn("nrc", F.lit("0"))
    # in one list a person's rows of several terms may be alike in the whole order: their lines take turns step by step
    sinks.write_course_lists(hot.sortWithinPartitions(*schemas.COMMAND_ORDER), folder, dealt=True, compression="gzip")
    return _placed(spark, folder)


def _listed_backwards(courses: DataFrame) -> DataFrame:
    """A course list from the greatest number to the least."""
    return courses.withColumns({"src_file": F.lit("list"), "row_no": -F.col("nrc").cast("bigint")})


@query
def course_list_order(spark, sf):
    """Lists follow each other as the course list has them."""
    folder, listed = fresh_dir(spark, "consolidated"), _listed_backwards(fx.courses(spark, sf))
    cmds = _staff_commands(spark, sf, lambda rows: sinks.arranged(rows, listed), roster.placed_courses(listed))
    sinks.write_consolidated(cmds, folder, courses=listed, dealt=True, compression="gzip")
    return _placed(spark, folder)


@query
def registry_link_order(spark, sf):
    """The written registry: known courses in their order, then new ones in that of the links."""
    base = fresh_dir(spark, "registry")
    known = _listed_backwards(_registry(spark, sf))
    sinks.commit_registry(known.orderBy("row_no").select(*schemas.COURSE_COLUMNS), base)
    first = sources.read_registry(spark, base)
    sinks.commit_registry(registry.ordered_registry(first, registry_new(spark, sf)), base)
    rows = sources.read_registry(spark, base)
    return rows.select(*schemas.COURSE_COLUMNS, F.row_number().over(Window.orderBy("src_file", "row_no")).cast("bigint").alias("place"))


@query
def sink_consolidated(spark, sf):
    folder = fresh_dir(spark, "consolidated")
    sinks.write_consolidated(_student_commands(spark, sf), folder)
    return spark.read.text(folder).withColumnRenamed("value", "line")


@query
def sink_course_counts(spark, sf):
    folder = fresh_dir(spark, "counts")
    sinks.write_course_counts(teacher_course_counts(spark, sf), folder)
    return spark.read.schema("short_name string, nrc string, n bigint").csv(folder)


@query
def sink_registry(spark, sf):
    folder = fresh_dir(spark, "registry")
    sinks.write_registry(registry_merged(spark, sf), folder)
    return spark.read.schema("short_name string, nrc string, term string").option("header", True).csv(folder)


@query
def sink_landed_roster(spark, sf):
    folder = fresh_dir(spark, "landed")
    sinks.land_roster(fx.students(spark, sf), folder)
    rows = spark.read.schema(fx.students(spark, sf).schema).parquet(folder)
    return rows.groupBy("term", "crosslist", "status").agg(F.count("*").alias("n_rows"), F.sum("row_no").alias("row_sum"))


@query
def landed_since(spark, sf):
    """A roster landed with typed times: the date is asked of the files."""
    folder = fresh_dir(spark, "landed")
    sinks.land_roster(_raw(fx.students(spark, sf)), folder, formats=())
    rows = roster.student_keys(sources.read_landed(spark, folder), SINCE)
    return rows.select(*KEYS, "student_id", _stamp())


@query
def stream_landed_roster(spark, sf):
    """Parquet files landed by a stream with the checks of a batch read; those of ``f1`` lack a column."""
    folder, base = fresh_dir(spark, "arriving"), fresh_dir(spark, "streamed")
    headers = {ours: theirs for theirs, ours in schemas.STUDENT_HEADERS.items()}
    named = _raw(fx.students(spark, sf)).select(F.col("src_file").alias("of"), *[F.col(c).alias(h) for c, h in headers.items()])
    named.where("of <> 'f1'").drop("of").write.parquet(f"{folder}/whole")
    named.where("of = 'f1'").drop("of", "PAGO").write.parquet(f"{folder}/short")
    streaming.land_checked(spark, folder, schemas.STUDENT_HEADERS, base, f"{base}-checkpoint").awaitTermination()
    rows = roster.clean_students(streaming.read_checked(spark, base))
    return rows.select(*[c for c in schemas.STUDENT_COLUMNS if c != "activity_ts"], _stamp())


# Whole jobs on files


def _job_params(spark: SparkSession, sf: str, **more) -> JobParams:
    """Inputs of a job as files, rosters gzipped; the names of a roster's files follow the order of its rows."""
    folder = fresh_dir(spark, "job")
    extracts = {**schemas.STUDENT_HEADERS, **PROGRAM_CODE}
    paths = {
        "courses_path": _written(fx.courses(spark, sf), {"Nombre": "short_name", "NRC": "nrc", "Periodo": "term"}, "csv"),
        "users_path": _written(fx.users(spark, sf).orderBy("row_no"), schemas.USER_HEADERS, "csv"),
        "students_path": _written(_raw(fx.students(spark, sf, spark.sparkContext.defaultParallelism)).orderBy("src_file", "row_no"), extracts, "csv", "gzip"),
    }
    return JobParams(**{**paths, "output_dir": f"{folder}/out", "work_dir": f"{folder}/work", "run_id": "1", **more})


@query
def job_student(spark, sf):
    """The student job from files to the consolidated list."""
    out = run_student_job(spark, _job_params(spark, sf))
    return spark.read.text(out.consolidated).withColumnRenamed("value", "line")


@query
def job_staff(spark, sf):
    """The staff job from files to the consolidated list."""
    ordered = _raw(fx.teachers(spark, sf)).orderBy("src_file", "row_no")
    names = {**schemas.COORDINATOR_HEADERS, **schemas.COORDINATOR_OPTIONAL_HEADERS}
    params = _job_params(
        spark,
        sf,
        teachers_path=_written(ordered, schemas.TEACHER_HEADERS, "csv", "gzip"),
        coordinators_path=_written(fx.coordinators(spark, sf).orderBy("row_no").coalesce(1), names, "csv"),
    )
    return spark.read.text(run_staff_job(spark, params).consolidated).withColumnRenamed("value", "line")


@query
def job_registry(spark, sf):
    """The registry job from files: the current version after it."""
    folder = fresh_dir(spark, "job")
    links = _written(fx.course_links(spark, sf).orderBy("row_no").coalesce(1), {schemas.LINK_HEADER: "link"}, "csv")
    known = _written(_registry(spark, sf), {"Nombre": "short_name", "NRC": "nrc", "Periodo": "term"}, "csv")
    out = f"{folder}/out"
    run_registry_job(spark, links, _catalogue(spark, sf), known, out, "1", f"{folder}/work", f"{folder}/current")
    return sources.read_registry(spark, f"{folder}/current").select(*schemas.COURSE_COLUMNS)
