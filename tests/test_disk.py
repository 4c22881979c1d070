"""What a run writes to disk: rows move rather than the lines made of them, and with no more than is asked of them."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harness import views as fx
from harness.queries import QUERIES
from rosterflow import Process, sinks, sources
from rosterflow.operators import programme, roster
from rosterflow.plans import enrolment
from rosterflow.schemas import COMMAND_ORDER, STUDENT_COLUMNS

SMALL = "/root/testdata/sf0.001"
PERSON = ("doc_type", "doc_no", "email", "first_name", "last_name")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As with tables that are too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, kept)


def students(spark, rows):
    """A roster of (row, section, crosslist, student, status, number)."""
    given = spark.createDataFrame(rows, "row_no bigint, section string, crosslist string, student_id string, status string, doc_no string")
    texts = {"src_file": "f", "term": "202610", "doc_type": "CC", "first_name": "ana", "last_name": "gil", "enrol_code": "", "activity_ts": "2026-01-02", "paid": "Y", "partner": "BS"}
    named = given.withColumns({c: F.lit(v) for c, v in texts.items()}).withColumn("email", F.concat("student_id", F.lit("@example.org")))
    return named.select("src_file", "row_no", *STUDENT_COLUMNS)


def courses(spark, *numbers):
    return spark.createDataFrame([(f"1-1-202610-{n}", n, "202610") for n in numbers], "short_name string, nrc string, term string")


ROWS = [
    (1, "30", "1", "7", "Cancelado", "70"),
    (2, "30", "1", "7", "Inscrito", "71"),
    (3, "31", "1", "7", "Inscrito", "72"),
    (4, "30", "2", "8", "Eliminado", "80"),
    (5, "31", "2", "8", None, "81"),
    (6, "30", "2", "0", "Cancelado", "90"),
    (None, "32", "2", "9", "Inscrito", "92"),
    (None, "32", "2", "9", "Inscrito", "91"),
    (7, "30", "2", "5", "Raro", "50"),
]


def test_lines_are_not_sorted_again(spark):
    plan = plan_of(QUERIES["consolidated_commands"](spark, SMALL))
    assert "Sort [" not in plan[: plan.index("posexplode")]


def test_commands_of_arranged_rows_are_in_order(spark):
    views = [fx.courses(spark, SMALL), fx.teachers(spark, SMALL), fx.students(spark, SMALL), fx.coordinators(spark, SMALL), fx.users(spark, SMALL)]
    plain = enrolment.staff_commands(*views).orderBy(*COMMAND_ORDER)
    assert enrolment.staff_commands(*views, arrange=sinks.arranged).collect() == plain.collect()


def test_placed_rows_are_arranged_without_a_join(spark):
    listed = fx.courses(spark, SMALL).withColumns({"src_file": F.lit("list"), "row_no": -F.col("nrc").cast("bigint")})
    views = [fx.teachers(spark, SMALL), fx.students(spark, SMALL), fx.coordinators(spark, SMALL), fx.users(spark, SMALL)]
    joined = enrolment.staff_commands(fx.courses(spark, SMALL), *views, arrange=lambda rows: sinks.arranged(rows, listed))
    placed = enrolment.staff_commands(roster.placed_courses(listed), *views, arrange=lambda rows: sinks.arranged(rows, listed))
    assert sorted(placed.columns) == sorted(joined.columns)
    assert placed.select(joined.columns).collect() == joined.collect()


def test_lines_are_placed_without_a_shuffle(spark, no_broadcast):
    for query in ("sink_hot_course_list", "course_list_order"):
        plan = plan_of(QUERIES[query](spark, SMALL))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("process", list(Process))
def test_rows_that_need_no_person_give_the_same_commands(spark, process):
    listed, rows = courses(spark, "1", "2"), students(spark, ROWS)
    users = spark.createDataFrame([("7",)], "user_name string")
    whole = enrolment.commands_of_students(enrolment.matched_students(listed, rows, process), users, process)
    lean = enrolment.student_commands(listed, rows, users, process)
    assert sorted(map(repr, lean.collect())) == sorted(map(repr, whole.collect())) != []


def test_rows_without_person_carry_none(spark):
    person = programme.names_person(Process.MIXED)
    rows = enrolment.matched_students(courses(spark, "1", "2"), students(spark, ROWS), Process.MIXED, person=person).collect()
    for r in rows:
        left = r.status in ("Cancelado", "Eliminado")
        assert all((r[c] is None) == left for c in PERSON), r
    assert {r.status in ("Cancelado", "Eliminado") for r in rows} == {True, False}


@pytest.mark.parametrize("process", list(Process))
def test_logged_is_asked_before_the_match(spark, process, no_broadcast):
    matched = enrolment.matched_students(courses(spark, "1", "2"), students(spark, ROWS), process)
    reason = F.col("skip_reason")
    later = matched.where(reason.isNull() | (reason != "status"))
    assert sorted(map(repr, matched.where(programme.logged(process)).collect())) == sorted(map(repr, later.collect()))
    if process is Process.ENROL:
        plan = plan_of(matched.where(programme.logged(process)))
        filters = [i for i, line in enumerate(plan.splitlines()) if "Filter" in line and "Inscrito" in line]
        assert min(filters) > next(i for i, line in enumerate(plan.splitlines()) if "SortMergeJoin" in line)


def test_terms_do_not_shuffle_a_roster(spark, no_broadcast):
    pruned = sources.prune_to_terms(students(spark, ROWS), courses(spark, "1"), cut=True)
    assert "SortMergeJoin" not in plan_of(pruned) and pruned.count() == len(ROWS)


def test_buyers_meet_orders_first(spark, no_broadcast):
    plan = plan_of(fx.students(spark, SMALL))
    assert re.search(r"SortMergeJoin \[o_custkey", plan)
    assert plan.index("[l_orderkey") < plan.index("[o_custkey")


def test_gzipped_lists_hold_the_same_lines(spark, tmp_path):
    cmds = enrolment.teacher_commands(fx.courses(spark, SMALL), fx.teachers(spark, SMALL), fx.users(spark, SMALL)).localCheckpoint()
    plain, pressed = str(tmp_path / "plain"), str(tmp_path / "pressed")
    sinks.write_course_lists(cmds, plain)
    sinks.write_course_lists(cmds, pressed, compression="gzip")
    assert {p.suffix for p in Path(pressed).glob("short_name=*/part-*")} == {".gz"}
    assert sorted(sinks.read_course_lists(spark, pressed).collect()) == sorted(sinks.read_course_lists(spark, plain).collect())
    as_text = spark.read.schema("line string, short_name string").text(pressed)
    assert sorted(as_text.collect()) == sorted(sinks.read_course_lists(spark, plain).collect())
    sinks.write_consolidated(cmds, f"{plain}-all")
    sinks.write_consolidated(cmds, f"{pressed}-all", compression="gzip")
    assert {p.suffix for p in Path(f"{pressed}-all").glob("part-*")} == {".gz"}
    assert sorted(spark.read.text(f"{pressed}-all").collect()) == sorted(spark.read.text(f"{plain}-all").collect())
    with pytest.raises(ValueError):
        sinks.write_course_lists(cmds, plain, compression="lzo")
