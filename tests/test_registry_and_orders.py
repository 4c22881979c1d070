"""The current registry, statuses nobody knows, older forms of the job, and what a run loaded."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterflow import schemas, sinks, sources, streaming
from rosterflow.operators import registry, roster
from rosterflow.params import Process
from rosterflow.plans import enrolment, run_student_job
from tests.test_jobs import STUDENT_HEADER, course, inputs, lines_of, real_term, student, write_csv  # noqa: F401
from tests.test_sources import HEADERS, teacher

KIND = "short_name string, nrc string, term string"


def rows_of(df):
    return [tuple(r) for r in df.select(*schemas.COURSE_COLUMNS).collect()]


def test_a_version_counts_once_it_is_committed(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "registry")
    first, second = [("b", "2", "202610")], [("b", "2", "202610"), ("a", "1", "202610")]
    assert sources.current_registry(spark, base) is None and sources.read_registry(spark, base).isEmpty()
    sinks.commit_registry(spark.createDataFrame(first, KIND), base)
    with monkeypatch.context() as killed:
        killed.setattr("rosterflow.sinks.lists.F.unix_micros", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            sinks.commit_registry(spark.createDataFrame(second, KIND), base)
    assert len(list((tmp_path / "registry" / "versions").iterdir())) == 2
    assert rows_of(sources.read_registry(spark, base)) == first
    sinks.commit_registry(spark.createDataFrame(second, KIND).coalesce(1), base)
    assert rows_of(sources.read_registry(spark, base)) == second


def test_new_rows_follow_in_link_order(spark):
    known = spark.createDataFrame([("z", "9", "1", "f", 5), ("y", "8", "1", "f", 2), ("x", "7", "1", "a", 9)], f"{KIND}, src_file string, row_no long")
    new = spark.createDataFrame([("a", "1", "1", 30), ("b", "2", "1", 10), ("c", "3", "1", 10)], f"{KIND}, row_no long")
    assert [r[0] for r in rows_of(registry.ordered_registry(known, new))] == ["x", "y", "z", "b", "c", "a"]


def test_unknown_status_gives_no_command_but_an_event(spark, inputs, tmp_path):  # noqa: F811
    statuses = ["Inscrito", "Cancelado", "Eliminado", "", "En espera", " "]
    rows = [student(i + 1, real_term(i + 1), 1000 + i, "P", status=s) for i, s in enumerate(statuses)]
    write_csv(tmp_path / "odd" / "a.csv", STUDENT_HEADER, rows)
    out = run_student_job(spark, inputs(run_id="odd", students_path=str(tmp_path / "odd"), process=Process.MIXED))
    assert {line.split(",")[1] for line in lines_of(out.consolidated)} == {f"00000{1000 + k}" for k in (0, 1, 2, 3, 5)}
    events = spark.read.parquet(out.audit)
    assert [r.detail for r in events.where("event = 'unknown_status'").collect()] == ["000001004"]
    loaded = {r.detail.split()[0]: int(r.detail.split()[1]) for r in events.where("event = 'loaded'").collect()}
    assert loaded["students"] == 6 and loaded["courses"] == 19 and loaded["users"] > 0


def test_lists_follow_the_course_list(spark, inputs, tmp_path):  # noqa: F811
    rows = [student(i, real_term(i), 1000 + i, "P") for i in (1, 2, 3)]
    write_csv(tmp_path / "some" / "a.csv", STUDENT_HEADER, rows)
    listed = write_csv(tmp_path / "backwards.csv", ["Nombre", "NRC", "Periodo"], [course(i) for i in (3, 1, 2)])
    out = run_student_job(spark, inputs(run_id="order", courses_path=listed, students_path=str(tmp_path / "some")))
    people = [line.split(",")[1] for line in lines_of(out.consolidated)]
    assert list(dict.fromkeys(people)) == ["000001003", "000001001", "000001002"]


def test_old_headers_and_the_oldest_key_from_a_job(spark, inputs, tmp_path):  # noqa: F811
    rows = [student(1, real_term(1), 1001, "P"), student(1, "202541", 1001, "P")]
    header = [f" {h}" for h in STUDENT_HEADER]
    write_csv(tmp_path / "old" / "a.csv", header, rows[::-1])
    more = {"students_path": str(tmp_path / "old"), "legacy_headers": True, "users_path": inputs().users_path}
    by_term = run_student_job(spark, inputs(run_id="by-term", **more))
    assert len(lines_of(by_term.consolidated)) == 3


def test_oldest_key_takes_the_first_row_of_any_term(spark):
    courses = spark.createDataFrame([("c", "20001", "202610")], KIND)
    names = [*schemas.STUDENT_COLUMNS, *schemas.LINEAGE]
    make = lambda term, n: dict.fromkeys(names) | {"term": term, "section": "1", "crosslist": "20001", "student_id": "7", "src_file": "a", "row_no": n}
    kind = ", ".join(f"{c} {'long' if c == 'row_no' else 'string'}" for c in names)
    rows = spark.createDataFrame([tuple(make(t, n)[c] for c in names) for t, n in (("202541", 1), ("202610", 2))], kind)
    for reduce in (False, True):
        assert enrolment.matched_students(courses, rows, reduce=reduce).count() == 1
        assert enrolment.matched_students(courses, rows, reduce=reduce, by_term=False).count() == 0


def test_reduction_moves_only_rows_of_listed_sections(spark, sf_dir):
    from harness import views as fx

    students, courses = fx.students(spark, sf_dir), fx.courses(spark, sf_dir).where(F.col("nrc").cast("int") % 50 == 0)
    keyed = roster.student_keys(students)
    some = roster.in_sections(keyed, roster.listed_sections(courses, keyed, True))
    assert 0 < some.count() < 0.3 * keyed.count()
    whole, part = (enrolment.matched_students(courses, students, reduce=r) for r in (False, True))
    key = ("short_name", "user_id", "src_file", "row_no")
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, part.select(*key).collect()))
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Window [row_number()")  # below the sort of first rows


def test_landed_times_are_asked_of_the_files(spark, sf_dir, tmp_path):
    import pyarrow.parquet as pq

    from harness import views as fx

    since = dt.date(1997, 1, 1)
    rows = fx.students(spark, sf_dir).withColumn("activity_ts", F.date_format("activity_ts", "dd/MM/yyyy"))
    sinks.land_roster(rows, str(tmp_path / "landed"), formats=("dd/MM/yyyy",))
    landed = sources.read_landed(spark, str(tmp_path / "landed"))
    kept = roster.student_keys(landed, since)
    assert "GreaterThanOrEqual(activity_ts," in kept._jdf.queryExecution().executedPlan().toString()
    plain = roster.student_keys(rows, since, ("dd/MM/yyyy",))
    assert kept.count() == plain.count() > 0
    for file in (tmp_path / "landed").rglob("*.parquet"):
        times = [t for t in pq.read_table(file, columns=["activity_ts"])["activity_ts"].to_pylist() if t]
        assert times == sorted(times)


def test_a_stream_rejects_what_a_batch_read_rejects(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "landed")

    def arrive(header, *rows):
        spark.createDataFrame([r[: len(header)] for r in rows], ", ".join(f"`{h}` string" for h in header)).coalesce(1).write.mode("append").parquet(folder)

    def land():
        streaming.land_checked(spark, folder, schemas.TEACHER_HEADERS, base, str(tmp_path / "checkpoint")).awaitTermination(120)

    arrive(HEADERS, teacher(1), teacher(2))
    arrive(HEADERS[:-1], teacher(3))
    land()
    arrive(HEADERS, teacher(4))
    land()
    land()
    batch, rejected = sources.read_teachers(spark, folder, "parquet")
    columns = [*schemas.TEACHER_COLUMNS, *schemas.LINEAGE]
    got = streaming.read_checked(spark, base)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))
    assert got.count() == 3 and rejected.count() == 1
    assert [tuple(r)[1:3] for r in spark.read.parquet(f"{base}/rejected").collect()] == [("missing_columns", [HEADERS[-1]])]
