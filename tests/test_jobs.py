"""Whole jobs on a small invented roster, shaped like one known production run."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from rosterflow import JobParams, Process
from rosterflow import schemas
from rosterflow.plans import run_registry_job, run_staff_job, run_student_job

N = 19


def write_csv(path: Path, header, rows) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(header), *[",".join(map(str, r)) for r in rows]]) + "\n", encoding="utf8")
    return str(path)


def course(i: int) -> tuple[str, str, str]:
    """Nine undergraduate and ten graduate courses; the tenth has a mistyped term."""
    term = "202610" if i <= 9 else "206241" if i == 10 else "202641"
    return f"55{i:02d}-{i:04d}-{term}-{20000 + i}", str(20000 + i), term


def real_term(i: int) -> str:
    return "202610" if i <= 9 else "202641"


def student(i, term, person, program, status="Inscrito", partner="", paid="N", row_day=2, name="maría josé"):
    return [term, 30000 + i, 20000 + i, person, "CC", 1000000 + person, f"u{person}@example.org", name, "o'neil"] + [
        "RE", status, f"2026-01-0{row_day} 08:00:00", paid, partner, program
    ]


STUDENT_HEADER = [*schemas.STUDENT_HEADERS, "COD_PROGRAMA_ESTUDIANTE"]


@pytest.fixture()
def inputs(tmp_path):
    courses = write_csv(tmp_path / "courses.csv", ["Nombre", "NRC", "Periodo"], [course(i) for i in range(1, N + 1)])
    teachers = [
        [real_term(i), 30000 + i, 20000 + i, f"{500 + i}.0", "CC", 70000000 + i, f"t{i}@example.org", "ana maría", "gil"]
        + ["2026-01-02"]
        for i in range(1, N + 1)
    ]
    write_csv(tmp_path / "teachers" / "a.csv", list(schemas.TEACHER_HEADERS), teachers)
    students = [student(i, real_term(i), 1000 + i, f"P{i:02d}") for i in range(1, N + 1)]
    students += [student(i, real_term(i), 2000 + i, "P99", row_day=1) for i in (3, 7)]
    students += [student(4, real_term(4), 3004, "P98", status="Cancelado"), student(5, real_term(5), 3005, "P05", partner="ZZ")]
    write_csv(tmp_path / "students" / "a.csv", STUDENT_HEADER, students)
    users = [[500 + i, "Ana", "Gil", "110", "", f"t{i}@example.org"] for i in range(1, N + 1)]
    users += [[900 + i, "Coord", "Inador", "135.0", "CC. 1", f"k{i}@example.org"] for i in range(1, N + 1) if i != 2]
    users += [[1000 + i, "x", "y", "110", "", "z"] for i in range(1, 6)]
    users_path = write_csv(tmp_path / "dirs" / "users.csv", list(schemas.USER_HEADERS), users)
    coordinators = [[f"P{i:02d}", 502 if i == 2 else 900 + i, f"Coord {i}", f"k{i}@example.org"] for i in range(1, N + 1)]
    header = [*schemas.COORDINATOR_HEADERS, *schemas.COORDINATOR_OPTIONAL_HEADERS]
    write_csv(tmp_path / "dirs" / "Coordinadores.csv", header, coordinators)

    def params(**more) -> JobParams:
        return JobParams(
            **{
                "courses_path": courses,
                "users_path": users_path,
                "students_path": str(tmp_path / "students"),
                "teachers_path": str(tmp_path / "teachers"),
                "output_dir": str(tmp_path / "out"),
                "work_dir": str(tmp_path / "work"),
                "run_id": "r1",
                **more,
            }
        )

    return params


def lines_of(folder: str) -> list[str]:
    return [line for part in sorted(Path(folder).glob("part-*")) for line in part.read_text(encoding="utf8").splitlines()]


def lists_of(folder: str) -> dict[str, list[str]]:
    return {p.name.removeprefix("short_name="): lines_of(str(p)) for p in Path(folder).glob("short_name=*")}


def counts_of(spark, folder: str) -> dict[str, int]:
    rows = spark.read.schema("short_name string, nrc string, n bigint").csv(folder).collect()
    return {r.short_name: r.n for r in rows}


def test_staff_job_reproduces_the_known_run(spark, inputs):
    out = run_staff_job(spark, inputs())
    lists = lists_of(out.lists)
    assert len(lists) == 18
    assert all(len(lines) == 4 for lines in lists.values())
    name = course(1)[0]
    assert lists[name] == [
        "UPDATE,000000501,CC. 70.000.001,Ana María,Gil,,1,t1@example.org",
        "ENROLL,000000501,,Moderador,UPBV",
        f"ENROLL,000000501,,Moderador,{name}",
        f"ENROLL,000000901,,Coordinador,{name}",
    ]
    consolidated = lines_of(out.consolidated)
    assert consolidated == [line for key in sorted(lists) for line in lists[key]]
    assert len(consolidated) == 72
    counts = counts_of(spark, out.counts)
    assert counts == {course(i)[0]: 0 if i == 10 else 1 for i in range(1, N + 1)}
    events = Counter(r.event for r in spark.read.parquet(out.audit).collect())
    assert events == {"course_total": 19, "many_centres": 2, "no_centre": 1, "coordinator_ok": 18, "loaded": 4}
    assert "502" in lists[course(2)[0]][3]  # one person is teacher and coordinator


def test_a_rerun_replaces_itself(spark, inputs):
    first = run_staff_job(spark, inputs())
    before = lines_of(first.consolidated), counts_of(spark, first.counts)
    second = run_staff_job(spark, inputs())
    assert (lines_of(second.consolidated), counts_of(spark, second.counts)) == before


def test_student_job(spark, inputs):
    out = run_student_job(spark, inputs())
    lists = lists_of(out.lists)
    name = course(1)[0]
    assert lists[name] == [
        "UPDATE,000001001,CC. 1.001.001,María José,O'Neil,,1,u1001@example.org",
        "ENROLL,000001001,,Student_pr,UPBV",
        f"ENROLL,000001001,,Student,{name}",
    ]
    graduate = course(11)[0]
    assert lists[graduate] == [
        "CREATE,000001011,CC. 1.001.011,María José,O'Neil,,Student_fa,1,u1011@example.org",
        "ENROLL,000001011,,Student_fa,CVFA",
        f"ENROLL,000001011,,Student,{graduate}",
    ]
    counts = counts_of(spark, out.counts)
    assert counts[course(3)[0]] == 2 and counts[course(10)[0]] == 0
    assert sum(counts.values()) == sum(line.endswith(n) for n, ls in lists.items() for line in ls)
    events = Counter(r.event for r in spark.read.parquet(out.audit).collect())
    assert events == {"course_total": 19, "partner": 1, "loaded": 3}


def test_drop_and_since(spark, inputs):
    out = run_student_job(spark, inputs(process=Process.DROP, run_id="drop"))
    assert lines_of(out.consolidated) == [f"UNENROLL,000003004,,{course(4)[0]}"]
    out = run_student_job(spark, inputs(since=dt.date(2026, 1, 3), run_id="late"))
    assert lines_of(out.consolidated) == []
    assert set(counts_of(spark, out.counts).values()) == {0}


def test_short_name_with_two_numbers_is_two_courses(spark, inputs, tmp_path):
    """Rows of either number get their commands; exact repeats count once."""
    name, nrc, term = course(2)
    rows = [course(1), course(2), course(2), (name, "20001", term)]
    listed = write_csv(tmp_path / "twice.csv", ["Nombre", "NRC", "Periodo"], rows)
    out = run_student_job(spark, inputs(courses_path=listed, run_id="twice"))
    assert {line.split(",")[1] for line in lists_of(out.lists)[name]} == {"000001001", "000001002"}
    counted = spark.read.schema("short_name string, nrc string, n bigint").csv(out.counts).collect()
    assert sorted(map(tuple, counted)) == [(course(1)[0], "20001", 1), (name, "20001", 1), (name, nrc, 1)]
    events = Counter(r.event for r in spark.read.parquet(out.audit).collect())
    assert events["duplicate_course"] == 1 and events["conflicting_course"] == 1


def test_staff_job_without_coordinators(spark, inputs, tmp_path):
    out = run_staff_job(spark, inputs(coordinators_path=str(tmp_path / "none.csv"), run_id="alone"))
    assert all(len(lines) == 3 for lines in lists_of(out.lists).values())
    events = Counter(r.event for r in spark.read.parquet(out.audit).collect())
    assert events["no_coordinator_list"] == 1 and events["coordinator_ok"] == 0


def test_bad_dates_are_told(spark, inputs, tmp_path):
    rows = [student(i, real_term(i), 1000 + i, "P") for i in (1, 2, 3, 4)]
    for row, text in zip(rows, ("19/03/2026", "46100", "soon", "2026-03-19")):
        row[11] = text
    write_csv(tmp_path / "odd" / "a.csv", STUDENT_HEADER, rows)
    more = {"students_path": str(tmp_path / "odd"), "since": dt.date(2026, 1, 1)}
    out = run_student_job(spark, inputs(run_id="odd", date_formats=("dd/MM/yyyy",), **more))
    assert {line.split(",")[1] for line in lines_of(out.consolidated)} == {"000001001", "000001002", "000001004"}
    events = {r.event: r.detail for r in spark.read.parquet(out.audit).collect()}
    assert events["bad_date"].endswith("a.csv 1")
    with pytest.raises(ValueError):
        inputs(since=dt.date.today() + dt.timedelta(days=2))


def test_landed_roster_gives_the_same_commands(spark, inputs, tmp_path):
    from rosterflow import sinks, sources

    by_files = lines_of(run_student_job(spark, inputs()).consolidated)
    p = inputs()
    sinks.land_roster(sources.read_students(spark, p.students_path).rows, str(tmp_path / "landed"))
    sources.read_users(spark, p.users_path).drop("src_file", "row_no").withColumnsRenamed(
        {ours: theirs for theirs, ours in schemas.USER_HEADERS.items()}
    ).write.parquet(str(tmp_path / "users"))
    landed = inputs(
        extract_format="landed", students_path=str(tmp_path / "landed"), users_path=str(tmp_path / "users"), run_id="l"
    )
    assert lines_of(run_student_job(spark, landed).consolidated) == by_files


def test_registry_job(spark, tmp_path):
    links = ["Enlace curso"] + [f"https://lms.example.org/home/{i}" for i in (10001, 10002, 10003, 10002, 10004, 10005)]
    links += ['""', "https://lms.example.org/none"]
    (tmp_path / "links.csv").write_text("\n".join(links) + "\n", encoding="utf8")
    registry = write_csv(tmp_path / "courses.csv", ["Nombre", "NRC", "Periodo"], [("1-1-202610-1", "1", "202610")])
    catalogue = spark.createDataFrame(
        [("10001", "1-1-202610-1"), ("10002", "2-2-202641V1-2"), ("10003", "malformed"), ("10004", "2-2-202641V1-2")],
        "course_id string, short_name string",
    )
    args = (str(tmp_path / "links.csv"), catalogue, registry, str(tmp_path / "out"))
    out = run_registry_job(spark, *args, "r1")
    rows = spark.read.option("header", True).csv(out.registry).collect()
    assert sorted(tuple(r) for r in rows) == [("1-1-202610-1", "1", "202610"), ("2-2-202641V1-2", "2", "202641V1")]
    errors = spark.read.option("header", True).csv(out.errors).collect()
    assert sorted((r.course_id, r.error) for r in errors) == [("10005", "not_in_catalogue"), ("N/A", "no_course_id")]
    again = run_registry_job(spark, args[0], catalogue, out.registry, args[3], "r2")
    assert again.n_new == 0 and again.registry == out.registry


def test_staff_block_order(spark, duck, sf_dir, tmp_path):
    """Over a whole table: every list starts a person with CREATE or UPDATE, coordinator last."""
    from harness import views as fx
    from rosterflow import sinks
    from rosterflow.plans import staff_commands

    cmds = staff_commands(
        fx.courses(spark, sf_dir),
        fx.teachers(spark, sf_dir),
        fx.students(spark, sf_dir),
        fx.coordinators(spark, sf_dir),
        fx.users(spark, sf_dir),
    )
    sinks.write_course_lists(cmds, str(tmp_path / "lists"))
    by_course = defaultdict(list)
    for folder in (tmp_path / "lists").glob("short_name=*"):
        assert len(list(folder.glob("part-*"))) <= 2
        by_course[folder.name] = lines_of(str(folder))
    assert by_course
    for lines in by_course.values():
        coordinator = [i for i, line in enumerate(lines) if ",Coordinador," in line]
        assert coordinator == list(range(len(lines) - len(coordinator), len(lines)))
        for line, following in zip(lines, lines[1:]):
            if line.startswith(("CREATE", "UPDATE")):
                assert following.split(",")[1] == line.split(",")[1]
