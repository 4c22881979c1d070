"""Scalar expressions on edge values, against plain Python where Python defines them."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterflow import functions as rf
from rosterflow.rules import DEFAULT_RULES

LATIN = st.text(alphabet="abzAZñÑéÉüÜçáÍó 0123456789'-./_ºª\t", max_size=20)


def evaluate(spark, fn, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(LATIN, min_size=200, max_size=300))
def test_text_functions_follow_python(spark, values):
    assert evaluate(spark, rf.title_case, values) == [v.strip().title() for v in values]
    assert evaluate(spark, rf.clean_text, values) == [v.strip() for v in values]
    assert evaluate(spark, rf.pad_id, values) == [v.zfill(9) for v in values]


@pytest.mark.parametrize(
    ("fn", "cases"),
    [
        (rf.pad_id, {"7": "000000007", "1234567890": "1234567890", "-5": "-00000005", "+": "+00000000", None: None}),
        (rf.roster_id, {"27267.0": "000027267", " 1": "0000000 1", "aB": "0000000aB", None: None}),
        (
            rf.normalise_id,
            {" 138144.0 ": "000138144", "NaN": "", "None": "", "": "", None: "", "ABC": "000000abc", "-": "-00000000"},
        ),
        (
            rf.is_invalid_id,
            {"-": True, "-00000000": True, "0": True, "0.0": True, "nan": True, "000000nan": True, "": True, None: True}
            | {"none": True, "  ": True, "12": False, "000000012": False, "-1": False},
        ),
        (rf.clean_text, {None: "", " a b ": "a b", "\n": ""}),
        (rf.title_case, {"o'neil-de la ñu": "O'Neil-De La Ñu", " 3er ": "3Er", "MARÍA": "María", None: None}),
        (rf.strip_decimal, {"12.0": "12", "1.0.0": "1.0", "12.5": "12.5", ".0": "", None: None}),
        (
            rf.doc_number,
            {"1234567": "1.234.567", "999": "999", "-1234": "-1.234", "AB123": "AB123", "12.0": "12", "12.7": "12.7"}
            | {"1_000": "1_000", "12345678901234567890": "12.345.678.901.234.567.890", None: None, " 1000 ": "1.000"},
        ),
        (
            rf.course_id,
            {"https://x/home/82264": "82264", " https://x/1234 ": "1234", "https://x/123": None, "https://x/1234567": None}
            | {"https://x/12345/": None, "": None, None: None},
        ),
        (rf.legacy_course_id, {"https://x/home/82264": "82264", "https://x/1234": "1234", "12": "12", "abcdef": "cdef"}),
        (rf.legacy_number, {"a-b-c-20001": "20001", "a-b-123456": "N/A", "abc": "N/A", "a-": "N/A", "a-1 ": "1"}),
        (rf.oldest_number, {"a-b-c-20001": "20001", "abc": "abc"}),
        (rf.cut_term, {"202641V1": "202641", "2026": "2026"}),
        (rf.programme_suffix, {"202641V1": "41", "202610": "10"}),
    ],
)
def test_edge_values(spark, fn, cases):
    assert dict(zip(cases, evaluate(spark, fn, list(cases)), strict=True)) == cases


def test_doc_label(spark):
    rows = spark.createDataFrame(
        [("CC", "1000", "CC. 1.000"), (None, "1000", "1.000"), ("CC", None, ""), ("CC", "A1", "CC. A1")],
        "t string, n string, want string",
    )
    for row in rows.withColumn("got", rf.doc_label(F.col("t"), F.col("n"))).collect():
        assert row.got == row.want


def test_short_name_parts(spark):
    parts = evaluate(spark, rf.short_name_parts, ["5500-0001-202641-20001", "a-b-c", "a-b-c-d-e", "---", ""])
    assert [p and tuple(p) for p in parts] == [("20001", "202641"), None, None, ("", ""), None]


def test_activity_time(spark):
    def parse(c):
        return rf.parse_activity(c, ["dd/MM/yyyy HH:mm"])

    found = evaluate(spark, parse, ["2026-03-19 12:41:06", "2026-03-19", "19/03/2026 07:05", "later", None])
    assert found == [
        dt.datetime(2026, 3, 19, 12, 41, 6),
        dt.datetime(2026, 3, 19),
        dt.datetime(2026, 3, 19, 7, 5),
        None,
        None,
    ]


def test_since_keeps_the_day_itself_and_drops_unknown_times(spark):
    rows = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2026-01-02'), (TIMESTAMP_NTZ '2026-01-01 23:59:59'), (NULL) t(a)")
    assert rows.where(rf.active_since(F.col("a"), dt.date(2026, 1, 2))).count() == 1
    assert rows.where(rf.active_since(F.col("a"), None)).count() == 3


def test_former_unit(spark):
    units = evaluate(spark, DEFAULT_RULES.former_unit, ["150", "143", "138", "137", "136", "135", "110", "", None])
    assert units == ["CVTE", "CVLA", "CVPR", "CVFC", "CVFA", "CVFA", None, None, None]


def test_render_line(spark):
    from rosterflow.operators.commands import has_comma, render_line
    from rosterflow.schemas import COMMAND_COLUMNS

    def command(**values):
        return tuple(values.get(c, "") for c in COMMAND_COLUMNS)

    person = {"user_id": "1", "doc_label": "CC. 1", "first_name": "A, B", "last_name": 'C "D"', "active": "1", "email": "e"}
    rows = spark.createDataFrame(
        [
            command(verb="CREATE", role="r", **person),
            command(verb="UPDATE", **person),
            command(verb="ENROLL", user_id="1", role="r", org_unit="u"),
            command(verb="UNENROLL", user_id="1", org_unit="u"),
        ],
        ", ".join(f"{c} string" for c in COMMAND_COLUMNS),
    )
    lines = {r.verb: r for r in rows.select("verb", render_line().alias("n"), render_line("csv").alias("q"), has_comma().alias("c")).collect()}
    assert lines["CREATE"].n == 'CREATE,1,CC. 1,A, B,C "D",,r,1,e'
    assert lines["CREATE"].q == 'CREATE,1,CC. 1,"A, B","C ""D""",,r,1,e'
    assert lines["UPDATE"].n == 'UPDATE,1,CC. 1,A, B,C "D",,1,e'
    assert lines["ENROLL"].n == lines["ENROLL"].q == "ENROLL,1,,r,u"
    assert lines["UNENROLL"].n == "UNENROLL,1,,u"
    assert [lines[v].c for v in ("CREATE", "ENROLL")] == [True, False]
    with pytest.raises(ValueError):
        render_line("tab")


def test_legacy_dedupe_key(spark):
    from rosterflow.operators.roster import dedupe_students

    columns = "src_file,row_no,crosslist,activity_ts,status,paid,doc_no,email,term,section,student_id"
    rows = spark.sql(
        f"SELECT * FROM VALUES ('f',1L,'x','a','s','y','1','e','202610','s1','p'),('f',2L,'x','a','s','y','1','e','202641','s1','p') t({columns})"
    )
    assert dedupe_students(rows).count() == 2
    assert [r.row_no for r in dedupe_students(rows, by_term=False).collect()] == [1]
