"""Rows are dealt by range before their commands are made, and tasks do not grow with the table."""

from __future__ import annotations

import gzip

from harness import views as fx
from rosterflow import sinks, sources
from rosterflow.plans import staff_commands
from rosterflow.schemas import COMMAND_ORDER, TEACHER_HEADERS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_roster_views_have_no_fixed_number_of_tasks(spark):
    assert "REPARTITION_BY_NUM" not in plan_of(fx.teachers(spark, "/root/testdata/sf0.001"))


def test_arranged_commands_are_the_same_in_order(spark):
    sf = "/root/testdata/sf0.001"
    views = [fx.courses(spark, sf), fx.teachers(spark, sf), fx.students(spark, sf), fx.coordinators(spark, sf), fx.users(spark, sf)]
    plain = staff_commands(*views).orderBy(*COMMAND_ORDER)
    dealt = staff_commands(*views, arrange=sinks.arranged).sortWithinPartitions(*COMMAND_ORDER)
    assert [tuple(r) for r in dealt.collect()] == [tuple(r) for r in plain.collect()]
    plan = plan_of(dealt)
    assert "posexplode" in plan[: plan.index("Exchange rangepartitioning")]


def test_gzipped_extracts_are_read(spark, tmp_path):
    line = '{"' + '":"1","'.join(TEACHER_HEADERS) + '":"1"}\n'
    with gzip.open(tmp_path / "a.json.gz", "wt", encoding="utf8") as f:
        f.write(line)
    (tmp_path / "b.json").write_text(line, encoding="utf8")
    assert sources.read_teachers(spark, str(tmp_path), "json").rows.count() == 2
