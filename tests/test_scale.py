"""What the plans must keep to at scale: hot keys, pruning, no Python, no cross joins."""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from harness import views as fx
from harness.queries import QUERIES
from rosterflow import Process, sinks, sources
from rosterflow.operators import programme, roster
from rosterflow.plans import matched_students, student_commands

LAZY = sorted(n for n in QUERIES if not n.startswith("sink_") and n not in ("extract_students", "rejected_files"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_engine(spark, name):
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan


def hot_roster(spark, n: int):
    """A third of the rows are one crosslist, and a third one person in one section."""
    key = F.col("id")
    hot_course, hot_person = key % 3 == 0, key % 3 == 1
    return spark.range(0, n, 1, 8).select(
        F.lit("f0").alias("src_file"),
        key.alias("row_no"),
        F.lit("202610").alias("term"),
        F.when(hot_person, "30000").otherwise((key % 997 + 30001).cast("string")).alias("section"),
        F.when(hot_course, "20000").otherwise((key % 89 + 20001).cast("string")).alias("crosslist"),
        F.when(hot_person, "7").otherwise((key % 5003 + 8).cast("string")).alias("student_id"),
        F.lit("CC").alias("doc_type"),
        key.cast("string").alias("doc_no"),
        F.lit("u@example.org").alias("email"),
        F.lit("ana").alias("first_name"),
        F.lit("gil").alias("last_name"),
        F.lit("RE").alias("enrol_code"),
        F.when(key % 5 == 0, "Cancelado").otherwise("Inscrito").alias("status"),
        F.lit("2026-01-02").alias("activity_ts"),
        F.lit("Y").alias("paid"),
        F.lit("BS").alias("partner"),
    )


def hot_courses(spark):
    nrc = (F.col("id") + 20000).cast("string")
    return spark.range(100).select(
        F.concat(F.lit("1-1-202610-"), nrc).alias("short_name"), nrc.alias("nrc"), F.lit("202610").alias("term")
    )


def test_first_rows_of_a_hot_key_are_reduced_before_the_shuffle(spark):
    rows = hot_roster(spark, 30000)
    deduped = roster.dedupe_students(roster.student_keys(rows))
    plan = plan_of(deduped)
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    seen = {}
    for r in rows.select("row_no", "term", "section", "student_id").orderBy("row_no").toLocalIterator():
        seen.setdefault((r.term, r.section, r.student_id.zfill(9)), r.row_no)
    found = {(r.term, r.section, r.student_id): r.row_no for r in deduped.collect()}
    assert found == seen


def test_hot_course_is_split_when_the_course_list_is_too_large_to_broadcast(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    rows = roster.student_keys(hot_roster(spark, 30000))
    with settings(spark, **small):
        counted = roster.match_courses(hot_courses(spark), rows, cut=True).groupBy("nrc").agg(
            F.count("*").alias("n"), F.count_distinct("doc_no")
        )
        found = {r.nrc: r.n for r in counted.collect()}
        assert "SortMergeJoin(skew=true)" in plan_of(counted)
    listed = {str(20000 + i) for i in range(100)}
    expected = Counter(r.crosslist for r in rows.select("crosslist").collect() if r.crosslist in listed)
    assert found == expected


def commands_multiset(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def test_partitioning_of_the_input_changes_nothing(spark, sf_dir):
    courses, users = fx.courses(spark, sf_dir), fx.users(spark, sf_dir)
    rows = fx.students(spark, sf_dir)
    straight = student_commands(courses, rows, users)
    shuffled = student_commands(courses, rows.orderBy(F.xxhash64("row_no", "email")).repartition(13), users)
    assert commands_multiset(straight) == commands_multiset(shuffled)


def test_create_and_update_agree_with_the_directory(spark, sf_dir):
    cmds = student_commands(fx.courses(spark, sf_dir), fx.students(spark, sf_dir), fx.users(spark, sf_dir))
    known = fx.users(spark, sf_dir).select(F.lpad("user_name", 9, "0").alias("user_id")).distinct()
    assert cmds.where("verb = 'CREATE'").join(known, "user_id", "left_semi").isEmpty()
    assert cmds.where("verb = 'UPDATE'").join(known, "user_id", "left_anti").isEmpty()
    in_course = cmds.where("verb = 'ENROLL' AND org_unit = short_name").count()
    assert in_course == cmds.where("step = 0").count() > 0


@pytest.mark.parametrize("process", list(Process))
def test_eligible_means_no_skip_reason(spark, sf_dir, process):
    rows = matched_students(fx.courses(spark, sf_dir), fx.students(spark, sf_dir), process)
    differ = rows.where(programme.eligible(process) != F.col("skip_reason").isNull())
    assert differ.isEmpty()
    assert rows.where(programme.eligible(process).isNull()).isEmpty()


def test_terms_prune_a_landed_roster(spark, sf_dir, tmp_path):
    sinks.land_roster(fx.students(spark, sf_dir), str(tmp_path / "landed"))
    landed = sources.read_landed(spark, str(tmp_path / "landed"))
    courses = fx.courses(spark, sf_dir).where("term = '202610'")
    pruned = sources.prune_to_terms(landed, courses, cut=True)
    users = fx.users(spark, sf_dir)
    with settings(spark, **{"spark.sql.maxMetadataStringLength": "100000"}):
        plan = plan_of(student_commands(courses, pruned, users))
    pruned_scans = [line for line in plan.splitlines() if "FileScan" in line and "dynamicpruning" in line]
    assert pruned_scans
    for scan in pruned_scans:
        assert "dynamicpruning" in scan[scan.index("PartitionFilters") :], scan
        read = scan[scan.index("ReadSchema") :] if "ReadSchema" in scan else scan[: scan.index("Batched")]
        assert "enrol_code" not in read and "program_code" not in read, scan
    whole = student_commands(courses, landed, users)
    assert commands_multiset(student_commands(courses, pruned, users)) == commands_multiset(whole)
