"""Extract folders, row lineage and the registry files."""

from __future__ import annotations

import pytest

from rosterflow import schemas, sources
from rosterflow.sources.extracts import normalise_header

HEADERS = list(schemas.TEACHER_HEADERS)


def write(folder, name, header, rows):
    lines = [",".join(header), *[",".join(r) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf8")


def teacher(n, name="ana"):
    return ["202610", f"3{n:04d}", "20001", str(n), "CC", str(1000 + n), f"t{n}@example.org", name, "gil", "2026-01-02"]


def test_extracts_with_different_headers_are_joined_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", HEADERS, [teacher(1), teacher(2)])
    turned = [*reversed(HEADERS), "EXTRA"]
    write(tmp_path, "b.csv", turned, [[*reversed(teacher(3)), "x"]])
    write(tmp_path, "short.csv", HEADERS[:-1], [teacher(4)[:-1]])
    write(tmp_path, "~$a.csv", HEADERS, [teacher(5)])
    (tmp_path / "empty.csv").write_text("\n\n", encoding="utf8")
    (tmp_path / "note.txt").write_text("not an extract", encoding="utf8")
    rows, rejected = sources.ingest_teachers(spark, str(tmp_path))
    assert sorted(r.teacher_id for r in rows.collect()) == ["000000001", "000000002", "000000003"]
    assert {r.first_name for r in rows.collect()} == {"Ana"}
    found = {r.src_file.rsplit("/", 1)[-1]: (r.reason, len(r.missing)) for r in rejected.collect()}
    assert found == {"short.csv": ("missing_columns", 1), "empty.csv": ("unreadable", len(HEADERS))}


def test_no_extract_and_no_valid_extract(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_teachers(spark, str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        sources.read_teachers(spark, str(tmp_path))
    write(tmp_path, "a.csv", HEADERS[:3], [["1", "2", "3"]])
    with pytest.raises(ValueError, match="no valid extract"):
        sources.read_teachers(spark, str(tmp_path))


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_row_numbers_follow_the_file_over_many_blocks(spark, tmp_path, file_format):
    named = spark.range(0, 20000, 1, 1).selectExpr(
        *[f"lpad(id, 9, '0') AS `{h}`" if h == "ID_DOCENTE" else f"'x' AS `{h}`" for h in HEADERS]
    )
    writer = named.write.option("header", True) if file_format == "csv" else named.write
    writer.format(file_format).save(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows, _ = sources.read_teachers(spark, str(tmp_path / "in"), file_format)
        ordered = [r.teacher_id for r in rows.orderBy("src_file", "row_no").select("teacher_id").collect()]
        numbers = rows.select("row_no").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert numbers == 20000
    assert ordered == [f"{i:09d}" for i in range(20000)]


def test_json_files_may_leave_keys_out_of_rows(spark, tmp_path):
    first = {h: "x" for h in HEADERS if h != "DOCUMENTO"}
    rows = spark.createDataFrame([(str(first).replace("'", '"'),), ('{"DOCUMENTO": "7"}',)], "value string")
    rows.coalesce(1).write.text(str(tmp_path / "in"))
    for part in (tmp_path / "in").glob("*.txt"):
        (tmp_path / "extract.json").write_text(part.read_text(encoding="utf8"), encoding="utf8")
    found, rejected = sources.read_teachers(spark, str(tmp_path), "json")
    assert found.count() == 2
    assert rejected.isEmpty()


def test_legacy_headers(spark, tmp_path):
    assert normalise_header(" Fecha Actividad ") == "Fecha_Actividad"
    write(tmp_path, "a.csv", [" ID Docente", "Lista Cruzada "], [["1", "2"]])
    names = {"ID_Docente": "teacher_id", "Lista_Cruzada": "crosslist"}
    rows = sources.read_extracts(spark, str(tmp_path), names, legacy_headers=True).rows
    assert [(r.teacher_id, r.crosslist) for r in rows.collect()] == [("1", "2")]


def test_registry_is_taken_by_position_and_may_be_absent(spark, tmp_path):
    (tmp_path / "r.csv").write_text("any,names,here\na-b-202610-1,00001,202610\n", encoding="utf8")
    assert [tuple(r)[:3] for r in sources.read_courses(spark, str(tmp_path / "r.csv")).collect()] == [
        ("a-b-202610-1", "00001", "202610")
    ]
    with pytest.raises(FileNotFoundError):
        sources.read_courses(spark, str(tmp_path / "no.csv"))
    assert sources.read_registry(spark, str(tmp_path / "no.csv")).isEmpty()


def test_roster_keeps_the_listed_terms(spark):
    courses = spark.createDataFrame([("c", "1", "202610V1"), ("d", "2", ""), ("e", "3", None)], "short_name string, nrc string, term string")
    rows = spark.createDataFrame([(" 202610.0 ", 1), ("202610", 2), ("", 3), (None, 4), ("202641", 5)], "term string, row_no int")
    kept = sources.prune_to_terms(rows, courses, cut=True)
    assert sorted(r.row_no for r in kept.collect()) == [1, 2] and kept.columns == rows.columns
    assert sources.prune_to_terms(rows, courses, cut=False).isEmpty()
