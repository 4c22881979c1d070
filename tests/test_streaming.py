"""Files landed by a stream, in several runs, equal one batch read."""

from __future__ import annotations

from rosterflow import schemas, sources
from rosterflow.streaming import land_stream, stream_extracts
from tests.test_sources import HEADERS, teacher


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*schemas.TEACHER_COLUMNS, *schemas.LINEAGE).collect())


def test_files_are_landed_once(spark, tmp_path):
    folder, landed = str(tmp_path / "in"), str(tmp_path / "landed")

    def arrive(*numbers):
        rows = spark.createDataFrame([teacher(n) for n in numbers], ", ".join(f"`{h}` string" for h in HEADERS))
        rows.coalesce(1).write.mode("append").parquet(folder)

    def land():
        rows = stream_extracts(spark, folder, schemas.TEACHER_HEADERS)
        land_stream(rows, landed, str(tmp_path / "checkpoint")).awaitTermination(120)

    arrive(1, 2)
    land()
    arrive(3)
    land()
    land()
    batch = sources.read_teachers(spark, folder, "parquet").rows
    assert rows_of(sources.read_landed(spark, landed)) == rows_of(batch)
    assert len(rows_of(batch)) == 3
