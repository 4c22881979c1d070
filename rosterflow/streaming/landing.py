"""Landing extract files as they arrive.

The same columns and lineage as a batch read, kept in a roster table. Rows are only landed
here: deduplication needs all files, so the jobs do it. ``land_checked`` checks arriving files
as a batch read does; ``land_stream`` takes Parquet files of known columns as they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rosterflow.sources.extracts import LOCK_PREFIX, read_files, row_number


def stream_extracts(spark: SparkSession, path: str, names: Mapping[str, str]) -> DataFrame:
    """Parquet files below ``path`` as a stream, under our column names.

    Parquet only: it alone knows the position of a row in its file while streaming.
    """
    schema = T.StructType([T.StructField(header, T.StringType()) for header in names])
    files = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .parquet(path)
    )
    return files.select(
        *[F.col(f"`{theirs}`").alias(ours) for theirs, ours in names.items()],
        F.col("_metadata.file_path").alias("src_file"),
        row_number("parquet").alias("row_no"),
    )


def land_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Land every file not landed yet, each exactly once, and stop.

    ``checkpoint`` must lie in a folder that all executors share.
    """
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("term")
        .trigger(availableNow=True)
        .start(path)
    )


def land_checked(
    spark: SparkSession,
    path: str,
    required: Mapping[str, str],
    base: str,
    checkpoint: str,
    optional: Mapping[str, str] | None = None,
    file_format: str = "parquet",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Land every file not landed yet, through the plan of a batch read, and stop.

    The stream is one of file names. A batch reads its files with their headers checked:
    accepted rows go to ``base/rows/batch=N`` and the others' names to ``base/rejected/batch=N``.
    A batch that is repeated after a failure replaces its own folders, so each file is
    landed once. ``checkpoint`` must lie in a folder that all executors share.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"*.{file_format}")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path")
    )

    def land(batch: DataFrame, number: int) -> None:
        files = [r.path for r in batch.collect()]  # at most files_per_batch names
        files = [f for f in files if not f.rsplit("/", 1)[-1].startswith(LOCK_PREFIX)]
        if not files:
            return
        rows, rejected = read_files(spark, files, required, optional, file_format)
        rows.write.mode("overwrite").parquet(f"{base}/rows/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{base}/rejected/batch={number}")

    return names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_checked(spark: SparkSession, base: str) -> DataFrame:
    """All rows that ``land_checked`` has landed."""
    return spark.read.parquet(f"{base}/rows").drop("batch")
