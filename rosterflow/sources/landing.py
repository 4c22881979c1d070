"""Landing extract folders step by step: a run reads only files that are new or changed.

``base/rows/batch=...`` holds the rows that a run read, and ``base/manifest`` one row for each
file it looked at: its size, time of change, the batch, and whether it was accepted. The
manifest is written last, so rows of a run that was killed belong to no manifest row and are
never read; the next run reads their files again. A file's rows are those of the last batch
that looked at it, so a changed file replaces its old rows and a removed one loses them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.sources.extracts import LOCK_PREFIX, read_files

ACCEPTED, GONE = "accepted", "gone"
_MANIFEST = "src_file string, size bigint, changed timestamp, batch string, at bigint, state string, missing array<string>"


class Landing(NamedTuple):
    """What a run found: its batch (null if nothing was new), and how many files it read, rejected and missed."""

    batch: str | None
    n_read: int
    n_rejected: int
    n_gone: int


def _file(c: str):
    """One spelling of a file name, as listings and rows have different ones.

    Every landed row has one, so names without an escape are not decoded, and those that
    listings give need no pattern.
    """
    name = F.col(c)
    plain = F.when(F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)
    few = F.startswith(plain, F.lit("file:///")) & ~F.startswith(plain, F.lit("file:////"))
    local = F.when(few, F.concat(F.lit("file:/"), F.substring(plain, 9, 1 << 30))).otherwise(F.regexp_replace(plain, "^file:/+", "file:/"))
    return F.when(F.startswith(plain, F.lit("file://")), local).otherwise(plain)


def list_files(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """``src_file, size, changed`` of the extract files below ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{file_format}").option("recursiveFileLookup", True)
    try:
        listed = files.load(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no extract folder at {path}") from error
    named = listed.select(_file("path").alias("src_file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))
    return named.where(~F.element_at(F.split("src_file", "/"), -1).startswith(LOCK_PREFIX))


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The last manifest row of each file ever looked at."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{base}/manifest")
    except AnalysisException:
        rows = spark.createDataFrame([], _MANIFEST)
    last = F.max_by(F.struct("size", "changed", "batch", "at", "state", "missing"), F.struct("at", "batch")).alias("last")
    return rows.groupBy("src_file").agg(last).select("src_file", "last.*")


def land_new(
    spark: SparkSession,
    path: str,
    base: str,
    required: Mapping[str, str],
    optional: Mapping[str, str] | None = None,
    file_format: str = "csv",
    legacy_headers: bool = False,
) -> Landing:
    """Land the rows of the files below ``path`` that the manifest of ``base`` does not hold as they are now."""
    known = read_manifest(spark, base)
    listed = list_files(spark, path, file_format)
    held = known.where(F.col("state") != GONE)
    new = listed.join(held.select("src_file", "size", "changed"), ["src_file", "size", "changed"], "left_anti")
    gone = held.join(listed.select("src_file"), "src_file", "left_anti")
    found, lost = new.collect(), gone.select("src_file").collect()  # names of changed files, as any listing has them
    if not found and not lost:
        return Landing(None, 0, 0, 0)
    batch = uuid.uuid4().hex
    at = F.unix_micros(F.current_timestamp()).alias("at")
    entries, n_rejected = spark.createDataFrame([], _MANIFEST), 0
    if found:
        rows, rejected = read_files(spark, [r.src_file for r in found], required, optional, file_format, legacy_headers)
        rows.withColumn("src_file", _file("src_file")).write.parquet(f"{base}/rows/batch={batch}")
        n_rejected = rejected.count()
        bad = rejected.select(_file("src_file").alias("src_file"), "reason", "missing")
        looked = spark.createDataFrame(found, listed.schema).join(bad, "src_file", "left")
        entries = looked.select("src_file", "size", "changed", F.lit(batch).alias("batch"), at, F.coalesce("reason", F.lit(ACCEPTED)).alias("state"), "missing")
    if lost:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("size", "bigint"), ("changed", "timestamp"))]
        names = spark.createDataFrame(lost, "src_file string")
        entries = entries.unionByName(names.select("src_file", *none, F.lit(batch).alias("batch"), at, F.lit(GONE).alias("state"), F.lit(None).cast("array<string>").alias("missing")))
    entries.coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return Landing(batch, len(found), n_rejected, len(lost))


def read_rows(spark: SparkSession, base: str) -> DataFrame:
    """The rows of all accepted files as they were last landed."""
    current = read_manifest(spark, base).where(F.col("state") == ACCEPTED).select("src_file", "batch")
    rows = spark.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows")
    return rows.join(current, ["src_file", "batch"], "left_semi").drop("batch")


def read_rejected(spark: SparkSession, base: str) -> DataFrame:
    """``src_file, reason, missing`` of the files that were rejected when last looked at."""
    return read_manifest(spark, base).where(~F.col("state").isin(ACCEPTED, GONE)).select("src_file", F.col("state").alias("reason"), "missing")
