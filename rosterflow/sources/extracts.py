"""Reading many extract files with different headers as one DataFrame.

Files are grouped by header, each group is one multi-path read, and the groups are
joined by column name. The first lines of all CSV files come from one distributed pass, and
one file of each different line tells its columns, so the driver's work follows the number
of headers, not of files. JSON rows are parsed once and landed with the keys that they
have; a file's keys are an aggregate of that table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.session import fresh_dir

LOCK_PREFIX = "~$"
#: Errors that lie in a file itself.
UNREADABLE = ("UNABLE_TO_INFER_SCHEMA", "is not a Parquet file", "MALFORMED_CSV_RECORD")
REJECTED_SCHEMA = "src_file string, reason string, missing array<string>"


class Extracts(NamedTuple):
    """Rows of the accepted files and one row per rejected file."""

    rows: DataFrame
    rejected: DataFrame


def normalise_header(name: str) -> str:
    """Older extracts: no blanks around a header, underscores for those inside."""
    return name.strip().replace(" ", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: normalise_header(c) for c in df.columns})


def list_extracts(spark: SparkSession, path: str, file_format: str) -> list[str]:
    """Files of the format below a path, gzipped ones too, without the lock files of open editors. No job is run."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{file_format}{{,.gz}}")
        .option("recursiveFileLookup", True)
    )
    try:
        files = sorted(_plain(unquote(f)) for f in listing.load(path).inputFiles())
    except AnalysisException as error:
        raise FileNotFoundError(f"no extract folder at {path}") from error
    files = [f for f in files if not f.rsplit("/", 1)[-1].startswith(LOCK_PREFIX)]
    if not files:
        raise FileNotFoundError(f"no .{file_format} extract at {path}")
    return files


def header_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file, line``: the first line that is not blank of each text file, in one pass over the files.

    Lines are read as text, without parsing, and a task keeps one line of a file. Only the
    first block of a file is looked at. A file of blank lines has no row.
    """
    lines = spark.read.text(files).where((F.col("_metadata.file_block_start") == 0) & (F.btrim("value") != ""))
    placed = lines.select(F.col("_metadata.file_path").alias("file"), "value", row_number("text").alias("place"))
    return placed.groupBy("file").agg(F.min_by("value", "place").alias("line"))


def _header(spark: SparkSession, file: str, file_format: str) -> tuple[str, ...]:
    """Column names of one file; none for a file that cannot be read."""
    reader = spark.read.option("header", True) if file_format == "csv" else spark.read
    try:
        return tuple(reader.format(file_format).load(file).columns)
    except PySparkException as error:
        if any(kind in str(error) for kind in UNREADABLE):
            return ()
        raise  # a lost executor or a denied read is no property of the file


def _headers(spark: SparkSession, files: list[str], file_format: str) -> dict[str, tuple[str, ...]]:
    """Column names of each file.

    Equal first lines of CSV files are one header. A line with an open quote goes on in the
    next one, so its file is asked by itself. Parquet files are asked one by one.
    """
    alike: dict[str, list[str]] = defaultdict(list)
    found: dict[str, tuple[str, ...]] = dict.fromkeys(files, ())
    if file_format == "csv":
        for row in header_lines(spark, files).toLocalIterator():
            file = _plain(unquote(row.file))
            alike[row.line if row.line.count('"') % 2 == 0 else file].append(file)
    else:
        alike = {f: [f] for f in files}
    with ThreadPoolExecutor(16) as pool:
        told = pool.map(lambda same: _header(spark, same[0], file_format), alike.values())
        for same, header in zip(alike.values(), told, strict=True):
            found.update(dict.fromkeys(same, header))
    return found


def _plain(path: str) -> str:
    return path.replace("file:///", "file:/")


def row_number(file_format: str) -> Column:
    """A number that grows with the position of the row in its file.

    Parquet knows the position. Elsewhere it is the start of the block plus the place
    of the row among those the task reads: a row takes at least a byte, so numbers of
    one block stay below the start of the next.
    """
    if file_format == "parquet":
        return F.col("_metadata.row_index")
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("_metadata.file_block_start") + in_task


def _read_group(
    spark: SparkSession,
    files: list[str],
    header: tuple[str, ...],
    names: Mapping[str, str],
    file_format: str,
    key: Callable[[str], str],
) -> DataFrame:
    reader = spark.read
    if file_format == "csv":
        reader = reader.schema(T.StructType([T.StructField(h, T.StringType()) for h in header])).option("header", True)
    df = reader.format(file_format).load(files)
    lineage = [
        F.col("_metadata.file_path").alias("src_file"),
        row_number(file_format).alias("row_no"),
    ]
    source = {key(h): h for h in header}
    return df.select(
        *[
            (F.col(f"`{source[n]}`") if n in source else F.lit(None).cast("string")).alias(ours)
            for n, ours in names.items()
        ],
        *lineage,
    )


def parse_json(spark: SparkSession, files: list[str], names: Mapping[str, str], key: Callable[[str], str] = str) -> DataFrame:
    """Rows of JSON lines under our column names, with ``keys``: those of ``names`` that the row has.

    One scan. A line is an object, or an array of objects; one that is neither gives a row of
    nulls, as Spark's reader does, and a blank line none.
    """
    lines = spark.read.text(files).where(F.btrim("value") != "")
    kind = T.MapType(T.StringType(), T.StringType())
    many = F.ltrim("value").startswith("[")
    objects = F.when(many, F.from_json("value", T.ArrayType(kind))).otherwise(F.array(F.from_json("value", kind)))
    lineage = [F.col("_metadata.file_path").alias("src_file"), row_number("json").alias("row_no")]
    rows = lines.select(objects.alias("objects"), *lineage).select(F.explode_outer("objects").alias("object"), "src_file", "row_no")
    if key is not str:
        named = F.transform_keys("object", lambda k, _: F.replace(F.btrim(k), F.lit(" "), F.lit("_")))
        rows = rows.withColumn("object", named)
    given = [F.when(F.map_contains_key("object", theirs), F.lit(theirs)) for theirs in names]
    return rows.select(
        *[F.col("object").getItem(theirs).alias(ours) for theirs, ours in names.items()],
        "src_file",
        "row_no",
        F.array_compact(F.array(*given)).alias("keys"),
    )


def _json_extracts(spark: SparkSession, files: list[str], names: Mapping[str, str], key: Callable[[str], str]) -> tuple[DataFrame, dict[str, tuple[str, ...]]]:
    """The rows of all files, landed, and the keys that each file has in some row; none if no row has any."""
    path = fresh_dir(spark, "json-extracts")
    parsed = parse_json(spark, files, names, key)
    parsed.write.parquet(path)
    landed = spark.read.schema(parsed.schema).parquet(path)
    found: dict[str, set[str]] = {f: set() for f in files}
    for row in landed.select("src_file", F.explode("keys").alias("key")).distinct().toLocalIterator():
        found[_plain(unquote(row.src_file))].add(row.key)
    return landed.drop("keys"), {f: tuple(sorted(k)) for f, k in found.items()}


def read_files(
    spark: SparkSession,
    files: list[str],
    required: Mapping[str, str],
    optional: Mapping[str, str] | None = None,
    file_format: str = "csv",
    legacy_headers: bool = False,
) -> Extracts:
    """The rows of those of ``files`` that hold the required columns, and the others as rejected; no rows if none does."""
    names = {**required, **(optional or {})}
    key = normalise_header if legacy_headers else str
    if file_format == "json":
        rows, headers = _json_extracts(spark, files, names, key)
    else:
        headers = {f: tuple(h) for f, h in _headers(spark, files, file_format).items()}
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    rejected: list[tuple[str, str, list[str]]] = []
    for file, header in headers.items():
        missing = sorted(set(required) - {key(h) for h in header})
        if not header:
            rejected.append((file, "unreadable", missing))
        elif missing:
            rejected.append((file, "missing_columns", missing))
        else:
            groups[header].append(file)
    table = spark.createDataFrame(rejected, REJECTED_SCHEMA)
    if not groups:
        columns = ", ".join(f"`{c}` string" for c in names.values())
        return Extracts(spark.createDataFrame([], f"{columns}, src_file string, row_no bigint"), table)
    if file_format == "json":
        bad = table.select(F.col("src_file").alias("_bad"))
        plain = F.url_decode(F.replace("src_file", F.lit("file:///"), F.lit("file:/")))
        return Extracts(rows.join(bad, plain == F.col("_bad"), "left_anti") if rejected else rows, table)
    reads = [_read_group(spark, some, header, names, file_format, key) for header, some in groups.items()]
    return Extracts(reduce(DataFrame.unionByName, reads), table)


def read_extracts(
    spark: SparkSession,
    path: str,
    required: Mapping[str, str],
    optional: Mapping[str, str] | None = None,
    file_format: str = "csv",
    legacy_headers: bool = False,
) -> Extracts:
    """All files below ``path`` that hold the required columns, under our column names.

    Raises FileNotFoundError when there is no file and ValueError when every file is
    rejected.
    """
    files = list_extracts(spark, path, file_format)
    found = read_files(spark, files, required, optional, file_format, legacy_headers)
    if found.rejected.count() == len(files):
        raise ValueError(f"no valid extract at {path}: {[tuple(r) for r in found.rejected.collect()]}")
    return found
