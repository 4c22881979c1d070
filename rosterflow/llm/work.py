"""Written tables in the folder that all executors share, and results beside the rows they are of."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.session import fresh_dir

#: Bytes of a row group that a task holds while it writes, and of a batch that goes to Python.
ROW_GROUP, BATCH = 16 << 20, 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound batches of long texts by bytes, unless the cluster's settings say how."""
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, str(BATCH))


def release() -> None:
    """Give memory that batches or groups have freed back to the system: a worker that goes on or waits has little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: its lineage ends here, and no executor's loss repeats it."""
    spark = df.sparkSession
    small_batches(spark)
    path = fresh_dir(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """The column of this very name, whatever signs it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def beside(docs: DataFrame, made: Column) -> tuple[DataFrame, str]:
    """``docs`` with ``made`` as a column whose name no other has, in any case; and that name."""
    small_batches(docs.sparkSession)
    taken, name = {c.lower() for c in docs.columns}, "made"
    while name in taken:
        name += "_"
    return docs.select("*", made.alias(name)), name


def with_fields(docs: DataFrame, made: Column, names: list[str]) -> DataFrame:
    """``docs`` with the fields ``names`` of the struct ``made``. Columns of these names, in any case, are replaced."""
    results = {n.lower() for n in names}
    rows, name = beside(docs, made)
    return rows.select(*(quoted(c) for c in docs.columns if c.lower() not in results), *(F.col(f"{name}.{n}").alias(n) for n in names))


def of_text(run: Callable[[Iterator[pa.Array]], Iterator[pa.Table]], fields: StructType) -> Callable[..., Column]:
    """A function of text columns to a struct of ``fields``; ``run`` makes a table of each batch.

    Only the texts go to Python, and only the results come back; the other columns of a row
    wait in the JVM. Spark runs it once a row, wherever its result is used.
    """

    def structs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for table in run(batches):
            table = table.combine_chunks()
            columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
            yield pa.StructArray.from_arrays(columns, fields=[pa.field(n, c.type) for n, c in zip(table.column_names, columns)])
        release()

    return F.arrow_udf(structs, fields).asNondeterministic()
