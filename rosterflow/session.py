"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

# What the plans of this package count on. All are defaults of current Spark but
# stated here, because the handling of hot keys rests on them: the optimiser splits
# hot join partitions, coalesces small ones and broadcasts only sides whose measured
# size is under the limit.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
}


def build_session(app_name: str = "rosterflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; on a cluster ``master`` comes from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a session that names none (a local test) gets one, in its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/rosterflow/{name}-{uuid.uuid4().hex}"


def share_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHARED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(SparkFiles.getRootDirectory()) / "rosterflow.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHARED.add(context.applicationId)


_SHARED: set[str] = set()
