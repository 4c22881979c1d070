"""The user directory of the learning system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import clean_text, is_invalid_padded, normalise_id, roster_id, strip_decimal
from rosterflow.operators.first import first_rows
from rosterflow.schemas import LINEAGE, USER_COLUMNS


def clean_users(users: DataFrame) -> DataFrame:
    """First row per normalised id, all six columns as clean text; absent ones empty."""
    present = set(users.columns)
    cleaned = {
        c: clean_text(F.col(c)) if c in present else F.lit("")
        for c in USER_COLUMNS
        if c not in ("user_name", "org_role_id")
    }
    role = strip_decimal(clean_text(F.col("org_role_id"))) if "org_role_id" in present else F.lit("")
    rows = users.withColumns(
        {"user_name": normalise_id(F.col("user_name")), "org_role_id": role, **cleaned}
    )
    order = [c for c in (*LINEAGE, *USER_COLUMNS) if c in rows.columns and c != "user_name"]
    named = rows.where(F.col("user_name") != "")
    return first_rows(named, ["user_name"], order).select(*USER_COLUMNS)


def user_ids(users: DataFrame) -> DataFrame:
    """Distinct padded ids, the lean form of the directory that the student job needs."""
    ids = users.select(roster_id(F.col("user_name")).alias("user_id"))
    return ids.where(~is_invalid_padded(F.col("user_id"))).distinct()


def with_known_flag(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ``is_known``: whether ``user_id`` is in the directory.

    ``ids`` holds each id once, so no row is multiplied.
    """
    flagged = ids.select("user_id", F.lit(True).alias("_known"))
    return (
        rows.join(flagged, "user_id", "left")
        .withColumn("is_known", F.coalesce(F.col("_known"), F.lit(False)))
        .drop("_known")
    )


def known_users(people: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``user_id`` is in the directory."""
    return people.join(ids, "user_id", "left_semi")


def new_users(people: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``user_id`` is not in the directory."""
    return people.join(ids, "user_id", "left_anti")
