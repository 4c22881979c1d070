"""Upkeep of the course registry from course links.

The short name of a course comes from a catalogue table of the learning system,
joined on the course id that ends the link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions import course_id, detail_link, short_name_parts
from rosterflow.operators.first import first_rows
from rosterflow.schemas import COURSE_COLUMNS

# Codes of the link errors.
NO_COURSE_ID, NOT_IN_CATALOGUE = "no_course_id", "not_in_catalogue"


def link_ids(links: DataFrame) -> DataFrame:
    """Non-null links with the course id each ends in, null where there is none."""
    return links.where(F.col("link").isNotNull()).withColumn("course_id", course_id(F.col("link")))


def unique_catalogue(catalogue: DataFrame) -> DataFrame:
    """One short name per course id."""
    named = catalogue.where(F.col("course_id").isNotNull() & (F.col("short_name") != ""))
    return first_rows(named.select("course_id", "short_name"), ["course_id"], ["short_name"])


def link_errors(links: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per link without an id, and per link whose course is not in the catalogue.

    Links without an id skip the join, so they never gather under one null key.
    """
    rows = link_ids(links)
    no_id = rows.where(F.col("course_id").isNull()).select(
        F.lit("N/A").alias("course_id"), F.col("link").alias("url"), F.lit(NO_COURSE_ID).alias("error")
    )
    known = unique_catalogue(catalogue).select("course_id")
    missing = rows.where(F.col("course_id").isNotNull()).join(known, "course_id", "left_anti")
    return no_id.unionByName(
        missing.select(
            "course_id",
            detail_link(F.col("course_id")).alias("url"),
            F.lit(NOT_IN_CATALOGUE).alias("error"),
        )
    )


def found_courses(links: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Short names behind the links, each once, with the first link that names it.

    Links are reduced to one row per id before the join. ``row_no`` orders the links.
    """
    ids = (
        link_ids(links)
        .where(F.col("course_id").isNotNull())
        .groupBy("course_id")
        .agg(F.min("row_no").alias("row_no"))
    )
    named = ids.join(unique_catalogue(catalogue), "course_id")
    return named.groupBy("short_name").agg(F.min("row_no").alias("row_no"))


def unknown_courses(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Found short names that the registry does not hold."""
    return found.join(registry.select("short_name").distinct(), "short_name", "left_anti")


def new_courses(links: DataFrame, catalogue: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows to add: new, well-formed short names with their number and term."""
    return well_formed(unknown_courses(found_courses(links, catalogue), registry))


def well_formed(unknown: DataFrame) -> DataFrame:
    """Short names of four parts with their number and term."""
    parts = unknown.withColumn(
        "_parts", short_name_parts(F.col("short_name"))
    )
    return parts.where(F.col("_parts").isNotNull()).select(
        "short_name", F.col("_parts.nrc").alias("nrc"), F.col("_parts.term").alias("term"), "row_no"
    )


def malformed_courses(links: DataFrame, catalogue: DataFrame, registry: DataFrame) -> DataFrame:
    """New short names that do not have four parts, as audit events."""
    return malformed(unknown_courses(found_courses(links, catalogue), registry))


def malformed(unknown: DataFrame) -> DataFrame:
    """Short names that do not have four parts, as audit events."""
    return unknown.where(short_name_parts(F.col("short_name")).isNull()).select(
        "short_name", F.lit("malformed_short_name").alias("event"), F.col("short_name").alias("detail")
    )


def merged_registry(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry followed by the new rows: a set, for joins. ``ordered_registry`` is the table to write."""
    return registry.select(*COURSE_COLUMNS).unionByName(new.select(*COURSE_COLUMNS))


def ordered_registry(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry in its own order (file and row), then the new rows in the order of their links."""
    known = registry.select(*COURSE_COLUMNS, F.lit(0).alias("block"), "src_file", F.col("row_no").cast("bigint").alias("row_no"))
    added = new.select(*COURSE_COLUMNS, F.lit(1).alias("block"), F.lit("").alias("src_file"), F.col("row_no").cast("bigint").alias("row_no"))
    return known.unionByName(added).orderBy("block", "src_file", "row_no", "short_name").select(*COURSE_COLUMNS)
