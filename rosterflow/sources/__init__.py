"""Inputs: extract folders, directories, the course registry and landed rosters."""

from rosterflow.sources.extracts import Extracts, list_extracts, normalise_headers, read_extracts, read_files
from rosterflow.sources.landing import Landing, land_new, read_rejected, read_rows
from rosterflow.sources.tables import (
    current_registry,
    ingest_students,
    ingest_teachers,
    prune_to_terms,
    read_bridge,
    read_coordinators,
    read_courses,
    read_landed,
    read_links,
    read_registry,
    read_students,
    read_teachers,
    read_users,
)

__all__ = [
    "Extracts",
    "Landing",
    "current_registry",
    "ingest_students",
    "ingest_teachers",
    "land_new",
    "list_extracts",
    "normalise_headers",
    "prune_to_terms",
    "read_bridge",
    "read_coordinators",
    "read_courses",
    "read_extracts",
    "read_files",
    "read_landed",
    "read_links",
    "read_registry",
    "read_rejected",
    "read_rows",
    "read_students",
    "read_teachers",
    "read_users",
]
