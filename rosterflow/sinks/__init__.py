"""Outputs: command lists, counts, audit, registry and landed rosters."""

from rosterflow.sinks.lists import (
    arranged,
    commit_registry,
    land_roster,
    read_course_lists,
    run_path,
    write_audit,
    write_consolidated,
    write_course_counts,
    write_course_lists,
    write_link_errors,
    write_registry,
    write_table,
)

__all__ = [
    "arranged",
    "commit_registry",
    "land_roster",
    "read_course_lists",
    "run_path",
    "write_audit",
    "write_consolidated",
    "write_course_counts",
    "write_course_lists",
    "write_link_errors",
    "write_registry",
    "write_table",
]
