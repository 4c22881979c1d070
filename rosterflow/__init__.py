"""Registrar extracts to bulk-load commands for a learning-management system, on Spark."""

from rosterflow.params import JobParams, Process, parse_since
from rosterflow.rules import DEFAULT_RULES, Rules
from rosterflow.session import build_session

__all__ = ["DEFAULT_RULES", "JobParams", "Process", "Rules", "build_session", "parse_since"]
