"""The events of an audit read landed tables, not the rosters once an event."""

from __future__ import annotations

from harness.queries import QUERIES


def test_events_read_landed_rows(spark, sf_dir):
    files = QUERIES["audit_events"](spark, sf_dir).inputFiles()
    assert files and not [f for f in files if "/lineitem" in f or "/orders" in f]
