from __future__ import annotations

import datetime as dt

import pytest

from rosterflow import JobParams, Process, parse_since


def test_since_argument():
    assert parse_since([]) is None
    assert parse_since(["19/03/26"], dt.date(2026, 3, 19)) == dt.date(2026, 3, 19)
    with pytest.raises(ValueError, match="future"):
        parse_since(["20/03/26"], dt.date(2026, 3, 19))
    with pytest.raises(ValueError, match="at most one"):
        parse_since(["19/03/26", "20/03/26"])
    with pytest.raises(ValueError):
        parse_since(["2026-03-19"])


def test_process_names():
    assert Process.of(None) is Process.ENROL
    assert Process.of("Desmatricular") is Process.DROP
    assert Process.of("clean_up") is Process.CLEAN_UP
    with pytest.raises(ValueError, match="unknown process"):
        Process.of("Other")


def test_coordinators_lie_beside_the_users():
    def params(**more):
        return JobParams(courses_path="c", users_path="/in/users/list.csv", output_dir="o", run_id="r", **more)

    assert params().coordinators_location() == "/in/users/Coordinadores.csv"
    assert params(coordinators_path="/in/k.csv").coordinators_location() == "/in/k.csv"
