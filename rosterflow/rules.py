"""Enrolment rules: the constant tables of the jobs, replaceable per run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Programme suffix -> (role, organisation unit).
PROGRAMME_CLASSES = {
    "41": ("Student_fa", "CVFA"),
    "42": ("Student_fa", "CVFA"),
    "10": ("Student_pr", "CVPR"),
    "11": ("Student_pr", "CVPR"),
    "20": ("Student_pr", "CVPR"),
    "21": ("Student_pr", "CVPR"),
    "50": ("Student_ex", "CVFC"),
    "17": ("Student_te", "CVTE"),
    "27": ("Student_te", "CVTE"),
    "37": ("Student_te", "CVTE"),
}

# Fixed values: (programme suffix, partner) -> (role, organisation unit).
PARTNER_CLASSES = {
    ("41", "AP"): ("Student_ap", "CVLA"),
    ("42", "AP"): ("Student_ap", "CVLA"),
}

# Class chosen by hand in the legacy policy -> (role, organisation unit).
LEGACY_CLASSES = {
    "1": ("Student_fa", "CVFA"),
    "2": ("Student_pr", "CVPR"),
    "3": ("Student_ex", "CVFC"),
    "4": ("Student_ap", "CVLA"),
}

# Role a known user held -> organisation unit a new teacher leaves.
FORMER_ROLE_UNITS = {
    "150": "CVTE",
    "143": "CVLA",
    "138": "CVPR",
    "137": "CVFC",
    "136": "CVFA",
    "135": "CVFA",
}


@dataclass(frozen=True)
class Rules:
    programme_classes: Mapping[str, tuple[str, str]] = field(default_factory=lambda: PROGRAMME_CLASSES)
    partner_classes: Mapping[tuple[str, str], tuple[str, str]] = field(default_factory=lambda: PARTNER_CLASSES)
    legacy_classes: Mapping[str, tuple[str, str]] = field(default_factory=lambda: LEGACY_CLASSES)
    former_role_units: Mapping[str, str] = field(default_factory=lambda: FORMER_ROLE_UNITS)
    root_unit: str = "UPBV"
    course_role: str = "Student"
    teacher_role: str = "Moderador"
    coordinator_role: str = "Coordinador"
    home_partner: str = "BS"
    paying_partner: str = "AP"
    enrolled: str = "Inscrito"
    cancelled: str = "Cancelado"
    removed: str = "Eliminado"

    def programme_class(self, suffix: Column, partner: Column) -> tuple[Column, Column]:
        """Role and organisation unit, null for an unknown suffix."""
        special = [
            ((suffix == s) & (partner == p), value) for (s, p), value in self.partner_classes.items()
        ]
        return _lookup(special + [(suffix.isin(keys), v) for v, keys in _by_value(self.programme_classes)])

    def legacy_class(self, code: Column) -> tuple[Column, Column]:
        """Role and unit of a class chosen by hand; unknown codes have no unit."""
        role, unit = _lookup([(code.isin(keys), v) for v, keys in _by_value(self.legacy_classes)])
        return F.coalesce(role, F.lit(self.course_role)), F.coalesce(unit, F.lit(""))

    def has_left(self, status: Column) -> Column:
        """True for an explicit cancellation or removal only: a blank status takes nobody out."""
        return F.coalesce(status.isin(self.cancelled, self.removed), F.lit(False))

    def unknown_status(self, status: Column) -> Column:
        """True for a text that neither enrols nor takes out."""
        text = F.btrim(F.coalesce(status, F.lit("")))
        return ~text.isin("", self.enrolled, self.cancelled, self.removed)

    def former_unit(self, role_id: Column) -> Column:
        """Unit that a known user leaves on becoming a teacher, or null."""
        units = [F.when(role_id.isin(keys), F.lit(u)) for u, keys in _by_value(self.former_role_units)]
        return F.coalesce(*units)


def _by_value(table: Mapping) -> list[tuple]:
    """The table turned round: each value once with all its keys."""
    turned: dict = {}
    for key, value in table.items():
        turned.setdefault(value, []).append(key)
    return list(turned.items())


def _lookup(cases: list[tuple[Column, tuple[str, str]]]) -> tuple[Column, Column]:
    """Role and unit of the first condition that holds."""
    return tuple(F.coalesce(*[F.when(c, F.lit(value[i])) for c, value in cases]) for i in (0, 1))


DEFAULT_RULES = Rules()
