"""Logical plans of the jobs and the jobs themselves."""

from rosterflow.plans.enrolment import (
    coordinator_commands,
    legacy_student_commands,
    matched_students,
    matched_teachers,
    staff_commands,
    student_commands,
    teacher_commands,
)
from rosterflow.plans.jobs import (
    JobOutputs,
    RegistryOutputs,
    run_registry_job,
    run_staff_job,
    run_student_job,
)

__all__ = [
    "JobOutputs",
    "RegistryOutputs",
    "coordinator_commands",
    "legacy_student_commands",
    "matched_students",
    "matched_teachers",
    "run_registry_job",
    "run_staff_job",
    "run_student_job",
    "staff_commands",
    "student_commands",
    "teacher_commands",
]
