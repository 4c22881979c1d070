"""Column expressions of the roster jobs."""

from rosterflow.functions.courses import (
    course_id,
    cut_term,
    detail_link,
    legacy_course_id,
    legacy_number,
    oldest_number,
    programme_suffix,
    short_name_parts,
)
from rosterflow.functions.documents import doc_label, doc_number
from rosterflow.functions.ids import INVALID_IDS, is_invalid_id, is_invalid_padded, normalise_id, pad_id, roster_id
from rosterflow.functions.text import clean_text, strip_decimal, title_case, trim_all
from rosterflow.functions.times import active_since, parse_activity

__all__ = [
    "INVALID_IDS",
    "active_since",
    "clean_text",
    "course_id",
    "cut_term",
    "detail_link",
    "doc_label",
    "doc_number",
    "is_invalid_id",
    "is_invalid_padded",
    "legacy_course_id",
    "legacy_number",
    "normalise_id",
    "oldest_number",
    "pad_id",
    "parse_activity",
    "programme_suffix",
    "roster_id",
    "short_name_parts",
    "strip_decimal",
    "title_case",
    "trim_all",
]
