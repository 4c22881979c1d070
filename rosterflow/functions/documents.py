"""Identity document labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.text import strip_decimal


def doc_number(c: Column) -> Column:
    """Whole numbers of any length grouped in thousands with dots; anything else as it came.

    Most are one to nine plain digits, which are cut by their length without further patterns.
    """
    raw = strip_decimal(c)
    text = F.btrim(raw)
    n = F.length(text)
    low = F.substring(text, n - 2, F.lit(3))
    short = (
        F.when(n <= 3, text)
        .when(n <= 6, F.concat(F.left(text, n - 3), F.lit("."), low))
        .otherwise(F.concat(F.left(text, n - 6), F.lit("."), F.substring(text, n - 5, F.lit(3)), F.lit("."), low))
    )
    digits = F.regexp_replace(text, r"^(-?)[+]?0*(?=[0-9])", "$1")
    grouped = F.regexp_replace(F.regexp_replace(digits, r"^-0$", "0"), r"(?<=[0-9])(?=([0-9]{3})+$)", ".")
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), grouped).otherwise(raw)
    return F.when(text.rlike(r"^[1-9][0-9]{0,8}\z"), short).otherwise(whole)


def doc_label(doc_type: Column, doc_no: Column) -> Column:
    """``TYPE. number``; the number alone without a type; empty without a number."""
    return F.when(doc_no.isNull(), F.lit("")).otherwise(F.concat_ws(". ", doc_type, doc_number(doc_no)))
