"""Text labels to 0 or 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .text import as_number, as_text


def label_from_words(value: Column, numeric: bool = False) -> Column:
    """Malicious words win over benign words, words win over numbers, anything else is 0."""
    if numeric:
        return label_from_number(value, numeric)
    text = F.lower(as_text(value))
    return (
        F.when(text.rlike("|".join(fixed.MALICIOUS_WORDS)), 1)
        .when(text.rlike("|".join(fixed.BENIGN_WORDS)), 0)
        .when(as_number(value) > 0, 1)
        .otherwise(0)
        .cast("byte")
    )


def label_from_number(value: Column, numeric: bool = False) -> Column:
    return (as_number(value, numeric) > 0).cast("byte")
