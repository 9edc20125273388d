"""Code-to-label mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The audience text for each film rating.
AUDIENCE = {
    "G": "All ages admitted",
    "PG": "Parental Guidance Suggested",
    "PG-13": "Parents Strongly Cautioned under 13",
    "R": "17+ or with parent",
    "NC-17": "18+ only",
}


def label(column: Column, labels: Mapping[str, str]) -> Column:
    """The label of each code; a code without one gives NULL."""
    case = None
    for code, text in labels.items():
        case = F.when(column == code, text) if case is None else case.when(column == code, text)
    return case
