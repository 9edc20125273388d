"""Sort keys with NULL as the largest value: last ascending, first descending."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sort_keys(*names: str) -> list[Column]:
    """Sort columns from names; a leading minus sign means descending."""
    return [
        F.col(name[1:]).desc_nulls_first() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in names
    ]
