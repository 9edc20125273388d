"""Aggregation of facts along a chain of lookups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.operators.joins import join_on, key_pairs
from tallyframe.operators.sizes import fits_broadcast


@dataclass(frozen=True)
class Hop:
    """One inner join of the chain: the table, its key pairs, and the columns to carry on."""

    table: DataFrame
    on: Sequence[str | tuple[str, str]]
    take: Sequence[str] = field(default=())


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be merged from partial results."""

    name: str
    kind: str
    column: str

    def first(self) -> Column:
        return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[self.kind](self.column).alias(self.name)

    def merge(self) -> Column:
        return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[self.kind](self.name).alias(self.name)


def _aggregate(df: DataFrame, by: Sequence[str], measures: Sequence[Measure], merged: bool) -> DataFrame:
    if not measures:
        return df.select(*by).distinct()
    return df.groupBy(*by).agg(*[m.merge() if merged else m.first() for m in measures])


def roll_up(
    facts: DataFrame,
    hops: Sequence[Hop],
    by: Sequence[str],
    measures: Sequence[Measure],
    eager: bool | None = None,
) -> DataFrame:
    """Join ``facts`` along ``hops`` and aggregate by ``by``; without measures, the distinct groups.

    Before a hop that must shuffle, rows are first aggregated on the hop's key:
    the aggregate and the join share one shuffle, its map side shrinks the data,
    and a hot key becomes a single row. A hop to a table small enough to
    broadcast needs no shuffle, so nothing is aggregated before it. ``eager``
    overrides that choice.
    """
    current, merged = facts, False
    for n, hop in enumerate(hops):
        left = [l for l, _ in key_pairs(hop.on)]
        right = [r for _, r in key_pairs(hop.on)]
        later = set(by).union(*[[l for l, _ in key_pairs(h.on)] for h in hops[n:]])
        carried = [name for name in current.columns if name in later]
        table = hop.table.select(*dict.fromkeys([*right, *hop.take]))
        shuffles = not fits_broadcast(table) if eager is None else eager
        # Columns carried beside the key would cost a shuffle of their own.
        if shuffles and set(carried) == set(left):
            current = _aggregate(current, left, measures, merged)
            merged = True
        current = join_on(current, table, hop.on)
    return _aggregate(current, by, measures, merged)


def count_by_value(
    counts: DataFrame, group: str, value: str, columns: dict[str, str], number: str = "n"
) -> DataFrame:
    """Counts per (group, value) turned into one row per group with a column for each listed value.

    Values compare without regard to letter case; groups holding none of them keep zeros.
    """

    def column(name: str, wanted: str) -> Column:
        found = F.sum(F.when(F.upper(value) == wanted.upper(), F.col(number)))
        return F.coalesce(found, F.lit(0)).cast("bigint").alias(name)

    return counts.groupBy(group).agg(*[column(name, wanted) for name, wanted in columns.items()])
