"""Reports kept up by change sets instead of read again from their tables.

A state holds, for each group, the row count, sums with the count of their values, and extremes. Inserted and removed rows move counts and sums by signed deltas. A
removed row can only lower a group's extreme if it held it; those groups, and no others, are looked up in the table again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyframe.operators.joins import exists_in


@dataclass(frozen=True)
class Kept:
    """What a report keeps for each group: sums and largest values of columns. Group columns are compared with NULL as a value."""

    groups: tuple[str, ...]
    sums: tuple[str, ...] = ()
    largest: tuple[str, ...] = ()

    def state(self, rows: DataFrame) -> DataFrame:
        """The state over all of some rows."""
        return rows.groupBy(*self.groups).agg(
            F.count("*").alias("n_rows"),
            *[F.sum(c).alias(f"sum_{c}") for c in self.sums],
            *[F.count(c).alias(f"count_{c}") for c in self.sums],
            *[F.max(c).alias(f"max_{c}") for c in self.largest],
        )

    def apply(self, state: DataFrame, inserted: DataFrame, removed: DataFrame, table: DataFrame | None = None) -> DataFrame:
        """The state after a change set. An update is its old rows removed and its new rows inserted.

        Groups without rows go. ``table``, the rows after the change, is read only for groups whose largest value may have been removed, and is needed only
        if largest values are kept.
        """
        if self.largest and table is None:
            raise ValueError("largest values need the table for groups that lose theirs")
        plus, minus = self.state(inserted), self.state(removed)
        counted = ["n_rows", *[f"{kind}_{c}" for kind in ("sum", "count") for c in self.sums]]
        largest = [f"max_{c}" for c in self.largest]
        types = dict(state.dtypes)
        parts = [
            state.select(*self.groups, *counted, *largest, *[F.lit(None).cast(types[m]).alias(f"lost_{m}") for m in largest]),
            plus.select(*self.groups, *counted, *largest, *[F.lit(None).cast(types[m]).alias(f"lost_{m}") for m in largest]),
            minus.select(*self.groups, *[(-F.col(c)).alias(c) for c in counted], *[F.lit(None).cast(types[m]).alias(m) for m in largest], *[F.col(m).alias(f"lost_{m}") for m in largest]),
        ]
        moved = parts[0].union(parts[1]).union(parts[2]).groupBy(*self.groups).agg(
            *[F.sum(c).alias(c) for c in counted], *[F.max(m).alias(m) for m in largest], *[F.max(f"lost_{m}").alias(f"lost_{m}") for m in largest]
        )
        moved = moved.filter("n_rows > 0").withColumns({f"sum_{c}": F.when(F.col(f"count_{c}") > 0, F.col(f"sum_{c}")).cast(types[f"sum_{c}"]) for c in self.sums})
        columns = [F.col(c).cast(types[c]).alias(c) for c in state.columns]
        if not largest:
            return moved.select(*columns)
        lowered = F.lit(False)
        for m in largest:
            lowered = lowered | F.coalesce(F.col(f"lost_{m}") >= F.col(m), F.lit(False))
        named = moved.withColumn("_lowered", lowered)
        again = named.filter("_lowered").select(*self.groups)
        read = self.state(exists_in(table, again, list(self.groups)))
        # A group whose column is NULL is never found by the join above; it is read by itself.
        empty = F.lit(False)
        for g in self.groups:
            empty = empty | F.col(g).isNull()
        fresh = read.union(self.state(table.filter(empty))).select(*self.groups, *[F.col(m).alias(f"new_{m}") for m in largest], F.lit(True).alias("_read"))
        on = [named[g].eqNullSafe(fresh[g]) for g in self.groups]
        condition = on[0]
        for c in on[1:]:
            condition = condition & c
        joined = named.join(fresh, condition, "left").select(*[named[c] for c in named.columns], *[fresh[f"new_{m}"] for m in largest], fresh["_read"])
        joined = joined.withColumns({m: F.when(F.col("_read"), F.col(f"new_{m}")).otherwise(F.col(m)) for m in largest})
        return joined.select(*columns)
