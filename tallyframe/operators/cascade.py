"""Deletes that follow the foreign keys of table definitions by themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyframe.operators.changes import Change
from tallyframe.operators.joins import join_on, lookup_join
from tallyframe.session import scratch_path
from tallyframe.sources.definitions import ForeignKey, TableDef


def parents_first(definitions: Sequence[TableDef]) -> list[TableDef]:
    """The tables in an order in which each stands behind all it refers to; self references do not count, any other cycle is an error."""
    left = {d.name: d for d in definitions}
    order: list[TableDef] = []
    while left:
        free = [d for d in left.values() if not any(k.parent in left and k.parent != d.name for k in d.foreign_keys)]
        if not free:
            raise ValueError(f"tables refer to each other in a cycle: {', '.join(sorted(left))}")
        for d in free:
            order.append(left.pop(d.name))
    return order


def _marked(table: DataFrame, keys: Sequence[tuple[ForeignKey, DataFrame]]) -> DataFrame:
    """The table with ``_gone``: whether one of its foreign keys is among the keys beside it."""
    hit = F.lit(False)
    for n, (key, gone) in enumerate(keys):
        mark = f"_hit{n}"
        named = gone.select(*[F.col(p).alias(c) for p, c in zip(key.parent_columns, key.columns, strict=True)]).distinct()
        table = lookup_join(table, named.withColumn(mark, F.lit(True)), list(key.columns), "left")
        hit = hit | F.col(mark).isNotNull()
    return table.withColumn("_gone", hit).drop(*[f"_hit{n}" for n in range(len(keys))])


def delete_cascade(tables: Mapping[str, DataFrame], definitions: Sequence[TableDef], root: str, keys: DataFrame) -> dict[str, Change]:
    """Remove the rows of ``root`` with these keys, and from every other table the rows that refer to a removed row, however far down.

    ``keys`` has columns of ``root`` (its primary key, as a rule). A row with several foreign keys goes if one of them is lost; a NULL key refers to nothing. Changes come
    in the order in which they can be written: children before parents. Removed rows are carried down as the key columns their children use. The removed rows of
    each table are written when this is called, so that no child repeats the joins above it.
    """
    changes: dict[str, Change] = {}
    gone: dict[str, DataFrame] = {}
    for definition in parents_first([d for d in definitions if d.name in tables]):
        name, table = definition.name, tables[definition.name]
        lost = [(k, gone[k.parent]) for k in definition.foreign_keys if k.parent in gone and k.parent != name]
        own = [k for k in definition.foreign_keys if k.parent == name]
        if name == root:
            lost.append((ForeignKey(tuple(keys.columns), root, tuple(keys.columns)), keys))
        if not lost:
            continue
        marked = _marked(table, lost)
        rows = _written(marked.filter("_gone").drop("_gone"), name)
        if own:
            rows = _with_descendants(table, rows, definition, own)
            identity = list(definition.primary_key)
            kept = join_on(table, rows.select(*identity).distinct(), identity, "left_anti")
        else:
            kept = marked.filter(~F.col("_gone")).drop("_gone")
        gone[name] = rows
        changes[name] = Change(kept.select(*table.columns), rows.select(*table.columns))
    return dict(reversed(changes.items()))


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, f"gone-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _with_descendants(table: DataFrame, rows: DataFrame, definition: TableDef, own: Sequence[ForeignKey]) -> DataFrame:
    """The rows and all that refer to them within the table, level by level; each level reads the table once. Circles of rows end, too."""
    identity = list(definition.primary_key)
    if not identity:
        raise ValueError(f"{definition.name} refers to itself and has no primary key")
    found, level = rows, rows
    while True:
        below = _marked(table, [(k, level) for k in own]).filter("_gone").drop("_gone")
        level = _written(join_on(below, found.select(*identity).distinct(), identity, "left_anti"), definition.name)
        if level.isEmpty():
            return found
        found = found.union(level)
