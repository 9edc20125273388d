"""Copy-on-write table changes.

Every operator takes DataFrames and returns the table's next state together with
the rows it changed. Nothing is written here: the caller checks the rules first
and then writes the new state once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.text import fold as fold_text
from tallyframe.operators.joins import absent_from, exists_in, join_on, lookup_join
from tallyframe.operators.numbering import number_rows
from tallyframe.operators.sizes import fits_broadcast

Fold = str | Mapping[str, str] | None


class Change(NamedTuple):
    table: DataFrame
    rows: DataFrame


def _folded(df: DataFrame, keys: Sequence[str], fold: Fold) -> list[Column]:
    """The key columns of ``df`` under the aliases _k0, _k1, ..; one mode folds all text keys."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    modes = {k: fold for k in keys if k in text} if isinstance(fold, str) else dict(fold or {})
    return [fold_text(F.col(key), modes.get(key)).alias(f"_k{n}") for n, key in enumerate(keys)]


def new_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], fold: Fold = None, fold_batch: bool = True
) -> DataFrame:
    """Batch rows whose key is not in the target; a NULL key is never found there.

    A batch small enough to broadcast first limits the target to the keys it
    asks for, so a large target is scanned once, by key columns only, and never
    shuffled. Otherwise the target's distinct keys meet the batch by shuffle.
    """
    aliases = [f"_k{n}" for n in range(len(keys))]
    asked = batch.select("*", *_folded(batch, keys, fold if fold_batch else None))
    known = target.select(*_folded(target, keys, fold))
    wanted = asked.select(*aliases)
    if fits_broadcast(wanted):
        found = join_on(known, wanted, aliases, "left_semi").distinct()
        return join_on(asked, found, aliases, "left_anti").drop(*aliases)
    return absent_from(asked, known, aliases).drop(*aliases)


def append(target: DataFrame, rows: DataFrame) -> Change:
    """Append rows by column name, cast to the target's types; columns they do not have are NULL."""
    aligned = rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    return Change(target.unionByName(aligned), aligned)


def insert_if_absent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    fold: Fold = None,
    alternatives: Sequence[Sequence[str]] = (),
    fold_batch: bool = True,
) -> Change:
    """Append the batch rows whose key the target lacks.

    ``alternatives`` are further keys, any of which also counts as present. The
    batch is compared with the target only, so duplicates inside one batch are
    all inserted and left for the uniqueness rule to report.
    """
    rows = batch
    for key in [keys, *alternatives]:
        rows = new_rows(target, rows, key, fold, fold_batch)
    return append(target, rows)


@dataclass(frozen=True)
class Lookup:
    """How one surrogate key is found: batch column -> lookup column pairs, and the key to fetch."""

    table: DataFrame
    match: Mapping[str, str]
    key: str
    name: str
    fold: Fold = "lower"


def resolve_keys(batch: DataFrame, lookups: Sequence[Lookup], how: str = "left") -> DataFrame:
    """Replace natural keys by surrogate keys.

    ``left`` is the scalar form: no match gives NULL, and two matches for a key
    the batch uses are an error. ``inner`` is the join form: unmatched rows go and
    several matches multiply. The natural-key columns are dropped.
    """
    spent: list[str] = []
    base = batch
    for lookup in lookups:
        asked_names, known_names = list(lookup.match), list(lookup.match.values())
        aliases = [f"_k{n}" for n in range(len(asked_names))]
        fold = lookup.fold
        asked_fold = {a: fold[k] for a, k in lookup.match.items() if k in fold} if isinstance(fold, Mapping) else fold
        asked = batch.select("*", *_folded(batch, asked_names, asked_fold))
        known = lookup.table.select(*_folded(lookup.table, known_names, fold), F.col(lookup.key).alias(lookup.name))
        wanted = asked.select(*aliases)
        small = fits_broadcast(wanted)
        if small:
            known = join_on(known, wanted, aliases, "left_semi")
        if how == "left":
            kind = lookup.table.schema[lookup.key].dataType
            several = F.raise_error(F.lit(f"more than one {lookup.name} for a key")).cast(kind)
            known = known.groupBy(*aliases).agg(F.min(lookup.name).alias("_key"), F.count("*").alias("_n"))
            if small:
                matched = join_on(asked, known, aliases, how)
            else:  # hot keys are looked for in the batch itself, whatever was joined to it before
                own = [name for name in asked_names if name in base.columns]
                keyed = base.select(*_folded(base, asked_names, asked_fold)) if own == asked_names else None
                matched = lookup_join(asked, known, aliases, how, keyed_by=keyed)
            key = F.when(F.col("_n") > 1, several).otherwise(F.col("_key"))
            batch = matched.withColumn(lookup.name, key).drop("_key", "_n", *aliases)
        else:
            batch = join_on(asked, known, aliases, how).drop(*aliases)
        spent += [name for name in asked_names if name != lookup.name]
    return batch.drop(*spent)


def marked(
    target: DataFrame,
    where: Column | None = None,
    keys: DataFrame | None = None,
    on: Sequence[str | tuple[str, str]] = (),
    unless: Column | None = None,
) -> DataFrame:
    """The rows with a column ``_hit``: whether they meet ``where``, are named by ``keys``, and do not meet ``unless``."""
    hit = F.lit(True) if where is None else where
    if unless is not None:
        hit = hit & ~F.coalesce(unless, F.lit(False))
    rows = target
    if keys is not None:
        names = [name if isinstance(name, str) else name[1] for name in on]
        rows = lookup_join(target, keys.select(*names).distinct().withColumn("_named", F.lit(True)), on, "left")
        hit = hit & F.col("_named").isNotNull()
    return rows.withColumn("_hit", F.coalesce(hit, F.lit(False))).select(*target.columns, "_hit")


def assigned(rows: DataFrame, assignments: Mapping[str, Column]) -> DataFrame:
    """Marked rows with the columns of those hit set, in the types they had."""
    return rows.withColumns(
        {
            name: F.when(F.col("_hit"), value).otherwise(F.col(name)).cast(rows.schema[name].dataType)
            for name, value in assignments.items()
        }
    )


def update_where(
    target: DataFrame,
    assignments: Mapping[str, Column],
    where: Column | None = None,
    keys: DataFrame | None = None,
    on: Sequence[str | tuple[str, str]] = (),
    unless: Column | None = None,
) -> Change:
    """Set columns on the rows that meet ``where`` and are named by ``keys``.

    ``unless`` marks rows that already hold the new values; they are left alone,
    so a second run changes nothing. Changed rows come back with their new values.
    """
    updated = assigned(marked(target, where, keys, on, unless), assignments)
    return Change(updated.select(*target.columns), updated.filter("_hit").select(*target.columns))


def delete_where(
    target: DataFrame,
    where: Column | None = None,
    keys: DataFrame | None = None,
    on: Sequence[str | tuple[str, str]] = (),
) -> Change:
    """Remove the rows that meet ``where`` (unknown keeps the row) or whose key is in ``keys``."""
    if (where is None) == (keys is None):
        raise ValueError("give either a condition or keys")
    if where is not None:
        hit = F.coalesce(where, F.lit(False))
        return Change(target.filter(~hit), target.filter(hit))
    return Change(absent_from(target, keys, on), exists_in(target, keys, on))


def delete_children_first(
    tables: Sequence[tuple[str, DataFrame, Sequence[str | tuple[str, str]]]], keys: DataFrame
) -> dict[str, Change]:
    """Remove the rows of ``keys`` from each table, in the given order: children before parents."""
    return {name: delete_where(table, keys=keys, on=on) for name, table, on in tables}


def assign_keys(batch: DataFrame, target: DataFrame, key: str, order: Sequence[Column] = ()) -> DataFrame:
    """Give batch rows the dense keys that follow the target's largest one."""
    last = target.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("last")).scalar()
    return number_rows(batch.drop(key), key, order, start=last + 1)


def get_or_create(
    dim: DataFrame, names: DataFrame, name: str, key: str, fold: str = "upper", order: str | None = None
) -> Change:
    """Make sure every name has a row in ``dim``; names that differ only in case share one.

    Of several spellings of a missing name the first by ``order`` is stored, the
    smallest without it, and keys follow the same order. Columns of ``dim`` other
    than the key and name are NULL in the created rows.
    """
    order = order or name
    asked = names.select(*dict.fromkeys([name, order])).filter(F.col(name).isNotNull())
    spellings = (
        new_rows(dim, asked, [name], fold)
        .groupBy(fold_text(F.col(name), fold).alias("_folded"))
        .agg(F.min_by(name, order).alias("_name"), F.min(order).alias("_order"))
        .select(F.col("_name").alias(name), "_order")
    )
    return append(dim, assign_keys(spellings, dim, key, order=[F.col("_order")]).drop("_order"))


def fill_defaults(batch: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns a batch does not have; a NULL the batch states stays NULL."""
    return batch.withColumns({name: value for name, value in defaults.items() if name not in batch.columns})


def add_column(target: DataFrame, name: str, default: Column) -> DataFrame:
    """A new column holding the default in every existing row."""
    if name in target.columns:
        raise ValueError(f"column {name} already exists")
    return target.withColumn(name, default)


def completeness(target: DataFrame, name: str) -> DataFrame:
    """All rows beside the rows where ``name`` has a value."""
    return target.agg(F.count("*").alias("total_rows"), F.count(name).alias("non_null_rows"))
