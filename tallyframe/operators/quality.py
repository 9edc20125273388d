"""Table rules as Spark jobs: the rows that break a rule, and counts for a whole definition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.operators.joins import absent_from, join_on
from tallyframe.sources.definitions import ForeignKey, TableDef

REPORT_SCHEMA = "table_name string, rule string, violations bigint"


def duplicate_keys(df: DataFrame, keys: Sequence[str], nulls_count: bool = False) -> DataFrame:
    """Keys held by more than one row, with their number. A UNIQUE key skips NULLs, a primary key does not."""
    rows = df if nulls_count else df.dropna(subset=list(keys))
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def null_violations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows missing a required value."""
    return df.filter(reduce(Column.__or__, [F.col(name).isNull() for name in names]))


def orphans(df: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]) -> DataFrame:
    """Rows that point to no parent; a row with a NULL in its key points nowhere and is no orphan."""
    return absent_from(df.dropna(subset=list(columns)), parent, list(zip(columns, parent_columns)))


def check_violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false; unknown passes."""
    return df.filter(~F.coalesce(condition, F.lit(True)))


def too_long(df: DataFrame, name: str, limit: int) -> DataFrame:
    return df.filter(F.length(name) > limit)


def _row_rules(table: TableDef) -> dict[str, Column]:
    """Rules that one row can break by itself, as conditions that are true when broken."""
    rules = {f"not null {name}": F.col(name).isNull() for name in table.required()}
    rules |= {f"length {name}": F.length(name) > limit for name, limit in table.max_lengths().items()}
    rules |= {f"check {name}": ~F.coalesce(condition, F.lit(True)) for name, condition in table.checks.items()}
    return rules


def _row_report(df: DataFrame, table: TableDef) -> DataFrame:
    rules = _row_rules(table)
    counts = df.agg(*[F.count(F.when(broken, 1)).alias(f"_c{n}") for n, broken in enumerate(rules.values())])
    pairs = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(f"_c{n}").alias("violations")) for n, rule in enumerate(rules)]
    )
    return counts.select(F.inline(pairs)).select(F.lit(table.name).alias("table_name"), "rule", "violations")


def _count_report(table: TableDef, rule: str, counts: DataFrame, number: str) -> DataFrame:
    return counts.agg(F.coalesce(F.sum(number), F.lit(0)).alias("violations")).select(
        F.lit(table.name).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def _key_report(df: DataFrame, table: TableDef, keys: Sequence[str], primary: bool) -> DataFrame:
    """Surplus rows of repeated keys."""
    surplus = duplicate_keys(df, keys, nulls_count=primary).select((F.col("n") - 1).alias("surplus"))
    kind = "primary key" if primary else "unique"
    return _count_report(table, f"{kind} {', '.join(keys)}", surplus, "surplus")


def _foreign_report(df: DataFrame, table: TableDef, key: ForeignKey, parent: DataFrame) -> DataFrame:
    """Orphan rows, counted per key before the join so that a hot key travels as one row."""
    counts = df.dropna(subset=list(key.columns)).groupBy(*key.columns).agg(F.count("*").alias("n"))
    lost = absent_from(counts, parent, list(zip(key.columns, key.parent_columns)))
    return _count_report(table, f"foreign key {', '.join(key.columns)}", lost, "n")


def rule_report(df: DataFrame, table: TableDef, parents: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule with the number of rows breaking it.

    All row rules share one pass. Each key costs one aggregation, each foreign
    key one aggregation and one anti-join.
    """
    parts = [_row_report(df, table)] if _row_rules(table) else []
    if table.primary_key:
        parts.append(_key_report(df, table, table.primary_key, primary=True))
    parts += [_key_report(df, table, keys, primary=False) for keys in table.unique]
    parts += [_foreign_report(df, table, key, parents[key.parent]) for key in table.foreign_keys]
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "rule", F.col("violations").cast("bigint").alias("violations")
    )


def _raise_broken(report: DataFrame) -> None:
    broken = report.filter(F.col("violations") > 0).collect()  # one row per rule
    if broken:
        raise ValueError("; ".join(f"{r.table_name}: {r.rule} ({r.violations})" for r in broken))


def require_new_rows(rows: DataFrame, target: DataFrame, table: TableDef, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Return ``rows`` if adding them to a sound target breaks no rule, else raise with the rules.

    Row rules, repeated keys among the rows and their parents are checked on the rows alone. The target is read by key columns
    and limited to the rows' keys, so it is not shuffled where the rows can be broadcast.
    """
    report = rule_report(rows, table, parents)
    primary = [(table.primary_key, "primary key")] if table.primary_key else []
    for keys, kind in [*primary, *[(keys, "unique") for keys in table.unique]]:
        wanted = rows.select(*keys).distinct()
        taken = join_on(target.select(*keys), wanted, list(keys), "left_semi").select(F.lit(1).alias("n"))
        report = report.unionByName(_count_report(table, f"{kind} {', '.join(keys)} of the table", taken, "n"))
    _raise_broken(report)
    return rows


def require_rules(df: DataFrame, table: TableDef, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Return ``df`` if it breaks no rule, else raise with the rules it breaks."""
    _raise_broken(rule_report(df, table, parents))
    return df
