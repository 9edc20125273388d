"""Row policies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tallyframe.operators.joins import exists_in, lookup_join


def visible_rows(table: DataFrame, policies: DataFrame, role: str, key: str) -> DataFrame:
    """The rows a role may read: those whose ``key`` its policies name.

    ``policies`` has the columns ``role`` and ``key``. A role without a policy
    sees nothing.
    """
    return exists_in(table, policies.filter(F.col("role") == role), [key])


def with_roles(table: DataFrame, policies: DataFrame, key: str, name: str = "roles") -> DataFrame:
    """Every row with the sorted roles that may read it, none if no policy names its key: the policies of all roles in one pass.

    The list of a key is bounded by the number of roles.
    """
    named = policies.filter(F.col("role").isNotNull() & F.col(key).isNotNull())
    allowed = named.groupBy(key).agg(F.sort_array(F.collect_set("role")).alias(name))
    seen = lookup_join(table, allowed, [key], "left")
    return seen.withColumn(name, F.coalesce(F.col(name), F.array().cast("array<string>")))


def rows_by_role(tables: Mapping[str, tuple[DataFrame, str]], policies: DataFrame, roles: DataFrame | None = None) -> DataFrame:
    """How many rows of each table each role may read, from one scan of each table.

    ``tables`` gives each table with its key column; ``policies`` has ``table_name``, ``role`` and ``key`` (compared as text). Roles are those of the policies and of
    ``roles``; a role without a policy for a table has a row with 0.
    """
    named = policies.select("table_name", "role", F.col("key").cast("string").alias("key")).dropna("any").distinct()
    sizes, empty = None, None
    who = named.select("role") if roles is None else named.select("role").union(roles.select("role").dropna("any"))
    who = who.distinct()
    for name, (table, key) in tables.items():
        # Counted by key first: a hot key is one row for each task.
        size = table.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).filter("key IS NOT NULL")
        size = size.select(F.lit(name).alias("table_name"), "key", "n")
        none = who.select(F.lit(name).alias("table_name"), "role", F.lit(0).cast("bigint").alias("n"))
        sizes, empty = (size, none) if sizes is None else (sizes.union(size), empty.union(none))
    read = named.join(sizes, ["table_name", "key"]).select("table_name", "role", "n")
    return read.union(empty).groupBy("table_name", "role").agg(F.sum("n").alias("n_rows"))
