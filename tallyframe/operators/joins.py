"""Join operators.

None of them hints a broadcast on data of unknown size. A small side is
broadcast by Spark's own threshold; beyond it rows are shuffled once on their keys,
and keys that hold a large share of the rows are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.operators.sizes import fits_broadcast

On = Sequence[str | tuple[str, str]]

HOT_SHARE = 0.005
HOT_PARTS = 32
_SALT = "_salt"


def key_pairs(on: On) -> list[tuple[str, str]]:
    return [(key, key) if isinstance(key, str) else key for key in on]


def join_on(left: DataFrame, right: DataFrame, on: On, how: str = "inner") -> DataFrame:
    """Equi-join on (left, right) column pairs.

    The right key columns are not kept. Any other right column named like a left one is an error.
    """
    pairs = key_pairs(on)
    keys = [l for l, _ in pairs]
    matched = [r for _, r in pairs]
    added = [name for name in right.columns if name not in matched]
    if how not in ("left_semi", "left_anti") and (both := sorted(set(added) & set(left.columns))):
        raise ValueError(f"columns on both sides: {', '.join(both)}")
    right = right.select(*[F.col(r).alias(l) for l, r in pairs], *added)
    joined = left.join(right, keys, how)
    return joined.select(*left.columns) if how in ("left_semi", "left_anti") else joined.select(*left.columns, *added)


def through_bridge(left: DataFrame, bridge: DataFrame, right: DataFrame, left_on: On, right_on: On) -> DataFrame:
    """Many-to-many join: ``left`` to ``bridge``, then on to ``right``."""
    return join_on(join_on(left, bridge, left_on), right, right_on)


def join_path(start: DataFrame, steps: Sequence[tuple[DataFrame, On]]) -> DataFrame:
    """Inner joins along a path of tables."""
    for table, on in steps:
        start = join_on(start, table, on)
    return start


# --- hot keys -------------------------------------------------------------


_WHOLE_NUMBERS = {"tinyint", "smallint", "int", "bigint"}


def _key_hash(df: DataFrame, names: Sequence[str]) -> Column:
    """A hash that agrees for equal keys of different integer widths."""
    types = dict(df.dtypes)
    return F.xxhash64(*[F.col(n).cast("bigint") if types[n] in _WHOLE_NUMBERS else F.col(n) for n in names])


def _hashes_agree(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> bool:
    a, b = dict(left.dtypes), dict(right.dtypes)
    return all(a[l] == b[r] or {a[l], b[r]} <= _WHOLE_NUMBERS for l, r in pairs)


def hot_keys(df: DataFrame, names: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """One row with one array ``hot``: hashes of keys (NULL keys too), among them all that hold more than ``share`` of the rows.

    A mergeable heavy-hitter summary of the key columns: it shuffles one short array per task and
    holds at most ``1 / share`` values. Keys that are not that frequent may be among them.
    """
    summary = df.select(_key_hash(df, names).alias("h")).freqItems(["h"], share)
    return summary.select(F.coalesce("h_freqItems", F.array().cast("array<bigint>")).alias("hot"))


def _unique_side_join(
    left: DataFrame, right: DataFrame, on: On, how: str, right_bounded: bool, keyed_by: DataFrame | None = None
) -> DataFrame:
    """Join ``left`` with ``right``, which holds each key once, without a hot shuffle partition.

    Unless Spark broadcasts the right side by its own threshold, both sides get a salt: 0, but
    for hot keys a hash of the left row, and the right rows of hot keys are repeated per salt. Both sides are
    shuffled once. The hot keys are a scalar subquery, so nothing runs while the plan is built; it reads
    the key columns of ``keyed_by``, the base of ``left`` if earlier joins have not changed them.
    """
    pairs = key_pairs(on)
    if right_bounded or not _hashes_agree(left, right, pairs):
        return join_on(left, right, on, how)
    base = left if keyed_by is None else keyed_by
    hot = hot_keys(base, [l for l, _ in pairs]).scalar()
    is_hot = lambda df, names: F.array_contains(hot, _key_hash(df, names))
    seat = F.pmod(F.xxhash64(*map(F.col, left.columns)), F.lit(HOT_PARTS))
    salted = left.withColumn(_SALT, F.when(is_hot(left, [l for l, _ in pairs]), seat).otherwise(F.lit(0)).cast("int"))
    last = F.when(is_hot(right, [r for _, r in pairs]), F.lit(HOT_PARTS - 1)).otherwise(F.lit(0))
    repeated = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last)))
    return join_on(salted, repeated, [*on, _SALT], how).drop(_SALT)


def lookup_join(left: DataFrame, right: DataFrame, on: On, how: str = "inner", keyed_by: DataFrame | None = None) -> DataFrame:
    """Inner or left join to a side that holds each key once, safe for hot keys on the left."""
    return _unique_side_join(left, right, on, how, fits_broadcast(right), keyed_by)


def _filter_by_keys(left: DataFrame, right: DataFrame, on: On, how: str, keyed_by: DataFrame | None = None) -> DataFrame:
    keys = right.select(*[r for _, r in key_pairs(on)])
    small = fits_broadcast(keys)
    # A set of keys is enough, and building it pre-aggregates hot keys on the right.
    return _unique_side_join(left, keys if small else keys.distinct(), on, how, small, keyed_by)


# --- semi and anti joins --------------------------------------------------


def exists_in(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Rows of ``left`` with at least one match (EXISTS, IN)."""
    return _filter_by_keys(left, right, on, "left_semi")


def absent_from(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Rows of ``left`` without a match (NOT EXISTS); a NULL key never matches, so its row stays."""
    return _filter_by_keys(left, right, on, "left_anti")


def absent_from_any(left: DataFrame, right: DataFrame, alternatives: Sequence[On]) -> DataFrame:
    """Rows matched by none of several keys (NOT EXISTS over OR), one anti-join per key."""
    rest = left
    for on in alternatives:
        rest = _filter_by_keys(rest, right, on, "left_anti", keyed_by=left)
    return rest


def exists_along(start: DataFrame, steps: Sequence[tuple[DataFrame, On]]) -> DataFrame:
    """Nested IN: ``start`` limited by the first step, itself limited by the next, and so on."""
    table, on = steps[0]
    inner = table if len(steps) == 1 else exists_along(table, steps[1:])
    return exists_in(start, inner, on)


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """SQL NOT IN: any NULL on the right empties the result; a NULL on the left stays only beside an empty right.

    The NULL rules are two scalar facts about the right side, so the join itself
    remains an ordinary shuffled or broadcast anti-join.
    """
    # The distinct keys, NULL among them, serve the join and the facts: one aggregate, reused by both.
    keys = right.select(F.col(right_key)).distinct()
    facts = keys.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.col(right_key).isNull()), F.lit(False)).alias("has_null")
    )
    kept = _unique_side_join(left, keys, [(left_key, right_key)], "left_anti", fits_broadcast(right.select(right_key)))
    return kept.filter(
        ~facts.select("has_null").scalar() & (F.col(left_key).isNotNull() | (facts.select("n").scalar() == 0))
    )


# --- scalar pairing and extremes ------------------------------------------


def pair_with_one(left: DataFrame, single: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Attach columns of a one-row relation, read as one scalar subquery.

    ``columns`` maps new names to names in ``single``. No row drops every row of
    ``left``, like the inner join it stands for; two rows are an error.
    """
    row = single.select(F.struct(*[F.col(name).alias(new) for new, name in columns.items()]).alias("_one")).scalar()
    paired = left.withColumn("_one", row).filter(F.col("_one").isNotNull())
    return paired.select(*left.columns, *[F.col("_one")[new].alias(new) for new in columns])


def holders_of_max(rows: DataFrame, group: Sequence[str], value: str, max_groups: int | None = None) -> DataFrame:
    """Rows that carry their group's largest ``value``, ties kept.

    The maxima are pre-aggregated and joined back on (group, value), which spreads
    a large group over many tasks where a ranking window would sort it in one.
    With ``max_groups`` the caller states a proven bound, and within 10,000 groups
    the maxima are broadcast so that ``rows`` is not shuffled again.
    """
    maxima = rows.groupBy(*group).agg(F.max(value).alias(value))
    if max_groups is not None and max_groups <= 10_000:
        maxima = F.broadcast(maxima)
    return join_on(rows, maxima, [*group, value])
