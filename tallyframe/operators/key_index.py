"""The keys of a table in buckets, so that loads meet them without reading or shuffling the table.

A load asks with its distinct keys, dealt like the buckets: the index is read where it lies. Keys of loaded rows are appended to their buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.text import fold as fold_text
from tallyframe.operators.joins import absent_from


@dataclass(frozen=True)
class KeyIndex:
    """Distinct keys in a table of the catalogue; keys with a NULL in them are not kept, since they are never found.

    ``fold`` names the text keys that are compared by case, each with its mode. Of two loads from one state both may see a key as new: load one after another.
    """

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    buckets: int
    fold: tuple[tuple[str, str], ...] = ()

    @classmethod
    def create(cls, target: DataFrame, keys: Sequence[str], name: str, path: str, buckets: int, fold: Sequence[tuple[str, str]] = ()) -> KeyIndex:
        """Index the rows of ``target`` under a table name that is not taken."""
        index = cls(target.sparkSession, name, path, tuple(keys), buckets, tuple(fold))
        index._write(index._keys_of(target), "errorifexists")
        return index

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Batch rows whose key is not in the index; a NULL key is never there. Rows equal in key are all returned."""
        asked = batch.select("*", *self._folded())
        wanted = self._keys_of(batch)
        # Merge join: a hash table of the index would have to be sent or built; the wanted keys are dealt to its buckets.
        found = wanted.join(self.spark.table(self.name).hint("merge"), list(self._aliases), "left_semi")
        return absent_from(asked, found, list(self._aliases)).drop(*self._aliases)

    def add(self, rows: DataFrame) -> None:
        """Append the keys of loaded rows; those that are there already are left out, so that a repeated call adds nothing."""
        fresh = self._keys_of(rows).join(self.spark.table(self.name).hint("merge"), list(self._aliases), "left_anti")
        self._write(fresh, "append")

    def count(self) -> int:
        return self.spark.table(self.name).count()

    def drop(self) -> None:
        """The name goes; the files stay below the path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    @property
    def _aliases(self) -> tuple[str, ...]:
        return tuple(f"_k{n}" for n in range(len(self.keys)))

    def _folded(self) -> list:
        modes = dict(self.fold)
        return [fold_text(F.col(key), modes.get(key)).alias(alias) for key, alias in zip(self.keys, self._aliases, strict=True)]

    def _keys_of(self, rows: DataFrame) -> DataFrame:
        # Distinct on the map side first, so that a hot key crosses once for each task.
        return rows.select(*self._folded()).dropna("any").distinct().repartition(self.buckets, *self._aliases)

    def _write(self, keys: DataFrame, mode: str) -> None:
        writer = keys.write.mode(mode).format("parquet").bucketBy(self.buckets, *self._aliases).sortBy(*self._aliases)
        writer.option("path", self.path).saveAsTable(self.name)
