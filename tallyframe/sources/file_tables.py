"""Tables as lists of data files: a change rewrites only the files that hold rows it changes.

A table's folder has ``data`` with its Parquet files and ``versions`` with one small table for each version: the files of that version, and the column
layouts they were written under. Data files are never altered or removed, so a version once opened stays readable. The next version is one new
folder, written if it is not there yet, so of two writers from the same version one fails.

The list of files passes through the driver, as Spark's own list of a table's files does; it grows with the number of files, not with the rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tallyframe.operators.changes import assigned, marked
from tallyframe.sources.tables import inline_rows

_FILE = "_file"
_VERSION_ROWS = "file string, layout int, columns string, default string"


class FileChange(NamedTuple):
    """The next state, the rows as they are after the change (of a delete: the rows removed), and the rows as they were before it."""

    table: FileTable
    rows: DataFrame
    before: DataFrame


@dataclass(frozen=True)
class Layout:
    """The columns that files were written with; ``default`` is the text form of what earlier files hold in the last column."""

    columns: StructType
    default: str | None = None


def _plain(path: str) -> str:
    """One spelling for a file: Spark's listings and its metadata column differ in slashes and escapes."""
    return re.sub("^file:/+", "file:/", unquote(path))


@dataclass(frozen=True)
class FileTable:
    spark: SparkSession
    path: str
    version: int
    files: Mapping[str, int]
    layouts: tuple[Layout, ...]

    @classmethod
    def create(cls, df: DataFrame, path: str) -> FileTable:
        """Write ``df`` as the first version of a new table; an error if there is one."""
        path = path.rstrip("/")
        # Readers take missing values in any column, as Parquet files hold them.
        columns = StructType([StructField(f.name, f.dataType, True) for f in df.schema])
        empty = cls(df.sparkSession, path, -1, {}, (Layout(columns),))
        return empty._next(empty._write(df))

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> FileTable:
        """The latest version of a table, or an earlier one."""
        path = path.rstrip("/")
        versions = spark.read.parquet(f"{path}/versions")
        if version is None:
            version = versions.agg(F.max("version")).first()[0]
        rows = versions.where(F.col("version") == version).collect()
        if not rows:
            raise ValueError(f"no version {version} at {path}")
        layouts = sorted((r for r in rows if r["file"] is None), key=lambda r: r["layout"])
        return cls(
            spark, path, version, {r["file"]: r["layout"] for r in rows if r["file"] is not None},
            tuple(Layout(StructType.fromJson(json.loads(r["columns"])), r["default"]) for r in layouts),
        )

    @property
    def columns(self) -> StructType:
        return self.layouts[-1].columns

    def read(self) -> DataFrame:
        return self._read(self.files).drop(_FILE)

    def append(self, df: DataFrame) -> FileTable:
        """The table with the rows of ``df``, matched by name and cast; columns it does not have are NULL."""
        aligned = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.columns])
        return self._next({**self.files, **self._write(aligned)})

    def add_column(self, name: str, kind: str, default: str | None = None) -> FileTable:
        """A new last column. No file is written again: rows of earlier files have the default, later rows what they state."""
        if name in self.columns.names:
            raise ValueError(f"column {name} already exists")
        column = StructType.fromDDL(f"`{name}` {kind}")[0]
        return replace(self, layouts=(*self.layouts, Layout(StructType([*self.columns, column]), default)))._next(self.files)

    def update_where(
        self,
        assignments: Mapping[str, Column],
        where: Column | None = None,
        keys: DataFrame | None = None,
        on: Sequence[str | tuple[str, str]] = (),
        unless: Column | None = None,
    ) -> FileChange:
        """Set columns on the rows that meet ``where`` and are named by ``keys``, but for those that meet ``unless``."""
        return self._change(assignments, where, keys, on, unless)

    def delete_where(self, where: Column | None = None, keys: DataFrame | None = None, on: Sequence[str | tuple[str, str]] = ()) -> FileChange:
        """Remove the rows that meet ``where`` (unknown keeps the row) or whose key is in ``keys``."""
        if (where is None) == (keys is None):
            raise ValueError("give either a condition or keys")
        return self._change(None, where, keys, on, None)

    def _change(self, assignments: Mapping[str, Column] | None, where, keys, on, unless) -> FileChange:
        # First the files with rows to change, by the columns that tell them; then these files alone, once.
        look = self._read(self.files)
        if where is None and unless is None:
            look = look.select(*dict.fromkeys(name if isinstance(name, str) else name[0] for name in on), _FILE)
        hit = marked(look, where, keys, on, unless).filter("_hit").groupBy(_FILE).agg(F.count("*"))
        touched = {_plain(row[0]) for row in hit.collect()}
        nothing = inline_rows(self.spark, [], self.columns)
        if not touched:
            return FileChange(self, nothing, nothing)
        old = marked(self._read({f: self.files[f] for f in touched}).drop(_FILE), where, keys, on, unless)
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        (old if assignments is None else assigned(old, assignments)).write.partitionBy("_hit").parquet(folder)
        written = self._listed(folder)
        changed = [f for f in written if "/_hit=true/" in f]
        kept = written if assignments is not None else [f for f in written if f not in set(changed)]
        here = len(self.layouts) - 1
        table = self._next({**{f: n for f, n in self.files.items() if f not in touched}, **dict.fromkeys(kept, here)})
        rows = self._read(dict.fromkeys(changed, here)).drop(_FILE)
        return FileChange(table, rows, rows if assignments is None else old.filter("_hit").drop("_hit"))

    def _read(self, files: Mapping[str, int]) -> DataFrame:
        """Rows of some files under the latest layout, with the file each comes from."""
        out = None
        for n, layout in enumerate(self.layouts):
            named = [f for f, number in files.items() if number == n]
            if not named:
                continue
            part = self.spark.read.schema(layout.columns).parquet(*named).select("*", F.col("_metadata.file_path").alias(_FILE))
            part = part.withColumns({later.columns[-1].name: F.lit(later.default).cast(later.columns[-1].dataType) for later in self.layouts[n + 1 :]})
            part = part.select(*self.columns.names, _FILE)
            out = part if out is None else out.unionByName(part)
        return inline_rows(self.spark, [], StructType([*self.columns, StructField(_FILE, StructType.fromDDL("f string")[0].dataType)])) if out is None else out

    def _write(self, df: DataFrame) -> dict[str, int]:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return dict.fromkeys(self._listed(folder), len(self.layouts) - 1)

    def _listed(self, folder: str) -> list[str]:
        return [_plain(f) for f in self.spark.read.schema("none int").parquet(folder).inputFiles()]

    def _next(self, files: Mapping[str, int]) -> FileTable:
        after = replace(self, version=self.version + 1, files=dict(files))
        layouts: Iterable[tuple] = ((None, n, json.dumps(x.columns.jsonValue()), x.default) for n, x in enumerate(after.layouts))
        rows = inline_rows(self.spark, [*layouts, *((f, n, None, None) for f, n in files.items())], _VERSION_ROWS)
        # One file, so that a version is there whole or not at all.
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/versions/version={after.version}")
        return after
