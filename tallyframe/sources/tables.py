"""Reading tables, inline rows and generated rows; writing them as new Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyframe.functions.text import tagged


class Tables(Mapping[str, DataFrame]):
    """The Parquet tables of one folder, listed and opened once each, when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, names: Iterable[str]):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.names = tuple(names)
        self._opened: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(self.path(name))
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


def inline_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    """A relation written out in the program, with declared column types.

    It goes over as an Arrow table, so the planner knows how small it is.
    """
    types = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = types.names
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows], schema=to_arrow_schema(types))
    return spark.createDataFrame(table, schema=types)


def numbers(spark: SparkSession, first: int, last: int, name: str = "x") -> DataFrame:
    """The whole numbers from ``first`` to ``last``, both included, made inside the tasks."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def tagged_numbers(numbered: DataFrame, number: str, prefix: str, name: str = "col") -> DataFrame:
    """One text column: a fixed prefix followed by each number."""
    return numbered.select(tagged(prefix, F.col(number)).alias(name))


def create_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a new table, failing if one is there, and return the table."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """Append ``df`` to the table at ``path``, matching columns by name and casting to its types."""
    target = df.sparkSession.read.parquet(path)
    df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema]).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
