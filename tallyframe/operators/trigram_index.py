"""Pattern search by an index of trigrams: rows that hold the rarest trigrams of a pattern are looked up, and the pattern itself is tried on those alone.

The index holds the rows, numbered, in files of their own, the postings (trigram, file, row) of the lower-cased texts in order of the trigrams, so that a lookup reads the
row groups of its trigrams, and the number of rows of each trigram.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.operators.joins import exists_in

ROW = "_row"
#: So many of a pattern's trigrams are looked up, the rarest ones; the pattern decides afterwards.
LOOKED_UP = 3


def literal_runs(pattern: str) -> list[str]:
    """The texts that every match of a LIKE pattern holds: what stands between its ``%`` and ``_``; a backslash takes the next character as it is."""
    runs, at = [""], 0
    while at < len(pattern):
        letter = pattern[at]
        if letter == "\\" and at + 1 < len(pattern):
            at += 1
            runs[-1] += pattern[at]
        elif letter in "%_":
            runs.append("")
        else:
            runs[-1] += letter
        at += 1
    return [run for run in runs if run]


def trigrams(runs: list[str]) -> list[str]:
    return sorted({run[k : k + 3] for run in runs for k in range(len(run) - 2)})


@dataclass(frozen=True)
class TrigramIndex:
    spark: SparkSession
    path: str
    text: str

    @classmethod
    def create(cls, table: DataFrame, text: str, path: str) -> TrigramIndex:
        """Index a text column of a table; a NULL text is never found."""
        spark = table.sparkSession
        # Written before they are read: the numbers are those of the files, whatever task is tried again.
        table.withColumn(ROW, F.monotonically_increasing_id()).write.mode("errorifexists").parquet(f"{path}/rows")
        lower = F.lower(F.col(text))
        places = F.sequence(F.lit(1), F.length(lower) - 2)
        grams = F.array_distinct(F.transform(places, lambda k: F.substring(lower, k, F.lit(3))))
        rows = spark.read.parquet(f"{path}/rows").select(text, ROW, F.col("_metadata.file_path").alias("file"))
        postings = rows.filter(F.length(lower) > 2).select(F.explode(grams).alias("gram"), "file", ROW)
        # By (trigram, row): a frequent trigram is spread over several files.
        postings.repartitionByRange("gram", ROW).sortWithinPartitions("gram", ROW).write.parquet(f"{path}/postings")
        spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("n")).sort("gram").write.parquet(f"{path}/sizes")
        return cls(spark, path, text)

    def ilike(self, pattern: str) -> DataFrame:
        """The rows whose text matches, whatever the case. Patterns without three letters in a row are tried on all rows."""
        rows = self.spark.read.parquet(f"{self.path}/rows")
        lowered = self.spark.range(1).select(F.lower(F.lit(pattern))).first()[0]
        grams = trigrams(literal_runs(lowered))
        if grams:
            sizes = self.spark.read.parquet(f"{self.path}/sizes").filter(F.col("gram").isin(grams)).collect()
            rarest = [r["gram"] for r in sorted(sizes, key=lambda r: (r["n"], r["gram"]))[:LOOKED_UP]]
            if len(sizes) < len(grams):
                return rows.filter(F.lit(False)).drop(ROW)
            postings = self.spark.read.parquet(f"{self.path}/postings").filter(F.col("gram").isin(rarest))
            found = postings.groupBy(ROW).agg(F.count("*").alias("n"), F.first("file").alias("file")).filter(F.col("n") == len(rarest))
            # The files with candidates: as many as the rows have at most.
            files = [r["file"] for r in found.select("file").distinct().collect()]
            if not files:
                return rows.filter(F.lit(False)).drop(ROW)
            rows = exists_in(rows.filter(F.col("_metadata.file_path").isin(files)), found, [ROW])
        return rows.filter(F.col(self.text).ilike(pattern)).drop(ROW)
