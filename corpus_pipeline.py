"""From raw documents to packed training sequences: five stages, each written and read again.

1. language: documents without an identifiable language go.
2. near_copies: of documents linked by a 5-gram Jaccard similarity of 0.8 or more, one stays: that with the smallest doc_id.
3. decontamination: documents go in which benchmark windows cover a twentieth of the words or more.
4. personal_data: spans of personal data are replaced by their kind; ``n_chars`` follows.
5. packing: the texts as token pieces placed in sequences of 2048 tokens.

Rows are told apart by doc_id and text. Rows that agree in both are copies of each other (one stays in stage 2); rows without words are linked with nothing
and stay there. Every stage takes empty tables. Stages 2 and 3 write the keys of the rows that go. A filter of at most ``FILTER_WORDS`` 64-bit words over these keys
parts the rows that cannot be meant, which stay where they are, from the others, which are joined with the keys (and shuffled, if the keys are not small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe.llm import jaccard, language, packing, personal, positional
from tallyframe.llm.queries import tokenizer_file
from tallyframe.llm.workers import reach_package
from tallyframe.session import scratch_path, written

#: Below this share of letters in one language a document has none. Texts that mix two or three languages are kept.
LEAST_SCORE = 0.25
#: Words of an n-gram and least similarity in per cent of near copies; op8's own values hold for that query only.
COPY_WORDS, COPY_PERCENT = 5, 80

#: Words of the filter over keys of rows, at most; it is broadcast. Rows that it lets through are joined with the keys themselves.
FILTER_WORDS = 1 << 18

#: Not expressible in SQL: models, tokenizer and packing are code. The stages are tested against brute force.
ORACLE_SQL = None


def _row() -> Column:
    """What tells rows apart; rows with a doc_id come first, in its order."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.xxhash64("text").alias("text_hash"))


def _written(frame: DataFrame, name: str) -> DataFrame:
    return written(frame, scratch_path(frame.sparkSession, name))


def _parted(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents that may be among these keys, and those that are not; the texts of the latter need no shuffle."""
    word = lambda key: F.xxhash64(key).bitwiseAND(FILTER_WORDS - 1)
    bit = lambda key: F.shiftrightunsigned(F.xxhash64(key), 58).cast("int")
    hashed = keys.toDF("key").select(word("key").alias("word"), bit("key").alias("bit"))
    # At most FILTER_WORDS rows, whatever the keys.
    words = F.broadcast(hashed.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    key = F.to_json(_row())
    met = (word(key) == F.col("word")) & (F.call_function("getbit", F.col("bits"), bit(key)) == 1)
    return docs.join(words, met, "left_semi"), docs.join(words, met, "left_anti")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose key is not among the written ones."""
    doubtful, clear = _parted(docs, gone)
    return clear.union(doubtful.join(gone, F.to_json(_row()) == F.col("gone"), "left_anti"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    found = language.identify(docs, language.learn(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    keyed = docs.select(_row().alias("row"), "text")
    placed = _written(jaccard.components(keyed, size=COPY_WORDS, percent=COPY_PERCENT, key="row").withColumnRenamed("doc_id", "row"), "placed")
    gone = _written(placed.where(F.col("row") != F.col("component_id")).select(F.to_json("row").alias("gone")).distinct(), "gone")
    repeated = placed.where("n_shingles > 0").groupBy("row").count().where("count > 1").select("row")
    repeated = _written(repeated.select(F.to_json("row").alias("again")), "repeated")
    doubtful, clear = _parted(docs, gone.union(repeated))
    key = F.to_json(_row())
    kept = doubtful.join(gone, key == F.col("gone"), "left_anti")
    once = kept.join(repeated, key == F.col("again"), "left_semi").withColumn("row_key", key).dropDuplicates(["row_key"]).drop("row_key")
    return clear.union(kept.join(repeated, key == F.col("again"), "left_anti")).union(once.select(docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    path = scratch_path(spark, "index")
    positional.write_index(docs.select(F.to_json(_row()).alias("row"), "text"), path, key="row")
    found = positional.find_passages(spark, path, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))
    gone = found.where(positional.contaminated(F.col("n_hit"), F.col("n_words")))
    return _without(docs, _written(gone.select(F.col("key").alias("gone")).distinct(), "gone"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    masked = personal.mask(docs, personal.learn(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), "n_chars")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_package(spark)
    path = scratch_path(spark, "pieces")
    packing.write_pieces(docs, path, tokenizer_file())
    return packing.pack(spark, path).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = _written(stage(spark, docs, sf_dir), name)
    return docs
