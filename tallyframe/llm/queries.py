"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import alignment, archive, jaccard, katz, language, packing, personal, positional, resampling, simhash, url_cascade, vector_search, wrapper
from tallyframe.llm.workers import reach_package
from tallyframe.session import scratch_path

#: The rules of the URL query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three quarters of those with a label."""
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = language.held_out(F.col("doc_id"), 4, 2)
    model = language.learn(documents.where(~held))
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to an archive and read back."""
    path = scratch_path(spark, "archive")
    archive.write_archive(_table(spark, folder, "pages"), path)
    records = archive.read_archive(spark, path)
    return records.select(
        "page_id",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    path = scratch_path(spark, "pieces")
    packing.write_pieces(_table(spark, folder, "documents"), path, tokenizer_file())
    return packing.pack(spark, path).withColumnRenamed("key", "doc_id")


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    found = personal.find(documents, personal.learn(documents))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("pii_spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(F.size(F.filter(base, _is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in personal.KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii_spans")).alias("spans"),
    )


def _is_kind(kind: str):
    return lambda span: span["kind"] == kind


def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    found = wrapper.extract(_table(spark, folder, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows found in every document."""
    path = scratch_path(spark, "index")
    positional.write_index(_table(spark, folder, "documents"), path)
    found = positional.find_passages(spark, path, _table(spark, folder, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        positional.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict for every page's URL."""
    judged = url_cascade.judge(_table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document, by 4-word shingles and a similarity of 0.85."""
    return jaccard.components(_table(spark, folder, "documents"))


def op9_katz(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score, learned from six sevenths of them."""
    held = language.held_out(F.col("doc_id"), 7, 2)
    scored, unigrams = katz.score(_table(spark, folder, "documents"), ~held)
    return scored.withColumnRenamed("key", "doc_id").select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(unigrams.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op10_top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best vectors for each hundredth vector."""
    return vector_search.top_k(_table(spark, folder, "embeddings"), lambda key: key % 100 == 0)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned, and its links by how many documents hold them."""
    found = alignment.align(_table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return found.withColumnRenamed("key", "doc_id")


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's words."""
    found = resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.withColumnRenamed("key", "doc_id")


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document by SimHash fingerprints that differ in at most two bits."""
    return simhash.components(_table(spark, folder, "documents")).withColumnRenamed("key", "doc_id")


QUERIES = {
    "op1_language": op1_language,
    "op2_archive": op2_archive,
    "op3_packing": op3_packing,
    "op4_personal_data": op4_personal_data,
    "op5_main_text": op5_main_text,
    "op6_decontamination": op6_decontamination,
    "op7_url_rules": op7_url_rules,
    "op8_near_copies": op8_near_copies,
    "op9_katz": op9_katz,
    "op10_top_vectors": op10_top_vectors,
    "op11_alignment": op11_alignment,
    "op12_resampling": op12_resampling,
    "op13_simhash": op13_simhash,
}
