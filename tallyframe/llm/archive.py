"""A content-addressed archive of WARC records, as two tables.

``payloads`` keeps each distinct payload once under its SHA-256; ``records`` keeps
the exact header block of each record, its digest and what it refers to. A
record is rebuilt by joining the two: header block, payload, two line ends.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
smallest id is the response; the others are revisits of it (``identical-payload-digest``), whose
own block is empty. Smaller payloads are always responses. Payload equality is verified: for each digest
the writer also compares lengths and a second hash, and the reader recomputes the digest of the payload it joined.

Cases: a NULL payload is an empty one. A NULL id sorts first, so such a record is the response. Rows that agree in
id and payload are one response and revisits of that same id. A NULL URL gives a record without a target line; line ends in a URL
are escaped. An empty table gives empty archives. Other columns of the input are not archived.

No record is gathered with its copies: the first id of a digest is a mergeable aggregate over (digest, id), and
both joins are plain shuffle joins, in which a hot digest is a skewed partition that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REVISIT_BYTES = 100
_CRLF = "\r\n"
#: Fixed values of the WARC 1.1 format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(name + ": "), F.lit(value) if isinstance(value, str) else value, F.lit(_CRLF))


def _record_id(key: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.substring(digest, 1, 16), F.lit(">"))


def _header(length: Column) -> Column:
    """The exact header block of a record; ``length`` is that of the block that follows."""
    revisit = F.col("record_type") == "revisit"
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(_VERSION + _CRLF),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", _DATE),
        F.coalesce(_line("WARC-Target-URI", url), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("digest"))), _line("WARC-Profile", _PROFILE))).otherwise(""),
        _line("Content-Length", length.cast("string")),
        F.lit(_CRLF),
    )


def write_archive(pages: DataFrame, path: str) -> None:
    """Write the archive of (page_id, url, html) below a shared path, as ``records`` and ``payloads``."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit("").cast("binary"))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    payloads = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")

    copies = (
        rows.select("page_id", "url", "digest", F.length("payload").cast("long").alias("bytes"), F.xxhash64("payload").alias("check"))
        .groupBy("digest", "page_id", "url")
        .agg(F.count("*").alias("copies"), *_extremes("bytes", "bytes", "check", "check"))
    )
    order = F.struct(F.col("page_id").isNotNull(), F.col("page_id").alias("id"), F.col("url").isNotNull(), F.col("url").alias("target"))
    first = copies.groupBy("digest").agg(F.min(order).alias("first"), *_extremes("low_bytes", "high_bytes", "low_check", "high_check"))
    agree = (F.col("low_bytes") == F.col("high_bytes")) & (F.col("low_check") == F.col("high_check"))
    first = first.select(
        "digest",
        F.col("first.id").alias("first_id"),
        F.col("first.target").alias("first_url"),
        F.when(agree, F.col("low_bytes")).otherwise(F.raise_error(F.concat(F.lit("unequal payloads under "), F.col("digest")))).alias("bytes"),
    )
    leads = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url")) & (F.col("copy") == 1)
    response = leads | (F.col("bytes") < REVISIT_BYTES)
    records = (
        copies.select("digest", "page_id", "url", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
        .join(first, "digest")
        .withColumn("record_type", F.when(response, "response").otherwise("revisit"))
        .withColumn("refers_to", F.when(~response, F.col("first_id")))
        .withColumn("header", _header(F.when(response, F.col("bytes")).otherwise(F.lit(0).cast("long"))))
    )
    records.select("page_id", "digest", "refers_to", "header").write.option("compression", "zstd").parquet(f"{path}/records")


def _extremes(*columns: str) -> list[Column]:
    """Smallest and largest length, smallest and largest second hash of what shares a digest."""
    names = ("low_bytes", "high_bytes", "low_check", "high_check")
    return [(F.max if name.startswith("high") else F.min)(column).alias(name) for name, column in zip(names, columns, strict=True)]


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: page_id, record_type, refers_to, url, payload, and ``record``, the exact bytes of the WARC record.

    ``payload`` is the full one, for revisits that of the response. A payload that does not
    have its digest is an error.
    """
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    found = F.sha2("payload", 256)
    sound = F.when(found == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
    joined = records.join(payloads.select("digest", sound.alias("payload")), "digest")
    kind = F.regexp_extract("header", "WARC-Type: (\\w+)", 1)
    block = F.when(kind == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    ends = F.lit(_CRLF + _CRLF).cast("binary")
    return joined.select(
        "page_id",
        kind.alias("record_type"),
        "refers_to",
        F.regexp_extract("header", "WARC-Target-URI: ([^\r\n]*)", 1).alias("url"),
        "digest",
        "payload",
        F.concat(F.encode("header", "UTF-8"), block, ends).alias("record"),
    )


def block_of(record: Column) -> Column:
    """The block of a record's exact bytes, by its header block and Content-Length."""
    text = F.decode(record, "ISO-8859-1")
    start = F.instr(text, _CRLF + _CRLF) + 4
    length = F.regexp_extract(text, "Content-Length: ([0-9]+)", 1).cast("int")
    return F.substr(record, start, length)
