"""Texts drawn so that their hashed word runs are distributed like those of a target (importance resampling).

1. Features are all runs of 1 to ``RUNS`` neighbouring words (``words.ALNUM``, joined by one space). A feature's bucket is the CRC-32 of its
   bytes modulo ``BUCKETS``. Each task adds up its own counts; one row for a bucket and task is shuffled.
2. A bucket's gain is the logarithm of its share in the target over its share in the texts, each with one more event a bucket.
3. A text's weight is the mean gain of its features. Weight and Gumbel noise from a hash of the key give its score; the highest scores are drawn,
   which samples without replacement in proportion to exp(weight). Ranks come from one distributed sort.

CRC-32 is linear over XOR but for a constant of the length: a byte contributes a value that depends only on the byte and on its distance from the end.
``POSITIONS`` holds these values, so the sums of all features of a chunk are one gather and one ``bitwise_xor.reduceat`` over their spans. Spans beyond
``REACH`` bytes are cut into blocks from the end; block sums are folded pairwise, the front one moved over the other by byte tables for 1, 2, 4 .. blocks.

Cases: NULL and empty texts, and those without words, have no features, weight 0 and no rank. With an empty target all gains follow from the smoothing alone.
Repeated rows count and are drawn by themselves. A NULL key hashes like an empty one and comes last in a tie. An empty table gives no rows. Only
the key and the text are read. Scores are whole thousandths.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.llm.words import ALNUM, ranges, text_chunks, words_of
from tallyframe.operators.numbering import number_rows
from tallyframe.session import scratch_path

RUNS = 2
BUCKETS = 10_000
#: Distances from the end for which a byte's contribution is in the table.
REACH = 64
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _position_table() -> np.ndarray:
    """What byte b at distance d from the end adds: entry 256 * d + b."""
    zeros = [zlib.crc32(bytes(d + 1)) for d in range(REACH)]
    return np.array([zlib.crc32(bytes([b]) + bytes(d)) ^ zeros[d] for d in range(REACH) for b in range(256)], np.uint32)


POSITIONS = _position_table()
#: The checksum of so many zero bytes, up to ``REACH``.
_ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def _moved(sums: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums with the bytes behind them that ``table`` (four times 256 entries, for the four bytes of a sum) stands for."""
    out = table[0][sums & 255]
    for k in range(1, 4):
        out = out ^ table[k][sums >> np.uint32(8 * k) & 255]
    return out


# A sum's byte k is a byte of the message k places before the last of four.
_BLOCK = np.stack([POSITIONS[256 * (REACH - 1 - k) : 256 * (REACH - k)] for k in range(4)])


def _fold(blocks: np.ndarray) -> int:
    """The sum of one span from those of its blocks, the last one first."""
    table = _BLOCK
    while len(blocks) > 1:
        if len(blocks) % 2:
            blocks = np.append(blocks, np.uint32(0))
        blocks = blocks[0::2] ^ _moved(blocks[1::2], table)
        table = _moved(table, table)
    return int(blocks[0])


def _zeros_of(length: int) -> int:
    """The checksum of ``length`` zero bytes, without making them: the start value moved over them."""
    sums, table, blocks = np.array([0xFFFFFFFF], np.uint32), _BLOCK, length // REACH
    while blocks:
        if blocks & 1:
            sums = _moved(sums, table)
        table, blocks = _moved(table, table), blocks >> 1
    value = int(sums[0])
    for _ in range(length % REACH):
        value = value >> 8 ^ int(POSITIONS[value & 255])
    return value ^ 0xFFFFFFFF


def span_checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] for many spans, which may overlap; none is empty."""
    length = end - start
    blocks = -(-length // REACH)
    # Blocks of a span from its end on; only the last one, at the front, may be shorter.
    owner = np.repeat(np.arange(len(start)), blocks)
    number = ranges(np.zeros(len(start), np.int64), blocks)
    stop = end[owner] - number * REACH
    size = np.minimum(REACH, stop - start[owner])
    first = np.cumsum(size) - size
    places = ranges(stop - size, size)
    distance = np.repeat(first + size - 1, size) - np.arange(len(places))
    sums = np.bitwise_xor.reduceat(POSITIONS[distance << 8 | data[places]], first)
    if len(sums) == len(start):
        return sums ^ _ZEROS[length]
    heads = np.cumsum(blocks) - blocks
    out = sums[heads]
    short = blocks == 1
    out[short] ^= _ZEROS[length[short]]
    for k in np.flatnonzero(~short):
        out[k] = _fold(sums[heads[k] : heads[k] + blocks[k]]) ^ _zeros_of(int(length[k]))
    return out


def features_of(data: np.ndarray, offsets: np.ndarray, runs: int = RUNS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of a chunk of texts, and the texts' word counts."""
    words = words_of(data, offsets, ALNUM)
    length = words.end - words.start
    begin = np.cumsum(length + 1) - length - 1
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[ranges(begin, length)] = _LOWER[data[ALNUM[data]]]
    stop, owner = begin + length, words.owner()
    texts, buckets_of = [], []
    for size in range(1, runs + 1):
        last = np.arange(size - 1, len(begin))
        first = last - size + 1
        whole = owner[last] == owner[first]
        first, last = first[whole], last[whole]
        if len(first):
            texts.append(owner[first])
            buckets_of.append(span_checksums(joined, begin[first], stop[last]) % np.uint32(buckets))
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words.counts
    return np.concatenate(texts), np.concatenate(buckets_of).astype(np.int64), words.counts


def _count(batches: Iterator[pa.RecordBatch], runs: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, data, offsets in text_chunks(batch.column(0), CHUNK):
            counts += np.bincount(features_of(data, offsets, runs, buckets)[1], minlength=buckets)
    there = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["bucket", "n"])


def count_features(texts: DataFrame, text: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket has; ``buckets`` numbers on the driver."""
    counted = texts.select(text).mapInArrow(lambda batches: _count(batches, runs, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # one row a bucket at most
        out[bucket] = n
    return out


def gains_of(target: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the texts, rounded down."""
    many = len(texts)
    target_all, texts_all = float(target.sum() + many), float(texts.sum() + many)
    return np.array([math.floor(1000 * math.log((t + 1.0) * texts_all / ((s + 1.0) * target_all))) for t, s in zip(target.tolist(), texts.tolist(), strict=True)], np.int64)


def noise_of(key: object, seed: int) -> int:
    """Thousandths of Gumbel noise, from a hash of seed and key."""
    number = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((number + 0.5) / 4294967296)))


def _weigh(batches: Iterator[pa.RecordBatch], gains: np.ndarray, seed: int, runs: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column(1), CHUNK):
            texts, bucket, n_words = features_of(data, offsets, runs, len(gains))
            many = len(offsets) - 1
            n = np.bincount(texts, minlength=many)
            total = np.zeros(many, np.int64)
            np.add.at(total, texts, gains[bucket])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            keys = batch.column(0).slice(row, many)
            score = weight + np.array([noise_of(key, seed) for key in keys.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (n_words, n, weight, score))], names=["key", "n_words", "n_features", "weight", "score"])


def weigh(documents: DataFrame, gains: np.ndarray, seed: int, key: str = "doc_id", text: str = "text", runs: int = RUNS) -> DataFrame:
    """(key, n_words, n_features, weight, score) of every text."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    arrow = to_arrow_type(kind)

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _weigh(batches, gains, seed, runs):
            yield batch.set_column(0, "key", batch.column(0).cast(arrow))

    return rows.mapInArrow(cast, f"key {kind.simpleString()}, n_words long, n_features long, weight long, score long")


def resample(documents: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, key: str = "doc_id", text: str = "text", target_text: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_features, weight, score, rank) of every text; ``rank`` from 1 on for those drawn, else NULL.

    Drawn are ``percent`` of the texts with ``least_words`` words, rounded down, by the highest scores; ties go to the smaller key.
    """
    spark = documents.sparkSession
    gains = gains_of(count_features(target, target_text, runs, buckets), count_features(documents, text, runs, buckets))
    path = scratch_path(spark, "weights")
    weigh(documents, gains, seed, key, text, runs).write.parquet(path)
    weighed = spark.read.parquet(path)
    able = F.col("n_words") >= least_words
    draw = percent * weighed.where(able).count() // 100
    ranked = number_rows(weighed.where(able), "place", [F.desc("score"), F.asc_nulls_last("key")])
    rank = F.when(F.col("place") <= draw, F.col("place"))
    columns = ["key", "n_features", "weight", "score"]
    rest = weighed.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).union(rest)
