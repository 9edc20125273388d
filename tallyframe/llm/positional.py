"""Benchmark passages found in a corpus by a positional inverted index.

The index lies in segments of neighbouring documents (about ``words.CHUNK_BYTES`` of text each; a document is never cut).
A segment is one row: its documents, its distinct terms in order, and for each
term the word places where it stands. Terms are 64-bit hashes of words (``words.ALNUM``).
It is written once and holds every word of every document.

A test item gives windows of ``WINDOW`` neighbouring words; an item of fewer words, but not none, is one
window. Windows come from the driver in blocks of ``BLOCK_WINDOWS``, which bounds what a task and the
driver hold; each block is one pass over the segments, whose hits are written before the next block is read. In a segment a window whose terms are not all there ends at
once. For the others the places of the rarest term, shifted back by its offset, are intersected with those of
the next rarest term, and so on until none is left or all agree. With ``slack`` a term may stand
that many words from its place (proximity); with 0 matches are exact phrases.

Cases: NULL and empty texts have no words and no hits. Items without words give no window. Items with a NULL id count like others, but are not listed.
Items that repeat a window all count. Repeated documents are judged one by one, each by its own row. A NULL key stays NULL. Empty tables give
no rows, or no hits. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm.words import ALNUM, text_chunks, words_of
from tallyframe.llm.workers import lean
from tallyframe.session import scratch_path

WINDOW = 13
BLOCK_WINDOWS = 200_000


def _planes(numbers: np.ndarray) -> bytes:
    """Differences of 32-bit numbers, byte plane by byte plane, which packs well."""
    steps = np.diff(numbers.astype(np.int32), prepend=np.int32(0)).astype(np.int32)
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()
    return np.cumsum(steps, dtype=np.int32)


def _postings(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms in order, where each one's list starts, and the places of all terms in turn."""
    if not len(hashes):
        return hashes, np.zeros(1, np.int64), np.zeros(0, np.int64)
    order = np.argsort(hashes)
    ranked = hashes[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    rank = np.cumsum(new) - 1
    pairs = np.sort((rank.astype(np.uint64) << np.uint64(32)) | order.astype(np.uint64))
    return ranked[new], np.append(np.flatnonzero(new), len(hashes)), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _index(batches: Iterator[pa.RecordBatch], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    segment = (context.partitionId() if context else 0) << 32
    for batch in batches:
        keys = batch.column(0)
        for row, data, offsets in text_chunks(batch.column(1)):
            words = words_of(data, offsets, ALNUM)
            terms, starts, places = _postings(words.hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([segment]),
                    pa.array([keys.slice(row, len(offsets) - 1).to_pylist()], pa.list_(key_type)),
                    pa.array([_planes(words.first)]),
                    pa.array([terms.tobytes()]),
                    pa.array([_planes(starts)]),
                    pa.array([_planes(places)]),
                ],
                names=["segment", "keys", "first", "terms", "starts", "places"],
            )
            segment += 1


def write_index(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the index of all documents to a shared path."""
    kind = dict(documents.dtypes)[key]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = f"segment long, keys array<{kind}>, first binary, terms binary, starts binary, places binary"
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows.mapInArrow(lean(lambda batches: _index(batches, arrow)), schema).write.option("compression", "zstd").parquet(path)


def _windows(items: Iterator[tuple[str | None, str | None]], size: int, limit: int) -> Iterator[list[tuple[bytes, str | None]]]:
    """Blocks of (the window's term hashes, item)."""
    block: list[tuple[bytes, str | None]] = []
    for item, text in items:
        data = np.frombuffer((text or "").encode(), np.uint8)
        hashes = words_of(data, np.array([0, len(data)]), ALNUM).hashes
        for at in range(max(1, len(hashes) - size + 1) if len(hashes) else 0):
            block.append((hashes[at : at + size].tobytes(), item))
            if len(block) == limit:
                yield block
                block = []
    yield block


def _intersect(terms: list[np.ndarray], slack: int) -> np.ndarray:
    """Places of the window's start at which each term stands in its turn, or at most ``slack`` words off; rarest term first."""
    order = sorted(range(len(terms)), key=lambda k: len(terms[k]))
    starts = terms[order[0]] - order[0]
    for k in order[1:]:
        want, there = starts + k, terms[k]
        at = np.searchsorted(there, want - slack)
        near = there[np.minimum(at, len(there) - 1)]
        starts = starts[(near >= want - slack) & (near <= want + slack)]
        if not len(starts):
            break
    return starts


def _matcher(block: list[tuple[bytes, str | None]], slack: int, all_rows: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    owners: dict[bytes, set[str]] = {}
    for window, item in block:
        owners.setdefault(window, set()).update(() if item is None else (item,))
    windows = [(np.frombuffer(window, np.uint64), sorted(items)) for window, items in owners.items()]
    known = np.unique(np.concatenate([terms for terms, _ in windows])) if windows else np.zeros(0, np.uint64)
    slots = [np.searchsorted(known, terms) for terms, _ in windows]
    flat = np.concatenate(slots) if slots else np.zeros(0, np.int64)
    heads = np.cumsum([0, *map(len, slots)])[:-1]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield one({name: batch.column(name)[row].as_py() for name in batch.schema.names}, batch.schema.field("keys").type)

    def one(row: dict, key_type: pa.DataType) -> pa.RecordBatch:
        first = _from_planes(row["first"])
        terms = np.frombuffer(row["terms"], np.uint64)
        spans: dict[int, list[tuple[int, int]]] = {}
        found: dict[int, set[str]] = {}
        if len(known) and len(terms):
            at = np.minimum(np.searchsorted(terms, known), len(terms) - 1)
            there = terms[at] == known
            complete = np.flatnonzero(np.logical_and.reduceat(there[flat], heads))
            if len(complete):
                starts, places = _from_planes(row["starts"]), _from_planes(row["places"])
            for w in complete:
                ids = at[slots[w]]
                hits = _intersect([places[starts[t] : starts[t + 1]] for t in ids], slack)
                low, high = hits - slack, hits + len(ids) + slack
                doc = np.searchsorted(first, hits, side="right") - 1
                inside = (hits >= 0) & (hits + len(ids) <= first[np.minimum(doc + 1, len(first) - 1)])
                for d, s, e in zip(doc[inside].tolist(), low[inside].tolist(), high[inside].tolist(), strict=True):
                    spans.setdefault(d, []).append((max(s, int(first[d])) - int(first[d]), min(e, int(first[d + 1])) - int(first[d])))
                    found.setdefault(d, set()).update(windows[w][1])
        docs = list(range(len(first) - 1)) if all_rows else sorted(spans)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row["segment"]] * len(docs), pa.int64()),
                pa.array(docs, pa.int64()),
                pa.array([row["keys"][d] for d in docs], key_type.value_type),
                pa.array([int(first[d + 1] - first[d]) for d in docs], pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in _merged(spans.get(d, []))] for d in docs], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([sorted(found.get(d, ())) for d in docs], pa.list_(pa.string())),
            ],
            names=["segment", "place", "key", "n_words", "spans", "items"],
        )

    return match


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def find_passages(
    spark: SparkSession, path: str, items: DataFrame, size: int = WINDOW, slack: int = 0, key: str = "item_id", text: str = "text", block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """For every indexed document: key, n_words, the merged word spans that windows of the items match, and those items.

    Spans are word places, end exclusive. The text of the spans is the caller's to cut.
    """
    index = spark.read.parquet(path)
    kind = dict(index.dtypes)["keys"][len("array<") : -1]
    schema = f"segment long, place long, key {kind}, n_words long, spans array<struct<start: long, end: long>>, items array<string>"
    listed = items.select(F.col(key).cast("string"), F.col(text))
    passes: list[str] = []
    for block in _windows(listed.toLocalIterator(), size, block_windows):
        hits = index.mapInArrow(lean(_matcher(block, slack, not passes)), schema)
        passes.append(scratch_path(spark, "hits"))
        hits.write.parquet(passes[-1])
    found = spark.read.schema(schema).parquet(*passes)
    gathered = found.groupBy("segment", "place").agg(
        F.first("key").alias("key"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return gathered.withColumn("n_hit", _covered(F.col("spans"))).drop("segment", "place")


def _covered(spans):
    """Words inside sorted spans, which may overlap where several blocks found them."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state, span):
        fresh = F.greatest(span["end"] - F.greatest(span["start"], state["end"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(state["end"], span["end"]).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(spans, zero, add)["n"]


def contaminated(n_hit, n_words):
    """A document is contaminated if hits make up a twentieth of its words or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
