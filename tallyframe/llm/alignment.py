"""The tokens of two tokenizers over the same texts, aligned by their bytes, and how often each pair of ids is aligned in a corpus.

1. A chunk of texts is encoded by A (byte-level pairs, JSON file) and B (sentence pieces), each token with its byte range in a space and the text.
   All tokens of the chunk are sorted by their starts (``lexsort``), their ends run up (``maximum.accumulate``), and a group of tokens ends where a
   start reaches the running maximum. Within a group every token of A is linked with every one of B.
2. The links of a chunk are counted for each (pair of ids, text). They are written once, dealt by A's id to ``PARTS`` parts: pairs in order, texts of each pair,
   and how often each text has it.
3. The texts of each pair are summed over chunks, part by part, in rounds of ``FAN`` chunks. The table (pair, texts) has at most as many rows as the two
   vocabularies allow, whatever the corpus; all pairs of an id of A lie in one part, so its largest count is found there.
4. A part's table meets the links of its part, in lanes whose number grows with the links. Each lane gives sums for each chunk's texts, which are put together by chunk.

Cases: NULL and empty texts, and those whose bytes A or B does not give back (a text with U+2581, for instance), have no tokens and zeros. Special
tokens inside texts are plain text. Groups of very many tokens are linked by distinct ids and their counts. Repeated rows count by themselves. NULL keys are kept. An empty table
gives no rows. Only the key and the text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.llm.byte_planes import pack, unpack
from tallyframe.llm.words import ranges, text_chunks
from tallyframe.llm.workers import lean
from tallyframe.session import scratch_path

PARTS = 64
CHUNK = 2 << 20
#: Chunks whose counts are summed at once, and bytes of links in a lane of a part.
FAN = 64
LANE_BYTES = 16 << 20
#: Links that are spread out at once; a group with more than the second number is linked by distinct ids.
LINKS = 1 << 20
LARGE_GROUP = 4096

#: Bits of an id of B, of an id of A, and of a text's number in its chunk.
B_BITS, A_BITS, TEXT_BITS = 15, 16, 26


def shown_bytes() -> dict[str, int]:
    """The characters by which byte-level models show bytes: printable ones as themselves, the others from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """The bytes of every id, one after the other."""

    data: np.ndarray
    first: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        length = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(length) - length, length)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.first[ids], self.length[ids])]


class ByteLevel:
    """Ids by a byte-level tokenizer.

    Texts of Latin letters, on whose classes all versions of Unicode agree, are encoded from the same vocabulary by a faster library if the
    merges stand in the order of the ids; others go through the tokenizer itself.
    """

    def __init__(self, file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        shown = shown_bytes()
        model = json.loads(self.tokenizer.to_str())["model"]
        own = {bytes(shown[c] for c in name): number for name, number in model["vocab"].items()}
        merged = ["".join(merge if isinstance(merge, list) else merge.split(" ")) for merge in model["merges"]]
        ordered = all(model["vocab"][name] == 256 + k for k, name in enumerate(merged))
        self.fast = tiktoken.Encoding("pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own, special_tokens={}) if ordered else None
        self.unusual = re.compile("[\x1c-\x1f\u0250-\U0010ffff]").search
        tokens = [name.encode() for name, _ in sorted(self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])]
        for data, number in own.items():
            tokens[number] = data
        self.vocabulary = Vocabulary.of(tokens)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or self.unusual(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4")
        return np.array(self.fast.encode_ordinary(text), "<i4")


class Pieces:
    """Ids by a sentence-piece model."""

    def __init__(self, file: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=file)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.vocabulary = Vocabulary.of([bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)])

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), "<i4")


@dataclass
class Aligned:
    """The tokens of a chunk's texts: ids and groups of A and B in order, and the text of each group."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    text: np.ndarray
    texts: int

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(self.group_a, minlength=len(self.text)), np.bincount(self.group_b, minlength=len(self.text))


def _encoded(encode, texts: list[str], prefix: str) -> tuple[np.ndarray, np.ndarray]:
    nothing = np.zeros(0, "<i4")
    found = [encode(prefix + text) if text else nothing for text in texts]
    return np.concatenate([nothing, *found]).astype(np.int64), np.array([len(x) for x in found], np.int64)


def _sums(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums of neighbouring values, so many each."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(many)
    return total[ends] - total[ends - many]


def align_chunk(data: np.ndarray, offsets: np.ndarray, one: ByteLevel, two: Pieces) -> Aligned:
    """The groups of the texts that lie at the offsets of the bytes."""
    texts = [data[x:y].tobytes().decode() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    (a, n_a), (b, n_b) = _encoded(one.encode, texts, " "), _encoded(two.encode, texts, "")
    size = np.diff(offsets)
    many = np.where(size > 0, size + 1, 0)
    whole = (size > 0) & (_sums(one.vocabulary.length[a], n_a) == many) & (_sums(two.vocabulary.length[b], n_b) == many)
    for _ in range(2):  # after the lengths the bytes themselves
        a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
        n_a, n_b, many = np.where(whole, n_a, 0), np.where(whole, n_b, 0), np.where(whole, many, 0)
        source = np.full(int(many.sum()), 32, np.uint8)
        first = np.cumsum(many) - many
        source[ranges(first[whole] + 1, size[whole])] = data[ranges(offsets[:-1][whole], size[whole])]
        wrong = (one.vocabulary.bytes_of(a) != source) | (two.vocabulary.bytes_of(b) != source)
        if not wrong.any():
            break
        whole &= _sums(wrong.astype(np.int64), many) == 0
    ends = [np.cumsum(one.vocabulary.length[a]), np.cumsum(two.vocabulary.length[b])]
    start = np.concatenate([ends[0] - one.vocabulary.length[a], ends[1] - two.vocabulary.length[b]])
    end = np.concatenate(ends)
    order = np.lexsort((end, start))
    running = np.maximum.accumulate(end[order])
    group = np.empty(len(order), np.int64)
    breaks = np.append(False, start[order][1:] >= running[:-1])[: len(order)]
    group[order] = np.cumsum(breaks)
    owner = np.repeat(np.arange(len(texts)), n_a)
    heads = np.flatnonzero(np.append(True, group[: len(a)][1:] != group[: len(a)][:-1])[: len(a)])
    return Aligned(a, b, group[: len(a)], group[len(a) :], owner[heads], len(texts))


_DIGITS = [str(k).encode() for k in range(1 << A_BITS)]
_NUMBERS = Vocabulary.of(_DIGITS)


def group_texts(found: Aligned) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``: the ids of A and of B in order."""
    ids = np.concatenate([found.a, found.b])
    group = np.concatenate([found.group_a, found.group_b])
    order = np.argsort(group, kind="stable")  # A's tokens of a group stand before B's
    ids, group, of_b = ids[order], group[order], order >= len(found.a)
    length = _NUMBERS.length[ids] + 1
    out = np.empty(int(length.sum()), np.uint8)
    first = np.cumsum(length) - length
    out[ranges(first, length - 1)] = _NUMBERS.bytes_of(ids)
    last = np.append(group[1:] != group[:-1], True)[: len(ids)]
    turn = np.append(of_b[1:] != of_b[:-1], True)[: len(ids)]
    out[first + length - 1] = np.where(last, ord(";"), np.where(turn, ord("|"), ord(",")))
    sizes = np.bincount(found.text[group], weights=length, minlength=found.texts).astype(np.int64)
    ends = np.cumsum(sizes)
    joined = out.tobytes()
    return [joined[end - size : max(end - 1, end - size)] for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)]


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of ids as numbers that sort by part, A's id and B's id."""
    return ((a % PARTS) << A_BITS | a) << B_BITS | b


def _links(found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """(pair and text as one number, how often) for the links of a chunk, a bounded number at once; None for once each."""
    n_a, n_b = found.sizes
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    links = n_a * n_b
    small = np.flatnonzero(links <= LARGE_GROUP)
    cuts = np.searchsorted(np.cumsum(links[small]), np.arange(LINKS, int(links[small].sum()) + LINKS, LINKS), side="right")
    for groups in np.split(small, cuts):
        if len(groups):
            many = links[groups]
            which = np.repeat(groups, many)
            place = ranges(np.zeros(len(groups), np.int64), many)
            a, b = found.a[first_a[which] + place // n_b[which]], found.b[first_b[which] + place % n_b[which]]
            yield pair_of(a, b) << TEXT_BITS | found.text[which], None
    for g in np.flatnonzero(links > LARGE_GROUP):
        a, times_a = np.unique(found.a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(found.b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        step = max(1, LINKS // len(b))
        for k in range(0, len(a), step):
            yield (pair_of(a[k : k + step, None], b[None]) << TEXT_BITS | found.text[g]).ravel(), (times_a[k : k + step, None] * times_b[None]).ravel()


def links_of(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, text, how often) of a chunk's links, by pair and text."""
    keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for key, many in _links(found):
        if many is None:
            key = np.sort(key)
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, many = key[heads], np.diff(np.append(heads, len(key)))
        keys.append(key)
        times.append(many)
    key, many = np.concatenate(keys), np.concatenate(times)
    if len(keys) > 2:
        order = np.argsort(key, kind="stable")
        key, many = key[order], many[order]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        key, many = key[heads], np.add.reduceat(many, heads) if len(heads) else many
    return key >> TEXT_BITS, key & (1 << TEXT_BITS) - 1, many


def _steps(numbers: np.ndarray) -> np.ndarray:
    return np.diff(numbers, prepend=0)


def _encode(batches: Iterator[pa.RecordBatch], file_a: str, file_b: str, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """For each chunk a head row (part -1) with its texts' figures, and a row for each part with its links."""
    one, two = ByteLevel(file_a), Pieces(file_b)
    context = TaskContext.get()
    chunk = (context.partitionId() if context else 0) << 32
    names = ["part", "chunk", "keys", "figures", "digests", "pairs", "texts", "text", "times"]
    kinds = [pa.int64(), pa.int64(), pa.list_(key_type), *[pa.binary()] * 6]
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column(1), CHUNK):
            found = align_chunk(data, offsets, one, two)
            many = found.texts
            n_a, n_b = found.sizes
            count = lambda weights, found=found, many=many: np.bincount(found.text, weights=weights, minlength=many).astype("<i8")
            figures = np.stack([count(n_a), count(n_b), count(None), count(n_a * n_b)])
            digests = b"".join(hashlib.sha256(text).digest() for text in group_texts(found))
            rows = [(-1, chunk, batch.column(0).slice(row, many).to_pylist(), figures.tobytes(), digests, None, None, None, None)]
            pair, text, times = links_of(found)
            heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
            pairs, texts = pair[heads], np.diff(np.append(heads, len(pair)))
            # Texts of a pair as steps from one to the next.
            step = _steps(text)
            step[heads] = text[heads]
            edges = np.searchsorted(pairs >> A_BITS + B_BITS, np.arange(PARTS + 1))
            bounds = np.append(heads, len(pair))
            for part, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if y > x:
                    u, v = bounds[x], bounds[y]
                    rows.append((part, chunk, None, None, None, pack(_steps(pairs[x:y]), "<i8"), pack(texts[x:y], "<u4"), pack(step[u:v], "<u4"), pack(times[u:v], "<u4")))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)
            chunk += 1


def _merged(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, texts = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.argsort(pairs, kind="stable")
    pairs, texts = pairs[order], texts[order]
    heads = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    return pairs[heads], np.add.reduceat(texts, heads)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each (part, lane) of sorted rows, the texts of equal pairs added up."""
    place, held, waiting = None, [], 0

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            pairs, texts = _merged(held)
            yield pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1]]), pa.array([pack(_steps(pairs), "<i8")]), pa.array([pack(texts, "<u8")])], names=["part", "lane", "pairs", "texts"])

    for batch in batches:
        for k in range(batch.num_rows):
            part, lane, wide = (batch.column(n)[k].as_py() for n in ("part", "lane", "wide"))
            if (part, lane) != place:
                yield from out()
                place, held, waiting = (part, lane), [], 0
            held.append((np.cumsum(unpack(batch.column("pairs")[k].as_buffer(), "<i8")), unpack(batch.column("texts")[k].as_buffer(), "<u8" if wide else "<u4").astype(np.int64)))
            waiting += len(held[-1][0])
            if waiting > 4_000_000 + 2 * len(held[0][0]):
                held = [_merged(held)]
                waiting = len(held[0][0])
    yield from out()


def _count_pairs(links: DataFrame, chunks: int, path: str) -> DataFrame:
    """(part, pairs, texts): how many texts hold each pair; written."""
    spark = links.sparkSession
    rows = links.select("part", F.xxhash64("chunk").alias("number"), "pairs", "texts", F.lit(False).alias("wide"))
    lanes, step = chunks, 0
    while True:
        lanes = -(-lanes // FAN)
        dealt = rows.withColumn("lane", F.pmod("number", F.lit(lanes))).drop("number").repartition("part", "lane").sortWithinPartitions("part", "lane")
        added = dealt.mapInArrow(_add_up, "part long, lane long, pairs binary, texts binary")
        added.write.parquet(f"{path}/counts-{step}")
        added = spark.read.parquet(f"{path}/counts-{step}")
        if lanes <= 1:
            return added.select("part", "pairs", "texts")
        rows = added.select("part", F.col("lane").alias("number"), "pairs", "texts", F.lit(True).alias("wide"))
        step += 1


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums for each text of a chunk's links in one part, from sorted rows in which a part's table stands before the links of a lane."""
    table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        for row in batch.to_pylist():
            pairs, texts = np.cumsum(unpack(row["pairs"], "<i8")), unpack(row["texts"], "<u8" if row["chunk"] is None else "<u4").astype(np.int64)
            if row["chunk"] is None:
                heads = np.flatnonzero(np.append(True, pairs[1:] >> B_BITS != pairs[:-1] >> B_BITS))
                most = np.repeat(np.maximum.reduceat(texts, heads), np.diff(np.append(heads, len(pairs))))
                table = pairs, texts, texts == most
                continue
            at = np.searchsorted(table[0], pairs)
            step, times = unpack(row["text"], "<u4").astype(np.int64), unpack(row["times"], "<u4").astype(np.int64)
            heads = np.cumsum(texts) - texts
            total = np.cumsum(step)
            text = total - np.repeat(total[heads] - step[heads], texts)
            present, local = np.unique(text, return_inverse=True)
            count_sum, best = np.zeros(len(present), np.int64), np.zeros(len(present), np.int64)
            np.add.at(count_sum, local, np.repeat(table[1][at], texts) * times)
            np.add.at(best, local, np.repeat(table[2][at], texts) * times)
            yield pa.RecordBatch.from_arrays([pa.array([row["chunk"]]), *(pa.array([pack(x, "<i8")]) for x in (present, count_sum, best))], names=["chunk", "text", "count_sum", "best"])


def _finish(batches: Iterator[pa.RecordBatch], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A chunk's texts, from sorted rows in which its head stands before its sums."""
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    head, sums = None, None

    def out() -> Iterator[pa.RecordBatch]:
        if head is not None:
            figures = np.frombuffer(head["figures"], "<i8").reshape(4, -1)
            digests = [head["digests"][32 * k : 32 * k + 32].hex() if n else "" for k, n in enumerate(figures[0].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(head["keys"], key_type), *map(pa.array, (*figures, sums[1], sums[0])), pa.array(digests, pa.string())], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            if row["keys"] is not None:
                yield from out()
                head, sums = row, np.zeros((2, len(row["keys"])), np.int64)
            else:
                text = unpack(row["text"], "<i8")
                sums[0, text] += unpack(row["count_sum"], "<i8")
                sums[1, text] += unpack(row["best"], "<i8")
    yield from out()


def align(documents: DataFrame, file_a: str, file_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text.

    A pair's count is the number of texts that hold it linked. ``n_best`` counts the links whose count is the highest of their A id, ``count_sum`` adds up the counts of all
    links, and ``groups_sha256`` digests what ``group_texts`` gives ('' without tokens).
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "alignment")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    schema = f"part long, chunk long, keys array<{name}>, figures binary, digests binary, pairs binary, texts binary, text binary, times binary"
    rows.mapInArrow(lean(lambda batches: _encode(batches, file_a, file_b, arrow)), schema).write.option("compression", "none").parquet(f"{path}/links")
    written = spark.read.parquet(f"{path}/links")
    heads, links = written.where("part < 0"), written.where("part >= 0")
    chunks, size = written.agg(F.count(F.when(F.col("part") < 0, 1)), F.sum(F.length("pairs") + F.length("texts") + F.length("text") + F.length("times"))).first()
    counts = _count_pairs(links, max(1, chunks), path)
    lanes = max(1, -(-(size or 0) // (PARTS * LANE_BYTES)))
    columns = ["part", "lane", "chunk", "pairs", "texts", "text", "times"]
    asked = links.withColumn("lane", F.pmod(F.xxhash64("chunk"), F.lit(lanes)))
    nothing = F.lit(None)
    tables = counts.select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), nothing.cast("long").alias("chunk"), "pairs", "texts", nothing.cast("binary").alias("text"), nothing.cast("binary").alias("times"))
    dealt = asked.select(columns).union(tables).repartition("part", "lane").sortWithinPartitions("part", "lane", F.asc_nulls_first("chunk"))
    sums = dealt.select(columns[2:]).mapInArrow(_meet, "chunk long, text binary, count_sum binary, best binary")
    told = heads.select("chunk", "keys", "figures", "digests").unionByName(sums, allowMissingColumns=True)
    placed = told.repartition("chunk").sortWithinPartitions("chunk", F.col("keys").isNull())
    schema = f"key {name}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return placed.mapInArrow(lambda batches: _finish(batches, arrow), schema)


def groups(documents: DataFrame, file_a: str, file_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, groups): the groups of every text, ``a1,a2|b1;a3|b2,b3`` with A's and B's ids."""
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    arrow = to_arrow_type(kind)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = ByteLevel(file_a), Pieces(file_b)
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(1), CHUNK):
                texts = [x.decode() for x in group_texts(align_chunk(data, offsets, one, two))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(texts)).cast(arrow), pa.array(texts, pa.string())], names=["key", "groups"])

    return rows.mapInArrow(found, f"key {kind.simpleString()}, groups string")
