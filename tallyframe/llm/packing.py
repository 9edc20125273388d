"""Documents packed into sequences by length patterns fitted with non-negative least squares.

1. Documents become token pieces of at most ``SEQUENCE`` tokens; only longer ones are cut. The pieces are written once.
2. The histogram of piece lengths, at most ``SEQUENCE`` numbers, goes to the driver. Patterns of one to three
   lengths that fill a sequence as well as present lengths allow are enumerated, and repeat counts are fitted to the
   histogram by non-negative least squares. Rounded down, and never beyond what is there, they
   give most sequences. What is left is packed best-fit by counts, longest first: a
   piece goes where it leaves the least room.
3. Each piece gets its rank among the pieces of its length. A plan of (length, rank range) gives sequence and offset.

Ranks are made in buckets of about ``BUCKET_ROWS`` pieces of one length, so no task sees all of a common length. The plan has a
few thousand patterns at any size of the corpus.

Cases: NULL and empty texts are one piece with the closing token alone. Repeated rows are packed as often as they occur.
An empty table gives no rows. NULL keys are kept. Only the key and the text are read.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyframe.llm.words import ranges, text_chunks
from tallyframe.llm.workers import KEPT, lean

SEQUENCE = 2048
BUCKET_ROWS = 50_000
#: Bytes, about, of the chunks of text and ASCII runs within them, and of the other runs, that a Python worker keeps of late with their ids; as many of those before stay.
CACHE_BYTES, RUN_BYTES = 48 << 20, 8 << 20
#: Longer chunks and runs are not kept.
CACHE_LENGTH = 100
#: What an entry takes besides its text and ids.
_ENTRY = 180
#: Bytes, about, of the texts that are encoded at once. A run of more bytes than the second number goes through the tokenizer's own model.
BLOCK_BYTES, RUN_LENGTH = 1 << 20, 400
#: Sweeps of the least-squares fit.
SWEEPS = 60

#: Below this character, composition changes nothing and lower case does not depend on context.
_LATIN_END = "\u0250"


def _shown_bytes() -> dict[int, str]:
    """Byte-level models show printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


_SHOWN = _shown_bytes()
_encoders: dict[str, "_Texts"] = KEPT.setdefault("packing", {})


class _Kept:
    """Ids by text, of bounded weight: when the new entries are too heavy they become the old ones, and those go."""

    def __init__(self, most: int):
        self.most, self.weight = most, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, text: str) -> bytes | None:
        ids = self.new.get(text)
        if ids is None and (ids := self.old.get(text)) is not None:
            self.put(text, ids)
        return ids

    def put(self, text: str, ids: bytes) -> None:
        if len(text) > CACHE_LENGTH or text in self.new:
            return
        self.weight += _ENTRY + len(text) + len(ids)
        if self.weight > self.most:
            self.old, self.new, self.weight = self.new, {}, _ENTRY + len(text) + len(ids)
        self.new[text] = ids


class _Encoder:
    """Token ids of texts as bytes (little-endian, 32 bits), by the chunks between white space.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its chunks in turn. A chunk of
    Latin letters and ASCII signs splits into runs of letters, single digits and runs of signs; each run's ids come from the
    tokenizer's model alone, without its normalizer and splitter, which cost several times as much. An ASCII run has the ids of the
    chunk that reads like it, so both are kept together. All other chunks go through the whole tokenizer, and so do texts that may hold special tokens or control characters on which Python and the tokenizer differ.
    """

    def __init__(self, file: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.numbers = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.chunks, self.runs = _Kept(CACHE_BYTES), _Kept(RUN_BYTES)
        splitter = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]
        self.split = regex.compile(splitter["pattern"]["Regex"]).findall

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def modelled(self, run: str) -> bytes:
        mapped = run if run.isascii() and run.isprintable() else run.encode().decode("latin-1").translate(_SHOWN)
        return b"".join([self.numbers[token.id] for token in self.model.tokenize(mapped)])

    def run(self, run: str) -> bytes:
        kept = self.chunks if run.isascii() else self.runs
        ids = kept.get(run)
        if ids is None:
            ids = self.modelled(run)
            kept.put(run, ids)
        return ids

    def missing(self, chunks: set[str]) -> dict[str, bytes]:
        """The ids of chunks that are not among the new ones."""
        found, far = {}, []
        for chunk in chunks:
            ids = self.chunks.get(chunk)
            if ids is None:
                plain = chunk.isascii()
                if not plain and max(chunk) >= _LATIN_END:
                    far.append(chunk)
                    continue
                ids = self.modelled(chunk) if plain and chunk.isalpha() and chunk.islower() else b"".join(map(self.run, self.split(chunk.lower())))
                self.chunks.put(chunk, ids)
            found[chunk] = ids
        for chunk, ids in zip(far, self.whole(far) if far else (), strict=True):
            found[chunk] = ids
            self.chunks.put(chunk, ids)
        return found

    def encode(self, text: str) -> bytes:
        if "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole([text])[0]
        chunks = text.split()
        ids = list(map(self.chunks.new.get, chunks))
        if lost := {chunk for chunk, known in zip(chunks, ids, strict=True) if known is None}:
            found = self.missing(lost)
            ids = [found[chunk] if known is None else known for chunk, known in zip(chunks, ids, strict=True)]
        return b"".join(ids)


#: Kinds of characters: white space, letters, numbers, signs, and the end of a text, which is a byte that Latin texts here do not hold.
_SPACE, _LETTER, _NUMBER, _SIGN, _BREAK = range(5)
_BREAK_BYTE = b"\x1c"


def _symbol_codes() -> np.ndarray:
    """A code point for each byte within a run (0 to 255) and each byte that ends one (256 to 511).

    Those of the first kind lie below U+0040 or from U+0080 to U+013F, the others from U+0040 to U+007F or U+0140 to U+01FF, so that a run is
    told by its end; the usual ones take one byte.
    """
    codes = np.zeros(512, np.uint32)
    inner = b"abcdefghijklmnopqrstuvwxyz\xc2\xc3" + bytes(range(0xA0, 0xC0))
    final = b"abcdefghijklmnopqrstuvwxyz0123456789.,:;!?'\"()*-" + bytes(range(0xA8, 0xB8))
    for usual, short, long, base in ((inner, 0x00, 0x80, 0), (final, 0x40, 0x140, 256)):
        for k, byte in enumerate(dict.fromkeys([*usual, *range(256)])):
            codes[base + byte] = short + k if k < 64 else long + k - 64
    return codes


_CODES = _symbol_codes()
_RUN_PATTERN = r"[\x00-\x3f\x80-\u{13f}]*[\x40-\x7f\u{140}-\u{1ff}]|\u{7ff}"
_BREAK_CODE = "\u07ff"


def _coded(name: str) -> str:
    """An entry of the vocabulary in these code points."""
    whole = name.endswith("</w>") and len(name) > 4
    symbols = [_BYTES[c] for c in (name[:-4] if whole else name)]
    return "".join(chr(_CODES[s + 256 * (whole and k == len(symbols) - 1)]) for k, s in enumerate(symbols))


_BYTES = {shown: byte for byte, shown in _SHOWN.items()}


def _model(file: str) -> dict:
    with open(file, encoding="utf-8") as content:
        return json.load(content)["model"]


@lru_cache(maxsize=4)
def merges_by_rank(file: str) -> bool:
    """Whether joining neighbours by the id of what they make gives the tokenizer's ids.

    It does if symbols come before merges, merges stand in the order of their ids, and every entry of the vocabulary is what its own symbols become. For then
    the steps inside a token's bytes are those that it takes alone, whatever stands beside it, and the last of them is its one merge.
    """
    from tokenizers.models import BPE

    model = _model(file)
    vocabulary = {_coded(name): number for name, number in model["vocab"].items()}
    merges = [tuple(map(_coded, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in merges]
    symbols = [number for name, number in vocabulary.items() if len(name) == 1]
    if len(symbols) < 512 or len(symbols) + len(set(made)) != len(vocabulary) or made != sorted(made) or min(made, default=512) < max(symbols):
        return False
    alone = BPE(vocabulary, merges)
    return all(len(alone.tokenize(name)) == 1 for name in vocabulary)


class _Latin:
    """Token ids of texts of Latin letters and ASCII signs, many texts at a time.

    Runs are found for all bytes at once, as the tokenizer splits: letters, single numbers, signs, and an apostrophe with the letters of a
    contraction. The bytes of the distinct ones become code points that tell whether a byte ends its run, and a faster library joins them by the
    same vocabulary.
    """

    def __init__(self, file: str):
        import regex
        import tiktoken

        vocabulary = {_coded(name): number for name, number in _model(file)["vocab"].items()}
        self.end = max(vocabulary.values()) + 1
        ranks = {name.encode(): number for name, number in vocabulary.items()} | {_BREAK_CODE.encode(): self.end}
        self.core = tiktoken.Encoding("runs", pat_str=_RUN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.codes = _CODES.astype("<u4")
        self.codes[256 + _BREAK_BYTE[0]] = ord(_BREAK_CODE)
        letter, number = regex.compile(r"\p{L}").match, regex.compile(r"\p{N}").match
        kind = lambda c: _SPACE if c.isspace() else _LETTER if letter(c) else _NUMBER if number(c) else _SIGN
        self.kinds = np.array([kind(chr(c)) for c in range(0x800)], np.uint8)
        self.kinds[_BREAK_BYTE[0]] = _BREAK
        #: The ids that end a run.
        self.final = np.zeros(self.end + 1, bool)
        self.final[[number for name, number in vocabulary.items() if 0x40 <= ord(name[-1]) < 0x80 or ord(name[-1]) >= 0x140] + [self.end]] = True
        self.contracted = np.zeros(256, bool)
        self.contracted[list(b"stmd")] = True

    def ids(self, texts: list[bytes]) -> list[np.ndarray | None]:
        """The ids of each text with the closing token; None for texts with a very long run."""
        if not texts:
            return []
        data = np.frombuffer((_BREAK_BYTE.join(texts) + _BREAK_BYTE).decode().lower().encode(), np.uint8)
        kind = self.kinds[data]
        lead = np.flatnonzero(data >= 0xC0)
        kind[lead] = kind[lead + 1] = self.kinds[(data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63]
        begins = np.ones(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= (kind == _NUMBER) | (kind == _BREAK)
        begins &= (data & 0xC0) != 0x80
        quote = np.flatnonzero(begins & (data == ord("'")))
        one, two = data[quote + 1], data[np.minimum(quote + 2, len(data) - 1)]
        short = self.contracted[one]
        pair = (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (one == ord("l")) & (two == ord("l"))
        begins[quote[short | pair] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[pair] + 3] = True
        first = np.flatnonzero(begins)
        size = np.diff(first, append=len(data))
        long = first[(size > RUN_LENGTH) & (kind[first] != _SPACE)]
        if len(long):
            gone = set(np.searchsorted(np.flatnonzero(kind == _BREAK), long).tolist())
            others = iter(self.ids([text for k, text in enumerate(texts) if k not in gone]))
            return [None if k in gone else next(others) for k in range(len(texts))]
        used = kind != _SPACE
        data, begins, kind = data[used], begins[used], kind[used]
        first = np.flatnonzero(begins)
        bounds = np.append(first, len(data)).astype(np.int64)
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        many, flat = self.joined(runs.dictionary)
        run = runs.indices.to_numpy()
        sizes = many[run]
        found = flat[ranges((np.cumsum(many) - many)[run], sizes)]
        return np.split(found, np.cumsum(sizes)[kind[first] == _BREAK][:-1])

    def joined(self, runs: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of these runs has, and the ids of all; the end of a text has the closing token."""
        _, bounds, data = runs.buffers()
        bounds = np.frombuffer(bounds, np.int64)[runs.offset : runs.offset + len(runs) + 1]
        symbol = np.frombuffer(data, np.uint8)[: bounds[-1]].astype(np.uint16)
        symbol[bounds[1:] - 1] += 256
        flat = self.core.encode_to_numpy(self.codes[symbol[bounds[0] :]].tobytes().decode("utf-32-le")).astype("<u4")
        many = np.diff(np.flatnonzero(self.final[flat]), prepend=-1)
        flat[flat == self.end] = 0
        return many, flat


class _Texts:
    """Token ids of texts: Latin ones many at a time if ``by_rank``, the others by their chunks."""

    def __init__(self, file: str, by_rank: bool):
        self.file, self.latin, self.chunked = file, _Latin(file) if by_rank else None, None

    def one(self, text: str) -> np.ndarray:
        self.chunked = self.chunked or _Encoder(self.file)
        return np.frombuffer(self.chunked.encode(text) + bytes(4), "<u4")

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of the texts that lie at the offsets of the bytes, each with the closing token."""
        whole = data.tobytes()
        texts = [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        if self.latin is None:
            return [self.one(text.decode()) for text in texts]
        after = np.append(data[1:], 0).astype(data.dtype)
        # Characters from U+0200 on, signs that may begin a special token, and control characters that count as white space here or there.
        odd = (data > 0xC7) | (data == ord("<")) & (after == ord("|")) | (data >= 0x1C) & (data <= 0x1F)
        other = np.zeros(len(texts), bool)
        other[np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1] = True
        latin = iter(self.latin.ids([text for text, no in zip(texts, other, strict=True) if not no]))
        found = [None if no else next(latin) for no in other]
        return [self.one(text.decode()) if ids is None else ids for text, ids in zip(texts, found, strict=True)]


def _pieces(batches: Iterator[pa.RecordBatch], file: str, by_rank: bool, sequence: int, key_type: pa.DataType, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = _encoders.get(file) or _encoders.setdefault(file, _Texts(file, by_rank))
    for batch in batches:
        keys = batch.column(0)
        rows, numbers, starts, lengths, sums, ids = [], [], [], [], [], []
        for first, data, offsets in text_chunks(batch.column(1), BLOCK_BYTES):
            for row, found in enumerate(encoder.ids(data, offsets), first):
                for number, at in enumerate(range(0, len(found), sequence)):
                    part = found[at : at + sequence]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(at)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part.astype(np.int32))
            columns = [keys.take(pa.array(rows, pa.int64())).cast(key_type), pa.array(numbers, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
        names = ["key", "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def write_pieces(documents: DataFrame, path: str, file: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, keep_ids: bool = False) -> None:
    """Write the pieces of all documents to a shared path; ``file`` is the tokenizer's, ``keep_ids`` adds the ids themselves."""
    kind = dict(documents.dtypes)[key]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    rows, by_rank = documents.select(F.col(key).alias("key"), F.col(text).alias("text")), merges_by_rank(file)
    rows.mapInArrow(lean(lambda batches: _pieces(batches, file, by_rank, sequence, arrow, keep_ids), "packing"), schema).write.parquet(path)


def patterns_of(lengths: list[int], sequence: int = SEQUENCE) -> list[tuple[int, ...]]:
    """Few-document patterns of the present lengths: one, two or three pieces with as little room left as they allow."""
    there = sorted(lengths)

    def largest(room: int) -> int | None:
        at = bisect_left(there, room + 1)
        return there[at - 1] if at else None

    found = {(there[-1],)} if there else set()
    for a in there:
        if (b := largest(sequence - a)) is None:
            found.add((a,))
            continue
        found.add(tuple(sorted((a, b))))
        for share in (0.25, 0.4, 0.5, 0.6, 0.75):
            b = largest(int((sequence - a) * share))
            if b is not None and (c := largest(sequence - a - b)) is not None:
                found.add(tuple(sorted((a, b, c))))
    return sorted(found)


def fit(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 with the least squared error of sum(x * pattern) against the histogram, by cyclic coordinate descent."""
    left = dict.fromkeys(histogram, 0.0) | {k: float(v) for k, v in histogram.items()}
    counts = [Counter(pattern) for pattern in patterns]
    norms = [sum(n * n for n in count.values()) for count in counts]
    x = np.zeros(len(patterns))
    for _ in range(sweeps):
        for j, count in enumerate(counts):
            step = max(-x[j], sum(n * left[k] for k, n in count.items()) / norms[j])
            if step:
                x[j] += step
                for k, n in count.items():
                    left[k] -= n * step
    return x


def plan_packing(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence in order, repeat count); together they use each length as often as the histogram says."""
    left = {k: v for k, v in histogram.items() if v}
    plan: list[tuple[tuple[int, ...], int]] = []
    if (full := left.pop(sequence, 0)):
        plan.append(((sequence,), full))
    patterns = patterns_of(list(left), sequence)
    wanted = fit(patterns, left)
    # Full patterns first, so that rounding leaves the pieces that are easy to place.
    for j in sorted(range(len(patterns)), key=lambda j: (sum(patterns[j]) - sequence) * -1):
        if sum(patterns[j]) < sequence:
            continue
        count = Counter(patterns[j])
        times = min([int(wanted[j] + 1e-9), *(left[k] // n for k, n in count.items())])
        if times > 0:
            plan.append((patterns[j], times))
            for k, n in count.items():
                left[k] -= n * times
    return plan + _best_fit({k: v for k, v in left.items() if v}, sequence)


def _best_fit(left: dict[int, int], sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit packing, longest first, of counted lengths into counted sequences."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(pattern: tuple[int, ...], times: int, room: int) -> None:
        if room not in open_:
            insort(rooms, room)
        open_.setdefault(room, []).append((pattern, times))

    for length in sorted(left, reverse=True):
        many = left[length]
        while many:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, pattern, times = sequence, (), many
            each = min(room // length, many)
            use = min(times, many // each)
            put(pattern + (length,) * each, use, room - each * length)
            if pattern and times > use:
                put(pattern, times - use, room)
            many -= each * use
    return [entry for room in rooms for entry in open_[room]]


def pack(spark: SparkSession, path: str, sequence: int = SEQUENCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The written pieces with ``sequence_id`` and ``offset``."""
    pieces = spark.read.parquet(path)
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = plan_packing(histogram, sequence)
    slots: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            slots.setdefault(length, []).append((times, base, offset))
            offset += length
        base += times
    places = {
        length: (np.cumsum([0, *(s[0] for s in found)]), np.array([s[1] for s in found]), np.array([s[2] for s in found])) for length, found in slots.items()
    }

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            ids, offsets = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                rows = np.flatnonzero(length == one)
                edges, bases, starts = places[int(one)]
                slot = np.searchsorted(edges, rank[rows], side="right") - 1
                ids[rows], offsets[rows] = bases[slot] + rank[rows] - edges[slot], starts[slot]
            columns = [*(batch.column(n) for n in names), pa.array(ids), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    # At most ``sequence`` rows.
    buckets = spark.createDataFrame([(k, -(-v // bucket_rows)) for k, v in sorted(histogram.items())], "length long, buckets long")
    names = pieces.columns
    order = [F.xxhash64("key", "piece", "ids_crc32"), "key", "piece", "ids_crc32"]
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.col("buckets")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = dealt.withColumn("within", within).join(offsets, ["length", "bucket"]).withColumn("rank", (F.col("within") + F.col("before")).cast("long"))
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(place, schema)
