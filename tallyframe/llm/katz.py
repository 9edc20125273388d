"""A Katz backoff bigram model of a corpus and the score of each of its texts.

Tokens are the words of a text (``words.SPACED``) and one end; the first token's history is a start mark.

1. Training tokens are counted; the unigram table is written. Its most frequent words (at most ``LISTED``) go to all tasks with their exact counts. If there
   are more, each part is told the counts of its other words: words and table are dealt by ranges of hashes and meet there.
2. Every token of every text is dealt, packed, to the *part* that holds its history: a part has all bigrams of its histories, so counts and backoff
   weights are made where they are used. A history with more tokens than a quarter of a part is split over several parts by its next words; its
   count is in the list, and its weight is put together from the parts.
3. A part counts its bigrams and is written as one row with its counts of counts. Their sums over all parts give the Good-Turing discounts of bigrams
   seen up to ``TOP_R`` times, one set for the corpus.
4. A part evaluates its tokens: a seen bigram gives d * c / N(h), any other the weight of h times the unigram probability. Parts give sums per text; these
   are summed. So the number of parts changes nothing but the order of sums.

The weight of h is (1 - sum of seen probabilities) / (1 - sum of the unigram probabilities of the seen words), so each history's probabilities sum
to 1. If none of a history's seen words is discounted, N(h) + 1 stands for N(h), split or not. Unigrams: every word of the vocabulary has
c / (N + 1), listed or not, and one unseen word what is left.

Cases: NULL and empty texts have the end as their only token. Without training texts N and V are 0, nothing is known, and every token has
the unseen word's probability 1. Repeated rows count and score by themselves. A NULL doc_id is not held out. An empty table gives no rows. Words are 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.llm.words import SPACED, mix, text_chunks, words_of
from tallyframe.session import scratch_path

LISTED = 1 << 17
PART_TOKENS = 2_000_000
CHUNK = 4 << 20
#: Words outside the list that are told from one place; a part gets at most a row from each place.
SLOT_WORDS = 1 << 18
#: Files of the held parts; with more parts than these a file has several.
MOST_BUCKETS = 20_000
TOP_R = 5
#: A Good-Turing discount outside these is held at them; where counts of counts are missing there is none.
LEAST_DISCOUNT = 0.05

END, START = (mix(np.array([k], np.uint64))[0] for k in (0x454E44, 0x5354415254))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(21)
#: In place of a listed word's place.
_OTHER = LISTED + 1


def _pack(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    kind = np.dtype(kind)
    planes = np.ascontiguousarray(numbers.astype(kind)).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts are ranges of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


@dataclass
class Tokens:
    """The tokens of a chunk: word and document of each; a document's tokens end with the end."""

    word: np.ndarray
    doc: np.ndarray
    heads: np.ndarray


def _tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    words = words_of(data, offsets, SPACED)
    counts = words.counts + 1
    ends = np.cumsum(counts) - 1
    word = np.empty(int(counts.sum()), np.uint64)
    word[np.arange(len(words.hashes)) + words.owner()] = words.hashes
    word[ends] = END
    return Tokens(word, np.repeat(np.arange(len(counts)), counts), ends - counts + 1)


def _count(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        train = batch.column("train").to_numpy(zero_copy_only=False)
        for row, data, offsets in text_chunks(batch.column("text"), CHUNK):
            tokens = _tokens(data, offsets)
            word, many = np.unique(tokens.word[train[row + tokens.doc]], return_counts=True)
            edges = np.searchsorted(_part_of(word, parts), np.arange(parts + 1))
            held = [(p, a, b) for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _, _ in held], pa.int64()),
                    pa.array([_pack(np.diff(word[a:b], prepend=np.uint64(0)), "<u8") for _, a, b in held], pa.binary()),
                    pa.array([_pack(many[a:b], "<u4") for _, a, b in held], pa.binary()),
                ],
                names=["part", "words", "counts"],
            )


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["part"], []).append((row["words"], row["counts"]))
    for rows in held.values():
        words = np.concatenate([np.cumsum(_unpack(w, "<u8"), dtype=np.uint64) for w, _ in rows])
        counts = np.concatenate([_unpack(c, "<u4") for _, c in rows])
        word, place = np.unique(words, return_inverse=True)
        sums = np.bincount(place, weights=counts).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(sums)], names=["word", "n"])


@dataclass
class Unigrams:
    """Totals, and the listed words in order of their hashes with their counts; histories with more than ``split_at`` tokens are split."""

    tokens: int
    vocabulary: int
    words: np.ndarray
    counts: np.ndarray
    texts: int
    split_at: int

    @property
    def whole(self) -> bool:
        """Whether the list has all words."""
        return len(self.words) == self.vocabulary

    @property
    def rare(self) -> float:
        """The probability of one unseen word."""
        return 1 / (self.tokens + 1)

    def find(self, words: np.ndarray) -> np.ndarray:
        """Places of words in the list, -1 for others."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def probability(self, words: np.ndarray) -> np.ndarray:
        at = self.find(words)
        return np.where(at >= 0, self.counts[at] / (self.tokens + 1) if len(self.counts) else 0.0, self.rare)

    def looked_up(self, words: np.ndarray, told: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Probabilities of words, those outside the list by the counts told (words in order, counts)."""
        out = self.probability(words)
        if len(told[0]):
            at = np.minimum(np.searchsorted(told[0], words), len(told[0]) - 1)
            there = told[0][at] == words
            out[there] = told[1][at[there]] / (self.tokens + 1)
        return out

    def virtual(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes in order, place in ``histories``, count) of the shares of split histories."""
        hashes, places, counts = [], [], []
        for place, (history, count, splits) in enumerate(self.histories()):
            hashes.append(_share(np.full(splits, history, np.uint64), np.arange(splits, dtype=np.uint64)))
            places += [place] * splits
            counts += [count] * splits
        if not hashes:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = np.concatenate(hashes)
        order = np.argsort(hashes)
        return hashes[order], np.array(places)[order], np.array(counts)[order]

    def histories(self) -> list[tuple[int, int, int]]:
        """(hash, count, splits) of the split histories, the start mark among them if there are many texts."""
        large = np.flatnonzero((self.counts > self.split_at) & (self.words != END))
        out = [(int(self.words[k]), int(self.counts[k])) for k in large]
        if self.texts > self.split_at:
            out.append((int(START), self.texts))
        return [(word, count, -(-count // self.split_at)) for word, count in out]


def _share(history: np.ndarray, number: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(history + (number + np.uint64(1)) * _STEP)


def count_unigrams(rows: DataFrame, path: str, parts: int, most: int, split_at: int) -> Unigrams:
    counted = rows.select("text", "train").mapInArrow(lambda batches: _count(batches, parts), "part long, words binary, counts binary")
    counted.repartition(parts, "part").mapInArrow(_sum_counts, "word long, n long").write.parquet(f"{path}/unigrams")
    table = rows.sparkSession.read.parquet(f"{path}/unigrams")
    level = F.floor(8 * F.log2("n"))
    sizes = table.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).collect()
    tokens, vocabulary = sum(r["n"] for r in sizes), sum(r["words"] for r in sizes)
    least, room = None, most
    for r in sorted(sizes, key=lambda r: -r["level"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["least"]
    chosen = F.col("word") == int(END.astype(np.int64))
    listed = table.where(chosen if least is None else chosen | (F.col("n") >= least)).collect()  # at most ``most`` rows, and the end
    words, counts = np.array([r["word"] for r in listed], np.int64).view(np.uint64), np.array([r["n"] for r in listed], np.int64)
    order = np.argsort(words)
    texts = rows.where("train").count()
    return Unigrams(tokens, vocabulary, words[order], counts[order], texts, split_at)


def _deal(batches: Iterator[pa.RecordBatch], unigrams: Unigrams, parts: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """For each chunk a head row with what is known of its texts, and a row for each part with tokens of it."""
    context = TaskContext.get()
    chunk = (context.partitionId() if context else 0) << 32
    names = ["part", "chunk", "texts", "keys", "train", "histories", "sizes", "words", "others", "many", "docs"]
    base_of = np.log10(unigrams.counts + 1.0)
    for batch in batches:
        keys, flags = batch.column("key"), batch.column("train").to_numpy(zero_copy_only=False)
        for row, data, offsets in text_chunks(batch.column("text"), CHUNK):
            tokens = _tokens(data, offsets)
            texts = len(offsets) - 1
            train = flags[row : row + texts]
            bits = np.packbits(train).tobytes()
            vocabulary, word = np.unique(np.append(tokens.word, START), return_inverse=True)
            word, start = word[:-1], word[-1]
            history = np.append(start, word[:-1])
            history[tokens.heads] = start
            place = unigrams.find(vocabulary)
            listed = place[word] >= 0
            base = np.bincount(tokens.doc, weights=np.where(listed, base_of[place[word]] if len(base_of) else 0.0, 0.0), minlength=texts)
            known = np.bincount(tokens.doc, weights=listed, minlength=texts)
            many = np.bincount(tokens.doc, minlength=texts)
            head = [-1 - chunk, chunk, texts, keys.slice(row, texts).to_pylist(), bits, b"", many.astype("<i8").tobytes(), b"", base.astype("<f8").tobytes(), known.astype("<i8").tobytes(), b""]
            splits = np.zeros(len(vocabulary), np.int64)
            for one, _, number in unigrams.histories():
                at = np.searchsorted(vocabulary, np.uint64(one))
                if at < len(vocabulary) and vocabulary[at] == np.uint64(one):
                    splits[at] = number
            hot = np.flatnonzero(splits[history])
            shared = _share(vocabulary[history[hot]], mix(vocabulary[word[hot]]) % splits[history[hot]].astype(np.uint64))
            virtual, which = np.unique(shared, return_inverse=True)
            every = np.concatenate([vocabulary, virtual])
            rank = np.empty(len(every), np.int64)
            order = np.argsort(every, kind="stable")
            rank[order] = np.arange(len(every))
            history = rank[history]
            history[hot] = rank[len(vocabulary) + which]
            every = every[order]
            if max(len(every), texts) < 1 << 21:
                key = np.sort(history.astype(np.uint64) << (_SHIFT + _SHIFT) | word.astype(np.uint64) << _SHIFT | tokens.doc.astype(np.uint64))
                low = np.uint64((1 << 21) - 1)
                history, word, doc = ((key >> (_SHIFT + _SHIFT)).astype(np.int64), (key >> _SHIFT & low).astype(np.int64), (key & low).astype(np.int64))
            else:
                order = np.lexsort((tokens.doc, word, history))
                history, word, doc = history[order], word[order], tokens.doc[order]
            entry = np.flatnonzero(np.append(True, (history[1:] != history[:-1]) | (word[1:] != word[:-1])))
            size = np.diff(np.append(entry, len(history)))
            owner = history[entry]
            bounds = np.searchsorted(_part_of(every[owner], parts), np.arange(parts + 1))
            rows = [head]
            for part, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if a == b:
                    continue
                own, sizes = np.unique(owner[a:b], return_counts=True)
                at = place[word[entry[a:b]]]
                stop = entry[b] if b < len(entry) else len(history)
                rows.append(
                    [
                        part, chunk, texts, None, bits,
                        _pack(np.diff(every[own], prepend=np.uint64(0)), "<u8"), _pack(sizes, "<u4"),
                        _pack(np.where(at >= 0, at, _OTHER), "<u4"), _pack(vocabulary[word[entry[a:b]]][at < 0], "<u8"),
                        _pack(size[a:b], "<u4"), _pack(doc[entry[a] : stop], "<u2" if texts < 1 << 16 else "<u4"),
                    ]
                )
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(key_type), *[pa.binary()] * 7]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)
            chunk += 1


def _by_slot(words: np.ndarray, counts: np.ndarray, part: int, slots: int) -> pa.RecordBatch:
    """Words in order with their counts, a row for each slot (range of hashes) that has any."""
    edges = np.searchsorted(_part_of(words, slots), np.arange(slots + 1))
    held = [(slot, a, b) for slot, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
    columns = [
        pa.array([slot for slot, _, _ in held], pa.int64()),
        pa.array([part] * len(held), pa.int64()),
        pa.array([_pack(np.diff(words[a:b], prepend=np.uint64(0)), "<u8") for _, a, b in held], pa.binary()),
        pa.array([_pack(counts[a:b], "<u8") for _, a, b in held], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["slot", "part", "words", "counts"])


def _asked(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """The words outside the list that each part has to know: a part asks once, at most one row for each slot."""
    for batch in batches:
        for part, others in zip(batch.column("part").to_pylist(), batch.column("others").to_pylist(), strict=True):
            words = np.cumsum(_unpack(others, "<u8"), dtype=np.uint64)
            yield _by_slot(words, np.zeros(len(words), np.int64), part, slots)


def _unlisted(batches: Iterator[pa.RecordBatch], unigrams: Unigrams, slots: int) -> Iterator[pa.RecordBatch]:
    """The counted words outside the list, as part -1."""
    for batch in batches:
        words, counts = batch.column("word").to_numpy().view(np.uint64), batch.column("n").to_numpy()
        order = np.argsort(words)
        order = order[unigrams.find(words[order]) < 0]
        yield _by_slot(words[order], counts[order], -1, slots)


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part and slot the words asked for that were counted, with their counts."""
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["slot"], []).append(row)
    words_of_row = lambda row: np.cumsum(_unpack(row["words"], "<u8"), dtype=np.uint64)
    while held:
        _, rows = held.popitem()
        table = [(words_of_row(row), _unpack(row["counts"], "<u8")) for row in rows if row["part"] < 0]
        if not table:
            continue
        known, counts = (np.concatenate(x) for x in zip(*table, strict=True))
        order = np.argsort(known)
        known, counts = known[order], counts[order]
        asked: dict[int, list[np.ndarray]] = {}
        for row in rows:
            if row["part"] >= 0:
                asked.setdefault(row["part"], []).append(words_of_row(row))
        for part, words in asked.items():
            words = np.unique(np.concatenate(words))
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            there = known[at] == words
            if there.any():
                packed = _pack(np.diff(words[there], prepend=np.uint64(0)), "<u8"), _pack(counts[at[there]], "<u8")
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([packed[0]]), pa.array([packed[1]])], names=["part", "words", "counts"])


def _told(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(words in order, counts) of the rows that ``_tell`` made for a part."""
    told = [(np.cumsum(_unpack(row["words"], "<u8"), dtype=np.uint64), _unpack(row["counts"], "<u8")) for row in rows]
    if not told:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    words, counts = (np.concatenate(x) for x in zip(*told, strict=True))
    order = np.argsort(words)
    return words[order], counts[order]


def classes_of(counts: np.ndarray) -> np.ndarray:
    """How many distinct bigrams have each count from 0 to ``TOP_R`` + 1, and how many have more; these sum over parts."""
    return np.bincount(np.minimum(counts, TOP_R + 2), minlength=TOP_R + 3)


def discounts(classes: np.ndarray) -> np.ndarray:
    """Good-Turing discounts for counts 0 to ``TOP_R`` + 1 from the counts of counts of all parts; 1 where they cannot be told."""
    seen = classes.astype(float)
    out = np.ones(TOP_R + 2)
    if not seen[1 : TOP_R + 2].all():
        return out
    common = (TOP_R + 1) * seen[TOP_R + 1] / seen[1]
    for r in range(1, TOP_R + 1):
        out[r] = ((r + 1) * seen[r + 1] / (r * seen[r]) - common) / (1 - common) if common < 1 else 1.0
    return np.clip(out, LEAST_DISCOUNT, 1.0)


def _hold(batches: Iterator[pa.RecordBatch], unigrams: Unigrams, rows_type: pa.DataType, ordered: bool) -> Iterator[pa.RecordBatch]:
    """One row for each part, which no later task divides: its counts of counts, its words outside the list and its rows. Heads pass by themselves.

    With ``ordered`` the rows of a part come one after another, and only one part is held at a time.
    """
    names = ["part", "classes", "others", "rows"]

    def out(part: int, classes: np.ndarray, others: np.ndarray, rows: list[dict]) -> pa.RecordBatch:
        packed = _pack(np.diff(others, prepend=np.uint64(0)), "<u8")
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([classes.tolist()], pa.list_(pa.int64())), pa.array([packed]), pa.array([rows], rows_type)], names=names)

    def whole(part: int, rows: list[dict]) -> pa.RecordBatch:
        others = np.unique(np.concatenate([_unpack(row["others"], "<u8") for row in rows]))
        return out(part, classes_of(_bigrams(rows, unigrams).counts), others, rows)

    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            part = row["part"]
            if part < 0:
                yield out(part, np.zeros(TOP_R + 3, np.int64), np.zeros(0, np.uint64), [row])
                continue
            if ordered and held and part not in held:
                yield whole(*held.popitem())
            held.setdefault(part, []).append(row)
    while held:
        yield whole(*held.popitem())


def _evaluate(batches: Iterator[pa.RecordBatch], unigrams: Unigrams, discount: np.ndarray, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            rows = batch.column("rows")[k].as_py()
            if batch.column("part")[k].as_py() < 0:
                heads = [("head", row["chunk"], row["keys"], row["train"], row["sizes"], row["others"], row["many"], None, None) for row in rows]
                yield _sums(heads, key_type)
            else:
                yield _sums(_part(rows, _told(batch.column("told")[k].as_py() or []), unigrams, discount), key_type)


def denominator(total: np.ndarray, used: np.ndarray) -> np.ndarray:
    """N(h), or one more event for what was not seen if none of the history's bigrams is discounted."""
    return total + np.where(used > total - 1e-9, 1.0, 0.0)


def _sums(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    """Rows of kind ``head`` (keys, train, tokens, base, known), ``sum`` (docs, score, base, known), ``later`` (docs, histories, counts) or ``history`` (history, seen, covered)."""
    names = ["kind", "chunk", "keys", "one", "two", "three", "four", "seen", "covered"]
    kinds = [pa.string(), pa.int64(), pa.list_(key_type), *[pa.binary()] * 4, pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


@dataclass
class Bigrams:
    """Distinct bigrams of a part with their training counts, and where the entries of its rows lie among them."""

    history: np.ndarray
    word: np.ndarray
    counts: np.ndarray
    which: np.ndarray
    many: np.ndarray
    ends: np.ndarray
    docs: list[np.ndarray]


def _bigrams(rows: list[dict], unigrams: Unigrams) -> Bigrams:
    history, word, many, trained, docs = [], [], [], [], []
    for row in rows:
        sizes, at = _unpack(row["sizes"], "<u4"), _unpack(row["words"], "<u4").astype(np.int64)
        words = np.empty(len(at), np.uint64)
        words[at < _OTHER] = unigrams.words[at[at < _OTHER]]
        words[at == _OTHER] = _unpack(row["others"], "<u8")
        count = _unpack(row["many"], "<u4").astype(np.int64)
        doc = _unpack(row["docs"], "<u2" if row["texts"] < 1 << 16 else "<u4").astype(np.int64)
        train = np.unpackbits(np.frombuffer(row["train"], np.uint8))[: row["texts"]]
        history.append(np.repeat(np.cumsum(_unpack(row["histories"], "<u8"), dtype=np.uint64), sizes))
        word.append(words)
        many.append(count)
        trained.append(np.add.reduceat(train[doc].astype(np.int64), np.cumsum(count) - count))
        docs.append(doc)
    ends = np.cumsum([len(x) for x in word])
    history, word, trained = np.concatenate(history), np.concatenate(word), np.concatenate(trained)
    with np.errstate(over="ignore"):
        pair = mix(history * _STEP + word)
    _, first, which = np.unique(pair, return_index=True, return_inverse=True)
    counts = np.bincount(which, weights=trained).astype(np.int64)
    return Bigrams(history[first], word[first], counts, which, np.concatenate(many), ends, docs)


def _part(rows: list[dict], told: tuple[np.ndarray, np.ndarray], unigrams: Unigrams, discount: np.ndarray) -> list[tuple]:
    """The sums of one part's tokens; ``told`` has the counts of its words outside the list."""
    bigrams = _bigrams(rows, unigrams)
    counts, which, many_all, ends, docs = bigrams.counts, bigrams.which, bigrams.many, bigrams.ends, bigrams.docs
    own, owner = np.unique(bigrams.history, return_inverse=True)  # histories, and that of each bigram
    total = np.bincount(owner, weights=counts, minlength=len(own))
    hashes, places, split_counts = unigrams.virtual()
    at = np.minimum(np.searchsorted(hashes, own), max(0, len(hashes) - 1))
    split = hashes[at] == own if len(hashes) else np.zeros(len(own), bool)
    known = total.copy()
    if split.any():
        total[split] = split_counts[at[split]]
    seen = counts > 0
    backoff = unigrams.looked_up(bigrams.word, told)
    mass = np.where(seen, counts * discount[np.minimum(counts, TOP_R + 1)], 0.0)
    used, covered = np.bincount(owner, weights=mass, minlength=len(own)), np.bincount(owner, weights=np.where(seen, backoff, 0.0), minlength=len(own))
    # A split history's denominator and weight need the sums of all its parts, and are applied in the end.
    base = denominator(total, used)
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.where(total > 0, (1 - used / base) / (1 - covered), 1.0)
        ready = ~split[owner]
        value = np.where(seen, np.log10(mass) - np.where(ready, np.log10(base[owner]), 0.0), np.log10(backoff) + np.where(ready, np.log10(weight[owner]), 0.0))
    # A history that is not listed and not the start is a word whose whole count is here.
    free = (unigrams.find(own) < 0) & ~split & (own != START)
    later = split[owner]
    out = []
    begin = 0
    for row, end, doc in zip(rows, ends, docs, strict=True):
        bigram = np.repeat(which[begin:end], many_all[begin:end])
        begin = end
        present, local = np.unique(doc, return_inverse=True)
        histories = owner[bigram]
        score = np.bincount(local, weights=value[bigram])
        words_base = np.bincount(local, weights=np.where(free[histories], np.log10(known[histories] + 1), 0.0))
        words_known = np.bincount(local, weights=free[histories] & (known[histories] > 0))
        out.append(("sum", row["chunk"], None, _pack(present, "<u4"), _pack(score, "<f8"), _pack(words_base, "<f8"), _pack(words_known, "<u4"), None, None))
        wait = np.flatnonzero(later[bigram])
        if len(wait):
            cells, times = np.unique(doc[wait] << 32 | 2 * places[at[histories[wait]]] | seen[bigram[wait]], return_counts=True)
            out.append(("later", row["chunk"], None, _pack(cells >> 32, "<u4"), _pack(cells & 0xFFFFFFFF, "<u4"), _pack(times, "<u4"), None, None, None))
    for k in np.flatnonzero(split):
        out.append(("history", int(places[at[k]]), None, None, None, None, None, float(used[k]), float(covered[k])))
    return out


def _finish(batches: Iterator[pa.RecordBatch], weights: np.ndarray, unigrams: Unigrams, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    heads: dict[int, dict] = {}
    sums: dict[int, list[np.ndarray]] = {}

    def grown(chunk: int, size: int) -> list[np.ndarray]:
        have = sums.setdefault(chunk, [np.zeros(0), np.zeros(0), np.zeros(0)])
        if len(have[0]) < size:
            have[:] = [np.append(x, np.zeros(size - len(x))) for x in have]
        return have

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == "head":
                heads[row["chunk"]] = row
                continue
            docs = _unpack(row["one"], "<u4").astype(np.int64)
            score, base, known = grown(row["chunk"], int(docs.max()) + 1)
            if row["kind"] == "sum":
                score[docs] += _unpack(row["two"], "<f8")
                base[docs] += _unpack(row["three"], "<f8")
                known[docs] += _unpack(row["four"], "<u4")
            else:
                np.add.at(score, docs, np.log10(weights[_unpack(row["two"], "<u4")]) * _unpack(row["three"], "<u4"))
    for chunk, head in heads.items():
        texts = len(head["keys"])
        score, base, known = grown(chunk, texts)
        tokens = np.frombuffer(head["two"], "<i8")
        base = base + np.frombuffer(head["three"], "<f8") - tokens * np.log10(unigrams.tokens + unigrams.vocabulary + 1)
        known = known.astype(np.int64) + np.frombuffer(head["four"], "<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(head["keys"], key_type), *map(pa.array, (tokens, known, base, score))], names=["key", "n_tokens", "n_known", "base_score", "score"]
        )


def score(documents: DataFrame, train: Column, key: str = "doc_id", text: str = "text", parts: int | None = None, part_tokens: int = PART_TOKENS, shortcut: int = LISTED) -> tuple[DataFrame, Unigrams]:
    """(key, n_tokens, n_known, base_score, score) of every text, and the unigram totals; ``train`` tells the texts to learn from.

    ``parts`` is the number of n-gram partitions, by default one for ``PART_TOKENS`` tokens. Every word of the vocabulary has its own unigram probability;
    those of the ``shortcut`` most frequent words are in all tasks, the others are dealt to the parts that need them.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "katz")
    kind = dict(documents.dtypes)[key]
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    if parts is None:  # a token takes about three characters
        parts = max(1, -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // (3 * part_tokens)))
    unigrams = count_unigrams(rows, path, parts, min(shortcut, LISTED), max(1, part_tokens // 4))
    schema = f"part long, chunk long, texts long, keys array<{kind}>, train binary, histories binary, sizes binary, words binary, others binary, many binary, docs binary"
    dealt = rows.mapInArrow(lambda batches: _deal(batches, unigrams, parts, key_type), schema)
    buckets = min(parts, MOST_BUCKETS)
    together, ordered = dealt.repartition(buckets, "part"), parts > buckets
    if ordered:
        together = together.sortWithinPartitions("part")
    row = F.struct(*dealt.columns).alias("row")
    row_type = dealt.select(row).dtypes[0][1]
    held_type = to_arrow_type(dealt.select(F.array(row)).schema[0].dataType)
    # Written once, in buckets of parts, so that what a part is told comes to it and its rows are not shuffled again.
    table = f"held_{uuid.uuid4().hex}"
    held = together.mapInArrow(lambda batches: _hold(batches, unigrams, held_type, ordered), f"part long, classes array<long>, others binary, rows array<{row_type}>")
    held.write.bucketBy(buckets, "part").option("compression", "none").option("path", f"{path}/held").saveAsTable(table)
    try:
        held = spark.table(table)
        summed = held.agg(*(F.sum(F.col("classes")[k]) for k in range(TOP_R + 3))).first()
        discount = discounts(np.array([n or 0 for n in summed]))
        told = spark.createDataFrame([], "part long, told array<struct<words: binary, counts: binary>>")
        if not unigrams.whole:
            slots = max(1, -(-(unigrams.vocabulary - len(unigrams.words)) // SLOT_WORDS))
            packed = "slot long, part long, words binary, counts binary"
            asked = held.where("part >= 0").select("part", "others").mapInArrow(lambda batches: _asked(batches, slots), packed)
            counted = spark.read.parquet(f"{path}/unigrams").mapInArrow(lambda batches: _unlisted(batches, unigrams, slots), packed)
            answers = asked.union(counted).repartition(slots, "slot").mapInArrow(_tell, "part long, words binary, counts binary")
            told = answers.groupBy("part").agg(F.collect_list(F.struct("words", "counts")).alias("told"))
        schema = f"kind string, chunk long, keys array<{kind}>, one binary, two binary, three binary, four binary, seen double, covered double"
        evaluated = held.select("part", "rows").join(told.hint("shuffle_hash"), "part", "left")
        evaluated.select("part", "rows", "told").mapInArrow(lambda batches: _evaluate(batches, unigrams, discount, key_type), schema).write.parquet(f"{path}/sums")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    sums = spark.read.parquet(f"{path}/sums")
    # Of each split history the weight of its unseen bigrams and the factor of its seen ones.
    split = unigrams.histories()
    weights = np.ones(2 * len(split))
    for place, used, covered in sums.where("kind = 'history'").groupBy("chunk").agg(F.sum("seen"), F.sum("covered")).collect():
        base = float(denominator(np.float64(split[place][1]), np.float64(used)))
        weights[2 * place : 2 * place + 2] = (1 - used / base) / (1 - covered), 1 / base
    schema = f"key {kind}, n_tokens long, n_known long, base_score double, score double"
    return sums.where("kind <> 'history'").repartition("chunk").mapInArrow(lambda batches: _finish(batches, weights, unigrams, key_type), schema), unigrams
