"""Near copies by SimHash: fingerprints that differ in at most ``ERRORS`` bits are linked, by a self-join of their binary trie.

1. One pass writes each text's fingerprint: bit by bit the majority over the XXH64 of its runs of ``SIZE`` words (``words.SPACED``, A-Z as a-z), repeats included.
2. Two fingerprints within ``ERRORS`` bits agree in one of ``ERRORS + 1`` blocks of their bits. For each block a trie has it on top: above its lower end
   no differing bit is allowed, so the pairs of nodes there are the nodes themselves, and the distinct fingerprints are dealt by that block.
3. A task walks its tries from there on: pairs of nodes go down together, bit by bit, the differing bits add up, and a pair goes when they pass the budget.
   Pairs are taken in blocks, depth first, and a pair of nodes that are already connected as a whole goes too; so a dense group costs no list of all its pairs.
   Each task gives a forest of its links, at most one for each fingerprint it holds.
4. Nodes with more than ``GROUP_ROWS`` fingerprints go down ``STEP`` bits by a join of their own: each fingerprint is dealt to the pairs of children that its bits
   and the budget left allow. This repeats until all are small; distinct fingerprints part at the last bit at the latest.
5. Components of the forests by alternating stars, on distinct fingerprints; documents get theirs by a join on the fingerprint.

Cases: NULL and empty texts, and those without words, have fingerprint zero, linked like any other. Fewer words than ``SIZE``: the whole sequence is the only run.
Repeated rows share fingerprint and component; a NULL key is never the smallest, a component of NULL keys alone has none. An empty table gives no rows. Only
the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.llm.components import connected
from tallyframe.llm.words import SPACED, ranges, text_chunks, words_of
from tallyframe.session import scratch_path

SIZE = 3
ERRORS = 2
SEED = 42
BITS = 64
CHUNK = 1 << 20
#: Fingerprints of a node that one task takes in; bits that larger ones go down at once.
GROUP_ROWS = 20_000
STEP = 8
#: Fingerprints whose tries are walked at once, and pairs of nodes in one step of the walk; nodes of so many pairs of fingerprints are compared directly.
WALK_ROWS = 50_000
WALK_PAIRS = 200_000
DIRECT = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANES = np.uint64(0x0101010101010101)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, size: int = SIZE, seed: int = SEED) -> np.ndarray:
    """The fingerprints of a chunk of texts."""
    words = words_of(data, offsets, SPACED)
    length = words.end - words.start
    begin = np.cumsum(length + 1) - length - 1
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[ranges(begin, length)] = _LOWER[data[SPACED[data]]]
    counts = words.counts
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = ranges(words.first[:-1], runs)
    last = first + np.repeat(np.minimum(counts, size), runs) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begin[first].tolist(), (begin + length)[last].tolist(), strict=True) if len(first) else ()
    hashes = np.fromiter((digest(text[a:b], seed) for a, b in spans), np.uint64, len(first))
    return _majority(hashes, runs)


def _majority(hashes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """For each text the bits that over half of its hashes have."""
    out = np.zeros(len(runs), np.uint64)
    full = np.flatnonzero(runs)
    if not len(full):
        return out
    # Eight counters a number, one a byte; a byte counts 255 hashes, so texts are counted in pieces.
    pieces = -(-runs[full] // 255)
    number = ranges(np.zeros(len(full), np.int64), pieces)
    first = np.cumsum(runs[full]) - runs[full]
    starts = np.repeat(first, pieces) + 255 * number
    heads = np.cumsum(pieces) - pieces
    for bit in range(8):
        lanes = np.add.reduceat(hashes >> np.uint64(bit) & _LANES, starts)
        ones = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), heads)
        for byte in range(8):
            out[full] |= (2 * ones[:, byte] > runs[full]).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], size: int, seed: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column(1), CHUNK):
            found = fingerprints_of(data, offsets, size, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(found)).cast(key_type), pa.array(found.view(np.int64))], names=["key", "node"])


class _Sets:
    """Connected sets of numbers 0 to n - 1, merged many at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.forest: list[tuple[int, int]] = []
        self._spread()

    def _spread(self) -> None:
        self.changes = np.append(0, np.cumsum(self.root[1:] != self.root[:-1])) if len(self.root) else self.root

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.root[a] != self.root[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return
        ends = np.stack([np.minimum(self.root[a], self.root[b]), np.maximum(self.root[a], self.root[b])])
        _, first = np.unique(ends[0] * len(self.root) + ends[1], return_index=True)
        above: dict[int, int] = {}

        def top(x: int) -> int:
            path = []
            while x in above:
                path.append(x)
                x = above[x]
            for y in path:
                above[y] = x
            return x

        for k in first.tolist():
            x, y = top(int(ends[0, k])), top(int(ends[1, k]))
            if x != y:
                above[max(x, y)] = min(x, y)
                self.forest.append((int(a[k]), int(b[k])))
        moved = np.arange(len(self.root))
        for x in above:
            moved[x] = top(x)
        self.root = moved[self.root]
        self._spread()

    def one(self, low1: np.ndarray, high1: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
        """Which pairs of ranges lie in one set altogether."""
        even = (self.changes[high1 - 1] == self.changes[low1]) & (self.changes[high2 - 1] == self.changes[low2])
        return even & (self.root[low1] == self.root[low2])


def walk(keys: np.ndarray, pairs: np.ndarray, depth: int, errors: int = ERRORS) -> np.ndarray:
    """A forest of the links below some pairs of trie nodes, as (place, place) in ``keys``.

    ``keys`` are unsigned numbers; a node is a range of neighbours that are sorted and agree in the first ``depth`` bits. ``pairs`` has rows
    (low, high, low, high, differing bits); a node paired with itself has its range twice.
    """
    sets = _Sets(len(keys))
    ones = [np.append(0, np.cumsum((keys >> np.uint64(BITS - 1 - bit)) & np.uint64(1), dtype=np.int64)) for bit in range(depth, BITS)]
    stack = [(depth, pairs)]
    while stack:
        level, block = stack.pop()
        if len(block) > WALK_PAIRS:
            stack.append((level, block[WALK_PAIRS:]))
            block = block[:WALK_PAIRS]
        block = block[~sets.one(*block.T[:4])]
        size1, size2 = block[:, 1] - block[:, 0], block[:, 3] - block[:, 2]
        direct = (size1 * size2 <= DIRECT) | (level == BITS)
        if direct.any():
            low1, low2, n1, n2 = block[direct, 0], block[direct, 2], size1[direct], size2[direct]
            which = np.repeat(np.arange(len(n1)), n1 * n2)
            place = ranges(np.zeros(len(n1), np.int64), n1 * n2)
            a, b = low1[which] + place // n2[which], low2[which] + place % n2[which]
            near = (a != b) & (np.bitwise_count(keys[a] ^ keys[b]) <= errors)
            sets.merge(a[near], b[near])
        block = block[~direct]
        if not len(block):
            continue
        count = ones[level - depth]
        low1, high1, low2, high2, differ = block.T
        mid1, mid2 = high1 - (count[high1] - count[low1]), high2 - (count[high2] - count[low2])
        same = low1 == low2
        less = differ < errors
        children = [
            np.stack([low1, mid1, low2, mid2, differ], 1),
            np.stack([mid1, high1, mid2, high2, differ], 1),
            np.stack([low1, mid1, mid2, high2, differ + 1], 1)[less],
            np.stack([mid1, high1, low2, mid2, differ + 1], 1)[less & ~same],
        ]
        below = np.concatenate(children)
        below = below[(below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3])]
        if len(below):
            stack.append((level + 1, below))
    return np.array(sets.forest, np.int64).reshape(-1, 2)


def _turned_back(keys: np.ndarray, turn: np.ndarray) -> np.ndarray:
    turn = turn.astype(np.uint64)
    return keys >> turn | keys << (np.uint64(BITS) - turn & np.uint64(BITS - 1))


def _links(batches: Iterator[pa.RecordBatch], depth: int, errors: int) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows (turn, depth, a, b, key); rows that agree in all but the key are the fingerprints of one pair of nodes."""
    held: list[np.ndarray] = []

    def found(rows: np.ndarray) -> pa.RecordBatch:
        turn, _, a, b, _ = rows.T
        keys = np.ascontiguousarray(rows[:, 4]).view(np.uint64)
        new = np.append(True, (rows[1:, :4] != rows[:-1, :4]).any(1))
        low = np.flatnonzero(new)
        high = np.append(low[1:], len(rows))
        same = a[low] == b[low]
        differ = np.bitwise_count((a[low] ^ b[low]).view(np.uint64)).astype(np.int64)
        # The nodes of a pair lie one after the other: a's prefix is the smaller one.
        prefix = (keys >> np.uint64(BITS - depth)).astype(np.int64)
        other = np.append(0, np.cumsum(prefix == a[np.repeat(low, high - low)]))
        mid = low + other[high] - other[low]
        pairs = np.stack([low, np.where(same, high, mid), np.where(same, low, mid), high, differ], 1)
        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3]) & ((pairs[:, 1] - pairs[:, 0] > 1) | ~same)]
        links = walk(keys, pairs, depth, errors)
        ends = [_turned_back(keys[links[:, k]], turn[links[:, k]]).view(np.int64) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*map(pa.array, ends)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.stack([batch.column(k).to_numpy() for k in range(5)], 1))
        if sum(map(len, held)) >= WALK_ROWS:
            rows = np.concatenate(held)
            # Whole pairs of nodes only; the last one may go on in the next batch.
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            if len(cut):
                yield found(rows[: cut[-1]])
                held = [rows[cut[-1] :]]
            else:
                held = [rows]
    if held:
        yield found(np.concatenate(held))


def _masks(errors: int, bits: int) -> list[int]:
    return [x for x in range(1 << bits) if x.bit_count() <= errors]


def _turned(key: Column, turn: int) -> Column:
    return F.shiftleft(key, turn).bitwiseOR(F.shiftrightunsigned(key, BITS - turn)) if turn else key


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, BITS - depth) if depth < BITS else key


def link(nodes: DataFrame, path: str, errors: int = ERRORS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links of distinct 64-bit numbers (column ``node``) that connect all that differ in ``errors`` bits or fewer; written below ``path``."""
    spark = nodes.sparkSession
    edges = [BITS * k // (errors + 1) for k in range(errors + 2)]
    depth = min(high - low for low, high in zip(edges, edges[1:], strict=False))
    turned = F.array(*(F.struct(F.lit(turn).cast("long").alias("turn"), _turned(F.col("node"), turn).alias("key")) for turn in edges[:-1]))
    rows = nodes.select(F.explode(turned).alias("t")).select("t.turn", F.lit(depth).cast("long").alias("depth"), _prefix(F.col("t.key"), depth).alias("a"), "t.key")
    rows = rows.select("turn", "depth", "a", F.col("a").alias("b"), "key")
    pair = ["turn", "depth", "a", "b"]
    out = None
    for step in range(BITS):
        rows.write.parquet(f"{path}/rows-{step}")
        rows = spark.read.parquet(f"{path}/rows-{step}")
        sizes = rows.groupBy(*pair).agg(F.count("*").alias("n"), F.count(F.when(_prefix(F.col("key"), depth) == F.col("a"), 1)).alias("n_a"))
        met = F.when(F.col("a") == F.col("b"), F.col("n") > 1).otherwise((F.col("n_a") > 0) & (F.col("n_a") < F.col("n")))
        sizes.where(F.col("n") > group_rows).select(*pair, met.alias("met")).write.parquet(f"{path}/large-{step}")
        large = spark.read.parquet(f"{path}/large-{step}")
        last = depth == BITS or large.isEmpty()
        # Large nodes without a partner go, too.
        small = rows if last else rows.join(large, pair, "left_anti")
        dealt = small.repartition(*pair).sortWithinPartitions(*pair, _prefix(F.col("key"), BITS // 2), "key")
        found = dealt.mapInArrow(lambda batches, depth=depth: _links(batches, depth, errors), "a long, b long")
        found.write.parquet(f"{path}/links-{step}")
        links = spark.read.parquet(f"{path}/links-{step}")
        out = links if out is None else out.union(links)
        if last:
            return out
        rows, depth = _descend(rows.join(large.where("met"), pair, "left_semi"), depth, errors), min(BITS, depth + STEP)
    return out


def _descend(rows: DataFrame, depth: int, errors: int) -> DataFrame:
    """The rows of pairs of nodes dealt to the pairs of their children, ``STEP`` bits deeper, that the differing bits allow."""
    deeper = min(BITS, depth + STEP)
    bits = deeper - depth
    own = _prefix(F.col("key"), depth)
    of_a = own == F.col("a")
    other = F.when(of_a, F.col("b")).otherwise(F.col("a"))
    left = F.lit(errors) - F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    masks = F.lit(None)
    for budget in range(errors + 1):
        masks = F.when(left == budget, F.array(*(F.lit(m).cast("long") for m in _masks(budget, bits)))).otherwise(masks)
    dealt = rows.select("turn", "key", other.alias("other"), F.explode(masks).alias("mask"))
    mine = _prefix(F.col("key"), deeper)
    theirs = F.shiftleft(F.col("other"), bits).bitwiseOR(mine.bitwiseAND((1 << bits) - 1).bitwiseXOR(F.col("mask")))
    return dealt.select("turn", F.lit(deeper).cast("long").alias("depth"), F.least(mine, theirs).alias("a"), F.greatest(mine, theirs).alias("b"), "key")


def components(documents: DataFrame, size: int = SIZE, errors: int = ERRORS, key: str = "doc_id", text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(key, fingerprint, component_id) of every text; ``component_id`` is the smallest key of its component."""
    spark = documents.sparkSession
    path = scratch_path(spark, "simhash")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    arrow = to_arrow_type(kind)
    rows.mapInArrow(lambda batches: _fingerprint(batches, size, SEED, arrow), f"key {kind.simpleString()}, node long").write.parquet(f"{path}/members")
    members = spark.read.parquet(f"{path}/members")
    members.groupBy("node").agg(F.min("key").alias("least")).write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")
    roots = connected(link(nodes.select("node"), path, errors, group_rows).distinct(), f"{path}/roots")
    linked = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked.join(least, "root").select("node", "component_id").write.parquet(f"{path}/named")
    # One row a fingerprint against the rows of documents, both as written: a fingerprint that very many documents have is split by adaptive execution.
    named = members.join(spark.read.parquet(f"{path}/named"), "node")
    return named.select("key", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
