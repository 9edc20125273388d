"""Jaccard self-join on word n-grams by vertical partitioning of the global n-gram order.

A document's set holds its distinct runs of ``size`` words; documents of one set share a *node* (128 bits of
set signature, of which 64 name it). N-grams are ordered by how full their bucket of a fixed table of corpus
counts is, then by hash, so common ones come last. The order is cut into ``FRAGMENTS`` fragments of equal mass.

1. One pass counts the buckets and gives each document its set size and node.
2. Two sets that link share ``k`` n-grams among their first ``n - ceil(t n) + k`` (``k`` is ``SHARED``, or the overlap that a link needs if that is
   less). Those prefixes are dealt by n-gram, packed, one entry for an n-gram and chunk of documents; only n-grams of several nodes are written
   (*shared postings*). Asking for several keeps sets apart that meet in one n-gram by chance, of which a larger corpus has ever more.
3. Candidates come in rounds, from n-grams whose nodes are still in several components. A round of stars tries each node with one
   node of about its size among those that share two n-grams with it, later ones with a few others, in another order each turn. Stars go on while a turn
   finds at least ``WORTH`` times the links of the first. The last round goes across components, the only pairs that can still matter: the members of a component are cut
   into blocks (small components with a very frequent n-gram share some), and each node meets the blocks of larger ones with which it shares ``k`` n-grams whose places in both orders leave room for a link.
4. The sets of candidates are written once, cut into the fragments. Overlaps are counted for each fragment apart and summed per pair; a node's overlaps with a
   block are one row for each fragment, and of the links to a component's members in a block the strongest is kept. Links give components.

So a group of near copies costs about as many candidates a turn as it has members, not their pairs, and no link between
components is lost. Fragments of a star with a hot centre, or of a block that very many nodes meet, are dealt to as many groups as these need.

Cases: texts that are NULL or without words have an empty set and are a component of their own. With fewer words than ``size``
the whole sequence is the only n-gram. Repeated rows share a component; a NULL doc_id is never the smallest. An empty table gives no rows.
N-grams are 56-bit hashes: two different ones of a pair of documents count as one with a chance of about 2**-56 each.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyframe.llm.components import connected
from tallyframe.llm.words import SPACED, mix, ranges, run_hashes, text_chunks, words_of
from tallyframe.llm.workers import lean
from tallyframe.session import scratch_path, written

FRAGMENTS = 4
#: Buckets of the count table: a fixed size, whatever the corpus. It only steers the work.
BUCKETS = 1 << 20
#: Bits of the filter for nodes whose sets are wanted: for each of them, and at most. What it lets through is joined with the nodes.
NODE_BITS, FILTER_BITS = 16, 1 << 25
#: Partitions that its words come to the driver in, one after another.
WORD_PARTS = 8
#: A turn of stars with a smaller share of the first one's links is the last; partners of a node in a turn after the first; members of a block.
WORTH = 0.25
TRIES = 8
#: N-grams that the prefixes of linked sets must share.
SHARED = 4
BLOCK = 256
#: Small components that have an n-gram of more nodes than this share blocks.
HOT = 64
#: Prefix n-grams in a partition, and partners of a centre in a group.
PART_NGRAMS = 1_000_000
GROUP_ROWS = 500

_ID = np.uint64(8)
_SLICE = 4096
_ZSTD = pa.Codec("zstd")


class Sets:
    """The sets of one chunk of documents, each in the global order if ``level`` is given."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int, level: np.ndarray | None = None):
        words = words_of(data, offsets, SPACED)
        counts = words.counts
        many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
        self.first = np.append(0, np.cumsum(many))
        hashes = np.zeros(int(self.first[-1]), np.uint64)
        if len(words.hashes):
            runs = run_hashes(words.hashes, size)
            long = np.flatnonzero(counts >= size)
            places = np.repeat(words.first[long] - self.first[long], many[long]) + ranges(self.first[long], many[long])
            hashes[ranges(self.first[long], many[long])] = runs[places]
            for d in np.flatnonzero((counts > 0) & (counts < size)):
                hashes[self.first[d]] = run_hashes(words.hashes[words.first[d] : words.first[d + 1]], int(counts[d]))[0]
        self.keys = hashes >> _ID
        if level is not None:
            self.keys |= level[bucket_of(self.keys)].astype(np.uint64) << np.uint64(56)

    def __len__(self) -> int:
        return len(self.first) - 1

    def set_of(self, d: int) -> np.ndarray:
        keys = np.sort(self.keys[self.first[d] : self.first[d + 1]])
        return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) > 1 else keys


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(20)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def node_of(keys: np.ndarray) -> tuple[int, int]:
    """The signature of a set as two signed numbers; the order of its members and their levels do not matter."""
    ids = keys & np.uint64((1 << 56) - 1)
    with np.errstate(over="ignore"):
        one, two = mix(ids).sum(dtype=np.uint64), mix(ids ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        one = mix(np.array([one + np.uint64(len(ids))], np.uint64))[0]
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _survey(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows for the documents (set size and node), and at the end of the task its bucket counts in slices."""
    counts = np.zeros(BUCKETS, np.int64)
    names = ["doc_id", "n", "node", "check", "slice", "counts"]
    key_type = None
    for batch in batches:
        key_type = batch.column(0).type
        for row, data, offsets in text_chunks(batch.column(1)):
            sets = Sets(data, offsets, size)
            counts += np.bincount(bucket_of(sets.keys), minlength=BUCKETS)
            found = [sets.set_of(d) for d in range(len(sets))]
            nodes = [node_of(keys) if len(keys) else (None, None) for keys in found]
            many = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(row, many),
                    pa.array([len(keys) for keys in found], pa.int64()),
                    pa.array([n[0] for n in nodes], pa.int64()),
                    pa.array([n[1] for n in nodes], pa.int64()),
                    pa.nulls(many, pa.int32()),
                    pa.nulls(many, pa.binary()),
                ],
                names=names,
            )
    if key_type is not None:
        slices = [k for k in range(BUCKETS // _SLICE) if counts[k * _SLICE : (k + 1) * _SLICE].any()]
        many = len(slices)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(many, key_type), *(pa.nulls(many, pa.int64()) for _ in range(3)), pa.array(slices, pa.int32()), pa.array([_ZSTD.compress(counts[k * _SLICE : (k + 1) * _SLICE].astype("<i4").tobytes(), asbytes=True) for k in slices], pa.binary())],
            names=names,
        )


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums.setdefault(k, np.zeros(_SLICE, np.int64))
            sums[k] += np.frombuffer(_ZSTD.decompress(counts, 4 * _SLICE, asbytes=True), "<i4")
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of 8 steps a doubling."""
    return np.minimum(255, np.round(8 * np.log2(1 + counts))).astype(np.uint8)


def pivots_of(counts: np.ndarray, level: np.ndarray, fragments: int) -> np.ndarray:
    """Keys that cut the global order into fragments of equal mass: hashes are even within a level."""
    mass = np.cumsum(np.bincount(level, weights=counts, minlength=256))
    cuts = []
    for k in range(1, fragments):
        want = mass[-1] * k / fragments
        at = int(np.searchsorted(mass, want))
        below = mass[at - 1] if at else 0
        share = (want - below) / max(1, mass[at] - below)
        cuts.append((at << 56) + int(share * ((1 << 56) - 1)))
    return np.array(cuts, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """Of the first so many n-grams linked sets share ``SHARED``, or all that the link needs if those are fewer."""
    needed = -(-percent * n // 100)
    return n - needed + min(SHARED, needed)


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, percent: int, level: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Prefix n-grams packed by part; ``sure`` rows hold n-grams that several nodes of the chunk share."""
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column(0)):
            sets = Sets(data, offsets, size, level)
            nodes: dict[int, int] = {}
            tokens, owner, sizes, places = [], [], [], []
            for d in range(len(sets)):
                keys = sets.set_of(d)
                if not len(keys) or (node := node_of(keys)[0]) in nodes:
                    continue
                nodes[node] = len(sizes)
                sizes.append(len(keys))
                tokens.append(keys[: prefix_length(len(keys), percent)])
                owner.append(np.full(len(tokens[-1]), len(sizes) - 1, np.int64))
                places.append(np.arange(len(tokens[-1]), dtype=np.int32))
            if not sizes:
                continue
            token, owner, place = np.concatenate(tokens), np.concatenate(owner), np.concatenate(places)
            ids, sizes = np.array(list(nodes), np.int64), np.array(sizes, np.int64)
            order = np.argsort(token, kind="stable")
            token, owner, place = token[order], owner[order], place[order]
            head = np.append(True, token[1:] != token[:-1])
            last = np.append(head[1:], True)
            more = ~(head & last)  # shared within the chunk
            part = (mix(token) % np.uint64(parts)).astype(np.int64)
            rows = []
            extra = np.flatnonzero(~head)
            if len(extra):
                rows.append((int(ids[0] % parts), True, token[extra], ids[owner[extra]], sizes[owner[extra]], place[extra].view(np.uint8)))
            one = np.flatnonzero(head)
            one = one[np.argsort(part[one], kind="stable")]
            edges = np.flatnonzero(np.append(True, part[one][1:] != part[one][:-1]))
            for a, b in zip(edges, np.append(edges[1:], len(one)), strict=True):
                which = one[a:b]
                present, local = np.unique(owner[which], return_inverse=True)
                rows.append((int(part[which[0]]), False, token[which], ids[present], sizes[present], np.concatenate([place[which].view(np.uint8), local.astype("<i4").view(np.uint8), more[which].view(np.uint8)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (2, 3, 4, 5))],
                names=["part", "sure", "tokens", "nodes", "sizes", "local"],
            )


def early_enough(n: np.ndarray, place: np.ndarray, least: np.ndarray, most: np.ndarray, percent: int) -> np.ndarray:
    """Whether the nodes of an n-gram, with set sizes from ``least`` to ``most``, leave each of its postings room for a link; as ``Join.early``."""
    small = np.maximum(least, np.ceil(n * percent / 100 - 1e-9))
    common = np.ceil(percent * (n + small) / (100.0 + percent) - 1e-9)
    return (small <= np.floor(n * 100 / percent + 1e-9)) & (most >= np.ceil(n * percent / 100 - 1e-9)) & (place <= n - common + (SHARED - 1))


def _shared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(n-gram, node, set size, place in the set's order) of the n-grams that more than one node has in its prefix.

    Postings that stand too late for a link with any other set of the n-gram stay out, where all its postings are in this part.
    """

    def out(token: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), *map(pa.array, columns)], names=["token", "node", "n", "place"])

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for row in batch.to_pylist():
            token, node, size = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["sizes"], np.int64)
            local = np.frombuffer(row["local"], np.uint8)
            place = local[: 4 * len(token)].view("<i4")
            if row["sure"]:
                yield out(token, node, size, place)
                continue
            which, more = local[4 * len(token) : 8 * len(token)].view("<i4"), local[8 * len(token) :].astype(bool)
            held.append((token, node[which], size[which], place, more))
    if held:
        token, node, size, place, more = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(token, kind="stable")
        token, node, size, place, more = token[order], node[order], size[order], place[order], more[order]
        new = np.append(True, token[1:] != token[:-1])
        run = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        # Entries of one node from several chunks (exact copies) do not make an n-gram shared.
        far = np.logical_or.reduceat(more, heads)  # others of its postings are ``sure`` rows elsewhere
        differs = np.maximum.reduceat(node, heads) != np.minimum.reduceat(node, heads)
        fits = early_enough(size, place, np.minimum.reduceat(size, heads)[run], np.maximum.reduceat(size, heads)[run], percent)
        low = np.minimum.reduceat(np.where(fits, node, np.iinfo(np.int64).max), heads)
        high = np.maximum.reduceat(np.where(fits, node, np.iinfo(np.int64).min), heads)
        keep = far[run] | fits & (differs & (low < high))[run]
        yield out(token[keep], node[keep], size[keep], place[keep])


def _segments(batches: Iterator[pa.RecordBatch], size: int, level: np.ndarray, pivots: np.ndarray, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sets of the wanted nodes (and of a few others: the filter is not exact) cut into fragments."""
    for batch in batches:
        for _, data, offsets in text_chunks(batch.column(0)):
            sets = Sets(data, offsets, size, level)
            seen: set[int] = set()
            nodes, fragments, parts = [], [], []
            for d in range(len(sets)):
                keys = sets.set_of(d)
                if not len(keys):
                    continue
                node = node_of(keys)[0]
                bit = node & (8 * len(wanted) - 1)
                if node in seen or not wanted[bit >> 3] >> (bit & 7) & 1:
                    continue
                seen.add(node)
                for k, part in enumerate(np.split(keys, np.searchsorted(keys, pivots))):
                    if len(part):
                        nodes.append(node)
                        fragments.append(k)
                        parts.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(fragments, pa.int32()), pa.array(parts, pa.binary())], names=["node", "fragment", "keys"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial overlaps of centres with their partners, from sorted rows: before its partners stands a centre's own set in a fragment, if it has one."""
    place, own = None, None
    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in ("a", "salt", "fragment")), strict=True)
        nodes, keys = batch.column("b").to_pylist(), batch.column("keys")
        found = []
        for k, at in enumerate(rows):
            if at != place:
                place, own = at, None
            fragment = np.frombuffer(keys[k].as_buffer(), np.uint64)
            if nodes[k] == at[0]:
                own = fragment
            elif own is not None:
                near = np.minimum(np.searchsorted(own, fragment), len(own) - 1)
                found.append((at[0], nodes[k], int((own[near] == fragment).sum())))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["a", "b", "overlap"])


def _block_overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial overlaps of nodes with all members of a block, a row each, from sorted rows in which a block's members (with a seat) stand before the nodes it meets."""
    columns = ["several", "id", "block", "salt", "fragment"]
    place, members, block = None, [], None
    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in columns), strict=True)
        nodes, seats, keys = batch.column("node").to_pylist(), batch.column("seat").to_pylist(), batch.column("keys")
        found = []
        for k, at in enumerate(rows):
            if at != place:
                place, members, block = at, [], None
            fragment = np.frombuffer(keys[k].as_buffer(), np.uint64)
            if seats[k] is not None:
                members.append((seats[k], fragment))
                continue
            if not members:
                continue
            if block is None:
                tokens = np.concatenate([m[1] for m in members])
                order = np.argsort(tokens, kind="stable")
                block = tokens[order], np.repeat([m[0] for m in members], [len(m[1]) for m in members])[order], 1 + max(m[0] for m in members)
            low, high = np.searchsorted(block[0], fragment), np.searchsorted(block[0], fragment, side="right")
            counts = np.bincount(block[1][ranges(low, high - low)], minlength=block[2])
            found.append((nodes[k], *at[:3], counts.astype("<i4").tobytes()))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names=["node", *columns[:3], "counts"])


def _strongest(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The strongest link of a node to each other component that a block has members of, if any, from sorted rows with its partial overlaps and the members (node, size, root) by seat."""
    place, total, last = None, None, None

    def out() -> list[tuple[int, int, int, int, int]]:
        if place is None:
            return []
        n, sizes = last["n"], np.array([m["n"] for m in last["members"]], np.int64)
        overlap = np.append(total, np.zeros(max(0, len(sizes) - len(total)), np.int64))
        linked = np.flatnonzero(100 * overlap >= percent * (n + sizes - overlap))
        best: dict[int, int] = {}
        for k in linked[np.argsort(-overlap[linked] / (n + sizes[linked] - overlap[linked]), kind="stable")]:
            if (root := last["members"][k]["root"]) != last["root"]:
                best.setdefault(root, k)
        return [(last["node"], last["members"][k]["node"], int(overlap[k]), n, int(sizes[k])) for k in best.values()]

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(5)], names=["a", "b", "overlap", "na", "nb"])

    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if (at := (row["node"], row["several"], row["id"], row["block"])) != place:
                found += out()
                place, total = at, np.zeros(0, np.int64)
            counts = np.frombuffer(row["counts"], "<i4").astype(np.int64)
            if len(counts) > len(total):
                total, counts = counts, total
            total[: len(counts)] += counts
            last = row
        yield rows_of(found)
    yield rows_of(out())


class Join:
    """The state of one join: tables below a shared path, and the order of the n-grams."""

    def __init__(self, documents: DataFrame, size: int, percent: int, key: str, text: str):
        self.spark: SparkSession = documents.sparkSession
        self.path = scratch_path(self.spark, "jaccard")
        self.size, self.percent = size, percent
        self.texts = documents.select(F.col(text).alias("text"))
        kind = dict(documents.dtypes)[key]
        schema = f"doc_id {kind}, n long, node long, check long, slice int, counts binary"
        rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        survey = written(rows.mapInArrow(lean(lambda batches: _survey(batches, size)), schema), f"{self.path}/survey")
        self.members = survey.where("slice IS NULL").select("doc_id", "n", "node")
        self.counts = np.zeros(BUCKETS, np.int64)
        slices = survey.where("slice IS NOT NULL").select("slice", "counts").repartition("slice").mapInArrow(_sum_slices, "slice int, counts binary")
        for k, counts in slices.collect():  # BUCKETS numbers in all
            self.counts[k * _SLICE : (k + 1) * _SLICE] = np.frombuffer(counts, np.int64)
        self.level = levels_of(self.counts)
        self.pivots = pivots_of(self.counts, self.level, FRAGMENTS)
        self.sets: list[DataFrame] = []
        self.tables: list[str] = []
        self.has: DataFrame | None = None

    def write_shared(self) -> DataFrame:
        size, percent, level = self.size, self.percent, self.level
        parts = max(1, -(-int(self.counts.sum()) * (100 - percent) // 100 // PART_NGRAMS))
        schema = "part long, sure boolean, tokens binary, nodes binary, sizes binary, local binary"
        packed = self.texts.mapInArrow(lean(lambda batches: _prefixes(batches, size, percent, level, parts)), schema)
        found = packed.repartition(parts, "part").mapInArrow(lean(lambda batches: _shared(batches, percent)), "token long, node long, n long, place int")
        return written(found, f"{self.path}/shared").distinct()

    def write_sets(self, nodes: DataFrame, name: str) -> DataFrame:
        """The fragments (node, fragment, keys) of these nodes' sets, in one more pass over the texts; written."""
        nodes = written(nodes.distinct(), f"{self.path}/wanted-{name}")
        many = nodes.count()
        bits = min(FILTER_BITS, max(64, 1 << (NODE_BITS * many).bit_length()))
        bit = F.col("node").bitwiseAND(bits - 1)
        wanted = np.zeros(bits // 8, np.uint8)
        words = nodes.groupBy(F.shiftright(bit, 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(node & 31 as int))")).alias("bits"))
        for word, found in words.repartition(WORD_PARTS).toLocalIterator():  # at most FILTER_BITS / 32 rows, a job for each partition
            wanted.view("<u4")[word] = found
        size, level, pivots = self.size, self.level, self.pivots
        segments = self.texts.mapInArrow(lean(lambda batches: _segments(batches, size, level, pivots, wanted)), "node long, fragment int, keys binary")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        segments = segments.repartition(parts, "node").join(nodes, "node", "left_semi")  # the filter lets a few others through
        # Copies of a document in several chunks give a segment several times; one is kept.
        sets = segments.groupBy("node", "fragment").agg(F.first("keys").alias("keys"))
        # In buckets of nodes: joins bring the nodes that they ask for to the sets, and never shuffle all sets again.
        table = f"sets_{uuid.uuid4().hex}"
        sets.write.bucketBy(parts, "node").option("path", f"{self.path}/sets-{name}").saveAsTable(table)
        self.tables.append(table)
        return self.spark.table(table)

    def with_sets(self, wished: DataFrame, node: str) -> DataFrame:
        """Rows with the fragments of the sets of the nodes they name."""
        parts = [wished.join(sets.withColumnRenamed("node", node), node) for sets in self.sets]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    def forget_tables(self) -> None:
        """Their names go; the files stay below the shared path."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def need_sets(self, nodes: DataFrame, name: str) -> None:
        missing = nodes if self.has is None else nodes.join(self.has, "node", "left_anti")
        if self.has is not None and missing.isEmpty():
            return
        self.sets.append(self.write_sets(missing, name))
        has = self.spark.read.schema("node long").parquet(f"{self.path}/wanted-{name}")
        self.has = has if self.has is None else self.has.union(has)

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b, na, nb) whose overlap links them; written, and so are the pairs. Their sets have been written before."""
        pairs = written(pairs, f"{self.path}/pairs-{name}")
        # Many rounds: both sides are dealt by node, and merged as in ``connected``. The set of the node in more pairs stays, those of its partners travel.
        many = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("many"))
        ranked = pairs.select("a", "b").join(many.toDF("a", "many_a").hint("merge"), "a").join(many.toDF("b", "many_b").hint("merge"), "b")
        swap = F.col("many_b") > F.col("many_a")
        turned = ranked.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"), F.greatest("many_a", "many_b").alias("many"))
        dealt = turned.withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / GROUP_ROWS)))
        wished = written(dealt.select("a", "salt", "b").union(dealt.select("a", "salt", F.col("a").alias("b")).distinct()), f"{self.path}/wished-{name}")
        placed = self.with_sets(wished, "b").select("a", "salt", "fragment", "b", "keys")
        place = ["a", "salt", "fragment"]
        sorted_ = placed.repartition(*place).sortWithinPartitions(*place, F.col("a") != F.col("b"))
        partial = sorted_.mapInArrow(lean(_overlaps), "a long, b long, overlap long")
        sums = partial.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("overlap").alias("overlap"))
        found = sums.join(pairs, ["a", "b"]).where(100 * F.col("overlap") >= self.percent * (F.col("na") + F.col("nb") - F.col("overlap")))
        return written(found.select("a", "b", "overlap", "na", "nb"), f"{self.path}/links-{name}")

    def mixed(self, postings: DataFrame, roots: DataFrame | None, name: str) -> DataFrame:
        """The postings of n-grams whose nodes are in several components, with their roots; written."""
        if roots is None:  # each node is a component, and each n-gram has several nodes
            return written(postings.select("token", "node", "n", "place", F.col("node").alias("root")), f"{self.path}/mixed-{name}")
        placed = postings.select("token", "node", "n", "place").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("least"), F.max("n").alias("most")).where("low < high")
        least = F.greatest("least", F.ceil(F.col("n") * self.percent / 100 - 1e-9))
        placed = placed.join(split.select("token", "least", "most"), "token").where(self.early(F.col("n"), F.col("place"), least))
        return written(placed.select("token", "node", "n", "place", "root"), f"{self.path}/mixed-{name}")

    def stars(self, mixed: DataFrame, turn: int) -> DataFrame:
        """Each node with others of its n-grams and about its size: those that are first in an n-gram, in an order of this turn.

        The first turn has one order for all n-grams and takes the one that a node meets most often, so that a group becomes a star. Later
        turns have an order of their own for each n-gram and take up to ``TRIES``. The first nodes of neighbouring sizes that share an n-gram meet as well.
        """
        sized = mixed.where(self.early(F.col("n"), F.col("place"), F.col("n")))
        sized = sized.withColumn("class", F.floor(F.log(F.col("n")) / math.log(100 / self.percent)))
        order = F.xxhash64("node", F.lit(turn)) if turn == 0 else F.xxhash64("node", "token", F.lit(turn))
        first = F.min(F.struct(order.alias("order"), "node", "n", "root")).alias("first")
        least = sized.groupBy("token", "class").agg(first)
        spread = sized.join(least, ["token", "class"]).where("root != first.root").select("node", "n", "first")
        above = least.select("token", (F.col("class") - 1).alias("class"), F.col("first").alias("next"))
        steps = least.join(above, ["token", "class"]).where("first.root != next.root").select("first.node", "first.n", F.col("next").alias("first"))
        met = spread.union(steps).groupBy("node", "n", F.col("first.node").alias("other"), F.col("first.n").alias("other_n"), F.col("first.root").alias("to")).agg(F.count("*").alias("times"))
        # A node has few rows here, so all that follows can be dealt by node.
        to_root = F.sum("times").over(Window.partitionBy("node", "to"))
        met = met.repartition("node").withColumn("to_root", to_root).where(F.col("to_root") >= F.least(F.lit(2), self.needed("n"))).drop("to", "to_root")
        if self.has is None:
            met = written(met, f"{self.path}/met")
            self.need_sets(met.select("node").union(met.select("other")), "first")
        else:  # nodes that met nobody in two n-grams until now wait for the last round
            met = met.join(self.has, "node", "left_semi")
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("times"), F.xxhash64("other", F.lit(turn))))
        best = met.withColumn("place", place).where(F.col("place") <= (1 if turn == 0 else TRIES))
        best = best.join(self.has.withColumnRenamed("node", "other"), "other", "left_semi")
        # Dealt by the pair alone, as the join with the pairs of earlier turns needs them.
        return best.select(*_pair("node", "n", "other", "other_n")).where(self.fits()).groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"))

    def across(self, mixed: DataFrame) -> DataFrame:
        """The strongest links of each node to the blocks of larger groups that share enough n-grams with it, one for a component; written.

        A group is a component, or the components of few nodes whose most frequent n-gram is the same one of more than ``HOT`` nodes: so a passage
        that very many texts share costs them blocks, not pairs. Nodes of such a group meet the blocks of their own group from their own one on.

        The first n-grams that two linked sets share must stand early in both (all n-grams that two components share are in ``mixed``). For a block
        this is judged by its smallest and largest sets and its earliest place, so no pair that can link is left out.
        """
        path = self.path
        nodes = mixed.select("node", "n", "root").distinct()
        sizes = nodes.groupBy("root").agg(F.count("*").alias("own"))
        hot = mixed.groupBy("token").agg(F.count("*").alias("times")).where(F.col("times") > HOT)
        families = mixed.select("token", "root").join(hot, "token").groupBy("root").agg(F.max(F.struct("times", "token"))["token"].alias("family"))
        families = sizes.join(families, "root", "left").select("root", F.when(F.col("own") <= BLOCK, F.col("family")).alias("family"))
        grouped = nodes.join(families, "root").withColumn("group", F.struct(F.col("family").isNotNull().alias("several"), F.coalesce("family", "root").alias("id")))
        many = grouped.groupBy("group").agg(F.count("*").alias("many"))
        block = F.pmod(F.xxhash64("node"), F.ceil(F.col("many") / BLOCK))
        seat = F.row_number().over(Window.partitionBy("group", "block").orderBy("node")) - 1
        seats = written(grouped.join(many, "group").withColumn("block", block).withColumn("seat", seat).drop("family"), f"{path}/seats")
        placed = mixed.select("token", "node", "place").join(seats, "node")
        blocks = placed.groupBy("token", F.col("group").alias("to"), F.col("block").alias("to_block"), F.col("many").alias("to_many")).agg(
            F.min("n").alias("least"), F.max("n").alias("most"), F.min("place").alias("soonest"), F.min("root").alias("first_root"), F.max("root").alias("last_root")
        )
        other = (F.col("first_root") != F.col("root")) | (F.col("last_root") != F.col("root"))
        own = (F.col("group") == F.col("to")) & (F.col("block") <= F.col("to_block")) & other
        ordered = (F.struct("many", "group") < F.struct("to_many", "to")) | own
        # Sizes of sets that can be linked with one of this size.
        least, most = F.greatest("least", F.ceil(F.col("n") * self.percent / 100 - 1e-9)), F.least("most", F.floor(F.col("n") * 100 / self.percent + 1e-9))
        soon = self.early(F.col("n"), F.col("place"), least) & self.early(most, F.col("soonest"), F.col("n"))
        met = placed.join(blocks, "token").where(ordered & (least <= most) & soon)
        met = met.groupBy("node", "n", "root", F.col("to").alias("group"), F.col("to_block").alias("block")).agg(F.count("*").alias("times"))
        met = written(met.where(F.col("times") >= self.needed("n")).drop("times"), f"{path}/across")
        there = met.select("group", "block").groupBy("group", "block").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("groups"))
        members = seats.select("group", "block", "node", "n", "root", "seat").join(there, ["group", "block"])
        self.need_sets(members.select("node").union(met.select("node")), "across")
        salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))
        asked = met.join(there, ["group", "block"]).withColumn("salt", F.pmod(F.xxhash64("node"), F.col("groups")))
        columns = ["group", "block", "salt", "node", "seat"]
        wished = members.withColumn("salt", salts).select(columns).union(asked.withColumn("seat", F.lit(None).cast("int")).select(columns))
        wished = written(wished, f"{path}/wished-across")
        place = ["group", "block", "salt", "fragment"]
        dealt = self.with_sets(wished, "node").repartition(*place).sortWithinPartitions(*place, F.col("seat").isNull())
        partial = dealt.select("group.several", "group.id", *place[1:], "node", "seat", "keys").mapInArrow(lean(_block_overlaps), "node long, several boolean, id long, block long, counts binary")
        partial = partial.select("node", F.struct("several", "id").alias("group"), "block", "counts")
        seated = F.array_sort(F.collect_list(F.struct("seat", "node", "n", "root")))
        lists = members.groupBy("group", "block").agg(F.transform(seated, lambda m: F.struct(m["node"].alias("node"), m["n"].alias("n"), m["root"].alias("root"))).alias("members"))
        whole = partial.join(met, ["node", "group", "block"]).join(lists, ["group", "block"]).select("node", "n", "root", "group", "block", "counts", "members")
        percent, key = self.percent, ["node", "group", "block"]
        whole = whole.repartition(*key).sortWithinPartitions(*key).select("node", "n", "root", "group.several", "group.id", "block", "counts", "members")
        found = whole.mapInArrow(lambda batches: _strongest(batches, percent), "a long, b long, overlap long, na long, nb long")
        return written(found, f"{path}/links-across")

    def early(self, n, place, other_n):
        """Whether a place can be that of one of the first ``SHARED`` n-grams that a set of size ``n`` shares with a linked set of size ``other_n``.

        Linked sets have at least ``t / (1 + t)`` of both sizes in common, and those that follow a shared n-gram stand behind it.
        """
        common = F.ceil(self.percent * (n + other_n) / F.lit(100.0 + self.percent) - 1e-9)
        return place <= n - common + (SHARED - 1)

    def needed(self, n):
        """How many n-grams of its prefix a set of this size shares with any set that it is linked with, at least."""
        smallest = F.ceil(F.col(n) * self.percent / 100 - 1e-9)
        return F.least(F.lit(SHARED), F.ceil(smallest * self.percent / 100 - 1e-9))

    def fits(self):
        """Whether sets of these sizes can be similar enough."""
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        return 100 * small >= self.percent * large


def _pair(x: str, nx: str, y: str, ny: str) -> list[Column]:
    """The two nodes in order, with their sizes."""
    swap = F.col(x) > F.col(y)
    pick = lambda one, other: F.when(swap, F.col(other)).otherwise(F.col(one))
    return [pick(x, y).alias("a"), pick(y, x).alias("b"), pick(nx, ny).alias("na"), pick(ny, nx).alias("nb")]


def join(documents: DataFrame, size: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, roots): documents with set size and node; linked nodes with their overlap; the component of each linked node.

    The links connect exactly the documents that links at ``percent`` connect; pairs inside a component need not all be listed.
    """
    work = Join(documents, size, percent, key, text)
    mixed = work.mixed(work.write_shared(), None, "shared")
    found, roots, turn, enough = [], None, 0, 1
    across = False
    while not across:
        across = turn > 0 and enough == 0
        if across:
            new = work.across(mixed)
        else:
            pairs = work.stars(mixed, turn)
            if turn:
                tried = work.spark.read.schema("a long, b long").parquet(*(f"{work.path}/pairs-{k}" for k in range(turn)))
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            new = work.links(pairs, str(turn))
        many = new.count()
        if turn == 0:
            enough = max(1, math.ceil(WORTH * many))
        if many < enough:
            enough = 0
        if many:
            found.append(new)
            # Components so far are stars around their roots.
            edges = new.select("a", "b") if roots is None else new.select("a", "b").union(roots.select("node", "root"))
            roots = connected(edges, f"{work.path}/roots-{turn}")
            if not across:
                mixed = work.mixed(mixed, roots, str(turn))
        turn += 1
    work.forget_tables()
    if not found:
        nothing = work.spark.createDataFrame([], "a long, b long, overlap long, na long, nb long")
        return work.members, nothing, work.spark.createDataFrame([], "node long, root long")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return work.members, links, roots


def components(documents: DataFrame, size: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    members, _, roots = join(documents, size, percent, key, text)
    path = scratch_path(documents.sparkSession, "components")
    placed = members.where("node IS NOT NULL").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # Written, so that the join below has plain sides: a component that very many documents are in is split by adaptive execution.
    smallest = written(smallest, f"{path}/smallest")
    named = written(placed, f"{path}/placed").join(smallest, "root")
    alone = members.where("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(alone)
