"""Token alignment, importance resampling and SimHash against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tallyframe.llm import alignment, resampling, simhash
from tallyframe.llm.queries import tokenizer_file
from tallyframe.llm.words import text_chunks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "The quick BROWN fox étage naïve 12 x jumps over_the lazy-dog and won't stop".split()


def texts_of(n, seed):
    chance = random.Random(seed)
    return [" ".join(chance.choices(WORDS, k=chance.randint(1, 60))) for _ in range(n)]


ODD = [None, "", " ", "a", "x▁y", " a  b ", "日本語 text", "<|endoftext|> hi <s>", "\x1c\x1d x", "é" * 50, "\n" * 40, "😀" * 300 + "a", "​́" * 40]
A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def _plain_groups(text, one, two):
    """The groups of one text and its links, from the offsets at which both have an end."""
    if not text:
        return None
    ids = one.tokenizer.encode(" " + text, add_special_tokens=False).ids, two.model.encode(text)
    data = [[v.data[v.first[k] : v.first[k] + v.length[k]].tobytes() for k in x] for v, x in zip((one.vocabulary, two.vocabulary), ids, strict=True)]
    if not all(b"".join(x) == (" " + text).encode() for x in data):
        return None
    ends = [np.cumsum([len(t) for t in x]).tolist() for x in data]
    groups, at = [], [0, 0]
    for stop in sorted(set(ends[0]) & set(ends[1])):
        own = []
        for k in (0, 1):
            upto = ends[k].index(stop) + 1
            own.append(ids[k][at[k] : upto])
            at[k] = upto
        groups.append(own)
    return groups


@pytest.mark.parametrize("large", [4096, 3])
def test_alignment_equals_plain_groups_and_counts(spark, large, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE_GROUP", large)
    texts = ODD + texts_of(60, 1)
    one, two = alignment.ByteLevel(A), alignment.Pieces(B)
    plain = [_plain_groups(t, one, two) for t in texts]
    links = [Counter((a, b) for x, y in groups or [] for a in x for b in y) for groups in plain]
    held = Counter(pair for found in links for pair in found)
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    want = {}
    for k, (groups, found) in enumerate(zip(plain, links, strict=True)):
        shown = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups or [])
        best = sum(n for p, n in found.items() if held[p] == most[p[0]])
        total = sum(n * held[p] for p, n in found.items())
        sizes = [sum(len(g[side]) for g in groups or []) for side in (0, 1)]
        want[k] = (*sizes, len(groups or []), sum(found.values()), best, total, hashlib.sha256(shown.encode()).hexdigest() if groups else "")
        (row, data, offsets), = text_chunks(pa.array([texts[k]]))
        chunk = alignment.align_chunk(data, offsets, one, two)
        assert alignment.group_texts(chunk)[0].decode() == shown
        pairs, _, times = alignment.links_of(chunk)
        assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == {int(alignment.pair_of(np.int64(a), np.int64(b))): n for (a, b), n in found.items()}
    rows = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, n_a int").repartition(5)
    found = {r["key"]: tuple(r)[1:] for r in alignment.align(rows, A, B).collect()}
    assert found == want


def test_alignment_of_no_rows_and_of_repeated_keys(documents):
    assert alignment.align(documents((1, "x")).limit(0), A, B).count() == 0
    found = [tuple(r) for r in alignment.align(documents((1, "a b"), (1, "a b"), (None, "a b")), A, B).collect()]
    assert len(found) == 3 and len({r[1:] for r in found}) == 1 and found[0][6] == 3 * found[0][4]
    assert {r["groups"] for r in alignment.groups(documents((1, ""), (2, None)), A, B).collect()} == {""}


def test_many_rounds_and_lanes_give_the_same_counts(spark, monkeypatch):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts_of(80, 2))], "doc_id long, text string").repartition(8)
    want = sorted(map(tuple, alignment.align(rows, A, B).collect()))
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr(alignment, "LANE_BYTES", 64)
    assert sorted(map(tuple, alignment.align(rows, A, B).collect())) == want


def test_span_checksums_equal_crc32():
    chance = random.Random(3)
    data = chance.randbytes(50_000)
    spans = [(0, 50_000), (7, 8)]
    for length in (1, 2, 3, 4, 5, 63, 64, 65, 127, 128, 129, 200, 1000, 4097):
        at = chance.randrange(40_000)
        spans.append((at, at + length))
    start, end = np.array(spans).T
    found = resampling.span_checksums(np.frombuffer(data, np.uint8), start, end)
    assert found.tolist() == [zlib.crc32(data[a:b]) for a, b in spans]


def _features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def test_resampling_equals_plain_scores(spark):
    texts = [*ODD, "w" * 70_000 + " tail", *texts_of(60, 4), *texts_of(5, 4)]
    target = [None, "", "lazy dog stop fox", "the quick fox"]
    own = [_features(t) for t in texts]
    s, t = Counter(b for _, f in own for b in f), Counter(b for x in target for b in _features(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    want, able = {}, []
    for k, (n, found) in enumerate(own):
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{k}".encode()).hexdigest()[:8], 16)
        want[k] = [len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        if n >= 20:
            able.append(k)
    for place, k in enumerate(sorted(able, key=lambda k: (-want[k][2], k))[: 25 * len(able) // 100], 1):
        want[k][3] = place
    rows = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(texts)], "doc_id long, text string, score string").repartition(4)
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    found = {r["key"]: list(r)[1:] for r in resampling.resample(rows, aim).collect()}
    assert found == want


def test_resampling_of_no_rows_without_target_and_with_null_keys(documents):
    nothing = documents((1, "x")).limit(0)
    assert resampling.resample(nothing, nothing).count() == 0
    long = " ".join(WORDS * 3)
    found = [tuple(r) for r in resampling.resample(documents((None, long), (None, long), (3, long), (4, long)), nothing, percent=50).collect()]
    assert sorted(r[4] for r in found if r[4]) == [1, 2] and len(found) == 4


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _components(numbers, errors):
    root = list(range(len(numbers)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, a in enumerate(numbers):
        for y in range(x):
            if (a ^ numbers[y]).bit_count() <= errors:
                low, high = sorted((top(x), top(y)))
                root[high] = low
    return [top(x) for x in range(len(numbers))]


def test_simhash_equals_brute_force(spark):
    texts = [*ODD, "w" * 70_000, " ".join(WORDS * 200), *texts_of(40, 5)]
    texts += [texts[20], texts[20], texts[21] + " more", texts[15] + " " + texts[16] + " end"]
    prints = [_fingerprint(t) for t in texts]
    roots = _components(prints, 2)
    rows = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, component_id int").repartition(4)
    found = {r["key"]: (r["fingerprint"], r["component_id"]) for r in simhash.components(rows).collect()}
    assert found == {k: (f"{p:016x}", roots[k]) for k, p in enumerate(prints)}


def _ball(n, seed, spread):
    """Distinct numbers near a few centres: groups in which most are linked, some only through others, some not."""
    chance = random.Random(seed)
    centres = [chance.getrandbits(64) for _ in range(4)]
    found = {0, (1 << 64) - 1, 1 << 63}
    while len(found) < n:
        number = chance.choice(centres)
        for _ in range(chance.randint(0, spread)):
            number ^= 1 << chance.randrange(64)
        found.add(number)
    return sorted(found)


@pytest.mark.parametrize("group_rows", [20_000, 5])
def test_links_connect_what_differs_in_few_bits(spark, group_rows, tmp_path):
    numbers = _ball(200, 6, 4)
    nodes = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in numbers], "node long")
    links = simhash.link(nodes, str(tmp_path / "links"), group_rows=group_rows).collect()
    place = {n: k for k, n in enumerate(numbers)}
    root = list(range(len(numbers)))
    for row in links:
        a, b = (x & (1 << 64) - 1 for x in row)
        assert (a ^ b).bit_count() <= 2
        low, high = sorted((root[place[a]], root[place[b]]))
        root = [low if r == high else r for r in root]
    assert root == _components(numbers, 2)


def test_a_dense_group_gives_a_forest_and_not_its_pairs():
    numbers = np.array(_ball(1500, 7, 2), np.uint64)
    found = simhash.walk(numbers, np.array([[0, len(numbers), 0, len(numbers), 0]]), 0)
    assert len(found) == len(numbers) - len(set(_components([int(n) for n in numbers], 2)))


def test_simhash_of_no_rows_and_null_keys(documents):
    assert simhash.components(documents((1, "x")).limit(0)).count() == 0
    found = {tuple(r) for r in simhash.components(documents((None, ""), (None, None), (7, " "), (9, "a b"))).collect()}
    assert ("0" * 16, 7) in {f[1:] for f in found} and (None, "0" * 16, 7) in found
    alone = simhash.components(documents((None, "only words here and there"))).collect()
    assert alone[0]["component_id"] is None
