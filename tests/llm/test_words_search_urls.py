"""Word hashing, exact vector search, URL cascade and archive against plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import archive, url_cascade, vector_search
from tallyframe.llm.words import ALNUM, SPACED, text_chunks, words_of
from tallyframe.session import scratch_path
from tests.conftest import bag

PATTERNS = {"spaced": (SPACED, re.compile(r"[^\x20\x09-\x0D]+")), "alnum": (ALNUM, re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_words_match_the_patterns_and_hash_by_content():
    draw = random.Random(1)
    texts = ["".join(draw.choice("aBc Ä1ß.\t\n#漢 z") for _ in range(draw.randint(0, 60))) for _ in range(300)] + ["", None, "x" * 9000]
    for rule, pattern in PATTERNS.values():
        names: dict = {}
        for limit in (50, 1 << 20):
            seen = 0
            for row, data, offsets in text_chunks(pa.array(texts), limit):
                words = words_of(data, offsets, rule)
                for d in range(len(offsets) - 1):
                    want = pattern.findall(lower(texts[row + d] or ""))
                    got = words.hashes[words.first[d] : words.first[d + 1]].tolist()
                    assert len(want) == len(got)
                    for word, code in zip(want, got, strict=True):
                        assert names.setdefault(word, code) == code
                    seen += 1
            assert seen == len(texts)
        assert len(set(names.values())) == len(names)


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(int(k), draw.normal(size=6).astype(np.float32).tolist()) for k in range(300)]
    rows[7] = (7, None)
    rows[8] = (8, [float("nan")] + rows[9][1][1:])
    rows[10] = (10, [None] + rows[9][1][1:])
    rows[11] = (11, rows[12][1])  # a tie
    rows[13] = (13, [1.0])
    rows += [rows[20], rows[0]]  # repeated rows, one of them a query
    rows += [(300, [2.0, 1.0]), (301, [])]  # short ones, the first a query
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    usable = [(k, [math.floor(1024 * x) for x in v] + [0] * (6 - len(v))) for k, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, qv in usable:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), k) for k, v in usable if k != q)
            want += [(q, r, k, -s) for r, (s, k) in enumerate(scored[:10], 1)]
    for block, batch in ((16, 2), (256, 4096)):
        assert bag(vector_search.top_k(frame, lambda k: k % 100 == 0, block_rows=block, query_rows=batch)) == sorted(want, key=str)


def test_the_kth_score_skips_blocks_of_later_batches(monkeypatch):
    scored = []
    best = vector_search._best
    monkeypatch.setattr(vector_search, "_best", lambda ids, scores, k: scored.append(len(ids)) or best(ids, scores, k))
    draw = np.random.default_rng(4)
    near = draw.integers(900, 1000, (64, 4))
    batches = []
    for part in range(4):
        vectors = near if part == 0 else draw.integers(-100, 100, (64, 4))
        lists = pa.ListArray.from_arrays(np.arange(0, 257, 4, dtype=np.int32), pa.array(vectors.ravel()))
        batches.append(pa.RecordBatch.from_arrays([pa.array(np.arange(64) + 64 * part), lists], names=["vec_id", "vector"]))
    queries = np.array([[5, 6, 7, 8], [1, 1, 1, 1]])
    (found,) = vector_search._searcher(queries, np.array([1000, 1001]), None, 3, 16)(iter(batches))
    assert len(scored) <= 8  # blocks of the first batch only: 4 for each query at most, of 32 in all
    want = [np.lexsort((np.arange(64), -(near @ q)))[:3].tolist() for q in queries]
    assert found.column("vec_id").to_pylist() == sum(want, [])


def test_scores_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e9, 1e9]), (1, [1e9, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64-bit"):
        vector_search.top_k(frame, lambda k: k == 0).collect()


def test_top_k_of_few_and_of_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert bag(vector_search.top_k(frame, lambda k: k == 0)) == [(0, 1, 1, 2 * 1024 * 1024)]
    assert vector_search.top_k(frame.limit(0), lambda k: k == 0).count() == 0


def test_shorter_vectors_count_as_filled_up_with_zeros(spark):
    draw = np.random.default_rng(5)
    rows = [(int(k), draw.normal(size=4 if k % 3 else 2).tolist()) for k in range(60)]
    rows += [(60, draw.normal(size=5).tolist()), (61, []), (62, None), (100, [2.0])]  # one overlong row, and short ones
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {k: [math.floor(1024 * x) for x in v] for k, v in rows if v is not None}
    want = []
    for q in (0, 20, 40, 60, 100):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), k) for k, v in whole.items() if k != q)
        want += [(q, r, k, -s) for r, (s, k) in enumerate(scored, 1)]
    for block in (7, 256):
        assert bag(vector_search.top_k(frame, lambda k: k % 20 == 0, k=100, block_rows=block)) == sorted(want, key=str)
    nothing = spark.createDataFrame([(0, []), (1, [])], "vec_id long, embedding array<double>")
    assert bag(vector_search.top_k(nothing, lambda k: k == 0)) == [(0, 1, 1, 0)]


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "b.org/x"), ("allow", "a.b.org/")]


def judged(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = lower(host)
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or (len(rule), rule) > (len(best[1]), best[1])):
            best = (verdict, rule)
    return host, path, best[1] if best else None, best[0] if best else "allow"


def test_url_rules(spark):
    urls = ["http://X.Example.NET/en/1?q", "https://example.net/fr", "http://net", "http://net/#a", "ftp://a.b.org/xy", "http://b.org/x", "http://cb.org/x", None, "", "nothing", "://", "http://a..net//", "http://b.org/X"]
    urls += [f"http://h{k}.net/{'en/' * (k % 3)}" for k in range(50)]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls + urls)], "page_id int, url string, rule string")
    got = url_cascade.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
    assert bag(got) == sorted(((k, *judged(u)) for k, u in enumerate(urls + urls)), key=str)
    assert url_cascade.judge(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_cascade.judge(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_where_the_first_filter_errs(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key like '%7'")
    levels = url_cascade.build_cascade(universe, listed)
    assert len(levels) > 1
    wrong = universe.where(url_cascade.member(F.col("key"), levels) != F.col("key").like("%7"))
    assert wrong.count() == 0


def test_archive_round_trip(spark):
    long = "<p>" + "é" * 90
    rows = [(3, "http://a/", long), (1, "http://b/\n", long), (2, None, long), (2, None, long), (None, "u", "tiny"), (5, "u", "tiny"), (6, "u", None), (7, "u", ""), (8, "u", "x" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = scratch_path(spark, "archive")
    archive.write_archive(pages, path)
    records = archive.read_archive(spark, path)
    want = []
    for key, _, html in rows:
        payload = (html or "").encode()
        kind, refers = ("response", None) if len(payload) < 100 or key in (1, 8) else ("revisit", 1)
        want.append((key, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers))
    got = records.select("page_id", F.length("payload"), F.sha2("payload", 256), "record_type", "refers_to")
    assert bag(got) == sorted(want, key=str)
    block = archive.block_of(F.col("record"))
    assert records.where((F.col("record_type") == "response") & (block != F.col("payload"))).count() == 0
    assert records.where((F.col("record_type") == "revisit") & (F.length(block) > 0)).count() == 0
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    empty = scratch_path(spark, "archive")
    archive.write_archive(pages.limit(0), empty)
    assert archive.read_archive(spark, empty).count() == 0


def test_archive_with_equal_ids_has_one_response(spark):
    html = "y" * 100
    pages = spark.createDataFrame([(1, "a", html), (1, "b", html)], "page_id long, url string, html string")
    path = scratch_path(spark, "archive")
    archive.write_archive(pages, path)
    assert bag(archive.read_archive(spark, path).select("record_type", "url")) == [("response", "a"), ("revisit", "b")]
