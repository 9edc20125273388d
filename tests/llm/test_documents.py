"""Main text, packing, decontamination, near copies and the pipeline against brute force."""

import html
import json
import re
import tracemalloc
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyframe.llm import components, jaccard, language, packing, personal, positional, words, workers, wrapper
from tallyframe.llm.queries import op3_packing, op6_decontamination, op8_near_copies, tokenizer_file
from tallyframe.llm.words import text_chunks
from tallyframe.session import scratch_path
from tests.conftest import bag

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- main text ------------------------------------------------------------


def page(k, body, extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>t {k}</title><style>p{{}}</style><script>var t='<p>no</p>';</script></head><body>"
        f"<nav><ul><li><a href='/'>Home {k}</a></li></ul></nav><div class=\"cookie-notice\">We use cookies {k}</div>"
        f"<div class='tagline'>The site of everything</div>{extra}<article><h1>Title {k}</h1>{body}<form><input><button>Go</button></form>"
        f"<div class='comments'><p>First! {k}</p></div></article><aside>See also {k}</aside><footer>&copy; {k}</footer></body></html>"
    )


def test_main_text_without_template(spark):
    rows, want = [], {}
    for k in range(8):
        body = f"<p>Para  {k}\n of <b>bold</b> &amp; text<br>line<p>unclosed {k}" + "<ul><li>one<li>two</ul>" * (k % 2)
        rows.append((k, f"http://a.example/{k}", page(k, body, "<div class='ad'>buy</div>" * (k % 3))))
        want[k] = "\n".join([f"Title {k}", f"Para {k} of bold & text", "line", f"unclosed {k}", *["one", "two"] * (k % 2)])
    # Without an article the varying part is found by the wrapper alone.
    for k in range(20, 26):
        rows.append((k, f"http://b.example/{k}", f"<body><div class='top'>My blog</div><div class='x'><p>Story number {k} goes on here and on.</p><p>More {k}</p></div><div class='low'>All rights</div></body>"))
        want[k] = f"Story number {k} goes on here and on.\nMore {k}"
    rows += [(30, None, None), (31, "x", ""), (32, "http://c.example", "plain <i>text</i> only"), (33, "http://d.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (34, "http://e.example", "<p a='" + "<" * 2000)]
    rows += [rows[0], (35, "http://f.example", "<article><p>" + "long " * 50_000 + "</p></article>")]
    want |= {30: "", 31: "", 32: "plain text only", 33: "deep", 35: " ".join(["long"] * 50_000)}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = wrapper.extract(pages, ["page_id", "url"])
    assert got.columns == ["page_id", "url", "text"]
    found = defaultdict(list)
    for r in got.collect():
        found[r.page_id].append(r.text)
    assert {k: found[k][0] for k in want} == want and len(found[0]) == 2
    assert wrapper.extract(pages.limit(0), ["page_id", "url"]).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    pages = spark.createDataFrame([(k, "http://a.example/", page(1, "<p>same</p>")) for k in range(6)], "page_id long, url string, html string")
    assert {r.text for r in wrapper.extract(pages, ["page_id", "url"]).collect()} == {"Title 1\nsame"}


def test_main_text_of_the_table_is_the_article(spark):
    for row in wrapper.extract(spark.read.parquet(f"{FOLDER}/pages.parquet"), ["page_id", "url", "html"]).collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert row.text == "\n".join(filter(None, blocks))


def test_text_after_deep_nesting_stays_in_its_place(spark):
    deep = lambda k: "<div>" * 100 + f"deep {k}<nav>menu {k}</nav><div class='comments'>nice {k}</div>" + "</div>" * 100
    texts = [f"<body><article><p>first {k}</p>{deep(k)}<p>after {k}</p></article><div>other {k}</div></body>" for k in range(5)]
    texts.append("<article>" + "<div>" * 50_000 + "in</b>" * 50_000 + "</article><p>out</p>")
    pages = spark.createDataFrame([(k, f"http://h{k // 5}.example/{k}", t) for k, t in enumerate(texts)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in wrapper.extract(pages, ["page_id", "url"]).collect()}
    assert found == {k: f"first {k}\ndeep {k}\nafter {k}" for k in range(5)} | {5: "in" * 50_000}


def test_tree_matching_aligns_inserted_nodes():
    assert wrapper.align("(a(x,y,z))", "(a(x,q,y,z))") == {0: 0, 1: 1, 2: 2, 3: 4, 4: 5}
    assert wrapper.align("(b)", "(a)") == {0: 0}


# --- packing --------------------------------------------------------------


def check_packing(rows, texts, file, sequence=2048):
    tokenizer = Tokenizer.from_file(file)
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t in texts]
    want = Counter()
    for (key, _), all_ids in zip(texts, ids, strict=True):
        for piece, at in enumerate(range(0, len(all_ids), sequence)):
            part = all_ids[at : at + sequence]
            want[key, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= sequence
    return len(sequences), -(-sum(map(len, ids)) // sequence)


def test_packing_query_is_whole_and_tight(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    used, least = check_packing(op3_packing(spark, FOLDER).collect(), texts, tokenizer_file())
    assert used <= least + 1


def test_packing_of_odd_texts(spark, documents):
    texts = [(1, None), (2, ""), (2, ""), (3, "a" * 70_000), (4, "x <|endoftext|> y <| z"), (5, "a\x1cb \x01 É'S ΣΑΣ 漢字 ́e é ﬁ"), (6, "word " * 9000), (None, "no key"), (7, "İI 1²3")]
    path = scratch_path(spark, "pieces")
    packing.write_pieces(documents(*texts), path, tokenizer_file(), keep_ids=True)
    packed = packing.pack(spark, path, bucket_rows=1)
    rows = packed.withColumnRenamed("key", "doc_id").collect()
    check_packing(rows, texts, tokenizer_file())
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    empty = scratch_path(spark, "pieces")
    packing.write_pieces(documents(*texts).limit(0), empty, tokenizer_file())
    assert packing.pack(spark, empty).count() == 0


def test_chunks_encode_like_whole_texts():
    encoder, tokenizer = packing._Encoder(tokenizer_file()), Tokenizer.from_file(tokenizer_file())
    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"ab{chr(c)}cd {chr(c)} É'S{chr(c)}" for c in points]
    for text, whole in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.encode(text) == np.array(whole.ids, "<u4").tobytes(), repr(text)


@pytest.mark.parametrize("histogram", [{}, {5: 3}, {2048: 4, 2047: 2, 1: 1}, {1100: 7}, {k: 1 + k % 5 for k in range(1, 2049, 3)}])
def test_plan_uses_each_length_as_often_as_it_occurs(histogram):
    plan = packing.plan_packing(histogram)
    used = Counter()
    for pattern, times in plan:
        assert times > 0 and sum(pattern) <= 2048
        for length in pattern:
            used[length] += times
    assert used == Counter(histogram)
    least = -(-sum(k * v for k, v in histogram.items()) // 2048)
    assert sum(times for _, times in plan) <= max(least + 1, 7)


# --- decontamination ------------------------------------------------------


def brute_hits(docs, items, size=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[at : at + size])].add(str(item))
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for length in {len(x) for x in windows}:
            for at in range(len(w) - length + 1):
                if items_here := windows.get(tuple(w[at : at + length])):
                    hit.update(range(at, at + length))
                    found |= items_here
        out.append((key, len(w), len(hit), tuple(sorted(found))))
    return out


def test_passages_equal_brute_force(spark, documents):
    long = " ".join(f"w{k % 17}x{k % 5}" for k in range(60))
    items = [(1, long), (2, "short Item"), (3, None), (4, "..."), (5, long), (6, "the " * 20), (7, "漢字 é")]
    docs = [(1, "before " + long + " after"), (1, "before " + long + " after"), (2, "a SHORT-item, short item"), (3, None), (4, ""), (5, "the " * 5000), (6, "漢字 É é 漢字 é"), (7, " ".join(long.split()[:12])), (8, " ".join(long.split()[:13]))]
    table = documents(*docs)
    path = scratch_path(spark, "index")
    positional.write_index(table, path)
    listed = spark.createDataFrame(items, "item_id int, text string").withColumn("key", F.lit("clash"))
    for block in (3, 10_000):
        found = positional.find_passages(spark, path, listed, block_windows=block)
        got = [(r.key, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect()]
        assert sorted(got) == sorted(brute_hits(docs, items))
    assert positional.find_passages(spark, path, listed.limit(0)).where("n_hit > 0").count() == 0
    empty = scratch_path(spark, "index")
    positional.write_index(table.limit(0), empty)
    assert positional.find_passages(spark, empty, listed).count() == 0


def test_items_without_an_id_count(spark, documents):
    path = scratch_path(spark, "index")
    positional.write_index(documents((1, "alpha beta gamma"), (2, "one two"), (3, "clean")), path)
    items = spark.createDataFrame([(None, "alpha beta gamma"), (7, "one two"), (None, "one two")], "item_id int, text string")
    for block in (1, 10_000):
        found = {r.key: (r.n_hit, r["items"]) for r in positional.find_passages(spark, path, items, block_windows=block).collect()}
        assert found == {1: (3, []), 2: (2, ["7"]), 3: (0, [])}


def test_proximity_allows_words_to_stand_off(spark, documents):
    path = scratch_path(spark, "index")
    positional.write_index(documents((1, "alpha beta x gamma"), (2, "alpha x y z beta gamma")), path)
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string")
    hits = lambda slack: {r.key for r in positional.find_passages(spark, path, items, slack=slack).collect() if r.n_hit}
    assert hits(0) == set() and hits(1) == {1} and hits(3) == {1, 2}


def test_decontamination_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {(k, n, h, len(i), h > 0 and 20 * h >= n) for k, n, h, i in brute_hits(docs, items)}
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in op6_decontamination(spark, FOLDER).collect()}
    assert got == want


# --- near copies ----------------------------------------------------------


def brute_components(docs, size=4, percent=85):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    least: dict = {}
    for k, (key, _) in enumerate(docs):
        r = top(k)
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return sorted(((key, len(sets[k]), least.get(top(k))) for k, (key, _) in enumerate(docs)), key=str)


def near_copies():
    draw = np.random.default_rng(7)
    words = [f"w{k}" for k in range(400)]
    docs = []
    for base in range(4):
        text = list(draw.choice(words, size=80 + 60 * base))
        for copy in range(25):
            edited = list(text)
            for _ in range(int(draw.integers(0, 5))):
                edited[int(draw.integers(len(edited)))] = f"e{draw.integers(10_000)}"
            cut = int(draw.integers(0, 12)) * (copy % 3 == 0)
            docs.append((1000 * base + copy, " ".join(edited[cut:])))
    passage = " ".join(draw.choice(words, size=40))
    docs += [(9000 + k, passage + " " + " ".join(draw.choice(words, size=int(draw.integers(5, 60))))) for k in range(40)]
    docs += [(1, "A b"), (2, "a B"), (3, "a"), (4, None), (5, ""), (6, " \t"), (7, "a b c d"), (8, "A B C d"), (8, "A B C d"), (None, docs[0][1]), (10, "x y " * 5000)]
    return docs


def test_components_equal_brute_force(spark, documents):
    docs = near_copies()
    assert bag(jaccard.components(documents(*docs))) == brute_components(docs)
    assert jaccard.components(documents(*docs).limit(0)).count() == 0
    alone = documents((1, "only one text here today"), (2, None))
    assert bag(jaccard.components(alone)) == [(1, 2, 1), (2, 0, 2)]


def test_links_carry_true_overlaps(spark, documents):
    docs = near_copies()[:60]
    members, links, _ = jaccard.join(documents(*docs))
    sets = {}
    for r in members.collect():
        w = lower(dict(docs)[r.doc_id]).split()
        sets[r.node] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))}
    found = links.collect()
    assert found and all(r.overlap == len(sets[r.a] & sets[r.b]) for r in found)


def test_near_copies_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert bag(op8_near_copies(spark, FOLDER)) == brute_components(docs)


def test_connected_components_of_long_chains(spark, tmp_path):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (200, 160)]
    found = components.connected(spark.createDataFrame(links, "a long, b long"), str(tmp_path / "one"))
    want = [(k, 0) for k in range(41)] + [(100, 100), (101, 100), (150, 150), (160, 150), (200, 150)]
    assert bag(found) == sorted(want, key=str)
    assert components.connected(spark.createDataFrame([], "a long, b long"), str(tmp_path / "none")).count() == 0


def jobs_of(spark, work):
    """How many jobs this starts: each stage of a plan costs the driver a broadcast, a thread and a new plan."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_finished_components_take_no_further_round(spark, tmp_path):
    stars = spark.createDataFrame([(10 * k, 10 * k + j) for k in range(5) for j in range(1, 8)], "a long, b long")
    found = []
    many = jobs_of(spark, lambda: found.append(components.connected(stars, str(tmp_path / "stars"))))
    assert bag(found[0]) == bag(spark.createDataFrame([(10 * k + j, 10 * k) for k in range(5) for j in range(8)], "node long, root long"))
    assert [p.name for p in (tmp_path / "stars").iterdir()] == ["0"]
    assert many <= 8


def test_the_filter_comes_in_few_jobs_whatever_the_partitions(spark, documents):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    work = jaccard.Join(documents(*near_copies()[:60]), 4, 85, "doc_id", "text")
    nodes = work.members.where("node IS NOT NULL").select("node")
    sets = []
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        many = jobs_of(spark, lambda: sets.append(work.write_sets(nodes, "all").select("node").distinct().count()))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        work.forget_tables()
    assert sets == [nodes.distinct().count()]
    assert many <= 30


def passage_documents(many):
    """Texts that share a passage, of which few are linked: those of ten a number, with one word of their own at the end."""
    draw = np.random.default_rng(11)
    passage = " ".join(draw.choice([f"p{k}" for k in range(300)], size=24, replace=False))
    docs = [(k, " ".join([f"x{k}a{j}" for j in range(2 + k % 5)] + [passage] + [f"y{k}b{j}" for j in range(k % 7)])) for k in range(many)]
    return docs + [(many + k, f"{docs[10 * k][1]} z{k}") for k in range(many // 10)]


def test_a_frequent_passage_costs_blocks_not_pairs(spark, documents, monkeypatch):
    docs = passage_documents(300)
    monkeypatch.setattr(jaccard, "WORTH", 2.0)  # one turn of stars, then across
    seen = []
    across = jaccard.Join.across
    monkeypatch.setattr(jaccard.Join, "across", lambda self, mixed: (across(self, mixed), seen.append(self.path))[0])
    assert bag(jaccard.components(documents(*docs))) == brute_components(docs)
    seats = spark.read.parquet(f"{seen[0]}/seats")
    assert seats.select("group", "block").distinct().count() <= 20 < seats.select("root").distinct().count()
    assert max(r.many for r in seats.collect()) > jaccard.HOT


def test_postings_without_room_for_a_link_stay_out():
    def part(postings):
        token, node, n, place = (np.array(x, np.int64) for x in zip(*postings, strict=True))
        local = np.concatenate([place.astype("<i4").view(np.uint8), np.arange(len(node), dtype="<i4").view(np.uint8), np.zeros(len(node), np.uint8)])
        names = ["part", "sure", "tokens", "nodes", "sizes", "local"]
        return pa.RecordBatch.from_pylist([dict(zip(names, [0, False, token.astype(np.uint64).tobytes(), node.tobytes(), n.tobytes(), local.tobytes()], strict=True))])

    # 100 and 100 n-grams at 80: at least 89 in common, so the first four they share stand at places up to 14.
    rows = [(1, 10, 100, 14), (1, 11, 100, 3), (2, 10, 100, 15), (2, 11, 100, 3)]
    kept = [r for b in jaccard._shared(iter([part(rows)]), 80) for r in b.to_pylist()]
    assert [(r["token"], r["node"]) for r in kept] == [(1, 10), (1, 11)]


# --- pipeline -------------------------------------------------------------


def test_few_texts_are_shuffled_for_the_rows_that_go(spark, documents):
    docs = documents(*[(k, f"text {k}") for k in range(2000)], (None, "without"), (5, "other"))
    gone = docs.where("doc_id % 100 = 7 OR doc_id IS NULL").select(F.to_json(corpus_pipeline._row()).alias("gone"))
    doubtful, clear = corpus_pipeline._parted(docs, gone)
    assert 21 <= doubtful.count() <= 40 and doubtful.count() + clear.count() == 2002
    assert bag(corpus_pipeline._without(docs, gone), "doc_id") == bag(docs.where("NOT (doc_id % 100 <=> 7) AND doc_id IS NOT NULL"), "doc_id")
    assert corpus_pipeline._without(docs, gone.limit(0)).count() == 2002


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()] if name != "packing" else None
        out = corpus_pipeline._written(stage(spark, docs, FOLDER), name)
        if name == "packing":
            texts = [(r.doc_id, r.text) for r in docs.collect()]
            check_packing(out.collect(), texts, tokenizer_file())
            break
        assert out.columns == docs.columns
        kept = {r.doc_id: r for r in out.collect()}
        if name == "language":
            assert set(kept) == {k for k, r in rows.items() if any(map(str.isalpha, r.text))}
        elif name == "near_copies":
            assert set(kept) == {k for k, _, c in brute_components(before) if k == c}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert set(kept) == {k for k, n, h, _ in brute_hits(before, items) if not (h > 0 and 20 * h >= n)}
        else:
            assert set(kept) == {k for k, _ in before} and all(r.n_chars == len(r.text) for r in kept.values())
        docs = out


def test_pipeline_stages_take_odd_rows(spark, documents):
    odd = documents((1, None), (1, None), (2, ""), (3, "the and of it is to"), (3, "the and of it is to"), (3, "the and of it is to be or"), (None, "der die und ist das"), (None, None))
    for stage, left in ((corpus_pipeline.drop_near_copies, 7), (corpus_pipeline.decontaminate, 8), (corpus_pipeline.mask_personal_data, 8)):
        assert stage(spark, odd, FOLDER).count() == left
        assert stage(spark, odd.limit(0), FOLDER).count() == 0
    assert corpus_pipeline.identify_language(spark, odd, FOLDER).count() == 4
    assert corpus_pipeline.pack_sequences(spark, odd.limit(0), FOLDER).count() == 0


def test_near_copies_stage_takes_five_words_and_four_fifths(spark, documents):
    text = [f"w{k}" for k in range(200)]
    edited = lambda *at: " ".join(f"e{k}" if k in at else w for k, w in enumerate(text))
    # Four edits: 176 of 216 5-grams are shared (0.81), and 181 of 213 4-grams (just under 0.85). Five edits: 171 of 221 (0.77).
    docs = [(1, " ".join(text)), (2, edited(20, 60, 100, 140)), (3, edited(30, 70, 110, 150, 180)), *near_copies()]
    docs = [(k, t) for k, (_, t) in enumerate(docs)]
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, documents(*docs), FOLDER).collect()}
    assert 0 in kept and 1 not in kept and 2 in kept
    assert kept == {k for k, _, c in brute_components(docs, 5, 80) if k == c}


@pytest.mark.parametrize(
    "page,want",
    [
        ('<body><div class="content has-sidebar"><p>Story one.</p></div>', "Story one."),
        ('<body><div id="ad-free-content"><p>Story one.</p></div>', "Story one."),
        ('<body><div class="social-science"><p>Story one.</p></div>', "Story one."),
        ('<body><form action="/"><h1>Title</h1><p>Story one.</p></form>', "Title\nStory one."),
        ('<body><form><label>Name</label><input name="a"></form><p>Story one.</p>', "Story one."),
        ('<body><article><div class="entry-header"><h1>Title</h1></div><p>Story one.</p></article>', "Title\nStory one."),
        ('<body><div class="entry-header"><h1>Title</h1></div><p>Story one.</p>', "Title\nStory one."),
        ('<body><article><p>Story one.</p><div class="related-work"><p>Earlier ones.</p></div></article>', "Story one.\nEarlier ones."),
        ('<body><div class="page-header">Brand</div><p>Story one.</p><div id="main-sidebar">Side</div>', "Story one."),
        ('<body><p>Story one.</p><div class="ad-slot-1">Buy</div><ul class="comment-list"><li>First!</li></ul><div class="x sidebar_left">Side</div>', "Story one."),
        ('<body><div class="cookie-bar">We use cookies</div><p>Story one.</p><div class="site-nav">Home</div><div class="share-buttons">Share</div>', "Story one."),
    ],
)
def test_class_names_exclude_as_whole_names(page, want):
    assert "\n".join(wrapper._content(wrapper.page_tree(page), None, ())) == want



def test_runs_and_chunks_of_letters_are_kept_once():
    encoder = packing._Encoder(tokenizer_file())
    parts = [b"".join(map(encoder.encode, text.split())) for text in ("word word, Word (word) wörd", "x1 a-b --")]
    assert parts == encoder.whole(["word word, Word (word) wörd", "x1 a-b --"])
    assert "word" in encoder.chunks.new and "word" not in encoder.runs.new and "wörd" in encoder.runs.new
    weight = encoder.chunks.weight
    encoder.chunks.put("word", encoder.chunks.get("word"))
    assert encoder.chunks.weight == weight


def test_stages_of_the_pipeline_hand_memory_back(documents, spark, monkeypatch):
    docs, made = documents(*((k, "one two three a@b.example") for k in range(20))), []
    for module in (language, personal, positional):
        monkeypatch.setattr(module, "lean", lambda function, module=module: made.append(module) or function)
    language.identify(docs, language.learn(docs))
    personal.mask(docs, personal.learn(docs))
    positional.write_index(docs, scratch_path(spark, "index"))
    assert made == [language] * 2 + [personal] * 2 + [positional]


def test_other_tasks_drop_what_packing_kept():
    packing._encoders["one"] = object()
    assert list(workers.lean(lambda batches: batches, "packing")(iter([1]))) == [1] and "one" in packing._encoders
    assert list(workers.lean(lambda batches: batches)(iter([1]))) == [1] and "one" not in packing._encoders


def texts_ids(texts, by_rank=True):
    column = pa.array([t or "" for t in texts])
    encoder = packing._Texts(tokenizer_file(), by_rank)
    return [ids for _, data, offsets in text_chunks(column, 1000) for ids in encoder.ids(data, offsets)], encoder


def test_texts_encode_many_at_a_time_like_the_tokenizer():
    tokenizer = Tokenizer.from_file(tokenizer_file())
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"ab{chr(c)}cd {chr(c)} É'S{chr(c)}'{chr(c)}" for c in points]
    ends = ["s", "t", "re", "ve", "m", "ll", "d", "l", "r", "v", "x", "S", "'", "''s", "1", "", " "]
    texts += [f"{a}'{b}{c}" for a in ("", "we", "9", '"', "'s", " ") for b in ends for c in ("", "z", "'s", " it", "5", "é", "!", "\x1c")]
    texts += ["", " ", "a" * 399, "b" * 401 + " c", "don't " + "xy" * 3000 + " we'll", "word " * 500, "²³½ªº ÀÉß×÷ı İI 12", "a\u0307b", "<| <|endoftext|> |>", "漢字 word wörd’s"]
    found, encoder = texts_ids(texts)
    assert encoder.latin is not None and packing.merges_by_rank(tokenizer_file())
    for text, ids, whole in zip(texts, found, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == [*whole.ids, 0], repr(text)[:80]


def test_latin_texts_need_no_chunks_and_other_vocabularies_no_ranks(tmp_path):
    texts = ["Words of Latin letters, 12 numbers; don't.", "wörd"]
    found, encoder = texts_ids(texts)
    assert encoder.chunked is None
    slow, encoder = texts_ids(texts, by_rank=False)
    assert encoder.chunked is not None and [x.tolist() for x in found] == [x.tolist() for x in slow]
    content = json.loads(open(tokenizer_file(), encoding="utf-8").read())
    content["model"]["merges"].reverse()
    (file := tmp_path / "reversed.json").write_text(json.dumps(content))
    assert not packing.merges_by_rank(str(file))


def feature_counts(texts, langs):
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(langs)], names=["text", "lang"])
    found = Counter()
    for part in language._count(iter([batch]), sorted(set(langs))):
        for key, n in zip(*(part.column(k).to_pylist() for k in (0, 1)), strict=True):
            found[key] += n
    return found


def test_learning_counts_every_word_of_every_language():
    texts = ["The the THE cat", "the chat", None, "", "Кот the", "cat " * 300_000, "the cat"]
    langs = ["en", "fr", "en", "fr", "ru", "en", "fr"]
    want = Counter()
    for text, lang in zip(texts, langs, strict=True):
        data = np.frombuffer((text or "").encode(), np.uint8)
        words = language.words_of(data, np.array([0, len(data)]), language.LETTERS)
        at = ["en", "fr", "ru"].index(lang)
        for k in range(len(words.hashes) if lang != "en" or len(data) < 100 else 0):
            one = slice(k, k + 1)
            want.update((language._features(data, words.start[one], words.end[one], words.hashes[one])[0] * 3 + at).tolist())
            want[int(language.FEATURES + language._scripts(data, words.start[one], words.end[one])[0]) * 3 + at] += int(words.end[k] - words.start[k])
    few = feature_counts(["cat"], ["en"])
    for key, n in few.items():
        want[key * 3] += n * 300_000
    assert feature_counts(texts, langs) == want


def test_learning_and_labelling_stay_in_little_memory():
    letters = np.random.default_rng(1).integers(97, 123, (400, 2000, 6), np.uint8)
    letters[:, :, 5] = 32
    texts = [one.tobytes().decode() for one in letters]
    langs = [("de", "en")[k % 2] for k in range(len(texts))]
    model = language.Model(["de", "en"], np.zeros((language.FEATURES, 2), np.float32), np.ones((14, 2), bool))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(langs)], names=["text", "lang"])
    for work in (lambda: list(language._count(iter([batch]), ["de", "en"])), lambda: language._label(batch, "text", model, False)):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 250e6


def test_words_are_hashed_in_parts_and_little_memory(monkeypatch):
    data = np.random.default_rng(2).integers(97, 123, 4 << 20, np.uint8)
    data[::7] = 32
    offsets = np.array([0, 1000, 1000, len(data) - 3, len(data)])
    tracemalloc.start()
    found = words.words_of(data, offsets, words.SPACED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    monkeypatch.setattr(words, "PART_BYTES", 1 << 30)
    whole = words.words_of(data, offsets, words.SPACED)
    for name in ("hashes", "first", "start", "end"):
        assert np.array_equal(getattr(found, name), getattr(whole, name))
    text = b"one  Two\tthree" + "wörd".encode() * 3 + b" two"
    monkeypatch.setattr(words, "PART_BYTES", 1)
    alone = [words.words_of(np.frombuffer(w, np.uint8), np.array([0, len(w)]), words.SPACED).hashes[0] for w in text.split()]
    assert words.words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]), words.SPACED).hashes.tolist() == alone and alone[1] == alone[3]
