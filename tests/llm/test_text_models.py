"""Language identification, personal data and Katz scores against brute force and held-out accuracy."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import katz, language, personal
from tallyframe.llm.queries import op1_language, op4_personal_data
from tallyframe.llm.words import mix, words_of
from tests.conftest import bag

FOLDER = "/root/testdata/sf0.001"


def viterbi(scores, switch):
    value, back = list(scores[0]), []
    for row in scores[1:]:
        top = int(np.argmax(value))
        came = [top if value[top] - np.float32(switch) > v else k for k, v in enumerate(value)]
        value = [max(v, value[top] - np.float32(switch)) + s for v, s in zip(value, row, strict=True)]
        back.append(came)
    state = int(np.argmax(value))
    path = [state]
    for came in reversed(back):
        state = came[state]
        path.append(state)
    return path[::-1]


def test_blocks_chain_to_the_path_of_the_whole_text():
    draw = np.random.default_rng(5)
    sizes = [0, 1, 3, 4, 5, 17, 64, 2]
    first = np.cumsum([0, *sizes])
    scores = (draw.normal(size=(first[-1], 4)) * 2).astype(np.float32)
    path = language.best_path(scores, first, switch=1.5, block=4)
    for a, b in zip(first, first[1:], strict=False):
        if b > a:
            assert path[a:b].tolist() == viterbi(scores[a:b], 1.5)


def test_paths_take_memory_in_proportion_to_the_languages():
    draw = np.random.default_rng(6)
    first = np.cumsum([0, *[200] * 100, 20_000])
    peaks = []
    for labels in (8, 64):
        scores = draw.normal(size=(first[-1], labels)).astype(np.float32)
        tracemalloc.start()
        path = language.best_path(scores, first)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert path[:200].tolist() == viterbi(scores[:200].astype(float), language.SWITCH) and path[20_000:].tolist() == viterbi(scores[20_000:].astype(float), language.SWITCH)
    assert peaks[1] < 16 * peaks[0]  # the square would be 64 times


def test_rare_languages_are_learned(spark):
    rows = [(f"the and of {k} with", "en") for k in range(3000)] + [("und der die das nicht", "de"), ("le la les des pas", "fr")]
    model = language.learn(spark.createDataFrame(rows, "text string, lang string"), 100)
    assert model.languages == ["de", "en", "fr"]
    found = language.identify(spark.createDataFrame([("der die das",), ("les des pas",), ("the of and",)], "text string"), model)
    assert [r.lang_pred for r in found.collect()] == ["de", "fr", "en"]


def test_labels_and_scores_of_whole_documents_by_hand(spark, documents):
    """The prediction from the model's tables with plain strings and loops."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.learn(table)
    texts = [r.text for r in table.where("text IS NOT NULL").orderBy("doc_id").limit(20).collect()]
    mixed = " ".join(t[:200] for t in texts[:6])
    texts += [mixed, mixed * 9, "Привет мир the end", "ab", "x1y 22 Zz"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(documents(*enumerate(texts)), model).collect()}
    for k, text in enumerate(texts):
        words = re.findall(rb"[A-Za-z\x80-\xFF]+", text.encode())
        scores = np.array([word_score(model, w) for w in words], np.float32).astype(float)
        letters = dict.fromkeys(range(len(model.languages)), 0)
        for word, label in zip(words, viterbi(scores, language.SWITCH), strict=True):
            letters[label] += len(word)
        best = max(letters, key=lambda x: (letters[x], -x))
        assert got[k] == (model.languages[best], letters[best] / sum(letters.values()))


def word_score(model, word):
    data = np.frombuffer(word, np.uint8)
    lower = word.lower() if word.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in word)
    edged = b"\0" + lower + b"\0"
    keys = [edged[i] * 256 + edged[i + 1] + (1 << 32) for i in range(len(edged) - 1)]
    keys += [edged[i] * 65536 + edged[i + 1] * 256 + edged[i + 2] + (1 << 41) for i in range(len(edged) - 2)]
    keys.append(int(words_of(data, np.array([0, len(data)]), language.LETTERS).hashes[0]))
    sums = np.zeros(len(model.languages))
    for feature in (mix(np.array(keys, np.uint64)) % np.uint64(language.FEATURES)).astype(int):
        sums += model.ratios[feature]
    sums = np.clip(sums, -language.CLIP, language.CLIP)
    first = next((c for c in word.decode() if c > "\x7f"), "a")
    script = [number for start, number in language._SCRIPTS if start <= ord(first)][-1]
    if model.allowed[script].any():
        sums[~model.allowed[script]] -= language.FOREIGN
    return sums


def test_held_out_accuracy_and_letterless_texts(spark, documents):
    found = op1_language(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    assert held.count() > 30 and held.where("lang_pred = lang").count() >= 0.97 * held.count()
    assert found.where("score < 0 OR score > 1").count() == 0
    model = language.learn(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    odd = documents((1, None), (2, ""), (3, "12 ** 3 × ∞"), (4, "漢字"), (4, "漢字"), (5, "the and of " * 30_000))
    got = {(r.doc_id, r.lang_pred) for r in language.identify(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "en")} <= got and (4, "und") not in got
    assert language.identify(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.learn(odd.where("false"))).collect()} == {"und"}


def test_spans_of_mixed_text(spark, documents):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.learn(table)
    parts = [table.where(F.col("lang") == lang).orderBy(F.desc("n_chars")).first().text[:600].rsplit(" ", 1)[0] for lang in ("en", "de", "fr")]
    text = " ".join(parts)
    spans = language.identify(documents((1, text)), model, with_spans=True).first().lang_spans
    assert [s.lang for s in spans] == ["en", "de", "fr"]
    assert abs(spans[1].start - len(parts[0])) < 40 and abs(spans[2].start - len(parts[0]) - len(parts[1])) < 40


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda x: (x[1], x[0]))


def test_base_spans_equal_the_patterns():
    draw = random.Random(3)
    for _ in range(30_000):
        text = "".join(draw.choice("aé.@@-+% 0123456789..  ()") for _ in range(draw.randint(0, 40)))
        assert personal.base_spans(text) == base(text), text
    for long in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" + "(" * 200_000):
        personal.base_spans(long)


def test_personal_data_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in op4_personal_data(spark, FOLDER).collect():
        want = base(texts[row.doc_id])
        assert [row[f"n_{k}"] for k in personal.KINDS] == [sum(x[0] == k for x in want) for k in range(4)]
        listed = [f"{personal.KINDS[k]}:{s}:{e}" for k, s, e in want]
        assert set(listed) <= set(filter(None, row.spans.split(",")))


def test_field_carries_labels_to_repeated_forms(spark, documents):
    texts = [f"mail user{k}.x@mail.com or +1 555 {k:03d} 4567 now 10.0.0.{k}, again user{k}.x@mail.com or +1555{k:03d}4567 with {k} and {k} from 10.0.0.{k}, by 4111111111111111 or 4111111111111111" for k in range(60)]
    field = personal.learn(documents(*enumerate(texts)))
    odd = documents((1, "call +1 555 123 4567 é and later 15551234567, bob.x@mail.com then bob.x@localhost"), (2, None), (3, ""), (4, "nothing 42 here"))
    found = {r.doc_id: r.pii_spans for r in personal.find(odd, field).collect()}
    assert [(s.kind, s.base) for s in found[1]] == [("phone", True), ("phone", False), ("email", True), ("email", False)]
    assert found[2] == found[3] == found[4] == []
    masked = {r.doc_id: r.text for r in personal.mask(odd, field).collect()}
    assert masked[1] == "call <PHONE> é and later <PHONE>, <EMAIL> then <EMAIL>"
    assert masked[2] is None and masked[4] == "nothing 42 here"
    assert personal.find(odd.limit(0), field).count() == 0


def test_beliefs_on_a_tree_are_exact():
    draw = np.random.default_rng(4)
    labels = personal.LABELS
    pair = lambda: (lambda m: m + m.T)(draw.normal(size=(labels, labels)))
    field = personal.Field(draw.normal(size=(3, labels)), pair(), pair())
    shapes, observed = np.array([0, 1, 2]), np.array([-1, 2, -1])
    got = personal.beliefs(field, shapes, observed, np.array([[0, 1]]), np.array([[1, 2]]))
    weights = np.zeros((labels,) * 3)
    for a in range(labels):
        for c in range(labels):
            weights[a, 2, c] = math.exp(field.shape[0, a] + field.shape[2, c] + field.chain[a, 2] + field.skip[2, c])
    weights /= weights.sum()
    assert np.allclose(got[0], weights.sum(axis=(1, 2))) and np.allclose(got[2], weights.sum(axis=(0, 1)))


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def brute_katz(docs, train, listed):
    uni, bi, total = Counter(), Counter(), Counter()
    for key, text in docs:
        if train(key):
            words = tokens(text)
            uni.update(words)
            bi.update(zip(["<s>", *words[:-1]], words, strict=True))
            total.update(["<s>", *words[:-1]])
    n, v = sum(uni.values()), len(uni)
    rare = (n - sum(uni[w] for w in listed) + 1) / (n + 1) / (v - len(listed) + 1)
    probability = lambda w: uni[w] / (n + 1) if w in listed else rare
    counts = Counter(bi.values())
    d = dict.fromkeys(range(1, 6), 1.0)
    if all(counts[r] for r in range(1, 7)):
        a = 6 * counts[6] / counts[1]
        d = {r: min(1, max(0.05, ((r + 1) * counts[r + 1] / (r * counts[r]) - a) / (1 - a) if a < 1 else 1)) for r in d}
    used, covered = defaultdict(float), defaultdict(float)
    for (h, w), c in bi.items():
        used[h] += c * d.get(c, 1)
        covered[h] += probability(w)
    bases = {h: c + (used[h] > c - 1e-9) for h, c in total.items()}

    def p(h, w):
        if bi[h, w]:
            return bi[h, w] * d.get(bi[h, w], 1) / bases[h]
        return (1 - used[h] / bases[h]) / (1 - covered[h]) * probability(w) if h in bases else probability(w)

    # Each history's probabilities, with all words that are not in the vocabulary as one, sum to 1.
    for h in list(bases)[:20]:
        assert abs(sum(p(h, w) for w in uni) + p(h, "never seen") - 1) < 1e-9
    out = []
    for key, text in docs:
        words = tokens(text)
        pairs = list(zip(["<s>", *words[:-1]], words, strict=True))
        out.append((key, len(words), sum(uni[w] > 0 for w in words), sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in words), sum(math.log10(p(*x)) for x in pairs)))
    return out


@pytest.mark.parametrize("shortcut,part_tokens", [(katz.LISTED, katz.PART_TOKENS), (150, 2000)])
def test_katz_scores_equal_brute_force(spark, shortcut, part_tokens):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60").select("doc_id", "text", F.lit(1).alias("score"))
    extra = spark.createDataFrame([(1000, None, 1), (1001, "", 1), (1002, "the " * 3000, 1), (1002, "the " * 3000, 1), (1003, "漢 the\tX", 1)], "doc_id long, text string, score int")
    frame = frame.union(extra)
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    train = lambda k: zlib.crc32(str(k).encode()) % 7 != 2
    scored, unigrams = katz.score(frame, ~language.held_out(F.col("doc_id"), 7, 2), parts=1, shortcut=shortcut, part_tokens=part_tokens)
    want = brute_katz(docs, train, {w for k, t in docs if train(k) for w in tokens(t)})
    rounded = lambda rows: sorted((k, a, b, round(c, 6), round(d, 6)) for k, a, b, c, d in rows)
    assert rounded(bag(scored)) == rounded(want)
    assert bool(unigrams.histories()) == (part_tokens < 10_000)
    spread, _ = katz.score(frame, ~language.held_out(F.col("doc_id"), 7, 2), parts=3, shortcut=shortcut, part_tokens=part_tokens)
    assert [x[:4] for x in rounded(bag(spread))] == [x[:4] for x in rounded(want)]


def test_katz_without_training_or_rows(spark, documents):
    rows = documents((1, "a b"), (2, None))
    scored, unigrams = katz.score(rows, F.lit(False))
    assert unigrams.tokens == 0 and bag(scored) == [(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)]
    assert katz.score(rows.limit(0), F.lit(True))[0].count() == 0


@pytest.mark.parametrize("shortcut", [katz.LISTED, 150])
def test_katz_scores_do_not_depend_on_parts(spark, shortcut):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    one, many = ({r.key: r.score for r in katz.score(frame, F.col("doc_id") % 7 > 0, parts=n, shortcut=shortcut, part_tokens=2000)[0].collect()} for n in (1, 7))
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-6 for k in one)


def test_katz_words_outside_the_list_keep_their_counts(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    frame = frame.union(spark.createDataFrame([(1000, None), (1001, "the " * 3000), (1003, "漢 the\tX")], "doc_id long, text string"))
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    train = lambda k: k % 7 > 0
    words = {w for k, t in docs if train(k) for w in tokens(t)}
    want = {row[0]: row[4] for row in brute_katz(docs, train, words)}
    for shortcut, parts in ((150, 1), (150, 5), (katz.LISTED, 2)):
        scored, unigrams = katz.score(frame, F.col("doc_id") % 7 > 0, parts=parts, part_tokens=2000, shortcut=shortcut)
        got = {r.key: r.score for r in scored.collect()}
        assert (len(unigrams.words) < len(words)) == (shortcut <= 150)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_katz_rows_between_parts_grow_as_the_words_asked_for():
    """A part asks once: its rows are bounded by the slots, and slots by the vocabulary, whatever the number of chunks."""
    unigrams = katz.Unigrams(10, 10, np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 1 << 30)
    data = np.frombuffer(" ".join(f"w{k}" for k in range(2000)).encode(), np.uint8)
    for chunks in (1, 8):
        texts = pa.RecordBatch.from_pydict({"key": [0], "train": [True], "text": [data.tobytes().decode()]})
        rows = [row for _ in range(chunks) for batch in katz._deal(iter([texts]), unigrams, 4, pa.int64()) for row in batch.to_pylist()]
        dealt = pa.RecordBatch.from_pylist(rows)
        held = list(katz._hold(iter([dealt]), unigrams, pa.list_(pa.struct(dealt.schema)), False))
        assert sum(batch.column("part")[0].as_py() >= 0 for batch in held) == 4
        asked = [batch for b in held if b.column("part")[0].as_py() >= 0 for batch in katz._asked(iter([b]), 3)]
        assert sum(batch.num_rows for batch in asked) == 12


@pytest.mark.parametrize("buckets", [2, 20])
def test_katz_with_more_parts_than_buckets(spark, monkeypatch, buckets):
    monkeypatch.setattr(katz, "MOST_BUCKETS", buckets)
    monkeypatch.setattr(katz, "SLOT_WORDS", 100)
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 30").select("doc_id", "text")
    docs = [(r.doc_id, r.text) for r in frame.collect()]
    words = {w for k, t in docs if k % 7 > 0 for w in tokens(t)}
    want = {row[0]: row[4] for row in brute_katz(docs, lambda k: k % 7 > 0, words)}
    scored, _ = katz.score(frame, F.col("doc_id") % 7 > 0, parts=9, part_tokens=2000, shortcut=150)
    got = {r.key: r.score for r in scored.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_evidence_reaches_all_repeats_and_documents_without_patterns(spark, documents):
    texts = [f"mail user{k}.x@mail.com or +1 555 {k:03d} 4567 now 10.0.0.{k}, again user{k}.x@mail.com or +1555{k:03d}4567 with {k} and {k} from 10.0.0.{k}, by 4111111111111111 or 4111111111111111" for k in range(60)]
    field = personal.learn(documents(*enumerate(texts)))
    far = "call +1 555 123 4567 at once " + "and later 15551234567 " * 40
    first = "later 15551234567 " * 40 + "call +1 555 123 4567"
    found = {r.doc_id: r.pii_spans for r in personal.find(documents((1, far), (2, first), (3, "and later 15551234567")), field).collect()}
    assert [len(found[k]) for k in (1, 2, 3)] == [41, 41, 0]
    # What its shape alone makes certain is found with and without a base span elsewhere in the document.
    field.shape[personal._shape("4455")] = np.log([0.01, 0.01, 0.01, 0.01, 0.96])
    spans = {r.doc_id: [s.kind for s in r.pii_spans if not s.base] for r in personal.find(documents((1, "x 4455 y"), (2, "x 4455 y 10.0.0.1")), field).collect()}
    assert spans == {1: ["phone"], 2: ["phone"]}


def test_sums_of_a_part_are_packed():
    texts = [" ".join(f"w{(k * j) % 97}" for j in range(1, 60)) for k in range(2000)]
    batch = pa.record_batch({"key": pa.array(range(2000)), "text": pa.array(texts), "train": pa.array([True] * 2000)})
    words = np.unique(katz._tokens(np.frombuffer("\n".join(texts).encode(), np.uint8), np.array([0, sum(map(len, texts)) + 1999])).word)
    unigrams = katz.Unigrams(120_000, len(words), words, np.full(len(words), 1000), 2000, 1 << 40)
    dealt = [row for made in katz._deal(iter([batch]), unigrams, 4, pa.int64()) for row in made.to_pylist() if row["part"] == 1]
    (found,) = katz._part(dealt, (np.zeros(0, np.uint64), np.zeros(0, np.uint64)), unigrams, np.ones(katz.TOP_R + 2))
    docs = len(katz._unpack(found[3], "<u4"))
    assert docs > 1000 and sum(map(len, found[4:7])) < 12 * docs
