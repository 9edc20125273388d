"""Language identification: scripts narrow the candidates, per-word scores and a Viterbi path label the words.

Learning takes a bounded sample of labelled rows (about ``SAMPLE_ROWS`` of each language, chosen by hash, all rows of a rarer one) and counts, for each
language, hashed features of its words: the word itself, its letter pairs and triples with the word's edges. The model is a table of
``FEATURES`` x languages of log ratios, and the scripts that each language was seen in; its size does not depend on the corpus.

A word's score for a language is the sum of its features' log ratios, held within ``CLIP``; languages that do not use the
word's script get a penalty. The best path over the words pays ``SWITCH`` for each change of language. The path's runs
are the spans of a text; the language with most letters is the text's, and its share of the letters the score.

The path is computed for all texts of a chunk side by side, in memory that grows with words x languages. Texts of more than ``BLOCK`` words are cut
into blocks; each is solved for every language that it may start in, and the blocks of a text are chained; the result is that of one pass over the whole text.

Cases: texts that are NULL or without letters are ``und`` with score 0 and no spans. Letters of scripts that no language was
seen in still give the best-scoring language. Ties go to the first language in string order. Without labelled rows every text is ``und``. Only the
text is an input of a prediction; columns of other names pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.sampling import sample_texts
from tallyframe.llm.words import code_table, mix, text_chunks, words_of
from tallyframe.llm.workers import lean

SAMPLE_ROWS = 1000
FEATURES = 1 << 17
CLIP = 6.0
SWITCH = 8.0
FOREIGN = 12.0
BLOCK = 1024
#: Bytes of the texts whose words are in memory at once, of those to learn from and of those to label. Learning takes up to some 250 bytes for each, labelling some 60.
LEARNED, LABELLED = 1 << 19, 2 << 20
#: Distinct words that are scored at once.
WORDS = 1 << 16
#: A language uses a script in which at least this share of its letters was seen.
SCRIPT_SHARE = 0.02

#: Bytes of letters: ASCII letters and everything beyond ASCII.
LETTERS = code_table("41-5A 61-7A 80-FF")

#: First code points of the script ranges, and the script of each range (0: none in particular).
_SCRIPTS = (
    (0x0000, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0E00, 9),
    (0x0E80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 12), (0x3100, 0), (0x3400, 13), (0xA000, 0),
    (0xAC00, 11), (0xD7B0, 0), (0xF900, 13), (0xFB00, 0), (0x20000, 13), (0x30000, 0),
)
_RANGE_STARTS = np.array([start for start, _ in _SCRIPTS])
_RANGE_SCRIPT = np.array([script for _, script in _SCRIPTS])


@dataclass
class Model:
    languages: list[str]
    ratios: np.ndarray
    allowed: np.ndarray


def _scripts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The script of each word: that of its first character beyond ASCII, or Latin."""
    high = np.flatnonzero(data >= 0xC0)
    out = np.ones(len(start), np.int64)
    if not len(high):
        return out
    at = np.searchsorted(high, start)
    has = (at < len(high)) & (high[np.minimum(at, len(high) - 1)] < end)
    lead = high[at[has]]
    more = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 63 for k in (1, 2, 3)]
    head = data[lead].astype(np.int64)
    two, three = (head & 31) << 6 | more[0], (head & 15) << 12 | more[0] << 6 | more[1]
    four = (head & 7) << 18 | more[0] << 12 | more[1] << 6 | more[2]
    code = np.where(head < 0xE0, two, np.where(head < 0xF0, three, four))
    out[has] = _RANGE_SCRIPT[np.searchsorted(_RANGE_STARTS, code, side="right") - 1]
    return out


def _features(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word) pairs of the words at the spans: byte pairs and triples within word edges, and the word itself."""
    lower = data.copy()
    lower[(data >= 65) & (data <= 90)] += 32
    size = end - start + 2
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(start)), size)
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    edge = (place == 0) | (place == size[word] - 1)
    code = np.where(edge, 0, lower[np.clip(start[word] + place - 1, 0, max(0, len(data) - 1))]).astype(np.uint64)
    pair = place <= size[word] - 2
    triple = place <= size[word] - 3
    two = code[:-1] * np.uint64(256) + code[1:] + np.uint64(1 << 32)
    three = two[:-1] * np.uint64(256) + code[2:] + np.uint64(1 << 40)
    keys = [two[pair[:-1]], three[triple[:-2]], hashes]
    owner = [word[:-1][pair[:-1]], word[:-2][triple[:-2]], np.arange(len(start))]
    return (mix(np.concatenate(keys)) % np.uint64(FEATURES)).astype(np.int64), np.concatenate(owner)


def _count(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    """Feature counts of the texts of each language; scripts are counted above the features."""
    number = {name: k for k, name in enumerate(languages)}
    for batch in batches:
        language = np.array([number[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
        keys, sums = np.zeros(0, np.int64), np.zeros(0)
        for row, data, offsets in text_chunks(batch.column("text"), LEARNED):
            words = words_of(data, offsets, LETTERS)
            if not len(words.hashes):
                continue
            owner = language[row + words.owner()]
            script = (FEATURES + _scripts(data, words.start, words.end)) * len(languages) + owner
            # A word's features are found once for each language that has it in the chunk.
            _, which = np.unique(words.hashes, return_inverse=True)
            _, one, times = np.unique(which * len(languages) + owner, return_index=True, return_counts=True)
            feature, word = _features(data, words.start[one], words.end[one], words.hashes[one])
            added = np.concatenate([keys, feature * len(languages) + owner[one][word], script])
            many = np.concatenate([sums, times[word], words.end - words.start])
            keys, place = np.unique(added, return_inverse=True)
            sums = np.bincount(place, weights=many)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums.astype(np.int64))], names=["key", "n"])


def learn(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from (text, lang) rows; rows without a language or text teach nothing."""
    sample = sample_texts(labelled.select("text", "lang").where(F.col("lang").isNotNull()), sample_rows, "lang")
    languages = sorted(row[0] for row in sample.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros((14, 0), bool))
    counts = sample.mapInArrow(lean(lambda batches: _count(batches, languages)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((FEATURES + 14, len(languages)))
    table.ravel()[counts.column("key").to_numpy()] = counts.column("n").to_numpy()
    seen, scripts = table[:FEATURES], table[FEATURES:]
    shares = np.log((seen + 0.5) / (seen.sum(axis=0) + 0.5 * FEATURES))
    ratios = (shares - shares.mean(axis=1, keepdims=True)) * (seen.sum(axis=1, keepdims=True) > 0)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    return Model(languages, ratios.astype(np.float32), allowed)


def _word_scores(model: Model, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A row of scores for each word; equal words are scored once."""
    _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    parts = [_distinct_scores(model, data, start[some], end[some], hashes[some]) for some in np.split(one, range(WORDS, len(one), WORDS))]
    return np.concatenate(parts)[which]


def _distinct_scores(model: Model, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    feature, word = _features(data, start, end, hashes)
    scores = np.stack([np.bincount(word, weights=model.ratios[feature, k], minlength=len(hashes)) for k in range(len(model.languages))], axis=1)
    scores = np.clip(scores, -CLIP, CLIP)
    allowed = model.allowed[_scripts(data, start, end)]
    scores -= FOREIGN * (~allowed & allowed.any(axis=1, keepdims=True))
    return scores.astype(np.float32)


def _forward(scores: np.ndarray, begin: np.ndarray, live: list[int], value: np.ndarray, switch: float, keep: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Moves ``value`` (rows x labels) over the rows' words, longest row first: ``live`` has how many rows reach each step.

    All switches cost the same, so a label is reached from itself or from the row's best one. With ``keep`` the best label of each step and row is
    returned, and one bit for each label: whether it was reached from the best one.
    """
    tops, moves = [], []
    for t, n in enumerate(live):
        now = value[:n]
        top = now.argmax(axis=1)
        turned = np.take_along_axis(now, top[:, None], axis=1) - switch
        if keep:
            tops.append(top.astype(np.int32))
            moves.append(np.packbits(turned > now, axis=1))
        np.maximum(now, turned, out=now)
        now += scores[begin[:n] + t]
    return tops, moves


def _live(size: np.ndarray) -> list[int]:
    """How many of the rows, longest first, have a word at each step."""
    return np.searchsorted(-size, -np.arange(int(size.max(initial=0)))).tolist()


def best_path(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH, block: int = BLOCK) -> np.ndarray:
    """The label of each word on the best path of its text; ``first`` has the texts' word ranges."""
    words, labels = scores.shape
    counts = np.diff(first)
    blocks = -(-counts // block)
    head = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(counts)), blocks)
    path = np.zeros(words, np.int64)
    if not len(owner):
        return path
    begin = first[owner] + (np.arange(len(owner)) - head[owner]) * block
    size = np.minimum(block, first[owner + 1] - begin)
    order = np.argsort(-size, kind="stable")
    start = np.zeros((len(owner), labels))  # entering a text costs nothing, whatever the label
    leave = np.full(len(owner), -1)
    cut = np.flatnonzero(blocks > 1)
    if len(cut):
        # ends[b, s, l]: best of a block that enters it in s and leaves it in l, for blocks of texts that are cut.
        mine = order[blocks[owner[order]] > 1]
        ends = np.full((len(mine), labels, labels), -np.inf)
        ends[:, np.arange(labels), np.arange(labels)] = 0
        live = [n * labels for n in _live(size[mine])]
        _forward(scores, np.repeat(begin[mine], labels), live, ends.reshape(-1, labels), switch, False)
        place = np.zeros(len(owner), np.int64)
        place[mine] = np.arange(len(mine))
        # Chain the blocks of each text: total[d, l], best until now; the entry state of each block is kept.
        total = np.zeros((len(counts), labels))
        entry = np.zeros((len(owner), labels), np.int64)
        for k in range(int(blocks.max())):
            docs = cut[blocks[cut] > k]
            joined = total[docs][:, :, None] + ends[place[head[docs] + k]]
            entry[head[docs] + k] = joined.argmax(axis=1)
            total[docs] = joined.max(axis=1)
        state = total.argmax(axis=1)
        for k in reversed(range(int(blocks.max()))):
            docs = cut[blocks[cut] > k]
            leave[head[docs] + k] = state[docs]
            state[docs] = entry[head[docs] + k, state[docs]]
            start[head[docs] + k] = -np.inf
            start[head[docs] + k, state[docs]] = 0
    begin, value, leave = begin[order], start[order], leave[order]
    live = _live(size[order])
    tops, moves = _forward(scores, begin, live, value, switch, True)
    state = np.where(leave >= 0, leave, value.argmax(axis=1))
    for t in reversed(range(len(live))):
        n = live[t]
        now = state[:n]
        path[begin[:n] + t] = now
        moved = moves[t][np.arange(n), now >> 3] >> (7 - (now & 7)) & 1
        state[:n] = np.where(moved == 1, tops[t], now)
    return path


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _label(batch: pa.RecordBatch, text: str, model: Model, with_spans: bool) -> tuple[list, list, list]:
    column = batch.column(batch.schema.names.index(text))
    languages, names, shares, spans = model.languages, [], [], []
    for row, data, offsets in text_chunks(column, LABELLED):
        words = words_of(data, offsets, LETTERS)
        docs = len(offsets) - 1
        if not languages or not len(words.hashes):
            path, letters = np.zeros(0, np.int64), np.zeros((docs, max(1, len(languages))))
        else:
            scores = _word_scores(model, data, words.start, words.end, words.hashes)
            path = best_path(scores, words.first)
            at = words.owner() * len(languages) + path
            letters = np.bincount(at, weights=words.end - words.start, minlength=docs * len(languages)).reshape(docs, -1)
        best, sums = letters.argmax(axis=1), letters.sum(axis=1)
        ascii_letter = np.append(0, np.cumsum(LETTERS[data] & (data < 128)))
        plain = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
        for d in range(docs):
            known = bool(languages) and sums[d] > 0 and (plain[d] or _has_letter(column[row + d].as_py()))
            names.append(languages[best[d]] if known else "und")
            shares.append(float(letters[d, best[d]] / sums[d]) if known else 0.0)
            if with_spans:
                one = slice(words.first[d], words.first[d + 1])
                spans.append(_spans(data, int(offsets[d]), words.start[one], words.end[one], path[one], languages) if known else [])
    return names, shares, spans


def _spans(data: np.ndarray, origin: int, start: np.ndarray, end: np.ndarray, path: np.ndarray, languages: list[str]) -> list[dict]:
    """Runs of one label as code points of the text, end exclusive."""
    edges = np.append(np.flatnonzero(np.append(True, path[1:] != path[:-1])), len(path))
    points = np.cumsum((data[origin : int(end[-1])] & 0xC0) != 0x80)
    before = lambda at: int(points[at - origin - 1]) if at > origin else 0
    return [{"start": before(int(start[a])), "end": before(int(end[b - 1])), "lang": languages[path[a]]} for a, b in zip(edges, edges[1:], strict=False)]


def identify(documents: DataFrame, model: Model, text: str = "text", with_spans: bool = False) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, and on request ``lang_spans``; they replace columns of those names."""
    added = ["lang_pred", "score"] + ["lang_spans"] * with_spans
    kept = documents.drop(*added)
    schema = _schema(kept, with_spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            names, shares, spans = _label(batch, text, model, with_spans)
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(shares, pa.float64())] + [pa.array(spans, spans_type)] * with_spans
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    return kept.mapInArrow(lean(run), schema)


def _schema(kept: DataFrame, with_spans: bool) -> str:
    fields = ", ".join(f"`{name}` {kind}" for name, kind in kept.dtypes) + ", lang_pred string, score double"
    return fields + ", lang_spans array<struct<start: long, end: long, lang: string>>" * with_spans


def held_out(key: Column, of: int, at: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder."""
    return F.coalesce(F.crc32(key.cast("string")) % of == at, F.lit(False))
