"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans (emails, IP addresses, card and phone numbers); they always stay. Tokens that hold a digit,
``@`` or ``+`` are the nodes of a field for each document: neighbouring nodes share chain potentials, and
nodes of one normal form (the same digits, the same local part, or the same letters) share skip potentials
however far apart they are. Each occurrence is linked to the one before it and to the first observed one of its form, so a form that occurs n times
has less than 2 n links and evidence does not fade with the distance; messages are passed on until they settle. Nodes in a base span are observed. Loopy message passing
gives each other node a belief; a label of at least ``CERTAIN`` becomes an added span, unless it touches a base span. A document without
base spans is judged the same way. A round passes on only what changed; from ``DAMPED`` rounds on steps are halved, and a document whose loops still do not settle
stops after four rounds a node (and ``DAMPED``).

Node potentials are label shares by shape of the token, chain and skip potentials the ratios of label pairs to
chance. They are counted on a bounded sample (about ``SAMPLE_ROWS``, chosen by hash) that
the patterns label. Rounds run over all documents of a chunk at once, and over each document by itself, since documents share no link.

Cases: NULL and empty texts have no spans. Places are code points, the end exclusive. Very long runs without white space cost linear time. Repeated
rows are judged alike. An empty table gives no rows and an even model. Only the text is read; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.sampling import sample_texts
from tallyframe.llm.words import SPACED, code_table, text_chunks
from tallyframe.llm.workers import lean

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
SAMPLE_ROWS = 5000
#: Messages that change less have settled.
SETTLED = 1e-6
DAMPED = 64
CERTAIN = 0.9
#: Buckets of token shapes.
SHAPES = 4096

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Possessive, and never begun inside a run of digits: a run that fails as a whole fails from each of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SIGNS = code_table("30-39 40 2B")
_EDGES = ".,;:!?()[]{}<>\"'*#|&$%"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            done = found.end()
            yield start, done
        at += 1


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def _luhn(digits: list[int]) -> bool:
    return (sum(digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, in order of start and kind."""
    found = [(0, *span) for span in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda x: (x[1], x[0]))


@dataclass
class Nodes:
    """The tokens of one document, base spans as one token each: span, last word's number, shape, normal form, and the observed label (-1: none)."""

    start: list[int]
    end: list[int]
    place: list[int]
    shape: list[int]
    form: list[str]
    label: list[int]


def _shape(token: str) -> int:
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    signs = (token.count("."), token.count("-"), token.count("@"), token.count("+"))
    code = 0
    for value, size in zip((min(digits, 20) // 2, min(letters, 3), *(min(s, 2) for s in signs)), (11, 4, 3, 3, 3, 3), strict=True):
        code = code * size + value
    return code % SHAPES


def _form(token: str) -> str:
    if "@" in token:
        return "@" + token.partition("@")[0].lower()
    digits = "".join(c for c in token if "0" <= c <= "9")
    return digits if len(digits) >= 7 else "=" + token.lower()


def _nodes(text: str, spans: list[tuple[int, int, int]], tokens: list[tuple[int, int, int]]) -> Nodes:
    nodes = Nodes([], [], [], [], [], [])
    k = 0
    for start, end, place in tokens:
        while start < end and text[start] in _EDGES:
            start += 1
        while start < end and text[end - 1] in _EDGES:
            end -= 1
        if start == end:
            continue
        while k < len(spans) and spans[k][2] <= start:
            k += 1
        inside, start, end = next(((kind, s, e) for kind, s, e in spans[k : k + 4] if s < end and e > start), (-1, start, end))
        if inside >= 0 and nodes.start and nodes.start[-1] == start and nodes.end[-1] == end:
            nodes.place[-1] = place  # one more word of the same base span
            continue
        token = text[start:end]
        nodes.start.append(start)
        nodes.end.append(end)
        nodes.place.append(place)
        nodes.shape.append(_shape(token))
        nodes.form.append(_form(token))
        nodes.label.append(inside + 1 if inside >= 0 else -1)
    return nodes


def _documents(column: pa.Array) -> Iterator[tuple[int, str, list[tuple[int, int, int]], Nodes]]:
    """(row, text, base spans, nodes) of the rows with a digit or an ``@``."""
    for row, data, offsets in text_chunks(column):
        signs = np.flatnonzero(_SIGNS[data])
        if not len(signs):
            continue
        inside = SPACED[data]
        opens = inside & np.append(True, ~inside[:-1])
        opens[offsets[:-1][offsets[:-1] < len(data)]] |= inside[offsets[:-1][offsets[:-1] < len(data)]]
        starts = np.flatnonzero(opens)
        closes = np.append(np.flatnonzero(~inside), len(data))
        word = np.unique(np.searchsorted(starts, signs, side="right") - 1)
        begin = starts[word]
        owner = np.searchsorted(offsets, begin, side="right") - 1
        stop = np.minimum(closes[np.searchsorted(closes, begin)], offsets[owner + 1])
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        origin = points[offsets[owner]]
        begin, stop = points[begin] - origin, points[stop] - origin
        edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(owner)), strict=True):
            text = column[row + int(owner[a])].as_py()
            spans = base_spans(text)
            tokens = list(zip(begin[a:b].tolist(), stop[a:b].tolist(), word[a:b].tolist(), strict=True))
            yield row + int(owner[a]), text, spans, _nodes(text, spans, tokens)


def _links(nodes: Nodes, base: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain links between neighbouring words; skip links of each occurrence of a form to the one before it and to the form's first observed one."""
    chain, skip = [], []
    last: dict[str, int] = {}
    hub: dict[str, int] = {}
    before: dict[str, list[int]] = {}
    for k, form in enumerate(nodes.form):
        if k and nodes.place[k] == nodes.place[k - 1] + 1:
            chain.append((base + k - 1, base + k))
        if form in last:
            skip.append((base + last[form], base + k))
            if form in hub and last[form] != hub[form]:
                skip.append((base + hub[form], base + k))
        last[form] = k
        if nodes.label[k] >= 0 and form not in hub:
            hub[form] = k
            skip += [(base + j, base + k) for j in before.get(form, ())[:-1]]
        if form not in hub:
            before.setdefault(form, []).append(k)
    return chain, skip


@dataclass
class Field:
    """Log potentials: of a label by shape, of label pairs on chain links, and on skip links."""

    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def learn(documents: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Field:
    """Potentials from a bounded sample that the patterns label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = np.zeros((SHAPES + 2 * LABELS, LABELS), np.int64)
            for _, _, _, nodes in _documents(batch.column(0)):
                label = np.maximum(nodes.label, 0)
                np.add.at(tables, (np.array(nodes.shape, np.int64), label), 1)
                for which, links in enumerate(_links(nodes, 0)):
                    for a, b in links:
                        tables[SHAPES + which * LABELS + label[a], label[b]] += 1
                        tables[SHAPES + which * LABELS + label[b], label[a]] += 1
            at = np.flatnonzero(tables)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(tables.ravel()[at])], names=["at", "n"])

    sample = sample_texts(documents.select(F.col(text).alias("text")), sample_rows)
    counted = sample.mapInArrow(lean(count), "at long, n long").groupBy("at").agg(F.sum("n")).collect()
    tables = np.zeros((SHAPES + 2 * LABELS, LABELS))
    for at, n in counted:
        tables.ravel()[at] = n
    shape = tables[:SHAPES] + 0.5
    pairs = [np.log(t / t.sum()) - np.log(t.sum(axis=1) / t.sum())[:, None] - np.log(t.sum(axis=0) / t.sum())[None, :] for t in (tables[SHAPES : SHAPES + LABELS] + 0.5, tables[SHAPES + LABELS :] + 0.5)]
    return Field(np.log(shape / shape.sum(axis=1, keepdims=True)), *pairs)


def beliefs(field: Field, shapes: np.ndarray, labels: np.ndarray, chain: np.ndarray, skip: np.ndarray, members: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of each node by loopy sum-product message passing; observed nodes keep their label. ``members``: for each node the nodes of its document."""
    own = field.shape[shapes].copy()
    seen = np.flatnonzero(labels >= 0)
    own[seen] = -60.0
    own[seen, labels[seen]] = 0.0
    source = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
    target = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
    half = len(chain) + len(skip)
    back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
    # Both pair tables are symmetric.
    weights = np.exp(np.stack([field.chain, field.skip]))
    kind = np.tile(np.repeat([0, 1], [len(chain), len(skip)]), 2)
    limit = DAMPED + 4 * (np.full(len(shapes), len(shapes)) if members is None else members)[source]
    order = np.argsort(source, kind="stable")
    heads = np.searchsorted(source[order], np.arange(len(shapes) + 1))
    messages = np.zeros((2 * half, own.shape[1]))
    gathered = own.copy()
    active = np.arange(2 * half)
    turn = 0
    while len(active):
        cavity = gathered[source[active]] - messages[back[active]]
        cavity = np.exp(cavity - cavity.max(axis=1, keepdims=True))
        sent = np.empty_like(cavity)
        for k in (0, 1):
            own_kind = kind[active] == k
            sent[own_kind] = np.log(cavity[own_kind] @ weights[k] + 1e-300)
        step = sent - sent.max(axis=1, keepdims=True) - messages[active]
        moved = np.abs(step).max(axis=1) > SETTLED
        active, step = active[moved], step[moved] * (0.5 if turn >= DAMPED else 1.0)
        messages[active] += step
        np.add.at(gathered, target[active], step)
        # Next come the messages out of nodes that were told something new, and those still on their way.
        nodes = np.unique(target[active])
        many = heads[nodes + 1] - heads[nodes]
        told = order[np.repeat(heads[nodes] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        turn += 1
        active = np.union1d(told, active) if turn > DAMPED else np.sort(told)
        active = active[limit[active] > turn]
    np.add.at(own, target, messages)
    own = np.exp(own - own.max(axis=1, keepdims=True))
    return own / own.sum(axis=1, keepdims=True)


def _found(column: pa.Array, field: Field) -> dict[int, list[tuple[int, int, int, bool]]]:
    """All spans of the rows that have any: (kind, start, end, whether it is a base one)."""
    out: dict[int, list[tuple[int, int, int, bool]]] = {}
    shapes: list[int] = []
    labels: list[int] = []
    at: list[tuple[int, int, int]] = []
    members: list[int] = []
    chain: list[tuple[int, int]] = []
    skip: list[tuple[int, int]] = []
    for row, _, spans, nodes in _documents(column):
        if spans:
            out[row] = [(kind, start, end, True) for kind, start, end in spans]
        new_chain, new_skip = _links(nodes, len(shapes))
        chain += new_chain
        skip += new_skip
        shapes += nodes.shape
        labels += nodes.label
        members += [len(nodes.shape)] * len(nodes.shape)
        at += [(row, s, e) for s, e in zip(nodes.start, nodes.end, strict=True)]
    if shapes:
        pairs = [np.array(links, np.int64).reshape(-1, 2) for links in (chain, skip)]
        belief = beliefs(field, np.array(shapes), np.array(labels), *pairs, np.array(members))
        best = belief.argmax(axis=1)
        for k in np.flatnonzero((np.array(labels) < 0) & (best > 0) & (belief.max(axis=1) >= CERTAIN)):
            out.setdefault(at[k][0], []).append((int(best[k]) - 1, at[k][1], at[k][2], False))
    for row, spans in out.items():
        spans.sort(key=lambda x: (x[1], x[0]))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find(documents: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The documents with ``pii_spans``, an array of (kind, start, end, base)."""
    kept = documents.drop("pii_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _found(batch.column(batch.schema.names.index(text)), field)
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in found.get(row, ())] for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _SPANS)], names=[*batch.schema.names, "pii_spans"])

    return kept.mapInArrow(lean(run), _schema(kept, "pii_spans array<struct<kind: string, start: long, end: long, base: boolean>>"))


def mask(documents: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The documents with each span of the text replaced by its kind in angle brackets; overlapping spans are replaced together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text)
            column = batch.column(at)
            texts = None
            for row, spans in _found(column, field).items():
                texts = column.to_pylist() if texts is None else texts
                texts[row] = _masked(texts[row], spans)
            columns = list(batch.columns)
            columns[at] = column if texts is None else pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return documents.mapInArrow(lean(run), _schema(documents))


def _masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    parts, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _schema(frame: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in frame.dtypes), *more])
