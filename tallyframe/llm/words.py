"""Words of Arrow text columns as 64-bit hashes, computed for a whole chunk of documents at once.

A word is a run of word bytes of the UTF-8 text; A-Z count as a-z. Two rules are
known: ``SPACED`` (anything but ASCII white space) and ``ALNUM`` (ASCII letters
and digits and everything beyond ASCII). A word's hash is a polynomial of its
bytes, mixed at the end; it is the same on every machine and in every run.
Different words share a hash with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Documents are cut into chunks of about so many bytes, which bounds the arrays of one step; one document is never cut.
CHUNK_BYTES = 4 << 20
#: Words of a chunk are hashed about so many bytes at a time; one word is never cut.
PART_BYTES = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)


def code_table(upto: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for part in upto.split():
        low, _, high = part.partition("-")
        table[int(low, 16) : int(high or low, 16) + 1] = True
    return table


SPACED = ~code_table("09-0D 20")
ALNUM = code_table("30-39 41-5A 61-7A 80-FF")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
_BASE = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """The words of some documents: hash and byte span of each; ``first[d]`` to ``first[d + 1]`` are document d's."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) for runs of whole rows; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    rows = len(column)
    offsets = np.frombuffer(offsets, dtype=np.int64, count=rows + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def words_of(data: np.ndarray, offsets: np.ndarray, rule: np.ndarray) -> Words:
    """The words of the documents that lie at the offsets of the bytes."""
    rows = len(offsets) - 1
    inside = rule[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    opens[heads] = inside[heads]
    start = np.flatnonzero(opens)
    first = np.searchsorted(start, offsets).astype(np.int64)
    if not len(start):
        return Words(np.zeros(0, np.uint64), first, start, start)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | opens[1:]
    end = np.flatnonzero(last) + 1
    lengths = end - start
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
        # A part of the words at a time, so that numbers for each byte are few.
        parts = np.unique(np.append(np.searchsorted(start, np.arange(0, len(data), PART_BYTES)), len(start)))
        hashes = [_polynomials(data[start[a] : end[b - 1]], inside[start[a] : end[b - 1]], lengths[a:b], powers) for a, b in zip(parts, parts[1:], strict=False)]
    return Words(mix(np.concatenate(hashes)), first, start, end)


def _polynomials(data: np.ndarray, inside: np.ndarray, lengths: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """For words in turn, the sum of their bytes' numbers times powers of the base."""
    letters = _BYTE[_LOWER[data[inside]]]
    begin = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(begin, lengths)
    return np.add.reduceat(letters * powers[place], begin)


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of so many neighbouring words."""
    many = len(hashes) - size + 1
    if many <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(many, np.uint64(size) * _STEP)
        for k in range(size):
            total = (total + hashes[k : k + many]) * _BASE
            total ^= total >> np.uint64(29)
    return mix(total)


def ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All the numbers of the ranges that begin at ``start`` and hold ``many`` numbers."""
    total = int(many.sum())
    return np.repeat(start - (np.cumsum(many) - many), many) + np.arange(total)
