"""Vectorised scanning of whole texts held in Arrow string columns.

A batch is cut into slices of about SLICE bytes along row borders (one very long text is a slice of its own), and each
slice is processed as one byte array: no text becomes a Python string. Words are runs of bytes other than space and
0x09-0x0D. Words, lines and windows are compared by 64-bit hashes; two different ones of one document coincide with a
probability of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
BLOCK = 1 << 18

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
MULT = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(MULT), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


TABLE = mix((np.arange(256, dtype=U) + U(1)) * MULT)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, BLOCK + 1)
        for key, base in (("up", MULT), ("down", INVERSE)):
            x = np.full(n, base, U)
            x[0] = 1
            _powers[key] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


@dataclass
class Slice:
    lo: int  # rows lo to hi of the batch
    hi: int
    data: np.ndarray  # uint8
    offs: np.ndarray  # int64, hi - lo + 1 offsets into data


def slices(col: pa.Array, limit: int = SLICE, rows: int | None = None) -> Iterator[Slice]:
    """Slices of a string column, of at most `rows` texts where that is given; nulls are empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type) or col.null_count:
        col = pc.fill_null(col.cast(pa.string()), "")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + (rows or n))
        yield Slice(lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


def spans(keep: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run never crosses a document's border."""
    n = len(keep)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offs] = True
    edge = keep.copy()
    edge[1:] &= ~keep[:-1] | border[1:n]
    starts = np.flatnonzero(edge)
    edge = keep.copy()
    edge[:-1] &= ~keep[1:] | border[1:n]
    return starts, np.flatnonzero(edge) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of sorted spans that don't overlap."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        part = data[base : ends[j - 1]]
        up, down = _power(len(part) + 1)
        total = np.zeros(len(part) + 1, U)
        np.cumsum(TABLE[part] * up[: len(part)], out=total[1:])
        s = starts[i:j] - base
        out[i:j] = (total[ends[i:j] - base] - total[s]) * down[s]
        i = j
    return mix(out)


def per_doc(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many True values each document has."""
    out = np.zeros(len(offs) - 1, np.int64)
    full = np.flatnonzero(np.diff(offs))
    if len(full):
        out[full] = np.add.reduceat(mask.view(np.uint8), offs[full], dtype=np.int64)
    return out


def count_at(positions: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many of the sorted positions each document has."""
    return np.diff(np.searchsorted(positions, offs))


def window_hashes(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of `size` words within one document, and their first words' positions."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, U), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    total = np.zeros(n, U)
    for k in range(size):
        total = total * MULT + words[k : k + n]
    return mix(total[at]), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """A mask of the keys that occur at least twice."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def later_copies(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document, how many keys equal an earlier one; keys already tell documents apart."""
    order = np.argsort(keys, kind="stable")
    again = order[1:][keys[order[1:]] == keys[order[:-1]]]
    return np.bincount(doc[again], minlength=n_docs)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


SYMBOLS = _class("#*$%&|<>")  # fixed values of the contract
PUNCT = _class(".,;:?\"'()-")
DIGITS = _class("0123456789")
UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
MARKS = _class("!|{}[]=_~^\\/@")
#: Measures of `measure`, all integers.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_punct",
    "n_marks", "n_distinct_words", "n_twice_running", "n_non_ascii",
)


def measure(s: Slice, window: int = 5) -> dict[str, np.ndarray]:
    """The MEASURES of each document of a slice, as int64 arrays; a text without words has zeros."""
    data, offs, n = s.data, s.offs, s.hi - s.lo
    starts, ends = spans(~SPACE[data], offs)
    firsts = np.searchsorted(starts, offs)
    n_words = np.diff(firsts)
    doc = np.repeat(np.arange(n), n_words)
    words = span_hashes(data, starts, ends)
    salt = mix(np.arange(n, dtype=U) + U(7))
    out = {"n_words": n_words}
    out["word_chars"] = per_doc(((data & 0xC0) != 0x80) & ~SPACE[data], offs)
    for name, table in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_digits", DIGITS), ("n_punct", PUNCT), ("n_marks", MARKS)):
        out[name] = per_doc(table[data], offs)
    out["n_non_ascii"] = per_doc(data >= 0xC0, offs)
    at, to = spans(data != 10, offs)
    full = np.searchsorted(starts, to) > np.searchsorted(starts, at)
    at, to = at[full], to[full]
    line_doc = np.searchsorted(offs, at, "right") - 1
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = later_copies(span_hashes(data, at, to) ^ salt[line_doc], line_doc, n)
    keys = words ^ salt[doc]
    order = np.sort(keys)
    out["n_distinct_words"] = n_words.copy()
    if (order[1:] == order[:-1]).any():
        out["n_distinct_words"] -= later_copies(keys, doc, n)
    out["n_twice_running"] = np.bincount(doc[1:][keys[1:] == keys[:-1]], minlength=n) if len(keys) else np.zeros(n, np.int64)
    grams, first = window_hashes(words, doc, window)
    again = first[repeated(grams ^ salt[doc[first]])]
    cover = np.zeros(len(words) + window + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    covered = np.flatnonzero(np.cumsum(cover)[: len(words)] > 0)
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    return {k: np.asarray(out[k], np.int64) for k in MEASURES}


def batches(it: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """Run work(batch) -> batch over a partition."""
    for batch in it:
        if batch.num_rows:
            yield work(batch)
