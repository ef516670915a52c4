"""Runs of repeated words, found by a suffix automaton.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping q, of at least LEAST words and
TIMES periods. Words are the runs of characters other than space and 0x09-0x0D, compared by 64-bit hashes within a text.

The automaton of a stretch of words has a state for each set of substrings with the same end positions. The ordered sets of
end positions are merged from the longest states to the shortest, the smaller into the larger. Where an end position gets a
new neighbour at a distance d that doesn't exceed the state's length, the words before both are equal for at least d
words: a square of period d, the seed of a run. Seeds are extended to both sides. In a run, the first of the root's occurrences
are neighbours in their state, as a primitive root occurs in its powers at multiples of its length only, so every run has a
seed. Of runs with the same ends the one with the smallest period is kept: neighbours that a later merge separates may give
a multiple of it.

Automata are built only for stretches that can hold a run, and that loses none: in a run of period q, each window of four
words but those of the first period occurs again q words earlier. So for each power of two K there must be a stretch of
windows, as long as the runs of periods above K / 2 make it, whose distance to their last occurrence is K at most. These
distances come from one sort of all windows of a slice of texts. Prose has next to no such stretches.

Memory: an automaton takes about 500 bytes a word of its stretch. Stretches beyond WINDOW words are cut into windows that
overlap by half, of WINDOW words for periods up to a quarter of it, and of four times the level's K for longer ones, so that
memory grows with the periods that a text may hold, not with its length.

Defined results: null and empty texts have no words, no runs, null run columns and the hashes of empty texts; repeated
rows get equal results, an empty table none; a null id keeps its text as it is; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from groundplan.llm import textscan
from groundplan.llm.frames import as_text, key_name, map_arrow, position
from groundplan.llm.textscan import U, mix

LEAST = 6
TIMES = 4
GRAM = 4
WINDOW = 1 << 17
FAR = 1 << 62


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lengths and suffix links of the states of words' suffix automaton, and the prefix (its end position) of each or 0."""
    length, link, end, step = [0], [-1], [0], [{}]
    last = 0
    for i, word in enumerate(words, 1):
        new = len(length)
        length.append(i)
        end.append(i)
        step.append({})
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at < 0:
            link.append(0)
        else:
            to = step[at][word]
            if length[to] == length[at] + 1:
                link.append(to)
            else:
                link.append(new + 1)
                length.append(length[at] + 1)
                end.append(0)
                step.append(step[to].copy())
                link.append(link[to])
                link[to] = new + 1
                while at >= 0 and step[at].get(word) == to:
                    step[at][word] = new + 1
                    at = link[at]
        last = new
    return length, link, end


def seeds(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(d, lo, hi): words lo to hi have the period d, and there are at least 2 * d of them."""
    length, link, end = automaton(words)
    ends: list[list[int] | None] = [[e] if e else None for e in end]
    for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
        up = link[state]
        few, ends[state] = ends[state], None
        if not up:
            continue
        many = ends[up]
        if many is None:
            ends[up] = few
            continue
        if len(many) < len(few):
            few, many = many, few
        long = length[up]
        for e in few:
            at = bisect_left(many, e)
            if at and e - many[at - 1] <= long:
                yield e - many[at - 1], many[at - 1] - long, e
            if at < len(many) and many[at] - e <= long:
                yield many[at] - e, e - long, many[at]
            many.insert(at, e)
        ends[up] = many


def _same(words: np.ndarray, d: int, at: int, way: int) -> int:
    """How many words from `at` on, in the direction `way`, equal the word d to their left."""
    n, size = 0, 32
    while True:
        lo, hi = (at + n, min(at + n + size, len(words))) if way > 0 else (max(at - n - size + 1, d), at - n + 1)
        if lo >= hi:
            return n
        same = words[lo:hi] == words[lo - d : hi - d]
        if not same.all():
            return n + int((~same if way > 0 else ~same[::-1]).argmax())
        n, size = n + hi - lo, size * 2


def runs_within(words: np.ndarray, stretches: list[tuple[int, int]], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of words that have two periods in one of the stretches, in order."""
    known: dict[int, list[tuple[int, int]]] = {}
    for lo, hi in stretches:
        _, codes = np.unique(words[lo:hi], return_inverse=True)
        for d, a, b in seeds(codes.tolist()):
            a, b = a + lo, b + lo
            if any(x <= a and b <= y for x, y in reversed(known.get(d, ()))):
                continue
            first = a - _same(words, d, a + d - 1, -1)
            known.setdefault(d, []).append((first, b + _same(words, d, b, 1)))
    period: dict[tuple[int, int], int] = {}
    for d in sorted(known):
        for a, b in known[d]:
            if b - a >= max(least, times * d):
                period.setdefault((a, b), d)
    return sorted((a, b - a, d) for (a, b), d in period.items())


def stretches(words: np.ndarray, doc: np.ndarray, firsts: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """For the texts of a slice that may hold runs: stretches of their words, each to be searched at once.

    doc is the text of each word, firsts the first word of each text.
    """
    grams, at = textscan.window_hashes(words, doc, GRAM)
    if not len(at):
        return {}
    keys = grams ^ mix(doc[at].astype(U) + U(3))
    order = np.argsort(keys, kind="stable")
    back = np.full(len(at), FAR)
    twin = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    back[order[twin + 1]] = at[order[twin + 1]] - at[order[twin]]
    found: dict[int, list[tuple[int, int, int]]] = {}
    for level in range(max(1, int(np.diff(firsts).max()).bit_length())):
        near = np.zeros(len(words) + 1, np.int8)
        near[at[back <= 1 << level]] = 1
        edge = np.diff(near, prepend=0)
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        fine = hi - lo >= (2 if not level else 3 << (level - 1))
        for a, b in zip(lo[fine].tolist(), hi[fine].tolist(), strict=True):
            d = int(doc[a])
            found.setdefault(d, []).append((max(a - (1 << level), int(firsts[d])), b + GRAM - 1, level))
    return {d: _windows(x) for d, x in found.items()}


def _windows(found: list[tuple[int, int, int]], window: int = WINDOW) -> list[tuple[int, int]]:
    """Overlapping stretches are joined; those beyond a window are cut as the module says."""
    joined: list[list] = []
    for lo, hi, level in sorted(found):
        if joined and lo <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], hi)
            joined[-1][2].append((lo, hi, level))
        else:
            joined.append([lo, hi, [(lo, hi, level)]])
    out = []
    for lo, hi, parts in joined:
        cuts = [(lo, hi, window)] + [(a, b, 4 << level) for a, b, level in parts if 4 << level > window] if hi - lo > window else [(lo, hi, hi - lo)]
        for a, b, size in cuts:
            out += [(x, min(x + size, b)) for x in range(a, max(a + 1, b - size // 2), max(1, size // 2))]
    return sorted(set(out))


RESULT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
NAMES = tuple(f.split()[0] for f in RESULT.split(", "))


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words `of` one after the other, each followed by a space, and where each begins (and the last ends)."""
    sizes = ends[of] - starts[of]
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(begins[-1], 32, np.uint8)
    step = np.arange(int(sizes.sum()))
    before = np.cumsum(sizes) - sizes
    out[np.repeat(begins[:-1] - before, sizes) + step] = data[np.repeat(starts[of] - before, sizes) + step]
    return out, begins


def _measured(s: textscan.Slice, source: Callable[[int, int], np.ndarray | None]) -> list[tuple]:
    """RESULT of each text of a slice; source(text, n) may give the original word that stands at each of its n places."""
    n = s.hi - s.lo
    starts, ends = textscan.spans(~textscan.SPACE[s.data], s.offs)
    firsts = np.searchsorted(starts, s.offs)
    doc = np.repeat(np.arange(n), np.diff(firsts))
    of = np.arange(len(starts))
    for d in range(n):
        places = source(s.lo + d, int(firsts[d + 1] - firsts[d]))
        if places is not None:
            of[firsts[d] : firsts[d + 1]] = firsts[d] + places
    words = textscan.span_hashes(s.data, starts, ends)[of]
    runs: dict[int, list[tuple[int, int, int]]] = {}
    dropped = np.zeros(len(words) + 1, np.int64)
    for d, parts in stretches(words, doc, firsts).items():
        base = int(firsts[d])
        runs[d] = runs_within(words[base : firsts[d + 1]], [(a - base, b - base) for a, b in parts])
        for start, length, period in runs[d]:
            dropped[base + start + period] += 1
            dropped[base + start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    text, begins = _joined(s.data, starts, ends, of[kept])
    cuts = begins[np.searchsorted(kept, firsts)]
    out = []
    for d in range(n):
        mine = runs.get(d, [])
        best = (None,) * 4
        if mine:
            top = mine[0]
            for r in mine[1:]:  # in order of start and period, so an equal one comes later
                if r[1] * top[2] > top[1] * r[2]:
                    top = r
            best = (*top, 1000 * top[1] // top[2])
        told = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in mine).encode()).hexdigest()
        out.append((len(mine), *best, told, hashlib.sha256(text[cuts[d] : max(cuts[d], cuts[d + 1] - 1)]).hexdigest()))
    return out


def runs(docs: DataFrame, text: str = "text", key: str = "doc_id", source: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """key and RESULT of each row: its number of runs, the run with most periods, hashes of all runs and of the text without repeats.

    A word is dropped from the text if a run contains it after its first period. source(key, n) may name the place whose
    word is taken at each of a text's n places, None for the text as it is.
    """
    name = key_name(docs.columns[position(docs, key)], NAMES)
    base = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(F.col(f"c{position(docs, key)}").alias(name), as_text(f"c{position(docs, text)}").alias("_text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keys = batch.column(name).to_pylist()
            rows = [r for s in textscan.slices(batch.column("_text")) for r in _measured(s, (lambda d, n: source(keys[d], n)) if source else lambda d, n: None)]
            cols = list(zip(*rows, strict=True)) or [()] * len(NAMES)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(name), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=[name, *NAMES])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:1])
    return map_arrow(base, run, f"{fields}, {RESULT}")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's periodic texts: one id in ten repeats a stretch of words up to its end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of every document."""
    return runs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), source=planted)
