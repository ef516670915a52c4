"""Audit of how far the sources of a language differ in their vocabulary.

Texts are scanned once: each task counts (lang, source, term) over its rows, by integers of its own dictionary, and writes a
row for each language and term. These rows are dealt by ranges of (lang, term), so that a range is a stretch of the
language's dictionary in UTF-8 order: the terms in enough documents are a sorted array, `searchsorted` turns the rows' terms
into integers and `bincount` gives each source's counts. Such a chunk is one row of bounded size. Its integers keep the order of the terms, so equal values are ranked by
them. Then each chunk, with the totals of its language's sources, gives a dense matrix of shares (sources by terms): the
sums of all pairs of sources over the chunk, and each source's best terms in it.

No dictionary is sent to the tasks as a whole: a chunk holds its own part. What goes to all chunks of a language is the list
of its sources with their totals. A term of very many sources is bounded by their number, a source of very many documents by
its terms. The work grows with terms times pairs of sources; up to 2,048 sources of a language, the sums of its pairs are
added up in each task before they are shuffled.

Defined results: null text, lang and source are empty texts; repeated rows count as often as they occur; a group without
terms has count 0 for all terms of its language; a language without kept terms gives pairs of value 0 and no terms; an empty
table gives no rows; extra columns are ignored. Counts are exact below 2**53, so for any corpus below about 50 PB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from groundplan.llm import textscan
from groundplan.llm.frames import as_text, map_arrow, position
from groundplan.scratch import Scratch

LEAST_DOCS = 10
TOP = 10
#: Cells that a task adds up, terms of a chunk, cells that become chunks at a time, cells of a matrix in memory.
HELD = 1 << 20
TERMS = 1024
CELLS = 1 << 18
DENSE = 1 << 21
SALTS = 64

LETTER = np.ones(256, bool)
LETTER[:128] = False
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
COUNTS = "lang string, term string, n_docs long, sources array<string>, n array<long>"


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(data)))


def _ints(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).astype(np.int64)


#: Counts of cells: the group and the term of each, its occurrences and documents.
Cells = tuple[np.ndarray, pa.DictionaryArray, np.ndarray, np.ndarray]


def _slice_cells(s: textscan.Slice, group: np.ndarray) -> Cells:
    """The cells of one slice of texts, whose groups are given; one with the empty term and 0, 0 for each group."""
    mask = LETTER[s.data]
    starts, ends = textscan.spans(mask, s.offs)
    doc = np.repeat(np.arange(s.hi - s.lo), np.diff(np.searchsorted(starts, s.offs)))
    words = _strings(LOWER[s.data[mask]], ends - starts).dictionary_encode()
    terms = pa.concat_arrays([pa.array([""], pa.large_string()), words.dictionary])
    wide = len(terms)
    pairs, times = np.unique(doc * wide + _ints(words.indices) + 1, return_counts=True)
    seen = np.unique(group) * wide
    keys, which = np.unique(np.concatenate([group[pairs // wide] * wide + pairs % wide, seen]), return_inverse=True)
    zero = np.zeros(len(seen), np.int64)
    n, docs = (np.bincount(which, np.concatenate([x, zero]), len(keys)).astype(np.int64) for x in (times, np.ones_like(times)))
    return keys // wide, pa.DictionaryArray.from_arrays(pa.array(keys % wide), terms), n, docs


def _summed(parts: list[Cells]) -> Cells:
    """One list of cells, in the order of their groups, with one dictionary."""
    terms = pa.chunked_array([p[1] for p in parts]).unify_dictionaries()
    words, wide = terms.chunk(0).dictionary, len(terms.chunk(0).dictionary)
    codes = np.concatenate([_ints(c.indices) for c in terms.chunks])
    keys, which = np.unique(np.concatenate([p[0] for p in parts]) * wide + codes, return_inverse=True)
    n, docs = (np.bincount(which, np.concatenate([p[k] for p in parts]), len(keys)).astype(np.int64) for k in (2, 3))
    return keys // wide, pa.DictionaryArray.from_arrays(pa.array(keys % wide), words), n, docs


def _told(cells: Cells, groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """COUNTS of cells: a row for each language and term, with its sources."""
    group, terms, n, docs = cells
    names = sorted({x for x, _ in groups})
    lang = np.array([names.index(x) for x, _ in groups], np.int64)[group]
    codes = _ints(terms.indices)
    order = np.lexsort((codes, lang))
    lang, codes, group, n, docs = lang[order], codes[order], group[order], n[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (codes[1:] != codes[:-1])]))
    ends, total = np.append(first[1:], len(codes)), np.add.reduceat(docs, first)
    sources = pa.array([x for _, x in groups], pa.string())
    step = 1 << 13
    for k in range(0, len(first), step):
        at, to = first[k : k + step], ends[k : k + step]
        lists = [pa.ListArray.from_arrays(pa.array(np.append(at, to[-1]) - at[0], pa.int32()), x) for x in (sources.take(pa.array(group[at[0] : to[-1]])), pa.array(n[at[0] : to[-1]]))]
        cols = [pa.array(names, pa.string()).take(pa.array(lang[at])), terms.dictionary.take(pa.array(codes[at])).cast(pa.string()), pa.array(total[k : k + step]), *lists]
        yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in COUNTS.split(", ")])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """COUNTS of stretches of rows, so several rows for a term; the empty term has all sources, each with 0."""
    base = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*[as_text(f"c{position(docs, c)}").alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held: list[Cells] = []
        rows, last = 0, 0
        for batch in it:
            group = np.array([groups.setdefault(g, len(groups)) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)], np.int64)
            for s in textscan.slices(batch.column("text")):
                held.append(_slice_cells(s, group[s.lo : s.hi]))
                rows += len(held[-1][0])
                if rows > HELD + last:
                    held = [_summed(held)]
                    rows = last = len(held[0][0])
                    if rows > 2 * HELD:
                        yield from _told(held[0], list(groups))
                        held, rows, last = [], 0, 0
        if held:
            yield from _told(_summed(held), list(groups))

    return map_arrow(base, run, COUNTS)


CHUNK = "lang string, chunk long, terms array<string>, sources array<string>, sums array<long>, src array<int>, ids array<int>, n array<long>"


def _language(rows: pa.Table, least: int) -> Iterator[list[pa.Array]]:
    """CHUNK from `terms` on, for whole terms of one language in order: their rows of COUNTS."""
    terms = rows.column("term").cast(pa.large_binary()).to_numpy()
    first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    kept = terms[first][np.add.reduceat(rows.column("n_docs").to_numpy(), first) >= least]
    lists = rows.column("sources").combine_chunks()
    names = lists.flatten().dictionary_encode()
    offs = np.concatenate([[0], np.cumsum(_ints(pc.list_value_length(lists)))])
    src, n = _ints(names.indices), rows.column("n").combine_chunks().flatten().to_numpy()
    ids = np.searchsorted(kept, terms)
    width = max(1, min(TERMS, DENSE // max(1, len(names.dictionary))))
    for lo in range(0, len(kept), width):
        some = kept[lo : lo + width]
        a, b = np.searchsorted(ids, [lo, lo + len(some)])
        at = np.flatnonzero(terms[a:b] == kept[ids[a:b]]) + a  # without the terms that aren't kept
        sizes = offs[at + 1] - offs[at]
        cell = np.repeat(offs[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        found, who = np.unique(src[cell], return_inverse=True)
        dense = np.bincount(who * len(some) + np.repeat(ids[at] - lo, sizes), n[cell], len(found) * len(some)).astype(np.int64).reshape(-1, len(some))
        i, j = np.nonzero(dense)
        yield [pa.array([x.decode() for x in some], pa.string()), names.dictionary.take(pa.array(found)).cast(pa.string()), pa.array(dense.sum(1)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(dense[i, j])]


def _one_row(rows: pa.Table) -> pa.Table:
    """The rows of one term as one."""
    sums = pa.table({"s": pc.list_flatten(rows.column("sources")), "n": pc.list_flatten(rows.column("n"))}).group_by("s", use_threads=False).aggregate([("n", "sum")])
    lists = [pa.ListArray.from_arrays(pa.array([0, sums.num_rows], pa.int32()), sums.column(c).combine_chunks()) for c in ("s", "n_sum")]
    return pa.table([rows.column("lang").slice(0, 1), rows.column("term").slice(0, 1), pa.array([pc.sum(rows.column("n_docs")).as_py()], pa.int64()), *lists], schema=rows.schema)


def chunks(counts: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """The kept terms of each language in stretches of the dictionary, with the sources' counts: see CHUNK.

    `counts` should be a written table, as dealing by ranges reads it twice.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        held: list[pa.Table] = []

        def work(end: bool) -> Iterator[pa.RecordBatch]:
            """The chunks of the whole terms that are held; the rows of the last term stay, as more may come."""
            nonlocal number, held
            table = pa.concat_tables(held).combine_chunks()
            lang, term = (_ints(table.column(c).combine_chunks().dictionary_encode().indices) for c in ("lang", "term"))
            turns = np.flatnonzero((lang[1:] != lang[:-1]) | (term[1:] != term[:-1])) + 1
            whole = table.num_rows if end else int(turns[-1]) if len(turns) else 0
            cuts = [0, *(np.flatnonzero(lang[1:] != lang[:-1]) + 1).tolist(), table.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < whole:
                    name = table.column("lang")[a].as_py()
                    for lists in _language(table.slice(a, min(b, whole) - a), least):
                        arrays = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([number], pa.int64()), *arrays], names=[f.split()[0] for f in CHUNK.split(", ")])
                        number += 1
            held = [] if end else [_one_row(table.slice(whole))]

        cells, last = 0, 0
        for batch in it:
            held.append(pa.Table.from_batches([batch]))
            cells += len(batch.column("sources").flatten())
            if cells > CELLS + last:
                yield from work(False)
                cells = last = len(pc.list_flatten(held[0].column("sources")))
        if held:
            yield from work(True)

    dealt = counts.filter("term <> ''").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return map_arrow(dealt, run, CHUNK)


def share(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * n / of) for integers n <= of < 2**53, exactly: three decimal digits at a time."""
    whole, rest = np.divmod(n, of)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, of)
        whole = whole * 1000 + digits
    return whole + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)) of shares, which are below 2**31."""
    return (p - q) ** 2 // (p + q)


PARTS = "lang string, source string, part string, item string, value long"


def _rows(lang: str, source, part: str, item, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    n = len(value)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array(source, pa.string()), pa.array([part] * n), pa.array(item, pa.string()), pa.array(value, pa.int64())], names=[f.split()[0] for f in PARTS.split(", ")])


def _pair_rows(lang: str, names: np.ndarray, lo: int, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the sources from number lo on, each with those after it."""
    a, b = np.nonzero(np.arange(lo, lo + len(sums))[:, None] < np.arange(len(names)))
    for k in range(0, len(a), 1 << 16):
        i, j = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
        yield from _rows(lang, names[lo + i], "pair", names[j], sums[i, j])


def _compared(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For chunks with their language's sources: the pairs' sums, and the best terms of each source in each chunk."""
    known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in it:
        for row in batch.to_pylist():
            lang, n_terms, all_of = row["lang"], row["n_kept"], row["all_n"]
            names = np.array([m["source"] for m in row["members"]], object)
            totals = np.array([m["n"] for m in row["members"]], np.int64) + 2 * n_terms
            place = {x: k for k, x in enumerate(names)}
            src = np.array([place[x] for x in row["sources"]], np.int64)[np.array(row["src"], np.int64)] if row["sources"] else np.empty(0, np.int64)
            ids, n, width = np.array(row["ids"], np.int64), np.array(row["n"], np.int64), len(row["terms"])
            block = max(1, DENSE * 2 // max(1, len(names)))
            whole = len(names) <= block
            if whole and lang not in known:
                if sum(x[1].size for x in known.values()) + len(names) ** 2 > 2 * DENSE:
                    for x, (who, sums) in known.items():
                        yield from _pair_rows(x, who, 0, sums)
                    known.clear()
                known[lang] = names, np.zeros((len(names), len(names)), np.int64)
            for lo in range(0, len(names), block):
                sums = known[lang][1] if whole else np.zeros((min(block, len(names) - lo), len(names)), np.int64)
                step = max(1, DENSE // len(names))
                for left in range(0, width, step):
                    inside = (ids >= left) & (ids < left + step)
                    dense = np.zeros((len(names), min(step, width - left)), np.int64)
                    dense[src[inside], ids[inside] - left] = n[inside]
                    p = share(dense + 2, totals[:, None])
                    for k in range(len(sums)):
                        sums[k, lo + k + 1 :] += gap(p[lo + k], p[lo + k + 1 :]).sum(1)
                if not whole:
                    yield from _pair_rows(lang, names, lo, sums)
            if not width:
                continue
            p = share(n + 2, totals[src])
            q = share(np.bincount(ids, n, width).astype(np.int64) + 2, np.int64(all_of + 2 * n_terms))[ids]
            at = np.flatnonzero(p > q)
            value = gap(p[at], q[at])
            order = np.lexsort((ids[at], -value, src[at]))
            at, value = at[order], value[order]
            first = np.searchsorted(src[at], src[at])
            best = np.arange(len(at)) - first < TOP
            terms = np.array(row["terms"], object)
            yield from _rows(lang, names[src[at[best]]], "term", terms[ids[at[best]]], value[best])
    for x, (who, sums) in known.items():
        yield from _pair_rows(x, who, 0, sums)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS, scratch: Scratch | None = None) -> DataFrame:
    """lang, source, part, item, value, rank: see the module; `pair` ranks all other sources, `term` the first TOP terms."""
    scratch = scratch or Scratch(docs.sparkSession, "divergence")
    counts = scratch.save(term_counts(docs, text, lang, source), "counts")
    chunked = scratch.save(chunks(counts, least), "chunks")
    totals = chunked.select("lang", F.explode(F.arrays_zip("sources", "sums")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.sums").alias("n"))
    kept = chunked.groupBy("lang").agg(F.sum(F.size("terms")).cast("long").alias("n_kept"))
    groups = counts.filter("term = ''").select("lang", F.explode("sources").alias("source")).distinct().join(totals, ["lang", "source"], "left").fillna(0, ["n"])
    members = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("members")
    langs = scratch.save(groups.groupBy("lang").agg(members, F.sum("n").alias("all_n")).join(kept, "lang", "left").fillna(0, ["n_kept"]), "langs")
    none = [F.array().cast(t).alias(c) for c, t in (f.split() for f in CHUNK.split(", ")[2:])]
    every = chunked.union(langs.select("lang", F.lit(-1).cast("long").alias("chunk"), *none)).withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(SALTS)))
    salted = langs.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    parts = scratch.save(map_arrow(every.join(salted.hint("merge"), ["lang", "salt"]).drop("salt"), _compared, PARTS), "parts")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = pairs.union(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = parts.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return both.withColumn("rank", F.row_number().over(order)).union(best)


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Every source of every language against the others, and its telling terms."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))
