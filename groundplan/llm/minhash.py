"""Near-duplicate classes by ProbMinHash signatures, banding and exact verification.

A text is the weighted set of its five-word shingles (the weight is how often a shingle occurs; fewer than five words are
one shingle). Two texts are linked if their probability Jaccard similarity

    J_P(x, y) = sum over i in both of 1 / sum over j of max(x_j / x_i, y_j / y_i)

is 0.8 or more; without repeated shingles this is the plain Jaccard similarity. Classes are the connected components.

Signatures: each shingle is a Poisson process of rate `weight`, seeded by its hash, whose arrivals fall on random
registers; a register keeps the shingle that arrives first. A shingle's process ends once its next arrival is later than
the latest register of its document, so that few processes have more than one or two arrivals. Bands of registers are the
buckets: as many of so many registers (`shape`) that a pair at the threshold shares none with a probability below MISS; for
0.8 these are 24 bands of 5.

A bucket never yields all its pairs. Equal texts are one node. Every node is first verified against two pivots of its
bucket; the components of those links are labelled; then pairs of a bucket whose nodes are still in different
components are verified, all of them but those that a bound on J_P from bitmaps of their shingles rules out (exactly: the
bound is never below J_P); blocks of nodes are compared as matrices, so that no row is made for a pair that is ruled out.
A pair left out is of one component already, so no link that could join classes is lost to the size of a bucket, and a
group of many near copies costs about as many pairs as it has texts.

Defined results: null is the empty text; texts without words are alike only if they are equal byte for byte; repeated
rows are copies of each other; a class id is the smallest doc_id of its class (null if it has none); an empty table gives
no rows; extra columns are ignored, and pass through `keep_one` whatever their names.

All joins are sort-merge joins of written tables, whose hot keys Spark can split; nothing is broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from groundplan.llm import textscan
from groundplan.llm.frames import as_text, key_name, map_arrow, position
from groundplan.llm.textscan import MULT, U, mix
from groundplan.scratch import Scratch

WORDS = 5
THRESHOLD = 0.8
MISS = 1e-4
REGISTERS = 256
BITS = 4096
BLOCK = 256
#: Texts that have signatures or bitmaps, and bytes of text that are verified, in a worker's memory at a time.
AT_ONCE = 4096
CHUNK = 1 << 23


def shape(least: float) -> tuple[int, int]:
    """Bands and registers in each for a threshold: the longest bands, up to 5, that need at most REGISTERS registers."""
    if not 0 < least <= 1:
        raise ValueError("the threshold is a similarity above 0")
    for rows in (5, 4, 3, 2, 1):
        share = min(least, 0.999) ** rows
        n = math.ceil(math.log(MISS) / math.log(1 - share))
        if n * rows <= REGISTERS or rows == 1:
            return n, rows
    raise AssertionError


def shingles(s: textscan.Slice, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order within each document, their weights, and the documents' offsets."""
    n = s.hi - s.lo
    starts, ends = textscan.spans(~textscan.SPACE[s.data], s.offs)
    firsts = np.searchsorted(starts, s.offs)
    n_words = np.diff(firsts)
    doc = np.repeat(np.arange(n), n_words)
    words = textscan.span_hashes(s.data, starts, ends)
    grams, at = textscan.window_hashes(words, doc, size)
    owner = doc[at]
    for k in range(1, size):
        short = np.flatnonzero(n_words == k)
        if len(short):
            total = np.full(len(short), k, U)
            for j in range(k):
                total = total * MULT + words[firsts[short] + j]
            grams, owner = np.concatenate([grams, mix(total)]), np.concatenate([owner, short])
    order = np.argsort(grams)
    order = order[np.argsort(owner[order], kind="stable")]
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    weights = np.diff(np.append(first, len(grams)))
    return grams[first], weights, np.searchsorted(owner[first], np.arange(n + 1))


def signatures(grams: np.ndarray, weights: np.ndarray, offs: np.ndarray, registers: int) -> np.ndarray:
    """The first shingle to arrive at each register, a row for each document; documents without shingles have zeros."""
    n = len(offs) - 1
    best = np.full(n * registers, np.inf)
    which = np.zeros(n * registers, U)
    doc = np.repeat(np.arange(n), np.diff(offs))
    gram, rate, time = grams, weights.astype(float), np.zeros(len(grams))
    turn = 0
    while len(gram):
        turn += 1
        draw = mix(gram + U(turn * int(MULT) % 2**64))
        time = time - np.log(((draw >> U(11)).astype(float) + 0.5) * 2.0**-53) / rate
        at = doc * registers + (mix(draw ^ U(0xA5A5A5A5)) % U(registers)).astype(np.int64)
        np.minimum.at(best, at, time)
        won = best[at] == time
        which[at[won]] = gram[won]
        latest = best.reshape(n, registers).max(1)
        on = time < latest[doc]
        doc, gram, rate, time = doc[on], gram[on], rate[on], time[on]
    return which.reshape(n, registers)


def bands(sig: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each row of sig."""
    parts = sig.reshape(len(sig), n_bands, rows)
    total = np.broadcast_to(mix(np.arange(n_bands, dtype=U) + U(99)), parts.shape[:2]).copy()
    for k in range(rows):
        total = mix(total * MULT + parts[:, :, k])
    return total


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """J_P of two weighted sets with ascending keys; two empty sets have 0."""
    both = np.intersect1d(a, b, assume_unique=True)
    if not len(both):
        return 0.0
    if (wa == 1).all() and (wb == 1).all():
        return len(both) / (len(a) + len(b) - len(both))
    keys = np.union1d(a, b)
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a)], y[np.searchsorted(keys, b)] = wa, wb
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.maximum(x, 1e-300), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    xs, ys = np.cumsum(x), np.cumsum(y)
    top = np.searchsorted(ratio, ratio, "right") - 1
    i = np.flatnonzero((x > 0) & (y > 0))
    below, above = xs[top[i]], ys[-1] - ys[top[i]]
    return float((x[i] / (below + above / ratio[i])).sum())


def _numbered(docs: DataFrame, text: str, key: str, scratch: Scratch) -> DataFrame:
    """rid, id, row (a hash of the whole row), h1, h2 and the columns of docs as c0, c1, ...: written, so that rid stays."""
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fields = [f for f in flat.schema.fields if f.dataType.typeName() != "void"]
    plain = [f.name for f in fields if not re.search("map<|variant", f.dataType.simpleString())]
    words = as_text(f"c{position(docs, text)}")
    hashes = F.xxhash64(words).alias("h1"), F.xxhash64(F.lit("second"), words).alias("h2")
    chosen = F.monotonically_increasing_id().alias("rid"), F.col(f"c{position(docs, key)}").alias("id"), F.xxhash64(*plain).alias("row"), *hashes
    return scratch.save(flat.select(*chosen, *[f.name for f in fields]), "numbered")


def _signed(numbered: DataFrame, words: Column, n_bands: int, rows: int) -> DataFrame:
    """rid, id, row, h1, h2 and the band keys of each row."""
    base = numbered.select("rid", "id", "row", "h1", "h2", words.alias("text"))
    fields = [f for f in base.schema.fields if f.name != "text"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for s in textscan.slices(batch.column("text"), rows=AT_ONCE):
                grams, weights, offs = shingles(s)
                keys = bands(signatures(grams, weights, offs, n_bands * rows), n_bands, rows)
                full = np.diff(offs) > 0
                ends = np.concatenate([[0], np.cumsum(full * n_bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].reshape(-1).view(np.int64)))
                rest = [batch.column(f.name).slice(s.lo, s.hi - s.lo) for f in fields]
                yield pa.RecordBatch.from_arrays([*rest, lists], names=[*[f.name for f in fields], "bands"])

    return map_arrow(base, run, T.StructType([*fields, T.StructField("bands", T.ArrayType(T.LongType()))]))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Borders of at most 512 rows whose texts have about CHUNK bytes, one row at least."""
    upto = np.cumsum(pc.add(pc.binary_length(batch.column("ta")), pc.binary_length(batch.column("tb"))).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(upto):
        hi = min(lo + 512, max(lo + 1, int(np.searchsorted(upto, CHUNK + (upto[lo - 1] if lo else 0), "right"))))
        yield lo, min(hi, len(upto))
        lo = hi


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""
    left, right = (_merge(texts.select(F.col("node").alias(n), F.col("text").alias(f"t{n}"))) for n in "ab")
    both = pairs.join(left, "a").join(right, "b")

    def sets(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for s in textscan.slices(col):
            grams, weights, offs = shingles(s)
            out += [(grams[i:j], weights[i:j]) for i, j in zip(offs[:-1], offs[1:], strict=True)]
        return out

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for lo, hi in _chunks(whole):
                batch = whole.slice(lo, hi - lo)
                same = batch.column("ta").dictionary_encode()  # a pivot's text comes many times
                known = sets(same.dictionary)
                which = same.indices.to_pylist()
                sim = np.array([probability_jaccard(*known[i], *b) for i, b in zip(which, sets(batch.column("tb")), strict=True)])
                keep = pa.array(sim >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(sim).filter(keep)], names=["a", "b", "similarity"])

    return map_arrow(both.select("a", "b", "ta", "tb"), run, "a long, b long, similarity double")


def bitmaps(texts: DataFrame, sets: Callable[[textscan.Slice], tuple[np.ndarray, np.ndarray, np.ndarray]] = shingles) -> DataFrame:
    """node, total (weight of its shingles) and bits (which of BITS hash places they take) of each text."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for s in textscan.slices(batch.column("text"), rows=AT_ONCE):
                grams, weights, offs = sets(s)
                n = s.hi - s.lo
                doc = np.repeat(np.arange(n), np.diff(offs))
                places = np.zeros((n, BITS), np.uint8)
                places[doc, (mix(grams ^ U(0x5BD1E995)) % U(BITS)).astype(np.int64)] = 1
                longs = np.packbits(places, axis=1, bitorder="little").view("<i8")
                total = np.bincount(doc, weights, n).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * (BITS // 64) + 1, BITS // 64, dtype=np.int32)), pa.array(longs.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(s.lo, n), pa.array(total), lists], names=["node", "total", "bits"])

    return map_arrow(texts.select("node", "text"), run, "node long, total long, bits array<long>")


def _merge(df: DataFrame) -> DataFrame:
    """df as a side of a sort-merge join at every size: tables here grow with the input, so none is broadcast."""
    return df.hint("merge")


def _apart(shared: DataFrame, labels: DataFrame, texts: DataFrame, least: float, scratch: Scratch) -> DataFrame | None:
    """The distinct pairs (a, b) of nodes that share a bucket, are in different components and may be similar enough.

    The nodes of a bucket are dealt to blocks of about BLOCK, and two blocks are one row, compared as matrices: if c places
    are common and x and y take p and q places of total weights X and Y, then 1 / J_P >= X / (X - p + c) + Y / (Y - q + c) - 1.
    Nodes of one component are compared only where few of them (under 32) share a bucket. Pairs with a pivot of the bucket
    are left out, as they have been verified. None: every bucket is within one component.
    """
    labelled = shared.join(_merge(labels), "node", "left").select("bucket", "node", "p1", "p2", F.coalesce("label", "node").alias("label"))
    labelled = scratch.save(labelled, "labelled")
    counts = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    few = F.when(F.col("n") < 32, F.col("n")).otherwise(0)
    mixed = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("labels"), F.sum(few).alias("small")).filter("labels > 1").drop("labels")
    sizes = counts.join(_merge(mixed), "bucket").select("bucket", "label", F.when(F.col("n") < 32, F.lit(-1)).otherwise(F.col("label")).alias("tag"), F.when(F.col("n") < 32, F.col("small")).otherwise(F.col("n")).alias("size"))
    sizes = scratch.save(sizes, "sizes")
    if sizes.isEmpty():
        return None
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK).cast("long")).alias("part")
    rows = scratch.save(labelled.join(_merge(sizes), ["bucket", "label"]).select("bucket", "tag", part, "node", "label", "p1", "p2"), "rows")
    maps = scratch.save(bitmaps(texts.join(_merge(rows.select("node")), "node", "left_semi")), "bitmaps")
    packed = F.collect_list(F.struct("node", "label", "total", "bits")).alias("nodes")
    blocks = scratch.save(rows.join(_merge(maps), "node").groupBy("bucket", "tag", "part").agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), packed), "blocks")
    other = blocks.select("bucket", F.col("tag").alias("tag_"), F.col("part").alias("part_"), F.col("nodes").alias("others"))
    after = (F.col("tag") < F.col("tag_")) | ((F.col("tag") == F.col("tag_")) & (F.col("tag") == -1) & (F.col("part") <= F.col("part_")))
    met = blocks.join(_merge(other), "bucket").filter(after).select("nodes", "others", "p1", "p2")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [np.empty((2, 0), np.int64)]
            waiting = 0
            pivots = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            for (an, al, aw, ab), (bn, bl, bw, bb), ends in zip(_unpacked(batch.column(0)), _unpacked(batch.column(1)), pivots, strict=True):
                c = ab @ bb.T
                x, y = (aw - ab.sum(1))[:, None] + c, (bw - bb.sum(1))[None] + c
                with np.errstate(divide="ignore"):
                    fine = (aw[:, None] / x + bw[None] / y <= 1 + 1 / least + 1e-6) & (al[:, None] != bl[None])
                fine[np.isin(an, ends)] = False
                fine[:, np.isin(bn, ends)] = False
                i, j = np.nonzero(fine)
                found.append(np.stack([np.minimum(an[i], bn[j]), np.maximum(an[i], bn[j])]))
                waiting += len(i)
                if waiting > 1_000_000:
                    yield _distinct_pairs(found)
                    found, waiting = [np.empty((2, 0), np.int64)], 0
            yield _distinct_pairs(found)

    return map_arrow(met, run, "a long, b long").distinct()


def _distinct_pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found, 1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _unpacked(col: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes, labels, totals and 0/1 places of one block after the other: places take 32 times the room of their bits."""
    flat = col.flatten()
    node, label, total = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    bits = flat.field(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, BITS // 64)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(col).to_numpy(zero_copy_only=False))])
    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield node[i:j], label[i:j], total[i:j].astype(float), np.unpackbits(np.ascontiguousarray(bits[i:j]).view(np.uint8), axis=1).astype(np.float32)


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """node, label (one of the nodes of its component) for each node of the edges (a, b), which are distinct, a < b.

    Every node goes to its first neighbour or stays, and the graph shrinks to the nodes that are left and the edges between
    them, until there are none: after one turn for stars around their smallest node, which is what pivots yield, after two
    for any star. The order is the nodes' own in the first two turns, then by a hash that changes every two turns, so that a
    long path shrinks by a constant factor too. Each turn is two written tables.
    """
    steps: list[DataFrame] = []
    while True:
        turn = len(steps)
        rank = lambda c: F.xxhash64(c, F.lit(turn // 2)) if turn > 1 else F.col(c)  # noqa: B023, E731
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", rank("b")).alias("first"), F.min(rank("b")).alias("rank"))
        up = scratch.save(near.select("node", F.when(rank("node") < F.col("rank"), F.col("node")).otherwise(F.col("first")).alias("label")), f"{name}-{turn}")
        steps.append(up)
        ends = [_merge(up.select(F.col("node").alias(n), F.col("label").alias(f"l{n}"))) for n in "ab"]
        left = edges.select("a", "b").join(ends[0], "a").join(ends[1], "b").filter("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
        edges = scratch.save(left.distinct(), f"{name}-{turn}-edges")
        if edges.isEmpty():
            break
    labels = steps[0]
    for up in steps[1:]:
        labels = labels.join(_merge(up.select(F.col("node").alias("label"), F.col("label").alias("upper"))), "label", "left").select("node", F.coalesce("upper", "label").alias("label"))
    return scratch.save(labels, name) if len(steps) > 1 else labels


def _linked(docs: DataFrame, text: str, key: str, least: float, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows of docs (numbered, signed), nodes (a row for each text: its first row, n), and label and n_links of nodes with links."""
    numbered = _numbered(docs, text, key, scratch)
    words = as_text(f"c{position(docs, text)}")
    signed = scratch.save(_signed(numbered, words, *shape(least)), "signed")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "rid")).alias("first")
    nodes = signed.groupBy("h1", "h2").agg(first, F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n"))
    nodes = scratch.save(nodes.select(F.col("first.rid").alias("node"), "first", "h1", "h2", "n", "bands"), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    several = scratch.save(buckets.groupBy("bucket").agg(F.min("node").alias("p1"), F.max("node").alias("p2")).filter("p1 < p2"), "keys")
    shared = scratch.save(buckets.join(_merge(several), "bucket"), "shared")
    texts = scratch.save(numbered.select(F.col("rid").alias("node"), words.alias("text")).join(_merge(shared.select("node")), "node", "left_semi"), "texts")

    star = shared.select(F.col("p1").alias("a"), F.col("node").alias("b")).union(shared.select(F.col("node").alias("a"), F.col("p2").alias("b")))
    links = scratch.save(_verified(star.filter("a < b").distinct(), texts, least), "links-1")
    labels = components(links, scratch, "cc1")
    cross = _apart(shared, labels, texts, least, scratch)
    if cross is not None:
        more = scratch.save(_verified(cross, texts, least), "links-2")
        ends = [_merge(labels.select(F.col("node").alias(n), F.col("label").alias(f"l{n}"))) for n in "ab"]
        between = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        between = scratch.save(between.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "between")
        if not between.isEmpty():
            links = links.union(more)
            upper = components(between, scratch, "cc2").select(F.col("node").alias("label"), F.col("label").alias("upper"))
            every = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(_merge(labels), "node", "left")
            labels = every.select("node", F.coalesce("label", "node").alias("label")).join(_merge(upper), "label", "left").select("node", F.coalesce("upper", "label").alias("label"))
    counts = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    known = scratch.save(counts.join(_merge(labels), "node").select("node", "label", "n_links"), "known")
    scratch.drop("keys", "shared", "texts", "labelled", "sizes", "rows", "bitmaps", "blocks", "between")
    return numbered, signed, nodes, known


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = THRESHOLD, scratch: Scratch | None = None) -> DataFrame:
    """One row for each row of docs: key (as key_name says), class_id, class_size, n_links.

    n_links counts the links of its text to other texts that have been verified: at least those that hold its class
    together. Pairs of one component aren't verified any further.
    """
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    _, signed, nodes, known = _linked(docs, text, key, least, scratch)
    told = nodes.select("node", F.col("first.id").alias("id"), "h1", "h2", "n").join(_merge(known), "node", "left")
    told = scratch.save(told.select("h1", "h2", "id", "n", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "told")
    sizes = scratch.save(told.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size")).filter("class_size > 1"), "class-sizes")
    placed = told.join(_merge(sizes), "label", "left").select("h1", "h2", "class_id", "class_size", "n_links")
    return signed.select("id", "h1", "h2").join(_merge(placed), ["h1", "h2"]).select(
        F.col("id").alias(key_name(docs.columns[position(docs, key)], ("class_id", "class_size", "n_links"))),
        F.when(F.col("class_size").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        "n_links",
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = THRESHOLD) -> DataFrame:
    """The rows of docs without near-duplicates: exactly one row of each class stays, the first by (key, hashes of the text, hash of the row).

    Rows without a key stay only if their class has no key at all. Which row stays depends on the rows alone, not on how
    they are partitioned; only of rows that are equal in all columns (maps aside) any one may stay.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    numbered, _, nodes, known = _linked(docs, text, key, least, scratch)
    members = scratch.save(nodes.select("node", "first", "h1", "h2").join(_merge(known.select("node", "label")), "node"), "members")
    order = F.struct("first.none", "first.id", "h1", "h2", "first.row", "node")
    best = members.groupBy("label").agg(F.min(order).alias("best")).select(F.col("best.node").alias("rid"))
    alone = nodes.select(F.col("node").alias("rid")).join(_merge(members.select(F.col("node").alias("rid"))), "rid", "left_anti")
    kept = numbered.join(_merge(alone.union(best)), "rid", "left_semi")
    have = set(kept.columns)
    whole = [f"c{i}" for i in range(len(docs.columns))]
    return kept.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in whole]).toDF(*docs.columns)


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
