"""Jaccard self-join of documents on word n-grams by adaptive multi-match prefixes.

A document's set is its distinct four-word shingles of the ASCII-lower-cased text (fewer words are one shingle). Two
documents link if 100 * |intersection| >= 85 * |union|; the result is the connected components of all links.

Order. All sets are ordered by one global order: the commonest shingles of a sample of documents come after all others, else
it is that of the shingles' hashes. So a passage that many texts have is in the prefix of few. Nothing but cost rests on the sample.

Prefixes. A partner of a set of n shingles shares
c = ceil(0.85 n) of them at least. The l-prefix is the first n - c + l shingles, and two linked sets share at least
min(l, l') shingles within their l- and l'-prefixes. Each document chooses its own l: it starts with 1, and where shingles
of its prefix are common (estimated cost: the candidates that their lists hold) and that holds a good part of all candidates, the prefix
is lengthened until it should hold
as many rare ones as the first had in all. A document looks up (probes) only the n - c + 1 rarest shingles of its prefix,
leaving out the l - 1 commonest, and is listed under all of them. Of a linked pair the one with the smaller l finds the
other: it shares l shingles with the other's prefix and left out l - 1. Nothing rests on the estimates but the cost: any l is exact.

Shingles that occur in one prefix only find nobody. Documents with equal sets are one node. Of the others, short lists are paired row by
row; a pair is looked at if it shares as many shingles of short lists as linked sets do in their 1-prefixes (`_needed`), or else
shares one of a long list. Long lists never yield all their pairs: in each, the node whose shingles are commonest (the likely original of near
copies) and the smallest one are compared with all, and each node takes the name of its neighbour with the commonest shingles, or its own.
Nodes of one name are connected, so only pairs of different names with a probe among them are compared further, block by block, as
matrices of 0 and 1. A block yields as few links as join what all its links join, so no component is lost. Texts are fetched once, of
the nodes that have such pairs or long lists only.

Defined results: null text, and text without words, is an empty set, linked with nothing (component: its own id); repeated
rows and equal sets are one component; the component is the smallest id in it (null where it has none); an empty table gives no
rows; extra columns are ignored. Shingles are compared by 64-bit hashes, sets and texts by 128-bit ones.

All joins are sort-merge joins of written tables, whose hot keys Spark can split; nothing is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from groundplan.llm import minhash, textscan
from groundplan.llm.frames import as_text, key_name, map_arrow, position
from groundplan.llm.minhash import BLOCK, _chunks, _merge, components
from groundplan.llm.textscan import U, mix
from groundplan.scratch import Scratch

WORDS = 4
PERCENT = 85
#: Documents under a shingle from which on it is common; the part of common ones beyond which lengthening has no end.
COMMON = 32
MOSTLY = 0.75
#: Prefixes are lengthened if that spares this part of all candidates at least, and more than the texts that are read for it have shingles.
WORTH = 0.25
#: Documents by which common shingles are found: this part, in tables of so many rows at least; a shingle in SEEN of them is common,
#: and the commonest, MOST at most, are known to all tasks. The part doesn't fall as tables grow: SEEN would stand for ever longer lists.
PART, ROWS, SEEN, MOST = 0.1, 1_000, 4, 1 << 20
#: Shingles to a place of a sketch, at least half as many, and the fewest places.
SHARE, PLACES = 8, 16
#: Members of a list that are paired one by one.
SHORT = 48
#: Weight of a small block (a node weighs 1, and 1 for each WEIGHT shingles), and small blocks that are compared with another at a time.
FEW, GATHERED, WEIGHT = BLOCK // 8, 32, 1024
#: Shingles that are compared at a time between two blocks.
COLUMNS = 1 << 13

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Common:
    """The shingles that come last in the global order: sorted, and with a table of their first bits (20 or more), which few others hit."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.sort(grams.astype(U))
        bits = max(20, len(grams).bit_length() + 3)
        self.rest = U(64 - bits)
        self.firsts = np.zeros(1 << bits, bool)
        self.firsts[(self.grams >> self.rest).astype(np.int64)] = True

    def holds(self, grams: np.ndarray) -> np.ndarray:
        out = self.firsts[(grams >> self.rest).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
            out[at] = self.grams[place] == grams[at]
        return out


def sets(s: textscan.Slice, common: Common | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in the global order within each document (ascending, common ones after all others), and the documents' offsets."""
    grams, _, offs = minhash.shingles(replace(s, data=LOWER[s.data]), WORDS)
    if common is not None and (last := common.holds(grams)).any():
        n = np.diff(offs)
        doc = np.repeat(np.arange(len(n), dtype=np.uint16 if 2 * len(n) < 1 << 16 else np.int64), n)
        grams = grams[np.argsort(doc * doc.dtype.type(2) + last.astype(doc.dtype), kind="stable")]
    return grams, offs


def _common(docs: DataFrame, text: str, key: str, scratch: Scratch) -> Common | None:
    """The commonest shingles of a sample of documents. They only settle the order, and any order is exact."""
    if docs.count() < ROWS:
        return None
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    words = as_text(f"c{position(docs, text)}")
    some = flat.select(F.xxhash64(F.col(f"c{position(docs, key)}"), words).alias("h"), words.alias("text"))
    some = some.filter(F.pmod("h", F.lit(1 << 20)) < int(PART * (1 << 20))).select("text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for s in textscan.slices(batch.column("text"), rows=minhash.AT_ONCE):
                grams, counts = np.unique(sets(s)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], names=["token", "n"])

    counts = map_arrow(some, run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= SEEN)
    counts = scratch.save(counts, "common")
    least, room = 0, MOST
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        room -= r["count"]
        if room < 0:
            break
        least = r.n
    found = counts.filter(F.col("n") >= least).select("token").toArrow().column("token").to_numpy() if least else []
    scratch.drop("common")
    return Common(found.view(U)) if len(found) else None


def _sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, U), np.cumsum(values, dtype=U)])
    return (total[offs[1:]] - total[offs[:-1]]).view(np.int64)


def _first(n, percent: int):
    """Shingles of the 1-prefix of sets of n."""
    return n - (n * percent + 99) // 100 + 1


def _lists(grams: np.ndarray, offs: np.ndarray, skip: np.ndarray, take: np.ndarray) -> pa.ListArray:
    """Of each document the shingles from number `skip` on, `take` of them."""
    before = np.cumsum(take) - take
    at = np.repeat(offs[:-1] + skip - before, take) + np.arange(int(take.sum()))
    return pa.ListArray.from_arrays(pa.array(np.append(before, take.sum()), pa.int32()), pa.array(grams[at].view(np.int64)))


def _sketches(grams: np.ndarray, offs: np.ndarray) -> pa.BinaryArray:
    """Of each set, how many of its shingles fall to each place: a byte a place (255: or more), a power of two of places.

    The sums of differences between two sketches are never above the number of shingles that only one of the sets has.
    """
    n = np.diff(offs)
    places = np.maximum(PLACES, 1 << np.ceil(np.log2(np.maximum(n, 1) / SHARE)).clip(0).astype(np.int64))
    ends = np.cumsum(places)
    at = np.repeat(ends - places, n) + (grams & np.repeat(places - 1, n).astype(U)).astype(np.int64)
    counts = np.minimum(np.bincount(at, minlength=int(places.sum())), 255).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(counts)])


def _differences(x: pa.BinaryArray, y: pa.BinaryArray) -> np.ndarray:
    """The sum of differences of each pair of sketches; the longer one is folded to the places of the shorter."""
    sides = []
    for z in (x, y):
        offs = np.frombuffer(z.buffers()[1], np.int32)[z.offset : z.offset + len(z) + 1].astype(np.int64)
        sides.append((offs[:-1], np.diff(offs), np.frombuffer(z.buffers()[2] or b"", np.uint8)))
    out = np.zeros(len(x), np.int64)
    kinds, kind = np.unique(np.stack([sides[0][1], sides[1][1]]), axis=1, return_inverse=True)
    for k, places in enumerate(kinds.T.tolist()):
        rows = np.flatnonzero(kind.ravel() == k)
        a, b = (data[starts[rows][:, None] + np.arange(m)].astype(np.int64).reshape(len(rows), -1, min(places)).sum(1) for (starts, _, data), m in zip(sides, places, strict=True))
        out[rows] = np.abs(a - b).sum(1)
    return out


def _signed(docs: DataFrame, text: str, key: str, percent: int, common: Common | None) -> DataFrame:
    """id, h1, h2 (of the text), s1, s2, n (of the set), its sketch and its 1-prefix, for each row."""
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    words = as_text(f"c{position(docs, text)}")
    base = flat.select(F.col(f"c{position(docs, key)}").alias("id"), *_text_hashes(words), words.alias("text"))
    kept = base.schema.fields[:3]
    more = [*[T.StructField(c, T.LongType()) for c in ("s1", "s2", "n")], T.StructField("sketch", T.BinaryType())]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for s in textscan.slices(batch.column("text"), rows=minhash.AT_ONCE):
                grams, offs = sets(s, common)
                n = np.diff(offs)
                short = np.where(n > 0, _first(n, percent), 0)
                new = [_sum(mix(grams ^ U(0x51ED270B)), offs), _sum(mix(grams ^ U(0x2545F491)), offs), n, _sketches(grams, offs)]
                rest = [batch.column(f.name).slice(s.lo, s.hi - s.lo) for f in kept]
                yield pa.RecordBatch.from_arrays([*rest, *map(pa.array, new), _lists(grams, offs, np.zeros_like(n), short)], names=[*[f.name for f in kept], "s1", "s2", "n", "sketch", "prefix"])

    return map_arrow(base, run, T.StructType([*kept, *more, T.StructField("prefix", T.ArrayType(T.LongType()))]))


def _text_hashes(words: Column) -> list[Column]:
    return [F.xxhash64(words).alias("h1"), F.xxhash64(F.lit("second"), words).alias("h2")]


def _lengthened(texts: DataFrame, longer: DataFrame, percent: int, common: Common | None) -> DataFrame:
    """The rows of longer (node, size, score, extra), each with a token: the shingles that the longer prefixes have more."""
    told = longer.columns

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for s in textscan.slices(batch.column("text"), rows=minhash.AT_ONCE):
                grams, offs = sets(s, common)
                extra = batch.column("extra").slice(s.lo, s.hi - s.lo).to_numpy()
                rest = [batch.column(c).slice(s.lo, s.hi - s.lo) for c in told]
                yield pa.RecordBatch.from_arrays([*rest, _lists(grams, offs, _first(np.diff(offs), percent), extra)], names=[*told, "tokens"])

    both = texts.join(_merge(longer), "node").select(*told, "text")
    return map_arrow(both, run, T.StructType([*longer.schema, T.StructField("tokens", T.ArrayType(T.LongType()))])).select(*told, F.explode("tokens").alias("token"))


def _alike(a: Column | str, b: Column | str, percent: int) -> Column:
    """Whether sets of these sizes can link."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _needed(a: Column | str, b: Column | str, percent: int) -> Column:
    """Shingles that linked sets of these sizes share in their 1-prefixes at least.

    They share x = ceil(percent * (a + b) / (100 + percent)) in all. Take the prefix that ends first: what they share up to its end lies in both
    prefixes, and the rest of its set is not more than ceil(percent * the larger / 100) - 1.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.greatest(F.lit(1), F.ceil((a + b) * percent / (100 + percent)) - F.floor((F.greatest(a, b) * percent + 99) / 100) + 1)


def _parts(col: pa.Array) -> list[np.ndarray]:
    """The set of each text."""
    out = []
    for s in textscan.slices(col):
        grams, offs = sets(s)
        out += [grams[i:j] for i, j in zip(offs[:-1], offs[1:], strict=True)]
    return out


def _sifted(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The rows of pairs (a, b, sa, sb) that may link by the sketches (node, n, sketch): no pair that links is lost."""
    left, right = (_merge(sketches.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"t{k}"))) for k in "ab")
    kept = ("a", "b", "sa", "sb")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                size = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
                keep = pa.array(_differences(batch.column("ta"), batch.column("tb")) * (100 + percent) <= size * (100 - percent))
                yield pa.RecordBatch.from_arrays([batch.column(n).filter(keep) for n in kept], names=[*kept])

    return map_arrow(pairs.join(left, "a").join(right, "b").select(*kept, "na", "nb", "ta", "tb"), run, "a long, b long, sa long, sb long")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The rows of pairs (a, b, sa, sb) that link."""
    left, right = (_merge(texts.select(F.col("node").alias(n), F.col("text").alias(f"t{n}"))) for n in "ab")

    def link(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for lo, hi in _chunks(whole):
                batch = whole.slice(lo, hi - lo)
                same = batch.column("ta").dictionary_encode()  # a pivot's text comes many times
                known = _parts(same.dictionary)
                keep = pa.array([link(known[i], y) for i, y in zip(same.indices.to_pylist(), _parts(batch.column("tb")), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(n).filter(keep) for n in ("a", "b", "sa", "sb")], names=["a", "b", "sa", "sb"])

    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "ta", "tb"), run, "a long, b long, sa long, sb long")


def _shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of x has in common with each of y."""
    both = np.intersect1d(*[np.unique(np.concatenate(z)) for z in (x, y)], assume_unique=True)
    sides = []
    for z in (x, y):
        grams, owner = np.concatenate(z), np.repeat(np.arange(len(z)), [len(g) for g in z])
        place = np.searchsorted(both, grams)
        there = place < len(both)
        there[there] = both[place[there]] == grams[there]
        place, owner = place[there], owner[there]
        order = np.argsort(place, kind="stable")
        sides.append((place[order], owner[order], len(z)))
    total = np.zeros((len(x), len(y)))
    for lo in range(0, len(both), COLUMNS):
        part = []
        for place, owner, n in sides:
            i, j = np.searchsorted(place, (lo, lo + COLUMNS))
            ones = np.zeros((n, min(COLUMNS, len(both) - lo)), np.float32)
            ones[owner[i:j], place[i:j] - lo] = 1
            part.append(ones)
        total += part[0] @ part[1].T
    return total


def _forest(x: pa.StructArray, y: pa.StructArray, percent: int) -> Iterator[tuple[int, int]]:
    """As many links between two blocks as join all labels that their links join."""
    (xn, xl), (yn, yl) = ([z.field(k).to_numpy() for k in (0, 1)] for z in (x, y))
    xs = _parts(x.field(2))
    ys = xs if x.equals(y) else _parts(y.field(2))
    c = _shared(xs, ys)
    size = np.array([len(g) for g in xs])[:, None] + np.array([len(g) for g in ys])[None]
    i, j = np.nonzero((100 * c >= percent * (size - c)) & (xl[:, None] != yl[None]))
    names, label = np.unique(np.concatenate([xl, yl]), return_inverse=True)
    one, two = label[: len(xl)][i], label[len(xl) :][j]
    first = np.unique(np.minimum(one, two) * len(names) + np.maximum(one, two), return_index=True)[1]
    up = list(range(len(names)))

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for k in first.tolist():
        a, b = root(int(one[k])), root(int(two[k]))
        if a != b:
            up[max(a, b)] = min(a, b)
            yield int(min(xn[i[k]], yn[j[k]])), int(max(xn[i[k]], yn[j[k]]))


def _texts(nodes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """node and text of the nodes (node, h1, h2)."""
    words = as_text(f"c{position(docs, text)}")
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*_text_hashes(words), words.alias("text"))
    return flat.join(_merge(nodes), ["h1", "h2"]).groupBy("node").agg(F.first("text").alias("text"))


def _probes(nodes: DataFrame, docs: DataFrame, text: str, percent: int, order: Common | None, scratch: Scratch) -> DataFrame:
    """The lists (token, node, size, score, extra, probe, n: members), of shingles in several prefixes.

    What is told of a node goes along with its rows, so that lists are joined by their shingles only.
    """
    first = nodes.select("node", "size", F.explode("prefix").alias("token"))
    several = scratch.save(first.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "several")
    listed = scratch.save(first.join(_merge(several), "token"), "listed")
    common = F.count(F.when(F.col("n") > COMMON, True)).alias("common"), F.coalesce(F.sum(F.when(F.col("n") > COMMON, F.col("n"))), F.lit(0)).alias("many")
    wanted = scratch.save(listed.groupBy("node", "size").agg(*common, F.sum("n").alias("score"), F.collect_list(F.struct("token", "n")).alias("of")), "wanted")

    short = F.col("size") - F.floor((F.col("size") * percent + 99) / 100) + 1
    part = F.col("common") / short
    extra = F.least(F.col("size") - short, F.ceil(1.25 * short * part / (1 - part)).cast("long") + 2)
    able = (F.col("common") > 0) & (part <= MOSTLY) & (extra > 0)
    spared, every, read = wanted.agg(F.sum(F.when(able, F.col("many"))), F.sum("score"), F.sum(F.when(able, F.col("size")))).first()
    told = "node", "size", "score", "extra"
    if (spared or 0) > max(WORTH * (every or 0), read or 0):  # these find each other by the shingles that they have more, all others by their 1-prefixes
        longer = scratch.save(wanted.filter(able).select("node", "size", "score", extra.alias("extra")), "longer")
        texts = scratch.save(_texts(nodes.select("node", "rep.h1", "rep.h2").join(_merge(longer), "node", "left_semi"), docs, text), "longer-texts")
        added = scratch.save(_lengthened(texts, longer, percent, order), "added")
        fresh = _merge(added.select("token").distinct().join(_merge(several), "token", "left_anti"))
        before = nodes.select("node", "prefix").join(_merge(longer), "node").select(*told, F.explode("prefix").alias("token")).join(fresh, "token", "left_semi")
        known = wanted.select("node", "size", "score", F.when(able, extra).otherwise(0).alias("extra"), F.explode("of.token").alias("token"))
        rows = scratch.save(known.union(added.select(*told, "token")).union(before.select(*told, "token")), "lengthened")
        rows = rows.join(_merge(rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")), "token")
        mine = Window.partitionBy("node")
        plain = rows.filter("extra = 0").withColumn("probe", F.lit(True))
        chosen = rows.filter("extra > 0").withColumn("k", F.row_number().over(mine.orderBy("n", "token"))).withColumn("m", F.count(F.lit(1)).over(mine))
        chosen = chosen.withColumn("probe", F.expr("k <= m - extra")).drop("k", "m")
        lists = scratch.save(plain.union(chosen).select("token", *told, "probe", "n"), "lists")
        scratch.drop("several", "listed", "wanted", "longer", "longer-texts", "added", "lengthened")
        return lists
    scratch.drop("several", "listed")
    return wanted.select("node", "size", "score", F.lit(0).cast("long").alias("extra"), F.lit(True).alias("probe"), F.explode("of").alias("at")).select("at.token", *told, "probe", "at.n")


def _blocks_of_lists(counts: DataFrame, long: DataFrame, wide: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """nodes, others: the blocks of long lists that are compared.

    Texts that are much alike meet in many lists. So each node has a home, the most common of its lists' pivots, and the nodes
    of a home are dealt to blocks once; two blocks that meet in several lists are compared once, as a whole. A list whose
    members are thinly spread over such blocks has blocks of its own.
    """
    at = ("home", "tag", "probe", "part")
    dealt = lambda of: F.pmod(F.xxhash64("node"), F.ceil(F.col(of) / BLOCK).cast("long")).alias("part")
    tag = lambda n: F.when(F.col(n) >= 32, F.col("label")).otherwise(F.lit(-1)).alias("tag")
    packed = F.collect_list(F.struct("node", "label", "text")).alias("nodes"), F.sum("w").alias("n")
    order = lambda end: F.struct(*[F.col(c + end) for c in at])
    once = (F.col("probe") | F.col("probe_")) & (order("") <= order("_")) & ((F.col("tag") != F.col("tag_")) | (F.col("tag") == -1))

    homes = wide.groupBy("node", "label").agg(F.max(F.struct("score", "home")).alias("h"), F.max("probe").alias("probe"), F.first("w").alias("w")).select("node", "label", "h.home", "probe", "w")
    homes = scratch.save(homes, "homes")
    sized = homes.groupBy("home", "label", "probe").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).withColumn("tag", tag("n"))
    room = sized.groupBy("home", "tag", "probe").agg(F.sum("w").alias("of"))
    placed = homes.join(_merge(sized.select("home", "label", "probe", "tag")), ["home", "label", "probe"]).join(_merge(room), ["home", "tag", "probe"])
    placed = scratch.save(placed.select("node", "label", "w", "home", "tag", "probe", dealt("of")), "placed")
    seen = scratch.save(wide.select("token", "node").join(_merge(placed.select("node", *at)), "node").groupBy("token", *at).agg(F.count(F.lit(1)).alias("m")), "seen")
    full = scratch.save(seen.groupBy("token").agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("h")).filter(F.col("h") * BLOCK <= 4 * F.col("m") + BLOCK).select("token"), "full")
    here = seen.join(_merge(full), "token").select("token", *at)
    there = here.select("token", *[F.col(c).alias(c + "_") for c in at])
    met = scratch.save(here.join(_merge(there), "token").filter(once).select(*at, *[c + "_" for c in at]).distinct(), "met")
    used = met.select(*at).union(met.select(*[F.col(c + "_").alias(c) for c in at])).distinct()
    whole = placed.join(_merge(used), list(at), "left_semi").join(_merge(texts), "node").groupBy(*at).agg(*packed)
    whole = scratch.save(whole, "whole")
    shared = _side_by_side(met, whole, at)

    thin = scratch.save(long.join(_merge(full), "token", "left_anti"), "thin")
    if thin.isEmpty():
        return shared
    sizes = counts.join(_merge(thin), "token").select("token", "label", tag("n"), F.when(F.col("n") >= 32, F.col("w")).otherwise(F.col("few")).alias("of"))
    alone = wide.join(_merge(sizes), ["token", "label"]).select(F.col("token").alias("home"), "tag", "probe", dealt("of"), "node", "label", "w")
    alone = scratch.save(alone.join(_merge(texts), "node").groupBy(*at).agg(*packed), "alone")
    lengths = scratch.save(alone.select(*at, "n"), "lengths")
    other = lengths.select("home", F.col("home").alias("home_"), *[F.col(c).alias(c + "_") for c in (*at[1:], "n")])
    pairs = scratch.save(lengths.join(_merge(other), "home").filter(once).select(*at, *[c + "_" for c in at], "n", "n_"), "pairs")
    few = F.least("n", "n_") <= FEW
    large = pairs.filter(~few)
    if large.isEmpty():
        return shared.union(_gathered(pairs, alone, at))
    used = large.select(*at).union(large.select(*[F.col(c + "_").alias(c) for c in at])).distinct()
    beside = _side_by_side(large, scratch.save(alone.join(_merge(used), list(at), "left_semi"), "large"), at)
    return shared.union(beside).union(_gathered(pairs.filter(few), alone, at))


def _side_by_side(pairs: DataFrame, blocks: DataFrame, at: tuple[str, ...]) -> DataFrame:
    """nodes, others of each pair of blocks: for pairs of large ones, which would take much room if they were sent pair by pair."""
    other = blocks.select(*[F.col(c).alias(c + "_") for c in at], F.col("nodes").alias("others"))
    return pairs.join(_merge(blocks), list(at)).join(_merge(other), [c + "_" for c in at]).select("nodes", "others")


def _gathered(pairs: DataFrame, blocks: DataFrame, at: tuple[str, ...]) -> DataFrame:
    """nodes, others of each block and all the small ones that it meets, GATHERED at a time: small ones are sent to large ones.

    A block is read and unpacked once for many small ones, and what a task gets is known by number, so that no key is hot.
    """
    names = lambda end: F.struct(*[F.col(c + end).alias(c) for c in at])
    first = F.col("n") >= F.col("n_")
    met = pairs.select(F.when(first, names("")).otherwise(names("_")).alias("to"), F.when(first, names("_")).otherwise(names("")).alias("of"))
    turn = F.floor((F.row_number().over(Window.partitionBy("to").orderBy("of")) - 1) / GATHERED).alias("turn")
    met = met.select("to", turn, "of")
    sent = met.select("to", "turn", F.lit(False).alias("own"), "of.*").union(met.select("to", "turn").distinct().select("to", "turn", F.lit(True), "to.*"))
    both = sent.join(_merge(blocks), list(at)).groupBy("to", "turn").agg(F.collect_list(F.when(F.col("own"), F.col("nodes"))).alias("nodes"), F.collect_list(F.when(~F.col("own"), F.col("nodes"))).alias("others"))
    return both.select(F.flatten("nodes").alias("nodes"), F.flatten("others").alias("others"))


def _short(lists: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, sa, sb) of short lists that may link, paired row by row.

    A pair with fewer shingles of short lists than linked sets share in their prefixes doesn't link, or shares one of a long list.
    """
    both = "node", "size", "extra", "probe"
    short = lists.filter(F.col("n") <= SHORT)
    left, right = (short.select("token", *[F.col(c).alias(c + n) for c in both]) for n in "ab")
    fits = (F.col("nodea") < F.col("nodeb")) & (F.col("probea") | F.col("probeb")) & _alike("sizea", "sizeb", percent)
    need = F.when(F.greatest("extraa", "extrab") == 0, _needed("sizea", "sizeb", percent)).otherwise(1).alias("need")
    pairs = left.join(_merge(right), "token").filter(fits).groupBy(F.col("nodea").alias("a"), F.col("nodeb").alias("b"), need).agg(F.count(F.lit(1)).alias("n")).filter("n >= need")
    return pairs.select("a", "b", F.lit(0).cast("long").alias("sa"), F.lit(0).cast("long").alias("sb"))


def _met(rows: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between nodes of different labels with a probe among them in one list, of rows (token, node, label, size, probe, home, score).

    Lists are dealt to blocks of about BLOCK nodes with their texts, two of which are compared as matrices of 0 and 1, exactly. Nodes of one
    label are compared only where few of them (under 32) share a list.
    """
    rows = rows.withColumn("w", (1 + F.floor(F.col("size") / WEIGHT)).cast("long"))
    counts = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
    few = F.when(F.col("n") < 32, F.col("w")).otherwise(0)
    mixed = counts.groupBy("token").agg(F.count(F.lit(1)).alias("labels"), F.sum(few).alias("few")).filter("labels > 1")
    mixed = scratch.save(mixed.select("token", "few"), "mixed")
    wide = rows.join(_merge(mixed.select("token")), "token")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                found = np.array([*_forest(x.values, y.values, percent)], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return map_arrow(_blocks_of_lists(counts, mixed, wide, texts, scratch), run, "a long, b long")


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(_merge(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _stars(links: DataFrame) -> DataFrame:
    """node, label: of links (a, b, sa, sb) each node's neighbour with the highest score, or itself. Nodes of one label are linked to it."""
    both = links.select(F.col("a").alias("node"), F.struct(F.col("sa").alias("s"), F.col("a").alias("k")).alias("own"), F.struct(F.col("sb").alias("s"), F.col("b").alias("k")).alias("to"))
    both = both.union(links.select("b", F.struct(F.col("sb").alias("s"), F.col("b").alias("k")), F.struct(F.col("sa").alias("s"), F.col("a").alias("k"))))
    best = both.groupBy("node").agg(F.max("to").alias("to"), F.max("own").alias("own"))
    return best.select("node", F.greatest("to", "own").getField("k").alias("label"))


def _links(lists: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, percent: int, scratch: Scratch) -> DataFrame:
    """node and label of all nodes that are linked with another."""
    pairs = scratch.save(_short(lists, percent), "short")
    long = scratch.save(lists.filter(F.col("n") > SHORT).drop("n"), "long")
    hot = not long.isEmpty()
    if hot:
        live = long.filter("probe").groupBy("token").agg(F.min("extra").alias("lowest"), F.max(F.struct("score", "node", "size", "extra")).alias("p1"), F.min(F.struct("node", "score", "size", "extra")).alias("p2"))
        rows = scratch.save(long.join(_merge(live), "token").filter("probe or extra >= lowest"), "rows")
        p2 = F.struct(*[F.col(f"p2.{c}").alias(c) for c in ("score", "node", "size", "extra")])
        ends = rows.select("node", "size", "extra", "score", F.explode(F.array("p1", p2)).alias("p")).filter((F.col("p.node") != F.col("node")) & _alike("p.size", "size", percent))
        mine = F.col("node") < F.col("p.node")
        score = lambda own: F.when(own, F.col("score")).otherwise(F.col("p.score"))
        star = ends.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b"), score(mine).alias("sa"), score(~mine).alias("sb")).distinct()
        pairs = scratch.save(pairs.union(star), "star")
    pairs = scratch.save(_sifted(pairs, nodes.select("node", "n", "sketch"), percent), "sifted")
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(long.select("node")).distinct()
    texts = scratch.save(_texts(nodes.select("node", "h1", "h2").join(_merge(used), "node", "left_semi"), docs, text), "texts")
    scratch.drop("lists", "listed", "wanted", "long")
    links = scratch.save(_verified(pairs, texts, percent), "links-1")
    if hot:
        rows = rows.select("token", "node", "size", "probe", F.col("p1.node").alias("home"), F.col("p1.score").alias("score"))
        labelled = scratch.save(_relabelled(rows, _stars(links)), "labelled")
        far = _met(labelled, texts, percent, scratch)
        links = scratch.save(links.select("a", "b").union(far).distinct(), "links")
    scratch.drop("short", "star", "sifted", "rows", "labelled", "texts", "mixed", "homes", "placed", "seen", "full", "met", "whole", "thin", "alone", "lengths", "pairs", "large")
    return components(links.select("a", "b"), scratch, "cc")


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """key (as key_name says), n_shingles and component_id of each row of docs."""
    if not 0 < percent <= 100:
        raise ValueError("the threshold is a percentage above 0")
    scratch = scratch or Scratch(docs.sparkSession, "ngrams")
    order = _common(docs, text, key, scratch)
    signed = scratch.save(_signed(docs, text, key, percent, order), "signed")
    ids = scratch.save(signed.select("id", "s1", "s2", "n"), "ids")
    one = signed.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("h1", "h2")).alias("rep"), F.min("id").alias("id"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
    nodes = scratch.save(one.select(F.monotonically_increasing_id().alias("node"), "s1", "s2", F.col("n").alias("size"), "rep", "id", "prefix", "sketch"), "nodes")
    scratch.drop("signed")
    every = scratch.save(nodes.select("node", "s1", "s2", F.col("size").alias("n"), "id", "rep.h1", "rep.h2", "sketch"), "every")
    lists = _probes(nodes, docs, text, percent, order, scratch)
    scratch.drop("nodes")
    labels = _links(lists, every.select("node", "n", "sketch", "h1", "h2"), docs, text, percent, scratch)
    every = every.drop("sketch")
    known = every.join(_merge(labels), "node")
    least = scratch.save(known.groupBy("label").agg(F.min("id").alias("least")), "least")
    placed = known.join(_merge(least), "label").select("s1", "s2", "n", "least")
    alone = every.join(_merge(labels), "node", "left_anti").select("s1", "s2", "n", F.col("id").alias("least"))
    name = key_name(docs.columns[position(docs, key)], ("n_shingles", "component_id"))
    whole = ids.join(_merge(placed.union(alone)), ["s1", "s2", "n"], "left")
    return whole.select(F.col("id").alias(name), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def op11_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Every document's component of texts with 85 % of their shingles in common."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
