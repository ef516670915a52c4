"""Fuzzy entity matching: token-sort similarity, a join within blocks, a global join with lossless candidates.

The similarity of two names is 100 * 2 * LCS / (la + lb) of their sorted words. It is computed in Arrow batches by
bit-parallel LCS; everything that decides which pairs are compared is a DataFrame operation.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from groundplan.functions.text import name_key, pincode_key, token_sort
from groundplan.scratch import Scratch

BLOCKED, GLOBAL = 85.0, 90.0


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word of a's letters at a time."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    mask = (1 << len(a)) - 1
    v = mask
    for c in b:
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & mask
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (la + lb); two empty strings are equal."""
    total = len(a) + len(b)
    return 200.0 * lcs(a, b) / total if total else 100.0


@F.pandas_udf(T.DoubleType())
def ratio_udf(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def token_sort_ratio(a: str | Column, b: str | Column) -> Column:
    return ratio_udf(token_sort(a), token_sort(b))


def length_bound(a: Column, b: Column, cutoff: float) -> Column:
    """Whether lengths allow a similarity of the cutoff."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= cutoff * (F.length(a) + F.length(b))


def _best(scored: DataFrame, keys: list[str], cutoff: float) -> DataFrame:
    """Of each key the candidate with the highest score, the earliest of equals."""
    return scored.filter(F.col("score") >= cutoff).groupBy(*keys).agg(F.max(F.struct("score", (-F.col("idx")).alias("i"))).alias("m")).select(*keys, F.col("m.score").alias("score"), (-F.col("m.i")).alias("idx"))


#: Distinct names of a block from which on it is searched by segments instead of compared with all.
LARGE_BLOCK = 512
#: Similarities at which large blocks are searched first: a name that finds one there has its best.
STEPS = (95.0, 85.0, 75.0)


def _segments(x: DataFrame, here: str, there: str, cutoff: float) -> DataFrame:
    """x with a row for each segment of a name: start and size of the i-th of tau + 1 even parts of length lt.

    tau is the number of single insertions and deletions that the lengths ls and lt allow at the cutoff. `here` names the
    length that is known, `there` the other, which takes all values that the cutoff allows.
    """
    least, most = F.ceil(F.col(here) * cutoff / (200.0 - cutoff) - 1e-9), F.floor(F.col(here) * (200.0 - cutoff) / cutoff + 1e-9)
    x = x.withColumn(there, F.explode(F.sequence(F.greatest(least, F.lit(1)), most))).withColumn("tau", F.floor((100.0 - cutoff) * (F.col("ls") + F.col("lt")) / 100.0 + 1e-9))
    start = lambda i: F.floor(i * F.col("lt") / (F.col("tau") + 1))
    x = x.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), "tau")))
    return x.withColumn("start", start(F.col("i"))).withColumn("size", start(F.col("i") + 1) - F.col("start"))


def segment_candidates(probes: DataFrame, refs: DataFrame, cutoff: float) -> DataFrame:
    """block, s, t: the pairs of probes (block, s) and refs (block, t) that may reach the cutoff; none that does is left out.

    A similarity of the cutoff leaves at most tau single insertions and deletions between two names. Each of them touches one
    of t's tau + 1 segments at most, so that one stands in s unchanged. What is inserted and deleted before it and after it
    is tau at most, too, which bounds its place: by from (ls - lt - tau) / 2 to (ls - lt + tau) / 2 further on. Segments
    are joined on their text, lengths and number. Where tau reaches a name's length, some segments are empty and all names of
    that length are candidates: below a cutoff of about 70, little is gained.
    """
    key = lambda text: F.xxhash64("block", "ls", "lt", "i", text).alias("key")
    r = _segments(refs.select("block", "t", F.length("t").cast("long").alias("lt")).filter("lt > 0"), "lt", "ls", cutoff)
    r = r.select("block", "t", key(F.substr("t", F.col("start").cast("int") + 1, F.col("size").cast("int"))))
    p = _segments(probes.select("block", "s", F.length("s").cast("long").alias("ls")).filter("ls > 0"), "ls", "lt", cutoff)
    apart = F.col("ls") - F.col("lt")
    p = p.withColumn("at", F.explode(F.sequence(F.ceil((apart - F.col("tau")) / 2), F.floor((apart + F.col("tau")) / 2)))).withColumn("at", F.col("start") + F.col("at"))
    p = p.filter((F.col("at") >= 0) & (F.col("at") + F.col("size") <= F.col("ls")))
    p = p.select("block", "s", key(F.substr("s", F.col("at").cast("int") + 1, F.col("size").cast("int")))).distinct()
    return p.join(r, ["block", "key"]).select("block", "s", "t").distinct()


def blocked_match(probes: DataFrame, names: DataFrame, cutoff: float = BLOCKED, large: int = LARGE_BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """name, block, score, idx of probes (name, block) among names (idx, ref, block) of the same block; null is no block.

    Equal names of a block are one, and each pair of different names is scored once, in however many blocks it meets.
    Blocks of few names are compared with all of their probes. In large ones candidates come from an index of segments, at
    falling similarities: a probe that has a hit at one of STEPS has its best there and goes no further.
    """
    scratch = scratch or Scratch(probes.sparkSession, "blocked")
    p = scratch.save(probes.filter(F.col("block").isNotNull()).withColumn("s", token_sort("name")), "probes")
    r = names.filter(F.col("block").isNotNull()).withColumn("t", token_sort("ref")).groupBy("block", "t").agg(F.min("idx").alias("idx"))
    r = scratch.save(r, "names")
    hot = r.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= large).select("block")
    fits = length_bound(F.col("s"), F.col("t"), cutoff)
    asks = p.select("s", "block").distinct()
    met = asks.join(r.join(hot, "block", "left_anti").select("t", "block"), "block").filter(fits).select("s", "t").distinct()
    scored = scratch.save(met.withColumn("score", ratio_udf("s", "t")).filter(F.col("score") >= cutoff), "few")
    best = _best(p.join(r.join(hot, "block", "left_anti"), "block").filter(fits).join(scored, ["s", "t"]), ["name", "block"], cutoff)
    hot = scratch.save(hot, "hot")
    if hot.isEmpty():
        return best
    todo, refs = asks.join(hot, "block"), r.join(hot, "block")
    for k, least in enumerate([*(x for x in STEPS if x > cutoff), cutoff]):
        todo = scratch.save(todo, f"todo-{k}")
        near = scratch.save(segment_candidates(todo, refs.select("block", "t"), least), f"near-{k}")
        pairs = near.select("s", "t").distinct().withColumn("score", ratio_udf("s", "t")).filter(F.col("score") >= least)
        pairs = scratch.save(near.join(pairs, ["s", "t"]), f"scored-{k}")
        best = best.unionByName(_best(p.join(todo, ["s", "block"]).join(pairs, ["s", "block"]).join(refs, ["block", "t"]), ["name", "block"], least))
        todo = todo.join(pairs.select("s", "block").distinct(), ["s", "block"], "left_anti")
    return best


def _grams(s: Column) -> Column:
    """Distinct trigrams of a longer string; a string of four letters or fewer is one key."""
    n = F.length(s)
    return F.when(n <= 4, F.array(F.concat(F.lit("="), s))).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substr(s, i, F.lit(3)))))


def global_candidates(left: DataFrame, right: DataFrame, cutoff: float = GLOBAL) -> DataFrame:
    """Pairs (s, t) of distinct strings that may reach a cutoff of 90 or more; none that does is left out.

    At such a similarity d = la + lb - 2 LCS is at most 2 la / 9 single insertions and deletions, each of which destroys
    three trigrams at most, so x keeps n_x - 3 d of its n_x distinct ones. Then the first n_x - (n_x - 3 d) + 1 trigrams of
    both strings, the rarest first, have one in common: only these are joined. Up to four letters only equal strings
    reach 90. The table of trigram frequencies has 37**3 + rows at most for names of letters, digits and spaces.
    """
    if cutoff < 90:
        raise ValueError("the bound holds from 90 on")
    both = left.select(F.col("s").alias("x"), F.lit(0).alias("side")).union(right.select(F.col("t").alias("x"), F.lit(1).alias("side"))).distinct()
    grams = both.select("x", "side", F.explode(_grams(F.col("x"))).alias("g"))
    freq = grams.groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    ranked = grams.join(freq, "g").groupBy("x", "side").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("all"))
    lost = 3 * F.floor(2 * F.length("x") / F.lit(9)).cast("int")
    prefix = ranked.select("x", "side", F.explode(F.slice("all", 1, lost + 1)).alias("e")).select("x", "side", F.col("e.g").alias("g"))
    a = prefix.filter("side = 0").select(F.col("x").alias("s"), "g")
    b = prefix.filter("side = 1").select(F.col("x").alias("t"), "g")
    return a.join(b, "g").filter(length_bound(F.col("s"), F.col("t"), cutoff)).select("s", "t").distinct()


def global_match(probes: DataFrame, names: DataFrame, cutoff: float = GLOBAL) -> DataFrame:
    """name, score, idx of probes (name) among all names (idx, ref)."""
    p = probes.select("name").distinct().filter("name <> ''").withColumn("s", token_sort("name"))
    r = names.filter("ref <> ''").withColumn("t", token_sort("ref")).groupBy("t").agg(F.min("idx").alias("idx"))
    pairs = global_candidates(p.select("s").distinct(), r, cutoff).withColumn("score", ratio_udf("s", "t"))
    return _best(p.join(pairs, "s").join(r, "t"), ["name"], cutoff)


def match(listings: DataFrame, registry: DataFrame, row: str, society: str = "Society", pincode: str = "Pincode", name: str = "rera_project_name", code: str = "rera_pincode") -> DataFrame:
    """row, match_score, match_method, idx: the registry row of each listing.

    registry has idx (its order), a name and a code. Tier one compares within a code at 85, tier two, for probes without a
    hit there, with all names at 90. Methods: pincode_block, name_only, unmatched, no_society. Each distinct probe is
    matched once.
    """
    probes = listings.select(row, name_key(society).alias("name"), pincode_key(pincode).alias("block"))
    names = registry.filter(F.col(name).isNotNull()).select("idx", name_key(name).alias("ref"), pincode_key(code).alias("block")).filter("ref <> ''")
    distinct = probes.filter("name <> ''").select("name", "block").distinct()
    one = blocked_match(distinct, names).select("name", "block", F.col("score").alias("s1"), F.col("idx").alias("i1"))
    missed = distinct.join(one, (distinct.name == one.name) & distinct.block.eqNullSafe(one.block), "left_anti")
    two = global_match(missed, names).select("name", F.col("score").alias("s2"), F.col("idx").alias("i2"))
    x = probes.join(one, ["name", "block"], "left").join(two, "name", "left")
    hit1, hit2 = F.col("i1").isNotNull(), F.col("i2").isNotNull()
    return x.select(
        row,
        F.when(hit1, F.col("s1")).when(hit2, F.col("s2")).otherwise(F.lit(0.0)).alias("match_score"),
        F.when(F.col("name") == "", "no_society").when(hit1, "pincode_block").when(hit2, "name_only").otherwise("unmatched").alias("match_method"),
        F.when(hit1, F.col("i1")).otherwise(F.col("i2")).alias("idx"),
    )


def attach(listings: DataFrame, registry: DataFrame, row: str, columns: list[str], **how) -> DataFrame:
    """Listings with the match and the matched registry row's columns."""
    found = match(listings, registry, row, **how)
    return listings.join(found, row, "left").join(registry.select("idx", *columns), "idx", "left").drop("idx")


def report(matched: DataFrame, project: str = "rera_project_name", promoter: str = "rera_promoter_name") -> DataFrame:
    """One row: rows, matched rows, rate, counts by method, distinct projects and promoters."""
    hit = F.col("match_method").isin("pincode_block", "name_only")
    n = F.count(F.lit(1))
    by = {m: F.count_if(F.col("match_method") == m).alias(f"n_{m}") for m in ("pincode_block", "name_only", "unmatched", "no_society")}
    return matched.agg(n.alias("n_rows"), F.count_if(hit).alias("n_matched"), F.round(F.try_divide(F.count_if(hit), n), 6).alias("match_rate"), *by.values(), F.count_distinct(project).alias("n_projects"), F.count_distinct(promoter).alias("n_promoters"))
