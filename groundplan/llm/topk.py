"""Exact top-k inner-product search with a ball tree in each shard.

Rows are dealt to shards of about SHARD vectors by a hash of their row number, which no hot value can skew; a shard is
packed into one record with its ball tree: vectors in leaf order, and for each node a centre and a radius. Queries are
packed into blocks. Shards are dealt to lanes; a task is one block and one lane, reads the block once and then the lane's
shards one after the other, and carries each query's k best along, so that the kth score of the earlier shards prunes the
later ones. With several lanes, a first pass over one shard gives all lanes a floor under each query's kth score.

In a tree, (query, node) pairs descend level by level; a pair is dropped when the largest inner product that the node's
ball allows, q.c + |q| r, is below the query's kth score. The leaves that are left are visited in waves of 1, 2, 4, ... leaves, each query's
most promising first, with the kth score raised between waves. Bounds are widened by more than the rounding of doubles, and a
bound equal to the kth score isn't pruned, so that ties go to the smaller id exactly.

Scores are exact integers: products of doubles where no product of the table can reach 2**53, else 64-bit integers. A
component or score beyond a long counts as the nearest long.

Defined results: vectors that are null, empty or hold null, NaN or infinite components take no part; a shorter vector
counts as padded with zeros; equal rows are different candidates, and a query never meets its own row but does meet an
equal one; without candidates there are no rows; a key named like a result column is returned under another (key_name).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from groundplan.llm.frames import key_name, map_arrow
from groundplan.scratch import Scratch

SHARD = 8192
BLOCK = 4096
LEAF = 128


def ball_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """An order of the rows, and the levels of a balanced tree: starts, ends, centres and radii of its nodes.

    Nodes 2i and 2i + 1 of a level are the halves of node i of the level above, split along the direction between two far
    points. The last level's nodes are the leaves.
    """
    order = np.arange(len(x))
    starts, ends, levels = np.array([0]), np.array([len(x)]), []
    while True:
        centres = np.stack([x[order[a:b]].mean(0) if b > a else np.zeros(x.shape[1]) for a, b in zip(starts, ends, strict=True)])
        radii = np.array([np.sqrt(((x[order[a:b]] - c) ** 2).sum(1).max(initial=0.0)) for a, b, c in zip(starts, ends, centres, strict=True)])
        levels.append((starts, ends, centres, radii))
        if (ends - starts).max() <= leaf:
            return order, levels
        middles = (starts + ends) // 2
        for a, b, m, c in zip(starts, ends, middles, centres, strict=True):
            if b - a > 1:
                rows = x[order[a:b]]
                far = rows[np.argmax(((rows - c) ** 2).sum(1))]
                other = rows[np.argmax(((rows - far) ** 2).sum(1))]
                order[a:b] = order[a:b][np.argpartition(rows @ (other - far), m - a)]
        starts, ends = np.stack([starts, middles], 1).ravel(), np.stack([middles, ends], 1).ravel()


NOTHING = np.iinfo(np.int64).min
BEYOND = float(2**63 - 2**53)


class Best:
    """The k best of each query so far: scores descending, ties by ascending id. No candidate below `floor` is wanted."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.floor = np.full(n, NOTHING) if floor is None else floor
        self.score = np.full((n, k), NOTHING)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.row = np.full((n, k), -1)

    def least(self) -> np.ndarray:
        """What a candidate must reach, as an integer (NOTHING: any will do)."""
        return np.maximum(self.score[:, -1], self.floor)

    def kth(self) -> np.ndarray:
        """The same as a double that is not above it."""
        least = self.least()
        return np.where(least == NOTHING, -np.inf, least - np.abs(least) * 2.0**-52)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Offer candidates to the queries q: score is len(q) x n integers; NOTHING doesn't count. Only rows that reach their least are sorted."""
        some = np.flatnonzero((score >= np.maximum(self.least()[q], NOTHING + 1)[:, None]).any(1))
        if not len(some):
            return
        q, score = q[some], score[some]
        s = np.hstack([self.score[q], score])
        i = np.hstack([self.id[q], np.broadcast_to(ids, score.shape)])
        r = np.hstack([self.row[q], np.broadcast_to(rows, score.shape)])
        order = np.lexsort((r, i, ~s), axis=1)[:, : self.k]
        self.score[q], self.id[q], self.row[q] = (np.take_along_axis(a, order, 1) for a in (s, i, r))


def products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; exact: doubles can't hold them all, so 64-bit integers, whose overflow cancels out in sums."""
    rough = q @ x.T
    if not exact:
        return rough.astype(np.int64)
    whole = _longs(q) @ _longs(x).T
    whole[rough >= BEYOND] = np.iinfo(np.int64).max
    whole[rough <= -BEYOND] = NOTHING + 1
    return whole


def _longs(x: np.ndarray) -> np.ndarray:
    """Integers of doubles that hold integers; what a long can't hold is only found in products that are beyond it too."""
    return np.clip(x, -BEYOND, BEYOND).astype(np.int64)


def search(queries: np.ndarray, query_rows: np.ndarray, shard: dict, best: Best, exact: bool = False) -> int:
    """Offer a shard's vectors to all queries; returns how many inner products it took."""
    width = max(queries.shape[1], shard["x"].shape[1])
    q, x = _wide(queries, width), _wide(shard["x"], width)
    norm = np.sqrt((q**2).sum(1))
    levels = shard["levels"]
    qi = np.arange(len(q))
    node = np.zeros(len(q), np.int64)
    bound = np.full(len(q), np.inf)
    for depth, (_, _, centres, radii) in enumerate(levels):
        if depth:
            qi, node = np.repeat(qi, 2), np.stack([2 * node, 2 * node + 1], 1).ravel()
        reach = np.empty(len(qi))
        by = np.argsort(node, kind="stable")
        cuts = np.flatnonzero(np.diff(node[by])) + 1
        c = _wide(centres, width)
        size = np.sqrt((c**2).sum(1))
        for part in np.split(by, cuts):
            if len(part):
                reach[part] = q[qi[part]] @ c[node[part[0]]]
        slack = norm[qi] * radii[node]
        bound = reach + slack + 1e-9 * (1 + norm[qi] * size[node] + slack)
        on = bound >= best.kth()[qi]
        qi, node, bound = qi[on], node[on], bound[on]
    starts, ends = levels[-1][:2]
    order = np.lexsort((-bound, qi))
    qi, node, bound = qi[order], node[order], bound[order]
    wave = np.log2(np.arange(len(qi)) - np.searchsorted(qi, qi) + 1).astype(np.int64)
    work = 0
    for t in range(int(wave.max(initial=-1)) + 1):
        now = np.flatnonzero((wave == t) & (bound >= best.kth()[qi]))
        now = now[np.argsort(node[now], kind="stable")]
        for part in np.split(now, np.flatnonzero(np.diff(node[now])) + 1):
            if not len(part):
                continue
            a, b = starts[node[part[0]]], ends[node[part[0]]]
            score = products(q[qi[part]], x[a:b], exact)
            work += score.size
            score[query_rows[qi[part], None] == shard["rows"][a:b]] = NOTHING
            best.add(qi[part], score, shard["ids"][a:b], shard["rows"][a:b])
    return work


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _matrix(col) -> np.ndarray:
    width = max(map(len, col), default=0)
    out = np.zeros((len(col), width))
    for i, v in enumerate(col):
        out[i, : len(v)] = v
    return out


def _pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    x = _matrix(pdf["v"].tolist())
    order, levels = ball_tree(x)
    packed = {"x": x[order], "ids": pdf["id"].to_numpy(np.int64)[order], "rows": pdf["rid"].to_numpy(np.int64)[order], "levels": levels}
    return pd.DataFrame({"shard": [pdf["part"].iloc[0]], "tree": [pickle.dumps(packed)]})


def _pack_block(pdf: pd.DataFrame) -> pd.DataFrame:
    packed = {"x": _matrix(pdf["v"].tolist()), "ids": pdf["id"].to_numpy(np.int64), "rows": pdf["rid"].to_numpy(np.int64)}
    return pd.DataFrame({"block": [pdf["part"].iloc[0]], "queries": [pickle.dumps(packed)]})


def _met(blocks: DataFrame, trees: DataFrame, n_blocks: int, lanes: int) -> DataFrame:
    """block, lane, queries, tree: for each block and lane one row with the block, then one for each of the lane's shards."""
    series = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    nothing = F.lit(None).cast("binary")
    heads = blocks.select("block", F.explode(series(lanes)).alias("lane"), F.lit(-1).cast("long").alias("shard"), "queries", nothing.alias("tree"))
    shards = trees.select(F.explode(series(n_blocks)).alias("block"), F.pmod("shard", F.lit(lanes)).alias("lane"), "shard", nothing.alias("queries"), "tree")
    return heads.union(shards).repartition("block", "lane").sortWithinPartitions("block", "lane", "shard").select("block", "lane", "queries", "tree")


def _searched(met: DataFrame, k: int, exact: bool, emit: Callable[[int, dict, Best], pa.RecordBatch], schema: str) -> DataFrame:
    """emit(block number, block, its k best) of each block and lane."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, best, block = None, None, None
        for batch in it:
            for i in range(batch.num_rows):
                if batch.column("queries")[i].is_valid:
                    if best is not None:
                        yield emit(number, block, best)
                    number, block = batch.column("block")[i].as_py(), pickle.loads(batch.column("queries")[i].as_py())
                    best = Best(len(block["ids"]), k, block.get("floor"))
                else:
                    search(block["x"], block["rows"], pickle.loads(batch.column("tree")[i].as_py()), best, exact)
        if best is not None:
            yield emit(number, block, best)

    return map_arrow(met, run, schema)


def _floored(number: int, block: dict, best: Best) -> pa.RecordBatch:
    """The block with its kth scores as floors."""
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([pickle.dumps(block | {"floor": best.least()})], pa.binary())], names=["block", "queries"])


def _found(number: int, block: dict, best: Best) -> pa.RecordBatch:
    q, j = np.nonzero(best.score > NOTHING)
    return pa.RecordBatch.from_arrays(
        [pa.array(block["rows"][q]), pa.array(block["ids"][q]), pa.array(best.id[q, j]), pa.array(best.row[q, j]), pa.array(best.score[q, j])], names=["query_row", "query_id", "id", "row", "score"]
    )


def top_k(table: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0, tasks: int | None = None) -> DataFrame:
    """query_id, rank, key, score (floor(scale * x) integers' inner product) of each query's k best other rows."""
    spark = table.sparkSession
    scratch = Scratch(spark, "topk")
    v = F.transform(F.col(f"`{vector}`"), lambda e: e.cast("double"))
    fine = (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    floor = F.transform(v, lambda e: F.floor(e * scale).cast("double"))
    rows = table.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.when(fine, floor).alias("v"))
    rows = scratch.save(rows.filter("v is not null and id is not null"), "rows")
    most = F.max(F.size("v") * F.pow(F.array_max(F.transform("v", F.abs)), F.lit(2.0)))
    n, n_queries, largest = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)), F.coalesce(most, F.lit(0.0))).first()
    n_shards, n_blocks = -(-n // SHARD), -(-n_queries // BLOCK)
    exact = largest >= 2.0**53

    def deal(df: DataFrame, parts: int, seed: int) -> DataFrame:
        return df.withColumn("part", F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(max(parts, 1)).cast("long")))

    name = key_name(key, ("query_id", "rank", "score"))
    if not n_queries:
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(name), F.col("id").alias("score"))
    trees = scratch.save(deal(rows, n_shards, 1).groupBy("part").applyInPandas(_pack_shard, "shard long, tree binary"), "trees")
    blocks = scratch.save(deal(rows.filter("asks"), n_blocks, 2).groupBy("part").applyInPandas(_pack_block, "block long, queries binary"), "blocks")
    lanes = max(1, min(n_shards, (tasks or spark.sparkContext.defaultParallelism) // n_blocks))
    if lanes > 1:
        first = _met(blocks, trees.filter("shard = 0"), n_blocks, 1)
        blocks = scratch.save(_searched(first, k, exact, _floored, "block long, queries binary"), "floored")
    found = _searched(_met(blocks, trees, n_blocks, lanes), k, exact, _found, "query_row long, query_id long, id long, row long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(name), "score")


def op7_topk_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best inner products of each row whose id is divisible by 20."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table, F.col("vec_id") % 20 == 0)
