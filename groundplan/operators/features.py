"""Encoders, scaling, splits and collinearity."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from groundplan.functions.text import normalize_category


def collapse_to_top_n(df: DataFrame, cols: str | list[str], n: int = 10, other: str = "Other", normalise: bool = True) -> DataFrame:
    """The n most frequent categories of each column (ties: alphabetical); the others and nulls become `other`.

    All counts are taken from df itself, so that the plan grows with the number of columns only.
    """
    cols = [cols] if isinstance(cols, str) else cols
    x = df.withColumns({c: normalize_category(c) for c in cols}) if normalise else df
    out = x
    for i, c in enumerate(cols):
        top = x.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias(f"_top{i}")).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), f"_top{i}").limit(n).select(f"_top{i}")
        out = out.join(F.broadcast(top), F.col(c) == F.col(f"_top{i}"), "left")
    return out.withColumns({c: F.coalesce(f"_top{i}", F.lit(other)) for i, c in enumerate(cols)}).drop(*[f"_top{i}" for i in range(len(cols))])


def one_hot(df: DataFrame, cols: list[str], values: dict[str, list] | None = None, keep: bool = False, most: int = 10_000) -> DataFrame:
    """A boolean column <col>_<value> for each category in order; null has none. Columns are metadata: `most` bounds them."""
    made: dict[str, Column] = {}
    for c in cols:
        found = values[c] if values else [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(most + 1).collect()]
        if len(found) > most:
            raise ValueError(f"{c} has more than {most} categories")
        made |= {f"{c}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)) for v in found}
    out = df.select("*", *[x.alias(n) for n, x in made.items()])
    return out if keep else out.drop(*cols)


def target_encoding(train: DataFrame, key: str, target: str, smoothing: float = 20.0) -> DataFrame:
    """key, encoding, global_mean: (mean * n + global * s) / (n + s)."""
    g = train.agg(F.avg(target).alias("global_mean"))
    t = train.groupBy(key).agg(F.avg(target).alias("_m"), F.count(target).alias("_n"))
    return t.crossJoin(F.broadcast(g)).select(key, ((F.col("_m") * F.col("_n") + F.col("global_mean") * smoothing) / (F.col("_n") + smoothing)).alias("encoding"), "global_mean")


def apply_target_encoding(df: DataFrame, train: DataFrame, key: str, target: str, into: str, smoothing: float = 20.0) -> DataFrame:
    """df with the key's encoding, fitted on train; unseen keys take the global mean."""
    t = target_encoding(train, key, target, smoothing).select(F.col(key).alias("_k"), F.col("encoding").alias("_e"))
    g = train.agg(F.avg(target).alias("_g"))
    return df.join(t, F.col(key).eqNullSafe(F.col("_k")), "left").crossJoin(F.broadcast(g)).withColumn(into, F.coalesce("_e", "_g")).drop("_k", "_e", "_g")


def frequency_encode(df: DataFrame, train: DataFrame, key: str, into: str) -> DataFrame:
    """df with how often train has the key; unseen: 0."""
    t = train.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return df.join(t, F.col(key) == F.col("_k"), "left").withColumn(into, F.coalesce("_n", F.lit(0))).drop("_k", "_n")


def in_test(key: str | Column, parts: int = 5, seed: int = 42) -> Column:
    """A reproducible split: one row of `parts` is for testing, by the MD5 of its key and the seed."""
    c = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", F.coalesce(c.cast("string"), F.lit("")), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % parts == 0


def standard_scale(df: DataFrame, train: DataFrame, cols: list[str]) -> DataFrame:
    """Columns as (x - mean) / population deviation of train, nulls as 0; a constant's divisor is 1."""
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    stats = train.agg(*[a for c in cols for a in (F.avg(z(c)).alias(f"_m_{c}"), F.stddev_pop(z(c)).alias(f"_s_{c}"))])
    made = {c: (z(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0) for c in cols}
    return df.crossJoin(F.broadcast(stats)).withColumns(made).select(df.columns)


def vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """feature, vif of columns (nulls as 0) without an intercept: G_ii * (G^-1)_ii of the Gram matrix, highest first."""
    z = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    k = len(cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = df.agg(*[F.sum(z[i] * z[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    g = np.zeros((k, k))
    for (i, j), v in zip(pairs, sums, strict=True):
        g[i, j] = g[j, i] = v or 0.0
    inverse = np.linalg.pinv(g)
    rows = sorted(((c, float(g[i, i] * inverse[i, i])) for i, c in enumerate(cols)), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")
