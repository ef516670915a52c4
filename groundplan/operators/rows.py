"""Filters, deduplication, unions and lookups over rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T


def reindex(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order: absent ones null, others dropped, values coerced."""
    have = set(df.columns)
    return df.select([(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def valid_rows(df: DataFrame, price: str = "Price_INR", area: str = "Area_Sqft") -> DataFrame:
    """Rows with a positive price and area."""
    return df.filter((F.col(price) > 0) & (F.col(area) > 0))


def in_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows whose value is within the bounds, which count; a bound that is None doesn't bound, nulls fall out."""
    test = F.col(col).isNotNull()
    for bound, side in ((lo, F.col(col) >= F.lit(lo)), (hi, F.col(col) <= F.lit(hi))):
        test = test & side if bound is not None else test
    return df.filter(test)


def members(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a table."""
    return df.join(table.select(key), key, "left_semi")


def first_per_key(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """The first row of each key in the given order; null is a key as any other."""
    keys, orders = ([key] if isinstance(key, str) else key), ([order] if isinstance(order, str) else order)
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*orders))).filter("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("_rn") <= n).drop("_rn")


def duplicate_flag(df: DataFrame, key: str, into: str = "is_duplicate_url") -> DataFrame:
    """True for rows whose key (null as well) occurs more than once.

    Keys are counted with partial aggregation and joined back, so that a hot key, null among them, is no single window.
    """
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return df.join(counts, F.col(key).eqNullSafe(F.col("_k")), "left").withColumn(into, F.col("_n").isNotNull()).drop("_k", "_n")


def full_row_dedup(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls being equal."""
    return df.dropDuplicates()


def union_dedup(first: DataFrame, second: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Both inputs in one schema, equal rows once."""
    if schema is not None:
        first, second = reindex(first, schema), reindex(second, schema)
    return full_row_dedup(first.unionByName(second))


def unseen(candidates: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Candidates whose key was not seen yet."""
    return candidates.join(seen.select(key), key, "left_anti")


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default=None) -> DataFrame:
    """df with `value` of the table by key; default where there is none."""
    out = df.join(table.select(key, value), key, "left")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), default if isinstance(default, Column) else F.lit(default)))


def mode_by_key(df: DataFrame, key: str, value: str, into: str = "mode") -> DataFrame:
    """Each key's most frequent value, the smallest of several; null keys and values don't count."""
    counts = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.min_by(F.col(value), F.struct(-F.col("_n"), F.col(value))).alias(into))


def site_limit(df: DataFrame, site: str, order: list[str], limit: int) -> DataFrame:
    """At most `limit` rows of each site (0: all)."""
    return df if not limit else top_per_group(df, [site], [F.col(c) for c in order], limit)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows, the same for a seed whatever the partitioning: those with the least MD5 of key and seed."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def checked_loss(n_before: int, n_after: int, budget_pct: float = 5.0) -> float:
    """Per cent of rows lost, to two digits; ValueError beyond the budget."""
    loss = round(100 * (n_before - n_after) / n_before, 2) if n_before else 0.0
    if loss > budget_pct:
        raise ValueError(f"data loss {loss}% exceeds the {budget_pct}% budget ({n_before - n_after:,} of {n_before:,} rows dropped)")
    return loss


class Counted:
    """Counts the rows of a table while it is written, without a job of its own."""

    def __init__(self):
        self._seen = Observation()

    def watch(self, df: DataFrame, **also: Column) -> DataFrame:
        """df, which counts its rows, and those for which a condition in `also` holds, when it runs."""
        return df.observe(self._seen, F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in also.items()])

    def __getitem__(self, name: str) -> int:
        return self._seen.get[name]

    @property
    def n(self) -> int:
        return self["n"]


def keep_within_budget(df: DataFrame, keep: Column, write: Callable[[DataFrame], None], budget_pct: float = 5.0) -> tuple[int, int, float]:
    """Write the rows that `keep` holds for; how many there were, how many were kept, per cent lost. One pass over df.

    ValueError beyond the budget: `write` should not publish what it writes before this returns.
    """
    counted = Counted()
    write(counted.watch(df, kept=keep).filter(keep))
    return counted.n, counted["kept"], checked_loss(counted.n, counted["kept"], budget_pct)


def paged_until_empty(pages: DataFrame, page: str, links: str) -> DataFrame:
    """Links of numbered pages up to the first page that has none."""
    stop = pages.filter(F.size(links) <= 0).agg(F.min(page).alias("_stop"))
    return pages.crossJoin(F.broadcast(stop)).filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).select(page, F.explode(links).alias("url"))
