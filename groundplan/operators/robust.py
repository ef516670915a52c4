"""Exact quantiles, winsorizing and percentile filters.

Quantiles interpolate linearly over non-null values. Group results are a small table joined back, never a window over a
whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from groundplan.functions.numeric import clip
from groundplan.operators.quantiles import quantile_row, quantiles_by_group


def bounds(df: DataFrame, cols: list[str], lo: float = 0.01, hi: float = 0.99, group: str | None = None) -> DataFrame:
    """[group,] lo_<col>, hi_<col> of each column."""
    table = quantiles_by_group(df, cols, [lo, hi], group, "_g") if group else quantile_row(df, cols, [lo, hi])
    ends = [F.get(F.col(f"`{c}`"), F.lit(i)).alias(f"{n}_{c}") for c in cols for i, n in ((0, "lo"), (1, "hi"))]
    return table.select(*([F.col("_g").alias(group)] if group else []), *ends)


def percentile_filter(df: DataFrame, cols: list[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Rows within the band of every column, all bands from the whole input; nulls fall out."""
    test = F.lit(True)
    for c in cols:
        test = test & F.col(c).between(F.col(f"lo_{c}"), F.col(f"hi_{c}"))
    return df.crossJoin(F.broadcast(bounds(df, cols, lo, hi))).filter(test).select(df.columns)


def percentile_filter_in_turn(df: DataFrame, cols: list[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """As percentile_filter, each column's band from the rows that the columns before it left."""
    for c in cols:
        df = percentile_filter(df, [c], lo, hi)
    return df


def winsorize(df: DataFrame, cols: list[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Columns clipped to their own band; nulls stay."""
    made = {c: clip(F.col(c).cast("double"), F.col(f"lo_{c}"), F.col(f"hi_{c}")) for c in cols}
    return df.crossJoin(F.broadcast(bounds(df, cols, lo, hi))).withColumns(made).select(df.columns)


def winsorize_by_group(df: DataFrame, cols: list[str], group: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Columns clipped to the band of their row's group; rows without a group get no value, as they have no band."""
    table = bounds(df.filter(F.col(group).isNotNull()), cols, lo, hi, group).withColumnRenamed(group, "_group")
    made = {c: F.when(F.col("_group").isNotNull(), clip(F.col(c).cast("double"), F.col(f"lo_{c}"), F.col(f"hi_{c}"))) for c in cols}
    return df.join(table, F.col(group) == F.col("_group"), "left").withColumns(made).select(df.columns)
