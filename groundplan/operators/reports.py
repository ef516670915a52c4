"""Summary tables; each is one aggregation over the data and then an unpivot of its single row."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from groundplan.operators.quantiles import quantile_row, quantiles_by_group
from groundplan.operators.rows import seeded_sample

#: How each flagged column was imputed.
METHODS = {
    "BHK": "median of the area bucket", "Bathrooms": "median of the bedrooms", "Balconies": "median of the bedrooms", "Car_Parking": "median of the bedrooms",
    "Floor_Number": "median of the bedrooms", "Total_Floors": "median of the bedrooms", "Property_Age_Years": "median of the bedrooms",
    "Pincode": "society mode, neighbours' vote, locality mode", "geo": "centroid of locality or pincode",
    "Cement_Price_Rs_per_bag_50kg": "median of the month or year", "Steel_TMT_Price_Rs_per_tonne": "median of the month or year",
}


def _unpivot(row: DataFrame, names: dict[str, list[str]], key: str, values: list[str]) -> DataFrame:
    """Rows (key, values...) from one row's columns: names[key value] lists the columns in order of the values."""
    items = F.array(*[F.struct(F.lit(k).alias(key), *[F.col(f"`{c}`").alias(v) for c, v in zip(cs, values, strict=True)]) for k, cs in names.items()])
    return row.select(F.inline(items))


def missingness(df: DataFrame) -> DataFrame:
    """column, missing_pct to two digits, highest first."""
    row = df.agg(*[F.round(F.avg(F.col(f"`{c}`").isNull().cast("int")) * 100, 2).alias(c) for c in df.columns])
    return _unpivot(row, {c: [c] for c in df.columns}, "column", ["missing_pct"]).orderBy(F.desc("missing_pct"), "column")


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """column, count, mean, std, min, seven percentiles, max."""
    qs = (1, 5, 25, 50, 75, 95, 99)
    aggs, names = [], {}
    for c in cols:
        x = F.col(c).cast("double")
        made = {"count": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        aggs += [a.alias(f"{c}|{k}") for k, a in made.items()]
        names[c] = [f"{c}|{k}" for k in ("count", "mean", "std", "min", *[f"p{q}" for q in qs], "max")]
    ranks = quantile_row(df, cols, [q / 100 for q in qs])
    ranks = ranks.select(*[F.get(F.col(f"`{c}`"), F.lit(i)).alias(f"{c}|p{q}") for c in cols for i, q in enumerate(qs)])
    return _unpivot(df.agg(*aggs).crossJoin(ranks), names, "column", ["count", "mean", "std", "min", *[f"p{q}" for q in qs], "max"])


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """value, count of non-null values, most frequent first, ties by value; the n first."""
    out = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value")
    return out if n is None else out.limit(n)


def top_categories(df: DataFrame, col: str, n: int = 15) -> DataFrame:
    return value_counts(df, col, n)


def sorted_counts(df: DataFrame, col: str) -> DataFrame:
    """value, count of non-null values in the order of the values."""
    return value_counts(df, col).orderBy("value")


def top_groups(df: DataFrame, key: str, value: str, least: int = 20, n: int = 15) -> DataFrame:
    """key, n, median of the n groups with the highest median of a value among those with at least `least` rows."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    middle = quantiles_by_group(df, [value], [0.5], key, "_g").select(F.col("_g"), F.get(F.col(f"`{value}`"), F.lit(0)).alias("median"))
    return counts.join(middle, F.col("key") == F.col("_g"), "left").drop("_g").orderBy(F.desc("median"), "key").limit(n)


def shapiro_wilk(df: DataFrame, col: str, key: str, most: int = 5000) -> tuple[float, float] | None:
    """Statistic and p-value of the Shapiro-Wilk test (Royston's approximation, 1995) over at most `most` rows chosen by `key`.

    The sample's size is what the test is made for: beyond 5,000 values its p-value isn't known well. None below three
    values or for constants.
    """
    most = min(most, 5000)
    sample = seeded_sample(df.filter(F.col(col).isNotNull()).select(key, F.col(col).cast("double").alias("_v")), key, most)
    return normality(np.array([r["_v"] for r in sample.collect()]))


def normality(values: np.ndarray) -> tuple[float, float] | None:
    """W and p of a sample."""
    x = np.sort(values)
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return None
    normal = NormalDist()
    m = np.array([normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    square, u = float(m @ m), n**-0.5
    a = np.empty(n)
    if n == 3:
        a[:] = (-(0.5**0.5), 0.0, 0.5**0.5)
    else:
        last = m[-1] / square**0.5 + np.polyval((-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, 0.0), u)
        if n > 5:
            before = m[-2] / square**0.5 + np.polyval((-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0), u)
            scale = (square - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * before**2)
            a = m / scale**0.5
            a[-2], a[1] = before, -before
        else:
            a = m / ((square - 2 * m[-1] ** 2) / (1 - 2 * last**2)) ** 0.5
        a[-1], a[0] = last, -last
    w = min(1.0, float(a @ x) ** 2 / float(((x - x.mean()) ** 2).sum()))
    if n == 3:
        return w, max(0.0, 6 / np.pi * (np.arcsin(w**0.5) - np.arcsin(0.75**0.5)))
    log = np.log(n)
    if n <= 11:
        y, mean, spread = -np.log(0.459 * n - 2.273 - np.log1p(-w)), np.polyval((-0.0006714, 0.025054, -0.39978, 0.544), n), np.exp(np.polyval((-0.0020322, 0.062767, -0.77857, 1.3822), n))
    else:
        y, mean, spread = np.log1p(-w), np.polyval((0.0038915, -0.083751, -0.31082, -1.5861), log), np.exp(np.polyval((0.0030302, -0.082676, -0.4803), log))
    return w, 1 - normal.cdf((y - mean) / spread)


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows that have both; null for constants."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    sx, sy = F.stddev_pop(F.when(b.isNotNull(), a)), F.stddev_pop(F.when(a.isNotNull(), b))
    return F.covar_pop(a, b) / F.nullif(sx * sy, F.lit(0.0))


def correlation_with_target(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """feature, correlation, strongest first."""
    features = [c for c in cols if c != target]
    row = df.agg(*[correlation(c, target).alias(c) for c in features])
    return _unpivot(row, {c: [c] for c in features}, "feature", ["correlation"]).orderBy(F.desc(F.abs("correlation")), "feature")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """a, b, correlation of every pair once, a before b in the list."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    row = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    items = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("correlation")) for a, b in pairs])
    return row.select(F.inline(items))


def imputation_summary(df: DataFrame) -> DataFrame:
    """column, rows_imputed, pct_imputed, method of each <column>_was_missing that df has, most first."""
    cols = [c.removesuffix("_was_missing") for c in df.columns if c.endswith("_was_missing")]
    row = df.agg(*[a for c in cols for a in (F.count_if(f"{c}_was_missing").alias(f"{c}|n"), F.round(100 * F.avg(F.col(f"{c}_was_missing").cast("int")), 2).alias(f"{c}|p"))])
    methods = F.create_map(*[F.lit(x) for kv in METHODS.items() for x in kv])
    out = _unpivot(row, {c: [f"{c}|n", f"{c}|p"] for c in cols}, "column", ["rows_imputed", "pct_imputed"])
    return out.withColumn("method", F.coalesce(F.try_element_at(methods, F.col("column")), F.lit("imputed"))).orderBy(F.desc("rows_imputed"), "column")


def sample_skewness(x: str | Column) -> Column:
    """Skewness adjusted for the sample's size; null below three values or for constants."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.count(x).cast("double")
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def sample_kurtosis(x: str | Column) -> Column:
    """Excess kurtosis adjusted for the sample's size; null below four values or for constants."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.count(x).cast("double")
    return F.when(n > 3, ((n + 1) * F.kurtosis(x) + 6) * (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)))


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """n_rows, n_duplicate_rows, n_duplicate_keys."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("n_duplicate_rows"))
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(F.col("_n") - 1).alias("n_duplicate_keys"))
    return rows.crossJoin(keys)


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """bin (0...), count over equal widths from minimum to maximum."""
    ends = df.agg(F.min(col).cast("double").alias("_lo"), F.max(col).cast("double").alias("_hi"))
    b = F.least(F.floor((F.col(col) - F.col("_lo")) / F.nullif((F.col("_hi") - F.col("_lo")) / bins, F.lit(0.0))), F.lit(bins - 1))
    return df.filter(F.col(col).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(b, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def overview(df: DataFrame, price: str = "Price_INR", area: str = "Area_Sqft", deal: str = "deal_type") -> DataFrame:
    """One row of counts, means and medians by deal type."""
    of = lambda d: F.when(F.col(deal) == d, F.col(price))
    middle = quantile_row(df, {"sale": of("Sale"), "rent": of("Rent")}, [0.5])
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(deal) == d).alias(f"n_{d.lower()}") for d in ("Sale", "Rent", "Lease", "Unknown")],
        F.rint(F.avg(of("Sale"))).alias("mean_sale_price"),
        F.bround(F.avg(area), 1).alias("mean_area"),
    )
    medians = middle.select(F.rint(F.get("sale", F.lit(0))).alias("median_sale_price"), F.rint(F.get("rent", F.lit(0))).alias("median_rent"))
    out = counted.crossJoin(medians)
    return out.select(*[c for c in out.columns if c != "mean_area"], "mean_area")
