"""Imputation with provenance: medians by group, bucket and time, centroids, layered codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from groundplan.functions.text import pincode_key, place_key
from groundplan.operators.quantiles import quantile_row, quantiles
from groundplan.operators.rows import mode_by_key
from groundplan.operators.spatial import knn_vote


def _with_medians(df: DataFrame, cols: list[str], groups: list[str]) -> DataFrame:
    """df with <col>_m0, <col>_m1, ...: the medians of the row's groups, and <col>_all; every statistic is of df itself.

    All of them come from one pass, in which a row stands once for each of its groups and once for the whole. Rows without
    a group have no median of it.
    """
    key = lambda c: F.col(c).cast("string")
    sets = [F.when(F.col(g).isNotNull(), F.struct(F.lit(i).alias("i"), key(g).alias("k"))) for i, g in enumerate(groups)] + [F.struct(F.lit(len(groups)).alias("i"), F.lit("").alias("k"))]
    found = quantiles(df.select(*cols, F.explode(F.array(*sets)).alias("_g")), cols, [0.5], "_g")
    found = found.groupBy("g").agg(*[F.max(F.when(F.col("name") == c, F.get("values", F.lit(0)))).alias(c) for c in cols])
    found = found.select("g.i", "g.k", *cols)
    out = df
    for i, g in enumerate(groups):
        table = found.filter(F.col("i") == i).select(F.col("k").alias(f"_g_m{i}"), *[F.col(c).alias(f"{c}_m{i}") for c in cols])
        out = out.join(table, key(g) == F.col(f"_g_m{i}"), "left")
    whole = found.filter(F.col("i") == len(groups)).agg(*[F.max(c).alias(f"{c}_all") for c in cols])  # one row, also without values
    return out.crossJoin(F.broadcast(whole))


def _filled(df: DataFrame, cols: list[str], groups: list[str], flags: dict[str, Column]) -> DataFrame:
    """Missing values of the columns from the first group that has a median, else the global one; flags are added."""
    x = _with_medians(df, cols, groups)
    made = flags | {c: F.coalesce(F.col(c).cast("double"), *[f"{c}_m{i}" for i in range(len(groups))], f"{c}_all") for c in cols}
    return x.withColumns(made).select(*df.columns, *[f for f in flags if f not in df.columns])


def group_median_impute(df: DataFrame, cols: str | list[str], group: str) -> DataFrame:
    """Missing values take their group's median, else the global one; <col>_was_missing flags them."""
    cols = [cols] if isinstance(cols, str) else cols
    return _filled(df, cols, [group], {f"{c}_was_missing": F.col(c).isNull() for c in cols})


def bucketed_median_impute(df: DataFrame, col: str, bucket_on: str, n_bins: int = 5) -> DataFrame:
    """Missing values take the median of their quantile bucket of another column, else the global one; all are rounded half to even."""
    edges = quantile_row(df, [bucket_on], [i / n_bins for i in range(n_bins + 1)]).select(F.array_distinct(F.col(f"`{bucket_on}`")).alias("_edges"))
    inner = F.slice(F.col("_edges"), 2, F.greatest(F.size("_edges") - 2, F.lit(0)))
    bucket = F.when(F.col(bucket_on).isNotNull(), F.size(F.filter(inner, lambda e: e < F.col(bucket_on))))
    x = group_median_impute(df.crossJoin(F.broadcast(edges)).withColumn("_bucket", bucket), col, "_bucket")
    return x.withColumn(col, F.rint(col)).drop("_edges", "_bucket")


def time_group_impute(df: DataFrame, cols: str | list[str], time_cols: list[str]) -> DataFrame:
    """Missing values take the median of the first time column's group that has one, else the global; medians are of observed values."""
    cols = [cols] if isinstance(cols, str) else cols
    return _filled(df, cols, time_cols, {f"{c}_was_missing": F.col(c).isNull() for c in cols})


def centroid_impute(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude", keys: tuple[str, ...] = ("Locality", "Pincode")) -> DataFrame:
    """Coordinates from the median of the first key that has one, else the global, each by itself; geo_was_missing: either was."""
    return _filled(df, [lat, lon], list(keys), {"geo_was_missing": F.col(lat).isNull() | F.col(lon).isNull()})


def layered_impute(
    df: DataFrame, code: str = "Pincode", society: str = "Society", locality: str = "Locality", lat: str = "Latitude", lon: str = "Longitude", k: int = 15
) -> DataFrame:
    """A code from the society's mode, a distance-weighted vote of neighbours, or the locality's mode, in this order.

    Adds <code>_was_missing and <code>_impute_source (observed, society_mode, geo_knn, locality_mode, unimputed). Only
    observed codes and coordinates vote, and only if more than k rows have both.
    """
    x = df.withColumns({"_pin": pincode_key(code), "_soc": place_key(society), "_loc": place_key(locality)})
    x = x.withColumns({"_lat": F.col(lat).cast("double"), "_lon": F.col(lon).cast("double")})
    by_society = mode_by_key(x, "_soc", "_pin", "_m1").withColumnRenamed("_soc", "_k1")
    by_locality = mode_by_key(x, "_loc", "_pin", "_m3").withColumnRenamed("_loc", "_k3")
    train = x.filter(F.col("_pin").isNotNull() & F.col("_lat").isNotNull() & F.col("_lon").isNotNull()).select("_lat", "_lon", "_pin")
    asks = x.filter(F.col("_pin").isNull() & F.col("_lat").isNotNull() & F.col("_lon").isNotNull()).select("_lat", "_lon")
    votes = knn_vote(train, asks, "_lat", "_lon", "_pin", k).select(F.col("_lat").alias("_kx"), F.col("_lon").alias("_ky"), F.col("_pin").alias("_m2"))
    x = x.join(by_society, F.col("_soc") == F.col("_k1"), "left").join(votes, (F.col("_lat") == F.col("_kx")) & (F.col("_lon") == F.col("_ky")), "left")
    x = x.join(by_locality, F.col("_loc") == F.col("_k3"), "left")
    layers = (("observed", "_pin"), ("society_mode", "_m1"), ("geo_knn", "_m2"), ("locality_mode", "_m3"))
    source = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(name)) for name, c in layers], F.lit("unimputed"))
    made = {f"{code}_was_missing": F.col("_pin").isNull(), f"{code}_impute_source": source, code: F.coalesce(*[F.col(c) for _, c in layers])}
    return x.withColumns(made).select(*df.columns, f"{code}_was_missing", f"{code}_impute_source")
