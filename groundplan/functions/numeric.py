"""Column builders for numbers; null in, null out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from groundplan.functions.text import col

#: Square feet in a unit of area (fixed values).
SQFT_PER = {
    "sq.ft.": 1.0, "sq.ft": 1.0, "sq. yards": 9.0, "sq.yards": 9.0, "sq. meter": 10.7639, "sq.meter": 10.7639,
    "acre": 43560.0, "cent": 435.6, "guntha": 1089.0, "ares": 1076.39, "hectares": 107639.0,
}


def sqft_per(unit: str | Column) -> Column:
    """Square feet of a unit's name, 1 for others."""
    table = F.create_map(*[F.lit(x) for kv in SQFT_PER.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(col(unit))), F.lit(1.0))


def clip(x: str | Column, lo, hi) -> Column:
    """x within [lo, hi]; null stays null, and a null bound doesn't bound."""
    x, lo, hi = col(x), lo if isinstance(lo, Column) else F.lit(lo), hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """a / b within [0, 1]; 0 where it has no value."""
    return clip(F.coalesce(F.try_divide(col(a).cast("double"), F.nullif(col(b).cast("double"), F.lit(0.0))), F.lit(0.0)), 0.0, 1.0)


def safe_ratio_positive(a: str | Column, b: str | Column) -> Column:
    """As safe_ratio, 0 where b isn't positive."""
    return F.when(col(b) > 0, safe_ratio(a, b)).otherwise(F.lit(0.0))


def age_group(years: str | Column) -> Column:
    """New, 1-5, 6-10 or 10+ years; '' for null."""
    y = col(years)
    return F.when(y.isNull(), "").when(y <= 1, "New").when(y <= 5, "1-5 Years").when(y <= 10, "6-10 Years").otherwise("10+ Years")


def half_even(x: str | Column, digits: int = 0) -> Column:
    """Rounded half to even."""
    return F.rint(col(x)) if digits == 0 else F.bround(col(x), digits)


def derived_prices(price: Column, area: Column) -> dict[str, Column]:
    """Price_INR, Price_Cr, Area_Sqft and PricePerSqft of raw values; zero counts as missing."""
    p, a = F.when(price != 0, price), F.when(area != 0, area)
    return {"Price_INR": half_even(p), "Price_Cr": half_even(p / 1e7, 4), "Area_Sqft": half_even(a, 2), "PricePerSqft": half_even(F.try_divide(p, a), 2)}


def next_run(now, at: str | None = None, every_hours: float | None = None):
    """When a schedule runs next: at HH:MM today, or tomorrow if that has come, or some hours from now."""
    import datetime as dt

    if at is None:
        return now + dt.timedelta(hours=every_hours or 0)
    hour, minute = map(int, at.split(":"))
    then = now.replace(hour=hour, minute=minute, second=0, microsecond=0)
    return then if then > now else then + dt.timedelta(days=1)


def otsu(histogram, level: str = "level", n: str = "n", key: str | None = None):
    """The level that splits a histogram with the largest variance between its sides (ties: the lowest); [key,] threshold.

    The window runs over the levels of one image, 256 at most.
    """
    from pyspark.sql import Window

    keys = [key] if key else []
    w = Window.partitionBy(*keys).orderBy(level) if keys else Window.partitionBy(F.lit(0)).orderBy(level)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    x = histogram.withColumn("wb", F.sum(n).over(w)).withColumn("sb", F.sum(F.col(n) * F.col(level)).over(w))
    x = x.withColumn("wt", F.sum(n).over(whole)).withColumn("st", F.sum(F.col(n) * F.col(level)).over(whole))
    wf = F.col("wt") - F.col("wb")
    gap = F.try_divide(F.col("sb"), F.col("wb")) - F.try_divide(F.col("st") - F.col("sb"), F.nullif(wf, F.lit(0)))
    x = x.withColumn("between", F.coalesce(F.col("wb").cast("double") * wf * gap * gap, F.lit(0.0)))
    best = F.max_by(F.col(level), F.struct("between", -F.col(level))).alias("threshold")
    return x.groupBy(*keys).agg(best) if keys else x.agg(best)
