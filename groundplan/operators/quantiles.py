"""Exact quantiles of whole columns, by group or not, whose memory doesn't grow with the data.

A value's bits, in the order of the values, are found from the top in three passes of counts. So no task holds all the
values of a column or of a group, however many are distinct, and none are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundplan.scratch import Scratch


#: How far the key is shifted in each pass: 21 bits, 21 bits, 22 bits.
SHIFTS = (43, 22, 0)


def order_key(v: Column) -> Column:
    """The bits of a double as a long that sorts as the double does; both zeros are 0, NaN has no place.

    The exponent is the logarithm, put right by one where it was rounded; the fraction is exact, as all factors are powers
    of two.
    """
    a = F.abs(v)
    guess = F.floor(F.log2(a)).cast("int")
    power = lambda e: F.pow(F.lit(2.0), e)
    part = a / power(guess)
    e = F.when(part < 1, guess - 1).when(part >= 2, guess + 1).otherwise(guess)
    fraction = ((a / power(e) - 1) * 2.0**52).cast("long")
    usual = F.shiftleft((e + 1023).cast("long"), 52) + fraction
    tiny = (a * 2.0**537 * 2.0**537).cast("long")  # below the least power that has a whole mantissa
    bits = F.when(a == float("inf"), F.lit(2047 << 52)).when(a < 2.0**-1022, tiny).when(a < 2.0**-1000, _scaled(a)).otherwise(usual)
    return F.when(v < 0, -bits).otherwise(bits)


def _scaled(a: Column) -> Column:
    """The bits of the smallest normal doubles, by those of 2**100 times as much."""
    b = a * 2.0**100
    guess = F.floor(F.log2(b)).cast("int")
    part = b / F.pow(F.lit(2.0), guess)
    e = F.when(part < 1, guess - 1).when(part >= 2, guess + 1).otherwise(guess)
    return F.shiftleft((e - 100 + 1023).cast("long"), 52) + ((b / F.pow(F.lit(2.0), e) - 1) * 2.0**52).cast("long")


def key_value(key: Column) -> Column:
    """The double of an order_key."""
    a = F.abs(key)
    e, fraction = F.shiftright(a, 52).cast("int"), a.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    usual = F.pow(F.lit(2.0), (e - 1023).cast("double")) * (1 + fraction / 2.0**52)
    tiny = fraction / 2.0**537 / 2.0**537
    small = F.pow(F.lit(2.0), (e - 923).cast("double")) * (1 + fraction / 2.0**52) / 2.0**100
    value = F.when(e == 2047, F.lit(float("inf"))).when(e == 0, tiny).when(e < 30, small).otherwise(usual)
    return F.when(key < 0, -value).otherwise(value)


def quantiles(df: DataFrame, cols: dict[str, Column] | list[str], qs: list[float], group: str | Column | None = None) -> DataFrame:
    """g (only with a group), name, values: the quantiles of each column in the order of qs, interpolated linearly.

    Nulls and NaN don't count; a column without values (in a group: without a row) has no row, nor has a null group.

    A radix selection in three passes over df, in one query: df should be a table or cheap to make. Each pass counts rows by
    the next bits of their order_key, which tasks combine before they send anything, and finds the bits of the wanted ranks;
    the next one looks at rows with these bits only. So values aren't sent or sorted, and nothing is written.
    """
    named = cols if isinstance(cols, dict) else {c: F.col(f"`{c}`") for c in cols}
    g = F.lit(0) if group is None else F.col(group) if isinstance(group, str) else group
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("v")) for n, c in named.items()])
    rows = df.select(g.alias("g"), F.inline(pairs)).filter("g is not null and v is not null and not isnan(v)").select("g", "name", order_key(F.col("v")).alias("key"))
    wanted = None
    for k, shift in enumerate(SHIFTS):
        bits = F.shiftright("key", shift).alias("bits")
        last = ["g", "name"] + ([] if wanted is None else ["upper"])
        if wanted is None:
            counts = rows.groupBy("g", "name", bits).agg(F.count(F.lit(1)).alias("n"))
        else:
            keyed = rows.withColumn("upper", F.shiftright("key", SHIFTS[k - 1])).join(wanted.select(*last).distinct(), last, "left_semi")
            counts = keyed.groupBy(*last, bits).agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy(*last).orderBy("bits")
        placed = counts.withColumn("before", F.sum("n").over(w) - F.col("n"))
        if wanted is None:
            at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(qs)])).alias("want")
            asked = placed.withColumn("total", F.sum("n").over(Window.partitionBy(*last))).select("*", at).withColumn("at", F.col("want.q") * (F.col("total") - 1))
            asked = asked.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))).withColumn("i", F.col("want.i"))
            asked = asked.withColumn("share", F.when(F.col("rank") == F.floor("at"), 1 - (F.col("at") - F.floor("at"))).otherwise(F.col("at") - F.floor("at")))
        else:
            asked = wanted.join(placed, last)
        hit = asked.filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        wanted = hit.select("g", "name", "i", "share", (F.col("rank") - F.col("before")).alias("rank"), F.col("bits").alias("upper"))
    each = wanted.groupBy("g", "name", "i").agg(F.sum(key_value(F.col("upper")) * F.col("share")).alias("value"))
    out = each.groupBy("g", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "value"))), lambda s: s["value"]).alias("values"))
    out = Scratch(df.sparkSession, "quantiles").save(out, "quantiles")
    return out if group is not None else out.drop("g")


def quantile_row(df: DataFrame, cols: dict[str, Column] | list[str], qs: list[float]) -> DataFrame:
    """One row: for each column an array of its quantiles under the column's name; null for a column without values."""
    names = list(cols)
    found = quantiles(df, cols, qs)
    return found.agg(*[F.max(F.when(F.col("name") == n, F.col("values"))).alias(n) for n in names])


def quantiles_by_group(df: DataFrame, cols: list[str], qs: list[float], group: str, into: str) -> DataFrame:
    """`into` (the group) and for each column an array of its quantiles; groups without any value have no row."""
    found = quantiles(df, cols, qs, group)
    return found.groupBy(F.col("g").alias(into)).agg(*[F.max(F.when(F.col("name") == c, F.col("values"))).alias(c) for c in cols])
