"""Points and zones: containment, nearest zones, neighbours. Planar degrees; no geometry library.

A zone is (zone_id, pincode, district, rings): array<array<struct<x,y>>> whose even-odd interior is the zone, holes and
several parts included. Zones are joined to points through the cells of a grid that their bounding boxes cover, so that a
join is an equi-join on the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundplan.scratch import Scratch

#: 5 km in degrees of latitude.
RADIUS = 5 / 111


def valid_zone(rings: Column) -> Column:
    """Closed rings of four finite points or more."""
    ok = lambda r: (
        (F.size(r) >= 4)
        & (F.get(r, F.lit(0))["x"] == F.element_at(r, -1)["x"])
        & (F.get(r, F.lit(0))["y"] == F.element_at(r, -1)["y"])
        & F.forall(r, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    )
    return rings.isNotNull() & (F.size(rings) > 0) & F.forall(rings, ok)


def _edges(rings: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> of all rings."""
    one = lambda r: F.transform(
        F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), lambda p, i: F.struct(F.get(r, i)["x"].alias("x1"), F.get(r, i)["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2"))
    )
    return F.flatten(F.transform(rings, one))


def squared_distance(x: Column, y: Column, edges: Column) -> Column:
    """Squared distance to the nearest edge."""

    def to(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, F.nullif(dx * dx + dy * dy, F.lit(0.0))), F.lit(0.0))
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        px, py = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
        return px * px + py * py

    return F.array_min(F.transform(edges, to))


def inside(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd ray casting; what counts on an edge itself is left to the distance."""
    crosses = F.filter(edges, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    return F.size(crosses) % 2 == 1


def _celled(zones: DataFrame, cell: float, margin: float) -> DataFrame:
    xs = F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p: p["y"])))
    z = zones.filter(valid_zone(F.col("rings"))).withColumns({"edges": _edges(F.col("rings")), "x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)})
    span = lambda a, b: F.sequence(F.floor((F.col(a) - margin) / cell), F.floor((F.col(b) + margin) / cell))
    return z.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1"))).select("cx", "cy", "zone_id", "pincode", "district", "edges", "x0", "x1", "y0", "y1")


def _near(points: DataFrame, zones: DataFrame, lat: str, lon: str, cell: float, margin: float) -> DataFrame:
    """Points with each zone whose box, widened by the margin, holds them."""
    p = points.withColumns({"_x": F.col(lon).cast("double"), "_y": F.col(lat).cast("double")}).filter("_x is not null and _y is not null and not isnan(_x) and not isnan(_y)")
    p = p.withColumns({"cx": F.floor(F.col("_x") / cell), "cy": F.floor(F.col("_y") / cell)})
    hit = F.col("_x").between(F.col("x0") - margin, F.col("x1") + margin) & F.col("_y").between(F.col("y0") - margin, F.col("y1") + margin)
    return p.join(_celled(zones, cell, margin), ["cx", "cy"]).filter(hit)


def containing(points: DataFrame, zones: DataFrame, row: str, lat: str = "Latitude", lon: str = "Longitude", cell: float = 0.1) -> DataFrame:
    """row, pincode, district of the zone that strictly contains each point, the first by zone_id of several; others have no row."""
    x, y = F.col("_x"), F.col("_y")
    found = _near(points.select(row, lat, lon), zones, lat, lon, cell, 0.0).filter(inside(x, y, F.col("edges")) & (squared_distance(x, y, F.col("edges")) > 0))
    best = F.min_by(F.struct("pincode", "district"), F.col("zone_id")).alias("z")
    return found.groupBy(row).agg(best).select(row, "z.pincode", "z.district")


def nearest(points: DataFrame, zones: DataFrame, row: str, n: int = 3, radius: float = RADIUS, lat: str = "Latitude", lon: str = "Longitude", cell: float = 0.1) -> DataFrame:
    """row, rank, pincode, distance of the n nearest codes within the radius (0 inside); each code once, ties by code."""
    x, y = F.col("_x"), F.col("_y")
    gap = F.when(inside(x, y, F.col("edges")), F.lit(0.0)).otherwise(F.sqrt(squared_distance(x, y, F.col("edges"))))
    found = _near(points.select(row, lat, lon), zones, lat, lon, cell, radius).withColumn("distance", gap).filter(F.col("distance") <= radius)
    per_code = found.groupBy(row, "pincode").agg(F.min("distance").alias("distance"))
    w = Window.partitionBy(row).orderBy("distance", "pincode")
    return per_code.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select(row, "rank", "pincode", "distance")


def candidates(points: DataFrame, zones: DataFrame, row: str, sep: str = ",", n: int = 3, **how) -> DataFrame:
    """row, nearest_pincode and all n codes in order as one text."""
    top = nearest(points, zones, row, n, **how)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "pincode"))), lambda s: s["pincode"]), sep)
    return top.groupBy(row).agg(F.min_by("pincode", "rank").alias("nearest_pincode"), listed.alias("codes"))


def attach_geo(df: DataFrame, zones: DataFrame | None, row: str, code: str = "Pincode", **how) -> DataFrame:
    """df with district_from_geo, Possible_Pincodes and the nullable pincode_agrees_with_geo; nulls without zones."""
    base = df.drop("Possible_Pincodes")
    if zones is None:
        return base.withColumns({"district_from_geo": F.lit(None).cast("string"), "Possible_Pincodes": F.lit(None).cast("string"), "pincode_agrees_with_geo": F.lit(None).cast("boolean")})
    c = containing(df, zones, row, **how).select(row, F.col("pincode").alias("_geo"), F.col("district").alias("district_from_geo"))
    t = candidates(df, zones, row, ",", **how).select(row, F.col("codes").alias("Possible_Pincodes"))
    out = base.join(c, row, "left").join(t, row, "left")
    return out.withColumn("pincode_agrees_with_geo", F.col("_geo") == F.col(code)).drop("_geo")


def enrich_from_polygons(df: DataFrame, zones: DataFrame, row: str, code: str = "Pincode", **how) -> DataFrame:
    """df whose missing codes come from the nearest zone, with the candidates in Possible_Pincodes; existing codes stay."""
    t = candidates(df, zones, row, ", ", **how)
    out = df.drop("Possible_Pincodes").join(t, row, "left")
    return out.withColumns({code: F.coalesce(F.nullif(F.col(code).cast("string"), F.lit("")), "nearest_pincode"), "Possible_Pincodes": F.col("codes")}).drop("nearest_pincode", "codes")


#: A quadtree's cells are cut in four by four, so often at most; the finest are a 2**24th of the longer side of all points.
STEPS, BITS = 12, 2


def _cell(c: Column, step: int) -> Column:
    return F.shiftright(c, BITS * (STEPS - step))


def _spots(df: DataFrame, lat: str, lon: str, *more: Column) -> DataFrame:
    """y, x and more of the rows with coordinates."""
    x = df.select(F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"), *more)
    return x.filter("y is not null and x is not null and not isnan(y) and not isnan(x) and abs(y) < 1e300 and abs(x) < 1e300")


def quadtree(points: DataFrame, leaf: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """An equi-depth quadtree over points (y, x, n, ...), a written table: its nodes by step, and points with step, cx, cy of their leaf.

    A node has its cell, the sum of n, whether it is cut further (more than `leaf` points), and the box of its points, so
    that distances to it are right whatever the cells' borders. Only points of nodes that are cut go to the next step. A
    point far from all others costs a leaf of its own, and a dense place is cut until its leaves are small.
    """
    x0, y0, side = points.agg(F.min("x"), F.min("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))).first()
    top = (1 << (BITS * STEPS)) - 1
    grid = lambda c, lo: F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(side or 1.0) * F.lit(float(top + 1))), F.lit(top)).cast("long")
    rest = points.withColumns({"ix": grid("x", x0 or 0.0), "iy": grid("y", y0 or 0.0)})
    nodes, leaves = [], None
    for step in range(STEPS + 1):
        at = rest.withColumns({"cx": _cell(F.col("ix"), step), "cy": _cell(F.col("iy"), step)})
        boxes = [f(c).alias(f"{c}{n}") for f, n in ((F.min, 0), (F.max, 1)) for c in "xy"]
        node = at.groupBy("cx", "cy").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("points"), *boxes).withColumn("cut", (F.col("points") > leaf) & F.lit(step < STEPS)).drop("points")
        node = scratch.save(node, f"nodes-{step}")
        nodes.append(node)
        dealt = at.join(node.select("cx", "cy", "cut"), ["cx", "cy"])
        here = scratch.save(dealt.filter("not cut").select(F.lit(step).alias("step"), "cx", "cy", *points.columns), f"leaves-{step}")
        leaves = here if leaves is None else leaves.union(here)
        if node.filter("cut").isEmpty():
            return nodes, leaves
        rest = scratch.save(dealt.filter("cut").drop("cx", "cy", "cut"), f"rest-{step}")
    raise AssertionError


def _ends(box: list[str]) -> tuple[Column, Column]:
    """Least and greatest squared distance of qx, qy to a box x0, x1, y0, y1."""
    x0, x1, y0, y1 = map(F.col, box)
    zero = F.lit(0.0)
    dx, dy = F.greatest(x0 - F.col("qx"), F.col("qx") - x1, zero), F.greatest(y0 - F.col("qy"), F.col("qy") - y1, zero)
    fx, fy = F.greatest(F.abs(F.col("qx") - x0), F.abs(F.col("qx") - x1)), F.greatest(F.abs(F.col("qy") - y0), F.abs(F.col("qy") - y1))
    return dx * dx + dy * dy, fx * fx + fy * fy


def leaves_near(asks: DataFrame, nodes: list[DataFrame], k: int, scratch: Scratch) -> DataFrame:
    """qy, qx, step, cx, cy: the leaves that can hold one of the k points (by n) nearest to each of asks (qy, qx).

    All queries go down the tree together. After each step a query knows a distance within which k points lie, from the far
    corners of the boxes that it still looks at, and gives up the boxes beyond it; what is left is a written table a step.
    """
    held = None
    for step, node in enumerate(nodes):
        if held is None:
            found = asks.crossJoin(F.broadcast(node))  # the root is one row
        else:
            under = node.withColumns({"px": F.shiftright("cx", BITS), "py": F.shiftright("cy", BITS)})
            parents = held.filter("cut").select("qy", "qx", F.col("cx").alias("px"), F.col("cy").alias("py"))
            found = parents.join(under, ["px", "py"]).drop("px", "py")
        low, high = _ends(["x0", "x1", "y0", "y1"])
        found = found.select("qy", "qx", F.lit(step).alias("step"), "cx", "cy", "cut", "n", low.alias("low"), high.alias("high"))
        every = found if held is None else found.union(held.filter("not cut"))
        mine = Window.partitionBy("qy", "qx")
        enough = F.sum("n").over(mine.orderBy("high").rangeBetween(Window.unboundedPreceding, Window.currentRow)) >= k
        bound = every.withColumn("within", F.when(enough, F.col("high"))).withColumn("within", F.min("within").over(mine))
        held = scratch.save(bound.filter(F.col("within").isNull() | (F.col("low") <= F.col("within") * (1 + 1e-9))).drop("within"), f"held-{step}")
    return held.select("qy", "qx", "step", "cx", "cy")


def knn_vote(train: DataFrame, queries: DataFrame, lat: str, lon: str, label: str, k: int = 15, leaf: int = 64, scratch: Scratch | None = None, decimals: int | None = None) -> DataFrame:
    """lat, lon, label for each distinct query point: its k nearest training rows vote with weight 1 / distance.

    Rows at distance 0 alone vote if there are any. The k nearest are taken in order of (distance, label, coordinates), an
    equal row counting as often as it occurs; ties of votes go to the smallest label. Nothing is returned unless more than
    k training rows exist. Votes are sums of fractions, whose last bits depend on the order of adding: those within a
    billionth of the most count as ties, or with `decimals` those that are equal once rounded to so many. Rows and queries without finite coordinates take no part.

    Equal training rows are one row with a count. A query is compared with the rows of the few leaves of a quadtree that can
    hold its neighbours, of `leaf` places each, however unevenly the points lie.
    """
    scratch = scratch or Scratch(train.sparkSession, "knn")
    pts = _spots(train, lat, lon, F.col(label).alias("t")).groupBy("y", "x", "t").agg(F.count(F.lit(1)).alias("n"))
    pts = scratch.save(pts, "points")
    asks = _spots(queries, lat, lon).select(F.col("y").alias("qy"), F.col("x").alias("qx")).distinct()
    if (pts.agg(F.sum("n")).first()[0] or 0) <= k:
        return asks.limit(0).select(F.col("qy").alias(lat), F.col("qx").alias(lon), F.lit(None).cast(train.schema[label].dataType).alias(label))
    nodes, leaves = quadtree(pts, leaf, scratch)
    near = scratch.save(leaves_near(scratch.save(asks, "asks"), nodes, k, scratch), "near")
    found = near.join(leaves.withColumnsRenamed({"y": "ty", "x": "tx"}), ["step", "cx", "cy"])
    found = found.withColumn("d", F.sqrt(F.pow(F.col("tx") - F.col("qx"), 2) + F.pow(F.col("ty") - F.col("qy"), 2)))
    w = Window.partitionBy("qy", "qx").orderBy("d", "t", "ty", "tx")
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = found.withColumn("before", before).filter(F.col("before") < k).withColumn("take", F.least("n", F.lit(k) - F.col("before")))
    out = scratch.save(used.select("qy", "qx", "t", "d", "take"), "used")
    zero = out.groupBy("qy", "qx").agg(F.min("d").alias("least"))
    voted = out.join(zero, ["qy", "qx"]).filter((F.col("least") > 0) | (F.col("d") == 0))
    votes = voted.groupBy("qy", "qx", "t").agg(F.sum(F.when(F.col("d") == 0, F.col("take").cast("double")).otherwise(F.col("take") / F.nullif(F.col("d"), F.lit(0.0)))).alias("v"))
    vote, slack = (F.col("v"), 1e-9) if decimals is None else (F.round(F.col("v") * 10.0**decimals), 0.0)
    tally = votes.groupBy("qy", "qx").agg(F.collect_list(F.struct(vote.alias("v"), "t")).alias("tally"), F.max(vote).alias("most"))  # k labels at most
    most = F.transform(F.filter("tally", lambda s: s["v"] >= F.col("most") * (1 - slack)), lambda s: F.struct(s["t"].alias("t")))
    return tally.select(F.col("qy").alias(lat), F.col("qx").alias(lon), F.array_min(most)["t"].alias(label))
