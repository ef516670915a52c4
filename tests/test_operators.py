import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundplan.functions.text import name_key, pincode_key, token_sort
from groundplan.operators import features, fuzzy, impute, reports, robust, rows, spatial
from groundplan.queries import QUERIES, match_tables


def test_winsorize_by_group(spark):
    data = [("a", float(i)) for i in range(101)] + [("b", 1000.0 * i) for i in range(101)] + [("c", 5.0), ("a", None), (None, 3.0)]
    got = robust.winsorize_by_group(spark.createDataFrame(data, "g string, v double"), ["v"], "g").collect()
    assert len(got) == len(data)
    a = [r.v for r in got if r.g == "a"]
    assert min(v for v in a if v is not None) == 1.0 and max(v for v in a if v is not None) == 99.0 and a.count(None) == 1
    assert [r.v for r in got if r.g == "c"] == [5.0] and [r.v for r in got if r.g is None] == [None]


def test_group_median(spark):
    data = [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, None), (6, None, 10.0)]
    got = {r.k: (r.v, r.v_was_missing) for r in impute.group_median_impute(spark.createDataFrame(data, "k int, g string, v double"), "v", "g").collect()}
    assert got == {1: (1.0, False), 2: (3.0, False), 3: (2.0, True), 4: (3.0, True), 5: (3.0, True), 6: (10.0, False)}


def test_bucketed_median_rounds_half_even_and_takes_null_sources(spark):
    data = [(i, float(i), float(i % 3)) for i in range(20)] + [(90, None, None), (91, 3.0, 2.5)]
    got = {r.k: r.v for r in impute.bucketed_median_impute(spark.createDataFrame(data, "k int, s double, v double"), "v", "s").collect()}
    assert got[91] == 2.0 and got[90] == 1.0


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", "z"), (None, "q")], "k string, v string")
    assert {r.k: r.mode for r in rows.mode_by_key(df, "k", "v").collect()} == {"a": "x", "b": "z"}


def test_duplicate_flag_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "URL string")
    assert sorted((str(r.URL), r.is_duplicate_url) for r in rows.duplicate_flag(df, "URL").collect()) == [("None", True), ("None", True), ("a", True), ("a", True), ("b", False)]


def test_loss_budget():
    assert rows.checked_loss(100, 95) == 5.0
    assert rows.checked_loss(0, 0) == 0.0
    with pytest.raises(ValueError):
        rows.checked_loss(100, 94)


def brute_lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def test_lcs_against_brute_force():
    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("ab c") for _ in range(r.randint(0, 12))) for _ in "xy")
        assert fuzzy.lcs(a, b) == brute_lcs(a, b)


def test_global_candidates_lose_nothing(spark):
    r = random.Random(2)
    base = ["".join(r.choice("ABCDE ") for _ in range(r.randint(1, 24))).strip() or "A" for _ in range(60)]

    def edited(s):
        s = list(s)
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(s) + 1)
            s[i : i + r.randint(0, 1)] = r.choice(["", "A", "Z"])
        return "".join(s) or "A"

    left = sorted({" ".join(sorted(edited(s).split())) or "A" for s in base for _ in range(3)})
    right = sorted({" ".join(sorted(s.split())) for s in base})
    want = {(a, b) for a in left for b in right if fuzzy.ratio(a, b) >= 90}
    got = fuzzy.global_candidates(spark.createDataFrame([(s,) for s in left], "s string"), spark.createDataFrame([(s,) for s in right], "t string"))
    assert want and want <= {(x.s, x.t) for x in got.collect()}


def test_match_tiers(spark):
    registry = spark.createDataFrame([(0, "Green Park Residency", "1"), (1, "Green Park Residency", "2"), (2, "Lake View Towers", "3")], "idx long, rera_project_name string, rera_pincode string")
    listings = spark.createDataFrame([(1, "green park residenci", "2"), (2, "Lake View Towers", "9"), (3, None, "1"), (4, "Nothing Alike", "1"), (5, "Towers Lake View", None)], "k int, Society string, Pincode string")
    got = {r.k: (r.match_method, r.idx) for r in fuzzy.match(listings, registry, "k").collect()}
    assert got == {1: ("pincode_block", 1), 2: ("name_only", 2), 3: ("no_society", None), 4: ("unmatched", None), 5: ("name_only", 2)}


SQUARE = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]
NEXT = [[(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]]
ZONE = "zone_id int, pincode string, district string, rings array<array<struct<x: double, y: double>>>"


def test_zones_and_points(spark):
    zones = spark.createDataFrame([(0, "111111", "d1", SQUARE), (1, "222222", "d2", NEXT), (2, "333333", "bad", [[(0.0, 0.0), (1.0, 1.0)]])], ZONE)
    points = spark.createDataFrame([(0, 0.5, 0.99, None), (1, 0.5, 1.5, "999999"), (2, None, None, None), (3, 0.5, 1.0, None), (4, 5.0, 5.0, None)], "k int, Latitude double, Longitude double, Pincode string")
    got = {r.k: (r.Pincode, r.Possible_Pincodes) for r in spatial.enrich_from_polygons(points, zones, "k").collect()}
    assert got[0] == ("111111", "111111, 222222") and got[1] == ("999999", "222222") and got[2] == (None, None) and got[4] == (None, None)
    inside = {r.k: r.pincode for r in spatial.containing(points, zones, "k").collect()}
    assert inside == {0: "111111", 1: "222222"}  # a point on a border is within neither
    none = spatial.attach_geo(points, None, "k").first()
    assert none.district_from_geo is None and none.pincode_agrees_with_geo is None


def test_hole(spark):
    holed = SQUARE + [[(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6), (0.4, 0.4)]]
    points = spark.createDataFrame([(0, 0.5, 0.5), (1, 0.2, 0.2)], "k int, Latitude double, Longitude double")
    assert [r.k for r in spatial.containing(points, spark.createDataFrame([(0, "1", "d", holed)], ZONE), "k").collect()] == [1]


def test_knn_against_brute_force(spark):
    r = np.random.default_rng(3)
    train = [(round(float(a), 2), round(float(b), 2), f"p{int(c)}") for a, b, c in zip(r.normal(0, 1, 120), r.normal(0, 1, 120), r.integers(0, 5, 120))]
    asks = [(round(float(a), 3) + 0.0005, round(float(b), 3)) for a, b in r.normal(0, 1, (25, 2))] + [(9.0, 9.0), train[0][:2]]
    got = {(x.lat, x.lon): x.t for x in spatial.knn_vote(spark.createDataFrame(train, "lat double, lon double, t string"), spark.createDataFrame(asks, "lat double, lon double"), "lat", "lon", "t").collect()}
    for la, lo in asks:
        near = sorted((math.hypot(x - lo, y - la), t, y, x) for y, x, t in train)[:15]
        zero = [n for n in near if n[0] == 0]
        votes = {}
        for d, t, *_ in zero or near:
            votes[t] = votes.get(t, 0) + (1 if zero else 1 / d)
        assert got[la, lo] == min(votes, key=lambda t: (-round(votes[t], 9), t))
    few = spark.createDataFrame(train[:15], "lat double, lon double, t string")
    assert spatial.knn_vote(few, spark.createDataFrame(asks, "lat double, lon double"), "lat", "lon", "t").count() == 0


def test_knn_ties_of_votes_despite_rounding(spark):
    # a: 1/3 + 1/6, b: 1/2; c and d differ in the seventh decimal
    at = lambda d, t: (0.0, d, t)
    make = lambda rows: spark.createDataFrame(rows, "lat double, lon double, label string")
    q = spark.createDataFrame([(0.0, 0.0)], "lat double, lon double")
    ten = [at(0.1 * k, "a") for k in (3, -3, 6, -6, 6, -6)] + [at(0.1 * k, "b") for k in (1, -1)] + [at(9.0, "z")]  # 40 / 3, 20
    assert spatial.knn_vote(make(ten), q, "lat", "lon", "label", 8).collect()[0].label == "b"
    for x, y in ([3.0, -6.0], [2.0]), ([0.7, -0.7, 0.7], [0.7 / 3]), ([0.3] * 10, [0.03]):
        for first, second in (x, y), (y, x):
            rows = make([at(d, "a") for d in first] + [at(d, "b") for d in second] + [at(9.0, "z")])
            assert [r.label for r in spatial.knn_vote(rows, q, "lat", "lon", "label", len(x) + len(y)).collect()] == ["a"]
    near = make([at(1.0, "c"), at(0.9999999, "d"), at(9.0, "z")])
    assert [spatial.knn_vote(near, q, "lat", "lon", "label", 2, decimals=n).first().label for n in (None, 6, 7)] == ["d", "c", "d"]


def test_knn_query_against_its_sql(spark, tmp_path):
    import duckdb

    from groundplan import queries

    r = np.random.default_rng(5)
    rows = [(i, [float(x) / 16 for x in r.integers(-6, 7, 2)], int(r.integers(0, 4))) for i in range(600)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = {(x.lat + 0.0, x.lon + 0.0, x.label) for x in queries.QUERIES["knn_vote"](spark, str(tmp_path)).collect()}
    assert got == {(y + 0.0, x + 0.0, t) for y, x, t in db.execute(queries.ORACLE_SQL["knn_vote"]).fetchall()}


def test_one_hot_and_scaling(spark):
    df = spark.createDataFrame([(1, "a b", 1.0), (2, None, None), (3, "c", 3.0)], "k int, s string, v double")
    assert features.one_hot(df, ["s"]).columns == ["k", "v", "s_a b", "s_c"]
    assert [(r["s_a b"], r["s_c"]) for r in features.one_hot(df, ["s"]).orderBy("k").collect()] == [(True, False), (False, False), (False, True)]
    const = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [r.v for r in features.standard_scale(const, const, ["v"]).collect()] == [0.0, 0.0]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert reports.correlation_with_target(df, "b", ["a"]).first().correlation is None


def test_split_is_disjoint_and_near_a_fifth(spark):
    n = spark.range(5000).filter(features.in_test("id")).count()
    assert 850 < n < 1150


def test_match_queries_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    listings, registry = match_tables(spark, sf)
    n = spark.read.parquet(f"{sf}/part.parquet").count()
    names = registry.select("idx", token_sort(name_key("rera_project_name")).alias("s"), pincode_key("rera_pincode").alias("b")).collect()
    assert len(names) == n
    want = {}
    for r in listings.select("p_partkey", token_sort(name_key("Society")).alias("s"), pincode_key("Pincode").alias("b")).collect():
        scored = [(fuzzy.ratio(r.s, x.s), -x.idx, x.b) for x in names] if r.s else []
        one = max((x for x in scored if x[2] == r.b and r.b is not None and x[0] >= 85), default=None)
        two = max((x for x in scored if x[0] >= 90), default=None)
        hit = one or two
        want[r.p_partkey] = ("no_society" if not r.s else "pincode_block" if one else "name_only" if two else "unmatched", -hit[1] if hit else None)
    got = {r.p_partkey: (r.match_method, r.idx) for r in QUERIES["tiered_match"](spark, sf).collect()}
    assert got == want and {m for m, _ in got.values()} == {"pincode_block", "name_only", "unmatched", "no_society"}
    (r,) = QUERIES["match_report"](spark, sf).collect()
    methods = [m for m, _ in want.values()]
    assert (r.n_rows, r.n_matched) == (n, methods.count("pincode_block") + methods.count("name_only"))
    assert (r.n_unmatched, r.n_no_society) == (methods.count("unmatched"), methods.count("no_society"))


def test_feature_matrix_query(spark):
    sf = "/root/testdata/sf0.001"
    x = QUERIES["one_hot_feature_matrix"](spark, sf)
    assert x.count() == QUERIES["etl_flow"](spark, sf).count() > 0
    made = [c for c in x.columns if c.startswith("deal_type_")]
    assert len(made) == 3 and x.filter(" + ".join(f"int(`{c}`)" for c in made) + " <> 1").count() == 0

def brute_knn(train, asks, k):
    out = {}
    for qy, qx in set(asks):
        near = sorted((math.hypot(x - qx, y - qy), t, y, x) for y, x, t in train)[:k]
        zero = [n for n in near if n[0] == 0]
        votes = {}
        for d, t, *_ in zero or near:
            votes[t] = votes.get(t, 0.0) + (1.0 if zero else 1 / d)
        out[qy, qx] = votes
    return out


def city(r, n):
    """A dense city, a few villages, one place with very many rows and one point far out."""
    spot = lambda y, x, w: (round(y + r.gauss(0, w), 5), round(x + r.gauss(0, w), 5))
    train = [(*spot(17.4, 78.4, 0.05), f"c{r.randrange(9)}") for _ in range(n)]
    train += [(*spot(17 + v, 77.0, 0.3), "v") for v in range(3) for _ in range(20)] + [(17.41, 78.41, f"s{i % 7}") for i in range(300)]
    return [*train, (0.0, 0.0, "far")]


def test_neighbours_in_a_dense_city_with_a_far_point(spark):
    from groundplan.scratch import Scratch

    r = random.Random(9)
    train = city(r, 3000)
    asks = [t[:2] for t in r.sample(train, 60)] + [(r.uniform(17, 18), r.uniform(77, 79)) for _ in range(60)] + [(0.0, 0.0), (0.1, 0.0), (-60.0, 170.0), (17.41, 78.41), (17.4100001, 78.41)]
    scratch = Scratch(spark, "test")
    t = spark.createDataFrame(train + [(None, 1.0, "x"), (float("nan"), 1.0, "x")], "lat double, lon double, label string")
    q = spark.createDataFrame(asks + asks[:9] + [(None, 2.0)], "lat double, lon double")
    got = {(x.lat, x.lon): x.label for x in spatial.knn_vote(t, q, "lat", "lon", "label", 15, 32, scratch).collect()}
    want = brute_knn(train, asks, 15)
    assert set(got) == set(want)
    assert all(votes[got[a]] >= max(votes.values()) * (1 - 1e-9) for a, votes in want.items())
    # rows that are compared: a few leaves a query, not the city
    near = spark.read.parquet(f"{scratch.root}/near")
    leaves = [spark.read.parquet(f"{scratch.root}/leaves-{i}") for i in range(13) if (__import__("pathlib").Path(scratch.root.removeprefix("file:")) / f"leaves-{i}").exists()]
    pairs = sum(near.join(x, ["step", "cx", "cy"]).count() for x in leaves)
    assert len(leaves) > 4 and pairs < 250 * len(set(asks)) < len(train) * len(set(asks)) / 10


def test_neighbours_of_few_points_and_one_place(spark):
    make = lambda rows: spark.createDataFrame(rows, "lat double, lon double, label string")
    q = spark.createDataFrame([(1.0, 1.0), (5.0, 5.0)], "lat double, lon double")
    assert spatial.knn_vote(make([(1.0, 1.0, "a")] * 15), q, "lat", "lon", "label").count() == 0
    same = spatial.knn_vote(make([(1.0, 1.0, "b")] * 20 + [(1.0, 1.0, "a")] * 21), q, "lat", "lon", "label").collect()
    assert sorted((x.lat, x.label) for x in same) == [(1.0, "a"), (5.0, "a")]
    assert spatial.knn_vote(make([(0.0, float(i), str(i)) for i in range(40)]), q, "lat", "lon", "label", 3, 4).count() == 2
    assert spatial.knn_vote(make([]), q, "lat", "lon", "label").count() == 0


def names_of(r, n):
    words = [f"{a}{b}{c}" for a in ("SRI", "GREEN", "LAKE", "MY", "PEARL", "ROYAL") for b in ("", "VALLEY", "HOME", "NEST", "PARK") for c in ("", "S", "TOWER")]
    return [" ".join(r.choice(words) for _ in range(r.randint(1, 4))) + f" {r.randrange(40)}" for _ in range(n)]


def typo(r, s):
    for _ in range(r.randint(0, 4)):
        i = r.randrange(len(s) + 1)
        s = s[:i] + r.choice(["", "A", "Z"]) + s[i + r.randint(0, 1) :]
    return s


@pytest.mark.parametrize("cutoff", [85.0, 60.0])
def test_large_blocks_match_as_all_pairs(spark, cutoff):
    """One hot code by the index of segments, against comparing all; pairs that are scored are few."""
    from groundplan.scratch import Scratch

    r = random.Random(11)
    refs = names_of(r, 500)
    asks = [typo(r, r.choice(refs)) for _ in range(120)] + names_of(r, 30) + ["A", "QQ", "", "X" * 60]
    n = spark.createDataFrame([(i, t, "hot" if i % 10 else "small") for i, t in enumerate(refs)], "idx long, ref string, block string")
    p = spark.createDataFrame([(a, b) for a in set(asks) for b in ("hot", "small", None)], "name string, block string")
    scratch = Scratch(spark, "test")
    got = sorted(map(tuple, fuzzy.blocked_match(p, n, cutoff, large=200, scratch=scratch).collect()))
    assert got == sorted(map(tuple, fuzzy.blocked_match(p, n, cutoff, large=10**6).collect())) and len(got) > 100
    if cutoff == 85.0:
        all_pairs = len(set(asks)) * len(set(refs[i] for i in range(500) if i % 10))
        assert sum(spark.read.parquet(f"{scratch.root}/near-{k}").count() for k in range(2)) < all_pairs / 8


def test_segments_lose_no_pair(spark):
    r = random.Random(12)
    made = ["".join(r.choice("ab ") for _ in range(r.randint(1, 14))).strip() or "a" for _ in range(60)]
    x = spark.createDataFrame([("b", s) for s in set(made)], "block string, s string")
    for cutoff in (60.0, 72.5, 85.0, 95.0):
        found = {(c.s, c.t) for c in fuzzy.segment_candidates(x, x.withColumnRenamed("s", "t"), cutoff).collect()}
        assert {(a, b) for a in set(made) for b in set(made) if fuzzy.ratio(a, b) >= cutoff} <= found


def test_order_keys_are_the_bits_of_doubles(spark):
    import struct

    from groundplan.operators import quantiles as q

    r = random.Random(13)
    odd = [0.0, -0.0, 1.0, 2.0, 0.5, 1 - 2**-53, 1 + 2**-52, math.inf, -math.inf, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 2.0**-1000, 2.0**-1021, 1.7976931348623157e308, -1e-310, 1e-305, 3.3e-301, 0.1]
    values = odd + [2.0**e for e in range(-1074, 1024, 7)] + [math.nextafter(2.0**e, 0) for e in range(-1000, 1023, 11)] + [struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    x = spark.createDataFrame([(v,) for v in values], "v double").select("v", q.order_key(F.col("v")).alias("k")).withColumn("back", q.key_value(F.col("k"))).collect()
    for row in x:
        bits = struct.unpack("q", struct.pack("d", abs(row.v)))[0]
        assert row.k == (-bits if row.v < 0 else bits) and row.back == row.v


def test_quantiles_against_numpy_without_shuffling_values(spark):
    from groundplan.operators import quantiles as q

    r = random.Random(14)
    data = [(r.choice(["a", "b", None]), r.choice([r.gauss(0, 1), r.lognormvariate(3, 4), -1e9, 7.0, 1e-320, None, math.nan, 5e8 + r.random() * 1e-6])) for _ in range(4000)]
    df = spark.createDataFrame([*data, ("one", 2.5), ("none", None)], "g string, v double")
    qs = [0.0, 0.01, 0.25, 0.5, 0.777, 0.99, 1.0]
    got = {x.g: x["values"] for x in q.quantiles(df, ["v"], qs, "g").collect()}
    real = lambda g: [v for k, v in data if k == g and v is not None and v == v]
    assert set(got) == {"a", "b", "one"} and got["one"] == [2.5] * 7
    for g in "ab":
        assert np.allclose(got[g], np.quantile(real(g), qs), rtol=1e-12, atol=0)
    assert q.quantiles(df.limit(0), ["v"], qs).count() == 0


def test_loss_is_counted_on_the_way(spark, tmp_path):
    df = spark.range(100).repartition(3)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup("budget")
    spark.sparkContext.setJobGroup("budget", "one write")
    write = lambda kept: kept.write.mode("overwrite").parquet(f"{tmp_path}/kept")
    try:
        assert rows.keep_within_budget(df, F.col("id") >= 4, write) == (100, 96, 4.0)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("budget")) - len(before)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 2 and spark.read.parquet(f"{tmp_path}/kept").count() == 96  # the repartition and the write
    with pytest.raises(ValueError, match="exceeds"):
        rows.keep_within_budget(df, F.col("id") >= 6, write)
    assert rows.keep_within_budget(df.limit(0), F.col("id") >= 6, write) == (0, 0, 0.0)
