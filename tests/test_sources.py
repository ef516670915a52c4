import datetime as dt

from pyspark.sql import functions as F

from groundplan.plans import flows
from groundplan.queries import synthetic_listings
from groundplan.schema import COLUMNS
from groundplan.sources import registry, sites, tables
from groundplan.streaming.ingest import file_stream, ingest


SF = "/root/testdata/sf0.001"


def parsed(spark, site, url, html):
    return sites.parse(spark.createDataFrame([(url, html)], "url string, html string"), site, today=F.to_date(F.lit("2026-01-05"))).collect()


def test_project_without_price(spark):
    html = '<script type="application/ld+json">{"@type":["Product","Residence"],"name":"Elite Plaza","address":{"postalCode":"500082"},"geo":{"latitude":17.1}}</script><p>Total Units 8</p>'
    (r,) = parsed(spark, "magicbricks.com", "http://x/a-pdpid-1", html)
    assert (r.Society, r.Pincode, r.Total_Units, r.Price_INR, r.Latitude, r.YearMonth) == ("Elite Plaza", "500082", 8.0, None, 17.1, "2026-01")
    assert r.asDict().keys() == set(COLUMNS)


def test_pages_without_a_listing(spark):
    for name in sites.SITES:
        assert parsed(spark, name, "http://x/y/z/detail", "<html>nothing</html>") == []


def test_owner_listing(spark):
    html = '<p>3 BHK Flat for Sale in Sky Towers, Hyderabad ₹ 1.2 Cr Builtup Area 1,500 sq.ft No. of Floors 3 / 9 Age of Building 5-10 Years Ownership Type Self Maintenance</p><script>{"locality":"Madhapur"}</script>'
    (r,) = parsed(spark, "nobroker.in", "https://n/property/buy/3-bhk-apartment-for-sale-in-madhapur-hyderabad/x/detail", html)
    assert (r.Price_INR, r.Area_Sqft, r.PricePerSqft, r.BHK, r.Floor_Number, r.Total_Floors) == (1.2e7, 1500.0, 8000.0, "3", "3", 9.0)
    assert (r.Society, r.Locality, r.Ownership, r.Property_Type, r.Full_Address) == ("Sky Towers", "Madhapur", "Self", "Apartment", "Sky Towers, Madhapur, Hyderabad, India")


def test_project_units(spark):
    html = "<p>2 BHK Apartment 1,000 Sq. Ft. ₹ 50 L 3 BHK Apartment 1,500 Sq. Ft. Price on Request avg. price is ₹ 5.5k compared with Kukatpally.</p>"
    (r,) = parsed(spark, "squareyards.com", "https://s/green-meadows/1/project", html)
    assert (r.Society, r.BHK, r.Price_INR, r.Area_Sqft, r.Area_Max_Sqft, r.PricePerSqft, r.Locality) == ("Green Meadows", "2/3", 5e6, 1000.0, 1500.0, 5500.0, "Kukatpally")


def test_labelled_listing(spark):
    html = "<h1>Property Information</h1> Listing Type Sale Property Type Flat City Hyderabad Locality Miyapur Price 68 Lac Built Up Area 100 Sq. Yards Age of Property New Total Floor Count 5"
    (r,) = parsed(spark, "realestateindia.com", "https://r/2-bhk-flat-hyderabad", html)
    assert (r.Listing_Type, r.Price_INR, r.Area_Sqft, r.BHK, r.Property_Age_Years, r.Age_Group, r.Total_Floors) == ("Sale", 6.8e6, 900.0, "2", 0.0, "New", 5.0)


def test_ranges(spark):
    html = '<script type="application/ld+json">{"@type":"Apartment","name":"Orion","address":{"addressLocality":"Kokapet, Hyderabad"}}</script> by Maker Group Kokapet, (show on map) ₹ 90 L - ₹ 1.1 Cr Configuration 2, 3 BHK Area sq ft 1,200 - 1,800 sq ft'
    (r,) = parsed(spark, "proptiger.com", "https://p/hyderabad/orion", html)
    assert (r.Price_INR, r.Price_Max_INR, r.Area_Sqft, r.Area_Max_Sqft, r.BHK, r.Locality, r.Society) == (9e6, 1.1e7, 1200.0, 1800.0, "2/3", "Kokapet", "Orion")


def test_index_pages_that_failed_are_not_done(spark):
    pages = spark.createDataFrame([("p1", 'href="/a" href="/b" href="/a"'), ("p2", None), ("p3", "")], "url string, html string")
    links, done = sites.expand_index(pages, spark.createDataFrame([("p3",)], "url string"), r'href="(/[a-z])"')
    assert sorted(r.link for r in links.collect()) == ["/a", "/b"] and [r.url for r in done.collect()] == ["p1"]


def test_archive_and_migration(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿URL,Pincode,Price_INR\nhttps://+A2:AB145www.nobroker.in/x,500001.0,1\n,,2\n", encoding="utf-8")
    got = tables.load_archive(spark, str(tmp_path / "a.csv")).orderBy("Price_INR").collect()
    assert [(r.URL, r.Source, r.Pincode) for r in got] == [("https://www.nobroker.in/x", "nobroker.in", "500001"), (None, "unknown (no URL)", None)]
    (tmp_path / "old.csv").write_text("URL,Price_INR,Odd\nhttp://a,500000000,z\n")
    tables.migrate(spark, str(tmp_path / "old.csv"), str(tmp_path / "new"))
    new = tables.read_csv(spark, str(tmp_path / "new"))
    assert new.columns == COLUMNS and (new.first().URL, new.first().Price_INR) == ("http://a", "500000000")


def test_zones_file(spark, tmp_path):
    (tmp_path / "z.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"pincode":500001,"district":"A"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"properties":{"pincode":""},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},{"properties":{"pincode":"5"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]}}]}')
    z = tables.load_zones(spark, [str(tmp_path / "z.json")]).orderBy("zone_id").collect()
    assert [(r.pincode, r.district, len(r.rings[0])) for r in z] == [("500001", "A", 4), ("5", None, 4)]
    assert tables.load_zones(spark, ["/nowhere.json"], missing_ok=True) is None


def test_records_flatten(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"district":"H","token":"1","summary":{"n":"x"},"detail":{"sections":{"P":{"a":"1"}}}}\n{"district":"h","token":"2","detail":{"sections":{"P":{"b":"2"}}}}\n{"district":"H","token":"3","error":"late"}\n')
    flat = tables.flatten_records(tables.load_records(spark, str(tmp_path / "r.jsonl")), " H ")
    assert flat.columns == ["token", "district", "summary.n", "P :: a", "P :: b"]
    assert sorted(tuple(r) for r in flat.collect()) == sorted([("1", "H", "x", "1", None), ("2", "h", None, None, "2")])


def test_registry_pages(spark):
    grid = '<table><tr><th>Name</th><th>View</th></tr><tr><td>A</td><td><a href="d?q=t1">v</a></td></tr><tr><td>B</td></tr></table> page 1 of 3'
    df = spark.createDataFrame([(grid,)], "h string")
    g = df.select(registry.parse_grid("h").alias("g"), *[c.alias(k) for k, c in registry.pager("h").items()]).first()
    assert g.g.columns == ["Name", "View"] and [r.cells for r in g.g.rows] == [{"Name": "A", "View": "v"}, {"col0": "B"}]
    assert g.pages == 3 and g.tokens == ["t1"]
    page = "<h3>Project</h3><label>Name:</label><span>Orion</span><label>Name</label><div>Other</div><h3>Parts</h3><table><tr><th>x</th><th>y</th><th>z</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"
    d = spark.createDataFrame([(page,)], "h string").select(registry.parse_detail("h").alias("d")).first().d
    assert d.sections == {"Project": {"Name": "Orion"}} and d.tables == {"Parts": [{"x": "1", "y": "2", "z": "3"}]} and d.raw_labels == {"Name": "Orion"}


def test_etl_flow_properties(spark):
    listings, reg = synthetic_listings(spark, SF)
    done = flows.run_etl(listings, reg)
    rows = done.cleaned.collect()
    assert 0 <= done.loss_pct <= 5 and len(rows) == listings.filter("Price_INR > 0 and Area_Sqft > 0").count()
    assert {r.Pincode_impute_source for r in rows} <= {"observed", "society_mode", "geo_knn", "locality_mode", "unimputed"}
    assert all((r.Pincode_impute_source == "observed") == (not r.Pincode_was_missing) for r in rows)
    assert all(r.rera_approved_date is None for r in rows)  # never imputed
    assert not set(flows.LEAKAGE_COLS) & set(done.features.columns)


def test_stream_takes_each_key_once(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string").write.parquet(str(src))
    run = lambda: ingest(file_stream(spark, str(src), "parquet", spark.read.parquet(str(src)).schema), "k", lambda b: b.withColumn("parsed", F.col("v").isNotNull()), *[str(tmp_path / n) for n in ("out", "dead", "cp")]).awaitTermination()
    run()
    spark.createDataFrame([(1, "again"), (3, "c")], "k int, v string").write.mode("append").parquet(str(src))
    run()
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "a"), (3, "c")]
    assert [r.k for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [2]
    assert dt.date.today()
