"""Registered queries of readers, writers, page parsers, registry pages, matching and flows, with their SQL.

Files are made from the test tables, written to the shared folder, and read back by the readers; pages carry facts that are
made from keys in front of the table's own HTML.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window, functions as F

from groundplan.functions import json_html, numeric, text
from groundplan.operators import features, fuzzy, impute, reports, rows, spatial
from groundplan.plans import flows
from groundplan.queries import BOX_SQL, PTS, _points, _pts, match_tables, query, r6, table
from groundplan.schema import REGISTRY
from groundplan.scratch import Scratch
from groundplan.sources import registry, sites, tables

# Readers and writers ---------------------------------------------------------------------------------------------

URLS = """CASE p_partkey % 4 WHEN 0 THEN 'https://+A2:AB145www.Example' || (p_partkey % 9)::STRING || '.com/x/' || p_partkey::STRING
 WHEN 1 THEN 'http://user@example.org:80/' || p_partkey::STRING WHEN 2 THEN '' ELSE 'https://www.site.in/p?' || p_partkey::STRING END"""


def _csv(spark, df: DataFrame, name: str) -> str:
    scratch = Scratch(spark, name)
    df.write.option("header", True).csv(f"{scratch.root}/{name}")
    return f"{scratch.root}/{name}"


@query("""SELECT p_name || ' ' || p_partkey::VARCHAR AS address,
 CASE p_partkey % 4 WHEN 0 THEN 'https://www.Example' || (p_partkey % 9)::VARCHAR || '.com/x/' || p_partkey::VARCHAR WHEN 1 THEN 'http://user@example.org:80/' || p_partkey::VARCHAR
 WHEN 2 THEN NULL ELSE 'https://www.site.in/p?' || p_partkey::VARCHAR END AS url,
 CASE p_partkey % 4 WHEN 0 THEN 'example' || (p_partkey % 9)::VARCHAR || '.com' WHEN 1 THEN 'example.org' WHEN 2 THEN 'unknown (no URL)' ELSE 'site.in' END AS source,
 CASE WHEN p_partkey % 3 <> 0 THEN (500000 + p_partkey % 50)::VARCHAR END AS pincode, p_retailprice AS price, NULL::VARCHAR AS facing, 42 AS n_columns FROM part""")
def archive_csv(spark, sf):
    """An archive with pasted cell references, blanks, codes as doubles and a column that the schema doesn't have."""
    made = table(spark, sf, "part").selectExpr(f"{URLS} AS URL", "CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE (500000 + p_partkey % 50)::STRING || '.0' END AS Pincode", "p_retailprice::STRING AS `Price_INR `", "p_name || '  ' || p_partkey::STRING AS Full_Address", "'x' AS Odd")
    x = tables.load_archive(spark, _csv(spark, made, "archive"))
    return x.select(F.col("Full_Address").alias("address"), F.col("URL").alias("url"), F.col("Source").alias("source"), F.col("Pincode").alias("pincode"), F.col("Price_INR").alias("price"), F.col("Facing").alias("facing"), F.lit(len(x.columns)).alias("n_columns"))


@query("""SELECT p_name AS society, (p_partkey * 1000000)::DOUBLE AS price, (p_partkey * 1000000)::VARCHAR AS written, p_size + 0.25 AS area, (p_size + 0.25)::VARCHAR AS written_area FROM part""")
def interim_appends(spark, sf):
    """Rows appended in two turns, read back typed and as they are written: no exponents in amounts."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("Society"), (F.col("p_partkey") * 1e6).alias("Price_INR"), (F.col("p_size") + 0.25).cast("double").alias("Area_Sqft"), F.lit("x").alias("_links"))
    path = f"{Scratch(spark, 'interim').root}/interim"
    assert tables.load_interim(spark, path) is None
    tables.append_rows(p.filter("p_partkey % 2 = 0"), path)
    tables.append_rows(p.filter("p_partkey % 2 = 1"), path)
    typed = tables.load_interim(spark, path).select(F.col("Society").alias("society"), F.col("Price_INR").alias("price"), F.col("Area_Sqft").alias("area"))
    raw = tables.read_csv(spark, path).select(F.col("Society").alias("s"), F.col("Price_INR").alias("written"), F.col("Area_Sqft").alias("written_area"))
    return typed.join(raw, (F.col("society") == F.col("s")) & (F.col("price") == F.col("written").cast("double"))).select("society", "price", "written", "area", "written_area")


@query("SELECT p_partkey::VARCHAR AS url, CASE WHEN p_partkey % 6 <> 0 THEN p_size::DOUBLE END AS bedrooms, p_retailprice AS price, CASE p_partkey % 5 WHEN 0 THEN NULL ELSE 'f' || p_type END AS furnishing FROM part")
def listings_csv(spark, sf):
    """The first path that exists, numbers coerced, junk null."""
    made = table(spark, sf, "part").select(
        F.col("p_partkey").alias("URL"), F.when(F.col("p_partkey") % 6 == 0, "NaN or so").otherwise(F.col("p_size").cast("string")).alias("BHK"), F.col("p_retailprice").alias("Price_INR"),
        F.when(F.col("p_partkey") % 5 == 0, " ").otherwise(F.concat(F.lit("f"), "p_type")).alias("Furnishing"),
    )
    path = f"{Scratch(spark, 'listings').root}/listings"
    tables.save_csv(made, path)
    return tables.load_listings(spark, f"{path}-none", path).select(F.col("URL").alias("url"), F.col("BHK").alias("bedrooms"), F.col("Price_INR").alias("price"), F.col("Furnishing").alias("furnishing"))


@query("SELECT p_partkey::VARCHAR AS rera_token, 'd' || (p_partkey % 3)::VARCHAR AS rera_district, p_name AS rera_project_name, (500000 + p_partkey % 7)::VARCHAR AS rera_pincode, NULL::VARCHAR AS rera_approved_date FROM part")
def registry_csv(spark, sf):
    names = {new: old for old, new in REGISTRY.items()}
    k = F.col("p_partkey")
    made = table(spark, sf, "part").select(
        k.alias(names["rera_token"]), F.concat(F.lit("d"), k % 3).alias(names["rera_district"]), F.col("p_name").alias(names["rera_project_name"]), (F.lit(500000) + k % 7).alias(names["rera_pincode"]), F.lit("z").alias("Else")
    )
    x = tables.load_registry(spark, _csv(spark, made, "registry"))
    return x.select("rera_token", "rera_district", "rera_project_name", "rera_pincode", "rera_approved_date")


def _records(spark, sf) -> str:
    """Registry records as JSON lines; every ninth is an error, every seventh has no section."""
    k = F.col("p_partkey")
    brand = F.create_map(F.lit("Brand"), F.col("p_brand"), F.lit("Size"), F.col("p_size").cast("string"))
    kind = F.create_map(F.lit("Type"), F.col("p_type"))
    sections = F.when(k % 7 == 0, F.create_map().cast("map<string,map<string,string>>")).when(k % 2 == 0, F.create_map(F.lit("Part"), brand)).otherwise(F.create_map(F.lit("Part"), brand, F.lit("Kind"), kind))
    made = table(spark, sf, "part").select(
        F.concat(F.lit("D"), k % 3).alias("district"), (k % 3).cast("int").alias("district_id"), F.concat(F.lit("t"), k % 1500).alias("token"), F.create_map(F.lit("Promoter Name"), F.col("p_name")).alias("summary"),
        F.when(k % 9 == 0, "late").alias("error"), F.when(k % 9 != 0, F.struct(sections.alias("sections"))).alias("detail"),
    )
    path = f"{Scratch(spark, 'records').root}/records"
    tables.append_records(made.filter("district_id < 2"), path)
    tables.append_records(made.filter("district_id = 2"), path)
    return path


@query("SELECT 't' || (p_partkey % 1500)::VARCHAR AS token, p_name AS promoter, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END AS n_sections, p_brand AS brand FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 7 <> 0")
def records_jsonl(spark, sf):
    x = tables.load_records(spark, _records(spark, sf))
    return x.select("token", F.col("summary")["Promoter Name"].alias("promoter"), F.size("detail.sections").alias("n_sections"), F.col("detail.sections")["Part"]["Brand"].alias("brand"))


@query("SELECT DISTINCT 't' || (p_partkey % 1500)::VARCHAR AS token FROM part")
def done_tokens(spark, sf):
    return tables.done_tokens(tables.load_records(spark, _records(spark, sf), successful=False))


@query("""SELECT 't' || (p_partkey % 1500)::VARCHAR AS token, 'D1' AS district, p_name AS "summary.Promoter Name", p_brand AS "Part :: Brand", p_size::VARCHAR AS "Part :: Size", CASE WHEN p_partkey % 2 = 1 THEN p_type END AS "Kind :: Type"
 FROM part WHERE p_partkey % 3 = 1 AND p_partkey % 9 <> 0 AND p_partkey % 7 <> 0""")
def flatten_records(spark, sf):
    return tables.flatten_records(tables.load_records(spark, _records(spark, sf)), " d1 ")


@query("SELECT p_name AS society, NULL::VARCHAR AS facing, p_retailprice AS price, 42 AS n_columns FROM part")
def migrated_csv(spark, sf):
    scratch = Scratch(spark, "migrated")
    old = table(spark, sf, "part").select(F.col("p_name").alias("Society"), F.col("p_retailprice").alias("Price_INR"), F.lit("x").alias("Gone"))
    old.write.option("header", True).csv(f"{scratch.root}/old")
    tables.migrate(spark, f"{scratch.root}/old", f"{scratch.root}/new")
    x = tables.load_interim(spark, f"{scratch.root}/new")
    return x.select(F.col("Society").alias("society"), F.col("Facing").alias("facing"), F.col("Price_INR").alias("price"), F.lit(len(x.columns)).alias("n_columns"))


@query("SELECT source AS \"Source\", count(*) AS rows FROM documents GROUP BY 1")
def rows_per_source(spark, sf):
    return tables.rows_per_source(table(spark, sf, "documents").withColumnRenamed("source", "Source"))


@query("""SELECT 'Deals' AS sheet, source AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL SELECT 'Overview', 'rows', count(*) FROM documents UNION ALL SELECT 'A name that is longer than thirt', lang, count(*) FROM documents GROUP BY 2""")
def report_sheets(spark, sf):
    """Sheets written and read back, one table each, names cut to 31 characters."""
    d = table(spark, sf, "documents")
    by = lambda c: d.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    root = f"{Scratch(spark, 'report').root}/report"
    names = tables.write_report({"Deals": by("source"), "A name that is longer than thirty-one characters": by("lang")}, root, d.agg(F.lit("rows").alias("value"), F.count(F.lit(1)).alias("n")))
    out = None
    for n in names:
        x = tables.read_csv(spark, f"{root}/{n}").select(F.lit(n + "t" * (len(n) == 31)).alias("sheet"), "value", F.col("n").cast("long").alias("n"))
        out = x if out is None else out.unionByName(x)
    return out


@query("SELECT 'sale' AS part, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'rental', count(*) FROM orders WHERE o_orderstatus <> 'F'")
def split_by_deal(spark, sf):
    d = F.when(F.col("o_orderstatus") == "F", "Sale").when(F.col("o_orderstatus") == "O", "Rent").otherwise("Lease")
    sale, rental = tables.split_by_deal(table(spark, sf, "orders").withColumn("deal_type", d))
    n = lambda x, name: x.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    return n(sale, "sale").unionByName(n(rental, "rental"))


# Zones with corners inwards, holes and several parts, from GeoJSON ------------------------------------------------

SHAPES = {
    "500001": [[[[-0.3, -0.3], [0.1, -0.3], [0.1, -0.2], [-0.2, -0.2], [-0.2, 0.1], [-0.3, 0.1], [-0.3, -0.3]]]],
    "500002": [[[[0.0, 0.0], [0.3, 0.0], [0.3, 0.3], [0.0, 0.3], [0.0, 0.0]], [[0.1, 0.1], [0.2, 0.1], [0.2, 0.2], [0.1, 0.2], [0.1, 0.1]]]],
    "500003": [[[[-0.15, 0.0], [-0.05, 0.0], [-0.05, 0.1], [-0.15, 0.1], [-0.15, 0.0]]], [[[-0.15, 0.15], [-0.05, 0.15], [-0.05, 0.25], [-0.15, 0.25], [-0.15, 0.15]]]],
}


@query(f"""WITH p AS ({PTS}) SELECT vec_id, CASE WHEN (x > -0.3 AND x < 0.1 AND y > -0.3 AND y < -0.2) OR (x > -0.3 AND x < -0.2 AND y > -0.3 AND y < 0.1) THEN '500001'
 WHEN x > 0 AND x < 0.3 AND y > 0 AND y < 0.3 THEN '500002' ELSE '500003' END AS pincode, 'A' AS district FROM p
 WHERE (x > -0.3 AND x < 0.1 AND y > -0.3 AND y < -0.2) OR (x > -0.3 AND x < -0.2 AND y > -0.3 AND y < 0.1)
 OR (x > 0 AND x < 0.3 AND y > 0 AND y < 0.3 AND NOT (x >= 0.1 AND x <= 0.2 AND y >= 0.1 AND y <= 0.2))
 OR (x > -0.15 AND x < -0.05 AND ((y > 0 AND y < 0.1) OR (y > 0.15 AND y < 0.25)))""")
def zones_geojson(spark, sf):
    """Points in zones read from GeoJSON: an L, a square with a hole, and two squares; a zone without a code and an open ring drop out."""
    feature = lambda code, kind, at: {"properties": {"PINCODE": code, "dtname": "A"}, "geometry": {"type": kind, "coordinates": at}}
    found = [feature(k, *(("Polygon", v[0]) if len(v) == 1 else ("MultiPolygon", v))) for k, v in SHAPES.items()]
    found += [feature("", "Polygon", [[[-1, -1], [1, -1], [1, 1], [-1, -1]]]), feature("500009", "Polygon", [[[-1, -1], [1, -1], [1, 1], [-1, 1]]])]
    scratch = Scratch(spark, "zones")
    spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": found}),)], "value string").coalesce(1).write.text(f"{scratch.root}/zones")
    return spatial.containing(_pts(spark, sf), tables.load_zones(spark, [f"{scratch.root}/zones"]), "vec_id")


# Page parsers ----------------------------------------------------------------------------------------------------


def _pages(spark, sf, url: str, facts: str) -> DataFrame:
    """The pages table with made URLs, and facts in front of its HTML; every eighth page holds none."""
    return table(spark, sf, "pages").selectExpr("page_id", f"{url} AS url", f"CASE WHEN page_id % 8 = 7 THEN '<html>nothing</html>' ELSE {facts} || html END AS html")


N = "(page_id % 90 + 10)"
OWNER_URL = "'https://n/property/' || CASE WHEN page_id % 2 = 0 THEN 'rent' ELSE 'buy' END || '/' || (page_id % 4 + 1)::STRING || '-bhk-apartment-for-sale-in-old-town-hyderabad/' || page_id::STRING || '/detail'"
OWNER = f"""'<p>3 BHK Flat for Sale in Sky &amp; Towers, Hyderabad ₹ ' || {N}::STRING || '.5 L Builtup Area ' || {N}::STRING || ',500 sq.ft Furnishing Status Semi Facing North East No. of Floors 3 / 9 '
 || 'Age of Building ' || (page_id % 12)::STRING || ' Years Ownership Type Self Maintenance 2 Bathroom No. of Bathroom</p><script>{{"locality":"Madhapur 500081", "latitude":"17.' || {N}::STRING || '"}}</script>'"""


@query(f"""SELECT 'https://n/property/' || CASE WHEN page_id % 2 = 0 THEN 'rent' ELSE 'buy' END || '/' || (page_id % 4 + 1)::VARCHAR || '-bhk-apartment-for-sale-in-old-town-hyderabad/' || page_id::VARCHAR || '/detail' AS url,
 'nobroker.in' AS source, '2026-01' AS ym, CASE WHEN page_id % 2 = 0 THEN 'Rent' ELSE 'Sale' END AS kind, {N} * 100000 + 50000.0::DOUBLE AS price, {N} * 1000 + 500.0::DOUBLE AS area,
 round(({N} * 100000 + 50000.0)::DOUBLE / ({N} * 1000 + 500.0)::DOUBLE, 2) AS per_sqft, (page_id % 4 + 1)::VARCHAR AS bedrooms, 2.0::DOUBLE AS bathrooms, '3' AS floor, 9.0::DOUBLE AS floors, (page_id % 12)::DOUBLE AS years,
 CASE WHEN page_id % 12 <= 1 THEN 'New' WHEN page_id % 12 <= 5 THEN '1-5 Years' WHEN page_id % 12 <= 10 THEN '6-10 Years' ELSE '10+ Years' END AS age_group, 'Semi' AS furnishing, 'North East' AS facing, 'Self' AS ownership,
 'Sky & Towers' AS society, 'Madhapur 500081' AS locality, '500081' AS pincode, ('17.' || {N}::VARCHAR)::DOUBLE AS lat, 'Apartment' AS property_type FROM pages WHERE page_id % 8 <> 7""")
def parse_owner_pages(spark, sf):
    x = sites.parse(_pages(spark, sf, OWNER_URL, OWNER), "nobroker.in", today=F.to_date(F.lit("2026-01-05")))
    return x.select(
        F.col("URL").alias("url"), F.col("Source").alias("source"), F.col("YearMonth").alias("ym"), F.col("Listing_Type").alias("kind"), F.col("Price_INR").alias("price"), F.col("Area_Sqft").alias("area"),
        F.round("PricePerSqft", 2).alias("per_sqft"), F.col("BHK").alias("bedrooms"), F.col("Bathrooms").alias("bathrooms"), F.col("Floor_Number").alias("floor"), F.col("Total_Floors").alias("floors"),
        F.col("Property_Age_Years").alias("years"), F.col("Age_Group").alias("age_group"), F.col("Furnishing").alias("furnishing"), F.col("Facing").alias("facing"), F.col("Ownership").alias("ownership"),
        F.col("Society").alias("society"), F.col("Locality").alias("locality"), F.col("Pincode").alias("pincode"), F.col("Latitude").alias("lat"), F.col("Property_Type").alias("property_type"),
    )


PROJECT = f"""'<script type="application/ld+json">[{{"@type":"Thing"}},{{"@graph":[{{"@type":["Product","Residence"],"name":"Plaza ' || page_id::STRING || '","address":{{"postalCode":"500082","addressLocality":"Kondapur"}},"geo":{{"latitude":17.' || {N}::STRING || '}},'
 || CASE WHEN page_id % 3 = 0 THEN '' WHEN page_id % 3 = 1 THEN '"offers":[{{"lowPrice":"' || {N}::STRING || '00000","highPrice":"' || {N}::STRING || '50000"}}],' ELSE '"offers":{{"lowPrice":' || {N}::STRING || '00000}},' END
 || '"aggregateRating":{{"ratingValue":"4.5","reviewCount":12}}}}]}}]</script><p>Other Status sold. Plaza ' || page_id::STRING || ' Status Under Construction. Total Units ' || {N}::STRING || ' around Rs. 5,100/sq. ft</p>'"""


@query(f"""SELECT 'https://m/plaza-pdpid-' || page_id::VARCHAR AS url, 'Plaza ' || page_id::VARCHAR AS society, '500082' AS pincode, 'Kondapur' AS locality, 'Under Construction' AS status, {N}::DOUBLE AS units, 5100.0::DOUBLE AS per_sqft,
 CASE WHEN page_id % 3 <> 0 THEN {N} * 100000.0::DOUBLE END AS price, CASE WHEN page_id % 3 = 1 THEN {N} * 100000.0::DOUBLE + 50000 END AS price_max, ('17.' || {N}::VARCHAR)::DOUBLE AS lat, 4.5::DOUBLE AS rating, 12.0::DOUBLE AS reviews,
 'Plaza ' || page_id::VARCHAR || ', Kondapur, Hyderabad' AS address FROM pages WHERE page_id % 8 <> 7""")
def parse_project_pages(spark, sf):
    x = sites.parse(_pages(spark, sf, "'https://m/plaza-pdpid-' || page_id::STRING", PROJECT), "magicbricks.com")
    return x.select(
        F.col("URL").alias("url"), F.col("Society").alias("society"), F.col("Pincode").alias("pincode"), F.col("Locality").alias("locality"), F.col("Construction_Status").alias("status"), F.col("Total_Units").alias("units"),
        F.col("PricePerSqft").alias("per_sqft"), F.col("Price_INR").alias("price"), F.col("Price_Max_INR").alias("price_max"), F.col("Latitude").alias("lat"), F.col("Rating").alias("rating"), F.col("Review_Count").alias("reviews"),
        F.col("Full_Address").alias("address"),
    )


RESALE_URL = "CASE WHEN page_id % 2 = 0 THEN 'https://s/green-meadows/' || page_id::STRING || '/project' ELSE 'https://s/resale-2-bhk-900-sq-ft-flat-in-kukat-pally/' || page_id::STRING END"
RESALE = f"""CASE WHEN page_id % 2 = 0 THEN '<p>2 BHK Apartment 1,' || {N}::STRING || '0 Sq. Ft. ₹ ' || {N}::STRING || ' L 3 BHK Apartment 2,500 Sq. Ft. Price on Request avg. price is ₹ 5.5k compared with Kukatpally.</p>'
 ELSE '<p>Listing ID: #12 ₹ ' || {N}::STRING || ' Lac Area Carpet Area 100 Sq. Yards Number of Bathroom 2 Floor Number 4 Total Floors 9 Age of Property 7 Years Facing East View Park Property Information Locality Kukat Pally Project Sun City Price x City Hyderabad Micro market</p>' END"""


@query(f"""SELECT CASE WHEN page_id % 2 = 0 THEN 'https://s/green-meadows/' || page_id::VARCHAR || '/project' ELSE 'https://s/resale-2-bhk-900-sq-ft-flat-in-kukat-pally/' || page_id::VARCHAR END AS url,
 CASE WHEN page_id % 2 = 0 THEN 'Green Meadows' ELSE 'Sun City' END AS society, CASE WHEN page_id % 2 = 0 THEN 'Kukatpally' ELSE 'Kukat Pally' END AS locality, {N} * 100000.0::DOUBLE AS price,
 CASE WHEN page_id % 2 = 0 THEN 1000.0 + {N} * 10 ELSE 900.0 END::DOUBLE AS area, CASE WHEN page_id % 2 = 0 THEN 2500.0 END::DOUBLE AS area_max, CASE WHEN page_id % 2 = 0 THEN '2/3' ELSE '2' END AS bedrooms,
 CASE WHEN page_id % 2 = 0 THEN 5500.0::DOUBLE ELSE round({N} * 100000.0::DOUBLE / 900, 2) END AS per_sqft, CASE WHEN page_id % 2 = 1 THEN 2.0 END::DOUBLE AS bathrooms, CASE WHEN page_id % 2 = 1 THEN '4' END AS floor,
 CASE WHEN page_id % 2 = 1 THEN 7.0 END::DOUBLE AS years, CASE WHEN page_id % 2 = 1 THEN 'East' END AS facing, CASE WHEN page_id % 2 = 0 THEN 'New Property' ELSE 'Resale' END AS deal FROM pages WHERE page_id % 8 <> 7""")
def parse_resale_pages(spark, sf):
    x = sites.parse(_pages(spark, sf, RESALE_URL, RESALE), "squareyards.com")
    return x.select(
        F.col("URL").alias("url"), F.col("Society").alias("society"), F.col("Locality").alias("locality"), F.col("Price_INR").alias("price"), F.col("Area_Sqft").alias("area"), F.col("Area_Max_Sqft").alias("area_max"),
        F.col("BHK").alias("bedrooms"), F.round("PricePerSqft", 2).alias("per_sqft"), F.col("Bathrooms").alias("bathrooms"), F.col("Floor_Number").alias("floor"), F.col("Property_Age_Years").alias("years"),
        F.col("Facing").alias("facing"), F.col("Transaction").alias("deal"),
    )


LABELLED = f"""'<h1>Property Information</h1> Listing Type ' || CASE WHEN page_id % 2 = 0 THEN 'Sale' ELSE 'Rent' END || ' Property Type Flat City Hyderabad Locality Miyapur Price ' || {N}::STRING || ' Lac Balcony 2 Built Up Area '
 || {N}::STRING || CASE page_id % 3 WHEN 0 THEN ' Sq. Yards' WHEN 1 THEN ' Sq.Meter' ELSE ' Acre' END || ' Age of Property New Project &amp; Society Rose Garden Floor Number 3 Total Floor Count 5 Facing West Status Ready Amenities '"""


@query(f"""SELECT 'https://r/2-bhk-flat-hyderabad-' || page_id::VARCHAR AS url, CASE WHEN page_id % 2 = 0 THEN 'Sale' ELSE 'Rent' END AS kind, {N} * 100000.0::DOUBLE AS price,
 round({N} * CASE page_id % 3 WHEN 0 THEN 9.0 WHEN 1 THEN 10.7639 ELSE 43560.0 END::DOUBLE, 2) AS area, '2' AS bedrooms, 2.0::DOUBLE AS balconies, 0.0::DOUBLE AS years, 'New' AS age_group, 'Rose Garden' AS society, '3' AS floor,
 5.0::DOUBLE AS floors, 'West' AS facing, 'Ready' AS status, 'Rose Garden, Miyapur, Hyderabad, India' AS address FROM pages WHERE page_id % 8 <> 7""")
def parse_labelled_pages(spark, sf):
    x = sites.parse(_pages(spark, sf, "'https://r/2-bhk-flat-hyderabad-' || page_id::STRING", LABELLED), "realestateindia.com")
    return x.select(
        F.col("URL").alias("url"), F.col("Listing_Type").alias("kind"), F.col("Price_INR").alias("price"), F.col("Area_Sqft").alias("area"), F.col("BHK").alias("bedrooms"), F.col("Balconies").alias("balconies"),
        F.col("Property_Age_Years").alias("years"), F.col("Age_Group").alias("age_group"), F.col("Society").alias("society"), F.col("Floor_Number").alias("floor"), F.col("Total_Floors").alias("floors"), F.col("Facing").alias("facing"),
        F.col("Construction_Status").alias("status"), F.col("Full_Address").alias("address"),
    )


RANGES = f"""'<script type="application/ld+json">{{"@type":"Apartment","name":"Orion","address":{{"addressLocality":"Kokapet, Hyderabad"}},"geo":{{"longitude":"78.' || {N}::STRING || '"}}}}</script> by Alpha, Beta Group Kokapet, (show on map) ₹ ' || {N}::STRING
 || ' L - ₹ 1.5 Cr Configuration 2, 3 BHK Area sq ft 1,' || {N}::STRING || '0 - 2,800 sq ft Avg. Price ₹ 6,' || {N}::STRING || '0 Possession Status Ready To Move Price RERA ID P0240000' || {N}::STRING || ' '"""


@query(f"""SELECT 'https://p/hyderabad/orion-' || page_id::VARCHAR AS url, {N} * 100000.0::DOUBLE AS price, 15000000.0::DOUBLE AS price_max, 1000.0::DOUBLE + {N} * 10 AS area, 2800.0::DOUBLE AS area_max, '2/3' AS bedrooms, 'Kokapet' AS locality,
 'Orion' AS society, 'Alpha, Beta Group' AS builder, 6000.0::DOUBLE + {N} * 10 AS per_sqft, 'Ready To Move' AS status, 'P0240000' || {N}::VARCHAR AS rera, ('78.' || {N}::VARCHAR)::DOUBLE AS lon, 'Apartment' AS property_type FROM pages WHERE page_id % 8 <> 7""")
def parse_range_pages(spark, sf):
    x = sites.parse(_pages(spark, sf, "'https://p/hyderabad/orion-' || page_id::STRING", RANGES), "proptiger.com")
    return x.select(
        F.col("URL").alias("url"), F.col("Price_INR").alias("price"), F.col("Price_Max_INR").alias("price_max"), F.col("Area_Sqft").alias("area"), F.col("Area_Max_Sqft").alias("area_max"), F.col("BHK").alias("bedrooms"),
        F.col("Locality").alias("locality"), F.col("Society").alias("society"), F.col("Builder").alias("builder"), F.col("PricePerSqft").alias("per_sqft"), F.col("Construction_Status").alias("status"), F.col("RERA_ID").alias("rera"),
        F.col("Longitude").alias("lon"), F.col("Property_Type").alias("property_type"),
    )


@query("SELECT 'nobroker.in' AS site, (page_id % 8 <> 7) AS parsed, count(*) AS n FROM pages GROUP BY 2")
def parse_counters(spark, sf):
    """Parsed and failed pages of a site."""
    from groundplan.streaming.ingest import counters

    x = counters(sites.parse_all(_pages(spark, sf, OWNER_URL, OWNER), "nobroker.in").withColumn("site", F.lit("nobroker.in")), "site")
    return x.select("site", F.inline(F.array(F.struct(F.lit(True).alias("parsed"), F.col("parsed").alias("n")), F.struct(F.lit(False).alias("parsed"), F.col("failed").alias("n")))))


SITEMAPS = {
    "nobroker.in": ("https://n/sitemap/sale_hyderabad.xml", "'https://n/property/buy/x-' || k || '/detail'", "https://n/other.xml"),
    "magicbricks.com": ("https://m/pdp_Hyderabad2.xml", "'https://m/x-' || k || '-pdpid-1'", "https://m/pdp_Pune2.xml"),
    "squareyards.com": ("https://s/sitemap-project3.xml", "'https://s/hyderabad-residential-property/x-' || k || '/project'", "https://s/sitemap-blog1.xml"),
    "realestateindia.com": ("https://r/property-detail-buy1.xml", "'https://r/x-' || k || '-flat-in-hyderabad'", "https://r/agents.xml"),
    "proptiger.com": ("https://p/secure-sitemap-project-1.xml", "'https://p/hyderabad/x-' || k", "https://p/secure-sitemap-city.xml"),
}


@query(" UNION ALL ".join(f"SELECT DISTINCT '{n}' AS site, {u.replace(' k', ' (page_id % 100)::VARCHAR')} AS url FROM pages WHERE page_id % 3 <> 0" for n, (_, u, _) in SITEMAPS.items()))
def discover_pages(spark, sf):
    """Pages of all five sites from their sitemaps: other sitemaps and other URLs are left out, repeats once."""
    p = table(spark, sf, "pages").select((F.col("page_id") % 100).cast("string").alias("k"), (F.col("page_id") % 3).alias("m"))
    out = None
    for name, (good, url, bad) in SITEMAPS.items():
        loc = F.concat(F.lit("<url><loc>"), F.expr(url), F.lit("</loc></url><url><loc>https://x/about</loc></url>"))
        maps = p.select(F.when(F.col("m") == 0, bad).otherwise(good).alias("sitemap"), loc.alias("xml"))
        found = sites.discover(maps, name, [r"\.xml$"]).select(F.lit(name).alias("site"), "url")
        out = found if out is None else out.unionByName(found)
    return out


@query("""SELECT 'link' AS what, page_id AS page, unnest(list_distinct(regexp_extract_all(html, 'href="(/[^"#?]+)"', 1))) AS link FROM pages WHERE page_id % 5 <> 0 AND page_id % 7 <> 0
UNION ALL SELECT 'done', page_id, NULL FROM pages WHERE page_id % 5 <> 0 AND page_id % 7 <> 0""")
def expand_index_pages(spark, sf):
    """Links of index pages that aren't done and could be fetched, and the pages that are then."""
    p = table(spark, sf, "pages").select(F.col("page_id").alias("url"), F.when(F.col("page_id") % 7 != 0, F.col("html")).alias("html"))
    links, done = sites.expand_index(p, p.filter("url % 5 = 0").select("url"), r'href="(/[^"#?]+)"')
    return links.select(F.lit("link").alias("what"), "page", "link").unionByName(done.select(F.lit("done").alias("what"), F.col("url").alias("page"), F.lit(None).cast("string").alias("link")))


# Registry pages --------------------------------------------------------------------------------------------------

GRID = """'<table><tr><td>x</td></tr></table><table><tr><th>Name</th><th> Size </th><th>View</th></tr><tr><td>' || p_name || '</td><td>' || p_size::STRING || '</td><td><a href="d?q=t' || p_partkey::STRING || '">v</a></td></tr>'
 || '<tr><td>' || p_brand || '</td><td>short</td></tr></table> page 1 of 3 of 1,234 records <a href="?page=3">3</a><a href="?page=2">2</a><a href="?page=3">3</a>'"""


@query("""SELECT p_partkey, 0 AS row, 'Name' AS key, p_name AS value, 't' || p_partkey::VARCHAR AS token FROM part UNION ALL SELECT p_partkey, 0, 'Size', p_size::VARCHAR, 't' || p_partkey::VARCHAR FROM part
UNION ALL SELECT p_partkey, 0, 'View', 'v', 't' || p_partkey::VARCHAR FROM part UNION ALL SELECT p_partkey, 1, 'col0', p_brand, 't' || p_partkey::VARCHAR FROM part UNION ALL SELECT p_partkey, 1, 'col1', 'short', 't' || p_partkey::VARCHAR FROM part""")
def registry_grid(spark, sf):
    """Cells of the largest table by header or place, and the row's token."""
    x = table(spark, sf, "part").select("p_partkey", F.expr(GRID).alias("h"))
    x = x.select("p_partkey", registry.parse_grid("h").alias("g"), registry.pager("h")["tokens"].alias("tokens"))
    x = x.select("p_partkey", F.posexplode("g.rows").alias("row", "r"), F.get("tokens", F.lit(0)).alias("token"))
    return x.select("p_partkey", "row", F.explode("r.cells").alias("key", "value"), "token")


@query("SELECT p_partkey, 1234 AS records, 3 AS pages, 2 AS first_page, 2 AS n_page_numbers, 't' || p_partkey::VARCHAR AS token, CASE p_partkey % 3 WHEN 0 THEN 'captcha' WHEN 1 THEN 'expired' ELSE 'ok' END AS status, 'v' || p_size::VARCHAR AS option_value, p_type AS option_label FROM part")
def registry_pager(spark, sf):
    said = F.when(F.col("p_partkey") % 3 == 0, "<b>Enter the CAPTCHA</b>").when(F.col("p_partkey") % 3 == 1, "Your session has expired").otherwise("fine")
    select = F.concat(F.lit('<select id="a" name="District"><option value="0">All</option><option value=" v'), F.col("p_size"), F.lit('"> '), F.col("p_type"), F.lit(" </option></select>"))
    x = table(spark, sf, "part").select("p_partkey", "p_size", "p_type", F.expr(GRID).alias("h"), said.alias("said"), select.alias("s"))
    p = registry.pager("h")
    option = F.get(registry.select_options("s", "District"), F.lit(0))
    return x.select(
        "p_partkey", p["records"].alias("records"), p["pages"].alias("pages"), F.get(p["page_numbers"], F.lit(0)).alias("first_page"), F.size(p["page_numbers"]).alias("n_page_numbers"), F.get(p["tokens"], F.lit(0)).alias("token"),
        registry.response_status("said").alias("status"), option["value"].alias("option_value"), option["label"].alias("option_label"),
    )


DETAIL = """CASE WHEN p_partkey % 6 = 0 THEN 'session expired' ELSE '<h3>Zoning</h3><label>Zone:</label><span>z</span><h3>Project Information</h3><label>Name:</label><span>' || p_name || '</span><label>Name</label><div>Other</div><label>Brand</label><input value="' || p_brand || '">'
 || '<h3>Parts</h3><table><tr><th>x</th><th>y</th><th>z</th></tr><tr><td>1</td><td>' || p_size::STRING || '</td><td>3</td></tr></table>' END"""


@query("""SELECT p_partkey AS token, 'Project Information > Zoning' AS sections, p_name AS name, p_brand AS brand, p_size::VARCHAR AS y, NULL::VARCHAR AS error FROM part WHERE p_partkey % 6 <> 0
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, 'expired' FROM part WHERE p_partkey % 6 = 0""")
def registry_detail(spark, sf):
    """Detail pages: sections in their known order, the first of equal labels, tables; failed pages with their reason."""
    pages = table(spark, sf, "part").select(F.col("p_partkey").alias("token"), F.expr(DETAIL).alias("html"))
    good, again = registry.enriched(pages)
    d = F.col("detail")
    s = d["sections"]["Project Information"]
    good = good.select("token", F.array_join(F.map_keys(d["sections"]), " > ").alias("sections"), s["Name"].alias("name"), s["Brand"].alias("brand"), F.get(d["tables"]["Parts"], F.lit(0))["y"].alias("y"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(again, allowMissingColumns=True)


# Functions -------------------------------------------------------------------------------------------------------


@query(r"""SELECT page_id, url AS repaired, string_split(url, '/')[3] AS third, string_split(url, '/')[-1] AS last, regexp_replace(url, '[^\p{L}\p{N}]', '_', 'g') AS slug, 'A Bc D' AS unslugged, 'x, ' || page_id::VARCHAR AS joined,
 'a b+c/é' AS decoded, '17.5' AS first, '' AS none, 'one two' AS cleaned, CASE WHEN page_id % 2 = 0 THEN NULL ELSE page_id::VARCHAR END AS blank, 'Semi/Fully Furnished' AS title FROM pages""")
def text_pieces(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", text.repair_url(F.concat(F.substring(u, 1, 4), F.lit("+A12:ZB9"), F.substring(u, 5, 9999))).alias("repaired"), text.segment(u, 3).alias("third"), text.segment(u, -1).alias("last"), text.slugify(u).alias("slug"),
        text.unslug(F.lit("a-bc-d")).alias("unslugged"), text.join_non_empty(F.lit("x"), F.lit(""), F.lit(None).cast("string"), F.col("page_id").cast("string")).alias("joined"), text.url_decode(F.lit("a%20b+c%2F%C3%A9")).alias("decoded"),
        text.first_group(F.lit("lat: 17.5 lon"), r"lat: ([\d.]+)").alias("first"), text.first_group(F.lit("x"), r"(\d)").alias("none"), text.clean_space(F.lit("  one \t two ")).alias("cleaned"),
        text.blank_to_null(F.when(F.col("page_id") % 2 == 0, " \n ").otherwise(F.col("page_id").cast("string"))).alias("blank"), text.title_case(F.lit("semi/fully furnished")).alias("title"),
    )


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE round_even(p_retailprice * 1003, 0) END AS price, CASE WHEN p_size % 4 = 0 THEN NULL ELSE round_even(p_retailprice * 1003 / 1e7, 4) END AS crores,
 round_even((p_size * 10.00713)::DOUBLE, 2) AS area, CASE WHEN p_size % 4 <> 0 THEN round(p_retailprice * 1003 / (p_size * 10.00713)::DOUBLE, 2) END AS per_sqft, least(p_size / 20.0, 1)::DOUBLE AS ratio FROM part""")
def listing_prices(spark, sf):
    """Price, crores, area and price by area of raw values, zero being missing."""
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 4 == 0, 0.0).otherwise(F.col("p_retailprice") * 1003).alias("p"), (F.col("p_size") * F.lit(10.00713)).alias("a"), "p_size")
    d = numeric.derived_prices(F.col("p"), F.col("a"))
    return p.select("p_partkey", d["Price_INR"].alias("price"), d["Price_Cr"].alias("crores"), d["Area_Sqft"].alias("area"), F.round(F.col("p") / F.nullif(F.when(F.col("p") != 0, F.col("a")), F.lit(0.0)), 2).alias("per_sqft"), numeric.safe_ratio_positive("p_size", F.lit(20)).alias("ratio"))


NODES = """'<script type="application/ld+json">not json</script><script type="application/ld+json">{"@graph":[{"@type":"Thing","name":"no"},{"@type":["X","Residence"],"name":"' || p_name || '","offers":'
 || CASE WHEN p_partkey % 2 = 0 THEN '[{"low":' || p_size::STRING || '}]' ELSE '{"low":' || p_size::STRING || '}' END || '}]}</script>'"""


@query("SELECT p_partkey, 2 AS n_nodes, p_name AS name, p_size::VARCHAR AS low, NULL::VARCHAR AS missing, true AS is_residence FROM part")
def ld_json_nodes(spark, sf):
    """JSON-LD: broken blocks skipped, lists and graphs flattened, types by name or list, offers as object or list."""
    x = table(spark, sf, "part").select("p_partkey", json_html.ld_json(F.expr(NODES)).alias("n"))
    node = json_html.first_of_type(F.col("n"), "Residence", "Product")
    return x.select("p_partkey", F.size("n").alias("n_nodes"), json_html.field(node, "$.name").alias("name"), json_html.first_offer(node, "low").alias("low"), json_html.field(node, "$.address.code").alias("missing"), json_html.has_type(node, "Residence").alias("is_residence"))


@query("""SELECT p_partkey, p_name AS a, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS b, CASE WHEN p_partkey % 2 = 1 THEN p_name END AS col0, 'B,a' AS ordered FROM part""")
def row_maps(spark, sf):
    """Rows as maps by header, or by place where the numbers differ; the first of equal names counts; keys in a known order."""
    header = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a")))
    m = json_html.row_map(header, F.array("p_name", "p_type", F.lit("again")))
    o = json_html.ordered_sections(F.create_map(F.lit("a"), F.lit(1), F.lit("B"), F.lit(2)), ["B", "C"])
    x = table(spark, sf, "part").select("p_partkey", "p_name", m.alias("m"), o.alias("o"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    return x.select("p_partkey", F.coalesce(get("a"), get("col0")).alias("a"), get("b").alias("b"), get("col0").alias("col0"), F.array_join(F.map_keys("o"), ",").alias("ordered"))


@query("SELECT p_type AS site, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS r FROM part) WHERE r <= 7")
def site_limit(spark, sf):
    return rows.site_limit(table(spark, sf, "part").select(F.col("p_type").alias("site"), "p_partkey"), "site", ["p_partkey"], 7)


@query("SELECT p_partkey FROM part ORDER BY md5(p_partkey::VARCHAR || ':42'), p_partkey LIMIT 50")
def seeded_sample(spark, sf):
    return rows.seeded_sample(table(spark, sf, "part").select("p_partkey"), "p_partkey", 50)


@query("""SELECT o_orderkey, ('0x' || substr(md5(o_orderkey::VARCHAR || ':42'), 1, 8))::BIGINT % 5 = 0 AS in_test FROM orders""")
def train_test_split(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", features.in_test("o_orderkey").alias("in_test"))


@query("""WITH n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Semi Furnished' WHEN 1 THEN 'Ready To Move' ELSE upper(p_name[1]) || '' END AS name FROM part),
c AS (SELECT name, count(*) AS n FROM n GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5) SELECT p_partkey, coalesce(c.name, 'Other') AS name FROM n LEFT JOIN c USING (name)""")
def collapse_normalised(spark, sf):
    """Categories in many spellings, brought to one before the most frequent are kept."""
    k = F.col("p_partkey")
    spelt = F.when(k % 3 == 0, F.when(k % 2 == 0, "semi-furnished Property").otherwise(" SEMI  furnished")).when(k % 3 == 1, F.when(k % 2 == 0, "ready-to-move").otherwise("Ready to Move properties")).otherwise(F.substring("p_name", 1, 1))
    return features.collapse_to_top_n(table(spark, sf, "part").select("p_partkey", spelt.alias("name")), "name", 5)


@query("""WITH x AS (SELECT o_orderpriority AS g, o_totalprice AS v FROM orders) SELECT round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS q2, round(quantile_cont(v, 0.75), 6) AS q3, g FROM x GROUP BY g""")
def box_plot_quartiles(spark, sf):
    from groundplan.operators.quantiles import quantiles_by_group

    x = quantiles_by_group(table(spark, sf, "orders"), ["o_totalprice"], [0.25, 0.5, 0.75], "o_orderpriority", "g")
    return x.select(*[F.round(F.get("o_totalprice", F.lit(i)), 6).alias(f"q{i + 1}") for i in range(3)], "g")


# Matching: the same similarity in SQL, by the recurrence of bit-parallel longest common subsequences ---------------

SORTED = "array_to_string(list_sort(list_filter(string_split_regex({0}, '\\s+'), lambda w: w <> '')), ' ')"


def ratio_sql(a: str, b: str) -> str:
    """100 * 2 * LCS / (la + lb) of two strings of 60 characters at most."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    places = f"list_sum(list_transform(range(length({a})), lambda i: CASE WHEN {a}[i + 1] = c THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END))::HUGEINT"
    left = f"list_reduce(list_prepend({full}, list_transform(string_split({b}, ''), lambda c: {places})), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    return f"200.0 * (length({a}) - bit_count({left})) / (length({a}) + length({b}))"


BLOCKED_SQL = f"""WITH p AS (SELECT DISTINCT string_split(p_name, ' ')[-1] || ' ' || p_name AS name, p_brand AS block FROM part), r AS (SELECT p_name AS ref, p_brand AS block, min(p_partkey) AS idx FROM part GROUP BY 1, 2),
k AS (SELECT name, block, {SORTED.format("name")} AS s FROM p), t AS (SELECT idx, block, {SORTED.format("ref")} AS t FROM r),
d AS (SELECT s, t, {ratio_sql("s", "t")} AS score FROM (SELECT DISTINCT s, t FROM k JOIN t USING (block)) WHERE 200.0 * least(length(s), length(t)) >= 60 * (length(s) + length(t))),
m AS (SELECT name, k.block, score, idx, row_number() OVER (PARTITION BY name, k.block ORDER BY score DESC, idx) AS n FROM k JOIN t USING (block) JOIN d USING (s, t) WHERE score >= 60)
SELECT name, block, round(score, 6)::DOUBLE AS score, idx FROM m WHERE n = 1"""


@query(BLOCKED_SQL)
def token_sort_match_segments(spark, sf):
    """The same, with every block searched by the index of segments."""
    return _blocked(spark, sf, 1)


@query(BLOCKED_SQL)
def token_sort_match_blocked(spark, sf):
    """Names with a word repeated, against the registry of the same block, from 60."""
    return _blocked(spark, sf, fuzzy.LARGE_BLOCK)


def _blocked(spark, sf, large):
    reg = table(spark, sf, "part").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("idx")).select("idx", F.col("p_name").alias("ref"), F.col("p_brand").alias("block"))
    p = table(spark, sf, "part").select(F.concat(F.element_at(F.split("p_name", " "), -1), F.lit(" "), F.col("p_name")).alias("name"), F.col("p_brand").alias("block")).distinct()
    return fuzzy.blocked_match(p, reg, 60.0, large).select("name", "block", r6("score").alias("score"), "idx")


EDITED = "CASE p_partkey % 3 WHEN 0 THEN p_name || 's' WHEN 1 THEN replace(p_name, 'a', '') ELSE substr(p_name, 2) || ' tower' END"


@query(f"""WITH p AS (SELECT DISTINCT {EDITED} AS name FROM part), r AS (SELECT p_name AS ref, min(p_partkey) AS idx FROM part GROUP BY 1), k AS (SELECT name, {SORTED.format("name")} AS s FROM p WHERE name <> ''), t AS (SELECT idx, {SORTED.format("ref")} AS t FROM r),
d AS (SELECT s, t, {ratio_sql("s", "t")} AS score FROM (SELECT DISTINCT s, t FROM k, t) WHERE 200.0 * least(length(s), length(t)) >= 90 * (length(s) + length(t))),
m AS (SELECT name, score, idx, row_number() OVER (PARTITION BY name ORDER BY score DESC, idx) AS n FROM k JOIN d USING (s) JOIN t USING (t) WHERE score >= 90) SELECT name, round(score, 6)::DOUBLE AS score, idx FROM m WHERE n = 1""")
def token_sort_match_global(spark, sf):
    """Names with letters added, lost and changed, against all names, from 90."""
    part = table(spark, sf, "part")
    names = part.groupBy("p_name").agg(F.min("p_partkey").alias("idx")).select("idx", F.col("p_name").alias("ref"))
    return fuzzy.global_match(part.selectExpr(f"{EDITED} AS name"), names).select("name", r6("score").alias("score"), "idx")


TIERS = f"""WITH l AS (SELECT p_partkey, coalesce(trim(regexp_replace(regexp_replace(upper(CASE WHEN p_partkey % 10 <> 0 THEN p_name || ' ' || substr(p_type, 1, 2) END), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')), '') AS name,
 CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey % 50 + 500000)::VARCHAR END AS block FROM part),
g AS (SELECT p_partkey AS idx, CASE WHEN p_partkey % 4 = 3 THEN 'Zq' || reverse(p_name) || ' Xv' || p_partkey::VARCHAR ELSE p_name END AS project, (p_partkey % 50 + 500000)::VARCHAR AS block, 'Promoter ' || (p_partkey % 7)::VARCHAR AS promoter FROM part),
k AS (SELECT DISTINCT name, block, {SORTED.format("name")} AS s FROM l WHERE name <> ''),
t AS (SELECT idx, block, {SORTED.format("trim(regexp_replace(regexp_replace(upper(project), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))")} AS t FROM g),
d1 AS (SELECT s, t, {ratio_sql("s", "t")} AS score FROM (SELECT DISTINCT s, t FROM k JOIN t USING (block)) WHERE 200.0 * least(length(s), length(t)) >= 85 * (length(s) + length(t))),
one AS (SELECT name, k.block, score, idx FROM k JOIN t USING (block) JOIN d1 USING (s, t) WHERE score >= 85 QUALIFY row_number() OVER (PARTITION BY name, k.block ORDER BY score DESC, idx) = 1),
miss AS (SELECT DISTINCT name, s FROM k WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.name = k.name AND one.block IS NOT DISTINCT FROM k.block)),
d2 AS (SELECT s, t, {ratio_sql("s", "t")} AS score FROM (SELECT DISTINCT miss.s, t.t FROM miss, t) WHERE 200.0 * least(length(s), length(t)) >= 90 * (length(s) + length(t))),
two AS (SELECT name, score, idx FROM miss JOIN d2 USING (s) JOIN t USING (t) WHERE score >= 90 QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, idx) = 1),
m AS (SELECT p_partkey, coalesce(one.score, two.score, 0) AS score, CASE WHEN l.name = '' THEN 'no_society' WHEN one.idx IS NOT NULL THEN 'pincode_block' WHEN two.idx IS NOT NULL THEN 'name_only' ELSE 'unmatched' END AS method, coalesce(one.idx, two.idx) AS idx
 FROM l LEFT JOIN one ON one.name = l.name AND one.block = l.block LEFT JOIN two ON two.name = l.name)"""


@query(TIERS + " SELECT p_partkey, round(score, 6)::DOUBLE AS match_score, method AS match_method, idx FROM m")
def tiered_match(spark, sf):
    return fuzzy.match(*match_tables(spark, sf), "p_partkey").select("p_partkey", r6("match_score").alias("match_score"), "match_method", "idx")


@query(TIERS + """ SELECT count(*) AS n_rows, count(m.idx) AS n_matched, round(count(m.idx) / count(*), 6)::DOUBLE AS match_rate, count_if(method = 'pincode_block') AS n_pincode_block, count_if(method = 'name_only') AS n_name_only,
 count_if(method = 'unmatched') AS n_unmatched, count_if(method = 'no_society') AS n_no_society, count(DISTINCT project) AS n_projects, count(DISTINCT promoter) AS n_promoters FROM m LEFT JOIN g ON g.idx = m.idx""")
def match_report(spark, sf):
    return fuzzy.report(fuzzy.attach(*match_tables(spark, sf), "p_partkey", ["rera_project_name", "rera_promoter_name"]))


# Flows -----------------------------------------------------------------------------------------------------------

LAYERS = """WITH x AS (SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN embedding[1]::DOUBLE END AS lat, CASE WHEN vec_id % 5 <> 0 THEN embedding[2]::DOUBLE END AS lon, CASE WHEN vec_id % 3 <> 0 THEN (500000 + label)::VARCHAR END AS pin,
 CASE WHEN vec_id % 7 = 0 THEN 'society ' || (vec_id % 10)::VARCHAR END AS soc, 'area ' || (vec_id % 8)::VARCHAR AS loc FROM embeddings),
s AS (SELECT soc, pin AS m1 FROM (SELECT soc, pin, count(*) AS n FROM x WHERE soc IS NOT NULL AND pin IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY soc ORDER BY n DESC, pin) = 1),
a AS (SELECT loc, pin AS m3 FROM (SELECT loc, pin, count(*) AS n FROM x WHERE pin IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY loc ORDER BY n DESC, pin) = 1),
t AS (SELECT lat, lon, pin FROM x WHERE pin IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL), q AS (SELECT DISTINCT lat, lon FROM x WHERE pin IS NULL AND lat IS NOT NULL AND lon IS NOT NULL),
d AS (SELECT q.lat, q.lon, t.pin, sqrt((t.lon - q.lon) ** 2 + (t.lat - q.lat) ** 2) AS d, row_number() OVER (PARTITION BY q.lat, q.lon ORDER BY sqrt((t.lon - q.lon) ** 2 + (t.lat - q.lat) ** 2), t.pin, t.lat, t.lon) AS r FROM q, t),
n AS (SELECT *, min(d) OVER (PARTITION BY lat, lon) AS least FROM d WHERE r <= 15),
v AS (SELECT lat, lon, pin, sum(CASE WHEN d = 0 THEN 1 ELSE 1 / d END) AS v FROM n WHERE least > 0 OR d = 0 GROUP BY 1, 2, 3),
k AS (SELECT lat, lon, pin AS m2 FROM v QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY round(v, 6) DESC, pin) = 1)"""


@query(LAYERS + """ SELECT vec_id, coalesce(pin, m1, m2, m3) AS "Pincode", pin IS NULL AS "Pincode_was_missing",
 CASE WHEN pin IS NOT NULL THEN 'observed' WHEN m1 IS NOT NULL THEN 'society_mode' WHEN m2 IS NOT NULL THEN 'geo_knn' WHEN m3 IS NOT NULL THEN 'locality_mode' ELSE 'unimputed' END AS "Pincode_impute_source"
 FROM x LEFT JOIN s USING (soc) LEFT JOIN k USING (lat, lon) LEFT JOIN a USING (loc)""")
def layered_impute(spark, sf):
    p = _points(spark, sf).select(
        "vec_id", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"), (F.lit(500000) + F.col("label")).cast("string").alias("Pincode"),
        F.when(F.col("vec_id") % 7 == 0, F.concat(F.lit("Society "), F.col("vec_id") % 10)).alias("Society"), F.concat(F.lit("Area "), F.col("vec_id") % 8, F.lit(", Hyderabad")).alias("Locality"),
    )
    return impute.layered_impute(p).select("vec_id", "Pincode", "Pincode_was_missing", "Pincode_impute_source")


@query(f"""WITH z AS ({BOX_SQL}), p AS ({PTS}), a AS (SELECT DISTINCT vec_id // 2 AS k, min(x) OVER w AS x, min(y) OVER w AS y FROM p WINDOW w AS (PARTITION BY vec_id // 2)),
d AS (SELECT k, pincode, min(sqrt(greatest(x0 - x, 0, x - x1) ** 2 + greatest(y0 - y, 0, y - y1) ** 2)) AS d FROM a, z GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d, pincode) AS r FROM d WHERE d <= 5 / 111),
l AS (SELECT k, string_agg(pincode, ', ' ORDER BY r) AS codes, min(CASE WHEN r = 1 THEN pincode END) AS one FROM n WHERE r <= 3 GROUP BY 1)
SELECT 'row' AS what, 's' || (k % 3)::VARCHAR AS source, 'k' || k::VARCHAR AS url, coalesce(CASE WHEN k % 4 = 0 THEN '999999' END, one) AS pincode, codes, NULL::BIGINT AS n FROM a LEFT JOIN l USING (k)
UNION ALL SELECT 'source', 's' || (k % 3)::VARCHAR, NULL, NULL, NULL, count(*) FROM a GROUP BY 2""")
def build_final(spark, sf):
    """Archive and crawled rows, half of them equal, in one table with codes from zones, and its rows by source."""
    from groundplan.queries import _zones

    w = Window.partitionBy("k")
    x = _pts(spark, sf).withColumn("k", F.floor(F.col("vec_id") / 2)).select("vec_id", "k", F.min("Longitude").over(w).alias("Longitude"), F.min("Latitude").over(w).alias("Latitude"))
    x = x.select(F.col("vec_id"), F.concat(F.lit("s"), F.col("k") % 3).alias("Source"), F.concat(F.lit("k"), F.col("k")).alias("URL"), F.when(F.col("k") % 4 == 0, "999999").alias("Pincode"), "Longitude", "Latitude")
    final, by_source = flows.build_final(x.filter("vec_id % 2 = 0"), x.filter("vec_id % 2 = 1"), _zones(spark))
    null = F.lit(None).cast("string")
    return final.select(F.lit("row").alias("what"), F.col("Source").alias("source"), F.col("URL").alias("url"), F.col("Pincode").alias("pincode"), F.col("Possible_Pincodes").alias("codes"), F.lit(None).cast("long").alias("n")).unionByName(
        by_source.select(F.lit("source").alias("what"), F.col("Source").alias("source"), null.alias("url"), null.alias("pincode"), null.alias("codes"), F.col("rows").alias("n"))
    )


@query("""WITH l AS (SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'http://x/for-sale/' WHEN 1 THEN 'http://x/for-rent/' ELSE 'http://x/resale/' END || (p_partkey % 1700)::VARCHAR AS url, p_retailprice AS price, p_size * 10.0 AS area,
 CASE WHEN p_partkey % 5 <> 0 THEN p_size % 4 END AS balconies, CASE WHEN p_partkey % 4 <> 0 THEN p_size::DOUBLE END AS bhk, CASE WHEN p_partkey % 6 <> 0 THEN p_type END AS facing FROM part),
f AS (SELECT * FROM l WHERE contains(url, 'sale') QUALIFY row_number() OVER (PARTITION BY url ORDER BY k) = 1), v AS (SELECT * FROM f WHERE price > 0 AND area > 0),
b AS (SELECT quantile_cont(price, [0.01, 0.99]) AS q FROM v), w AS (SELECT v.* FROM v, b WHERE price BETWEEN q[1] AND q[2]), c AS (SELECT quantile_cont(area, [0.01, 0.99]) AS q FROM w), y AS (SELECT w.* FROM w, c WHERE area BETWEEN q[1] AND q[2])
SELECT k, round(ln(1 + price), 6) AS log_price, coalesce(balconies, 0)::DOUBLE AS balconies, coalesce(bhk, (SELECT median(bhk) FROM y)) AS bedrooms, coalesce(facing, 'Unknown') AS facing, 0.0::DOUBLE AS floor_ratio FROM y""")
def modelling_table(spark, sf):
    """The sale-only table: caps in turn, zero, median and label fills, ratios."""
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, "http://x/for-sale/").when(k % 3 == 1, "http://x/for-rent/").otherwise("http://x/resale/")
    x = table(spark, sf, "part").select(
        k.alias("k"), F.concat(kind, (k % 1700).cast("string")).alias("URL"), F.col("p_retailprice").alias("Price_INR"), (F.col("p_size") * 10.0).alias("Area_Sqft"), F.when(k % 5 != 0, F.col("p_size") % 4).cast("double").alias("Balconies"),
        F.when(k % 4 != 0, F.col("p_size")).cast("double").alias("BHK"), F.when(k % 6 != 0, F.col("p_type")).alias("Facing"), F.lit(None).cast("double").alias("Floor_Number"), F.lit(None).cast("double").alias("Total_Floors"),
    )
    return flows.modelling_table(x, "k").select("k", r6("log_price").alias("log_price"), F.col("Balconies").alias("balconies"), F.col("BHK").alias("bedrooms"), F.col("Facing").alias("facing"), "floor_ratio")


@query("""SELECT event_type, window_start, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM events) GROUP BY 1, 2""")
def windowed_stream(spark, sf):
    """Event-time windows with a watermark over a stream of files; the last windows close as the stream ends in complete mode."""
    from groundplan.streaming.ingest import file_stream, latest_to, windowed_counts

    scratch = Scratch(spark, "windows")
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    scratch.save(events, "arrived")
    counted = windowed_counts(file_stream(spark, f"{scratch.root}/arrived", "parquet", events.schema), "ts", "event_type", "value", "1 day", "1 day")
    latest_to(counted, f"{scratch.root}/result", f"{scratch.root}/checkpoint").awaitTermination()
    x = spark.read.parquet(f"{scratch.root}/result")
    return x.select("event_type", F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n", F.round("total", 4).alias("total"))


@query("SELECT row_number() OVER (ORDER BY count(*) DESC, lang) AS place, lang AS value, count(*) AS count FROM documents GROUP BY lang")
def value_order(spark, sf):
    """Value counts with their places, so that the order is compared too."""
    x = reports.value_counts(table(spark, sf, "documents"), "lang")
    return x.withColumn("place", F.row_number().over(Window.orderBy(F.desc("count"), "value")).cast("long")).select("place", "value", "count")


@query("SELECT lang AS value, count(*) AS count FROM documents GROUP BY 1")
def sorted_counts(spark, sf):
    return reports.sorted_counts(table(spark, sf, "documents"), "lang")


@query("SELECT p_partkey, p_name, p_retailprice, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS p_type FROM part")
def checkpoint_csv(spark, sf):
    x = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("p_type"))
    return tables.checkpointed(x, f"{Scratch(spark, 'checkpoint').root}/part")


@query("SELECT p_partkey, CASE WHEN p_size >= 30 THEN 2 ELSE 1 END AS n_sure FROM part")
def sure_words(spark, sf):
    row = lambda conf: F.concat(F.lit("5\t1\t1\t1\t1\t1\t0\t0\t9\t9\t"), conf, F.lit("\tw"))
    words = json_html.ocr_words(F.concat_ws("\n", F.lit("level"), row(F.col("p_size").cast("string")), row(F.lit("90.5"))))
    return table(spark, sf, "part").select("p_partkey", F.size(json_html.sure_words(words, 30.0)).alias("n_sure"))


@query()
def shapiro_wilk(spark, sf):
    """W and p of the logarithm of prices of at most 5,000 orders."""
    found = reports.shapiro_wilk(table(spark, sf, "orders").withColumn("v", F.log1p("o_totalprice")), "v", "o_orderkey")
    return spark.createDataFrame([found or (None, None)], "w double, p double")


def offline(url: str) -> tuple[int, dict[str, str], bytes]:
    """A transport without a network: host h1 forbids /private, every seventh page is gone, every fifth fails to connect."""
    if url.endswith("/robots.txt"):
        return (200, {}, b"User-agent: *\nDisallow: /private") if "//h1/" in url else (404, {}, b"")
    number = int(url.rsplit("/", 1)[1])
    if number % 7 == 0:
        return 404, {}, b"gone"
    if number % 5 == 0:
        raise OSError("no connection")
    return 200, {"Content-Type": "text/html; charset=latin-1"}, f"page {number} \xe9".encode("latin-1")


@query("""WITH u AS (SELECT DISTINCT page_id % 3 AS h, page_id % 2 AS p, page_id AS k FROM pages)
SELECT 'http://h' || h::VARCHAR || CASE p WHEN 0 THEN '/private/' ELSE '/open/' END || k::VARCHAR AS url, CASE WHEN (h = 1 AND p = 0) OR k % 7 = 0 OR k % 5 = 0 THEN NULL ELSE 'page ' || k::VARCHAR || ' é' END AS html,
 CASE WHEN h = 1 AND p = 0 THEN NULL WHEN k % 7 = 0 THEN 404 WHEN k % 5 = 0 THEN NULL ELSE 200 END AS status, CASE WHEN h = 1 AND p = 0 THEN 0 WHEN k % 7 <> 0 AND k % 5 = 0 THEN 3 ELSE 1 END AS requests FROM u""")
def fetched_pages(spark, sf):
    """Pages by a transport without a network: robots rules, retries, charsets."""
    from groundplan.sources import fetch

    k = F.col("page_id")
    urls = table(spark, sf, "pages").select(F.concat(F.lit("http://h"), k % 3, F.when(k % 2 == 0, "/private/").otherwise("/open/"), k).alias("url"))
    return fetch.fetch(urls, offline, delay=0.0, pause=lambda s: None)


@query("""SELECT 'listed' AS how, 'a.png' AS name, sum(length(p_name) + 1)::BIGINT AS bytes FROM part UNION ALL SELECT 'listed', 'b.jpeg', sum(length(s_name) + 1)::BIGINT FROM supplier
UNION ALL SELECT 'watched', 'a.png', sum(length(p_name) + 1)::BIGINT FROM part UNION ALL SELECT 'watched', 'b.jpeg', sum(length(s_name) + 1)::BIGINT FROM supplier""")
def image_files(spark, sf):
    """Image files of a folder, listed at once and as a stream of files as they appear; others are left out."""
    from groundplan.streaming import settle

    scratch = Scratch(spark, "images")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(scratch.root).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{scratch.root}/in"))
    for name, source, column in (("a.png", "part", "p_name"), ("b.jpeg", "supplier", "s_name"), ("c.txt", "nation", "n_name")):
        table(spark, sf, source).select(column).coalesce(1).write.text(f"{scratch.root}/{name}")
        (written,) = [f.getPath() for f in fs.listStatus(path(f"{scratch.root}/{name}")) if f.getPath().getName().startswith("part-")]
        fs.rename(written, path(f"{scratch.root}/in/{name}"))
    for number in range(2):  # a file is passed on when a second look finds its length unchanged
        settle.look(spark, f"{scratch.root}/in", f"{scratch.root}/looks", number)
    settle.watch(settle.settled(spark, f"{scratch.root}/looks"), lambda batch, number: batch.write.mode("overwrite").parquet(f"{scratch.root}/seen/batch={number}"), f"{scratch.root}/checkpoint").awaitTermination()
    seen = spark.read.parquet(f"{scratch.root}/seen").filter("settled")
    of = lambda df, how: df.select(F.lit(how).alias("how"), text.segment("path", -1).alias("name"), F.col("length").cast("long").alias("bytes"))
    return of(tables.load_images(spark, f"{scratch.root}/in"), "listed").unionByName(of(seen, "watched"))


@query("""WITH l AS (SELECT 'g' || (page_id % 4)::VARCHAR AS place, page_id FROM pages) SELECT place, count(*) AS n_rows, string_agg(page_id::VARCHAR, '/' ORDER BY page_id) AS ids FROM l GROUP BY 1""")
def repeated_groups(spark, sf):
    """All matches of a pattern with several groups, as rows."""
    one = table(spark, sf, "pages").select(F.concat(F.lit("g"), F.col("page_id") % 4).alias("place"), "page_id")
    flat = one.groupBy("place").agg(F.array_join(F.transform(F.array_sort(F.collect_list("page_id")), lambda i: F.concat(F.lit("Unit "), i, F.lit(" of "), i, F.lit("; "))), "").alias("s"))
    found = text.groups_as_rows("s", r"Unit (\d+) of (\d+)", 2)
    return flat.select("place", F.size(found).cast("long").alias("n_rows"), F.array_join(F.transform(found, lambda g: g["g2"]), "/").alias("ids"))


DEPENDANTS = ("bathrooms", "floor", "floors", "years")


@query(f"""WITH l AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'http://x/for-sale/' WHEN p_partkey % 3 = 1 THEN 'http://x/a-rent-b/' ELSE 'http://x/for-lease/' END || p_partkey::VARCHAR AS url,
 CASE p_partkey % 3 WHEN 0 THEN 'Sale' WHEN 1 THEN 'Rent' ELSE 'Lease' END AS deal, p_retailprice * CASE WHEN p_partkey % 3 = 0 THEN 5000.0 ELSE 20.0 END::DOUBLE AS price, (p_size * 40 + 300)::DOUBLE AS area,
 CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey % 4 + 1)::DOUBLE END AS bhk, CASE WHEN p_partkey % 4 <> 0 THEN (p_partkey % 3 + 1)::DOUBLE END AS bathrooms, CASE WHEN p_partkey % 6 <> 0 THEN (p_partkey % 12)::DOUBLE END AS floor,
 CASE WHEN p_partkey % 7 <> 0 THEN (p_partkey % 20)::DOUBLE END AS floors, CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey % 15)::DOUBLE END AS years FROM part WHERE p_partkey % 97 <> 0),
q AS (SELECT deal, quantile_cont(price, [0.01, 0.99]) AS p, quantile_cont(area, [0.01, 0.99]) AS a FROM l GROUP BY 1),
c AS (SELECT l.* REPLACE (least(greatest(price, p[1]), p[2]) AS price, least(greatest(area, a[1]), a[2]) AS area) FROM l JOIN q USING (deal)),
e AS (SELECT list_sort(list_distinct(quantile_cont(area, [0, 0.2, 0.4, 0.6, 0.8, 1]))) AS e FROM c),
b AS (SELECT c.*, len(list_filter(e[2:len(e) - 1], lambda z: z < area)) AS bucket FROM c, e), bm AS (SELECT bucket, median(bhk) AS m FROM b GROUP BY 1), ba AS (SELECT median(bhk) AS m FROM b),
f AS (SELECT b.* REPLACE (round_even(coalesce(bhk, bm.m, ba.m), 0) AS bhk), bhk IS NULL AS bhk_was_missing FROM b LEFT JOIN bm USING (bucket), ba),
g AS (SELECT bhk, {", ".join(f"median({x}) AS m_{x}" for x in DEPENDANTS)} FROM f GROUP BY 1), w AS (SELECT {", ".join(f"median({x}) AS a_{x}" for x in DEPENDANTS)} FROM f),
d AS (SELECT f.* REPLACE ({", ".join(f"coalesce({x}, m_{x}, a_{x}) AS {x}" for x in DEPENDANTS)}), price / area AS per FROM f JOIN g USING (bhk), w),
r AS (SELECT deal, quantile_cont(per, [0.01, 0.99]) AS p FROM d GROUP BY 1)
SELECT url, deal AS deal_type, round(price, 6) AS price, round(area, 6) AS area, bhk AS bedrooms, bhk_was_missing, bathrooms, floor, floors, years, round(least(greatest(per, p[1]), p[2]), 6) AS per_sqft, round(ln(1 + price), 6) AS log_price,
 round(CASE WHEN floors = 0 THEN 0 ELSE least(greatest(floor / floors, 0), 1) END, 6) AS floor_ratio, false AS is_duplicate FROM d JOIN r USING (deal)""")
def etl_numbers(spark, sf):
    """The analysis flow's caps, medians and ratios, of the same listings as etl_flow."""
    from groundplan.queries import _zones, synthetic_listings

    listings, reg = synthetic_listings(spark, sf)
    merged = rows.valid_rows(fuzzy.attach(listings.withColumn("_row_id", F.monotonically_increasing_id()), reg, "_row_id", list(REGISTRY.values())))
    scratch = Scratch(spark, "etl")
    x = flows.clean_and_engineer(scratch.save(merged, "merged"), _zones(spark), scratch)
    return x.select(
        F.col("URL").alias("url"), "deal_type", r6("Price_INR").alias("price"), r6("Area_Sqft").alias("area"), F.col("BHK").alias("bedrooms"), F.col("BHK_was_missing").alias("bhk_was_missing"), F.col("Bathrooms").alias("bathrooms"),
        F.col("Floor_Number").alias("floor"), F.col("Total_Floors").alias("floors"), F.col("Property_Age_Years").alias("years"), r6("PricePerSqft").alias("per_sqft"), r6("log_price").alias("log_price"), r6("floor_ratio").alias("floor_ratio"),
        F.col("is_duplicate_url").alias("is_duplicate"),
    )
