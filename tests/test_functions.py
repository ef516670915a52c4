import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from groundplan.functions import json_html as j, numeric as n, text as t
from groundplan.operators import fuzzy
from groundplan.queries import QUERIES


def one(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_money_and_numbers(spark):
    assert one(spark, ["45 Lacs", "₹ 1.2 Cr", "₹ 5,000", "Price on Request", None, ", x", "3K", "2.00 L", "1 Crores"], t.money) == [4.5e6, 1.2e7, 5000.0, None, None, None, 3000.0, 2e5, 1e7]
    assert one(spark, ["12 years", "a 1,234.5 b", ",", ""], t.number) == [12.0, 1234.5, None, None]


def test_names_of_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    got = {r.doc_id: r.name for r in QUERIES["normalize_name"](spark, sf).collect()}
    assert {r.lang for r in docs} > {"en"} and len(got) == len(docs)
    assert got == {r.doc_id: " ".join(re.sub("[^A-Z0-9 ]", " ", (r.text or "").upper()).split()) for r in docs}


def test_age_group(spark):
    assert one(spark, [0.0, 1.0, 5.0, 6.0, 12.0, None], n.age_group, "double") == ["New", "New", "1-5 Years", "6-10 Years", "10+ Years", ""]


def test_category_spellings(spark):
    got = one(spark, ["Ready to move", "Ready to Move Property", "ready-to-move", "semi/fully", "property", " ", None, "1-5 Years"], t.normalize_category)
    assert got == ["Ready To Move", "Ready To Move", "Ready To Move", "Semi/Fully", None, None, None, "1 5 Years"]


def test_place_and_name_keys(spark):
    assert one(spark, ["Alwal Hyderabad", "X, Hyderabad, Telangana", "X, Hyderabad, Telangana, India", "Hyderabad", None], t.place_key) == ["alwal", "x", "x hyderabad", "hyderabad", None]
    assert one(spark, ["a-b  c!", None, "é"], t.name_key) == ["A B C", "", ""]
    assert one(spark, ["500081.0", "500081", "junk", "NaN", "Infinity", None], t.pincode_key) == ["500081", "500081", None, None, None, None]


def test_html_and_urls(spark):
    assert one(spark, ["a&nbsp;b", "&lt;b&gt;x&lt;/b&gt;", "<script>x</script>y<p>z</p>", "a b"], t.html_to_text) == ["a b", " x ", " y z ", "a b"]
    assert one(spark, ["https://www.Site.in/x", "http://a.b:80/c", None, "junk"], t.url_domain) == ["site.in", "a.b", "unknown (no URL)", "unknown (no URL)"]
    assert one(spark, ["https://+A2:AB145www.nobroker.in/x"], t.repair_url) == ["https://www.nobroker.in/x"]
    assert one(spark, ["a%20b+c"], t.url_decode) == ["a b+c"]


def test_html_query_on_cut_references(spark, tmp_path):
    import duckdb

    from groundplan import queries

    pages = ["<p>a &amp", "x &ampy; &am &copy z", "&amp;lt;b&gt; &nbsp;&#65;", "&copy; &middot; &lt;i&gt;x&lt;/i&gt; &quot;q&quot;", None, ""]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = {tuple(r) for r in queries.QUERIES["html_to_text"](spark, str(tmp_path)).collect()}
    assert got == set(db.execute(queries.ORACLE_SQL["html_to_text"]).fetchall())
    assert one(spark, ["a &amp", "&copy z"], t.html_to_text) == ["a &", "© z"]  # the function itself resolves as browsers do


def test_key_values(spark):
    got = one(spark, ["x Price 5 Lac City Pune Pricey", "nothing"], lambda c: t.key_values(c, ["City", "Price", "Facing"]))
    assert got == [{"Price": "5 Lac", "City": "Pune Pricey"}, {}]


def test_deal_type_precedence(spark):
    urls = ["a-for-lease-for-rent", "x-for-rent", "a-rent-b", "for-sale", "resale", "-sale-", None, "z"]
    assert one(spark, urls, t.deal_type) == ["Lease", "Rent", "Rent", "Sale", "Sale", "Sale", "Unknown", "Unknown"]
    assert one(spark, urls, t.deal_type_two_way)[0] == "Rent"


def test_clip_keeps_nulls(spark):
    assert one(spark, [None, -1.0, 0.5, 9.0], lambda c: n.clip(c, 0.0, 1.0), "double") == [None, 0.0, 0.5, 1.0]


def test_next_run():
    now = dt.datetime(2026, 1, 1, 10, 0)
    assert n.next_run(now, "02:30") == dt.datetime(2026, 1, 2, 2, 30)
    assert n.next_run(now, "23:00") == dt.datetime(2026, 1, 1, 23, 0)
    assert n.next_run(now, "10:00") == dt.datetime(2026, 1, 2, 10, 0)
    assert n.next_run(now, every_hours=6) == dt.datetime(2026, 1, 1, 16, 0)


def test_json_ld(spark):
    page = '<script type="application/ld+json">{"@graph":[{"@type":["Product","X"],"offers":[{"lowPrice":5}]}]}</script><script type="application/ld+json">bad</script>'
    node = lambda c: j.first_of_type(j.ld_json(c), "Product")
    assert one(spark, [page, "none"], lambda c: j.first_offer(node(c), "lowPrice")) == ["5", None]


def test_row_map(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3"]), (["a"], ["1", "2"]), (["a"], [])], "c array<string>, v array<string>")
    assert [r[0] for r in df.select(j.row_map(F.col("c"), F.col("v"))).collect()] == [{"a": "1", "b": "2"}, {"col0": "1", "col1": "2"}, {}]


def test_lcs_expression_is_the_bit_parallel_one(spark):
    pairs = [("abcde", "ace"), ("aaaa", "aa"), ("", "x"), ("kitten", "sitting"), ("a b", "b a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(t.lcs_length("a", "b")).collect()]
    assert got == [fuzzy.lcs(a, b) for a, b in pairs] == [3, 2, 0, 4, 1]


@pytest.mark.parametrize("text, want", [("a  \n\n\n\nb\n\n", "a\n\nb"), ("", "")])
def test_tidy(spark, text, want):
    assert one(spark, [text], t.tidy) == [want]


def test_unescape_as_the_standard_library(spark):
    import html
    import random

    r = random.Random(3)
    parts = ["&", "&amp;", "&ampx", "&lt", "&eacute;", "&eacute", "&notit;", "&#39;", "&#39", "&#x27;", "&#x1F600;", "&#128;", "&#0;", "&#xD800;", "&#99999999999;", "&#1;", "&unknown;", "&nbsp;", "&CounterClockwiseContourIntegral;", "#", ";", "a", " ", "&#", "&#x", "&;"]
    texts = ["", "plain", *parts, *["".join(r.choices(parts, k=6)) for _ in range(400)]]
    got = [x.o for x in spark.createDataFrame([(x,) for x in texts], "s string").select(t.unescape("s").alias("o")).collect()]
    assert got == [html.unescape(x) for x in texts]


def test_ordered_sections(spark):
    df = spark.createDataFrame([({"x": {"1": "2"}, "B": {"k": "v"}, "A": {}},), (None,)], "m map<string, map<string, string>>")
    got = [r.o for r in df.select(F.map_keys(j.ordered_sections(F.col("m"), ["A", "B", "C"])).alias("o")).collect()]
    assert got == [["A", "B", "x"], None]
