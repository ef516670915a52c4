"""Page parsers: (url, html) to listings, one projection for each site; and the discovery of their pages.

A parser is a list of columns and a test for pages that hold a listing. Pages that don't are dropped by `parse`, or kept as
failed by `parse_all`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from groundplan.functions import json_html as j, numeric as n, text as t
from groundplan.sources.tables import listing_columns

# The patterns in this module are the wording of the sites' pages.
PRICE = r"[\d.,]+\s*(?:Cr|Crores?|Lacs?|Lakhs?|L|K)?"
LAT = r'"?lat(?:itude)?"?\s*[:=]\s*"?([\d.]+)'
LON = r'"?lon(?:g|gitude)?"?\s*[:=]\s*"?([\d.]+)'


Put = Callable[[str, Column], Column]


@dataclass(frozen=True)
class Site:
    name: str
    columns: Callable[[Put, Column, Column], tuple[dict[str, Column], Column]]
    sitemap: str  # which sitemaps list its pages
    page: Callable[[Column], Column]  # which of their URLs are pages


def _priced(price: Column, area: Column, **more: Column) -> dict[str, Column]:
    return n.derived_prices(price, area) | more


def _either(price: Column, area: Column) -> Column:
    return (F.coalesce(price, F.lit(0.0)) != 0) | (F.coalesce(area, F.lit(0.0)) != 0)


def _address(*parts: Column) -> Column:
    return F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts])


def _or(a: Column, b: Column) -> Column:
    """a, or b where a is blank."""
    return F.coalesce(F.nullif(a, F.lit("")), b)


def _behind(x: Column, head: str, name: Column, tail: str) -> Column:
    """The trimmed first group of a pattern that holds a column's text as it stands, '' without a match."""
    pattern = F.concat(F.lit(head + r"\Q"), F.replace(F.coalesce(name, F.lit("")), F.lit(r"\E"), F.lit("")), F.lit(r"\E" + tail))
    return F.coalesce(F.trim(F.call_function("regexp_extract", x, pattern, F.lit(1))), F.lit(""))


def _owner(put: Put, url: Column, html: Column) -> tuple[dict[str, Column], Column]:
    """Owner listings: facts in running text, locality and coordinates in embedded data."""
    x = put("x", t.html_to_text(html))
    kind = F.when(url.contains("/property/rent/"), "Rent").otherwise("Sale")
    slug = put("slug", F.coalesce(t.segment(url, -3), F.lit("")))
    price = put("price", t.money(t.first_group(x, rf"₹\s*({PRICE})")))
    price = put("price", F.coalesce(F.nullif(price, F.lit(0.0)), t.money(t.first_group(x, r"for Rs\.\s*([\d,]+)"))))
    sized = r"(?i)(?:Super Builtup|Super Built Up|Builtup|Built Up|Carpet|Plot)\s+Area\s+([\d,.]+)\s*(sq\.?\s?ft|sq\.?\s?yard|sq\.?\s?m)"
    unit = put("unit", F.lower(t.first_group(x, sized, 2)))
    factor = F.when(unit.contains("yard"), n.SQFT_PER["sq.yards"]).when(unit.endswith("m"), n.SQFT_PER["sq.meter"]).otherwise(1.0)
    area = put("area", F.coalesce(t.number(t.first_group(x, sized)) * factor, t.number(t.first_group(x, r"(?i)([\d,.]+)\s*Sq\.?\s?Ft"))))
    age = put("age", t.first_group(x, r"Age of Building\s+(.+?)\s+(?:Ownership Type|Maintenance)"))
    years = put("years", F.when(age.rlike("(?i)new|under"), 0.0).otherwise(t.number(age)))
    raw_place = put("raw_place", t.first_group(html, r'"locality"\s*:\s*"([^"]+)"'))
    parts = F.transform(F.split(raw_place, ","), lambda p: F.trim(p))
    state = F.array_position(F.transform(parts, lambda p: p.rlike("^(Telangana|Andhra)")), F.lit(True))
    from_slug = t.unslug(t.first_group(F.concat(slug, F.lit("-hyderabad")), r"-for-(?:sale|rent)-in-(.+?)-hyderabad"))
    place = put("place", F.when(state > 1, F.get(parts, (state - 2).cast("int"))).otherwise(_or(raw_place, from_slug)))
    society = put("society", t.first_group(x, r"(?:Flat|House|Villa|Apartment|Plot|Land|Penthouse)s? for (?:Sale|Rent) in (.+?), Hyderabad"))
    floors = r"No\. of Floors\s+(\d+|NA)\s*/\s*(\d+)"
    floor = t.first_group(x, floors)
    kind_of = put("kind_of", _or(t.first_group(slug, r"-bhk-(.+?)-for-"), t.first_group(slug, r"^(.+?)-for-")))
    return _priced(
        price,
        area,
        BHK=_or(t.first_group(slug, r"^(\d+(?:\.\d)?)-bhk"), t.first_group(x, r"(\d+)\s*Bedroom")),
        Bathrooms=t.number(t.first_group(x, r"(\d+)\s*Bathroom\s+No\. of Bathroom")),
        Floor_Number=F.when(floor != "NA", floor),
        Total_Floors=t.first_group(x, floors, 2),
        Property_Age_Years=years,
        Age_Group=F.when(age.startswith(">"), "10+ Years").otherwise(n.age_group(years)),
        Locality=place,
        Pincode=t.first_group(raw_place, r"\b(5\d{5})\b"),
        Society=society,
        Furnishing=t.first_group(x, r"Furnishing Status\s+(\w+(?: \w+)?)\s+Facing"),
        Facing=t.first_group(x, r"Facing\s+([A-Za-z -]+?)\s+No\. of Floors"),
        Ownership=t.first_group(x, r"Ownership Type\s+(.+?)\s+Maintenance"),
        Car_Parking=t.first_group(x, r"Parking\s+(\w+)\s+Gated"),
        Construction_Status=_or(t.title_case(t.first_group(x, "(READY|UNDER CONSTRUCTION)")), t.first_group(x, r"No\. of Bathroom\s+(.+?)\s+Possession")),
        Transaction=F.when(F.substring(x, 1, 600).contains("Resale"), "Resale").otherwise(kind),
        Latitude=t.first_group(html, r'"(?:latitude|lat)"\s*:\s*"?([\d.]+)'),
        Longitude=t.first_group(html, r'"(?:longitude|lon|lng)"\s*:\s*"?([\d.]+)'),
        Listing_Type=kind,
        Property_Type=t.unslug(kind_of),
        Full_Address=_address(society, place, F.lit("Hyderabad"), F.lit("India")),
        Posted_On=t.first_group(x, r"([A-Z][a-z]{2} \d{1,2}, \d{4})\s+Posted On"),
    ), _either(price, area)


def _project_ld(put: Put, url: Column, html: Column) -> tuple[dict[str, Column], Column]:
    """Project pages whose facts are in JSON-LD; a project without a price still counts."""
    node = put("node", j.first_of_type(j.ld_json(html), "Residence", "Product"))
    x = put("x", t.html_to_text(html))
    get = lambda path: F.coalesce(j.field(node, path), F.lit(""))
    low, high = t.number(j.first_offer(node, "lowPrice")), t.number(j.first_offer(node, "highPrice"))
    name, place = get("$.name"), get("$.address.addressLocality")
    said = put("said", _behind(x, "", name, r"\s+Status\s*([A-Za-z ]+?)(?:\s[A-Z][a-z]+ [a-z]+ |\s+is\s|\.|$)"))
    status = F.coalesce(*[F.when(F.lower(said).contains(s.lower()), F.lit(s)) for s in ("Ready To Move", "Under Construction", "New Launch")], said)
    return _priced(
        low,
        F.lit(None).cast("double"),
        Locality=place,
        Society=name,
        Pincode=get("$.address.postalCode"),
        Latitude=get("$.geo.latitude"),
        Longitude=get("$.geo.longitude"),
        Construction_Status=status,
        Transaction=F.lit("New Property"),
        Listing_Type=F.lit("Sale"),
        Property_Type=F.lit("Project"),
        Price_Max_INR=F.rint(F.nullif(high, F.lit(0.0))),
        Total_Units=t.number(t.first_group(x, r"Total Units\s+(\d+)")),
        Rating=get("$.aggregateRating.ratingValue"),
        Review_Count=get("$.aggregateRating.reviewCount"),
        Full_Address=_or(get("$.address.streetAddress"), _address(name, place, F.lit("Hyderabad"))),
    ) | {"PricePerSqft": t.number(t.first_group(x, r"around Rs\.\s*([\d,]+)/sq\. ft"))}, node.isNotNull() & ((F.coalesce(low, F.lit(0.0)) != 0) | (name != ""))


def _resale(put: Put, url: Column, html: Column) -> tuple[dict[str, Column], Column]:
    """Resale and rent listings, and project pages with a table of units, told apart by the URL's end."""
    x = put("x", t.html_to_text(html))
    is_project = url.endswith("/project")
    slug = put("slug", F.coalesce(t.segment(url, -2), F.lit("")))
    kind = F.when(slug.startswith("rent-"), "Rent").otherwise("Sale")
    sized = r"(?i)Area\s+(?:(?:Carpet|Built-up|Super Built-up|Plot) Area\s+)?([\d,.]+)\s*(Sq\.?\s?Ft|Sq\.?\s?Yards?|Sq\.?\s?Yd|Sq\.?\s?M)"
    unit = put("unit", F.lower(t.first_group(x, sized, 2)))
    price = put("price", t.money(t.first_group(x, rf"Listing ID: #\d+\s*₹\s*({PRICE})")))
    area = put("area", t.number(t.first_group(x, sized)) * F.when(unit.contains("y"), n.SQFT_PER["sq.yards"]).when(unit.endswith("m"), n.SQFT_PER["sq.meter"]).otherwise(1.0))
    info = put("info", F.substr(x, F.greatest(F.locate("Property Information", x), F.lit(1))))
    both = put("both", t.first_group(info, r"Locality\s+(.+?)\s+Price"))
    place = put("place", F.substring_index(both, " Project ", 1))
    project = F.when(both.contains(" Project "), F.regexp_replace(both, r"^.*? Project ", "")).otherwise("")
    slug_place = put("slug_place", t.first_group(slug, r"-in-(.+)$"))
    letters = lambda c: F.regexp_replace(F.lower(c), "[^a-z]", "")
    society = put("society", F.when(project != "", project).when(letters(place) == letters(slug_place), "").otherwise(t.unslug(slug_place)))
    city = _or(t.first_group(info, r"City\s+(\w+(?: \w+)?)\s+Micro market"), F.lit("Hyderabad"))
    age = put("age", t.first_group(x, r"Age of (?:Property|Building)\s+(.+?)\s+(?:Facing|Floor|Ownership|View)"))
    years = put("years", F.when(age != "", t.number(age)))
    units = put("units", t.groups_as_rows(x, r"(?i)(\d(?:\.\d)?)\s*BHK\s+\w+\s+([\d,]+)\s*Sq\.?\s?Ft\.?\s+(Price on Request|₹\s*[\d.,]+\s*(?:Cr|L|Lac|K)?)", 3))
    prices = F.transform(F.filter(units, lambda u: u["g3"].startswith("₹")), lambda u: t.money(u["g3"]))
    areas = F.transform(units, lambda u: t.number(u["g2"]))
    name, where = t.unslug(F.coalesce(t.segment(url, -3), F.lit(""))), t.first_group(x, r"compared with (.+?)\.")
    avg = put("avg", F.lower(t.first_group(x, r"(?i)avg\. price is ₹\s*([\d.,]+\s*k?)")))
    per = F.nullif(t.number(avg) * F.when(avg.endswith("k"), 1000.0).otherwise(1.0), F.lit(0.0))
    pick = lambda a, b: F.when(is_project, a).otherwise(b)
    none = F.lit(None).cast("string")
    price_, area_ = pick(F.array_min(prices), price), pick(F.array_min(areas), area)
    made = _priced(
        price_,
        area_,
        BHK=pick(F.array_join(F.array_distinct(F.transform(units, lambda u: u["g1"])), "/"), _or(F.replace(t.first_group(slug, r"^(?:resale|rent)-([\d-]+)-bhk"), F.lit("-"), F.lit(".")), t.first_group(x, r"(\d+)\s*Bedrooms?"))),
        Bathrooms=pick(F.lit(None).cast("double"), t.number(t.first_group(x, r"Number of Bathroom\s+(\d+)"))),
        Floor_Number=pick(none, t.first_group(x, r"Floor Number\s+(\w+)")),
        Total_Floors=pick(none, t.first_group(x, r"Total Floors?\s+(\d+)")),
        Property_Age_Years=pick(F.lit(None).cast("double"), years),
        Age_Group=pick(none, n.age_group(years)),
        Locality=pick(where, place),
        Society=pick(name, society),
        Facing=pick(none, t.first_group(x, r"Facing\s+([A-Za-z -]+?)\s+(?:View|Power|Flooring)")),
        Furnishing=pick(none, t.first_group(x, r"Furnishing\s+([A-Za-z -]+?)\s+(?:Facing|Floor|View|Power)")),
        Construction_Status=pick(none, t.first_group(x, r"Possession Status\s+(.+?)\s+(?:View Number|Request)")),
        Transaction=pick(F.lit("New Property"), F.when(kind == "Sale", "Resale").otherwise("Rent")),
        Listing_Type=pick(F.lit("Sale"), kind),
        Property_Type=pick(F.lit("Project"), t.unslug(t.first_group(slug, "sq-(?:ft|yd)-(.+?)-in-"))),
        Price_Max_INR=pick(F.rint(F.array_max(prices)), F.lit(None).cast("double")),
        Area_Max_Sqft=pick(F.array_max(areas), F.lit(None).cast("double")),
        Latitude=t.first_group(html, LAT),
        Longitude=t.first_group(html, LON),
        Full_Address=pick(_address(name, where, F.lit("Hyderabad"), F.lit("India")), _address(society, place, city, F.lit("India"))),
    )
    made["PricePerSqft"] = pick(per, made["PricePerSqft"])
    return made, pick(F.size(units) > 0, _either(price, area))


# The labels that a listing's flat text is cut at.
LABELS = [
    "Listing Type", "Building Type", "Property Type", "City", "Locality", "Price", "Number of Rooms", "Balcony", "Number of Bathroom", "Built Up Area", "Carpet Area",
    "Super Area", "Plot/Land Area", "Plot Area", "Ownership", "Sale Type", "Age of Property", "Project & Society", "Floor Number", "Total Floor Count", "Power Back-up",
    "Booking Amount", "Maintenance Charge", "Furnishing", "Facing", "Status", "Amenities", "Location & Connectivity",
]


def _labelled(put: Put, url: Column, html: Column) -> tuple[dict[str, Column], Column]:
    """Listings whose facts are label and value in flat text behind a heading."""
    x = put("x", t.html_to_text(html))
    at = put("at", F.locate("Property Information", x))
    kv = put("kv", t.key_values(F.substr(x, F.greatest(at, F.lit(1))), LABELS))
    get = lambda k: F.coalesce(F.try_element_at(kv, F.lit(k)), F.lit(""))
    kind = F.split(get("Listing Type"), " ")[0]
    price = put("price", t.money(get("Price")))
    size = put("size", F.coalesce(*[F.nullif(get(k), F.lit("")) for k in ("Built Up Area", "Super Area", "Carpet Area", "Plot/Land Area", "Plot Area")], F.lit("")))
    unit = put("unit", F.lower(_or(t.first_group(size, r"(?i)[\d.,]+\s*(Sq\.?\s?(?:ft|Yards|Meter)\.?|Acre|Cent|Guntha|Ares|Hectares)"), F.lit("Sq.ft."))))
    area = put("area", t.number(size) * n.sqft_per(F.replace(F.regexp_replace(unit, r"\s+", " "), F.lit("sq. ft"), F.lit("sq.ft"))))
    said = put("said", F.concat(t.first_group(html, r'"name":\s*"([^"]*)"'), F.lit(" "), F.replace(url, F.lit("-"), F.lit(" "))))
    age, place, society = get("Age of Property"), get("Locality"), get("Project & Society")
    years = put("years", F.when(F.lower(age).contains("new"), 0.0).otherwise(t.number(age)))
    spot = r'"latitude":\s*"?([\d.]+)"?,\s*"longitude":\s*"?([\d.]+)'
    return _priced(
        price,
        area,
        BHK=_or(t.first_group(said, r"(?i)(\d(?:\.\d)?)\s*BHK"), t.first_group(url, r"(?i)(\d(?:\.\d)?)\s*bkh")),
        Bathrooms=t.number(get("Number of Bathroom")),
        Balconies=t.number(get("Balcony")),
        Floor_Number=get("Floor Number"),
        Total_Floors=t.number(get("Total Floor Count")),
        Property_Age_Years=years,
        Age_Group=n.age_group(years),
        Locality=place,
        Society=society,
        Furnishing=get("Furnishing"),
        Facing=get("Facing"),
        Ownership=get("Ownership"),
        Transaction=_or(get("Sale Type"), get("Listing Type")),
        Construction_Status=get("Status"),
        Latitude=t.first_group(html, spot),
        Longitude=t.first_group(html, spot, 2),
        Full_Address=_address(society, place, F.lit("Hyderabad"), F.lit("India")),
        Listing_Type=kind,
        Property_Type=get("Property Type"),
    ), (at > 0) & kind.isin("Sale", "Rent", "Lease") & _either(price, area)


def _ranges(put: Put, url: Column, html: Column) -> tuple[dict[str, Column], Column]:
    """Project pages with ranges of price and area around a map link, and one JSON-LD node."""
    node = put("node", F.get(F.filter(j.ld_json(html), lambda v: F.coalesce(F.try_variant_get(v, "$['@type']", "string").isin("ApartmentComplex", "Residence", "Apartment"), F.lit(False))), F.lit(0)))
    get = lambda path: F.coalesce(j.field(node, path), F.lit(""))
    x = put("x", t.html_to_text(html))
    k = put("k", F.locate("(show on map)", x))
    head = put("head", F.when(k > 0, F.substr(x, k, F.lit(900))).otherwise(x))
    before = put("before", F.when(k > 0, F.substr(x, F.greatest(k - 200, F.lit(1)), F.least(k - 1, F.lit(200)))).otherwise(""))
    money = r"₹\s*([\d.,]+\s*(?:Cr|Lac|L))\s*(?:-\s*₹\s*([\d.,]+\s*(?:Cr|Lac|L)))?"
    sizes = r"sq ft\s+([\d,]+)\s*(?:-\s*([\d,]+))?\s*sq ft"
    p0, p1 = t.money(t.first_group(head, money)), t.money(t.first_group(head, money, 2))
    a0, a1 = t.number(t.first_group(head, sizes)), t.number(t.first_group(head, sizes, 2))
    configuration = put("configuration", t.first_group(head, r"Configuration\s+([\d.,\s/]+(?:BHK|RK)?[^A-Za-z]*(?:BHK|RK)?)"))
    full = put("full", get("$.address.addressLocality"))
    place = put("place", F.replace(full, F.lit(", Hyderabad"), F.lit("")))
    maker = _behind(before, r"\bby\s+(.+?)\s+", F.split(full, ",")[0], ",")
    made = _priced(
        p0,
        a0,
        BHK=F.array_join(F.regexp_extract_all(configuration, F.lit(r"\d(?:\.\d)?"), F.lit(0)), "/"),
        Locality=place,
        Society=get("$.name"),
        Transaction=F.lit("New Property"),
        Construction_Status=_or(t.first_group(head, r"Possession Status\s+([A-Za-z ]+?)\s+(?:Avg|Price)"), t.first_group(x, r"Possession\s*:?\s*([A-Za-z]{3}'\d{2})")),
        Latitude=get("$.geo.latitude"),
        Longitude=get("$.geo.longitude"),
        Full_Address=_address(get("$.name"), place, F.lit("Hyderabad"), F.lit("India")),
        Listing_Type=F.lit("Sale"),
        Property_Type=get("$['@type']"),
        Price_Max_INR=F.rint(p1),
        Area_Max_Sqft=a1,
        Builder=maker,
        RERA_ID=t.first_group(x, r"RERA ID\s+([A-Z0-9/\-]+)"),
    )
    made["PricePerSqft"] = F.coalesce(t.number(t.first_group(head, r"Avg\. Price\s*₹\s*([\d,]+)")), made["PricePerSqft"])
    return made, node.isNotNull() & _either(p0, a0)


_HOMES, _OTHERS = "flat|apartment|villa|house|floor|penthouse|studio|plot|land", "agricultur|farm|commercial|office|shop|warehouse|godown"
SITES = {
    s.name: s
    for s in (
        Site("nobroker.in", _owner, r"(?:sale|plot|rent)_hyderabad|new-flats-for-sale-hyderabad", lambda u: u.rlike("/property/(?:buy|rent)/[^#?]+/detail$")),
        Site("magicbricks.com", _project_ld, r"/pdp_Hyderabad\d*\.xml", lambda u: u.contains("-pdpid-")),
        Site("squareyards.com", _resale, r"sitemap-project\d+\.xml", lambda u: u.contains("/hyderabad-residential-property/") & u.endswith("/project")),
        Site("realestateindia.com", _labelled, "property-detail-(?:buy|rent)", lambda u: F.element_at(F.split(u, "/"), -1).contains("hyderabad") & u.rlike(_HOMES) & ~u.rlike(_OTHERS)),
        Site("proptiger.com", _ranges, r"secure-sitemap-project(?:-\d+)?\.xml", lambda u: u.contains("/hyderabad/")),
    )
}


def parse_all(pages: DataFrame, site: str, url: str = "url", html: str = "html", today: Column | None = None) -> DataFrame:
    """The listing schema's columns and `parsed`: whether the page holds a listing."""
    stage = [pages.select(F.col(url).alias("_url"), F.col(html).alias("_html"))]

    def put(name: str, value: Column) -> Column:
        """A column that others use more than once is a projection of its own, so that it is computed once."""
        stage[0] = stage[0].withColumn(f"_{name}", value)
        return F.col(f"_{name}")

    made, ok = SITES[site].columns(put, F.col("_url"), F.col("_html"))
    return stage[0].select(*listing_columns(made, F.col("_url"), site, today), F.coalesce(ok, F.lit(False)).alias("parsed"))


def parse(pages: DataFrame, site: str, **how) -> DataFrame:
    return parse_all(pages, site, **how).filter("parsed").drop("parsed")


def discover(sitemaps: DataFrame, site: str, patterns: list[str] | None = None, sitemap: str = "sitemap", xml: str = "xml") -> DataFrame:
    """Page URLs of a site from its sitemaps (sitemap, xml), each once; with patterns, in the order of the first that fits."""
    s = SITES[site]
    listed = sitemaps.filter(F.col(sitemap).rlike(s.sitemap)).select(F.col(sitemap).alias("sitemap"), F.explode(j.sitemap_locs(xml)).alias("url"))
    found = listed.filter(s.page(F.col("url")))
    rank = F.lit(0)
    for i, p in reversed(list(enumerate(patterns or []))):
        rank = F.when(F.col("sitemap").rlike(p), i).otherwise(rank)
    return found.groupBy("url").agg(F.min(rank).alias("priority"))


def expand_index(pages: DataFrame, done: DataFrame, pattern: str, base: str = "", url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Detail links of index pages that aren't done, and the pages to mark done: those that could be fetched."""
    fresh = pages.join(done.select(url), url, "left_anti")
    found = fresh.filter(F.col(html).isNotNull())
    return found.select(F.col(url).alias("page"), F.explode(j.links(html, pattern, base)).alias("link")), found.select(url)
