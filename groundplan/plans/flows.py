"""The composed flows: the collected table, the analysis tables, the sale-only modelling table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from groundplan.functions.numeric import safe_ratio
from groundplan.functions.text import deal_type, deal_type_two_way
from groundplan.operators import fuzzy, impute, reports, rows
from groundplan.operators.features import collapse_to_top_n, one_hot
from groundplan.operators.quantiles import quantile_row
from groundplan.operators.robust import percentile_filter_in_turn, winsorize_by_group
from groundplan.operators.spatial import attach_geo, enrich_from_polygons
from groundplan.schema import COLUMNS, LISTING, REGISTRY
from groundplan.scratch import Scratch
from groundplan.sources.tables import rows_per_source

# Which columns take part in which step.
GROUP_MEDIAN_COLS = ["Bathrooms", "Balconies", "Car_Parking", "Floor_Number", "Total_Floors", "Property_Age_Years"]
MATERIAL_COLS = ["Cement_Price_Rs_per_bag_50kg", "Steel_TMT_Price_Rs_per_tonne"]
LOW_CARD_CATS = ["Furnishing", "Facing", "Ownership", "Overlooking", "Age_Group", "Construction_Status", "rera_project_status", "rera_project_type", "district_from_geo"]
LEAKAGE_COLS = ["Price_Cr", "PricePerSqft"]
NEVER_IMPUTE_COLS = ["rera_project_name", "rera_promoter_name", "rera_approved_date", "rera_proposed_completion_date", "rera_pincode"]
DROP_COLS = ["_links", "Transaction", "YearMonth", "Year", "Month", "Full_Address", "match_score", "match_method", "rera_token"]
FEATURES_FOR_CORR = [
    "Price_INR", "BHK", "Area_Sqft", "Bathrooms", "Balconies", "Car_Parking", "Floor_Number", "Total_Floors", "Property_Age_Years", "floor_ratio", "has_rera_match",
    "Latitude", "Longitude", *MATERIAL_COLS,
]


def build_final(archive: DataFrame, crawled: DataFrame | None, zones: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The collected table (union, equal rows once, missing codes from polygons) and its rows by source."""
    both = rows.union_dedup(archive, crawled, LISTING) if crawled is not None else rows.full_row_dedup(rows.reindex(archive, LISTING))
    if zones is not None:
        numbered = Scratch(both.sparkSession, "final").save(both.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        both = enrich_from_polygons(numbered, zones, "_row").drop("_row").select(COLUMNS)
    return both, rows_per_source(both)


def clean_and_engineer(merged: DataFrame, zones: DataFrame | None, scratch: Scratch, row: str = "_row_id") -> DataFrame:
    """Caps, imputations in their order, geography and features of matched listings; each step is a written table, as it takes statistics of the one before."""
    x = scratch.save(rows.duplicate_flag(merged.withColumn("deal_type", deal_type("URL")), "URL"), "flagged")
    x = scratch.save(winsorize_by_group(x, ["Price_INR", "Area_Sqft"], "deal_type"), "capped")
    x = scratch.save(impute.bucketed_median_impute(x, "BHK", "Area_Sqft", 5), "bedrooms")
    x = scratch.save(impute.group_median_impute(x, GROUP_MEDIAN_COLS, "BHK"), "dependants")
    x = scratch.save(impute.layered_impute(x), "codes")
    x = scratch.save(impute.centroid_impute(x), "centroids")
    x = scratch.save(impute.time_group_impute(x, MATERIAL_COLS, ["YearMonth", "Year"]), "materials")
    x = x.fillna("Unknown", ["Society", "Locality"]).fillna("Not Matched", ["rera_project_status", "rera_project_type", "rera_district"])
    x = winsorize_by_group(x.withColumn("PricePerSqft", F.try_divide("Price_INR", "Area_Sqft")), ["PricePerSqft"], "deal_type")
    x = scratch.save(x, "priced")
    x = scratch.save(attach_geo(x, zones, row), "placed")
    x = x.withColumns({"log_price": F.log1p("Price_INR"), "floor_ratio": safe_ratio("Floor_Number", "Total_Floors"), "has_rera_match": F.col("rera_project_name").isNotNull().cast("int")})
    x = collapse_to_top_n(x.fillna("Unknown", LOW_CARD_CATS), LOW_CARD_CATS)
    return x.drop(*DROP_COLS)


def feature_matrix(cleaned: DataFrame) -> DataFrame:
    """One-hot, without columns that give the price away."""
    cats = [c for c in [*LOW_CARD_CATS, "deal_type", "Pincode_impute_source"] if c in cleaned.columns]
    return one_hot(cleaned.drop(*LEAKAGE_COLS, "URL", "Possible_Pincodes"), cats)


METHODOLOGY = [
    ("Validity", "Rows without a positive price and area are dropped; the share that is lost is checked against a budget."),
    ("Registry match", "Names are compared by sorted words within the same code from 85, and among all names from 90."),
    ("Caps", "Price, area and price by area are clipped to the 1st and 99th percentile of their deal type."),
    ("Bedrooms", "Missing values take the median of their bucket of area, rounded half to even."),
    ("Dependants", "Bathrooms, balconies, parking, floors and age take the median of the rows with as many bedrooms."),
    ("Codes", "Missing codes come from the society's most frequent one, a vote of 15 neighbours, or the locality's; each row says which."),
    ("Coordinates", "Missing coordinates take the median of locality or code; a flag marks them."),
    ("Materials", "Missing prices of materials take the median of the month, else of the year."),
    ("Never filled", "Fields of the registry stay empty where no project matches."),
    ("Features", "Logarithm of the price, floor by floors, categories beyond the ten most frequent as Other, one-hot without columns that give the price away."),
]


@dataclass
class Analysis:
    cleaned: DataFrame
    features: DataFrame
    match_report: DataFrame
    loss_pct: float
    sheets: dict[str, DataFrame]
    overview: DataFrame


def run_etl(listings: DataFrame, registry: DataFrame, zones: DataFrame | None = None, max_loss_pct: float = 5.0) -> Analysis:
    """Validity filter, registry match, cleaning, features and report tables; ValueError if too many rows are lost."""
    scratch = Scratch(listings.sparkSession, "etl")
    before, after = rows.Counted(), rows.Counted()
    numbered = scratch.save(before.watch(listings.withColumn("_row_id", F.monotonically_increasing_id())), "listings")
    valid = rows.valid_rows(numbered)
    merged = scratch.save(fuzzy.attach(valid, registry, "_row_id", list(REGISTRY.values())), "merged")
    cleaned = scratch.save(after.watch(clean_and_engineer(merged, zones, scratch)), "cleaned")
    loss = rows.checked_loss(before.n, after.n, max_loss_pct)
    features = feature_matrix(cleaned)
    spark = listings.sparkSession
    sheets = {  # fixed values: the names of the sheets
        "Methodology": spark.createDataFrame(METHODOLOGY, "Step string, Description string"),
        "Cleaned_Listings": cleaned,
        "Rental_Listings": cleaned.filter(F.col("deal_type").isin("Rent", "Lease")),
        "Imputation_Summary": reports.imputation_summary(cleaned),
        "Missingness_Raw_Listings": reports.missingness(listings),
        "Missingness_Cleaned_Listings": reports.missingness(cleaned),
        "Numeric_Summary": reports.numeric_summary(cleaned, [*FEATURES_FOR_CORR, "log_price"]),
        "Correlation_With_Price": reports.correlation_with_target(cleaned, "Price_INR", FEATURES_FOR_CORR),
        "Top_Localities": reports.top_categories(cleaned, "Locality"),
        "Top_Promoters": reports.top_categories(cleaned, "rera_promoter_name"),
        "RERA_District_Coverage": reports.top_categories(cleaned, "rera_district"),
    }
    overview = reports.overview(cleaned).crossJoin(
        cleaned.agg(
            F.round(F.avg("BHK"), 2).alias("mean_bedrooms"),
            F.round(F.avg("has_rera_match"), 4).alias("match_rate"),
            F.round(1 - F.avg(F.col("Pincode_was_missing").cast("int")), 4).alias("observed_code_share"),
        )
    )
    overview = overview.select(F.lit(before.n).cast("long").alias("n_raw_rows"), F.lit(round(loss / 100, 4)).alias("loss_share"), "*")
    return Analysis(cleaned, features, fuzzy.report(merged), loss, sheets, overview)


def sale_only(listings: DataFrame, order: str = "_row_id") -> DataFrame:
    """Sale rows, the first of each URL."""
    return rows.first_per_key(listings.filter(deal_type("URL") == "Sale"), "URL", order)


def modelling_table(listings: DataFrame, order: str = "_row_id") -> DataFrame:
    """The notebooks' table: sale rows by the two-way deal type, caps in turn, zero, median and label fills, ratios."""
    x = rows.first_per_key(listings.filter(deal_type_two_way("URL") == "Sale"), "URL", order)
    x = percentile_filter_in_turn(rows.valid_rows(x), ["Price_INR", "Area_Sqft"])
    counts = [c for c in ("Balconies", "Car_Parking", "Floor_Number") if c in x.columns]
    x = x.fillna(0, counts)
    medians = [c for c in ("BHK", "Bathrooms", "Total_Floors", "Property_Age_Years") if c in x.columns]
    if medians:
        found = quantile_row(x, {c: F.col(c).try_cast("double") for c in medians}, [0.5])
        table = found.select(*[F.get(F.col(c), F.lit(0)).alias(f"_{c}") for c in medians])
        x = x.crossJoin(F.broadcast(table)).withColumns({c: F.coalesce(F.col(c).try_cast("double"), f"_{c}") for c in medians}).drop(*[f"_{c}" for c in medians])
    x = x.fillna("Unknown", [f.name for f in x.schema.fields if f.dataType.typeName() == "string" and f.name != "URL"])
    return x.withColumns({"log_price": F.log1p("Price_INR"), "floor_ratio": safe_ratio("Floor_Number", "Total_Floors")})
