"""The listing schema shared by every source and stage."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a listing, in order, and how the analysis types them.
COLUMNS = [
    "Source", "URL", "YearMonth", "Year", "Month", "Listing_Type", "Property_Type", "Transaction",
    "Price_INR", "Price_Max_INR", "Price_Cr", "PricePerSqft", "Area_Sqft", "Area_Max_Sqft",
    "BHK", "Bathrooms", "Balconies", "Car_Parking", "Floor_Number", "Total_Floors",
    "Property_Age_Years", "Age_Group", "Construction_Status", "Furnishing", "Facing", "Ownership",
    "Overlooking", "Builder", "RERA_ID", "Society", "Locality", "Pincode", "Possible_Pincodes",
    "Latitude", "Longitude", "Full_Address", "Total_Units", "Rating", "Review_Count", "Posted_On",
    "Cement_Price_Rs_per_bag_50kg", "Steel_TMT_Price_Rs_per_tonne",
]
INTS = {"Year", "Month"}
DOUBLES = {
    "Price_INR", "Price_Max_INR", "Price_Cr", "PricePerSqft", "Area_Sqft", "Area_Max_Sqft", "Bathrooms", "Balconies", "Total_Floors",
    "Property_Age_Years", "Latitude", "Longitude", "Total_Units", "Rating", "Review_Count", "Cement_Price_Rs_per_bag_50kg", "Steel_TMT_Price_Rs_per_tonne",
}
LISTING = T.StructType([T.StructField(c, T.IntegerType() if c in INTS else T.DoubleType() if c in DOUBLES else T.StringType()) for c in COLUMNS])
#: Columns that the analysis coerces to double, whatever text stands in them.
NUMERIC_COLS = [
    "Price_INR", "Price_Cr", "PricePerSqft", "BHK", "Area_Sqft", "Bathrooms", "Balconies", "Car_Parking", "Floor_Number", "Total_Floors",
    "Property_Age_Years", "Pincode", "Latitude", "Longitude", "Cement_Price_Rs_per_bag_50kg", "Steel_TMT_Price_Rs_per_tonne", "Year", "Month",
]
#: Registry columns as they are named there, and as they are named here.
REGISTRY = {
    "token": "rera_token",
    "district": "rera_district",
    "Project Information :: Project Name": "rera_project_name",
    "Project Information :: Project Status": "rera_project_status",
    "Project Information :: Project Type": "rera_project_type",
    "Project Information :: Approved Date": "rera_approved_date",
    "Project Information :: Proposed Date of Completion": "rera_proposed_completion_date",
    "summary.Promoter Name": "rera_promoter_name",
    "Address Details :: Pin Code": "rera_pincode",
}
