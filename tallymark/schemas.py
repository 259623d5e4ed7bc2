"""Table shapes, keys and the fixed vocabulary of the market reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SILVER_SCHEMA = T.StructType([
    T.StructField("dataset_type", T.StringType()),
    T.StructField("dimension_value", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("vehicle_count", T.LongType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("date", T.DateType()),
])
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()

# Unified column -> Silver column.
UNIFIED_TO_SILVER = {
    "Dataset_Type": "dataset_type",
    "Dimension_Value": "dimension_value",
    "Period": "period",
    "Year": "year",
    "Month": "month",
    "Month_Name": "month_name",
    "Vehicle_Count": "vehicle_count",
    "Source_File": "source_file",
}
UNIFIED_COLUMNS = list(UNIFIED_TO_SILVER.values())
TEXT_COLUMNS = ["dataset_type", "dimension_value", "period", "month_name", "source_file"]

BUSINESS_KEY = ["dataset_type", "state_code", "dimension_value", "period", "date"]
MEASURE = "vehicle_count"

DQ_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_checked", T.LongType()),
    T.StructField("critical_error_count", T.LongType()),
    T.StructField("details", T.StringType()),
])


@dataclass(frozen=True)
class Grain:
    """One report grain: its Silver label, fact suffix and naming column."""

    dataset_type: str
    name: str

    @property
    def column(self) -> str:
        return f"{self.name}_name"

    @property
    def fact(self) -> str:
        return f"fact_{self.name}"


CATEGORY = Grain("Vehicle_Category", "category")
FUEL = Grain("Fuel", "fuel")
MANUFACTURER = Grain("Manufacturer", "manufacturer")
GRAINS = (CATEGORY, FUEL, MANUFACTURER)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published reports and their rules.
# ---------------------------------------------------------------------------

# Dataset type -> first header cell of its report.
REPORT_HEADERS = {
    "Fuel": "Fuel",
    "Manufacturer": "Maker",
    "Vehicle_Category": "Vehicle Category",
    "Vehicle_Class": "Vehicle Class",
    "Vehicle_Type": "Vehicle Type",
    "State": "State",
    "Pollution_Norm": "Norms",
}

# Dataset types whose file names carry a state code.
STATE_REPORT_TYPES = ["Fuel", "Manufacturer", "Vehicle_Category"]

# Dataset types accepted by the unified validation.
EXPECTED_DATASET_TYPES = ["Fuel", "Manufacturer", "Vehicle_Category", "State", "Pollution_Norm"]

# Row labels that are sums of other rows.
SUMMARY_LABELS = ["total", "grand total", "all india", "all-india", "all india total"]
AGGREGATE_LABELS = ["TOTAL", "GRAND TOTAL"]

# First and last year in scope.
VALID_YEARS = (2016, 2026)

# Year ranges in which reports are delivered, per report.
YEAR_CHUNKS = [(2016, 2018), (2019, 2021), (2022, 2024), (2025, 2026)]
SINGLE_YEARS = [(y, y) for y in range(2016, 2027)]
REPORT_RANGES = {
    "vehicle_category": YEAR_CHUNKS,
    "fuel": YEAR_CHUNKS,
    "manufacturer": SINGLE_YEARS,
}

# State and union territory codes; some names have two codes.
INDIA_STATES = {
    "an": "Andaman and Nicobar Islands",
    "ap": "Andhra Pradesh",
    "ar": "Arunachal Pradesh",
    "as": "Assam",
    "br": "Bihar",
    "cg": "Chhattisgarh",
    "ch": "Chandigarh",
    "ct": "Chhattisgarh",
    "dd": "Daman and Diu",
    "dl": "Delhi",
    "dn": "Dadra and Nagar Haveli",
    "ga": "Goa",
    "gj": "Gujarat",
    "hp": "Himachal Pradesh",
    "hr": "Haryana",
    "jh": "Jharkhand",
    "jk": "Jammu and Kashmir",
    "ka": "Karnataka",
    "kl": "Kerala",
    "la": "Ladakh",
    "ld": "Lakshadweep",
    "mh": "Maharashtra",
    "ml": "Meghalaya",
    "mn": "Manipur",
    "mp": "Madhya Pradesh",
    "mz": "Mizoram",
    "nl": "Nagaland",
    "od": "Odisha",
    "or": "Odisha",
    "pb": "Punjab",
    "py": "Puducherry",
    "rj": "Rajasthan",
    "sk": "Sikkim",
    "tg": "Telangana",
    "tn": "Tamil Nadu",
    "tr": "Tripura",
    "ts": "Telangana",
    "uk": "Uttarakhand",
    "up": "Uttar Pradesh",
    "wb": "West Bengal",
}

# Codes above that no delivered report uses: the other code of the same name,
# and the territory merged into "dd".
UNPLANNED_CODES = ["ct", "dn", "od", "ts"]
PLANNED_STATES = [code for code in INDIA_STATES if code not in UNPLANNED_CODES]

# What is said about a report that gives no rows.
NO_HEADER = "Expected column '{}' not found"
NO_MONTHS = "No monthly columns found in {}"
NO_ROWS = "No valid rows found after transformation"

# Names and messages in the summaries of a run.
GOLD_MESSAGE = "Gold Model Completed Successfully"
SUMMARY_METRICS = [
    "Silver Records Processed",
    "Silver Vehicle-Count Total",
    "Data Quality Errors",
    "Reconciliation Status",
]
ROWS_MATCH = "Silver-Gold row counts match"
ROWS_DIFFER = "Row count mismatch - review"
ALL_PASSED = "All critical checks passed"

# Reject reasons in the order in which they are joined.
REJECT_REASONS = [
    "Invalid year",
    "Invalid month",
    "Invalid vehicle count",
    "Missing dimension value",
    "Missing dataset type",
    "Missing or invalid state code",
]
