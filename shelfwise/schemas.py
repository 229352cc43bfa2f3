"""Fixed schemas of the inventory data model (staging, dimensions, fact, KPIs)."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(10, 2)
PERCENT = DecimalType(5, 2)

# CSV column order of the raw daily feed; header names as in the file.
STAGING = StructType(
    [
        StructField("Date", StringType()),
        StructField("Store_ID", StringType()),
        StructField("Product_ID", StringType()),
        StructField("Category", StringType()),
        StructField("Region", StringType()),
        StructField("Inventory_Level", IntegerType()),
        StructField("Units_Sold", IntegerType()),
        StructField("Units_Ordered", IntegerType()),
        StructField("Demand_Forecast", MONEY),
        StructField("Price", MONEY),
        StructField("Discount", PERCENT),
        StructField("Weather_Condition", StringType()),
        StructField("Holiday_Promotion", StringType()),
        StructField("Competitor_Pricing", MONEY),
        StructField("Seasonality", StringType()),
    ]
)

STORES = StructType(
    [
        StructField("store_id", StringType(), False),
        StructField("region", StringType(), False),
        StructField("store_name", StringType()),
        StructField("store_type", StringType()),
    ]
)
STORES_KEY = ("store_id", "region")

PRODUCTS = StructType(
    [
        StructField("product_id", StringType(), False),
        StructField("category", StringType(), False),
        StructField("product_name", StringType()),
    ]
)
PRODUCTS_KEY = ("product_id",)

INVENTORY = StructType(
    [
        StructField("date", DateType(), False),
        StructField("store_id", StringType(), False),
        StructField("region", StringType(), False),
        StructField("product_id", StringType(), False),
        StructField("inventory_level", IntegerType(), False),
        StructField("units_sold", IntegerType(), False),
        StructField("units_ordered", IntegerType(), False),
        StructField("demand_forecast", MONEY, False),
        StructField("price", MONEY, False),
        StructField("discount", PERCENT, False),
        StructField("weather_condition", StringType()),
        StructField("holiday_promotion", StringType()),
        StructField("competitor_pricing", MONEY),
        StructField("seasonality", StringType()),
    ]
)
INVENTORY_KEY = ("date", "store_id", "region", "product_id")
SKU = ("store_id", "region", "product_id")
LOCATION = ("store_id", "region")

KPIS_KEY = ("store_id", "region", "product_id", "calculation_date")

# staging column -> fact column (the load renames, parses the date and
# keeps every measure).
STAGING_TO_FACT = {
    "Store_ID": "store_id",
    "Region": "region",
    "Product_ID": "product_id",
    "Inventory_Level": "inventory_level",
    "Units_Sold": "units_sold",
    "Units_Ordered": "units_ordered",
    "Demand_Forecast": "demand_forecast",
    "Price": "price",
    "Discount": "discount",
    "Weather_Condition": "weather_condition",
    "Holiday_Promotion": "holiday_promotion",
    "Competitor_Pricing": "competitor_pricing",
    "Seasonality": "seasonality",
}

# Longest values of the staging table's text columns (fixed values).
TEXT_LIMITS = {
    "Date": 20,
    "Store_ID": 10,
    "Product_ID": 10,
    "Category": 50,
    "Region": 50,
    "Weather_Condition": 20,
    "Holiday_Promotion": 50,
    "Seasonality": 20,
}

# Table comments of the data model (fixed values, shown by table_profile).
TABLE_COMMENTS = {
    "inventory_data": "Main fact table for daily inventory data",
    "inventory_kpis": "Calculated KPIs and metrics for inventory management",
    "products": "Master table for product information",
    "staging_inventory_data": "Staging table for CSV data import",
    "stores": "Master table for store information with composite PK",
}

# Foreign keys of the data model (fixed values, shown by constraint_report):
# (table, column, constraint, referenced table, referenced column)
FOREIGN_KEYS = [
    ("inventory_data", "product_id", "inventory_data_ibfk_2", "products", "product_id"),
    ("inventory_data", "region", "inventory_data_ibfk_1", "stores", "region"),
    ("inventory_data", "store_id", "inventory_data_ibfk_1", "stores", "store_id"),
    ("inventory_kpis", "product_id", "inventory_kpis_ibfk_2", "products", "product_id"),
    ("inventory_kpis", "region", "inventory_kpis_ibfk_1", "stores", "region"),
    ("inventory_kpis", "store_id", "inventory_kpis_ibfk_1", "stores", "store_id"),
]
