"""Small literal lookup tables (seeded, fixed size)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Country spelling map (raw_value, country_name, country_code).
COUNTRY_MAPPING = [
    ("AUSTRIA", "Austria", "AT"),
    ("AT", "Austria", "AT"),
    ("ÖSTERREICH", "Austria", "AT"),
    ("FRANCE", "France", "FR"),
    ("FR", "France", "FR"),
]

COUNTRY_MAPPING_SCHEMA = "raw_value string, country_name string, country_code string"


def country_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_MAPPING, COUNTRY_MAPPING_SCHEMA)
