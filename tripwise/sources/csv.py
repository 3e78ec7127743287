"""Raw CSV extracts: read and write.

Raw files are read as all-text columns with a fixed, positional schema (the
header line is skipped, its names need not match), optional double-quote
enclosure with doubled quotes inside, compression detected from the file
extension.  Load defaults (``is_processed = false``, ``load_tz``) are added
on read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .fixtures import RAW_BOOKING_COLUMNS, RAW_DRIVER_COLUMNS, RAW_OFFER_COLUMNS

RAW_COLUMNS = {
    "drivers": RAW_DRIVER_COLUMNS[:-2],
    "bookings": RAW_BOOKING_COLUMNS[:-2],
    "offers": RAW_OFFER_COLUMNS[:-2],
}

CSV_OPTIONS = {
    "header": "true",            # skip the first line
    "enforceSchema": "true",     # columns by position, header names ignored
    "quote": '"',
    "escape": '"',               # "" inside a quoted field is one quote
    "mode": "FAILFAST",          # a malformed line stops the load
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def with_load_defaults(df: DataFrame, load_tz: str | None = None) -> DataFrame:
    ts = F.lit(load_tz).cast("timestamp") if load_tz else F.current_timestamp()
    return df.withColumn("is_processed", F.lit(False)).withColumn("load_tz", ts)


def read_raw_csv(spark: SparkSession, path: str, kind: str, load_tz: str | None = None) -> DataFrame:
    """All-text raw rows of ``kind`` (drivers | bookings | offers) from CSV / CSV.gz files.

    ``.gz`` files cannot be split, so each is read by one task; the rows are
    spread by the first shuffle downstream (the per-id dedup), not by an
    extra repartition here.
    """
    df = spark.read.schema(text_schema(RAW_COLUMNS[kind])).options(**CSV_OPTIONS).csv(path)
    return with_load_defaults(df, load_tz)


def write_raw_csv(df: DataFrame, path: str, kind: str, compression: str | None = None) -> None:
    """Write raw text rows as CSV extracts (same dialect as ``read_raw_csv``)."""
    w = df.select(*RAW_COLUMNS[kind]).write.mode("overwrite").options(**CSV_OPTIONS)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
