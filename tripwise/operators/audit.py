"""Quality reports over staged rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Declared constraints of the staged offers table.
OFFER_NOT_NULL = ("offer_id", "offer_created_date", "booking_id", "driver_id", "offer_state", "driver_read",
                  "is_valid", "is_processed", "raw_load_tz")
OFFER_MAX_LENGTH = {"offer_id": 64, "booking_id": 64, "driver_id": 64, "offer_state": 50, "error_reason": 500}


# Which rules check which staged table.
TABLE_RULES = {"stg_drivers": range(1, 13), "stg_bookings": range(13, 19), "stg_offers": range(19, 28)}


def dq_rule_counts(staged: dict[str, DataFrame]) -> DataFrame:
    """Per staged table: row / valid / invalid counts and hits per rule code, 0 where there are none.

    One narrow pass per table (explode of the failed-rule list) and a grouped
    count; partial aggregation keeps the exchange at one row per rule and task.
    """
    parts = []
    for name, df in staged.items():
        codes = F.when(F.col("error_codes") == "", F.array().cast("array<string>")) \
                 .otherwise(F.split("error_codes", ","))
        status = F.array(F.lit("_rows"), F.when(F.col("is_valid"), "_valid").otherwise("_invalid"))
        parts.append(df.select(F.lit(name).alias("table_name"),
                               F.explode(F.concat(status, codes)).alias("rule"), F.lit(1).alias("hit")))
    spark = next(iter(staged.values())).sparkSession
    every = [(name, rule, 0) for name in staged
             for rule in ["_rows", "_valid", "_invalid", *(f"R{n}" for n in TABLE_RULES.get(name, ()))]]
    parts.append(spark.createDataFrame(every, "table_name string, rule string, hit int"))
    return (reduce(DataFrame.unionByName, parts)
            .groupBy("table_name", "rule").agg(F.sum("hit").alias("hits")))


def constraint_audit(stg_offers: DataFrame, key: str = "offer_id",
                     not_null=OFFER_NOT_NULL, max_length=None) -> DataFrame:
    """Violations of the declared NOT NULL, length and UNIQUE constraints (file tables enforce none).

    One aggregate pass for the per-row checks plus one grouped count on the key.
    """
    max_length = OFFER_MAX_LENGTH if max_length is None else max_length
    nulls = stg_offers.agg(
        *[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"not_null:{c}") for c in not_null],
        *[F.count_if(F.length(c) > n).cast("bigint").alias(f"max_length:{c}") for c, n in max_length.items()])
    dup = (stg_offers.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)
           .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias(f"unique:{key}")))
    return (nulls.unpivot([], nulls.columns, "check_name", "violations")
            .unionByName(dup.unpivot([], dup.columns, "check_name", "violations")))
