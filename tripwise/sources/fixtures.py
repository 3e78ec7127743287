"""Raw driver / booking / offer text tables derived from the TPC-H-style test tables.

The original project loaded private CSV extracts into all-string raw tables.
These views rebuild equivalent raw rows from ``customer``/``nation``,
``orders`` and ``lineitem`` (see FIXTURES.md): every business column is text,
defects (blank ids, the text ``null``, bad numbers and dates, unknown keys,
duplicates) are injected by key arithmetic, and dates move +25 years so the
original date constants apply.  Every source row is kept.

The column expressions are plain SQL that runs unchanged in Spark and DuckDB,
so the Spark job and the DuckDB oracle start from identical raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BATCH2_LOAD_TZ, BATCH3_LOAD_TZ

# Fixture expressions (FIXTURES.md sections 2-4 and 6).
DRIVER_EXPRS = {
    "id": "case when k%211=0 then ' ' else cast(k as string) end",
    "country": ("case when k%223=0 then ' ' else case nk%7 when 0 then 'AUSTRIA' when 1 then ' at ' "
                "when 2 then 'Österreich' when 3 then 'France' when 4 then 'fr' when 5 then 'FRANCE ' "
                "else n_name end end"),
    "rating": ("case when k%31=0 then 'null' when k%37=0 then 'abc' when k%41=0 then '5.70' "
               "else concat(cast(1+k%4 as string),'.',cast(k%10 as string)) end"),
    "rating_count": ("case when k%29=0 then 'null' when k%43=0 then '-3' when k%47=0 then 'x' "
                     "else cast(1+k%500 as string) end"),
    "date_registration": ("case when k%53=0 then 'null' when k%59=0 then 'not-a-date' "
                          "when k%61=0 then '1999-13-01' when k%67=0 then '2008-01-01 00:00:00' "
                          "else concat(cast(date '2021-05-10' + cast(k%60 as int) as string),' 08:30:00') end"),
    "receive_marketing": ("case k%9 when 0 then 'true' when 1 then 'FALSE' when 2 then ' yes ' when 3 then 'no' "
                          "when 4 then '1' when 5 then '0' when 6 then 'TRUE' when 7 then 'false' "
                          "else case when k%2=0 then null else 'maybe' end end"),
    "is_processed": "false",
    "load_tz": "cast('2026-06-01 00:00:00' as timestamp)",
}
# older snapshot of every 50th driver; loses the dedup to the newer row
DRIVER_OLD_EXPRS = {
    "id": "cast(k as string)",
    "country": "'FRANCE'",
    "rating": "'3.3'",
    "rating_count": "'10'",
    "date_registration": "'2021-05-15 08:30:00'",
    "receive_marketing": "'true'",
    "is_processed": "false",
    "load_tz": "cast('2026-05-31 00:00:00' as timestamp)",
}
DRIVER_OLD_WHERE = "k%50=0"

BOOKING_EXPRS = {
    "id": "case when o_orderkey%499=0 then ' ' when o_orderkey%997=0 then null else cast(o_orderkey as string) end",
    "request_date": ("case when o_orderkey%101=0 then 'null' when o_orderkey%103=0 then 'not-a-date' "
                     "when o_orderkey%3001=0 then '2005-01-01 00:00:00' "
                     "else cast(o_orderdate + interval 25 years as string) end"),
    "status": ("case o_orderkey%8 when 0 then 'success' when 1 then ' SUCCESS' when 2 then 'SUCCESS' "
               "when 3 then 'DRIVER_ABORT' when 4 then 'PASSENGER_ABORT' when 5 then 'NO_DRIVER_FOUND' "
               "when 6 then 'SERVER_ABORT' else case when o_orderkey%3=0 then 'LOST' else 'SUCCESS' end end"),
    "id_driver": ("case when o_orderkey%8=5 then 'null' when o_orderkey%23=0 "
                  "then cast(o_custkey+1000000 as string) else cast(o_custkey as string) end"),
    "estimated_route_fare": ("case when o_orderkey%19=0 then 'null' when o_orderkey%71=0 then '-5.00' "
                             "when o_orderkey%73=0 then 'n/a' "
                             "else cast(cast(o_totalprice as decimal(18,2)) as string) end"),
    "is_processed": "false",
    "load_tz": "cast('2026-06-01 00:00:00' as timestamp)",
}

OFFER_EXPRS = {
    "id": ("case when l_orderkey%503=0 then '' when l_orderkey%1009=0 then null "
           "else concat(cast(l_orderkey as string),'-',cast(l_linenumber as string)) end"),
    "datecreated": ("case when l_orderkey%107=0 then 'bad' when l_orderkey%3001=0 then '2005-01-01 00:00:00' "
                    "else cast(l_shipdate + interval 25 years as string) end"),
    "bookingid": "case when l_orderkey%109=0 then null else cast(l_orderkey as string) end",
    "driverid": "case when l_partkey%113=0 then 'null' else cast(l_partkey as string) end",
    "routedistance": ("case when l_partkey%17=0 then 'null' when l_partkey%79=0 then '-1' "
                      "when l_partkey%83=0 then '600000' when l_partkey%89=0 then 'far' "
                      "else concat(cast(cast(l_quantity as int)*100 as string),'.5') end"),
    "state": ("case when l_suppkey%13=0 then 'PENDING' when l_linestatus='O' then ' accepted' "
              "else 'Canceled' end"),
    "driverread": ("case when l_suppkey%17=0 then 'maybe' when l_returnflag='A' then 'true' "
                   "when l_returnflag='R' then '0' else '1' end"),
    "is_processed": "false",
    "load_tz": "cast(l_shipdate + interval 25 years as timestamp)",
}

# Second driver batch built from the first batch's valid drivers (k = numeric id):
# rating change, country flip, marketing flip, count-only change, rating+count to
# text null, new ids.  Columns: driver_id, country_name, driver_rating,
# driver_rating_count, registration_date, receive_marketing of the valid view.
BATCH2_EXPRS = {
    "id": "driver_id",
    "country": ("case when k%33=0 then case country_name when 'Austria' then 'France' "
                "when 'France' then 'Austria' else country_name end else country_name end"),
    "rating": ("case when k%37=1 then 'null' when k%20=0 then '4.4' "
               "else cast(driver_rating as string) end"),
    "rating_count": ("case when k%37=1 then 'null' when k%43=1 then cast(driver_rating_count+1 as string) "
                     "else cast(driver_rating_count as string) end"),
    "date_registration": "cast(registration_date as string)",
    "receive_marketing": ("case when k%41=1 then case when receive_marketing then 'false' "
                          "when not receive_marketing then 'true' end "
                          "else case when receive_marketing then 'true' "
                          "when not receive_marketing then 'false' end end"),
    "is_processed": "false",
    "load_tz": f"cast('{BATCH2_LOAD_TZ}' as timestamp)",
}
BATCH2_NEW_ID = "cast(k+2000000 as string)"
BATCH2_NEW_WHERE = "k%100=0"

# Third driver batch, built from the second's valid drivers: the country flips back, ratings that the second
# batch changed change again, marketing of some flips for the first time, every 11th driver is not sent, new ids.
BATCH3_EXPRS = dict(
    BATCH2_EXPRS,
    rating=("case when k%40=0 then '4.1' when k%37=2 then 'null' else cast(driver_rating as string) end"),
    rating_count="case when k%37=2 then 'null' else cast(driver_rating_count as string) end",
    receive_marketing=("case when k%41=2 then case when receive_marketing then 'false' "
                       "when not receive_marketing then 'true' end "
                       "else case when receive_marketing then 'true' "
                       "when not receive_marketing then 'false' end end"),
    load_tz=f"cast('{BATCH3_LOAD_TZ}' as timestamp)")
BATCH3_WHERE = "k%11<>0"
BATCH3_NEW_ID = "cast(k+4000000 as string)"
BATCH3_NEW_WHERE = "k%150=0"

RAW_DRIVER_COLUMNS = ("id", "country", "rating", "rating_count", "date_registration",
                      "receive_marketing", "is_processed", "load_tz")
RAW_BOOKING_COLUMNS = ("id", "request_date", "status", "id_driver", "estimated_route_fare",
                       "is_processed", "load_tz")
RAW_OFFER_COLUMNS = ("id", "datecreated", "bookingid", "driverid", "routedistance", "state",
                     "driverread", "is_processed", "load_tz")


def _select(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select([F.expr(e).alias(c) for c, e in exprs.items()])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"),
                                                         F.col("c_nationkey").alias("nk"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has a fixed 25 rows -> bounded broadcast
    base = cust.join(F.broadcast(nation), F.col("nk") == F.col("n_nationkey"))
    newer = _select(base, DRIVER_EXPRS)
    older = _select(base.filter(F.expr(DRIVER_OLD_WHERE)), DRIVER_OLD_EXPRS)
    return newer.unionByName(older)


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(read_table(spark, sf_dir, "orders"), BOOKING_EXPRS)


def raw_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(read_table(spark, sf_dir, "lineitem"), OFFER_EXPRS)


def _next_batch(valid_drivers: DataFrame, exprs: dict, where: str, new_id: str, new_where: str) -> DataFrame:
    v = valid_drivers.withColumn("k", F.col("driver_id").try_cast("bigint"))
    changed = _select(v.filter(F.expr(where)), exprs)
    return changed.unionByName(_select(v.filter(F.expr(new_where)), dict(exprs, id=new_id)))


def raw_drivers_batch2(valid_drivers: DataFrame) -> DataFrame:
    """Second raw driver snapshot derived from the first batch's valid drivers."""
    return _next_batch(valid_drivers, BATCH2_EXPRS, "true", BATCH2_NEW_ID, BATCH2_NEW_WHERE)


def raw_drivers_batch3(valid_drivers: DataFrame) -> DataFrame:
    """Third raw driver snapshot derived from the second batch's valid drivers."""
    return _next_batch(valid_drivers, BATCH3_EXPRS, BATCH3_WHERE, BATCH3_NEW_ID, BATCH3_NEW_WHERE)
