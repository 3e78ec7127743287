"""Raw landing with a load history (S2): every offered file is loaded once and can be replayed.

A load lists the offered files, leaves out those whose content has been loaded
before, and writes the rows of the others, as text and with the file they came from,
to a partition of its own in the raw table.  The manifest gets one row a file (path,
size, checksum) last, in one file, and readers take only loads that it names: a load
that fails halfway has not happened, and the same load id run again replaces it.

The checksum is the number of lines with sum and exclusive or of their hashes, so
files are read in parallel pieces and never held as a whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv import read_raw_csv, with_load_defaults
from .versioned import VersionedTable

MANIFEST_SCHEMA = "path string, bytes bigint, checksum string, load_run string, load_tz timestamp, landed_at timestamp"


def offered_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, bytes, checksum) of text files."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    h = F.xxhash64("value")
    return (lines.groupBy("path", "bytes")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"), F.bit_xor(h).alias("x"))
            .select("path", "bytes", F.concat_ws(":", "n", "s", "x").alias("checksum")))


class Landing:
    """The raw table of one kind (drivers | bookings | offers) under ``root``."""

    def __init__(self, spark: SparkSession, root: str, kind: str):
        self.spark, self.root, self.kind = spark, root.rstrip("/"), kind
        self.history = VersionedTable(spark, f"{self.root}/{kind}/manifest")

    def manifest(self) -> DataFrame:
        """One row per landed file."""
        rows = self.history.read()
        return self.spark.createDataFrame([], MANIFEST_SCHEMA) if rows is None else rows

    def land(self, paths: str | list[str], load_run: str, load_tz: str) -> int:
        """Load the offered files that are new by content; returns how many there were."""
        if not self.manifest().filter(F.col("load_run") == load_run).isEmpty():
            return 0
        offered = offered_files(self.spark, paths).groupBy("checksum").agg(F.min(F.struct("path", "bytes")).alias("f"))
        new = (offered.join(self.manifest().select("checksum").distinct(), "checksum", "left_anti")
               .select("f.path", "f.bytes", "checksum").collect())  # one row a file
        if not new:
            return 0
        rows = read_raw_csv(self.spark, [r.path for r in new], self.kind, load_tz=load_tz)
        (rows.drop("is_processed", "load_tz").withColumn("file", F.col("_metadata.file_path"))
         .write.mode("overwrite").parquet(f"{self.root}/{self.kind}/rows/load_run={load_run}"))
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        added = (self.spark.createDataFrame([(r.path, r.bytes, r.checksum, load_run, now) for r in new],
                                            "path string, bytes bigint, checksum string, load_run string, landed_at timestamp")
                 .withColumn("load_tz", F.lit(load_tz).cast("timestamp")).select("path", "bytes", "checksum", "load_run", "load_tz", "landed_at"))
        self.history.write(self.manifest().unionByName(added), label=load_run)
        return len(new)

    def raw(self, load_runs: list[str] | None = None) -> DataFrame:
        """The raw rows of the loads that the manifest names (or of some), with the load defaults."""
        loads = self.manifest().select("load_run", "load_tz").distinct()
        if load_runs is not None:
            loads = loads.filter(F.col("load_run").isin(load_runs))
        parts = []
        for load in loads.orderBy("load_tz", "load_run").collect():  # one row a load
            rows = self.spark.read.parquet(f"{self.root}/{self.kind}/rows/load_run={load.load_run}").drop("file")
            parts.append(with_load_defaults(rows).withColumn("load_tz", F.lit(load.load_tz)))
        if not parts:
            raise FileNotFoundError(f"no load of {self.kind} has landed in {self.root}")
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out
