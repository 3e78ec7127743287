"""Session helpers: pinned time zone and a shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for correct results (not tuning).
_REQUIRED = {
    # string timestamps without an offset are read as UTC wall clock
    "spark.sql.session.timeZone": "UTC",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session's time zone to UTC, which the rules' timestamps need; changes the given session."""
    for k, v in _REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


# Starting point for a large cluster run (100 TB of raw extracts, ~1000
# executors).  Shuffle width is set for ~128-256 MB per reduce task of the
# largest exchange (the offer dedup); AQE coalesces the smaller ones and
# splits skewed join partitions.  The broadcast threshold admits the driver
# key sets (tens of MB) to the referential checks and the dimension lookups.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tripwise",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests, benchmarks and examples (cluster jobs get theirs from spark-submit)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("TRIPWISE_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only a single-machine session (``local`` masters, as in tests) without
    one gets a scratch folder; on a cluster a missing setting is an error, as no
    local folder is seen by all executors.
    """
    sc = spark.sparkContext
    d = (spark.conf.get("spark.checkpoint.dir", None)
         or sc.getConf().get("spark.checkpoint.dir", None)
         or sc.getCheckpointDir())
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tripwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: with this on, Spark removes a query's shuffle files as soon as the query ends, not when the driver collects garbage
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """For jobs of several writes: what a query in here has shuffled goes when it has ended."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
