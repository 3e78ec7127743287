"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a Parquet table; whatever else it holds is not read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder name inside the folder that the driver and all executors share."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


#: names of the session variables that hold arrays
_ARRAYS: list[str] = []

#: with this on, Spark removes a query's shuffle files as soon as the query ends
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, what: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back (cuts lineage, survives lost executors).

    What the write shuffled is removed from the executors' disks when it has ended: later steps read the table.
    The arrays declared for it (see ``fixed_array``) leave the driver.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, what), spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
        while _ARRAYS:
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {_ARRAYS.pop()}")
    table = spark.read.schema(df.schema).parquet(path)
    table.tw_path = path
    return table


def forget(*tables: DataFrame) -> None:
    """Deletes the files of ``stored`` tables that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.tw_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: rows that a task of ``add_columns`` computes at once; its lists and arrays are no longer, however large Arrow's batches are
ROWS_AT_ONCE = 1000
#: rows of the batches that Spark hands to Python: they lie in an executor's memory on both sides
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: what this Python worker keeps from task to task (a key and its value, or nothing)
_KEPT: list[tuple[Any, Any]] = []
_ASKED: list[bool] = []


def worker_keeps(key: Any, make: Callable[[Any], Any]) -> Any:
    """``make(key)``, kept by this Python worker for its later tasks with the same key; a task of ``add_columns`` that asks for none frees it."""
    _ASKED[:] = [True]
    if not _KEPT or _KEPT[0][0] is not key:
        _KEPT.clear()
        _KEPT.append((key, make(key)))
    return _KEPT[0][1]


def _begun(make: Callable[[], Any]) -> Any:
    """``make()``, after which the worker keeps no more than that asked for."""
    _ASKED.clear()
    compute = make()
    if not _ASKED:
        _KEPT.clear()
    return compute


def add_columns(df: DataFrame, fields: list[T.StructField],
                make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
                drop: tuple[str, ...] = ()) -> DataFrame:
    """Every row with further columns computed batch by batch in Arrow.

    ``make`` runs once per task and returns the function for its batches, of at most
    ``ROWS_AT_ONCE`` rows (from here on the session's Arrow batches have no more); that function returns one array for each of ``fields``.  Columns in ``drop`` are
    handed to the function but not returned.
    """
    keep = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType(keep + fields)
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= ROWS_AT_ONCE:
        spark.conf.set(BATCH_ROWS, ROWS_AT_ONCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = _begun(make)
        names = [f.name for f in keep]
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(begin, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + compute(batch),
                                                 names=names + [f.name for f in fields])
        # the worker stays for later tasks; what it no longer holds goes back to the machine
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """A text column's values in UTF-8."""
    return column.cast(pa.large_binary()).to_pylist()


def not_null(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


def hashed_fold(column: str, folds: int):
    """crc32 of the value as text, modulo ``folds``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def fixed_array(values: DataFrame, size: int) -> Column:
    """Numbers (i, value) as one array of ``size`` elements with 0 where there is none, for use in any expression.

    The array is a session variable, computed at once.  ``size`` is a constant of
    the caller, so what all tasks get has a fixed size.  Use the column before the next table is
    ``stored``, which drops the variable; DataFrames made with it keep the array themselves.
    """
    spark = values.sparkSession
    every = spark.range(size).select(F.col("id").cast("int").alias("i"))
    filled = every.join(values, "i", "left").agg(F.sort_array(F.collect_list(F.struct(
        "i", F.coalesce("value", F.lit(0).cast(values.schema["value"].dataType)).alias("value")))).alias("all"))
    name = f"tw_array_{uuid.uuid4().hex}"
    filled.select(F.col("all.value").alias("value")).createOrReplaceTempView(name)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} ARRAY<BIGINT>")
    spark.sql(f"SET VAR {name} = (SELECT CAST(value AS ARRAY<BIGINT>) FROM {name})")
    spark.catalog.dropTempView(name)
    _ARRAYS.append(name)
    return F.expr(name)


def bit_filter(values: DataFrame, column: str, words: int = 1 << 14) -> Column:
    """Whether a row's ``column`` may be among the values of ``values``: one bit per hash, in an array of fixed size.

    Passes every given value; the more of them there are, the more others pass too.
    """
    word = (F.pmod(F.xxhash64(column), F.lit(64 * words)) / 64).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), 64) as int))")
    bits = values.groupBy(word.alias("i")).agg(F.bit_or(bit).alias("value"))
    return F.element_at(fixed_array(bits, words), word + 1).bitwiseAND(bit) != 0


def split_by(df: DataFrame, keys: DataFrame, column: str, words: int = 1 << 14) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``column`` may be among ``keys``, rows that surely aren't), so that a join shuffles the former only."""
    may = F.coalesce(bit_filter(keys.select(column).distinct(), column, words), F.lit(False))
    return df.where(may), df.where(~may)


def without_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is not among ``ids``; rows with a null there stay."""
    may, rest = split_by(df, ids, column)
    return may.join(ids.select(column).distinct(), column, "left_anti").select(*df.columns).unionByName(rest)


def fresh(name: str, taken) -> str:
    """``name``, lengthened until no column of ``taken`` has it."""
    names = {c.lower() for c in taken}
    while name.lower() in names:
        name += "_"
    return name


def stored_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The Parquet table at ``path``; None where nothing has been written yet.  Any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
