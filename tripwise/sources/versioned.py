"""Tables of parts, published version by version.

A part (a day, a key bucket, or all rows) is a folder that is written once.  A
version is one small file that names the folders of all parts; it is written last,
so readers see the version before until everything of the new one is there, and a
run that fails midway leaves the last version as it was.  A write replaces the parts
it names and keeps the folders of the others, whose files are not touched.

One writer at a time; folders that no version names any more stay until they are
removed with the table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ALL = "all"
_PART = "_part"


class VersionedTable:
    """``part`` names the part of a row as text; without it the table is one part."""

    def __init__(self, spark: SparkSession, root: str, part: Column | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.part = F.lit(ALL) if part is None else part.cast("string")

    def _versions(self) -> DataFrame:
        schema = "part string, folder string, columns string, label string, version string"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _last(self) -> str | None:
        return self._versions().agg(F.max("version").alias("v")).first()["v"]

    def version(self) -> int:
        """Number of the published version; 0 before the first."""
        last = self._last()
        return int(last.split("-")[0]) if last else 0

    def folders(self) -> dict[str, str]:
        """The current version's folder by part; there is one row a part."""
        last = self._last()
        return {r.part: r.folder for r in self._versions().filter(F.col("version") == last).collect() if r.part is not None}

    def read(self, parts: Iterable[str] | None = None) -> DataFrame | None:
        """The rows of the current version, or of some of its parts; None before the first version."""
        last = self._last()
        if last is None:
            return None
        rows = self._versions().filter(F.col("version") == last).collect()
        schema = StructType.fromJson(json.loads(rows[0].columns))
        wanted = None if parts is None else set(parts)
        return self.read_folders({r.part: r.folder for r in rows if r.part is not None and (wanted is None or r.part in wanted)}, schema)

    def schema(self) -> StructType | None:
        """The columns of the current version; None before the first."""
        last = self._last()
        return last and StructType.fromJson(json.loads(self._versions().filter(F.col("version") == last).first()["columns"]))

    def written(self, label: str) -> dict[str, str]:
        """The folders that the last version with this label brought, by part; empty without such a version."""
        versions = self._versions()
        own = versions.filter(F.col("label") == label).agg(F.max("version").alias("v")).first()["v"]
        rows = [] if own is None else versions.filter((F.col("version") <= own) & F.col("folder").isNotNull()).collect()  # one a part and version
        earlier = {r.folder for r in rows if r.version < own}
        return {r.part: r.folder for r in rows if r.version == own and r.folder not in earlier}

    def has(self, label: str) -> bool:
        """Whether a version with this label has been published."""
        return not self._versions().filter(F.col("label") == label).isEmpty()

    def prepare(self, df: DataFrame) -> dict[str, str]:
        """Write rows that no version names yet; returns the folder of each part, for ``publish``."""
        folder = f"data/{uuid.uuid4().hex}"
        # even files, whatever the parts' sizes: Spark splits large parts and joins small ones at run time
        df.withColumn(_PART, self.part).hint("rebalance", _PART).write.option("compression", "zstd").partitionBy(_PART).parquet(f"{self.root}/{folder}")
        parts = [r[0] for r in self.spark.read.schema(f"{_PART} string").parquet(f"{self.root}/{folder}").distinct().collect()]
        bad = [p for p in parts if p is None or not re.fullmatch(r"[\w-]+", p)]
        if bad:
            raise ValueError(f"names of parts are letters, digits, _ and -: {bad[:3]}")
        return {p: f"{folder}/{_PART}={p}" for p in parts}

    def publish(self, new: dict[str, str], schema: StructType, replaces: Iterable[str] | None = None, label: str | None = None) -> None:
        """A version with the ``new`` folders in place of those of the same parts and of ``replaces`` (None: of all)."""
        kept = {} if replaces is None else {p: f for p, f in self.folders().items() if p not in set(replaces)}
        columns = schema.json()
        rows = [(p, f, columns, label) for p, f in sorted((kept | new).items())] or [(None, None, columns, label)]
        name = f"{self.version() + 1:010d}-{uuid.uuid4().hex[:8]}"
        (self.spark.createDataFrame(rows, "part string, folder string, columns string, label string").coalesce(1)
         .write.parquet(f"{self.root}/versions/version={name}"))

    def read_folders(self, folders: dict[str, str], schema: StructType) -> DataFrame:
        """Rows of prepared or published folders; columns that ``schema`` lacks are not read."""
        paths = [f"{self.root}/{f}" for f in folders.values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame, replaces: Iterable[str] | None = None, label: str | None = None) -> None:
        """Publish a version with ``df``'s parts in place of the same ones and of ``replaces`` (None: of all)."""
        self.publish(self.prepare(df), df.schema, replaces, label)


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh (CREATE OR REPLACE TABLE ... AS): readers see the old rows until all new ones are written."""
    VersionedTable(df.sparkSession, path).write(df)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The published rows of a table that ``replace_table`` wrote."""
    rows = VersionedTable(spark, path).read()
    if rows is None:
        raise FileNotFoundError(f"no version of {path} has been published")
    return rows
