"""Latest record per key (ROW_NUMBER ... = 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], newest_first: str = "load_tz",
                   tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``key`` (one or more columns): the newest by ``newest_first``.

    Rows of one load share the load timestamp, so remaining ties are broken on
    every other column (ascending, NULLs last) which makes the survivor
    deterministic; rows equal in all of them are interchangeable.  All NULL
    keys form one group, so one NULL-key row survives.

    Spark plans the ``row_number() == 1`` filter as a WindowGroupLimit
    (partial top-1 per key before the shuffle, final top-1 after it), so a hot
    key costs one row per map task on the wire, not all of its rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in (*keys, newest_first, "is_processed")]
    order = [F.col(newest_first).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def newer(a: str, b: str, columns: Sequence[str], key: str, newest_first: str = "load_tz") -> Column:
    """Whether ``latest_per_key`` takes row ``a`` before row ``b`` (structs of ``columns``, neither NULL)."""
    def nulls_last(row: str, names: Sequence[str]) -> Column:
        return F.struct(*[x for c in names for x in (F.col(f"{row}.{c}").isNull(), F.col(f"{row}.{c}"))])

    # newest first has NULL last, as NULL is the smallest
    age_a, age_b = (F.struct(F.col(f"{row}.{newest_first}")) for row in (a, b))
    ties = [c for c in columns if c not in (key, newest_first, "is_processed")]
    return (age_a > age_b) | ((age_a == age_b) & (nulls_last(a, ties) < nulls_last(b, ties)))
