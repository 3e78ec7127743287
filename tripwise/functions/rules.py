"""Declarative data-quality rules.

A rule is data: ``Rule(code, condition, message)``.  ``apply_rules`` adds, in
one narrow projection (no shuffle):

* ``error_reason`` -- every failed rule's message joined with ``' | '``
  (empty string when the row passes),
* ``error_codes``  -- the failed rule codes joined with ``','``,
* ``is_valid``     -- no rule failed.

A condition that evaluates to NULL counts as "not failed", like a SQL
``CASE WHEN`` does.  Bad rows are kept and flagged, never dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ERROR_SEPARATOR


@dataclass(frozen=True)
class Rule:
    code: str
    condition: Column
    message: Column


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``concat_ws`` leaves out NULLs, so it compacts and joins the failed rules' texts in one compiled expression.

    The conditions become columns of their own first: each is evaluated once, and texts are built from flags.
    """
    flags = {f"_dq_{r.code}": F.coalesce(r.condition, F.lit(False)) for r in rules}
    checked = df.withColumns(flags)
    failed = [F.col(name) for name in flags]
    out = checked.withColumns({
        "is_valid": ~reduce(lambda a, b: a | b, failed),
        "error_reason": F.concat_ws(ERROR_SEPARATOR, *[F.when(f, r.message) for f, r in zip(failed, rules)]),
        "error_codes": F.concat_ws(",", *[F.when(f, F.lit(r.code)) for f, r in zip(failed, rules)])})
    return out.drop(*flags)
