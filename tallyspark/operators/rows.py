"""Row-level table operators: ordered limits, conditional update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(cols, descending: bool):
    out = []
    for c in cols:
        c = F.col(f"`{c}`") if isinstance(c, str) else c
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return out


def first_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """``LIMIT n`` with an order, so the rows are fixed.  Planned as
    ``TakeOrderedAndProject``: each task keeps its own top n, so only
    n rows per task reach the final merge."""
    return df.orderBy(*_order(order, False)).limit(n)


def top_n(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """Greatest ``n`` rows by ``order`` (descending)."""
    return df.orderBy(*_order(order, True)).limit(n)


def update_where(df: DataFrame, cond: Column, updates: dict) -> DataFrame:
    """``UPDATE … SET col = value WHERE cond`` as a projection.

    ``updates`` maps column -> literal or Column.  ``jobs.update_table``
    writes the touched partitions of a table back.
    """
    cols = []
    for c in df.columns:
        if c in updates:
            v = updates[c]
            v = v if isinstance(v, Column) else F.lit(v)
            cols.append(F.when(cond, v).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return df.select(*cols)
