"""Dedupe, latest-row and top-k operators.

Last-wins dedupe is an aggregate (``max_by`` over a struct ordering key), not
a ``row_number`` window: the aggregate combines map-side, so a key holding a
third of the table is reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order_cols`` for every key.

    Give ``order_cols`` a unique tie-break (e.g. an id) for a deterministic winner.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*payload), ordering).alias("__last"))
    return agg.select(*[F.col(k) for k in keys], "__last.*").select(*df.columns)


def last_n(df: DataFrame, n: int, order_cols: Sequence[str]) -> DataFrame:
    """The ``n`` latest rows by ``order_cols`` (n <= 0 keeps all rows).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task reach the final merge.
    """
    if n <= 0:
        return df
    return df.orderBy(*[F.col(c).desc() for c in order_cols]).limit(n)


def rows_at_latest(df: DataFrame, date_col: str, tie_break: Sequence[str] = (),
                   mode: str = "one") -> DataFrame:
    """E5: rows of the latest date; ``mode="one"`` keeps one deterministic row."""
    if mode == "one":
        order = [F.col(date_col).desc()] + [F.col(c).asc() for c in tie_break]
        return df.orderBy(*order).limit(1)
    latest = df.select(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == latest)


def top_k(df: DataFrame, metric: str, k: int | None = None,
          tie_break: Sequence[str] = ()) -> DataFrame:
    """Rank by a metric, descending (NULL last), optionally only the first k."""
    order = [F.col(metric).desc_nulls_last()] + [F.col(c).asc() for c in tie_break]
    out = df.orderBy(*order)
    return out.limit(k) if k else out
