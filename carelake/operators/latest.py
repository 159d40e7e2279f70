"""Top-1 / top-n per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence,
               cols: Sequence[str] | None = None, desc: bool = True) -> DataFrame:
    """One row per key: the row with the greatest (``desc``) or smallest
    ``order`` tuple; ``order`` must end in a unique tie-breaker.

    Implemented as ``max_by(payload, struct(order…))`` — an ordinary aggregate
    with map-side partial aggregation, so a key holding a third of all rows
    still sends only one candidate per map task through the shuffle (a
    ``row_number`` window would sort the whole hot key in one task).  NULL
    sort keys lose against non-NULL ones, matching ``ORDER BY … DESC``."""
    payload = list(cols) if cols is not None else [c for c in df.columns if c not in keys]
    order_key = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                           for i, c in enumerate(order)])
    packed = F.struct(*[F.col(c) for c in payload])
    pick = F.max_by(packed, order_key) if desc else F.min_by(packed, order_key)
    return df.groupBy(*keys).agg(pick.alias("_m")).select(*keys, "_m.*")


def top_n_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                 n: int, rank_col: str = "rn") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) <= n`` for
    n > 1.  Spark plans a per-partition ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most n rows per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
