"""Per-key aggregates and their attachment to a key list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to all of the session's shuffle partitions.

    Adaptive execution joins shuffle partitions up to its advisory size, which
    counts compressed bytes: of narrow rows that is millions, and every sort and
    hash map of the stage holds them at once.  A number given to ``repartition``
    stays, and the other side of a join is dealt to match, so a task's memory
    falls with the partitions the session is sized to.  Of two tables the smaller
    one is dealt: the larger isn't shuffled if that one is broadcast."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def any_flags(df: DataFrame, keys: Sequence[str], preds: Mapping[str, Column]) -> DataFrame:
    """``IF(COUNT(*) > 0, TRUE, FALSE)`` over several predicates in one pass
    (A2): one aggregate per source table instead of one subquery per flag."""
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.bool_or(F.coalesce(p, F.lit(False))), F.lit(False)).alias(n)
        for n, p in preds.items()])


def attach(base: DataFrame, keys: Sequence[str] | str, parts: Sequence[DataFrame],
           defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join per-key aggregates onto the key list and fill the values an
    aggregate over *no* rows has (A11): counts 0, existence flags false,
    ``[]`` where the source coalesces.  All parts are keyed the same way, so
    after the first exchange the joins reuse one hash partitioning."""
    out = base
    for p in parts:
        out = out.join(p, on=keys, how="left")
    if not defaults:
        return out
    fill = {n: (v if isinstance(v, Column) else F.lit(v)) for n, v in defaults.items()}
    # one projection for all defaults (each withColumn would re-analyse the plan)
    return out.select(*[F.coalesce(F.col(c), fill[c]).alias(c) if c in fill else F.col(c)
                        for c in out.columns])


def pivot_latest(df: DataFrame, keys: Sequence[str], type_col: str,
                 types: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Conditional-max pivot (A8): ``MAX(CASE WHEN type = t THEN v END)`` per
    (t, v), one struct per type.  Types are a fixed list, so no distinct pass
    is needed to discover the pivot columns."""
    aggs = []
    for t in types:
        aggs.append(F.struct(*[F.max(F.when(F.col(type_col) == t, F.col(v))).alias(v)
                               for v in value_cols]).alias(t))
    return df.groupBy(*keys).agg(*aggs)
