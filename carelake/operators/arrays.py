"""Array aggregates (JSON_ARRAYAGG, GROUP_CONCAT) in set form.

All of them are ``groupBy(key).agg(collect_*)``: Spark aggregates partially on
the map side, so only one partial buffer per key and map task crosses the
shuffle.  Element order is always made explicit (T5): the buffered items are
structs whose leading fields are the sort keys, the array is sorted once per
key, then the sort keys are projected away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(items) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def _item(order: Sequence, fields: Sequence) -> Column:
    """Struct ``(_o0, _o1, …, _v)``: sort keys first, payload last; without
    ``fields`` there is no payload."""
    order_cols = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))]
    payload = [F.struct(*_cols(fields)).alias("_v")] if fields else []
    return F.struct(*order_cols, *payload)


def ordered_array(df: DataFrame, keys: Sequence[str], order: Sequence,
                  fields: Sequence, alias: str, desc: bool = True) -> DataFrame:
    """One row per key with ``alias`` = array of ``struct(fields)`` ordered by
    ``order`` (newest first by default; NULL sort keys last, as in MySQL).

    ``collect_list`` of a struct keeps rows whose payload fields are NULL
    (``JSON_ARRAYAGG`` keeps NULL elements, A12).  Keys with no rows are
    absent: attach with a left join and choose NULL (A12) or ``[]`` (A13).
    """
    arr = F.sort_array(F.collect_list(_item(order, fields)), asc=not desc)
    return df.groupBy(*keys).agg(F.transform(arr, lambda x: x["_v"]).alias(alias))


def distinct_array(df: DataFrame, keys: Sequence[str], value, alias: str) -> DataFrame:
    """``JSON_ARRAYAGG`` over ``SELECT DISTINCT value`` (A14): distinct values
    sorted ascending, a NULL value kept as one NULL element.  ``collect_set``
    de-duplicates map-side, so the buffer per key is bounded by the number of
    distinct values, not rows."""
    v = F.col(value) if isinstance(value, str) else value
    s = F.array_sort(F.collect_set(F.struct(v.alias("v"))))
    return df.groupBy(*keys).agg(F.transform(s, lambda x: x["v"]).alias(alias))


def sorted_text(arr: Column, sep: str = ",") -> Column:
    """Array → sorted text (for oracle-comparable output)."""
    return F.array_join(F.array_sort(arr), sep)


def ordered_distinct_concat(df: DataFrame, keys: Sequence[str], value: str,
                            order: str, alias: str, sep: str = ", ",
                            latest_alias: str | None = None) -> DataFrame:
    """``GROUP_CONCAT(DISTINCT value ORDER BY order DESC SEPARATOR sep)``
    (A15).  Spark rejects DISTINCT with an ORDER BY on another column, so it
    is two aggregates: the latest ``order`` per distinct value, then values
    sorted by that, newest first (ties: value descending).  The first
    aggregate is keyed by (keys, value), which spreads a hot key over its
    distinct values."""
    per_value = df.groupBy(*keys, value).agg(F.max(order).alias("_last"))
    arr = F.sort_array(F.collect_list(F.struct(F.col("_last"), F.col(value))), asc=False)
    aggs = [F.array_join(F.transform(arr, lambda x: x[value]), sep).alias(alias)]
    if latest_alias:
        aggs.append(F.max("_last").alias(latest_alias))
    return per_value.groupBy(*keys).agg(*aggs)


def ordered_array_parts(df: DataFrame, keys: Sequence[str], order: Sequence, fields: Sequence,
                        alias: str, part_size: int, item_id: Sequence | None = None,
                        desc: bool = True) -> DataFrame:
    """:func:`ordered_array` for keys of any size: ``(keys…, part_no,
    n_parts, alias)`` where a key with ``n`` items is split into
    ``ceil(n / part_size)`` parts by a hash of the item, each part sorted.

    A normal key (``n <= part_size``) gives one row with the whole array, as
    :func:`ordered_array`.  A hot key (a person holding a third of all rows)
    never lands in one task: the per-key count is a partial aggregate, only
    keys above ``part_size`` are joined back (few, so AQE broadcasts them at
    their measured size), and an exchange on (key, part) comes before the
    final aggregate, which would else reuse a partitioning by key alone.  Parts are not ordered against each
    other; every item keeps its sort fields, so readers can merge them."""
    ident = [F.col(c) if isinstance(c, str) else c for c in (item_id or order)]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n_parts = F.coalesce(F.ceil(F.col("_n") / F.lit(part_size)), F.lit(1)).cast("int")
    j = df.join(counts.filter(F.col("_n") > part_size), list(keys), "left").withColumn("n_parts", n_parts)
    j = j.withColumn("part_no", F.pmod(F.xxhash64(*ident), F.col("n_parts")).cast("int")).repartition(*keys, "part_no")
    arr = F.sort_array(F.collect_list(_item(order, fields)), asc=not desc)
    return j.groupBy(*keys, "part_no", "n_parts").agg(
        F.transform(arr, lambda x: x["_v"]).alias(alias))
