"""Bringing per-key parts together without a chain of joins.

All parts become rows of one union, each row filling only its own part's
column, and one keyed aggregate picks every part's value: one exchange on the
key, however many parts there are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.aggregates import spread
from carelake.operators.arrays import _item


def item_rows(df: DataFrame, key: str, order: Sequence, fields: Sequence, alias: str, item_id: Sequence | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """``(key, _id, alias)``: one row per item of a keyed array; ``alias``
    holds the sort keys and the payload, ``_id`` a hash that deals the items
    of a hot key to parts.  ``keep``: further columns, e.g. the ``part_no`` of
    items that are dealt already."""
    ident = [F.col(c) if isinstance(c, str) else c for c in (item_id or order)]
    return df.select(key, *keep, F.xxhash64(*ident).alias("_id"), _item(order, fields).alias(alias))


def items_array(items: Column, desc: bool = True, unpack: Callable[[Column], Column] | None = None) -> Column:
    """Collected items in order, without their sort keys; NULL when there are none."""
    return F.when(F.size(items) > 0, F.transform(F.sort_array(items, asc=not desc), unpack or (lambda x: x["_v"])))


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union by halves: each step analyses its plan anew, so a chain would
    take time in the square of its length."""
    while len(frames) > 1:
        frames = [a.union(b) for a, b in zip(frames[::2], frames[1::2])] + (frames[-1:] if len(frames) % 2 else [])
    return frames[0]


def hot_keys(df: DataFrame, key: str, part_size: int, n: Column | None = None) -> DataFrame:
    """``(key, n_parts)`` of the keys with more than ``part_size`` rows.  ``n``
    (default: the rows) is the count as an aggregate; one that reads the columns
    a second reader of ``df`` needs makes both share the exchanges of ``df``.

    The key is given as an aggregate: a join on it asks for non-null keys, and
    below the grouping that filter would make ``df`` another plan than its
    second reader's, with exchanges of its own."""
    c = df.groupBy(F.col(key).alias("_k")).agg(F.max(key).alias(key), (F.count(F.lit(1)) if n is None else n).alias("_n")).where(F.col(key).isNotNull() & (F.col("_n") > part_size))
    return c.select(key, F.ceil(F.col("_n") / F.lit(part_size)).cast("int").alias("n_parts"))


def deal(df: DataFrame, key: str, hot: DataFrame, ident: Column) -> DataFrame:
    """``df`` with ``part_no`` by the hash ``ident`` of the item where the key is
    hot.  Every row is dealt anew by the key where the hot keys are too many
    to broadcast, so ``df`` had better hold no more than the hash reads."""
    return df.join(hot, key, "left").withColumn("part_no", F.coalesce(F.pmod(ident, F.col("n_parts")).cast("int"), F.lit(0))).drop("n_parts")


def max_parts(hot: Sequence[DataFrame], key: str) -> DataFrame:
    """``(key, n_parts)`` over the hot keys of several arrays, dealt to all
    partitions: so few bytes would be merged into one, and its task would make
    the rows of all parts."""
    return spread(_union(list(hot)), key).groupBy(key).agg(F.max("n_parts").alias("n_parts"))


def gather(present: DataFrame | str, key: str, rows: Mapping[str, DataFrame], items: Mapping[str, DataFrame], part_size: int | None = None,
           desc: Mapping[str, bool] | None = None, n_parts: DataFrame | None = None,
           unpack: Mapping[str, Callable[[Column], Column]] | None = None, apart: bool = False) -> DataFrame:
    """One row per key of ``present``: ``rows`` (one row per key each) as
    structs, NULL where a key has none, and ``items`` (see :func:`item_rows`)
    as ordered arrays, NULL where a key has none.  Where one of ``rows`` (or, of
    a key with several rows, of ``items``) holds the keys, ``present`` is its name,
    and no rows cross just to mark them.

    With ``part_size`` a key whose array has more items gives several rows
    ``(key, part_no, n_parts, …)``; structs stand in part 0 only, and no task
    assembles more than about ``part_size`` items of an array.  Items that
    have their ``part_no`` already (:func:`deal`) come with ``n_parts``, the
    parts of the hot keys, and aren't dealt again.

    The parts of a hot key are rows of the union too, so their number needs no
    join with the gathered rows.

    ``unpack`` makes the element of an array from its item, whose sort keys are
    ``_o0``, ``_o1``, … and whose payload is ``_v`` (default: the payload), so a
    value that items are sorted by needn't cross a second time.

    ``apart`` deals every part by an exchange of its own, before the union, which
    keeps their common partitions: rows cross with their own part's columns only,
    not with the empty ones of all others, and unsorted, as no task of the writing
    side aggregates them.  For parts many or wide."""
    desc, unpack = desc or {}, unpack or {}
    if part_size and n_parts is None:
        hot = {name: hot_keys(df, key, part_size) for name, df in items.items()}
        items = {name: deal(df, key, hot[name], F.col("_id")) for name, df in items.items()}
        n_parts = max_parts(list(hot.values()), key) if hot else None
    split = n_parts is not None
    zero = F.lit(0).alias("part_no")
    marked = isinstance(present, DataFrame)
    frames = {"_here": present.select(key, zero, F.lit(True).alias("_here"))} if marked else {}
    here = F.col("_here") if marked else F.size(present) > 0 if present in items else F.col(present).isNotNull()
    for name, df in rows.items():
        frames[name] = df.select(key, zero, F.struct(*[c for c in df.columns if c != key]).alias(name))
    for name, df in items.items():
        frames[name] = df.select(key, F.col("part_no") if split else zero, name)
    if split:
        hot = n_parts.join((present if marked else {**rows, **items}[present]).select(key).distinct(), key, "left_semi")
        frames["n_parts"] = hot.select(key, F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part_no"), "n_parts")
    types = {name: df.schema[name].dataType for name, df in frames.items()}
    none = {n: F.lit(None).cast(t).alias(n) for n, t in types.items()}
    keys = [key, "part_no"] if part_size else [key]
    if apart:
        frames = {name: spread(df.select(*keys, name), *keys) for name, df in frames.items()}
    union = _union([df.select(*keys, *[n if n == name else none[n] for n in types])
                    for name, df in frames.items()])
    picked = [*([F.bool_or("_here").alias("_here")] if marked else []), *[F.min(n).alias(n) for n in rows], *[F.collect_list(n).alias(n) for n in items]]
    if split:
        picked.append(F.max("n_parts").alias("n_parts"))
    out = union.groupBy(*keys).agg(*picked)
    arrays = [items_array(F.col(n), desc.get(n, True), unpack.get(n)).alias(n) for n in items]
    if not part_size:
        return out.where(here).select(key, *rows, *arrays)
    if not split:
        return out.where(here).select(key, "part_no", F.lit(1).alias("n_parts"), *rows, *arrays)
    # a part beyond the first has no mark of its own; the hash may have left it empty, then it is no row
    some = reduce(lambda a, b: a | b, [F.size(n) > 0 for n in items])
    out = out.where(here | ((F.col("part_no") > 0) & F.col("n_parts").isNotNull() & some))
    return out.select(key, "part_no", F.coalesce("n_parts", F.lit(1)).alias("n_parts"), *rows, *arrays)
