"""Hard-negative mining by Kronecker-packed products.

Vectors become integers, ``floor(256 * x)``.  In a block of candidates, a bias
makes all components non-negative, and the components of one dimension of all
candidates stand in separated fields of one wide integer.  An anchor, biased as
well, multiplies each dimension's integer once by its component; the sum over
the dimensions holds every candidate's product in its own field, because a
field is wide enough for the block's largest possible sum.  Taking off the
biases leaves the exact scores.

Two passes: an anchor's positives (the first ``positives`` other rows of its
label) come from blocks of its own label; then every block of every label gives
its best rows of another label within each positive's range of scores.  Rows go
to blocks by a hash of their id, anchors to groups of ``ANCHORS``; a task holds
one block and one group, and sends a few rows per anchor to the merge.

Cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part; a zero or empty vector does, with scores of 0; vectors
of other lengths are other spaces; of rows that repeat an id the one with the
least (label, vector) stays; scores are exact at any size of components, and
those that a long can't hold are given as its largest or smallest value; an
anchor without positives or without rows in range gives no row, as does an
empty table; other columns of the table aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import cut, table

POSITIVES, NEGATIVES = 5, 3
#: percent of the positive's score between which a negative's score lies
LEAST, MOST = 50, 95
#: rows of a block and anchors of a group
BLOCK, ANCHORS = 4_096, 4_096
LONG = np.iinfo(np.int64)

SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS "rank", s.vec_id AS negative_id, p.positive_score,
       s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3"""


def whole(vectors: np.ndarray) -> np.ndarray:
    """Integers of the components: int64, or Python ints where 62 bits don't hold them."""
    v = np.floor(256 * vectors.astype(np.float64))
    if v.size and np.abs(v).max() >= 2.0**62:
        return np.array([[int(x) for x in row] for row in v], dtype=object).reshape(v.shape)
    return v.astype(np.int64)


class Packed:
    """A block of candidates, one wide integer per dimension."""

    def __init__(self, rows: np.ndarray, largest: int):
        """``rows``: (candidates, dimensions) integers; ``largest``: the size
        of an anchor's largest component."""
        self.n, self.dim = rows.shape
        self.bias = int(np.abs(rows).max()) if rows.size else 0
        self.anchor_bias = largest
        self.sums = rows.sum(axis=1) if rows.size else np.zeros(self.n, np.int64)
        top = max(1, 4 * self.dim * self.bias * max(1, largest))
        self.width = max(1, -(-top.bit_length() // 8))  # bytes of a field
        self.integers = [self._pack(rows[:, d]) for d in range(self.dim)]
        self.exact64 = self.width <= 7

    def _pack(self, column: np.ndarray) -> int:
        if column.dtype == object or self.width > 8:
            return int.from_bytes(b"".join((int(x) + self.bias).to_bytes(self.width, "little") for x in column), "little")
        fields = (column + self.bias).astype("<u8").view(np.uint8).reshape(self.n, 8)[:, :self.width]
        return int.from_bytes(fields.tobytes(), "little")

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of ``anchor`` with all candidates."""
        total, whole_sum = 0, 0
        for a, wide in zip(anchor.tolist(), self.integers):
            total += (a + self.anchor_bias) * wide
            whole_sum += a
        data = total.to_bytes(self.n * self.width, "little")
        # (a + A)(c + B) = ac + aB + A(c + B), summed over the dimensions
        off = whole_sum * self.bias + self.dim * self.anchor_bias * self.bias
        if self.exact64:
            fields = np.zeros((self.n, 8), np.uint8)
            fields[:, :self.width] = np.frombuffer(data, np.uint8).reshape(self.n, self.width)
            return fields.view("<i8").ravel() - off - self.anchor_bias * self.sums.astype(np.int64)
        w = self.width
        return np.array([int.from_bytes(data[i * w:(i + 1) * w], "little") - off - self.anchor_bias * int(s) for i, s in enumerate(self.sums)],
                        dtype=object)


def first(score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest, ties to the earlier."""
    if len(score) > 4 * k:
        edge = np.sort(np.partition(score, len(score) - k)[len(score) - k:])[0]
        among = np.flatnonzero(score >= edge)
    else:
        among = np.arange(len(score))
    return among[np.argsort(-score[among], kind="stable")[:k]]


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def _clip(x) -> int:
    return int(min(max(int(x), LONG.min), LONG.max))


def _block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table, Packed | None, np.ndarray]:
    """(ids, labels, anchors, packed candidates, anchors' integers) of a task."""
    rows = rows.combine_chunks()
    is_anchor = rows["anchor"].to_numpy(zero_copy_only=False).astype(bool)
    own, asked = rows.filter(pa.array(~is_anchor)), rows.filter(pa.array(is_anchor))
    own = own.sort_by("vec_id")
    if not len(own) or not len(asked):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), asked, None, np.zeros((0, 0), np.int64)
    dim = rows["dim"][0].as_py()
    anchors = whole(_vectors(asked["v"], dim))
    packed = Packed(whole(_vectors(own["v"], dim)), int(np.abs(anchors).max()) if anchors.size else 0)
    return own["vec_id"].to_numpy(), own["label"].to_numpy(), asked, packed, anchors


FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
                   ("order", pa.string())])
FOUND_DDL = "anchor_id long, positive_id long, positive_score long, vec_id long, score long, order string"


def _sortable(x) -> str | None:
    """Text that sorts as the integer does, for scores that a long can't hold."""
    x = int(x)
    if LONG.min < x < LONG.max:
        return None
    digits = str(abs(x)).rjust(120, "0")
    return "p" + digits if x >= 0 else "m" + "".join(str(9 - int(c)) for c in digits)


def _positives(k: int):
    def run(rows: pa.Table) -> pa.Table:
        ids, _, asked, packed, anchors = _block(rows)
        out = []
        if packed is not None:
            for a, vector in zip(asked["vec_id"].to_pylist(), anchors):
                score = packed.scores(vector)
                other = np.flatnonzero(ids != a)
                for i in other[first(score[other], k)]:
                    out.append((a, int(ids[i]), None, int(ids[i]), _clip(score[i]), _sortable(score[i])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, FOUND)], schema=FOUND)

    return run


def _negatives(k: int, least: int, most: int):
    def run(rows: pa.Table) -> pa.Table:
        ids, labels, asked, packed, anchors = _block(rows)
        out = []
        if packed is not None:
            for a, label, positives, vector in zip(asked["vec_id"].to_pylist(), asked["label"].to_pylist(), asked["positives"].to_pylist(), anchors):
                other = np.flatnonzero((labels != label) & (ids != a))
                score = packed.scores(vector)[other]
                wide = score.dtype == object or (len(score) and max(-int(score.min()), int(score.max())) > 2**56)
                hundred = 100 * (score.astype(object) if wide else score)
                for p in positives:
                    exact = p["score"] if p["order"] is None else _from_sortable(p["order"])
                    if abs(exact) > 2**56:
                        hundred = hundred.astype(object)
                    fits = np.flatnonzero(((hundred >= least * exact) & (hundred <= most * exact)).astype(bool))
                    for i in fits[first(score[fits], k)]:
                        out.append((a, p["vec_id"], p["score"], int(ids[other[i]]), _clip(score[i]), _sortable(score[i])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 6, FOUND)], schema=FOUND)

    return run


def _from_sortable(text: str) -> int:
    return int(text[1:]) if text[0] == "p" else -int("".join(str(9 - int(c)) for c in text[1:]))


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` first rows per key by score, ties to the smaller id, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc_nulls_last("order"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(rows: DataFrame) -> DataFrame:
    """Rows that take part, one per id, with the length of their vectors."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("v").cast("array<double>").alias("v"))
    good = good.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    one = good.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("vec_id", "r.label", "r.v", F.size("r.v").alias("dim"))


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row of ``rows`` (vec_id, label, v) for which
    ``is_anchor`` holds and each of its positives, the first negatives whose
    score is between ``least`` and ``most`` percent of the positive's."""
    good = cut(usable(rows))
    n, asked = good.agg(F.count("*"), F.count_if(is_anchor)).first()
    n_blocks, n_groups = max(1, -(-n // BLOCK)), max(1, -(-asked // ANCHORS))
    block = F.pmod(F.xxhash64("vec_id", F.lit(12)), F.lit(n_blocks)).cast("int")
    group = F.pmod(F.xxhash64("vec_id", F.lit(21)), F.lit(n_groups)).cast("int")
    to_groups, to_blocks = (F.explode(F.sequence(F.lit(0), F.lit(x - 1))) for x in (n_groups, n_blocks))

    # a label with few rows is one block, a frequent one as many as it needs
    size = good.groupBy("dim", "label").count().select("dim", "label", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    sized = good.join(size, ["dim", "label"])
    part = F.pmod(F.xxhash64("vec_id", F.lit(12)), F.col("parts")).cast("int")
    own = sized.select("vec_id", "label", "v", "dim", part.alias("block"), to_groups.alias("turn"), F.lit(False).alias("anchor"))
    asking = sized.where(is_anchor).select("vec_id", "label", "v", "dim", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"), group.alias("turn"),
                                           F.lit(True).alias("anchor"))
    found = own.unionByName(asking).groupBy("dim", "label", "block", "turn").applyInArrow(_positives(positives), FOUND_DDL)
    best = cut(_best(found, ["anchor_id"], positives).groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score", "order")).alias("positives")))

    none = F.lit(None).cast("array<struct<vec_id:bigint,score:bigint,order:string>>")
    own = good.select("vec_id", "label", "v", "dim", block.alias("block"), to_groups.alias("turn"), F.lit(False).alias("anchor"), none.alias("positives"))
    asking = good.where(is_anchor).join(best, F.col("vec_id") == F.col("anchor_id")).select(
        "vec_id", "label", "v", "dim", to_blocks.alias("block"), group.alias("turn"), F.lit(True).alias("anchor"), "positives")
    found = own.unionByName(asking).groupBy("dim", "block", "turn").applyInArrow(_negatives(negatives, least, most), FOUND_DDL)
    return _best(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("v"))
    return mine(rows, F.col("vec_id") % 50 == 0)
