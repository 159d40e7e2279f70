"""Approximate nearest neighbours by collision-counting hashing.

Vectors are projected on ``PROJECTIONS`` random directions; each direction is
a sorted array of (projection, vector), cut into ``CELLS`` cells of equally many
vectors, and a vector keeps the numbers of its cells.  For a query, windows
around its own projections widen step by step (virtual rehashing: the arrays
stay, only the windows' edge cells move), and a vector's count is the number of
windows that hold it.  The windows are the narrowest in which enough vectors
reach the threshold; of these, the ones with the highest counts, ties included,
are verified: their inner products with the query on the original vectors in
double precision.  The best ``k`` remain.

Enough is ``PER_NEIGHBOUR`` times ``k`` and the share ``VERIFIED`` of a block:
on vectors without structure, a number that doesn't grow with the table can't
keep the recall (README).

For inner products, a vector gets one more component that makes all norms
equal to the largest, so near means a large product.

Vectors are dealt out to blocks by a hash of their id, queries as well; each
pair of a block of vectors and a block of queries is one task's work, and the
best of all blocks are merged per query.  No task holds more than a block.

Cases: vectors that are null, zero, or hold null or non-finite components take
no part, neither as query nor as neighbour; vectors of other lengths are other
spaces; rows that repeat an id are neighbours of each other only under
different ids; ties go to the smaller id; fewer than ``k`` candidates give
fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import table

K = 20
PROJECTIONS, CELLS = 160, 256
#: windows (half width, in standard deviations of a projection of two unit vectors' difference), and the share of windows that must hold a vector
WIDTHS = np.array([0.25, 0.5, 0.8, 1.0, 1.2, 1.5, 2.0, 3.0, 4.0])
THRESHOLD = 0.62
#: vectors verified per query and block: this many per neighbour asked for, and this share of the block
PER_NEIGHBOUR, VERIFIED = 20, 0.08
#: vectors and queries of a block
BLOCK, QUERIES = 20_000, 10_000


def usable(v: Column) -> Column:
    """Whether a vector takes part."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & good & F.exists(v, lambda x: x != 0), F.lit(False))


class Index:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 5):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.top = norms.max()
        full = np.column_stack((self.vectors / self.top, np.sqrt(np.maximum(0, 1 - (norms / self.top) ** 2))))
        self.directions = np.random.default_rng(seed).normal(size=(full.shape[1], PROJECTIONS))
        projected = np.ascontiguousarray((full @ self.directions).T)
        n, n_cells = len(ids), min(CELLS, len(ids))
        by_place = np.argsort(projected, axis=1, kind="stable")
        #: cells of the vectors, (projections, vectors)
        self.cell = np.empty((PROJECTIONS, n), np.uint8)
        np.put_along_axis(self.cell, by_place, np.broadcast_to((np.arange(n) * n_cells // n).astype(np.uint8), (PROJECTIONS, n)), axis=1)
        firsts = -(-np.arange(1, n_cells) * n // n_cells)
        #: first projection of each cell but the first
        self.edges = np.take_along_axis(projected, by_place[:, firsts], axis=1)
        self._less, self._in = np.empty_like(self.cell), np.empty(self.cell.shape, bool)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, ids, scores) of the best verified vectors of each query, best first."""
        n = len(self.ids)
        enough = min(n, PER_NEIGHBOUR * k + int(VERIFIED * n))
        for first in range(0, len(queries), 512):
            part = queries[first:first + 512]
            centre = (part / np.sqrt((part**2).sum(axis=1))[:, None]) @ self.directions[:-1]
            # first and last cells of all windows: (projections, queries, widths)
            low = np.stack([np.searchsorted(e, c[:, None] - WIDTHS) for e, c in zip(self.edges, centre.T)]).astype(np.uint8)
            high = np.stack([np.searchsorted(e, c[:, None] + WIDTHS, side="right") for e, c in zip(self.edges, centre.T)]).astype(np.uint8)
            start = 0
            for q in range(len(part)):
                count, start = self._narrowest(low[:, q], high[:, q] - low[:, q], enough, start)
                yield self._verify(int(query_ids[first + q]), part[q], count, enough, k)

    def _collisions(self, low: np.ndarray, span: np.ndarray) -> np.ndarray:
        """How many windows hold each vector."""
        np.subtract(self.cell, low[:, None], out=self._less)  # wraps below the window
        np.less_equal(self._less, span[:, None], out=self._in)
        return np.add.reduce(self._in.view(np.uint8), axis=0, dtype=np.uint8)

    def _narrowest(self, low: np.ndarray, span: np.ndarray, enough: int, start: int) -> tuple[np.ndarray, int]:
        """Counts in the narrowest windows in which ``enough`` vectors reach
        the threshold (the widest if none do), and their number.  The search
        begins at ``start``, which changes its time but not its end."""
        least, w = int(np.ceil(THRESHOLD * PROJECTIONS)), start

        def counts(w: int) -> tuple[np.ndarray, bool]:
            c = self._collisions(low[:, w], span[:, w])
            return c, np.count_nonzero(c >= least) >= enough

        count, reached = counts(w)
        while reached and w > 0:
            narrower, still = counts(w - 1)
            if not still:
                break
            count, w = narrower, w - 1
        while not reached and w < len(WIDTHS) - 1:
            w += 1
            count, reached = counts(w)
        return count, w

    def _verify(self, query_id: int, query: np.ndarray, count: np.ndarray, enough: int, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        at_least = np.bincount(count, minlength=PROJECTIONS + 1)[::-1].cumsum()
        found = np.flatnonzero(count >= PROJECTIONS - np.searchsorted(at_least, enough))
        found = found[self.ids[found] != query_id]
        score = self.vectors[found] @ query
        if len(found) > k:
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            found, score = found[keep], score[keep]
        best = np.lexsort((self.ids[found], -score))[:k]
        return query_id, self.ids[found[best]], score[best]


def _search_block(k: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, asked = rows[~rows["query"]], rows[rows["query"]]
        out = []
        if len(own) and len(asked):
            index = Index(own["vec_id"].to_numpy(np.int64), np.stack(own["v"].to_numpy()).astype(np.float64))
            for q, ids, score in index.search(asked["vec_id"].to_numpy(np.int64), np.stack(asked["v"].to_numpy()).astype(np.float64), k):
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row of
    ``vectors`` (vec_id, v) for which ``is_query`` holds."""
    good = vectors.where(usable(F.col("v")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim"), is_query.alias("q"))
    n, asked = good.agg(F.count("*"), F.count_if("q")).first()
    n_blocks, n_asked = max(1, -(-n // BLOCK)), max(1, -(-asked // QUERIES))
    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n_blocks))
    turn = F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(n_asked))
    own = good.select("vec_id", "v", "dim", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("turn"), F.lit(False).alias("query"))
    asking = good.where("q").select("vec_id", "v", "dim", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), turn.cast("int").alias("turn"),
                                    F.lit(True).alias("query")).dropDuplicates(["vec_id", "block"])
    found = own.withColumn("block", F.col("block").cast("int")).unionByName(asking).groupBy("dim", "block", "turn").applyInPandas(
        _search_block(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    return nearest(vectors, F.col("vec_id") % 20 == 0)
