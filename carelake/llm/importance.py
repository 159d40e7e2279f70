"""Importance resampling towards a target distribution of hashed n-grams.

Features are the runs of 1 to ``N`` consecutive words.  In a block of text, the
runs are interned in an open-addressed NumPy table: 64-bit xxhash keys are
probed linearly, and a slot is shared only if the bytes agree.  A slot stores
its run's bucket (crc32 modulo ``BUCKETS``) and count; the occurrences keep
slot ids, through which they gather the gains of their buckets.

Two passes over the documents: counts per bucket (each task sends at most
``BUCKETS`` partial sums) give the gains, which are broadcast (``BUCKETS``
numbers); then every document gets the floored mean of its gains and a Gumbel
number from a hash of its id.  Drawing the highest scores is a draw without
replacement.  Ranks come from a range partitioning by score with the counts of
the partitions before, so no task sees more than its range.

Cases: a null or empty text, or one without words, has no features and weight
0; runs and words of any length count whole; a null doc_id has the hash of
``7:null`` and comes last among ties; rows that repeat a doc_id are documents
of their own, ranked next to each other in any order; empty documents or
benchmark give the gains of empty sums; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import blocks, cut, table, utf8, words

N, BUCKETS = 2, 10_000
MIN_WORDS, PERCENT = 20, 25
#: words whose runs are interned together
WORDS = 1 << 17
#: runs of more bytes are hashed one by one
LONG = 256

#: what stands between words: all ASCII but letters and digits
GAP = np.ones(256, bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = GAP[128:] = False

SQL = r"""
WITH t AS (SELECT * FROM range(0, 256) r(i)),
crc AS (SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS codes FROM t),
w AS (
  SELECT 0 AS kind, row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 1, -row_number() OVER (), NULL,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (
  SELECT kind, r, f, count(*) AS c FROM (
    SELECT kind, r, unnest(w) AS f FROM w
    UNION ALL SELECT kind, r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w) GROUP BY ALL),
b AS (
  SELECT f, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(1, CAST(strlen(f) AS BIGINT) + 1),
                    lambda i: CAST('0x' || hex(f)[2 * i - 1 : 2 * i] AS BIGINT))),
                    lambda c, x: xor(c >> 8, codes[1 + xor(c, x) % 256])), 4294967295) % 10000 AS BIGINT) AS bucket
  FROM (SELECT DISTINCT f FROM f), crc),
n AS (SELECT bucket, CAST(sum(c) FILTER (kind = 0) AS BIGINT) AS s, CAST(sum(c) FILTER (kind = 1) AS BIGINT) AS t FROM f JOIN b USING (f) GROUP BY 1),
sums AS (SELECT COALESCE(sum(s), 0) AS s, COALESCE(sum(t), 0) AS t FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((COALESCE(n.t, 0) + 1) * (sums.s + 10000) AS DOUBLE) / CAST((COALESCE(n.s, 0) + 1) * (sums.t + 10000) AS DOUBLE))) AS BIGINT) AS gain
      FROM n, sums),
d AS (SELECT r, CAST(sum(c) AS BIGINT) AS n_features, CAST(floor(CAST(sum(c * gain) AS DOUBLE) / CAST(sum(c) AS DOUBLE)) AS BIGINT) AS weight
      FROM f JOIN b USING (f) JOIN g USING (bucket) WHERE kind = 0 GROUP BY 1),
x AS (
  SELECT w.doc_id, len(w.w) AS words, COALESCE(n_features, 0) AS n_features, COALESCE(weight, 0) AS weight,
         COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || w.doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN d USING (r) WHERE kind = 0),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE words >= 20
      QUALIFY rank <= (SELECT count(*) FROM x WHERE words >= 20) * 25 // 100)
SELECT x.doc_id, n_features, weight, score, rank FROM x LEFT JOIN k USING (doc_id)"""


# ── hashes of spans ───────────────────────────────────────────────────────

# Fixed values of the xxhash64 function.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(acc + lane * P2, 31) * P1


class Lanes:
    """Little-endian words at any byte of a buffer."""

    def __init__(self, data: np.ndarray):
        self.data = data
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self.u64 = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        self.u32 = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))


def xxhash64(lanes: Lanes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxhash64, seed 0, of the spans of a buffer."""
    out = np.empty(len(start), np.uint64)
    far = np.flatnonzero(size > LONG)
    for i in far.tolist():
        out[i] = xxhash.xxh64_intdigest(lanes.data[start[i]:start[i] + size[i]].tobytes())
    near = np.flatnonzero(size <= LONG) if len(far) else slice(None)
    with np.errstate(over="ignore"):
        out[near] = _xxhash64(lanes, start[near], size[near])
    return out


def _xxhash64(lanes: Lanes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = np.full(len(start), P5)
    at, left = start.copy(), size.copy()
    wide = np.flatnonzero(size >= 32)
    if len(wide):
        zero = np.zeros(len(wide), np.uint64)
        acc = [zero + P1 + P2, zero + P2, zero.copy(), zero - P1]
        live = np.arange(len(wide))
        while len(live):
            for k in range(4):
                acc[k][live] = _round(acc[k][live], lanes.u64[at[wide[live]] + 8 * k])
            at[wide[live]] += 32
            left[wide[live]] -= 32
            live = live[left[wide[live]] >= 32]
        x = _rotate(acc[0], 1) + _rotate(acc[1], 7) + _rotate(acc[2], 12) + _rotate(acc[3], 18)
        for k in range(4):
            x = (x ^ _round(zero, acc[k])) * P1 + P4
        h[wide] = x
    h += size.astype(np.uint64)
    live = np.flatnonzero(left >= 8)
    while len(live):
        h[live] = _rotate(h[live] ^ _round(np.uint64(0), lanes.u64[at[live]]), 27) * P1 + P4
        at[live] += 8
        left[live] -= 8
        live = live[left[live] >= 8]
    live = np.flatnonzero(left >= 4)
    h[live] = _rotate(h[live] ^ (lanes.u32[at[live]].astype(np.uint64) * P1), 23) * P2 + P3
    at[live] += 4
    left[live] -= 4
    live = np.flatnonzero(left > 0)
    while len(live):
        h[live] = _rotate(h[live] ^ (lanes.data[at[live]].astype(np.uint64) * P5), 11) * P1
        at[live] += 1
        left[live] -= 1
        live = live[left[live] > 0]
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def crc32(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of the spans of a buffer."""
    c = np.full(len(start), 0xFFFFFFFF, np.uint32)
    live, k = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(live):
        c[live] = _CRC[(c[live] ^ data[start[live] + k]) & 255] ^ (c[live] >> np.uint32(8))
        k += 1
        live = live[size[live] > k]
    c = ~c
    for i in np.flatnonzero(size > LONG).tolist():
        c[i] = zlib.crc32(data[start[i]:start[i] + size[i]].tobytes())
    return c


def same_bytes(lanes: Lanes, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans at ``a`` and ``b`` of one size hold the same bytes."""
    same = a == b
    live, at = np.flatnonzero(~same), 0
    same[:] = True
    while len(live):
        left = np.minimum(size[live] - at, 8).astype(np.uint64)
        unlike = (lanes.u64[a[live] + at] ^ lanes.u64[b[live] + at]) << (np.uint64(64) - np.uint64(8) * left)
        same[live[unlike != 0]] = False
        at += 8
        live = live[(unlike == 0) & (size[live] > at)]
    return same


def intern(lanes: Lanes, start: np.ndarray, size: np.ndarray, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slot id of each span, and the first-placed span of each slot id: spans
    with the same bytes, and only they, share a slot of an open-addressed
    table.  ``keys`` are their 64-bit hashes (xxhash64 if not given)."""
    n = len(start)
    keys = xxhash64(lanes, start, size) if keys is None else keys
    mask = (1 << max(4, int(2 * n - 1).bit_length())) - 1
    owner = np.full(mask + 1, -1, np.int64)  # the span that holds a slot
    slot = (keys & np.uint64(mask)).astype(np.int64)
    home = np.empty(n, np.int64)
    live = np.arange(n)
    while len(live):
        at = slot[live]
        empty = owner[at] < 0
        owner[at[empty]] = live[empty]  # of several that claim a slot, one gets it
        held = owner[at]
        mine = (keys[held] == keys[live]) & (size[held] == size[live])
        check = np.flatnonzero(mine)
        mine[check] = same_bytes(lanes, start[held[check]], start[live[check]], size[live[check]])
        home[live[mine]] = at[mine]
        live = live[~mine]
        slot[live] = (slot[live] + 1) & mask
    used = np.flatnonzero(owner >= 0)
    number = np.empty(mask + 1, np.int64)
    number[used] = np.arange(len(used))
    return number[home], owner[used]


# ── features ──────────────────────────────────────────────────────────────

def joined(d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, A-Z in lower case, with one space after each, and their
    starts; a run of words is a span."""
    size = ends - starts + 1
    to = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size, out=to[1:])
    out = d[np.minimum(np.arange(to[-1]) + np.repeat(starts - to[:-1], size), len(d) - 1)]
    out[to[1:] - 1] = 32
    upper = (out >= 65) & (out <= 90)
    out[upper] += 32
    return out, to[:-1]


def features(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of a string column: (documents of the occurrences, their slot
    ids, buckets of the slots, counts of the slots).  A piece holds at most
    ``WORDS`` words and the next one, so a long document makes several."""
    off, data = utf8(col)
    for i, j in blocks(off):
        starts, ends, counts = words(data, off[i:j + 1], GAP)
        doc = np.repeat(np.arange(i, j), counts)
        d = data[off[i]:off[j]]
        for a in range(0, len(starts), WORDS):
            b = min(a + WORDS, len(starts))
            c = min(b + N - 1, len(starts))
            text, at = joined(d, starts[a:c], ends[a:c])
            size, part = ends[a:c] - starts[a:c], doc[a:c]
            run_at, run_size, run_doc = [], [], []
            for n in range(1, N + 1):
                first = np.arange(min(b - a, c - a - n + 1))
                first = first[part[first] == part[first + n - 1]]
                run_at.append(at[first])
                run_size.append(at[first + n - 1] + size[first + n - 1] - at[first])
                run_doc.append(part[first])
            run_at, run_size, run_doc = np.concatenate(run_at), np.concatenate(run_size), np.concatenate(run_doc)
            slot, held = intern(Lanes(text), run_at, run_size)
            bucket = crc32(text, run_at[held], run_size[held]).astype(np.int64) % BUCKETS
            yield run_doc, slot, bucket, np.bincount(slot, minlength=len(held))


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): occurrences of features per bucket over all ``texts`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, bucket, count in features(batch.column(0)):
                np.add.at(total, bucket, count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of each bucket: 1000 times the smoothed log ratio of its share in
    ``target`` to that in ``docs``, rounded down."""
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for counts, texts in ((s, docs), (t, target)):
        for r in bucket_counts(texts).collect():  # BUCKETS rows at most
            counts[r["bucket"]] = r["n"]
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            n = batch.num_rows
            count, total, n_words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            off, data = utf8(batch.column(1))
            for i, j in blocks(off):
                n_words[i:j] = words(data, off[i:j + 1], GAP)[2]
            for doc, slot, bucket, _ in features(batch.column(1)):
                lo = doc[0]
                count[lo:] += np.bincount(doc - lo, minlength=n - lo)
                # sums of integers below 2**53 are exact in doubles
                total[lo:] += np.bincount(doc - lo, weights=gain[bucket][slot], minlength=n - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(count), pa.array(total // np.maximum(count, 1))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``rank`` by (score descending, doc_id) from 1, null beyond
    ``limit``; rows whose ``n_words`` are too few have none."""
    able = F.col("n_words") >= MIN_WORDS
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    dealt = cut(rows.where(able).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    # the id's upper part is the partition, the lower one the place in it
    place = (F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    dealt = dealt.select("*", *place)
    before, total = {}, 0
    for r in dealt.groupBy("part").count().orderBy("part").collect():  # a row per partition
        before[r["part"]] = total
        total += r["count"]
    if before:
        base = F.create_map(*(F.lit(x) for p in before.items() for x in p))[F.col("part")]
        rank = base + F.col("place") + 1
        dealt = dealt.withColumn("rank", F.when(rank <= limit, rank))
    else:
        dealt = dealt.withColumn("rank", F.lit(None).cast("long"))
    return dealt.select(*rows.columns, F.col("rank").cast("long").alias("rank")).unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: str = "7") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of ``docs``
    (doc_id, text): of the documents with MIN_WORDS words or more, ``percent``
    are drawn towards the texts of ``target``."""
    weighed = weigh(docs, gains(docs, target))
    h = F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), F.lit(8)), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))
    rows = cut(weighed.withColumn("score", F.col("weight") + gumbel))
    able = rows.where(F.col("n_words") >= MIN_WORDS).count()
    return ranked(rows, percent * able // 100)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resample(docs.select("doc_id", "text"), target.select("text")).select("doc_id", "n_features", "weight", "score", "rank")
