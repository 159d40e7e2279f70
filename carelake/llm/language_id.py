"""Language identification by averaged hashed subword embeddings.

A text's subwords are the byte n-grams (``ORDERS``) of its words with a blank
on either side; digits and ASCII signs count as blanks and A-Z as a-z.  Each
subword is hashed to a row of an embedding table, the rows are averaged and a
linear softmax gives the language.  Embeddings and softmax are trained
together by stochastic gradient descent in numpy on a bounded sample.  On
texts held back from training, a temperature is fitted to the scores and a
rejection bound chosen: the least score whose accepted texts reach
``PRECISION``.

For prediction the softmax is folded into the table (a row of class scores per
subword), so a text costs one look-up and one sum per subword.

Cases: null texts and texts without a letter get ``und``, score 0 and are
rejected; without labelled texts all are ``und``; rows without a label or text
aren't learned from; repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import BLOCK_BYTES, U64, blocks, table, utf8

#: training texts per language, and languages
PER_LANGUAGE, LANGUAGES = 600, 500
BUCKETS, DIM, ORDERS = 1 << 15, 16, (2, 3, 4)
PRECISION = 0.98

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_MUL = {n: U64(m) for n, m in zip(ORDERS, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))}


def subwords(d: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the starts and buckets of the n-grams of folded bytes."""
    blank = d == 32
    wide = d.astype(np.uint32)
    out = []
    for n in ORDERS:
        if len(d) < n:
            continue
        m = len(d) - n + 1
        ok = ~blank[1:1 + m] if n > 2 else ~(blank[:m] & blank[1:])
        for k in range(2, n - 1):
            ok &= ~blank[k:k + m]
        at = np.flatnonzero(ok)
        code = wide[at].copy()
        for k in range(1, n):
            code = (code << np.uint32(8)) | wide[at + k]
        with np.errstate(over="ignore"):
            out.append((at, ((code.astype(np.uint64) * _MUL[n]) >> U64(64 - 15)).astype(np.int32)))
    return out


def pieces(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of documents as (document numbers, starts, folded bytes): a
    blank before each and one at the end.  A document longer than a block is
    cut between words."""
    for i, j in blocks(off):
        if j - i == 1 and off[j] - off[i] > BLOCK_BYTES:
            s, end = int(off[i]), int(off[j])
            while s < end:
                e = min(s + BLOCK_BYTES, end)
                gaps = np.flatnonzero(_FOLD[data[s:e]] == 32)
                if e < end and len(gaps) and gaps[-1]:
                    e = s + int(gaps[-1])
                yield np.array([i]), np.array([0]), np.concatenate(([32], _FOLD[data[s:e]], [32])).astype(np.uint8)
                s = e
        else:
            n = j - i
            flat = np.full(off[j] - off[i] + n + 1, 32, np.uint8)
            starts = off[i:j] - off[i] + np.arange(n)
            lengths = np.diff(off[i:j + 1])
            to = np.arange(off[j] - off[i]) + np.repeat(np.arange(1, n + 1), lengths)
            flat[to] = _FOLD[data[off[i]:off[j]]]
            yield np.arange(i, j), starts, flat


def has_letter(data: np.ndarray, off: np.ndarray, col: pa.Array) -> np.ndarray:
    """Whether each text has a letter: an ASCII one, else any by its category."""
    fold = _FOLD[data[off[0]:off[-1]]]
    ascii_letter = np.concatenate(([0], np.cumsum((fold != 32) & (fold < 128))))
    out = ascii_letter[off[1:] - off[0]] > ascii_letter[off[:-1] - off[0]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[i] = any(c.isalpha() for c in col[i].as_py() or "")
    return out


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # class scores per bucket
    bias: np.ndarray
    temperature: float = 1.0
    bound: float = 0.0

    def logits(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Class scores per document."""
        total, n = np.zeros((len(off) - 1, len(self.languages))), np.zeros(len(off) - 1)
        for docs, starts, d in pieces(data, off):
            for at, bucket in subwords(d):
                if len(at):
                    first = np.searchsorted(at, starts)
                    have = np.diff(np.append(first, len(at))) > 0
                    sums = np.add.reduceat(self.scores[bucket], first[have], axis=0)
                    total[docs[have]] += sums
                    n[docs] += np.diff(np.append(first, len(at)))
        return total / np.maximum(n, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, languages: list[str], epochs: int = 6, rate: float = 2.0) -> Model:
    """Train on texts given as (buckets, counts).  A fifth calibrates."""
    rng = np.random.default_rng(11)
    table_, weights = rng.normal(0, 0.1, (BUCKETS, DIM)), np.zeros((DIM, len(languages)))
    bias = np.zeros(len(languages))
    order = rng.permutation(len(texts))
    held, train = order[:len(order) // 5], order[len(order) // 5:]
    steps, done = max(1, epochs * len(train)), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            bucket, count = texts[i]
            share = (count / count.sum())[:, None]
            x = (share * table_[bucket]).sum(axis=0)
            z = x @ weights + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[label[i]] -= 1
            lr = rate * (1 - done / steps)
            back = weights @ g
            weights -= lr * np.outer(x, g)
            bias -= 0.05 * lr * g
            table_[bucket] -= lr * len(bucket) ** 0.5 * share * back
            done += 1
    model = Model(languages, table_ @ weights, bias)
    if len(held) >= 10:
        logits = np.stack([(c[:, None] * model.scores[b]).sum(axis=0) / c.sum() + bias for b, c in (texts[i] for i in held)])
        y = label[held]
        grid = np.exp(np.linspace(np.log(0.1), np.log(10), 41))

        def loss(t: float) -> float:
            z = logits / t
            z = z - z.max(axis=1, keepdims=True)
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())

        model.temperature = float(min(grid, key=loss))
        p = model.probabilities(logits)
        score, right = p.max(axis=1), p.argmax(axis=1) == y
        at = np.argsort(-score)
        precision = np.cumsum(right[at]) / np.arange(1, len(at) + 1)
        good = np.flatnonzero(precision >= PRECISION)
        model.bound = float(score[at][good[-1]]) if len(good) else 1.0
    return model


def train(docs: DataFrame) -> Model | None:
    """Learn from a bounded sample of ``docs`` (text, lang, draw): of each
    language, the share that gives PER_LANGUAGE texts, by the number ``draw``
    in [0, 1).  None without labelled texts."""
    docs = docs.where("lang is not null and text is not null")
    n = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not n:
        return None
    share = F.create_map(*(F.lit(x) for r in n for x in (r["lang"], min(1.0, PER_LANGUAGE / r["n"]))))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            rows: list[list] = [[] for _ in range(len(off) - 1)]
            for docs_, starts, d in pieces(data, off):
                for at, bucket in subwords(d):
                    edges = np.append(np.searchsorted(at, starts), len(at))
                    for k, i in enumerate(docs_.tolist()):
                        rows[i].append(bucket[edges[k]:edges[k + 1]])
            packed = []
            for r in rows:
                b, c = np.unique(np.concatenate(r) if r else np.zeros(0, np.int32), return_counts=True)
                packed.append(np.stack([b.astype(np.int32), c.astype(np.int32)]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], names=["lang", "draw", "f"])

    chosen = docs.where(F.col("draw") < F.try_element_at(share, F.col("lang")))
    rows = chosen.select("lang", "text", "draw").mapInArrow(take, "lang string, draw double, f binary").toPandas()
    rows = rows.sort_values(["draw", "lang", "f"], kind="stable")
    rows = rows[rows["f"].map(len) > 0]
    languages = sorted(rows["lang"].unique().tolist())
    if not languages:
        return None
    texts = [tuple(np.frombuffer(f, np.int32).reshape(2, -1)) for f in rows["f"]]
    return fit(texts, rows["lang"].map(languages.index).to_numpy(), languages)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) per row of ``docs`` (doc_id,
    text); accepted is False where the score is below the calibrated bound."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            off, data = utf8(batch.column(1))
            known = has_letter(data, off, batch.column(1))
            lang, score = np.full(len(known), "und", object), np.zeros(len(known))
            if model is not None and len(known):
                p = model.probabilities(model.logits(data, off))
                lang = np.where(known, np.array(model.languages, object)[p.argmax(axis=1)], "und")
                score = np.where(known, p.max(axis=1), 0.0)
            else:
                known = np.zeros(len(known), bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(known & (score >= (model.bound if model else 1)))], names=["doc_id", "lang_pred", "score", "accepted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, accepted boolean")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def held(doc_id: Column) -> Column:
        return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))

    draw = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)).alias("draw")
    model = train(docs.where(~held(F.col("doc_id"))).select("text", "lang", draw))
    return identify(docs, model).withColumn("held_out", held(F.col("doc_id")))
