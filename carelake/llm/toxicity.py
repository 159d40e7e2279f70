"""Toxicity by a linear-chain conditional random field.

Tokens (runs of ASCII letters, digits and non-ASCII characters, A-Z as a-z)
have two tags, toxic or not.  A token's score adds the weights of its hashed
word and prefixes; transitions tie neighbours together.  Document labels are
turned into token tags first: in a toxic document, tokens with a feature that
toxic documents hold far more often than clean ones are toxic.  The field is
trained on a bounded sample by stochastic gradients of its exact likelihood
(forward-backward), and the tokens' marginals are pooled to a document score
by a logistic fit on documents it wasn't trained on.

Scoring streams over Arrow batches; forward and backward messages are computed
for all documents of a block at once, in chunks whose transfer matrices are
chained, so a long document costs no more than many short ones.

Cases: null, empty and wordless texts get the score of no toxic token; labels
without a document, or null, are ignored; with one class of labels only, all
scores are that class's share; repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import _BYTE, U64, _powers, blocks, mix, table, utf8, words

#: bounds of the training sample: documents of either class, words of a document
MAX_TOXIC, MAX_CLEAN, MAX_WORDS = 2000, 4000, 5000
#: hash buckets per kind of feature; prefixes in bytes
BUCKETS, PREFIXES = 1 << 19, (4, 5, 6)
CHUNK = 32
GAP = np.zeros(256, bool)
GAP[:128] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    GAP[_a:_b] = False


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, tokens per document, and feature ids (tokens, kinds)."""
    s, e, n = words(data, off, GAP)
    d = data[off[0]:off[-1]]
    with np.errstate(over="ignore"):
        total = np.empty(len(d) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[d] * _powers("f", len(d) + 1)[:len(d)], out=total[1:])
        back = _powers("b", len(d) + 1)[s]
        out = np.empty((len(s), 1 + len(PREFIXES)), np.int32)
        for f, upto in enumerate((1 << 40, *PREFIXES)):
            end = np.minimum(e, s + upto)
            h = mix((total[end] - total[s]) * back + (end - s).astype(np.uint64) + U64(f << 20))
            out[:, f] = (h & U64(BUCKETS - 1)).astype(np.int32) + f * BUCKETS
    return s, e, n, out


def _scan(p: np.ndarray, q: np.ndarray, u: np.ndarray, v: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """x_t = (p_t x_{t-1} + q_t) / (u_t x_{t-1} + v_t) along each document;
    the first step of a document ignores what goes in."""
    have = lengths[lengths > 0]
    if not len(have):
        return np.zeros(0)
    chunks = -(-have // CHUNK)
    starts = np.concatenate(([0], np.cumsum(have)[:-1]))
    first = np.concatenate(([0], np.cumsum(chunks)[:-1]))
    nth = np.arange(chunks.sum()) - np.repeat(first, chunks)
    at = np.repeat(starts, chunks)[:, None] + nth[:, None] * CHUNK + np.arange(CHUNK)
    real = at < np.repeat(starts + have, chunks)[:, None]
    at = np.where(real, at, 0)
    P, Q, U, V = (np.where(real, x[at], y).T.copy() for x, y in ((p, 1.0), (q, 0.0), (u, 0.0), (v, 1.0)))
    m = [np.ones(len(nth)), np.zeros(len(nth)), np.zeros(len(nth)), np.ones(len(nth))]
    for k in range(CHUNK):
        m = [P[k] * m[0] + Q[k] * m[2], P[k] * m[1] + Q[k] * m[3], U[k] * m[0] + V[k] * m[2], U[k] * m[1] + V[k] * m[3]]
        scale = 1 / (m[0] + m[1] + m[2] + m[3])
        m = [x * scale for x in m]
    x_in = np.ones(len(nth))
    order = np.argsort(-chunks, kind="stable")
    x, many = np.ones(len(have)), chunks[order]
    for j in range(int(many[0])):
        docs = order[:np.searchsorted(-many, -j, side="left")]
        c = first[docs] + j
        x_in[c] = x[docs]
        x[docs] = (m[0][c] * x[docs] + m[1][c]) / (m[2][c] * x[docs] + m[3][c])
    out, x = np.empty((CHUNK, len(nth))), x_in
    for k in range(CHUNK):
        x = (P[k] * x + Q[k]) / (U[k] * x + V[k])
        out[k] = x
    return out.T[real]


def marginals(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of the toxic tag per token, and the forward and backward
    odds.  ``score``: log odds a token adds; ``trans``: exp of the transition
    weights (from, to); ``start``: log odds of the first tag."""
    e = np.exp(np.clip(score, -30, 30))
    lead = np.zeros(len(e), bool)
    ends = np.cumsum(lengths)[lengths > 0]
    lead[np.concatenate(([0], ends[:-1]))[:len(ends)]] = True
    forward = _scan(np.where(lead, 0.0, e * trans[1, 1]), np.where(lead, e * np.exp(start), e * trans[0, 1]),
                    np.where(lead, 0.0, trans[1, 0]), np.where(lead, 1.0, trans[0, 0]), lengths)
    nxt = np.append(e[1:], 1.0)
    last = np.zeros(len(e), bool)
    last[ends - 1] = True
    r = lambda a: a[::-1]
    backward = r(_scan(r(np.where(last, 0.0, nxt * trans[1, 1])), r(np.where(last, 1.0, trans[1, 0])),
                       r(np.where(last, 0.0, nxt * trans[0, 1])), r(np.where(last, 1.0, trans[0, 0])), lengths[::-1]))
    odds = forward * backward
    return odds / (1 + odds), forward, backward


class Field:
    """Weights of the field and of the pooling."""

    def __init__(self) -> None:
        self.weights = np.zeros(BUCKETS * (1 + len(PREFIXES)), np.float32)
        self.trans = np.zeros((2, 2))
        self.start = self.bias = 0.0
        self.pool = np.zeros(3)

    def tags(self, feats: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        score = self.weights[feats].sum(axis=1, dtype=np.float64) + self.bias
        return marginals(score, lengths, np.exp(self.trans), self.start)

    def pooled(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per document: 1, log of one plus the expected toxic tokens (of those not clearly clean), the largest marginal."""
        out = np.zeros((len(lengths), 3))
        out[:, 0] = 1
        have = lengths > 0
        if have.any():
            at = np.concatenate(([0], np.cumsum(lengths[have])[:-1]))
            out[have, 1] = np.log1p(np.add.reduceat(np.where(p > 0.1, p, 0), at))
            out[have, 2] = np.maximum.reduceat(p, at)
        return out

    def scores(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.pooled(p, lengths) @ self.pool, -30, 30)))


def token_tags(feats: list[np.ndarray], label: np.ndarray) -> list[np.ndarray]:
    """Tags of the tokens of toxic documents, from how often their features
    are in toxic and in clean documents; 0 in clean ones."""
    count = np.zeros((2, BUCKETS * (1 + len(PREFIXES))), np.float32)
    for f, y in zip(feats, label):
        count[y, np.unique(f)] += 1
    n = np.maximum(np.bincount(label, minlength=2), 1)
    rate = n[1] / n.sum()
    seen = count.sum(axis=0)
    share = np.clip(count[1].astype(np.float64) / np.maximum(seen, 1), 1e-9, 1 - 1e-9)
    # log of the chance (Chernoff) that a feature that tells nothing is in so many toxic documents, for all features at once
    chance = seen * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))
    telling = (share > rate) & (share > 0.5) & (count[1] >= 3) & (chance > np.log(max(2, (seen >= 3).sum())) + 1)
    # two kinds of feature must agree: one alone may be a collision of hashes
    return [(telling[f].sum(axis=1) >= 2).astype(np.int8) if y else np.zeros(len(f), np.int8) for f, y in zip(feats, label)]


def distinct(feats: list[np.ndarray], k: int = 5) -> list[int]:
    """Positions of documents that aren't copies or near copies of earlier
    ones (two of four minimum hashes of their word runs agree); the words of
    one much copied document would seem to tell."""
    seen: list[dict[int, int]] = [{} for _ in range(4)]
    kept = []
    for i, f in enumerate(feats):
        w = mix(f[:, 0].astype(np.uint64))
        with np.errstate(over="ignore"):
            runs = sum(w[m:len(w) - min(k, len(w)) + 1 + m] * U64(2 * m * m + 6 * m + 1) for m in range(min(k, len(w)))) if len(w) else w
        low = [int(mix(runs ^ U64(s)).min()) if len(w) else s for s in range(4)]
        like = [t[h] for t, h in zip(seen, low) if h in t]
        if len(like) == len(set(like)):
            kept.append(i)
            for t, h in zip(seen, low):
                t.setdefault(h, i)
    return kept


def fit(feats: list[np.ndarray], label: np.ndarray, epochs: int = 5, rate: float = 0.3, decay: float = 1e-6) -> Field:
    """Train on documents (their feature ids, and 0 or 1 each)."""
    model, rng = Field(), np.random.default_rng(7)
    kept = distinct(feats)
    feats, label = [feats[i] for i in kept], label[kept]
    share = (label.sum() + 0.5) / (len(label) + 1)
    model.pool[0] = np.log(share / (1 - share))
    if len(set(label.tolist())) < 2:
        return model
    held = np.zeros(len(label), bool)
    held[rng.permutation(len(label))[:len(label) // 4]] = True
    tags = token_tags([f for f, h in zip(feats, held) if not h], label[~held])
    train = [(f, t) for (f, h), t in zip([(f, h) for f, h in zip(feats, held) if not h], tags) if len(f)]
    model.bias = -4.0
    seen, seen_t, seen_b = np.full(len(model.weights), 1e-6, np.float32), np.full((2, 2), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(train))
        for s in range(0, len(order), 32):
            part = [train[i] for i in order[s:s + 32]]
            f, y = np.concatenate([x for x, _ in part]), np.concatenate([t for _, t in part])
            lengths = np.array([len(t) for _, t in part])
            p, forward, backward = model.tags(f, lengths)
            diff = p - y
            ids, at = np.unique(f, return_inverse=True)
            grad = np.bincount(at.ravel(), np.repeat(diff, f.shape[1])).astype(np.float32) + decay * model.weights[ids]
            inner = np.ones(len(y) - 1, bool)
            inner[np.cumsum(lengths)[:-1] - 1] = False
            a, b = forward[:-1][inner], (np.exp(np.clip(model.weights[f].sum(axis=1, dtype=np.float64) + model.bias, -30, 30)) * backward)[1:][inner]
            t = np.exp(model.trans)
            pair = np.stack([np.full(len(a), t[0, 0]), t[0, 1] * b, t[1, 0] * a, t[1, 1] * a * b])
            got = (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)
            want = np.bincount(2 * y[:-1][inner].astype(int) + y[1:][inner], minlength=4).reshape(2, 2)
            g_t, g_b = got - want, float(diff.sum())
            seen[ids] += grad**2
            seen_t += g_t**2
            seen_b += g_b**2
            model.weights[ids] -= rate * grad / np.sqrt(seen[ids])
            model.trans -= 0.1 * g_t / np.sqrt(seen_t)
            model.bias -= 0.1 * g_b / np.sqrt(seen_b)
            model.start = model.trans[0, 1] - model.trans[0, 0]
    # pooling: logistic regression by Newton steps on the documents held back
    own = [f for f, h in zip(feats, held) if h]
    lengths = np.array([len(f) for f in own])
    p = model.tags(np.concatenate(own), lengths)[0] if lengths.sum() else np.zeros(0)
    x, y = model.pooled(p, lengths), label[held]
    # pseudo documents keep the fit finite when the classes separate
    x, y = np.concatenate((x, [[1, 0, 0], [1, 0, 0], [1, 1, 1], [1, 1, 1]])), np.concatenate((y, [0, 1, 0, 1]))
    w = np.concatenate((np.ones(len(own)), [1, 0.02, 0.02, 1]))
    beta = np.zeros(3)
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (w * s * (1 - s))[:, None]).T @ x + 0.01 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (w * (y - s)) - 0.01 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    model.pool = beta
    return model


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit on a bounded sample of the labelled rows of ``docs`` (doc_id, text);
    ``labels``: (doc_id, toxic).  The sample is by a hash of the id."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    least = {y: min(1.0, most / max(1, n.get(y, 0))) for y, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(F.when(F.col("toxic") == 1, draw < least[1]).otherwise(draw < least[0]))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = utf8(batch.column(1))
            for i, j in blocks(off):
                _, _, n, f = features(data, off[i:j + 1])
                cut = np.split(f, np.cumsum(n)[:-1])
                ok = [k for k, x in enumerate(cut) if len(x) <= MAX_WORDS]
                part = batch.slice(i, j - i).take(pa.array(ok, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([cut[k].tobytes() for k in ok], pa.binary())],
                                                 names=["doc_id", "toxic", "f"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(take, "doc_id long, toxic int, f binary").toPandas()
    rows = rows.sort_values(["doc_id", "f"], kind="stable").iloc[:2 * (MAX_TOXIC + MAX_CLEAN)]
    feats = [np.frombuffer(x, np.int32).reshape(-1, 1 + len(PREFIXES)) for x in rows["f"]]
    return fit(feats, rows["toxic"].to_numpy(np.int64))


def _judge(col: pa.Array, model: Field) -> tuple[np.ndarray, list[str]]:
    """Scores and offending spans (start:end in code points, comma-joined)."""
    off, data = utf8(col)
    scores, spans = [], []
    for i, j in blocks(off):
        o = off[i:j + 1]
        s, e, n, f = features(data, o)
        p = model.tags(f, n)[0] if len(f) else np.zeros(0)
        scores.append(model.scores(p, n))
        bad = np.flatnonzero(p > 0.5)
        found = [""] * (j - i)
        if len(bad):
            ends = np.cumsum(n)
            breaks = np.flatnonzero((np.diff(bad) > 1) | (np.diff(np.searchsorted(ends, bad, side="right")) > 0))
            lo, hi = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(bad) - 1]))
            chars = np.concatenate(([0], np.cumsum((data[o[0]:o[-1]] & 0xC0) != 0x80)))
            of = np.searchsorted(ends, bad[lo], side="right")
            base = chars[o[of] - o[0]]
            for d, a, b in zip(of.tolist(), (chars[s[bad[lo]]] - base).tolist(), (chars[e[bad[hi]]] - base).tolist()):
                found[d] += f",{a}:{b}" if found[d] else f"{a}:{b}"
        spans += found
    return (np.concatenate(scores) if scores else np.zeros(0)), spans


def toxicity(docs: DataFrame, model: Field) -> DataFrame:
    """(doc_id, score, spans) per row of ``docs``: the document's score and
    the offsets of its toxic spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, spans = _judge(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(spans, pa.string())],
                                             names=["doc_id", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, spans string")


def keep_clean(docs: DataFrame, model: Field) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judge(batch.column(at), shared.value)[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")) % 5 == 0, F.lit(False))
    model = train(docs, table(spark, sf_dir, "labels").where(~held("doc_id")))
    return toxicity(docs, model).select("doc_id", held("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
