"""Toxic spans by a linear-chain conditional random field.

Tokens are the letters of words, lower-cased (ASCII letters and every non-ASCII byte; other characters are left out); a chain is a
sentence. Features are hashed: the word, its first four and five bytes, its last four. Labels come with documents, so tokens are labelled
first: in a toxic document a token is toxic when its word or beginning is much more frequent in toxic documents, in the sample,
weighted as in all labelled rows. The field is trained on these tokens by Adagrad on the likelihood; expectations come from forward-backward.
Marginals are summed up per document (largest, logarithm of the sum, share) and calibrated by a logistic fit to the documents' labels.

The classifier is fitted on a bounded sample of the labelled training rows: the ``SAMPLE`` toxic and ``SAMPLE`` other ones that come first in the
order of a hash of doc_id. Every text is scored whole. Only text enters a score.

Defined cases: null, empty and wordless texts get the score of a document without any toxic token; rows that repeat a doc_id are scored
one by one; a row without doc_id is scored, not held out, and has no label; labels that are null or neither 0 nor 1 are not learnt from; without toxic or without other labelled rows every score is the share of
toxic rows; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.tables import tidy
from roadloom.llm.words import BASE, Words, _powers, mix, word_chunks

SAMPLE = 3000
BITS = 18
TEMPLATES = 4
EPOCHS = 8
CUT = 0.3
HELD_OUT = (4, 2)  # rows whose crc32 of doc_id as text leaves this remainder are never learnt from
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STOP = np.zeros(256, bool)
STOP[list(b".!?\n")] = True


class Tokens(NamedTuple):
    features: np.ndarray  # (tokens, TEMPLATES)
    words: np.ndarray  # 32-bit hashes of the word and of its first five and four bytes
    row: np.ndarray
    start: np.ndarray  # bytes in the chunk
    end: np.ndarray
    fresh: np.ndarray  # begins a sentence


def tokens(w: Words) -> Tokens:
    """The tokens of a chunk, with their hashed features."""
    keep = LETTER[w.data]
    letters = np.concatenate([[0], np.cumsum(keep)])
    a, b = letters[w.start], letters[w.end]
    some = np.flatnonzero(b > a)
    a, b, row, start, end = a[some], b[some], w.row[some], w.start[some], w.end[some]
    data = LOWER[w.data[keep]].astype(np.uint64) + np.uint64(1)
    power, inverse = _powers(len(data) + 2)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * power[: len(data)])])
    size = b - a

    def piece(x, y):
        return mix((total[y] - total[x]) * inverse[x] + (y - x).astype(np.uint64))

    word, five, four, tail = piece(a, b), piece(a, a + np.minimum(size, 5)), piece(a, a + np.minimum(size, 4)), piece(b - np.minimum(size, 4), b)
    salt = [np.uint64(x) * BASE for x in range(1, TEMPLATES + 1)]
    features = np.stack([(mix(h ^ s) >> np.uint64(64 - BITS)).astype(np.int32) for h, s in zip((word, five, four, tail), salt, strict=True)], axis=1)
    stops = np.concatenate([[0], np.cumsum(STOP[w.data])])
    fresh = np.ones(len(row), bool)
    if len(row) > 1:
        fresh[1:] = (row[1:] != row[:-1]) | (stops[start[1:]] > stops[np.maximum(end[:-1] - 1, start[:-1])])
    return Tokens(features, np.stack([(h >> np.uint64(32)).astype(np.uint32) for h in (word, five ^ salt[1], four ^ salt[2])], axis=1), row, start, end, fresh)


def forward_backward(s: np.ndarray, fresh: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the toxic state given what is before and at a token, and given what is after it.

    ``s`` is the emission's log odds, ``t[i, j]`` the log potential from state i to j; the chains are run side by side, longest first.
    """
    e = np.exp(t)
    begin = np.flatnonzero(fresh)
    length = np.diff(np.append(begin, len(s)))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    ahead, back = s.copy(), np.zeros_like(s)
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps) - 1, "right")
    for k in range(1, steps):
        at = begin[: alive[k]] + k
        r = np.exp(np.clip(ahead[at - 1], -40, 40))
        ahead[at] += np.log((e[0, 1] + e[1, 1] * r) / (e[0, 0] + e[1, 0] * r))
    for k in range(2, steps + 1):
        n = alive[k - 1]
        at = begin[:n] + length[:n] - k
        u = np.exp(np.clip(s[at + 1] + back[at + 1], -40, 40))
        back[at] = np.log((e[1, 0] + e[1, 1] * u) / (e[0, 0] + e[0, 1] * u))
    return ahead, back


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Model(NamedTuple):
    weights: np.ndarray  # (TEMPLATES, 2**BITS)
    bias: float
    moves: np.ndarray  # (2, 2)
    calibration: np.ndarray

    def marginals(self, x: Tokens) -> np.ndarray:
        s = self.emissions(x.features)
        ahead, back = forward_backward(s, x.fresh, self.moves)
        return sigmoid(ahead + back)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        s = np.full(len(features), self.bias)
        for k in range(TEMPLATES):
            s += self.weights[k, features[:, k]]
        return s

    def scores(self, sums: np.ndarray) -> np.ndarray:
        return sigmoid(sums @ self.calibration)


def summaries(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Per document: one, largest marginal, logarithm of the sum, share of the tokens."""
    most = np.zeros(n)
    np.maximum.at(most, row, p)
    total = np.bincount(row, p, n)
    return np.stack([np.ones(n), most, np.log1p(total), total / np.maximum(np.bincount(row, minlength=n), 1)], axis=1)


def label_tokens(words: np.ndarray, row: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which tokens of toxic documents are toxic: those with a form that half of its documents' weight speaks for,
    and that is in more toxic documents of the sample than chance explains (one form in all by Chernoff's bound)."""
    share = toxic.mean()
    marked = np.zeros(len(row), bool)
    for k in range(words.shape[1]):
        values, place = np.unique(words[:, k], return_inverse=True)
        pairs = np.unique(place.astype(np.int64) * len(toxic) + row)
        form, doc = pairs // len(toxic), pairs % len(toxic)
        yes = np.bincount(form, toxic[doc], len(values))
        every = np.bincount(form, weight[doc], len(values))
        n = np.bincount(form, minlength=len(values))
        rate = yes / np.maximum(n, 1)
        other = np.clip(1 - rate, 1e-12, 1)
        surprise = n * (rate * np.log(np.maximum(rate, 1e-12) / share) + (1 - rate) * np.log(other / (1 - share)))
        marked |= ((rate > share) & (surprise >= np.log(len(values) + 1)) & (yes >= 0.5 * every))[place]
    return marked & (toxic[row] > 0)


def _field(parts: list[Tokens], marked: list[np.ndarray], epochs: int, rate: float = 0.3) -> Model:
    """Fit emissions and moves to labelled tokens; one part is one step."""
    weights, bias, moves = np.zeros((TEMPLATES, 1 << BITS)), -4.0, np.zeros((2, 2))
    squares = [np.full_like(weights, 1e-3), 1.0, np.ones((2, 2))]
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(parts)):
            x, y = parts[i], marked[i]
            if not len(x.row):
                continue
            s = Model(weights, bias, moves, np.zeros(4)).emissions(x.features)
            ahead, back = forward_backward(s, x.fresh, moves)
            p = sigmoid(ahead + back)
            residual = (y - p) * np.where(y, 1.0, 0.2 + 0.8 * p)  # plain tokens that are never in doubt weigh little
            n = len(p)
            for k in range(TEMPLATES):
                g = np.bincount(x.features[:, k], residual, 1 << BITS) - 1e-3 * weights[k]
                squares[0][k] += g * g
                weights[k] += rate * g / np.sqrt(squares[0][k])
            g = residual.sum() / n
            squares[1] += g * g
            bias += rate * g / np.sqrt(squares[1])
            later = np.flatnonzero(~x.fresh)
            both = np.stack([(i * ahead[later - 1] + moves[i, j] + j * (s[later] + back[later])) for i in (0, 1) for j in (0, 1)])
            both = np.exp(both - both.max(0))
            expected = (both / both.sum(0)).sum(1).reshape(2, 2)
            seen = np.bincount(2 * y[later - 1] + y[later], minlength=4).reshape(2, 2)
            g = (seen - expected) / n
            squares[2] += g * g
            moves = moves + rate * g / np.sqrt(squares[2])
    return Model(weights, bias, moves, np.zeros(4))


def train(texts: list[str], toxic: np.ndarray, prior: float, epochs: int = EPOCHS, folds: int = 2) -> Model:
    """Fit field and calibration; ``prior`` is the share of toxic rows among all labelled training rows.

    The calibration sees each document as scored by a field, and by token labels, that were made without it.
    """
    base = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    if not 0 < toxic.sum() < len(toxic):
        return Model(np.zeros((TEMPLATES, 1 << BITS)), -4.0, np.zeros((2, 2)), np.array([base, 0, 0, 0]))
    toxic = toxic.astype(float)
    weight = np.where(toxic > 0, 1.0, (1 - prior) / prior * toxic.sum() / (len(toxic) - toxic.sum()))

    def fitted(which: np.ndarray) -> Model:
        column = pa.array([texts[i] for i in which], pa.large_string())
        parts = [(w.first, tokens(w)) for w in word_chunks(column, 1 << 18)]
        words, row = np.concatenate([p.words for _, p in parts]), np.concatenate([p.row + first for first, p in parts])
        marked = label_tokens(words, row, toxic[which], weight[which])
        parts = [(first, p._replace(words=None)) for first, p in parts]
        del words, row
        cuts = np.cumsum([0] + [len(p.row) for _, p in parts])
        return _field([p for _, p in parts], [marked[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], epochs)

    sums = np.zeros((len(texts), 4))
    fold = (np.cumsum(toxic) * toxic + np.cumsum(1 - toxic) * (1 - toxic)).astype(int) % folds
    for k in range(folds):
        learnt, rest = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if not 0 < toxic[learnt].sum() < len(learnt) or not len(rest):
            return Model(np.zeros((TEMPLATES, 1 << BITS)), -4.0, np.zeros((2, 2)), np.array([base, 0, 0, 0]))
        model = fitted(learnt)
        for w in word_chunks(pa.array([texts[i] for i in rest], pa.large_string())):
            x = tokens(w)
            sums[rest[w.first : w.last]] = summaries(model.marginals(x), x.row, w.last - w.first)
    return fitted(np.arange(len(texts)))._replace(calibration=_logistic(sums, toxic, weight))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    loss = lambda b: -(weight * (y * (x @ b) - np.logaddexp(0, x @ b))).sum() + (keep * b * b).sum() / 2
    for _ in range(50):
        p = sigmoid(x @ b)
        grad = x.T @ (weight * (y - p)) - keep * b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(keep), grad)
        size = 1.0
        while size > 1e-4 and loss(b + size * step) > loss(b):
            size /= 2
        b = b + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return b


def held_out(doc_id):
    """Whether the row is kept from learning."""
    parts, remainder = HELD_OUT
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == remainder, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the labelled rows that are not held out; at most ``2 * sample`` texts reach the one task that trains."""
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learnt = labelled.where(~held_out(F.col("doc_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = {r[0]: r[1] for r in learnt.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    order = F.xxhash64("doc_id", F.lit(9))
    chosen = [learnt.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(sample) for k in (0, 1)]
    rows = texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")  # at most 2 * sample ids

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = train([x or "" for x in t.column("text").to_pylist()], t.column("toxic").to_numpy().astype(np.int64), prior)
        small = np.concatenate([[model.bias], model.moves.ravel(), model.calibration])
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()), pa.array([small.tobytes()], pa.binary())], names=["weights", "small"])

    found = rows.dropDuplicates(["doc_id", "text"]).repartition(1).mapInArrow(tidy(run), "weights binary, small binary").collect()
    if not found:
        return Model(np.zeros((TEMPLATES, 1 << BITS), np.float32), -4.0, np.zeros((2, 2)), np.array([np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)), 0, 0, 0]))
    small = np.frombuffer(bytes(found[0]["small"]))
    return Model(np.frombuffer(bytes(found[0]["weights"]), np.float32).reshape(TEMPLATES, -1), float(small[0]), small[1:5].reshape(2, 2), small[5:])


def score(docs: DataFrame, model: Model, cut: float = 0.5) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, score and the offending ``spans`` (start, end in code points, marginal)."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        m = Model(*shared.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
        for batch in batches:
            for w in word_chunks(batch.column("text")):
                n = w.last - w.first
                x = tokens(w)
                p = m.marginals(x)
                spans: list[list] = [[] for _ in range(n)]
                hot = np.flatnonzero(p >= cut)
                if len(hot):
                    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
                    first = np.concatenate([[0], np.cumsum(w.sizes)])
                    for i in hot:
                        zero = points[first[x.row[i]]]
                        spans[x.row[i]].append({"start": int(points[x.start[i]] - zero), "end": int(points[x.end[i]] - zero), "marginal": float(p[i])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(w.first, n), pa.array(m.scores(summaries(p, x.row, n))), pa.array(spans, kind)], names=["doc_id", "score", "spans"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, score double, spans array<struct<start:long,end:long,marginal:double>>")


def report(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"),
        F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))).alias("spans"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` (any columns) that score below ``cut``."""
    spark = docs.sparkSession
    model = fit(docs, labels)
    shared = spark.sparkContext.broadcast(tuple(model))

    def run(batches):
        m = Model(*shared.value)
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for w in word_chunks(batch.column("text")):
                x = tokens(w)
                keep[w.first : w.last] = m.scores(summaries(m.marginals(x), x.row, w.last - w.first)) < cut
            yield batch.filter(pa.array(keep))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(tidy(run), docs.withColumn("text", F.col("text").cast("string")).schema)
