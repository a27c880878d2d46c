"""A gated recurrent language model in numpy, with a class-factored output.

Tokens are words with A-Z in lower case, and one end per document. Counts cover all training documents. The ``FREQUENT`` most frequent
tokens have output vectors and are cut by frequency into classes of ``PER_CLASS``; all other words are in one of ``TAIL`` classes by the
hash of their last two bytes, and within such a class a word's probability is its smoothed share of the class's count in the corpus, so unseen
words have probability as well: P(word | history) = P(class | state) * P(word | class, state or counts).

Training is truncated backpropagation over windows of ``STEPS`` tokens with the state carried on, by Adam. It starts from the class and word
frequencies, warms up on a bounded number of documents in one task, and then each task takes all its training documents once, from there;
the tasks' parameters are averaged, weighted by tokens. Scoring carries the state across windows through the whole document; documents
run side by side. Texts are split and looked up once: each document's output ids are written, and training and scoring read those. The
model, and the counts of the ``TOP`` most frequent words, are broadcast, both of fixed size; the counts of all other words are joined.
The tasks' parameters are summed in a tree, one row a task.

Defined cases: a null or empty text is one end token; rows that repeat a doc_id are scored one by one and all learnt from; a row without doc_id is
learnt from; without training rows there is no vocabulary and every token is unseen; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize, tidy
from roadloom.llm.words import Words, mix, text_buffers, word_chunks, word_hashes

FREQUENT, PER_CLASS, TAIL, HIDDEN = 1024, 32, 16, 16
CLASSES = FREQUENT // PER_CLASS + TAIL
TOP = 1 << 18
STREAMS, STEPS = 512, 16
WARM_UP = 3000  # documents
RATE = 0.01
LEARN_CHUNK, SCORE_CHUNK = 1 << 17, 1 << 20  # tokens taken together
FAN_IN = 32
END = np.uint64(0)
HELD_OUT = (7, 2)
BEGIN = FREQUENT + TAIL  # the input before a document's first token
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def hashed(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, tail class, row, first of its document) of every token of a chunk, ends included, in order."""
    data = LOWER[w.data]
    words = word_hashes(w, data)
    words[words == END] = 1
    last = data[w.end - 1].astype(np.uint64) if len(w.start) else np.zeros(0, np.uint64)
    second = np.where(w.end - w.start > 1, data[np.maximum(w.end - 2, 0)], 0).astype(np.uint64) if len(w.start) else last
    tail = (mix(last * np.uint64(256) + second) % np.uint64(TAIL)).astype(np.int32)
    n = w.last - w.first
    count = w.count
    ends = np.cumsum(count) + np.arange(n)
    total = len(words) + n
    word_at = np.ones(total, bool)
    word_at[ends] = False
    out, cls, row, fresh = np.full(total, END), np.zeros(total, np.int32), np.empty(total, np.int64), np.zeros(total, bool)
    out[word_at], cls[word_at], row[word_at] = words, tail, w.row
    row[ends] = np.arange(n)
    fresh[ends - count] = True
    return out, cls, row, fresh


class Vocabulary(NamedTuple):
    hashes: np.ndarray  # of the TOP words, sorted
    counts: np.ndarray
    ids: np.ndarray  # of the FREQUENT ones, else -1
    tail_log: np.ndarray  # log10 of each tail class's count, words and one
    tokens: int
    distinct: int

    def look_up(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(output id, count or -1 when the word is not among the top ones)."""
        if not len(self.hashes):
            return (FREQUENT + cls).astype(np.int32), np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        ids = np.where(known, self.ids[at], -1)
        return np.where(ids >= 0, ids, FREQUENT + cls).astype(np.int32), np.where(known, self.counts[at], -1)


def _tame(weights: np.ndarray, bias: np.ndarray):
    """Whether logits of states within 1 are sure to lie between -60 and 60."""
    return (np.abs(weights).sum(-2) + np.abs(bias)).max(-1) < 59


class Net:
    """Parameters in one flat array, with views by name."""

    SHAPES = {
        "wx": (FREQUENT + TAIL + 1, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,),
        "ww": (FREQUENT // PER_CLASS, HIDDEN, PER_CLASS), "bw": (FREQUENT // PER_CLASS, PER_CLASS),
    }

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def zeros(cls) -> Net:
        return cls(np.zeros(sum(int(np.prod(s)) for s in cls.SHAPES.values()), np.float32))

    @classmethod
    def start(cls, counts: np.ndarray) -> Net:
        """From the counts of all outputs: the class and word frequencies, and small random weights."""
        net, rng = cls.zeros(), np.random.default_rng(11)
        for name in ("wx", "u", "wc", "ww"):
            view = getattr(net, name)
            view[...] = rng.standard_normal(view.shape) * (0.3 if name in ("wx", "u") else 0.05)
        net.wx[:, :HIDDEN] += 1  # a state that lasts
        words = counts[:FREQUENT].reshape(-1, PER_CLASS) + 0.5
        groups = np.concatenate([words.sum(1), counts[FREQUENT:] + 0.5])
        net.bc[...] = np.log(groups / groups.sum())
        net.bw[...] = np.log(words / words.sum(1, keepdims=True))
        return net

    def states(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool):
        """States after each of the steps of ``x`` (steps, streams); with ``keep`` also what the way back needs."""
        steps, n = x.shape
        # gate by gate, so that each lies in one piece; the gates' values take the place of what goes into them
        wx, u = (np.ascontiguousarray(w.reshape(-1, 3, HIDDEN).transpose(1, 0, 2)) for w in (self.wx, self.u))
        pre = np.take(wx, x, axis=1)
        out = np.empty((steps, n, HIDDEN), np.float32)
        inner, before = (np.empty((steps, n, HIDDEN), np.float32) for _ in range(2)) if keep else (None, None)
        begins = fresh.any(1)
        for t in range(steps):
            if begins[t]:
                h = np.where(fresh[t][:, None], np.float32(0), h)
            g = h @ u
            gates, c = pre[:2, t], pre[2, t]
            gates += g[:2]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.divide(1, gates, out=gates)
            z, r = gates
            if keep:
                inner[t], before[t] = g[2], h
            c += np.multiply(r, g[2], out=g[2])
            c *= -2
            np.exp(c, out=c)
            c += 1
            np.divide(2, c, out=c)
            c -= 1
            h = np.subtract(h, c, out=out[t])
            h *= z
            h += c
        return out, h, (*pre, inner, before)

    def outputs(self, h: np.ndarray, y: np.ndarray, grad: Net | None = None):
        """Natural log probability of each output (-1: none), and the states' gradients of the summed loss when ``grad`` is given."""
        cls = np.where(y < FREQUENT, y // PER_CLASS, y - FREQUENT + FREQUENT // PER_CLASS)
        logits = h @ self.wc
        logits += self.bc
        if not _tame(self.wc, self.bc):
            np.clip(logits, -60, 60, out=logits)
        at = np.arange(len(y))
        log_p = logits[at, cls]
        e = np.exp(logits, out=logits)
        total = e @ np.ones(CLASSES, e.dtype)
        log_p -= np.log(total)
        there = y >= 0
        back = None
        if grad is not None:
            d = np.divide(e, total[:, None], out=e)
            d[at, cls] -= 1
            if not there.all():
                d *= there[:, None]
            grad.wc += h.T @ d
            grad.bc += d.sum(0)
            back = d @ self.wc.T
        some = np.flatnonzero(there & (y < FREQUENT))
        some = some[np.argsort(cls[some].astype(np.int16), kind="stable")]  # 16 bits are sorted by digits
        cuts = np.searchsorted(cls[some], np.arange(FREQUENT // PER_CLASS + 1))
        groups = [(k, slice(cuts[k], cuts[k + 1])) for k in range(FREQUENT // PER_CLASS) if cuts[k] < cuts[k + 1]]
        tame = _tame(self.ww, self.bw)
        hs, word, at = h[some], y[some] % PER_CLASS, np.arange(len(some))
        logits = np.empty((len(some), PER_CLASS), hs.dtype)
        for k, i in groups:
            part = np.matmul(hs[i], self.ww[k], out=logits[i])
            part += self.bw[k]
            if not tame[k]:
                np.clip(part, -60, 60, out=part)
        own = logits[at, word]
        e = np.exp(logits, out=logits)
        ones, total = np.ones(PER_CLASS, e.dtype), np.empty(len(some), e.dtype)
        for _, i in groups:
            np.matmul(e[i], ones, out=total[i])
        log_p[some] += own - np.log(total)
        if grad is not None:
            d = np.divide(e, total[:, None], out=e)
            d[at, word] -= 1
            pull = np.empty_like(hs)
            for k, i in groups:
                grad.ww[k] += hs[i].T @ d[i]
                grad.bw[k] += d[i].sum(0)
                np.matmul(d[i], self.ww[k].T, out=pull[i])
            back[some] += pull
        log_p[~there] = 0
        return log_p, back

    def gradient(self, x, fresh, y, h0, grad: Net) -> np.ndarray:
        """Add the window's gradient to ``grad``; returns the state after it."""
        steps, n = x.shape
        out, h, (z, r, c, gc, before) = self.states(x, fresh, h0, True)
        _, back = self.outputs(out.reshape(-1, HIDDEN), y.reshape(-1), grad)
        back = back.reshape(steps, n, HIDDEN)
        dg, dc = np.empty((steps, n, 3 * HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
        inner = (1 - z) * (1 - c * c)
        dz_scale, dr_scale = (before - c) * z * (1 - z), gc * r * (1 - r)
        dh = np.zeros((n, HIDDEN), np.float32)
        ut = np.ascontiguousarray(self.u.T)
        for t in range(steps - 1, -1, -1):
            dh = dh + back[t]
            dac = np.multiply(dh, inner[t], out=dc[t])
            np.multiply(dh, dz_scale[t], out=dg[t, :, :HIDDEN])
            np.multiply(dac, dr_scale[t], out=dg[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(dac, r[t], out=dg[t, :, 2 * HIDDEN :])
            dh = dh * z[t] + dg[t] @ ut
            if fresh[t].any():
                dh[fresh[t]] = 0
        grad.u += before.reshape(-1, HIDDEN).T @ dg.reshape(-1, 3 * HIDDEN)
        da = dg
        da[:, :, 2 * HIDDEN :] = dc
        ids = x.reshape(-1).astype(np.int16)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        grad.wx[ids[first]] += np.add.reduceat(da.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        return h


class Trainer:
    """Adam on windows over parallel streams of tokens."""

    def __init__(self, net: Net, rate: float = RATE):
        self.net, self.rate, self.step, self.tokens = net, rate, 0, 0
        self.mean, self.square = np.zeros_like(net.flat), np.zeros_like(net.flat)

    def learn(self, y: np.ndarray, fresh: np.ndarray) -> None:
        """All tokens ``y`` once: cut into ``STREAMS`` stretches that run side by side."""
        if not len(y):
            return
        self.tokens += len(y)
        x = inputs(y, fresh)
        streams = min(STREAMS, max(1, len(y) // (2 * STEPS)))
        length = -(-len(y) // streams)
        place = np.arange(streams)[None, :] * length + np.arange(length)[:, None]
        there = place < len(y)
        place = np.minimum(place, len(y) - 1)
        h = np.zeros((streams, HIDDEN), np.float32)
        for t in range(0, length, STEPS):
            p, ok = place[t : t + STEPS], there[t : t + STEPS]
            grad = Net.zeros()
            h = self.net.gradient(x[p], fresh[p], np.where(ok, y[p], -1), h, grad)
            self._move(grad.flat / max(1, int(ok.sum())))

    def _move(self, g: np.ndarray) -> None:
        self.step += 1
        g *= min(1.0, 1.0 / max(float(np.sqrt((g * g).sum())), 1e-9))
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        size = self.rate * min(1.0, self.step / 10) * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        self.net.flat -= np.float32(size) * self.mean / (np.sqrt(self.square) + np.float32(1e-7))


def inputs(y: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """What goes in before each token: the token before it, or the begin of a document."""
    x = np.empty_like(y)
    x[1:] = y[:-1]
    x[fresh] = BEGIN
    return x


def document_scores(net: Net, y: np.ndarray, fresh: np.ndarray, streams: int = STREAMS, steps: int = 64) -> np.ndarray:
    """Natural log probability of every token; whole documents are laid end to end in streams of about equal length."""
    log_p = np.zeros(len(y))
    begin = np.flatnonzero(fresh)
    if not len(begin):
        return log_p
    length = np.diff(np.append(begin, len(y)))
    order = np.argsort(-length, kind="stable")
    streams = min(streams, len(begin))
    # longest first, there and back again over the streams
    turn = np.arange(len(order))
    lane = np.where((turn // streams) % 2 == 0, turn % streams, streams - 1 - turn % streams)
    by_lane = order[np.lexsort((turn, lane))]
    sizes = np.bincount(lane, length[order], streams).astype(np.int64)
    place = np.repeat(begin[by_lane] - np.concatenate([[0], np.cumsum(length[by_lane])[:-1]]), length[by_lane]) + np.arange(len(y))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    rank = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[rank], sizes[rank]
    x = inputs(y, fresh)
    h = np.zeros((streams, HIDDEN), np.float32)
    for t in range(0, int(sizes[0]), steps):
        n = int(np.searchsorted(-sizes, -t, "left"))
        at = t + np.arange(min(steps, int(sizes[0]) - t))[:, None]
        ok = at < sizes[None, :n]
        p = place[np.where(ok, starts[None, :n] + at, 0)]
        out, last, _ = net.states(x[p], fresh[p] & ok, h[:n], False)
        h = last
        got, _ = net.outputs(out.reshape(-1, HIDDEN), np.where(ok, y[p], -1).reshape(-1))
        log_p[p[ok]] = got.reshape(p.shape)[ok]
    return log_p


def held_out(doc_id):
    parts, remainder = HELD_OUT
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == remainder, F.lit(False))


def keep_freed() -> None:
    """Give one large array back at once: from then on glibc keeps up to twice its size for the arrays of the next window.

    Else each window's arrays go back to the system and are fetched again page by page, a fifth of the time of learning.
    """
    np.empty(31 << 20, np.uint8)  # glibc takes note of blocks of up to 32 MB; nothing is written to it


def _counts(batches):
    keep_freed()
    for batch in batches:
        for w in word_chunks(batch.column("text")):
            h, cls, _, _ = hashed(w)
            values, first, n = np.unique(h, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(cls[first]), pa.array(n)], names=["word", "tail", "n"])


def vocabulary(counts: DataFrame, top: int = TOP) -> tuple[Vocabulary, np.ndarray]:
    """The broadcast part of the counts, and the counts of the outputs."""
    level = F.floor(F.log2("n") * 64)
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("v")).collect(), reverse=True)  # at most 64 * 64
    held, least = 0, levels[0]["level"] + 1 if levels else 0
    for r in levels:
        held += r["v"]
        if held > top:
            break
        least = r["level"]
    # the words of whole levels of frequency, as many levels as hold at most ``top`` words
    best = counts.where(level >= least).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    totals = {int(r["tail"]): (int(r["n"]), int(r["v"])) for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    ids = np.full(len(best), -1)
    ids[:FREQUENT] = np.arange(min(FREQUENT, len(best)))
    n, tail = best["n"].to_numpy(np.int64), best["tail"].to_numpy(np.int64)
    outputs = np.zeros(FREQUENT + TAIL)
    outputs[: min(FREQUENT, len(best))] = n[:FREQUENT]
    logs = np.zeros(TAIL)
    for k in range(TAIL):
        mine = tail[:FREQUENT] == k
        words, kinds = totals.get(k, (0, 0))
        words, kinds = words - int(n[:FREQUENT][mine].sum()), kinds - int(mine.sum())
        outputs[FREQUENT + k] = words + 1
        logs[k] = np.log10(words + kinds + 1)
    hashes = best["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    found = Vocabulary(hashes[order], n[order], ids[order], logs, sum(a for a, _ in totals.values()), sum(b for _, b in totals.values()))
    return found, outputs


_TOKENS = "doc_id long, outputs binary, n_tokens long, n_known long, base_score double, tail_score double, rest array<long>"


def _encode(shared):
    """Per row: output ids as 16-bit numbers, what the counts say about the tokens, and the words whose counts are not among the top ones."""

    def run(batches):
        keep_freed()
        vocab = Vocabulary(*shared.value)
        base_rest = np.log10(vocab.tokens + vocab.distinct + 1)
        for batch in batches:
            for w in word_chunks(batch.column("text")):
                h, cls, row, _ = hashed(w)
                n = w.last - w.first
                y, c = vocab.look_up(h, cls)
                known, tail = c >= 0, y >= FREQUENT
                seen = np.log10(np.maximum(c, 0) + 1.0)
                tail_score = np.where(tail, seen - vocab.tail_log[np.where(tail, y - FREQUENT, 0)], 0)
                left = np.flatnonzero(~known)
                sizes = np.bincount(row, minlength=n)
                at, rest = (np.concatenate([[0], np.cumsum(k)]).astype(np.int32) for k in (2 * sizes, np.bincount(row[left], minlength=n)))
                outputs = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(y.astype(np.int16))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(w.first, n), outputs, pa.array(sizes), pa.array(np.bincount(row, known, n).astype(np.int64)),
                        pa.array(np.bincount(row, seen - base_rest, n)), pa.array(np.bincount(row, tail_score, n)),
                        pa.ListArray.from_arrays(pa.array(rest), pa.array(h[left].view(np.int64))),
                    ],
                    names=[c.split()[0] for c in _TOKENS.split(", ")],
                )

    return run


def _token_chunks(column: pa.Array, size: int):
    """(first row, last row, output ids, first of its document) of about ``size`` tokens; a document is never cut."""
    data, offsets = text_buffers(column)
    cuts = offsets // 2
    y = data[: 2 * cuts[-1]].view(np.int16) if len(data) else np.zeros(0, np.int16)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + size, "right")) - 1)
        fresh = np.zeros(cuts[last] - cuts[first], bool)
        fresh[cuts[first:last] - cuts[first]] = True
        yield first, last, y[cuts[first] : cuts[last]].astype(np.int32), fresh
        first = last


_MODEL = "weight double, flat binary"


def _learn(shared, passes: int):
    def run(batches):
        keep_freed()
        trainer = Trainer(Net(shared.value.copy()))
        for batch in batches:
            for _ in range(passes):
                for _, _, y, fresh in _token_chunks(batch.column("outputs"), LEARN_CHUNK):
                    trainer.learn(y, fresh)
        if trainer.tokens:
            yield _model(float(trainer.tokens), trainer.net.flat.astype(np.float64) * trainer.tokens)

    return run


def _model(weight: float, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([total.tobytes()], pa.binary())], names=["weight", "flat"])


def _summed(batches):
    weight, total = 0.0, None
    for batch in batches:
        for w, flat in zip(batch.column("weight").to_pylist(), batch.column("flat"), strict=True):
            part = np.frombuffer(flat.as_buffer(), np.float64)
            weight, total = weight + w, part.copy() if total is None else total + part
    if total is not None:
        yield _model(weight, total)


def _averaged(models: DataFrame, before: np.ndarray) -> np.ndarray:
    """The tasks' parameters as one, weighted by tokens; sums of ``FAN_IN`` rows until one is left."""
    level = materialize(models, "models")
    while (n := level.count()) > 1:
        level = materialize(level.repartition(-(-n // FAN_IN)).mapInArrow(tidy(_summed), _MODEL), "models")
    row = level.first()
    return (np.frombuffer(row.flat, np.float64) / row.weight).astype(np.float32) if row else before


def _score(shared):
    def run(batches):
        keep_freed()
        net = Net(shared.value)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, last, y, fresh in _token_chunks(batch.column("outputs"), SCORE_CHUNK):
                row = np.cumsum(fresh) - 1
                scores[first:last] = np.bincount(row, document_scores(net, y, fresh), last - first) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(scores)], names=["place", "own"])

    return run


def log_likelihood(docs: DataFrame, top: int = TOP, warm_up: int = WARM_UP) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learnt = rows.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    counts = materialize(
        learnt.select("text").mapInArrow(_counts, "word long, tail int, n long").groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n")), "counts"
    )
    vocab, outputs = vocabulary(counts, top)
    flat = Net.start(outputs).flat
    # the number of a row is written with its tokens, so it stays the same from here on
    tokens = materialize(
        rows.mapInArrow(tidy(_encode(context.broadcast(tuple(vocab)))), _TOKENS).withColumn("place", F.monotonically_increasing_id()), "tokens"
    )
    training = tokens.where(~held_out(F.col("doc_id")))
    if vocab.tokens:
        few = training.select("doc_id", "place").orderBy(F.xxhash64("doc_id"), "place").limit(warm_up).select("place")
        first = training.join(F.broadcast(few), "place").select("outputs")  # at most warm_up rows
        flat = _averaged(first.repartition(1).mapInArrow(tidy(_learn(context.broadcast(flat), 2)), _MODEL), flat)
        flat = _averaged(training.select("outputs").mapInArrow(tidy(_learn(context.broadcast(flat), 1)), _MODEL), flat)
    scored = materialize(tokens.select("place", "outputs").mapInArrow(tidy(_score(context.broadcast(flat))), "place long, own double"), "scores")
    rest = tokens.select("place", F.explode("rest").alias("word")).join(counts.select("word", "n"), "word")
    more = rest.groupBy("place").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("log"))
    log = F.coalesce("log", F.lit(0.0))
    return tokens.drop("rest", "outputs").join(scored, "place").join(more, "place", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + log).alias("base_score"), (F.col("own") + F.col("tail_score") + log).alias("score"),
    )
