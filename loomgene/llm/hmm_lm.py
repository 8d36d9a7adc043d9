"""Hidden Markov language model, trained by Baum-Welch counts that Spark adds up over partitions.

Words are counted over all training texts in Spark. The OWN_CLASSES most frequent words are
classes of their own; every other word, known or not, belongs to a class by the hash of its
last characters. States emit classes, and a class emits its words in proportion to their
counts (plus ALPHA, and ALPHA for all words not seen), so the probabilities of all tokens
add up to one, the matrices have a fixed size and counts of words stay distributed: of their
table only words above a threshold, HEAD_WORDS at most, are broadcast; counts of all other
words of a text come by a join.

Baum-Welch runs over all training tokens in every iteration; texts are cut into sequences of
at most SEQUENCE tokens for that. Scores come from the scaled forward recursion over whole
texts; one of more than LONG tokens goes through it in segments of SEGMENT side by side, from
every state at once, whose matrices are then multiplied in order. Base scores are add-ALPHA unigrams.

Empty table: no rows. Only the columns doc_id, held_out and text are read. Null text: empty, the end token alone. A null doc_id is not held out. Rows are scored one by
one, whatever their doc_id. Without training texts every count is 0. A text of 100 MB takes
about five bytes a byte while its words are hashed, and two bytes and 6 * 8 bytes / SEGMENT a token to score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

ALPHA = 0.1
STATES, ITERATIONS, SEQUENCE = 6, 4, 512
OWN_CLASSES, SUFFIX_CLASSES = 4095, 4096
CLASSES = OWN_CLASSES + SUFFIX_CLASSES + 1
END = CLASSES - 1
HEAD_WORDS = 1 << 20
LONG, SEGMENT = 65_536, 4096
_SUFFIX_BYTES = 3
_U = np.uint64
_CHUNK = 256


def suffix_class(w: blocks.Words) -> np.ndarray:
    """A class by the last bytes and whether the word is longer than them."""
    n = w.ends - w.starts
    h = np.minimum(n, _SUFFIX_BYTES + 1).astype(_U)
    for j in range(1, _SUFFIX_BYTES + 1):
        h = h * _U(257) + np.where(n >= j, w.buf[np.maximum(w.ends - j, 0)], 0).astype(_U)
    return (blocks.mix(h) % _U(SUFFIX_CLASSES)).astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each block with their counts; a block is hashed part by part, so memory follows the parts."""
    for b in blocks.slices(batches, limit=8 * blocks.BLOCK_BYTES):
        parts = []
        for part in blocks.slices([b]):
            w = blocks.Words(part.column(0), blocks.SPACED, lower=True)
            h, first, n = np.unique(w.hashes, return_index=True, return_counts=True)
            parts.append((h, suffix_class(w)[first], n))
        h, s, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        h, first, inv = np.unique(h, return_index=True, return_inverse=True)
        n = np.bincount(inv, weights=n, minlength=len(h)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(s[first]), pa.array(n)], names=["h", "s", "n"])


class Vocabulary:
    """What tasks need of the counts: frequent words, classes of their own, and sums of the suffix classes."""

    def __init__(self, counts: DataFrame, ends: int):
        total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.total, self.types, self.ends = total + ends, types + (ends > 0), ends
        self.norm = self.total + ALPHA * (self.types + 1)
        level = F.floor(4 * F.log2("n")).cast("int")
        levels = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)  # a few hundred rows
        room, self.least = HEAD_WORDS, 1 << 62
        for k, n in levels:
            if n > room:
                break
            room, self.least = room - n, k
        head = counts.where(level >= self.least).select("h", "n").toArrow()
        h, n = head.column(0).to_numpy().view(_U), head.column(1).to_numpy()
        self.tail = counts.where(level < self.least).select("h", "n")
        top = counts.orderBy(F.desc("n"), "h").limit(OWN_CLASSES).select("h", "s", "n").toArrow()  # a top-k of fixed size
        own = top.column(0).to_numpy().view(_U)
        # words with a class of their own are looked up in the head even if it was cut above them: the tail would count them twice
        apart = ~np.isin(own, h)
        h, n = np.append(h, own[apart]), np.append(n, top.column(2).to_numpy()[apart])
        order = np.argsort(h)
        self.h, self.n = h[order], n[order]
        order = np.argsort(own)
        self.own, self.own_class = own[order], order.astype(np.int32)
        self.class_n = np.zeros(CLASSES)
        self.class_n[: len(own)] = top.column(2).to_numpy()
        seen, kinds = np.zeros(SUFFIX_CLASSES), np.zeros(SUFFIX_CLASSES)
        for s, a, b in counts.groupBy("s").agg(F.sum("n"), F.count("*")).collect():  # SUFFIX_CLASSES rows
            seen[s], kinds[s] = a, b
        np.subtract.at(seen, top.column(1).to_numpy(), top.column(2).to_numpy())
        np.subtract.at(kinds, top.column(1).to_numpy(), 1)
        self.class_n[OWN_CLASSES:END] = seen
        self.class_n[END] = ends
        #: log10 of what turns a unigram probability into one given the suffix class
        self.within = np.log10(self.norm) - np.log10(seen + ALPHA * (kinds + 1))

    def shared(self) -> dict:
        return {k: getattr(self, k) for k in ("h", "n", "own", "own_class", "within", "norm", "ends")}


def _look_up(keys: np.ndarray, values: np.ndarray, want: np.ndarray, none) -> np.ndarray:
    if not len(keys):
        return np.full(len(want), none, values.dtype)
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return np.where(keys[at] == want, values[at], none)


_ENCODED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, base double, known bigint, rest double, classes binary, tail array<struct<h:bigint,m:bigint>>"


def _encode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    v, row = shared.value, TaskContext.get().partitionId() << 40
    end, none = math.log10((v["ends"] + ALPHA) / v["norm"]), math.log10(ALPHA / v["norm"])
    for b in blocks.slices(batches):
        w = blocks.Words(b.column(2), blocks.SPACED, lower=True)
        h, inv = np.unique(w.hashes, return_inverse=True)  # each word of the block is looked up once
        n = _look_up(v["h"], v["n"], h, 0)[inv]
        own = _look_up(v["own"], v["own_class"], h, -1)[inv]
        s = suffix_class(w)
        head = n > 0
        logs = np.where(head, np.log10((n + ALPHA) / v["norm"]), none)  # words outside the head as if they had no count
        base = blocks.sums_by(w.first, logs) + end
        known = blocks.sums_by(w.first, head) + (v["ends"] > 0)
        # own classes give their word for certain; of other words the share in their class is due
        rest = blocks.sums_by(w.first, np.where(own >= 0, 0.0, v["within"][s] + logs))
        classes = np.where(own >= 0, own, OWN_CLASSES + s).astype(np.uint16)
        codes = [np.append(classes[a:z], np.uint16(END)).tobytes() for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
        # of the other words each one once a row, with how often it is there
        other = np.flatnonzero(~head)
        pair, many = np.unique(np.stack([w.doc[other].astype(np.int64), inv[other]]), axis=1, return_counts=True) if len(other) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
        offsets = np.append(0, np.cumsum(np.bincount(pair[0], minlength=b.num_rows))).astype(np.int32)
        tail = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(h[pair[1]].view(np.int64)), pa.array(many.astype(np.int64))], names=["h", "m"]))
        cols = [pa.array(np.arange(row, row + b.num_rows)), b.column(0), b.column(1), pa.array(w.counts.astype(np.int64) + 1), pa.array(base), pa.array(known.astype(np.int64)), pa.array(rest), pa.array(codes, pa.binary()), tail]
        row += b.num_rows
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in _ENCODED.split(", ")])


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # K, K x K, CLASSES x K


def first_model(class_n: np.ndarray, states: int) -> Model:
    """Sticky states whose emissions are the corpus's, each bent another way (by a hash of class and state)."""
    u = (class_n + ALPHA) / (class_n.sum() + ALPHA * CLASSES)
    bend = blocks.mix(np.arange(CLASSES * states, dtype=_U) + _U(1)).astype(np.float64).reshape(CLASSES, states) / 2.0**64
    emit = u[:, None] * (0.5 + bend)
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def _sequences(codes: list[bytes], most: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All observations one after another; where each sequence begins and its length, longest first."""
    obs = np.frombuffer(b"".join(codes), np.uint16)
    sizes = np.array([len(c) // 2 for c in codes], np.int64)
    starts = np.cumsum(sizes) - sizes
    if most:
        parts = -(-sizes // most)
        starts = np.repeat(starts, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * most
        sizes = np.minimum(np.diff(np.append(starts, len(obs))), most)
    order = np.argsort(-sizes, kind="stable")
    return obs, starts[order], sizes[order]


def _forward(m: Model, obs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scaled recursion, in step over sequences (longest first), from the states `a` before the first emission: states after the last one, log10 of all scales."""
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right").tolist() if len(lengths) else []
    ends, a, total = a.copy(), a, np.zeros(len(lengths))
    for t, n in enumerate(active):
        if n < len(a):  # those that ended keep their last states
            ends[n : len(a)] = a[n:]
        a = (a[:n] @ m.move if t else a[:n]) * m.emit[obs[starts[:n] + t]]
        c = a.sum(1)
        a /= c[:, None]
        total[:n] += np.log10(c)
    ends[: len(a)] = a
    return ends, total


def log10_likelihood(m: Model, codes: list[bytes]) -> np.ndarray:
    """log10 of the probability of each whole sequence."""
    sizes = np.array([len(c) // 2 for c in codes], np.int64)
    out, k = np.zeros(len(codes)), len(m.start)
    short, long = np.flatnonzero(sizes <= LONG), np.flatnonzero(sizes > LONG)
    order = short[np.argsort(-sizes[short], kind="stable")]
    obs, starts, lengths = _sequences([codes[i] for i in short], None)
    out[order] = _forward(m, obs, starts, lengths, np.tile(m.start, (len(order), 1)))[1]
    if not len(long):
        return out
    obs, starts, lengths = _sequences([codes[i] for i in long], SEGMENT)
    edge = np.append(0, np.cumsum(sizes[long]))
    begin = np.tile(np.eye(k), (len(starts), 1))
    later = np.repeat(~np.isin(starts, edge), k)  # segments that don't begin their text
    begin[later] = begin[later] @ m.move
    ends, logs = _forward(m, obs, np.repeat(starts, k), np.repeat(lengths, k), begin)
    order = np.argsort(starts, kind="stable")
    starts, ends, logs = starts[order], ends.reshape(-1, k, k)[order], logs.reshape(-1, k)[order]
    for i, first, last in zip(long.tolist(), np.searchsorted(starts, edge[:-1]).tolist(), np.searchsorted(starts, edge[1:]).tolist(), strict=True):
        a = m.start
        for step, scale in zip(ends[first:last], logs[first:last], strict=True):  # a row of step for each state at the beginning
            most = scale.max()
            a = (a * 10.0 ** (scale - most)) @ step
            c = a.sum()
            a, out[i] = a / c, out[i] + math.log10(c) + most
    return out


def expected_counts(m: Model, codes: list[bytes], most: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward recursions: expected starts, moves and emissions."""
    k = len(m.start)
    obs, starts, lengths = _sequences(codes, most)
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right").tolist()
    start, move, emit = (x.astype(np.float32) for x in (m.start, m.move, m.emit))
    alpha, scale, seen = np.empty((len(obs), k), np.float32), np.empty(len(obs), np.float32), []
    a = None
    for t, n in enumerate(active):
        at = starts[:n] + t
        a = (start if t == 0 else a[:n] @ move) * emit[obs[at]]
        c = a.sum(1)
        a /= c[:, None]
        alpha[at], scale[at] = a, c
    moves, b = np.zeros((k, k)), None
    for t in range(len(active) - 1, -1, -1):
        n, at = active[t], starts[: active[t]] + t
        cur = np.ones((n, k), np.float32)
        if b is not None:
            m_ = len(b)
            to = starts[:m_] + t + 1
            weighed = emit[obs[to]] * b / scale[to][:, None]
            moves += move * (alpha[at[:m_]].T @ weighed)
            cur[:m_] = weighed @ move.T
        b = cur
        alpha[at] *= b  # now the state probabilities
    firsts = alpha[starts].sum(0, dtype=np.float64)
    emits = np.stack([np.bincount(obs, weights=alpha[:, i], minlength=CLASSES) for i in range(k)], 1)
    return firsts, moves, emits


def _expect(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m, total = model.value, None
    for b in blocks.slices(batches, "classes", 2 << 20):
        got = expected_counts(m, b.column(0).to_pylist())
        total = got if total is None else [x + y for x, y in zip(total, got, strict=True)]
    if total is not None:
        task, table = TaskContext.get().partitionId(), np.vstack([total[0][None, :], total[1], total[2]])
        for at in range(0, len(table), _CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([task], pa.int32()), pa.array([table[at : at + _CHUNK].tobytes()], pa.binary())], names=["chunk", "task", "counts"])


def train(encoded: DataFrame, class_n: np.ndarray, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over the class sequences of all rows of encoded; what comes to the driver has the size of the model."""
    sc, m = encoded.sparkSession.sparkContext, first_model(class_n, states)
    u = ((class_n + ALPHA) / (class_n.sum() + ALPHA * CLASSES))[:, None]
    for _ in range(iterations):
        shared = sc.broadcast(m)
        parts = encoded.select("classes").mapInArrow(lambda it, s=shared: _expect(it, s), "chunk int, task int, counts binary")
        parts = store.summed(parts, ["chunk"], np.float64).select("chunk", "counts").collect()
        if not parts:
            break
        table = np.concatenate([np.frombuffer(r["counts"]) for r in sorted(parts)]).reshape(-1, states)
        firsts, moves, emits = table[0] + 1, table[1 : 1 + states] + 1, table[1 + states :] + 10 * u
        m = Model(firsts / firsts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return m


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for b in blocks.slices(batches, "classes", 8 << 20):
        at = b.schema.get_field_index("classes")
        yield b.set_column(at, "forward", pa.array(log10_likelihood(model.value, b.column(at).to_pylist())))


def score(docs: DataFrame, held_out: str = "held_out") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; learns from rows not held out."""
    spark = docs.sparkSession
    store.import_path(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(held_out).alias("held_out"), "text")
    training = docs.where(~F.col("held_out"))
    counts = training.select("text").mapInArrow(_count, "h bigint, s int, n bigint").groupBy("h").agg(F.first("s").alias("s"), F.sum("n").alias("n"))
    vocabulary = Vocabulary(store.cut(counts, "words"), training.count())
    shared = spark.sparkContext.broadcast(vocabulary.shared())
    encoded = store.cut(docs.mapInArrow(lambda it: _encode(it, shared), _ENCODED), "encoded")
    model = spark.sparkContext.broadcast(train(encoded.where("not held_out"), vocabulary.class_n))
    forward = encoded.drop("tail").mapInArrow(lambda it: _score(it, model), ", ".join(x.replace("classes binary", "forward double") for x in _ENCODED.split(", ")[:-1]))
    # words outside the head are scored as if they had no count; where they have one, the difference is due for each of their places
    tail = encoded.select("row", F.inline("tail")).join(vocabulary.tail, "h")
    tail = tail.groupBy("row").agg(F.sum(F.col("m") * F.log10((F.col("n") + ALPHA) / ALPHA)).alias("tail_base"), F.sum("m").alias("tail_known"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    return forward.join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + zero("tail_known")).alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + zero("tail_base")).alias("base_score"),
        (F.col("forward") + F.col("rest") + zero("tail_base")).alias("score"),
    )
