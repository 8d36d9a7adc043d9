"""Packing of tokenized documents into as few sequences as possible, by matching and best fit.

Documents longer than a sequence are cut into full pieces, the remainder first. What is
packed is then described by how many pieces there are of each length, a table of at most
`capacity` rows, from which the driver makes the plan:

* lengths above a third of the capacity: at most two fit together, so the longest is matched
  with the longest partner that fits, in runs of equal pairs;
* all others, longest first, go to the smallest gap that holds them, again in runs.

The plan is a list of runs ("pieces of length L, ranks r to r+n, t to each of these
sequences, from this offset"), whose number depends on the capacity, not on the data. Each
task numbers its pieces of each length; with the counts of the tasks before it that gives
the rank of a piece, and the rank its place. No piece list reaches the driver or one task.

Null text: empty, one piece with the end id alone. Rows with equal or null doc_id are packed
one by one. Empty table: no rows. Pieces of equal length are interchangeable; their ranks, and so
their sequences, follow their tasks. A very long text of any script is tokenized in the parts of
tokens.parts (one of 99 MB took 0.6 GB). Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.llm import blocks, store, tokens

CAPACITY, END_ID = 1024, 2


class Plan:
    """Runs of placements: length -> (first rank, pieces to a sequence, first sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in counts}
        self.rank = dict.fromkeys(counts, 0)
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
        self.open: list[int] = []
        self._large({n: c for n, c in counts.items() if 3 * n > capacity})
        for n in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._small(n, counts[n])

    def _new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _put(self, length: int, each: int, first: int, sequences: int, offset: int) -> None:
        self.runs[length].append((self.rank[length], each, first, offset))
        self.rank[length] += each * sequences

    def _leave(self, gap: int, first: int, sequences: int) -> None:
        if gap and sequences:
            if not self.gaps.get(gap):
                self.gaps[gap] = []
                insort(self.open, gap)
            self.gaps[gap].append((first, sequences))

    def _large(self, left: dict[int, int]) -> None:
        lengths = sorted(left)
        while lengths:
            a = lengths[-1]
            i = bisect_left(lengths, self.capacity - a + 1) - 1
            if i < 0:
                first = self._new(left[a])
                self._put(a, 1, first, left[a], 0)
                self._leave(self.capacity - a, first, left[a])
                lengths.pop()
                continue
            b = lengths[i]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            if not n:  # the last of its length, with no shorter partner at hand
                if i:
                    b, n = lengths[i - 1], 1
                else:
                    first = self._new(1)
                    self._put(a, 1, first, 1, 0)
                    self._leave(self.capacity - a, first, 1)
                    lengths.pop()
                    continue
            first = self._new(n)
            self._put(a, 1, first, n, 0)
            self._put(b, 1, first, n, a)
            self._leave(self.capacity - a - b, first, n)
            left[a] -= n
            left[b] -= n
            lengths = [x for x in lengths if left[x]]

    def _small(self, length: int, count: int) -> None:
        while count and (i := bisect_left(self.open, length)) < len(self.open):
            gap = self.open[i]
            first, n = self.gaps[gap].pop()
            if not self.gaps[gap]:
                self.open.pop(i)
            each = min(gap // length, count)  # a gap that still holds one is the best fit for the next, too
            used = min(n, count // each)
            self._put(length, each, first, used, self.capacity - gap)
            self._leave(gap - each * length, first, used)
            self._leave(gap, first + used, n - used)
            count -= each * used
        each = self.capacity // length
        for each, n in ((each, count // each), (count % each, 1)):
            if each and n:
                first = self._new(n)
                self._put(length, each, first, n, 0)
                self._leave(self.capacity - each * length, first, n)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for n in np.unique(length).tolist():
            at = np.flatnonzero(length == n)
            runs = np.array(self.runs[n], np.int64)
            run = runs[np.searchsorted(runs[:, 0], rank[at], side="right") - 1]
            step = rank[at] - run[:, 0]
            seq[at] = run[:, 2] + step // run[:, 1]
            offset[at] = run[:, 3] + step % run[:, 1] * n
        return seq, offset


_PIECES = "task int, rank bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _tokenize(batches: Iterator[pa.RecordBatch], spec, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    bpe, task, ranks = tokens.Bpe(spec.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
    end = np.array([end_id], "<u4")
    for b in blocks.slices(batches):
        out = []
        for doc, value in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = value.as_py()
            ids = np.concatenate([bpe.ids(text), end]) if text else end
            n = len(ids)
            cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
            for piece, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                out.append((task, ranks[z - a], doc, piece, a, z - a, zlib.crc32(ids[a:z].tobytes())))
                ranks[z - a] += 1
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["task", "rank", "doc_id", "piece", "start", "length", "ids_crc32"])


def _assign(batches: Iterator[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seq, offset = plan.value.place(b.column(4).to_numpy(), b.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(seq), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row."""
    spark = docs.sparkSession
    store.import_path(spark)
    spec = spark.sparkContext.broadcast(tokens.read_spec(tokenizer))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pieces = store.cut(docs.mapInArrow(lambda it: _tokenize(it, spec, capacity, end_id), _PIECES), "pieces")
    counts = store.cut(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    plan = spark.sparkContext.broadcast(Plan({r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}, capacity))  # at most `capacity` rows
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = pieces.join(before, ["task", "length"]).select((F.col("before") + F.col("rank")).alias("rank"), "doc_id", "piece", "start", "length", "ids_crc32")
    return ranked.mapInArrow(lambda it: _assign(it, plan), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
