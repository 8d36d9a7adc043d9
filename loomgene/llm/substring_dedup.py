"""Substring deduplication: every window of 13 words is hashed (Rabin-Karp) and counted in Spark.

1. Each task hashes all windows of a block of documents. Where a window occurs in several
   documents of the block, all but those of the smallest doc_id lose it at once; the
   occurrences in the smallest go on. So one window leaves a block for one document only,
   and a passage that a third of all rows share stays small in the shuffle.
2. Hashes are dealt by value to buckets (packed: 8 bytes a hash and 2 of position), as many
   as the measured bytes of text ask for, where equal hashes of different blocks meet; all
   but those of the smallest doc_id are marked.
3. Marks return to their block, become maximal intervals of words for each document, and
   are joined to the documents: by broadcast if their bytes are measured to be few, else by
   a shuffle on doc_id.

Windows are equal if their 64-bit hashes are: at 30 GB (about 5e9 windows) 0.7 false pairs are
expected, and they grow with the square of the text. A text of 100 MB is a block of its own and takes about twelve bytes a byte. Null or empty text: no words. Rows without a
doc_id lose nothing and take nothing. Rows that share a doc_id count as one document: a
window does not repeat through another row of the same doc_id. Documents may have any further columns. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

WINDOW = 13
#: Text of one block; its windows are kept together while it is deduplicated.
BLOCK = 8 << 20
#: Text whose hashes share a bucket; about twice as many bytes are held for it at once.
BUCKET_TEXT = 24 << 20

_DEALT = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("gaps", pa.binary()), ("rows", pa.binary()), ("ids", pa.binary()), ("marks", pa.binary())])
_MARKS = "block bigint, rows binary, ids binary, marks binary"
_SPANS = "doc_id bigint, text_key bigint, spans array<struct<start:int,stop:int>>"


def _smallest(h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have the smallest id of their hash; and which don't."""
    order = np.argsort(h, kind="stable")
    s, d = h[order], ids[order]
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(s)), bool), s[1:] != s[:-1]]))
    least = np.minimum.reduceat(d, head) if len(head) else d
    own = np.zeros(len(h), bool)
    own[order] = d == np.repeat(least, np.diff(np.append(head, len(s))))
    return own, ~own


def _hash(batches: Iterator[pa.RecordBatch], buckets: int, window: int) -> Iterator[pa.RecordBatch]:
    seq = TaskContext.get().partitionId() << 32
    for b in blocks.slices(batches, limit=BLOCK):
        b = b.filter(b.column(0).is_valid())
        if not b.num_rows:
            continue
        ids = b.column(0).to_numpy()
        ats, hashes, first = [], [], 0
        parts, word0 = [], [0]
        for part in blocks.slices([b], limit=blocks.BLOCK_BYTES):
            w = blocks.Words(part.column(1), blocks.SPACED, lower=False)
            at, h = w.grams(window)
            ats.append(at + first)
            hashes.append(h)
            parts.append(w.counts)
            first += len(w.hashes)
        at, h = np.concatenate(ats), np.concatenate(hashes)
        del ats, hashes
        rows = np.concatenate([word0, np.cumsum(np.concatenate(parts))]).astype(np.int64)
        owner = ids[np.searchsorted(rows, at, side="right") - 1]
        own, lost = _smallest(h, owner)
        local = at[lost].astype(np.uint32)
        at, h = at[own], h[own]
        bucket = (h % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")  # by bucket, then place
        at, h, owner, bucket = at[order], h[order], owner[own][order], bucket[order]
        full = np.unique(bucket)
        edges = np.append(np.searchsorted(bucket, full), len(bucket))
        turn = np.ones(len(at), bool)  # where a run of one document's windows in one bucket begins
        turn[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
        runs = np.flatnonzero(turn)
        spots = np.searchsorted(runs, edges)
        # the block's own marks travel with its directory of rows
        out = [(seq, int(seq % buckets), b"", b"", rows.tobytes(), np.concatenate([ids, b.column(2).to_numpy()]).astype(np.int64).tobytes(), local.tobytes())]
        for k, name in enumerate(full.tolist()):
            a, z = edges[k], edges[k + 1]
            own_runs = runs[spots[k] : spots[k + 1]]
            out.append((seq, name, h[a:z].tobytes(), _gaps(at[a:z]), np.diff(own_runs, append=z).astype(np.uint32).tobytes(), np.diff(owner[own_runs], prepend=0).astype(np.int64).tobytes(), None))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _DEALT, strict=True)], schema=_DEALT)
        seq += 1


def _gaps(at: np.ndarray) -> bytes:
    """Rising places as 16-bit steps; a step of 65535 goes on in the next number."""
    step = np.diff(at, prepend=0)
    big = step // 65535
    if not big.any():
        return step.astype(np.uint16).tobytes()
    out = np.full(len(step) + int(big.sum()), 65535, np.uint16)
    out[np.cumsum(big + 1) - 1] = step % 65535
    return out.tobytes()


def _places(raw: bytes) -> np.ndarray:
    step = np.frombuffer(raw, np.uint16).astype(np.int64)
    return np.cumsum(step)[step != 65535]


def _meet(table: pa.Table) -> pa.Table:
    """Of the windows of one bucket, marks those that have a smaller doc_id elsewhere."""
    out = []
    hs, ats, owners, blocks_of, meta = [], [], [], [], []
    for block, h, g, rows, ids, marks in zip(*(table.column(c).to_pylist() for c in ("block", "hashes", "gaps", "rows", "ids", "marks")), strict=True):
        if marks is not None:
            out.append((block, rows, ids, marks))
            continue
        at = _places(g)
        hs.append(np.frombuffer(h, np.uint64))
        ats.append(at)
        owners.append(np.repeat(np.cumsum(np.frombuffer(ids, np.int64)), np.frombuffer(rows, np.uint32)))
        blocks_of.append(np.full(len(at), len(meta), np.int32))
        meta.append(block)
    if hs:
        _, lost = _smallest(np.concatenate(hs), np.concatenate(owners))
        at, of = np.concatenate(ats)[lost].astype(np.uint32), np.concatenate(blocks_of)[lost]
        edges = np.searchsorted(of, np.arange(len(meta) + 1))
        out += [(block, None, None, at[edges[k] : edges[k + 1]].tobytes()) for k, block in enumerate(meta) if edges[k] < edges[k + 1]]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, kinds, strict=True)], names=["block", "rows", "ids", "marks"])


def _intervals(table: pa.Table, window: int) -> pa.Table:
    """The marked windows of one block as maximal intervals of words, for each of its rows that has any."""
    at = np.concatenate([np.frombuffer(m, np.uint32) for m in table.column("marks").to_pylist()]).astype(np.int64)
    rows = np.frombuffer(next(x for x in table.column("rows").to_pylist() if x is not None), np.int64)
    ids, keys = np.frombuffer(next(x for x in table.column("ids").to_pylist() if x is not None), np.int64).reshape(2, -1)
    at.sort()
    doc = np.searchsorted(rows, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + window)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1 if len(head) else head
    of = doc[head]
    start, stop = at[head] - rows[of], at[tail] + window - rows[of]
    row = np.unique(of)
    offsets = np.append(np.searchsorted(of, row), len(of)).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["start", "stop"])
    return pa.table([pa.array(ids[row]), pa.array(keys[row]), pa.ListArray.from_arrays(pa.array(offsets), spans)], names=["doc_id", "text_key", "spans"])


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, xxhash64 of the text and the maximal intervals of words [start, stop) to remove; documents that have some."""
    spark = docs.sparkSession
    store.import_path(spark)
    text = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text // BUCKET_TEXT))
    schema = "block bigint, bucket int, hashes binary, gaps binary, rows binary, ids binary, marks binary"
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text")).mapInArrow(lambda it: _hash(it, buckets, window), schema)
    marks = dealt.groupBy("bucket").applyInArrow(_meet, _MARKS)
    return marks.groupBy("block").applyInArrow(lambda t: _intervals(t, window), _SPANS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks.slices(batches):
        w = blocks.Words(b.column(1), blocks.SPACED, lower=False)
        raw, spans = w.buf.tobytes(), b.column(2).to_pylist()
        removed, kept = [], []
        for i, own in enumerate(spans):
            a, z = int(w.first[i]), int(w.first[i + 1])
            keep = np.ones(z - a, bool)
            for s in own or ():
                keep[s["start"] : s["stop"]] = False
            at = np.flatnonzero(keep) + a
            removed.append(z - a - len(at))
            kept.append(b" ".join([raw[s:e] for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]).decode())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w.counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _cut(batches):
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sha)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _with_spans(docs: DataFrame, window: int) -> DataFrame:
    spans = repeated_spans(docs, window)
    few = store.small(store.cut(spans.dropDuplicates(["doc_id", "text_key"]), "repeats"), "48 + 40 * size(spans)")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return docs.join(few, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the text that is left: its kept words joined by single spaces."""
    return _with_spans(docs, window).mapInArrow(_cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """As dedup_substrings, with the SHA-256 of the kept text in its place."""
    return _with_spans(docs, window).mapInArrow(_digest, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def sql(window: int = WINDOW) -> str:
    """digest() in DuckDB's SQL over the table documents; doc_id must be unique."""
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (SELECT doc_id, p, array_to_string(w[p:p + {window - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS p FROM d WHERE len(w) >= {window})),
m AS (SELECT k, min(doc_id) AS least FROM g GROUP BY k HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(p, p + {window})) AS q FROM g JOIN m USING (k) WHERE doc_id > least),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
y AS (SELECT x.doc_id, count(r.q) AS n_removed, string_agg(word, ' ' ORDER BY x.q) FILTER (r.q IS NULL) AS kept FROM x LEFT JOIN r ON x.doc_id = r.doc_id AND x.q = r.q GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN y USING (doc_id)"""
