"""Line deduplication: keys of lines in ranges, the first document of each key streamed, keep bitmaps a document.

1. Each task reads the lines of a block of documents and hashes their keys to 128 bits
   (BLAKE2b). Where a key occurs in several documents of the block, all but the smallest
   doc_id lose it at once and only the smallest one's lines go on, so a line that a third of
   all documents hold leaves a block for one document.
2. The lines that go on are dealt to ranges of (key, doc_id, line) and sorted within them. As
   the range holds doc_id and line, a frequent key spreads over as many ranges as it needs.
   Each range is streamed once: lines of another document than the first of their key are
   dropped. What a range can't know is whether its first key began in a range before it:
   the lines of that key's first document there wait, and each range reports its last key with
   the first document of it, one row a range; the least of these settles the waiting lines.
3. Numbers of dropped lines are grouped by document and become keep bitmaps: one bit a line
   (least significant first), compressed by zlib. They, not texts, are what the operator moves.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased. Keys of at
least 10 code points that at least two documents hold are kept in the smallest doc_id only (all
its lines of that key). Null or empty text: one empty line, which stays. Empty table: no rows.
Rows without a doc_id lose nothing and take nothing. Rows that share a doc_id count as one
document: a key doesn't repeat through them; with equal texts they share a bitmap. Texts of any
length are read in parts of PART bytes, so what is held beyond the text itself is bounded.
Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

LEAST = 10
#: Text of one block, whose keys are compared before anything leaves the task.
BLOCK = 8 << 20
PART = 1 << 20
#: Rows that a task holds before it hands them on.
_ROWS = 1 << 16
_BLANK = b" \t\n\v\f\r"
_LINES = "doc_id bigint, text_key bigint, n_lines bigint, line int, h1 bigint, h2 bigint"
_FOUND = "doc_id bigint, text_key bigint, line int, h1 bigint, h2 bigint, kind int"
_FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("line", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("kind", pa.int32())])
_DROPPED, _WAITING, _LAST = 0, 1, 2


def _parts(raw: bytes) -> Iterator[list[bytes]]:
    """The lines of a text, about PART bytes at a time."""
    at = 0
    while (to := raw.find(b"\n", at + PART)) >= 0:
        yield raw[at:to].split(b"\n")
        at = to + 1
    yield raw[at:].split(b"\n")


def _key(line: bytes, least: int) -> bytes | None:
    """The digest of the line's key; None if the key is shorter than `least` code points."""
    key = line.strip(_BLANK)
    if len(key) < 4 * least and (len(key) < least or len(key.decode()) < least):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()  # bytes.lower() knows A-Z only


def _table(docs: list, texts: list, lines: list, digests: list, counts: list | None = None) -> pa.RecordBatch:
    """A batch of _LINES. digests: bytes or None, for lines that are lost already."""
    none = [None] * len(docs)
    known = np.array([d is not None for d in digests], bool)
    h = np.frombuffer(b"".join(d or bytes(16) for d in digests), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(texts, pa.int64()), pa.array(counts or none, pa.int64()), pa.array(lines, pa.int32()), pa.array(h[:, 0], mask=~known), pa.array(h[:, 1], mask=~known)],
        names=["doc_id", "text_key", "n_lines", "line", "h1", "h2"],
    )


def _hash(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """A row a document with its number of lines, and a row a line that has a key: with its digest, or without where it is lost within the block."""
    for b in blocks.slices(batches, col="text", limit=BLOCK):
        b = b.filter(b.column(0).is_valid())
        ids, keys = b.column(0).to_pylist(), b.column(2).to_pylist()
        rows: tuple[list, list, list, list] = ([], [], [], [])
        first: dict[bytes, int] = {}
        counts = []
        for doc, key, text in zip(ids, keys, b.column(1), strict=True):
            n, raw = 0, text.as_buffer().to_pybytes() if text.is_valid else b""
            for part in _parts(raw):
                for i, line in enumerate(part, n):
                    if (digest := _key(line, least)) is not None:
                        for column, value in zip(rows, (doc, key, i, digest), strict=True):
                            column.append(value)
                n += len(part)
                if len(ids) == 1 and len(rows[0]) >= _ROWS:  # one document: nothing to compare
                    yield _table(*rows)
                    rows = ([], [], [], [])
            counts.append(n)
        if len(ids) > 1:
            for doc, digest in zip(rows[0], rows[3], strict=True):
                if first.setdefault(digest, doc) > doc:
                    first[digest] = doc
            rows = (*rows[:3], [d if first[d] == doc else None for doc, d in zip(rows[0], rows[3], strict=True)])
        if rows[0]:
            yield _table(*rows)
        yield _table(ids, keys, [None] * len(ids), [None] * len(ids), counts)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one sorted range: dropped lines, waiting lines, and one row with the last key and its first document."""
    last: tuple[int, int, int] | None = None  # key, and the first document that holds it
    opening = True  # no other key than the range's first has been seen
    for b in batches:
        if not b.num_rows:
            continue
        doc, h1, h2 = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("doc_id", "h1", "h2"))
        new = np.ones(len(doc), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        begins = last is None
        if not begins:
            new[0] = (h1[0], h2[0]) != last[:2]
        head = np.maximum.accumulate(np.where(new, np.arange(len(doc)), -1))
        own = np.where(head >= 0, doc[head], doc[0] if begins else last[2])
        seen = np.cumsum(new) - begins  # keys that began before a row, beyond the range's first
        kind = np.full(len(doc), -1, np.int32)
        kind[doc > own] = _DROPPED
        if opening:
            kind[(doc == own) & (seen == 0)] = _WAITING
            opening = not seen[-1]
        last = (int(h1[-1]), int(h2[-1]), int(own[-1]))
        out = pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in _FOUND_ARROW.names[:-1]), pa.array(kind)], schema=_FOUND_ARROW)
        yield out.filter(pa.array(kind >= 0))
    if last is not None:
        yield pa.RecordBatch.from_pylist([{"doc_id": last[2], "h1": last[0], "h2": last[1], "kind": _LAST}], schema=_FOUND_ARROW)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        dropped, keep = [], []
        for n, lines in zip(b.column(2).to_pylist(), b.column(3), strict=True):
            bits = np.ones(n, bool)
            bits[lines.values.to_numpy()] = False
            dropped.append(n - int(bits.sum()))
            keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())], names=["doc_id", "text_key", "n_lines", "n_dropped", "keep"])


def keep_bits(keep: bytes, n: int) -> np.ndarray:
    """The n booleans of a keep bitmap."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n, bitorder="little").astype(bool)


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), n_lines, n_dropped and keep (compressed bitmap) of each document with an id."""
    store.import_path(docs.sparkSession)
    lines = store.cut(_docs(docs).mapInArrow(lambda it: _hash(it, least), _LINES), "lines")
    order = ["h1", "h2", "doc_id", "line"]
    ranges = lines.where("h1 is not null").select("doc_id", "text_key", "line", "h1", "h2").repartitionByRange(*order).sortWithinPartitions(*order)
    found = store.cut(ranges.mapInArrow(_stream, _FOUND), "first-lines")
    least_doc = found.where(F.col("kind") == _LAST).groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))  # at most a row a range
    late = found.where(F.col("kind") == _WAITING).join(least_doc, ["h1", "h2"]).where("doc_id > least")
    place = ["doc_id", "text_key", "line"]
    dropped = lines.where("h1 is null and line is not null").select(*place).unionByName(found.where(F.col("kind") == _DROPPED).select(*place)).unionByName(late.select(*place))
    both = lines.where("n_lines is not null").select(*place[:2], "n_lines", "line").unionByName(dropped.select(*place[:2], F.lit(None).cast("bigint").alias("n_lines"), "line"))
    by_doc = both.groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"), F.collect_list("line").alias("dropped"))
    return by_doc.mapInArrow(_bitmaps, "doc_id bigint, text_key bigint, n_lines bigint, n_dropped bigint, keep binary")


def _kept(raw: bytes, keep: bytes | None) -> Iterator[bytes]:
    """The kept lines with line feeds between them, in pieces."""
    if keep is None:
        yield raw
        return
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    at, began = 0, False
    for part in _parts(raw):
        own = [line for line, k in zip(part, bits[at : at + len(part)].tolist(), strict=True) if k]
        at += len(part)
        if own:
            yield (b"\n" if began else b"") + b"\n".join(own)
            began = True


def _applied(batches: Iterator[pa.RecordBatch], text: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, n_lines, n_dropped and what is left (text) or its SHA-256; columns in: doc_id, text, n_dropped, keep."""
    for b in blocks.slices(batches):
        n, out = [], []
        for value, keep in zip(b.column(1), b.column(3).to_pylist(), strict=True):
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            n.append(raw.count(b"\n") + 1)
            if text:
                out.append(b"".join(_kept(raw, keep)).decode())
            else:
                sha = hashlib.sha256()
                for piece in _kept(raw, keep):
                    sha.update(piece)
                out.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), b.column(2), pa.array(out, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])


def apply(docs: DataFrame, bitmaps: DataFrame, text: bool = True) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of every row of docs; with text=False kept_sha256 in its place."""
    spark = docs.sparkSession
    store.import_path(spark)
    cut = store.cut(bitmaps.where("n_dropped > 0").select("doc_id", "text_key", "n_dropped", "keep"), "keep")
    few = store.small(cut, "64 + octet_length(keep)").hint("shuffle_hash")  # a hint to broadcast, where given, goes first
    rows = _docs(docs).join(few, ["doc_id", "text_key"], "left").select("doc_id", "text", F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"), "keep")
    return rows.mapInArrow(lambda it: _applied(it, text), "doc_id bigint, n_lines bigint, n_dropped bigint, kept string").withColumnRenamed("kept", "kept_text" if text else "kept_sha256")


def sql(least: int = LEAST) -> str:
    """apply(docs, keep_bitmaps(docs), text=False) in DuckDB's SQL over the table documents; doc_id must be unique."""
    return rf"""
WITH l AS MATERIALIZED (SELECT doc_id, unnest(w) AS line, unnest(range(1, len(w) + 1)) AS p FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents)),
k AS MATERIALIZED (SELECT doc_id, p, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, min(doc_id) AS least FROM k WHERE length(key) >= {least} GROUP BY key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id > least) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (least IS NULL OR doc_id = least), '')) AS kept_sha256
FROM k LEFT JOIN m USING (key) GROUP BY doc_id"""
