"""Benchmark decontamination with suffix arrays over shards of the documents.

A shard is a block of texts in one task. Its words become ranks in the vocabulary of
the benchmark (0: not in it), and the suffixes that can begin a benchmark window - their
first two words stand side by side in an item - are sorted into a suffix array, compared
over as many words as the longest window has. Every test suffix is looked up in it by
binary search; hits on one diagonal join to the longest verbatim matches, whose places
in item and document are kept.

The benchmark is taken in blocks of at most BENCHMARK_BYTES of text (a longer item is a
block of its own); each block is broadcast, PASS_BLOCKS of them meet the documents in one
pass, and the passes are cut by writing. Texts are never shuffled. Equal windows of several
items are searched once; the list of matches is made for as many rows at a time as have
PAIRS (window, place) pairs together, and one row's list has the size of its result.

Null or empty texts: no words, nothing hit. Rows with equal doc_id are judged one by one.
An item with a null id hits words but is not among the listed items. An empty benchmark
hits nothing. Documents may have any further columns; those with the names of the new ones
are replaced. A text of 100 MB is a shard of its own and takes about six bytes a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

BENCHMARK_BYTES, PASS_BLOCKS = 8 << 20, 4
PAIRS = 1 << 21
WINDOW = 10

_MATCH = "array<struct<item_id:bigint,item_start:int,doc_start:int,length:int>>"
_MATCH_ARROW = pa.struct([("item_id", pa.int64()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())])


class Tests:
    """A block of the benchmark: its vocabulary, windows and the pairs of words that may begin one."""

    def __init__(self, table: pa.Table, window: int):
        table = table.combine_chunks()
        text = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks)
        w = blocks.Words(text, blocks.ALNUM, lower=True)
        ids = table.column("item_id").to_pylist()
        self.vocab = np.unique(w.hashes)
        self.bits = max(1, int(len(self.vocab)).bit_length())
        codes = np.searchsorted(self.vocab, w.hashes) + 1
        length = np.minimum(w.counts, window)
        n = np.where(w.counts > 0, w.counts - length + 1, 0)
        item = np.repeat(np.arange(len(ids)), n)
        pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        size = length[item]
        self.depth = int(length.max()) if len(length) else 0
        self.seed = int(min(2, length[length > 0].min())) if (length > 0).any() else 0
        at = w.first[:-1][item] + pos
        cols = [np.where(j < size, codes[np.minimum(at + j, len(codes) - 1)], 0) for j in range(self.depth)]
        low = pack(cols, self.bits)
        # equal windows, which have equal keys, are one test with several (item, pos)
        order = np.lexsort([pos, item, *low[::-1]]) if len(item) else np.zeros(0, int)
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in low], axis=0) if low else False
        head = order[new]
        self.item, self.pos = item[order], pos[order]
        self.edge = np.append(np.flatnonzero(new), len(order))  # where the (item, pos) of each test begin
        self.length = size[head]
        top = (1 << self.bits) - 1
        cols = [c[head] for c in cols]
        self.low = [k[head] for k in low]
        self.high = pack([np.where(j < self.length, c, top) for j, c in enumerate(cols)], self.bits)
        self.seeds = np.unique(cols[0] * (len(self.vocab) + 1) + cols[1]) if self.seed == 2 else np.unique(cols[0]) if self.seed else np.zeros(0, np.int64)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.named = np.array([i is not None for i in ids], bool)
        size = 1 << max(16, int(4 * len(self.vocab)).bit_length())
        self.mask = np.uint64(size - 1)
        self.maybe = np.zeros(size, bool)
        self.maybe[self.vocab & self.mask] = True

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.maybe[hashes & self.mask])
        spot = np.minimum(np.searchsorted(self.vocab, hashes[at]), len(self.vocab) - 1)
        same = self.vocab[spot] == hashes[at]
        out[at[same]] = spot[same] + 1
        return out


def pack(cols: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Columns of ranks as few 64-bit keys, compared one after another."""
    per, keys = max(1, 63 // bits), []
    for a in range(0, len(cols), per):
        key = np.zeros(len(cols[a]), np.int64)
        for j in range(a, a + per):
            key = (key << bits) | (cols[j] if j < len(cols) else 0)
        keys.append(key)
    return keys


def bound(array: list[np.ndarray], query: list[np.ndarray], upper: bool) -> np.ndarray:
    """Binary search of all queries at once in a sorted array of composite keys."""
    lo, hi = np.zeros(len(query[0]), np.int64), np.full(len(query[0]), len(array[0]), np.int64)
    for _ in range(int(len(array[0])).bit_length()):
        mid = np.minimum((lo + hi) >> 1, len(array[0]) - 1)
        after, equal = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for a, q in zip(array, query, strict=True):
            v = a[mid]
            after |= equal & (v < q)
            equal &= v == q
        after = (after | equal if upper else after) & (lo < hi)
        lo, hi = np.where(after, mid + 1, lo), np.where(after, hi, np.where(lo < hi, mid, hi))
    return lo


def occurrences(w: blocks.Words, t: Tests) -> tuple[np.ndarray, np.ndarray]:
    """First words of all places where tests occur in the shard, in order, and the tests."""
    none = (np.zeros(0, np.int64),) * 2
    if not t.depth or not len(w.hashes):
        return none
    codes = t.codes(w.hashes)
    if t.seed == 2:
        at = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0) & (w.doc[:-1] == w.doc[1:]))
        lead = codes[at] * (len(t.vocab) + 1) + codes[at + 1]
    else:
        at = np.flatnonzero(codes)
        lead = codes[at]
    spot = np.minimum(np.searchsorted(t.seeds, lead), len(t.seeds) - 1)
    at = at[t.seeds[spot] == lead]
    if not len(at):
        return none
    last = w.first[w.doc[at] + 1]
    keys = pack([np.where(at + j < last, codes[np.minimum(at + j, len(codes) - 1)], 0) for j in range(t.depth)], t.bits)
    order = np.lexsort(keys[::-1])
    suffixes, keys = at[order], [k[order] for k in keys]
    lo, hi = bound(keys, t.low, False), bound(keys, t.high, True)
    test, spot = _expand(lo, np.maximum(hi - lo, 0))
    word = suffixes[spot]
    order = np.argsort(word, kind="stable")
    return word[order], test[order]


def _expand(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of [start, start + size), each with the range it is of."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(of))


def longest(w: blocks.Words, t: Tests, word: np.ndarray, test: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, item, start in item, start in row and length of the longest matches, by row: hits of one item on one diagonal that touch are one."""
    of, at = _expand(t.edge[test], t.edge[test + 1] - t.edge[test])
    word, length, item, pos = word[of], t.length[test[of]], t.item[at], t.pos[at]
    doc = w.doc[word].astype(np.int64)
    start = word - w.first[doc]
    order = np.lexsort((pos, start - pos, item, doc))
    doc, item, pos, start, length = (x[order] for x in (doc, item, pos, start, length))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] - pos[1:] != start[:-1] - pos[:-1]) | (pos[1:] > pos[:-1] + length[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1 if len(head) else head
    return doc[head], item[head], pos[head], start[head], pos[tail] + length[tail] - pos[head]


def _pass(batches: Iterator[pa.RecordBatch], tests: list, text: str, names: tuple[str, str, str], later: bool) -> Iterator[pa.RecordBatch]:
    for b in blocks.slices(batches, text):
        w = blocks.Words(b.column(b.schema.get_field_index(text)), blocks.ALNUM, lower=True)
        hits = [occurrences(w, t.value) for t in tests]
        pairs = np.zeros(b.num_rows + 1, np.int64)
        for t, (word, test) in zip(tests, hits, strict=True):
            np.add.at(pairs, w.doc[word] + 1, np.diff(t.value.edge)[test])
        pairs = np.cumsum(pairs)
        a = 0
        while a < b.num_rows:  # rows a to z
            z = max(a + 1, int(np.searchsorted(pairs, pairs[a] + PAIRS, side="right")) - 1)
            yield _rows(b, w, a, min(z, b.num_rows), tests, hits, names, later)
            a = z


def _rows(b: pa.RecordBatch, w: blocks.Words, a: int, z: int, tests: list, hits: list, names: tuple[str, str, str], later: bool) -> pa.RecordBatch:
    """Rows a to z of a shard with their new columns."""
    part, found = b.slice(a, z - a), []
    if later:  # what earlier passes found stays
        old = part.column(part.schema.get_field_index(names[2]))
        s, at = old.flatten(), np.diff(blocks.offsets_of(old))
        ids = s.field("item_id")
        found.append((np.repeat(np.arange(a, z), at), ids.fill_null(0).to_numpy(), *(s.field(k).to_numpy() for k in ("item_start", "doc_start", "length")), ids.is_valid().to_numpy(zero_copy_only=False)))
    for t, (word, test) in zip(tests, hits, strict=True):
        own = slice(*np.searchsorted(word, w.first[[a, z]]))
        doc, item, *rest = longest(w, t.value, word[own], test[own])
        found.append((doc, t.value.ids[item], *rest, t.value.named[item]))
    doc, ids, pos, start, length, named = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(doc, kind="stable")
    doc, ids, pos, start, length, named = (x[order] for x in (doc, ids, pos, start, length, named))
    first = w.first[a : z + 1] - w.first[a]
    hit = blocks.sums_by(first, blocks.covered(int(first[-1]), first[doc - a] + start, length))
    structs = pa.StructArray.from_arrays([pa.array(ids, pa.int64(), mask=~named), *(pa.array(x.astype(np.int32)) for x in (pos, start, length))], fields=list(_MATCH_ARROW))
    offsets = np.append(0, np.cumsum(np.bincount(doc - a, minlength=z - a))).astype(np.int32)
    new = [pa.array(w.counts[a:z].astype(np.int64)), pa.array(hit.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), structs)]
    part = part.select([c for c in part.schema.names if c not in names])
    return pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *names])


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, names: tuple[str, str, str] = ("n_words", "n_hit", "matches")) -> DataFrame:
    """docs with three more columns (that replace those of the same names): words, words hit, and all longest matches (item, places, length)."""
    spark = docs.sparkSession
    store.import_path(spark)
    docs = docs.drop(*names)
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BENCHMARK_BYTES))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = f"{kept}, `{names[0]}` bigint, `{names[1]}` bigint, `{names[2]}` {_MATCH}"
    for a in range(0, n, PASS_BLOCKS):
        tables = (items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).toArrow() for k in range(a, min(a + PASS_BLOCKS, n)))  # BENCHMARK_BYTES each
        tests = [spark.sparkContext.broadcast(Tests(t, window)) for t in tables]
        docs = (store.cut(docs, "decontaminated") if a else docs).mapInArrow(lambda it, own=tests, later=a > 0: _pass(it, own, text, names, later), schema)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    names = tuple(f"__decon_{x}" for x in ("words", "hit", "matches"))
    return annotate(docs, benchmark, window=window, names=names).where(F.col(names[1]) == 0).select(*(f"`{c}`" for c in docs.columns))


def sql(window: int = WINDOW) -> str:
    """The digest columns of annotate() in DuckDB's SQL, over the tables documents and benchmark."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    spans = lambda table, n: f"SELECT id, p, array_to_string(w[p:p + {n} - 1], ' ') AS k FROM (SELECT id, w, unnest(range(1, len(w) - {n} + 2)) AS p FROM {table} WHERE len(w) >= {n})"
    short = " UNION ALL ".join(f"SELECT id, k, {n} AS n FROM ({spans('i', n)}) WHERE id IN (SELECT id FROM i WHERE len(w) = {n})" for n in range(1, window))
    found = " UNION ALL ".join(f"SELECT s.id, s.p, t.id AS item, {n} AS n FROM ({spans('d', n)}) s JOIN t ON s.k = t.k AND t.n = {n} WHERE EXISTS (SELECT 1 FROM t WHERE n = {n})" for n in range(1, window + 1))
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id AS id, {words} AS w FROM documents),
i AS MATERIALIZED (SELECT item_id AS id, {words} AS w FROM benchmark),
t AS MATERIALIZED (SELECT id, k, {window} AS n FROM ({spans('i', window)}) UNION {short}),
f AS MATERIALIZED ({found}),
h AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + n)) AS q FROM f) GROUP BY id),
g AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM f) GROUP BY id)
SELECT d.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON d.id = h.id LEFT JOIN g ON d.id = g.id"""
