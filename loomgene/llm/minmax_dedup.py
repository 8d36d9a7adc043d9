"""Near-duplicate groups by min-max hashing, with every link confirmed on full shingle sets.

Each permutation of the 64-bit hashes gives a set two values, its minimum and its maximum,
so PERMUTATIONS evaluations make a signature twice as long. A band is the minima and maxima
of two permutations; at a similarity of 0.85 a band agrees with a probability of 0.52 and
at least one of 20 with 1 - 4e-7.

1. Documents with equal sets form a class (copies are never compared with each other).
2. Classes that share a band meet in a bucket. Buckets of equal membership are kept once.
   A bucket with more than CELL_SHINGLES shingles is dealt to cells, each set to one of them.
3. In a cell, one set at a time is compared with all that are not yet connected to it,
   beginning with the most typical one and leaving out what has joined its component, so
   pairs inside a connected group are not enumerated, yet no link that connects is lost.
4. The most typical set of each cell stands for it: those of FAN cells meet in the next
   round, until one is left of a bucket. So a large group of near copies is connected with
   each of its sets read once.
5. Components come from the confirmed links by rounds of joins (large star, small star).
6. Only buckets of several cells whose sets aren't all of one component by then are compared
   in full: their sets meet in cells for pairs of chunks, where only pairs of different
   components are looked at, and step 5 is repeated with the new links.
A set of fewer than three words is that whole sequence. Null and empty texts: n_shingles 0,
linked with nothing. A null doc_id takes part in no group: component_id null, kept. Rows
that share a doc_id are linked by their own texts only. Ties: the smallest doc_id stays, in
all of its rows if there are several. Empty table: no rows. Further columns are not read by near_duplicates and kept by dedup. A text of 100 MB is sketched by itself and takes about
ten bytes a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

PERMUTATIONS, BANDS = 40, 20
CELL_SHINGLES, GRID_SHINGLES = 40_000, 2_000_000
FAN = 64
_U = np.uint64
_MULT = blocks.mix(np.arange(1, PERMUTATIONS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_XOR = blocks.mix(_MULT + _U(17))


def shingle_sets(arr: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row after another; where each row's begin."""
    w = blocks.Words(arr, blocks.SPACED, lower=True)
    at, h = w.grams(k)
    counts = np.bincount(w.doc[at], minlength=len(arr))
    for n in range(1, k):  # whole short sequences
        short = np.flatnonzero(w.counts == n)
        if len(short):
            tail = blocks.rolling(w.hashes, n)[w.first[short]] + _U(n)
            spot = np.searchsorted(at, w.first[short])
            at, h = np.insert(at, spot, w.first[short]), np.insert(h, spot, blocks.mix(tail))
            counts[short] = 1
    first = np.append(0, np.cumsum(counts))
    h = h.copy()
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if z - a > 1:
            h[a:z].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[first[:-1][first[:-1] < len(h)]] = True
    return h[new], np.append(0, np.cumsum(blocks.sums_by(first, new)))


def signatures(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima and maxima under each permutation, for the (not empty) sets that begin at starts."""
    out, v = np.empty((len(starts), 2 * PERMUTATIONS), _U), np.empty_like(h)
    for p in range(PERMUTATIONS):
        np.bitwise_xor(h, _XOR[p], out=v)
        np.multiply(v, _MULT[p], out=v)
        out[:, 2 * p] = np.minimum.reduceat(v, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(v, starts)
    return out


def _digests(h: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    return [f.reduceat(blocks.mix(h ^ _U(c)), starts).view(np.int64) for f, c in ((np.add, 0xA5A5), (np.bitwise_xor, 0x5A5A5A))]


def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    per = 2 * PERMUTATIONS // BANDS
    for b in blocks.slices(batches):
        h, first = shingle_sets(b.column(1), k)
        n = np.diff(first)
        full = np.flatnonzero(n)
        d1, d2, bands = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros((0, BANDS), np.int64)
        if len(full):
            starts = first[:-1][full]
            d1[full], d2[full] = _digests(h, starts)
            sig, key = signatures(h, starts).reshape(len(full), BANDS, per), np.arange(BANDS, dtype=_U)[None, :].repeat(len(full), 0)
            for j in range(per):
                key = blocks.mix(key * _U(0x9E3779B97F4A7C15) + sig[:, :, j])
            bands = key.view(np.int64)
        offsets = np.append(0, np.cumsum(np.where(n > 0, BANDS, 0))).astype(np.int32)
        cols = [b.column(0), b.column(2), pa.array(n.astype(np.int64)), pa.array(d1), pa.array(d2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel()))]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_key", "n_shingles", "c1", "c2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in blocks.slices(batches):
        h, first = shingle_sets(b.column(0), k)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            d1, d2 = _digests(h, first[:-1][full])
            yield pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), pa.array([h[first[i] : first[i + 1]].tobytes() for i in full], pa.binary())], names=["c1", "c2", "hashes"])


def connect(sets: list[np.ndarray], percent: int, comp: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Component of each set under links of at least percent similarity (equal numbers, equal component), and the most typical set.

    comp: components known before; pairs within one are not compared.
    """
    m = len(sets)
    n = np.array([len(s) for s in sets])
    comp = np.arange(m) if comp is None else comp.copy()
    if m == 1:
        return comp, 0
    if m == 2:
        a, b = sets
        if comp[0] != comp[1] and 100 * min(n) >= percent * max(n):
            both = np.intersect1d(a, b, assume_unique=True).size
            if 100 * both >= percent * (n.sum() - both):
                comp[1] = comp[0]
        return comp, 0
    _, inv = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.append(0, np.cumsum(n))[:-1]
    common = np.bincount(inv)
    hub = int(np.argmax(np.add.reduceat(common[inv], starts) / n))
    mark = np.zeros(len(common), np.int32)
    for x in [hub, *(i for i in range(m) if i != hub)]:
        if x != hub and comp[x] == comp[hub]:
            continue
        mark[:] = 0
        mark[inv[starts[x] : starts[x] + n[x]]] = 1
        both = np.add.reduceat(mark[inv], starts)
        for c in np.unique(comp[100 * both >= percent * (n + n[x] - both)]):
            if c != comp[x]:
                comp[comp == c] = comp[x]
        if (comp == comp[hub]).all():
            break
    return comp, hub


def _spanning(c1: np.ndarray, c2: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are linked, each to the first row of its component."""
    _, first, inv = np.unique(comp, return_index=True, return_inverse=True)
    root = first[inv]
    far = np.flatnonzero(root != np.arange(len(root)))
    return far, root[far]


_LINKS = "a1 bigint, a2 bigint, b1 bigint, b2 bigint"
_CELL = "key bigint, chunks bigint, i bigint, c1 bigint, c2 bigint, hashes binary"


def _links(table: pa.Table, percent: int) -> pa.Table:
    """The links of one cell; and, if it is one of several of a bucket, its most typical set for the next round."""
    c1, c2, sets = table.column("c1").to_numpy(), table.column("c2").to_numpy(), table.column("hashes").to_pylist()
    comp, hub = connect([np.frombuffer(x, _U) for x in sets], percent)
    far, root = _spanning(c1, c2, comp)
    key, chunks, i = (table.column(c)[0].as_py() for c in ("key", "chunks", "i"))
    n = len(far) + (chunks > 1)
    up = lambda value: [None] * len(far) + [value] * (n - len(far))
    out = {"a1": [*c1[far].tolist(), None], "a2": [*c2[far].tolist(), None], "b1": [*c1[root].tolist(), None], "b2": [*c2[root].tolist(), None]}
    out = {k: v[:n] for k, v in out.items()} | {"key": up(key), "chunks": up(-(-chunks // FAN)), "i": up(i // FAN), "c1": up(int(c1[hub])), "c2": up(int(c2[hub]))}
    return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()} | {"hashes": pa.array(up(sets[hub]), pa.binary())})


def _late_links(table: pa.Table, percent: int) -> pa.Table:
    """Links of one pair of chunks between sets of different components (r1, r2)."""
    c1, c2 = table.column("c1").to_numpy(), table.column("c2").to_numpy()
    _, known = np.unique(np.stack([table.column("r1").to_numpy(), table.column("r2").to_numpy()]), axis=1, return_inverse=True)
    comp, _ = connect([np.frombuffer(x, _U) for x in table.column("hashes").to_pylist()], percent, known.ravel())
    far, root = _spanning(c1, c2, comp)
    return pa.table({"a1": c1[far], "a2": c2[far], "b1": c1[root], "b2": c2[root]})


def components(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v in any ordered type -> (u, root): root is the least node that u reaches."""
    check = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    e = store.cut(edges.distinct(), "edges")
    was = check(e)
    while was[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written first: the join then has two plain sides, so Spark broadcasts a small one or splits a hub's many rows
        least = store.cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = store.cut(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = store.cut(star.distinct(), "edges")
        now = check(e)
        if now == was:
            break
        was = now
    return e.select("u", F.col("v").alias("root"))


def _groups(docs: DataFrame, percent: int, k: int) -> DataFrame:
    """doc_id, xxhash64 of the text, n_shingles and component_id, for every row of docs."""
    store.import_path(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    sketch = store.cut(docs.mapInArrow(lambda it: _sketch(it, k), "doc_id bigint, text_key bigint, n_shingles bigint, c1 bigint, c2 bigint, bands array<bigint>"), "sketch")
    classes = store.cut(sketch.where("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    rows = classes.select("c1", "c2", "n", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("c1", "c2")).alias("m1"), F.bit_xor(F.xxhash64("c2", "c1")).alias("m2")).where("c > 1")
    shared = store.cut(shared.groupBy("c", "m1", "m2").agg(F.min("key").alias("key"), F.min("n").alias("n")), "buckets")
    members = store.cut(rows.drop("n").join(store.small(shared.select("key", F.ceil(F.col("n") / CELL_SHINGLES).alias("chunks"), F.ceil(F.col("n") / GRID_SHINGLES).alias("grid")), 24), "key"), "members")
    wanted = members.select("c1", "c2").distinct().join(classes.select("c1", "c2", "doc_id"), ["c1", "c2"]).select("doc_id").distinct()
    wanted = store.small(store.cut(wanted, "wanted"), 8)
    sets = docs.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(lambda it: _sets(it, k), "c1 bigint, c2 bigint, hashes binary").dropDuplicates(["c1", "c2"])
    chunk = lambda n: F.pmod(F.xxhash64("c1", "c2"), F.col(n))
    cells = members.join(sets, ["c1", "c2"]).select("key", "chunks", chunk("chunks").alias("i"), "c1", "c2", "hashes")
    most = shared.agg(F.coalesce(F.max(F.ceil(F.col("n") / CELL_SHINGLES)), F.lit(0))).first()[0]
    links = None
    while most:  # once for each factor of FAN in the largest bucket's number of cells
        out = store.cut(cells.groupBy("key", "i").applyInArrow(lambda t: _links(t, percent), f"{_LINKS}, {_CELL}"), "links")
        own = out.where("a1 is not null").select("a1", "a2", "b1", "b2")
        links = own if links is None else links.unionByName(own)
        cells, most = out.where("a1 is null").select("key", "chunks", "i", "c1", "c2", "hashes"), -(-most // FAN) if most > 1 else 0
    a, b = F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")), F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2"))
    pairs = lambda found: found.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    roots = components(pairs(links)) if links is not None else None
    split = members.where("chunks > 1") if links is not None else None
    if split is not None and not split.isEmpty():
        root = F.coalesce("root", F.struct("c1", "c2"))
        split = split.join(roots.select("u.c1", "u.c2", "root"), ["c1", "c2"], "left").select("key", "grid", "c1", "c2", root["c1"].alias("r1"), root["c2"].alias("r2"))
        torn = store.cut(split.groupBy("key").agg(F.min(F.struct("r1", "r2")).alias("lo"), F.max(F.struct("r1", "r2")).alias("hi")).where("lo <> hi").select("key"), "torn")
        if not torn.isEmpty():
            split = store.cut(split.join(store.small(torn, 8), "key"), "split").withColumn("own", chunk("grid")).withColumn("other", F.explode(F.expr("sequence(0, grid - 1)")))
            late = split.join(sets, ["c1", "c2"]).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "c1", "c2", "r1", "r2", "hashes")
            late = store.cut(late.groupBy("key", "i", "j").applyInArrow(lambda t: _late_links(t, percent), _LINKS), "late")
            roots = components(pairs(late).unionByName(roots.select("u", F.col("root").alias("v"))))
    labels = classes.select("c1", "c2", "doc_id")
    labels = labels.join(roots.select("u.c1", "u.c2", "root"), ["c1", "c2"], "left") if roots is not None else labels.withColumn("root", F.lit(None).cast("struct<c1:bigint,c2:bigint>"))
    labels = labels.withColumn("root", F.coalesce("root", F.struct("c1", "c2")))
    least = labels.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = store.cut(labels.join(least, "root").select("c1", "c2", "component_id"), "labels")
    own_id = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    own_id = F.when(F.col("n_shingles") > 0, own_id).otherwise(F.col("doc_id"))
    return sketch.drop("bands").join(labels, ["c1", "c2"], "left").select("doc_id", "text_key", "n_shingles", own_id.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for every row of docs."""
    return _groups(docs, percent, k).drop("text_key").withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def dedup(docs: DataFrame, percent: int = 85, k: int = 3) -> DataFrame:
    """docs with one document of each group: the one with the smallest doc_id."""
    gone = _groups(docs, percent, k).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key")).distinct()
    gone = store.small(store.cut(gone, "gone"), 16)
    return docs.join(gone, (docs["doc_id"] == F.col("__gone")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left_anti")


def sql(percent: int = 85, k: int = 3, rounds: int = 16) -> str:
    """near_duplicates() in DuckDB's SQL over the table documents; doc_id must be unique. Equal sets are one node; components by `rounds` of taking the least neighbour's."""
    steps = ["r0 AS MATERIALIZED (SELECT c, doc_id AS root FROM c)"]
    steps += [f"r{i} AS MATERIALIZED (SELECT r.c, least(r.root, coalesce(min(o.root), r.root)) AS root FROM r{i - 1} r LEFT JOIN e ON e.a = r.c LEFT JOIN r{i - 1} o ON o.c = e.b GROUP BY r.c, r.root)" for i in range(1, rounds + 1)]
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[p:p + {k - 1}], ' ') FOR p IN range(1, len(w) - {k - 2})] END)) AS g FROM d),
c AS MATERIALIZED (SELECT md5(array_to_string(g, chr(10))) AS c, min(doc_id) AS doc_id, any_value(g) AS g FROM s WHERE len(g) > 0 GROUP BY 1),
x AS MATERIALIZED (SELECT c, len(g) AS n, unnest(g) AS h FROM c),
e0 AS MATERIALIZED (SELECT a.c AS a, b.c AS b FROM x a JOIN x b ON a.h = b.h AND a.c < b.c AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
e AS MATERIALIZED (SELECT a, b FROM e0 UNION ALL SELECT b, a FROM e0),
{", ".join(steps)}
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(root, s.doc_id) AS component_id, coalesce(root, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN r{rounds} r ON r.c = md5(array_to_string(g, chr(10))) AND len(g) > 0"""
