"""Exact top-k inner products by a dual-tree search over cover trees of queries and data.

1. The shared top of all trees comes from a bounded sample (SAMPLE rows, the same ones in
   every run): by farthest-point traversal each new point is the farthest from those before
   it, and it hangs below the nearest point of the level above, levels halving their radius.
2. Every row, query or not, is indexed in one pass: it belongs to the nearest leaf of the
   top, and a query learns a lower bound of its kth score from the sample's rows. Spark
   computes for each leaf how many rows and queries it has, how far they reach, and the
   worst kth score; a row a leaf comes to the driver, nothing else.
3. A pair of nodes is pruned when the largest inner product that its radii allow,
   <q, r> <= <cq, cr> + |cq| rr + |cr| rq + rq rr, is below the worst kth score of its
   queries. Of the leaf pairs that are left, queries are dealt to groups of about QUERY_GROUP
   rows and data to blocks of about DATA_BLOCK, along the tree; a large leaf is split by a
   hash. A cell is a group and a block with a pair between them.
4. In a cell, both sides get a cover tree of their own, down to LEAF rows. Query nodes are
   visited from the root with the data nodes that are still possible for them; a query leaf
   scores data leaves in the order of their bounds, and its worst kth score rises as it goes.
5. Spark merges the k best of each query over its cells.

Neither side is collected: each row travels once for each group or block it may matter to.

Components become floor(256 x). Vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows without a vec_id; shorter vectors count as if filled up
with zeros. Repeated rows (same id, same vector) count once; other rows that share the
query's vec_id are no candidates. Ties go to the smaller vec_id. Empty table, or one without queries: no rows. Further columns are not read. Scores are exact up to 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.llm import store

SAMPLE, LEAVES = 4096, 128
QUERY_GROUP, DATA_BLOCK = 16_384, 4_096
LEAF, FAN = 64, 8
#: Rows scored at once for a query leaf.
BATCH = 512
_SLACK = 1e-9


class CoverTree:
    """points: of the leaves, in the order of traversal; levels: arrays of the parent of each node in the level above."""

    def __init__(self, sample: np.ndarray, leaves: int):
        order, near = [0], np.linalg.norm(sample - sample[0], axis=1)
        reach = [np.inf]
        while len(order) < min(leaves, len(sample)) and near.max() > 0:
            far = int(near.argmax())
            order.append(far)
            reach.append(float(near[far]))
            near = np.minimum(near, np.linalg.norm(sample - sample[far], axis=1))
        self.points = sample[order]
        # a level holds the points picked while the radius was at least its own
        sizes, radius = [], reach[1] if len(reach) > 1 else 0.0
        while not sizes or sizes[-1] < len(order):
            sizes.append(max(1, int(np.sum(np.array(reach) >= radius))) if radius > reach[-1] else len(order))
            radius /= 2
        self.sizes = [1, *sizes] if sizes[0] > 1 else sizes
        self.parents = [nearest(self.points[:n], self.points[:up]) for up, n in zip(self.sizes, self.sizes[1:], strict=False)]

    def cover(self, leaf_radius: np.ndarray) -> list[np.ndarray]:
        """Covering radii of all levels from those of the leaves (negative: nothing below)."""
        radii = [leaf_radius]
        for up, parent in zip(reversed(self.sizes[:-1]), reversed(self.parents), strict=True):
            below = radii[0]
            reach = np.where(below >= 0, np.linalg.norm(self.points[: len(parent)] - self.points[parent], axis=1) + below, -1.0)
            out = np.full(up, -1.0)
            np.maximum.at(out, parent, reach)
            radii.insert(0, out)
        return radii

    def pairs(self, query_radius: np.ndarray, data_radius: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """Dual-tree descent: which leaf of queries may have a better candidate in which leaf of data."""
        rq, rd = self.cover(query_radius), self.cover(data_radius)
        low = [worst]
        for up, parent in zip(reversed(self.sizes[:-1]), reversed(self.parents), strict=True):
            out = np.full(up, np.inf)
            np.minimum.at(out, parent, low[0])
            low.insert(0, out)
        alive = np.array([[0, 0]])
        for level, n in enumerate(self.sizes):
            if level:  # children of both nodes of each surviving pair
                kids = np.argsort(self.parents[level - 1], kind="stable")
                edge = np.searchsorted(self.parents[level - 1][kids], np.arange(self.sizes[level - 1] + 1))
                alive = np.concatenate([np.stack(np.meshgrid(kids[edge[a] : edge[a + 1]], kids[edge[b] : edge[b + 1]], indexing="ij"), -1).reshape(-1, 2) for a, b in alive.tolist()] or [np.zeros((0, 2), int)])
            q, d = alive.T
            top = bound(self.points[q], self.points[d], rq[level][q], rd[level][d])
            alive = alive[(rq[level][q] >= 0) & (rd[level][d] >= 0) & (top >= low[level][q])]
        out = np.zeros((n, n), bool)
        out[alive[:, 0], alive[:, 1]] = True
        return out


def bound(cq: np.ndarray, cd: np.ndarray, rq: np.ndarray, rd: np.ndarray) -> np.ndarray:
    """The largest inner product of points within rq of cq and rd of cd, row by row."""
    nq, nd = np.linalg.norm(cq, axis=1), np.linalg.norm(cd, axis=1)
    top = (cq * cd).sum(1) + nq * rd + nd * rq + rq * rd
    return top + _SLACK * (1 + (nq + rq) * (nd + rd))


class Tree:
    """A cover tree of the rows of one side of a cell. Nodes in order of their making: centre, radius, kids, and the rows order[first:last]."""

    def __init__(self, rows: np.ndarray, leaf: int, fan: int):
        self.order = np.arange(len(rows))
        self.first, self.last, self.kids, centres, radii = [], [], [], [], []
        todo = [(0, len(rows), int(np.argmin(np.linalg.norm(rows - rows.mean(0), axis=1))), -1)]
        while todo:
            a, z, centre, parent = todo.pop()
            own = self.order[a:z]
            near = np.linalg.norm(rows[own] - rows[centre], axis=1)
            node, radius = len(self.first), float(near.max())
            self.first.append(a)
            self.last.append(z)
            self.kids.append([])
            centres.append(centre)
            radii.append(radius)
            if parent >= 0:
                self.kids[parent].append(node)
            if z - a <= leaf or radius == 0:
                continue
            points, to = [centre], np.zeros(z - a, int)
            while len(points) < fan and near.max() > 0:  # each new point is the farthest from those before it
                far = int(near.argmax())
                dist = np.linalg.norm(rows[own] - rows[own[far]], axis=1)
                to[dist < near] = len(points)
                points.append(int(own[far]))
                near = np.minimum(near, dist)
            by = np.argsort(to, kind="stable")
            self.order[a:z] = own[by]
            edge = a + np.searchsorted(to[by], np.arange(len(points) + 1))
            todo += [(edge[i], edge[i + 1], c, node) for i, c in enumerate(points) if edge[i] < edge[i + 1]]
        self.centre, self.radius = rows[centres], np.array(radii)
        self.inner = np.array([bool(k) for k in self.kids])

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The kids of inner nodes, and the leaves."""
        inner = self.inner[nodes]
        return np.concatenate([nodes[~inner], *(np.array(self.kids[n]) for n in nodes[inner].tolist())]).astype(int)


def search(q_ids: np.ndarray, q: np.ndarray, worst: np.ndarray, d_ids: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best scores and ids of each query, empty places with the score -inf, and how many pairs were scored.

    worst: lower bounds of the kth scores; what is below them may be left out.
    """
    best, who = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    if not len(q) or not len(d):
        return best, who, 0
    tq, td, worst, scored = Tree(q, LEAF, FAN), Tree(d, LEAF, FAN), worst.copy(), 0
    todo = [(0, np.zeros(1, int))]
    while todo:
        node, near = todo.pop()
        rows = tq.order[tq.first[node] : tq.last[node]]

        def kept(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            top = bound(tq.centre[[node]], td.centre[near], tq.radius[node], td.radius[near])
            ok = top >= worst[rows].min()
            return near[ok], top[ok]

        near, top = kept(near)
        if tq.kids[node]:
            if len(near):
                todo += [(kid, td.below(near)) for kid in tq.kids[node]]
            continue
        while td.inner[near].any():
            near, top = kept(td.below(near))
        by = np.argsort(-top, kind="stable")
        near, top, at = near[by], top[by], 0
        size = np.cumsum([td.last[n] - td.first[n] for n in near.tolist()])
        while at < len(near) and top[at] >= worst[rows].min():
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH, side="right")))
            own = np.concatenate([td.order[td.first[n] : td.last[n]] for n in near[at:to].tolist()])
            score = q[rows] @ d[own].T
            scored += score.size
            score[q_ids[rows][:, None] == d_ids[own][None, :]] = -np.inf
            hit = np.flatnonzero((score >= worst[rows][:, None]).any(1))
            if len(hit):
                r = rows[hit]
                s = np.concatenate([best[r], score[hit]], 1)
                i = np.concatenate([who[r], np.broadcast_to(d_ids[own], (len(hit), len(own)))], 1)
                best[r], who[r] = _best(s, i, k)
                worst[r] = np.maximum(worst[r], best[r, -1])
            at = to
    return best, who, scored


def nearest(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return ((points * points).sum(1)[None, :] - 2 * rows @ points.T).argmin(1) if len(rows) else np.zeros(0, int)


def matrix(arr: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, filled up with zeros."""
    flat = arr.flatten().to_numpy().astype(np.float64)
    sizes = np.diff(np.frombuffer(arr.buffers()[1], np.int32)[arr.offset : arr.offset + len(arr) + 1]) if len(arr) else np.zeros(0, int)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def quantized(table: DataFrame, embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and code (array of bigint) of the rows that take part."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    code = F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return table.where(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite).select(F.col("vec_id").cast("bigint").alias("vec_id"), code.alias("code"))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k best columns of each row, by score, then smaller id; empty places have the score -inf."""
    if score.shape[1] > 8 * k:  # first drop what is below the kth score
        kth = np.partition(score, score.shape[1] - k, axis=1)[:, -k]
        keep = score >= kth[:, None]
        width = keep.sum(1).max()
        if width < score.shape[1] // 2:
            col = np.argsort(~keep, axis=1, kind="stable")[:, :width]
            score = np.where(np.take_along_axis(keep, col, 1), np.take_along_axis(score, col, 1), -np.inf)
            ids = np.take_along_axis(ids, col, 1)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def _index(batches: Iterator[pa.RecordBatch], shared, divisor: int, k: int) -> Iterator[pa.RecordBatch]:
    """Each row with its leaf of the top, its distance to it, and for queries a lower bound of the kth score."""
    points, sample_ids, sample = shared.value
    for b in batches:
        ids, codes = b.column(0).to_numpy(), matrix(b.column(1), points.shape[1])
        leaf = nearest(codes, points)
        kth, query = np.full(len(ids), np.nan), np.flatnonzero(ids % divisor == 0)
        for a in range(0, len(query), 512):
            own = query[a : a + 512]
            s = codes[own] @ sample.T
            s[ids[own][:, None] == sample_ids[None, :]] = -np.inf
            kth[own] = np.partition(s, s.shape[1] - k, axis=1)[:, -k] if s.shape[1] >= k else -np.inf
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32()), pa.array(np.linalg.norm(codes - points[leaf], axis=1)), pa.array(kth, mask=np.isnan(kth))], names=["vec_id", "code", "leaf", "dist", "kth"])


def _numbered(sizes: list[int], least: int) -> list[tuple[int, int]]:
    """(first number, parts) of each leaf: small neighbours share a number until they have `least` rows, a large one has several."""
    out, number, filled = [], 0, 0
    for n in sizes:
        if n > least or filled + n > least:
            number, filled = number + (filled > 0), 0
        parts = max(1, -(-n // least))
        out.append((number, parts))
        number, filled = (number + parts, 0) if parts > 1 else (number, filled + n)
    return out


def _ranges(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first, last) of the numbers in use."""
    out = []
    for first, parts in sorted(set(places)):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], first + parts - 1))
        else:
            out.append((first, first + parts - 1))
    return out


def deal(tree: CoverTree, asked: list[int], held: list[int], pairs: np.ndarray) -> list[tuple]:
    """For each leaf: group of its queries (first, parts), the blocks they meet (runs), block of its data (first, parts), the groups these meet (runs)."""
    order = np.arange(len(asked))
    keys = [order]
    for parent in reversed(tree.parents):  # leaves of one subtree next to each other
        keys.append(parent[keys[-1]])
    order = np.lexsort(keys).tolist()
    group, block = [None] * len(order), [None] * len(order)
    for places, sizes, least in ((group, asked, QUERY_GROUP), (block, held, DATA_BLOCK)):
        for leaf, place in zip(order, _numbered([sizes[i] for i in order], least), strict=True):
            places[leaf] = place
    out = []
    for leaf in range(len(order)):
        mates = [i for i in order if asked[i] and group[i] == group[leaf]]
        meets = [block[j] for j in order if held[j] and any(pairs[i, j] for i in mates)]
        wanted = [group[i] for i in order if asked[i] and pairs[i, leaf]]
        out.append((leaf, *group[leaf], _ranges(meets), *block[leaf], _ranges(wanted)))
    return out


def _cell(q: pa.Table, d: pa.Table, width: int, k: int) -> pa.Table:
    q, d = q.combine_chunks(), d.combine_chunks()
    ids = q.column("query_id").to_numpy()
    best, who, _ = search(ids, matrix(_one(q, "query"), width), q.column("kth").to_numpy(), d.column("vec_id").to_numpy(), matrix(_one(d, "code"), width), k)
    full = best > -np.inf
    return pa.table({"query_id": np.repeat(ids, full.sum(1)), "vec_id": who[full], "score": best[full].astype(np.int64)})


def _one(t: pa.Table, column: str) -> pa.Array:
    return pa.concat_arrays(t.column(column).chunks) if t.num_rows else pa.array([], t.schema.field(column).type)


def top_k(table: DataFrame, divisor: int = 50, k: int = 5, leaves: int = LEAVES) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each row whose vec_id is divisible by divisor."""
    spark = table.sparkSession
    store.import_path(spark)
    rows = quantized(table)
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().combine_chunks()
    if not sample.num_rows:
        return none
    width = rows.agg(F.max(F.size("code"))).first()[0]
    ids, codes = sample.column(0).to_numpy(), matrix(_one(sample, "code"), width)
    _, once = np.unique(np.column_stack([ids, codes]), axis=0, return_index=True)  # a row twice would count twice in the kth scores
    ids, codes = ids[once], codes[once]
    tree = CoverTree(codes, leaves)
    shared = spark.sparkContext.broadcast((tree.points, ids, codes))
    indexed = rows.mapInArrow(lambda it: _index(it, shared, divisor, k), "vec_id bigint, code array<bigint>, leaf int, dist double, kth double")
    indexed = store.cut(indexed.distinct(), "indexed")
    asks = F.col("kth").isNotNull()
    stats = indexed.groupBy("leaf").agg(F.count("*"), F.count_if(asks), F.max("dist"), F.max(F.when(asks, F.col("dist"))), F.min("kth")).collect()  # a row a leaf
    n = len(tree.points)
    held, asked, far, reach, worst = [0] * n, [0] * n, np.full(n, -1.0), np.full(n, -1.0), np.full(n, np.inf)
    for leaf, rows_, queries, f, r, w in stats:
        held[leaf], asked[leaf], far[leaf] = rows_, queries, f
        if queries:
            reach[leaf], worst[leaf] = r, w
    if not sum(asked):
        return none
    run = "array<struct<a:int,z:int>>"
    dealt = spark.createDataFrame(deal(tree, asked, held, tree.pairs(reach, far, worst)), f"leaf int, g int, g_parts int, blocks {run}, b int, b_parts int, groups {run}")
    rows = indexed.join(F.broadcast(dealt), "leaf")  # a row a leaf
    part = lambda first, parts: (F.col(first) + F.pmod(F.xxhash64("vec_id"), F.col(parts))).cast("int")
    each = lambda runs: F.explode(F.flatten(F.transform(runs, lambda r: F.sequence(r["a"], r["z"]))))
    q = rows.where("kth is not null").select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"), "kth", part("g", "g_parts").alias("grp"), each("blocks").alias("blk"))
    d = rows.select("vec_id", "code", each("groups").alias("grp"), part("b", "b_parts").alias("blk"))
    found = q.groupBy("grp", "blk").cogroup(d.groupBy("grp", "blk")).applyInArrow(lambda a, z: _cell(a, z, width, k), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS code FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.code, c.code) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""
