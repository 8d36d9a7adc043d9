"""Hard negatives by distributed radix selection over integer scores.

A window is an anchor with a range of scores and a number k of rows wanted from it, best scores
first. To find its kth score, anchors meet all rows in cells (a group of anchors and a block of
rows), each of which counts the window's scores by their highest digit; Spark adds the
counts up, finds the digit in which the kth row lies, and the next round counts the next digit
within it only, until the kth score itself is known. A cell leaves out digits below those in
which it has k rows of its own: the kth row of all can't lie there. Then each cell hands out
the rows above the kth score (fewer than k in all cells together) and, of those that tie with it,
the ones with the smallest vec_id, as many as are still wanted; a last ranking puts them in order.

The same selection runs twice: for the positives of an anchor (rows of its label, all
scores), and for the negatives of each positive (rows of other labels, scores between LOW and
HIGH hundredths of the positive's).

Neither side is collected or broadcast. A row travels once for each group of anchors and
an anchor once for each block of rows; both are of the same size, up to CELL rows, which makes
the sum of both travels least.

Components become floor(256 x). Rows with a null vec_id, label or vector, or with a null or
non-finite component, take no part. Shorter vectors count as if filled up with zeros (an empty
one scores 0). Repeated rows (same vec_id, label and vector) count once; rows that share the
anchor's vec_id are not other rows. Ties go to the smaller vec_id. An anchor without rows of its
label has no positives, a positive whose window is empty or whose score is negative has no
negatives: both give no rows, as does an empty table. Scores are exact up to 2**53; components are
held to +-2**53 and scores to +-2**61. Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.llm import store

POSITIVES, NEGATIVES = 5, 3
#: Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
#: Bits of a digit; rows on one side of a cell, at most; scores held at once.
DIGIT, CELL, SCORES = 10, 32_768, 1 << 20
_WINDOW = "struct<win:int,lo:bigint,hi:bigint,need:int>"
_FLOAT_LIMIT, _LIMIT = float(1 << 53), float(1 << 61)
_OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def participants(table: DataFrame, vec_id: Column, label: Column, embedding: Column) -> DataFrame:
    """vec_id, label and code (array<double> of floor(256 x)) of the rows that take part, each once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    x = embedding.cast("array<double>")
    code = F.transform(x, lambda v: F.greatest(F.least(F.nanvl(F.lit(256.0) * v, F.lit(0.0)), F.lit(_FLOAT_LIMIT)), F.lit(-_FLOAT_LIMIT)))
    rows = table.select(vec_id.cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), x.alias("x"), F.transform(code, lambda v: F.floor(v).cast("double")).alias("code"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("x", finite), F.lit(False))).select("vec_id", "label", "code").distinct()


def _packed(batches, width: int):
    """code as the bytes of `width` doubles."""
    for b in batches:
        codes = b.column(2).combine_chunks() if isinstance(b.column(2), pa.ChunkedArray) else b.column(2)
        out = np.zeros((b.num_rows, width))
        sizes = np.diff(codes.offsets.to_numpy())
        row = np.repeat(np.arange(b.num_rows), sizes)
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = codes.flatten().to_numpy()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in out], pa.binary())], names=["vec_id", "label", "code"])


def _matrix(t: pa.Table, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("code").to_pylist()), np.float64).reshape(t.num_rows, width)


class Selection:
    """What a cell needs to know of a round. shift: bits below the digit, or None to hand out rows."""

    def __init__(self, width: int, same: bool, shift: int | None):
        self.width, self.same, self.shift = width, same, shift

    def cell(self, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """Counts (aid, win, digit, n), or rows (aid, win, vec_id, score)."""
        a, r = _matrix(anchors, self.width), _matrix(rows, self.width)
        aid, own, label = (anchors.column(c).to_numpy() for c in ("aid", "vec_id", "label"))
        vec, kind = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        by_id = np.argsort(vec, kind="stable")  # so ties come by vec_id
        r, vec, kind = r[by_id], vec[by_id], kind[by_id]
        windows = anchors.column("windows").to_pylist()
        slots = max((len(w or ()) for w in windows), default=0)
        out: list[list[np.ndarray]] = [[], [], [], []]
        step = max(1, SCORES // max(1, len(vec)))
        for at in range(0, len(aid) if len(vec) else 0, step):
            part = slice(at, at + step)
            s = np.clip(a[part] @ r.T, -_LIMIT, _LIMIT).astype(np.int64)
            able = ((label[part, None] == kind) == self.same) & (own[part, None] != vec)
            for slot in range(slots):
                mine = [w[slot] if w and slot < len(w) else {"win": 0, "lo": 1, "hi": 0, "need": 0} for w in windows[part]]
                win, lo, hi, need = (np.array([w[c] for w in mine], np.int64) for c in ("win", "lo", "hi", "need"))
                i, j = np.nonzero(able & (s >= lo[:, None]) & (s <= hi[:, None]))
                found = self._counts(i, hi[i] - s[i, j], need) if self.shift is not None else self._rows(i, s[i, j], vec[j], lo, need)
                for column, values in zip(out, (aid[part][found[0]], win[found[0]], *found[1:]), strict=True):
                    column.append(values)
        names = ["aid", "win", "digit", "n"] if self.shift is not None else ["aid", "win", "vec_id", "score"]
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], names=names)

    def _counts(self, i: np.ndarray, below: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, ...]:
        size = 1 << DIGIT
        n = np.bincount(i * size + (below >> self.shift), minlength=len(need) * size).reshape(-1, size)
        before = np.cumsum(n, axis=1) - n
        which, digit = np.nonzero((n > 0) & (before < need[:, None]))
        return which, digit, n[which, digit]

    def _rows(self, i: np.ndarray, score: np.ndarray, vec: np.ndarray, lo: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows above lo, and the first `need` (by vec_id) of those at it."""
        tie = score == lo[i]
        nth = np.cumsum(tie)
        before = np.concatenate([[0], nth])[np.searchsorted(i, np.arange(len(lo)))]  # ties of the anchors before; i rises
        take = ~tie | (nth - before[i] <= need[i])
        return i[take], vec[take], score[take]


def _cells(anchors: DataFrame, rows: DataFrame, groups: int, parts: int, job: Selection) -> DataFrame:
    q = anchors.select("aid", "vec_id", "label", "code", "windows", F.pmod(F.xxhash64("aid"), F.lit(groups)).alias("grp"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("blk"))
    d = rows.select("vec_id", "label", "code", F.pmod(F.xxhash64("vec_id", "label", "code"), F.lit(parts)).alias("blk"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("grp"))
    schema = "aid bigint, win bigint, digit bigint, n bigint" if job.shift is not None else "aid bigint, win bigint, vec_id bigint, score bigint"
    return q.groupBy("grp", "blk").cogroup(d.groupBy("grp", "blk")).applyInArrow(lambda x, y: job.cell(x, y), schema)


def select(anchors: DataFrame, rows: DataFrame, windows: DataFrame, span: int, same: bool, width: int, sizes: tuple[int, int], k: int) -> DataFrame:
    """aid, win, vec_id, score and rank of the k best rows of each window, all if fewer.

    anchors: aid, vec_id, label, code; windows: aid, windows (array of win, lo, hi, need = k); span: the number of scores of the widest window.
    sizes: groups of anchors, blocks of rows.
    """
    groups, parts = sizes
    open_ = windows.select("aid", F.explode("windows").alias("w")).select("aid", "w.*")
    state = store.cut(open_.withColumns({"top": F.col("hi"), "settled": F.lit(False)}), "windows")
    shift = max(0, -(-(max(span, 1) - 1).bit_length() // DIGIT) * DIGIT)
    asked = lambda w: w.groupBy("aid").agg(F.collect_list(F.struct("win", "lo", "hi", "need").cast(_WINDOW)).alias("windows"))
    while shift > 0:
        shift -= DIGIT
        counted = _cells(anchors.join(asked(state.where("not settled")), "aid"), rows, groups, parts, Selection(width, same, shift))
        total = counted.groupBy("aid", F.col("win").cast("int").alias("win"), "digit").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(W.partitionBy("aid", "win").orderBy("digit"))
        place = total.withColumn("upto", upto).join(state.select("aid", "win", F.col("need").alias("wanted")), ["aid", "win"]).where("upto >= wanted and upto - n < wanted").select("aid", "win", "digit", (F.col("upto") - F.col("n")).alias("before"))
        # no digit: the window holds fewer rows than wanted, and all of them qualify
        rest = state.join(place, ["aid", "win"], "left").withColumn("hit", F.col("digit").isNotNull() & ~F.col("settled"))
        edge = F.col("hi") - F.shiftleft(F.col("digit"), shift)
        state = store.cut(
            rest.select(
                "aid", "win",
                F.when(F.col("hit"), F.greatest(F.col("lo"), edge - ((1 << shift) - 1))).otherwise(F.col("lo")).alias("lo"),
                F.when(F.col("hit"), edge).otherwise(F.col("hi")).alias("hi"),
                F.when(F.col("hit"), (F.col("need") - F.col("before")).cast("int")).otherwise(F.col("need")).alias("need"),
                "top", (~F.col("hit")).alias("settled"),
            ), "windows")
    ready = state.select("aid", "win", "lo", F.col("top").alias("hi"), "need")
    found = _cells(anchors.join(asked(ready), "aid"), rows, groups, parts, Selection(width, same, None))
    rank = F.row_number().over(W.partitionBy("aid", "win").orderBy(F.desc("score"), "vec_id"))
    return found.select("aid", F.col("win").cast("int").alias("win"), "vec_id", "score", rank.alias("rank")).where(F.col("rank") <= k)


def mine(rows: DataFrame, divisor: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. rows: as of participants; anchors: rows whose vec_id is divisible by divisor."""
    spark = rows.sparkSession
    store.import_path(spark)
    rows = store.cut(rows, "vectors")
    is_anchor = F.col("vec_id") % divisor == 0
    n, asked, width = rows.agg(F.count("*"), F.count_if(is_anchor), F.max(F.size("code"))).first()
    if not asked:
        return spark.createDataFrame([], _OUT)
    width = max(width, 1)
    norm = rows.agg(F.max(F.aggregate("code", F.lit(0.0), lambda t, x: t + x * x))).first()[0] or 0.0
    most = int(min(norm * (1 + 1e-9) + 1, _LIMIT))  # of any score, by Cauchy and Schwarz
    rows = store.cut(rows.mapInArrow(lambda it: _packed(it, width), "vec_id bigint, label bigint, code binary"), "vectors")
    anchors = store.cut(rows.where(is_anchor).select(F.monotonically_increasing_id().alias("aid"), "vec_id", "label", "code"), "anchors")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = (-(-asked // CELL), max(-(-n // CELL), min(tasks, -(-n // 1024))))
    wide = lambda lo, hi, k: F.struct(F.lit(0).alias("win"), F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"), F.lit(k).alias("need"))
    first = select(anchors, rows, anchors.select("aid", F.array(wide(-most, most, positives)).alias("windows")), 2 * most + 1, True, width, sizes, positives)
    first = store.cut(first.select("aid", F.col("rank").alias("win"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score").cast("decimal(20,0)")
    bounds = first.where("positive_score >= 0").select("aid", "win", F.expr(f"cast((cast(positive_score as decimal(20,0)) * {low} + 99) div 100 as bigint)").alias("lo"), F.floor(p * high / 100).cast("bigint").alias("hi"), F.lit(negatives).alias("need")).where("lo <= hi")
    span = bounds.agg(F.max(F.col("hi") - F.col("lo") + 1)).first()[0]
    if span is None:
        return spark.createDataFrame([], _OUT)
    windows = bounds.groupBy("aid").agg(F.collect_list(F.struct("win", "lo", "hi", "need")).alias("windows"))
    found = select(anchors, rows, windows, span, False, width, sizes, negatives)
    named = found.join(first, ["aid", "win"]).join(anchors.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH v AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS code
  FROM embeddings WHERE label IS NOT NULL),
s AS MATERIALIZED (
  SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same, CAST(list_inner_product(q.code, c.code) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
