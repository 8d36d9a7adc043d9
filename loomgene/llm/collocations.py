"""Phrases by hierarchical pair naming: a frequent k-gram is a pair of frequent (k-1)-grams that overlap.

1. Each task turns the texts of a block into numbers of the block's own distinct words, with a
   break between pieces, and counts them. Words are dealt to buckets by a hash, where the
   counts of all blocks are added up by language and word (the words themselves are compared) and
   the frequent ones get global ids.
2. For k = 2 to 5: ids come back to the blocks that use them, each block replaces its numbers by
   ids, breaks where an item isn't frequent, and numbers its distinct pairs of adjacent ids.
   Pairs meet in buckets in the same way: a pair that is frequent over all blocks gets an id and
   is a k-gram, its two ids are its parents.
3. The parents are the way back: the left parent of a phrase is the phrase without its last word,
   the right one that without its first, so counts of all prefixes and suffixes (and so all
   cuts) come level by level from joins with the parents, and a phrase lies in a longer one of as
   many occurrences if and only if it is a parent of such a one (counts of phrases in between lie
   in between).

What leaves a block are its distinct items with their counts, packed (about six bytes a pair), so however
frequent an item is, it costs one entry a block. Blocks hold about BLOCK bytes; a longer text is
divided at breaks between pieces, so no phrase is lost, and a piece of any length stays whole. There are
as many buckets as the measured bytes of text ask for (BUCKET_TEXT each). Nothing is broadcast.

Words are `[^\\x20\\x09]+` of the pieces between any of `.,;:!?\\x0A-\\x0D`, A-Z lower-cased. Null or
empty text has no words; null language is `und`, together with rows that say so. Languages without
a phrase of LEAST occurrences, and empty tables, give no rows. Repeated rows count each. Ties
of the cuts go to the smallest k, ties of phrases as in `phrases`. Only the columns lang and text are read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

LEAST, LONGEST, TOP, SHARE = 100, 5, 2000, 100
#: Text of one block.
BLOCK = 4 << 20
#: Text whose items share a bucket.
BUCKET_TEXT = 32 << 20
_BREAK = re.compile(rb"[.,;:!?\n-\r]")
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\v\f\r")] = True
_WORD = ~_BREAKS
_WORD[[0x20, 0x09]] = False
_STATE = "block bigint, lang string, n bigint, codes binary, bucket int, first bigint, words array<string>, lefts binary, rights binary, counts binary"
_STATE_ARROW = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("codes", pa.binary()), ("bucket", pa.int32()), ("first", pa.int64()), ("words", pa.list_(pa.string())), ("lefts", pa.binary()), ("rights", pa.binary()), ("counts", pa.binary())])
_MET = "block bigint, numbers binary, ids binary, lang string, word string, `left` bigint, `right` bigint, a bigint, id bigint"
_MET_ARROW = pa.schema([("block", pa.int64()), ("numbers", pa.binary()), ("ids", pa.binary()), ("lang", pa.string()), ("word", pa.string()), ("left", pa.int64()), ("right", pa.int64()), ("a", pa.int64()), ("id", pa.int64())])


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from -1 in as few bytes each as they need, compressed byte by byte: all first bytes, then all second ones."""
    most = int(numbers.max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    size = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, size).T)
    return bytes([size]) + len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    size, n = raw[0], int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(pa.decompress(raw[9:], size * n, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view({1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[size]).ravel()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Languages with about BLOCK bytes of their texts, lower-cased, texts apart by line feeds."""
    batch = batch.sort_by("lang")
    langs = batch.column(0).dictionary_encode()
    of = langs.indices.to_numpy()
    edges = np.flatnonzero(np.diff(of, prepend=-1, append=-1)).tolist() if len(of) else []
    for a, z in zip(edges, edges[1:]):
        lang = langs.dictionary[int(of[a])].as_py()
        for part in blocks.slices([batch.slice(a, z - a)], col="text", limit=BLOCK):
            raw = b"\n".join([t.as_buffer().to_pybytes() for t in part.column(1) if t.is_valid]).lower()  # bytes.lower() knows A-Z only
            at = 0
            while len(raw) - at > 2 * BLOCK and (cut := _BREAK.search(raw, at + BLOCK)):
                yield lang, raw[at : cut.end()]
                at = cut.end()
            yield lang, raw[at:] if at else raw


def _words(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Each word's number, with -1 before each piece, and the distinct words."""
    buf = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = _WORD[buf]
    edge = inside[1:] != inside[:-1]
    starts, ends = np.flatnonzero(edge).reshape(-1, 2).T
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside[1:-1]])]).dictionary_encode()
    codes = found.indices.to_numpy()
    pieces = np.cumsum(_BREAKS[buf], dtype=np.int32)[starts] if len(starts) else starts
    new = np.flatnonzero(np.diff(pieces, prepend=-1))
    return np.insert(codes, new, -1), found.dictionary.cast(pa.string())


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items in the order of their buckets, and the number that each gets by it."""
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return order, number


def _dealt(block: int, own: dict, bucket: np.ndarray, counts: np.ndarray, items, **shared) -> pa.RecordBatch:
    """A block's own row, and a row for each bucket that gets some of its items, in the order of their numbers.

    items(order): what says which items these are, as a function of a slice of the order.
    """
    order, _ = _by_bucket(bucket)
    full, first = np.unique(bucket[order], return_index=True)
    rows = [{"block": block, "n": int(counts.sum())} | own | shared]
    for b, x, y in zip(full.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        rows.append({"block": block, "bucket": b, "first": x, "counts": _packed(counts[order[x:y]])} | shared | items(order[x:y]))
    return pa.RecordBatch.from_pylist(rows, schema=_STATE_ARROW)


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for lang, raw in _texts(batch):
            codes, words = _words(raw)
            if not len(words):
                continue
            salt = zlib.crc32(lang.encode())
            bucket = np.array([zlib.crc32(w.as_buffer(), salt) % buckets for w in words], np.int32)
            number = np.append(_by_bucket(bucket)[1], -1)  # the last stands for breaks
            counts = np.bincount(codes[codes >= 0], minlength=len(words))
            yield _dealt(block, {"codes": _packed(number[codes])}, bucket, counts, lambda at: {"words": words.take(pa.array(at)).to_pylist()}, lang=lang)
            block += 1


def _adjacent(at: np.ndarray, name: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a sequence of items (-1: a break) with the ids `name`: where pairs begin, which pair it is there, how often each occurs, its key and its bucket."""
    both = (at[:-1] >= 0) & (at[1:] >= 0)
    key, which, n = np.unique(at[:-1][both].astype(np.int64) * len(name) + at[1:][both], return_inverse=True, return_counts=True)
    mixed = blocks.mix(name[key // len(name)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + name[key % len(name)].astype(np.uint64))
    return both, which, n, key, (mixed % np.uint64(buckets)).astype(np.int32)


def _pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """From a block's sequence and the ids of its frequent items (`named`) to the sequence of these, and its pairs of adjacent ones.

    The sequence is that of words where `lefts` is null, else of the items whose ids these are, the pairs of which are meant.
    """
    for batch in batches:
        for block, raw, ids, named in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), strict=True):
            codes = _unpacked(raw.as_py())
            if ids.is_valid:  # numbers of pairs as they were dealt: derived again, as the shorter sequence travels
                both, which, _, _, bucket = _adjacent(codes, np.cumsum(_unpacked(ids.as_py()).astype(np.int64)), buckets)
                codes = np.full(len(both), -1, np.int64)
                codes[both] = _by_bucket(bucket)[1][which]
            number = np.concatenate([_unpacked(x["numbers"].as_py()) for x in named])
            name = np.concatenate([_unpacked(x["ids"].as_py()) for x in named]).astype(np.int64)
            name, number = (x[np.argsort(name)] for x in (name, number))  # so pairs come by their left id
            own = np.full(int(max(codes.max(initial=0), number.max(initial=0))) + 2, -1, np.int64)  # the last stands for breaks
            own[number] = np.arange(len(number))
            at = own[codes]
            at = at[(at >= 0) | np.concatenate([at[:1] >= 0, at[:-1] >= 0])]  # one break in a row is enough
            _, _, n, key, bucket = _adjacent(at, name, buckets)
            if len(key):
                left, right = name[key // len(name)], name[key % len(name)]
                state = {"codes": _packed(at), "lefts": _packed(np.diff(name, prepend=0))}
                yield _dealt(block, state, bucket, n, lambda at: {"lefts": _packed(np.diff(left[at], prepend=0)), "rights": _packed(right[at])})  # noqa: B023


def _meet(table: pa.Table, least: int, buckets: int) -> pa.Table:
    """Of one bucket: the items that are frequent over all blocks, with new ids, and for each block the numbers of those it holds."""
    counts = [_unpacked(c) for c in table.column("counts").to_pylist()]
    n = np.concatenate(counts).astype(np.int64)
    sizes = [len(c) for c in counts]
    if table.column("words").null_count:
        left = np.concatenate([np.cumsum(_unpacked(x).astype(np.int64)) for x in table.column("lefts").to_pylist()])
        right = np.concatenate([_unpacked(x).astype(np.int64) for x in table.column("rights").to_pylist()])
        (ls, x), (rs, y) = (np.unique(v, return_inverse=True) for v in (left, right))
        says = lambda k: {"left": ls[k // len(rs)].tolist(), "right": rs[k % len(rs)].tolist()}
    else:
        langs = table.column("lang").combine_chunks().dictionary_encode()
        words = pa.concat_arrays([c.flatten() for c in table.column("words").chunks]).dictionary_encode()
        x, y, rs = np.repeat(langs.indices.to_numpy(), sizes), words.indices.to_numpy(), words.dictionary
        says = lambda k: {"lang": langs.dictionary.take(pa.array(k // len(rs))).to_pylist(), "word": rs.take(pa.array(k % len(rs))).to_pylist()}
    key, which = np.unique(x.astype(np.int64) * len(rs) + y, return_inverse=True)
    total = np.bincount(which, n, len(key)).astype(np.int64)  # sums below 2**53 are exact
    often = np.flatnonzero(total >= least)
    name = np.full(len(key), -1, np.int64)
    name[often] = np.arange(len(often)) * buckets + table.column("bucket")[0].as_py()  # close to dense, so ids stay short
    found = {"a": total[often].tolist(), "id": name[often].tolist()} | says(key[often])
    rows = [dict(zip(found, values, strict=True)) for values in zip(*found.values(), strict=True)]
    ids, at = name[which], 0
    for block, first, size in zip(table.column("block").to_pylist(), table.column("first").to_pylist(), sizes, strict=True):
        own = ids[at : at + size]
        if (own >= 0).any():
            rows.append({"block": block, "numbers": _packed(np.flatnonzero(own >= 0) + first), "ids": _packed(own[own >= 0])})
        at += size
    return pa.Table.from_pylist(rows, schema=_MET_ARROW)


def _heavy(df: DataFrame, name: str) -> DataFrame:
    """store.cut for rows of megabytes: Parquet looks at its buffers after every row."""
    path = f"{store.shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.page.size.row.check.min", "1").option("parquet.block.size", str(32 << 20)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ngrams(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and for each length the phrases of `least` occurrences or more.

    Of length 1: lang, word, a, id; of length k: left, right (ids of the phrases of k - 1 words that begin and end it), a, id.
    """
    spark = docs.sparkSession
    store.import_path(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_TEXT))
    found = _heavy(texts.mapInArrow(lambda it: _blocks(it, buckets), _STATE), "words")
    totals = found.where("codes is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    levels = []
    for k in range(1, longest + 1):
        items = found.where("bucket is not null").select("bucket", "block", "lang", "first", "words", "lefts", "rights", "counts")
        met = store.cut(items.groupBy("bucket").applyInArrow(lambda t: _meet(t, least, buckets), _MET), f"grams{k}")
        levels.append(met.where("id is not null").select(*(["lang", "word"] if k == 1 else ["left", "right"]), "a", "id"))
        if k < longest:
            named = met.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("numbers", "ids")).alias("named"))
            state = found.where("codes is not null").select("block", "codes", "lefts").join(named, "block").select("block", "codes", "lefts", "named")
            found = _heavy(state.mapInArrow(lambda it: _pairs(it, buckets), _STATE), f"pairs{k + 1}")
    return totals, levels


def _exact(c: Column) -> Column:
    return c.cast("decimal(17,0)")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's `top` phrases of 2 to `longest` words.

    By score, then a, descending, then phrase in the order of its UTF-8 bytes. A phrase inside a longer one that has `share`
    hundredths of its occurrences or more is left out.
    """
    totals, levels = ngrams(docs, least, longest)
    known = levels[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("a").alias("pre"), F.array("a").alias("suf"))
    out = None
    for k, level in enumerate(levels[1:], 2):
        left = known.select(F.col("id").alias("left"), "lang", "phrase", "pre")
        right = known.select(F.col("id").alias("right"), "last", "suf")
        own = F.array("a")
        known = store.cut(level.join(left, "left").join(right, "right").select("id", "a", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", F.concat("pre", own).alias("pre"), F.concat("suf", own).alias("suf")), f"phrases{k}")
        kept = known
        if k < longest:
            longer = levels[k].select(F.col("left").alias("id"), F.col("a").alias("most")).unionByName(levels[k].select(F.col("right").alias("id"), F.col("a").alias("most"))).groupBy("id").agg(F.max("most").alias("most"))
            kept = known.join(longer, "id", "left").where(f"most is null or most < a * {share} / 100.0")
        cuts = kept.select("lang", "phrase", "a", F.array(*(F.struct(F.lit(j).alias("k"), F.col("pre")[j - 1].alias("l"), F.col("suf")[k - j - 1].alias("r")) for j in range(1, k))).alias("cuts"))
        out = cuts if out is None else out.unionByName(cuts)
    rows = out.join(totals, "lang")
    # 1000 a n / (l r) in decimals of 38 digits; it is at most 1000 n / max(l, r), so the quotient is a long
    weight = F.lit(1000).cast("decimal(4,0)") * _exact(F.col("a")) * _exact(F.col("n"))
    scored = rows.withColumn("weight", weight).withColumn("cuts", F.expr("transform(cuts, c -> struct(weight div (cast(c.l as decimal(17,0)) * cast(c.r as decimal(17,0))) as score, c.k as k, c.l as l, c.r as r))"))
    best = scored.select("lang", "phrase", "a", "n", F.array_min("cuts").alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH p AS MATERIALIZED (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
x AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS g FROM x, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE i + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS a FROM g GROUP BY lang, k, g HAVING count(*) >= {LEAST}),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (
  SELECT f.lang, f.k, f.g, f.a, l.a AS l, r.a AS r, t.n, (CAST(1000 AS HUGEINT) * f.a * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM f JOIN t USING (lang) JOIN f l ON l.lang = f.lang AND l.k < f.k AND l.g = f.g[1:l.k] JOIN f r ON r.lang = f.lang AND r.k = f.k - l.k AND r.g = f.g[l.k + 1:]
  QUALIFY row_number() OVER (PARTITION BY f.lang, f.g ORDER BY score, l.k) = 1),
d AS (SELECT DISTINCT lang, sub, a FROM (SELECT lang, f.a, unnest([f.g[1:k - 1], f.g[2:]]) AS sub FROM f WHERE k > 2)),
o AS (SELECT c.* FROM c LEFT JOIN (SELECT lang, sub, max(a) AS most FROM d GROUP BY lang, sub) m ON m.lang = c.lang AND m.sub = c.g WHERE most IS NULL OR 100 * most < {SHARE} * c.a),
z AS (SELECT *, array_to_string(g, ' ') AS phrase FROM o)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z) WHERE rank <= {TOP}"""
