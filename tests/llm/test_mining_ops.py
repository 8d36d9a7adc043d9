"""Line dedup, hard negatives and phrases against plain Python, on odd and empty tables too."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomgene.llm import collocations, hard_negatives, line_dedup, queries
from tests.llm.brute import LOWER

BLANK = " \t\n\v\f\r"
DOC = "doc_id bigint, text string"


def dedup_lines(docs, least=10):
    """(doc_id, n_lines, n_dropped, kept text) of each row."""
    key = lambda line: line.strip(BLANK).translate(LOWER)
    first = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= least:
                first[key(line)] = min(first.get(key(line), d), d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(key(x)) < least or first[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def odd_docs():
    rng = random.Random(5)
    lines = ["The same licence line here", "  the SAME licence line here\t", "short", "", "Ünïcödé ß ten", "éééééééééé", "ééééééééé", " nbsp is no blank", "unique {}", "Ä" * 10, "ä" * 10, "x" * 10, "X" * 10 + "\r", "\v\f" + "x" * 9]
    docs = [(i, "\n".join(rng.choice(lines).format(rng.random()) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    docs += [(None, "The same licence line here\nThe same licence line here"), (None, None), (200, None), (201, ""), (202, "\n"), (203, "\n\n"), (-4, "x" * 10), (3, "the same licence line here\nagain and again"), (3, "again and again"), (3, docs[3][1])]
    docs += [(1000 + i, "hot line in every document\nhot line in every document\nmine %d and only mine" % i) for i in range(300)]
    return docs


def test_line_dedup_equals_plain(spark):
    docs = odd_docs()
    df = spark.createDataFrame(docs, DOC).withColumns({"keep": F.lit("clash"), "n_lines": F.lit(1), "line": F.lit("x")}).repartition(13)
    bitmaps = line_dedup.keep_bitmaps(df)
    got = [tuple(r) for r in line_dedup.apply(df, bitmaps).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(dedup_lines(docs), key=key)
    sha = {(r[0], r[3]) for r in line_dedup.apply(df, bitmaps, text=False).collect()}
    assert sha == {(d, hashlib.sha256(t.encode()).hexdigest()) for d, _, _, t in dedup_lines(docs)}


def test_keep_bitmaps_say_which_lines_stay(spark):
    docs = [(1, "a line of some length\nown words of one"), (2, "own words of two\na line of some length\n"), (3, None)]
    got = {r["doc_id"]: r for r in line_dedup.keep_bitmaps(spark.createDataFrame(docs, DOC)).collect()}
    assert {d: line_dedup.keep_bits(r["keep"], r["n_lines"]).tolist() for d, r in got.items()} == {1: [True, True], 2: [True, False, True], 3: [True]}
    assert {d: r["n_dropped"] for d, r in got.items()} == {1: 0, 2: 1, 3: 0}


def test_ranges_that_share_a_key_agree(spark):
    import pyarrow as pa

    rows = sorted((h, 0, d, i) for h in (1, 2, 3) for d in range(7) for i in range(2))
    names = ["h1", "h2", "doc_id", "line"]
    batch = lambda part: pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in part], pa.int32() if n == "line" else pa.int64()) for i, n in enumerate(names)} | {"text_key": pa.array([0] * len(part), pa.int64())})
    for cuts in ([5], [1, 2, 3, 20], [14, 28], [13, 15, 16, 17]):
        edges = [0, *cuts, len(rows)]
        found = [r for a, z in zip(edges, edges[1:]) for r in pa.Table.from_batches(line_dedup._stream(iter([batch(rows[a : (a + z) // 2]), batch(rows[(a + z) // 2 : z])]))).to_pylist()]
        least = {}
        for r in found:
            if r["kind"] == line_dedup._LAST:
                least[r["h1"]] = min(least.get(r["h1"], r["doc_id"]), r["doc_id"])
        dropped = {(r["h1"], r["doc_id"], r["line"]) for r in found if r["kind"] == line_dedup._DROPPED or (r["kind"] == line_dedup._WAITING and r["doc_id"] > least.get(r["h1"], r["doc_id"]))}
        assert dropped == {(h, d, i) for h, _, d, i in rows if d > 0}


def test_long_text_is_read_in_parts():
    raw = b"\n".join([b"line %d of a long text" % i for i in range(200_000)] + [b"", b"z" * (3 << 20), b""])
    parts = list(line_dedup._parts(raw))
    assert len(parts) > 3
    assert [x for p in parts for x in p] == raw.split(b"\n")
    assert b"".join(line_dedup._kept(raw, None)) == raw


def plain_negatives(rows, divisor=50, k=5, n=3):
    """rows: (vec_id, label, vector) that take part."""
    rows = [(v, x, [math.floor(256 * c) for c in e]) for v, x, e in {(v, x, tuple(e)) for v, x, e in rows}]
    out = []
    for a, label, q in rows:
        if a % divisor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, e)), v, lab) for v, lab, e in rows if v != a)
        for s, p, _ in [r for r in scored if r[2] == label][:k]:
            fit = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:n]
            out += [(a, p, i, v, -s, -m) for i, (m, v, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 0.02, 300.0])
def test_hard_negatives_equal_plain(spark, monkeypatch, scale):
    rng = random.Random(int(scale * 100))
    vector = lambda: [rng.choice([-1, 0, 0.25, 0.5, 0.75, 1]) * scale for _ in range(3)]  # noqa: E731  few values: many ties
    rows = [(i, rng.randrange(4), vector()) for i in range(400)]
    rows += [(i + 1000, 1, rows[50][2]) for i in range(60)] + [(50, 2, [scale] * 3), (7, 3, [scale]), (8, 3, []), rows[3], rows[50]]
    bad = [(None, 1, [1.0]), (9001, None, [1.0]), (9002, 1, None), (9003, 1, [1.0, None]), (9004, 1, [1.0, float("nan")]), (9005, 1, [float("inf")])]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, label int, embedding array<double>").withColumns({"score": F.lit(1), "rank": F.lit("x")}).repartition(5)
    monkeypatch.setattr(hard_negatives, "CELL", 100)  # several cells of both sides
    got = hard_negatives.mine(hard_negatives.participants(df, F.col("vec_id"), F.col("label"), F.col("embedding")))
    want = plain_negatives(rows)
    assert want
    assert sorted(tuple(r) for r in got.collect()) == want


def test_hard_negatives_of_few_and_no_rows(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
        return [tuple(r) for r in hard_negatives.mine(hard_negatives.participants(df, F.col("vec_id"), F.col("label"), F.col("embedding"))).collect()]

    assert run([]) == run([(50, 1, [1.0])]) == run([(1, 1, [1.0]), (2, 1, [1.0])]) == run([(50, 1, [1.0]), (51, 1, [-1.0]), (52, 2, [-0.6])]) == []
    assert run([(50, 1, [1.0]), (51, 1, [1.0]), (52, 2, [0.75]), (53, 2, [0.25])]) == [(50, 51, 1, 52, 65536, 49152)]
    assert len(run([(50, 1, [0.0]), (51, 1, [1.0]), (52, 2, [0.5])])) == 1  # scores of 0: 0 <= 0 <= 0
    assert run([(50, 1, [3e38, -3e38]), (51, 1, [3e38, -1.0]), (52, 2, [2.7e38, 1.0])]) == []  # held to limits, where all tie


def plain_phrases(docs, least, longest=5, top=2000, share=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(w[i : i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        able = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in able.items():
            if any(len(h) > len(g) and 100 * b >= share * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in able.items()):
                continue
            score, k = min((1000 * a * n[lang] // (own[g[:k]] * own[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), own[g[:k]], own[g[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("share", "top"), [(100, 2000), (60, 7)])
def test_phrases_equal_plain(spark, share, top):
    rng = random.Random(share)
    words = ["New", "york", "city", "of", "the", "straße", "É", " x", "a.b", "stop,", "no\ttab", "line\nbreak", "\x00", "𝒳", "z?"]
    docs = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(words, [8, 8, 5, 5, 5, 2, 2, 1, 1, 2, 1, 1, 1, 1, 1], k=rng.randint(0, 60)))) for _ in range(150)]
    docs += [("en", None), ("fr", ""), (None, None), ("xx", "only one. phrase"), ("en", "!" * 50), ("en", "once upon a time " * 400)]
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({"n": F.lit(1), "block": F.lit("x"), "phrase": F.lit(2)}).repartition(6)
    got = collocations.phrases(df, least=20, share=share, top=top)
    want = plain_phrases(docs, 20, share=share, top=top)
    assert len(want) > 10
    assert sorted(tuple(r) for r in got.collect()) == want


def test_phrases_of_empty_tables_and_long_texts(spark):
    assert collocations.phrases(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert collocations.phrases(spark.createDataFrame([("en", "a b c")], "lang string, text string")).collect() == []
    text = ("one two three. " * 1000 + "four five " * 1000 + "\n") * 600  # 15 MB, beyond two blocks
    got = {(r["phrase"], r["a"]) for r in collocations.phrases(spark.createDataFrame([("en", text)], "lang string, text string")).collect()}
    assert ("one two three", 600_000) in got
    assert ("five four five four five", 600 * 998) in got


def test_large_counts_stay_exact(spark):
    """The score's product passes 64 bits."""
    a, n, l, r = 3_000_000_019, 90_000_000_000_001, 7_000_000_003, 4_000_000_009
    row = spark.createDataFrame([(a, n, l, r)], "a bigint, n bigint, l bigint, r bigint")
    weight = F.lit(1000).cast("decimal(4,0)") * collocations._exact(F.col("a")) * collocations._exact(F.col("n"))
    got = row.select(weight.alias("weight"), "l", "r").selectExpr("weight div (cast(l as decimal(17,0)) * cast(r as decimal(17,0))) as s").first()["s"]
    assert got == 1000 * a * n // (l * r)


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_hard_negatives", "op13_collocations"])
def test_new_queries_equal_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.sql(queries.SQL[name])
    df = queries.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(tuple, df.select(*rel.columns).collect())) == sorted(rel.fetchall())
