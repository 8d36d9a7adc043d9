import random

import pytest
from pyspark.sql import functions as F

from loomgene.llm import decontaminate, minmax_dedup, queries, substring_dedup
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, n_words string, matches int"
key = lambda r: tuple((x is None, x) for x in r)


def rows(df):
    return sorted(map(tuple, df.collect()), key=key)


def odd_docs():
    rnd = random.Random(5)
    vocab = ["Étage", "the", "of", "and", "A1", "b", "ñandú", "x-y", "end."]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    base = [f"w{i}" for i in range(60)]
    edit = lambda n: " ".join(w if i not in rnd.sample(range(60), n) else f"e{rnd.random()}" for i, w in enumerate(base))
    docs = [(i, text(rnd.choice([0, 1, 2, 3, 9, 12, 13, 14, 40, 300]))) for i in range(60)]
    docs += [(100 + i, edit(rnd.choice([0, 1, 2, 3]))) for i in range(60)]
    docs += [(None, " ".join(base)), (200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, "long " * 30_000), (207, "same " * 40), (0, docs[0][1]), (103, " ".join(base)), (59, "x " + docs[59][1])]
    docs += [(300, docs[59][1] + " \n" + " ".join(base)), (301, "  nb sp " + " ".join(base[20:50]))]
    return [(d, t, "clash", 1) for d, t in docs]


ITEMS = [(1, "the of and A1 b"), (2, " ".join(f"W{i}" for i in range(5, 30))), (3, None), (4, ""), (None, "same same"), (5, "one"), (2, "x y end"), (77, "ñandú!Étage the the the the the the the the the")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_docs(), SCHEMA).repartition(5)


def as_op1(out):
    ids = F.array_sort(F.array_distinct(F.expr("filter(transform(m, x -> cast(x.item_id as string)), x -> x is not null)")))
    return out.select("doc_id", "w", "h", F.size(ids), F.sha2(F.array_join(ids, ","), 256), F.col("h") > 0)


@pytest.mark.parametrize("bytes_", [8 << 20, 60])
def test_decontaminate_odd(spark, odd, monkeypatch, bytes_):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", bytes_)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = as_op1(decontaminate.annotate(odd, items, names=("w", "h", "m")))
    assert rows(out) == sorted(brute.decontaminate([d[:2] for d in odd_docs()], ITEMS), key=key)
    left = decontaminate.decontaminate(odd, items)
    assert left.schema == odd.schema
    assert left.count() == sum(not r[-1] for r in brute.decontaminate([d[:2] for d in odd_docs()], ITEMS))


def test_decontaminate_long_matches(spark):
    words = [f"k{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, "lead " + " ".join(words[3:30]) + " tail " + " ".join(words[5:20]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, " ".join(words))], "item_id bigint, text string")
    got = [tuple(m) for m in decontaminate.annotate(docs, items).first()["matches"]]
    assert sorted(got) == [(9, 3, 1, 27), (9, 5, 29, 15)]


def test_decontaminate_shared_passage(monkeypatch):
    """A passage in many items, in parts of few pairs: as the brute force, which knows no parts."""
    import pyarrow as pa

    passage = " ".join(f"p{i}" for i in range(25))
    items = [(i, f"x{i} {passage} y{i}") for i in range(50)]
    docs = [(i, f"{'z ' * i}{passage} end {passage if i % 3 else ''}") for i in range(8)] + [(8, None), (9, "none of it")]
    tests = decontaminate.Tests(pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}), 10)
    assert len(tests.low[0]) < 50 * 2 + 20  # the passage's own windows are searched once
    shared = type("B", (), {"value": tests})
    for limit in (1 << 21, 1500, 1):
        monkeypatch.setattr(decontaminate, "PAIRS", limit)
        table = pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})
        out = pa.Table.from_batches(decontaminate._pass(iter(table.to_batches()), [shared], "text", ("w", "h", "m"), False)).to_pylist()
        assert [(r["doc_id"], r["w"], r["h"], len({m["item_id"] for m in r["m"]})) for r in out] == [x[:4] for x in brute.decontaminate(docs, items)]
        assert all(m["length"] == 25 for r in out for m in r["m"]) and len(out[1]["m"]) == 100


def test_decontaminate_empty(spark, odd):
    clash = decontaminate.annotate(odd, spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    assert sorted(clash.columns) == ["doc_id", "matches", "n_hit", "n_words", "text"] and clash.schema["n_words"].dataType.simpleString() == "bigint"
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r[3] for r in decontaminate.annotate(odd.select("doc_id", "text"), none).collect()} == {0}
    assert decontaminate.annotate(odd.limit(0).select("doc_id", "text"), none).count() == 0


def test_near_odd(spark, odd, monkeypatch):
    want = sorted(brute.near([d[:2] for d in odd_docs()]), key=key)
    assert rows(minmax_dedup.near_duplicates(odd)) == want
    monkeypatch.setattr(minmax_dedup, "CELL_SHINGLES", 150)  # many cells
    monkeypatch.setattr(minmax_dedup, "GRID_SHINGLES", 500)
    monkeypatch.setattr(minmax_dedup, "FAN", 3)
    assert rows(minmax_dedup.near_duplicates(odd)) == want
    kept = minmax_dedup.dedup(odd)
    assert kept.schema == odd.schema and kept.count() == sum(r[3] for r in want)


def test_near_torn_bucket(spark, monkeypatch):
    """Sets that share buckets but fall into several components: no link is lost between cells."""
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(120):  # a few edits near the end: many share bands, few pairs are similar enough
        w = list(base)
        for j in rnd.sample(range(60, 80), rnd.choice([1, 2, 4])):
            w[j] = f"e{rnd.randint(0, 3)}"
        docs.append((i, " ".join(w)))
    want = sorted(brute.near(docs), key=key)
    assert 1 < len({r[2] for r in want}) < 120
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    for cell, grid in ((100_000, 2_000_000), (200, 1000)):
        monkeypatch.setattr(minmax_dedup, "CELL_SHINGLES", cell)
        monkeypatch.setattr(minmax_dedup, "GRID_SHINGLES", grid)
        assert rows(minmax_dedup.near_duplicates(df)) == want


def test_near_empty(spark):
    assert minmax_dedup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_substrings_odd(spark, odd, monkeypatch):
    docs = [d[:2] for d in odd_docs()]
    want = sorted(brute.substrings(docs), key=key)
    assert rows(substring_dedup.digest(odd)) == want
    monkeypatch.setattr(substring_dedup, "BLOCK", 3000)
    assert rows(substring_dedup.digest(odd)) == want
    monkeypatch.setattr(substring_dedup, "BUCKET_TEXT", 3)  # more buckets than 16 bits
    monkeypatch.setattr(substring_dedup.store, "BROADCAST_BYTES", 0)
    assert rows(substring_dedup.digest(odd)) == want
    assert substring_dedup.digest(odd.limit(0)).count() == 0


def test_gaps_round_trip():
    import numpy as np

    at = np.array([0, 1, 65535, 65535 * 3, 65535 * 3 + 7, 2_000_000])
    assert (substring_dedup._places(substring_dedup._gaps(at)) == at).all()


def test_queries_match_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(queries.op1_benchmark_decontamination(spark, sf)) == sorted(brute.decontaminate(docs, items))
    assert rows(queries.op7_minmax_near_dedup(spark, sf)) == sorted(brute.near(docs))
    assert rows(queries.op8_substring_dedup(spark, sf)) == sorted(brute.substrings(docs))
