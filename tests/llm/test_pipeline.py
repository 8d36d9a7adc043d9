import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_token_ops import base_spans, brute_language


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    columns = docs.columns
    by = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "packing"]
    lang, dedup, clean, secret, pack = (f for _, f in corpus_pipeline.STAGES)
    a = lang(spark, docs, sf)
    assert a.columns == columns and a.count() >= 0.97 * len(by)
    b = dedup(spark, docs, sf)
    groups = {}
    sets = {i: brute.shingles(t, 5) for i, t in by.items()}
    root = {i: i for i in by}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in by:
        for j in by:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(j)] = find(i)
    for i in by:
        groups.setdefault(find(i), []).append(i)
    assert b.columns == columns and sorted(r["doc_id"] for r in b.collect()) == sorted(min(g) for g in groups.values())
    c = clean(spark, docs, sf)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert c.columns == columns and {r["doc_id"] for r in c.collect()} == {r[0] for r in brute.decontaminate(list(by.items()), items) if not r[-1]}
    d = {r["doc_id"]: r for r in secret(spark, docs, sf).collect()}
    assert set(d) == set(by) and not any(re.search(r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r["text"] or "") for r in d.values())
    assert sum(d[i]["text"] != t for i, t in by.items()) <= 0.1 * len(by)
    assert pack(spark, docs, sf).select("doc_id").distinct().count() == len(by)


def chain(docs, items, library):
    """The five stages in plain Python: pieces of (doc_id, piece, start, length, ids_crc32)."""
    train = [(d["text"], d["lang"]) for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2]
    found = brute_language(train, [d["text"] for d in docs])
    left = {d["doc_id"]: d["text"] for d, (lang, score) in zip(docs, found, strict=True) if lang != "und" and score >= 0.6}
    sets = {i: brute.shingles(t, 5) for i, t in left.items()}
    root = {i: i for i in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in left:
        for j in left:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    left = {i: t for i, t in left.items() if find(i) == i}
    hit = {r[0] for r in brute.decontaminate(list(left.items()), items) if r[-1]}
    out = set()
    for i, text in left.items():
        if i in hit:
            continue
        clean, at = "", 0
        for start, _, _, stop in base_spans(text):
            if start >= at:
                clean += text[at:start] + "<secret>"
            at = max(at, stop)
        ids = [*library.encode(clean + text[at:], add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        out |= {(i, n, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())) for n, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))}
    return out


def test_run(spark, sf):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = out.collect()
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    want = chain(docs, items, Tokenizer.from_file(corpus_pipeline.TOKENIZER))
    assert len(got) == len(set(got)) and set(got) == want and 0 < len({g[0] for g in got}) < 200
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in filled.values():  # without gaps, and none too long
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= 1024


def test_stages_on_odd_tables(spark, sf):
    """Nulls, empty texts, repeated rows and further columns with clashing names; empty tables."""
    rows = [(1, "the cat sat on the mat and the dog ran " * 3, "en", "a", 9, "x"), (1, "the cat sat on the mat and the dog ran " * 3, "en", "a", 9, "x"), (2, None, None, None, None, None), (3, "", "en", "", 0, ""), (None, "der hund und die katze sind hier im haus " * 3, "de", "b", 1, "y"), (5, "der hund und die maus password=12345678 sind hier " * 3, "de", "b", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_hit string").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    lang, dedup, clean, secret, pack = (f for _, f in corpus_pipeline.STAGES)
    assert {r["doc_id"] for r in lang(spark, docs, sf).collect()} == {1, 5, None}
    assert len(dedup(spark, docs, sf).collect()) == 6 and len(clean(spark, docs, sf).collect()) == 6  # rows that share a doc_id are one document
    assert sorted(r["text"].count("<secret>") for r in secret(spark, docs, sf).collect() if r["text"]) == [0, 0, 0, 3]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in pack(spark, docs, sf).collect()) == [(False, 1), (False, 1), (False, 2), (False, 3), (False, 5), (True, 0)]
    assert pack(spark, docs.limit(0), sf).count() == 0
