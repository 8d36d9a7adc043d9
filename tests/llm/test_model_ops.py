import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomgene.llm import blocks, cover_topk, hmm_lm, queries
from tests.llm import brute


def brute_topk(rows, divisor=50, k=5):
    rows = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in rows:
        if q % divisor == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [20_000, 3])
def test_topk_query(spark, sf, monkeypatch, block):
    monkeypatch.setattr(cover_topk, "QUERY_GROUP", block)
    monkeypatch.setattr(cover_topk, "DATA_BLOCK", 30 * block)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op2_cover_tree_topk(spark, sf).collect())) == brute_topk(rows)


def test_topk_odd(spark):
    rnd = random.Random(4)
    centre = [[rnd.gauss(0, 3) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in rnd.choice(centre)]) for i in range(300)]
    rows += [(i, [1.0] * 6) for i in range(300, 420)]  # many equal vectors
    rows += [(500, None), (550, []), (600, [1.0, None]), (650, [float("nan")] * 6), (700, [float("inf")] * 6), (750, [0.5]), (800, [0.0] * 6), (None, [1.0] * 6), (50, rows[50][1])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("vec_id", "embedding", "1 as score").repartition(7)
    assert sorted(map(tuple, cover_topk.top_k(table).collect())) == brute_topk(rows)
    assert sorted(map(tuple, cover_topk.top_k(table, leaves=3).collect())) == brute_topk(rows)
    few = table.where("vec_id < 3")
    assert sorted(map(tuple, cover_topk.top_k(few).collect())) == brute_topk(rows[:3])
    assert cover_topk.top_k(table.limit(0)).count() == 0 and cover_topk.top_k(table.where("vec_id = 1")).count() == 0


def test_dual_tree_prunes_and_never_wrongly():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.normal(c, 1, (200, 8)) for c in (rng.normal(0, 60, 8) for _ in range(6))])
    tree = cover_topk.CoverTree(data, 40)
    leaf = cover_topk.nearest(data, tree.points)
    far = np.full(len(tree.points), -1.0)
    np.maximum.at(far, leaf, np.linalg.norm(data - tree.points[leaf], axis=1))
    score = data @ data.T
    kth = np.partition(score, -5, axis=1)[:, -5]
    worst = np.full(len(tree.points), np.inf)
    np.minimum.at(worst, leaf, kth)
    pairs = tree.pairs(far, far, worst)
    assert pairs[leaf[:, None], leaf[None, :]][score >= kth[:, None]].all()
    assert pairs.mean() < 0.6


def test_cell_search_prunes_clusters(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 60, (12, 8))
    data = np.floor(np.concatenate([rng.normal(c, 1, (300, 8)) for c in centres]) * 16)
    data[5] = data[6]
    ids = rng.permutation(len(data)).astype(np.int64)
    score = data @ data.T
    score[ids[:, None] == ids[None, :]] = -np.inf
    for leaf in (64, 8):
        monkeypatch.setattr(cover_topk, "LEAF", leaf)
        best, who, scored = cover_topk.search(ids, data, np.full(len(ids), -np.inf), ids, data, 5)
        order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :5]
        assert (best == np.take_along_axis(score, order, 1)).all() and (who == ids[order]).all()
        assert scored < 0.3 * score.size  # most pairs of clusters are pruned


def test_cell_search_on_the_real_table(sf):
    """Exact whatever the bounds prune; on isotropic unit vectors of 64 dimensions they prune next to nothing."""
    import pyarrow.parquet as pq

    e = pq.read_table(f"{sf}/embeddings.parquet")
    d, ids = np.floor(256 * np.stack(e["embedding"].to_numpy()).astype(float)), e["vec_id"].to_numpy()
    q = ids % 50 == 0
    best, who, scored = cover_topk.search(ids[q], d[q], np.full(q.sum(), -np.inf), ids, d, 5)
    score = d[q] @ d.T
    score[ids[q][:, None] == ids[None, :]] = -np.inf
    assert (best == -np.sort(-score, axis=1)[:, :5]).all() and 0 < scored <= score.size


def test_dealing_meets_every_pair():
    rng = np.random.default_rng(4)
    for trial in range(20):
        points = rng.normal(0, 5, (60, 3))
        tree = cover_topk.CoverTree(points, 25)
        n = len(tree.points)
        asked, held, pairs = rng.integers(0, 9, n).tolist(), rng.integers(0, 60, n).tolist(), rng.random((n, n)) < 0.3
        cover_topk.QUERY_GROUP, cover_topk.DATA_BLOCK, keep = 6, 25, (cover_topk.QUERY_GROUP, cover_topk.DATA_BLOCK)
        try:
            dealt = cover_topk.deal(tree, asked, held, pairs)
        finally:
            cover_topk.QUERY_GROUP, cover_topk.DATA_BLOCK = keep
        within = lambda x, runs: any(a <= x <= z for a, z in runs)
        for i, g, g_parts, blocks_, _, _, _ in dealt:
            for j, _, _, _, b, b_parts, groups in dealt:
                if asked[i] and held[j] and pairs[i, j]:
                    assert all(within(x, groups) for x in range(g, g + g_parts)) and all(within(x, blocks_) for x in range(b, b + b_parts))


def base(docs, held):
    toks = {i: [*brute.SPACED.findall((t or "").translate(brute.LOWER)), None] for i, t in docs}
    c = Counter(w for i, ws in toks.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in toks.items()}


def test_hmm_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    want, out = base(docs, held), queries.op6_hmm_scoring(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        n, known, total, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
    assert sum(r["score"] for r in out if r["held_out"]) > sum(r["base_score"] for r in out if r["held_out"])


@pytest.mark.parametrize("head", [1 << 20, 8])
def test_hmm_odd(spark, monkeypatch, head):
    monkeypatch.setattr(hmm_lm, "HEAD_WORDS", head)
    rnd = random.Random(1)
    text = lambda: " ".join(rnd.choice(["le", "chat", "Noir", "the", "cat", "é", "x1"]) for _ in range(rnd.randint(0, 30)))
    docs = [(i, text()) for i in range(40)] + [(40, None), (41, ""), (42, " \t"), (43, "word " * 30_000), (44, "unseen words only"), (45, "UNSEEN")]
    held = {i: i % 5 == 4 for i, _ in docs}
    df = spark.createDataFrame([(i, t, held[i], 0) for i, t in docs], "doc_id bigint, text string, held_out boolean, n_tokens int").repartition(4)
    want = base(docs, held)
    for r in hmm_lm.score(df).collect():
        n, known, total, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total), r
        assert r["base_score"] == pytest.approx(score, rel=1e-9) and r["score"] < 0
    assert hmm_lm.score(df.limit(0)).count() == 0
    nothing = {r["doc_id"]: r for r in hmm_lm.score(df.withColumn("held_out", df["doc_id"] >= 0)).collect()}
    assert nothing[44]["train_tokens"] == 0 and nothing[44]["base_score"] == pytest.approx(0)


def test_hmm_scores_do_not_depend_on_the_head(spark, monkeypatch):
    rnd = random.Random(4)
    words = ["le", "chat", "Noir", "the", "cat", "é", "x1", "dog", "sun", "zw"]
    docs = spark.createDataFrame([(i, " ".join(rnd.choice(words) for _ in range(20)), i % 5 == 4) for i in range(40)], "doc_id bigint, text string, held_out boolean").repartition(4)
    found = []
    for head in (hmm_lm.HEAD_WORDS, 1):
        monkeypatch.setattr(hmm_lm, "HEAD_WORDS", head)
        found.append({r["doc_id"]: r["score"] for r in hmm_lm.score(docs).collect()})
    assert found[1] == pytest.approx(found[0], rel=1e-9)


def slow_forward(m, obs):
    a, total = m.start * m.emit[obs[0]], 0.0
    for x in obs[1:]:
        total += math.log10(a.sum())
        a = (a / a.sum()) @ m.move * m.emit[x]
    return total + math.log10(a.sum())


def test_recursions():
    rng = np.random.default_rng(0)
    m = hmm_lm.first_model(rng.integers(1, 9, hmm_lm.CLASSES).astype(float), 3)
    obs = [rng.integers(0, hmm_lm.CLASSES, n).astype(np.uint16) for n in (1, 5, 2, 40, 40, 1)]
    codes = [o.tobytes() for o in obs]
    assert hmm_lm.log10_likelihood(m, codes) == pytest.approx([slow_forward(m, o) for o in obs])
    firsts, moves, emits = hmm_lm.expected_counts(m, codes, most=1000)
    assert firsts.sum() == pytest.approx(6, rel=1e-4) and moves.sum() == pytest.approx(89 - 6, rel=1e-4) and emits.sum() == pytest.approx(89, rel=1e-4)
    # against sums over all paths of a short sequence
    o, k = obs[1], 3
    paths = {}
    for p in np.ndindex(*[k] * len(o)):
        v = m.start[p[0]] * m.emit[o[0], p[0]]
        for i in range(1, len(o)):
            v *= m.move[p[i - 1], p[i]] * m.emit[o[i], p[i]]
        paths[p] = v
    total = sum(paths.values())
    f, mv, em = hmm_lm.expected_counts(m, [o.tobytes()], most=1000)
    assert math.log10(total) == pytest.approx(slow_forward(m, o))
    assert f == pytest.approx([sum(v for p, v in paths.items() if p[0] == s) / total for s in range(k)], rel=1e-3)
    assert mv[0, 1] == pytest.approx(sum(v * sum(a == 0 and b == 1 for a, b in zip(p, p[1:], strict=False)) for p, v in paths.items()) / total, rel=1e-3)
    assert em[o[2], 1] == pytest.approx(sum(v * sum(s == 1 and x == o[2] for s, x in zip(p, o, strict=True)) for p, v in paths.items()) / total, rel=1e-3)


def test_long_sequences_in_segments(monkeypatch):
    rng = np.random.default_rng(3)
    m = hmm_lm.first_model(rng.integers(1, 9, hmm_lm.CLASSES).astype(float), 4)
    obs = [rng.integers(0, hmm_lm.CLASSES, n).astype(np.uint16) for n in (3, 700, 64, 65, 1, 129)]
    monkeypatch.setattr(hmm_lm, "SEGMENT", 64)
    monkeypatch.setattr(hmm_lm, "LONG", 64)
    assert hmm_lm.log10_likelihood(m, [o.tobytes() for o in obs]) == pytest.approx([slow_forward(m, o) for o in obs])


def brute_scores(docs, held):
    """The whole method in plain steps and logarithms: classes, Baum-Welch, forward, words within classes."""
    import pyarrow as pa

    tokens = {i: brute.SPACED.findall((t or "").translate(brute.LOWER)) for i, t in docs}
    words = sorted({w for ws in tokens.values() for w in ws})
    suffix = dict(zip(words, hmm_lm.suffix_class(blocks.Words(pa.array(words), blocks.SPACED, lower=False)).tolist(), strict=True))
    hashes = dict(zip(words, blocks.Words(pa.array(words), blocks.SPACED, lower=False).hashes.view(np.int64).tolist(), strict=True))
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    ends = sum(not h for h in held.values())
    own = {w: k for k, w in enumerate(sorted(c, key=lambda w: (-c[w], hashes[w]))[: hmm_lm.OWN_CLASSES])}
    of = lambda w: own[w] if w in own else hmm_lm.OWN_CLASSES + suffix[w]
    seqs = {i: [*(of(w) for w in ws), hmm_lm.END] for i, ws in tokens.items()}
    n = np.zeros(hmm_lm.CLASSES)
    kinds = Counter(of(w) for w in c if w not in own)
    for w, k in c.items():
        n[of(w)] += k
    n[hmm_lm.END] = ends
    m, u = hmm_lm.first_model(n, hmm_lm.STATES), (n + 0.1) / (n.sum() + 0.1 * hmm_lm.CLASSES)
    for _ in range(hmm_lm.ITERATIONS):
        firsts, moves, emits = np.ones(hmm_lm.STATES), np.ones((hmm_lm.STATES,) * 2), np.repeat(10 * u[:, None], hmm_lm.STATES, 1)
        for o in (seqs[i][a : a + hmm_lm.SEQUENCE] for i in seqs if not held[i] for a in range(0, len(seqs[i]), hmm_lm.SEQUENCE)):
            f, b = [np.log(m.start * m.emit[o[0]])], [np.zeros(hmm_lm.STATES)]
            for x in o[1:]:
                f.append(np.logaddexp.reduce(f[-1][:, None] + np.log(m.move), axis=0) + np.log(m.emit[x]))
            for x in reversed(o[1:]):
                b.insert(0, np.logaddexp.reduce(np.log(m.move) + np.log(m.emit[x])[None, :] + b[0][None, :], axis=1))
            z = np.logaddexp.reduce(f[-1])
            for t, x in enumerate(o):
                emits[x] += np.exp(f[t] + b[t] - z)
                if t:
                    moves += np.exp(f[t - 1][:, None] + np.log(m.move) + np.log(m.emit[x])[None, :] + b[t][None, :] - z)
            firsts += np.exp(f[0] + b[0] - z)
        m = hmm_lm.Model(firsts / firsts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    within = lambda w: 0.0 if w in own else math.log10((c[w] + 0.1) / (n[of(w)] + 0.1 * (kinds[of(w)] + 1)))
    return {i: slow_forward(m, np.array(seqs[i])) + sum(map(within, tokens[i])) for i in seqs}


def test_hmm_score_against_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    monkeypatch.setattr(hmm_lm, "OWN_CLASSES", 3)  # most words share classes
    monkeypatch.setattr(hmm_lm, "CLASSES", 3 + hmm_lm.SUFFIX_CLASSES + 1)
    monkeypatch.setattr(hmm_lm, "END", 3 + hmm_lm.SUFFIX_CLASSES)
    words = ["le", "chat", "noir", "the", "cat", "é", "x1", "dog", "sun", "zw", "ion", "nation", "station"]
    docs = [(i, " ".join(rnd.choice(words[i % 2 :: 2]) for _ in range(rnd.randint(0, 25)))) for i in range(24)] + [(24, None), (25, "never seen words here"), (26, "la " * 700)]
    held = {i: i % 4 == 1 for i, _ in docs}
    df = spark.createDataFrame([(i, t, held[i]) for i, t in docs], "doc_id bigint, text string, held_out boolean").repartition(3)
    # workers get the constants with the functions only if they are not read from the module there, so one task's worth of rows runs here
    batches = df.toArrow().to_batches()
    got = local_scores(batches)
    want = brute_scores(docs, held)
    assert got == pytest.approx(want, rel=2e-4)


def local_scores(batches):
    """hmm_lm.score step by step in this process."""
    import pyarrow as pa

    table = pa.Table.from_batches(batches)
    training = table.filter(pa.compute.invert(table["held_out"]))

    class One:
        def __init__(self, value):
            self.value = value

    counted = pa.Table.from_batches(hmm_lm._count(iter(training.select(["text"]).combine_chunks().to_batches()))).group_by("h").aggregate([("s", "min"), ("n", "sum")])
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = list(zip(counted["h"].to_pylist(), counted["s_min"].to_pylist(), counted["n_sum"].to_pylist(), strict=True))
    v = hmm_lm.Vocabulary(spark.createDataFrame(rows, "h bigint, s int, n bigint"), training.num_rows)
    hmm_lm.TaskContext, keep = One(0), hmm_lm.TaskContext
    hmm_lm.TaskContext.get = lambda: type("T", (), {"partitionId": lambda self: 0})()
    try:
        encoded = pa.Table.from_batches(hmm_lm._encode(iter(table.select(["doc_id", "held_out", "text"]).combine_chunks().to_batches()), One(v.shared())))
    finally:
        hmm_lm.TaskContext = keep
    codes, held = encoded["classes"].to_pylist(), encoded["held_out"].to_pylist()
    m = hmm_lm.first_model(v.class_n, hmm_lm.STATES)
    u = ((v.class_n + 0.1) / (v.class_n.sum() + 0.1 * hmm_lm.CLASSES))[:, None]
    for _ in range(hmm_lm.ITERATIONS):
        f, mv, em = hmm_lm.expected_counts(m, [c for c, h in zip(codes, held, strict=True) if not h])
        f, mv, em = f + 1, mv + 1, em + 10 * u
        m = hmm_lm.Model(f / f.sum(), mv / mv.sum(1, keepdims=True), em / em.sum(0))
    total = hmm_lm.log10_likelihood(m, codes) + encoded["rest"].to_numpy()
    return dict(zip(encoded["doc_id"].to_pylist(), total.tolist(), strict=True))


def test_training_raises_likelihood():
    rng = np.random.default_rng(5)
    obs = [(rng.integers(0, 40, 60) + 40 * (i % 3)).astype(np.uint16).tobytes() for i in range(60)]
    n = np.bincount(np.frombuffer(b"".join(obs), np.uint16), minlength=hmm_lm.CLASSES).astype(float)
    m, last = hmm_lm.first_model(n, 3), -math.inf
    for _ in range(6):
        now = hmm_lm.log10_likelihood(m, obs).sum()
        assert now > last
        last = now
        f, mv, em = hmm_lm.expected_counts(m, obs)
        m = hmm_lm.Model(f / f.sum(), mv / mv.sum(1, keepdims=True), (em + 1e-9) / (em + 1e-9).sum(0))


def test_probabilities_add_up():
    """Classes given states, and words given classes, are distributions."""
    m = hmm_lm.first_model(np.arange(hmm_lm.CLASSES, dtype=float), 4)
    assert m.emit.sum(0) == pytest.approx(np.ones(4)) and m.move.sum(1) == pytest.approx(np.ones(4)) and m.start.sum() == pytest.approx(1)
    assert re.fullmatch(r"\d+", str(hmm_lm.END)) and blocks.BLOCK_BYTES
