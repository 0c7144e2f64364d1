"""Exact search against brute force."""

import numpy as np

from ordermart.llm import topk


def brute(rows, every=20):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            kept[i] = [int(np.floor(64 * np.float32(c).astype(float))) for c in v]
    out = []
    for q in kept:
        if q % every == 0:
            score = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(score[:20])]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.search(df).collect())) == brute(rows)


def test_documents_table(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, topk.search(df).collect())) == brute(rows)


def test_small_chunks_copies_and_clusters(spark, monkeypatch):
    for name, value in (("CHUNK", 16), ("QUERY_BLOCK", 4), ("PIVOTS", 5), ("NEAR", 2)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + rng.normal(size=8) * 0.1).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]                   # one vector three hundred times
    check(spark, rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, None), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]),
            (100, [None, 1.0]), (None, [1.0, 1.0]), (1, [3.0]), (2, []), (3, [-1.0, -1.0]), (120, [1e6, -1e6]), (4, [1.0, 2.0])]
    check(spark, rows)
    repeated = spark.createDataFrame(rows + rows[:3], "vec_id long, embedding array<float>")
    extra = repeated.selectExpr("*", "1 as score", "2 as rank", "3 as chunk")
    assert sorted(map(tuple, topk.search(extra).collect())) == brute(rows)
    assert topk.search(repeated.limit(0)).count() == 0
    check(spark, [(1, [1.0]), (2, [2.0])])                                 # no queries
    check(spark, [(20, [1.0])])                                            # no partners


def test_scores_beyond_exact_doubles(spark):
    check(spark, [(i, [1e7 + i, 3e6 - i]) for i in range(0, 60)])


def test_far_annuli_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 32)
    rng = np.random.default_rng(0)
    centres = np.eye(16) * 3
    rows = [(i, (centres[i % 16] + rng.normal(size=16) * 0.02).tolist()) for i in range(3200)]
    seen = []
    compared = topk._compared
    monkeypatch.setattr(topk, "_compared", lambda pairs, *a: seen.append(pairs.count()) or compared(pairs, *a))
    check(spark, rows)
    assert len(seen) == 2 and sum(seen) < 0.6 * (3200 / 32) * 16


def test_pairs_beyond_the_bound_are_never_made(spark, monkeypatch):
    """Many annuli per pivot: what is written and compared is a fraction of blocks times annuli."""
    for name, value in (("CHUNK", 16), ("QUERY_BLOCK", 4), ("PIVOTS", 8)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6)) * 4
    rows = [(i, (centres[i % 8] * (1 + (i // 8 % 40) / 10) + rng.normal(size=6) * 0.01).tolist()) for i in range(4000)]
    made, sizes = [], []
    within, packed = topk._within, topk._packed
    monkeypatch.setattr(topk, "_within", lambda *a: made.append(within(*a)) or made[-1])
    monkeypatch.setattr(topk, "_packed", lambda *a: sizes.append(packed(*a)) or sizes[-1])
    check(spark, rows)
    assert made[0].count() < 0.35 * sizes[0].count() * sizes[1].count()
