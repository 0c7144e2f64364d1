"""Embedding near-duplicates: links and components by brute force."""

import numpy as np
import pytest

from ordermart.llm import pq_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """The contract over all pairs of a label."""
    def able(v, label):
        return label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)
    width = max((len(v) for _, v, _ in rows if v), default=0)
    x = np.zeros((len(rows), width))
    for i, (_, v, label) in enumerate(rows):
        if able(v, label):
            x[i, :len(v)] = np.array(v, np.float32)
    size = np.sqrt((x * x).sum(axis=1))
    unit = x / np.where(size > 0, size, 1)[:, None]
    labels = np.array([-1 if label is None else label for _, _, label in rows])
    linked = (unit @ unit.T >= threshold) & (labels[:, None] == labels) & (size > 0)[:, None] & (size > 0)
    np.fill_diagonal(linked, False)
    out, group = [], np.arange(len(rows))
    while True:
        new = np.array([min([group[i], *group[linked[i]]]) for i in range(len(rows))])
        if (new == group).all():
            break
        group = new
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(group == group[i]) if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, int(linked[i].sum()), low, vec_id == low))
    return sorted(out, key=str)


def found(df, **options):
    out = pq_dedup.near_duplicates(df, **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


def clustered(seed, n=400, dim=16, noise=0.05):
    """Clusters, chains, copies and scaled copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(i, (centres[i % 12] + rng.normal(size=dim) * noise * (1 + i % 4)).tolist(), i % 3) for i in range(n)]
    turn = np.linspace(0, 2, 60)
    rows += [(1000 + k, [float(np.cos(t)), float(np.sin(t))] + [0.0] * (dim - 2), 7) for k, t in enumerate(turn)]     # a chain
    rows += [(2000 + k, rows[5][1], rows[5][2]) for k in range(150)]                                   # one vector often
    rows += [(3000 + k, (np.array(rows[9][1]) * (k + 1)).tolist(), rows[9][2]) for k in range(30)]     # and scaled
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_clusters(spark, monkeypatch, seed):
    monkeypatch.setattr(pq_dedup, "TABLES", 16)
    rows = clustered(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, block=2048) == brute(rows)
    if seed == 0:
        assert found(df, block=20) == brute(rows)           # lists dealt out by blocks


def test_probes_and_look_ups_lose_nothing():
    """Recall of the probes and of the table look-ups, from a poor sample."""
    rng = np.random.default_rng(5)
    x = pq_dedup.unit_rows(np.repeat(rng.normal(size=(150, 12)), 4, axis=0) + rng.normal(size=(600, 12)) * 0.03)
    quantiser = pq_dedup.Quantiser(12, 16, x[:40], 0.2)
    own, probes = quantiser.own(x)
    probes |= np.eye(len(quantiser.centroids), dtype=bool)[own]
    code, error = quantiser.encode(x, own)
    near = np.sqrt(((x[:, None, :] - x) ** 2).sum(axis=2)) <= 0.2
    i, j = np.nonzero(near)
    assert len(i) > 1500 and (probes[i, own[j]] | probes[j, own[i]]).all()
    for list_ in range(len(quantiser.centroids)):
        mine = own == list_
        hit = quantiser.near(list_, x, code[mine], error[mine])
        assert hit[near[:, mine]].all()
    assert probes.sum() < 0.8 * probes.size                 # probing leaves lists out


def test_documents_table(spark, small_dir):
    df = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    assert found(df) == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [0.0, -0.0], 1), (2, None, 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
            (5, [None, 1.0], 1), (None, [1.0, 1.0], 1), (6, [3.0], 1), (7, [], 1), (8, [-1.0, -1.0], 1), (9, [1e30, -1e30], 1),
            (10, [1.0, 2.0], 1), (11, [1.0, 2.0], None), (12, [1.0, 2.0], 2), (13, [1e-30, 2e-30], 1), (0, [1.0, 2.0], 1),
            (0, [2.0, -1.0], 1), (None, [5.0, 5.0], 3), (None, [5.0, 5.0], 3), (None, None, None), (14, [9.0, -0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(rows)
    assert found(df.selectExpr("*", "1 as cls", "2 as list", "3 as n_links")) == brute(rows)
    assert found(df.limit(0)) == []
    none = [r for r in rows if r[2] is None]
    assert found(spark.createDataFrame(none, SCHEMA)) == brute(none)
    one = [(4, [1.0, 2.0], 1)]
    assert found(spark.createDataFrame(one, SCHEMA)) == brute(one)
