"""Mixing: targets, exact quotas, the tree, reruns."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ordermart.llm import mixing

WORDS = lambda t: len((t or "").encode().split())


def test_targets_share_what_is_over():
    assert mixing.targets([100, 100, 100]) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    sizes = [7, 0, 1000, 13, 13, 900, 1]
    t = mixing.targets(sizes)
    assert sum(t) == pytest.approx(1.5 * sum(sizes)) and all(x <= 2 * n for x, n in zip(t, sizes))


def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 17, 64, 1000):
        assert sorted(map(mixing.Permutation(n, 3), range(n))) == list(range(n))


def test_tree_gives_every_shard_its_room_and_every_source_its_quota():
    plan = mixing.Plan({"a": 50_000, "b": 9_000, None: 700}, block_words=100, shard_blocks=7)
    by_shard = Counter(plan.shard(i, d) for i, q in enumerate(plan.quota) for d in range(q))
    assert sum(by_shard.values()) == plan.total and len(by_shard) == plan.shards
    assert max(by_shard.values()) - min(by_shard.values()) <= 1


def check(docs, **options):
    rows = mixing.taken(docs, **options).collect()
    texts = defaultdict(Counter)
    for r in docs.select("doc_id", "text", "source").collect():
        texts[r.source][r.doc_id, WORDS(r.text)] += 1
    sizes = {s: sum(n * k for (_, n), k in c.items()) for s, c in texts.items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, mixing.targets([sizes[s] for s in order])))
    assert Counter((r.doc_id, r.size) for r in rows) == sum(texts.values(), Counter())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {(r.source_size, r.target) for r in rows} <= {(sizes[s], target[s]) for s in order}
    for s in order:
        same = [r for r in rows if (r.source_size, r.target) == (sizes[s], target[s])]
        assert abs(sum(r.taken for r in same) - sum(target[x] for x in order if (sizes[x], target[x]) == (sizes[s], target[s]))) <= len(order)
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block", [64, 8192])
def test_taken_meets_the_targets_and_reruns_agree(documents, block):
    a = check(documents, block_words=block)
    assert a == check(documents.repartition(5, "text"), block_words=block)
    assert a != check(documents, block_words=block, seed=1)


def test_mix_gives_the_words_that_were_counted(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    options = {"block_words": 200, "shard_blocks": 4}
    mixed = mixing.mix(documents, places=True, **options).collect()
    words = Counter()
    for r in mixed:
        words[r.doc_id] += WORDS(r.text)
    assert words == Counter({r.doc_id: r.taken for r in mixing.taken(documents, **options).collect() if r.taken})
    whole = {r.doc_id: r.text for r in documents.collect()}
    assert all(r.text in whole[r.doc_id] for r in mixed)
    assert len({r.mix_shard for r in mixed}) > 5


def changes(keys):
    return sum(a != b for a, b in zip(keys, keys[1:]))


def test_rows_stand_in_shards_that_hold_the_quotas_of_the_tree(documents):
    options = {"block_words": 64, "shard_blocks": 16}
    sizes = Counter()
    for r in documents.collect():
        sizes[r.source] += WORDS(r.text)
    plan = mixing.Plan(dict(sizes), **options)
    quotas = Counter((plan.shard(plan.index[s], d), s) for s in sizes for d in range(plan.quota[plan.index[s]]))
    rows = mixing.mix(documents, places=True, **options).withColumn("task", F.spark_partition_id()).collect()
    places = [(r.task, r.mix_shard, r.mix_position) for r in rows]
    assert places == sorted(places) and len({r.task for r in rows}) > 3
    assert len({(r.task, r.mix_shard) for r in rows}) == len({r.mix_shard for r in rows}) == plan.shards > 10
    assert Counter((shard, s) for shard, _, s in {(r.mix_shard, r.mix_position, r.source) for r in rows}) == quotas
    plain = mixing.mix(documents, **options).collect()
    assert [(r.doc_id, r.text) for r in plain] == [(r.doc_id, r.text) for r in rows]
    apart = 1 - sum((q / plan.total) ** 2 for q in plan.quota)                # neighbours that differ by chance
    assert changes([r.source for r in plain]) > 0.8 * apart * plan.total


def test_taken_names_the_places_of_the_mix(documents):
    options = {"block_words": 200, "shard_blocks": 4}
    want = defaultdict(list)
    for r in mixing.mix(documents, places=True, **options).collect():
        want[r.doc_id].append((r.mix_shard, r.mix_position))
    got = {r.doc_id: list(zip(r.shards, r.positions)) for r in mixing.taken(documents, **options).collect()}
    assert {k: v for k, v in got.items() if v} == {k: sorted(v) for k, v in want.items()}


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents)
    mixed = mixing.mix(odd_documents)
    assert mixed.dtypes == odd_documents.dtypes and mixed.filter("text is null").count() == 0
    assert mixing.taken(no_documents).count() == 0 and mixing.mix(no_documents).count() == 0
    assert {r.taken for r in mixing.taken(odd_documents.filter("text is null")).collect()} == {0}


def test_blocks_grow_before_the_tree_has_too_many():
    plan = mixing.Plan({"a": 10 ** 13, "b": 6 * 10 ** 12, None: 10 ** 12})
    assert plan.total < mixing.MOST_BLOCKS and plan.block == 4 * mixing.BLOCK_WORDS
    assert all(abs(t - w) <= 1 for t, w in zip(plan.targets, plan.words))
    shards = {plan.shard(0, draw) for draw in range(0, plan.quota[0], plan.quota[0] // 50)}
    assert len(shards) > 40 and max(shards) < plan.shards
    assert mixing.Plan({"a": 10 ** 6, "b": 5}).block == mixing.BLOCK_WORDS


def test_spans_of_long_texts_are_cut_in_linear_time(spark):
    """Every span of a long text by brute force; one of 4 MB in many spans in seconds."""
    import re
    import time
    text = " \n".join(f"wörd{i}" for i in range(500)) + "  "
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    part = mixing.Words(text, len(spans))
    for first in range(0, 500, 7):
        for words in (1, 2, 250, 500 - first):
            if first + words <= 500:
                assert part.cut(first, words) == (text[spans[first][0]:spans[first + words - 1][1]] if words < 500 else text)
    long = "some words of a text " * 200_000
    n = len(long.split())
    began, part = time.time(), mixing.Words(long, n)
    assert sum(len(part.cut(k, 8192).split()) for k in range(0, n - 8192, 8192)) == n // 8192 * 8192
    assert time.time() - began < 3


def test_the_tree_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(mixing, "TREE_BYTES", 20_000)
    plan = mixing.Plan({f"s{i}": 50_000 for i in range(100)}, block_words=100, shard_blocks=10)
    for draw in range(0, plan.quota[0], 3):
        plan.shard(0, draw)
        assert len(plan._tree) * 8 * 100 <= 20_000
