"""Quality rules: counts by brute force, the model against a direct one."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermart.llm import ngram_model as N
from ordermart.llm import quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té# \x1c", max_size=120))
def test_measures(text):
    assert Q.measures(text) == brute(text)


def direct(grams):
    """Modified Kneser-Ney by its definition, with dictionaries."""
    levels = [Counter(tuple(g >> N.BITS * k & 2 ** N.BITS - 1 for k in range(3, -1, -1)) for g in grams.tolist())]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    discounts = [N._discounts(np.array(list(x.values()), float)) for x in levels]

    def p(g):
        if not g:
            return 2 ** -N.BITS
        level, d = levels[len(g) - 1], discounts[len(g) - 1]
        after = {h: n for h, n in level.items() if h[:-1] == g[:-1]}
        if not after:
            return p(g[1:])
        n, total = level.get(g, 0), sum(after.values())
        back = sum(d[min(3, x)] for x in after.values()) / total
        return (n - d[min(3, n)] if n else 0) / total + back * p(g[1:])
    return p


def test_model_equals_the_definition():
    corpus = "the cat sat on the mat.\nThe dog, 12 dogs and the cat! été"
    codes, n = np.unique(N.grams(corpus), return_counts=True)
    model, p = N.Model.fit(codes, n), direct(N.grams(corpus))
    model = N.Model.load(model.dump())
    probe = np.unique(np.concatenate([N.grams("the dog sat 7 ZZ"), N.grams(corpus)]))
    want = [math.log(p(tuple(int(g) >> N.BITS * k & 2 ** N.BITS - 1 for k in range(3, -1, -1)))) for g in probe]
    assert np.allclose(model.log_prob(probe), want, atol=1e-4)
    context = (N.grams("the")[2] & N._MASKS[3]) << N._STEP
    assert np.exp(model.log_prob(context | np.arange(2 ** N.BITS, dtype=np.uint64))).sum() == pytest.approx(1, abs=1e-4)
    scorer = N.Scorer(model)
    for _ in range(2):                                          # new and remembered n-grams
        assert np.allclose(scorer.log_prob(np.tile(probe, 3)), np.tile(want, 3), atol=1e-4)


def test_characters_of_any_script_are_told_apart():
    text = "aZ é Я я ש ع\0"
    assert len(set(N.characters(text).tolist())) == len(set(text)) and 0 not in N.characters(text)
    many = "".join(chr(0x4E00 + k) for k in range(3000)) + "😀"
    assert len(set(N.characters(many).tolist())) > 1200 and N.characters(many).max() < 2 ** N.BITS


def test_counts_are_those_of_all_good_documents(spark, small_dir, documents):
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    want = defaultdict(Counter)
    for r in documents.collect():
        if r.doc_id in good:
            want[r.lang].update(N.grams(r.text or "").tolist())
    rows = Q.count_grams(documents.repartition(3).join(Q.good_documents(labels), "doc_id", "left_semi")).collect()
    assert {(r.lang, r.code): r.n for r in rows} == {(k, c): n for k, x in want.items() for c, n in x.items()}


def test_verdicts_keep_good_and_reject_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train = labels.filter("doc_id % 5 <> 0")                               # a fifth of the labels is held out
    rows = {r.doc_id: r for r in Q.quality(docs, train).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[i]) for i, r in rows.items())
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows.values())
    assert not any(r.kept and r.base_failed for r in rows.values())
    held = [(r.quality, rows[r.doc_id]) for r in labels.filter("doc_id % 5 = 0").collect() if not rows[r.doc_id].base_failed]
    assert all(r.kept for q, r in held if q == 1)
    assert sum(not r.kept for q, r in held if q == 0) >= 0.8 * sum(q == 0 for q, _ in held)


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, None), (8, None, 0), (None, 1, 1), (99, 1, 0), (6, 1, 0), (6, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = Q.quality(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count()
    assert {r.kept for r in rows if r.doc_id == 7} == {True}
    assert {r.base_failed for r in rows if r.doc_id in (0, 1, 2, 3)} == {True}
    kept = Q.keep_good(odd_documents, labels)
    assert kept.dtypes == odd_documents.dtypes and kept.filter("doc_id = 7").count() == 3
    assert Q.quality(no_documents, labels).count() == 0
    assert Q.quality(odd_documents, labels.limit(0)).filter("not base_failed and not kept").count() == 0


def brute_kept(rows, good):
    """Verdicts one document at a time: model and band of each language from
    its good documents, or from all of them where none is good."""
    langs = defaultdict(list)
    for doc_id, lang, text in rows:
        langs[lang].append((doc_id, text or ""))
    out = {}
    for lang, docs in langs.items():
        own = [t for i, t in docs if i in good]
        counts = Counter(g for t in own or [t for _, t in docs] for g in N.grams(t).tolist())
        codes = np.array(sorted(counts))
        model = N.Model.load(N.Model.fit(codes, np.array([counts[c] for c in codes])).dump())
        score = {i: -float(model.log_prob(N.grams(t)).astype(np.float32).astype(float).mean()) for i, t in docs}
        ref = sorted(score[i] for i, _ in docs if i in good) if own else sorted(score.values())
        at = lambda p: ref[max(1, math.ceil(p * len(ref))) - 1]
        far = 3 * (at(0.75) - at(0.25))
        low, high = (at(Q.TAIL), at(1 - Q.TAIL)) if own else (at(0.25) - far, at(0.75) + far)
        for i, t in docs:
            out[i] = (score[i], low - math.log(Q.MARGIN), high + math.log(Q.MARGIN), Q.base_failed(*(lambda m: (m[0], m[4]))(brute(t))))
    return out


def check_kept(docs, labels):
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    want = brute_kept(rows, {r.doc_id for r in Q.good_documents(labels).collect()})
    got = {r.doc_id: r for r in Q.quality(docs, labels).collect()}
    for i, (score, low, high, failed) in want.items():
        assert got[i].log_perplexity == pytest.approx(score, abs=1e-4)
        if min(abs(score - low), abs(score - high)) > 1e-3:
            assert got[i].kept == (not failed and low <= score <= high)
    return got


def test_verdicts_by_brute_force(spark, documents, small_dir):
    check_kept(documents, spark.read.parquet(f"{small_dir}/labels.parquet"))


def test_a_language_without_labels_and_another_script(spark):
    """Russian prose and letter junk: with good documents, and in a language
    where none is labelled."""
    rng = np.random.default_rng(4)
    stems = ["дом", "город", "ветер", "стол", "книга", "вода", "дорога", "время", "человек", "работа", "день", "рука", "жизнь"]
    ends = ["а", "ы", "ов", "ом", "ами", "е", ""]
    prose = lambda: " ".join(rng.choice(stems) + rng.choice(ends) for _ in range(80))
    junk = lambda: " ".join("".join(rng.choice(list("абвгдежзийклмнопрстуфхцчшщъыьэюя"), 7)) for _ in range(80))
    for lang_of_good in ("ru", None):
        rows = [(i, "ru", prose()) for i in range(60)] + [(100 + i, "ru", junk()) for i in range(5)]
        docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
        labels = spark.createDataFrame([(i, 1, 0) for i in range(30) if lang_of_good] + [(999, 1, 0)],
                                       "doc_id long, quality int, toxic int")
        got = check_kept(docs, labels)
        assert all(r.kept == (i < 100) for i, r in got.items())
