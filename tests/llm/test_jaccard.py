import random

import pytest

import corpus_pipeline
from tidemark.llm import jaccard, simhash


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def slow(rows, threshold=0.8):
    """{id: least id reachable}, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for x in range(len(rows)):
            for y in range(len(rows)):
                both = len(sets[x] & sets[y])
                if both >= threshold * (len(sets[x] | sets[y])) - 1e-9 and group[y] < group[x]:
                    group[x], changed = group[y], True
    return {i: g for (i, _), g in zip(rows, group)}


@pytest.mark.parametrize("sample", [0, 2000])
def test_against_brute_force(spark, monkeypatch, sample):
    monkeypatch.setattr(jaccard, "SAMPLE", sample)
    rng = random.Random(4)
    words, passage = [f"w{k}" for k in range(400)], [f"p{k}" for k in range(25)]
    rows = [None, "", " \n", "One two", "one TWO", "a b c d e", "a b c d f"]
    for _ in range(15):
        base = rng.choices(words, k=60) + passage
        for _ in range(8):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(60)] = rng.choice(words)
            rows.append(" ".join(t))
    rows = list(enumerate(rows))
    want = slow(rows)
    assert 20 < len(set(want.values())) < len(rows) - 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == want


def test_stage_links_by_similarity_and_not_by_fingerprint(spark, sf):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    # 96 shingles; 8 in a row changed: 88 of 104 are shared, 0.85. 4 words apart in the text: 20 changed, 0.66.
    near, apart = [*base[:4], *["x%d" % k for k in range(4)], *base[8:]], [*base]
    for k in (20, 40, 60, 80):
        apart[k] = f"y{rng.random()}"
    texts = [" ".join(t) for t in (base, near, apart)]
    prints = [simhash.fingerprint(t.encode(), 5) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() > jaccard.RADIUS
    docs = spark.createDataFrame([(k, t, None, None, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, sf).collect()) == [0, 2]


def test_sketches_never_rule_out_a_link():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (5, 40, 1024, 1500, 4096, 9000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        for share in (0.0, 0.5, 0.8, 0.9, 1.0):
            b = np.unique(np.concatenate([a[: int(share * n)], rng.integers(0, 1 << 63, int((1 - share) * n * 0.9)).astype(np.uint64)]))
            apart = len(np.setxor1d(a, b))
            x, y = jaccard.sketch(a).view(np.uint64), jaccard.sketch(b).view(np.uint64)
            assert np.bitwise_count(x ^ y).sum() <= apart
            fits = jaccard.wide_fit(jaccard.wide_sketch(a), jaccard.wide_sketch(b), len(a) + len(b), 0.8)
            assert fits or len(np.intersect1d(a, b)) * 10 < 8 * len(np.union1d(a, b))
            assert not fits or share > 0.5 or min(len(a), len(b)) < jaccard.WIDE


def test_a_large_group_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "WIDE", 64)
    rng = random.Random(11)
    words = [f"w{k}" for k in range(900)]
    base = rng.choices(words, k=120)
    rows = []
    for _ in range(150):  # copies of one text, few of them near each other
        t = list(base)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(120)] = rng.choice(words)
        rows.append(" ".join(t))
    passage = rng.choices(words, k=60)
    for _ in range(40):  # unlike texts with a passage in common
        rows.append(" ".join([*rng.choices(words, k=100), *passage]))
    rows = list(enumerate(rows))
    want = slow(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for small in (0, 8, 1000):
        monkeypatch.setattr(jaccard, "SMALL", small)
        assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == want
