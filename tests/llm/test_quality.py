import itertools

import numpy as np
import pytest

from tidemark.llm import quality


def slow_marginals(score, trans):
    """Sums over all label sequences of one chain."""
    total, good = 0.0, np.zeros(len(score))
    for path in itertools.product((0, 1), repeat=len(score)):
        w = np.exp(sum(s for s, y in zip(score, path) if y) + sum(trans[a, b] for a, b in itertools.pairwise(path)))
        total += w
        good += w * np.array(path)
    return good / total


def test_marginals_against_all_paths():
    rng = np.random.default_rng(1)
    lines = np.array([1, 5, 3, 8, 1])
    score, trans = rng.normal(size=lines.sum()), rng.normal(size=(2, 2))
    got = quality.marginals(score, trans, quality._Steps(lines))[0]
    ends = np.cumsum(lines)
    want = np.concatenate([slow_marginals(score[e - k : e], trans) for e, k in zip(ends, lines)])
    assert np.allclose(got, want)


def test_features_of_lines():
    texts = ["", "AB ab ab\n\n*** x!", "same line\nother\nsame line", "\n", "🙂 é" * 3]
    f, lengths, lines = quality.line_features(texts)
    assert lines.tolist() == [1, 3, 3, 2, 1] and lengths.tolist() == [len(x) for t in texts for x in t.split("\n")]
    assert f[1, 1] == pytest.approx(2 / 6) and f[1, 7] == pytest.approx(1 / 3) and f[2, 10] == 1
    assert f[3, 2] == pytest.approx(4 * 3 / 6) and f[:, 9].tolist() == [0, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    one_by_one = [quality.line_features([t]) for t in texts]
    assert np.array_equal(f, np.concatenate([x[0] for x in one_by_one]))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = quality.scored(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    right = [(r.score >= 0.3) == bool(r.quality) for r in rows]
    assert np.mean(right) >= 0.97
    good = [r.score for r in rows if r.quality]
    assert min(good) >= 0.3
    kept = quality.good(docs, model)
    assert kept.columns == docs.columns and kept.count() == quality.scored(docs, model).where("score >= 0.3").count()


def test_edge_rows_and_missing_labels(spark):
    schema = "doc_id long, text string, score double, held_out int"
    docs = spark.createDataFrame([(1, None, 0.0, 1), (2, "", 0.0, 1), (None, "x", 0.0, 1), (2, "", 0.0, 1), (3, "long line " * 90_000, 0.0, 1)], schema)
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality.scored(docs, none).collect()
    assert len(got) == 5 and all(r.score == 0.5 for r in got) and [r.held_out for r in got if r.doc_id is None] == [True]
    one = quality.fit(docs, spark.createDataFrame([(1, None), (2, 1), (3, 1), (3, 1)], "doc_id long, quality int"))
    assert all(0.5 < r.score < 1 for r in quality.scored(docs, one).collect())
    assert quality.scored(docs.limit(0), one).count() == 0
