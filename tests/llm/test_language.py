import math
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import language


def buckets_of(text):
    _, orders = language.ngrams([text])
    return [int(b) for order in orders for b in order]


def test_scores_against_plain_bayes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("text", "lang", language.held_out("doc_id").alias("out")).collect()
    counts, prior = defaultdict(Counter), Counter()
    for r in rows:
        if not r.out:
            counts[r.lang].update(buckets_of(r.text))
            prior[r.lang] += 1
    langs, size = sorted(counts), 1 << language.BITS
    model = language.fit(docs)
    assert model.langs == langs
    some = [r.text for r in rows if r.out][:25]
    names, best = model.predict(some)
    for text, name, share in zip(some, names, best):
        score = {}
        for x in langs:
            total = sum(counts[x].values()) + 0.5 * size
            score[x] = math.log(prior[x] / sum(prior.values())) + sum(math.log((counts[x][b] + 0.5) / total) for b in buckets_of(text))
        top = max(score, key=score.get)
        assert name == top
        assert abs(share - 1 / sum(math.exp(v - score[top]) for v in score.values())) < 1e-3


def test_ngrams_do_not_span_texts():
    texts = ["ab", "", "c" * 5, "İx", "🙂é"]
    starts, orders = language.ngrams(texts)
    for order, single in zip(orders, zip(*[list(language.ngrams([t])[1]) for t in texts])):
        for k, t in enumerate(texts):
            end = starts[k + 1] if k + 1 < len(texts) else len(order)
            assert np.array_equal(order[starts[k] : end], single[k])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.predicted(docs, language.fit(docs)).join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out").collect()
    right = [r.lang == r.lang_pred for r in rows if len(r.text) > 60]
    assert len(right) > 200 and np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, score int"
    docs = spark.createDataFrame([(0, None, "en", 1), (1, "", "en", 1), (2, "12 !? \n", "de", 1), (None, "abc", None, 1), (3, "the the " * 80_000, "en", 1), (3, "𝒳", None, 1)], schema)
    got = language.predicted(docs, language.fit(docs)).collect()
    assert [r.lang_pred for r in got][:3] == ["und"] * 3 and [r.score for r in got][:3] == [0.0] * 3
    assert got[3].held_out and all(r.lang_pred != "und" and r.score > 0 for r in got[3:])
    nothing = language.predicted(docs, language.fit(docs.limit(0))).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == 6
    assert language.predicted(docs.limit(0), language.fit(docs)).count() == 0
