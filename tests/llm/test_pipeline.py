import numpy as np
import public_tokenizers
import tiktoken
from test_decontaminate import slow as slow_leaks
from test_jaccard import slow as slow_groups

import corpus_pipeline
from tidemark.llm import bpe, quality, secrets


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        kept[name] = (before, after)
    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(i in after for i in before if labels.get(i) == 1)
    gone = [i for i in before if i not in after]
    assert gone and np.mean([labels[i] == 0 for i in gone if i in labels]) > 0.9
    before, after = kept["dedup"]
    group = slow_groups([(i, r.text) for i, r in sorted(before.items())])
    assert set(after) == {i for i, g in group.items() if i == g} and len(after) < len(before)
    before, after = kept["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    import re

    fold = lambda t: re.sub(r"[^\W_]", lambda m: m[0] if m[0].isascii() else "é", t or "")
    leaks = {i for i, *_ in slow_leaks([(i, fold(r.text)) for i, r in before.items()], [(j, fold(t)) for j, t in items])}
    assert leaks and set(before) - set(after) == leaks
    before, after = kept["secrets"]
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.text == secrets.redact(before[i].text, secrets.spans(before[i].text)) and r.n_chars == len(r.text)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id: r.ids for r in last} == {i: encoding.encode_ordinary(r.text) for i, r in after.items()}
    assert all(r.n_tokens == len(r.ids) and r.n_bytes == len(after[r.doc_id].text.encode()) for r in last)


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "ids", "n_bytes"] and got.count() > 100


def test_rows_with_nulls(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", None, None, 0), (2, "", None, None, 0), (None, "a b c", None, None, 5)], schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).collect()
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert quality.held_out("doc_id") is not None
