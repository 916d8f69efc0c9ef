"""Stages that drop rows, over null ids and repeated rows."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_one_row_of_each_group_stays(spark, sf):
    texts = [(None, "a b c d e f"), (None, "A b c d e f"), (3, "q r s t u v"), (3, "q r s t u v"), (None, "q r s t u v"), (2, "q r s t u v"), (5, "other"), (5, "differs"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts], SCHEMA).repartition(3)
    got = corpus_pipeline.keep_one_of_each(spark, docs, sf)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), (r.text or "").lower()) for r in got.collect()) == [("2", "q r s t u v"), ("5", "differs"), ("5", "other"), ("None", ""), ("None", "a b c d e f")]


def test_leaks_without_an_id_go(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(None, f"before {item} after", None, None, 0), (None, "clean", None, None, 0), (7, item, None, None, 0), (7, "clean too", None, None, 0)], SCHEMA)
    got = corpus_pipeline.drop_leaks(spark, docs, sf)
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [("7", "clean too"), ("None", "clean")]


def test_stages_send_small_batches(spark, sf):
    given = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    docs = spark.createDataFrame([(1, "a b", None, None, 3)], SCHEMA)
    try:
        for rows, want in (("10000", "2000"), ("0", "2000"), ("500", "500")):
            for stage in (corpus_pipeline.mask_secrets, corpus_pipeline.to_tokens, corpus_pipeline.keep_one_of_each):
                spark.conf.set(corpus_pipeline.BATCH_SETTING, rows)
                stage(spark, docs, sf)
                assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == want
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, given)
