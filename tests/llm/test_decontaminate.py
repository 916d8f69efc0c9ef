import re

import pytest

from tidemark.llm import decontaminate as d


def slow(docs, items, t=0.8):
    def words(x):
        return [w for w in re.split(r"[^a-z0-9éü]+", (x or "").lower()) if w]

    def runs(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    out = []
    for i, a in docs:
        for j, b in items:
            w = words(b)
            own = runs(w, min(5, len(w))) if w else set()
            if own:
                held = len(own & runs(words(a), min(5, len(w))))
                if held * 10 >= len(own) * 10 * t - 1e-6:
                    out.append((i, j, len(own), held))
    return sorted(out, key=str)


BASE = [f"w{k}" for k in range(40)]
ITEMS = [(1, " ".join(BASE)), (2, "Short one"), (3, "three little words"), (4, ""), (5, None), (6, " ".join(BASE[10:16])), (7, "a b a b a b a b a b a b"), (None, "null id item of some words here"), (9, "é ü é ü Z"), (1, " ".join(BASE))]
DOCS = [
    (1, "before " + " ".join(BASE).upper().replace(" ", ", ") + " after"),
    (2, " ".join(BASE[:20] + ["x"] + BASE[21:])),  # 31 of 36
    (3, " ".join(BASE[:10] + ["x"] + BASE[11:20] + ["y"] + BASE[21:])),  # 26 of 36
    (4, None), (5, ""), (6, "the short ONE is here; three little, words"), (7, "a b " * 30_000), (8, "clean " + "text of its own " * 9), (None, "null id item of some words here"), (9, "É ü é ü z"),
    (1, "short one"), (1, "short one"),
]


@pytest.mark.parametrize(("block", "bits"), [(64 << 20, 16), (500, 1)])
def test_against_brute_force(spark, monkeypatch, block, bits):
    monkeypatch.setattr(d, "BLOCK_BYTES", block)
    monkeypatch.setattr(d, "BITS_A_HASH", bits)
    docs = spark.createDataFrame([(*r, 0, 0) for r in DOCS], "doc_id long, text string, item_id int, h int").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in d.contaminated(docs, items).collect()), key=str)
    assert got == slow(DOCS, ITEMS[:-1])  # equal items count once
    kept = d.decontaminate(docs, items)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "8"] and kept.columns == docs.columns


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.contaminated(docs, items).count() == 1
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0
    assert d.contaminated(docs, items.limit(0)).columns == ["doc_id", "item_id", "n_shingles", "n_found", "containment"]


def test_broadcasts_one_row_an_item(spark):
    """The side that is joined by hash has no shingles; those come once an item."""
    items = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(900)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(800)))], "doc_id long, text string")
    found = d.contaminated(docs, items)
    assert found.count() == 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2


def test_rows_are_judged_by_their_own_texts(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "a b c d e f", 1), (None, "clean", 2), (7, "a b c d e f", 3), (7, "clean", 4), (7, "clean", 4)], "doc_id long, text string, row_key int")
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text, r.row_key) for r in kept.collect()) == [("7", "clean", 4), ("7", "clean", 4), ("None", "clean", 2)]
    assert d.decontaminate(docs, items.limit(0)).count() == 5
    assert d.decontaminate(docs.limit(0), items).count() == 0
