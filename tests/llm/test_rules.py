import re
from collections import Counter

import pytest

from tidemark.llm import rules

TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c", "a b c b c a b c", "x x x x x", "l1 a\nl1 a\n\n \n \nl1 a\nl2", "a\x0bb\x0cc\rd\x1ce\x85f é🙂 #$% <|>", "w " * 60, " ".join(f"w{k}" for k in range(80)), "und " * 20_000,
    "line\n" * 50, "a  b\tc d a b c d a\nb c", " ".join(f"w{k}" for k in range(60)) + " #" * 30,
]


def slow(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_measures_and_hosts(spark):
    good = " ".join(f"w{k}" for k in range(80))
    rows = [(k, t, "mixed") for k, t in enumerate(TEXTS)]
    rows += [(100 + k, "bad", "bad.example") for k in range(40)] + [(140, good, "bad.example"), (141, good, None), (None, good, None), (141, good, None)]
    rows += [(200 + k, good, f"host{k % 7}") for k in range(70)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_words int").repartition(3)
    got = rules.judged(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow(t), t
    assert by[140].host_failed and not by[140].base_failed and not by[140].kept
    assert by[141].kept and all(by[200 + k].kept for k in range(70))
    assert all(r.kept == (not r.base_failed and not r.host_failed) for r in got)


def test_hash_collisions_count_for_nothing(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(rules.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    docs = spark.createDataFrame([(k, t, "h") for k, t in enumerate(TEXTS) if len(t or "") < 1000], "doc_id long, text string, source string")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.id: r.n_repeat_words for r in rules.measured(docs).collect()} == {k: slow(t)[4] for k, t in texts.items()}


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(1, "x y z " * 30, "h")], "doc_id long, text string, source string").limit(n)
    assert rules.judged(docs).count() == n
