import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "    ", "\n\n\n  x", "a  b\n\n c\t 　x \x1c\x1d hi's 'S don't", "日本語 テスト ١٢٣ ½ 🙂🙂 é '''s   ", "a" * 500 + "!" * 300, "<|endoftext|> it", "\x85​﻿ z", "\0\0 \x7f", "ab" * 40, "  the the the",
]


def test_as_the_library(spark, ranks, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_A_ROW", 3)
    rng = np.random.default_rng(2)
    letters = list("etaonhi  \n'.,!é日🙂0") + ["the", "ing", "'re"]
    texts = [*TEXTS, *("".join(rng.choice(letters, 60)) for _ in range(150)), *TEXTS]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(2)
    for most in (10, 1_000_000):  # the table of a task starts anew, or never does
        got = {r.doc_id: r for r in bpe.encode(docs, ranks, public_tokenizers.PATTERN, max_words=most).collect()}
        for k, t in enumerate(texts):
            want = encoding.encode_ordinary(t or "")
            assert got[k].ids == want and got[k].ids_le == np.array(want, "<u4").tobytes()


def test_digests_of_a_table(spark, ranks, encoding):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = bpe.digests(docs, ranks, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_decode_rows(spark, ranks):
    rows = spark.createDataFrame([(None,), ([],), ([0, 256, 50255],)], "ids array<int>")
    back = {v: k for k, v in ranks.items()}
    assert [r.decoded for r in bpe.decode(rows, ranks).collect()] == [None, b"", back[0] + back[256] + back[50255]]
    for bad in ([50256], [-1], [None]):
        with pytest.raises(Exception, match="not in the vocabulary"):
            bpe.decode(spark.createDataFrame([(bad,)], "ids array<int>"), ranks).collect()


def test_null_ids_and_empty(spark, ranks):
    docs = spark.createDataFrame([(None, "the"), (None, "the"), (3, None)], "doc_id int, text string")
    got = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), len(r.ids)) for r in got.collect()) == [("3", 0), ("None", 1), ("None", 1)]
    assert bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_units_are_apart_for_the_pattern(ranks, encoding):
    import random

    import regex

    pattern = public_tokenizers.PATTERN
    words = regex.compile(pattern).findall
    assert bpe.cuts_at_blanks(pattern)
    rng = random.Random(5)
    around = ["a", "1", "!", "'s", "", " ", "\n", "  "]
    texts = [a + x + chr(k) + x + b for k in [*range(0x300), *range(0x1600, 0x1700), *range(0x1F00, 0x2100), 0x3000, 0x3001, 0xFEFF, 0x1F600] for x in ("", " ", "\n") for a, b in [rng.choices(around, k=2)]]
    texts += ["".join(rng.choices("ab1! \n\t'\x1c\u3000", k=rng.randint(0, 30))) for _ in range(20000)]
    import pyarrow as pa

    apart = {}
    given = pa.array(texts)
    for mask, lists in bpe.unit_lists(given, True):
        apart |= dict(zip(given.filter(mask).to_pylist(), lists.to_pylist(), strict=True))
    for t in texts:
        own = [bpe.unit_text(k) for k in apart[t]]
        assert "".join(own) == t
        assert [w for u in own for w in words(u)] == words(t)
        assert sum((encoding.encode_ordinary(u) for u in own), []) == encoding.encode_ordinary(t)


@pytest.mark.parametrize("pattern", [r"\p{L}+|\s+", r"[\s\p{L}]+|\s+(?!\S)|\s+", r"\p{N}{1,3}| ?\p{L}+|\s+(?!\S)|\s+", r"a b|\s+(?!\S)|\s+"])
def test_other_patterns_take_whole_texts(spark, ranks, pattern):
    assert not bpe.cuts_at_blanks(pattern)
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["the a b  1234 x\n\n y ", "a b a b", " \n", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, ranks, pattern).collect()}
    assert got == {k: other.encode_ordinary(t or "") for k, t in enumerate(texts)}


def test_long_words(spark, ranks, encoding):
    import time

    rng = np.random.default_rng(7)
    letters = list("etaonhisrdlu")
    sizes = (bpe.LONG - 1, bpe.LONG, bpe.LONG + 1, 3000, 20_000)
    texts = ["".join(rng.choice(letters, n)) for n in sizes] + ["é" * 600 + "x", "a" * 5000, "x " + "ab" * 2000 + " y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, ranks, public_tokenizers.PATTERN).collect()}
    assert got == {k: encoding.encode_ordinary(t) for k, t in enumerate(texts)}
    word = np.frombuffer("".join(rng.choice(letters, 1_000_000)).encode(), np.uint8)
    single = np.array([ranks[bytes([b])] for b in range(256)])
    pairs = bpe.pair_ranks(ranks)
    began = time.time()
    assert len(bpe.merge_long(single[word], pairs)) < 600_000
    assert time.time() - began < 60


def test_plans_hold_no_ranks(spark, ranks, capsys):
    """Spark's driver keeps the text of each plan that it has run."""
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bpe.checked(docs, ranks, public_tokenizers.PATTERN).explain("extended")
    assert len(capsys.readouterr().out) < 100_000


def test_words_come_apart_where_no_merge_joins(ranks, encoding, monkeypatch):
    rng = np.random.default_rng(11)
    letters = list("etaonhisrdlu") + ["é", "日", "本", "!", "0", "'", "🙂", "ß", "\0", " "]
    words = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 30, 4000)] + ["", "a", "", "th" * 900, ""]
    single, pairs = np.array([ranks[bytes([b])] for b in range(256)]), bpe.pair_ranks(ranks)

    def ids(piece: bytes) -> list[int]:
        return bpe.merge_long(single[np.frombuffer(piece, np.uint8)], pairs)

    for bits, most in ((23, 1 << 18), (10, 100)):  # a hash that is often hit leaves places out, no more
        monkeypatch.setattr(bpe.Cuts, "BITS", bits)
        monkeypatch.setattr(bpe.Cuts, "AT_ONCE", most)
        pieces, first = bpe.cut_words(words, bpe.Cuts(ranks))
        pieces = pieces.to_pylist()
        assert len(first) == len(words) + 1 and first[-1] == len(pieces) and all(pieces)
        for w, a, b in zip(words, first[:-1], first[1:], strict=True):
            assert b"".join(pieces[a:b]) == w.encode()
            assert sum(map(ids, pieces[a:b]), []) == ids(w.encode())
        assert bits == 10 or len(pieces) > 1.5 * len(words)
    assert bpe.cut_words([], bpe.Cuts(ranks))[1].tolist() == [0]
    assert bpe.cut_words(["", ""], bpe.Cuts(ranks))[1].tolist() == [0, 0, 0]


def test_few_merges_and_many_ids():
    """Ids so high that a pair's bucket is told by both, and a file that merges nothing."""
    few = {bytes([b]): b for b in range(256)}
    assert not any(bpe.RankMap(few).buckets.to_pylist())
    high = few | {b"ab": (1 << bpe.ID_BITS) - 1, b"abc": 70_000, b"cab": 300}
    known = bpe.RankMap(high)
    got = {(k, b): rank >> bpe.PART_BITS + bpe.ID_BITS for k, bucket in enumerate(known.buckets.to_pylist()) for b, rank in bucket}
    pairs = bpe.pair_ranks(high)
    assert got == {((a * known.SPREAD + b) % known.n, b): rank for (a, b), rank in pairs.items()}
    assert len(got) == len(pairs) == 3


def test_each_distinct_piece_is_folded_once(spark, ranks, encoding):
    """Words that share pieces send these to the fold once, and the fold searches no array by an exception."""
    pattern = public_tokenizers.PATTERN
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text or "" for r in docs.collect()]
    import pyarrow as pa
    import regex

    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc", "text"])
    made = [w for out in bpe._number_units(pattern, 1_000_000, bpe.Cuts(ranks))(iter([batch])) for row in out.column("new").to_pylist() for w in row or []]
    words = {w for t in texts for w in regex.findall(pattern, t)}
    assert len(made) == len({*map(tuple, made)})
    assert sum(map(len, made)) < 0.8 * sum(len(w.encode()) for w in words)
    plan = bpe.encode(docs, ranks, pattern)._jdf.queryExecution().toString()
    assert "array_position" not in plan and "array_min" in plan
