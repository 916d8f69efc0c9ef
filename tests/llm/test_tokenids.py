import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import tokenids

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello  the\tworld's\n\n x", "é ́ Ångström ΑΣ Σ ΟΔΥΣΣΕΥΣ İstanbul", "\x1c\x1d a\x85b\xa0c　d​e", "<|endoftext|> <|startoftext|>x", "日本語 🙂 ½ 12345 -- ***", "the " * 60_000, "가 ᅡ", "a\0b", "\x01 a\x01b \x01\x01"]


def reference(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_give_the_ids_of_the_whole(monkeypatch):
    monkeypatch.setattr(tokenids, "CACHED_PIECES", 50)
    rng = np.random.default_rng(4)
    letters = list("a\x01eéΣİ's'.,!? \n\t\x0b\x1ć̈🙂0") + ["the", "'ll", "\r\n", "<|endoftext|>"]
    texts = [*TEXTS, *("".join(rng.choice(letters, 40)) for _ in range(400))]
    own = tokenids.encoder(PATH)
    got = [b for k in range(0, len(texts), 7) for b in own.encode(pa.array([t or "" for t in texts[k : k + 7]]), b"")]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == reference(texts)


def test_plain_pieces(monkeypatch):
    monkeypatch.setattr(tokenids, "CACHED_PIECES", 300)
    rng = np.random.default_rng(6)
    letters = list("abctheings") * 3 + [chr(k) for k in [*range(33, 127), *range(0xA1, 0x100)]] + list("    \n")
    texts = ["".join(rng.choice(letters, 60)) for _ in range(600)] + ["it's IT'S don't 's 'S a'll1x2 ×÷ ß ÀÉÿ A\u0301 É\u0323 naïve, end."]
    own = tokenids.Encoder(PATH)
    assert own.model is not None
    got = [b for k in range(0, len(texts), 50) for b in own.encode(pa.array(texts[k : k + 50]), b"")]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == reference(texts)


def test_tokenizers_that_keep_blanks_get_whole_texts(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = tokenids.Encoder(path)
    assert not own.apart
    texts = ["", "a  b\n\n c", "<|endoftext|> it's", " x "]
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(pa.array(texts), b"")] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shards = tokenids.write(docs, f"file://{tmp_path}/whole", path, end_id=None)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in tokenids.read(spark, shards).collect()} == dict(enumerate(want))


def test_which_files_allow_pieces():
    import json

    spec = json.load(open(PATH))
    assert tokenids.split_pattern(spec)
    for change in (
        lambda s: s.update(normalizer=None),
        lambda s: s["normalizer"]["normalizers"].pop(),
        lambda s: s["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True),
        lambda s: s["pre_tokenizer"]["pretokenizers"][0].update(pattern={"Regex": r"\s?[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}),
        lambda s: s["added_tokens"].append({"content": "a b", "special": False}),
    ):
        other = json.loads(json.dumps(spec))
        change(other)
        assert tokenids.split_pattern(other) is None


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenids, "FRAME_IDS", 16)
    rows = [(k * 3 % 31 - 5, t) for k, t in enumerate(TEXTS * 3)] + [(None, "null id"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id int, text string, ids string, start int").repartition(3)
    shards = tokenids.write(docs, f"file://{tmp_path}/out", PATH)
    got = sorted(tokenids.read(spark, shards).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: -100 if i is None else i)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    want = sorted((str(i), [*ids, 1]) for (i, _), ids in zip(rows, reference([t for _, t in rows])))
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    crc = tokenids.read(spark, shards).select(F.crc32("ids").alias("c"), "ids").collect()
    assert all(r.c == zlib.crc32(r.ids) for r in crc)


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    shards = tokenids.write(docs, f"file://{tmp_path}/none", PATH)
    assert shards == [] and tokenids.read(spark, shards).count() == 0


def shard(tmp_path, docs, name="a"):
    uri = f"file://{tmp_path}/{name}"
    with tokenids.publish(uri) as out:
        w = tokenids.Writer(out)
        for i, ids in docs:
            w.add(i, np.array(ids, "<u4").tobytes())
        w.close()
    return uri


def test_only_the_frames_asked_for(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenids, "FRAME_IDS", 8)
    docs = [(k, list(range(k, k + k % 7))) for k in range(60)]
    s = tokenids.Shard(shard(tmp_path, docs))
    assert len(s.entries) > 10
    taken = []
    plain = s._read
    s._read = lambda at, size: taken.append(at) or plain(at, size)
    assert np.frombuffer(s.document(40), "<u4").tolist() == docs[40][1] and len(taken) == 1
    assert [np.frombuffer(d, "<u4").tolist() for d in s.documents()] == [ids for _, ids in docs]
    # Any reader of zstd sees the ids one after another.
    whole = zstandard.ZstdDecompressor().stream_reader(open(f"{tmp_path}/a", "rb"), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u4").tolist() == [x for _, ids in docs for x in ids]


def test_damage_is_found(tmp_path):
    uri = shard(tmp_path, [(1, [1, 2, 3] * 50), (2, [4])])
    data = bytearray(open(f"{tmp_path}/a", "rb").read())
    n, _, magic = struct.unpack("<IBI", data[-9:])
    assert (n, magic) == (2, 0x8F92EAB1)
    data[-9 - 24 + 8] ^= 1  # the checksum of the first frame
    open(f"{tmp_path}/a", "wb").write(data)
    with pytest.raises(ValueError, match="checksum"):
        tokenids.Shard(uri).document(0)
    open(f"{tmp_path}/a", "wb").write(data[:-1])
    with pytest.raises(ValueError, match="seek table"):
        tokenids.Shard(uri)
