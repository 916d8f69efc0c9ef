"""Token ids in binary files: independent zstd frames and a trailing seek table.

A shard holds the documents of one range of ids, in ascending order. Its bytes:

* data frames, each the ids of whole documents (little-endian 32-bit integers),
* a skippable frame with the directory: of each document its id and how many
  token ids it has (itself a zstd frame inside),
* a skippable frame with the seek table of the public seekable zstd format: for
  each frame its compressed and decompressed size and a checksum (the low half
  of XXH64), then the number of frames, a descriptor and a magic number.

Any zstd reader decompresses a shard from end to end; ``Shard`` reads only the
frames of the documents asked for, and checks each against its checksum.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Table, text_or_empty, tidy
from tidemark.llm.files import publish, resolve

#: Fixed values of the seekable format, and of the skippable frame of the directory.
SEEKABLE_MAGIC, SEEK_FRAME_MAGIC, DIRECTORY_MAGIC = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
_CHECKSUMS = 0x80
#: A data frame ends with the document that brings it to so many token ids.
FRAME_IDS = 1 << 15
#: Pieces of text whose ids a Python worker remembers; beyond that it starts anew.
CACHED_PIECES = 1_000_000


#: Stands between pieces that are encoded together.
MARK = "\x01"
#: Characters that a normalizer of the known kind lower-cases one by one and leaves alone otherwise.
_PLAIN = re.compile("[!-~\u00c0-\u00ff]+")
#: Letters with at most marks behind them.
_SIMPLE = re.compile("([A-Za-z]+)([!-&(-/:-@\\[-`{-~]*)")


def split_pattern(spec: dict) -> str | None:
    """The pattern of a tokenizer file (its JSON) under which pieces between white space are independent.

    So they are if the normalizer only composes, replaces white space and
    lower-cases, and the words are the matches of a pattern that takes no white
    space and looks at nothing beyond a match. None for any other file.
    """
    normalizer, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [(n.get("type"), (n.get("pattern") or {}).get("Regex"), n.get("content")) for n in normalizer.get("normalizers", [])]
    parts = pre.get("pretokenizers", [])
    if steps != [("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None)] or [x.get("type") for x in parts] != ["Split", "ByteLevel"]:
        return None
    split, to_bytes = parts
    pattern = (split.get("pattern") or {}).get("Regex", "")
    known = split.get("behavior") == "Removed" and split.get("invert") and not to_bytes.get("add_prefix_space") and not to_bytes.get("use_regex")
    alone = re.fullmatch(r"(?:'[a-z]+\|)*\[\\p\{L\}\]\+\|\[\\p\{N\}\]\+?\|\[\^\\s\\p\{L\}\\p\{N\}\]\+", pattern)
    plain = all(t.get("special") for t in spec.get("added_tokens") or []) and spec.get("model", {}).get("type") == "BPE"
    return pattern if known and alone and plain and not spec.get("post_processor") else None


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """The ids that a tokenizer file gives a text.

    Where the file allows it (split_pattern), by its pieces between ASCII white
    space, each distinct piece once: pieces of plain characters are lower-cased
    and cut into words here, and each distinct word goes through the file's
    model; others go through the whole tokenizer. Calls cost more than words do,
    so thousands go in one call; pieces that go through the tokenizer have a
    mark between them, and those that have the mark in them are encoded by
    themselves. Any other file gets whole texts.
    """

    def __init__(self, path: str) -> None:
        import os

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs in parallel
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern = split_pattern(spec)
        self.apart = pattern is not None
        # A control character that stands alone is one token, which no text without it gives.
        mark = self.plain.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.known: dict[str, int] = {}
        self.table = Table()
        self.words: dict[str, bytes] = {}
        self.model = None
        end = spec.get("model", {}).get("end_of_word_suffix")
        if self.apart and end:
            self.cut = regex.compile(pattern).findall
            self.model = Tokenizer(self.plain.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[k for token, k in vocab.items() if token.endswith(end)]] = True
            self.letters = byte_letters()

    def _learn_words(self, words: list[str]) -> None:
        """words: as letters for bytes, so none has white space."""
        for k in range(0, len(words), 4096):
            part = words[k : k + 4096]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(part):
                raise ValueError("words and their ends don't match")
            data, ends = ids.tobytes(), (4 * ends + 4).tolist()
            self.words.update(zip(part, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        made: list = [None] * len(pieces)
        fullmatch, wanted = _SIMPLE.fullmatch, set()
        for k, text in enumerate(pieces if self.model else []):
            simple = fullmatch(text)
            if simple:
                made[k] = own = simple[1].lower(), simple[2]
            elif _PLAIN.fullmatch(text):
                own = self.cut(text.lower())
                if not text.isascii():
                    own = [w.encode().decode("latin-1").translate(self.letters) for w in own]
                made[k] = own
            else:
                continue
            wanted.update(own)
        if len(self.words) > CACHED_PIECES:
            self.words.clear()
        self.words[""] = b""
        self._learn_words([w for w in wanted if w not in self.words])
        get = self.words.__getitem__
        made = [own and b"".join(map(get, own)) for own in made]
        rest = [k for k, ids in enumerate(made) if ids is None]
        for k, ids in zip(rest, self._learn_marked([pieces[k] for k in rest]), strict=True):
            made[k] = ids
        return made

    def _learn_marked(self, pieces: list[str]) -> list[bytes]:
        known: dict[str, bytes] = {}
        apart = [p for p in pieces if self.mark is None or MARK in p]
        for p, e in zip(apart, self.plain.encode_batch_fast(apart, add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, "<u4").tobytes()
        rest = [p for p in pieces if p not in known]
        for k in range(0, len(rest), 4096):
            part = rest[k : k + 4096]
            ids = np.array(self.plain.encode_batch_fast([f" {MARK} ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) != len(part) - 1:
                raise ValueError("pieces and marks don't match")
            data = ids.tobytes()
            starts, ends = [0, *(4 * marks + 4).tolist()], [*(4 * marks).tolist(), len(data)]
            known.update(zip(part, map(data.__getitem__, map(slice, starts, ends)), strict=True))
        return [known[p] for p in pieces]

    def encode(self, texts: pa.StringArray, end: bytes) -> list[bytes]:
        """The ids of each text, which is not null, and ``end``."""
        if not self.apart:
            return [np.array(e.ids, "<u4").tobytes() + end for e in self.plain.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        if len(self.known) > CACHED_PIECES:
            self.known, self.table = {}, Table()
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten().dictionary_encode()
        pieces = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in pieces if p not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            ids = self._learn(new)
            self.table.add(np.frombuffer(b"".join(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4)
        numbers = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        ids, sizes = self.table.pick(numbers[flat.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])] * 4
        data = ids.astype("<i4").tobytes()
        return [data[a:b] + end for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process: workers that Spark uses again keep what they know."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


@dataclass
class Writer:
    """Writes one shard to a stream, holding one frame and the directory in memory."""

    out: object
    level: int = 3
    entries: list[tuple[int, int, int]] = field(default_factory=list)
    ids: list[int] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)
    waiting: list[bytes] = field(default_factory=list)
    size: int = 0

    def __post_init__(self) -> None:
        import zstandard

        self.zstd = zstandard.ZstdCompressor(level=self.level)

    def add(self, doc_id: int, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= 4 * FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            data = b"".join(self.waiting)
            frame = self.zstd.compress(data)
            self.out.write(frame)
            self.entries.append((len(frame), len(data), _checksum(data)))
            self.waiting, self.size = [], 0

    def close(self) -> None:
        self.flush()
        body = self.zstd.compress(struct.pack("<Q", len(self.ids)) + np.array(self.ids, "<i8").tobytes() + np.array(self.counts, "<u8").tobytes())
        frame = _skippable(DIRECTORY_MAGIC, body)
        self.out.write(frame)
        self.entries.append((len(frame), 0, _checksum(b"")))
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        self.out.write(_skippable(SEEK_FRAME_MAGIC, table + struct.pack("<IBI", len(self.entries), _CHECKSUMS, SEEKABLE_MAGIC)))


class Shard:
    """Reads a shard; a frame is read, checked and decompressed when a document of it is asked for."""

    def __init__(self, uri: str) -> None:
        import zstandard

        fs, path = resolve(uri)
        self.uri, self.file = uri, fs.open_input_file(path)
        self.zstd = zstandard.ZstdDecompressor()
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & _CHECKSUMS:
            raise ValueError(f"{uri} has no seek table with checksums")
        table_at = size - 9 - 12 * n
        self.entries = np.frombuffer(self._read(table_at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        if struct.unpack("<II", self._read(table_at - 8, 8)) != (SEEK_FRAME_MAGIC, 12 * n + 9):
            raise ValueError(f"{uri} has a damaged seek table")
        self.offsets = np.cumsum(self.entries[:, 0]) - self.entries[:, 0]
        frame = self._read(int(self.offsets[-1]), int(self.entries[-1, 0]))
        body = self.zstd.decompress(frame[8:])
        docs = struct.unpack("<Q", body[:8])[0]
        self.ids = np.frombuffer(body, "<i8", docs, 8)
        self.counts = np.frombuffer(body, "<u8", docs, 8 + 8 * docs).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts  # in token ids, within the shard
        frame_ids = self.entries[:-1, 1] // 4
        self.frame_starts = np.cumsum(frame_ids) - frame_ids
        self.held: tuple[int, bytes] = (-1, b"")

    def __len__(self) -> int:
        return len(self.ids)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            packed, size, want = (int(x) for x in self.entries[k])
            data = self.zstd.decompress(self._read(int(self.offsets[k]), packed), max_output_size=size)
            if len(data) != size or _checksum(data) != want:
                raise ValueError(f"frame {k} of {self.uri} doesn't match its checksum")
            self.held = (k, data)
        return self.held[1]

    def document(self, k: int) -> bytes:
        """The ids of the k-th document, as little-endian 32-bit integers."""
        start, count = int(self.starts[k]), int(self.counts[k])
        if not count:
            return b""
        f = int(np.searchsorted(self.frame_starts, start, side="right")) - 1
        at = 4 * (start - int(self.frame_starts[f]))
        return self.frame(f)[at : at + 4 * count]

    def documents(self) -> Iterator[bytes]:
        return (self.document(k) for k in range(len(self)))


#: Stands for a null document id in a shard.
NULL_ID = -(1 << 63)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """Encode every whole text and write shards below ``path``; [(shard, start)].

    Shards come in ascending order of integer ids (null ids first), and start is
    the number of token ids in all shards before. ``end_id`` is appended to each
    document; null and empty texts are just that. Repeated rows are kept, in the
    order of their texts' hashes. Other columns are left out. An empty table
    gives no shard. Only a row for each shard comes to the driver.
    """
    tail = b"" if end_id is None else struct.pack("<I", end_id)
    given = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    given = given.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        full = (b for b in batches if b.num_rows)
        first = next(full, None)
        if first is None:
            return
        shard, total = f"{path}/shard-{part:06d}.ids.zst", 0
        own = encoder(tokenizer)
        with publish(shard) as out:
            writer = Writer(out)
            for batch in chain([first], full):
                for k in range(0, batch.num_rows, 1024):
                    piece = batch.slice(k, 1024)
                    for i, ids in zip(piece.column("id").to_pylist(), own.encode(piece.column("text"), tail), strict=True):
                        writer.add(NULL_ID if i is None else i, ids)
                        total += len(ids) // 4
            writer.close()
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([shard]), pa.array([total], pa.int64())], ["part", "shard", "total"])

    rows = sorted(given.mapInArrow(tidy(run), "part int, shard string, total bigint").collect(), key=lambda r: r.part)
    starts = np.cumsum([0, *(r.total for r in rows)]).tolist()
    return [(r.shard, start) for r, start in zip(rows, starts, strict=False)]


def read(spark: SparkSession, shards: list[tuple[str, int]]) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of these shards, ids as bytes.

    start: the number of token ids of all documents before. No shards give an
    empty table.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = Shard(uri)
                for k in range(0, len(shard), 512):
                    some = range(k, min(k + 512, len(shard)))
                    ids = shard.ids[k : k + 512]
                    yield pa.record_batch(
                        [pa.array(ids, mask=ids == NULL_ID), pa.array(shard.starts[k : k + 512] + base), pa.array(shard.counts[k : k + 512]), pa.array([shard.document(x) for x in some], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    table = spark.createDataFrame(shards, "shard string, base bigint")
    if len(shards) > 1:
        table = table.repartition(len(shards))
    return table.mapInArrow(tidy(run), "doc_id bigint, start bigint, n_tokens bigint, ids binary")
