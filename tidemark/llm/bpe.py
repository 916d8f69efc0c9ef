"""Byte-level BPE encoding and decoding.

Every task cuts its texts at blanks where the vocabulary's pattern always starts a
word, numbers the distinct units it gets, and applies the pattern to each distinct
unit once. Its words come apart where no merge can join their bytes, and each
distinct piece of a word is encoded once by Spark higher-order functions that fold
the ranked merges over its bytes, looking pairs up in a rank map; the documents
then pick up the ids of their units by number. Decoding maps each id to
its binary piece and concatenates the pieces. All of it is one stage without a
shuffle: the pieces of a task, not those of the corpus, are what memory holds, and
the table of a task starts anew once it has ``max_words`` entries.

One map would be searched from end to end, so the rank map is an array of small
maps, of which the pair of ids selects one. It is the value of scalar subqueries: a plan
holds literals as text, and Spark's driver keeps the plans it has run. The fold's state is one array:
of each part its id, its index, and the rank of its merge with the next part
are packed in one number, so the least number is the merge to make. Its steps cost
as much as the word is long, so words of over LONG bytes pass it by unmerged; a
queue of candidate merges in the Python worker does those, in time n log n.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Table, give_back, let, text_or_empty, tidy

#: Bits of a part's index within its word; words of more bytes than they count are long.
PART_BITS = 10
LONG = 1 << PART_BITS
#: Bits of a part's id.
ID_BITS = 20
#: Number of words a dictionary row carries from Python to the JVM at most.
WORDS_A_ROW = 2048


def load_ranks(path: str) -> dict[bytes, int]:
    """Read a rank file: a base64 piece and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def cuts_at_blanks(pattern: str) -> bool:
    """Whether a word always starts at a blank that something else than white space follows.

    So it is if each alternative has a blank at its front only, or is made of
    white space alone and leaves its last character where something follows.
    """
    front = r"'[a-z]+| \?\\p\{[LN]\}\+| \?\[\^\\s\\p\{L\}\\p\{N\}\]\+"
    return re.fullmatch(rf"(?:(?:{front})\|)+\\s\+\(\?!\\S\)\|\\s\+", pattern) is not None


#: What keeps a text from being cut at its blanks and line ends alone: white space
#: beside white space or at an end, or of another kind (all that Python knows).
_UNEVEN = r"[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z|[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BLANK = re.compile(r" (?=\S)")


def units(text: str, cuts: bool) -> list[str]:
    """The text in pieces that the pattern takes apart independently, as keys.

    After a return a key stands for the rest of it, after a newline for itself;
    any other follows a blank.
    """
    if not text:
        return []
    parts = _BLANK.split(text) if cuts else [text]
    parts[0] = "\r" + parts[0]
    return parts


def unit_text(key: str) -> str:
    return key[1:] if key[0] == "\r" else key if key[0] == "\n" else " " + key


def unit_lists(texts: pa.StringArray, cuts: bool) -> Iterator[tuple[pa.Array, pa.ListArray]]:
    """Which of the texts (a mask), and the keys of each: first even texts, then the others."""
    uneven = pc.match_substring_regex(texts, _UNEVEN) if cuts else pa.array([True] * len(texts), pa.bool_())
    even = pc.invert(uneven)
    marked = pc.binary_join_element_wise("\r", pc.replace_substring(texts.filter(even), "\n", " \n"), "")
    yield even, pc.split_pattern(marked, " ")
    yield uneven, pa.array([units(t.as_py(), cuts) for t in texts.filter(uneven)], pa.list_(pa.string()))


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _shift(name: str, x: Column, bits: int) -> Column:
    return F.call_function(name, x, F.lit(bits))


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The rank of merging two parts (ids) whose bytes together are a piece: that piece's own."""
    got = {}
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
            if a is not None and b is not None:
                got[a, b] = rank
    return got


class Cuts:
    """Where words come apart: at places that no merge can join.

    The first merge that joins the bytes around a place takes a part that ends
    there and one that begins there. So where no pair that merges fits, what
    stands before and what stands behind merge independently, to the same ids.
    Of each pair, NEAR bytes on each side of the place are compared, and those
    by a hash: that finds fewer such places, never a wrong one.
    """

    NEAR = 3
    #: The hashes are of so many bits; a bit is kept for each.
    BITS = 23
    #: Number of places that are looked at together.
    AT_ONCE = 1 << 18

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys: dict[tuple[int, int], set[int]] = defaultdict(set)
        for piece in ranks:
            for k in range(1, len(piece)):
                if piece[:k] in ranks and piece[k:] in ranks:
                    i, j = min(k, self.NEAR), min(len(piece) - k, self.NEAR)
                    keys[i, j].add(int.from_bytes(bytes([4 * i + j]) + piece[k - i : k + j]))
        self.single = np.zeros(1 << 16, bool)
        self.single[[key & 0xFFFF for key in keys.pop((1, 1), ())]] = True
        self.sizes = sorted(keys)
        marked = np.zeros(1 << self.BITS, bool)
        marked[self._hash(np.array([*chain.from_iterable(keys.values())], np.uint64))] = True
        self.marked = np.packbits(marked, bitorder="little")

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where a piece of a word begins, of words that lie end to end in ``flat`` from ``starts``."""
        begins = np.zeros(len(flat), bool)
        begins[starts] = True
        pairs = flat[:-1].astype(np.uint16) << 8 | flat[1:]
        places = np.flatnonzero(~(begins[1:] | self.single[pairs])) + 1
        ends, padded = np.append(starts[1:], len(flat)), np.pad(flat, self.NEAR)
        for k in range(0, len(places), self.AT_ONCE):
            some = places[k : k + self.AT_ONCE]
            word = np.searchsorted(starts, some, "right") - 1
            begins[some[~self._joined(padded, some, some - starts[word], ends[word] - some)]] = True
        return begins

    def _joined(self, padded: np.ndarray, places: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Whether a longer pair may fit each place, with so many bytes of its word on both sides."""
        joined = np.zeros(len(places), bool)
        for i, j in self.sizes:
            key = np.full(len(places), 4 * i + j, np.uint64)
            for k in range(-i, j):
                key = key << np.uint64(8) | padded[places + (self.NEAR + k)]
            at = self._hash(key)
            joined |= (before >= i) & (behind >= j) & (self.marked[at >> 3] >> (at & 7) & 1 > 0)
        return joined


def cut_words(words: list[str], cuts: Cuts) -> tuple[pa.BinaryArray, np.ndarray]:
    """The pieces of these words in order, and where each word's begin among them (and the last one's end)."""
    texts = pa.array(words, pa.string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1)
    flat = np.frombuffer(data, np.uint8, ends[-1]) if ends[-1] else np.empty(0, np.uint8)
    begins = cuts(flat, ends[:-1][np.diff(ends) > 0]) if len(flat) else np.empty(0, bool)
    at = np.append(np.flatnonzero(begins), len(flat)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(flat)])
    return pieces, np.searchsorted(at, ends)


def _next_prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


class RankMap:
    """The ranked merges as arrays for the fold.

    buckets: an array of small maps from a pair's second id to its rank; pairs of one
    second id never share one, as n is a prime beyond any id. first: the ranks of
    pairs of single bytes; single: the ids of bytes. A rank is stored where the
    fold's numbers have it; NONE is beyond any rank.
    """

    #: What spreads the first ids over the buckets; no multiple of a prime n beyond 2.
    SPREAD = 1 << 16

    def __init__(self, ranks: dict[bytes, int]) -> None:
        ids = [ranks.get(bytes([b])) for b in range(256)]
        if None in ids:
            raise ValueError("the rank file lacks a rank for some single byte")
        if max(ranks.values()) >= 1 << ID_BITS:
            raise ValueError("the rank file has more ranks than the fold counts")
        pairs = pair_ranks(ranks)
        self.none = 1 << PART_BITS + 2 * ID_BITS
        self.n = _next_prime(max(2, 2 * len(ranks), max(ranks.values()) + 1))
        first_ids, second_ids = np.fromiter(chain.from_iterable(pairs), np.int64, 2 * len(pairs)).reshape(-1, 2).T
        at = (first_ids * self.SPREAD + second_ids) % self.n
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(np.bincount(at, minlength=self.n))
        stored = np.fromiter(pairs.values(), np.int64, len(pairs)) << PART_BITS + ID_BITS
        self.buckets = pa.MapArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(second_ids[order]), pa.array(stored[order]))
        first = [pairs.get((a, b)) for a in ids for b in ids]
        self.first = pa.array([self.none if r is None else r << PART_BITS + ID_BITS for r in first], pa.int64())
        self.single = pa.array(ids, pa.int64())

    def tables(self, spark: SparkSession) -> dict[str, Column]:
        """The three arrays as scalar subqueries, by name."""
        row = {name: _lists(getattr(self, name), [len(getattr(self, name))]) for name in ("buckets", "first", "single")}
        table = spark.createDataFrame(pa.table(row))
        return {name: table.select(name).scalar() for name in row}

    def rank(self, a: Column, b: Column, buckets: Column) -> Column:
        """The rank of merging ids a and b, in place; NONE if they don't merge or either is null."""
        return F.coalesce(F.get(buckets, (a * _long(self.SPREAD) + b) % _long(self.n))[b], _long(self.none))


def fold_word(word: Column, buckets: Column, first: Column, single: Column, known: RankMap) -> Column:
    """array<bigint>: the parts of one word (its array of bytes); the low ID_BITS of each are its id.

    A number of the state is rank | index | id. The fold takes a step for each
    byte, more than there are merges. A step merges the leftmost pair of the
    lowest rank and looks up only the two pairs that this changes; once no pair
    can merge, the state stays as it is. Words of over LONG bytes stay as bytes.

    Nothing here searches by array_position: inside lambdas it ends its search by
    an exception.
    """
    id_mask, low_mask = (1 << ID_BITS) - 1, (1 << PART_BITS + ID_BITS) - 1

    def of_id(x: Column) -> Column:
        return x.bitwiseAND(_long(id_mask))

    def step(q: Column, _: Column) -> Column:
        def merge(least: Column) -> Column:
            # at: the index of the pair's first part; one: the id of the merged part.
            at = _shift("shiftright", least, ID_BITS).bitwiseAND(_long((1 << PART_BITS) - 1)).cast("int")
            one = _shift("shiftright", least, PART_BITS + ID_BITS)
            before, gone, after = F.get(q, at - 1), F.get(q, at + 1), F.get(q, at + 2)
            merged = known.rank(one, of_id(after), buckets) + least.bitwiseAND(_long(low_mask - id_mask)) + one
            moved = known.rank(of_id(before), one, buckets) + before.bitwiseAND(_long(low_mask))
            made = {"at": at, "gone": gone, "merged": merged, "before": before, "moved": moved}
            return F.when(least < _long(known.none), F.struct(*(c.alias(name) for name, c in made.items())))

        def renew(s: Column) -> Column:
            parts = F.transform(F.array_remove(q, s["gone"]), lambda x, i: F.when(i > s["at"], x - _long(1 << ID_BITS)).when(i == s["at"], s["merged"]).when(x == s["before"], s["moved"]).otherwise(x))
            return F.when(s.isNull(), q).otherwise(parts)

        return let(let(F.array_min(q), merge), renew)

    start = F.transform(word, lambda b, i: F.coalesce(F.get(first, b * 256 + F.get(word, i + 1)), _long(known.none)) + i * _long(1 << ID_BITS) + F.get(single, b))
    return F.when(F.size(word) > LONG, F.transform(word, lambda b: F.get(single, b))).otherwise(F.aggregate(word, start, step))


def merge_long(ids: np.ndarray, pairs: dict[tuple[int, int], int]) -> list[int]:
    """The ids of a word given by those of its bytes: the same merges, taken from a queue."""
    part, left, right = ids.tolist(), [*range(-1, len(ids) - 1)], [*range(1, len(ids) + 1)]
    n = len(part)
    queue = [(r, k, part[k], part[k + 1]) for k in range(n - 1) if (r := pairs.get((part[k], part[k + 1]))) is not None]
    heapq.heapify(queue)
    while queue:
        rank, k, a, b = heapq.heappop(queue)
        after = right[k]
        if part[k] != a or after >= n or part[after] != b:
            continue  # one of the two has been merged since
        part[k], part[after], right[k] = rank, -1, right[after]
        if right[k] < n:
            left[right[k]] = k
            if (r := pairs.get((rank, part[right[k]]))) is not None:
                heapq.heappush(queue, (r, k, rank, part[right[k]]))
        if left[k] >= 0 and (r := pairs.get((part[left[k]], rank))) is not None:
            heapq.heappush(queue, (r, left[k], part[left[k]], rank))
    return [x for x in part if x >= 0]


#: The type of rows of words, a word being the list of its bytes.
_BYTES = pa.list_(pa.list_(pa.int32()))


def _lists(values: np.ndarray, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def _rows_of(items: list, width: int) -> list[int]:
    """How many of these items each row takes: ``width``, the last one the rest."""
    return [min(width, len(items) - k) for k in range(0, len(items), width)]


def _byte_arrays(words: list[bytes]) -> pa.ListArray:
    """Rows of WORDS_A_ROW words at most, each the list of its bytes."""
    flat = _lists(pa.array(np.frombuffer(b"".join(words), np.uint8).astype(np.int32)), [len(w) for w in words])
    return _lists(flat, _rows_of(words, WORDS_A_ROW))


def _sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows, at most so many at a time: what is made of them is wider than they are."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _numbered(items: pa.Array, known: dict) -> np.ndarray:
    """The number of each item by ``known``, which numbers new ones."""
    distinct = items.dictionary_encode()
    keys = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
    return np.fromiter(map(known.__getitem__, keys), np.int32, len(keys))[distinct.indices.to_numpy()]


def _newest(known: dict, old: int) -> list:
    """The keys that came after the first ``old``."""
    return [*islice(reversed(known), len(known) - old)][::-1]


def _each(values: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Runs of these 32-bit numbers, of so many each, as bytes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * 4
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values, np.int32))])


def _number_units(pattern: str, max_words: int, apart: Cuts):
    cuts = cuts_at_blanks(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number the units of this task and the pieces of their words; send new ones on before their first use.

        Rows out: a row of new pieces; a row of new units, with the numbers of
        their pieces and how many each has (``fresh`` where the numbering starts
        anew); or a document, with the numbers of its units.
        """
        import regex

        words_of = regex.compile(pattern).findall
        known: dict[str, int] = {}
        words: dict[bytes, int] = {}
        fresh = True
        for batch in _sliced(batches, 1024):
            doc = batch.schema.field("doc").type
            none = lambda n: {"doc": pa.nulls(n, doc), "numbers": pa.nulls(n, pa.binary()), "sizes": pa.nulls(n, pa.binary()), "new": pa.nulls(n, _BYTES), "fresh": pa.array([False] * n)}  # noqa: B023, E731
            for mask, lists in unit_lists(batch.column("text"), cuts):
                if fresh or len(known) + len(words) > max_words:
                    known, words, fresh = defaultdict(count().__next__), defaultdict(count().__next__), True
                old, old_words = len(known), len(words)
                numbers = _numbered(lists.flatten(), known)
                made, sizes = [], []
                for key in _newest(known, old):
                    own = words_of(unit_text(key))
                    made += own
                    sizes.append(len(own))
                pieces, first = cut_words(made, apart)
                made, sizes = _numbered(pieces, words), np.diff(first[np.cumsum([0, *sizes])])
                new = _newest(words, old_words)
                if new or fresh:
                    rows = _byte_arrays(new) if new else pa.array([[]], _BYTES)
                    starts = [fresh] + [False] * (len(rows) - 1)
                    yield pa.RecordBatch.from_pydict(none(len(rows)) | {"new": rows, "fresh": pa.array(starts)})
                    fresh = False
                if len(sizes):
                    yield pa.RecordBatch.from_pydict(none(1) | {"numbers": _each(made, [len(made)]), "sizes": _each(sizes, [len(sizes)])})
                if len(lists):
                    yield pa.RecordBatch.from_pydict(none(len(lists)) | {"doc": batch.column("doc").filter(mask), "numbers": _each(numbers, _sizes(lists))})

    return run


def _flat(rows: pa.ListArray) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False)


def _sizes(rows: pa.ListArray) -> np.ndarray:
    return rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _numbers(rows: pa.BinaryArray) -> np.ndarray:
    """The 32-bit numbers of all rows."""
    return np.frombuffer(b"".join(x.as_buffer() for x in rows), np.int32)


def _pick_ids(ranks: dict[bytes, int]):
    pairs: dict[tuple[int, int], int] = {}

    def folded(rows: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each has; unmerged ones are merged."""
        words = rows.flatten()
        ids, sizes = (_flat(words) & (1 << ID_BITS) - 1).astype(np.int32), _sizes(words)
        if sizes.max(initial=0) <= LONG:
            return ids, sizes
        if not pairs:
            pairs.update(pair_ranks(ranks))
        each = [merge_long(x, pairs) if len(x) > LONG else x for x in np.split(ids, np.cumsum(sizes)[:-1])]
        return np.concatenate(each).astype(np.int32), np.array([len(x) for x in each])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Give each document the ids of its units, as a list and as little-endian bytes."""
        words, table = Table(), Table()
        for batch in _sliced(batches, 512):
            kind = np.where(batch.column("new_ids").is_valid(), 1, np.where(batch.column("sizes").is_valid(), 2, 0))
            fresh = batch.column("fresh").to_numpy(zero_copy_only=False)
            # Rows keep their order, so runs of one kind are taken one after another;
            # a fresh start opens a run of its own.
            edges = np.flatnonzero((kind[1:] != kind[:-1]) | fresh[1:]) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if b == a:
                    continue
                if kind[a] == 1:
                    if fresh[a]:
                        words, table = Table(), Table()
                    words.add(*folded(batch.column("new_ids").slice(a, b - a)))
                    continue
                numbers = batch.column("numbers").slice(a, b - a)
                if kind[a] == 2:
                    ids, each = words.pick(_numbers(numbers))
                    ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(_numbers(batch.column("sizes").slice(a, b - a)))]
                    table.add(ids, np.diff(ends, prepend=0))
                    continue
                ids, each = table.pick(_numbers(numbers))
                ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(pc.binary_length(numbers).to_numpy() // 4)])]
                ids = ids.astype("<i4")
                binary = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.record_batch([batch.column("doc").slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), binary], ["doc", "ids", "ids_le"])

    return run


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str, max_words: int, finish, columns: str) -> DataFrame:
    """What ``finish`` makes of the batches (doc, ids, ids_le), in the Python worker that made them."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc"), text_or_empty(text_col).alias("text"))
    numbered = texts.mapInArrow(tidy(_number_units(pattern, max_words, Cuts(ranks))), f"doc {kind}, numbers binary, sizes binary, new array<array<int>>, fresh boolean")
    known, pick = RankMap(ranks), _pick_ids(ranks)
    tables = known.tables(docs.sparkSession)
    give_back()  # the rank map was made of lists
    # Lambdas take no subqueries, but columns of them. A lambda's variable stands
    # for each, so that it is used once and Spark puts the subquery in its place.
    buckets, first, single = map(F.col, tables)
    new_ids = let(buckets, lambda t: let(first, lambda f: let(single, lambda s: F.transform("new", lambda w: fold_word(w, t, f, s, known)))))
    folded = numbered.withColumns(tables).select("doc", "numbers", "sizes", new_ids.alias("new_ids"), "fresh")
    return folded.mapInArrow(tidy(lambda batches: finish(pick(batches))), f"doc {kind}, {columns}").withColumnRenamed("doc", id_col)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", max_words: int = 1_000_000) -> DataFrame:
    """(id_col, ids array<int>, ids_le binary): the ids of every whole text.

    ids_le holds the same ids as little-endian 32-bit integers. Null and empty
    texts give no ids. Rows are kept as they are: repeated rows and null
    ``id_col`` stay, and an empty table gives an empty one. Other columns of
    ``docs`` are left out, so none can clash. A text is encoded in full whatever
    its length; one unbroken word of n bytes takes time in n log n.
    """
    return _encoded(docs, ranks, pattern, id_col, text_col, max_words, lambda batches: batches, "ids array<int>, ids_le binary")


class Decoder:
    """Turns ids into bytes: the pieces lie end to end, and each id picks its own."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values(), default=-1) + 1
        pieces = [b""] * size
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.lengths = np.fromiter(map(len, pieces), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        own = self.lengths[ids]
        ends = np.cumsum(own)
        shift = np.repeat(self.starts[ids] - (ends - own), own)
        return self.flat[shift + np.arange(len(shift))].tobytes()


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` and ``out_col`` binary: the pieces of each row's ids, concatenated.

    A null list gives null, an empty one no bytes. An id without a piece, or a
    null one, raises an error rather than leaving bytes out.
    """
    decoder = Decoder(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            if lists.flatten().null_count:
                raise ValueError("an id is not in the vocabulary")
            out = [x.values.to_numpy() if x.is_valid else None for x in lists]
            yield batch.append_column(out_col, pa.array([None if x is None else decoder(x) for x in out], pa.binary()))

    return encoded.mapInArrow(tidy(run), T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())]))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", max_words: int = 1_000_000) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): encode(), then decode(), as digests.

    The worker that has the ids decodes them and keeps only digests of both.
    """
    decoder = Decoder(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column("ids_le")]
            hashed = [[hashlib.sha256(x).hexdigest() for x in (row.tobytes(), decoder(row))] for row in rows]
            yield pa.record_batch(
                [batch.column("doc"), pa.array([len(x) for x in rows], pa.int64()), pa.array([x for x, _ in hashed], pa.string()), pa.array([x for _, x in hashed], pa.string())],
                ["doc", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _encoded(docs, ranks, pattern, id_col, text_col, max_words, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def checked(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", max_words: int = 1_000_000) -> DataFrame:
    """(id_col, n_tokens, ids, n_bytes): the ids, and how many bytes they decode to.

    The worker that has the ids decodes them; n_bytes is the length of that.
    """
    decoder = Decoder(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column("ids_le")]
            yield pa.record_batch(
                [batch.column("doc"), pa.array([len(x) for x in rows], pa.int64()), batch.column("ids"), pa.array([len(decoder(x)) for x in rows], pa.int64())],
                ["doc", "n_tokens", "ids", "n_bytes"],
            )

    return _encoded(docs, ranks, pattern, id_col, text_col, max_words, run, "n_tokens bigint, ids array<int>, n_bytes bigint")
