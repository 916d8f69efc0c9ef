"""SimHash near-duplicates, paired exactly with vantage-point trees.

Fingerprints of equal value are one point. A tree of vantage points, fitted on a
bounded sample, deals the points out to shards by Hamming distance: within the
radius mu of its vantage point a point goes left, else right. Two points at most
``radius`` apart whose shards differ part at some vantage point where, by the
triangle inequality, the right one lies within mu + radius; so points on the
right of a boundary also visit the shards on its left that their ball reaches,
and no pair is missed. Each shard searches its points with a tree of its own,
pruned by the same bounds, and returns a spanning forest of the pairs it found,
not all pairs. Components of the forests are joined up by alternating stars.

Deeper trees send more copies to boundary shards, so depth is bounded, and a shard
that holds more than SHARD_POINTS is split further: its fingerprints are cut into
radius + 1 blocks of bits, and each goes to a part of the shard for the value of
each block. Two fingerprints at most ``radius`` bits apart agree in some block, so
they still meet; only fingerprints that agree in a whole block must share a part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, tidy
from tidemark.llm.components import stars

#: Points of a shard or part of one; levels of the tree; sampled points a shard.
SHARD_POINTS, MAX_DEPTH, SAMPLE_A_SHARD = 4096, 10, 64
#: Copies of a point that boundaries may ask for; levels beyond that give way to parts.
BOUNDARY_COPIES = 4
#: Points that a search compares one by one, and pairs kept before they are reduced.
LEAF, KEPT_PAIRS = 128, 1 << 20
_CHUNK = 1 << 16


def shingle_values(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 values (seed 42) of the word shingles, repeats included.

    Fewer words than ``size`` are one shingle, none give no value.
    """
    import xxhash

    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if n <= size:
        return np.array([h(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[: n - size] + 1]).tolist()
    ends = ends[size - 1 :].tolist()
    return np.fromiter((h(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)), np.uint64, n - size + 1)


def majority(values: np.ndarray) -> int:
    """The bits that over half of the values have; 0 for none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(values), _CHUNK):
        bits = np.unpackbits(values[k : k + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def normal(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased, between ASCII white space."""
    return text.lower().split()  # of bytes: lower() and split() know ASCII alone


def fingerprint(text: bytes, size: int = 3) -> int:
    """The 64-bit SimHash of a text in UTF-8, from word shingles with repeats.

    A-Z are lower-cased; words are runs without blank, tab, newline, vertical
    tab, form feed and return; a text of fewer than ``size`` words is one
    shingle; one without words has fingerprint 0. A bit is set if it is set in
    over half of the shingles' XXH64 values (seed 42).
    """
    return majority(shingle_values(normal(text), size))


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            got = np.fromiter((fingerprint(t.as_py() or b"", size) for t in texts), np.uint64, len(texts))
            yield pa.record_batch([batch.column("id"), pa.array(got.view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp bigint): a fingerprint for each row; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return given.mapInArrow(tidy(_fingerprints(size)), f"id {kind}, fp bigint")


class Tree:
    """A complete binary tree of vantage points in heap order, fitted on a sample."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.points = np.zeros(1 << depth, np.uint64)
        self.mu = np.full(1 << depth, 64, np.uint8)
        part = {1: sample}
        for node in range(1, 1 << depth):
            own = part.pop(node, sample[:0])
            if len(own):
                self.points[node], self.mu[node] = choose(own)
                left = np.bitwise_count(own ^ self.points[node]) <= self.mu[node]
                if 2 * node < 1 << depth:
                    part[2 * node], part[2 * node + 1] = own[left], own[~left]

    def route(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each copy: which fingerprint, its shard, and whether that is its home."""
        which, node, home = np.arange(len(fps)), np.ones(len(fps), np.int64), np.ones(len(fps), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(fps[which] ^ self.points[node]).astype(np.int16)
            mu = self.mu[node].astype(np.int16)
            near = d <= mu
            left = d - radius <= mu
            right = np.where(home, ~near, d + radius > mu)  # a point at home on the left sends no copy right
            which = np.concatenate([which[left], which[right]])
            home = np.concatenate([(home & near)[left], home[right]])
            node = np.concatenate([2 * node[left], 2 * node[right] + 1])
        return which, node - (1 << self.depth), home


def choose(points: np.ndarray) -> tuple[np.uint64, int]:
    """A vantage point and the radius that halves these points best.

    Among candidates spread over the (sorted) points, the one with the largest
    spread of distances; the radius is their median.
    """
    tried = points[:: max(1, len(points) // 8)][:8]
    seen = points[:: max(1, len(points) // 512)]
    d = np.bitwise_count(seen[None, :] ^ tried[:, None]).astype(np.float32)
    best = tried[int(d.std(axis=1).argmax())]
    return best, int(np.median(np.bitwise_count(points ^ best)))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index reachable, for each of n points, over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def search(queries: np.ndarray, points: np.ndarray, radius: int) -> np.ndarray:
    """For each query the least point reachable over pairs of query and point.

    ``queries`` begins with ``points``; both are indexed alike. Depth first, with
    few pairs at a time: what has been found is reduced to a forest again and
    again, so memory follows the number of points, not that of pairs.
    """
    n = len(queries)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    kept = 0

    def reduce() -> None:
        nonlocal found, kept
        if found:
            label = forest(n, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
            own = np.flatnonzero(label != np.arange(n))
            found, kept = [(own, label[own])], 0

    todo = [(np.arange(n), np.arange(len(points)))]
    while todo:
        q, p = todo.pop()
        if not len(q) or not len(p):
            continue
        split = False
        if len(p) > LEAF:
            v, mu = choose(points[p])
            dp = np.bitwise_count(points[p] ^ v)
            near = dp <= mu
            if near.all() and mu:  # many at the median: the ball inside it
                mu -= 1
                near = dp <= mu
            split = bool(near.any() and not near.all())
        if split:
            dq = np.bitwise_count(queries[q] ^ v).astype(np.int16)
            todo.append((q[dq - radius <= mu], p[near]))
            todo.append((q[dq + radius > mu], p[~near]))
            continue
        step = max(1, (1 << 19) // len(p))
        for k in range(0, len(q), step):
            x, y = np.nonzero(np.bitwise_count(queries[q[k : k + step], None] ^ points[None, p]) <= radius)
            x, y = q[k + x], p[y]
            new = x != y
            found.append((x[new], y[new]))
            kept += int(new.sum())
            if kept > KEPT_PAIRS:
                reduce()
    reduce()
    label = np.arange(n)
    for x, y in found:
        label[x] = y
    return label


def _forest_of_shard(radius: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["home", "fp"], ascending=[False, True])
        fps = shard["fp"].to_numpy().view(np.uint64)
        label = search(fps, fps[: int(shard["home"].sum())], radius)
        own = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": fps[own].view(np.int64), "b": fps[label[own]].view(np.int64)})

    return run


def blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of radius + 1 blocks that cut the 64 bits evenly."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, (1 << b - a) - 1) for a, b in zip(edges, edges[1:])]


def parts(fps: np.ndarray, of_shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each copy: which fingerprint, and the part of its shard that it goes to.

    of_shard: into how many parts the shard of each is split. Whole shards have
    part -1 alone; else a fingerprint goes to a part for each of its blocks.
    """
    split = np.flatnonzero(of_shard > 1)
    whole = np.flatnonzero(of_shard <= 1)
    which, part = [whole], [np.full(len(whole), -1, np.int64)]
    for k, (shift, mask) in enumerate(blocks(radius)):
        value = fps[split] >> np.uint64(shift) & np.uint64(mask)
        mixed = (value + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        which.append(split)
        part.append((mixed % of_shard[split].astype(np.uint64)).astype(np.int64) * (radius + 1) + k)
    return np.concatenate(which), np.concatenate(part)


def links(points: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): pairs at most ``radius`` bits apart that connect what is connected.

    ``points`` has one column fp (bigint) of distinct values. The driver holds
    SAMPLE_A_SHARD fingerprints and one count for each of at most 2**MAX_DEPTH
    shards, whatever the input.
    """
    n = points.count()
    depth = 0
    while depth < MAX_DEPTH and n > SHARD_POINTS << depth:
        depth += 1
    wanted = SAMPLE_A_SHARD << depth
    sample = points
    if n > wanted:  # the bound of the sample holds on average, by a hash of the value
        sample = points.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int((1 << 30) * wanted / n))
    fitted = np.sort(np.array([r.fp for r in sample.collect()] if depth else [], np.int64)).view(np.uint64)
    tree = Tree(fitted, depth)
    while depth and len(tree.route(fitted, radius)[0]) > BOUNDARY_COPIES * len(fitted):
        depth -= 1
        tree = Tree(fitted, depth)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(fps), _CHUNK):
                which, shard, home = tree.route(fps[k : k + _CHUNK], radius)
                yield fps[k : k + _CHUNK][which], shard, home

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << depth, np.int64)
        for _, shard, _ in routed(batches):
            held += np.bincount(shard, minlength=1 << depth)
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(held[some])], ["shard", "n"])

    points = points.select("fp")
    of_shard = np.ones(1 << depth, np.int64)
    for r in points.mapInArrow(tidy(count), "shard int, n bigint").groupBy("shard").agg(F.sum("n").alias("n")).collect():
        of_shard[r.shard] = -(-r.n // SHARD_POINTS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, shard, home in routed(batches):
            which, part = parts(fps, of_shard[shard], radius)
            yield pa.record_batch([pa.array(shard[which].astype(np.int32)), pa.array(part), pa.array(fps[which].view(np.int64)), pa.array(home[which])], ["shard", "part", "fp", "home"])

    dealt = points.mapInArrow(tidy(deal), "shard int, part bigint, fp bigint, home boolean")
    return dealt.groupBy("shard", "part").applyInPandas(_forest_of_shard(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id): one row for each row of ``docs``.

    fingerprint is 16 lowercase hex digits, component_id the smallest id
    reachable over pairs of fingerprints at most ``radius`` bits apart. Texts
    without words (null, empty) share fingerprint 0 and are linked like any
    other. Repeated rows stay; a row with a null id takes part and gets the
    smallest known id of its component (null if there is none). Other columns
    are left out. An empty table gives an empty one.
    """
    prints = cut(fingerprints(docs, id_col, text_col, size))
    points = cut(prints.groupBy("fp").agg(F.min("id").alias("low")))
    roots = stars(links(points.select("fp"), radius))
    members = points.join(roots, points.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = members.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = members.join(least, "root").select("fp", "component_id")
    found = prints.join(of_print, "fp")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
