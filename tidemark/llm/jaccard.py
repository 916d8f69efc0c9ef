"""Near-duplicates by SimHash trees, completed to exact Jaccard similarity.

Fingerprints of 64 bits keep texts of similarity 0.8 some ten bits apart, too far
for a tree to prune, so the trees of simhash.py can't find all links by
themselves. Here they find the near ones, each verified; what they leave is found
by prefixes: under one order of all shingles, two sets of similarity ``t`` or more
share one of the first n - ceil(t n) + 1 shingles of each. Those prefixes meet in
buckets, one a shingle. The order puts shingles that a sample knows as common
last; it settles the cost alone, for any order gives all pairs.

Of each bucket one member is the hub: that whose shingles the sample holds most
often, which in a large group of near copies is the text they come from or one
close to it. All are compared with their hubs first, so such a group costs a few
comparisons a row; then members of one bucket that are not yet connected, each
with each, but only in a bucket whose place in both prefixes lets it be the first that
similar sets share. From buckets of over SMALL texts the join lets only pairs through whose
sketches allow the similarity (the parities of a set's shingles by hash; each
shingle that only one set has flips one parity at most). Candidates that pass
the sketches are verified on their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, cut, release, tidy
from tidemark.llm.components import stars
from tidemark.llm.simhash import links, majority, normal, shingle_values

#: Sampled texts from which common shingles are known, and in how many of them they occur.
SAMPLE, COMMON = 20_000, 3
#: 64-bit words of a sketch, and the size of a set from which it also has a wide one.
SKETCH, WIDE = 16, 1024
#: Bits by which fingerprints that the trees link may differ.
RADIUS = 3
#: Texts of a bucket all of whose pairs are candidates.
SMALL = 8
#: So many nodes at most are broadcast to pick out their texts.
BROADCAST = 1_000_000


def node_of(words: list[bytes]) -> int:
    """A signed 64-bit hash of the words in order: equal for texts of equal words."""
    import xxhash

    h = xxhash.xxh3_64_intdigest(b" ".join(words), 42)
    return h - (1 << 64) if h >> 63 else h


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct XXH64 values (seed 42) of the shingles; a shorter text is one shingle."""
    return np.unique(shingle_values(words, size))


def prefix(own: np.ndarray, common: np.ndarray, rank: np.ndarray, threshold: float) -> np.ndarray:
    """The first shingles of a set, of which similar sets share one; ``common`` is sorted."""
    n = len(own)
    kept = n - int(np.ceil(n * threshold - 1e-9)) + 1
    if not n or not len(common):
        return own[:kept]
    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
    order = np.lexsort((own, np.where(common[at] == own, rank[at], 0)))
    return own[order[:kept]]


def sketch(own: np.ndarray) -> np.ndarray:
    """SKETCH words of 64 bits: for each hash value, whether an odd number of shingles has it."""
    odd = np.bincount((own >> np.uint64(64 - 10)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def wide_sketch(own: np.ndarray) -> bytes | None:
    """Two parity bits and more a shingle, a power of two of them; None for a set below WIDE."""
    if len(own) < WIDE:
        return None
    bits = (2 * len(own) - 1).bit_length()
    odd = np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def wide_fit(a: bytes | None, b: bytes | None, total: int, threshold: float) -> bool:
    """Whether wide sketches allow the similarity of two sets of ``total`` shingles together."""
    if a is None or b is None:
        return True
    x, y = (np.frombuffer(z, np.uint8) for z in (a, b))
    least = min(len(x), len(y))
    # A hash's leading bits pick its parity bit: neighbours fold into one of a sketch half as wide.
    x, y = (np.bitwise_xor.reduce(np.unpackbits(z, bitorder="little").reshape(8 * least, -1), axis=1) for z in (x, y))
    return int(np.count_nonzero(x != y)) <= total * (1 - threshold) / (1 + threshold) + 1e-6


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def _sample(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles, sorted, and in how many sampled texts each occurs."""
    part = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * min(1, SAMPLE / max(1, texts.count()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                yield pa.record_batch([pa.array(shingle_set(normal(t.as_py() or b""), size).view(np.int64))], ["h"])

    counts = part.select("text").distinct().mapInArrow(tidy(run), "h bigint").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).toArrow()
    common = counts.column("h").to_numpy().view(np.uint64)
    order = np.argsort(common)
    return common[order], counts.column("n").to_numpy()[order]


def _rows(texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """A row for each text: id, node; where its task first meets the node, also what is known of its set.

    w: how often the sample holds its shingles, on average.
    """
    common, rank = _sample(texts, size)
    names = ["id", "node", "n", "w", "fp", *_sketch("s"), "wide", "prefix"]

    def weight(own: np.ndarray) -> float:
        if not len(common):
            return 0.0
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        return float(np.where(common[at] == own, rank[at], 0).mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                nodes, rows, none = [], [], (None, None, None, np.zeros(SKETCH, np.int64), None, None)
                for t in batch.column("text"):
                    words = normal(t.as_py() or b"")
                    nodes.append(node_of(words))
                    if nodes[-1] in seen or not words:
                        rows.append(none)
                        continue
                    seen.add(nodes[-1])
                    values = shingle_values(words, size)
                    own = np.unique(values)
                    fp = np.uint64(majority(values)).view(np.int64)
                    rows.append((len(own), weight(own), int(fp), sketch(own), wide_sketch(own), prefix(own, common, rank, threshold).view(np.int64)))
                sketches = np.stack([r[3] for r in rows], axis=1) if rows else np.zeros((SKETCH, 0), np.int64)
                columns = [pa.array(nodes, pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int64()), *map(pa.array, sketches)]
                yield pa.record_batch([batch.column("id"), *columns, pa.array([r[4] for r in rows], pa.binary()), pa.array([r[5] for r in rows], pa.list_(pa.int64()))], names)

    kind = texts.schema["id"].dataType.simpleString()
    longs = "".join(f"{c} bigint, " for c in _sketch("s"))
    return texts.mapInArrow(tidy(run), f"id {kind}, node bigint, n int, w double, fp bigint, {longs}wide binary, prefix array<bigint>")


def _sketch(name: str) -> list[str]:
    return [f"{name}{k}" for k in range(SKETCH)]


def _fits(a: str, b: str, threshold: float) -> str:
    """SQL: whether the sizes a and b allow the similarity."""
    return f"least({a}, {b}) >= greatest({a}, {b}) * {threshold}D - 1e-9D"


def _may_link(a: str, b: str, threshold: float) -> str:
    """SQL: whether sizes and sketches of the sides a and b allow the similarity."""
    apart = " + ".join(f"bit_count({a}.s{k} ^ {b}.s{k})" for k in range(SKETCH))
    return f"{_fits(f'{a}.n', f'{b}.n', threshold)} AND {apart} <= ({a}.n + {b}.n) * {(1 - threshold) / (1 + threshold)!r}D + 1e-6D"


def _may_start(a: str, b: str, threshold: float) -> str:
    """SQL: whether similar sets may have their first common shingle at pos of a and pos of b.

    Those before it in the one order are not common, so at most n - pos of each are.
    """
    return f"least({a}.n - {a}.pos, {b}.n - {b}.pos) >= ({a}.n + {b}.n) * {threshold / (1 + threshold)!r}D - 1e-6D"


def _own_sets(texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, own): the sorted shingle values of these nodes (node, low).

    low is the least id of a node's texts, so one row stands for each node where
    ids are unique. Where ids repeat or are null, rows may repeat, and other
    texts of those ids come along. The texts are picked by id before they reach
    Python, so a task has one worker, which sees few texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for t in batch.column("text"):
                words = normal(t.as_py() or b"")
                node = node_of(words)
                if node not in seen:
                    seen.add(node)
                    own = shingle_set(words, size).view(np.int64)
                    yield pa.record_batch([pa.array([node], pa.int64()), pa.ListArray.from_arrays([0, len(own)], pa.array(own))], ["node", "own"])

    wanted = nodes.select("low").distinct()
    wanted = F.broadcast(wanted) if nodes.count() <= BROADCAST else wanted
    picked = texts.join(wanted, F.expr("id <=> low"), "left_semi")
    return picked.select("text").mapInArrow(tidy(run), "node bigint, own array<bigint>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(id_col, component_id): one row for each row of ``docs``.

    component_id is the smallest id reachable over pairs of texts whose sets of
    shingles have a Jaccard similarity of ``threshold`` or more: every such pair
    and no other. Texts of equal words, and all without words, are copies.
    Repeated rows stay; a row with a null id takes part and gets the smallest
    known id of its component (null if there is none). Other columns are left
    out. An empty table gives an empty one.
    """
    space = Workspace(docs.sparkSession, "similar")
    texts = _texts(docs, id_col, text_col)
    rows = space.keep(_rows(texts, size, threshold).withColumn("key", F.monotonically_increasing_id()))
    points = space.keep(rows.groupBy("node").agg(F.min("id").alias("low"), F.min(F.expr("if(n IS NULL, NULL, key)")).alias("key")))
    known = space.keep(rows.join(points.select("key"), "key", "left_semi"))
    sized = known.select("node", "n", *_sketch("s"))

    # Only buckets of two texts and more go on, each with its hub.
    posted = known.select("node", "n", F.posexplode("prefix").alias("pos", "h"))
    posted = posted.select("h", "node", F.expr("shiftleft(cast(n AS bigint), 32) + pos").alias("place"))
    full = posted.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    unpacked = [F.expr("cast(shiftright(place, 32) AS int)").alias("n"), F.expr("cast(place & 4294967295 AS int)").alias("pos")]
    buckets = space.keep(posted.join(full, "h").select("h", "node", "c", *unpacked))
    weighed = buckets.join(known.select("node", "w"), "node")
    hubs = weighed.groupBy("h").agg(F.max(F.struct("w", "node", "n")).alias("hub")).select("h", "hub.node", "hub.n").toDF("h", "hub", "hn")

    def wide_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("wa").to_pylist(), batch.column("wb").to_pylist(), batch.column("total").to_pylist(), strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([wide_fit(x, y, n, threshold) for x, y, n in pairs], pa.bool_()))

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar."""
        left = pairs.where("a <> b").distinct().join(sized.withColumnRenamed("node", "a"), "a").alias("x")
        close = left.join(sized.alias("y"), F.expr(f"x.b = y.node AND {_may_link('x', 'y', threshold)}"))
        close = space.keep(close.select("a", "b", F.expr("x.n + y.n").alias("total"), F.expr(f"least(x.n, y.n) >= {WIDE}").alias("long")))
        wide = known.where(f"n >= {WIDE}").select("node", "wide")
        both = close.where("long").join(wide.toDF("a", "wa"), "a").join(wide.toDF("b", "wb"), "b").select("a", "b", "total", "wa", "wb")
        pairs = space.keep(close.where("NOT long").select("a", "b").unionByName(both.mapInArrow(tidy(wide_enough), "a bigint, b bigint")))
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = space.keep(_own_sets(texts, space.keep(points.join(nodes, "node").select("node", "low")), size))
        both = pairs.join(sets.toDF("a", "oa"), "a").join(sets.toDF("b", "ob"), "b")
        shared = both.select("a", "b", F.expr("size(oa) + size(ob)").alias("total"), F.size(F.array_intersect("oa", "ob")).alias("both"))
        return space.keep(shared.where(F.expr(f"both >= {threshold}D * (total - both) - 1e-9D")).select("a", "b"))

    # Near fingerprints: one text of each, and those that the trees link.
    of_print = space.keep(known.groupBy("fp").agg(F.min("node").alias("one")))
    same = known.join(of_print, "fp").select(F.col("node").alias("a"), F.col("one").alias("b"))
    ends = links(of_print.select("fp"), RADIUS).join(of_print.toDF("a", "na"), "a").join(of_print.toDF("b", "nb"), "b")
    to_hub = buckets.join(hubs, "h").where("node <> hub AND " + _fits("n", "hn", threshold)).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    edges = linked(to_hub.unionByName(same).unionByName(ends.select(F.col("na").alias("a"), F.col("nb").alias("b"))))

    # What a bucket holds of pairs not yet connected.
    release(docs.sparkSession)
    roots = stars(edges)
    few, many = buckets.where(f"c <= {SMALL}").select("h", "node", "n", "pos"), buckets.where(f"c > {SMALL}").select("h", "node", "pos")
    pairs = few.alias("x").join(few.alias("y"), F.expr(f"x.h = y.h AND x.node < y.node AND {_fits('x.n', 'y.n', threshold)} AND {_may_start('x', 'y', threshold)}"))
    pairs = pairs.select(F.expr("x.node").alias("a"), F.expr("y.node").alias("b")).distinct()
    of_a, of_b = roots.toDF("a", "ra"), roots.toDF("b", "rb")
    apart = pairs.join(of_a, "a", "left").join(of_b, "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b")
    placed = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("h")
    still = space.keep(placed.join(mixed, "h").join(sized, "node"))
    across = still.alias("x").join(still.alias("y"), F.expr(f"x.h = y.h AND x.node < y.node AND x.root <> y.root AND {_may_start('x', 'y', threshold)} AND {_may_link('x', 'y', threshold)}"))
    more = linked(apart.unionByName(across.select(F.expr("x.node").alias("a"), F.expr("y.node").alias("b"))))
    roots = stars(edges.unionByName(more))

    members = points.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    least = members.groupBy("root").agg(F.min("low").alias("component_id"))
    found = rows.select("id", "node").join(members.join(least, "root").select("node", "component_id"), "node")
    found = cut(found.select(F.col("id").alias(id_col), "component_id"))
    space.drop()
    release(docs.sparkSession)
    return found
