import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import stars


def slow_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, radius=2):
    """{id: least id reachable}, by comparing all pairs."""
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            if (prints[x][1] ^ prints[y][1]).bit_count() <= radius:
                group[max(top(x), top(y))] = min(top(x), top(y))
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return {i: (f"{f:016x}", least.get(top(k))) for k, (i, f) in enumerate(prints)}


TEXTS = [None, "", " \n\t", "One two", "one TWO", "one two three", "ONE two  three\n", "Ä é ü ö", "ä é ü ö", "a b c d " * 4000, "x " * 5, "x " * 7, "\x1c \x85 z"]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 16)  # a tree of several levels
    monkeypatch.setattr(simhash, "LEAF", 4)
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(60)]
    base = [list(rng.choice(words, 60)) for _ in range(20)]
    rows = [*TEXTS]
    for b in base:
        for _ in range(8):
            c = list(b)
            if rng.random() < 0.7:
                c[rng.integers(60)] = "other"
            rows.append(" ".join(c))
    rows = [(100 + i, t) for i, t in enumerate(rows)]
    want = slow_components(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_clashing_columns_null_ids_and_empty(spark):
    rows = [(None, "a b c", 1, 2, 3), (5, "a b c", 1, 2, 3), (5, "a b c", 1, 2, 3), (None, "q r s t u", 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long, id long, component_id long")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5), (5, 5), (None, 5), (None, None)]
    empty = simhash.near_duplicates(docs.limit(0))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.count() == 0


@pytest.mark.parametrize(("depth", "radius"), [(0, 2), (3, 2), (6, 2), (4, 5), (6, 9)])
def test_tree_and_search_miss_no_pair(depth, radius):
    rng = np.random.default_rng(depth)
    seeds = rng.integers(0, 2**64, 40, dtype=np.uint64)
    points = [seeds]
    for _ in range(30):
        flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 2).astype(np.uint64)) for _ in seeds])
        points.append(points[rng.integers(len(points))] ^ flips)
    points = np.unique(np.concatenate([*points, np.arange(300, dtype=np.uint64)]))
    rng.shuffle(points)
    which, shard, home = simhash.Tree(np.sort(points[:200]), depth).route(points, radius)
    assert home.sum() == len(points) and len(set(which[home].tolist())) == len(points)
    a, b = [], []
    for s in np.unique(shard):
        at = shard == s
        order = np.concatenate([which[at & home], which[at & ~home]])
        label = simhash.search(points[order], points[which[at & home]], radius)
        a.append(order), b.append(order[label])
    got = simhash.forest(len(points), np.concatenate(a), np.concatenate(b))
    x, y = np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= radius)
    assert (got == simhash.forest(len(points), x, y)).all()


def test_long_path_and_hub(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1400)] + [(7, 7), (None, 3), (2001, 2000)]
    got = {r.node: r.root for r in stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {k: 1000 for k in range(1001, 1400)} | {2001: 2000}


def test_parts_of_large_shards_keep_all_links(spark, monkeypatch):
    """Shards of a few points, split by blocks of bits, against all pairs."""
    rng = np.random.default_rng(12)
    centres = rng.integers(0, 1 << 63, 40)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(0, 4), replace=False)) for c in np.repeat(centres, 12)]
    fps = sorted({*near, *map(int, rng.integers(0, 1 << 63, 300))})
    points = spark.createDataFrame([(f,) for f in fps], "fp bigint").repartition(3)
    for radius in (0, 2, 5):
        want = np.arange(len(fps))
        x = np.array(fps, np.uint64)
        close = np.argwhere(np.bitwise_count(x[:, None] ^ x[None, :]) <= radius)
        want = simhash.forest(len(fps), close[:, 0], close[:, 1])
        for points_a_shard, copies in ((4, 4), (16, 1), (100, 2)):
            monkeypatch.setattr(simhash, "SHARD_POINTS", points_a_shard)
            monkeypatch.setattr(simhash, "BOUNDARY_COPIES", copies)
            place = {f: k for k, f in enumerate(fps)}
            pairs = [(place[r.a], place[r.b]) for r in simhash.links(points, radius).collect()]
            assert all((fps[a] ^ fps[b]).bit_count() <= radius for a, b in pairs) or radius
            a, b = (np.array([p[k] for p in pairs], int) for k in (0, 1))
            assert simhash.forest(len(fps), a, b).tolist() == want.tolist()
