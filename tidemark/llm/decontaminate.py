"""Benchmark decontamination: which documents hold which test items.

An item is found by containment: the share of its distinct word shingles that a
document holds. MinHash keeps of each item the shingles of least hash; items are
partitioned by size, and a partition keeps as many as its sizes call for: if a
document holds the share ``t`` of an item's n shingles, at most n - ceil(t n) are
missing, so of any n - ceil(t n) + 1 shingles it holds one. A document none of
whose shingles meets a sketch thus cannot reach ``t``; the others are verified
by exact shingle containment, on the shingles themselves, not their hashes.

Texts are lower-cased; words are runs of letters and digits. Everything is a
DataFrame expression, and documents are never shuffled: items are broadcast, in
blocks of bounded size, one pass over the documents for each. Of a block go a
narrow table of sketch hashes and one row for each item with its shingles.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, let, text_or_empty

#: Items are broadcast in blocks of about so many bytes; an item is never split.
BLOCK_BYTES = 64 << 20
#: Bytes of a shingle besides its text: its hashes, its length, its share of a row.
SHINGLE_BYTES = 40
#: Bits of a block's bitmap for each hash, at least.
BITS_A_HASH = 16


def words(text: Column) -> Column:
    """array<string>: runs of letters and digits of the lower-cased text."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(of: Column, size: Column | int) -> Column:
    """array<string>: the runs of ``size`` words, repeats included; none if the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.size(of) >= size, F.sequence(F.lit(1), F.size(of) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(of, i, size), " "))


def shingle_hashes(of: Column, size: int) -> Column:
    """array<bigint>: a hash of each run of ``size`` words, straight from the words."""
    starts = F.when(F.size(of) >= size, F.sequence(F.lit(0), F.size(of) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(of, i + k) for k in range(size)]))


def sketches(items: DataFrame, id_col: str, text_col: str, size: int, threshold: float) -> DataFrame:
    """(item, size, n, own, hashes, sketch, class): one row for each item with words.

    own: its distinct shingles; hashes: theirs; sketch: the least hashes, in
    ascending order; class: the size partition (log2 of n). An item of fewer
    words than ``size`` is one shingle of all its words.
    """
    given = items.select(F.col(id_col).alias("item"), words(text_or_empty(text_col)).alias("w")).distinct()
    given = given.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(size)))
    given = given.withColumn("own", F.array_distinct(shingles(F.col("w"), F.col("size"))))
    # The hash of a shingle is that of its words as columns, as for documents.
    hashes = F.lit(None).cast("array<bigint>")
    for k in range(1, size + 1):
        hashes = F.when(F.col("size") == k, F.array_distinct(shingle_hashes(F.col("w"), k))).otherwise(hashes)
    given = given.withColumn("hashes", hashes).withColumn("n", F.size("own")).withColumn("class", F.floor(F.log2("n")).cast("int"))
    # Enough for the largest item of the class, 2**(class + 1) - 1 shingles.
    largest = F.pow(F.lit(2), F.col("class") + 1) - 1
    kept = (largest - F.ceil(largest * F.lit(threshold) - 1e-9) + 1).cast("int")
    return given.withColumn("sketch", F.slice(F.sort_array("hashes"), 1, kept)).drop("w")


def _bitmap(hashes: list[int]) -> tuple[Column, int]:
    """A literal bitmap (array<bigint>) of hashes by their low bits, and its number of bits."""
    bits = 1 << max(6, (BITS_A_HASH * len(hashes)).bit_length())
    table = [0] * (bits >> 6)
    for h in hashes:
        table[(h & bits - 1) >> 6] |= 1 << (h & 63)
    signed = [x - (1 << 64) if x >> 63 else x for x in table]
    return F.from_json(F.lit(json.dumps(signed)), "array<bigint>"), bits


def _met(w: Column, size: int, bitmap: Column, bits: int) -> Column:
    """array<struct<h, s>>: hash and words of the distinct runs of ``size`` words that the bitmap lets pass."""

    def passes(h: Column) -> Column:
        word = F.get(bitmap, F.shiftright(h.bitwiseAND(F.lit(bits - 1)), 6).cast("int"))
        return F.call_function("shiftright", word, h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    def of(hashes: Column) -> Column:
        kept = F.filter(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))), lambda x: passes(x["h"]))
        return F.array_distinct(F.transform(kept, lambda x: F.struct(x["h"].alias("h"), F.array_join(F.slice(w, x["i"] + 1, size), " ").alias("s"))))

    return let(shingle_hashes(w, size), of)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """(id_col, item_col, n_shingles, n_found, containment): pairs at or over the threshold.

    One row for each document and item whose containment (n_found / n_shingles)
    reaches ``threshold``. Documents are told apart by row: a repeated row gives
    its pairs again, equal items (id and text) count once. Null and empty texts,
    and items without words, match nothing; null ids are passed on. Other
    columns are left out. Empty tables give an empty result.
    """
    known = sketches(items, item_col, item_text_col, size, threshold).withColumn("key", F.xxhash64("item", "own"))
    bytes_of = F.expr(f"aggregate(own, 0L, (n, s) -> n + octet_length(s) + {SHINGLE_BYTES})")
    blocks = max(1, -(-(known.agg(F.sum(bytes_of)).first()[0] or 0) // BLOCK_BYTES))
    found = None
    for block in range(blocks):
        own = known.where(F.pmod(F.xxhash64("own"), F.lit(blocks)) == block)
        # A block's hashes, of bounded number, make bitmaps (one for each length of
        # shingles) that let past nearly only those that some item has.
        hashes: dict[int, list[int]] = {}
        for r in own.select("size", F.explode("hashes").alias("h")).distinct().collect():
            hashes.setdefault(r["size"], []).append(r["h"])
        bitmaps = {k: _bitmap(v) for k, v in sorted((hashes or {size: []}).items())}
        met = let(words(text_or_empty(text_col)), lambda w: F.concat(*[_met(w, k, *bitmap) for k, bitmap in bitmaps.items()]))  # noqa: B023
        # Never null, and said so: else a filter for it computes all of this twice.
        met = F.coalesce(met, F.array().cast("array<struct<h: bigint, s: string>>"))
        given = docs.select(F.col(id_col).alias("doc"), met.alias("met")).select("doc", F.col("met.h").alias("hs"), F.col("met.s").alias("ss"))
        probe = given.select("doc", "hs", "ss", F.explode(F.array_distinct("hs")).alias("h"))
        narrow = own.select(F.explode("sketch").alias("h"), "key").distinct()
        pairs = probe.join(F.broadcast(narrow), "h").join(F.broadcast(own.select("key", "item", "n", "own", "sketch")), "key")
        # Of an item's sketch, the least hash that the document holds speaks for
        # the pair, so each pair is verified once and nothing need be shuffled.
        pairs = pairs.where(F.element_at(F.array_intersect("sketch", "hs"), 1) == F.col("h"))
        held = F.size(F.array_intersect("own", "ss")).cast("long")
        part = pairs.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), F.col("n").cast("long").alias("n_shingles"), held.alias("n_found"))
        part = part.where(F.col("n_found") >= F.ceil(F.col("n_shingles") * F.lit(threshold) - 1e-9))
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold an item at or over the threshold.

    All columns and their order are kept. Each row is judged by its own text,
    whatever its id: rows without an id or with a repeated one, and repeated
    rows, stay or go as their texts do. Null and empty texts stay. Empty tables
    of documents or items give ``docs``. ``options`` are those of contaminated().
    """
    rows, key = keyed(docs)
    leaks = contaminated(rows, items, **(options | {"id_col": key})).select(key).distinct()
    return rows.join(leaks, key, "left_anti").select(*docs.columns)


def oracle(size: int = 5, threshold: float = 0.8) -> str:
    """DuckDB SQL: all pairs of documents and items by their distinct shingles."""

    def side(table: str, key: str) -> str:
        return f"""
  SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}"""

    def cut(key: str, source: str, length: str, when: str = "true") -> str:
        return f"""
  SELECT DISTINCT {key}, {length} AS size, list_aggregate(w[i : i + {length} - 1], 'string_agg', ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, len(w) - {length} + 1)) AS i FROM {source} WHERE len(w) >= {length} AND len(w) > 0 AND {when})"""

    # Documents' shingles of each length that some item has.
    lengths = " UNION ALL ".join(cut("doc_id", "d", str(k), f"{k} IN (SELECT size FROM bs)") for k in range(1, size + 1))
    return f"""
WITH d AS ({side("documents", "doc_id")}),
b AS (SELECT DISTINCT * FROM ({side("benchmark", "item_id")})),
bs AS ({cut("item_id", "b", f"least({size}, len(w))")}),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
ds AS ({lengths}),
m AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (size, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM m JOIN n USING (item_id)
WHERE n_found >= ceil(n_shingles * {threshold} - 1e-9)
"""
