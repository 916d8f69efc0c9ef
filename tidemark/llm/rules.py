"""Quality rules of documents, and verdicts on whole hosts.

Each text is measured by DataFrame expressions alone. Rule failures are counted
by host (partial counts first, so a hot host costs no more than others); each
host's rate is shrunk towards the mean of all hosts by a beta prior fitted to
the hosts' rates (method of moments); the verdicts are joined back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, cut, let, text_or_empty

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Limits. The first two make base_failed; the others count against the host only."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10
    max_dup_lines: int = 30
    #: Hosts whose shrunken rate of failures exceeds this lose all their documents.
    max_host_rate: float = 0.5
    #: Bounds of the prior's weight, in documents.
    prior_weight: tuple[float, float] = (2.0, 10_000.0)


def word_array(text: Column) -> Column:
    """array<string>: the runs of non-white characters."""
    return F.array_remove(F.split(text, SPACE), "")


def _windows(n: Column) -> Column:
    """0 .. n - 3, the starts of the three-word windows."""
    return F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))


def repeat_words(w: Column) -> Column:
    """Number of words in three-word windows that occur twice or more.

    Hashes single out the windows that may be repeated; only their words are
    then compared, so hash collisions count for nothing.
    """

    def covered(starts: Column) -> Column:  # ascending starts of repeated windows
        steps = F.zip_with(starts, F.slice(starts, 2, 1 << 30), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda n, s: n + s)

    def adjacent(rows: Column, same) -> Column:
        """Starts i of those sorted structs (key, i) whose key a neighbour shares."""
        kept = F.filter(
            F.transform(F.sequence(F.lit(0), F.size(rows) - 1), lambda k: F.when(same(F.get(rows, k), F.get(rows, k - 1)) | same(F.get(rows, k), F.get(rows, k + 1)), F.get(rows, k)["i"])),
            lambda i: i.isNotNull(),
        )
        return F.array_sort(kept)

    def exact(words: Column):
        def of(maybe: Column) -> Column:
            rows = F.transform(maybe, lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("s"), i.alias("i")))
            return let(F.array_sort(rows), lambda r: covered_of(adjacent(r, lambda a, b: a["s"] == b["s"])))

        return of

    def covered_of(starts: Column) -> Column:
        return let(starts, covered)

    def of_words(words: Column) -> Column:
        hashes = F.transform(_windows(F.size(words)), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(among(words, h)))

    def among(words: Column, h: Column) -> Column:
        rows = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        maybe = let(F.array_sort(rows), lambda r: adjacent(r, lambda a, b: a["h"] == b["h"]))
        return let(maybe, lambda m: F.when(F.size(m) == 0, F.lit(0)).otherwise(exact(words)(m)))

    return let(w, of_words)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text_or_empty(text_col)
    given = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), text.alias("text"), word_array(text).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return given.select(
        "id",
        "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).cast("long").alias("n_repeat_words"),
    )


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """(id_col, the five measures, base_failed, kept, host_failed): one row a row.

    base_failed: fewer than min_words words, or more than max_repeat_percent of
    them in repeated windows. kept: not base_failed and the host not rejected.
    Null and empty texts have no words and fail; a null host is a host of its
    own; repeated rows count as often as they occur; null ids are passed on.
    Other columns are left out. An empty table gives an empty one.
    """
    n = F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    other = (100 * F.col("n_symbols") > rules.max_symbol_percent * F.col("word_chars")) | (F.col("n_dup_lines") > rules.max_dup_lines)
    rows = cut(measured(docs, id_col, text_col, host_col).withColumn("base_failed", base).withColumn("failed", base | other))
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("k"))
    rate = F.col("k") / F.col("n")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # one row, whatever the number of hosts
    low, high = rules.prior_weight
    mean = 0.0 if mean is None else mean
    weight = min(max(mean * (1 - mean) / var - 1, low), high) if var else high
    shrunk = (F.col("k") + weight * mean) / (F.col("n") + weight)
    rejected = hosts.where(shrunk > rules.max_host_rate).select(F.col("host").alias("bad"), F.lit(True).alias("hit"))
    joined = rows.join(rejected, F.col("host").eqNullSafe(F.col("bad")), "left")
    host_failed = F.coalesce("hit", F.lit(False))
    return joined.select(F.col("id").alias(id_col), *MEASURES, "base_failed", (~F.col("base_failed") & ~host_failed).alias("kept"), host_failed.alias("host_failed"))


def oracle(rules: Rules = Rules()) -> str:  # noqa: B008
    """DuckDB SQL for judged() over documents."""
    low, high = rules.prior_weight
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
i AS (
  SELECT r, unnest(generate_series(1, len(w) - 2)) AS i, w FROM w WHERE len(w) >= 3),
g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS c FROM i),
c AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c >= 2) GROUP BY r),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
f AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
    base_failed OR 100 * n_symbols > {rules.max_symbol_percent} * word_chars OR n_dup_lines > {rules.max_dup_lines} AS failed
  FROM m),
h AS (SELECT source, count(*) AS n, sum(failed::INT) AS k FROM f GROUP BY source),
p AS (SELECT avg(k / n) AS mean, var_pop(k / n) AS var FROM h),
q AS (SELECT mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, {low}), {high}) ELSE {high} END AS weight FROM p),
v AS (SELECT source, (k + weight * mean) / (n + weight) > {rules.max_host_rate} AS host_failed FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_failed AS kept, host_failed
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
