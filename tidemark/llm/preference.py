"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once, as the prompt; what follows
on either side is its completion, whose masks say which characters are trained
on. Rows stay turns: the common prefix is found by comparing turn with turn, so
a conversation of any length is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

#: The opening and close of a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: The role whose turns are trained on.
TRAINED_ROLE = "assistant"


def common_prefix(turns: DataFrame) -> DataFrame:
    """(pair_id, n_common): how many turns both sides open with, for every pair.

    ``turns`` has pair_id, side ('chosen' or 'rejected'), pos (0, 1, ... on each
    side), role and text. Turns are equal if role and text are, nulls included.
    """
    sides = turns.groupBy("pair_id", "pos").agg(
        F.min(F.when(F.col("side") == "chosen", F.struct(F.lit(1).alias("is"), "role", "text"))).alias("c"),
        F.min(F.when(F.col("side") == "rejected", F.struct(F.lit(1).alias("is"), "role", "text"))).alias("r"),
    )
    apart = F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("pos"))
    return sides.groupBy("pair_id").agg(F.coalesce(F.min(apart), F.max("pos") + 1).cast("int").alias("n_common"))


def rendered(turns: DataFrame) -> DataFrame:
    """(pair_id, part, pos, role, masked, trained): the segments of every pair.

    part is 'prompt' (common turns, once), 'chosen' or 'rejected'. Segments in
    order of pos, masked then trained, make up a part's text; only ``trained``
    counts for the loss: the text and close of the assistant's turns in a
    completion. Null roles and texts render as empty; pairs with a null id are
    left out, for there is nothing to pair them by; equal sides give a prompt
    alone; a pair with one side only has no prompt. An empty table gives an
    empty one. Further columns of ``turns`` are left out.
    """
    turns = turns.where(F.col("pair_id").isNotNull()).select("pair_id", "side", "pos", "role", "text")
    joined = turns.join(common_prefix(turns), "pair_id")
    common = F.col("pos") < F.col("n_common")
    kept = joined.where(~common | (F.col("side") == "chosen"))
    opening = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"))
    closing = F.concat(F.coalesce("text", F.lit("")), F.lit(CLOSE))
    trains = ~common & F.col("role").eqNullSafe(F.lit(TRAINED_ROLE))
    return kept.select(
        "pair_id",
        F.when(common, "prompt").otherwise(F.col("side")).alias("part"),
        F.col("pos").cast("int").alias("pos"),
        "role",
        F.when(trains, opening).otherwise(F.concat(opening, closing)).alias("masked"),
        F.when(trains, closing).otherwise("").alias("trained"),
    )


def against_truncated(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Pairs made of conversations alone, as turns for rendered().

    chosen: the conversation up to its last assistant turn; rejected: the same
    with that turn cut to the first half of its characters (rounded down). A
    conversation without an assistant turn is whole and equal on both sides.
    Turns are numbered by ``turn`` as given; rows with a null turn are left out,
    and of rows with one turn number the least (role, text) counts.
    """
    given = conversations.where(F.col("turn").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("pair_id"), F.col("turn").alias("pos")).agg(F.min(F.struct("role", "text")).alias("t"))
    given = given.select("pair_id", "pos", F.col("t.role").alias("role"), F.col("t.text").alias("text"))
    last = given.groupBy("pair_id").agg(F.max(F.when(F.col("role") == TRAINED_ROLE, F.col("pos"))).alias("last"))
    turns = given.join(last, "pair_id").where(F.col("last").isNull() | (F.col("pos") <= F.col("last")))
    half: Column = F.when(F.col("pos") == F.col("last"), F.expr("substring(text, 1, cast(floor(char_length(text) / 2) as int))")).otherwise(F.col("text"))
    sides = F.explode(F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")), F.struct(F.lit("rejected").alias("side"), half.alias("text"))))
    return turns.select("pair_id", "pos", "role", sides.alias("s")).select("pair_id", F.col("s.side").alias("side"), "pos", "role", F.col("s.text").alias("text"))


def assembled(segments: DataFrame, max_turns: int = 4096) -> DataFrame:
    """(pair_id, prompt, chosen, rejected, chosen_spans, rejected_spans) for pairs of up to ``max_turns`` segments.

    Spans are [start, end) in characters of what is trained on. Longer pairs
    stay as segments: one row can't hold them without gathering a whole pair.
    """
    size = segments.groupBy("pair_id").agg(F.count("*").alias("n")).where(F.col("n") <= max_turns)
    within = Window.partitionBy("pair_id", "part").orderBy("pos")
    length = F.length("masked") + F.length("trained")
    placed = segments.join(size, "pair_id", "left_semi").withColumn("end", F.sum(length).over(within))
    span = F.when(F.length("trained") > 0, F.struct((F.col("end") - F.length("trained")).alias("start"), F.col("end").alias("end")))
    item = F.struct("pos", F.concat("masked", "trained").alias("text"), span.alias("span"))

    def of(part: str, what: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == part, item))), lambda x: x[what])

    text = [F.array_join(of(p, "text"), "").alias(p) for p in ("prompt", "chosen", "rejected")]
    spans = [F.filter(of(p, "span"), lambda s: s.isNotNull()).alias(f"{p}_spans") for p in ("chosen", "rejected")]
    return placed.groupBy("pair_id").agg(*text, *spans)


def oracle() -> str:
    """DuckDB SQL for rendered(against_truncated(conversations))."""
    return rf"""
WITH g AS (
  SELECT conv_id AS pair_id, turn AS pos, min({{'role': role, 'text': text}}) AS t FROM conversations
  WHERE turn IS NOT NULL AND conv_id IS NOT NULL GROUP BY ALL),
l AS (SELECT *, t.role AS role, t.text AS text, max(pos) FILTER (t.role = '{TRAINED_ROLE}') OVER (PARTITION BY pair_id) AS last FROM g),
s AS (
  SELECT pair_id, pos, role, text AS chosen,
    CASE WHEN pos = last THEN substring(text, 1, (length(text) // 2)::INT) ELSE text END AS rejected
  FROM l WHERE last IS NULL OR pos <= last),
n AS (
  SELECT *, coalesce(min(pos) FILTER (chosen IS DISTINCT FROM rejected) OVER (PARTITION BY pair_id), max(pos) OVER (PARTITION BY pair_id) + 1) AS n FROM s),
p AS (
  SELECT pair_id, pos, role, 'prompt' AS part, chosen AS text FROM n WHERE pos < n
  UNION ALL SELECT pair_id, pos, role, 'chosen', chosen FROM n WHERE pos >= n
  UNION ALL SELECT pair_id, pos, role, 'rejected', rejected FROM n WHERE pos >= n),
r AS (
  SELECT *, '{OPEN}' || coalesce(role, '') || chr(10) AS o, coalesce(text, '') || '{CLOSE[:-1]}' || chr(10) AS c,
    part <> 'prompt' AND role IS NOT DISTINCT FROM '{TRAINED_ROLE}' AS trains FROM p)
SELECT pair_id, part, pos::INT AS pos, role, CASE WHEN trains THEN o ELSE o || c END AS masked, CASE WHEN trains THEN c ELSE '' END AS trained
FROM r
"""
