"""Preference examples from pairs of conversations, in DataFrame expressions alone.

The turns that a chosen and a rejected conversation share from their beginning are the prompt, rendered once; the others
are the two completions. Turns are compared by their number: the prompt ends before the first number at which the
two differ. This is found by aggregates over (pair, turn), so no conversation is gathered in one place to compare
it, whatever its length.

Each segment is a rendered turn with the part of it that is trained on: in completions, what an assistant said and
the mark that ends it; in prompts nothing (start and end are 0).

A null role is ``unknown``, a null text is empty, a null turn comes after all others. Rows without ``conv_id`` are in no
conversation. Repeated rows count once. A pair whose conversations are equal is all prompt; one that lacks a
conversation has no prompt. Marks within a text are broken by a space, so that a text cannot end its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|turn|>", "<|end|>"
LAST = (1 << 63) - 1


def _clean(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2m (chosen) and 2m + 1 (rejected): pair_id, chosen, rejected."""
    ids = turns.where("conv_id is not null").groupBy(F.floor(F.col("conv_id") / 2).alias("pair_id"))
    side = lambda k: F.max(F.when(F.pmod("conv_id", F.lit(2)) == k, F.col("conv_id")))
    return ids.agg(side(0).alias("chosen"), side(1).alias("rejected"))


def retold(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation up to its last assistant turn, against itself with another one there: turns and pairs.

    The other turn is the last assistant turn of the conversation 2m + 1 of 2m, and of 2m for 2m + 1. pair_id is the
    conversation; one without an assistant turn, or whose partner has none, is in no pair."""
    number = F.coalesce(F.col("turn").cast("long"), F.lit(LAST))
    said = turns.where("conv_id is not null").select("conv_id", number.alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    last = said.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    partner = F.when(F.pmod("conv_id", F.lit(2)) == 0, F.col("conv_id") + 1).otherwise(F.col("conv_id") - 1)
    ends = last.join(last.select(partner.alias("conv_id"), F.col("last.text").alias("other")), "conv_id")
    name = lambda side: F.concat(F.col("conv_id").cast("string"), F.lit(side))
    told = said.join(ends.select("conv_id", F.col("last.turn").alias("end")), "conv_id").where("turn <= end")
    chosen = told.select(name("c").alias("conv_id"), "turn", "role", "text")
    shared = told.where("turn < end").select(name("r").alias("conv_id"), "turn", "role", "text")
    other = ends.select(name("r").alias("conv_id"), F.col("last.turn").alias("turn"), F.lit("assistant").alias("role"), F.col("other").alias("text"))
    return chosen.unionByName(shared).unionByName(other), ends.select(F.col("conv_id").alias("pair_id"), name("c").alias("chosen"), name("r").alias("rejected"))


def segments(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each segment of each pair: pair_id, part (prompt, chosen, rejected), turn, role, rendered, train_from, train_to.

    turns: conv_id, turn, role, text; pairs: pair_id, chosen, rejected (conversation ids)."""
    said = turns.where("conv_id is not null").select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sides = F.array(*[F.struct(F.col(x).alias("conv_id"), F.lit(x).alias("side")) for x in ("chosen", "rejected")])
    members = pairs.select("pair_id", F.inline(sides)).where("conv_id is not null").distinct()
    spoken = said.join(members, "conv_id")
    has = lambda x: F.max(F.col("side") == x).alias(x)
    turn = spoken.groupBy("pair_id", "turn", "role", "text").agg(has("chosen"), has("rejected"))
    parting = turn.where(~(F.col("chosen") & F.col("rejected"))).groupBy("pair_id").agg(F.min("turn").alias("parts_at"))
    turn = turn.join(parting, "pair_id", "left")
    shared = F.col("parts_at").isNull() | (F.col("turn") < F.col("parts_at"))
    where = F.filter(F.array(*[F.when(F.col(x), F.lit(x)) for x in ("chosen", "rejected")]), lambda x: x.isNotNull())
    parts = turn.withColumn("part", F.explode(F.when(shared, F.array(F.lit("prompt"))).otherwise(where)))
    head = F.concat(F.lit(OPEN), _clean(F.col("role")), F.lit("\n"))
    rendered = F.concat(head, _clean(F.col("text")), F.lit(CLOSE + "\n"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return parts.select(
        "pair_id", "part", F.when(F.col("turn") != LAST, F.col("turn")).alias("turn"), "role", rendered.alias("rendered"),
        F.when(trained, F.char_length(head)).otherwise(0).alias("train_from"), F.when(trained, F.char_length(rendered) - 1).otherwise(0).alias("train_to"),
    )


def examples(rows: DataFrame) -> DataFrame:
    """One row a pair: pair_id, prompt, chosen, rejected, and the trained spans of either completion.

    ``rows`` are segments. A pair's text is gathered in one row here, which must fit in memory as a training example does."""
    turn = F.struct(F.coalesce("turn", F.lit(LAST)).alias("turn"), "role", "rendered", "train_from", "train_to")
    each = rows.groupBy("pair_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("part") == p, turn))).alias(p) for p in ("prompt", "chosen", "rejected")])
    text = lambda p: F.array_join(F.transform(p, lambda x: x.rendered), "").alias(p)

    def spans(p: str) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
        add = lambda acc, x: F.struct((acc.at + F.char_length(x.rendered)).alias("at"), F.when(x.train_to > 0, F.concat(acc.out, F.array(F.struct((acc.at + x.train_from).alias("start"), (acc.at + x.train_to).alias("end"))))).otherwise(acc.out).alias("out"))
        return F.aggregate(p, start, add, lambda acc: acc.out).alias(f"{p}_trained")

    return each.select("pair_id", text("prompt"), text("chosen"), text("rejected"), spans("chosen"), spans("rejected"))


SQL = f"""
WITH said AS (SELECT DISTINCT conv_id, CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 AS side, coalesce(turn, {LAST}) AS turn,
  coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT pair_id, turn, role, text, bool_or(side = 0) AS c, bool_or(side <> 0) AS r FROM said GROUP BY ALL),
p AS (SELECT pair_id, min(turn) AS parts_at FROM t WHERE NOT (c AND r) GROUP BY pair_id),
s AS (SELECT t.*, parts_at IS NULL OR turn < parts_at AS shared FROM t LEFT JOIN p USING (pair_id)),
x AS (SELECT *, 'prompt' AS part FROM s WHERE shared UNION ALL SELECT *, 'chosen' FROM s WHERE NOT shared AND c UNION ALL SELECT *, 'rejected' FROM s WHERE NOT shared AND r),
y AS (SELECT *, '{OPEN}' || replace(role, '<|', '< |') || chr(10) AS head, part <> 'prompt' AND role = 'assistant' AS trained FROM x),
z AS (SELECT *, head || replace(text, '<|', '< |') || '{CLOSE}' || chr(10) AS rendered FROM y)
SELECT pair_id, part, CASE WHEN turn <> {LAST} THEN turn END AS turn, role, rendered,
  CAST(CASE WHEN trained THEN length(head) ELSE 0 END AS INTEGER) AS train_from, CAST(CASE WHEN trained THEN length(rendered) - 1 ELSE 0 END AS INTEGER) AS train_to FROM z
"""
