"""Preference formatting (operator 4).

Of a chosen and a rejected conversation the longest common prefix of turns is
rendered once, as the prompt; what follows it in either is that side's
completion, in which a mask says what to train on. The result is one row a
rendered turn, so a conversation of any length stays spread over tasks. Forks
are found on hashes of turns; a text moves once, to the rows that render it.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm.common import ORDER_BITS, dropped, shuffle_width, staged, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rendered(role: Column, text: Column) -> Column:
    """One turn as text. A ``<|`` inside is broken up, so that no text can open
    or close a turn."""
    body = F.replace(text, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), body, F.lit(CLOSE + "\n"))


def one_a_turn(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): of rows that repeat a turn the smallest
    (role, text), nulls as empty; rows without conversation or turn number have
    no place in any and are left out. Texts move only if some turn is repeated."""
    rows = turns.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    many = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    many = staged(many, "repeated-turns")
    if many.isEmpty():
        dropped(many)
        return rows
    least = rows.join(many, ["conv_id", "turn"], "left_semi").groupBy("conv_id", "turn")
    least = least.agg(F.min(F.struct("role", "text")).alias("t")).select("conv_id", "turn", "t.role", "t.text")
    return rows.join(many, ["conv_id", "turn"], "left_anti").unionAll(least)


def turn_marks(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h, g): 128 bits of each turn's role and text."""
    return turns.select(
        "conv_id",
        "turn",
        "role",
        F.xxhash64("role", "text").alias("h"),
        F.xxhash64("text", F.lit(1), "role").alias("g"),
    )


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, rendered, mask_start, mask_length, n_prompt_turns).

    ``turns``: conv_id, turn, role, text, as ``one_a_turn`` gives. ``pairs``:
    pair_id (unique), chosen_id, rejected_id. ``part`` is prompt, chosen or
    rejected. Conversations agree in a turn if both have it with equal role and
    text (128 bits of it are compared). The mask covers, in characters of
    ``rendered``, what an assistant says in a completion, with its end mark; its
    length is 0 elsewhere. Equal conversations are all prompt; a side without
    turns has no rows. Only pair_id, ids and the four columns are read.

    A result row is one turn, not one pair: a conversation of any length stays
    spread over tasks. A pair's record is its rows by part and turn.
    """
    ids = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("chosen_id").alias("conv_id")),
        F.struct(F.lit("rejected").alias("side"), F.col("rejected_id").alias("conv_id")),
    )).alias("c")).select("pair_id", "c.side", "c.conv_id")
    marks = staged(turn_marks(turns), "turn-marks")
    uses = marks.join(ids, "conv_id").select(
        "pair_id", "side", "turn", "conv_id", F.col("turn").alias("from_turn"), "h", "g"
    )
    return format_uses(turns, uses)


def format_uses(turns: DataFrame, uses: DataFrame) -> DataFrame:
    """``format_pairs`` from the turns that each side of a pair is made of.

    ``uses``: pair_id, side, turn, and the turn of ``turns`` that stands there
    (conv_id, from_turn) with its marks (h, g). The fork is found on the marks,
    so each text moves once, to where it is used.
    """
    uses = staged(uses, "turn-uses")
    agree = (F.count(F.lit(1)) == 2) & (F.min("h") == F.max("h")) & (F.min("g") == F.max("g"))
    by_turn = uses.groupBy("pair_id", "turn").agg(agree.alias("agree"))
    # Plain longs: a pair of very many turns is combined before it moves.
    forks = by_turn.groupBy("pair_id").agg(F.min(F.when(~F.col("agree"), F.col("turn"))).alias("fork"))
    forks = staged(forks, "forks")
    shared = F.col("fork").isNull() | (F.col("turn") < F.col("fork"))
    rows = uses.join(forks, "pair_id").withColumn("part", F.when(shared, "prompt").otherwise(F.col("side")))
    # The chosen side stands for both in the prompt.
    rows = rows.where("part <> 'prompt' OR side = 'chosen'")
    counted = rows.groupBy("pair_id").agg(F.count_if(F.col("part") == "prompt").alias("n_prompt_turns"))
    places = rows.join(counted, "pair_id").select(
        "pair_id", "part", "turn", "n_prompt_turns", "conv_id", F.col("from_turn").alias("__from")
    )
    texts = turns.select("conv_id", F.col("turn").alias("__from"), "role", "text")
    rows = places.join(texts, ["conv_id", "__from"])
    whole = rendered(F.col("role"), F.col("text"))
    head = F.length(F.concat(F.lit(OPEN), F.col("role"), F.lit("\n")))
    trained = (F.col("role") == "assistant") & (F.col("part") != "prompt")
    return rows.withColumn("rendered", whole).select(
        "pair_id",
        "part",
        "turn",
        "role",
        "rendered",
        F.when(trained, head).otherwise(0).cast("long").alias("mask_start"),
        # The line break after the end mark is not said by anyone.
        F.when(trained, F.length("rendered") - head - 1).otherwise(0).cast("long").alias("mask_length"),
        F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
    )


def following(ids: DataFrame) -> DataFrame:
    """(conv_id, next_id): each distinct id of ``ids`` and the one after it by
    (52 bits of the id's MD5, id); the first follows the last, an only id itself.

    Ids are dealt to ranges of the hash, so no task sees all; a range's last id
    takes the first of the next range that has any (one row a range, as many as
    the session has shuffle partitions)."""
    width = -(-(1 << ORDER_BITS) // shuffle_width(ids.sparkSession))
    order = F.conv(F.substring(F.md5(F.col("conv_id").cast("string")), 1, ORDER_BITS // 4), 16, 10).cast("long")
    dealt = ids.select("conv_id").distinct().withColumn("o", order).withColumn("r", F.expr(f"o div {width}L"))
    ahead = dealt.withColumn("next_id", F.expr("lead(conv_id) OVER (PARTITION BY r ORDER BY o, conv_id)"))
    ahead = staged(ahead, "following")
    firsts = ahead.groupBy("r").agg(F.min_by("conv_id", F.struct("o", "conv_id")).alias("first_id"))
    firsts = firsts.selectExpr(
        "r", "coalesce(lead(first_id) OVER (ORDER BY r), first_value(first_id) OVER (ORDER BY r)) AS after_id"
    )
    return ahead.join(firsts, "r").selectExpr("conv_id", "coalesce(next_id, after_id) AS next_id")


def borrowed_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, uses) from plain conversations, for ``format_uses``: each that has
    an assistant turn is chosen as far as its last one (pair_id: its conv_id);
    rejected is the same with that answer replaced by the last answer of the
    conversation that follows it (``following``, among those with an answer). A
    conversation without an answer has nothing to prefer and no rows; the only
    one with an answer is compared with itself, and all prompt."""
    marks = staged(turn_marks(turns), "turn-marks")
    last = marks.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last"))
    last = staged(last, "last-answers")
    after = following(last).join(last.select(F.col("conv_id").alias("next_id"), F.col("last").alias("next_last")), "next_id")
    answers = marks.select(F.col("conv_id").alias("next_id"), F.col("turn").alias("next_last"), F.col("h").alias("nh"), F.col("g").alias("ng"))
    after = after.join(answers, ["next_id", "next_last"])
    asked = marks.join(last, "conv_id").where("turn <= last").join(after, "conv_id")
    other = F.col("turn") == F.col("last")
    use = lambda side, swap: F.struct(
        F.lit(side).alias("side"),
        *[
            (F.when(other, F.col(theirs)).otherwise(F.col(own)) if swap else F.col(own)).alias(name)
            for name, own, theirs in (
                ("conv_id", "conv_id", "next_id"), ("from_turn", "turn", "next_last"), ("h", "h", "nh"), ("g", "g", "ng"),
            )
        ],
    )
    uses = asked.select(
        F.col("conv_id").alias("pair_id"), "turn", F.explode(F.array(use("chosen", False), use("rejected", True))).alias("u")
    )
    return turns, uses.select("pair_id", "turn", "u.*")


def op4_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = one_a_turn(table(spark, sf_dir, "conversations"))
    return format_uses(*borrowed_answers(turns))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, ''), coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL) WHERE k = 1),
l AS (SELECT conv_id, max(turn) AS last FROM t WHERE role = 'assistant' GROUP BY 1),
o AS (SELECT conv_id, count(*) OVER () AS n, row_number() OVER (
        ORDER BY ('0x' || substr(md5(conv_id::VARCHAR), 1, 13))::BIGINT, conv_id) AS i FROM l),
a AS (SELECT x.conv_id, t.text FROM o x JOIN o y ON y.i = x.i % x.n + 1 JOIN l ON l.conv_id = y.conv_id
      JOIN t ON t.conv_id = y.conv_id AND t.turn = l.last),
p AS (
  SELECT t.conv_id AS pair_id, turn, role, t.text AS chosen,
         CASE WHEN turn = last THEN a.text ELSE t.text END AS rejected
  FROM t JOIN l USING (conv_id) JOIN a ON a.conv_id = t.conv_id WHERE turn <= last),
f AS (SELECT pair_id, min(turn) FILTER (chosen <> rejected) AS fork FROM p GROUP BY 1),
n AS (SELECT pair_id, count(*) FILTER (fork IS NULL OR turn < fork) AS n_prompt_turns FROM p JOIN f USING (pair_id) GROUP BY 1),
r AS (
  SELECT pair_id, 'prompt' AS part, turn, role, chosen AS text FROM p JOIN f USING (pair_id) WHERE fork IS NULL OR turn < fork
  UNION ALL SELECT pair_id, 'chosen', turn, role, chosen FROM p JOIN f USING (pair_id) WHERE turn >= fork
  UNION ALL SELECT pair_id, 'rejected', turn, role, rejected FROM p JOIN f USING (pair_id) WHERE turn >= fork),
x AS (
  SELECT *, '<|im_start|>' || role || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS rendered,
         part <> 'prompt' AND role = 'assistant' AS trained FROM r)
SELECT pair_id, part, turn, role, rendered, n_prompt_turns,
       CASE WHEN trained THEN 13 + length(role) ELSE 0 END::BIGINT AS mask_start,
       CASE WHEN trained THEN length(rendered) - 14 - length(role) ELSE 0 END::BIGINT AS mask_length
FROM x JOIN n USING (pair_id)
"""
