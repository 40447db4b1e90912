"""Preference formatting: pairs of conversations as one prompt and two masked completions.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"  # role whose turns count in training


def conversations(turns: DataFrame) -> DataFrame:
    """``conv, turns``: the turns ``(role, text)`` of each conversation in order of turn,
    role and text (nulls first, null role and text being empty)."""
    item = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (turns.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv"))
            .agg(F.sort_array(F.collect_list(item)).alias("turns"))
            .select("conv", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns")))


def _head(turn):
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _body(turn):
    # markers within a text are broken up, so they can't pass for turns
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def _rendered(turns):
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns):
    """Runs 'flag:characters' of the rendered turns; flag 1 counts in training."""
    def runs(t):
        head, body = F.length(_head(t)), F.length(_body(t))
        return F.when(t["role"] == TRAINED, F.concat(F.lit("0:"), head, F.lit(",1:"), body)).otherwise(
            F.concat(F.lit("0:"), head + body))
    return F.array_join(F.transform(turns, runs), ",")


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, chosen_id, rejected_id, n_common, prompt, chosen, rejected,
    chosen_mask, rejected_mask`` of every row of ``pairs(pair_id, chosen_id,
    rejected_id)`` over ``turns(conv_id, turn, role, text)``.

    The longest common prefix of turns (role and text) of both conversations
    is rendered once, as the prompt, which is not trained on; the turns after
    it are the completions. A mask gives the runs of characters of its
    completion that count in training: what the assistant says, with the end
    marker.

    A conversation that is missing, or null, has no turns; turns without
    conv_id belong to none; turns with the same number are ordered by role and
    text, and repeated turns stay; identical conversations have empty
    completions; repeated pairs give repeated rows, an empty table none; other
    columns are not read. A task holds the turns of a pair, as its row does.
    """
    convs = conversations(turns)
    side = lambda name: convs.select(F.col("conv").alias(f"{name}_conv"), F.col("turns").alias(f"{name}_turns"))
    ids = pairs.select(*[F.col(c).cast("long").alias(c) for c in ("pair_id", "chosen_id", "rejected_id")])
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = (ids.join(side("a"), F.col("chosen_id") == F.col("a_conv"), "left")
            .join(side("b"), F.col("rejected_id") == F.col("b_conv"), "left")
            .select("*", F.coalesce("a_turns", none).alias("a"), F.coalesce("b_turns", none).alias("b")))
    differs = F.array_position(F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y)), F.lit(False))
    n = F.when(differs > 0, differs - 1).otherwise(F.size("a")).cast("int")
    rest = lambda x: F.slice(x, F.col("n_common") + 1, F.greatest(F.size(x) - F.col("n_common"), F.lit(0)))
    cut = both.withColumn("n_common", n).select(
        "pair_id", "chosen_id", "rejected_id", "n_common", F.slice("a", F.lit(1), F.col("n_common")).alias("p"),
        rest("a").alias("a"), rest("b").alias("b"))
    return cut.select("pair_id", "chosen_id", "rejected_id", "n_common", _rendered("p").alias("prompt"),
                      _rendered("a").alias("chosen"), _rendered("b").alias("rejected"),
                      _mask("a").alias("chosen_mask"), _mask("b").alias("rejected_mask"))


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs of the conversations 2k (chosen) and 2k + 1 (rejected), for each k of
    which either exists."""
    even = (F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(2))).cast("long")
    return turns.where(F.col("conv_id").isNotNull()).select(even.alias("pair_id")).distinct().select(
        "pair_id", F.col("pair_id").alias("chosen_id"), (F.col("pair_id") + 1).alias("rejected_id"))


NEIGHBOURS_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         conv_id - (conv_id % 2 + 2) % 2 AS pair_id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
place AS (
  SELECT pair_id, pos,
         count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same
  FROM t GROUP BY pair_id, pos),
common AS (
  SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT same) - 1, max(pos)) AS n_common FROM place GROUP BY pair_id),
shown AS (
  SELECT t.pair_id, t.conv_id, pos, n_common, role, '<|' || role || '|>' || chr(10) AS head,
         replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM t JOIN common ON t.pair_id = common.pair_id),
runs AS (
  SELECT *, CASE WHEN role = 'assistant' THEN '0:' || length(head) || ',1:' || length(body)
                 ELSE '0:' || (length(head) + length(body)) END AS run FROM shown)
SELECT pair_id, pair_id AS chosen_id, pair_id + 1 AS rejected_id, CAST(any_value(n_common) AS INTEGER) AS n_common,
  coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE pos <= n_common AND conv_id = pair_id), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE pos > n_common AND conv_id = pair_id), '') AS chosen,
  coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (WHERE pos > n_common AND conv_id > pair_id), '') AS rejected,
  coalesce(string_agg(run, ',' ORDER BY pos) FILTER (WHERE pos > n_common AND conv_id = pair_id), '') AS chosen_mask,
  coalesce(string_agg(run, ',' ORDER BY pos) FILTER (WHERE pos > n_common AND conv_id > pair_id), '') AS rejected_mask
FROM runs GROUP BY pair_id
"""
