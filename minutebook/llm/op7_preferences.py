"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

The longest common prefix of turns (same role and text) is rendered once as
the prompt.  What follows it in each conversation is rendered as a
completion, with a mask that tells its trained characters (the assistant's
texts and their end marks) from the rest.  A mask is a run-length list: the
length of each segment in characters, and whether it is trained; the lengths
add up to the completion.

A conversation is one row of turns, as it will be one rendered text; turns
are gathered per conversation and never across conversations.

Defined results: a null role counts as ``user``, a null text as empty; turns
are ordered by turn (null first), role and text; markers inside texts and
roles are broken up, so they cannot open a turn; conversations without an
assistant turn, or that are equal, give empty completions; rows without
conversation id are left out; repeated rows are repeated turns; an empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minutebook.llm.common import read, saved, with_next

ASSISTANT = "assistant"
END = "<|end|>\n"


def _plain(text: Column, default: str) -> Column:
    return F.replace(F.coalesce(text.cast("string"), F.lit(default)), F.lit("<|"), F.lit("< |"))


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: key and its turns in order, as an array of turn, role, text."""
    turn = F.struct("turn", F.coalesce(F.col("role"), F.lit("user")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return turns.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), _plain(t["role"], "user"), F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.concat(_plain(t["text"], ""), F.lit(END))


def _mask(turns: Column) -> Column:
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.char_length(_head(t)).alias("length"), F.lit(False).alias("trained")),
        F.struct(F.char_length(_body(t)).alias("length"), (t["role"] == ASSISTANT).alias("trained")))))


def preference_examples(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with two arrays of turns (role, text) becomes prompt, completions and masks.

    Adds n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask; other columns stay.
    """
    a, b = F.col(chosen), F.col(rejected)
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(same, False)
    n = F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")
    rest = [c for c in pairs.columns if c not in (chosen, rejected)]
    cut = pairs.select(*[F.col(f"`{c}`") for c in rest], n.alias("n_prompt_turns"), F.slice(a, F.lit(1), n).alias("__p"),
                       F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(0))).alias("__c"),
                       F.slice(b, n + 1, F.greatest(F.size(b) - n, F.lit(0))).alias("__r"))
    return cut.select(*[F.col(f"`{c}`") for c in rest], "n_prompt_turns", _rendered(F.col("__p")).alias("prompt"),
                      _rendered(F.col("__c")).alias("chosen"), _rendered(F.col("__r")).alias("rejected"),
                      _mask(F.col("__c")).alias("chosen_mask"), _mask(F.col("__r")).alias("rejected_mask"))


def with_other_answer(convs: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs: each conversation, and the same one ending in the next conversation's last answer.

    The last assistant turn's text is replaced by that of the following conversation
    (ascending key, after the last the first; its own where that one has no answer).
    """
    roles = F.reverse(F.transform("turns", lambda t: t["role"]))
    back = F.array_position(roles, ASSISTANT)
    last = F.when(back > 0, F.size("turns") - back).cast("int")
    own = convs.withColumn("last", last).withColumn("answer", F.expr("if(last is null, null, turns[last].text)"))
    rows = with_next(own, key, [], ["answer"], descending=False)
    changed = F.transform("turns", lambda t, i: F.when(i == F.col("last"), F.struct(
        t["turn"], t["role"], F.coalesce("next_answer", t["text"]).alias("text"))).otherwise(t))
    return rows.select(key, F.col("turns").alias("chosen"), F.when(
        F.col("last").isNull(), F.col("turns")).otherwise(changed).alias("rejected"))


def _runs(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["length"].cast("string"), s["trained"].cast("int").cast("string"))), ",")


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a preference example, its rejected side ending in another's answer."""
    convs = saved(conversations(read(spark, sf_dir, "conversations")), "conversations")
    out = preference_examples(with_other_answer(convs))
    return out.select("conv_id", "n_prompt_turns", "prompt", "chosen", "rejected", _runs("chosen_mask").alias("chosen_mask"),
                      _runs("rejected_mask").alias("rejected_mask"))


ORACLE = r"""
WITH c AS (SELECT conv_id, list({'turn': turn, 'role': coalesce(role, 'user'), 'text': coalesce(text, '')}
                  ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
l AS (SELECT *, list_max(list_transform(turns, lambda t, i: CASE WHEN t.role = 'assistant' THEN i END)) AS last FROM c),
a AS (SELECT *, CASE WHEN last IS NOT NULL THEN turns[last].text END AS answer FROM l),
n AS (SELECT *, CASE WHEN count(*) OVER () = row_number() OVER w THEN first_value(answer) OVER w ELSE lead(answer) OVER w END AS other
      FROM a WINDOW w AS (ORDER BY conv_id)),
r AS (SELECT *, list_transform(turns, lambda t, i: CASE WHEN i = last
             THEN {'turn': t.turn, 'role': t.role, 'text': coalesce(other, t.text)} ELSE t END) AS bad FROM n),
p AS (SELECT *, CASE WHEN last IS NULL OR turns[last].text = bad[last].text THEN len(turns) ELSE last - 1 END AS k FROM r),
s AS (SELECT conv_id, CAST(k AS INTEGER) AS n_prompt_turns, list_slice(turns, 1, k) AS pr, list_slice(turns, k + 1, len(turns)) AS ch,
             list_slice(bad, k + 1, len(turns)) AS re FROM p)
SELECT conv_id, n_prompt_turns,
       array_to_string(list_transform(pr, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)), '') AS prompt,
       array_to_string(list_transform(ch, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)), '') AS chosen,
       array_to_string(list_transform(re, lambda t: '<|' || replace(t.role, '<|', '< |') || '|>' || chr(10) || replace(t.text, '<|', '< |') || '<|end|>' || chr(10)), '') AS rejected,
       array_to_string(list_transform(ch, lambda t: (length(replace(t.role, '<|', '< |')) + 5) || ':0,' || (length(replace(t.text, '<|', '< |')) + 8) || ':' || CASE WHEN t.role = 'assistant' THEN 1 ELSE 0 END), ',') AS chosen_mask,
       array_to_string(list_transform(re, lambda t: (length(replace(t.role, '<|', '< |')) + 5) || ':0,' || (length(replace(t.text, '<|', '< |')) + 8) || ':' || CASE WHEN t.role = 'assistant' THEN 1 ELSE 0 END), ',') AS rejected_mask
FROM s
"""
