"""Preference pairs: one prompt, two masked completions.

The longest common prefix of turns of a chosen and a rejected conversation is rendered once, as
the prompt; what follows in each is rendered as its completion. A mask gives the character spans
of a completion that are learned from: what assistants say, with the closing mark. Built-in
expressions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template of a turn: opening, role, break, text, closing.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED = "assistant"
TURNS = "array<struct<role: string, text: string>>"


def conversations(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, turns``: each conversation as one row, turns in order.

    Turns of equal number are ordered by role and text; a null number comes first. Null roles
    and texts count as empty. Turns of a null conversation belong to none and are left out. A
    conversation becomes one row, so its length is bounded by what a row can hold.
    """
    own = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.col("t").cast(_numbered(turns, turn_col)).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["role"], x["text"])).cast(TURNS).alias("turns")
    )


def _numbered(turns: DataFrame, turn_col: str) -> str:
    kind = turns.schema[turn_col].dataType.simpleString()
    return f"array<struct<turn: {kind}, role: string, text: string>>"


def answered(own: DataFrame) -> DataFrame:
    """``conv_id, context, answer``: each conversation cut after its last assistant turn.

    Conversations without an assistant turn have nothing to learn from and are left out.
    """
    at = F.array_max(
        F.transform("turns", lambda x, k: F.when(x["role"] == LEARNED, k + 1).otherwise(0))
    )
    placed = own.withColumn("at", F.coalesce(at, F.lit(0))).where("at > 0")
    return placed.select(
        "conv_id",
        F.slice("turns", F.lit(1), F.col("at") - 1).alias("context"),
        F.element_at("turns", F.col("at")).alias("answer"),
    )


def partner_pairs(own: DataFrame) -> DataFrame:
    """``pair_id, chosen, rejected`` from conversations alone.

    A conversation up to its last answer is chosen; rejected is the same with the last answer of
    its partner, the conversation whose number differs in the last bit, or with none where there
    is no such answer. ``conv_id`` must be a whole number and stands once; null ids have no
    partner. An empty table gives no pairs; other columns are not read.
    """
    cut = answered(own)
    other = cut.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("answer").alias("other")
    )
    # numbers may repeat in other tables, not here: conversations() gives one row for each
    joined = cut.join(other, "conv_id", "left")
    instead = F.when(F.col("other").isNull(), F.expr(f"cast(array() as {TURNS})"))
    return joined.select(
        F.col("conv_id").alias("pair_id"),
        F.concat("context", F.array("answer")).alias("chosen"),
        F.concat("context", instead.otherwise(F.array("other"))).alias("rejected"),
    )


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(BREAK), turn["text"], F.lit(CLOSE))


def _rest(column: str) -> Column:
    return F.slice(column, F.col("n_common") + 1, F.greatest(F.size(column), F.lit(1)))


def _mask(turns: Column) -> Column:
    """Start and end of the learned characters of rendered turns."""
    sizes = F.transform(turns, lambda x: F.length(_render(x)))
    skipped = F.transform(turns, lambda x: F.length(x["role"]) + len(OPEN) + len(BREAK))
    ends = F.transform(
        sizes,
        lambda _, k: F.aggregate(F.slice(sizes, F.lit(1), k + 1), F.lit(0), lambda a, x: a + x),
    )
    spans = F.transform(
        turns,
        lambda x, k: F.struct(
            (x["role"] == LEARNED).alias("learned"),
            (F.get(ends, k) - F.get(sizes, k) + F.get(skipped, k)).alias("start"),
            F.get(ends, k).alias("end"),
        ),
    )
    learned = F.filter(spans, lambda x: x["learned"])
    return F.transform(learned, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    Input: ``pair_id, chosen, rejected``, the latter two as arrays of (role, text). Null
    conversations count as empty, null roles and texts too. Equal conversations are all prompt
    and have empty completions. Masks are arrays of (start, end) in characters of the completion.
    Every row gives a row; other columns are not read. Template marks inside texts are not
    escaped: the masks tell where the turns are.
    """
    def clean(column: str) -> Column:
        turns = F.transform(
            F.coalesce(F.col(column), F.expr(f"cast(array() as {TURNS})")),
            lambda x: F.struct(
                F.coalesce(x["role"], F.lit("")).alias("role"),
                F.coalesce(x["text"], F.lit("")).alias("text"),
            ),
        )
        return turns.alias(column)

    own = pairs.select("pair_id", clean("chosen"), clean("rejected"))
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    parted = F.array_position(same, F.lit(False)).cast("int")
    own = own.withColumn("n_common", F.when(parted == 0, F.size(same)).otherwise(parted - 1))
    common = F.slice("chosen", F.lit(1), F.col("n_common"))
    own = own.select(
        "pair_id", "n_common", common.alias("common"), _rest("chosen").alias("c"), _rest("rejected").alias("r")
    )
    text = lambda x: F.array_join(F.transform(x, _render), "")
    return own.select(
        "pair_id",
        "n_common",
        text("common").alias("prompt"),
        text("c").alias("chosen"),
        text("r").alias("rejected"),
        _mask(F.col("c")).alias("chosen_mask"),
        _mask(F.col("r")).alias("rejected_mask"),
    )


def mask_text(mask: str) -> Column:
    return F.array_join(
        F.transform(mask, lambda x: F.concat_ws("-", x["start"], x["end"])), ","
    ).alias(mask)


_RENDERED = "'<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)"
_MASK = """array_to_string(list_transform(list_filter(range(1, len({0}) + 1), lambda k: {0}[k].role = 'assistant'),
        lambda k: CAST(CAST(coalesce(list_sum(list_transform(list_slice({0}, 1, k - 1), lambda x: length({1}))), 0) AS BIGINT) + length({0}[k].role) + 13 AS VARCHAR)
            || '-' || CAST(CAST(list_sum(list_transform(list_slice({0}, 1, k), lambda x: length({1}))) AS BIGINT) AS VARCHAR)), ',')"""
ORACLE = f"""
WITH c AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
p AS (
    SELECT conv_id, turns, list_max(list_transform(range(1, len(turns) + 1),
        lambda k: CASE WHEN turns[k].role = 'assistant' THEN k ELSE 0 END)) AS cut FROM c),
a AS (SELECT conv_id, list_slice(turns, 1, cut - 1) AS context, turns[cut] AS answer FROM p WHERE cut > 0),
q AS (
    SELECT a.conv_id AS pair_id, list_append(a.context, a.answer) AS chosen,
           CASE WHEN b.conv_id IS NULL THEN a.context ELSE list_append(a.context, b.answer) END AS rejected
    FROM a LEFT JOIN a AS b ON xor(a.conv_id, 1) = b.conv_id),
n AS (
    SELECT *, coalesce(list_min(list_filter(range(1, greatest(len(chosen), len(rejected)) + 1),
        lambda k: chosen[k] IS DISTINCT FROM rejected[k])) - 1, len(chosen)) AS n_common FROM q),
r AS (SELECT *, list_slice(chosen, n_common + 1, len(chosen)) AS c, list_slice(rejected, n_common + 1, len(rejected)) AS j FROM n)
SELECT pair_id, CAST(n_common AS INTEGER) AS n_common,
       array_to_string(list_transform(list_slice(chosen, 1, n_common), lambda x: {_RENDERED}), '') AS prompt,
       array_to_string(list_transform(c, lambda x: {_RENDERED}), '') AS chosen,
       array_to_string(list_transform(j, lambda x: {_RENDERED}), '') AS rejected,
       {_MASK.format("c", _RENDERED)} AS chosen_mask,
       {_MASK.format("j", _RENDERED)} AS rejected_mask
FROM r
"""
