"""Chat formatting: every participant's view of a conversation, with training masks.

For each participant the whole dialogue is rendered once with that speaker as assistant and
all other speakers as named users; turns of `system` are context in every view and no view
of their own. The mask marks the assistant's words and the mark that ends the turn.

A view is written in pages of a fixed number of turns, so neither a row nor a group grows
with a conversation: (conversation, perspective, page) is the key, `first_turn` counts the
turns before the page, and the pages of a view joined in order are its text. Numbering the
turns uses range partitions, so one conversation with most rows is spread over many tasks.

Defined cases: a null text is empty, a null speaker is named `unknown`, a null conversation
is one conversation, null turns come first. Turns of one number are ordered by speaker and
text; repeated rows are repeated turns. A conversation of system turns alone has no view.
`<|` inside names and texts is written `< |`, so a text cannot forge a turn. Other columns
are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import quoted
from ledgerlake.operators.ranking import ordinal_in_group

PAGE_TURNS = 64
SYSTEM = "system"


def _plain(name: str, missing: str):
    return F.regexp_replace(F.coalesce(quoted(name).cast("string"), F.lit(missing)), r"<\|", "< |")


def rotate(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    page_turns: int = PAGE_TURNS,
) -> DataFrame:
    """Rows (conversation, perspective, page, first_turn, n_turns, rendered, masks).

    `masks` are spans of code points in `rendered`, start included and end excluded.
    """
    rows = turns.select(
        quoted(conversation).alias("conv"),
        quoted(turn).alias("place"),
        _plain(speaker, "unknown").alias("name"),
        _plain(text, "").alias("said"),
    )
    rows = ordinal_in_group(rows, ["conv"], ["place", "name", "said"], "ordinal")
    people = rows.where(F.col("name") != SYSTEM).select(F.col("conv").alias("whose"), F.col("name").alias("perspective"))
    views = rows.join(people.distinct(), F.col("conv").eqNullSafe(F.col("whose")))
    head = (
        F.when(F.col("name") == SYSTEM, F.lit("<|im_start|>system\n"))
        .when(F.col("name") == F.col("perspective"), F.lit("<|im_start|>assistant\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), F.col("name"), F.lit("\n")))
    )
    body = F.concat(F.col("said"), F.lit("<|im_end|>"))
    own = F.col("name") == F.col("perspective")
    segments = views.select(
        "conv",
        "perspective",
        F.floor(F.col("ordinal") / page_turns).alias("page"),
        F.struct(
            "ordinal",
            F.concat(head, body, F.lit("\n")).alias("segment"),
            F.length(head).alias("from"),
            (F.length(head) + F.length(body)).alias("to"),
            own.alias("own"),
        ).alias("part"),
    )
    pages = segments.groupBy("conv", "perspective", "page").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    # a page holds a fixed number of turns, so the running offsets are short
    offsets = F.expr(
        "aggregate(parts, array(0), (o, p) -> concat(o, array(element_at(o, -1) + length(p.segment))))"
    )
    masks = F.expr(
        "transform(filter(arrays_zip(parts, starts), z -> z.parts.own),"
        " z -> named_struct('start', z.starts + z.parts.from, 'end', z.starts + z.parts.to))"
    )
    return (
        pages.withColumn("starts", F.slice(offsets, 1, F.size("parts")))
        .withColumn("masks", masks)
        .select(
            F.col("conv").alias(conversation),
            "perspective",
            F.col("page").cast("int").alias("page"),
            F.col("parts")[0]["ordinal"].alias("first_turn"),
            F.size("parts").alias("n_turns"),
            F.array_join(F.col("parts.segment"), "").alias("rendered"),
            "masks",
        )
    )
