"""Chat formatting: one training example for every assistant turn, with all turns before it as context.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Texts cannot break the template: a
backslash is doubled, ``<|`` becomes ``<\\|`` and, in a role, a line break becomes ``<\\n|``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE = "assistant"
PART_TURNS = 64

# SQL string literals: a backslash is written twice.
_ESCAPE = r"replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"
_UNESCAPE = r"replace(replace({0}, '<\\|', '<|'), '\\\\', '\\')"
_ESCAPE_ROLE = r"replace(" + _ESCAPE + r", '\n', '<\\n|')"
_UNESCAPE_ROLE = _UNESCAPE.replace("{0}", r"replace({0}, '<\\n|', '\n')")


def format_parts(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Formatted text of every conversation (columns conv_id, turn, role, text), in parts.

    A part holds the turns of one range of ``part_turns`` turn numbers, so that a conversation of
    any length is formatted by many tasks; its parts joined in order are its text. Per part:
    conv_id, part, n_turns, formatted, base (code points before the part) and targets, the spans of
    all assistant texts as (start, chars), counted in code points from the start of the part.

    Rows go by turn, equal turns by role and text; a null turn comes first; null roles and texts are
    empty; repeated rows stay; rows with a null conv_id form one conversation; other columns are
    ignored. No rows give no rows.
    """
    turns = conversations.selectExpr(
        "conv_id", "turn", f"BIGINT(floor(turn / {part_turns})) AS part",
        "coalesce(string(role), '') AS role", "coalesce(string(text), '') AS text",
    ).selectExpr(
        "conv_id", "part", "turn", "role", "text",
        f"concat('{START}', {_ESCAPE_ROLE.format('role')}, '\\n') AS head", f"{_ESCAPE.format('text')} AS body",
    )
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    placed = (
        turns.withColumn("chars", F.expr(f"BIGINT(length(head) + length(body) + {len(END)})"))
        .withColumn("nth", F.row_number().over(inside))
        .withColumn("start", F.sum("chars").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("chars"))
    )
    parts = placed.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sum("chars").alias("chars"),
        F.expr("sort_array(collect_list(struct(nth, concat(head, body) AS text)))").alias("texts"),
        F.expr(
            f"sort_array(collect_list(if(role = '{TARGET_ROLE}', "
            "struct(start + length(head) AS start, BIGINT(length(body)) AS chars), NULL)))"
        ).alias("targets"),
    )
    end = END.replace("\n", "\\n")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "conv_id", "part", "n_turns",
        F.expr(f"concat(array_join(transform(texts, t -> t.text), '{end}'), '{end}')").alias("formatted"),
        F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("base"), "targets",
    )


def prefix_targets(parts: DataFrame) -> DataFrame:
    """One row per assistant turn: its own example, all turns before it as context, written out.

    ``text`` is the conversation's formatted text up to the end of the turn; only code points from
    ``loss_start`` up to ``loss_end`` are trainable. A conversation that does not end with an
    assistant turn gives one more row, its whole text with null loss columns, so that nothing of it
    is lost. ``last``: no row of the conversation is longer. ``nth`` counts within the part.

    The context of a part is joined once and serves all its examples; written out, the examples of a
    conversation grow with the square of its turns.
    """
    along = Window.partitionBy("conv_id").orderBy("part")
    context = F.collect_list("formatted").over(along.rowsBetween(Window.unboundedPreceding, -1))
    closed = f"coalesce(try_element_at(targets, -1).start + try_element_at(targets, -1).chars + {len(END)} = length(formatted), false)"
    spans = parts.select(
        "conv_id", "part", "base", "formatted", "targets",
        F.array_join(context, "").alias("context"), F.lead(F.lit(True), 1, False).over(along).alias("more"),
    ).withColumn(
        "spans", F.expr(f"if(more OR {closed}, targets, concat(targets, array(NULL)))")
    )
    end = END.replace("\n", "\\n")
    return spans.selectExpr("*", "posexplode(spans) AS (nth, span)").selectExpr(
        "conv_id", "part", "nth",
        f"if(span IS NULL, concat(context, formatted), concat(context, left(formatted, INT(span.start + span.chars)), '{end}')) AS text",
        "base + span.start AS loss_start", "base + span.start + span.chars AS loss_end",
        "NOT more AND nth = size(spans) - 1 AS last",
    )


def example_texts(parts: DataFrame) -> DataFrame:
    """(conv_id, text, loss_start, loss_end) of every example, without the rows that train nothing."""
    return prefix_targets(parts).where("loss_end IS NOT NULL").select("conv_id", "text", "loss_start", "loss_end")


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples' texts and loss spans alone: its turns and trained texts.

    conv_id, n_turns, turns (role, line break, text, line break per turn, of the longest example),
    loss (all trained texts in order, unescaped), formatted_chars (code points of the formatted
    conversation), n_examples and example_chars (code points of all examples).
    """
    end = END.replace("\n", "\\n")
    role = _UNESCAPE_ROLE.format(f"substring_index(substring(t, {len(START) + 1}), '\\n', 1)")
    text = _UNESCAPE.format(f"substring(t, {len(START) + 2} + length(substring_index(substring(t, {len(START) + 1}), '\\n', 1)))")
    marked = end.replace("|", "\\\\|")
    once = examples.selectExpr(
        "conv_id", "part", "nth", "if(last, text, NULL) AS whole", "BIGINT(length(text)) AS chars", "loss_end IS NOT NULL AS trained",
        f"{_UNESCAPE.format('substring(text, INT(loss_start + 1), INT(loss_end - loss_start))')} AS loss",
    ).selectExpr(
        "conv_id", "part", "nth", "loss", "if(trained, chars, 0) AS example_chars", "if(whole IS NULL, NULL, chars) AS chars",
        f"slice(split(whole, '{marked}'), 1, size(split(whole, '{marked}')) - 1) AS segments",
    ).selectExpr(
        "conv_id", "part", "nth", "loss", "example_chars", "chars", "if(segments IS NULL, 0, size(segments)) AS n_turns",
        f"array_join(transform(segments, t -> concat({role}, '\\n', {text}, '\\n')), '') AS turns",
    )
    return once.groupBy("conv_id").agg(
        F.sum(F.col("n_turns").cast("long")).alias("n_turns"),
        F.expr("array_join(collect_list(turns), '')").alias("turns"),
        F.expr("array_join(transform(sort_array(collect_list(if(loss IS NULL, NULL, struct(part, nth, loss)))), p -> p.loss), '')").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
        F.count("loss").alias("n_examples"),
        F.sum("example_chars").alias("example_chars"),
    )
