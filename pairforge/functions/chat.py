"""Chat rendering as Column expressions (no UDF).

A message list is ``array<struct<role:string, content:string>>``.  Rendering is
``transform`` + ``array_join``: each message becomes
``header(role) + strip(content) + end-of-turn``; the BOS string is put in
front of message 0 only; an empty list renders ``""`` (no BOS).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

# The Llama-3 style chat template markers.
HEADER_START = "<|start_header_id|>"
HEADER_END = "<|end_header_id|>\n\n"
END_OF_TURN = "<|eot_id|>"
DEFAULT_BOS = "<|begin_of_text|>"
GENERATION_HEADER = HEADER_START + "assistant" + HEADER_END

MESSAGE_DDL = "struct<role:string,content:string>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_message(role: Column, content: Column) -> Column:
    """One rendered message without BOS: header(role) + strip(content) + end-of-turn.
    A null role or content fails the query."""
    role, content = (F.when(c.isNull(), F.raise_error(F.lit(f"a message without {n}"))).otherwise(c)
                     for c, n in ((role, "role"), (content, "content")))
    return F.concat(F.lit(HEADER_START), role, F.lit(HEADER_END), py_strip(content), F.lit(END_OF_TURN))


def render_chat(messages: Column | str, bos: str = DEFAULT_BOS,
                add_generation_prompt: bool = False) -> Column:
    """Render a message list to model text (P1); with the generation header."""
    def piece(m: Column, i: Column) -> Column:
        return F.concat(F.when(i == 0, F.lit(bos)).otherwise(F.lit("")), render_message(m["role"], m["content"]))

    text = F.array_join(F.transform(_col(messages), piece), "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(GENERATION_HEADER))
    return text


def render_long(messages, key: str = "row_id", order: str = "turn", role: str = "role",
                content: str = "content", bos: str = DEFAULT_BOS, add_generation_prompt: bool = False,
                out: str = "text", span: int = 256):
    """P1/P2 from a long message table (one row per message): each message is
    rendered by plain column expressions (whole-stage codegen, no lambda), then
    the rendered pieces of a conversation are gathered in ``order`` and joined.
    Equal to ``render_chat`` over the collected list; BOS goes in front of the first
    message of each conversation.

    ``order`` is a number.  Joining takes two levels: runs of ``span`` order values first, each
    in a group of its own, then a conversation's runs.  So the turns of a hot conversation
    are sorted and joined by many tasks, and the last one only puts their texts one
    after the other; the finished text is one value and has to fit in a row."""
    pieces = messages.select(key, order, F.floor(F.col(order) / F.lit(span)).alias("_run"),
                             render_message(F.col(role), F.col(content)).alias("_p"))
    runs = pieces.groupBy(key, "_run").agg(F.array_sort(F.collect_list(F.struct(order, "_p"))).alias("_ps")) \
        .select(key, "_run", F.array_join(F.col("_ps._p"), "").alias("_p"))
    joined = runs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_run", "_p"))).alias("_ps"))
    text = F.concat(F.lit(bos), F.array_join(F.col("_ps._p"), ""))  # a key has a message at least
    if add_generation_prompt:
        text = F.concat(text, F.lit(GENERATION_HEADER))
    return joined.select(key, text.alias(out))


def append_turn(messages: Column | str, response: Column | str,
                role: str = "assistant") -> Column:
    """Prompt messages + one ``{role, content: response}`` message."""
    turn = F.struct(F.lit(role).alias("role"), _col(response).alias("content"))
    return F.array_append(_col(messages), turn)


def reward_model_text(messages: Column | str, response: Column | str,
                      bos: str = DEFAULT_BOS) -> Column:
    """Scorer input (P5): render prompt + response, then delete every BOS occurrence."""
    rendered = render_chat(append_turn(messages, response), bos=bos)
    return F.replace(rendered, F.lit(bos), F.lit(""))


def reward_model_text_rendered(rendered_prompt: Column | str, response: Column | str,
                               bos: str = DEFAULT_BOS, role: str = "assistant") -> Column:
    """P5 from a prompt already rendered by ``render_chat`` (no generation header):
    equal to ``reward_model_text`` because every BOS is removed after the
    concatenation, so where the template would put BOS does not matter.  Lets a
    per-response lambda read one rendered column instead of re-rendering."""
    return F.replace(F.concat(_col(rendered_prompt), render_message(F.lit(role), _col(response))),
                     F.lit(bos), F.lit(""))


def normalise_chat(conversation: Column | str, role_map: Mapping[str, str],
                   from_field: str = "from", value_field: str = "value") -> Column:
    """Role/value chat -> standard messages (P13); an unknown role raises."""
    mapping = F.create_map(*[F.lit(x) for kv in role_map.items() for x in kv])

    def one(c: Column) -> Column:
        role = F.coalesce(
            F.try_element_at(mapping, c[from_field]),
            F.raise_error(F.concat(F.lit("unknown chat role: "), F.coalesce(c[from_field], F.lit("null")))),
        )
        return F.struct(role.cast("string").alias("role"), c[value_field].alias("content"))

    return F.transform(_col(conversation), one)
