"""Chat formatting: one example per assistant turn, all earlier turns as its context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.llm.blocks import saved
from emberfield.operators.ordering import running_sums

START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(?s:(.*))" + re.escape(END) + r"\n")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(c: Column) -> Column:
    """Reversible: backslashes are doubled and every ``<|`` is broken, so no control string is left in a text."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str, line_feeds: bool = False) -> str:
    return _ESCAPED.sub(lambda m: "\n" if line_feeds and m[1] == "n" else m[1], text) if "\\" in text else text


def _by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(turns: DataFrame, trainable: str = "assistant") -> DataFrame:
    """Formatted turns with their places: one row per turn of (conv_id, turn, role, text).

    Returns conv_id, number (from 0), role, segment, start, stop, loss_start and
    loss_stop, places in characters of the conversation's formatted text. Each
    ``trainable`` turn is an example of its own: the formatted text up to ``stop``, of which
    only ``loss_start``..``loss_stop`` is trained. The context is stored once and shared by all
    examples of a conversation, so the output grows with the input and not with its square.

    Turns are ordered by turn, then role and text for ties; null turns come first, null roles
    and texts are empty, null ids are one conversation. Repeated rows are turns of
    their own; other columns are ignored. Places are running sums over ranges of that
    order less the conversation's first, so a conversation of any size is placed by many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escape(text)
    parts = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.concat(head, body, F.lit(f"{END}\n")).alias("segment"), F.length(head).cast("long").alias("head"), F.length(body).cast("long").alias("body"), F.lit(1).cast("long").alias("one"),
    ).withColumn("size", F.length("segment").cast("long"))
    summed = running_sums(parts, ["conv_id", "turn", "role", "text"], {"chars": "size", "count": "one"}).drop("text", "turn", "one")
    summed = saved(summed, "placed")
    first = summed.groupBy(F.col("conv_id").alias("_conv")).agg(F.min(F.col("chars") - F.col("size")).alias("_chars"), F.min(F.col("count") - 1).alias("_count"))
    start = F.col("chars") - F.col("size") - F.col("_chars")
    loss = F.when(F.col("role") == trainable, start + F.col("head"))
    return summed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", (F.col("count") - 1 - F.col("_count")).alias("number"), "role", "segment", start.alias("start"),
        (F.col("chars") - F.col("_chars")).alias("stop"), loss.alias("loss_start"), (loss + F.col("body")).alias("loss_stop"),
    )


def examples(formatted: DataFrame) -> DataFrame:
    """One row per trainable turn: context is 0..loss_start of the formatted text, the target loss_start..loss_stop."""
    return formatted.where("loss_start is not null").select("conv_id", F.col("number").alias("target"), "loss_start", "loss_stop", "stop")


def example_texts(formatted: DataFrame) -> DataFrame:
    """``examples`` written out: a row (conv_id, target, loss_start, loss_stop, stop, part, text) for each turn up to the target.

    The parts of an example, joined in order, are its whole text, however long. Written out, a conversation
    of n turns takes about n / 2 times its size; the places of ``examples`` say the same in its own size.
    """
    parts = formatted.select(F.col("conv_id").alias("_conv"), F.col("number").alias("part"), F.col("segment").alias("text"))
    wanted = examples(formatted)
    return wanted.join(parts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") <= F.col("target"))).select(*wanted.columns, "part", "text")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trained text of each conversation, parsed from its formatted text and its ``examples`` alone.

    What is trained is read from the examples: each is joined to its target turn, and its mask cuts the reply out of it.
    Returns conv_id, n_turns, turns_sha256 (role, line feed, text, line feed per turn), loss_chars,
    loss_sha256 (all text under the loss mask, unescaped) and formatted_chars (of the conversation's text, stored once).
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = object(), None

        def row() -> list[tuple]:
            return [(conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])] if state else []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], _DIGEST)

        for b in batches:
            rows = []
            for c, segment, start, low, high in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                if c != conv:
                    rows += row()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turn = _TURN.fullmatch(segment)
                state[0] += 1
                state[1].update(f"{unescape(turn[1], True)}\n{unescape(turn[2])}\n".encode())
                if low is not None:
                    trained = unescape(segment[low - start : high - start])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                state[4] += len(segment)
            yield out(rows)
        yield out(row())

    targets = examples(formatted).select(F.col("conv_id").alias("_conv"), "target", "loss_start", "loss_stop")
    masked = formatted.drop("loss_start", "loss_stop").join(targets, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("number") == F.col("target")), "left")
    ordered = _by_conversation(masked.select("conv_id", "segment", "start", "loss_start", "loss_stop"), "start")
    return ordered.mapInArrow(parse, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
