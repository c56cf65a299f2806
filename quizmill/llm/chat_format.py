"""Chat formatting with a compiled template, and reading formatted conversations back.

Turns of a conversation come to one task, sorted by Spark, and are rendered as they come: a long
conversation leaves in several parts, so a task holds a part, not a conversation. Control strings of
the template can't occur inside texts: ``<`` followed by ``|`` gets a backslash between, one more than
there are already, and loses one when read back. In roles line ends and backslashes are escaped too.

Nulls: a null text or role is empty; rows with a null conversation form one; null turns come first.
Turns that tie are ordered by role and text. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tasks import tidy
from .template import BEGIN, END, compile_template

START, STOP = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + (message.role | header) + '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.content | escape }}{% endgeneration %}"
    "{% else %}{{ message.content | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}"
    "{% endfor %}"
)
#: Characters of a part, about.
PART = 1 << 16


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text or "")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def header(role: str) -> str:
    return escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))


def read_header(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text), flags=re.S)


FILTERS = {"escape": escape, "header": header, "trim": lambda x: (x or "").strip(), "lower": lambda x: (x or "").lower(), "upper": lambda x: (x or "").upper()}


def format_conversations(turns: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, part, last, text, loss``: the parts of each conversation in order, in one partition;
    ``loss`` holds start and end of generated stretches, in characters of the part."""
    schema = "conv_id long, part int, last boolean, text string, loss array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, FILTERS)
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out: list[tuple] = []
        size = 0
        for conv, of in groupby(rows, key=lambda r: r[0]):
            text: list[str] = []
            loss: list[int] = []
            at = part = 0
            inside = False
            for x in render(messages=({"role": r[1] or "", "content": r[2] or ""} for r in of)):
                if x is BEGIN or x is END:
                    inside = x is BEGIN
                    loss.append(at)
                    continue
                text.append(x)
                at += len(x)
                if at >= PART and not inside:
                    out.append((conv, part, False, "".join(text), loss))
                    size += at
                    text, loss, at, part = [], [], 0, part + 1
                    if size >= 16 * PART:
                        yield batch(out)
                        out, size = [], 0
            out.append((conv, part, True, "".join(text), loss))
            size += at
            if size >= 16 * PART:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["conv_id", "part", "last", "text", "loss"])

    return (
        turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), F.col(turn_col).alias("turn"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(tidy(run), schema)
    )


def read_back(parts: DataFrame) -> DataFrame:
    """What the formatted parts say: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. Parts must lie as ``format_conversations`` leaves them, each conversation's in order
    and in one partition; others raise an error."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [x.split()[0] for x in schema.split(", ")]
    turn = re.compile(f"{re.escape(START)}(.*?)\n(.*?){re.escape(STOP)}\n", re.S)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = lambda: [0, hashlib.sha256(), 0, hashlib.sha256(), 0, ""]
        now, follows = fresh(), (None, 0)
        for b in batches:
            done = []
            for conv, part, last, text, loss in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != (follows[1] if conv == follows[0] else 0):
                    raise ValueError(f"part {part} of conversation {conv} is out of order")
                follows = (None, 0) if last else (conv, part + 1)
                for i in range(0, len(loss), 2):
                    said = unescape(text[loss[i] : loss[i + 1]])
                    now[2] += len(said)
                    now[3].update(said.encode())
                now[4] += len(text)
                left, at = now[5] + text, 0
                while m := turn.match(left, at):
                    now[0] += 1
                    now[1].update(f"{read_header(m[1])}\n{unescape(m[2])}\n".encode())
                    at = m.end()
                now[5] = left[at:]
                if last:
                    if now[5]:
                        raise ValueError(f"conversation {conv} can't be read back")
                    done.append((conv, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4]))
                    now = fresh()
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k.endswith("256") else pa.int64()) for k, c in zip(names, zip(*done, strict=True), strict=True)], names=names)

    return parts.mapInArrow(tidy(run), schema)
