"""Conversations as training text: a state machine over roles and segments with loss flags.

A declarative template names, for every role, the control strings around its text, whether the text
is trained on, and which roles may come next. Control strings inside texts are escaped with a
backslash, as are backslashes, so that texts can be read back from the output. Texts never touch a
control string of the template: a space stands between them, and no control string has a space.

Conversations are dealt by id and sorted by turn within their task, and the machine reads them as a
stream: one turn is in memory at a time, however long a conversation is. One conversation's turns
stay in one task, since a digest over them is sequential; only narrow state is kept for it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import columns, record_batch


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool
    next: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    """start: before a conversation; turns: by role; other: for roles without an entry, whose name
    stands between `role_open` and `role_close`; first: roles that may begin; last: that may end."""

    start: str
    turns: dict[str, Turn]
    other: Turn
    role_open: str
    role_close: str
    first: tuple[str, ...]
    last: tuple[str, ...]

    @property
    def controls(self) -> list[str]:
        marks = [self.start, self.role_open, self.role_close]
        for turn in (*self.turns.values(), self.other):
            marks += [turn.open, turn.close]
        return sorted(set(marks), key=lambda m: (-len(m), m))


TEMPLATE = Template(
    start="<s>",
    turns={
        "system": Turn("[SYS]", "[/SYS]", False, ("user",)),
        "user": Turn("[INST]", "[/INST]", False, ("assistant",)),
        "assistant": Turn("[ANS]", "</s>", True, ("user",)),
    },
    other=Turn("[TEXT]", "[/TEXT]", False, ()),
    role_open="[ROLE]",
    role_close="[/ROLE]",
    first=("system", "user"),
    last=("assistant",),
)
FORMATTED = (
    "conv_id {kind}, position long, segments array<struct<text: string, loss: boolean>>, "
    "in_order boolean, may_end boolean"
)
SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def escaper(template: Template) -> re.Pattern:
    return re.compile("|".join([r"\\", *map(re.escape, template.controls)]))


def escape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def segments(role: str, text: str, first: bool, template: Template, pattern: re.Pattern) -> list[dict]:
    """The turn as alternating control and text segments; only a text can bear loss."""
    turn = template.turns.get(role, template.other)
    lead = template.start if first else ""
    if role not in template.turns:
        lead += f"{template.role_open} {escape(role, pattern)} {template.role_close}"
    return [
        {"text": f"{lead}{turn.open} ", "loss": False},
        {"text": escape(text, pattern), "loss": turn.loss},
        {"text": f" {turn.close}", "loss": False},
    ]


def in_streams(df: DataFrame, *order: str) -> DataFrame:
    """Each conversation in one task, its rows in order."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_turns(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, position, segments, in_order (the machine accepts the role here),
    may_end (a conversation may end with it).

    Turns that the machine rejects are flagged and formatted all the same. Order: turn, then role and
    text for equal turns (nulls first). Null role or text: empty. Rows without conv_id form one
    conversation of their own. Other columns are ignored.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, conv, position, allowed = escaper(template), object(), 0, ()
        for batch in batches:
            ids, roles, texts = columns(batch, "conv_id", "role", "text")
            no, parts, fine, end = [], [], [], []
            for i, role, text in zip(ids.to_pylist(), roles.to_pylist(), texts.to_pylist()):
                role, text = role or "", text or ""
                if i != conv:
                    conv, position, allowed = i, 0, template.first
                no.append(position)
                parts.append(segments(role, text, position == 0, template, pattern))
                fine.append(role in allowed)
                end.append(role in template.last)
                allowed = template.turns.get(role, template.other).next
                position += 1
            schema = pa.schema([
                ("conv_id", ids.type), ("position", pa.int64()), ("segments", SEGMENTS),
                ("in_order", pa.bool_()), ("may_end", pa.bool_()),
            ])
            yield record_batch(schema, ids, no, parts, fine, end)

    rows = conversations.select("conv_id", "turn", "role", "text")
    return in_streams(rows, "turn", "role", "text").mapInArrow(run, FORMATTED.format(kind=kind))


def reader(template: Template) -> re.Pattern:
    """Parses one formatted turn: an optional role name, the opening mark, the text, the end."""
    text = r"((?:[^\\]|\\.)*?)"
    opens = "|".join(re.escape(t.open) for t in (*template.turns.values(), template.other))
    closes = "|".join(re.escape(t.close) for t in (*template.turns.values(), template.other))
    role = rf"(?:{re.escape(template.role_open)} {text} {re.escape(template.role_close)})?"
    return re.compile(rf"(?:{re.escape(template.start)})?{role}({opens}) (.*) (?:{closes})", re.DOTALL)


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation, from the formatted text and its loss flags alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, valid (turn order and end accepted)."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    by_open = {t.open: role for role, t in template.turns.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = reader(template)
        schema = None
        conv = none = object()
        done: list[tuple] = []
        turns = loss = None
        n = n_loss = chars = 0
        fine = True

        def close() -> None:
            if conv is not none:
                done.append((conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), chars, fine and end))

        end = False
        for batch in batches:
            ids, parts, accepted, may_end = columns(batch, "conv_id", "segments", "in_order", "may_end")
            schema = pa.schema([
                ("conv_id", ids.type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                ("formatted_chars", pa.int64()), ("valid", pa.bool_()),
            ])
            for i, part, ok, last in zip(*(c.to_pylist() for c in (ids, parts, accepted, may_end))):
                if i != conv or conv is none:
                    close()
                    conv, n, n_loss, chars, fine = i, 0, 0, 0, True
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                whole = "".join(s["text"] for s in part)
                name, mark, text = pattern.fullmatch(whole).groups()
                role = by_open.get(mark, unescape(name or ""))
                turns.update(f"{role}\n{unescape(text)}\n".encode())
                for s in part:
                    if s["loss"]:
                        plain = unescape(s["text"])
                        n_loss += len(plain)
                        loss.update(plain.encode())
                n, chars, fine, end = n + 1, chars + len(whole), fine and ok, last
            yield record_batch(schema, *(zip(*done) if done else [[]] * 7))
            done.clear()
        close()
        if done:
            yield record_batch(schema, *zip(*done))

    return in_streams(formatted, "position").mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean",
    )


def control_conversation(like: DataFrame) -> DataFrame:
    """Conversation -7, whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    rows = like.sparkSession.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    names = rows.columns
    return rows.select(*[F.col(c).cast(like.schema[c].dataType).alias(c) for c in names])
