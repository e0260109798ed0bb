"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

Rows are streamed per conversation in turn order, so a task holds one batch and one state.
Output is one row per text segment with its loss flag; the formatted conversation is the
concatenation of its segments.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

START, END = "start", "end"


@dataclass(frozen=True)
class Template:
    """Markers around each role's text, the role transitions that are valid, the roles under the loss.

    ``other`` formats roles that have no markers of their own; its role name is escaped too.
    ``controls`` are the strings that only markers may contain.
    """

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": (" [ANS] ", " </s>"),
    })
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
    opening: str = "<s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANS]", "[ROLE]", "[TEXT]", "[/ROLE]")
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    loss_roles: tuple[str, ...] = ("assistant",)

    def pattern(self) -> re.Pattern:
        return re.compile("(?=" + "|".join(map(re.escape, self.controls)) + ")(.)", re.S)


def escape(text: str, pattern: re.Pattern) -> str:
    r"""Double backslashes, and put ``\!`` behind the first character of every control string."""
    return pattern.sub(r"\1\\!", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|!)", lambda m: "\\" if m[1] == "\\" else "", text)


SEGMENTS = "conv_id bigint, seq bigint, turn bigint, segment string, loss boolean, valid boolean"
_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("turn", pa.int64()), ("segment", pa.string()),
                       ("loss", pa.bool_()), ("valid", pa.bool_())])
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint, valid boolean")
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])


def by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of every conversation of ``turns`` (conv_id, turn, role, text).

    Turns are taken in order of (turn, role, text). A null text is empty, a null role is the
    role "" (formatted by ``other``), a null conv_id is a conversation of its own. ``valid`` on
    a segment says whether the conversation followed the transitions up to and with that turn;
    invalid conversations are formatted whole as well.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = template.pattern()
        current, seq, state, valid = object(), 0, START, True
        for batch in batches:
            out: list[tuple] = []
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != current:
                    current, seq, state, valid = conv, 0, START, True
                    out.append((conv, seq, None, template.opening, False, True))
                role = role or ""
                valid = valid and role in template.transitions.get(state, ())
                state = role
                if role in template.roles:
                    before, after = template.roles[role]
                    parts = [(before, False), (escape(text or "", pattern), role in template.loss_roles), (after, False)]
                else:
                    first, middle, last = template.other
                    parts = [(first, False), (escape(role, pattern), False), (middle, False), (escape(text or "", pattern), False),
                             (last, False)]
                for segment, loss in parts:
                    seq += 1
                    out.append((conv, seq, turn, segment, loss, valid))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SEGMENTS)], schema=_SEGMENTS)

    rows = turns.select("conv_id", "turn", "role", "text")
    return by_conversation(rows, "turn", "role", "text").mapInArrow(run, SEGMENTS)


class _Reader:
    """Parses one conversation's segments back into turns and keeps running digests."""

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.opened = conv, {v[0]: k for k, v in template.roles.items()}
        self.template, self.valid = template, True
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        self.step: str | None = None  # what the next segment is: role name, middle marker, text, closing marker
        self.role = ""

    def add(self, segment: str, loss: bool, valid: bool) -> None:
        self.chars += len(segment)
        self.valid = self.valid and valid
        if self.step is None:
            if segment in self.opened:
                self.role, self.step = self.opened[segment], "text"
            elif segment == self.template.other[0]:
                self.step = "role"
            elif segment != self.template.opening:
                raise ValueError(f"conversation {self.conv}: {segment!r} opens no turn")
        elif self.step == "role":
            self.role, self.step = unescape(segment), "middle"
        elif self.step == "middle":
            self.step = "text"
        elif self.step == "text":
            plain = unescape(segment)
            self.n += 1
            self.turns.update(f"{self.role}\n{plain}\n".encode())
            if loss:
                self.loss.update(plain.encode())
                self.loss_chars += len(plain)
            self.step = "close"
        else:
            self.step = None

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid)


def read_conversations(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digest per conversation, parsed back from the segments and their loss flags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DIGEST)], schema=_DIGEST)

        reader: _Reader | None = None
        for batch in batches:
            rows = []
            for conv, _, segment, loss, valid in zip(*(c.to_pylist() for c in batch.columns)):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        rows.append(reader.row())
                    reader = _Reader(conv, template)
                reader.add(segment, loss, valid)
            if rows:
                yield done(rows)
        if reader is not None:
            yield done([reader.row()])

    return by_conversation(segments.select("conv_id", "seq", "segment", "loss", "valid"), "seq").mapInArrow(run, DIGEST)
