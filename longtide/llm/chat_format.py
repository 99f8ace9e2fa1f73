"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names each role's opening and closing mark and whether its text is
learned from (loss). Control strings inside texts are escaped reversibly, so a
formatted conversation can be read back turn by turn.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import text_batches

#: Put inside a control string of a text, after its first character; a backslash of a text is doubled.
_MARK = "\\:"
#: A conversation of more characters is given out in parts of about so many.
PART_CHARS = 4 << 20


@dataclass(frozen=True)
class Template:
    """Marks by role; `other` is for roles without marks, whose name is then written out."""

    begin: str = "<s>"
    end: str = "</s>"
    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "[/ANS]")}
    )
    other: tuple[str, str, str] = ("[ROLE]", "[AS]", "[/ROLE]")
    learned: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        return sorted({self.begin, self.end, *self.other, *(m for pair in self.marks.values() for m in pair)}, key=lambda c: (-len(c), c))

    def pattern(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.controls())))


TEMPLATE = Template()

#: state -> role -> next state. A conversation starts in "start"; it is complete in "answered".
TRANSITIONS = {
    "start": {"system": "told", "user": "asked"},
    "told": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}


class TurnOrder:
    """The machine over one conversation's roles: bad_turn is the first turn that no transition allows (-1: none)."""

    def __init__(self):
        self.state, self.turns, self.bad_turn = "start", 0, -1

    def take(self, role: str) -> None:
        if self.bad_turn < 0:
            if role in TRANSITIONS[self.state]:
                self.state = TRANSITIONS[self.state][role]
            else:
                self.bad_turn = self.turns
        self.turns += 1

    @property
    def valid(self) -> bool:
        """Whether the turns so far are in order and complete."""
        return self.bad_turn < 0 and self.state == "answered"


def escape(text: str, controls: re.Pattern) -> str:
    return controls.sub(lambda m: m[0][0] + _MARK + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|:)", lambda m: "\\" if m[1] == "\\" else "", text)


def turn_segments(role: str, text: str, template: Template, controls: re.Pattern) -> tuple[tuple[str, bool], ...]:
    """(text segment, is it learned from) of one turn, in order."""
    if role in template.marks:
        before, after = template.marks[role]
    else:
        before, after = template.other[0] + escape(role, controls) + template.other[1], template.other[2]
    return (before, False), (escape(text, controls), role in template.learned), (after, False)


def parse(formatted: str, template: Template = TEMPLATE) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, or of one of its parts."""
    openings = {a: role for role, (a, _) in template.marks.items()}
    turns, role, start = [], None, 0
    for m in template.pattern().finditer(formatted):
        if m[0] in openings:
            role, start = openings[m[0]], m.end()
        elif m[0] == template.other[0]:
            start = m.end()
        elif m[0] == template.other[1]:
            role, start = unescape(formatted[start : m.start()]), m.end()
        elif m[0] not in (template.begin, template.end):
            turns.append((role, unescape(formatted[start : m.start()])))
    return turns


class _Part:
    """A part of a formatted conversation: whole turns, with the opening mark in the first and the closing one in the last."""

    def __init__(self, number: int):
        self.number, self.texts, self.spans, self.size = number, [], [], 0

    def add(self, text: str, learned: bool) -> None:
        if learned:
            self.spans.append({"start": self.size, "length": len(text)})
        self.texts.append(text)
        self.size += len(text)


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, formatted, loss_spans (array of start, length in code points), last, valid, bad_turn of each conversation.

    The input has conv_id, turn, role, text; other columns are ignored. Turns
    that share a number are ordered by role and text, null turns first; null
    roles and texts are empty; rows without conv_id are one conversation. A
    conversation out of order is formatted as it is and marked valid = false.

    A conversation is one row, part 0, unless it is of more than part_chars
    characters: then every so many characters of whole turns are a part, numbered
    from 0, and the formatted conversation is its parts end to end. Spans count
    from the start of their part. valid and bad_turn (of the whole conversation)
    are in its last part, and null in the others. Turns meet in a task in order and go
    through one at a time, so a conversation of any length takes the memory of
    one part.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    turns = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    types = (pa.int32(), pa.string(), spans, pa.bool_(), pa.bool_(), pa.int32())
    names = ["conv_id", "part", "formatted", "loss_spans", "last", "valid", "bad_turn"]

    def write(batches):
        controls = template.pattern()
        done, size = [], 0
        of, conversation, order, part = None, None, None, None

        def rows():
            columns = [pa.array([r[k + 1] for r in done], t) for k, t in enumerate(types)]
            return pa.record_batch([pa.array([r[0] for r in done], of), *columns], names)

        def close(last):
            if last:
                part.add(template.end, False)
            done.append((conversation[0], part.number, "".join(part.texts), part.spans, last, *((order.valid, order.bad_turn) if last else (None, None))))
            return part.size

        for batch in text_batches(batches, "text"):
            of = batch.schema.field("conv_id").type
            for id, role, said in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conversation is None or not _same(conversation[0], id):
                    if conversation is not None:
                        size += close(True)
                    conversation, order, part = (id,), TurnOrder(), _Part(0)
                    part.add(template.begin, False)
                elif part.size >= part_chars:
                    size += close(False)
                    part = _Part(part.number + 1)
                order.take(role)
                for segment in turn_segments(role, said, template, controls):
                    part.add(*segment)
                if size >= part_chars:
                    yield rows()
                    done, size = [], 0
        if conversation is not None:
            close(True)
            yield rows()

    return ordered.mapInArrow(write, f"conv_id {kind}, part int, formatted string, loss_spans array<struct<start: bigint, length: bigint>>, last boolean, valid boolean, bad_turn int")


def _same(a, b) -> bool:
    """Equal ids; not-a-number is one id."""
    return a == b or (a != a and b != b)


def digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What the formatted conversations say, read back from them: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid.

    Rows may come in any order: they are dealt out by conversation and sorted by
    part. A conversation that lacks a part, or has one twice, is an error.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def read(batches):
        n_turns = loss_chars = chars = due = 0
        said, learned, of = hashlib.sha256(), hashlib.sha256(), None
        for batch in text_batches(batches, "formatted"):
            rows = []
            for id, part, text, spans, last, valid in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "formatted", "loss_spans", "last", "valid")), strict=True):
                if part != due or (due and not _same(of, id)):
                    raise ValueError(f"conversation {of if due else id} has no part {due}, or one part twice")
                of, due = id, 0 if last else due + 1
                for role, turn in parse(text, template):
                    n_turns += 1
                    said.update(f"{role}\n{turn}\n".encode())
                for s in spans:
                    own = unescape(text[s["start"] : s["start"] + s["length"]])
                    loss_chars += len(own)
                    learned.update(own.encode())
                chars += len(text)
                if last:
                    rows.append((id, n_turns, said.hexdigest(), loss_chars, learned.hexdigest(), chars, valid))
                    n_turns = loss_chars = chars = 0
                    said, learned = hashlib.sha256(), hashlib.sha256()
            columns = [pa.array([r[k + 1] for r in rows], t) for k, t in enumerate(types)]
            yield pa.record_batch([pa.array([r[0] for r in rows], batch.schema.field("conv_id").type), *columns], names)
        if due:
            raise ValueError(f"conversation {of} has no last part")

    ordered = formatted.select("conv_id", "part", "formatted", "loss_spans", "last", "valid").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    )
