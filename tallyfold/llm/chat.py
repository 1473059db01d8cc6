"""Chat formatting with a template that is only ever called, never looked into.

The template is rendered over successive prefixes of a conversation. What an output adds
to the one before is the new turn's span; an output that does not begin with the one
before shows a template that rewrites history, and the turn is marked so. Where the text
lies inside its span is found by rendering two probe texts in its place.

Conversations are ordered by ``(conversation, turn)`` inside partitions and walked as a
stream. Whole prefixes are rendered (``context=None``), which takes time with the square of
a conversation's length. A template declared with ``looks_back(n)`` only appends, by at
most ``n`` turns before, and may be given a ``context`` of ``n`` or more turns: then a task
holds those and one batch, whatever the length of a conversation.

Defined results: a null text or role counts as empty; turns of equal number are ordered by
role, then text; a repeated row is one more turn; a null conversation id is a conversation
of its own; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import os.path
import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

# The control strings of the template below.
_CONTROL = r"(?:\[/?INST\]|</?s>|<</?SYS>>|<<ROLE|/ROLE>>)"
_MARK = re.compile(rf"(?<!\\){_CONTROL}")


def escape(text: str) -> str:
    """One backslash more before every control string, and before the backslashes ahead of it."""
    return re.sub(rf"(?=(?<!\\)\\*{_CONTROL})", lambda _: "\\", text)


def unescape(text: str) -> str:
    return re.sub(rf"\\(?=\\*{_CONTROL})(?<!\\\\)", "", text)


def looks_back(turns: int) -> Callable[[Template], Template]:
    """Declares that what a turn adds to the output depends on it and at most so many turns
    before it, and that earlier output is never rewritten."""

    def declare(template: Template) -> Template:
        template.looks_back = turns
        return template

    return declare


@looks_back(0)
def instruction_template(turns: Sequence[Turn]) -> str:
    """Marks every turn by its role; texts are set off by one space at both ends."""
    out = []
    for role, text in turns:
        text = escape(text)
        if role == "user":
            out.append(f"<s>[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f" {text} </s>")
        elif role == "system":
            out.append(f"<<SYS>> {text} <</SYS>>")
        else:
            out.append(f"<<ROLE {len(role)}:{role} {text} /ROLE>>")
    return "".join(out)


def read_turns(formatted: str) -> list[Turn]:
    """Roles and texts read back from what ``instruction_template`` made."""
    turns, at = [], 0
    ends = {"<s>[INST] ": ("user", " [/INST]"), " ": ("assistant", " </s>"), "<<SYS>> ": ("system", " <</SYS>>")}
    while at < len(formatted):
        if formatted.startswith("<<ROLE ", at):
            size, _, _ = formatted[at + 7 :].partition(":")
            begin = at + 7 + len(size) + 1
            role, end = formatted[begin : begin + int(size)], " /ROLE>>"
            begin += int(size) + 1
        else:
            head = next(h for h in ends if formatted.startswith(h, at))
            (role, end), begin = ends[head], at + len(head)
        mark = end[1:]
        stop = next(m.start() for m in _MARK.finditer(formatted, begin - 1) if m[0] == mark and m.start() > begin - 1)
        turns.append((role, unescape(formatted[begin : stop - 1])))
        at = stop + len(mark)
    return turns


class Span(NamedTuple):
    """What a turn added to the output, and where its text lies in it."""

    added: str
    start: int
    end: int
    rewrites: bool


def locate(template: Template, before: Sequence[Turn], turn: Turn) -> Span:
    """Span of ``turn`` after the turns ``before``."""
    old = template(before) if before else ""
    new = template([*before, turn])
    if not new.startswith(old):
        shared = len(os.path.commonprefix([old, new]))
        return Span(new[shared:], 0, 0, True)
    added = new[len(old) :]
    probes = [template([*before, (turn[0], text)])[len(old) :] for text in ("", "0", "1")]
    start = len(os.path.commonprefix(probes[1:]))
    length = len(added) - len(probes[0])
    if length < 0 or len(probes[1]) != len(probes[0]) + 1:  # the text does not stand there as it is
        return Span(added, 0, 0, False)
    return Span(added, start, start + length, False)


FORMATTED = "conv_id long, turn long, role string, formatted string, text_start int, text_end int, trained boolean, rewrites boolean"


def format_turns(
    conversations: DataFrame,
    template: Template = instruction_template,
    context: int | None = None,
    trained_roles: Sequence[str] = ("assistant",),
) -> DataFrame:
    """One row per turn, in order inside its partition: the piece of output it adds, the
    place of its text in that, whether that text is under the loss mask, and whether the
    template rewrote earlier output there. ``context`` needs a template that looks back no
    further; without it whole prefixes are rendered."""
    if context is not None and context < getattr(template, "looks_back", float("inf")):
        raise ValueError("a context needs a template declared to look back no further")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[Turn] = []
        last: object = run
        for batch in batches:
            ids, turns, roles, texts = (batch.column(i).to_pylist() for i in range(4))
            rows = []
            for conv, number, role, text in zip(ids, turns, roles, texts, strict=True):
                if conv != last:
                    before, last = [], conv
                turn = (role or "", text or "")
                span = locate(template, before, turn)
                rows.append((conv, number, turn[0], span.added, span.start, span.end, turn[0] in trained_roles and not span.rewrites, span.rewrites))
                before.append(turn)
                if context is not None:
                    before = before[len(before) - context :]
            yield _table(rows, FORMATTED)

    return (
        conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, FORMATTED)
    )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the pieces of ``format_turns`` in their order, read
    back by ``read_turns``: a stream that keeps digests, not texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (
            piece
            for batch in batches
            for piece in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "text_start", "text_end", "trained")), strict=True)
        )
        rows = []
        for conv, own in itertools.groupby(pieces, key=lambda piece: piece[0]):
            turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, start, end, trained in own:
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                if trained:
                    said = unescape(text[start:end])
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
            rows.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(rows) == 1000:
                yield _table(rows, DIGESTS)
                rows = []
        yield _table(rows, DIGESTS)

    return formatted.mapInArrow(run, DIGESTS)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )
