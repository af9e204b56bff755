"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

Rows are dealt by conversation and sorted by turn; the machine then streams
over them with a constant amount of state, so a conversation of any length
costs no memory. The reader takes the formatted segments apart again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ESCAPE = "\\"
INVALID = "invalid"


@dataclass(frozen=True)
class Template:
    """How turns look, which may follow which, and on whose text the loss is taken.

    A turn is ``open + role + role_end + text + close``. ``control`` strings may
    not appear in a text as they are; inside one, an escape character is put
    after the first character of each. No control string may hold a second one
    or overlap the next, so that this can be undone exactly.
    """

    open: str = "<|im_start|>"
    role_end: str = "\n"
    close: str = "<|im_end|>\n"
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    transitions: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user", "tool": "tool"},
        "tool": {"assistant": "assistant"},
    })

    def __post_init__(self) -> None:
        for a in self.control:
            for b in self.control:
                if a != b and a in b or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
            if len(a) < 2 or ESCAPE in a:
                raise ValueError(f"control string {a!r} cannot be escaped")

    @cached_property
    def _hidden(self) -> re.Pattern:
        return re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(ESCAPE)}*{re.escape(c[1:])})" for c in self.control))

    @cached_property
    def _shown(self) -> re.Pattern:
        return re.compile("|".join(
            f"(?<={re.escape(c[0])}){re.escape(ESCAPE)}(?={re.escape(ESCAPE)}*{re.escape(c[1:])})" for c in self.control))

    def escape(self, text: str) -> str:
        """No control string is left, whatever the text holds."""
        return self._hidden.sub(lambda _: ESCAPE, text)

    def unescape(self, text: str) -> str:
        return self._shown.sub("", text)

    def head(self, role: str) -> str:
        name = role.replace("\\", "\\\\").replace("\n", "\\n")
        return self.open + self.escape(name) + self.role_end

    def role(self, name: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(name))

    def step(self, state: str, role: str) -> str:
        return self.transitions.get(state, {}).get(role, INVALID)


_SEGMENT = "conv string, turn_no long, segment int, text string, loss boolean, state string"


def format_segments(turns: DataFrame, template: Template, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn_no, segment, text, loss, state): the formatted text in order, with a loss flag per segment.

    Each turn gives three segments: its head, its escaped text, its end.
    ``state`` is the machine's after the turn; from the first turn that may not
    follow, it is ``invalid`` to the end, and the turns are formatted all the same.
    Null roles and texts are empty ones, turns with equal numbers follow each
    other by role and text, rows with a null conversation make up one, and
    further columns are dropped. Rows of a conversation lie together and in order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, number = (), template.start, 0
        for batch in batches:
            rows = []
            for key, who, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (key,) != last:
                    last, state, number = (key,), template.start, 0
                state = template.step(state, who)
                parts = ((template.head(who), False), (template.escape(body), who in template.loss), (template.close, False))
                rows += [(key, number, i, part, flag, state) for i, (part, flag) in enumerate(parts)]
                number += 1
            columns = zip(*rows) if rows else [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "turn_no", "segment", "text", "loss", "state"])

    rows = turns.select(
        F.col(conv).cast("string").alias("conv"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(turn).alias("turn"))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return dealt.select("conv", "role", "text").mapInArrow(run, _SEGMENT)


class _Reader:
    """Takes one conversation's formatted text apart again, segment by segment."""

    def __init__(self, template: Template) -> None:
        self.template, self.rest, self.turns, self.chars = template, "", 0, 0
        self.all, self.masked, self.masked_chars, self.bad_turn = hashlib.sha256(), hashlib.sha256(), 0, None

    def feed(self, text: str, loss: bool, state: str) -> None:
        t = self.template
        self.chars += len(text)
        if loss:
            plain = t.unescape(text)
            self.masked.update(plain.encode())
            self.masked_chars += len(plain)
        if state == INVALID and self.bad_turn is None:
            self.bad_turn = self.turns
        self.rest += text
        while self.rest.startswith(t.open) and (end := self.rest.find(t.close)) >= 0:
            name, _, body = self.rest[len(t.open):end].partition(t.role_end)
            self.all.update(f"{t.role(name)}\n{t.unescape(body)}\n".encode())
            self.rest, self.turns = self.rest[end + len(t.close):], self.turns + 1

    def row(self, conv: str | None) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {conv} does not end with a turn")
        return (conv, self.turns, self.all.hexdigest(), self.masked_chars, self.masked.hexdigest(), self.chars,
                self.bad_turn is None, self.bad_turn)


def read_back(segments: DataFrame, template: Template) -> DataFrame:
    """Per conversation what its formatted segments say: turns, loss text, lengths and validity.

    (conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid, first_bad_turn); the input is that of :func:`format_segments`, in its order.
    """
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "first_bad_turn"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, reader, rows = None, None, []

        def batch_of() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for key, text, loss, state in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (key,) != last:
                    if reader:
                        rows.append(reader.row(last[0]))
                    last, reader = (key,), _Reader(template)
                reader.feed(text, loss, state)
            if rows:
                yield batch_of()
                rows.clear()
        if reader:
            rows.append(reader.row(last[0]))
            yield batch_of()

    return segments.select("conv", "text", "loss", "state").mapInArrow(run, (
        "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "valid boolean, first_bad_turn long"))


def formatted(segments: DataFrame) -> DataFrame:
    """(conv, text, loss_spans): a conversation per row, for conversations that fit one; spans are (start, end) code points."""
    parts = F.array_sort(F.collect_list(F.struct("turn_no", "segment", "text", "loss")))
    step = lambda a, p: F.struct(
        (a["at"] + F.char_length(p["text"])).alias("at"),
        F.when(p["loss"], F.concat(a["spans"], F.array(F.struct(
            a["at"].alias("start"), (a["at"] + F.char_length(p["text"])).alias("end"))))).otherwise(a["spans"]).alias("spans"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return segments.groupBy("conv").agg(parts.alias("p")).select(
        "conv", F.array_join("p.text", "").alias("text"), F.aggregate("p", none, step)["spans"].alias("loss_spans"))
