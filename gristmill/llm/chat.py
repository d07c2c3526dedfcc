"""Chat formatting: a finite-state machine over roles and a declarative template.

Every turn becomes three segments: its opening mark, its text, its closing mark. Each
segment says whether it counts for the loss. Control strings inside texts are escaped, so
that the marks can be told from the texts and the conversation can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks per role, the roles whose texts are learned, and the permitted turn order.

    ``order`` maps a state to the roles that may follow and the state each leads to. Roles
    without marks of their own are written as ``other[0] + role + other[1] + text +
    other[2]``. A backslash after the first character of a control string, and another
    before a backslash, make texts safe; ``unescape`` undoes both.
    """

    marks: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    learned: frozenset[str]
    order: dict[str, dict[str, str]]
    start: str = "start"
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        controls = [m for pair in self.marks.values() for m in pair] + list(self.other)
        for a in controls:
            if not a or "\\" in a:
                raise ValueError(f"not a control string: {a!r}")
            for b in controls:
                tails = [a[k:] for k in range(1, len(a))]
                if any(b.startswith(t) or t.startswith(b) for t in tails):
                    raise ValueError(f"control strings may not overlap: {a!r}, {b!r}")
        if len({p[0] for p in self.marks.values()} | {self.other[0]}) <= len(self.marks):
            raise ValueError("opening marks must differ")
        object.__setattr__(self, "controls", tuple(dict.fromkeys(controls)))

    def _starts(self) -> re.Pattern:
        return re.compile("(?=" + "|".join(map(re.escape, self.controls)) + r")(.)|\\", re.S)

    def escape(self, text: str) -> str:
        return self._starts().sub(lambda m: m.group() + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        # Of two backslashes one stays; a single one is a mark.
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        if role in self.marks:
            opening, closing = self.marks[role]
        else:
            opening, closing = self.other[0] + self.escape(role) + self.other[1], self.other[2]
        return [(opening, False), (self.escape(text), role in self.learned), (closing, False)]

    def read(self, text: str, at: int) -> tuple[str, str, int] | None:
        """Role, text and end of the turn that begins at ``at``; None if it is not complete."""
        if text.startswith(self.other[0], at):
            middle = text.find(self.other[1], at)
            end = text.find(self.other[2], middle) if middle >= 0 else -1
            if end < 0:
                return None
            role = self.unescape(text[at + len(self.other[0]):middle])
            return role, self.unescape(text[middle + len(self.other[1]):end]), end + len(self.other[2])
        for role, (opening, closing) in self.marks.items():
            if text.startswith(opening, at):
                end = text.find(closing, at + len(opening))
                if end < 0:
                    return None
                return role, self.unescape(text[at + len(opening):end]), end + len(closing)
        raise ValueError("no turn begins here")


#: A system turn may open the conversation; then user and assistant alternate, with tool turns between.
DEFAULT = Template(
    marks={
        "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"),
        "assistant": ("<s>", "</s>"), "tool": ("[TOOL]", "[/TOOL]"),
    },
    other=("<role>", "</role>", "<end>"),
    learned=frozenset({"assistant"}),
    order={
        "start": {"system": "opened", "user": "asked"},
        "opened": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked", "tool": "asked"},
    },
)


#: The same order as a pattern over one letter a turn.
DEFAULT_ORDER = "s|s?u(a[ut])*a?"


class _Format:
    """mapInArrow over turns in order: segments, with the state of the machine carried on."""

    names = ["conv_id", "segment", "text", "loss", "in_order"]
    schema = "conv_id long, segment long, text string, loss boolean, in_order boolean"

    def __init__(self, template: Template):
        self.template = template

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, last, state, number = self.template, (), self.template.start, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv,) != last:
                    last, state, number = (conv,), t.start, 0
                state = t.order.get(state, {}).get(role)
                for piece, loss in t.segments(role, text):
                    out.append((conv, number, piece, loss, state is not None))
                    number += 1
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], self.names)


def format_chat(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """``conv_id, segment, text, loss, in_order``: three segments per turn, numbered.

    Turns are ordered by ``turn`` (null first), then role, then text, so ties and repeated
    rows have a fixed place. A null text or role is empty; rows without ``conv_id`` are one
    conversation. ``in_order`` is false from the first turn that the machine does not
    permit to the end of its conversation; such turns are formatted all the same, and the
    caller decides. An empty table gives an empty result; other columns are not read.

    Conversations meet in one task as a sorted stream of which one batch is in memory at a
    time, so their length is not bounded.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(_Format(template), _Format.schema)


class _ReadBack:
    """mapInArrow over segments in order: one row per conversation, from its formatted text."""

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, in_order boolean")

    def __init__(self, template: Template):
        self.template = template

    def _turns(self, state: dict) -> None:
        at, text = 0, state["text"]
        while at < len(text) and (found := self.template.read(text, at)):
            role, said, at = found
            state["turns"] += 1
            state["all"].update(f"{role}\n{said}\n".encode())
        state["text"] = text[at:]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())

        def end(state: dict) -> list:
            if state["text"]:
                raise ValueError("a conversation ends inside a turn")
            return [state["conv"], state["turns"], state["all"].hexdigest(), state["chars"],
                    state["loss"].hexdigest(), state["size"], state["ok"]]

        def rows(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], self.names)

        for batch in batches:
            out = []
            for conv, text, loss, ok in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        out.append(end(state))
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(),
                             "chars": 0, "size": 0, "text": "", "ok": True}
                state["size"] += len(text)
                state["ok"] = state["ok"] and ok
                if loss:
                    said = self.template.unescape(text)
                    state["chars"] += len(said)
                    state["loss"].update(said.encode())
                state["text"] += text
                # A turn may end with a segment that ends with a closing mark.
                if text.endswith(tuple(c for _, c in self.template.marks.values()) + self.template.other[2:]):
                    self._turns(state)
            if out:
                yield rows(out)
        if state is not None:
            yield rows([end(state)])


def read_back(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Conversations parsed again from the text of their segments, with digests.

    Turns are found by their marks alone. ``loss_*`` are about the unescaped text under
    the loss flags. Memory holds one turn at a time.
    """
    rows = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return rows.select("conv_id", "text", "loss", "in_order").mapInArrow(_ReadBack(template), _ReadBack.schema)


def chat_sql(conversations: str, template: Template = DEFAULT) -> str:
    """DuckDB SQL of the digests: escapes are counted, not made; the order is that of the default template."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    marks = lambda x: " + ".join(
        [f"(length({x}) - length(replace({x}, '\\', '')))"]
        + [f"(length({x}) - length(replace({x}, {quote(c)}, ''))) // {len(c)}" for c in template.controls])
    plain = " ".join(f"WHEN {quote(r)} THEN {len(a) + len(b)}" for r, (a, b) in template.marks.items())
    order = "turn NULLS FIRST, role, text"
    learned = "role IN (" + ", ".join(map(quote, sorted(template.learned))) + ")"
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({conversations})),
sized AS (SELECT *, length(text) + {marks("text")} + CASE role {plain}
  ELSE {sum(map(len, template.other))} + length(role) + {marks("role")} END AS n FROM turns)
SELECT conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {order})) turns_sha256,
  coalesce(sum(length(text)) FILTER ({learned}), 0)::BIGINT loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY {order}) FILTER ({learned}), '')) loss_sha256,
  sum(n)::BIGINT formatted_chars, regexp_full_match(string_agg(CASE WHEN role IN ('system', 'user', 'assistant', 'tool')
  THEN role[1] ELSE 'x' END, '' ORDER BY {order}), '{DEFAULT_ORDER}') in_order FROM sized GROUP BY conv_id"""
