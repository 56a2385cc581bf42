"""Chat formatting: a state machine over roles, a declarative template, loss flags."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id long, turn_no long, seg_no long, text string, loss boolean, order_ok boolean"
READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles that bear loss, and the turns that may follow.

    ``turns`` maps a state to the roles allowed next; the role is the next state.
    A conversation is valid when every step is allowed and it ends in ``final``.
    """

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    loss_roles: frozenset = frozenset({"assistant"})
    turns: dict = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: frozenset = frozenset({"assistant"})

    def __post_init__(self):
        if not (self.start.startswith("<|") and self.end.startswith("<|")):
            raise ValueError("marks have to begin with <|, which texts never contain once escaped")
        if self.end.startswith(self.start) or self.start.startswith(self.end):
            raise ValueError("the marks have to differ")
        if self.after_role != "\n":
            raise ValueError("a role ends with its line")


CHAT = Template()

_OPEN = re.compile(r"<(\\*)\|")
_OPENED = re.compile(r"<\\(\\*)\|")
_ROLE = {"\\\\": "\\", "\\n": "\n"}


def escape(text: str) -> str:
    """Put one more backslash into every ``<|``, ``<\\|``, ...: no ``<|`` is left."""
    return _OPEN.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\n]", lambda m: _ROLE[m[0]], unescape(role))


def _format(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("seg_no", pa.int64()),
                        ("text", pa.string()), ("loss", pa.bool_()), ("order_ok", pa.bool_())])
    conv, state, turn, begun = None, "", 0, False
    for batch in batches:
        rows = []
        for conv_id, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if not begun or conv_id != conv:
                conv, state, turn, begun = conv_id, "", 0, True
            ok = role in template.turns.get(state, ())
            loss = role in template.loss_roles
            head = f"{template.start}{escape_role(role)}{template.after_role}"
            for k, (part, flag) in enumerate(((head, False), (escape(text), loss), (template.end, False))):
                rows.append((conv_id, turn, 3 * turn + k, part, flag, ok))
            state, turn = role, turn + 1
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )


def format_conversations(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """Text segments of every conversation, in order, with a loss flag for each.

    Turns of a conversation go to one partition and are sorted there by turn, role
    and text (so equal turn numbers have a fixed order); the state machine then runs
    over the sorted rows as a stream, so a conversation of any length needs the
    memory of one batch. Per turn: the opening mark with the role, the escaped text,
    the closing mark. ``order_ok`` says whether the role may follow the one before;
    turns out of order are formatted all the same. Null role or text: empty; null
    conv_id: one conversation of its own; null turn: first. Other columns are ignored.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(lambda it: _format(it, template), SEGMENTS)


class _Reader:
    """Reads one conversation from pieces of its formatted text."""

    def __init__(self, conv_id, template: Template):
        self.conv_id, self.template = conv_id, template
        self.turns = self.loss_chars = self.chars = 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()
        self.pending: list[str] = []
        self.state, self.valid = "", True

    def feed(self, text: str, loss: bool) -> None:
        self.chars += len(text)
        self.pending.append(text)
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        if text.endswith(self.template.end):
            self._turn()

    def _turn(self) -> None:
        whole = "".join(self.pending)
        start, end = self.template.start, self.template.end
        if not whole.startswith(start) or whole.count("<|") != 2:
            raise ValueError(f"conversation {self.conv_id}: turn {self.turns} is not framed by its marks")
        role, _, text = whole[len(start) : -len(end)].partition(self.template.after_role)
        role, text = unescape_role(role), unescape(text)
        self.digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.valid &= role in self.template.turns.get(self.state, ())
        self.state = role
        self.turns += 1
        self.pending = []

    def row(self):
        if self.pending:
            raise ValueError(f"conversation {self.conv_id}: the last turn has no end")
        return (self.conv_id, self.turns, self.digest.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars, self.valid and self.state in self.template.final)


def _read(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64()), ("valid", pa.bool_())])
    reader: _Reader | None = None
    done = []

    def flush():
        columns = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for conv_id, text, loss in zip(*(batch[c].to_pylist() for c in ("conv_id", "text", "loss"))):
            if reader is None or conv_id != reader.conv_id:
                if reader is not None:
                    done.append(reader.row())
                reader = _Reader(conv_id, template)
            reader.feed(text, loss)
        if done:
            yield flush()
            done = []
    if reader is not None:
        done.append(reader.row())
        yield flush()


def read_back(segments: DataFrame, template: Template = CHAT, in_order: bool = False) -> DataFrame:
    """Parse formatted segments back to turns: counts and digests per conversation.

    ``in_order`` says that the segments come straight from :func:`format_conversations`,
    each conversation whole and sorted in its partition; a stored table is dealt and
    sorted again. A turn that is not framed by its marks is an error.
    """
    rows = segments.select("conv_id", "seg_no", "text", "loss")
    if not in_order:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seg_no")
    return rows.mapInArrow(lambda it: _read(it, template), READ_BACK)
