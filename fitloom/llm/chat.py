"""Chat transcripts with typed content parts, formatted for training and read back.

Each turn is formatted on its own: a visitor flattens its parts into text and numbered
placeholders, records what every placeholder refers to and how many tokens it will expand
to, and escapes control strings inside texts. A conversation is the concatenation of its
turns in order; the loss mask covers what the assistant says.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Tokens of an image tile of 14 by 14 pixels, of a second of audio, of a document page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 256
#: Control strings of this and other templates, without their first character.
_CONTROL = r"(\||/?s>|/?INST\]|</?SYS>>)"
_OPEN = re.compile(r"([<\[])(\\*)" + _CONTROL)
_CLOSED = re.compile(r"([<\[])\\(\\*)" + _CONTROL)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document) (\d+)\|>")
_FORMATTED = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(BODY) + r"(.*?)" + re.escape(END), re.DOTALL)

PART = "struct<kind:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>"


def escape(text: str) -> str:
    """The text with a backslash inside every control string; those that have some get one more."""
    return _OPEN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"\1\2\3", text)


@dataclass
class Visitor:
    """Flattens the parts of one turn in order."""

    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown part kind: {kind}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        across, down = (-(-max(part.get(side) or PATCH, 1) // PATCH) for side in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, -(-int((part.get("seconds") or 0.0) * 1000) * AUDIO_RATE // 1000))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(part.get("pages") or 1, 1) * PAGE_TOKENS)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments) + 1
        self.attachments.append({"n": n, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self.out.append((kind, n))

    def formatted(self, role: str) -> str:
        """The turn; texts next to each other are escaped together, as they are read back."""
        pieces, text = [], ""
        for piece in [*self.out, None]:
            if isinstance(piece, str):
                text += piece
            else:
                pieces.append(escape(text))
                text = ""
                if piece:
                    pieces.append(f"<|{piece[0]} {piece[1]}|>")
        return f"{TURN}{escape(role)}{BODY}{''.join(pieces)}{END}"


def read_back(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and start and end of the text within ``formatted``, for every turn.

    Placeholders are no text; the parts around them are joined.
    """
    for m in _FORMATTED.finditer(formatted):
        text = "".join(unescape(t) for t in _PLACEHOLDER.split(m[2])[::3])
        yield unescape(m[1]), text, m.start(2), m.end(2)


_TURN = "struct<formatted:string,attachments:array<struct<n:int,kind:string,ref:string,tokens:long>>,loss:boolean>"


def format_turn(role: Column, parts: Column) -> Column:
    """Struct of one formatted turn, its attachments, and whether the loss mask covers its text."""
    attachment = pa.struct([("n", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
    kind = pa.struct([("formatted", pa.string()), ("attachments", pa.list_(attachment)), ("loss", pa.bool_())])

    @F.arrow_udf(_TURN)
    def told(roles: pa.Array, contents: pa.Array) -> pa.Array:
        rows = []
        for who, content in zip(roles.to_pylist(), contents.to_pylist(), strict=True):
            visitor = Visitor()
            for part in content or ():
                visitor.visit(part or {})
            rows.append({"formatted": visitor.formatted(who or ""), "attachments": visitor.attachments, "loss": who == "assistant"})
        return pa.array(rows, kind)

    return told(role, parts)


def text_part(text: Column) -> Column:
    """A text as the only part of a turn."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))).cast("array<struct<kind:string,text:string>>")


def formatted_turns(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, formatted, attachments, loss)`` for every row of ``rows(conv_id, turn,
    role, parts)``; nothing is shuffled. A null role is empty, null parts are none."""
    return rows.select("conv_id", "turn", format_turn(F.col("role"), F.col("parts")).alias("f")).select("conv_id", "turn", "f.*")


_CONVERSATION = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attachment_tokens long"


def digests(turns: DataFrame) -> DataFrame:
    """One row for each conversation of :func:`formatted_turns`, read back turn by turn.

    Turns go in the order of ``turn``, ties by their formatted text. A digest needs the turns
    of its conversation one after the other, so a conversation is one task's; the task streams
    them and holds two hash states, however long the conversation is. Null ids are one
    conversation.
    """
    names = [x.split()[0] for x in _CONVERSATION.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for part in batches:
            done = []
            for conv, formatted, loss, tokens in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if state is None or conv != now:
                    if state:
                        done.append(_finished(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text, _, _ in read_back(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if loss:
                        state[2] += len(text)
                        state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(formatted)
                state[5] += tokens or 0
            yield batch(done)
        yield batch([_finished(now, state)] if state else [])

    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    rows = turns.select("conv_id", "turn", "formatted", "loss", tokens.alias("tokens"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return rows.select("conv_id", "formatted", "loss", "tokens").mapInArrow(run, _CONVERSATION)


def _finished(conv: int | None, state: list) -> tuple:
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]
