"""Chat formatting with typed content parts (operator 1).

A message is a list of parts: text, image, audio or document. A visitor walks them in order and
flattens them into one string: text is escaped, every other part becomes a numbered placeholder, is
recorded as an attachment (kind, reference, number) and counts the tokens it expands to. The
template wraps each message in turn marks. Spans of assistant text, in code points of the formatted
message, form the loss mask.

Escaping is reversible: a backslash is doubled, and a control string gets a backslash behind its first
sign, so no control string is left inside a text; reading takes the sign after each backslash as it
is. Neighbouring text parts are escaped as one text, so no control string arises where they meet. In roles a line end is escaped too, for it ends the header.

A conversation is a stream of formatted messages in the order of its turns; nothing holds a whole
one. Messages are dealt by conversation, sorted by turn, and folded as they pass, so memory holds
one batch whatever the length; the fold of one conversation is sequential, as its digests are.

Edge cases: null text, parts, roles, references and sizes count as empty or 0; a part of an unknown
kind is a document; null turns come first; rows that tie on the turn go by role, then text; rows
repeated in full are turns of their own; rows with a null conversation form one; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared as sh

TURN, END = "<|turn|>", "<|end|>"
#: Strings that a chat model may read as control; none is left inside a text.
CONTROLS = [TURN, END, "<|image:", "<|audio:", "<|document:", "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ESCAPE = re.compile(r"(?=(?:" + "|".join(map(re.escape, CONTROLS)) + r"))(.)|\\", re.S)
_UNESCAPE = re.compile(r"\\(.)", re.S)
_MARK = re.compile(r"<\|(image|audio|document):(\d+)\|>")
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,number:int,tokens:bigint>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[1] + "\\" if m[1] else "\\\\", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class Sizes:
    """Tokens that attachments expand to."""

    patch: int = 14
    audio_a_second: float = 12.5
    page: int = 256


@dataclass
class Visitor:
    """Flattens parts in order; ``out`` is the text so far, ``spans`` its stretches of own text."""

    sizes: Sizes = field(default_factory=Sizes)
    out: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    waiting: list[str] = field(default_factory=list)

    def put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        self.waiting.append(part.get("text") or "")

    def close_text(self) -> None:
        """Puts out the text parts since the last placeholder, escaped as one."""
        text = escape("".join(self.waiting))
        self.waiting.clear()
        if text:
            self.spans.append((self.length, self.length + len(text)))
            self.put(text)

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil((part.get(k) or 0) / self.sizes.patch) for k in ("width", "height"))
        self.attach("image", part, max(1, across * down))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.sizes.audio_a_second)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part.get("pages") or 0) * self.sizes.page)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.close_text()
        number = len(self.attachments)
        self.attachments.append({"kind": kind, "ref": part.get("ref") or "", "number": number, "tokens": tokens})
        self.put(f"<|{kind}:{number}|>")


def format_message(role: str | None, parts: list[dict], sizes: Sizes | None = None) -> tuple[str, list[tuple[int, int]], list[dict]]:
    """The formatted message, the loss spans in it and its attachments."""
    head = f"{TURN}{escape_role(role or '')}\n"
    v = Visitor(sizes or Sizes())
    for p in parts:
        v.visit(p or {})
    v.close_text()
    spans = [(i + len(head), j + len(head)) for i, j in v.spans] if role == "assistant" else []
    return head + "".join(v.out) + END + "\n", spans, v.attachments


def read_message(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted message; placeholders are left out of the text."""
    if not formatted.startswith(TURN) or not formatted.endswith(END + "\n"):
        raise ValueError("not a formatted message")
    body = formatted[len(TURN) : -len(END) - 1]
    header = re.match(r"(?:[^\\\n]|\\.)*", body, re.S)[0]
    return unescape(header), unescape(_MARK.sub("", body[len(header) + 1 :]))


def text_part(text: Column) -> Column:
    """A plain text as a list of one part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in none.items()]))


def format_messages(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", sizes: Sizes | None = None) -> DataFrame:
    """One row per message: conv, turn, role, formatted, loss spans, attachments, attachment tokens. No shuffle."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (conv, turn)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [format_message(r, p or [], sizes) for r, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            spans = [[{"start": i, "stop": j} for i, j in s] for _, s, _ in done]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    b.column(2),
                    pa.array([f for f, _, _ in done], pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                    pa.array([a for _, _, a in done], pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("number", pa.int32()), ("tokens", pa.int64())]))),
                    pa.array([sum(x["tokens"] for x in a) for _, _, a in done], pa.int64()),
                ],
                [conv, turn, role, "formatted", "loss", "attachments", "attachment_tokens"],
            )

    schema = f"`{conv}` {kinds[conv]}, `{turn}` {kinds[turn]}, `{role}` string, formatted string, loss array<struct<start:int,stop:int>>, attachments array<{ATTACHMENT}>, attachment_tokens bigint"
    return df.select(conv, turn, role, parts).mapInArrow(run, schema)


def digest_conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role") -> DataFrame:
    """One row per conversation, read back from its formatted messages in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> list:
            key, n, turns, loss, loss_chars, chars = state
            return [key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]

        def pack(rows: list[list]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            kind = b.schema.field(0).type
            rows = []
            for key, formatted, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if state is None or key != current:
                    if state is not None:
                        rows.append(row())
                    current, state = key, [key, 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                role_read, text = read_message(formatted)
                state[1] += 1
                state[2].update(f"{role_read}\n{text}\n".encode())
                for s in spans or []:
                    learned = unescape(formatted[s["start"] : s["stop"]])
                    state[3].update(learned.encode())
                    state[4] += len(learned)
                state[5] += len(formatted)
            if rows:
                yield pack(rows)
        if state is not None:
            yield pack([row()])

    kind = messages.schema[conv].dataType.simpleString()
    ordered = sh.dealt(messages, conv, order=(turn, role, "formatted")).select(conv, "formatted", "loss")
    return ordered.mapInArrow(run, f"`{conv}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
