"""Chat formatting: typed content parts, flattened by a visitor into one marked-up string a conversation.

A turn is written as ``### {role}`` NEWLINE ``{content}</turn>`` NEWLINE. Inside roles and contents a backslash escapes
what would read as markup: ``\\``, ``###``, ``</turn>``, ``<|`` and, in roles, a line break (written ``\\n``). The
scanner reads from left to right and takes an escape whole, so writing and reading back are exact inverses for every
text. Parts other than text become placeholders ``<|kind:ordinal|>`` in their order; their references and token
counts are recorded beside the text.

A conversation is never gathered in one place: turns are formatted row by row, dealt by conversation, sorted, and
streamed. What leaves the operator are *pieces* of at most ``piece_chars`` characters plus one turn, in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

HEAD, END = "### ", "</turn>\n"
_ESCAPE = re.compile(r"\\|###|</turn>|<\|")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>|<\||n)")
#: One turn of formatted text: role, then content up to the first end mark that isn't escaped.
_TURN = re.compile(r"### ((?:\\(?:\\|###|</turn>|<\||n)|[^\\\n])*)\n((?:\\(?:\\|###|</turn>|<\|)|(?!</turn>)[^\\])*+)</turn>\n", re.S)
_PLACE = re.compile(r"\\(?:\\|###|</turn>|<\|)|<\|(image|audio|document|other):(\d+)\|>", re.S)

#: Tokens that one unit of a part stands for once it is expanded: an image tile, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}

#: Kinds of parts that have a visit of their own.
KINDS = ("text", *TOKENS_PER_UNIT)
PART_TYPE = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: str, role: bool = False) -> str:
    """Text with its control strings escaped; ``unescape`` is the inverse."""
    out = _ESCAPE.sub(lambda m: "\\" + m[0], text)
    return out.replace("\n", "\\n") if role else out


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


@dataclass
class Flattener:
    """Visits the parts of one message in order and gathers its content, attachments and expanded tokens."""

    out: list[str] = field(default_factory=list)
    refs: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}" if kind in KINDS else "visit_other")(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def attach(self, part: dict) -> None:
        kind, units = part["kind"], max(0, part.get("units") or 0)
        self.out.append(f"<|{kind}:{len(self.refs)}|>")
        self.refs.append({"kind": kind, "ordinal": len(self.refs), "ref": part.get("ref"), "tokens": max(1, units) * TOKENS_PER_UNIT[kind]})

    visit_image = visit_audio = visit_document = attach

    def visit_other(self, part: dict) -> None:
        """A kind that the template doesn't know: a placeholder that stands for no tokens; its kind and reference are recorded."""
        self.out.append(f"<|other:{len(self.refs)}|>")
        self.refs.append({"kind": part["kind"], "ordinal": len(self.refs), "ref": part.get("ref"), "tokens": 0})


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, int, int, list[dict]]:
    """(formatted turn, start and end of its content within it, attachments)."""
    f = Flattener()
    for p in parts or ():
        if p is not None:
            f.visit(p)
    head, body = f"{HEAD}{escape(role or '', role=True)}\n", "".join(f.out)
    return head + body + END, len(head), len(head) + len(body), f.refs


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, content still escaped, its start and end) of each turn of a formatted text."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        yield unescape(m[1]), m[2], m.start(2), m.end(2)
        at = m.end()


def attachments(content: str) -> list[tuple[str, int]]:
    """Placeholders (kind, ordinal) of an escaped content, in order; escaped look-alikes are text."""
    return [(m[1], int(m[2])) for m in _PLACE.finditer(content) if m[1]]


PIECES = "conv_id long, piece long, first_turn boolean, formatted string, n_turns long, loss array<struct<start:int,end:int>>, attachments array<struct<turn:long,kind:string,ordinal:int,ref:string,tokens:long>>, tokens_expanded long"
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ATTACHED = pa.list_(pa.struct([("turn", pa.int64()), ("kind", pa.string()), ("ordinal", pa.int32()), ("ref", pa.string()), ("tokens", pa.int64())]))
_PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("first_turn", pa.bool_()), ("formatted", pa.string()), ("n_turns", pa.int64()), ("loss", _LOSS), ("attachments", _ATTACHED), ("tokens_expanded", pa.int64())])


def format_conversations(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), piece_chars: int = 1 << 20) -> DataFrame:
    """Formats messages (conv_id long, turn long, role string, text string and/or parts PART_TYPE) by conversation.

    Returns PIECES: the pieces of a conversation, numbered from 0, join to its formatted text; ``loss`` has the
    code-point spans, within the piece, of the contents whose role is in ``loss_roles``; attachments have the turn's
    position, kind, ordinal, reference and expanded tokens. Turns go by ``turn`` (nulls first), ties by role and text.
    Null text or parts: an empty content; null role: an empty role; null conv_id: a conversation of its own; parts of an
    unknown kind: placeholders ``other`` of no tokens; units below 1: one unit. Texts are taken whole, however long. Other
    columns are ignored; repeated rows are repeated turns; an empty table gives no rows. One task holds a piece, never
    a conversation.
    """
    text_part = F.struct(F.lit("text").alias("kind"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"))
    if "parts" not in messages.columns:
        parts = F.array(text_part)
    elif "text" not in messages.columns:
        parts = F.col("parts")
    else:
        parts = F.coalesce(F.col("parts"), F.array(text_part))
    keys = ["turn", "role", *[c for c in ("text",) if c in messages.columns]]
    dealt = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", parts.cast(PART_TYPE).alias("parts"), *[F.col(c) for c in keys[2:]])
    dealt = dealt.repartition("conv_id").sortWithinPartitions("conv_id", *keys).select("conv_id", "role", "parts")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, piece, turn, rows, size = object(), 0, 0, [], 0
        buf: list[str] = []
        loss: list[dict] = []
        refs: list[dict] = []
        width = turns = 0
        started = False

        def close() -> None:
            nonlocal buf, loss, refs, width, turns, piece
            rows.append({"conv_id": now, "piece": piece, "first_turn": piece == 0, "formatted": "".join(buf), "n_turns": turns, "loss": loss, "attachments": refs, "tokens_expanded": sum(r["tokens"] for r in refs)})
            buf, loss, refs, width, turns, piece = [], [], [], 0, 0, piece + 1

        for b in it:
            for conv, role, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if not started or conv != now:
                    if turns:
                        close()
                    now, piece, turn, started = conv, 0, 0, True
                out, start, end, found = format_turn(role, content)
                if role in loss_roles:
                    loss.append({"start": width + start, "end": width + end})
                refs += [r | {"turn": turn} for r in found]
                buf.append(out)
                width, turns, turn, size = width + len(out), turns + 1, turn + 1, size + len(out)
                if width >= piece_chars:
                    close()
            if size >= 4 << 20:
                yield pa.RecordBatch.from_pylist(rows, _PIECE_SCHEMA)
                rows, size = [], 0
        if turns:
            close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _PIECE_SCHEMA)

    return batches(dealt, run, PIECES)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame) -> DataFrame:
    """One row a conversation, parsed back from its pieces as ``format_conversations`` gives them (in order).

    turns_sha256: role, line feed, text, line feed of each turn; loss_*: the unescaped text under the loss spans.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def row() -> dict:
            conv, n, turns, chars, loss, width = now
            return {"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": width}

        for b in it:
            rows = []
            for p in b.select(["conv_id", "first_turn", "formatted", "loss"]).to_pylist():
                if p["first_turn"]:
                    if now is not None:
                        rows.append(row())
                    now = [p["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = p["formatted"]
                for role, content, _, _ in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{unescape(content)}\n".encode())
                for s in p["loss"]:
                    said = unescape(text[s["start"] : s["end"]])
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(text)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _DIGEST_SCHEMA)
        if now is not None:
            yield pa.RecordBatch.from_pylist([row()], _DIGEST_SCHEMA)

    return batches(pieces, run, DIGESTS)


_DIGEST_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
