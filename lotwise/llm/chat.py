"""Chat formatting: typed content parts flattened into a marked-up transcript, and back.

A turn is ``<|turn|>role<|body|>content<|end|>``. A visitor flattens the parts of its
content in order: text is escaped, images, audio and documents become placeholders with a
running number, their references and expanded token counts recorded beside. Control
strings, ours and those of other common templates, are escaped wherever text or roles
hold them: a backslash behind the first character, original backslashes doubled. So no
text can end a turn or forge one, and reading back restores it exactly.

Conversations are streams, not groups: rows are dealt out by conversation and sorted by
turn, and a task writes a conversation in pieces of bounded length as it goes. So a
conversation with a third of all rows needs no more memory than any other. Reading
back does the same with the pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PART_OPEN, PART_CLOSE = "<|part:", "|>"

# fixed values: strings that tokenizers of common chat templates take for control
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>", "<|")

PIECE = 1 << 18  # characters after which a piece of a transcript is closed

_CONTROL = re.compile("(?=" + "|".join(map(re.escape, sorted(FOREIGN))) + r")(.)|(\\)", re.DOTALL)


def escape(text: str) -> str:
    """Backslashes doubled, and one put behind the first character of each control string."""
    return _CONTROL.sub(lambda m: "\\\\" if m[2] else m[1] + "\\", text)


def unescape(text: str) -> str:
    """A doubled backslash is one, a single one was put in."""
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass
class Flattened:
    """What one visit leaves: the flat text and what it refers to."""

    text: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0


class ContentVisitor:
    """Flattens typed parts; ``expanded`` says how many tokens a unit of each kind becomes.

    An image counts patches, audio seconds, a document pages. A part of an unknown or
    missing type is read as text; missing units count as one.
    """

    def __init__(self, expanded: dict[str, int] | None = None):
        self.expanded = {"image": 1, "audio": 25, "document": 600} | (expanded or {})

    def visit(self, part: dict, out: Flattened) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_text)(part, out)

    def visit_text(self, part: dict, out: Flattened) -> None:
        out.text.append(escape(part.get("text") or ""))

    def _attach(self, kind: str, part: dict, out: Flattened) -> None:
        units = part.get("units")
        tokens = (1 if units is None else units) * self.expanded[kind]
        out.text.append(f"{PART_OPEN}{kind}:{len(out.attachments)}{PART_CLOSE}")
        out.attachments.append({"kind": kind, "uri": part.get("uri"), "tokens": tokens})
        out.tokens += tokens

    def visit_image(self, part: dict, out: Flattened) -> None:
        self._attach("image", part, out)

    def visit_audio(self, part: dict, out: Flattened) -> None:
        self._attach("audio", part, out)

    def visit_document(self, part: dict, out: Flattened) -> None:
        self._attach("document", part, out)

    def flatten(self, content) -> Flattened:
        """``content`` is a text, a list of parts, or nothing."""
        out = Flattened()
        parts = [{"type": "text", "text": content}] if isinstance(content, str) else content or []
        for part in parts:
            if part is not None:
                self.visit(part, out)
        return out


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHED = pa.list_(pa.struct([("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())]))
_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("formatted", pa.string()),
        ("loss_spans", _SPAN),
        ("attachments", _ATTACHED),
        ("attached_tokens", pa.int64()),
    ]
)
PIECES = (
    "conv_id bigint, piece bigint, formatted string, loss_spans array<struct<start:bigint,end:bigint>>,"
    " attachments array<struct<kind:string,uri:string,tokens:bigint>>, attached_tokens bigint"
)


def _streamed(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    """Whole conversations, in order."""
    dealt = df.repartition("conv_id") if partitions is None else df.repartition(partitions, "conv_id")
    return dealt.sortWithinPartitions("conv_id", *order)


def _ranged(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    """Ranges of turns, in order: a long conversation is spread over several."""
    keys = ["conv_id", *order]
    dealt = df.repartitionByRange(*keys) if partitions is None else df.repartitionByRange(partitions, *keys)
    return dealt.sortWithinPartitions(*keys)


def formatted(
    turns: DataFrame,
    content: str = "text",
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    trained: tuple[str, ...] = ("assistant",),
    expanded: dict[str, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Pieces of transcripts: (conv_id, piece, formatted, loss_spans, attachments, attached_tokens).

    ``content`` is a text column or an array of structs with the fields type, text, uri
    and units. A conversation's transcript is its pieces in order, each of whole turns (the
    numbers rise and may leave some out: the upper bits are those of a range of turns);
    spans of the turns to be learned count characters within their piece. Null roles and
    contents are empty. Rows of one turn stand in order of role and content, null turns
    come first; rows without a conversation form one of their own.
    """
    c = F.col
    is_text = isinstance(turns.schema[content].dataType, T.StringType)
    narrow = turns.select(
        c(f"`{conversation}`").cast("bigint").alias("conv_id"),
        c(f"`{turn}`").alias("turn"),
        F.coalesce(c(f"`{role}`"), F.lit("")).alias("role"),
        c(f"`{content}`").alias("content"),
    )
    ties = c("content") if is_text else F.to_json("content")
    ordered = _ranged(narrow.withColumn("tie", ties), ["turn", "role", "tie"], partitions).drop("tie")

    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        visitor = ContentVisitor(expanded)
        # the state of the piece that is open
        key, piece, size = None, TaskContext.get().partitionId() << 33, 0
        text, spans, attached, tokens = [], [], [], 0
        started = False

        def close() -> pa.RecordBatch:
            row = [[key], [piece], ["".join(text)], [spans], [attached], [tokens]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _PIECES)], schema=_PIECES)

        for batch in stream:
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "role", "content"))
            for conv, who, body in zip(*columns):
                if started and (conv != key or size >= PIECE):
                    yield close()
                    piece += 1
                    size, text, spans, attached, tokens = 0, [], [], [], 0
                key, started = conv, True
                flat = visitor.flatten(body)
                head = f"{TURN}{escape(who)}{BODY}"
                inner = "".join(flat.text)
                text += [head, inner, END]
                if who in trained:
                    spans.append({"start": size + len(head), "end": size + len(head) + len(inner)})
                size += len(head) + len(inner) + len(END)
                attached += flat.attachments
                tokens += flat.tokens
        if started:
            yield close()

    return ordered.select("conv_id", "role", "content").mapInArrow(write, PIECES)


_TURN = re.compile(
    re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.DOTALL
)
READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint"
)


def read_turns(piece: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a piece; placeholders stay as they are."""
    at = 0
    for m in _TURN.finditer(piece):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        yield unescape(m[1]), unescape(m[2])
    if at != len(piece):
        raise ValueError(f"no turn at {at}")


def read_back(pieces: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row for each conversation, digested from its transcript and loss mask alone."""

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
            + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        )
        done: list[tuple] = []
        key, started = None, False
        n = chars = learned = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def result() -> tuple:
            return key, n, turns.hexdigest(), learned, loss.hexdigest(), chars

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(zip(*done), schema)], schema=schema
            )

        for batch in stream:
            for conv, text, spans in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "formatted", "loss_spans"))):
                if started and conv != key:
                    done.append(result())
                    n = chars = learned = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                key, started = conv, True
                chars += len(text)
                for role, body in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    body = unescape(text[span["start"] : span["end"]])
                    learned += len(body)
                    loss.update(body.encode())
            if len(done) > 10_000:
                yield packed()
                done = []
        if started:
            done.append(result())
            yield packed()

    narrow = pieces.select("conv_id", "piece", "formatted", "loss_spans")
    return _streamed(narrow, ["piece"], partitions).mapInArrow(read, READ)
