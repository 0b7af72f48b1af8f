"""Chat formatting of messages with typed content parts.

A message is a role and an ordered list of parts: text, image, audio or document. A visitor renders
the parts into one string: text with control strings escaped, every attachment as a placeholder,
with its reference, place and the tokens it expands to recorded beside it. Turns are marked by a
template; the loss mask covers what assistants say, without the marks.

Messages are sorted by conversation and turn and rendered in a stream, so a conversation of any
length needs one turn's memory.

Defined results: a null text is empty, a null role too. A part without a type is text, a null part
nothing, and a part of an unknown type an attachment with a placeholder of its own. Turns are ordered by (turn, role, text),
null turns last. A null conversation is one of its own. Repeated rows are turns of their own. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelens.llm.common import schema_of, small_batches

START, END, OTHER = "<|im_start|>", "<|im_end|>", "<|attachment|>"
TRAINED = "assistant"
#: Tokens for one unit of an attachment: an image tile, a second of sound, a page.
TOKENS = {"image": 256, "audio": 25, "document": 600}
PARTS = "array<struct<type:string,text:string,ref:string,units:bigint>>"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    r"""No `<|` is left, and \ is doubled, so that unescape() gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\\|])", r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], role)


class PartVisitor:
    """Renders a message's parts in order; attachments: (offset, type, reference, expanded tokens)."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            kind = part["type"] or "text"
            getattr(self, f"visit_{kind if kind == 'text' or kind in TOKENS else 'other'}")(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part["text"] or ""))

    def _attach(self, part: dict) -> None:
        kind = part["type"]
        tokens = TOKENS[kind] * max(1, part["units"] or 1)
        self.attachments.append({"offset": self.length, "type": kind, "ref": part["ref"], "tokens": tokens})
        self._add(f"<|{kind}|>")

    visit_image = visit_audio = visit_document = _attach

    def visit_other(self, part: dict) -> None:
        """A part of an unknown type: its type and reference are kept, and a token for each unit."""
        self.attachments.append({"offset": self.length, "type": part["type"], "ref": part["ref"], "tokens": max(1, part["units"] or 1)})
        self._add(OTHER)


def text_parts(text_col: str = "text") -> Column:
    """The parts of a message that is one text."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), F.col(text_col).alias("text"), none.cast("string").alias("ref"), none.cast("long").alias("units")))


def format_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts: Column | None = None) -> DataFrame:
    """A row for each turn, in order within its conversation and partition.

    conv, turn, start (code points of the conversation before it), rendered, loss_start and loss_end
    (in rendered; null if the turn is not trained on), attachments, and tokens they expand to.
    """
    small_batches(messages.sparkSession)
    parts = text_parts() if parts is None else parts
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), parts.cast(PARTS).alias("parts"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("turn"), "role", "parts")
    form = f"{schema_of(messages, conv_col, 'conv')}, {schema_of(messages, turn_col, 'turn')}, start long, rendered string, loss_start int, loss_end int, attachments array<struct<offset:int,type:string,ref:string,tokens:bigint>>, expanded_tokens long"
    kinds = pa.list_(pa.struct([("offset", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, start = object(), 0
        for batch in batches:
            out: list[tuple] = []
            for conv, role, content in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "parts")], strict=True):
                if conv != held:
                    held, start = conv, 0
                visitor = PartVisitor()
                for part in content or []:
                    visitor.visit(part)
                head = f"{START}{escape_role(role)}\n"
                rendered = f"{head}{''.join(visitor.pieces)}{END}\n"
                trained = (len(head), len(head) + visitor.length) if role == TRAINED else (None, None)
                placed = [a | {"offset": a["offset"] + len(head)} for a in visitor.attachments]
                out.append((start, rendered, *trained, placed, sum(a["tokens"] for a in placed)))
                start += len(rendered)
            starts, texts, first, last, attached, tokens = zip(*out, strict=True) if out else [[]] * 6
            columns = [pa.array(starts, pa.int64()), pa.array(texts, pa.string()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(attached, kinds), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("turn"), *columns], names=["conv", "turn", "start", "rendered", "loss_start", "loss_end", "attachments", "expanded_tokens"])

    return rows.mapInArrow(run, form)


def read_back(formatted: DataFrame) -> DataFrame:
    """A row for each conversation, from the rendered text and loss spans of format_turns alone, in any order of rows."""
    form = f"{schema_of(formatted, 'conv')}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = next(f for f in formatted.schema if f.name == "conv").dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        nothing = object()
        conv, turns, said, n, chars, total = nothing, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for batch in batches:
            done = []
            for own, rendered, first, last in zip(*[batch.column(c).to_pylist() for c in ("conv", "rendered", "loss_start", "loss_end")], strict=True):
                if own != conv:
                    if conv is not nothing:
                        done.append((conv, n, turns.hexdigest(), chars, said.hexdigest(), total))
                    conv, turns, said, n, chars, total = own, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                role, text = TURN.fullmatch(rendered).groups()
                turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode("utf-8", "replace"))
                if first is not None:
                    loss = unescape(rendered[first:last])
                    said.update(loss.encode("utf-8", "replace"))
                    chars += len(loss)
                n, total = n + 1, total + len(rendered)
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=names)
        if conv is not nothing:
            last_row = (conv, n, turns.hexdigest(), chars, said.hexdigest(), total)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(last_row, types, strict=True)], names=names)

    wanted = formatted.select("conv", "start", "rendered", "loss_start", "loss_end")
    return wanted.repartition("conv").sortWithinPartitions("conv", "start").mapInArrow(run, form)
