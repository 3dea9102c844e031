"""Chat formatting with typed content parts.

A turn is a list of parts; a visitor with one method per part kind flattens
them in order: text is escaped, and image, audio and document parts become
placeholders whose references and expanded token counts are recorded. The
formatted conversation is the concatenation of its turns

    ### role: content</turn>\\n

Escaping puts a backslash before every backslash and before each character
that could start a control string, so reading back is exact for any text.
Only the content of assistant turns is under the loss mask.

Defined results: null text, role or reference is empty; a part of unknown
kind is an error; turns of equal number are ordered by role, then content; a
null conversation id is an id of its own. Formatting is a narrow map.
Reading back takes a conversation as one text, in pieces of any length, finds
its turns by the control strings alone, and streams them through a running
digest: text that is no sequence of whole turns is an error. A conversation of
any length needs the memory of its longest turn, a few bytes a character.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, ROLE_END, CLOSE = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"
KINDS = ("image", "audio", "document")
#: Units of a part's size that one expanded token stands for: pixels, milliseconds, bytes.
UNITS_PER_TOKEN = {"image": 28 * 28, "audio": 40, "document": 4}

PARTS = "array<struct<kind: string, text: string, ref: string, size: bigint>>"
_TAGS = ("</turn>", *(f"<{kind}:" for kind in KINDS))
_HASHES = re.compile("##+")
_ROLE_CONTROL = re.compile(r"[\\:#<\n]")


def escape(text: str) -> str:
    """The text with a backslash before each backslash, each "#" of "###" or after another, and each "<" of a control string."""
    text = text.replace("\\", "\\\\")
    if "##" in text:
        text = _HASHES.sub(lambda run: ("#" if len(run[0]) == 2 else "\\#") + "\\#" * (len(run[0]) - 1), text)
    for tag in _TAGS:
        text = text.replace(tag, "\\" + tag)
    return text


def unescape(text: str) -> str:
    # of a run of backslashes the pairs come first, one left over belongs to what follows
    return "\\".join([part.replace("\\", "") for part in text.split("\\\\")]) if "\\" in text else text


def _find(text: str, control: str, at: int) -> int:
    """Where the control string next stands unescaped, or -1."""
    while (at := text.find(control, at)) >= 0:
        before = at
        while before and text[before - 1] == "\\":
            before -= 1
        if (at - before) % 2 == 0:
            break
        at += 1
    return at


class TurnReader:
    """Reads turns from the text of a conversation that comes in pieces; their ends need not be those of turns."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """(role, content) of the turns that are whole by now."""
        text, at = self.rest + piece if self.rest else piece, 0
        while (end := _find(text, CLOSE, at)) >= 0:
            colon = _find(text, ROLE_END, at)
            if not text.startswith(OPEN, at) or not at < colon < end:
                raise ValueError("not a formatted turn")
            content = text[colon + len(ROLE_END) : end]
            if _find(content, OPEN, 0) >= 0:
                raise ValueError("a turn that opens inside a turn")
            yield unescape(text[at + len(OPEN) : colon]), unescape(content)
            at = end + len(CLOSE)
        self.rest = text[at:]

    def finish(self) -> None:
        if self.rest:
            raise ValueError("text after the last turn")


class PartVisitor:
    """Flattens the parts of one turn; ``attachments`` records what the placeholders stand for."""

    def __init__(self):
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part["kind"]
        if kind not in ("text", *KINDS):
            raise ValueError(f"unknown part kind {kind!r}")
        getattr(self, f"visit_{kind}")(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part["text"] or ""))

    def _placeholder(self, part: dict) -> None:
        kind, n = part["kind"], len(self.attachments)
        tokens = max(1, math.ceil((part["size"] or 0) / UNITS_PER_TOKEN[kind]))
        self.out.append(f"<{kind}:{n}>")
        self.attachments.append({"kind": kind, "ref": part["ref"] or "", "ordinal": n, "tokens": tokens})

    visit_image = visit_audio = visit_document = _placeholder


TURN_SCHEMA = "formatted string, loss_start int, loss_end int, attachments array<struct<kind: string, ref: string, ordinal: int, tokens: bigint>>, attachment_tokens bigint"
_ATTACHMENTS = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("ordinal", pa.int32()), ("tokens", pa.int64())]))


def text_part(text: Column) -> Column:
    """A list of one text part, for tables whose turns are plain text."""
    none = F.lit(None)
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), none.cast("string").alias("ref"), none.cast("bigint").alias("size"))
    return F.array(part).cast(PARTS)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, int, int, list[dict]]:
    visitor = PartVisitor()
    for part in parts or []:
        visitor.visit(part)
    head = OPEN + _ROLE_CONTROL.sub(r"\\\g<0>", role or "") + ROLE_END
    content = "".join(visitor.out)
    length = len(content) if role == LOSS_ROLE else 0
    return head + content + CLOSE, len(head), len(head) + length, visitor.attachments


def format_turns(df: DataFrame, conv: str, turn: str, role: str, parts: Column) -> DataFrame:
    """(``conv``, ``turn``) of every row with its ``formatted`` turn, the loss span in it and the attachments."""
    source = df.select(df[conv].alias("conv"), df[turn].alias("turn"), df[role].alias("role"), parts.alias("parts"))
    keep = ", ".join(f"{c} {t}" for c, t in source.select("conv", "turn").dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turn(r, p) for r, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            columns = [
                pa.array([m[0] for m in made], pa.string()),
                pa.array([m[1] for m in made], pa.int32()),
                pa.array([m[2] for m in made], pa.int32()),
                pa.array([m[3] for m in made], _ATTACHMENTS),
                pa.array([sum(a["tokens"] for a in m[3]) for m in made], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["conv", "turn", "formatted", "loss_start", "loss_end", "attachments", "attachment_tokens"])

    out = source.mapInArrow(run, f"{keep}, {TURN_SCHEMA}")
    return out.select(F.col("conv").alias(conv), F.col("turn").alias(turn), "formatted", "loss_start", "loss_end", "attachments", "attachment_tokens")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of every turn of a formatted conversation."""
    reader = TurnReader()
    turns = list(reader.feed(formatted))
    reader.finish()
    return turns


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, content) of one formatted turn; anything else than exactly one turn is an error."""
    turns = read_turns(formatted)
    if len(turns) != 1:
        raise ValueError("not a formatted turn")
    return turns[0]


READ_SCHEMA = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_conversations(turns: DataFrame, conv: str, turn: str) -> DataFrame:
    """Read formatted conversations back: a row each with digests of the turns and of the text under the loss mask.

    The rows are pieces of a conversation's text in order, with the loss span
    in each; what its turns are is read from the text. ``turns_sha256`` covers role, newline, content, newline of each turn.
    A SHA-256 is sequential, so one conversation is read by one task, turn by
    turn; different conversations are spread over all tasks.
    """
    ordered = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), "formatted", "loss_start", "loss_end")
    ordered = ordered.repartition("conv").sortWithinPartitions("conv", "turn", "formatted")
    kind = ordered.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, started = None, False
        n = chars = loss = 0
        whole = masked = hashlib.sha256()
        reader = TurnReader()

        def finish() -> None:
            reader.finish()
            done.append((current, n, whole.hexdigest(), loss, masked.hexdigest(), chars))

        def rows() -> pa.RecordBatch:
            made = [pa.array([d[i] for d in done], t) for i, t in enumerate(types)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for c, text, a, b in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if not started or c != current:
                    if started:
                        finish()
                    current, started, n, chars, loss = c, True, 0, 0, 0
                    whole, masked, reader = hashlib.sha256(), hashlib.sha256(), TurnReader()
                for role, content in reader.feed(text):
                    for part in (role, "\n", content, "\n"):
                        whole.update(part.encode())
                    n += 1
                under = unescape(text[a:b])
                masked.update(under.encode())
                chars, loss = chars + len(text), loss + len(under)
            if done:
                yield rows()
        if started:
            finish()
            yield rows()

    return ordered.mapInArrow(run, f"conv {kind}, {READ_SCHEMA}").withColumnRenamed("conv", conv)
