"""Chat formatting with a grammar round trip.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. The rendered conversation is parsed again by a
deterministic parser, which splits at the marks and unescapes, and compared with the source; turns
that don't come back identical are escaped and all is rendered and parsed again, until it is identical.
Escaping puts one more backslash into each ``<`` ... ``|`` that could be taken for a mark or for an
escaped one, and writes a line feed of a role as ``\\n``; it loses nothing, so a second round always
agrees. The loss mask covers the texts of assistant turns, as code points of the rendered text.

Rows of a conversation are read in the order of ``turn`` from a sorted partition, one conversation
at a time, so a task holds one conversation and not its partition. A digest over a conversation
needs its turns in order in one place; no other step gathers rows.

Nulls and ties: a null text or role is empty; null turns come first, ties go by role and text, and
repeated rows are turns of their own. Rows with a null conv_id are one conversation. Texts are never
cut; a task holds one conversation's. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import keyed_stream

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
_HIDE, _SHOW = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _HIDE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHOW.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render_turn(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """``(role, text, start, end)`` of each turn, ``start`` and ``end`` of the text as it stands.

    None if it isn't of the grammar: a mark that opens no turn and ends none is an error.
    """
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        if line < 0 or not formatted.startswith(START, at):
            return None
        role, end = formatted[at + len(START) : line], formatted.find(END, line)
        if end < 0 or START in role or END in role or formatted.find(START, line, end) >= 0 or not formatted.startswith("\n", end + len(END)):
            return None
        turns.append((_unescape_role(role), unescape(formatted[line + 1 : end]), line + 1, end))
        at = end + len(END) + 1
    return turns


def comes_back(role: str, text: str, rendered: str) -> bool:
    turns = parse(rendered)
    return turns is not None and [t[:2] for t in turns] == [(role, text)]


def render(turns: list[tuple[str, str]]) -> str:
    """The conversation's text; the parser gives its turns back."""
    parts = [render_turn(role, text) for role, text in turns]
    plain = list(range(len(turns)))
    while True:
        formatted = "".join(parts)
        back = parse(formatted)
        if back is not None and [t[:2] for t in back] == turns:
            return formatted
        odd = [k for k in plain if not comes_back(*turns[k], parts[k])]
        if not odd:
            raise ValueError("a conversation doesn't come back as it was")
        for k in odd:
            parts[k] = render_turn(_escape_role(turns[k][0]), escape(turns[k][1]))
        plain = sorted(set(plain) - set(odd))


def loss_spans(formatted: str) -> list[tuple[int, int]]:
    """Places of the texts that are learned."""
    return [(a, b) for role, _, a, b in parse(formatted) if role == LEARNED]


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, str]]:
    for (conv_id,), pieces in keyed_stream(batches, ["conv_id"]):
        turns = [(r or "", t or "") for b in pieces for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)]
        yield conv_id, render(turns)


def _sorted(rows: DataFrame) -> DataFrame:
    rows = rows.select("conv_id", "turn", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))


def _emit(rows: Iterator[dict], schema: pa.Schema, each: int = 500) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == each:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: the rendered text and the places of the learned texts in it."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(span))])

    def task(batches):
        yield from _emit(({"conv_id": i, "formatted": f, "loss": [{"start": a, "end": b} for a, b in loss_spans(f)]} for i, f in _conversations(batches)), schema)

    return _sorted(rows).mapInArrow(task, "conv_id long, formatted string, loss array<struct<start: long, end: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests read from ``conv_id, formatted, loss`` alone."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def row(conv_id, text: str, loss: list[dict]) -> dict:
        turns = parse(text)
        said = "".join(f"{r}\n{t}\n" for r, t, _, _ in turns)
        learned = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return {"conv_id": conv_id, "n_turns": len(turns), "turns_sha256": sha(said), "loss_chars": len(learned), "loss_sha256": sha(learned), "formatted_chars": len(text)}

    def task(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([row(*r) for r in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)], schema)

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(task, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
