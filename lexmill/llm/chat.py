"""Chat formatting by columnar byte assembly, with a loss mask, and reading it back.

Turns of a conversation are formatted one by one, in order: a header that names the role, the
text, and a trailer. Lengths of all segments of a batch, their cumulative offsets and the scatter
indices are computed in numpy; headers, texts and trailers are copied into one preallocated Arrow
buffer. Control strings inside roles and texts are broken by a backslash after their first
character, and backslashes are doubled, so that the original comes back exactly.

Formatting needs no shuffle: rows are independent, and a conversation of any length is spread over
tasks. Only reading back deals rows by conversation and sorts them by turn; a conversation is then
streamed through batches and never held as a whole, so its length is not limited by memory. (Its
digests are of one byte sequence, which one task has to see in order.)

Defined results: a null text or role is empty; rows of one turn are ordered by their formatted text;
repeated rows are turns of their own; a null conversation id is a conversation, a null turn comes
first; extra columns are ignored; an empty table formats to an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, ROLE_END, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
#: Strings that mark turns; each begins with "<" or "[".
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLE = "assistant"
BATCH_BYTES, LONG_BYTES = 4_000_000, 65_536
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(column: pa.Array) -> pa.Array:
    column = pc.replace_substring(column, "\\", "\\\\")
    for control in CONTROLS:
        column = pc.replace_substring(column, control, control[0] + "\\" + control[1:])
    return column


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of each value (and the end of the last), and the bytes."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)


def assemble(parts: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """Row-wise concatenation of string columns, and where each column's segments begin in rows.

    All segments of the batch are scattered into one buffer: a segment's destination is the row's
    offset plus the lengths of the row's earlier segments. Indices of bytes are made for segments of
    up to ``LONG_BYTES``; a longer one is copied as the range that it is.
    """
    pieces = [buffers(p) for p in parts]
    lengths = np.stack([np.diff(at) for at, _ in pieces])
    begins = np.cumsum(lengths, axis=0) - lengths
    ends = np.cumsum(lengths.sum(axis=0))
    offsets = np.concatenate(([0], ends))
    out = np.empty(int(offsets[-1]), np.uint8)
    for (at, data), size, begin in zip(pieces, lengths, begins, strict=True):
        to, source = offsets[:-1] + begin, at[:-1]
        for i in np.flatnonzero(size > LONG_BYTES).tolist():
            out[to[i] : to[i] + size[i]] = data[source[i] : source[i] + size[i]]
        size = np.where(size > LONG_BYTES, 0, size)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(to, size) + inside] = data[np.repeat(source, size) + inside]
    array = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out))
    return array.cast(pa.string()), list(begins)


def bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded text bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // BATCH_BYTES
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)])).astype(int).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def format_turns(conversations: DataFrame, *, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id, turn, formatted, loss_start, loss_end`` for each row.

    A conversation's text is its rows' ``formatted`` by turn, one after another; ``loss_start`` and
    ``loss_end`` bound the bytes of a row that count for the loss (equal if none do).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole):
                role, text = (escape(pc.fill_null(batch.column(k), "")) for k in ("role", "text"))
                const = lambda s: pa.array([s] * batch.num_rows, pa.string())  # noqa: B023, E731
                formatted, begins = assemble([const(OPEN), role, const(ROLE_END), text, const(CLOSE)])
                learn = pc.equal(pc.fill_null(batch.column("role"), ""), loss_role).to_numpy(zero_copy_only=False)
                start = begins[3]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("conv_id"), batch.column("turn"), formatted, pa.array(start), pa.array(np.where(learn, begins[4], start))],
                    ["conv_id", "turn", "formatted", "loss_start", "loss_end"],
                )

    kinds = {k: conversations.schema[k].dataType.simpleString() for k in ("conv_id", "turn")}
    return conversations.select("conv_id", "turn", "role", "text").mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, formatted string, loss_start long, loss_end long")


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    cut = formatted.index(ROLE_END, len(OPEN))
    if not (formatted.startswith(OPEN) and formatted.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    return unescape(formatted[len(OPEN) : cut]), unescape(formatted[cut + len(ROLE_END) : len(formatted) - len(CLOSE)])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its formatted turns.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now, turns, loss, sums = None, None, None, None
        kind = None

        def row() -> list:
            return [now[0], sums[0], turns.hexdigest(), sums[1], loss.hexdigest(), sums[2]]

        def give(rows: list[list]) -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            kind, done = batch.column(0).type, []
            for key, text, a, b in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
                if now is None or now[0] != key:
                    if now is not None:
                        done.append(row())
                    now, turns, loss, sums = (key,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                role, content = parse_turn(text)
                turns.update(f"{role}\n{content}\n".encode())
                learnt = unescape(text.encode()[a:b].decode())
                loss.update(learnt.encode())
                sums = [sums[0] + 1, sums[1] + len(learnt), sums[2] + len(text)]
            if done:
                yield give(done)
        if now is not None:
            yield give([row()])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversations_with_probe(conversations: DataFrame) -> DataFrame:
    """All conversations plus number -1, whose texts say what the template's control strings do."""
    said = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, LOSS_ROLE, said)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
