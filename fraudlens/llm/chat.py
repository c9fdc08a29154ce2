"""Chat formatting: turns become marked text, assembled as columns of bytes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template. A turn is START role \n text END.
START, HEAD_END, END = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNT_ROLE = "assistant"

# No text keeps "<|": one backslash more stands between the two characters of each "<|", "<\|", "<\\|" ...
_ESCAPE, _ESCAPED = r"<(\\*)\|", r"<\1\\|"
_UNESCAPE, _UNESCAPED = re.compile(r"<(\\*)\\\|"), r"<\1|"
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END), re.DOTALL)

_FORMATTED = "conv_id long, part int, n_turns long, formatted string, loss array<struct<first:long,last:long>>"
_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(_UNESCAPED, text) if "<\\" in text else text


def unescape_role(role: str) -> str:
    return role.replace("%3C", "<").replace("%0A", "\n").replace("%25", "%")


def _escape_roles(roles: pa.Array) -> pa.Array:
    for plain, safe in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        roles = pc.replace_substring(roles, plain, safe)
    return roles


def _source(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and bytes of a large string array."""
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(strings) + 1, 8 * strings.offset)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, data


def _scatter(out: np.ndarray, at: np.ndarray, strings: pa.Array) -> None:
    """Copy each string to its place: one scatter index per byte."""
    offsets, data = _source(strings)
    lengths = np.diff(offsets)
    index = np.arange(offsets[0], offsets[-1]) + np.repeat(at - offsets[:-1], lengths)
    out[index] = data[offsets[0] : offsets[-1]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Formatted bytes of all turns in one buffer, and the offset of every turn in it."""
    start, middle, end = (np.frombuffer(x.encode(), np.uint8) for x in (START, HEAD_END, END))
    role_bytes, text_bytes = (np.diff(_source(x)[0]) for x in (roles, texts))
    length = len(start) + role_bytes + len(middle) + text_bytes + len(end)
    offsets = np.concatenate(([0], np.cumsum(length)))
    out = np.empty(offsets[-1], np.uint8)
    at = offsets[:-1]
    for constant, first in (
        (start, at),
        (middle, at + len(start) + role_bytes),
        (end, offsets[1:] - len(end)),
    ):
        out[first[:, None] + np.arange(len(constant))] = constant
    _scatter(out, at + len(start), roles)
    _scatter(out, at + len(start) + role_bytes + len(middle), texts)
    return out, offsets


def _format(rows: pa.Table, bounds: np.ndarray, part: int) -> pa.RecordBatch:
    """One output row for each conversation; ``bounds`` are the rows where conversations begin, and the end.

    ``part`` numbers the first one's row; the others are whole.
    """
    rows = rows.combine_chunks()
    roles, texts = (
        pc.fill_null(rows.column(c).combine_chunks().cast(pa.large_string()), "") for c in ("role", "text")
    )
    learnt = pc.equal(roles, LEARNT_ROLE).to_numpy(zero_copy_only=False)
    roles, texts = _escape_roles(roles), pc.replace_substring_regex(texts, _ESCAPE, _ESCAPED)
    data, offsets = assemble(roles, texts)
    role_chars, text_chars = (pc.utf8_length(x).to_numpy().astype(np.int64) for x in (roles, texts))
    chars = len(START) + role_chars + len(HEAD_END) + text_chars + len(END)
    before = np.concatenate(([0], np.cumsum(chars)))
    sizes = np.diff(bounds)
    first = before[:-1] - np.repeat(before[bounds[:-1]], sizes) + len(START) + role_chars + len(HEAD_END)
    spans = pa.StructArray.from_arrays(
        [pa.array(first[learnt]), pa.array((first + text_chars)[learnt])], ["first", "last"]
    )
    span_offsets = np.concatenate(([0], np.cumsum(learnt)))[bounds].astype(np.int32)
    n = len(sizes)
    parts = np.zeros(n, np.int32)
    parts[0] = part
    formatted = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets[bounds]), pa.py_buffer(data))
    return pa.RecordBatch.from_arrays(
        [
            rows.column("conv_id").combine_chunks().take(pa.array(bounds[:-1])),
            pa.array(parts),
            pa.array(sizes.astype(np.int64)),
            formatted.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(span_offsets), spans),
        ],
        ["conv_id", "part", "n_turns", "formatted", "loss"],
    )


def _begins(conv_id: pa.ChunkedArray) -> np.ndarray:
    """Rows where a conversation begins."""
    null = conv_id.is_null().to_numpy().astype(bool)
    value = conv_id.fill_null(0).to_numpy()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return np.flatnonzero(new)


def format_chats(turns: DataFrame, part_bytes: int = 4 << 20) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` as marked text with the spans a model learns from.

    One row per conversation: its formatted text and ``loss``, the ranges of characters that hold
    assistant texts. Rows are dealt by conversation and sorted, then read as a stream; a conversation of
    more than ``part_bytes`` of text is written as several rows, numbered by ``part``, so a task holds
    only about that much of it, however long it is.

    Defined cases: null texts and roles are empty; turns come by number, then role, then text, nulls first,
    and rows that repeat a turn are turns of their own; null conv_ids make one conversation; an empty
    table gives no rows; other columns are ignored. Control strings in texts are escaped, reversibly.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        part, open_id = 0, None
        for batch in batches:
            for rows in _sliced(batch, part_bytes):
                if held is None and part and rows.column("conv_id")[0].as_py() != open_id:
                    part = 0  # what was written last ended its conversation
                held = rows if held is None else pa.concat_tables([held, rows])
                bounds = _begins(held.column("conv_id"))
                last = int(bounds[-1])
                if last:
                    yield _format(held.slice(0, last), bounds, part)
                    held, part = held.slice(last), 0
                if held.nbytes > part_bytes:
                    yield _format(held, np.array([0, len(held)]), part)
                    open_id, held, part = held.column("conv_id")[0].as_py(), None, part + 1
        if held is not None:
            yield _format(held, np.array([0, len(held)]), part)

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")
    return rows.mapInArrow(run, _FORMATTED)


def _sliced(batch: pa.RecordBatch, most: int) -> Iterator[pa.Table]:
    """Slices of a batch of about ``most`` bytes."""
    table = pa.Table.from_batches([batch])
    step = max(1, int(len(table) * most / max(1, table.nbytes)))
    for first in range(0, len(table), step):
        yield table.slice(first, step)


def read_chats(formatted: DataFrame) -> DataFrame:
    """Turns read back from formatted text: digests of all turns and of what is learnt.

    Takes the rows of ``format_chats`` as they come, parts of a conversation one after the other.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    if state:
                        done.append(state.row())
                    state = _Digest(row["conv_id"])
                state.add(row["formatted"], row["loss"])
            if done:
                yield _digests(done)
        if state:
            yield _digests([state.row()])

    return formatted.mapInArrow(run, _DIGEST)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in _DIGEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class _Digest:
    """Digests of one conversation, fed with its parts."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        at = 0
        while at < len(formatted):
            found = _TURN.match(formatted, at)
            if not found:
                raise ValueError(f"conversation {self.conv_id}: no turn at character {at}")
            role, text = unescape_role(found[1]), unescape(found[2])
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
            at = found.end()
        for span in loss:
            text = unescape(formatted[span["first"] : span["last"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self) -> tuple:
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
        )
