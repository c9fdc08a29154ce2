"""Packing documents into training sequences by sum-of-squares online placement."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fraudlens.llm.tokens import word_encoder

_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_SEQUENCE_BITS = 40


class Piece:
    """A run of one document's ids."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * n], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + n, self.ids[4 * n :], self.doc_tokens)


class LevelPacker:
    """Windows of ``size`` tokens filled online.

    ``count[h]`` is the number of open windows with ``h`` tokens. A piece of ``n`` tokens goes to the level
    (0: a new window) that makes the sum of the squared counts smallest; ties go to the fullest level.
    Where a new window would be the ``max_open + 1``-th, the piece is cut instead: its head fills the
    fullest window. So memory holds at most ``max_open`` windows, whatever the input.
    """

    def __init__(self, size: int = 4096, max_open: int = 512):
        self.size, self.max_open = size, max_open
        self.count = np.zeros(size + 1, np.int64)
        self.windows: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.size:
            head, piece = piece.cut(self.size)
            self.closed.append([head])
        while len(piece):
            level = self._best_level(len(piece))
            if level == 0 and self.n_open >= self.max_open:
                level = max(self.windows)
                head, piece = piece.cut(min(self.size - level, len(piece)))
                self._put(head, level)
            else:
                self._put(piece, level)
                return

    def _best_level(self, n: int) -> int:
        """The level whose use changes the sum of squares least."""
        before, after = self.count[: self.size - n + 1], self.count[n:]
        change = 2 * (after - before) + 2
        change[-1] -= 1  # a full window is not open any more
        change[0] = 2 * self.count[n] + 1
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def _put(self, piece: Piece, level: int) -> None:
        if level:
            at = self.windows[level]
            window = at.pop()
            if not at:
                del self.windows[level]
            self.count[level] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        level += len(piece)
        if level == self.size:
            self.closed.append(window)
        else:
            self.windows.setdefault(level, []).append(window)
            self.count[level] += 1
            self.n_open += 1

    def take(self) -> list[list[Piece]]:
        """The windows closed since the last call."""
        done, self.closed = self.closed, []
        return done

    def drain(self) -> list[list[Piece]]:
        """Close what is open: the emptiest windows fill the gaps of the fullest.

        The one window that stays partly filled becomes sequences whose lengths are powers of two.
        """
        rest = [w for level in sorted(self.windows, reverse=True) for w in self.windows[level]]
        gaps = [self.size - sum(map(len, w)) for w in rest]
        first, last = 0, len(rest) - 1
        while first < last:
            piece = rest[last].pop()
            if len(piece) > gaps[first]:
                piece, back = piece.cut(gaps[first])
                rest[last].append(back)
            rest[first].append(piece)
            gaps[first] -= len(piece)
            gaps[last] += len(piece)
            last -= not rest[last]
            first += gaps[first] == 0
        out = self.take() + [w for w, gap in zip(rest, gaps) if gap == 0]
        pieces = [p for w, gap in zip(rest, gaps) if 0 < gap < self.size for p in w]
        left = sum(map(len, pieces))
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window: list[Piece] = []
            while room:
                piece = pieces.pop(0)
                if len(piece) > room:
                    piece, back = piece.cut(room)
                    pieces.insert(0, back)
                window.append(piece)
                room -= len(piece)
            out.append(window)
        self.windows, self.n_open = {}, 0
        self.count[:] = 0
        return out


def _rows(windows: list[list[Piece]], first: int, with_ids: bool) -> pa.RecordBatch:
    rows = []
    for number, window in enumerate(windows, first):
        offset = 0
        for p in window:
            rows.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, number, offset, p.ids))
            offset += len(p)
    columns = list(zip(*rows)) or [()] * 8
    arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    if with_ids:
        arrays.append(pa.array(columns[7], pa.binary()))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def pack_documents(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 2,
    size: int = 4096,
    max_open: int = 512,
    with_ids: bool = True,
) -> DataFrame:
    """Sequences of at most ``size`` tokens from ``docs(doc_id, text)``: one row per piece of a document.

    Every task packs the rows it reads, one after the other, and shuffles nothing; its own sequence
    numbers stand above its partition number. ``ids`` holds a piece's ids as unsigned 32-bit integers.

    Defined cases: a null or empty text is the end id alone; a document longer than a sequence first fills
    whole ones; rows that repeat a doc_id are documents of their own; a null doc_id stays null; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = word_encoder(tokenizer, end_id), LevelPacker(size, max_open)
        number = TaskContext.get().partitionId() << _SEQUENCE_BITS
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py())
                packer.add(Piece(doc_id, 0, ids, len(ids) // 4))
            done = packer.take()
            yield _rows(done, number, with_ids)
            number += len(done)
        yield _rows(packer.drain(), number, with_ids)

    schema = _SCHEMA + (", ids binary" if with_ids else "")
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, schema)
