"""A wavelet matrix over token ids: bit planes with rank and select, in one file."""

from __future__ import annotations

import json

import numpy as np
import zstandard

MAGIC = b"WVMX0001"
_BLOCK = 512  # bits between two entries of a rank directory


class WaveletMatrix:
    """Tokens ``0..n-1`` of a shard by bit planes, highest bit first; within each plane zeros go first.

    ``planes[k]`` are packed bits, ``ranks[k][j]`` counts the ones before bit ``512 * j``, ``zeros[k]`` the zeros.
    """

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.ranks, self.zeros = n, planes, ranks, zeros

    @staticmethod
    def build(ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        width = int(ids.max()).bit_length() if n else 0
        ids = np.ascontiguousarray(ids, np.uint16 if width <= 16 else np.uint32)
        planes, ranks, zeros = [], [], []
        for k in range(width - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << k)) != 0
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % (_BLOCK // 8)))
            ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, _BLOCK // 64).sum(1, dtype=np.uint32)
            planes.append(packed)
            ranks.append(np.concatenate(([0], np.cumsum(ones))).astype(np.uint32))
            zeros.append(n - int(ranks[-1][-1]))
            if k:
                ids = np.concatenate((np.compress(~bit, ids), np.compress(bit, ids)))
        return WaveletMatrix(n, planes, ranks, zeros)

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        """Ones of plane k before each bit i."""
        i = np.asarray(i, np.int64)
        block, rest = i // _BLOCK, i % _BLOCK
        out = self.ranks[k][block].astype(np.int64)
        for byte in range(_BLOCK // 8):
            used = np.clip(rest - 8 * byte, 0, 8)
            if not used.any():
                break
            at = np.minimum(block * (_BLOCK // 8) + byte, max(len(self.planes[k]) - 1, 0))
            out += np.bitwise_count(self.planes[k][at] & ((1 << used) - 1).astype(np.uint8))
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        """Tokens at positions i."""
        i = np.asarray(i, np.int64)
        value = np.zeros(len(i), np.uint32)
        for k in range(len(self.planes)):
            bit = (self.planes[k][i >> 3] >> (i & 7).astype(np.uint8)) & 1
            ones = self._ones(k, i)
            value = (value << 1) | bit
            i = np.where(bit == 1, self.zeros[k] + ones, i - ones)
        return value

    def tokens(self) -> np.ndarray:
        """All tokens, in order."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        value = np.zeros(self.n, kind)
        # upwards from the lowest plane: what stands below it as zeros, then ones, goes back to their places
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[~bit] = value[:zeros]
            above[bit] = value[zeros:] | kind(1 << k)
            value = above
        return value.astype(np.uint32)

    def _range(self, token: int, first: int, last: int) -> tuple[int, int]:
        """Where the occurrences of a token in ``[first, last)`` stand below the lowest plane."""
        if token < 0 or token.bit_length() > len(self.planes):
            return 0, 0
        for k in range(len(self.planes)):
            a, b = self._ones(k, np.array([first, last]))
            if (token >> (len(self.planes) - 1 - k)) & 1:
                first, last = self.zeros[k] + a, self.zeros[k] + b
            else:
                first, last = first - a, last - b
        return int(first), int(last)

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """How often a token occurs in ``[first, last)``."""
        a, b = self._range(token, first, self.n if last is None else last)
        return b - a

    def _select(self, k: int, j: np.ndarray, bit: int) -> np.ndarray:
        """Position in plane k of the j-th (from 0) bit of that value."""
        starts = np.minimum(np.arange(len(self.ranks[k]), dtype=np.int64) * _BLOCK, self.n)
        before = self.ranks[k].astype(np.int64) if bit else starts - self.ranks[k]
        block = np.searchsorted(before, j, side="right") - 1
        left = j - before[block]
        at = block[:, None] * (_BLOCK // 8) + np.arange(_BLOCK // 8)
        bits = np.unpackbits(self.planes[k][at], axis=1, bitorder="little") == bit
        return block * _BLOCK + np.argmax(np.cumsum(bits, axis=1, dtype=np.int32) == left[:, None] + 1, axis=1)

    def locate(self, token: int) -> np.ndarray:
        """Positions of a token, ascending: its place below the last plane carried up by select."""
        a, b = self._range(token, 0, self.n)
        out = []
        for first in range(a, b, 65_536):
            at = np.arange(first, min(b, first + 65_536), dtype=np.int64)
            for k in range(len(self.planes) - 1, -1, -1):
                bit = (token >> (len(self.planes) - 1 - k)) & 1
                at = self._select(k, at - self.zeros[k] if bit else at, bit)
            out.append(at)
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def to_bytes(matrix: WaveletMatrix, doc_ids: list, lengths: list[int]) -> bytes:
    """The file of a shard: a header, the documents, then each plane with its rank directory."""
    table = zstandard.compress(json.dumps({"doc_ids": doc_ids, "lengths": lengths}).encode())
    head = json.dumps({"n": matrix.n, "zeros": matrix.zeros, "table": len(table)}).encode()
    parts = [MAGIC, len(head).to_bytes(8, "little"), head, table]
    for plane, rank in zip(matrix.planes, matrix.ranks):
        parts += [plane.tobytes(), rank.tobytes()]
    return b"".join(parts)


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list, list[int]]:
    """What ``to_bytes`` wrote: the matrix, doc_ids and lengths."""
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    at = 16 + int.from_bytes(data[8:16], "little")
    head = json.loads(data[16:at])
    table = json.loads(zstandard.decompress(data[at : at + head["table"]]))
    at += head["table"]
    blocks = -(-head["n"] // _BLOCK)
    planes, ranks = [], []
    for _ in head["zeros"]:
        planes.append(np.frombuffer(data, np.uint8, blocks * _BLOCK // 8, at))
        at += blocks * _BLOCK // 8
        ranks.append(np.frombuffer(data, np.uint32, blocks + 1, at))
        at += 4 * (blocks + 1)
    return WaveletMatrix(head["n"], planes, ranks, head["zeros"]), table["doc_ids"], table["lengths"]
