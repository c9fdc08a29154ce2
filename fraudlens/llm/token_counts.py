"""Exact token counts at every prefix of a text, by dynamic programming over its bytes."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import sub

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from fraudlens.llm.tokens import Known, byte_letters

# Fixed value: how the tokenizer cuts text into pieces that no token spans.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_CONTRACTIONS = frozenset((b"'re", b"'ve", b"'ll"))


class PrefixCounter:
    """Counts for byte-level BPE tokenizers of the ``tokenizers`` library.

    The encoding of a prefix ends in the one token that is a suffix of it and may follow the last token of
    the prefix before; two tokens may follow each other if the library encodes their joint bytes as just
    these two. So the count at a prefix is the count before its last token plus one. States of prefixes
    are shared by all pieces that begin alike. A text is kept as the change of the count from byte to byte.
    """

    def __init__(self, file: str = "byte_bpe_50k.json", limit: int = 250_000):
        path = public_tokenizers.path(file)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        self.letters = byte_letters()
        back = {c: b for b, c in enumerate(self.letters)}
        self.specials = sorted((t["content"] for t in described["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        vocabulary = described["model"]["vocab"]
        self.token = {
            bytes(back[c] for c in t): i for t, i in vocabulary.items() if all(c in back for c in t)
        }
        self.longest = max(map(len, self.token))
        self.encode = self.tokenizer.model.tokenize
        self.pieces = regex.compile(PIECES)
        self.state: dict[bytes, tuple[bytes, int, bytes]] = {b"": (b"", 0, b"")}
        self.follows = Known(self._check_pair, 4 * limit)
        self.words = Known(self._unit, limit)
        self.parts = Known(self._part, limit)
        self.limit = limit

    def _check_pair(self, pair: tuple[bytes, bytes]) -> bool:
        """Whether the second token may follow the first (nothing: begin a piece)."""
        ids = [t.id for t in self.encode("".join([self.letters[b] for b in pair[0] + pair[1]]))]
        return ids == [self.token[x] for x in pair if x]

    def _step(self, prefix: bytes, last: bytes) -> tuple[bytes, int]:
        """Last token and count of a prefix; ``last`` is the last token of the prefix one byte shorter.

        Just one token fits, so the likely ones are tried first: the last token made longer, then a new one.
        """
        n = len(prefix)
        longer = n - 1 - len(last)
        for first in (longer, n - 1, *range(max(0, n - self.longest), n)):
            token = prefix[first:]
            if token in self.token:
                before = self.state[prefix[:first]]
                if self.follows[before[0], token]:
                    return token, before[1] + 1
        raise ValueError(f"no token ends {prefix!r}")

    def _piece(self, piece: bytes) -> bytes:
        """Changes of the count over the bytes of a piece."""
        if piece in _LONG_CONTRACTIONS:  # cut short, it is an apostrophe and a letter
            whole = sum(_numbers(self._run(piece)))
            return _deltas([1, 2, whole])
        return self._run(piece)

    def _run(self, piece: bytes) -> bytes:
        """The same without that rule; prefixes are kept with their last token, count and changes."""
        if len(piece) > 64:  # rare: not kept, as its prefixes take the square of its length
            return self._long_run(piece)
        state = self.state
        if len(state) > 4 * self.limit:
            state.clear()
            state[b""] = (b"", 0, b"")
        n = at = len(piece)
        while piece[:at] not in state:
            at -= 1
        last, count, changes = state[piece[:at]]
        for i in range(at + 1, n + 1):
            prefix = piece[:i]
            last, now = self._step(prefix, last)
            changes += _CHANGE[now - count] if -99 < now - count < 99 else struct.pack("<h", now - count)
            count = now
            state[prefix] = (last, count, changes)
        return changes

    def _long_run(self, piece: bytes) -> bytes:
        last, counts = [b""], [0]
        for i in range(1, len(piece) + 1):
            for first in range(max(0, i - self.longest), i):
                token = piece[first:i]
                if token in self.token and self.follows[last[first], token]:
                    last.append(token)
                    counts.append(counts[first] + 1)
                    break
        return _deltas(counts[1:])

    def _ordinary(self, text: str) -> list[int]:
        """Counts at all byte prefixes of a text without special tokens."""
        counts, total = [], 0
        run, run_start = b"", 0  # white space that ends what is done, and the total before it
        for piece in self.pieces.findall(text):
            data = piece.encode()
            own = list(accumulate(_numbers(self._piece(data))))
            here = [total + c for c in own]
            blank = piece.isspace()
            if run and (blank or piece[0] == " "):  # cut behind this white space, the run is one piece
                k = len(data) if blank else 1
                joined = list(accumulate(_numbers(self._run(run + data[:k]))))
                here[:k] = [run_start + c for c in joined[len(run) :]]
            if blank and not run:
                run_start = total
            run = run + data if blank else b""
            total += own[-1]
            counts += here
        return counts

    def counts(self, text: str | None) -> list[int]:
        """The exact count at each byte prefix of a text; the last one is the text's count."""
        text = text or ""
        out: list[int] = []
        base = 0
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            segment = text[at : found.start()]
            # cut inside, a special string is ordinary text
            inside = self._ordinary(segment + found[0][:-1])
            n = len(segment.encode())
            before = inside[n - 1] if n else 0
            out += [base + c for c in inside] + [base + before + 1]
            base += before + 1
            at = found.end()
        out += [base + c for c in self._ordinary(text[at:])]
        return out

    def _part(self, piece: str) -> bytes:
        return self._piece(piece.encode())

    def _unit(self, unit: str) -> bytes | None:
        """Changes over a space and the word behind it; None if more white space touches the space."""
        if not unit or unit[0].isspace() or unit[-1].isspace():
            return None
        if unit.isalpha():
            return self.parts[" " + unit]
        if unit[-1] in ".,;:!?" and unit[:-1].isalpha():
            return self.parts[" " + unit[:-1]] + self.parts[unit[-1]]
        if len(unit.split()) > 1:
            return _deltas(self._ordinary(" " + unit))
        return b"".join([self.parts[p] for p in self.pieces.findall(" " + unit)])

    def deltas(self, text: str | None) -> bytes:
        """Changes of the count from byte to byte, as 16-bit integers.

        Words and the single space before them are units whose changes never depend on their neighbours,
        so they are looked up; a text with other white space around spaces goes through ``counts``.
        """
        if not text:
            return b""
        first, *units = text.split(" ")
        if (first and first[-1].isspace()) or any(s in text for s in self.specials):
            return _deltas(self.counts(text))
        try:
            return _deltas(self._ordinary(first)) + b"".join(map(self.words.__getitem__, units))
        except TypeError:  # a unit that is None
            return _deltas(self.counts(text))


_CHANGE = {d: struct.pack("<h", d) for d in range(-99, 100)}


def _numbers(changes: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(changes) // 2}h", changes)


@lru_cache(maxsize=4)
def prefix_counter(file: str) -> PrefixCounter:
    """One counter for all tasks of a Python worker, so that words learnt in one serve the next."""
    return PrefixCounter(file)


def _deltas(counts: list[int]) -> bytes:
    return struct.pack(f"<{len(counts)}h", *map(sub, counts, [0, *counts]))


def prefix_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", with_prefixes: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` with n_bytes, n_tokens and, if asked for, ``prefixes``: the counts at every byte.

    ``prefixes`` holds the changes of the count from byte to byte as 16-bit integers, compressed; ``count_at``
    and ``longest_prefix`` read it. Every row is handled where it is read.

    Defined cases: a null text is empty and has no tokens; special strings in a text count as the library
    takes them by default; repeated and null doc_ids pass through; an empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, packer = prefix_counter(tokenizer), zstandard.ZstdCompressor(1)
        for batch in batches:
            sizes, totals, kept = [], [], []
            for text in batch.column(1):
                deltas = counter.deltas(text.as_py())
                sizes.append(len(deltas) // 2)
                totals.append(int(np.frombuffer(deltas, "<i2").sum(dtype=np.int64)))
                if with_prefixes:
                    kept.append(packer.compress(deltas))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens"]
            if with_prefixes:
                arrays.append(pa.array(kept, pa.binary()))
                names.append("prefixes")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, n_bytes long, n_tokens long" + (", prefixes binary" if with_prefixes else "")
    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, schema)


def stored_counts(prefixes: bytes) -> np.ndarray:
    """Counts at every byte prefix, from the empty one on."""
    deltas = np.frombuffer(zstandard.decompress(prefixes), "<i2")
    return np.concatenate(([0], np.cumsum(deltas, dtype=np.int64)))


def count_at(prefixes: bytes, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes of a text."""
    return int(stored_counts(prefixes)[n_bytes])


def longest_prefix(prefixes: bytes, budget: int) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens; counts may fall, so the last such byte."""
    return int(np.flatnonzero(stored_counts(prefixes) <= budget)[-1])


def answer_budgets(stored: DataFrame, budget: int) -> DataFrame:
    """From stored ``(doc_id, prefixes)``: doc_id, n_bytes, n_tokens and budget_bytes, without looking at a text.

    ``budget_bytes`` is the length of the longest prefix of at most ``budget`` tokens.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for kept in batch.column(1):
                counts = stored_counts(kept.as_py())
                rows.append((len(counts) - 1, int(counts[-1]), int(np.flatnonzero(counts <= budget)[-1])))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_tokens", "budget_bytes"])

    return stored.select("doc_id", "prefixes").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, budget_bytes long")
