"""Periodic runs of words: block convolution at dyadic scales finds the distances at which blocks come again.

A run of period q holds two equal stretches of q words, one behind the other. For 2B <= q < 4B the first of
them holds a whole block of a grid of B words, and that block comes again q words later. So, for B = 8, 16, 32 ...,
every block is slid over the words 2B to 5B behind its start; the sum of squared differences of word numbers at each
distance comes from an integer transform, and it is 0 where the block comes again. Such a distance is a seed, which
is extended to both sides as far as words that far apart are equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.columns import hide

# A prime with roots of unity of every order 2**k, k <= 23, and one of its primitive roots.
PRIME = 998_244_353
PRIMITIVE_ROOT = 3

BLOCK = 8  # words of the smallest block; periods under twice as many words are compared word by word
_BATCH = 1 << 16  # words looked at together; a longer document is a batch of its own
_CELLS = 1 << 20  # numbers of a transform held at a time


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for unsigned x below its double."""
    return np.minimum(x, x - np.uint64(PRIME))


def _times(a: np.ndarray, b) -> np.ndarray:
    product = a * b
    return product - product // np.uint64(PRIME) * np.uint64(PRIME)


class Transform:
    """The number-theoretic transform of rows of ``size`` (a power of two) numbers, and its inverse.

    ``forward`` leaves its result in bit-reversed order, which ``backward`` expects.
    """

    def __init__(self, size: int):
        self.size = size
        self.scale = np.uint64(pow(size, -1, PRIME))
        self.forward_roots, self.backward_roots = [], []
        m = size
        while m > 1:
            root = pow(PRIMITIVE_ROOT, (PRIME - 1) // m, PRIME)
            self.forward_roots.append(self._powers(root, m // 2))
            self.backward_roots.append(self._powers(pow(root, -1, PRIME), m // 2))
            m //= 2

    @staticmethod
    def _powers(root: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:  # by doubling
            out = np.concatenate((out, _times(out, np.uint64(pow(root, len(out), PRIME)))))
        return out[:n]

    def forward(self, rows: np.ndarray) -> np.ndarray:
        a, m = rows, self.size
        for roots in self.forward_roots:
            pairs = a.reshape(len(rows), -1, 2, m // 2)
            u, v = pairs[:, :, 0], pairs[:, :, 1]
            out = np.empty_like(pairs)
            out[:, :, 0] = _reduced(u + v)
            out[:, :, 1] = _times(u + np.uint64(PRIME) - v, roots)
            a, m = out, m // 2
        return a.reshape(len(rows), self.size)

    def backward(self, rows: np.ndarray) -> np.ndarray:
        a, m = rows, 2
        for roots in reversed(self.backward_roots):
            pairs = a.reshape(len(rows), -1, 2, m // 2)
            u, v = pairs[:, :, 0], _times(pairs[:, :, 1], roots)
            out = np.empty_like(pairs)
            out[:, :, 0] = _reduced(u + v)
            out[:, :, 1] = _reduced(u + np.uint64(PRIME) - v)
            a, m = out, 2 * m
        return _times(a.reshape(len(rows), self.size), self.scale)


def zero_distances(words: np.ndarray, starts: np.ndarray, block: int, transform: Transform) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of blocks that come again ``2 * block`` to ``4 * block - 1`` words later.

    ``words`` are numbers that reach ``5 * block`` beyond every start. Sums of squared differences are exact modulo
    the prime: none that is 0 is missed; one that only divides by it ends at once when it is extended.
    """
    out_start, out_distance = [], []
    step = max(1, _CELLS // transform.size)
    for first in range(0, len(starts), step):
        at = starts[first : first + step, None]
        pattern = np.zeros((len(at), transform.size), np.uint64)
        pattern[:, :block] = words[at + np.arange(block - 1, -1, -1)]
        window = np.zeros((len(at), transform.size), np.uint64)
        window[:, : 3 * block] = words[at + 2 * block + np.arange(3 * block)]
        squares = np.zeros((len(at), 3 * block + 1), np.uint64)
        np.cumsum(_times(window[:, : 3 * block], window[:, : 3 * block]), axis=1, out=squares[:, 1:])
        total = (squares[:, block : 3 * block] - squares[:, : 2 * block]) + _times(pattern, pattern).sum(1, keepdims=True)
        both = transform.backward(_times(transform.forward(pattern), transform.forward(window)))
        zero = total % np.uint64(PRIME) == _times(both[:, block - 1 : 3 * block - 1], np.uint64(2))
        row, shift = np.nonzero(zero)
        out_start.append(at[row, 0])
        out_distance.append(shift + 2 * block)
    if not out_start:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_start), np.concatenate(out_distance)


class EqualLengths:
    """How far two places of a sequence go on alike, to the right or to the left.

    Level k numbers the different strings of 2**k words; two places are equal for 2**k words where the numbers are.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        rank = np.unique(words, return_inverse=True)[1]
        self.levels, size = [rank.astype(np.int32)], 1
        while 2 * size <= self.n and rank.max(initial=0) + 1 < len(rank):
            pair = rank[: len(rank) - size].astype(np.int64) << 32 | rank[size:]
            rank, size = np.unique(pair, return_inverse=True)[1], 2 * size
            self.levels.append(rank.astype(np.int32))

    def _same(self, rank: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        known = (i >= 0) & (j < len(rank))
        return known & (rank[np.where(known, i, 0)] == rank[np.where(known, j, 0)])

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from ``i`` and ``j`` > i on."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            out += self._same(self.levels[k], i + out, j + out).astype(np.int64) << k
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words before ``i`` and ``j`` > i."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            size = 1 << k
            out += self._same(self.levels[k], i - out - size, j - out - size).astype(np.int64) << k
        return out


def _close(words: np.ndarray, most: int, least: int) -> Iterator[np.ndarray]:
    """Rows (start, end, period) of periods up to ``most``: stretches equal to themselves a few words later."""
    for d in range(1, min(most, len(words) - 1) + 1):
        equal = words[:-d] == words[d:]
        if not equal.any():
            continue
        change = np.flatnonzero(equal[1:] != equal[:-1]) + 1
        edges = np.concatenate(([0] if equal[0] else [], change, [len(equal)] if equal[-1] else [])).astype(np.int64)
        begin, end = edges[::2], edges[1::2] + d
        long = end - begin >= max(least, 2 * d)
        if long.any():
            yield np.column_stack((begin[long], end[long], np.full(int(long.sum()), d)))


def _recurring(words: np.ndarray, block: int, reach: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Starts of the blocks all of whose words come again 2 to 4 blocks later; the others match nowhere there."""
    n = len(words) // block * block
    blocks = np.flatnonzero(reach[:n].reshape(-1, block).min(1) >= 2 * block)
    if not len(blocks):
        return blocks
    at = (blocks[:, None] * block + np.arange(block)).ravel()
    wanted = words[at] << 32 | (at + 2 * block)
    found = np.searchsorted(key, wanted)
    again = key[np.minimum(found, len(key) - 1)]
    there = (found < len(key)) & (again < wanted + 2 * block)
    return blocks[there.reshape(-1, block).all(1)] * block


def _number(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, none shared by two texts, and where each text begins and ends."""
    numbers: list[int] = []
    edges, base = [0], 0
    for words in texts:
        table: dict[bytes, int] = {}
        numbers += [table.setdefault(w, base + len(table)) for w in words]
        base += len(table)
        edges.append(len(numbers))
    return np.array(numbers, np.int64), np.array(edges, np.int64)


def runs_of(texts: list[list[bytes]], least: int = 12) -> list[np.ndarray]:
    """All runs of each text as rows (start, length, period), by start, then period.

    A run is a stretch with smallest period q, at least ``least`` and 2q words long, that no neighbouring word
    extends keeping the period.
    """
    words, edges = _number(texts)
    found = list(_close(words, 2 * BLOCK - 1, least))
    longest = int(np.diff(edges).max(initial=0))
    seeds = list(_seeds(words, longest)) if longest >= 4 * BLOCK else []
    if seeds:
        found.append(_extended(words, edges, *(np.concatenate(c) for c in zip(*seeds))))
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(least, 2 * rows[:, 2])]
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)  # of one stretch's periods the smallest, which divides the others
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    owner = np.searchsorted(edges, rows[:, 0], side="right") - 1
    rows = np.column_stack((rows[:, 0] - edges[owner], rows[:, 1] - rows[:, 0], rows[:, 2]))
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _seeds(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, distance) of blocks that come again, scale by scale."""
    place = np.arange(len(words))
    last = np.zeros(int(words.max()) + 1, np.int64)
    last[words] = place  # of a repeated index the last value stays
    reach = last[words] - place
    order = np.argsort(words, kind="stable")
    key = words[order] << 32 | order  # places of each word, in order
    padded = np.concatenate((words, words.max() + 1 + np.arange(2 * longest + 5))).astype(np.uint64)
    block = BLOCK
    while 4 * block <= longest:
        starts = _recurring(words, block, reach, key)
        if len(starts):
            start, distance = zero_distances(padded, starts, block, Transform(4 * block))
            if len(start):
                yield start, distance
        block *= 2


def _extended(words: np.ndarray, edges: np.ndarray, start: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Seeds as rows (start, end, period) of the whole stretch in which words keep the distance."""
    owner = np.searchsorted(edges, start, side="right") - 1
    some = np.unique(owner)
    size = np.diff(edges)[some]
    moved = np.zeros(len(edges), np.int64)  # texts without a seed are left out
    moved[some] = edges[some] - (np.cumsum(size) - size)
    kept = np.repeat(moved[some], size) + np.arange(size.sum())
    lengths = EqualLengths(words[kept])
    shift = moved[owner]
    rows = []
    for first in range(0, len(start), _CELLS):
        i, d, s = start[first : first + _CELLS], distance[first : first + _CELLS], shift[first : first + _CELLS]
        left, right = lengths.left(i - s, i - s + d), lengths.right(i - s, i - s + d)
        row = np.column_stack((i - left, i + d + right, d))
        rows.append(np.unique(row[right > 0], axis=0))
    return np.concatenate(rows)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds behind its first period, joined by spaces."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, n in zip(words, np.cumsum(edges).tolist()) if not n])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batch(ids: list, texts: list[list[bytes]], least: int) -> pa.RecordBatch:
    found = runs_of(texts, least)
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    ends = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
    parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], fields=list(_RUN))
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.ListArray.from_arrays(pa.array(ends), parts),
        pa.array([collapsed(t, r).decode() for t, r in zip(texts, found)], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length, period; words from 0) and the text collapsed.

    Words are what stands between ASCII white space. ``runs`` holds every run of at least ``least`` words, by
    start, then period; ``collapsed`` joins by spaces the words that no run holds behind its first period.
    Tasks take documents as they read them; nothing is shuffled.

    Defined cases: a null or empty text has no words, no runs and an empty collapsed text; one very long text is looked
    at whole; rows that repeat a doc_id are documents of their own; a null doc_id stays null; an
    empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: list = []
            texts: list[list[bytes]] = []
            n = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts.append((text.as_py() or "").encode().split())
                ids.append(doc_id)
                n += len(texts[-1])
                if n >= _BATCH:
                    yield _batch(ids, texts, least)
                    ids, texts, n = [], [], 0
            if ids:
                yield _batch(ids, texts, least)

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    rows = hide(docs, "doc_id", "text")[0]
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)``, the text of one in ten made periodic from some word on.

    With h the crc32 of the decimal doc_id and g = h div 10: where h mod 10 is 0, word i >= a becomes word
    a + (i - a) mod p, for a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Texts without words and
    rows without doc_id stay.
    """
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"))
    rows = rows.withColumn("words", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words))
    planted = F.expr(
        "transform(sequence(0, size(words) - 1), i -> words[IF(i < a, i, a + (i - a) % p)])"
    )
    rows = rows.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("IF(n > 0, g % n, 0)").cast("int"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)").cast("int"))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document its number of runs, its longest run and digests of all runs and of the collapsed text."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    rows = found.withColumn("longest", longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "collapsed",
    )
