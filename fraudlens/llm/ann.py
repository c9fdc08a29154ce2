"""Approximate nearest neighbours: p-stable hashing, probing buckets in the order of their estimated success."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.vectors import Found, Ids, matrix, prepare, ranked, search_blocks, top, usable
from fraudlens.session import stage

_WIDTH = 1.0
_BITS = 2.05  # what one hash function of that width tells about a unit vector
_LIST = 4096  # best buckets that are kept while functions are combined


def tamed(v: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares of their components neither vanish nor overflow; cosines stay."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, initial=0))[1][:, None])


class Hashes:
    """``tables`` tables of ``functions`` hashes floor((a.v + b) / width) with normal a, on unit vectors."""

    def __init__(self, tables: int, functions: int, seed: int = 7):
        self.tables, self.functions, self.seed = tables, functions, seed
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _made(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        if d not in self.made:
            rng = np.random.default_rng((self.seed, d))
            shape = (self.tables, self.functions)
            self.made[d] = rng.standard_normal((*shape, d)), rng.random(shape) * _WIDTH
        return self.made[d]

    def project(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a.v, b) for all rows, tables and functions."""
        a, b = self._made(v.shape[1])
        v = tamed(v)
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        return np.einsum("nd,tfd->ntf", unit, a), b

    def name(self, cells: np.ndarray, table: np.ndarray, d: int) -> np.ndarray:
        """A 64-bit name for buckets; those of a shared name are searched together, which only adds candidates."""
        out = np.full(len(cells), d, np.uint64) * np.uint64(1000) + table.astype(np.uint64)
        for j in range(cells.shape[1]):
            out = (out ^ cells[:, j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return out.view(np.int64)

    def buckets(self, v: np.ndarray) -> np.ndarray:
        """Bucket names, one column per table."""
        at, b = self.project(v)
        cells = np.floor((at + b) / _WIDTH)
        return np.stack(
            [self.name(cells[:, t], np.full(len(v), t), v.shape[1]) for t in range(self.tables)], axis=1
        )

    def probes(self, v: np.ndarray, cosine: np.ndarray, success: float, most: int | None = None) -> list[np.ndarray]:
        """For each row the names of buckets to visit, over all tables.

        If a neighbour has cosine c, its a.p is normal around c * a.q with variance 1 - c * c. So each cell of a
        function has a probability, a bucket has their product, and buckets are visited from the likeliest
        on until a table's sum reaches ``success`` (or ``most`` are taken). Only the ``_LIST`` likeliest are known;
        a row that needs more in some table gets none at all, unless ``most`` is given.
        """
        at, b = self.project(v)
        spread = np.sqrt(np.maximum(1 - cosine**2, 1e-6))
        out = []
        for i in range(len(v)):
            names: list[np.ndarray] = []
            for t in range(self.tables):
                chance, cells = np.ones(1), np.zeros((1, 0), np.int64)
                for j in range(self.functions):
                    middle, s = cosine[i] * at[i, t, j] + b[t, j], spread[i]
                    first, last = math.floor((middle - 4 * s) / _WIDTH), math.floor((middle + 4 * s) / _WIDTH)
                    edges = (np.arange(first, last + 2) * _WIDTH - middle) / s
                    p = np.diff([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in edges])
                    both = np.outer(chance, p).ravel()
                    best = np.argsort(-both, kind="stable")[:_LIST]
                    chance = both[best]
                    cells = np.column_stack((cells[best // len(p)], first + best % len(p)))
                n = int(np.searchsorted(np.cumsum(chance), success)) + 1
                if most is None and n > len(cells):
                    names = [np.zeros(0, np.int64)]
                    break
                cells = cells[: min(n, most or n)]
                names.append(self.name(cells, np.full(len(cells), t), v.shape[1]))
            out.append(np.concatenate(names))
        return out


def _indexed(groups: DataFrame, hashes: Hashes) -> DataFrame:
    kept = ["gid", "first", "second", "vec"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _one_length(batch, "vec"):
                names = hashes.buckets(matrix(part.column("vec")))
                for t in range(hashes.tables):
                    yield pa.RecordBatch.from_arrays([pa.array(names[:, t]), *part.columns], ["block", *kept])

    return groups.select(*kept).mapInArrow(run, "block long, gid long, first long, second long, vec array<double>")


def _one_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch by the length of their vectors."""
    size = np.diff(np.asarray(batch.column(column).offsets))
    for d in np.unique(size):
        yield batch.take(pa.array(np.flatnonzero(size == d)))


def _probed(asking: DataFrame, hashes: Hashes, success: float, most: int | None) -> DataFrame:
    """A row (block, uid) per bucket to visit, from (uid, vec, cosine)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in _one_length(batch, "vec"):
                for first in range(0, whole.num_rows, 256):
                    part = whole.slice(first, 256)
                    cosine = np.asarray(part.column("cosine"))
                    names = hashes.probes(matrix(part.column("vec")), cosine, success, most)
                    uid = np.repeat(np.asarray(part.column("uid")), [len(n) for n in names])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names)), pa.array(uid)], ["block", "uid"])

    return asking.select("uid", "vec", "cosine").mapInArrow(run, "block long, uid long")


def _salted(index: DataFrame, most: int):
    """Deal buckets of more than ``most`` rows into several blocks; returns the index and what a probe must become."""
    sizes = index.groupBy("block").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    large = stage(sizes.select("block", F.ceil(F.col("_n") / most).cast("int").alias("_parts")), "large-buckets")
    if large.isEmpty():
        return index, lambda probes: probes
    part = F.pmod(F.xxhash64("gid"), F.col("_parts"))
    name = lambda number: F.when(F.col("_parts").isNull(), F.col("block")).otherwise(F.xxhash64("block", number))
    dealt = index.join(large, "block", "left").withColumn("block", name(part.cast("int"))).drop("_parts")

    def to_all(probes: DataFrame) -> DataFrame:
        numbers = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)).alias("_number")
        wide = probes.join(large, "block", "left").select("*", numbers)
        return wide.withColumn("block", name(F.col("_number"))).drop("_parts", "_number")

    return dealt, to_all


def _cosines(k: int):
    def build(gids: np.ndarray, ids: Ids, rows: np.ndarray):
        rows = tamed(rows)
        norms = np.linalg.norm(rows, axis=1)
        alone = np.flatnonzero(~ids.more)
        alone = alone[np.argsort(ids.first[alone], kind="stable")]  # by their only id
        only = ids.first[alone]

        def ask(query: np.ndarray, own: np.ndarray, vec: np.ndarray) -> Found:
            out = []
            for first in range(0, len(query), 512):
                q, mine = tamed(vec[first : first + 512]), own[first : first + 512]
                score = (q @ rows.T) / (np.linalg.norm(q, axis=1)[:, None] * norms)
                begin, end = np.searchsorted(only, mine), np.searchsorted(only, mine, "right")
                for i in np.flatnonzero(end > begin).tolist():
                    score[i, alone[begin[i] : end[i]]] = -np.inf  # vectors of the query's own id alone
                n = min(k, len(gids))
                worst = -np.partition(-score, n - 1, axis=1)[:, n - 1 : n]
                i, j = np.nonzero((score >= worst) & (score > -np.inf))  # all ties of the kth
                out.append((query[first + i], gids[j], ids.counting(j, mine[i])[0], score[i, j]))
            return tuple(np.concatenate(c) for c in zip(*out))

        return ask

    return build


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    tables: int = 4,
    bucket_rows: int = 256,
    success: float = 0.97,
    most: int = 16_384,
) -> DataFrame:
    """Each query row's ``k`` rows of largest cosine found: query_id, rank, vec_id, score.

    Every different vector is put into a bucket of each table; the number of hash functions follows the number of
    vectors, so a bucket has about ``bucket_rows``. Queries first visit their four likeliest buckets a table. The
    worst of the ``k`` cosines found there is at most that of the true ones, so for it buckets are visited
    until a neighbour is met in some table with probability ``success``. All rows of a visited bucket are compared by
    exact cosine. Buckets of more than ``most`` rows are split over blocks that all get the query. Queries for which
    the known buckets do not reach ``success``, and those that find too few results, are put to all rows. Nothing is
    fitted on a sample.

    Defined cases: ids that are null, and vectors that are null, empty, zero or hold null or non-finite components,
    take no part; components may be as small or large as doubles are; only vectors of one length are compared; rows
    equal in id and vector are one row; a row with the query's id is no candidate; an id on several vectors is several
    candidates and one query, whose vectors' results are ranked together; ties go to smaller ids; fewer than ``k``
    candidates are all returned; an empty table gives no rows; other columns are ignored.
    """
    rows = usable(vectors, id_column, vector_column).filter(F.exists("vec", lambda x: x != 0))
    groups, units = prepare(rows, is_query, k)
    n = groups.count()
    functions = max(0, round(math.log2(max(n, 1) / bucket_rows) / _BITS)) if n > 2 * bucket_rows else 0
    hashes = Hashes(tables if functions else 1, functions)
    index, to_all = _salted(stage(_indexed(groups, hashes), "buckets"), most)
    build = _cosines(k)
    found = None
    asking = units.select("uid", "vec")
    if functions:
        probes = stage(to_all(_probed(asking.withColumn("cosine", F.lit(0.5)), hashes, 1.0, 4)), "first-probes")
        found = stage(top(search_blocks(index, probes, units, build, k), k), "first-found")
        worst = found.groupBy(F.col("query").alias("uid")).agg(F.min("score").alias("_s"), F.count(F.lit(1)).alias("_n"))
        cosine = F.when(F.col("_n") >= k, F.least(F.greatest("_s", F.lit(0.0)), F.lit(0.999)))
        asking = asking.join(worst, "uid", "left").withColumn("cosine", F.coalesce(cosine, F.lit(0.0)))
    else:
        asking = asking.withColumn("cosine", F.lit(0.0))
    each = 1 - (1 - success) ** (1 / hashes.tables)
    probes = stage(to_all(_probed(asking, hashes, each, None)), "probes")
    second = stage(top(search_blocks(index, probes, units, build, k), k), "found")
    few = units.join(second.groupBy(F.col("query").alias("uid")).count(), "uid", "left")
    few = few.filter(f"coalesce(count, 0) < {k}").select("uid")  # also those without buckets
    found = second if found is None else found.unionByName(second)
    if functions and not few.isEmpty():
        blocks = max(1, -(-n // most))
        number = F.pmod(F.xxhash64("gid"), F.lit(blocks)).cast("long")
        width = F.size("vec").cast("long") * (1 << 32)
        all_rows = groups.withColumn("block", width + number)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_number")
        left = units.join(few, "uid").select("uid", "vec", every).select((width + F.col("_number")).alias("block"), "uid")
        found = found.unionByName(search_blocks(all_rows, stage(left, "all-rows"), units, build, k))
    return ranked(found, groups, units, k)
