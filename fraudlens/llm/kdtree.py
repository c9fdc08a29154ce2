"""Exact top-k by integer inner product: KD-trees per shard, searched best first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.vectors import Found, Ids, dealt, matrix, prepare, ranked, scaled, top, usable
from fraudlens.session import stage

_NONE = -(1 << 62)  # a bound below every score


class KDTree:
    """Median splits along the widest side; every node keeps the tight box of its rows.

    No row of a node scores more against q than the box: the sum of the larger of ``q * low`` and ``q * high``.
    """

    def __init__(self, gids: np.ndarray, ids: Ids, rows: np.ndarray, leaf: int = 128):
        self.leaf = leaf
        self.gids, self.ids, self.rows = gids, ids, rows
        # float64 products are exact as long as no sum can pass 2**53
        self.most = float(np.abs(rows).max()) if rows.size else 0.0
        self.children: list[tuple[int, int] | None] = []
        self.spans: list[tuple[int, int]] = []
        low, high, perm = [], [], np.arange(len(gids))
        waiting = [(0, len(gids), -1, 0)]
        while waiting:
            a, b, parent, side = waiting.pop()
            node = len(self.spans)
            self.spans.append((a, b))
            self.children.append(None)
            part = self.rows[perm[a:b]]
            low.append(part.min(0))
            high.append(part.max(0))
            if parent >= 0:
                left, right = self.children[parent]
                self.children[parent] = (node, right) if side == 0 else (left, node)
            if b - a > leaf and (high[-1] > low[-1]).any():
                widest = int(np.argmax(high[-1] - low[-1]))
                middle = (b - a) // 2
                perm[a:b] = perm[a:b][np.argpartition(part[:, widest], middle, kind="introselect")]
                self.children[node] = (-1, -1)
                waiting += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.low, self.high = np.array(low), np.array(high)
        self.perm, self.rows = perm, rows[perm]

    def best(self, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, k: int) -> Found:
        """(query, gid, id, score) of the ``k`` best vectors of each query that reach its bound, ties to smaller ids.

        Vectors that only the query's own id stands on are left out. Nodes come off a heap by their bound; the
        search ends once no node can reach the kth score.
        """
        exact = self.most * (float(np.abs(queries).max()) if queries.size else 0) * max(queries.shape[1], 1) < 2**53
        kind = np.float64 if exact else object  # object: Python integers
        rows, asked = self.rows.astype(kind), queries.astype(kind)
        limit = np.maximum(asked, 0) @ self.high.astype(kind).T + np.minimum(asked, 0) @ self.low.astype(kind).T
        out: list[tuple[int, int, int, int]] = []
        for i, (q, above) in enumerate(zip(asked, limit)):
            kth, found = int(bounds[i]), []  # found: heap of (score, -id, -gid), the worst first
            heap = [(-above[0], 0)]
            while heap:
                bound, node = heapq.heappop(heap)
                if -bound < kth:
                    break
                if self.children[node]:
                    for child in self.children[node]:
                        if above[child] >= kth:
                            heapq.heappush(heap, (-above[child], child))
                    continue
                a, b = self.spans[node]
                score = rows[a:b] @ q
                near = np.flatnonzero(score >= kth)
                at = self.perm[a + near]
                ids, there = self.ids.counting(at, own[i])
                for j in np.flatnonzero(there).tolist():
                    entry = (score[near[j]], -int(ids[j]), -int(self.gids[at[j]]))
                    if len(found) < k:
                        heapq.heappush(found, entry)
                    elif entry > found[0]:
                        heapq.heapreplace(found, entry)
                if len(found) == k:
                    kth = max(kth, found[0][0])
            out += [(i, -gid, -id_, int(s)) for s, id_, gid in found]
        columns = zip(*out) if out else [()] * 4
        return tuple(np.array(c, np.int64) for c in columns)


class Splits:
    """Median splits along the widest side of a sample: which leaf a vector falls into.

    Each length of vectors has a tree of its own, of at most ``levels`` levels and 16 sampled vectors a leaf.
    """

    def __init__(self, sample: list[np.ndarray], levels: int):
        self.trees: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_size.setdefault(len(v), []).append(v)
        for size, vectors in by_size.items():
            depth = min(levels, int(np.log2(max(1, len(vectors) / 16))))
            if depth and size:
                self.trees[size] = self._fit(np.array(vectors), depth)

    @staticmethod
    def _fit(rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        dims, cuts = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1, np.int64)
        parts = [np.arange(len(rows))]
        for node in range(2**depth - 1):
            part = rows[parts[node]]
            dims[node] = np.argmax(part.max(0) - part.min(0)) if len(part) else 0
            cuts[node] = np.sort(part[:, dims[node]])[(len(part) - 1) // 2] if len(part) else 0
            right = part[:, dims[node]] > cuts[node]
            parts += [parts[node][~right], parts[node][right]]
        return dims, cuts

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros(len(rows), np.int64)
        dims, cuts = self.trees.get(rows.shape[1], (np.zeros(0, np.int64),) * 2)
        for _ in range((len(dims) + 1).bit_length() - 1):
            node = 2 * node + 1 + (rows[np.arange(len(rows)), dims[node]] > cuts[node])
        return node - len(dims)

    def place(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``leaf`` and ``size``, the length of their ``vec``."""
        names = rows.columns
        at = names.index("vec")

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size = np.diff(np.asarray(batch.column(at).offsets))
                for d in np.unique(size):
                    part = batch.take(pa.array(np.flatnonzero(size == d)))
                    vectors = np.asarray(part.column(at).flatten()).reshape(part.num_rows, int(d))
                    more = [pa.array(self.leaf(vectors)), pa.array(np.full(part.num_rows, d, np.int32))]
                    yield pa.RecordBatch.from_arrays([*part.columns, *more], [*names, "leaf", "size"])

        schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", leaf long, size int"
        return rows.mapInArrow(run, schema)


def fit_splits(groups: DataFrame, n: int, shard_rows: int, most: int = 4096) -> Splits:
    """Splits for shards of about ``shard_rows`` vectors, fitted on the ``most`` that hash lowest: a bounded sample."""
    levels = max(0, math.ceil(math.log2(max(1, n / shard_rows))))
    if not levels:
        return Splits([], 0)
    sample = groups.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(most).collect()
    return Splits([np.array(r.vec, np.int64) for r in sample], min(levels, 8))


def _packed(shards: DataFrame) -> DataFrame:
    """One row per shard: its vectors and their box."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        vectors = table.column("vec").combine_chunks()
        rows = matrix(vectors)
        return pa.table(
            {
                "block": [key[0].as_py()],
                "size": table.column("size")[:1],
                "leaf": table.column("leaf")[:1],
                "low": pa.array([rows.min(0).astype(float).tolist()], pa.list_(pa.float64())),
                "high": pa.array([rows.max(0).astype(float).tolist()], pa.list_(pa.float64())),
                "gids": pa.array([table.column("gid").to_numpy().tobytes()], pa.binary()),
                "first": pa.array([table.column("first").to_numpy().tobytes()], pa.binary()),
                "second": pa.array([table.column("second").to_pylist()], pa.list_(pa.int64())),
                "rows": pa.array([np.ascontiguousarray(rows).tobytes()], pa.binary()),
            }
        )

    schema = (
        "block string, size int, leaf long, low array<double>, high array<double>, "
        "gids binary, first binary, second array<long>, rows binary"
    )
    return shards.select("block", "size", "leaf", "gid", "first", "second", "vec").groupBy("block").applyInArrow(pack, schema)


def _visit(tiles: DataFrame, asking: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """(query, gid, id, score): for every tile (slice, block) the ``k`` best vectors of the shard for each query."""

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        query = gid = ids = score = np.zeros(0, np.int64)
        if asked.num_rows and held.num_rows:
            gids, first = (np.frombuffer(held.column(c)[0].as_py(), np.int64) for c in ("gids", "first"))
            rows = np.frombuffer(held.column("rows")[0].as_py(), np.int64).reshape(len(gids), held.column("size")[0].as_py())
            tree = KDTree(gids, Ids(first, held.column("second")[0].values), rows)
            vectors = np.asarray(asked.column("vec").combine_chunks().flatten()).reshape(asked.num_rows, rows.shape[1])
            bound = np.asarray(asked.column("bound").combine_chunks().fill_null(_NONE))
            i, gid, ids, score = tree.best(vectors, asked.column("own").to_numpy(), bound, k)
            query = asked.column("uid").to_numpy()[i]
        return pa.table([pa.array(c) for c in (query, gid, ids, score)], ["query", "gid", "id", "score"])

    tiles = tiles.select("slice", "block")
    asked = tiles.join(asking, "slice").select("slice", "block", "uid", "own", "vec", "bound")
    held = tiles.join(shards, "block").select(
        F.col("slice").alias("_slice"), F.col("block").alias("_block"), "size", "gids", "first", "second", "rows"
    )
    pairs = asked.groupBy("slice", "block").cogroup(held.groupBy("_slice", "_block"))
    return pairs.applyInArrow(search, "query long, gid long, id long, score long")


def _boxes(asking: DataFrame) -> DataFrame:
    """The box of the vectors of each slice of queries, and the least bound in it."""

    def box(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = matrix(table.column("vec").combine_chunks()).astype(float)
        bound = np.asarray(table.column("bound").combine_chunks().fill_null(_NONE))
        return pa.table(
            {
                "slice": [key[0].as_py()],
                "size": pa.array([rows.shape[1]], pa.int32()),
                "leaf": table.column("leaf")[:1],
                "least": pa.array([float(bound.min())]),
                "at_least": pa.array([rows.min(0).tolist()], pa.list_(pa.float64())),
                "at_most": pa.array([rows.max(0).tolist()], pa.list_(pa.float64())),
            }
        )

    schema = "slice string, size int, leaf long, least double, at_least array<double>, at_most array<double>"
    return asking.select("slice", "leaf", "vec", "bound").groupBy("slice").applyInArrow(box, schema)


def _other_tiles(boxes: DataFrame, shards: DataFrame, chunks: int) -> DataFrame:
    """(slice, block) of all shards of other leaves whose box lets some query of the slice reach the least bound.

    The list is made in ``chunks`` parts. A margin makes up for rounding.
    """
    heads = shards.select("block", "size", F.col("leaf").alias("other"), "low", "high")
    heads = heads.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int"))
    boxes = boxes.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    most = F.expr(
        "aggregate(transform(sequence(1, size), i -> greatest(at_least[i - 1] * low[i - 1], at_least[i - 1] * high[i - 1], "
        "at_most[i - 1] * low[i - 1], at_most[i - 1] * high[i - 1])), 0D, (a, x) -> a + x)"
    )
    reach = F.when(F.col("size") > 0, most).otherwise(0.0)
    pairs = boxes.join(heads, ["size", "chunk"]).filter("leaf <> other")
    return pairs.filter(reach + F.abs(reach) * 1e-9 + 1 >= F.col("least")).select("slice", "block")


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    shard_rows: int = 8192,
    slice_rows: int = 4096,
) -> DataFrame:
    """Each query row's ``k`` rows of highest inner product of ``floor(scale * x)``: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``id``. Different vectors are dealt into shards of about ``shard_rows`` by
    median splits along the widest sides of a bounded sample, and by hash within a leaf of the splits that
    holds more. Queries, in slices of ``slice_rows``, first search the shards of the leaf their own vector falls into;
    the kth score there goes with them to the other shards, of which a slice gets only those whose box can reach it.
    The result is exact.

    Defined cases: ids that are null, and vectors that are null or hold null or non-finite components, take no part;
    an empty vector scores 0 with other empty ones; only vectors of one length are compared; rows equal in id and
    scaled vector are one row; a row with the query's id is no candidate; an id on several vectors is several candidates and one
    query, whose vectors' results are ranked together; ties go to smaller ids; fewer than ``k`` candidates are all
    returned; vectors so large that scores may not fit 64 bits end the job with a message; an empty table gives no
    rows; other columns are ignored.
    """
    rows = scaled(usable(vectors, id_column, vector_column), scale)
    groups, units = prepare(rows, is_query, k)
    n = groups.count()
    splits = fit_splits(groups, n, shard_rows)
    placed = dealt(splits.place(groups.drop("ids")), ["size", "leaf"], shard_rows, "block", "gid")
    shards = stage(_packed(placed), "shards")
    asking = dealt(splits.place(units), ["size", "leaf"], slice_rows, "slice", "uid")
    asking = stage(asking.withColumn("bound", F.lit(None).cast("long")), "slices")
    home = asking.select("slice", "size", "leaf").distinct().join(shards.select("block", "size", "leaf"), ["size", "leaf"])
    found = stage(top(_visit(home, asking, shards, k), k), "first-found")
    if splits.trees:
        kth = found.groupBy(F.col("query").alias("uid")).agg(F.min("score").alias("_s"), F.count(F.lit(1)).alias("_n"))
        kth = kth.select("uid", F.expr(f"IF(_n >= {k}, _s, NULL)").alias("bound"))
        asking = stage(asking.drop("bound").join(kth, "uid", "left"), "bounded")
        rest = stage(_other_tiles(_boxes(asking), shards, 1 + n // (1024 * shard_rows)), "tiles")
        found = found.unionByName(_visit(rest, asking, shards, k))
    return ranked(found, groups, units, k)
