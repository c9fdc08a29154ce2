"""What both vector searches share: distinct vectors, blocks that queries are put to, and the last ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.session import stage


def usable(vectors: DataFrame, id_column: str, vector_column: str, *more: Column) -> DataFrame:
    """(id, vec) and ``more`` of the rows that take part: no null id, no vector that is null or holds null or
    non-finite parts.
    """
    vec = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"), *more)
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)


def scaled(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` with the integers ``floor(scale * x)`` in ``vec``.

    All scores of vectors whose squares sum to less than 2^62 fit 64 bits; a larger one ends the job with a message.
    """
    times = F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x * float(scale)) * (x * float(scale)))
    refused = F.raise_error(F.lit("a vector's components are too large: its scores may not fit 64 bits"))
    return rows.withColumn("vec", F.when(squares < 2.0**61, times).otherwise(refused.cast("array<bigint>")))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(gid, ids, first, second, vec): each different vector once, with its smallest ``ids`` ids.

    ``gid`` numbers the vectors (stage the result before it is used twice), whatever ids stand on them; ``first`` and
    ``second`` are the two smallest ids. Only the smallest ids of equal vectors can be among a query's nearest, so a
    vector that fills a third of the table becomes one row; what exceeds ``ids`` is left out before the shuffle. Rows
    equal in id and vector are made one first, else copies would take the places of other ids.
    """
    window = Window.partitionBy("vec").orderBy("id")
    once = rows.select("id", "vec").distinct()
    lowest = once.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= ids)
    groups = lowest.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    number = F.monotonically_increasing_id().alias("gid")
    return groups.select(number, "ids", F.col("ids")[0].alias("first"), F.get("ids", F.lit(1)).alias("second"), "vec")


def prepare(rows: DataFrame, is_query, k: int) -> tuple[DataFrame, DataFrame]:
    """Staged: all different vectors, see ``distinct_vectors``, and the different query rows (uid, own, vec).

    ``own`` is the id of a query row, which is no candidate for it; an id may stand on several query rows.
    """
    groups = stage(distinct_vectors(rows, k + 1), "vectors")
    asking = rows.filter(is_query).select(F.col("id").alias("own"), "vec").distinct()
    return groups, stage(asking.select(F.monotonically_increasing_id().alias("uid"), "own", "vec"), "queries")


def dealt(rows: DataFrame, keys: list[str], most: int, name: str, *by: str) -> DataFrame:
    """``rows`` with ``name``, a text: groups of about ``most`` rows that share ``keys`` (the last may be any text).

    Sizes are counted beforehand and large groups dealt by a hash of the columns ``by``, so a value that fills a third
    of the table is many groups.
    """
    parts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).alias("_parts"))
    part = F.pmod(F.xxhash64(*by), F.col("_parts"))
    return rows.join(parts, keys).withColumn(name, F.concat_ws("/", part, *reversed(keys))).drop("_parts")


class Best:
    """The best ``k`` (query, gid, id, score) of each query so far, compacted now and then.

    Equal scores are ordered by ``id``, the smallest id of the vector that counts for the query.
    """

    def __init__(self, k: int, kind=np.float64, hold: int = 400_000):
        self.k, self.kind, self.hold = k, kind, hold
        self.parts: list[Found] = []
        self.size = 0

    def add(self, *found: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(found)
        self.size += len(found[0])
        if self.size > self.hold:
            self._compact()
            if self.size > self.hold // 2:
                yield from self.take()

    def _compact(self) -> None:
        found = [np.concatenate(c) for c in zip(*self.parts)]
        query, gid, counts, score = found
        order = np.lexsort((gid, counts, -score, query))
        query, gid, counts, score = (c[order] for c in found)
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (gid[1:] != gid[:-1])  # a gid found twice has one score
        query, gid, counts, score = query[new], gid[new], counts[new], score[new]
        first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        keep = rank < self.k
        self.parts = [(query[keep], gid[keep], counts[keep], score[keep])]
        self.size = int(keep.sum())

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._compact()
            *keys, score = self.parts[0]
            columns = [*(pa.array(c) for c in keys), pa.array(score.astype(self.kind))]
            yield pa.RecordBatch.from_arrays(columns, ["query", "gid", "id", "score"])
        self.parts, self.size = [], 0


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Ids:
    """The two smallest ids of each vector: which of them counts for a query that has an id of its own."""

    def __init__(self, first: np.ndarray, second: pa.Array):
        self.first = first
        self.more = np.asarray(second.is_valid())
        self.second = np.asarray(second.fill_null(0))

    def counting(self, at: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest id other than ``own`` of the vectors ``at``, and whether there is one."""
        mine = self.first[at] == own
        return np.where(mine, self.second[at], self.first[at]), ~mine | self.more[at]


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten()
    return np.asarray(flat).reshape(len(column), len(flat) // len(column))


def _sliced(index: DataFrame, asked: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Blocks that more than ``most`` queries ask for become several with the same rows and a share of the queries."""
    sizes = asked.groupBy("block").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    busy = stage(sizes.select("block", F.ceil(F.col("_n") / most).cast("int").alias("_parts")), "busy-blocks")
    if busy.isEmpty():
        return index, asked
    name = F.when(F.col("_parts").isNull(), F.col("block")).otherwise(F.xxhash64("block", "_part"))
    part = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_part")
    copies = index.join(busy, "block", "left").select("*", part).withColumn("block", name).drop("_part", "_parts")
    dealt_out = asked.join(busy, "block", "left").withColumn("_part", F.pmod(F.xxhash64("uid"), F.col("_parts")).cast("int"))
    return copies, dealt_out.withColumn("block", name).drop("_part", "_parts")


def search_blocks(
    index: DataFrame,
    asked: DataFrame,
    units: DataFrame,
    build: Callable[[np.ndarray, Ids, np.ndarray], Callable[[np.ndarray, np.ndarray, np.ndarray], Found]],
    k: int,
    most: int = 16_384,
) -> DataFrame:
    """Put queries to blocks: (query, gid, id, score), the best ``k`` of each query in a task.

    ``index`` has (block, gid, first, second, vec), ``asked`` (block, uid) staged, ``units`` (uid, own, vec). Both sides
    are dealt by block and sorted, the block's own rows first; ``build(gids, ids, matrix)`` makes a block and what it
    returns is called with query numbers, own ids and vectors, some thousand at a time. A task holds one block,
    one slice of queries and the best so far; a block gets at most ``most`` queries.
    """
    index, asked = _sliced(index.select("block", "gid", "first", "second", "vec"), asked.select("block", "uid"), most)
    own = index.select("block", F.lit(0).alias("side"), "gid", "first", "second", "vec")
    queries = asked.join(units, "uid").select("block", F.lit(1), "uid", "own", F.lit(None).cast("long"), "vec")
    rows = own.union(queries).repartition("block").sortWithinPartitions("block", "side")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        current, ask = None, None
        held: list[pa.RecordBatch] = []

        def ready():
            table = pa.Table.from_batches(held).combine_chunks()
            gid, first = np.asarray(table.column("gid")), np.asarray(table.column("first"))
            ids = Ids(first, table.column("second").combine_chunks())
            return build(gid, ids, np.concatenate([matrix(b.column("vec")) for b in held]))

        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                block, side = np.asarray(part.column("block")), np.asarray(part.column("side"))
                cut = np.flatnonzero((block[1:] != block[:-1]) | (side[1:] != side[:-1])) + 1
                for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
                    piece = part.slice(a, b - a)
                    if block[a] != current:
                        current, ask, held = block[a], None, []
                    if side[a] == 0:
                        held.append(piece)
                        continue
                    if ask is None:
                        if not held:
                            continue  # nothing is in this block
                        ask, held = ready(), []
                    query, mine = np.asarray(piece.column("gid")), np.asarray(piece.column("first"))
                    yield from best.add(*ask(query, mine, matrix(piece.column("vec"))))
        yield from best.take()

    return rows.mapInArrow(run, "query long, gid long, id long, score double")


def top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` vectors of each query over all tasks."""
    window = Window.partitionBy("query").orderBy(F.col("score").desc(), "id", "gid")
    once = found.groupBy("query", "gid").agg(F.min("id").alias("id"), F.max("score").alias("score"))
    return once.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= k).drop("_n")


def ranked(found: DataFrame, groups: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from the best ``k`` vectors of each query row, which hold ids other than its own.

    An id on several query rows is one query: what its rows find is ranked together.
    """
    members = top(found, k).join(groups.select("gid", "ids"), "gid")
    members = members.join(units.select(F.col("uid").alias("query"), F.col("own").alias("query_id")), "query")
    pairs = members.select("query_id", "query", "gid", "score", F.explode("ids").alias("vec_id")).filter("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "query", "gid")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
