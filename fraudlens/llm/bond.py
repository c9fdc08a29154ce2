"""Hard negatives by a vertical scan: dimensions are read one after the other until bounds decide which rows matter.

Rows lie in blocks that hold one column per dimension. For an anchor the columns are read in the order of its largest
components; what the unread ones can still add is known from their smallest and largest values in the block. With the
sum so far this bounds every row's score from both sides, and rows that cannot lie in any window of the anchor leave
the bitmap of candidates. What is left at the end has its exact score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.vectors import dealt, scaled, usable
from fraudlens.session import stage

_STEPS = (0.25, 0.5, 0.75, 0.875, 1.0)  # parts of the dimensions after which candidates are looked at again
_ALL = 1 << 62  # more than any score


class Block:
    """The rows of a block, a column per dimension."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray):
        self.ids, self.columns = ids, columns
        self.low = columns.min(1) if len(ids) else np.zeros(len(columns), np.int64)
        self.high = columns.max(1) if len(ids) else np.zeros(len(columns), np.int64)

    def exact_as_float(self, anchors: np.ndarray) -> bool:
        """Whether no sum of products can leave the integers that doubles hold."""
        most = np.maximum(np.abs(self.low), np.abs(self.high)).astype(float)
        return not len(anchors) or float((np.abs(anchors.astype(float)) @ most).max()) < 2**52

    def possible(self, anchors: np.ndarray, lows: list[np.ndarray], highs: list[np.ndarray]) -> list[int]:
        """The anchors that may have a row of the block in one of their windows, by the box of all rows."""
        low, high = self.low.astype(float), self.high.astype(float)
        up, down = np.maximum(anchors, 0).astype(float), np.minimum(anchors, 0).astype(float)
        most, least = up @ high + down @ low, up @ low + down @ high
        margin = 1 + 1e-9 * (np.abs(most) + np.abs(least))
        return [
            i
            for i, (a, b, m) in enumerate(zip(least.tolist(), most.tolist(), margin.tolist()))
            if ((lows[i] <= b + m) & (highs[i] >= a - m)).any()
        ]

    def scan(self, q: np.ndarray, own: int, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(window, id, score) of the ``k`` highest scores in each window [low, high], ties to smaller ids.

        Rows with the id ``own`` take no part. ``q`` and the columns are of one kind, doubles or Python's integers.
        """
        order = np.argsort(-np.abs(q), kind="stable")
        with_low, with_high = (q * self.low)[order], (q * self.high)[order]
        rest_low, rest_high = np.minimum(with_low, with_high), np.maximum(with_low, with_high)
        rest_low = np.append(rest_low[::-1].cumsum()[::-1], 0)
        rest_high = np.append(rest_high[::-1].cumsum()[::-1], 0)
        candidates = np.flatnonzero(self.ids != own)
        score = np.zeros(len(candidates), q.dtype)
        low, t = low.copy(), 0
        for end in sorted({int(np.ceil(s * len(q))) for s in _STEPS}):
            read, t = order[t:end], end
            columns = self.columns[read]
            score = score + q[read] @ (columns if len(candidates) == columns.shape[1] else columns[:, candidates])
            lower, upper = score + rest_low[t], score + rest_high[t]
            keep = (upper >= low.min()) & (lower <= high.max())
            if t == len(q) or int(keep.sum()) < 64 * k:
                keep = self._in_windows(lower, upper, low, high, k)
            candidates, score = candidates[keep], score[keep]
            if not len(candidates):
                return []
        score = score.astype(np.int64)
        out = []
        for w in range(len(low)):
            found = np.flatnonzero((score >= low[w]) & (score <= high[w]))
            ids = self.ids[candidates[found]]
            best = np.lexsort((ids, -score[found]))[:k]
            out += [(w, int(ids[i]), int(score[found[i]])) for i in best.tolist()]
        return out

    @staticmethod
    def _in_windows(lower: np.ndarray, upper: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the ``k`` best of a window; ``low`` rises to the kth score that is certain."""
        keep = np.zeros(len(lower), bool)
        for w in range(len(low)):
            certain = lower[(lower >= low[w]) & (upper <= high[w])]
            if len(certain) >= k:
                low[w] = max(low[w], int(np.partition(certain, len(certain) - k)[len(certain) - k]))
            keep |= (upper >= low[w]) & (lower <= high[w])
        return keep


def _place(rows: DataFrame, most: int, name: str) -> DataFrame:
    """``rows(id, label, vec)`` with ``name``: groups of about ``most`` rows of one label, length and half octave of norm."""
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("size", F.size("vec")).withColumn("norm", F.sqrt(squares))
    rows = rows.withColumn("band", F.when(F.col("norm") > 0, F.floor(2 * F.log2("norm"))).otherwise(-1))
    return dealt(rows, ["label", "size", "band"], most, name, "id", "vec").drop("band")


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """One row per block: its ids, and its vectors column by column."""

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        vectors = table.column("vec").combine_chunks().flatten()
        ids = np.asarray(table.column("id"))
        matrix = np.asarray(vectors).reshape(len(ids), len(vectors) // len(ids))
        order = np.argsort(ids, kind="stable")
        return pa.table(
            {
                "block": [key[0].as_py()],
                "label": table.column("label")[:1],
                "size": pa.array([matrix.shape[1]], pa.int32()),
                "n": pa.array([len(ids)], pa.int64()),
                "norm": pa.array([float(np.asarray(table.column("norm")).max())]),
                "ids": pa.array([ids[order].tobytes()], pa.binary()),
                "columns": pa.array([np.ascontiguousarray(matrix[order].T).tobytes()], pa.binary()),
            }
        )

    schema = "block string, label string, size int, n long, norm double, ids binary, columns binary"
    placed = _place(rows, most, "block").select("block", "id", "label", "vec", "norm")
    return placed.groupBy("block").applyInArrow(pack, schema)


def _visit(tiles: DataFrame, anchors: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(aid, w, id, score): for every tile (slice, block) the ``k`` best rows of the block in each anchor's windows."""

    def scan(asked: pa.Table, held: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if asked.num_rows and held.num_rows:
            ids = np.frombuffer(held.column("ids")[0].as_py(), np.int64)
            size = held.column("size")[0].as_py()
            block = Block(ids, np.frombuffer(held.column("columns")[0].as_py(), np.int64).reshape(size, len(ids)))
            flat = np.asarray(asked.column("vec").combine_chunks().flatten())
            q = flat.reshape(asked.num_rows, size)
            aid, own = asked.column("aid").to_pylist(), asked.column("id").to_pylist()
            low, high = ([np.array(x, np.int64) for x in asked.column(c).to_pylist()] for c in ("low", "high"))
            kind = np.float64 if block.exact_as_float(q) else object  # object: Python integers
            block = Block(ids, block.columns.astype(kind))
            q = q.astype(kind)
            for i in block.possible(q, low, high):
                found += [(aid[i], *x) for x in block.scan(q[i], own[i], low[i], high[i], k)]
        columns = zip(*found) if found else [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["aid", "w", "id", "score"])

    asked = tiles.join(anchors, "slice").select("slice", "block", "aid", "id", "vec", "low", "high")
    tiles = tiles.select("block", "slice")
    held = tiles.join(blocks.select("block", "size", "ids", "columns"), "block").toDF("_block", "_slice", "size", "ids", "columns")
    pairs = asked.groupBy("slice", "block").cogroup(held.groupBy("_slice", "_block"))
    return pairs.applyInArrow(scan, "aid long, w int, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("aid", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _tiles(anchors: DataFrame, heads: DataFrame, same_label: bool, chunks: int) -> DataFrame:
    """(slice, block) of all slices and blocks whose lengths of vectors leave a chance, in ``chunks`` parts.

    No product exceeds the product of the two lengths.
    """
    slices = anchors.groupBy("slice", "label", "size").agg(
        F.max("norm").alias("most"), F.min(F.array_min("low")).alias("low"), F.max(F.array_max("high")).alias("high")
    )
    slices = slices.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    others = heads.withColumnRenamed("label", "other").withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int"))
    label = F.col("label") == F.col("other") if same_label else F.col("label") != F.col("other")
    reach = F.col("most") * F.col("norm") * 1.000001 + 1
    pairs = slices.join(others, ["size", "chunk"]).filter(label & (F.col("low") <= reach) & (F.col("high") >= -reach))
    return pairs.select("slice", "block", "n", others["norm"])


def _search(anchors: DataFrame, blocks: DataFrame, same_label: bool, k: int, first: Column, chunks: int) -> DataFrame:
    """(aid, w, id, score, rank), the ``k`` best rows in each window of each anchor.

    Every slice of anchors first visits one block, the one of largest ``first``; the kth scores found there raise the
    windows' lower ends before the slice visits all others.
    """
    heads = blocks.select("block", "label", "size", "n", "norm")
    tiles = stage(_tiles(anchors, heads, same_label, chunks), "tiles")
    begin = stage(tiles.groupBy("slice").agg(F.max_by("block", first).alias("block")), "first-tiles")
    found = stage(_best(_visit(begin, anchors, blocks, k), k), "first-found")
    kth = found.filter(F.col("rank") == k).groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth"))
    raised = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("kth", w), x)))
    anchors = stage(anchors.join(kth, "aid", "left").withColumn("low", raised).drop("kth"), "raised")
    rest = _tiles(anchors, heads, same_label, chunks).select("slice", "block").join(begin, ["slice", "block"], "left_anti")
    more = _visit(stage(rest, "tiles"), anchors, blocks, k)
    return _best(found.drop("rank").unionByName(more), k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    scale: int = 256,
    block_rows: int = 8192,
    slice_rows: int = 4096,
) -> DataFrame:
    """Rows of other labels that score nearly as high as a positive: one row per anchor, positive and negative.

    Scores are inner products of ``floor(scale * x)``. ``is_anchor`` is a condition on the column ``id``. An
    anchor's positives are its ``positives`` best rows of the same label; a positive's negatives are the
    ``negatives`` best rows of another label whose score lies between ``low`` and ``high`` per cent of the positive's.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score; the result is exact.

    Blocks hold about ``block_rows`` rows of one label, slices about ``slice_rows`` anchors; a task holds one block
    and one slice at a time, whatever the labels' sizes.

    Defined cases: rows with a null id or label, and vectors that are null or hold null or non-finite components, take
    no part; only vectors of one length are compared, empty ones score 0; rows equal in id, label and scaled vector
    are one row; if an id stands on several different rows, each that is an anchor is one of its own, and no row of that id
    is a candidate; ties go to smaller ids; fewer positives or negatives are all returned; vectors so
    large that scores may not fit 64 bits end the job with a message; an empty table gives no rows; other columns
    are ignored.
    """
    label = F.col(label_column).cast("string").alias("label")
    rows = scaled(usable(vectors, id_column, vector_column, label).filter("label IS NOT NULL"), scale)
    rows = rows.select("id", "label", "vec").distinct()
    blocks = stage(_packed(rows, block_rows), "blocks")
    chunks = 1 + blocks.count() // 1024
    anchors = _place(rows.filter(is_anchor), slice_rows, "slice").withColumn("aid", F.monotonically_increasing_id())
    everything = [F.array(F.lit(s * _ALL)).alias(n) for s, n in ((-1, "low"), (1, "high"))]
    anchors = stage(anchors.select("*", *everything), "anchors")
    # among rows of the same label the longest vectors are the likeliest best, among others a large block has the narrowest windows
    near = _search(anchors, blocks, True, positives, F.struct("norm", "n", "block"), chunks)
    hundred, rest = F.expr("(score - pmod(score, 100)) div 100"), F.expr("pmod(score, 100)")
    near = near.withColumn("at_least", hundred * low + F.expr(f"({low} * pmod(score, 100) + 99) div 100"))
    near = near.withColumn("at_most", hundred * high + F.floor(high * rest / 100)).filter("at_least <= at_most")
    near = stage(near.select("aid", "id", "score", "rank", "at_least", "at_most"), "positives")
    windows = near.groupBy("aid").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score", "at_least", "at_most"))).alias("p"))
    asking = anchors.drop("low", "high").join(windows, "aid")
    asking = stage(asking.withColumns({"low": F.col("p.at_least"), "high": F.col("p.at_most")}), "windows")
    far = _search(asking.drop("p"), blocks, False, negatives, F.struct("n", "norm", "block"), chunks)
    far = far.select("aid", "w", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    found = far.join(asking.select("aid", F.col("id").alias("anchor_id"), "p"), "aid")
    positive = F.element_at("p", F.col("w") + 1)
    return found.select(
        "anchor_id",
        positive["id"].alias("positive_id"),
        "rank",
        "negative_id",
        positive["score"].alias("positive_score"),
        "negative_score",
    )


def hard_negatives_sql(label: str, anchors: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """The same over ``embeddings`` as DuckDB SQL: every anchor with every row."""
    return f"""
WITH rows AS (
  SELECT DISTINCT vec_id, {label} AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
    CAST(coalesce(list_sum([a.v[i] * c.v[i] for i in generate_series(1, len(a.v))]), 0) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE {anchors}),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {positives})
SELECT anchor_id, positive_id, CAST(place AS INT) AS rank, negative_id, positive_score, negative_score
FROM (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS place
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND {low} * positive_score <= 100 * s.score AND 100 * s.score <= {high} * positive_score) r
WHERE place <= {negatives}"""
