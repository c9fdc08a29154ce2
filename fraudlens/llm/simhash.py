"""Near-duplicate documents: SimHash fingerprints linked through BK-trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.columns import hide, show
from fraudlens.llm.components import connected_components
from fraudlens.session import stage

BITS = 64
# A bucket is named by equal bits: these blocks first, then blocks of what is left, and so on.
_LEVELS = 4


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """SimHash of a text: A-Z in lower case, words between ASCII white space, all shingles counted.

    A bit is 1 if it is set in more than half of the shingles' XXH64 values; no words give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist())]
    set_bits = np.zeros(BITS, np.int64)
    values = np.array(hashes, "<u8")
    for first in range(0, len(values), 1 << 16):
        part = values[first : first + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(values), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle_words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``_fp``, the fingerprint of ``text`` as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            values = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], np.uint64)
            columns = [*batch.columns[: len(keep)], pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_fp"])

    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[: len(keep)]) + ", _fp long"
    return rows.mapInArrow(run, schema)


class BKForest:
    """BK-trees of many groups at once: a node's children are keyed by their integer distance to it.

    ``group`` says which tree a value belongs to; the first value of a group is its root. All trees grow
    together, one level per round: of the values that reach a node at one distance, the first becomes the
    child and the others go on below it.
    """

    def __init__(self, group: np.ndarray, value: np.ndarray):
        order = np.argsort(group, kind="stable")
        group = group[order]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        self.groups, self.roots = group[first], order[first]
        self.value = value
        at = np.empty(len(value), np.int64)
        at[order] = self.roots[np.cumsum(first) - 1]
        waiting = np.setdiff1d(np.arange(len(value)), self.roots)
        at = at[waiting]
        edges, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(waiting):
            edge = at * (BITS + 1) + np.bitwise_count(value[waiting] ^ value[at])
            found, place, back = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(found)
            children.append(waiting[place])
            rest = np.ones(len(waiting), bool)
            rest[place] = False
            at, waiting = waiting[place][back][rest], waiting[rest]
        edges, children = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edges)
        self.edges, self.children = edges[order], children[order]

    def within(self, group: np.ndarray, value: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) at most ``radius`` bits apart in the query's group, by levels.

        Only edges whose distance is within ``radius`` of the query's distance to the parent are followed.
        """
        place = np.searchsorted(self.groups, group)
        place = np.minimum(place, len(self.groups) - 1) if len(self.groups) else place
        query = np.flatnonzero(self.groups[place] == group) if len(self.groups) else np.zeros(0, np.int64)
        node = self.roots[place[query]] if len(query) else query
        while len(query):
            distance = np.bitwise_count(value[query] ^ self.value[node]).astype(np.int64)
            near = distance <= radius
            yield query[near], node[near]
            base = node * (BITS + 1)
            low = np.searchsorted(self.edges, base + np.maximum(distance - radius, 0), side="left")
            high = np.searchsorted(self.edges, base + np.minimum(distance + radius, BITS), side="right")
            n = high - low
            query = np.repeat(query, n)
            step = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n)
            node = self.children[np.repeat(low, n) + step]


def _spanning(value: np.ndarray, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the same values together as all pairs: each value and the smallest of its part."""
    parent = np.arange(len(value))

    def roots(x: np.ndarray) -> np.ndarray:
        while True:
            up = parent[x]
            if (up == x).all():
                return x
            parent[x] = parent[up]
            x = parent[x]

    for a, b in pairs:
        while len(a):
            a, b = roots(a), roots(b)
            apart = a != b
            a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(parent, b, a)
            if len(a):
                keep = roots(a) != roots(b)
                a, b = a[keep], b[keep]
    top = roots(np.arange(len(value)))
    moved = np.flatnonzero(top != np.arange(len(value)))
    return moved, top[moved]


def _blocks(free: int, radius: int) -> list[tuple[int, int]]:
    """(first, width) of ``radius + 1`` blocks of the free bits; values within the radius agree on one of them."""
    n = radius + 1
    ends = [free * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends[:-1], ends[1:])]


def _subkeys(fp: np.ndarray, path: np.ndarray, radius: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """For each (value, path of chosen blocks) one row per next block: the new paths and the bits of that block.

    The bits chosen so far are taken out of the value first, so each level splits what is still free.
    """
    n = radius + 1
    paths, bits = [], []
    for p in np.unique(path):
        chosen, digits = [], int(p)
        for _ in range(level):
            chosen.append(digits % n)
            digits //= n
        rows = np.flatnonzero(path == p)
        rest, free = fp[rows], BITS
        for c in reversed(chosen):
            first, width = _blocks(free, radius)[c]
            low = rest & np.uint64((1 << first) - 1)
            rest = low | ((rest >> np.uint64(first + width)) << np.uint64(first))
            free -= width
        for c, (first, width) in enumerate(_blocks(free, radius)):
            part = (rest >> np.uint64(first)) & np.uint64((1 << width) - 1)
            paths.append((rows, np.full(len(rows), int(p) * n + c), part))
    rows = np.concatenate([r for r, _, _ in paths])
    return rows, (np.concatenate([p for _, p, _ in paths]), np.concatenate([b for _, _, b in paths]))


_KEYED = "_fp long, path long, bucket long"


def _split(rows: DataFrame, radius: int, level: int) -> DataFrame:
    """Rows (_fp, path, bucket) dealt to the next level's buckets; the new bucket's name covers the old one's."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, path, bucket = (np.asarray(c) for c in batch.columns)
            at, (paths, bits) = _subkeys(fp.view(np.uint64), path, radius, level)
            mixed = (bucket[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ bits
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + paths.astype(np.uint64)
            columns = [pa.array(fp[at]), pa.array(paths), pa.array(mixed.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["_fp", "path", "bucket"])

    return rows.mapInArrow(run, _KEYED)


def _search(rows: DataFrame, radius: int, block: int) -> DataFrame:
    """Links inside buckets; ``rows`` (bucket, tree, asks, _fp) come sorted, a tree's own values before the askers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def solve(table: pa.Table) -> pa.RecordBatch:
            bucket, tree, asks, fp = (np.asarray(table.column(c)) for c in range(4))
            group = np.cumsum(np.concatenate(([0], (bucket[1:] != bucket[:-1]) | (tree[1:] != tree[:-1]))))
            value, asks = fp.view(np.uint64), asks.astype(bool)
            own = np.flatnonzero(~asks)
            forest = BKForest(group[own], value[own])

            def pairs():
                for first in range(0, len(value), block):
                    part = slice(first, first + block)
                    for q, node in forest.within(group[part], value[part], radius):
                        q = q + first
                        later = own[node] < q  # each pair of a tree once
                        yield q[later], own[node[later]]

            a, b = _spanning(value, pairs())
            return pa.RecordBatch.from_arrays([pa.array(fp[b]), pa.array(fp[a])], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = _last_group(held, 2)
            if last >= block:
                yield solve(held.slice(0, last))
                held = held.slice(last)
        if held is not None and len(held):
            yield solve(held)

    return rows.mapInArrow(run, "a long, b long")


def _last_group(table: pa.Table, columns: int) -> int:
    """The row where the last group of a sorted table begins."""
    n = len(table)
    same = np.ones(n, bool)
    for c in range(columns):
        value = np.asarray(table.column(c))
        same &= value == value[-1]
    return n - int(same.sum()) if n else 0


def links(fingerprints: DataFrame, radius: int = 3, most: int = 20_000) -> DataFrame:
    """Links (a, b) that join distinct fingerprints ``_fp`` exactly as all pairs within ``radius`` bits would.

    Two values within the radius agree on one of ``radius + 1`` blocks of their bits, so each value goes to
    that many buckets, and each bucket is a shard with BK-trees of its own. A bucket of more than ``most``
    values is dealt again by blocks of the bits still free, up to four times; values that stay together then
    are dealt to trees of about ``most`` values, and every value of the bucket asks each of these trees.
    Nothing is dropped at any step, and a bucket gives at most one link per value.
    """
    found: list[DataFrame] = []
    rows = fingerprints.select("_fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("bucket"))
    for level in range(_LEVELS):
        rows = stage(_split(rows, radius, level), "buckets")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        sizes = stage(sizes, "bucket-sizes")
        large = sizes.filter(F.col("_n") > most)
        last = level == _LEVELS - 1
        done = sizes if last else sizes.filter(F.col("_n") <= most)
        plain = rows.join(done.withColumn("_trees", F.ceil(F.col("_n") / most).cast("int")), "bucket")
        own = F.pmod(F.xxhash64("_fp"), F.col("_trees")).cast("int")
        if last:  # every value is in its own tree and asks the others
            trees = F.explode(F.sequence(F.lit(0), F.col("_trees") - 1)).alias("tree")
            plain = plain.select("bucket", own.alias("_own"), trees, "_fp")
            plain = plain.select("bucket", "tree", (F.col("tree") != F.col("_own")).alias("asks"), "_fp")
        else:
            plain = plain.select("bucket", F.lit(0).alias("tree"), F.lit(False).alias("asks"), "_fp")
        plain = plain.repartition("bucket", "tree").sortWithinPartitions("bucket", "tree", "asks")
        found.append(_search(plain, radius, 1 << 15))
        if last or large.isEmpty():
            break
        rows = rows.join(large.select("bucket"), "bucket").select("_fp", "path", "bucket")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("a", "b")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle_words: int = 3, most: int = 20_000) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the smallest doc_id reachable over links.

    Defined cases: a null or empty text, or one of white space only, has fingerprint 0 and links like any
    other; fewer words than a shingle make one shingle; rows that repeat a doc_id keep a row each; a null
    doc_id gets the component of its fingerprint and is never its smallest id unless there is no other
    (then null); an empty table gives no rows; other columns are ignored.
    """
    rows = stage(with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle_words), "fingerprints")
    groups = _components(rows, radius, most)
    joined = rows.join(groups, "_fp")
    return joined.select(
        "doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _components(rows: DataFrame, radius: int, most: int) -> DataFrame:
    """For each fingerprint: component_id and ``_keep``, the fingerprint that the component's kept document has."""
    smallest = stage(rows.groupBy("_fp").agg(F.min("doc_id").alias("_id")), "distinct-fingerprints")
    joined = connected_components(stage(links(smallest.select("_fp"), radius, most), "links"))
    member = smallest.join(joined, F.col("_fp") == F.col("node"), "left")
    member = member.select("_fp", "_id", F.coalesce("component", "_fp").alias("_part"))
    best = member.groupBy("_part").agg(
        F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_fp"))).alias("_best")
    )
    return member.join(best, "_part").select(
        "_fp", F.col("_best._id").alias("component_id"), F.col("_best._fp").alias("_keep")
    )


def keep_first(docs: DataFrame, radius: int = 3, shingle_words: int = 3, most: int = 20_000) -> DataFrame:
    """One document of each component: the row of its smallest doc_id.

    Of rows that repeat that doc_id with that fingerprint, one stays. A component without doc_ids keeps one row.
    Only ids are compared where an id stands for one row; texts are read again only for ids of several rows.
    """
    docs, names = hide(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(with_fingerprint(rows, shingle_words), "fingerprints")
    best = _components(rows, radius, most).filter("_fp = _keep")
    best = best.select(F.col("_fp").alias("_f"), F.col("component_id").alias("_c"))
    times = rows.groupBy(F.col("doc_id").alias("_c")).agg(F.count(F.lit(1)).alias("_times"))
    several = times.filter("_c IS NULL OR _times > 1").select("_c")
    single = best.join(times.filter("_c IS NOT NULL AND _times = 1"), "_c").select("_c")
    kept = docs.join(single, F.col("doc_id") == F.col("_c"), "left_semi")
    if several.isEmpty():
        return show(kept, names)
    again = docs.join(several, F.col("doc_id").eqNullSafe(F.col("_c")), "left_semi")
    again = with_fingerprint(again, shingle_words, tuple(docs.columns))
    same = F.col("doc_id").eqNullSafe(F.col("_c")) & (F.col("_fp") == F.col("_f"))
    again = again.join(best, same, "left_semi").dropDuplicates(["doc_id", "_fp"])
    return show(kept.unionByName(again.select(*kept.columns)), names)
