"""Repeated passages by suffix order: longest previous factors over anchored regions of the texts.

A string of ``length`` bytes holds ``length - GRAM + 1`` grams of GRAM bytes; the one that hashes lowest is its
anchor. Strings can only be equal within the group of one anchor. Neighbouring strings of a text mostly share
their anchor; the run of text that they cover is a region, also where the anchor recurs in it (periodic text).
Only what groups need travels: regions whose anchor occurs nowhere else are left out first; of the others one hash
per region, and bytes only of those whose anchor also occurs in a different region or more than once in their own.

One pass can judge strings of two sizes: equal strings of ``far`` bytes begin with equal ones of ``length`` bytes, so they
meet under the anchor of these; regions then carry the bytes behind them that the longer strings reach.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.columns import hide, show
from fraudlens.session import stage, unstage

GRAM = 64
_CHUNK = 1 << 21  # bytes of text looked at in one go
_MOST = 2048  # strings of a region
_TASK_REGIONS = 8192  # regions put in order by a task, about 5 MB
_MULTIPLY = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = x * np.uint64(_MULTIPLY[k])
    return x ^ (x >> np.uint64(29))


def _hashes(data: np.ndarray, length: int, k: int = 0) -> np.ndarray:
    """A 64-bit hash of every string of ``length`` (a power of two from 8 on) bytes, by doubling."""
    words = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
    out, size = _mix(words, k), 8
    while size < length:
        out = _mix(out[: max(len(out) - size, 0)] + ((out[size:] << np.uint64(7)) | (out[size:] >> np.uint64(57))) * np.uint64(3), k)
        size *= 2
    return out


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def regions(data: bytes, length: int = 400) -> Iterator[tuple[int, int, int, int]]:
    """(anchor hash, first string, number of strings, places of the anchor) of the runs of strings with one anchor.

    A run of more than ``_MOST`` strings is cut, which periodic text makes necessary.
    """
    step = _CHUNK - length
    for base in range(0, max(len(data) - length + 1, 0), step):
        part = np.frombuffer(data, np.uint8, min(len(data) - base, step + length - 1), base)
        strings = len(part) - length + 1
        grams = _hashes(part, GRAM)
        place = np.arange(len(grams), dtype=np.uint64)
        keys = (grams & ~np.uint64((1 << 21) - 1)) | place
        at = (_lowest(keys, length - GRAM + 1) & np.uint64((1 << 21) - 1)).astype(np.int64)[:strings]
        anchor = grams[at]
        begins = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        run = np.diff(np.append(begins, strings))
        cuts = -(-run // _MOST)
        inside = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        first = np.repeat(begins, cuts) + inside * _MOST
        ends = np.append(first[1:], strings)
        moved = np.concatenate(([0], np.cumsum(at[1:] != at[:-1])))
        places = moved[ends - 1] - moved[first] + 1
        found = (anchor[first].view(np.int64), first + base, ends - first, places)
        yield from zip(*(x.tolist() for x in found))


def _id_columns(docs: DataFrame, *more: str) -> DataFrame:
    """A row's key is its doc_id and the hash of its text: equal keys mean equal rows, whose decisions agree."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text_key"), "text", *more
    )


_REGION = "doc_id long, _text_key long, anchor long, content binary, first long, strings int, places int"


def _find_regions(docs: DataFrame, length: int, far: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = (text or "").encode()
                for anchor, first, n, places in regions(data, length):
                    content = xxhash.xxh3_128_digest(data[first : first + n + far - 1], n)
                    for column, value in zip(out, (doc_id, key, anchor, content, first, n, places)):
                        column.append(value)
                if len(out[0]) > 50_000:
                    yield _region_batch(out)
                    out = [[] for _ in range(7)]
            yield _region_batch(out)

    return _id_columns(docs).mapInArrow(run, _REGION)


def _region_batch(columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32())
    names = [x.split()[0] for x in _REGION.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _rank(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def _keys(rank: np.ndarray, size: int, at: np.ndarray, length: int, most: int) -> np.ndarray:
    """Keys that order the strings of ``length`` bytes at ``at``, from ranks of strings of ``size`` bytes.

    A key joins at most ``most`` ranks of pieces of a string; for longer strings the pieces are ranked first.
    """
    piece = size
    while piece * most < length:
        piece *= most
    steps = [min(i * piece, length - piece) for i in range(-(-length // piece))]
    if piece == size:
        ranks = [rank[at + x] for x in steps]
    else:
        places = np.concatenate([at + x for x in steps])
        ranks = np.split(_rank(_keys(rank, size, places, piece, most)), len(steps))
    out = ranks[0].astype(np.uint64)
    for x in ranks[1:]:
        out = out << np.uint64(63 // most) | x.astype(np.uint64)
    return out


def prefix_ranks(data: np.ndarray, length: int) -> tuple[np.ndarray, int, int]:
    """Ranks of the strings at every place, their size, and how many of them reach over ``length`` bytes.

    Ranks of strings of 8, 24, 72 ... bytes give those of three times the size, as long as three fit into a key of 63 bits
    (prefix doubling with a larger step); in larger data two.
    """
    most = 3 if 3 * len(data) < 1 << 21 else 2
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    rank, size = _rank(np.ndarray(len(data), ">u8", padded, strides=(1,)).astype(np.uint64)), 8
    while size * most < length:
        at = np.arange(len(rank) - (most - 1) * size)
        rank, size = _rank(_keys(rank, size, at, most * size, most)), most * size
    return rank, size, most


def suffix_order(ranks: tuple[np.ndarray, int, int], starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts``, ordered by their first ``length`` bytes, then by place; and where equals begin.

    ``ranks`` are those of ``prefix_ranks``. Returns the order as indexes into ``starts`` and, for each place in it, whether
    its common prefix with the one before is shorter than ``length``.
    """
    rank, size, most = ranks
    key = _keys(rank, size, starts, length, most)
    order = np.argsort(key, kind="stable")
    key = key[order]
    return order, np.concatenate(([True], key[1:] != key[:-1]))


def smaller_neighbours(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the nearest smaller one before (-1: none) and behind (n: none), by jumping over larger ones."""
    n = len(value)
    out = []
    for step, end in ((-1, -1), (1, n)):
        at = np.arange(n) + step
        todo = np.flatnonzero(at != end)
        while len(todo):
            todo = todo[value[at[todo]] > value[todo]]
            at[todo] = at[at[todo]]  # all between are larger
            todo = todo[at[todo] != end]
        out.append(at)
    return out[0], out[1]


def previous_factors(order: np.ndarray, begins: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each string's longest previous factor has full length (2), only a later equal exists (1), or none (0).

    A string's longest previous factor is with its previous or its next smaller place in suffix order,
    whichever shares more bytes; it has full length if one of the two lies in the same run of equals.
    """
    n = len(order)
    run = np.cumsum(begins) - 1
    before, behind = smaller_neighbours(place[order])
    earlier = (before >= 0) & (run[np.maximum(before, 0)] == run)
    earlier |= (behind < n) & (run[np.minimum(behind, n - 1)] == run)
    state = np.where(earlier, 2, np.bincount(run)[run] > 1).astype(np.uint8)
    out = np.empty(n, np.uint8)
    out[order] = state
    return out


def _compare(contents: list[bytes], strings: np.ndarray, length: int, far: int) -> list[bytes]:
    """States of the strings of regions in the order of their places; equal strings share their anchor.

    The lower two bits of a state are that of the string of ``length`` bytes, the next two that of the one of ``far``.
    """
    data = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    base = np.cumsum(sizes) - sizes
    ends = np.cumsum(strings)
    starts = np.arange(ends[-1]) + np.repeat(base - (ends - strings), strings)
    ranks = prefix_ranks(data, length)
    states = previous_factors(*suffix_order(ranks, starts, length), np.arange(len(starts)))
    if far > length:
        whole = starts + far <= np.repeat(base + sizes, strings)
        some = np.flatnonzero(whole & (states > 0))
        if len(some):
            states[some] |= previous_factors(*suffix_order(ranks, starts[some], far), np.arange(len(some))) << 2
    states = states.tobytes()
    return [states[b - n : b] for n, b in zip(strings.tolist(), ends.tolist())]


_FETCHED = "anchor long, content binary, doc_id long, _text_key long, first long, strings int, bytes binary"


def _fetch(docs: DataFrame, wanted: DataFrame, far: int) -> DataFrame:
    """The bytes of regions: their documents are joined with all regions wanted of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for doc_id, key, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                data = (text or "").encode()
                for r in found:
                    part = data[r["first"] : r["first"] + r["strings"] + far - 1]
                    for column, value in zip(out, (r["anchor"], r["content"], doc_id, key, r["first"], r["strings"], part)):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            names = [x.split()[0] for x in _FETCHED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    grouped = _per_document(wanted, F.struct("anchor", "content", "first", "strings"))
    return _join_documents(docs, grouped, "inner").select("doc_id", "_text_key", "text", "_all").mapInArrow(run, _FETCHED)


def _per_document(rows: DataFrame, what) -> DataFrame:
    """One row per document with all its entries: no more than its text has strings."""
    grouped = rows.groupBy(F.col("doc_id").alias("_d"), F.col("_text_key").alias("_k"))
    return grouped.agg(F.collect_list(what).alias("_all"))


def _join_documents(docs: DataFrame, grouped: DataFrame, how: str) -> DataFrame:
    same = (F.col("_text_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d"))
    return docs.join(grouped, same, how)


def _sorted_states(fetched: DataFrame, length: int, far: int, block: int) -> DataFrame:
    """(anchor, content, state) of regions by suffix order; all regions of an anchor meet in one block."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        anchor, content, strings, data = (table.column(c).to_pylist() for c in ("anchor", "content", "strings", "bytes"))
        keep = [i for i in range(len(anchor)) if i == 0 or (anchor[i], content[i]) != (anchor[i - 1], content[i - 1])]
        anchor, content, strings, data = ([c[i] for i in keep] for c in (anchor, content, strings, data))
        states = _compare(data, np.array(strings), length, far)
        some = [i for i, x in enumerate(states) if any(x)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([anchor[i] for i in some], pa.int64()),
                pa.array([content[i] for i in some], pa.binary()),
                pa.array([states[i] for i in some], pa.binary()),
            ],
            ["anchor", "content", "state"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            step = max(1, int(len(table) * block / max(1, table.nbytes)))
            for first in range(0, len(table), step):
                part = table.slice(first, step)
                held = part if held is None else pa.concat_tables([held, part])
                anchors = np.asarray(held.column("anchor"))
                last = len(held) - int((anchors == anchors[-1]).sum())
                if last and held.nbytes >= block:
                    yield solve(held.slice(0, last))
                    held = held.slice(last)
        if held is not None and len(held):
            yield solve(held)

    return fetched.mapInArrow(run, "anchor long, content binary, state binary")


def _anchor_places(data: np.ndarray, length: int) -> np.ndarray:
    """Where the anchor of each string of a region begins."""
    grams = _hashes(data, GRAM)
    low = np.uint64((1 << 21) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    return (_lowest(keys, length - GRAM + 1) & low).astype(np.int64)[: len(data) - length + 1]


def cut_region(data: bytes, length: int, segments: int) -> Iterator[tuple[int, int, int]]:
    """(key, first string, number of strings) of the parts of a region.

    A string's anchor begins 0 to length - GRAM bytes behind it. These distances are cut into ``segments``, and strings
    with the same anchor place and segment are a part. All strings of a segment hold the same bytes around their
    anchor, save for the few by which they are shifted: the key is the hash of those bytes, so equal strings are in parts
    of one key, and parts that share an anchor but little else are told apart. With a segment for every distance a
    key is that of one whole string.
    """
    places = _anchor_places(np.frombuffer(data, np.uint8), length)
    distances = length - GRAM + 1
    segment = (places - np.arange(len(places))) * segments // distances
    new = np.concatenate(([True], (segment[1:] != segment[:-1]) | (places[1:] != places[:-1])))
    first = np.flatnonzero(new)
    for i, n in zip(first.tolist(), np.diff(np.append(first, len(places))).tolist()):
        k, at = int(segment[i]), int(places[i])
        nearest, farthest = -(-k * distances // segments), -(-(k + 1) * distances // segments) - 1
        around = data[at - nearest : at - farthest + length]
        yield xxhash.xxh3_64_intdigest(around, k) - (1 << 63), i, n


_PART = "key long, part binary, anchor long, content binary, i int, doc_id long, _text_key long, first long, strings int, bytes binary"


def _cut(regions_: DataFrame, length: int, far: int, segments: int) -> DataFrame:
    """The parts of regions (anchor, content, i, doc_id, _text_key, first, strings, bytes), ``i`` the first string's number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PART.split(", ")]
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                out: list[list] = [[] for _ in names]
                for anchor, content, i, doc_id, text_key, first, strings, data in zip(*(c.to_pylist() for c in batch.slice(start, 512).columns)):
                    for key, at, n in cut_region(data[: strings + length - 1], length, segments):
                        part = data[at : at + n + far - 1]
                        row = (key, xxhash.xxh3_128_digest(part, n), anchor, content, i + at, doc_id, text_key, first + at, n, part)
                        for column, value in zip(out, row):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    columns = ("anchor", "content", "i", "doc_id", "_text_key", "first", "strings", "bytes")
    return regions_.select(*columns).mapInArrow(run, _PART)


def _split_states(fetched: DataFrame, length: int, far: int, most: int, block: int) -> DataFrame:
    """(anchor, content, state) for anchors of very many regions: they are split by the bytes around the anchor.

    Regions are cut into parts whose strings share nearly all of their bytes; the parts of a key are put in suffix order
    like the regions of an ordinary anchor. A key that more than ``most`` different parts still share is cut finer,
    at last into single strings, where a key is one string: its parts differ at most in the bytes behind it, so counts and
    first places of keys and parts tell all. So no group is larger than ``most``.
    """
    left = fetched.dropDuplicates(["anchor", "content"]).withColumn("i", F.lit(0))
    found = None
    for segments in (8, 64, length - GRAM + 1):
        parts = stage(_cut(left, length, far, segments), "parts")
        place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_text_key", "first")
        classes = parts.groupBy(F.col("key").alias("anchor"), F.col("part").alias("content")).agg(
            F.count(F.lit(1)).alias("n"), F.min(place).alias("rep"), F.first("strings").alias("strings"), F.first("bytes").alias("bytes")
        )
        classes = stage(classes, "part-classes")
        sizes = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("_classes"), F.sum("n").alias("_n"), F.min("rep").alias("_rep"))
        single = segments == length - GRAM + 1
        if single:
            verdict = classes.join(sizes.filter("_n > 1"), "anchor").withColumn("state", F.lit(None).cast("binary"))
        else:
            many = stage(sizes.filter(F.col("_classes") > most).select("anchor"), "hot-keys")
            several = classes.join(sizes.filter((F.col("_classes") > 1) & (F.col("_classes") <= most)).select("anchor"), "anchor")
            columns = ["anchor", "content", "rep.doc_id", "rep._text_key", "rep.first", "strings", "bytes"]
            order = ["anchor", F.col("doc_id").asc_nulls_first(), "_text_key", "first", "content"]
            tasks = 1 + classes.count() // _TASK_REGIONS
            ready = several.select(*columns).repartition(tasks, "anchor").sortWithinPartitions(*order)
            states = _sorted_states(ready, length, far, block)
            verdict = classes.join(many, "anchor", "left_anti").join(states, ["anchor", "content"], "left")
            verdict = verdict.filter("n > 1 OR state IS NOT NULL").selectExpr("*", "n AS _n", "rep AS _rep")
        verdict = verdict.select(F.col("anchor").alias("key"), F.col("content").alias("part"), "n", "rep", "_n", "_rep", "state")
        verdict = stage(verdict, "part-verdicts")
        hits = parts.withColumn("place", place).join(verdict, ["key", "part"])

        def floor(rep: str, n: str):
            # a later copy of a part: an earlier equal exists for all its strings; the first copy: a later one does
            return F.when(F.col("place") == F.col(rep), F.when(F.col(n) > 1, 1).otherwise(0)).otherwise(2)

        whole = F.length("bytes") - (far - 1)  # strings of ``far`` bytes
        entry = F.struct(
            "i", F.col("strings").alias("n"), whole.alias("whole"), floor("_rep", "_n").alias("least"), floor("rep", "n").alias("least_far"), "state"
        )
        hits = hits.select("anchor", "content", entry.alias("e"))
        found = hits if found is None else found.unionByName(hits)
        if single or many.isEmpty():
            break
        left = parts.join(many.withColumnRenamed("anchor", "key"), "key").drop("key", "part")
    lists = found.groupBy("anchor", "content").agg(F.collect_list("e").alias("_all"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for entries in batch.column(2).to_pylist():
                state = np.zeros(max(e["i"] + e["n"] for e in entries), np.uint8)
                for e in entries:
                    own = np.frombuffer(e["state"], np.uint8) if e["state"] is not None else 0
                    near = np.maximum(own & 3, e["least"])
                    longer = np.where(np.arange(e["n"]) < e["whole"], np.maximum(own >> 2, e["least_far"]), 0) if far > length else 0
                    state[e["i"] : e["i"] + e["n"]] = near | longer << 2
                states.append(state.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(states, pa.binary())], ["anchor", "content", "state"]
            )

    return lists.mapInArrow(pack, "anchor long, content binary, state binary")


def repeated_spans(
    docs: DataFrame, length: int = 400, keep_first: bool = False, far: int = 0, most: int = 5_000, block: int = 1 << 19
) -> DataFrame:
    """Strings that start elsewhere too: rows (doc_id, _text_key, first, strings, floor, state).

    ``strings`` strings from byte ``first`` on belong to one region. A string whose state is 2 also starts earlier, one of
    state 1 only later. The state of all strings of a row is ``floor`` at least; ``state``, if not null, has a byte for
    each, that of its ``length`` bytes in the lower two bits, that of its ``far`` bytes (if asked for) in the next two.
    Unless ``keep_first`` or ``far`` is given, a 1 may stand for a 2.
    """
    far = far or length
    found = stage(_find_regions(docs, length, far), "regions")
    # most anchors occur once; what follows is for the others, a small side that spares the sort of all
    again = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("_times"), F.max("places").alias("_places"))
    again = again.filter("_times > 1 OR _places > 1").select("anchor")
    every, found = found, stage(found.join(again.hint("shuffle_hash"), "anchor"), "regions-again")
    unstage(every)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_text_key", "first")
    classes = found.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(place).alias("rep"),
        F.first("strings").alias("strings"),
        F.max("places").alias("places"),
    )
    classes = stage(classes, "region-classes")
    groups = classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("_classes"), F.min("n").alias("_least"), F.max("places").alias("_places")
    )
    open_ = F.col("_classes") + F.col("_places") > 2
    if not keep_first and far == length:
        open_ &= F.col("_least") == 1
    wanted = classes.join(groups.filter(open_).select("anchor", "_classes"), "anchor")
    wanted = wanted.select("anchor", "content", "rep.doc_id", "rep._text_key", "rep.first", "strings", "_classes")
    fetched = _fetch(_id_columns(docs), wanted, far)
    fetched = stage(fetched.join(groups.select("anchor", "_classes"), "anchor"), "region-bytes")
    columns = [x.split()[0] for x in _FETCHED.split(", ")]
    order = ["anchor", F.col("doc_id").asc_nulls_first(), "_text_key", "first", "content"]
    usual = fetched.filter(F.col("_classes") <= most).select(*columns)
    tasks = 1 + fetched.count() // _TASK_REGIONS  # left to itself, Spark merges them by bytes, which say little of the work
    usual = usual.repartition(tasks, "anchor").sortWithinPartitions(*order)
    states = _sorted_states(usual, length, far, block)
    hot = fetched.filter(F.col("_classes") > most).select(*columns)
    if not hot.isEmpty():
        states = states.unionByName(_split_states(hot, length, far, most, block))
    verdict = classes.join(states, ["anchor", "content"], "left").filter("n > 1 OR state IS NOT NULL")
    # staged, so that a class of very many occurrences meets it in a join of its own, which is split at run time
    verdict = stage(verdict.select("anchor", "content", "n", "rep", "state"), "verdicts")
    unstage(classes)  # their disk is wanted for the joins that follow
    unstage(fetched)
    hits = found.join(verdict, ["anchor", "content"])
    is_rep = F.col("rep") == place
    floor = F.when(~is_rep, 2).otherwise(F.when(F.col("n") > 1, 1).otherwise(0)).cast("byte")
    return hits.select("doc_id", "_text_key", "first", "strings", floor.alias("floor"), F.when(is_rep, F.col("state")).alias("state"))


def _spans(entries: list[dict] | None, size: int, length: int, least: int, shift: int = 0) -> list[tuple[int, int]]:
    """Maximal byte ranges of a text of ``size`` bytes covered by strings whose state is ``least`` or more.

    ``length`` is that of the strings, ``shift`` where their bits begin in a state.
    """
    edges = []
    for e in entries or ():
        first, strings = e["first"], min(e["strings"], size - length + 1 - e["first"])
        if strings <= 0:
            continue
        if e["floor"] >= least:
            edges.append((first, first + strings + length - 1))
        elif e["state"] is not None:
            hit = (np.frombuffer(e["state"], np.uint8) >> shift & 3) >= least
            change = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
            for a, b in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
                edges.append((first + a, first + b + length - 1))
    out: list[list[int]] = []
    for a, b in sorted(edges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _whole_characters(data: bytes, a: int, b: int) -> tuple[int, int]:
    """A span without the characters that it would cut."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def whole_words(data: bytes, a: int, b: int) -> int:
    """Words of a span without those that it cuts."""

    def cuts(at: int) -> bool:
        return 0 < at < len(data) and not data[at - 1 : at].isspace() and not data[at : at + 1].isspace()

    return max(0, len(data[a:b].split()) - cuts(a) - cuts(b))


def _passages(data: bytes, entries: list[dict] | None, length: int, least: int, words: int) -> list[tuple[int, int]]:
    """Spans of ``words`` whole words or of 400 bytes."""
    spans = _spans(entries, len(data), length, least)
    return [(a, b) for a, b in spans if b - a >= 400 or whole_words(data, a, b) >= words]


def _without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


_PASSAGE = 200  # bytes that passages have at least, however many words


def remove_repeats(
    docs: DataFrame,
    length: int = 400,
    keep_first: bool = False,
    with_bytes: bool = True,
    with_text: bool = False,
    words: int = 0,
    **limits: int,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, what remains.

    That is ``kept``, the bytes, and ``text``, the same as text, without the remains of characters that were cut.

    Texts are UTF-8 bytes; removed is each byte covered by a string of ``length`` bytes that starts anywhere
    else too, in any row; with ``keep_first``, by one that also starts earlier (smaller doc_id, then smaller place).
    Anchors shared by more than ``most`` different regions (a very common passage with different surroundings)
    are split by the bytes around the anchor until no group is larger.

    ``words`` asks for passages too, found in the same pass: ``n_passages`` counts those of ``words`` whole words or more
    (and 200 bytes), or of 400 bytes, that also stand elsewhere, first copies included; ``text_once`` is the text without
    later copies of them, as ``drop_later_copies`` leaves it. ``length`` must be over 200 then.

    Defined cases: a null text is empty; texts under ``length`` bytes stay; null doc_ids come first in order;
    rows equal in doc_id and text are copies of each other, of which ``keep_first`` takes none away; different
    texts under one doc_id are told apart by a hash; an empty table gives no rows; other columns are ignored.
    """
    least = 2 if keep_first else 1
    near, far, shift = (_PASSAGE, length, 2) if words else (length, 0, 0)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" * with_bytes + ", text string" * with_text + ", n_passages long, text_once string" * bool(words)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, entries in zip(*(c.to_pylist() for c in batch.columns)):
                data = (text or "").encode()
                spans = _spans(entries, len(data), length, least, shift)
                left = _without(data, spans)
                row = (doc_id, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest())
                row += (left,) * with_bytes + (left.decode(errors="ignore"),) * with_text
                if words:
                    later = [_whole_characters(data, a, b) for a, b in _passages(data, entries, near, 2, words)]
                    row += (len(_passages(data, entries, near, 1, words)), _without(data, later).decode())
                rows.append(row)
            kinds = {"kept": pa.binary(), "kept_sha256": pa.string(), "text": pa.string(), "text_once": pa.string()}
            columns = zip(*rows) if rows else [()] * len(names)
            arrays = [pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(columns, names)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    joined = _with_spans(docs, (), near, keep_first, limits | {"far": far})
    return joined.select("doc_id", "text", "_all").mapInArrow(run, schema)


def _with_spans(docs: DataFrame, more: tuple[str, ...], length: int, keep_first: bool, limits: dict) -> DataFrame:
    spans = repeated_spans(docs, length, keep_first, **limits)
    grouped = _per_document(spans, F.struct("first", "strings", "floor", "state"))
    return _join_documents(_id_columns(docs, *more), grouped, "left")


def drop_later_copies(docs: DataFrame, length: int = 400, words: int = 0, **limits: int) -> DataFrame:
    """``docs`` with every later copy of a repeated passage cut out of ``text``, the first one kept.

    Passages of fewer than ``words`` whole words stay, unless they have 400 bytes (texts without white space).
    Cuts keep characters whole. ``n_chars``, where there is such a column, is counted again for texts that change;
    documents of which nothing is left are dropped. Columns and other cases as in ``remove_repeats``.
    """
    types = dict(docs.dtypes)
    docs, names = hide(docs, "doc_id", "text")
    passed = [n for c, n in names.items() if n != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, changed = [], []
            for text, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode()
                later = [_whole_characters(data, a, b) for a, b in _passages(data, entries, length, 2, words)]
                changed.append(bool(later))
                texts.append(_without(data, later).decode() if later else text)
            columns = [pa.array(texts, pa.string()), pa.array(changed, pa.bool_()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["text", "_changed", *passed])

    keyed = docs.withColumnRenamed("doc_id", "_id").withColumn("doc_id", F.col("_id"))
    more = ["_id" if n == "doc_id" else n for n in passed]
    rows = _with_spans(keyed, tuple(more), length, True, limits).select("text", "_all", *more)
    schema = ", ".join(["text string", "_changed boolean", *(f"{n} {types[c]}" for c, n in names.items() if n != "text")])
    out = rows.mapInArrow(run, schema).filter("NOT _changed OR text <> ''")
    if "n_chars" in names:
        now = F.char_length("text").cast(types["n_chars"])
        out = out.withColumn(names["n_chars"], F.when(F.col("_changed"), now).otherwise(F.col(names["n_chars"])))
    return show(out, names)
