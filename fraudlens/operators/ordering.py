"""Positions, running totals, splits and slices over a total order.

None of these puts a whole table, or a whole group, into one task: rows are range-sorted, staged
with their place in the sort, and only one total per (chunk, group) is carried forward.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.session import stage

_CHUNK, _POS = "_chunk", "_pos"
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row number below

HISTOGRAM_BINS = 4096
SMALL_BIN = 10_000

Total = tuple[str, Column]  # ("sum" | "max", expression)


def sorted_chunks(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` range-sorted and staged, with the sort partition and the place inside it."""
    place = F.monotonically_increasing_id()
    ranked = df.orderBy(*order).withColumn(_POS, place)
    ranked = ranked.withColumn(_CHUNK, F.shiftright(F.col(_POS), _POSITION_BITS))
    ranked = ranked.withColumn(_POS, F.col(_POS).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    return stage(ranked, "sorted")


def with_row_index(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_idx", start: int = 0
) -> DataFrame:
    """0-based position of every row in the given total order.

    One range shuffle; the start of each chunk comes from one row per sort partition.
    """
    chunks = sorted_chunks(df, order)
    sizes = chunks.groupBy(_CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        _CHUNK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        chunks.join(F.broadcast(starts), _CHUNK)
        .withColumn(name, F.col("_start") + F.col(_POS) + F.lit(start))
        .drop(_CHUNK, _POS, "_start")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    totals: dict[str, Total],
    by: Sequence[str] = (),
    inclusive: bool = True,
) -> DataFrame:
    """Running sums or maxima per group along an order, exact for groups of any size.

    Each chunk of the range sort is totalled on its own; what came before a chunk in the same group
    is one row per (chunk, group).  Exclusive totals leave the current row out: sums start at 0,
    maxima at NULL.
    """
    by = list(by)
    chunks = sorted_chunks(df, [*by, *order])
    last = 0 if inclusive else -1
    local_frame = (
        Window.partitionBy(_CHUNK, *by)
        .orderBy(_POS)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    aggregate = {"sum": F.sum, "max": F.max}
    local = chunks.withColumns(
        {name: aggregate[kind](expr).over(local_frame) for name, (kind, expr) in totals.items()}
    )

    per_chunk = chunks.groupBy(_CHUNK, *by).agg(
        *[aggregate[kind](expr).alias(f"_t_{name}") for name, (kind, expr) in totals.items()]
    )
    earlier = Window.orderBy(_CHUNK)
    if by:
        earlier = Window.partitionBy(*by).orderBy(_CHUNK)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(
        F.col(_CHUNK),
        *by,
        *[
            aggregate[kind](f"_t_{name}").over(earlier).alias(f"_c_{name}")
            for name, (kind, _) in totals.items()
        ],
    )
    if not by:
        carried = F.broadcast(carried)  # one row per sort partition

    def combine(name: str, kind: str) -> Column:
        mine, carry = F.col(name), F.col(f"_c_{name}")
        if kind == "max":
            return F.greatest(mine, carry)
        return F.coalesce(mine, F.lit(0)) + F.coalesce(carry, F.lit(0))

    keys = [_CHUNK, *by]
    return (
        local.join(carried, keys)
        .withColumns({name: combine(name, kind) for name, (kind, _) in totals.items()})
        .drop(_CHUNK, _POS, *[f"_c_{name}" for name in totals])
        .select(*df.columns, *totals)
    )


def _key_before(keys: Sequence[str], bound: Sequence) -> Column:
    """Row key < bound, compared column by column."""
    condition = F.lit(False)
    for column, value in reversed(list(zip(keys, bound))):
        condition = (F.col(column) < F.lit(value)) | (
            (F.col(column) == F.lit(value)) & condition
        )
    return condition


def _scale(df: DataFrame, key: str) -> tuple[Column, Callable[[int], Column]]:
    """The key as a bigint of the same order, and the literal of the key for such a bigint."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key), lambda value: F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.IntegralType):
        return F.col(key).cast("bigint"), F.lit
    raise TypeError(f"the first order key must be an integer or a timestamp, {key} is {kind.simpleString()}")


def _extent(df: DataFrame, key: str) -> tuple[int, int, int]:
    """Smallest and largest key as bigints, and the number of rows."""
    value, _ = _scale(df, key)
    low, high, rows, known = df.agg(
        F.min(value), F.max(value), F.count(F.lit(1)), F.count(value)
    ).first()
    if known < rows:
        raise ValueError(f"{rows - known} rows have no {key}; leave them out or give them one")
    return low, high, rows


def keys_at(
    df: DataFrame,
    keys: Sequence[str],
    ranks: Sequence[int],
    extent: tuple[int, int, int] | None = None,
) -> list[tuple | None]:
    """The order keys of the rows at 0-based ranks, None beyond the end.

    The first key is an integer or a timestamp, without NULLs (both are checked); later keys
    break its ties.  Ranks
    are closed in on by histograms of the first key, with filters a file scan can use, so only a
    last small bin is sorted.
    """
    keyed = df.select(*keys)
    value, literal = _scale(keyed, keys[0])
    low, high, rows = extent or _extent(keyed, keys[0])

    def within(first: int, last: int) -> DataFrame:
        return keyed.filter(F.col(keys[0]).between(literal(first), literal(last)))

    def histogram(first: int, last: int) -> tuple[int, list[tuple[int, int]]]:
        width = -(-(last - first + 1) // HISTOGRAM_BINS)
        from_first = value - F.lit(first)
        edge = (from_first - F.pmod(from_first, F.lit(width))).alias("edge")
        counts = within(first, last).groupBy(edge).count()
        return width, sorted(map(tuple, counts.collect()))  # at most HISTOGRAM_BINS rows

    shared = histogram(low, high) if rows > SMALL_BIN and low < high else None

    def find(rank: int) -> tuple | None:
        if not 0 <= rank < rows:
            return None
        first, last, inside, bins = low, high, rows, shared
        while inside > SMALL_BIN and first < last:
            width, counts = bins or histogram(first, last)
            bins = None
            for edge, inside in counts:
                if rank < inside:
                    first, last = first + edge, min(last, first + edge + width - 1)
                    break
                rank -= inside
        found = within(first, last)
        if inside <= SMALL_BIN:
            return tuple(found.orderBy(*keys).offset(rank).limit(1).first())
        indexed = with_row_index(found, keys, "_rank")
        return tuple(indexed.filter(F.col("_rank") == rank).select(*keys).first())

    return [find(rank) for rank in ranks]


def chronological_split(
    df: DataFrame, keys: Sequence[str], cuts: Sequence[tuple[float, str]], name: str = "split"
) -> DataFrame:
    """Label rows by their share of the order.

    ``cuts`` lists (share, label): ``[(0.8, "train"), (1.0, "test")]`` puts the first
    ``int(n * 0.8)`` rows in train.  The cut positions are turned into cut keys, so the rows
    themselves are neither sorted nor shuffled.
    """
    extent = _extent(df, keys[0])
    ranks = [int(extent[2] * share) for share, _ in cuts[:-1]]
    label = F.lit(cuts[-1][1])
    bounds = keys_at(df, keys, ranks, extent)
    for bound, (_, text) in reversed(list(zip(bounds, cuts))):
        if bound is not None:
            label = F.when(_key_before(keys, bound), F.lit(text)).otherwise(label)
    return df.withColumn(name, label)


def row_slice(
    df: DataFrame, keys: Sequence[str], start: int = 0, limit: int = 0, name: str = "row_idx"
) -> DataFrame:
    """Rows ``[start, start + limit)`` of the order with their position; limit 0 is all.

    Only the slice is sorted.
    """
    first, stop = keys_at(df, keys, [start, start + limit])
    part = df if first else df.limit(0)
    if start and first:
        part = part.filter(~_key_before(keys, first))
    if limit and stop:
        part = part.filter(_key_before(keys, stop))
    return with_row_index(part, keys, name, start)


def label_positions(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """First and last position of the labelled rows, and their count in each half."""
    extent = _extent(df, keys[0])
    is_marked = F.col(label) == 1
    key = F.struct(*keys)
    ends = df.filter(is_marked).agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    middle = keys_at(df, keys, [extent[2] // 2], extent)[0]
    in_first = _key_before(keys, middle) if middle else F.lit(False)

    def position(bound) -> Column:
        if bound is None:
            return F.lit(None).cast("bigint")
        return F.count(F.when(_key_before(keys, bound), F.lit(1)))

    return df.agg(
        position(ends.low).alias("first_position"),
        position(ends.high).alias("last_position"),
        F.count(F.when(is_marked & in_first, F.lit(1))).alias("first_half"),
        F.count(F.when(is_marked & ~in_first, F.lit(1))).alias("second_half"),
    )


def last_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of the order, unsorted.

    The place of the first row kept is turned into its key, so this is a filter: nothing is
    shuffled however large ``n`` is. Rows without the first key are older than all others.
    """
    if n <= 0:
        return df.limit(0)
    known = df.filter(F.col(keys[0]).isNotNull())
    extent = _extent(known, keys[0])
    surplus = extent[2] - n
    if surplus > 0:
        return known.filter(~_key_before(keys, keys_at(known, keys, [surplus], extent)[0]))
    unknown = df.filter(F.col(keys[0]).isNull())
    if unknown.count() <= -surplus:
        return df
    return known.unionByName(unknown.orderBy(*[F.desc(key) for key in keys[1:]]).limit(-surplus))


def first_rows(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order (W8, W9): each task keeps ``k``, nothing is fully sorted."""
    return df.orderBy(*order).limit(k)


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame | None:
    """The keys with at least ``min_rows`` rows as a staged table, or None.

    The list routes rows between two exact plans; it is joined as the optimizer finds best.
    """
    counts = df.groupBy(key).count().filter(F.col("count") >= min_rows)
    keys = stage(counts.select(key), "hot-keys")
    return None if keys.isEmpty() else keys
