import random

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import ordering

KEYS = ["t", "id"]


def table(spark, n=500, seed=1):
    """A third of the rows share one order value."""
    rng = random.Random(seed)
    rows = [
        (
            7 if i % 3 == 0 else rng.randrange(-50, 10**6),
            f"{rng.random():.12f}",
            "hot" if i % 3 else f"g{i % 7}",
            rng.randrange(5),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "t bigint, id string, g string, v bigint").repartition(5), rows


@pytest.fixture(scope="module")
def data(spark):
    return table(spark)


def test_row_index_is_the_sort_position(data):
    df, rows = data
    found = {(r.t, r.id): r.row_idx for r in ordering.with_row_index(df, KEYS).collect()}
    assert found == {(r[0], r[1]): i for i, r in enumerate(sorted(rows))}


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_totals_by_group(data, inclusive):
    df, rows = data
    totals = {"s": ("sum", F.col("v")), "m": ("max", F.col("t"))}
    found = {
        r.id: (r.s, r.m)
        for r in ordering.running_totals(df, KEYS, totals, by=["g"], inclusive=inclusive).collect()
    }
    seen: dict = {}
    for t, i, g, v in sorted(rows):
        before = seen.get(g, (0, None))
        seen[g] = (before[0] + v, t)
        assert found[i] == (seen[g] if inclusive else before)


def test_running_totals_over_everything(data):
    df, rows = data
    found = {
        r.id: r.s
        for r in ordering.running_totals(df, KEYS, {"s": ("sum", F.col("v"))}).collect()
    }
    total = 0
    for _, i, _, v in sorted(rows):
        total += v
        assert found[i] == total


@pytest.mark.parametrize("small_bin", [10_000, 3])
def test_keys_at_every_kind_of_rank(data, monkeypatch, small_bin):
    monkeypatch.setattr(ordering, "SMALL_BIN", small_bin)
    monkeypatch.setattr(ordering, "HISTOGRAM_BINS", 16)
    df, rows = data
    ordered = sorted(rows)
    tied = next(i for i, r in enumerate(ordered) if r[0] == 7) + 5
    ranks = [0, tied, 250, 499, 500]
    assert ordering.keys_at(df, KEYS, ranks) == [
        *(ordered[rank][:2] for rank in ranks[:-1]),
        None,
    ]


def test_split_sizes_follow_int_of_share(data):
    df, rows = data
    cuts = [(0.6, "train"), (0.8, "validation"), (1.0, "test")]
    split = ordering.chronological_split(df, KEYS, cuts)
    found = {r.id: r.split for r in split.collect()}
    for i, r in enumerate(sorted(rows)):
        assert found[r[1]] == ("train" if i < 300 else "validation" if i < 400 else "test")


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "t bigint, id string")
    cuts = [(0.8, "train"), (1.0, "test")]
    assert ordering.chronological_split(empty, KEYS, cuts).count() == 0


@pytest.mark.parametrize("start, limit", [(0, 0), (0, 10), (480, 100), (490, 0), (500, 5), (3, 1)])
def test_row_slice(data, start, limit):
    df, rows = data
    part = ordering.row_slice(df, KEYS, start, limit)
    expected = list(enumerate(sorted(rows)))[start : start + limit if limit else None]
    assert sorted((r.row_idx, r.id) for r in part.collect()) == [(i, r[1]) for i, r in expected]


@pytest.mark.parametrize("n", [1, 20, 499, 500, 900])
def test_last_rows(data, n):
    df, rows = data
    kept = {r.id for r in ordering.last_rows(df, KEYS, n).collect()}
    assert kept == {r[1] for r in sorted(rows)[-n:]}


def test_label_positions(spark):
    rows = [(i, f"{i:03d}", int(i in (4, 20, 61))) for i in range(101)]
    df = spark.createDataFrame(rows, "t bigint, id string, is_fraud int").repartition(3)
    found = ordering.label_positions(df, KEYS, "is_fraud").first()
    assert tuple(found) == (4, 61, 2, 1)
    none = df.withColumn("is_fraud", F.lit(0))
    assert tuple(ordering.label_positions(none, KEYS, "is_fraud").first()) == (
        None,
        None,
        0,
        0,
    )


def test_hot_keys_lists_the_largest(data):
    df, _ = data
    assert [r.g for r in ordering.hot_keys(df, "g", 100).collect()] == ["hot"]
    assert ordering.hot_keys(df, "g", 10_000) is None


@pytest.mark.parametrize("n", [0, 1, 3, 4, 6, 9])
def test_last_rows_take_unknown_times_last(spark, n):
    rows = [(i, i if i % 2 else None) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, t long")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))[max(0, 8 - n) :]
    assert {r.id for r in ordering.last_rows(df, ["t", "id"], n).collect()} == {r[0] for r in want[:n]}


def test_unsupported_order_keys_are_refused(spark):
    rows = spark.createDataFrame([(1.5, 1), (2.5, 2)], "k double, n int")
    with pytest.raises(TypeError, match="integer or a timestamp"):
        ordering.keys_at(rows, ["k"], [0])
    rows = spark.createDataFrame([(1, 1), (None, 2)], "k bigint, n int")
    with pytest.raises(ValueError, match="1 rows have no k"):
        ordering.chronological_split(rows, ["k"], [(0.5, "a"), (1.0, "b")])
