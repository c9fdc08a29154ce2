import math

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from fraudlens.llm import bond
from fraudlens.llm.queries import CHECKS, QUERIES

NAME = "op11_bond_hard_negatives"
VECTORS = "vec_id long, embedding array<double>, label int, score double, norm string"


def every(n):
    return F.col("id") % n == 0


def plain(rows, n, positives=5, negatives=3):
    """All products of all rows."""
    rows = {
        (r.vec_id, r.label, tuple(math.floor(256 * x) for x in r.embedding))
        for r in rows
        if r.vec_id is not None and r.label is not None and r.embedding is not None
        and all(x is not None and math.isfinite(x) for x in r.embedding)
    }
    out = []
    for i, label, q in rows:
        if i % n:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in rows if j != i and len(v) == len(q))
        for ps, p, other in [x for x in scored if x[2] == label][:positives]:
            ps = -ps
            near = [x for x in scored if x[2] != label and 50 * ps <= -100 * x[0] <= 95 * ps]
            out += [(i, p, r + 1, j, ps, -s) for r, (s, j, _) in enumerate(near[:negatives])]
    return sorted(out)


def result(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def awkward(spark, n=300, d=6, seed=0, spread=4):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-spread, spread, d)], int(rng.integers(3)), 0.5, "x") for i in range(n)]
    rows += [(n + i, [1.0] * d, i % 2, 0.5, "x") for i in range(n // 2)]  # a third are one vector
    bad = [None, [None] * d, [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [0.0] * d, [], [], [1.0, 2.0], [2.0, 1.0]]
    rows += [(10_000 + 10 * i, v, i % 2, None, None) for i, v in enumerate(bad)]
    rows += [rows[0], rows[0], (None, [1.0] * d, 1, 0.5, "x"), (20_000, [2.0] * d, None, 0.5, "x")]
    return spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "slice_rows": 7}])
def test_equals_all_products(spark, options):
    df = awkward(spark)
    want = plain(df.collect(), 10)
    assert len(want) > 200 and result(bond.hard_negatives(df, every(10), **options)) == want
    assert bond.hard_negatives(df.limit(0), every(10)).collect() == []


def test_few_partners(spark):
    """Fewer positives and negatives than asked for, none at all, one label only."""
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 2), (3, [0.55, 0.0], 2), (4, [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(bond.hard_negatives(df, every(10))) == plain(df.collect(), 10) == [
        (0, 1, 1, 2, 65536, 58880), (0, 1, 2, 3, 65536, 35840)
    ]
    assert bond.hard_negatives(df.filter("label = 1"), every(10)).collect() == []
    assert bond.hard_negatives(df.filter("vec_id IN (0, 2)"), every(10)).collect() == []


def test_negative_positives_have_no_window(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.7, 0.0], 2), (10, [0.0, 0.0], 3), (11, [0.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(bond.hard_negatives(df, every(10))) == plain(df.collect(), 10)


def test_one_id_on_several_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i // 4 * 5, [float(x) for x in rng.integers(-3, 4, 3)], int(rng.integers(2))) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(bond.hard_negatives(df, every(10), block_rows=16, slice_rows=3)) == plain(df.collect(), 10)


def test_large_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 1e6], i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(bond.hard_negatives(df, every(10), block_rows=20)) == plain(df.collect(), 10)
    huge = spark.createDataFrame([(0, [1e300, 1.0], 1), (1, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        bond.hard_negatives(huge, every(10)).collect()


@pytest.mark.parametrize("kind", [np.float64, object])
def test_scan_finds_the_best_of_every_window(kind):
    rng = np.random.default_rng(5)
    ids = np.sort(rng.permutation(5000)[:1500])
    block = bond.Block(ids, rng.integers(-200, 200, (24, 1500)).astype(kind))
    for i in range(30):
        q = rng.integers(-200, 200, 24).astype(kind)
        exact = (q @ block.columns).astype(np.int64)
        top = int(exact.max())
        low, high = np.array([-(1 << 62), top // 2, top // 3, 5]), np.array([1 << 62, top * 9 // 10, top // 2, 4])
        want = []
        for w, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
            rows = sorted((-s, j) for s, j in zip(exact.tolist(), ids.tolist()) if a <= s <= b and j != ids[i])
            want += [(w, j, -s) for s, j in rows[:3]]
        assert block.scan(q, int(ids[i]), low, high, 3) == want
        assert block.possible(q[None], [low], [high]) == [0]
        assert block.possible(q[None], [np.array([1 << 40])], [np.array([1 << 41])]) == []


def test_whole_table(spark, sf_dir):
    got = QUERIES[NAME](spark, sf_dir).toPandas()
    assert len(got) and differences(got, connect(sf_dir).execute(CHECKS[NAME]).df()) is None
