import math

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from fraudlens.llm import ann, kdtree
from fraudlens.llm.queries import CHECKS, QUERIES
from fraudlens.llm.vectors import Ids

VECTORS = "vec_id long, embedding array<float>, label int, score double, rank string"


def every(n):
    return F.col("id") % n == 0


def usable(rows, zero):
    out = []
    for r in rows:
        v = r.embedding
        if r.vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero or any(v):
            out.append((r.vec_id, tuple(v)))
    return sorted(set(out))


def plain_top(rows, n, k, measure):
    out = []
    for i, q in rows:
        if i % n == 0:
            scored = sorted((-measure(q, v), j) for j, v in rows if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def inner(q, v):
    return sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(q, v))


def cosine(q, v):
    q, v = np.array(q, float), np.array(v, float)
    return float(q @ v / (np.linalg.norm(q) * np.linalg.norm(v)))


def awkward(spark, n=400, d=6, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, d)], 1, 0.5, "x") for i in range(n)]
    rows += [(n + i, [1.0] * d, 1, 0.5, "x") for i in range(n // 2)]  # a third are one vector
    bad = [None, [None] * d, [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [0.0] * d, [], [1.0, 2.0]]
    rows += [(10_000 + 10 * i, v, None, None, None) for i, v in enumerate(bad)]
    rows += [rows[0], rows[0], (None, [1.0] * d, 1, 0.5, "x")]
    return spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_integer_products_are_exact(spark, shard_rows):
    df = awkward(spark)
    got = kdtree.top_k(df, every(10), shard_rows=shard_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_top(usable(df.collect(), True), 10, 5, inner)
    assert kdtree.top_k(df.limit(0), every(10)).collect() == []


def test_large_integers_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8) * 3e5]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_top(usable(df.collect(), True), 10, 5, inner)
    assert sorted(tuple(r) for r in kdtree.top_k(df, every(10), shard_rows=20).collect()) == want


def test_a_repeated_row_takes_no_places(spark):
    """One (id, vector) stands 20 times beside other ids with the same vector."""
    rng = np.random.default_rng(8)
    rows = [(0, [3.0, 1.0, 2.0])] * 20 + [(i, [3.0, 1.0, 2.0]) for i in range(1, 9)]
    rows += [(10 + i, [float(x) for x in rng.normal(size=3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    distinct = usable(df.collect(), True)
    got = sorted(tuple(r) for r in kdtree.top_k(df, every(4)).collect())
    assert got == plain_top(distinct, 4, 5, inner)
    near = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, every(4)).collect())
    assert [x for x in near if x[0] in (0, 4)] == [(0, r, r) for r in range(1, 6)] + list(zip([4] * 5, range(1, 6), [0, 1, 2, 3, 5]))


def test_top_k_whole_table(spark, sf_dir):
    got = QUERIES["op7_kd_tree_top_k"](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(CHECKS["op7_kd_tree_top_k"]).df()) is None


def test_tree_boxes_hold_their_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (1000, 4))
    ids = rng.permutation(1000) + 5000
    numbers = Ids(ids, pa.array([int(i) + 9000 if i % 3 else None for i in ids], pa.int64()))
    tree = kdtree.KDTree(np.arange(1000), numbers, rows, leaf=16)
    for (a, b), low, high, children in zip(tree.spans, tree.low, tree.high, tree.children):
        assert (tree.rows[a:b].min(0) == low).all() and (tree.rows[a:b].max(0) == high).all()
        assert children or b - a <= 16
    q = rng.integers(-50, 50, (20, 4))
    own = ids[:20]
    i, gid, counted, score = tree.best(q, own, np.full(20, -(1 << 62)), 7)
    for k in range(20):
        there = [(j, int(x) if x != own[k] else int(x) + 9000) for j, x in enumerate(ids) if x != own[k] or x % 3]
        want = sorted((-int(rows[j] @ q[k]), x, j) for j, x in there)[:7]
        mine = i == k
        assert sorted(zip((-score[mine]).tolist(), counted[mine].tolist(), gid[mine].tolist())) == want


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 20}, {"bucket_rows": 20, "most": 16}])
def test_cosines(spark, options):
    df = awkward(spark, seed=2)
    rows = usable(df.collect(), False)
    got = ann.nearest(df, every(10), **options).collect()
    want = plain_top(rows, 10, 5, cosine)
    by_id = dict(rows)
    assert {(r.query_id, r["rank"]) for r in got} == {x[:2] for x in want}
    for r in got:
        assert abs(r.score - cosine(by_id[r.query_id], by_id[r.vec_id])) < 1e-12 and r.query_id != r.vec_id
    best = {(q, r): s for q, r, _, s in want}
    assert np.mean([r.score > best[r.query_id, r["rank"]] - 1e-9 for r in got]) > 0.9
    assert ann.nearest(df.limit(0), every(10)).collect() == []


def test_recall_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op6_multiprobe_lsh"](spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.stack(rows.embedding.to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = rows.vec_id.to_numpy()
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i]
        s[i] = -2
        want = set(ids[np.argsort(-s)[:5]].tolist())
        hits += len(want & {r.vec_id for r in got if r.query_id == ids[i]})
        total += 5
    assert len(got) == total and hits / total >= 0.9


def test_far_clusters_are_found_by_the_exact_way(spark):
    """Queries whose every neighbour lies where no probe goes still get five."""
    rng = np.random.default_rng(5)
    rows = [(1 + i, [-1.0 + 0.001 * float(x) for x in rng.normal(size=16)]) for i in range(300)]
    rows += [(0, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("id") == 0, bucket_rows=20).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5]


def test_recall_where_the_known_buckets_fall_short(spark):
    """Eight functions: the likeliest 4096 buckets a table are too few, so queries meet all rows."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50_000, 32))
    hashes = ann.Hashes(4, 8)
    assert [len(n) for n in hashes.probes(x[:3], np.full(3, 0.3), 0.584)] == [0, 0, 0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, every(2500), bucket_rows=1).collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 50_000, 2500):
        s = x @ x[i]
        s[i] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & {r.vec_id for r in got if r.query_id == i})
    assert len(got) == 100 and hits >= 97


def merged_top(rows, n, k, measure):
    """As the SQL has it: all pairs of a query id's vectors with rows of other ids are ranked together."""
    found = {}
    for i, q in rows:
        if i % n == 0:
            found.setdefault(i, []).extend((-measure(q, v), j) for j, v in rows if j != i and len(v) == len(q))
    return sorted((i, r + 1, j, -s) for i, pairs in found.items() for r, (s, j) in enumerate(sorted(pairs)[:k]))


@pytest.mark.parametrize("options", [{}, {"shard_rows": 16, "slice_rows": 3}])
def test_one_id_on_several_vectors(spark, tmp_path, options):
    """Ids on one, two and seven different vectors, as queries and as candidates, against the SQL of the query."""
    rng = np.random.default_rng(11)
    rows = [(0, rng.integers(-4, 5, 4)) for _ in range(7)] + [(50, rng.integers(-4, 5, 4)) for _ in range(2)]
    rows += [(i, rng.integers(-4, 5, 4)) for i in (3, 3, 7, 7, 7, 9, 11, 13, 100, 101, 102)]
    rows += [(200 + i, rng.integers(-4, 5, 4)) for i in range(60)] + [(0, rows[9][1]), (3, rows[0][1]), (50, rows[0][1])]
    data = sorted({(i, tuple(float(x) for x in v)) for i, v in rows})
    df = spark.createDataFrame([(i, list(v)) for i, v in data], "vec_id long, embedding array<double>").repartition(3)
    want = merged_top(data, 50, 5, inner)
    assert sorted(tuple(r) for r in kdtree.top_k(df, every(50), **options).collect()) == want
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    sql = CHECKS["op7_kd_tree_top_k"].replace("FROM embeddings", f"FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    theirs = connect("/root/testdata/sf0.001").execute(sql).fetchall()
    assert sorted((r[0], r[1], r[3]) for r in theirs) == [(q, r, s) for q, r, _, s in want]
    near = ann.nearest(df, every(50)).collect()
    best = merged_top(data, 50, 5, lambda q, v: cosine(q, v) if any(q) and any(v) else -9.0)
    assert [(q, r) for q, r, *_ in sorted(map(tuple, near))] == [(q, r) for q, r, *_ in best]
    assert np.allclose([x[3] for x in sorted(map(tuple, near))], [x[3] for x in best])


def test_seven_near_equal_versions_of_a_query(spark):
    rows = [(50, [1.0 + i / 100, 1.0]) for i in range(7)] + [(i, [float(i), 1.0]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    data = usable(df.collect(), True)
    assert sorted(tuple(r) for r in kdtree.top_k(df, every(50)).collect()) == merged_top(data, 50, 5, inner)
    got = sorted(tuple(r) for r in ann.nearest(df, every(50)).collect())
    assert [x[:3] for x in got] == [x[:3] for x in merged_top(data, 50, 5, cosine)] and len(got) == 5


def test_very_small_and_very_large_components(spark):
    rows = [(0, [1e-200, 0.0]), (1, [2e-200, 1e-200]), (2, [1e300, 1e300]), (3, [5e-324, 0.0]), (4, [0.0, -3.0]), (5, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in ann.nearest(df, every(2)).collect())
    angle = {0: 0.0, 1: math.atan2(1, 2), 2: math.atan2(1, 1), 3: 0.0, 4: -math.pi / 2, 5: math.atan2(1, 2)}
    want = []
    for q in (0, 2, 4):
        pairs = sorted((-round(math.cos(angle[q] - angle[j]), 9), j) for j in angle if j != q)
        want += [(q, r + 1, j, -s) for r, (s, j) in enumerate(pairs)]
    assert [(q, r, j, round(s, 9) + 0.0) for q, r, j, s in got] == [(q, r, j, s + 0.0) for q, r, j, s in want]
    with pytest.raises(Exception, match="too large"):
        kdtree.top_k(df, every(2)).collect()
    small = df.filter("vec_id <> 2")
    data = usable(small.collect(), True)
    assert sorted(tuple(r) for r in kdtree.top_k(small, every(2)).collect()) == plain_top(data, 2, 5, inner)


def test_splits_prune_shards(spark):
    """Two far clusters: the queries of one meet no shard of the other."""
    rng = np.random.default_rng(13)
    far = np.array([3.0] + [0.0] * 7)
    rows = [(i, (rng.normal(size=8) * 0.1 + (far if i % 2 else -far)).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    data = usable(df.collect(), True)
    assert sorted(tuple(r) for r in kdtree.top_k(df, every(40), shard_rows=100).collect()) == plain_top(data, 40, 5, inner)
    groups, units = kdtree.prepare(kdtree.scaled(kdtree.usable(df, "vec_id", "embedding"), 256), every(40), 5)
    splits = kdtree.fit_splits(groups, 800, 100)
    shards = kdtree._packed(kdtree.dealt(splits.place(groups.drop("ids")), ["size", "leaf"], 100, "block", "gid"))
    asking = kdtree.dealt(splits.place(units), ["size", "leaf"], 50, "slice", "uid").withColumn("bound", F.lit(400_000).cast("long"))
    tiles = kdtree._other_tiles(kdtree._boxes(asking), shards.cache(), 2)
    side = {r.block: r.low[0] > 0 for r in shards.collect()}
    asked = {r.slice: r.at_least[0] > 0 for r in kdtree._boxes(asking).collect()}
    found = [(side[t.block], asked[t.slice]) for t in tiles.collect()]
    assert found and all(a == b for a, b in found)
