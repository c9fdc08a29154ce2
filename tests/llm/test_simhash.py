from itertools import combinations

import numpy as np
import plain
import pytest

from fraudlens.llm import simhash
from fraudlens.llm.components import connected_components


def expected(rows, radius=3):
    """fingerprint and component of (doc_id, text) rows, as the contract says."""
    prints = [plain.fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a, b in combinations(set(prints), 2) if (a ^ b).bit_count() <= radius]
    part = plain.components(pairs, set(prints))
    best = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            best[part[p]] = min(best.get(part[p], i), i)
    return sorted(((i, f"{p:016x}", best.get(part[p])) for (i, _), p in zip(rows, prints)), key=str)


@pytest.mark.parametrize("most", [20_000, 2])
def test_whole_table(spark, sf_dir, most):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs, most=most).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert len({r[2] for r in got}) < len(got)


@pytest.mark.parametrize("most", [20_000, 2])
def test_awkward_rows(spark, most):
    df = plain.awkward_docs(spark, extra=True)
    got = sorted((tuple(r) for r in simhash.near_duplicates(df, most=most).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in df.collect()])
    assert simhash.near_duplicates(plain.empty_docs(spark)).collect() == []
    kept = simhash.keep_first(df, most=most)
    assert kept.columns == df.columns
    rows = kept.collect()
    prints = {int(f, 16) for _, f, _ in got}
    near = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 3]
    assert len(rows) == len(set(plain.components(near, prints).values()))
    assert {r.doc_id for r in rows} <= {g for _, _, g in got}


def test_dense_balls_split_into_trees(spark):
    """Hundreds of values within a few bits of each other, and buckets of two values at most."""
    rng = np.random.default_rng(3)
    values = []
    for base in rng.integers(0, 2**63, 3).tolist():
        for _ in range(60):
            x = base
            for b in rng.integers(0, 64, 3).tolist():
                x ^= 1 << b
            values.append(x - 2**64 if x >= 2**63 else x)
    values = sorted(set(values))
    df = spark.createDataFrame([(v,) for v in values], "_fp long")
    found = simhash.links(df, most=2).collect()
    pairs = [(a, b) for a, b in combinations(values, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert plain.components([tuple(r) for r in found], values) == plain.components(pairs, values)


def test_trees_find_what_is_within_the_radius():
    rng = np.random.default_rng(0)
    value = rng.integers(0, 256, 400).astype(np.uint64)
    group = rng.integers(0, 5, 400)
    forest = simhash.BKForest(group, value)
    for radius in (0, 1, 3):
        got = {(q, n) for a, b in forest.within(group, value, radius) for q, n in zip(a.tolist(), b.tolist())}
        near = np.bitwise_count(value[:, None] ^ value[None, :]) <= radius
        assert got == {(q, n) for q, n in zip(*np.nonzero(near & (group[:, None] == group[None, :])))}


def test_components_of_paths_and_stars(spark):
    rng = np.random.default_rng(1)
    path = rng.permutation(300).tolist()
    pairs = [*zip(path, path[1:]), *((1000, x) for x in range(1001, 1400)), (5000, 5001), (6000, 6000)]
    got = connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = plain.components(pairs, {x for p in pairs[:-1] for x in p})
    assert {tuple(r) for r in got} == set(want.items()) and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_long_texts_are_whole():
    text = plain.prose(8, 70_000)
    words = text.encode().lower().split()
    assert len(words) == 70_000 and simhash.fingerprint(text) == plain.fingerprint(text)
